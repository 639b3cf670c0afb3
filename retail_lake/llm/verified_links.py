"""Exact similarity of sets of shingles for candidate pairs, without listing all pairs of a group.

Candidates come as lists of sets that share a key; of each list only a star goes on, from its hub to every
other member. ``confirmed`` checks the stars. A list that this makes one component needs no more, nor does
a list of two. Of the others, ``remaining`` compares the members that are not linked yet, in blocks of a
bounded size, each block with each that may hold a link. Nothing is capped: a large group that is alike but
not near costs all its pairs, spread over tasks of two blocks.

The more sets, the more candidates are so by chance, and in a large table they chain groups to one. ``finer`` cuts a
group of many blocks before its pairs are compared. Similar sets share one of the rarest members of each, as many as
may be missing in the other and one more; so sets with enough members of their own have no partner, and of the others
only those go on together that are connected by such members. No similar pair is parted.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from retail_lake.llm import batches
from retail_lake.llm.components import components
from retail_lake.llm.scratch import drop, written, written_at
from retail_lake.llm.shingles import set_name, shingle_set
from retail_lake.operators.sizing import broadcast_if_small

# Bytes of shingle hashes, with ROW_BYTES more for each set, that a block of a group holds.
BLOCK_BYTES, ROW_BYTES = 4 << 20, 2048
# Edges of a hub that one task checks.
HUB_EDGES = 4096
# Edges are checked in rounds of about so many, but not in more rounds than this.
ROUND_EDGES, ROUNDS = 400_000, 8
# A group with more blocks than this outside of its largest part is cut finer; members are counted in so many slices,
# and those of so many slices tell that a set has no partner.
WIDE = 4
SLICES, TELLING = 8, 4
# The filter of documents whose sets are cut again has at most 2 ** FILTER_BITS bits (16 MB); when it is
# full, more documents are cut than are needed, and the join after it still keeps the right ones.
FILTER_BITS = 27

_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def similar(both, one, other, percent):
    """Whether sets of sizes ``one`` and ``other`` with ``both`` common members have that Jaccard similarity."""
    return (100 + percent) * both >= percent * (one + other)


def id_filter(ids):
    """The doc_ids of ``ids`` as a broadcast bit field, and the place of a doc_id in it."""
    def place(doc_id):
        return F.pmod(F.xxhash64(doc_id), F.lit(1 << FILTER_BITS))

    at = place(F.col("doc_id"))
    words = ids.select(F.shiftright(at, 6).alias("word"),
                       F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int")).alias("bit"))
    field = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most one row per word
    field[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return ids.sparkSession.sparkContext.broadcast(field), place


def passes(field, at):
    """Whether the bits at the places ``at`` of a field are set."""
    return (field[at >> 6] >> (at & 63)) & 1 != 0


def shingle_sets(docs, inside, shingle):
    """node and shingles of each node of ``inside`` (node, doc_id), cut anew from its document.

    Texts are not shuffled: a bit field of the wanted doc_ids goes to the scan instead.
    """
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    sent, place = id_filter(inside.where("doc_id IS NOT NULL").select("doc_id"))

    def run(parts):
        field = sent.value
        for part in parts:
            wanted = passes(field, part.column("place").to_numpy())
            wanted |= part.column("unnamed").to_numpy(zero_copy_only=False)
            for own in batches.chunks([part.filter(pa.array(wanted))], "text"):
                sets = [shingle_set(t or b"", shingle) for t in own.column("text").to_pylist()]
                yield batches.records([[set_name(s) for s in sets], [s.view(np.int64) for s in sets]], schema)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    texts = texts.select("text", place(F.col("doc_id")).alias("place"), F.col("doc_id").isNull().alias("unnamed"))
    sets = batches.map_arrow(texts, run, "node bigint, shingles array<bigint>")
    return inside.select("node").join(sets, "node").dropDuplicates(["node"])


def stars(parts):
    """Record batches of (key, node) in order -> batches of (list, hub, other).

    The two low bits of a key say what its node does: 0 searches and is found, 1 is found, 2 searches. All
    pairs of one that searches and one that is found are candidates. ``list`` is null for a list of two.
    """
    schema = pa.schema([("list", pa.int64()), ("hub", pa.int64()), ("other", pa.int64())])

    def found(keys, nodes):
        new = np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))
        keys, nodes = keys[new], nodes[new]
        lists, roles = keys >> 2, keys & 3
        begins = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
        ends = np.append(begins[1:], len(lists))
        several = ends - begins > 1
        begins, ends = begins[several], ends[several]
        begins, ends = begins[roles[begins] < 2], ends[roles[begins] < 2]
        if not len(begins):
            return
        # A hub that does both meets all; else the first found meets all that search, and the reverse.
        sizes = ends - begins
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        first, last = np.repeat(begins, sizes), np.repeat(ends - 1, sizes)
        both, mixed = roles[first] == 0, (roles[first] == 1) & (roles[last] == 2)
        hub = np.where(both | (roles[at] == 2), first, last)
        kept = (both | mixed) & (nodes[hub] != nodes[at])
        large = np.repeat(sizes > 2, sizes)[kept]
        if kept.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists[at[kept]], mask=~large), pa.array(nodes[hub[kept]]), pa.array(nodes[at[kept]])], schema=schema)

    keys, nodes, waiting = [], [], 0
    for part in parts:
        keys.append(part.column("key").to_numpy())
        nodes.append(part.column("node").to_numpy())
        waiting += part.num_rows
        if waiting >= 1 << 16:
            k, v = np.concatenate(keys), np.concatenate(nodes)
            cut = int(np.searchsorted(k >> 2, k[-1] >> 2, side="left"))
            if cut:
                yield from found(k[:cut], v[:cut])
            keys, nodes, waiting = [k[cut:]], [v[cut:]], 0
    if keys and sum(map(len, keys)):
        yield from found(np.concatenate(keys), np.concatenate(nodes))


def confirmed(edges, sets, percent):
    """(a, b): the pairs of ``edges`` (hub, other) whose sets are similar, written; a hub with many edges is salted."""
    hubs = edges.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_EDGES).alias("salts"))
    salted = edges.join(hubs, "hub").select("hub", F.expr("pmod(xxhash64(other), salts)").alias("salt"), "other")
    salted = written(salted, "salted-edges")
    rounds = min(ROUNDS, salted.count() // ROUND_EDGES + 1)

    def run(parts):
        hub, held = None, None
        for part in parts:
            a, b, shingles = [], [], part.column("shingles")
            for i, (kind, node) in enumerate(zip(part.column("kind").to_pylist(), part.column("node").to_pylist())):
                values = shingles[i].values.to_numpy()
                if not kind:
                    hub, held = node, values
                elif similar(min(len(held), len(values)), len(held), len(values), percent):
                    at = np.searchsorted(held.view(np.uint64), values.view(np.uint64))
                    at[at == len(held)] = 0
                    if similar(int((held[at] == values).sum()), len(held), len(values), percent):
                        a.append(hub)
                        b.append(node)
            yield batches.records([a, b], _LINKS)

    def checked(some):
        own = some.select("hub", "salt").distinct().select("hub", "salt", F.col("hub").alias("node"), F.lit(0).alias("kind"))
        asked = own.unionAll(some.select("hub", "salt", F.col("other").alias("node"), F.lit(1).alias("kind")))
        rows = broadcast_if_small(asked).join(sets, "node").select("hub", "salt", "node", "kind", "shingles")
        rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "kind")
        return written(batches.map_arrow(rows, run, "a bigint, b bigint"), "confirmed-links")

    at = F.pmod(F.xxhash64("hub", "salt"), F.lit(rounds))
    return reduce(lambda a, b: a.unionAll(b), [checked(salted.where(at == n)) for n in range(rounds)])


def _block_links(parts, percent):
    """Record batches of (key, node, part, shingles) in key order -> batches of (a, b).

    Rows of one key with different ``part`` are linked if their sets are similar; once linked their parts are
    one, so there are fewer links than rows.
    """
    def found(held):
        table = pa.Table.from_batches(held).combine_chunks()
        labels = np.unique(table.column("part").to_numpy(), return_inverse=True)[1]
        nodes, shingles = table.column("node").to_numpy(), table.column("shingles").combine_chunks()
        lengths = pc.list_value_length(shingles).to_numpy()
        codes = np.unique(shingles.flatten().to_numpy(), return_inverse=True)[1]
        begins = np.cumsum(lengths) - lengths
        own, a, b = np.zeros(len(codes) + 1, dtype=bool), [], []
        for i in range(len(labels) - 1):
            others = i + 1 + np.flatnonzero(labels[i + 1:] != labels[i])
            others = others[similar(np.minimum(lengths[others], lengths[i]), lengths[others], lengths[i], percent)]
            if not len(others):
                continue
            mine = codes[begins[i]:begins[i] + lengths[i]]
            own[mine] = True
            sizes = lengths[others]
            ends = np.cumsum(sizes)
            at = np.repeat(begins[others] - (ends - sizes), sizes) + np.arange(ends[-1])
            both = np.add.reduceat(own[codes[at]].astype(np.int64), ends - sizes)
            own[mine] = False
            for j in others[similar(both, sizes, lengths[i], percent)].tolist():
                if labels[j] != labels[i]:
                    labels[labels == labels[j]] = labels[i]
                    a.append(nodes[i])
                    b.append(nodes[j])
        if a:
            yield batches.records([a, b], _LINKS)

    key, held = None, []
    for part in parts:
        keys = part.column("key").to_numpy()
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
        for c, n in zip(cuts, np.diff(np.append(cuts, len(keys)))):
            if held and keys[c] != key:
                yield from found(held)
                held = []
            key = keys[c]
            held.append(part.slice(c, n))
    if held:
        yield from found(held)


def _alone(sets, percent):
    """node of the sets that have more members in no other set than a similar one may miss; a part of them."""
    def counted(n):
        rows = sets.select("node", F.explode("shingles").alias("token")).where(F.col("token").bitwiseAND(SLICES - 1) == n)
        rows = rows.groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
        return written(rows.groupBy("node").count(), "own-members")

    own = reduce(lambda a, b: a.unionAll(b), [counted(n) for n in range(TELLING)])
    own = own.groupBy("node").agg(F.sum("count").alias("own")).join(sets.select("node", F.size("shingles").alias("size")), "node")
    return own.where(100 * F.col("own") > (100 - percent) * F.col("size")).select("node")


def finer(sets, wide, percent):
    """(a, b): of groups ``wide`` (node, root, size) the nodes that may have a similar one, but the least of each finer group, and that least."""
    left = written(wide.join(_alone(sets, percent), "node", "left_anti"), "finer-nodes")
    own = written(broadcast_if_small(left.select("node", "root")).join(sets, "node"), "finer-sets")

    def common(n):
        rows = own.select("root", "node", F.explode("shingles").alias("token")).where(F.col("token").bitwiseAND(SLICES - 1) == n)
        rows = rows.select(F.xxhash64("root", "token").alias("key"), "node")
        return written(rows.join(rows.groupBy("key").count().where("count > 1"), "key"), "common-members")

    shared = reduce(lambda a, b: a.unionAll(b), [common(n) for n in range(SLICES)])
    shared = shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "key")))["key"].alias("keys"))
    # Members of one set alone are the rarest, and come first.
    rest = F.floor((100 - percent) * F.col("size") / 100) + 1 - (F.col("size") - F.size("keys"))
    rarest = shared.join(left.select("node", "size"), "node").withColumn("rest", rest.cast("int")).where("rest > 0")
    rarest = written(rarest.select("node", F.explode(F.slice("keys", F.lit(1), F.col("rest"))).alias("key")), "rarest-members")
    heads = rarest.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return components(rarest.join(heads, "key").select(F.col("node").alias("a"), F.col("head").alias("b")))


def _members(groups):
    """node and root of all nodes of ``groups`` (a, b: node and root)."""
    rows = groups.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rows.unionAll(rows.select(F.col("root").alias("node"), "root").distinct())


def _blocks(rows):
    """For each root with several parts among ``rows`` (node, root, part, size): its largest part, the blocks of the others, all blocks."""
    weight = F.sum(F.lit(ROW_BYTES) + 8 * F.col("size"))
    whole = rows.groupBy("root", "part").agg(weight.alias("bytes")).groupBy("root").agg(
        F.max_by("part", F.struct("bytes", "part")).alias("major"), F.max("bytes").alias("most"), F.sum("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("n")).where("n > 1")
    small = F.col("bytes") <= BLOCK_BYTES
    return whole.select(
        "root", "major", F.when(small, 0).otherwise(F.ceil((F.col("bytes") - F.col("most")) / BLOCK_BYTES)).alias("minors"),
        F.when(small, 1).otherwise(F.ceil(F.col("bytes") / BLOCK_BYTES) + 1).alias("blocks"))


def remaining(sets, groups, parts, percent):
    """(a, b): links between different ``parts`` (a, b: node and part) of one group of ``groups`` (a, b: node and root).

    The sets of a group are dealt into blocks; blocks of its largest part, which is linked already, do not
    meet each other, all others do. A group that would have many blocks is cut finer first.
    """
    rows = _members(groups).join(parts.select(F.col("a").alias("node"), F.col("b").alias("part")), "node", "left")
    rows = rows.withColumn("part", F.coalesce("part", "node")).join(sets.select("node", F.size("shingles").alias("size")), "node")
    rows = written(rows, "group-members")
    whole = _blocks(rows)
    wide = written(rows.join(whole.where(F.col("minors") > WIDE), "root", "left_semi"), "wide-groups")
    if wide.limit(1).count():
        again = _members(finer(sets, wide.select("node", "root", "size"), percent))
        again = again.join(wide.select("node", "part", "size"), "node").select(*rows.columns)
        rows = written(rows.join(wide.select("root").distinct(), "root", "left_anti").select(*rows.columns).unionAll(again), "finer-members")
        whole = _blocks(rows)
    # Blocks under ``minors`` hold the other parts, those from there on the largest one.
    rows = rows.join(whole, "root").withColumn("hash", F.xxhash64("node")).withColumn("own", F.when(
        (F.col("part") == F.col("major")) | (F.col("minors") == 0), F.col("minors") + F.expr("pmod(hash, blocks - minors)")
    ).otherwise(F.expr("pmod(hash, minors)")))
    reach = F.when(F.col("own") < F.col("minors"), F.col("blocks")).otherwise(F.greatest("minors", F.lit(1))) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), reach.cast("bigint"))))
    rows = rows.where("own != other OR blocks = 1")
    key = F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other"))
    rows = written(rows.select(key.alias("key"), "node", "part"), "group-blocks")
    rows = broadcast_if_small(rows).join(sets, "node").select("key", "node", "part", "shingles")
    rows = rows.repartition("key").sortWithinPartitions("key")
    return batches.map_arrow(rows, lambda parts: _block_links(parts, percent), "a bigint, b bigint")


def _confirmed_sets(docs, nodes, pairs, shingle, percent):
    """The sets of all nodes of ``pairs`` and the links among the pairs, both written, and the folder of the sets."""
    inside = pairs.select(F.explode(F.array("hub", "other")).alias("node")).distinct().join(nodes, "node")
    sets, path = written_at(shingle_sets(docs, written(inside, "candidate-nodes"), shingle), "candidate-sets")
    return sets, confirmed(pairs, sets, percent), path


def similar_groups(docs, nodes, pairs, shingle, percent):
    """(a, b): each node with a similar one but the least of its component, and that least.

    ``nodes`` (node, doc_id) are the sets of ``docs``. ``pairs`` (hub, other), written and distinct, connect
    groups of candidates, all of whose pairs count as candidates.
    """
    sets, links, path = _confirmed_sets(docs, nodes, pairs, shingle, percent)
    groups = components(pairs.select(F.col("hub").alias("a"), F.col("other").alias("b")))
    found = components(links.unionAll(remaining(sets, groups, components(links), percent)))
    drop(docs.sparkSession, [path])
    return found


def similar_components(docs, nodes, edges, shingle, percent):
    """As ``similar_groups`` for ``edges`` (list, hub, other): the stars of lists whose pairs are the candidates."""
    sets, links, path = _confirmed_sets(docs, nodes, edges.select("hub", "other").distinct(), shingle, percent)
    parts = components(links)
    part_of = parts.select(F.col("a").alias("node"), F.col("b").alias("part"))
    large = edges.where("list IS NOT NULL")
    for end in ("hub", "other"):
        own = part_of.select(F.col("node").alias(end), F.col("part").alias(f"{end}_part"))
        large = large.join(own, end, "left").withColumn(f"{end}_part", F.coalesce(f"{end}_part", end))
    lists = large.groupBy("list").agg(F.max(F.col("hub_part") != F.col("other_part")).alias("open")).where("open").select("list")
    groups = components(large.join(lists, "list", "left_semi").select(F.col("hub").alias("a"), F.col("other").alias("b")))
    found = components(links.unionAll(remaining(sets, groups, parts, percent)))
    drop(docs.sparkSession, [path])
    return found
