"""SimHash near-duplicates with pivot distance tables.

1. One fingerprint per text: a bit is set if over half of the hashed shingles have it. Documents with
   equal fingerprints are one node from here on (pre-aggregated, so a group of copies costs one row).
2. Each distinct fingerprint goes to a few buckets by part of its bits. For a small radius the parts
   are chosen so that any two linked fingerprints share a bucket for certain (``sure_tables``).
3. Inside a bucket the Hamming distances to the reference fingerprints (pivots) are tabled once. Two
   fingerprints within the radius differ by at most the radius in every coordinate, so pairs with a
   larger difference in any are discarded, and only survivors are compared bit by bit. Of the links
   of a bucket a spanning forest goes on: no pair list grows with the square of a group.
4. A bucket with more than ``HOT_ROWS`` fingerprints is not searched in one task. With radius 2 its
   rows take the exact way of ``_hot_links``: each goes to the 65 strings within one bit of it, and
   two fingerprints within two bits share one; all that meet at a string are within two bits. With any
   other radius it is dealt into blocks, and every block meets every other in a task of its own.
5. Links are joined to components, and each component is named after its smallest doc_id.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is linked
like any other; a text with fewer words than a shingle is one shingle; repeated rows are copies; a null
doc_id takes part but names a component only if there is no other; an empty table gives no rows. Other
columns are not read.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from retail_lake.llm import batches
from retail_lake.llm.components import components
from retail_lake.llm.scratch import written
from retail_lake.llm.shingles import mix, shingle_hashes

SHINGLE = 3
RADIUS = 2
PIVOTS = 16
HOT_ROWS = 4096
# Buckets up to this size are searched together, larger ones one by one.
SMALL = 32
_SLICE = 1 << 15


def fingerprints(texts, shingle=SHINGLE, words=1):
    """(n, words) array of 64-bit words: the fingerprint of each text (bytes)."""
    return from_hashes((np.array(shingle_hashes(text, shingle), dtype=np.uint64) for text in texts), len(texts), words)


def from_hashes(shingles, n, words):
    """The same of ``n`` arrays of shingle hashes."""
    out = np.zeros((n, words), dtype=np.uint64)
    for row, hashes in enumerate(shingles):
        if not len(hashes):
            continue
        for w in range(words):
            counts = np.zeros(64, dtype=np.int64)
            for at in range(0, len(hashes), _SLICE):
                bits = np.unpackbits(hashes[at:at + _SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            out[row, w] = np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0]
            if w + 1 < words:
                hashes = mix(hashes + np.uint64(0x9E3779B97F4A7C15))
    return out


def to_bytes(prints):
    """Rows of 64-bit words as byte strings, most significant byte first."""
    data, width = prints.astype(">u8").tobytes(), 8 * prints.shape[1]
    return [data[i:i + width] for i in range(0, len(data), width)]


def _from_column(column, words):
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, words)


def sure_tables(radius=RADIUS, spare=2):
    """Masks of 64 bits such that fingerprints within ``radius`` agree on one of them for certain.

    The bits are cut into radius + ``spare`` blocks; at least ``spare`` of them have no differing bit.
    """
    blocks = np.array_split(np.arange(64), radius + spare)
    masks = []
    for chosen in itertools.combinations(blocks, spare):
        masks.append([sum(1 << int(b) for block in chosen for b in block)])
    return np.array(masks, dtype=np.uint64)


def likely_tables(words, bits, tables, seed=7):
    """Masks of ``bits`` pseudo-random bits each, for a radius that no sure set of masks can cover."""
    rng = np.random.default_rng(seed)
    masks = np.zeros((tables, words), dtype=np.uint64)
    for t in range(tables):
        for b in rng.choice(64 * words, size=bits, replace=False).tolist():
            masks[t, b // 64] |= np.uint64(1 << (b % 64))
    return masks


def pivot_prints(words, pivots=PIVOTS, seed=11):
    return np.random.default_rng(seed).integers(0, 2**64, size=(pivots, words), dtype=np.uint64)


def hamming(a, b):
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


class Forest:
    """Union-find over row numbers; ``edges`` has the links that joined two trees."""

    def __init__(self, n):
        self.up, self.edges = list(range(n)), []

    def root(self, i):
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def link(self, a, b):
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = self.root(i), self.root(j)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                self.edges.append((i, j))


def _close(prints, table, left, right, radius):
    """Which of the pairs (left, right) are within the radius: pivots first, then all bits."""
    for p in range(table.shape[1]):
        if not len(left):
            break
        kept = np.abs(table[left, p] - table[right, p]) <= radius
        if kept.all():
            break  # what one pivot keeps whole, the next hardly cuts: the bits decide
        left, right = left[kept], right[kept]
    kept = hamming(prints[left], prints[right]) <= radius
    return left[kept], right[kept]


def _link_small(prints, table, sizes, begins, radius, forest):
    """All buckets of up to SMALL rows at once: every row against the s-th one behind it."""
    rows = np.concatenate([np.arange(b, b + n) for b, n in zip(begins.tolist(), sizes.tolist())])
    ends = np.repeat(begins + sizes, sizes)
    for shift in range(1, SMALL):
        going = rows + shift < ends
        rows, ends = rows[going], ends[going]
        if not len(rows):
            break
        forest.link(*_close(prints, table, rows, rows + shift, radius))


def _link_large(prints, table, begin, end, radius, forest):
    """One larger bucket: ordered by the first coordinate, each row meets only those within the radius."""
    order = begin + np.argsort(table[begin:end, 0], kind="stable")
    first = table[order, 0]
    stops = np.searchsorted(first, first + radius, side="right")
    for i in range(len(order)):
        others = order[i + 1:stops[i]]
        if len(others):
            forest.link(*_close(prints, table, np.full(len(others), order[i]), others, radius))


def bucket_links(parts, words, radius, pivots, limit):
    """Record batches of (key, fp) in key order -> batches of (a, b, hot, at).

    ``a`` and ``b`` are linked; where ``hot`` is not null, ``a`` is row ``at`` of the bucket ``hot``,
    which has more than ``limit`` rows.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("hot", pa.int64()), ("at", pa.int64())])
    keys, prints = np.zeros(0, dtype=np.int64), np.zeros((0, words), dtype=np.uint64)
    hot_key, hot_rows = None, 0

    def found(keys, prints):
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(cuts, len(keys)))
        some = sizes > 1
        cuts, sizes = cuts[some], sizes[some]
        if not len(cuts):
            return
        table = np.stack([hamming(prints, p) for p in pivots], axis=1)
        forest = Forest(len(keys))
        small = sizes <= SMALL
        if small.any():
            _link_small(prints, table, sizes[small], cuts[small], radius, forest)
        for b, n in zip(cuts[~small].tolist(), sizes[~small].tolist()):
            _link_large(prints, table, b, b + n, radius, forest)
        if forest.edges:
            a, b = np.array(forest.edges).T
            none = [None] * len(a)
            yield batches.records([to_bytes(prints[a]), to_bytes(prints[b]), none, none], schema)

    def hot(key, prints, at):
        n = len(prints)
        yield batches.records([to_bytes(prints), [None] * n, np.full(n, key), np.arange(at, at + n)], schema)

    for part in parts:
        if not part.num_rows:
            continue
        keys = np.concatenate([keys, part.column("key").to_numpy()])
        prints = np.concatenate([prints, _from_column(part.column("fp"), words)])
        if hot_key is not None:  # the bucket that was given up goes on
            n = int(np.searchsorted(keys, hot_key, side="right"))
            if n:
                yield from hot(hot_key, prints[:n], hot_rows)
                keys, prints, hot_rows = keys[n:], prints[n:], hot_rows + n
            if not len(keys):
                continue
            hot_key = None
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        over = [(c, n) for c, n in zip(cuts.tolist(), np.diff(np.append(cuts, len(keys))).tolist()) if n > limit]
        begin = 0
        for c, n in over:
            if c > begin:
                yield from found(keys[begin:c], prints[begin:c])
            yield from hot(keys[c], prints[c:c + n], 0)
            begin = c + n
            if begin == len(keys):
                hot_key, hot_rows = int(keys[-1]), n
        if hot_key is not None:
            keys, prints = keys[:0], prints[:0]
            continue
        if last > begin:
            yield from found(keys[begin:last], prints[begin:last])
        keys, prints = keys[max(begin, last):], prints[max(begin, last):]
    if len(keys) and hot_key is None:
        yield from found(keys, prints)


def _hot_links(rows):
    """Links within 2 bits among fingerprints of oversized buckets: by the strings one bit away."""
    words = rows.select(F.col("a").alias("fp"), F.conv(F.hex("a"), 16, -10).cast("bigint").alias("bits"))
    near = words.select("fp", F.explode(F.transform(
        F.sequence(F.lit(-1), F.lit(63)),
        lambda i: F.when(i < 0, F.col("bits")).otherwise(
            F.col("bits").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    )).alias("at"))
    least = near.groupBy("at").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return near.join(least, "at").where(F.col("fp") != F.col("least")).select(
        F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def links(prints, words=1, radius=RADIUS, tables=None, pivots=PIVOTS):
    """(a, b) of fingerprints in ``prints`` (fp, distinct) within ``radius`` bits: enough of them to
    connect all that are connected, where the tables are sure; see ``likely_tables`` otherwise."""
    masks = sure_tables(radius) if tables is None else tables
    salts = mix(np.arange(1, len(masks) + 1, dtype=np.uint64))
    references = pivot_prints(words, pivots)
    keyed_schema = pa.schema([("key", pa.int64()), ("fp", pa.binary())])

    def keyed(parts):
        for part in parts:
            for at in range(0, part.num_rows, 2048):
                column = part.column("fp").slice(at, 2048)
                own = _from_column(column, words)
                for mask, salt in zip(masks, salts):
                    key = np.full(len(own), salt, dtype=np.uint64)
                    for w in range(words):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + (own[:, w] & mask[w]))
                    yield batches.records([key.view(np.int64), column], keyed_schema)

    limit = HOT_ROWS

    def search(rows, limit):
        rows = rows.repartition("key").sortWithinPartitions("key")
        return batches.map_arrow(rows, lambda parts: bucket_links(parts, words, radius, references, limit),
                                 "a binary, b binary, hot bigint, at bigint")

    rows = batches.map_arrow(prints.select("fp"), keyed, "key bigint, fp binary")
    found = written(search(rows, limit), "simhash-links")
    edges, hot = found.where(F.col("hot").isNull()).select("a", "b"), found.where(F.col("hot").isNotNull())
    if words == 1 and radius == 2:
        return edges.unionAll(_hot_links(hot.select("a").distinct()))
    # No group of two blocks is over the limit, so none is given up again.
    return edges.unionAll(search(_block_pairs(hot, max(1, limit // 2)), float("inf")).select("a", "b"))


def _block_pairs(rows, size):
    """(key, fp): the rows of each oversized bucket in blocks of ``size``, once for every other block."""
    blocks = rows.select("hot", F.col("a").alias("fp"), F.floor(F.col("at") / size).alias("own"))
    last = blocks.groupBy("hot").agg(F.max("own").alias("last"))
    pairs = blocks.join(last, "hot").select("hot", "fp", "own", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    return pairs.where("own != other").select(
        F.xxhash64("hot", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")


def document_prints(docs, shingle=SHINGLE, words=1):
    """doc_id and fp (bytes) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.binary())])

    def run(parts):
        for part in batches.chunks(parts, "text"):
            texts = [t or b"" for t in part.column("text").to_pylist()]
            yield batches.records([part.column("doc_id"), to_bytes(fingerprints(texts, shingle, words))], schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("text"))
    return batches.map_arrow(rows, run, "doc_id bigint, fp binary")


def groups(prints, words=1, radius=RADIUS, tables=None):
    """(fp, root, component_id) of every distinct fingerprint of ``prints`` (doc_id, fp).

    ``root`` names the component among fingerprints, ``component_id`` is its smallest doc_id.
    """
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    stars = components(links(nodes, words, radius, tables))
    named = nodes.join(stars.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    named = named.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs, shingle=SHINGLE, words=1, radius=RADIUS, tables=None):
    """doc_id, fingerprint (hex) and component_id of every document."""
    prints = written(document_prints(docs, shingle, words), "simhash-prints")
    named = groups(prints, words, radius, tables).select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
