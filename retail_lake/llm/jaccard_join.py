"""N-gram Jaccard join by partitions of the universe and the pigeonhole principle.

1. Sets of one size band and their partners share a scheme: the universe of shingles is hashed into as many
   segments as the two sets can differ in, and one more. Two sets within the similarity then agree on a
   segment for certain.
2. A set is found in the scheme of its own band by the content of every segment, and in the segments that
   allow it by that content less one member (its one-deletion neighbourhood). The larger set of a pair
   searches, in its own scheme and in the one below: it gives each segment a threshold, -1 (left out), 0
   (equal) or 1 (one member more or less), which sum, with 1 added to each, to one more than the greatest
   difference. Then some segment differs by no more than its threshold.
3. The thresholds are allocated by cost: segments with few members, which many sets share, are left
   out as far as the sum allows, and segments with many members take the threshold 1 in their place.
4. Sets that meet at a key are candidates. They are linked only if their sets of shingles are checked to be
   similar (``verified_links``). Equal sets are one node, so a group of copies costs one row per task.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing, not
even with another; fewer words than a shingle are one shingle; repeated rows are copies; a null doc_id takes
part but names a component only if there is no other; an empty table gives no rows. Other columns are not
read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from retail_lake.llm import batches, verified_links
from retail_lake.llm.scratch import written
from retail_lake.llm.shingles import mix, set_name, shingle_set

SHINGLE, PERCENT = 4, 85
# The least size that has a partner of another content at this similarity.
LEAST = 6
# One segment in so many may have the threshold 1.
DELETABLE = 16
# Cost of searching a segment with so many members; from the last on, it is what a key costs.
COSTS = np.array([1e6, 1e3, 30.0, 1.0])
# Names of sets that a task remembers, so that copies in it are sent once.
REMEMBERED = 1 << 18
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Bands:
    """Greatest sizes of the bands; a partner of a set is in its band or in a neighbouring one."""

    def __init__(self, percent=PERCENT, least=LEAST):
        self.percent, self.most = percent, [least]

    def difference(self, sizes):
        """The greatest number of members in one of two sets but not in both, if their sizes sum to ``sizes``."""
        return (100 - self.percent) * sizes // (100 + self.percent)

    def of(self, size):
        while self.most[-1] < size:
            self.most.append(max(self.most[-1] + 1, 100 * self.most[-1] // self.percent))
        return int(np.searchsorted(self.most, size, side="left"))

    def segments(self, band):
        top = self.most[band]
        return self.difference(top + 100 * top // self.percent) + 1


def allocation(counts, need, deletable):
    """The threshold of each segment, least in cost, with the sum of thresholds plus one at least ``need``."""
    thresholds = np.zeros(len(counts), dtype=np.int8)
    costs = COSTS[np.minimum(counts, len(COSTS) - 1)]
    order, spare = np.argsort(-costs, kind="stable"), len(counts) - need
    thresholds[order[:spare]] = -1
    open_ = [int(i) for i in np.argsort(-np.minimum(counts[:deletable], len(COSTS) + 1), kind="stable") if thresholds[i] == 0]
    for i in order[spare:].tolist():
        if costs[i] <= COSTS[-1]:
            break
        if i in open_:
            open_.remove(i)
        best = next((j for j in open_ if counts[j] > len(COSTS) and counts[j] < costs[i]), None)
        if best is None:
            if i < deletable:
                open_.append(i)
            continue
        thresholds[best], thresholds[i] = 1, -1
        open_.remove(best)
    return thresholds


def scheme_keys(tokens, values, bands, band, need, own):
    """Keys of a set in the scheme of ``band``; ``own`` if it is found there, else it only searches."""
    m = bands.segments(band)
    salt = mix(np.uint64([band + 1]) * _SPREAD)
    at = (mix(tokens + salt) % np.uint64(m)).astype(np.int64)
    sums = np.zeros(m, dtype=np.uint64)
    np.add.at(sums, at, values)
    salts, deletable = mix(salt + np.arange(1, m + 1, dtype=np.uint64) * _SPREAD), max(1, m // DELETABLE)
    thresholds = allocation(np.bincount(at, minlength=m), need, deletable)
    whole = mix(sums + salts)
    inner = at < deletable
    less = mix(sums[at[inner]] - values[inner] + salts[at[inner]])
    searching, near = thresholds >= 0, thresholds[at[inner]] == 1
    if own:
        keys, roles = np.append(whole, less), np.append(~searching, ~near).astype(np.uint64)
    else:
        keys = np.append(whole[searching], less[near])
        roles = np.full(len(keys), 2, dtype=np.uint64)
    return (keys & ~np.uint64(3)) | roles


def signature(tokens, bands):
    """All keys of a set, with what it does there in the two low bits (see ``verified_links.stars``)."""
    n = len(tokens)
    if n < LEAST:
        return np.zeros(0, dtype=np.int64)
    values, band = mix(tokens * _SPREAD + np.uint64(1)), bands.of(n)
    keys = [scheme_keys(tokens, values, bands, band, bands.difference(2 * n) + 1, True)]
    if band and 100 * bands.most[band - 1] >= bands.percent * n:
        need = bands.difference(n + bands.most[band - 1]) + 1
        keys.append(scheme_keys(tokens, values, bands, band - 1, need, False))
    return np.concatenate(keys).view(np.int64)


def _texts(docs):
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def named_sets(docs, shingle=SHINGLE):
    """doc_id, n_shingles and node (null for an empty set) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64())])

    def run(parts):
        for part in batches.chunks(parts, "text"):
            sets = [shingle_set(t or b"", shingle) for t in part.column("text").to_pylist()]
            yield batches.records([part.column("doc_id"), list(map(len, sets)), list(map(set_name, sets))], schema)

    return batches.map_arrow(_texts(docs), run, "doc_id bigint, n_shingles bigint, node bigint")


def keyed_sets(docs, shingle=SHINGLE):
    """key and node of every set; copies within a task are sent once, as far as it remembers."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def run(parts):
        bands, seen = Bands(), set()
        for part in batches.chunks(parts, "text"):
            keys, nodes = [np.zeros(0, dtype=np.int64)], []
            for text in part.column("text").to_pylist():
                own = shingle_set(text or b"", shingle)
                name = set_name(own)
                if name in seen:
                    continue
                if len(seen) == REMEMBERED:
                    seen.clear()
                seen.add(name)
                keys.append(signature(own, bands))
                nodes += [name] * len(keys[-1])
            yield batches.records([np.concatenate(keys), nodes], schema)

    return batches.map_arrow(_texts(docs).select("text"), run, "key bigint, node bigint")


def similar_documents(docs, shingle=SHINGLE):
    """doc_id, n_shingles, component_id of every document, linked at a Jaccard similarity of 0.85."""
    prints = written(named_sets(docs, shingle), "jaccard-sets")
    nodes = prints.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    rows = keyed_sets(docs, shingle).repartition(F.shiftright("key", 2)).sortWithinPartitions("key", "node")
    edges = batches.map_arrow(rows, verified_links.stars, "list bigint, hub bigint, other bigint")
    edges = written(edges.distinct(), "jaccard-edges")
    named = verified_links.similar_components(docs, nodes, edges, shingle, PERCENT)
    named = nodes.join(named.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left")
    named = named.select("node", F.coalesce("root", "node").alias("root"), "doc_id")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    return prints.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
