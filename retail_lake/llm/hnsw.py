"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

Equal vectors are one node with their smallest ids (as many as one result can hold), found with a
per-task limit before any shuffle; the others can be in no result, since ties go to smaller ids. Nodes
are dealt to shards of about ``SHARD_ROWS`` by a hash, each shard builds its graph, and the graph is kept
as flat arrays in one row: vectors, ids, and per layer the members and a padded neighbour array. Queries
go in blocks to every shard; what the shards find is merged by distance.

Graph steps run for a block of vectors at once: layers are built from the top, a block finds its
candidates by a beam search over what is linked already and within itself, keeps the diverse ones
(a candidate nearer to a kept neighbour than to the vector is left out), and links back.

Defined cases: vectors that are null or zero, or hold a null or a component that is not finite, take no
part, nor does a null vec_id; vectors are compared with those of their own length only; ties go to the
smaller id; with fewer than k candidates all are returned; rows with one vec_id exclude each other.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.llm import batches
from retail_lake.llm.scratch import written

K = 10
SHARD_ROWS = 8192
QUERY_ROWS = 1024
QUERY_EVERY = 100
LINKS = 16
EF_BUILD = 64
EF_SEARCH = 160
BLOCK = 512
_BEAM = 4


def _gaps(vectors, ids, queries):
    """Squared distances (rows, columns) of ``vectors[ids]`` to each row's query."""
    diff = vectors[ids] - queries[:, None, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def beam_search(vectors, neighbours, entries, queries, ef):
    """(ids, squared distances), sorted, of up to ``ef`` near members for each query; -1 where none."""
    n_queries = len(queries)
    seen = np.zeros((n_queries, len(vectors)), dtype=bool)
    line = np.arange(n_queries)[:, None]
    gaps = _gaps(vectors, entries, queries)
    seen[line, entries] = True
    ids, done = np.full((n_queries, ef), -1, dtype=np.int64), np.ones((n_queries, ef), dtype=bool)
    best = np.full((n_queries, ef), np.inf, dtype=np.float32)
    order = np.argsort(gaps, axis=1)[:, :ef]
    width = order.shape[1]
    ids[:, :width], best[:, :width] = np.take_along_axis(entries, order, 1), np.take_along_axis(gaps, order, 1)
    done[:, :width] = False
    rows = np.arange(n_queries)
    while len(rows):
        open_ = ~done[rows]
        rows = rows[open_.any(axis=1)]
        if not len(rows):
            break
        rank = np.cumsum(~done[rows], axis=1)
        take = ~done[rows] & (rank <= _BEAM)
        chosen = np.full((len(rows), _BEAM), -1, dtype=np.int64)
        r, c = np.nonzero(take)
        chosen[r, rank[r, c] - 1] = ids[rows[r], c]
        done[rows[r], c] = True
        near = np.where(chosen[:, :, None] >= 0, neighbours[chosen], -1).reshape(len(rows), -1)
        at = np.maximum(near, 0)
        fresh = (near >= 0) & ~seen[rows[:, None], at]
        near = np.sort(np.where(fresh, near, -1), axis=1)  # one of several mentions stays
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        width = int((near >= 0).sum(axis=1).max(initial=0))
        if not width:
            continue
        near = -np.sort(-near, axis=1)[:, :width]
        at = np.maximum(near, 0)
        r, c = np.nonzero(near >= 0)
        seen[rows[r], near[r, c]] = True
        gaps = np.where(near >= 0, _gaps(vectors, at, queries[rows]), np.inf)
        all_gaps = np.concatenate([best[rows], gaps], axis=1)
        order = np.argsort(all_gaps, axis=1, kind="stable")[:, :ef]
        best[rows] = np.take_along_axis(all_gaps, order, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], axis=1), order, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], near < 0], axis=1), order, 1)
    return ids, best


def diverse(vectors, ids, gaps, keep):
    """Choose up to ``keep`` of the sorted candidates of each row (-1: none), near and apart from each other."""
    rows, width = ids.shape
    if width < keep:
        ids = np.pad(ids, ((0, 0), (0, keep - width)), constant_values=-1)
        gaps = np.pad(gaps, ((0, 0), (0, keep - width)), constant_values=np.inf)
        width = keep
    own = vectors[np.maximum(ids, 0)]
    norms = np.einsum("ijk,ijk->ij", own, own)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    kept, count = np.zeros((rows, width), dtype=bool), np.zeros(rows, dtype=np.int64)
    for c in range(width):
        close = ((between[:, c, :] < gaps[:, c, None]) & kept).any(axis=1)
        take = (ids[:, c] >= 0) & ~close & (count < keep)
        kept[:, c] = take
        count += take
    # Places that are left go to the nearest of the others.
    rest = (ids >= 0) & ~kept
    kept |= rest & (np.cumsum(rest, axis=1) <= (keep - count)[:, None])
    order = np.argsort(~kept, axis=1, kind="stable")[:, :keep]
    return np.where(np.take_along_axis(kept, order, 1), np.take_along_axis(ids, order, 1), -1)


def _link_back(vectors, neighbours, sources):
    """Add ``source`` to the neighbours of all it points at, and thin out lists that are too long."""
    keep = neighbours.shape[1]
    targets = neighbours[sources]
    r, c = np.nonzero(targets >= 0)
    to, of = targets[r, c], sources[r]
    order = np.argsort(to, kind="stable")
    to, of = to[order], of[order]
    nodes, begins, counts = np.unique(to, return_index=True, return_counts=True)
    for at in range(0, len(nodes), BLOCK):
        some = slice(at, at + BLOCK)
        own, begin, count = nodes[some], begins[some], counts[some]
        width = int(count.max())
        more = np.full((len(own), width), -1, dtype=np.int64)
        spread = np.arange(width) < count[:, None]
        more[spread] = of[np.concatenate([np.arange(b, b + n) for b, n in zip(begin.tolist(), count.tolist())])]
        whole = np.sort(np.concatenate([neighbours[own], more], axis=1), axis=1)
        whole[:, 1:][whole[:, 1:] == whole[:, :-1]] = -1
        gaps = np.where(whole >= 0, _gaps(vectors, np.maximum(whole, 0), vectors[own]), np.inf)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :3 * keep]
        neighbours[own] = diverse(vectors, np.take_along_axis(whole, order, 1), np.take_along_axis(gaps, order, 1), keep)


def build_layer(vectors, entries, keep):
    """Neighbour array (n, keep) over all ``vectors``; ``entries`` (n, e) are starting members, -1 for none."""
    n = len(vectors)
    neighbours = np.full((n, keep), -1, dtype=np.int64)
    begin = 0
    while begin < n:
        end = min(n, begin + BLOCK)
        block = np.arange(begin, end)
        own = vectors[block]
        diff = (own * own).sum(1)[:, None] + (own * own).sum(1)[None, :] - 2 * own @ own.T
        np.fill_diagonal(diff, np.inf)
        inside = np.argsort(diff, axis=1)[:, :min(EF_BUILD, len(block) - 1)]
        ids, gaps = block[inside], np.take_along_axis(diff, inside, 1)
        if begin:
            first = np.where((entries[block] >= 0) & (entries[block] < begin), entries[block], 0)
            found, far = beam_search(vectors[:begin], neighbours[:begin], first, own, EF_BUILD)
            ids, gaps = np.concatenate([found, ids], axis=1), np.concatenate([far, gaps], axis=1)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :EF_BUILD]
        if order.shape[1]:
            neighbours[block] = diverse(vectors, np.take_along_axis(ids, order, 1),
                                        np.take_along_axis(gaps, order, 1), keep)
            _link_back(vectors, neighbours, block)
        begin = end
    return neighbours


class Graph:
    """Layers from the top: members (positions among the vectors) and neighbours (positions among members)."""

    def __init__(self, vectors, layers):
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors, seed=3):
        n = len(vectors)
        heights = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
        graph = cls(np.ascontiguousarray(vectors, dtype=np.float32), [])
        for layer in range(int(heights.max(initial=0)), -1, -1):
            members = np.flatnonzero(heights >= layer)
            own = graph.vectors[members]
            entries = np.full((len(members), 1), -1, dtype=np.int64)
            if graph.layers:
                found = graph._descend(own, 4)
                entries = np.searchsorted(members, found)
            graph.layers.append((members, build_layer(own, entries, LINKS * (1 if layer else 2))))
        return graph

    def _descend(self, queries, ef):
        """Members of the lowest layer so far near to each query: (queries, e) positions among all vectors."""
        found = None
        for members, neighbours in self.layers:
            entries = np.zeros((len(queries), 1), dtype=np.int64)
            if found is not None:
                entries = np.searchsorted(members, found)
            ids = np.concatenate([beam_search(self.vectors[members], neighbours, entries[a:a + BLOCK], queries[a:a + BLOCK], ef)[0]
                                  for a in range(0, len(queries), BLOCK)])
            ids = np.where(ids >= 0, ids, ids[:, :1])
            found = members[ids]
        return found

    def search(self, queries, ef=EF_SEARCH):
        """(queries, ef) positions of near vectors; one position may stand more than once."""
        upper = Graph(self.vectors, self.layers[:-1])
        members, neighbours = self.layers[-1]
        entries = upper._descend(queries, 4) if upper.layers else np.zeros((len(queries), 1), dtype=np.int64)
        out = [beam_search(self.vectors, neighbours, entries[a:a + BLOCK], queries[a:a + BLOCK], ef)[0]
               for a in range(0, len(queries), BLOCK)]
        ids = np.concatenate(out)
        return np.where(ids >= 0, ids, ids[:, :1])

    def flat(self):
        """Layer sizes, members and neighbours in one run of 32-bit integers."""
        parts = [np.array([len(self.layers)] + [x for m, g in self.layers for x in g.shape], dtype="<i4")]
        for members, neighbours in self.layers:
            parts += [members.astype("<i4"), neighbours.astype("<i4").ravel()]
        return np.concatenate(parts).tobytes()

    @classmethod
    def from_flat(cls, vectors, data):
        values = np.frombuffer(data, dtype="<i4")
        shapes, at, layers = values[1:1 + 2 * values[0]].reshape(-1, 2), 1 + 2 * values[0], []
        for n, width in shapes.tolist():
            members = values[at:at + n].astype(np.int64)
            neighbours = values[at + n:at + n + n * width].reshape(n, width).astype(np.int64)
            layers.append((members, neighbours))
            at += n + n * width
        return cls(vectors, layers)


def usable(vectors):
    """vec_id, vec and dim of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vec, lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(vec, lambda x: x + 0.0).alias("vec"), F.size(vec).alias("dim"))


def build_index(rows, k=K, shard_rows=SHARD_ROWS):
    """One row per shard: dim, shard, ids (up to k + 1 per vector), vectors and graph, as flat arrays."""
    rank = F.row_number().over(Window.partitionBy("dim", "vec").orderBy("vec_id"))
    least = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1)
    nodes = written(least.groupBy("dim", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "hnsw-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int"))
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary()),
                        ("vectors", pa.binary()), ("graph", pa.binary())])

    def build(key, rows):
        dim, shard = (x.as_py() for x in key)
        lists = rows.column("ids").to_pylist()
        values = rows.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        order = np.lexsort(values.T[::-1])  # alike in every run, whatever order the rows came in
        values, lists = np.ascontiguousarray(values[order]), [lists[i] for i in order.tolist()]
        graph = Graph.build(values)
        return pa.Table.from_batches([batches.records([
            [dim], [shard], [np.array([len(x) for x in lists], dtype="<i4").tobytes()],
            [np.array([i for x in lists for i in x], dtype="<i8").tobytes()],
            [values.astype("<f8").tobytes()], [graph.flat()]], schema)])

    batches.importable(rows.sparkSession)
    made = nodes.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, counts binary, ids binary, vectors binary, graph binary")
    return written(made, "hnsw-index")


def search_index(index, queries, k=K, ef=EF_SEARCH, block_rows=QUERY_ROWS):
    """query_id, rank, vec_id and score of the k nearest found; ``queries`` has vec_id, vec and dim."""
    blocks = max(1, -(-queries.count() // block_rows))
    pairs = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    pack_schema = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("query_ids", pa.binary()), ("queries", pa.binary())])

    def pack(key, rows):
        ids = rows.column("vec_id").to_numpy()
        values = rows.column("vec").combine_chunks().flatten().to_numpy()
        return pa.Table.from_batches([batches.records([
            [key[0].as_py()], [key[1].as_py()], [ids.astype("<i8").tobytes()], [values.astype("<f8").tobytes()]], pack_schema)])

    batches.importable(index.sparkSession)
    packed = pairs.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, query_ids binary, queries binary")
    places = index.select("dim", "shard")
    work = packed.join(places, "dim").repartition("dim", "shard", "block").join(index, ["dim", "shard"])
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(parts):
        for part in parts:
            for row in part.to_pylist():
                vectors = np.frombuffer(row["vectors"], dtype="<f8").reshape(-1, row["dim"])
                graph = Graph.from_flat(vectors.astype(np.float32), row["graph"])
                counts = np.frombuffer(row["counts"], dtype="<i4").astype(np.int64)
                begins = np.concatenate([[0], np.cumsum(counts)])
                own_ids = np.frombuffer(row["ids"], dtype="<i8")
                query_ids = np.frombuffer(row["query_ids"], dtype="<i8").tolist()
                queries = np.frombuffer(row["queries"], dtype="<f8").reshape(-1, row["dim"])
                found = graph.search(queries.astype(np.float32), max(ef, 2 * k))
                out = []
                for q, own, near in zip(query_ids, queries, found):
                    near = np.unique(near)
                    exact = np.sqrt(((vectors[near] - own) ** 2).sum(axis=1))
                    best = np.argsort(exact, kind="stable")[:k + 1]
                    hits = [(float(exact[i]), v) for i in best.tolist()
                            for v in own_ids[begins[near[i]]:begins[near[i] + 1]].tolist() if v != q]
                    out += [(q, v, s) for s, v in sorted(hits)[:k]]
                if out:
                    yield batches.records([list(x) for x in zip(*out)], schema)

    found = batches.map_arrow(work, search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors, every=QUERY_EVERY, k=K):
    """The k nearest found for every vector whose id is divisible by ``every``."""
    rows = written(usable(vectors), "hnsw-rows")
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    return search_index(build_index(rows, k), queries, k)
