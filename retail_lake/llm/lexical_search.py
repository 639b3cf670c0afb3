"""Ranked lexical search over a trie of documents, by branch and bound.

1. The items are read in blocks of ``ITEM_BYTES``. The terms of a block are numbered and sent to all tasks:
   they are at most as large as the block. One pass over the whole texts gives each document its number of
   terms and its vector of frequencies, restricted to the terms of the block.
2. Document frequencies are counted with map-side combine; there is one row per term of the block.
3. Each task takes ``BLOCK_DOCS`` vectors at a time. With their terms in order of document frequency, most
   frequent first, sorted vectors are a trie: neighbours share the path of their common beginning (an
   FP-tree). A subtree is an interval of documents; its greatest frequency of each term and its least
   length factor m bound the score of every document in it, as scores grow with tf and fall with m.
4. The trie is searched depth first. An item leaves a subtree once its bound there is below its 20th best
   score so far; the subtree is left once all items have. Documents are leaves and are scored exactly.
   The best of every task meet in one window per item, which Spark limits before its shuffle.

Defined cases: a null or empty text, or one without terms, is no document and matches nothing; an item
without terms has no rows; repeated documents rank one by one; repeated items are ranked one by one, so
their rows repeat; a null doc_id comes after all others of its score; an empty table gives no rows. Other
columns are not read.
"""

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.llm import batches
from retail_lake.llm.scratch import written

TOP = 20
ITEM_BYTES = 4 << 20
BLOCK_DOCS = 4096

_SEPARATORS = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
# Bytes of a term stay, but A-Z is lowered; all other bytes become spaces.
_FOLD = bytes(0x20 if _SEPARATORS.match(bytes([b])) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms(text):
    """The terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


def item_blocks(items, limit=ITEM_BYTES):
    """Lists of (item_id, terms with their numbers) whose texts have about ``limit`` bytes at most."""
    block, size = [], 0
    rows = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("text"))
    for item, text in rows.toLocalIterator():
        text = bytes(text or b"")
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((item, Counter(terms(text))))
        size += len(text)
    if block:
        yield block


def vectors(docs, numbers):
    """doc_id, n and the numbers and frequencies of the terms of ``numbers`` of every document with terms."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(parts):
        known = sent.value
        for part in batches.chunks(parts, "text"):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                words = terms(text or b"")
                if words:
                    own = Counter([known[w] for w in words if w in known])
                    rows.append((doc, len(words), list(own), list(own.values())))
            yield batches.records(list(zip(*rows)) if rows else [[]] * 4, schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("text"))
    return batches.map_arrow(rows, run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def weight(n_docs, df):
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """For each term, in order of document frequency, the items that hold it with weight times repeats."""

    def __init__(self, block, numbers, dfs, n_docs):
        ranked = sorted(numbers.values(), key=lambda t: (-dfs.get(t, 0), t))
        self.rank = np.empty(len(numbers), dtype=np.int64)
        self.rank[ranked] = np.arange(len(ranked))
        held = sorted((int(self.rank[numbers[w]]), i, c * weight(n_docs, dfs.get(numbers[w], 0)))
                      for i, (_, counts) in enumerate(block) for w, c in counts.items())
        at, self.item, self.weight = (np.array(x, dtype=np.int64) for x in zip(*held))
        self.begin = np.searchsorted(at, np.arange(len(ranked) + 1))
        self.ids = [item for item, _ in block]

    def scores(self, ranks, tfs, m):
        """The score of every item for the frequencies ``tfs`` of the terms at ``ranks`` and the length factor m."""
        begins, sizes = self.begin[ranks], self.begin[ranks + 1] - self.begin[ranks]
        ends = np.cumsum(sizes)
        at = np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1])
        total = np.zeros(len(self.ids), dtype=np.int64)
        np.add.at(total, self.item[at], self.weight[at] * np.repeat(1_000_000_000 * tfs // (1000 * tfs + 12 * m), sizes))
        return total


class Best:
    """The TOP best documents of every item so far; equal scores prefer the smaller doc_id, null last."""

    def __init__(self, n):
        self.heaps, self.least = [[] for _ in range(n)], np.ones(n, dtype=np.int64)

    def offer(self, item, score, doc):
        heap, entry = self.heaps[item], (score, -math.inf if doc is None else -doc, doc)
        if len(heap) < TOP:
            heapq.heappush(heap, entry)
        elif entry[:2] > heap[0][:2]:
            heapq.heapreplace(heap, entry)
        if len(heap) == TOP:
            self.least[item] = heap[0][0]


class Trie:
    """Documents sorted by their vectors in frequency order; a subtree is an interval of them."""

    def __init__(self, docs, rank):
        """``docs`` are (doc_id, m, numbers of terms, frequencies)."""
        rows = []
        for doc, m, own, tfs in docs:
            ranks = rank[own]
            order = np.argsort(ranks)
            rows.append((ranks[order].tolist(), tfs[order], m, doc))
        rows.sort(key=lambda r: r[0])
        self.ids, self.m = [r[3] for r in rows], np.array([r[2] for r in rows], dtype=np.int64)
        self.begin = np.cumsum([0, *(len(r[0]) for r in rows)])
        self.ranks = np.fromiter((x for r in rows for x in r[0]), dtype=np.int64, count=int(self.begin[-1]))
        self.tfs = np.concatenate([r[1] for r in rows]).astype(np.int64)
        # Length of the path that each document shares with the one before.
        self.shared = np.array([0, *(self._common(a[0], b[0]) for a, b in zip(rows, rows[1:]))], dtype=np.int64)
        self.most = np.zeros(len(rank), dtype=np.int64)

    @staticmethod
    def _common(a, b):
        n = min(len(a), len(b))
        return next((i for i in range(n) if a[i] != b[i]), n)

    def maxima(self, lo, hi):
        """(ranks, greatest frequencies, least m) of the subtree of documents lo to hi."""
        inside = slice(self.begin[lo], self.begin[hi])
        ranks, tfs = self.ranks[inside], self.tfs[inside]
        if hi - lo > 1:
            np.maximum.at(self.most, ranks, tfs)
            ranks = np.unique(ranks)
            tfs = self.most[ranks]
            self.most[ranks] = 0
        return ranks, tfs, int(self.m[lo:hi].min())

    def children(self, lo, hi):
        inner = self.shared[lo + 1:hi]
        cuts = [lo, *(lo + 1 + np.flatnonzero(inner == inner.min())).tolist(), hi]
        return list(zip(cuts, cuts[1:]))

    def search(self, items, best):
        """Offer every document that can still be among the best of an item; returns the number of scored leaves."""
        open_, scored = [(0, len(self.ids), np.ones(len(items.ids), dtype=bool))], 0
        while open_:
            lo, hi, active = open_.pop()
            bound = items.scores(*self.maxima(lo, hi))  # of one document: its score
            active = active & (best.least <= bound)
            if not active.any():
                continue
            if hi - lo > 1:
                open_ += [(a, b, active) for a, b in reversed(self.children(lo, hi))]
                continue
            scored += 1
            for i in np.flatnonzero(active).tolist():
                best.offer(i, int(bound[i]), self.ids[lo])
        return scored


def block_results(docs, block):
    """item_id, doc_id, score: the best documents of each item of a block, of every task."""
    numbers = {w: i for i, w in enumerate(sorted({w for _, counts in block for w in counts}))}
    held = written(vectors(docs, numbers), "lexical-vectors")
    sums = held.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    counted = held.select(F.explode("terms").alias("term")).groupBy("term").count()
    dfs = dict(counted.toLocalIterator()) if numbers and sums["n"] else {}
    n_docs, n_terms = sums["n"], sums["l"]
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    sent = docs.sparkSession.sparkContext.broadcast(Items(block, numbers, dfs, n_docs) if numbers else None)

    def run(parts):
        items = sent.value
        if items is None:
            return
        best, waiting = Best(len(items.ids)), []
        for part in parts:
            columns = [part.column(c) for c in ("terms", "tfs")]
            factors = 75 + 25 * part.column("n").to_numpy() * n_docs // n_terms
            for i, doc in enumerate(part.column("doc_id").to_pylist()):
                own, tfs = (c[i].values.to_numpy() for c in columns)
                if len(own):
                    waiting.append((doc, factors[i], own, tfs))
                if len(waiting) == BLOCK_DOCS:
                    Trie(waiting, items.rank).search(items, best)
                    waiting = []
        if waiting:
            Trie(waiting, items.rank).search(items, best)
        rows = [(i, items.ids[i], doc, score) for i, heap in enumerate(best.heaps) for score, _, doc in heap]
        if rows:
            yield batches.records(list(zip(*rows)), schema)

    found = batches.map_arrow(held, run, "item int, item_id bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_documents(docs, items):
    """item_id, rank, doc_id, score of the 20 best documents of every item."""
    found = None
    for block in item_blocks(items):
        own = block_results(docs, block)
        found = own if found is None else found.unionAll(own)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return found


_TERM_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERM_SQL} AS terms FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
f AS (SELECT k, doc_id, n, term, count(*) AS tf
      FROM (SELECT k, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
i AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERM_SQL}) AS term FROM benchmark) GROUP BY ALL),
r AS (SELECT item_id, k, doc_id,
             CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN f USING (term), s GROUP BY item_id, k, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
WHERE rank <= {TOP}
"""
