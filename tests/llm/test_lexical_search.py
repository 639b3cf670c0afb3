"""Ranked lexical search against a plain ranking of all documents and against SQL."""

import math
import random
import re
from collections import Counter

import checks
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from retail_lake.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranking(docs, items, top=20):
    counts = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in counts:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, k in Counter(terms(text)).items() if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)] + ["Éa", "ñ1", "x-y", "_", "A\x7fB", " "]
    def text(k):
        return " ".join(rng.choice(words[:rng.choice([4, 20, 66])]) for _ in range(k))
    docs = [(i, text(rng.randint(0, 40))) for i in range(n)]
    docs += [(None, docs[3][1]), (n, None), (n + 1, ""), (n + 2, "... !"), (n + 3, text(20_000))] + docs[10:40] * 2
    return docs, [(i, text(rng.randint(1, 30))) for i in range(12)] + [(None, "W1 w2"), (90, None), (91, "!"), (92, "nowhere"), (3, "w5 w5 Éa")]


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = corpus(400, 1)
    clash = {c: F.lit("x") for c in ("n", "terms", "tfs", "item", "score", "rank")}
    return (docs, items, spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(clash).repartition(5),
            spark.createDataFrame(items, "item_id bigint, text string").withColumns(clash))


@pytest.mark.parametrize("block_docs, item_bytes", [(4096, 4 << 20), (16, 4 << 20), (7, 300)])
def test_against_all_documents(tables, monkeypatch, block_docs, item_bytes):
    docs, items, documents, benchmark = tables
    blocks = lexical_search.item_blocks
    monkeypatch.setattr(lexical_search, "item_blocks", lambda items: blocks(items, item_bytes))
    monkeypatch.setattr(lexical_search, "Trie", small_tries(block_docs))
    got = sorted((tuple(r) for r in lexical_search.ranked_documents(documents, benchmark).collect()), key=repr)
    assert got == ranking(docs, items)


def small_tries(block_docs):
    plain = lexical_search.Trie

    class Cut:
        def __init__(self, docs, rank):
            self.parts = [plain(docs[i:i + block_docs], rank) for i in range(0, len(docs), block_docs)]

        def search(self, items, best):
            return sum(part.search(items, best) for part in self.parts)

    return Cut


def test_subtrees_are_left_by_their_bounds():
    docs = [(i, f"common w{i % 7} " + ("rare words here" if i % 100 == 0 else f"other{i % 13}")) for i in range(4000)]
    block = [(1, Counter(lexical_search.terms(b"rare words here common")))]
    numbers = {w: i for i, w in enumerate(sorted(block[0][1]))}
    vectors = [[numbers[w] for w in t.encode().split() if w in numbers] for _, t in docs]
    dfs = Counter(t for v in vectors for t in v)
    items, best = lexical_search.Items(block, numbers, dfs, len(docs)), lexical_search.Best(1)
    trie = lexical_search.Trie([(d, 100, np.array(v), np.ones(len(v), dtype=int)) for (d, _), v in zip(docs, vectors)], items.rank)
    scored = trie.search(items, best)
    assert sorted(-e[1] for e in best.heaps[0]) == [100 * i for i in range(20)]
    assert scored < len(docs) / 2


def test_empty_tables(spark, tables):
    _, _, documents, benchmark = tables
    assert lexical_search.ranked_documents(documents.where("false"), benchmark).collect() == []
    assert lexical_search.ranked_documents(documents, benchmark.where("false")).collect() == []


def test_op12_against_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op12_lexical_search"
    problem, rows = checks.compare(spark, sf_dir, checks.connect(sf_dir), entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and rows > 0
