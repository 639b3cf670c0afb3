"""The Jaccard join against all pairs."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from retail_lake.llm import jaccard_join, verified_links


def grams(text, k=4):
    words = brute.WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def linked(a, b, percent=85):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def join_rows(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = {}
    for d, t in rows:
        sets.setdefault(grams(t), []).append(d)
    values = sorted(sets, key=sorted)
    roots, least = brute.components(values, linked), {}
    for root, value in zip(roots, values):
        least[root] = min([d for d in [*sets[value], least.get(root)] if d is not None], default=None)
    own = dict(zip(values, roots))
    return sorted(((d, len(s), least[own[s]] if s else d) for d, t in rows for s in [grams(t)]), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_partners_share_a_key():
    """Every pair of sets at the threshold meets at a key, one searching and the other found."""
    rng, bands = np.random.default_rng(5), jaccard_join.Bands()
    for _ in range(3000):
        small = int(rng.integers(6, rng.choice([10, 20, 60, 300, 2000])))
        large = int(rng.integers(small, 100 * small // 85 + 1))
        common = -(-85 * (small + large) // 185)
        if common > small:
            continue
        tokens = rng.integers(0, 2**63, small + large - common).astype(np.uint64)
        sides = [jaccard_join.signature(np.sort(s), bands) for s in (tokens[:small], tokens[small - common:])]
        found = [{k >> 2 for k in side.tolist() if k & 3 < 2} for side in sides]
        searching = [{k >> 2 for k in side.tolist() if k & 3 != 1} for side in sides]
        assert found[0] & searching[1] or found[1] & searching[0]


def test_allocation_covers_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(2000):
        m = int(rng.integers(1, 80))
        counts, need, deletable = rng.poisson(rng.choice([1, 3, 6]), m), int(rng.integers(1, m + 1)), max(1, m // 16)
        t = jaccard_join.allocation(counts, need, deletable)
        assert (t + 1).sum() >= need and (t[deletable:] < 1).all()


def family(rng, words, size, edits):
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for _ in range(edits):
        base = list(base)
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = rng.choice(words)
        out.append(" ".join(base))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "ONE", "a b c", "A b  c", "a b c d", "é" * 20, "x " * 3000]
    for size in (7, 9, 12, 30, 100, 300, 1500):
        texts += family(rng, words, size, 12)
    shared = " ".join(rng.choice(words) for _ in range(60))
    texts += [shared + " " + " ".join(rng.choice(words) for _ in range(rng.randint(3, 40))) for _ in range(60)]
    texts += [texts[20]] * 30 + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, "alone here")] + [(3, texts[3])] * 3


@pytest.mark.parametrize("seed, block, hub", [(1, 4 << 20, 4096), (2, 30_000, 2)])
def test_against_all_pairs(spark, monkeypatch, seed, block, hub):
    rows = corpus(seed)
    monkeypatch.setattr(verified_links, "BLOCK_BYTES", block)
    monkeypatch.setattr(verified_links, "HUB_EDGES", hub)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit("x") for c in ("key", "node", "part", "root", "list", "hub", "place")}).repartition(4)
    assert got(jaccard_join.similar_documents(df)) == join_rows(rows)


def test_no_rows(spark):
    assert got(jaccard_join.similar_documents(spark.createDataFrame([], "doc_id bigint, text string"))) == []


def test_op13_against_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(entry.queries()["op13_jaccard_join"](spark, sf_dir)) == join_rows(rows)
