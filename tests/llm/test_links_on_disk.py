"""What the steps of near-dedup and of the Jaccard join leave and move on disk."""

import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from retail_lake import session
from retail_lake.llm import components, jaccard_join, near_dedup, scratch, verified_links
from retail_lake.llm.shingles import set_name, shingle_set


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def texts(seed, families=8, members=4):
    """Families of near copies, and a passage that all texts have; the texts of two families are alike but not near."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for f in range(families):
        own = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        for m in range(members):
            some = list(own)
            for i in rng.sample(range(150), m):
                some[i] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(some + passage))
    return rows


@pytest.mark.parametrize("wide", [0, 1 << 30])
def test_a_chained_group_is_cut_before_its_pairs_are_compared(spark, monkeypatch, wide):
    docs = list(enumerate(texts(3)))
    sets = {set_name(s): (d, frozenset(s.tolist())) for d, t in docs for s in [shingle_set(t.encode(), 5)]}
    nodes = spark.createDataFrame([(n, d) for n, (d, _) in sets.items()], "node bigint, doc_id bigint")
    names = list(sets)
    random.Random(4).shuffle(names)
    chain = spark.createDataFrame(list(zip(names, names[1:])), "hub bigint, other bigint")
    moved, written = [], verified_links.written

    def noted(df, name):
        out = written(df, name)
        moved.append((name, out.count()))
        return out

    monkeypatch.setattr(verified_links, "written", noted)
    monkeypatch.setattr(verified_links, "BLOCK_BYTES", 1 << 12)
    monkeypatch.setattr(verified_links, "WIDE", wide)
    monkeypatch.setattr(verified_links, "ROUND_EDGES", 10)
    found = {r.a: r.b for r in verified_links.similar_groups(
        spark.createDataFrame(docs, "doc_id bigint, text string"), nodes, chain, 5, 80).collect()}
    roots = brute.components(names, lambda a, b: 100 * len(sets[a][1] & sets[b][1]) >= 80 * len(sets[a][1] | sets[b][1]))
    least = {}
    for n, root in zip(names, roots):
        least[root] = min(n, least.get(root, n))
    assert len(least) == 8
    assert {n: found.get(n, n) for n in names} == {n: least[root] for n, root in zip(names, roots)}
    blocks = dict(moved)["group-blocks"]
    assert blocks <= 4 * len(names) if not wide else blocks > 8 * len(names)


def test_shuffle_files_and_sets_go_with_their_step(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts(5))), "doc_id bigint, text string").repartition(4)
    written, peaks = scratch.written_at, {}

    def noted(df, name):
        out = written(df, name)
        time.sleep(0.3)
        peaks[seconds] = max(peaks.get(seconds, 0), shuffle_files(spark) - before)
        return out

    for module in (scratch, verified_links, components):
        monkeypatch.setattr(module, "written_at", noted)
    for seconds in (1e9, 0):
        monkeypatch.setattr(session, "SWEEP_SECONDS", seconds)
        spark._jvm.System.gc()
        time.sleep(2)
        before, held = shuffle_files(spark), set(scratch.held())
        jaccard_join.similar_documents(docs)
        assert not [p for p in set(scratch.held()) - held if "candidate-sets" in p]
    assert peaks[0] < peaks[1e9]


def test_documents_that_stay_are_not_moved(spark):
    docs = spark.createDataFrame([(d, t, d % 3) for d, t in enumerate(texts(6))], "doc_id bigint, text string, n int")
    kept = near_dedup.near_unique(docs)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 32, 4))
    assert kept.columns == docs.columns
    odd = docs.unionAll(docs.where("doc_id < 6")).unionAll(docs.where("doc_id = 9").select(F.lit(None).cast("bigint"), "text", "n"))
    got = near_dedup.near_unique(odd).collect()
    assert sorted(r.doc_id for r in got) == list(range(0, 32, 4))
