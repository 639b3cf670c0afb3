"""The registered queries on whole tables, against SQL, the libraries or a plain version."""

import base64
import hashlib
import zlib

import brute
import checks
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from retail_lake.llm import quality_classifier, quality_rules, shingles
from retail_lake.llm.scratch import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


def result(spark, name, columns):
    return sorted(tuple(r) for r in entry.queries()[name](spark, SF).select(*columns).collect())


def test_all_are_registered():
    names = set(entry.queries())
    assert {"pipeline"} <= names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_mixing", "op9_sharding"])
def test_against_sql(spark, name):
    problem, rows = checks.compare(spark, SF, checks.connect(SF), entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and rows > 0


def test_op1_scores_every_document(spark, docs):
    rows = entry.queries()["op1_quality_classifier"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == [d for d, _ in docs]
    assert all(0 <= r["p_top"] <= 1 and 0 <= r["expected_grade"] <= 2 and r["kept"] == (r["p_top"] >= 0.5) for r in rows)


def test_op2_base_rules(spark, docs):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert result(spark, "op2_quality_rules", columns) == sorted((d, *brute.base_rules(t)) for d, t in docs)


def test_op3_counts_as_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in docs:
        n = len(library.encode(t, add_special_tokens=False).ids)
        want.append((d, len(t.encode()), n, n > 2048))
    assert result(spark, "op3_token_counts", ["doc_id", "n_bytes", "n_tokens", "over_limit"]) == want


def test_op5_against_all_pairs(spark, docs):
    assert result(spark, "op5_simhash", ["doc_id", "fingerprint", "component_id"]) == brute.simhash_rows(docs)


def tiktoken_encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op6_encodes_as_the_library(spark, docs):
    encoding, want = tiktoken_encoding(), []
    for d, t in docs:
        ids = np.array(encoding.encode_ordinary(t), dtype="<u4").tobytes()
        want.append((d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert result(spark, "op6_byte_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == want


def test_op7_against_all_strings(spark, docs):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert result(spark, "op7_suffix_dedup", columns) == brute.suffix_rows(docs)


def test_op8_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute.nearest_rows(rows)
    got = result(spark, "op8_hnsw", ["query_id", "rank", "vec_id", "score"])
    assert len(got) == len(want)
    exact = {(q, v): s for q, _, v, s in want}
    found = [(q, v, s) for q, _, v, s in got if (q, v) in exact]
    assert len(found) >= 0.95 * len(want)
    assert all(s == pytest.approx(exact[q, v], rel=1e-12) for q, v, s in found)


def test_op10_files_hold_the_ids_of_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, at = [], 0
    for d, t in docs:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((d, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert result(spark, "op10_token_files", ["doc_id", "start", "n_tokens", "ids_crc32"]) == want


def test_pipeline_stage_by_stage(spark):
    """Each stage on what the one before kept, against a plain version of it."""
    before = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, before, SF), f"test-{name}")
        if name != "byte_bpe":
            assert after.columns == before.columns and after.dtypes == before.dtypes
        old = {r["doc_id"]: r for r in before.collect()}
        new = after.collect()
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            scores = quality_classifier.scores(before, quality_classifier.train(before, labels))
            assert sorted(r["doc_id"] for r in new) == sorted(r["doc_id"] for r in scores.where("kept").collect())
        elif name == "simhash_near_dedup":
            ids = sorted(old)
            sets = [shingles.shingle_set(old[i]["text"].encode(), 5) for i in ids]
            near = brute.components(sets, lambda a, b: 9 * len(np.intersect1d(a, b, True)) >= 4 * (len(a) + len(b)))
            first, kept = {ids[r] for r in near}, {r["doc_id"] for r in new}
            assert first <= kept  # no document goes that is not a near copy
            # Candidates are found with high probability, not for certain.
            assert len(ids) - len(kept) >= 0.95 * (len(ids) - len(first))
        elif name == "suffix_dedup":
            cut = {r[0]: r for r in brute.suffix_rows([(i, old[i]["text"]) for i in sorted(old)])}
            assert {r["doc_id"] for r in new} == {i for i, r in cut.items() if r[2] < r[1] or r[1] == 0}
            whole = [r for r in new if cut[r["doc_id"]][2] == 0]
            assert whole and all(r == old[r["doc_id"]] for r in whole)
            assert all(len(r["text"].encode()) <= cut[r["doc_id"]][1] - cut[r["doc_id"]][2] for r in new)
        elif name == "mixing":
            con = checks.connect(SF)
            con.register("kept", before.toPandas())
            sql = entry.oracle_sql()["op4_mixing"].replace("FROM documents)", "FROM kept)")
            taken = {i: n // s for i, s, _, _, n in con.sql(sql).fetchall() if n}
            got = {}
            for r in new:
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
                assert r == old[r["doc_id"]]
            assert got == taken
        else:
            encoding = tiktoken_encoding()
            assert all(r["token_ids"] == encoding.encode_ordinary(r["text"]) and r["decoded_text"] == r["text"] for r in new)
            assert len(new) == before.count()
        before = after


def test_rules_keep_clean_lines():
    assert quality_rules.line_fails(b"Home | News | Sport | Contact")
    assert quality_rules.line_fails(b"All rights reserved by the owner")
    assert quality_rules.line_fails(b"of%%% the*** and&&&")
    assert not quality_rules.line_fails("Das Haus, in dem sie wohnt, ist schön (und alt).".encode())
