"""Null, empty, long, tied and repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import math
import random

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retail_lake.llm import (
    bpe, byte_bpe, components, hnsw, mixing, near_dedup, pretokens, quality_classifier, quality_rules, sharding, simhash, suffix_dedup,
    token_counts, token_files, verified_links, vocabularies,
)

CLASHING = ["ord", "key", "size", "part", "fp", "bucket", "rank", "start", "kind", "shard", "finish", "copy", "row"]
random.seed(4)
WORDS = ["".join(random.choice("abcdefg") for _ in range(random.randint(1, 7))) for _ in range(300)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


LONG = prose(30_000, 1)
TEXTS = [None, "", "   \n\t ", "one", LONG, prose(60, 2), prose(60, 2), "A B c. 'S don't <|endoftext|> x", "é" * 300 + " ñ",
         prose(40, 3) + "\n" + prose(80, 5)[:250], prose(80, 5), "x" * 900, "\n".join([prose(6, 9)] * 9)]
ROWS = [(i, t, f"s{i % 3}" if i % 4 else None, "en") for i, t in enumerate(TEXTS)]
SCHEMA = "doc_id bigint, text string, source string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_quality_rules(docs, none):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, with_text=True).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.base_rules(t)
        assert not (r["base_failed"] and r["kept"])
    assert got[0]["clean_text"] == "" and got[4]["clean_text"] == LONG
    assert rows(quality_rules.quality_rules(none)) == []


def test_token_counts(spark, docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = sorted(((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(TEXTS)), key=repr)
    assert rows(token_counts.token_counts(spark, docs, path), "doc_id", "n_tokens") == want
    assert rows(token_counts.token_counts(spark, none, path)) == []


def test_token_counts_lower_letters_as_the_library():
    """Also letters that are newer than Python's Unicode, or older than its own."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, lower = Tokenizer.from_file(path), token_counts.lower_forms()
    odd = [c for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).lower() != lower.get(c, chr(c))]
    letters = [chr(c) for c in {*odd, 0xA7CB, 0xA7DC, 0x3A3, 0x130, *random.Random(6).sample(sorted(lower), 300)}]
    texts = [f"xx{c} {c}{c}y" for c in letters]
    with open(path, "rb") as file:
        content = file.read()
    counter = token_counts.Counter(bpe.from_json(content), token_counts.prove_whole_tokens(path))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(counter, vocabularies.special_tokens(content)[0], texts) == want


def test_byte_bpe_round_trip(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = byte_bpe.digests(spark, docs, path)
    want = sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in enumerate(TEXTS)), key=repr)
    assert rows(got, "doc_id", "decoded_sha256") == want
    full = byte_bpe.encode_documents(spark, docs, path)
    assert full.columns == [*docs.columns, "token_ids", "decoded_text"]
    assert all(r["decoded_text"] == (r["text"] or "") for r in full.collect())
    assert rows(byte_bpe.encode_documents(spark, none, path)) == []
    again = byte_bpe.encode_documents(spark, full.withColumnRenamed("decoded_text", "Decoded_Text"), path)
    assert again.columns == [*docs.columns, "token_ids", "Decoded_Text", "_token_ids", "_decoded_text"]
    assert all(r["token_ids"] == r["_token_ids"] and r["Decoded_Text"] == r["_decoded_text"] for r in again.collect())


@pytest.fixture(scope="module")
def merges():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return bpe.from_json(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 's'tremvld\n\t.,!é1２ñ日 ", max_size=80))
def test_matrices_and_heap_agree_with_the_library(merges, library, text):
    pieces, _ = pretokens.split([text])
    ids = np.frombuffer(b"".join(merges.encode(pieces)), dtype="<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    heap = [i for p in pieces for i in merges._heap(p)]
    assert heap == ids


def test_sources_in_the_mix(docs, none):
    got = mixing.mix(docs)
    sizes = {i: len(brute.WORD.findall(t or "")) for i, t in enumerate(TEXTS)}
    assert dict(rows(got, "doc_id", "size")) == sizes
    assert all(n <= 3 * s for s, n in rows(got, "size", "taken"))
    assert rows(got) == rows(mixing.mix(docs.repartition(5)))
    shares = {r["source"]: r["target"] for r in got.collect()}
    assert sum(shares.values()) == pytest.approx(sum(sizes.values()))
    assert rows(mixing.mix(none)) == [] and rows(mixing.mixed_documents(none)) == []
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(brute.WORD.findall(t)) for t, in mixed.select("text").collect()) == got.agg(F.sum("taken")).first()[0]


def test_mix_of_repeated_rows_comes_near_its_targets(spark):
    data = [(i % 40, prose(20, i % 7), ["a", "b", "c", None][i % 4], "en") for i in range(800)] + [(None, "x y", "a", "en")] * 3
    got = mixing.mix(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == 803
    by = {}
    for r in got:
        s = by.setdefault(r["source"], [0, r["target"]])
        s[0] += r["taken"]
    assert all(abs(n - t) <= 40 for n, t in by.values())


def test_shards_fit(docs, none):
    for limit in (1 << 20, 2000):
        got = sharding.shards(docs, limit).collect()
        assert sorted(r["doc_id"] for r in got) == list(range(len(TEXTS)))
        sums = {}
        for r in got:
            sums.setdefault(r["shard"], []).append(r)
        for shard, members in sums.items():
            total = sum(r["n_bytes"] for r in members)
            assert all(r["shard_bytes"] == total and r["shard_docs"] == len(members) for r in members)
            assert total <= limit or len(members) == 1 and members[0]["oversized"]
        names = sorted(sums)
        assert not any(b.startswith(a) and "-" not in b for a, b in zip(names, names[1:]))
    assert rows(sharding.shards(none)) == []


def test_one_hash_over_the_limit_is_cut(spark):
    df = spark.createDataFrame([(7, "y" * 100)] * 50 + [(None, "z")], "doc_id bigint, text string")
    got = sharding.shards(df, 1000).collect()
    assert len(got) == 51 and all(r["shard_bytes"] <= 1000 for r in got)


def test_simhash_cases(docs, none, monkeypatch):
    want = brute.simhash_rows(list(enumerate(TEXTS)))
    assert rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert rows(simhash.near_duplicates(none)) == [] and rows(near_dedup.near_unique(none)) == []
    kept = near_dedup.near_unique(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert 5 in ids and 6 not in ids and 4 in ids and sum(i in ids for i in (0, 1, 2)) == 1


def prints_near(center, n, seed, flips=4):
    rng = np.random.default_rng(seed)
    out = {center}
    while len(out) < n:
        x = center
        for b in rng.choice(64, size=rng.integers(1, flips + 1), replace=False).tolist():
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("hot", [4096, 20])
def test_dense_group_of_fingerprints_loses_no_link(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot)
    values = prints_near(0x0123456789ABCDEF, 150, 1) + prints_near(0xF0F0F0F00F0F0F0F, 100, 2, 6)
    data = [(i, bytearray(v.to_bytes(8, "big"))) for i, v in enumerate(values)]
    got = dict(rows(simhash.groups(spark.createDataFrame(data, "doc_id bigint, fp binary").repartition(2)), "fp", "component_id"))
    got = {bytes(k): v for k, v in got.items()}
    want = brute.components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert [got[bytes(d[1])] for d in data] == want


def wide_prints(n, seed, flips):
    """Fingerprints of 256 bits that differ from one another in about 2 * ``flips`` bits at most."""
    rng = np.random.default_rng(seed)
    center, out = rng.integers(0, 2, 256), []
    for _ in range(n):
        own = center.copy()
        own[rng.choice(256, size=flips, replace=False)] ^= 1
        out.append(np.packbits(own).tobytes())
    return out


def test_hot_buckets_of_a_wide_radius_lose_no_link(spark, monkeypatch):
    """One bucket for all rows: links of fingerprints must not depend on where a row stands in it."""
    values = wide_prints(90, 5, 21)
    numbers = [int.from_bytes(v, "big") for v in values]
    want = brute.components(numbers, lambda a, b: (a ^ b).bit_count() <= 30)
    assert 1 < len(set(want)) < len(want)
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "doc_id bigint, fp binary").repartition(3)
    for hot in (4096, 89, 20, 7):
        monkeypatch.setattr(simhash, "HOT_ROWS", hot)
        tables = np.zeros((1, 4), dtype=np.uint64)
        got = {bytes(k): v for k, v in rows(simhash.groups(df, 4, 30, tables), "fp", "component_id")}
        assert [got[v] for v in values] == want, hot


def test_a_bucket_over_the_limit_is_searched_whole(spark):
    values = wide_prints(simhash.HOT_ROWS + 200, 6, 21)
    prints = np.array([np.frombuffer(v, dtype=">u8") for v in values]).astype(np.uint64)
    forest = simhash.Forest(len(values))
    for i in range(len(values)):
        near = i + 1 + np.flatnonzero(simhash.hamming(prints[i + 1:], prints[i]) <= 26)
        forest.link(np.full(len(near), i), near)
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "doc_id bigint, fp binary").repartition(3)
    got = {bytes(k): v for k, v in rows(simhash.groups(df, 4, 26, np.zeros((1, 4), dtype=np.uint64)), "fp", "component_id")}
    assert [got[v] for v in values] == [forest.root(i) for i in range(len(values))]


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def similarity(a, b):
    return len(a & b) / len(a | b)


def edited(words, spans, rng):
    """``words`` with whole runs of words replaced: each run of n costs n + 4 shingles."""
    out = list(words)
    for begin, n in spans:
        out[begin:begin + n] = [f"w{rng.randrange(10**9)}" for _ in range(n)]
    return out


def families(seed):
    """Families that share some 0.5 to 0.75 with one another, with near copies of single members."""
    rng, texts = random.Random(seed), []
    for part in (0.15, 0.2, 0.25):
        body = [f"w{rng.randrange(10**9)}" for _ in range(300)]
        for k in range(25):
            own = edited(body, [(0, int(300 * part))], rng)
            texts.append(" ".join(own))
            if k % 8 == 0:
                texts.append(" ".join(edited(own, [(280, 15)], rng)))
    return texts


def test_distinct_documents_of_a_family_stay(spark, monkeypatch):
    """Links stand for a similarity of 0.8 and nothing less, also where candidates hang together."""
    texts = families(1)
    sets = [shingle_set(t) for t in texts]
    want = sorted(set(brute.components(sets, lambda a, b: similarity(a, b) >= 0.8)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert set(want) <= {d for (d,) in rows(near_dedup.near_unique(df), "doc_id")}
    masks = np.zeros((1, 2), dtype=np.uint64)  # all are candidates of one another
    for size, hot, block in ((verified_links.BLOCK_BYTES, 4096, 2048), (60_000, 40, 17)):
        monkeypatch.setattr(verified_links, "BLOCK_BYTES", size)
        small_buckets(monkeypatch, hot, block)
        got = [d for (d,) in rows(near_dedup.near_unique(df, radius=70, masks=masks), "doc_id")]
        assert sorted(got) == want, size


def small_buckets(monkeypatch, hot, block):
    """Let workers, too, take smaller buckets: they import the module anew."""
    plain = near_dedup.bucket_edges

    def run(parts, radius, pivots):
        near_dedup.HOT_ROWS = hot
        return plain(parts, radius, pivots)

    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_dedup, "bucket_edges", run)


@pytest.mark.parametrize("hot, block", [(4096, 2048), (50, 20), (20, 7)])
def test_hot_buckets_connect_all_candidates(spark, monkeypatch, hot, block):
    rng = np.random.default_rng(8)
    centers = rng.integers(0, 2, (3, 128))
    bits = np.concatenate([np.array([c ^ (rng.random(128) < p) for _ in range(60)]) for c, p in zip(centers, (0.05, 0.12, 0.2))])
    halves = np.packbits(bits, axis=1).view(">u8").astype(np.uint64)
    want = brute.components(list(halves), lambda a, b: simhash.hamming(a, b) <= 30)
    assert 1 < len(set(want)) < len(want)
    small_buckets(monkeypatch, hot, block)
    data = [(i, *map(int, row)) for i, row in enumerate(halves.view(np.int64))]
    nodes = spark.createDataFrame(data, "node bigint, hi bigint, lo bigint").repartition(3)
    edges = near_dedup.candidate_edges(nodes, radius=30, masks=np.zeros((1, 2), dtype=np.uint64))
    got = dict(rows(components.components(edges.selectExpr("hub as a", "other as b"))))
    assert [got.get(i, i) for i in range(len(halves))] == want
    assert edges.count() < 2 * len(halves)


def test_pivots_discard_pairs():
    """Pivots in the middle of a dense group tell its members from all others; random ones tell nothing."""
    rng = np.random.default_rng(9)
    center = rng.integers(0, 2, 128)
    bits = np.concatenate([[center ^ (rng.random(128) < 0.08) for _ in range(200)], rng.integers(0, 2, (400, 128))])
    prints = np.packbits(bits.astype(np.uint8), axis=1).view(">u8").astype(np.uint64)
    pivots = prints[::2][near_dedup.dense_pivots(prints[::2])]
    table = np.stack([simhash.hamming(prints, p) for p in pivots], axis=1)
    left, right = np.triu_indices(len(prints), 1)
    a, b, discarded = near_dedup.close(prints, table, left, right, near_dedup.RADIUS)
    assert discarded > 0.3 * len(left)
    assert len(a) == (simhash.hamming(prints[left], prints[right]) <= near_dedup.RADIUS).sum()


@pytest.mark.parametrize("n, least, wanted", [(29, 0.80, 0.97), (20, 0.85, 0.99)])
def test_near_copies_are_found(spark, n, least, wanted):
    rng, texts = random.Random(n), []
    for _ in range(200):
        body = [f"w{rng.randrange(10**9)}" for _ in range(304)]
        texts += [" ".join(body), " ".join(edited(body, [(120, n)], rng))]
    sets = [shingle_set(t) for t in texts]
    assert all(least <= similarity(a, b) < least + 0.01 for a, b in zip(sets[::2], sets[1::2]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    kept = {d for (d,) in rows(near_dedup.near_unique(df), "doc_id")}
    assert kept >= set(range(0, 400, 2))
    assert 400 - len(kept) >= wanted * 200


def test_repeated_ids_stay_apart(spark):
    data = [(1, prose(50, 1)), (1, prose(50, 2)), (1, prose(50, 2)), (None, prose(50, 3)), (2, prose(50, 3)), (None, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("size", F.lit(1))
    kept = rows(near_dedup.near_unique(df), "doc_id", "text")
    assert kept == sorted([(1, prose(50, 1)), (1, prose(50, 2)), (2, prose(50, 3)), (None, None)], key=repr)
    cut = suffix_dedup.deduplicated(df).collect()
    assert len(cut) == 6
    by_size = sorted((r["n_bytes"], r["n_removed"]) for r in cut)
    assert sum(n for _, n in by_size) == len(prose(50, 2)) + len(prose(50, 3))


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(200, 200), (201, 202)]
    got = dict(rows(components.components(spark.createDataFrame(chain, "a bigint, b bigint"))))
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 150)} | {202: 201}


def test_suffix_cases(docs, none):
    assert rows(suffix_dedup.deduplicated(docs)) == sorted(brute.suffix_rows(list(enumerate(TEXTS))), key=repr)
    assert rows(suffix_dedup.deduplicated(none)) == []
    left = suffix_dedup.deduplicated_documents(docs)
    assert left.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert got[0] is None and got[1] == "" and got[4] == LONG and 6 not in got and got[11] == "x"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=30), max_size=40), st.integers(1, 5))
def test_loser_tree_merges_as_a_sort(texts, n_runs):
    """Order, ties and shared prefixes of the merge are those of one sort."""
    keys = [t.encode() + b"\x00\xff" for t in texts]
    runs = []
    for r in range(n_runs):
        own = sorted(set(keys[r::n_runs]))
        if own:
            blob = suffix_dedup.front_coded(own, [r] * len(own), list(range(len(own))), [0] * len(own))
            runs.append(suffix_dedup.opened(blob))
    got = list(suffix_dedup.merge(runs)) if runs else []
    assert [k for k, *_ in got] == sorted(k for r in range(n_runs) for k in set(keys[r::n_runs]))
    for (a, *_), (b, shared, *_) in zip(got, got[1:]):
        common = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert shared == common


def test_suffix_rounds_with_many_ranges(spark):
    """Copies with edits, a passage shared by all, and splitters that cut through it."""
    rng = random.Random(8)
    base, passage = prose(120, 20), prose(40, 21)
    data = []
    for i in range(60):
        words = base.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        data.append((i * 3 % 101, " ".join(words[:60]) + " " + passage + " " + prose(30, i + 100) + " ".join(words[60:])))
    got = suffix_dedup.deduplicated(spark.createDataFrame(data, "doc_id bigint, text string").repartition(4))
    assert rows(got) == sorted(brute.suffix_rows(sorted(data)), key=repr)


def test_neighbours_cases(spark):
    rng = np.random.default_rng(6)
    data = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(i, [1.0] * 8) for i in range(400, 440)]
    data += [(500, None), (600, [0.0] * 8), (700, [float("nan")] + [1.0] * 7), (None, [1.0] * 8), (800, [1.0, None] * 4),
             (900, [1.0, 2.0]), (1000, [1.0, 2.5]), (901, [5.0, 5.0])]
    data += data[:5]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit(1))
    got = rows(hnsw.nearest(df))
    want = sorted(brute.nearest_rows(data), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert rows(hnsw.nearest(df.where("false"))) == []


def test_token_files(spark, docs, none, library, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = rows(token_files.token_files(spark, docs, path, str(tmp_path / "files")), "doc_id", "start", "n_tokens")
    want, at = [], 0
    for i, t in enumerate(TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids) + 1
        want.append((i, at, n))
        at += n
    assert got == sorted(want, key=repr)
    assert rows(token_files.token_files(spark, none, path)) == []


def test_sequences_are_mapped_without_copies(tmp_path):
    path = str(tmp_path / "a.arrow")
    writer = token_files.SequenceWriter(path, 4)
    ids = np.arange(5000, dtype="<u4")
    for a, b in ((0, 3), (3, 3), (3, 4500), (4500, 5000)):
        writer.append(ids[a:b].tobytes())
    writer.close()
    reader = token_files.SequenceReader(path, 4)
    assert all(np.array_equal(reader.ids(a, n), ids[a:a + n]) for a, n in ((0, 3), (1020, 10), (4990, 10), (7, 0)))
    assert not reader.ids(0, 3).flags.owndata
    with pytest.raises(ValueError):
        reader.ids(4998, 4)
    reader.close()


def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    model = quality_classifier.train(documents, labels.where(~held))
    assert (np.diff(model.thresholds) > 0).all()
    got = quality_classifier.scores(documents, model).join(labels.where(held), "doc_id").collect()
    low, clean = [r["kept"] for r in got if not r["quality"]], [r["kept"] for r in got if r["quality"] and not r["toxic"]]
    assert sum(low) <= 0.05 * len(low) and sum(clean) >= 0.97 * len(clean)
    toxic = [r["kept"] for r in got if r["quality"] and r["toxic"]]
    assert sum(toxic) <= 0.7 * len(toxic)


def test_classifier_cases(spark, docs, none):
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0), (4, None, 0), (99, 1, 1), (5, 1, 0), (5, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = quality_classifier.train(docs, labels)
    got = quality_classifier.scores(docs, model)
    assert got.count() == len(TEXTS)
    assert quality_classifier.good_documents(docs, model).columns == docs.columns
    assert quality_classifier.train(docs, labels.where("false")) is None
    assert quality_classifier.good_documents(docs, None).count() == len(TEXTS)
    assert rows(quality_classifier.scores(none, model)) == []


def _loss(model, rows, grades):
    """Mean negative log-likelihood of cumulative logits, by the definition: one probability for each grade."""
    total = 0.0
    for ids, g in zip(rows, grades):
        score = sum(float(model.weights[i]) for i in ids)
        above = [1.0, *[1 / (1 + math.exp(t - score)) for t in model.thresholds], 0.0]
        total -= math.log(max(1e-12, above[g] - above[g + 1]))
    return total / len(rows)


def _ordinal(n, seed):
    """Rows of features and grades drawn from a known model."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(1 << quality_classifier.BITS)
    weights[:40] = np.random.default_rng(1).normal(0, 1.5, 40)
    truth = quality_classifier.Model(weights, [-1.0, 1.5])
    drawn = [np.sort(rng.choice(40, 6, replace=False)).astype(np.int32) for _ in range(n)]
    tails = truth.tails([truth.score(ids) for ids in drawn])
    return truth, drawn, (rng.random(n)[:, None] < tails).sum(axis=1).tolist()


def test_classifier_reaches_the_likelihood_of_the_model_that_made_the_grades():
    truth, drawn, grades = _ordinal(4000, 2)
    model = quality_classifier.fit(drawn, grades)
    shares = np.bincount(grades, minlength=3) / len(grades)
    blind = -sum(p * math.log(p) for p in shares)
    best = _loss(truth, drawn, grades)
    assert np.all(np.diff(model.thresholds) > 0)
    assert _loss(model, drawn, grades) <= best + 0.05 * (blind - best)
    _, fresh, known = _ordinal(2000, 3)
    assert _loss(model, fresh, known) <= _loss(truth, fresh, known) + 0.1 * (blind - best)
    assert abs(np.corrcoef(model.weights[:40], truth.weights[:40])[0, 1]) > 0.95


def test_classifier_scores_equal_the_definition(spark, docs):
    weights = np.random.default_rng(4).normal(0, 1, 1 << quality_classifier.BITS)
    model = quality_classifier.Model(weights, [-0.5, 0.25])
    want = {}
    for r in docs.select("doc_id", "text").collect():
        score = sum(weights[i] for i in quality_classifier.features((r["text"] or "").encode()))
        tails = [1 / (1 + math.exp(-max(-40, min(40, score - t)))) for t in model.thresholds]
        want.setdefault(r["doc_id"], []).append((round(sum(tails), 9), round(tails[1], 9), tails[1] >= 0.5))
    got = {}
    for r in quality_classifier.scores(docs, model).collect():
        got.setdefault(r["doc_id"], []).append((round(r["expected_grade"], 9), round(r["p_top"], 9), r["kept"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_classifier_fits_a_repeated_document_once(spark):
    rows = [(i, f"word{i % 3} and text number {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 1)) for i in range(60)], "doc_id bigint, quality int, toxic int")
    whole = spark.createDataFrame(rows, "doc_id bigint, text string")
    again = spark.createDataFrame(rows + [(7, "zz later in bytes")] * 200, "doc_id bigint, text string").repartition(7)
    one, two = quality_classifier.train(whole, labels), quality_classifier.train(again, labels)
    assert np.array_equal(one.weights, two.weights) and np.array_equal(one.thresholds, two.thresholds)


def test_vocabulary_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(vocabularies, "MAX_BYTES", 10)
    with pytest.raises(ValueError):
        vocabularies.send(spark, public_tokenizers.path("byte_bpe_50k.json"))
