"""Conversation structure repair against a plain table of least edits."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from retail_lake.llm import conversations

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROLES = ["user", "assistant", "system", "tool", "", None]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 9])
def test_both_searches_meet_at_the_least_audit(n):
    rng = random.Random(n)
    for _ in range(300):
        rows = [(None, i, rng.choice(ROLES[:4]), rng.choice(["a.", "b", "", "c!", "d? "]) + str(i) * rng.randint(0, 1)) for i in range(n)]
        want, seen, flags = brute.repair(rows), set(), []
        for _, _, role, text in rows:
            blank, again = not text.strip(), (role, text) in seen
            flags.append((role[:1] or " ", blank or again, bool(text.strip()) and text.strip()[-1] not in ".!?"))
            seen.add((role, text))
        assert conversations.least_edits(flags, 0, (0, 3), True) == want[5:7]
        cut, chain = rng.randint(0, n), conversations.Chain()
        for piece in (flags[:cut], flags[cut:]):
            chain.add(conversations._piece(piece, False))
        assert chain.close() == want[5:7]


def rows_of(seed, conversation_ids=40):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(conversation_ids)]:
        said = [rng.choice(["Yes.", "No", "  ", "", "Why?\n", None, "é!", "long " * rng.randint(1, 40)]) for _ in range(6)]
        for turn in sorted({None if rng.random() < 0.1 else rng.randint(0, 12) for _ in range(rng.randint(1, 9))}, key=repr):
            rows.append((conv, turn, rng.choice(ROLES), rng.choice(said)))
    return rows + rows[5:9] * 3


@pytest.mark.parametrize("partitions, segment", [(1, 512), (7, 512), (5, 3)])
def test_any_cut_gives_the_same(spark, monkeypatch, partitions, segment):
    rows = rows_of(partitions)
    monkeypatch.setattr(conversations, "_pieces", cut_pieces(segment))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("part", "audit", "n", "first", "copy")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert got(conversations.repaired(df)) == brute.repair_rows(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def cut_pieces(segment):
    plain = conversations._pieces

    def run(parts, kind):
        conversations.SEGMENT = segment
        return plain(parts, kind)

    return run


def test_one_conversation_of_thousands_of_rows(spark):
    rng = random.Random(3)
    rows = [(7, i, rng.choice(ROLES[:3]), f"{i % 50} " + rng.choice([".", "", "!"])) for i in range(3000)]
    assert got(conversations.repaired(spark.createDataFrame(rows, SCHEMA))) == brute.repair_rows(rows)


def test_no_rows(spark):
    assert got(conversations.repaired(spark.createDataFrame([], SCHEMA))) == []


def test_op11_on_all_conversations(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(entry.queries()["op11_conversation_repair"](spark, sf_dir)) == brute.repair_rows(rows)
