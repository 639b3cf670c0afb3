"""The queries of this subpackage: each applies one operator to its whole table."""

import public_tokenizers

import corpus_pipeline

from retail_lake.llm import (
    byte_bpe, conversations, hnsw, jaccard_join, lexical_search, mixing, quality_classifier, quality_rules, sharding, simhash, suffix_dedup, token_counts, token_files,
)

QUERIES = {}
CHECKS = {}


def query(name, check=None):
    def add(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op2_quality_rules", quality_rules.SQL)
def op2_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(spark, table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    return byte_bpe.digests(spark, table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query("op4_mixing", mixing.SQL)
def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_sharding", sharding.SQL)
def op9_sharding(spark, sf_dir):
    return sharding.shards(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_token_files")
def op10_token_files(spark, sf_dir):
    return token_files.token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.scores(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


@query("op8_hnsw")
def op8_hnsw(spark, sf_dir):
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair")
def op11_conversation_repair(spark, sf_dir):
    return conversations.repaired(table(spark, sf_dir, "conversations"))


@query("op12_lexical_search", lexical_search.SQL)
def op12_lexical_search(spark, sf_dir):
    return lexical_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_jaccard_join")
def op13_jaccard_join(spark, sf_dir):
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
