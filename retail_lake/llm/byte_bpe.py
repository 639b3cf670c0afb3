"""Byte-level BPE encoding and decoding of documents.

Texts are cut into pre-tokens (``pretokens``), each distinct pre-token is merged in length-bucketed
padded matrices (``bpe``), and the ids are decoded again from the vocabulary. One pass over the rows,
no shuffle; a worker holds one chunk of texts and a bounded cache.

Defined cases: a null text is empty and has no ids; an empty text decodes to nothing; repeated rows
give repeated results; a null doc_id passes through; other columns are kept or not by the function's
contract and never clash, as only the named columns are read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_lake.llm import batches, pretokens, vocabularies
from retail_lake.llm.scratch import all_columns


def encode_texts(cache, texts):
    """Ids of each text as little-endian 32-bit integers."""
    pieces, bounds = pretokens.split(texts)
    ids = cache.ids(pieces)
    return [b"".join(ids[a:b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def decode_ids(tokens, ids):
    """Bytes of the tokens with these little-endian 32-bit ids."""
    return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def digests(spark, docs, path):
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, by the rank file at ``path``."""
    sent = vocabularies.send(spark, path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(parts):
        cache = vocabularies.pieces_cache(sent)
        tokens = cache.merges.tokens
        for part in batches.chunks(parts, "text"):
            ids = encode_texts(cache, [t or "" for t in part.column("text").to_pylist()])
            yield batches.records([
                part.column("doc_id"), [len(x) // 4 for x in ids],
                [hashlib.sha256(x).hexdigest() for x in ids],
                [hashlib.sha256(decode_ids(tokens, x)).hexdigest() for x in ids]], schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return batches.map_arrow(rows, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def free_name(name, taken):
    """``name`` with as many underscores in front as make it none of ``taken``."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def encode_documents(spark, docs, path, ids="token_ids", decoded="decoded_text"):
    """All columns of ``docs`` and two more: the ids of ``text``, and the text those ids decode to.

    Where ``docs`` has a column of one of these names, whatever its case, the new column gets underscores in
    front until its name is free; the column of ``docs`` stays as it is.
    """
    ids = free_name(ids, docs.columns)
    decoded = free_name(decoded, [*docs.columns, ids])
    both = free_name("coded", docs.columns)
    batches.importable(spark)
    sent = vocabularies.send(spark, path)
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
                         T.StructField("text", T.StringType(), False)])

    @F.arrow_udf(kind)
    def coded(texts: pa.Array) -> pa.Array:
        cache = vocabularies.pieces_cache(sent)
        tokens, encoded, words = cache.merges.tokens, [], []
        whole = pa.RecordBatch.from_arrays([texts], names=["text"])
        for part in batches.chunks([whole], "text"):
            for x in encode_texts(cache, [t or "" for t in part.column("text").to_pylist()]):
                encoded.append(np.frombuffer(x, dtype="<i4"))
                words.append(decode_ids(tokens, x).decode("utf-8"))
        return pa.StructArray.from_arrays(
            [pa.array(encoded, type=pa.list_(pa.int32())), pa.array(words, type=pa.string())],
            names=["ids", "text"])

    return docs.withColumn(both, coded(F.col("text").cast("string"))).select(
        *all_columns(docs), F.col(both)["ids"].alias(ids), F.col(both)["text"].alias(decoded))
