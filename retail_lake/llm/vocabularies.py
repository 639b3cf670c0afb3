"""Vocabulary files: read once on the driver, sent as bytes, and prepared once per Python worker.

A file is at most a few MB whatever the corpus, so sending it to all executors is bounded.
"""

import json
import re

from retail_lake.llm import bpe

MAX_BYTES = 64 << 20

_prepared = {}


def send(spark, path):
    """Broadcast the content of a vocabulary file of at most ``MAX_BYTES``."""
    with open(path, "rb") as file:
        content = file.read(MAX_BYTES + 1)
    if len(content) > MAX_BYTES:
        raise ValueError(f"{path} is over {MAX_BYTES} bytes")
    return spark.sparkContext.broadcast((content, path.endswith(".json")))


def prepared(name, content, make):
    """``make(content)``, kept by this worker for later tasks with the same vocabulary."""
    key = (name, len(content), hash(content))
    if key not in _prepared:
        _prepared[key] = make(content)
    return _prepared[key]


def merges(sent):
    content, described = sent.value
    return prepared("merges", content, bpe.from_json if described else bpe.from_ranks)


def pieces_cache(sent):
    return prepared("cache", sent.value[0], lambda _: bpe.PieceCache(merges(sent)))


def special_tokens(content):
    """(pattern or None, ids by string) of the special tokens of a tokenizer description."""
    added = {t["content"]: t["id"] for t in json.loads(content)["added_tokens"]}
    ordered = sorted(added, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None, added


def segments(texts, pattern):
    """Cut texts at special tokens: (segments, for each text the list of its parts).

    A part is the index of a segment, or the special token itself.
    """
    parts, flat = [], []
    for text in texts:
        own = []
        for i, part in enumerate(pattern.split(text) if pattern is not None else (text,)):
            if i % 2:
                own.append(part)
            elif part:
                own.append(len(flat))
                flat.append(part)
        parts.append(own)
    return flat, parts
