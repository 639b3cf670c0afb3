"""Token counts by a vocabulary with word ends: whole-token shortcut.

Before any text is read, the library encodes every vocabulary string that could be a word by itself;
those that come back as that one token are proven, and a pre-token equal to one counts 1 by one
dictionary look-up. Only other pre-tokens are merged, in the matrices of ``bpe``, once per worker and
cache filling. One pass over the rows, no shuffle.

Defined cases: a null text is empty and has 0 tokens; special strings in a text count 1 each, as the
library takes them out before it normalizes; repeated rows give repeated results.
"""

import functools
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from retail_lake.llm import batches, bpe, pretokens, vocabularies

CONTEXT = 2048
_CACHED = 300_000


def prove_whole_tokens(path):
    """Words (as bytes) that the library encodes as exactly one token when they stand alone.

    Candidates are the vocabulary's strings with the word end; the list is bounded by the vocabulary.
    """
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        end = json.load(file)["model"]["end_of_word_suffix"]
    back = {c: b for b, c in bpe.byte_letters().items()}
    words, ids = [], []
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        if token.endswith(end) and all(c in back for c in token.removesuffix(end)):
            try:
                words.append(bytes(back[c] for c in token.removesuffix(end)).decode("utf-8"))
                ids.append(i)
            except UnicodeDecodeError:
                continue
    coded = tokenizer.encode_batch(words, add_special_tokens=False)
    pieces, bounds = pretokens.split([normalized(w) for w in words], word_form=True)
    bounds = bounds.tolist()
    return {w.encode("utf-8") for w, i, e, a, b in zip(words, ids, coded, bounds, bounds[1:])
            if e.ids == [i] and pieces[a:b] == [w.encode("utf-8")]}


@functools.cache
def lower_forms():
    """The lower-case forms that the library gives letters, by its own version of Unicode; asked in one call."""
    from tokenizers import normalizers

    letters = [chr(c) for c in range(0x110000) if c != 10 and not 0xD800 <= c < 0xE000]
    lower = normalizers.Lowercase().normalize_str("\n".join(letters)).split("\n")
    return {ord(a): b for a, b in zip(letters, lower) if a != b}


def normalized(text):
    """Composed form, lower case letter by letter. White space is dropped later in any case."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).translate(lower_forms())


class Counter:
    """Tokens of pre-tokens: 1 for the proven, else by merging; keeps a bounded number of the rest."""

    def __init__(self, merges, proven):
        self.merges, self.proven, self.known = merges, proven, dict.fromkeys(proven, 1)

    def counts(self, pieces):
        known = self.known
        if len(known) > len(self.proven) + _CACHED:
            known = self.known = dict.fromkeys(self.proven, 1)
        found = list(map(known.get, pieces))
        if None in found:
            gaps = [i for i, x in enumerate(found) if x is None]
            fresh = list({pieces[i] for i in gaps})
            known.update((p, len(x) // 4) for p, x in zip(fresh, self.merges.encode(fresh)))
            for i in gaps:
                found[i] = known[pieces[i]]
        return found


def count_texts(counter, pattern, texts):
    """Number of tokens of each text."""
    flat, parts = vocabularies.segments(texts, pattern)
    pieces, bounds = pretokens.split([normalized(s) for s in flat], word_form=True)
    upto = np.concatenate([[0], np.cumsum(np.array(counter.counts(pieces), dtype=np.int64))])[bounds].tolist()
    return [sum(1 if isinstance(p, str) else upto[p + 1] - upto[p] for p in own) for own in parts]


def token_counts(spark, docs, path, context=CONTEXT):
    """doc_id, n_bytes, n_tokens and over_limit (more than ``context`` tokens) of every document."""
    sent = vocabularies.send(spark, path)
    proven = spark.sparkContext.broadcast(prove_whole_tokens(path))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def run(parts):
        content = sent.value[0]
        counter = vocabularies.prepared("counter", content,
                                        lambda _: Counter(vocabularies.merges(sent), proven.value))
        pattern, _ = vocabularies.prepared("special", content, vocabularies.special_tokens)
        for part in batches.chunks(parts, "text"):
            texts = part.column("text")
            counts = count_texts(counter, pattern, [t or "" for t in texts.to_pylist()])
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield batches.records([part.column("doc_id"), sizes, counts, [n > context for n in counts]], schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return batches.map_arrow(rows, run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
