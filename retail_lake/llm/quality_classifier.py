"""Ordinal quality classifier: cumulative-link logistic regression on graded ratings.

A text has hashed features: its distinct words and their stems, the signs at the ends of words, and its rates of
capitals, signs, digits and repeated words in steps. One weight vector is shared by all grades, and
ordered thresholds cut the score s: P(grade > k) = sigmoid(s - threshold_k). So one pass gives the
whole distribution of grades: the expected grade and the tail probability that selects.

The model is fitted on a bounded sample of labelled documents (``SAMPLE`` rows, the smallest hashes of
doc_id): executors turn texts into feature ids, the driver gets only these. Scoring reads every
document once, without a shuffle; the weights that each executor gets are 4 MB at any size.

Grades are made from the labels: 0 low quality, 1 good but toxic, 2 good and clean.

Defined cases: null and empty texts have rate features only; documents without label only get scores;
a document with several labels counts with its lowest grade; labels with a null are left out; if fewer
than two grades are known, all weights are zero and every document is kept. Repeated rows score alike, and
rows of one doc_id count once in the fit.
"""

import math
import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from retail_lake.llm import batches

SAMPLE = 10_000
BITS = 20
GRADES = 3
EPOCHS = 16
BATCH = 128
RATE = 0.25
# Weight of the sum of absolute weights: words that tell nothing stay at zero exactly.
PENALTY = 3e-3
# Features of fewer sample documents get no weight: most are words seen once, which say nothing.
MIN_DOCUMENTS = 5
KEEP_PROBABILITY = 0.5
# Beginnings of words that are features too, for inflected words; in bytes.
STEMS = (4, 5, 6)

_WHITE = bytes([0x20, *range(0x09, 0x0E)])
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()")


def _step(share):
    """Coarse logarithmic step of a share."""
    return 0 if share <= 0 else 1 + max(0, min(9, int(10 + 1.5 * math.log2(share))))


_MASK = (1 << BITS) - 1
# Signs at the ends of words: all of ASCII but letters and digits.
_EDGES = bytes(c for c in range(128) if not chr(c).isalnum())
_TAILS = _SIGNS + b".,;:'\"-()"


class _Words(dict):
    """Feature ids of a word: itself, its stems, the signs at its end. Emptied at ``limit`` words."""

    limit = 200_000

    def __missing__(self, word):
        core = word.strip(_EDGES)
        found = [] if core == word else [b"s" + word[len(word.rstrip(_TAILS)):]]
        if core:
            low = core.lower()
            found.append(b"w" + low)
            found += [b"%d" % n + low[:n] for n in STEMS if len(low) > n]
        if len(self) >= self.limit:
            self.clear()
        ids = self[word] = tuple(zlib.crc32(f) & _MASK for f in found)
        return ids


_words = _Words()


def features(text):
    """Sorted distinct feature ids of a text in UTF-8."""
    words = text.split()
    distinct = set(words)
    found = set()
    found.update(*map(_words.__getitem__, distinct))
    size = max(1, len(text) - len(words))
    share = lambda signs: (len(text) - len(text.translate(None, signs))) / size
    again = sum(map(operator.eq, words, words[1:])) / max(1, len(words))
    for name, value in ((b"upper", share(_UPPER)), (b"signs", share(_SIGNS)), (b"digits", share(_DIGITS)),
                        (b"bars", share(b"|")), (b"again", again), (b"repeat", 1 - len(distinct) / max(1, len(words)))):
        found.add(zlib.crc32(b"r" + name + b"%d" % _step(value)) & _MASK)
    found.add(zlib.crc32(b"n%d" % min(4, len(words) // 5)) & _MASK)
    return np.sort(np.fromiter(found, dtype=np.int32, count=len(found)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights, thresholds):
        self.weights, self.thresholds = weights, np.asarray(thresholds, dtype=np.float64)

    def tails(self, scores):
        """P(grade > k) by row and k."""
        return _sigmoid(np.asarray(scores)[:, None] - self.thresholds)

    def score(self, ids):
        return float(self.weights[ids].sum(dtype=np.float64))


def fit(rows, grades, n_grades=GRADES, epochs=EPOCHS, seed=5):
    """Maximum likelihood by AdaGrad over ``rows`` (arrays of feature ids); None without two grades."""
    grades = np.asarray(grades)
    if len(set(grades.tolist())) < 2:
        return None
    common = np.bincount(np.concatenate(rows), minlength=1 << BITS) >= MIN_DOCUMENTS
    rows = [ids[common[ids]] for ids in rows]
    known = np.bincount(grades, minlength=n_grades) + 0.5
    above = 1 - np.cumsum(known)[:-1] / known.sum()
    cuts = -np.log(above / (1 - above))
    # Thresholds are a first one and positive steps, kept as logarithms: so they stay in order.
    shape = np.concatenate([cuts[:1], np.log(np.maximum(1e-2, np.diff(cuts)))])
    weights, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-2)
    shape_seen = np.full(len(shape), 1e-2)
    average = np.zeros(1 << BITS)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            ids = np.concatenate([rows[i] for i in part])
            sizes = np.array([len(rows[i]) for i in part])
            y = grades[part]
            scores = np.bincount(np.repeat(np.arange(len(part)), sizes), weights[ids], minlength=len(part))
            cuts = np.cumsum(np.concatenate([shape[:1], np.exp(shape[1:])]))
            upper = np.append(cuts, np.inf)[y]
            lower = np.concatenate([[-np.inf], cuts])[y]
            a, b = _sigmoid(upper - scores), _sigmoid(lower - scores)
            chance = np.maximum(a - b, 1e-9)
            da, db = a * (1 - a), b * (1 - b)
            slope = (da - db) / chance  # of minus log likelihood by score
            touched, where = np.unique(ids, return_inverse=True)
            g = np.bincount(where, np.repeat(slope, sizes)) / len(part)
            seen[touched] += g * g
            rate = RATE / np.sqrt(seen[touched])
            moved = weights[touched] - rate * g
            weights[touched] = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * PENALTY)
            by_cut = np.zeros(len(shape))
            np.add.at(by_cut, y[y < n_grades - 1], -(da / chance)[y < n_grades - 1])
            np.add.at(by_cut, y[y > 0] - 1, (db / chance)[y > 0])
            by_cut /= len(part)
            tails = np.cumsum(by_cut[::-1])[::-1]
            g = tails * np.concatenate([[1.0], np.exp(shape[1:])])
            shape_seen += g * g
            shape = shape - RATE * g / np.sqrt(shape_seen)
        if epoch >= epochs // 2:
            average += weights
    average /= epochs - epochs // 2
    return Model(average.astype(np.float32), np.cumsum(np.concatenate([shape[:1], np.exp(shape[1:])])))


def grade(quality, toxic):
    """Grade column of the labels."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2)


def train(docs, labels, sample=SAMPLE):
    """Fit on at most ``sample`` labelled documents; of rows of one doc_id, on the one whose text is least in bytes."""
    rated = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                           grade(F.col("quality"), F.col("toxic")).alias("grade"))
             .where(F.col("doc_id").isNotNull() & labels["quality"].isNotNull() & labels["toxic"].isNotNull())
             .groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.col("text").cast("string").cast("binary").alias("text"))
    # At most ``sample`` rows of two numbers are sent to the executors. Repeated rows are combined before the shuffle,
    # so at most ``sample`` rows come back, the same ones in every run.
    rows = texts.join(F.broadcast(rated), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("ids", pa.binary())])

    def run(parts):
        for part in batches.chunks(parts, "text"):
            ids = [features(t or b"").astype("<i4").tobytes() for t in part.column("text").to_pylist()]
            yield batches.records([part.column("doc_id"), part.column("grade"), ids], schema)

    found = batches.map_arrow(rows, run, "doc_id bigint, grade int, ids binary").collect()
    found = sorted((r["doc_id"], r["grade"], bytes(r["ids"])) for r in found)
    return fit([np.frombuffer(ids, dtype="<i4") for _, _, ids in found], [g for _, g, _ in found])


def _columns(model, texts, top):
    """(expected grade, probability of ``top`` or better) by row."""
    if model is None:
        return [None] * len(texts), [1.0] * len(texts)
    tails = model.tails([model.score(features(t)) for t in texts])
    return tails.sum(axis=1), tails[:, top - 1]


def scores(docs, model, top=GRADES - 1, keep=KEEP_PROBABILITY):
    """doc_id, expected_grade, p_top and kept of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("p_top", pa.float64()), ("kept", pa.bool_())])

    def run(parts):
        for part in batches.chunks(parts, "text"):
            expected, tail = _columns(sent.value, [t or b"" for t in part.column("text").to_pylist()], top)
            yield batches.records([part.column("doc_id"), expected, tail, [p >= keep for p in tail]], schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("text"))
    return batches.map_arrow(rows, run, "doc_id bigint, expected_grade double, p_top double, kept boolean")


def good_documents(docs, model, top=GRADES - 1, keep=KEEP_PROBABILITY):
    """The documents the model keeps, with their columns as they are."""
    batches.importable(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        whole, out = pa.RecordBatch.from_arrays([texts], names=["text"]), []
        for part in batches.chunks([whole], "text"):
            _, tail = _columns(sent.value, [t or b"" for t in part.column("text").to_pylist()], top)
            out += [bool(p >= keep) for p in tail]
        return pa.array(out, type=pa.bool_())

    return docs.where(kept(F.col("text").cast("string").cast("binary")))
