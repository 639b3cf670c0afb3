"""Exact removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

Every ``LENGTH``-byte string that also starts earlier (smaller doc_id, or same document and earlier) is
found, and each byte it covers is removed. Strings never cross documents.

*Which suffixes.* A string's anchor is its ``GRAM``-byte piece of least hash, the leftmost of equals:
equal strings have their anchor at the same offset. Consecutive strings of a document with one anchor
form a class; the suffix that is sorted for a class starts at its core, the bytes that all strings of
the class share, goes on to the end of its last string, and is followed by what lies before the core.
Two suffixes with one core come together in the order; if they are equal, all strings of the class are;
if a core is alone, none of them occurs elsewhere.

*Rounds.* Round 0 sorts one suffix per class, about one for 39 bytes. Equal suffixes are decided: the
earliest stays, all others are repeats. Classes alone with their core are decided too. What is left
(classes at the edge of a repeat) is cut into cells of 8 offsets for round 1 and of one for round 2,
where the suffix is the string itself. No cap or threshold is involved, so the result is exact.

*Sort.* Each task sorts the suffixes of bounded stretches of text into runs, drops equal ones but the
earliest (so a passage in a third of all documents is one suffix per run from here on), front-codes
each run and cuts it at the range splitters. A range's fragments are merged by a loser tree whose
entries carry the length of the prefix they share with the last suffix put out: a longer shared prefix
wins without a look at the bytes, and bytes are compared only behind a prefix known to be equal.
Splitters may cut through a core with very many different suffixes; suffixes beside such a cut go to
the next round. Splitters come from a bounded sample and influence only the balance.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing; equal texts keep the
first by doc_id; rows with one doc_id are ordered by a hash of their text, and a null doc_id is last;
an empty table gives no rows. Other columns are not read.
"""

import bisect
import hashlib
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from retail_lake.llm import batches
from retail_lake.llm.scratch import all_columns, written

LENGTH = 100
GRAM = 24
# Offsets of a string in its class, by round: all, eight, one.
WIDTHS = (LENGTH - GRAM + 1, 8, 1)
# Text per run, text looked at in one step, text per range, about.
RUN_BYTES = 4 << 20
STEP_BYTES = 128 << 10
RANGE_BYTES = 8 << 20
MAX_RANGES = 20_000
SAMPLE_DOCUMENTS = 600
SAMPLE_KEYS = 20_000

DECIDED, FRAGMENT, CLASSES, SAMPLE = 0, 1, 2, 3
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("ord", pa.int64()), ("start", pa.int64()),
                     ("stop", pa.int64()), ("blob", pa.binary())])
_DDL = "kind int, part int, ord bigint, start bigint, stop bigint, blob binary"
_HEAD = struct.Struct("<II")


# --- anchors -------------------------------------------------------------------------------------

def _gram_hashes(data):
    """64-bit hash of the GRAM bytes from each position (GRAM = 24 = 16 + 8)."""
    h, base, size = data.astype(np.uint64) + np.uint64(1), np.uint64(0x100000001B3), 1
    eight = None
    while size < 16:
        power = np.uint64(pow(int(base), size, 2**64))
        h = h[:-size] + power * h[size:]
        size *= 2
        if size == 8:
            eight = h
    h = h[:len(h) - 8] + np.uint64(pow(int(base), 16, 2**64)) * eight[16:16 + len(h) - 8]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors(data, ends):
    """(first string, last string, anchor) of every class in ``data``: documents end at ``ends``."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none
    place = np.uint64(24)
    if len(data) >= 1 << 24:
        raise ValueError("a step is too long for its positions")
    h = _gram_hashes(data)
    least = (h >> place << place) | np.arange(len(h), dtype=np.uint64)
    # Least of WIDTHS[0] neighbours by doubling.
    size = 1
    whole = WIDTHS[0]
    while 2 * size <= whole:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = whole - size
    if rest:
        least = np.minimum(least[:len(least) - rest], least[rest:])
    q = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    inside = np.zeros(len(data) + 1, dtype=np.int64)  # strings must end within their document
    begins = np.concatenate([[0], ends[:-1]])
    long = ends - begins >= LENGTH
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[:len(q)] > 0)
    if not len(at):
        return none, none, none
    q = q[at]
    change = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    return at[change], at[np.append(change[1:], len(at)) - 1], q[change]


def _key(hull, core):
    """Suffix of a class: from its core on, then what lies before, then the two lengths."""
    return hull[core:] + hull[:core] + bytes((core, len(hull)))


def _hull(key):
    cut = key[-1] - key[-2]
    return key[cut:-2] + key[:cut]


def text_classes(documents):
    """(keys, ord, start, anchor offset) lists from (ord, text) pairs in order; in steps of bounded text."""
    waiting, size = [], 0

    def step():
        data = b"".join(piece for _, _, piece in waiting)
        sizes = np.array([len(piece) for _, _, piece in waiting], dtype=np.int64)
        ends = np.cumsum(sizes)
        first, last, anchor = anchors(np.frombuffer(data, dtype=np.uint8), ends)
        if not len(first):
            return [], [], [], []
        doc = np.searchsorted(ends, first, side="right")
        base = np.array([b for _, b, _ in waiting], dtype=np.int64) - (ends - sizes)
        ords = np.array([o for o, _, _ in waiting], dtype=np.int64)
        keys = [data[q:z + LENGTH] + data[a:q] + bytes((q - a, z + LENGTH - a))
                for a, z, q in zip(first.tolist(), last.tolist(), anchor.tolist())]
        return keys, ords[doc].tolist(), (first + base[doc]).tolist(), (anchor - first).tolist()

    for number, text in documents:
        for base in range(0, max(1, len(text) - LENGTH + 1), STEP_BYTES):
            piece = text[base:base + STEP_BYTES + LENGTH - 1]
            if size and size + len(piece) > STEP_BYTES:
                yield step()
                waiting, size = [], 0
            waiting.append((number, base, piece))
            size += len(piece)
    if waiting:
        yield step()


def cells(classes, width):
    """Cut classes (key, ord, start, anchor offset) into cells of ``width`` offsets from the anchor."""
    keys, ords, starts, offsets = [], [], [], []
    for key, number, start, offset in classes:
        hull = _hull(key)
        least = offset - (len(hull) - LENGTH)  # offset of the anchor in the last string
        for cell in range(least // width, offset // width + 1):
            far, near = min(offset, cell * width + width - 1), max(least, cell * width)
            begin = offset - far
            keys.append(_key(hull[begin:offset - near + LENGTH], far - cell * width))
            ords.append(number)
            starts.append(start + begin)
            offsets.append(far)
    return keys, ords, starts, offsets


# --- runs ----------------------------------------------------------------------------------------

def _merged(ords, starts, stops):
    """Intervals by document with overlapping and touching ones joined."""
    order = np.lexsort((starts, ords))
    ords, starts, stops = ords[order], starts[order], stops[order]
    doc = np.cumsum(np.append(False, ords[1:] != ords[:-1]))
    reach = np.maximum.accumulate((doc << 40) + stops)
    new = np.flatnonzero(np.append(True, (doc[1:] << 40) + starts[1:] > reach[:-1]))
    last = np.append(new[1:], len(ords)) - 1
    return ords[new], starts[new], reach[last] - (doc[new] << 40)


def _decided(ords, starts, stops):
    if not len(ords):
        return
    ords, starts, stops = _merged(np.array(ords), np.array(starts), np.array(stops))
    n = len(ords)
    part = (ords * 0x9E37) & 0x7FFF  # only deals the rows out
    yield batches.records([np.full(n, DECIDED, dtype=np.int32), part.astype(np.int32), ords, starts, stops, [None] * n], _SCHEMA)


def _row(kind, part, blob):
    return batches.records([[kind], [part], [None], [None], [None], [blob]], _SCHEMA)


def front_coded(keys, ords, starts, offsets):
    """A sorted stretch of different keys as bytes: shared prefix and length of each, then the rest."""
    n, sizes = len(keys), np.fromiter(map(len, keys), dtype=np.int64, count=len(keys))
    width = int(sizes.max())
    cellsof = np.frombuffer(b"".join([k.ljust(width, b"\0") for k in keys]), dtype=np.uint8).reshape(n, width)
    shared = np.zeros(n, dtype=np.int64)
    if n > 1:
        shared[1:] = np.minimum((cellsof[1:] != cellsof[:-1]).argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    columns, shared, sizes = np.arange(width, dtype=np.uint8), shared.astype(np.uint8), sizes.astype(np.uint8)
    rest = cellsof[(columns >= shared[:, None]) & (columns < sizes[:, None])].tobytes()
    body = b"".join([shared.tobytes(), sizes.tobytes(),
                     np.array(offsets, dtype=np.uint8).tobytes(), np.array(starts, dtype="<i8").tobytes(),
                     np.array(ords, dtype="<i8").tobytes(), rest])
    return _HEAD.pack(n, len(body)) + zstandard.ZstdCompressor(level=3).compress(body)


def opened(blob):
    """Generator of (key, shared prefix with the one before, ord, start, anchor offset)."""
    n, size = _HEAD.unpack_from(blob)
    body = zstandard.ZstdDecompressor().decompress(blob[_HEAD.size:], max_output_size=size)
    shared, sizes, offsets = body[:n], body[n:2 * n], body[2 * n:3 * n]
    starts = np.frombuffer(body, dtype="<i8", count=n, offset=3 * n).tolist()
    ords = np.frombuffer(body, dtype="<i8", count=n, offset=11 * n).tolist()
    at, key = 19 * n, b""
    for same, length, offset, start, number in zip(shared, sizes, offsets, starts, ords):
        end = at + length - same
        key = key[:same] + body[at:end]
        at = end
        yield key, same, number, start, offset


def _run(keys, ords, starts, offsets, splitters):
    """One sorted run: its repeats are decided, the rest goes out by range, front-coded."""
    if not keys:
        return
    # Earliest first among equals: the order of (ord, start), then a stable sort.
    early = np.lexsort((starts, ords)).tolist()
    order = sorted(early, key=keys.__getitem__)
    kept, repeats, before = [], [], None
    for i in order:
        if keys[i] == before:
            repeats.append(i)
        else:
            kept.append(i)
            before = keys[i]
    yield from _decided([ords[i] for i in repeats], [starts[i] for i in repeats],
                        [starts[i] + keys[i][-1] for i in repeats])
    del order, early, repeats
    sorted_keys = [keys[i] for i in kept]
    begin = 0
    for part, end in enumerate([*(bisect.bisect_left(sorted_keys, s) for s in splitters), len(kept)]):
        if end > begin:
            own = kept[begin:end]
            yield _row(FRAGMENT, part, front_coded(sorted_keys[begin:end], [ords[i] for i in own],
                                                   [starts[i] for i in own], [offsets[i] for i in own]))
            begin = end


def _runs(groups, splitters):
    """Gather (keys, ords, starts, offsets) groups to runs of RUN_BYTES of text, about."""
    run, size = ([], [], [], []), 0
    for group in groups:
        for whole, more in zip(run, group):
            whole += more
        size += sum(map(len, group[0]))
        if size > 4 * RUN_BYTES:  # a suffix has about four times the bytes it stands for
            yield from _run(*run, splitters)
            run, size = ([], [], [], []), 0
    yield from _run(*run, splitters)


# --- merge ---------------------------------------------------------------------------------------

def merge(runs):
    """Merge sorted generators of (key, shared, ord, start, offset) with a loser tree.

    Yields (key, prefix shared with the last key put out, ord, start, offset). ``lcp[r]`` is the prefix
    that run r's head shares with the last key put out, or with the one it lost against.
    """
    n = 1
    while n < len(runs):
        n *= 2
    iterators = [iter(r) for r in runs]
    heads = [next(i, None) for i in iterators] + [None] * (n - len(runs))
    from_bytes = int.from_bytes
    lcp = [-1 if h is None else 0 for h in heads]  # -1: the run has ended, and loses to all others

    def play(a, b):
        """(winner, loser) of two heads with equal shared prefixes; sets that of the loser."""
        p, x, y = lcp[a], heads[a][0], heads[b][0]
        # Most differ in the next few bytes; else the whole rest is looked at.
        for end in (p + 8, 1 << 30):
            left, right = x[p:end], y[p:end]
            if left != right:
                m = min(len(left), len(right))
                differ = from_bytes(left[:m]) ^ from_bytes(right[:m])
                same = p + m - (differ.bit_length() + 7) // 8
                if left < right:
                    lcp[b] = same
                    return a, b
                lcp[a] = same
                return b, a
        if heads[a][2:4] > heads[b][2:4]:
            a, b = b, a
        lcp[a], lcp[b] = p, len(x)
        return a, b

    losers, winners = [0] * n, [0] * n + list(range(n))
    for node in range(n - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        if lcp[a] == lcp[b] >= 0:
            a, b = play(a, b)
        elif lcp[a] < lcp[b]:
            a, b = b, a
        winners[node], losers[node] = a, b
    winner = winners[1]
    while lcp[winner] >= 0:
        head = heads[winner]
        yield head[0], lcp[winner], head[2], head[3], head[4]
        heads[winner] = head = next(iterators[winner], None)
        lcp[winner] = mine = -1 if head is None else head[1]
        node = (n + winner) >> 1
        while node:
            other = losers[node]
            theirs = lcp[other]
            if mine < theirs:
                losers[node], winner, mine = winner, other, theirs
            elif mine == theirs >= 0:
                winner, losers[node] = play(winner, other)
                mine = lcp[winner]
            node >>= 1


def _judge(merged, width, low, high):
    """Decide a merged range: (repeats as ord, start, stop lists; classes for the next round).

    ``low`` and ``high`` are the cores of the splitters beside the range, or None.
    """
    core = LENGTH + 1 - width
    ords, starts, stops, left = [], [], [], []
    held = None  # first key of the current core, while it is the only one
    open_core, last = False, None
    for key, shared, number, start, offset in merged:
        if last is not None and shared == len(key) == len(last):
            ords.append(number)
            starts.append(start)
            stops.append(start + key[-1])
            continue
        if last is None or shared < core:  # a new core
            held, open_core = (key, number, start, offset), False
            if width > 1 and key[:core] in (low, high):
                left.append(held)
                open_core = True
        elif width > 1:
            if not open_core:
                left.append(held)
                open_core = True
            left.append((key, number, start, offset))
        last = key
    return (ords, starts, stops), left


def _merge_task(splitters, width, next_width):
    cut = LENGTH + 1 - width

    def out(part, blobs):
        low = splitters[part - 1][:cut] if part else None
        high = splitters[part][:cut] if part < len(splitters) else None
        repeats, left = _judge(merge([opened(b) for b in blobs]), width, low, high)
        yield from _decided(*repeats)
        if left:
            for at in range(0, len(left), 1 << 16):
                some = left[at:at + (1 << 16)]
                yield _row(CLASSES, part, front_coded(*map(list, zip(*some))))
            keys = cells(left[::32], next_width)[0][::4]
            for key in keys:
                yield _row(SAMPLE, part, key)

    def run(rows):
        part, blobs = None, []
        for batch in rows:
            kinds = batch.column("kind").to_numpy()
            if (kinds == DECIDED).any():
                yield batch.filter(pa.array(kinds == DECIDED))
            parts = batch.column("part").to_numpy()
            for i in np.flatnonzero(kinds == FRAGMENT).tolist():
                if parts[i] != part:
                    if blobs:
                        yield from out(part, blobs)
                    part, blobs = int(parts[i]), []
                blobs.append(batch.column("blob")[i].as_py())
        if blobs:
            yield from out(part, blobs)

    return run


# --- jobs ----------------------------------------------------------------------------------------

def _quantiles(keys, ranges):
    keys = sorted(set(keys))
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def _in_order(part):
    numbers = part.column("ord").to_numpy()
    texts = part.column("text")
    return [(int(numbers[i]), texts[i].as_py() or b"") for i in np.argsort(numbers, kind="stable").tolist()]


def numbered(docs):
    """``docs`` with ``ord``: a number in document order, different for every row.

    doc_id itself where it is unique; else rows are sorted by (doc_id, hash of the text) once.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("id"))
    twice = ids.groupBy("id").count().where((F.col("count") > 1) | F.col("id").isNull()).limit(1).count()
    if not twice:
        return docs.withColumn("ord", F.col("doc_id").cast("bigint"))
    order = [F.asc_nulls_last(F.col("doc_id").cast("bigint")), F.xxhash64(F.col("text").cast("string"))]
    return written(docs.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("ord", F.monotonically_increasing_id()), "suffix-order")


def repeated_spans(texts):
    """(ord, start, stop) of repeated bytes of ``texts`` (ord, text as binary); spans may overlap."""
    spark = texts.sparkSession
    totals = texts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("bytes")).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(least, (totals["bytes"] or 0) // RANGE_BYTES))

    every = max(1, totals["n"] // SAMPLE_DOCUMENTS)
    picked = texts.where(F.pmod(F.xxhash64("ord"), F.lit(every)) == 0).limit(4 * SAMPLE_DOCUMENTS)

    def sample(parts):
        for part in batches.chunks(parts, "text", STEP_BYTES):
            for keys, *_ in text_classes(_in_order(part)):
                own = keys[::8]
                n = len(own)
                yield batches.records([[SAMPLE] * n, [0] * n, [None] * n, [None] * n, [None] * n, own], _SCHEMA)

    def keys_of(rows):
        got = rows.select("blob").orderBy(F.xxhash64("blob")).limit(SAMPLE_KEYS).collect()
        return [bytes(r["blob"]) for r in got]

    splitters = _quantiles(keys_of(batches.map_arrow(picked, sample, _DDL)), ranges)

    def sort_texts(cuts):
        def run(parts):
            def groups():
                for part in batches.chunks(parts, "text", STEP_BYTES):
                    yield from text_classes(_in_order(part))
            yield from _runs(groups(), cuts)
        return run

    def sort_cells(cuts, width):
        def run(parts):
            def groups():
                for part in parts:
                    for blob in part.column("blob").to_pylist():
                        yield cells(((k, o, s, a) for k, _, o, s, a in opened(blob)), width)
            yield from _runs(groups(), cuts)
        return run

    spans, source, sorter = None, texts, sort_texts(splitters)
    for round_, width in enumerate(WIDTHS):
        following = WIDTHS[round_ + 1] if round_ + 1 < len(WIDTHS) else 1
        fragments = batches.map_arrow(source, sorter, _DDL)
        fragments = fragments.repartition(ranges, "part").sortWithinPartitions("part")
        done = written(batches.map_arrow(fragments, _merge_task(splitters, width, following), _DDL), f"suffix-round{round_}")
        decided = done.where(F.col("kind") == DECIDED).select("ord", "start", "stop")
        spans = decided if spans is None else spans.unionAll(decided)
        if round_ + 1 < len(WIDTHS):
            source = done.where(F.col("kind") == CLASSES)
            splitters = _quantiles(keys_of(done.where(F.col("kind") == SAMPLE)), ranges)
            sorter = sort_cells(splitters, following)
    return spans


def _kept(text, starts, stops):
    """(kept bytes, removed bytes, number of removed runs)."""
    if not len(starts):
        return text, 0, 0
    _, starts, stops = _merged(np.zeros(len(starts), dtype=np.int64), np.array(starts), np.array(stops))
    pieces, at = [], 0
    for a, b in zip(starts.tolist(), stops.tolist()):
        pieces.append(text[at:a])
        at = b
    pieces.append(text[at:])
    return b"".join(pieces), int((stops - starts).sum()), len(starts)


def _packed(texts):
    """``texts`` with its text compressed for the shuffle."""
    schema = pa.schema([("ord", pa.int64()), ("doc_id", pa.int64()), ("text", pa.binary())])

    def run(parts):
        press = zstandard.ZstdCompressor(level=1)
        for part in batches.chunks(parts, "text", STEP_BYTES):
            yield batches.records([part.column("ord"), part.column("doc_id"),
                                   [press.compress(t or b"") for t in part.column("text").to_pylist()]], schema)

    return batches.map_arrow(texts, run, "ord bigint, doc_id bigint, text binary")


def deduplicated(docs):
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    return _applied(numbered(docs.select("doc_id", "text")))


def deduplicated_documents(docs):
    """The documents with their repeated bytes removed from ``text`` and all columns kept.

    What is left of a character that was cut goes too; ``n_chars`` follows the text where it is a column.
    Documents of which nothing is left are left out; those that were empty before stay.
    """
    others = [c for c in docs.columns if c != "text"]
    rest = [c for c, name in zip(all_columns(docs), docs.columns) if name != "text"]
    rows = numbered(docs.select("doc_id", "text", F.struct(*rest).alias("others")))
    kept = _applied(rows, with_text=True).select("ord", "kept_text", (F.col("n_removed") == F.col("n_bytes")).alias("all"), "n_removed")
    joined = rows.select("ord", "others", F.col("text").isNull().alias("none")).join(kept, "ord")
    joined = joined.where(~F.col("all") | (F.col("n_removed") == 0))
    text = F.when(~F.col("none"), F.col("kept_text"))
    columns = {c: F.col("others")[c] for c in others} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(columns["n_chars"])
    return joined.select(*[columns[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def _applied(numbered_rows, with_text=False):
    rows = numbered_rows.select("ord", F.col("doc_id").cast("bigint").alias("doc_id"),
                                F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text"))
    spans = repeated_spans(rows.select("ord", "text"))
    lists = spans.groupBy("ord").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
              ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("ord", pa.int64()), ("kept_text", pa.string())] * with_text)

    def run(parts):
        for part in batches.chunks(parts, "text"):
            texts = [zstandard.decompress(t) if t else b"" for t in part.column("text").to_pylist()]
            got = [_kept(t, a or (), b or ()) for t, a, b in
                   zip(texts, part.column("starts").to_pylist(), part.column("stops").to_pylist())]
            columns = [part.column("doc_id"), [len(t) for t in texts], [g[1] for g in got], [g[2] for g in got],
                       [hashlib.sha256(g[0]).hexdigest() for g in got]]
            if with_text:
                columns += [part.column("ord"), [g[0].decode("utf-8", "ignore") for g in got]]
            yield batches.records(columns, schema)

    ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return batches.map_arrow(_packed(rows).join(lists, "ord", "left"), run, ddl + ", ord bigint, kept_text string" * with_text)
