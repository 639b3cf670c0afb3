"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned by doc_id; each task encodes its range, appends the end id to every
document, and packs the ids into one Arrow IPC file: record batches of fixed-size lists, one column of
ids (16-bit where the vocabulary allows) and one of masks. Batches lie uncompressed at fixed offsets, so a reader maps the file and takes any
sequence without a copy. Only the last sequence of a file is padded; its mask tells which ids count.

Files get a name of their own per attempt; the index that names the valid ones is a table that Spark
commits. So a task that is run again leaves at most an unused file. The index has a row per document:
file, first id in the file, number of ids. Starts over all files come from a sum over files.

Defined cases: a null text is empty and has the end id only; special strings in a text are one id, as
the library takes them by default; rows with one doc_id are ordered by a hash of the text; a null doc_id
comes last; an empty table gives no file and no row. Other columns are not read.
"""

import contextlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_lake.llm import batches, pretokens, vocabularies
from retail_lake.llm.scratch import written
from retail_lake.session import shared_dir

SEQUENCE = 2048
END_ID = 2
# Sequences in one record batch.
ROWS = 256


def id_type(largest):
    """The smallest unsigned type that holds all ids of the vocabulary."""
    return pa.uint16() if largest < 1 << 16 else pa.uint32()


def file_schema(length=SEQUENCE, kind=None):
    return pa.schema([("ids", pa.list_(pa.field("id", kind or pa.uint32(), False), length)),
                      ("mask", pa.list_(pa.field("valid", pa.bool_(), False), length))])


class SequenceWriter:
    """Packs ids into sequences and writes them by whole record batches."""

    def __init__(self, sink, length=SEQUENCE, kind=None):
        self.length, self.schema = length, file_schema(length, kind)
        self.kind = self.schema.field(0).type.value_type
        self.plain = self.kind.to_pandas_dtype()
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting, self.count, self.total = [], 0, 0

    def append(self, ids):
        """Add the ids of one document, given as little-endian 32-bit integers."""
        self.waiting.append(ids)
        self.count += len(ids) // 4
        self.total += len(ids) // 4
        if self.count >= self.length * ROWS:
            self._flush(self.count // (self.length * ROWS) * ROWS)

    def _flush(self, rows):
        data = np.frombuffer(b"".join(self.waiting), dtype="<u4")
        small = data.astype(self.plain)
        size = rows * self.length
        valid = np.arange(size) < len(data)
        whole = small[:size] if len(data) >= size else np.pad(small, (0, size - len(data)))
        for at in range(0, rows, ROWS):
            cut = slice(at * self.length, min(rows, at + ROWS) * self.length)
            self.writer.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(whole[cut], type=self.kind), type=self.schema.field(0).type),
                pa.FixedSizeListArray.from_arrays(pa.array(valid[cut]), type=self.schema.field(1).type)], schema=self.schema))
        rest = data[size:]
        self.waiting, self.count = [rest.tobytes()], len(rest)

    def close(self):
        if self.count:
            self._flush(-(-self.count // self.length))
        self.writer.close()


class SequenceReader:
    """Ids of a file by position, as views of the mapped bytes where they lie in one batch."""

    def __init__(self, path, length=SEQUENCE):
        system, name = fs.FileSystem.from_uri(path)
        source = pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
        self.source, self.reader, self.per_batch = source, pa.ipc.open_file(source), ROWS * length
        self.at, self.values, self.valid = None, None, None

    def _load(self, batch):
        if batch != self.at:
            got = self.reader.get_batch(batch)
            self.values = got.column("ids").values.to_numpy()
            self.valid = got.column("mask").values
            self.at = batch

    def ids(self, start, count):
        parts = []
        while count > 0:
            batch, offset = divmod(start, self.per_batch)
            self._load(batch)
            n = min(count, self.per_batch - offset)
            if self.valid.slice(offset, n).true_count != n:
                raise ValueError("the index points at padding")
            parts.append(self.values[offset:offset + n])
            start, count = start + n, count - n
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)

    def close(self):
        self.source.close()


def encode_texts(cache, pattern, special, texts):
    """Ids of each text as bytes; special strings become their id."""
    flat, parts = vocabularies.segments(texts, pattern)
    pieces, bounds = pretokens.split(flat)
    ids, bounds = cache.ids(pieces), bounds.tolist()
    coded = [b"".join(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
    return [coded[own[0]] if len(own) == 1 and not isinstance(own[0], str) else b"".join(
        special[p].to_bytes(4, "little") if isinstance(p, str) else coded[p] for p in own) for own in parts]


def write_files(spark, docs, path, folder=None, length=SEQUENCE, end_id=END_ID):
    """Write all documents; returns the index: doc_id, file, part, row, start (in the file), n_tokens."""
    folder = folder or shared_dir(spark, "token-files")
    sent = vocabularies.send(spark, path)
    end = end_id.to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("part", pa.int64()), ("row", pa.int64()),
                        ("start", pa.int64()), ("n_tokens", pa.int64())])

    def run(parts):
        cache = vocabularies.pieces_cache(sent)
        pattern, special = vocabularies.prepared("special", sent.value[0], vocabularies.special_tokens)
        part = TaskContext.get().partitionId()
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        with contextlib.ExitStack() as stack:
            writer, row = None, 0
            for chunk in batches.chunks(parts, "text"):
                if writer is None:
                    sink = stack.enter_context(system.open_output_stream(f"{place}/{name}"))
                    writer = SequenceWriter(sink, length, id_type(max(len(cache.merges.tokens) - 1, end_id, *special.values(), 0)))
                starts, counts = [], []
                for ids in encode_texts(cache, pattern, special, [t or "" for t in chunk.column("text").to_pylist()]):
                    starts.append(writer.total)
                    counts.append(len(ids) // 4 + 1)
                    writer.append(ids + end)
                n = len(starts)
                yield batches.records([chunk.column("doc_id"), [f"{folder}/{name}"] * n, [part] * n,
                                       range(row, row + n), starts, counts], schema)
                row += n
            if writer is not None:
                writer.close()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(batches.map_arrow(rows, run, "doc_id bigint, file string, part bigint, row bigint, start bigint, n_tokens bigint"),
                   "token-index")


def read_files(index, length=SEQUENCE):
    """doc_id, start over all files, n_tokens and crc32 of the ids of every document, from its file."""
    files = index.groupBy("file", "part").agg(F.sum("n_tokens").alias("file_tokens"))
    before = F.sum("file_tokens").over(Window.orderBy("part")) - F.col("file_tokens")  # a row per file
    rows = index.join(files.select("file", before.alias("before")), "file")
    rows = rows.repartition("file").sortWithinPartitions("file", "row")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(parts):
        name = reader = None
        for part in parts:
            sums = []
            for file, start, count in zip(*(part.column(c).to_pylist() for c in ("file", "start", "n_tokens"))):
                if file != name:
                    if reader is not None:
                        reader.close()
                    name, reader = file, SequenceReader(file, length)
                sums.append(zlib.crc32(np.ascontiguousarray(reader.ids(start, count), dtype="<u4")))
            yield batches.records([part.column("doc_id"), pc.add(part.column("start"), part.column("before")),
                                   part.column("n_tokens"), sums], schema)

    return batches.map_arrow(rows, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(spark, docs, path, folder=None):
    """Write the documents as token files and read them back."""
    return read_files(write_files(spark, docs, path, folder))
