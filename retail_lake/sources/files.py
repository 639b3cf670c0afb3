"""Landing files: CSV with row positions, status documents, XML dumps, dataset listings (SRC1-SRC5, SRC8, SRC9)."""

import functools

from pyspark.sql import functions as F

from retail_lake.functions.names import base_name, file_glob, read_from, table_of_path
from retail_lake.operators.scan import running
from retail_lake.schemas import MISSING_CELLS
from retail_lake.session import PACKED, remove, shared_dir
from retail_lake.sources.blocks import place


def _listed(spark, folder, glob, recursive=False):
    """One row per file; the content column is not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(folder).select("path", "modificationTime", "length"))


def csv_header(spark, path):
    """SRC2: column names of a CSV; only its first line is read."""
    return spark.read.option("header", True).csv(path).columns


def landing_listing(spark, folder, glob):
    """SRC3: path, length and modified of the files of a landing folder; no content is read."""
    return _listed(spark, folder, glob).select("path", "length", F.col("modificationTime").alias("modified"))


def _survey(spark, paths):
    """One row per file that has a line: path, header (its first line that is not blank) and broken.

    A file is broken if a cell has a line break: some line then has an odd number of quotes. All files are told
    in one pass over their text, aggregated where it is read; the answer has one row per file.
    """
    lines = spark.read.text(list(paths)).select(
        read_from().alias("path"), "value", F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    shown = F.when(F.trim(F.translate("value", "\r\t", "")) != "", F.struct("block", "id"))
    return lines.groupBy("path").agg(F.min_by("value", shown).alias("header"), F.bool_or(odd).alias("broken")).where(
        "header IS NOT NULL")


def survey_landing(spark, paths):
    """SRC2, SRC3: ``(groups, broken)`` of CSV files: groups is ``[(columns, [paths])]`` with one entry per header.

    ``broken`` is the set of paths of files with a line break inside quotes. There is one pass for all files and a
    small job for every different header line, none per file. A file without a line that is not blank is in no
    group. A landing folder has one file per (file type, chain), so the lists are as short as the registry.
    """
    if not paths:
        return [], set()
    by_line, broken = {}, set()
    for row in _survey(spark, paths).orderBy("path").toLocalIterator():
        by_line.setdefault(row.header, []).append(row.path)
        if row.broken:
            broken.add(row.path)
    groups = {}
    for same in by_line.values():
        groups.setdefault(tuple(csv_header(spark, same[0])), []).extend(same)
    return [(list(columns), sorted(same)) for columns, same in groups.items()], broken


def landing_groups(spark, folder):
    """SRC3: the ``*.csv`` files of a landing folder as ``[(columns, [paths])]``, one entry per header."""
    return survey_landing(spark, [r.path for r in landing_listing(spark, folder, "*.csv").select("path").toLocalIterator()])[0]


def _broken_lines(spark, paths):
    """``(all files, files with a line break inside quotes)`` as sets of paths; one row per file comes back."""
    told = {r.path: r.broken for r in _survey(spark, paths).toLocalIterator()}
    return set(told), {path for path, broken in told.items() if broken}


def _records(spark, paths, folder):
    """_path, record, text of the records of CSV files whose cells may hold line breaks; no file is one task.

    Lines are read in blocks. Whether a line begins inside quotes is told by the parity of all quotes before it
    in its file; the lines from one that begins outside to the next such line are a record. Blank lines
    between records are none. A file with a quote that is never closed is one record from there on.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", read_from().alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    lines = place(lines, f"{folder}/lines")
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("bigint")
    marked = running(lines.select("_path", "pos", quotes.alias("quotes"), F.trim(F.translate("value", "\r\t", "")).alias("shown")),
                     ["_path"], "pos", {"before": ("sum", F.col("quotes"), False)})
    begins = (F.col("before") % 2 == 0) & ((F.col("shown") != "") | (F.col("quotes") > 0))
    marked = marked.select("_path", "pos", begins.cast("bigint").alias("begins"), (F.col("before") % 2 == 0).alias("outside"))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{folder}/marked")
    marked = running(spark.read.parquet(f"{folder}/marked"), ["_path"], "pos", {"record": ("sum", F.col("begins"), True)})
    marked = marked.where("NOT outside OR begins = 1")
    return marked.join(lines, ["_path", "pos"]).groupBy("_path", "record").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("lines")).select(
        "_path", "record", F.regexp_replace(F.array_join(F.col("lines")["value"], "\n"), r"\r\z", "").alias("text"))


def _broken_rows(spark, paths, columns, folder):
    """The rows of ``read_csv_rows`` for files with a line break inside quotes; the first record is the header."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    rows = _records(spark, paths, folder).where("record > 1").select(
        base_name("_path").alias("source_file"), table_of_path("_path").alias("table_name"),
        (F.col("record") - 2).alias("row_index"), F.from_csv("text", schema, {"escape": '"'}).alias("_row"))
    cell = F.col("_row")
    rows = rows.select("source_file", "table_name", "row_index",
                       *[F.when(~cell[c].isin(*MISSING_CELLS), cell[c]).alias(c) for c in columns])
    # Kept, so that a load that reads its rows several times cuts the records once.
    rows.write.options(**PACKED).mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{folder}/records")
    for name in ("lines", "marked"):
        remove(spark, f"{folder}/{name}")
    return spark.read.schema(rows.schema).parquet(f"{folder}/records")


def read_csv_rows(spark, paths, columns, folder=None, broken=None):
    """SRC1: CSV rows as text with (source_file, table_name, row_index).

    ``row_index`` is the position of the row in its file, header excluded. Every file is read in blocks by
    many tasks; ids rise within a block, so the position is the id relative to the first one of the block
    plus the rows of all earlier blocks. The rows are written to ``folder`` (by default a new shared one) with
    block and id, in the one pass that reads CSV; block offsets come from what was written, so they hold
    however the files were split, and no row is shuffled to be numbered. Files with a line break inside quotes
    are cut into records first (``_records``). A quote in a cell is doubled; cells such as ``NULL`` or ``NaN``
    are missing. ``broken`` names the files with such a break where a survey has told them already; ``paths`` are
    files then, and no other pass looks for them.
    """
    folder = folder or shared_dir(spark, "landing")
    listed = [paths] if isinstance(paths, str) else list(paths)
    every, broken = _broken_lines(spark, listed) if broken is None else (set(listed), set(listed) & set(broken))
    if broken:
        rows = _broken_rows(spark, sorted(every & broken), columns, f"{folder}/broken")
        whole = sorted(every - broken)
        return rows.unionByName(_block_rows(spark, whole, columns, f"{folder}/whole")) if whole else rows
    return _block_rows(spark, paths, columns, folder)


def _block_rows(spark, paths, columns, folder):
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    cells = [F.when(~F.col(f"`{c}`").isin(*MISSING_CELLS), F.col(f"`{c}`")).alias(c) for c in columns]
    rows = spark.read.schema(schema).options(header=True, escape='"').csv(paths).select(
        *cells, read_from().alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    placed = place(rows, folder)
    return placed.select(base_name("_path").alias("source_file"), table_of_path("_path").alias("table_name"),
                         F.col("pos").alias("row_index"), *[placed[f"`{c}`"] for c in columns])


def count_csv_rows(spark, paths, columns):
    """JN7: (table_name, source_rows) of CSV files; no cell is kept."""
    every, broken = _broken_lines(spark, paths)
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    counts = []
    if every - broken:
        counts.append(spark.read.schema(schema).options(header=True, escape='"').csv(sorted(every - broken))
                      .select(read_from().alias("_path")))
    if every & broken:
        counts.append(_records(spark, sorted(every & broken), shared_dir(spark, "counted")).where("record > 1").select("_path"))
    rows = functools.reduce(lambda a, b: a.unionByName(b), counts)
    return rows.groupBy(table_of_path("_path").alias("table_name")).agg(F.count(F.lit(1)).alias("source_rows"))


def read_status_documents(spark, folder, schema):
    """SRC4 for documents of a known shape, one JSON document per file."""
    return (spark.read.schema(schema).option("multiLine", True)
            .option("pathGlobFilter", "*.json").json(folder))


def read_xml_rows(spark, path, row_tag, schema=None):
    """SRC5: XML dumps as rows, with ``file_name`` and ``found_folder`` from the path."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path)
    parts = F.split(read_from(), "/")
    return rows.select(F.element_at(parts, -2).alias("found_folder"),
                       F.element_at(parts, -1).alias("file_name"), *rows.columns)


def list_files(spark, folder, chain=None, extension=None):
    """SRC8, X11: base names of the dataset files that match chain and extension."""
    return _listed(spark, folder, file_glob(chain, extension)).select(base_name("path").alias("file_name"))


def last_modified(spark, folder):
    """A8 for a dataset folder: newest modification time of any file in it."""
    return _listed(spark, folder, "*").agg(F.max("modificationTime").alias("last_update"))


def read_file(spark, folder, name):
    """SRC9: one dataset file by extension: JSON documents, CSV rows, else lines of text."""
    path = f"{folder.rstrip('/')}/{name}"
    if name.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    if name.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.text(path)
