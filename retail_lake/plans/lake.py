"""The lake: load landing files and status logs, serve the read queries, publish and check snapshots.

Everything of one load is written under its batch id; the load counts once its row is in
``commits``. A load that failed half way is run again under the same id and overwrites its own
folders, and readers never see it.
"""

import concurrent.futures
import functools

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from retail_lake.functions import names, values
from retail_lake.operators import access, catalog, filters, ingest, merge, quality, status, versions
from retail_lake.operators.scan import ROW_BITS
from retail_lake.operators.sizing import broadcast_if_small
from retail_lake.schemas import (
    FILE_TYPES, KEY_COLUMNS, LONG_TERM_SECONDS, PAGE_SIZE, SHORT_TERM_SECONDS, STATUS_DOC,
    STATUS_TABLES, STORED_MARKER, STORED_ROW,
)
from retail_lake.session import PACKED, remove, swept
from retail_lake.sinks import snapshot, store
from retail_lake.sources import files, status_logs, tables, xml_dumps

TABLE = ["table_name", "file_type", "chain"]
LEDGER = "source_file string, digest string, kind string, batch_id bigint"
BROKEN = "source_file string, value string, kind string, batch_id bigint"
COMMITS = "as_of string, batch_id bigint"
VERSIONS = "created_at string, message string, version bigint"
PROGRESS = ("table_name string, file_type string, chain string, last_row bigint, found_folder string, "
            "file_name string, content map<string,string>, first_row bigint, n_rows bigint, batch_id bigint")
QUARANTINE = ("table_name string, file_type string, chain string, row_index bigint, found_folder string, "
              "file_name string, content map<string,string>, batch_id bigint")
LANDED = "path string, length bigint, modified timestamp, kind string, batch_id bigint"
PARTITIONS = ["file_type", "chain"]
# Status tables of a kind of log: of its events and of its global rows.
STATUS_OF = {"scraper": ("ScraperStatus", "GlobalScraperStatus"), "parser": ("ParserStatus", "GlobalParserStatus")}


def together(spark, *steps):
    """Run steps that need nothing of each other at once: the jobs of one use the cores that those of another leave
    idle. All have ended on return, and the first error is raised then; else it is what each returned."""
    with concurrent.futures.ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


# Fixed names: the methods and arguments of the read queries are those that callers know.
class Lake:
    """A lake under ``root``. ``chains`` maps each enabled chain to its dump folder."""

    def __init__(self, spark, root, chains, file_types=FILE_TYPES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.chains = dict(chains)
        self.file_types = tuple(file_types)

    # --- stored tables -------------------------------------------------------------------------

    def _path(self, name):
        return f"{self.root}/{name}"

    def _stored(self, name, schema, conditions=None):
        return tables.read_table(self.spark, self._path(name), schema, conditions)

    def last_batch(self):
        """Id of the last committed load, -1 before the first one."""
        last = self._stored("commits", COMMITS).agg(F.max("batch_id")).first()[0]
        return -1 if last is None else last

    def _read(self, name, schema, conditions=None):
        """A table as of the last committed load."""
        return self._stored(name, schema, conditions).where(F.col("batch_id") <= self.last_batch())

    def rows(self, conditions=None):
        """Stored data rows; file type and chain prune partitions."""
        return self._read("rows", STORED_ROW, conditions)

    def markers(self):
        """Completion markers: the latest one of each file run."""
        marks = self._read("markers", STORED_MARKER)
        return merge.last_per_key(marks, [*PARTITIONS, "first_row"], "batch_id")

    def status(self, table):
        """Stored events of a status table."""
        return self._read(f"status/{table}", STATUS_DOC)

    def progress(self):
        """State of each table after the last load: last row and open run. One row per table."""
        return self._stored("progress", PROGRESS).where(F.col("batch_id") == self.last_batch()).drop("batch_id")

    def quarantined(self):
        """rows set aside because the first row of their table had no keys.

        Such a table has no mark, so each load sets all its rows aside again: the latest load counts. Of a dump with
        rows that are not well formed it is the latest load that read it; their text is the only cell.
        """
        held = self._read("quarantine", QUARANTINE)
        of_dump = F.when(F.map_contains_key("content", F.lit(xml_dumps.BROKEN_TEXT)), F.col("file_name"))
        held = held.withColumn("_dump", F.coalesce(of_dump, F.lit("")))
        latest = held.groupBy("table_name", "_dump").agg(F.max("batch_id").alias("batch_id"))
        return held.join(latest, ["table_name", "_dump", "batch_id"]).select(*held.drop("_dump").columns)

    def broken_logs(self):
        """SRC4: status files of the last load that are no status log: name and beginning."""
        return self._stored("broken_logs", BROKEN).where(F.col("batch_id") == self.last_batch())

    def registry(self):
        """JN6: the tables of the enabled chains and file types."""
        return catalog.table_registry(catalog.chain_dim(self.spark, self.chains), self.file_types)

    def list_destinations(self):
        """SNK7: names of all tables."""
        return (self.registry().select("table_name")
                .unionByName(catalog.status_registry(self.spark).select("table_name")))

    def content(self, table, conditions=None):
        """SRC6: content of a table by name; an unknown table is empty."""
        if table in STATUS_TABLES:
            return filters.eq_filter(self.status(table), conditions or {})
        kind = next((t for t in sorted(FILE_TYPES, key=len, reverse=True)
                     if table.startswith(t.lower() + "_")), None)
        chain = next((c for c in self.chains if kind and table == f"{kind}_{c}".lower()), None)
        rows = self.rows({"file_type": kind, "chain": chain}) if chain else self.rows().where("false")
        return filters.eq_filter(rows, conditions or {})

    # --- load ----------------------------------------------------------------------------------

    def restart(self):
        """SNK6/ST6: forget all loads; tables start empty. Snapshots stay."""
        def empty(name, schema):
            (self.spark.createDataFrame([], schema).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(self._path(name)))

        # Without a commit nothing counts, so a restart that fails half way leaves no table that readers see in part.
        empty("commits", COMMITS)
        together(self.spark, *[functools.partial(empty, name, schema) for name, schema in (
            ("rows", STORED_ROW), ("markers", STORED_MARKER), ("progress", PROGRESS),
            ("quarantine", QUARANTINE), ("ledger", LEDGER), ("broken_logs", BROKEN), ("landed", LANDED),
            *((f"status/{t}", STATUS_DOC) for t in STATUS_TABLES))])

    def upload(self, outputs, scraping_status, converting_status, as_of, full_refresh=False, dumps=None, layouts=None):
        """Load what is new in the landing folders; returns the batch id.

        ``as_of`` is the time of the load. ``full_refresh`` starts over from empty tables. ``dumps`` is a folder of
        XML dumps, read as ``layouts`` says: ``{file type: (row tag, columns)}`` (``_load_dumps``).
        """
        if full_refresh or self.last_batch() < 0:
            self.restart()
        batch = self.last_batch() + 1
        # Rows and events share no table of a load, so neither waits for the other.
        together(self.spark, lambda: self._load_rows(outputs, batch, dumps, layouts or {}),
                  lambda: self._load_status({"scraper": scraping_status, "parser": converting_status}, batch))
        commit = self.spark.createDataFrame([(as_of, batch)], COMMITS)
        store.write_batch(commit.coalesce(1), self._path("commits"), batch)
        self._drop_scratch()
        return batch

    def _drop_scratch(self):
        """Remove the landing copies of this lake's loads; they are of no use once the load counts."""
        remove(self.spark, self._path("_scratch"))

    def _fresh_files(self, listed, kind, batch, again=None):
        """ST1: paths of the landing files that the last load did not read as they are now.

        The listing is kept as ``landed`` before a file is read, so one that grows meanwhile differs at the next
        load. A file of the same path, length and time holds nothing past the marks; ``again`` has the source_file
        of those to read all the same. The answer is as long as the list of new files, at most the registry.
        """
        path = f"{self._path('landed')}/batch_id={batch}/kind={kind}"
        listed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        # Only the folder of that load is listed: other steps write in this load's meanwhile.
        seen = tables.read_table(self.spark, f"{self._path('landed')}/batch_id={self.last_batch()}", LANDED, {"kind": kind})
        if again is not None:
            seen = seen.join(again, names.base_name("path") == again["source_file"], "left_anti")
        now = self.spark.read.schema(listed.schema).parquet(path)
        fresh = now.join(seen, ["path", "length", "modified"], "left_anti").select("path")
        return sorted(r.path for r in fresh.toLocalIterator())

    def _load_dumps(self, dumps, layouts, batch, progress):
        """SRC5: rows of the XML dumps not stored yet: (packed rows, rows set aside, their tables).

        A dump lies in its chain's folder and its name tells the type. It is stored once by chain, type and name
        (names carry date and time), as a run of its own after the rows so far; a marker says that it is there, also
        after a restore. Rows are whole, so no cell is filled from the row before. Types without a layout stay.
        """
        chain_of = {folder: chain for chain, folder in self.chains.items()}
        listed = xml_dumps.dump_listing(self.spark, dumps, chain_of)
        listed = listed.where(F.col("file_type").isin([t for t in self.file_types if t in layouts]))
        stored = self.markers().select("file_type", "chain", "file_name").distinct()
        # Kept, so that every step of the load sees the same files; one row per new dump.
        scratch = f"{self._path('_scratch')}/dumps-{batch}"
        (listed.join(stored, ["file_type", "chain", "file_name"], "left_anti").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(f"{scratch}/listing"))
        fresh = self.spark.read.parquet(f"{scratch}/listing")
        paths, held = {}, set()
        for row in fresh.toLocalIterator():
            paths.setdefault(row.file_type, []).append(row.path)
            held.add((row.file_type, row.chain))
        packed, bad = [], []
        for kind in sorted(paths):
            row_tag, columns = layouts[kind]
            rows = xml_dumps.read_dump_rows(self.spark, sorted(paths[kind]), row_tag, columns, f"{scratch}/{kind}")
            rows = xml_dumps.table_rows(rows, fresh, progress.select("file_type", "chain", "last_row"))
            packed.append(ingest.pack_rows(rows.where("_broken IS NULL"), TABLE, columns))
            text = F.col("_broken").alias(xml_dumps.BROKEN_TEXT)
            bad.append(ingest.pack_rows(rows.where("_broken IS NOT NULL").select(
                *TABLE, "row_index", "found_folder", "file_name", text), TABLE, [xml_dumps.BROKEN_TEXT]))
        return packed, bad, held

    def _load_rows(self, outputs, batch, dumps=None, layouts=None):
        """Number, fill, pack and write the rows past each table's mark.

        A table's stored rows all lie at or below its mark, and a retried load replaces its own
        folder, so new rows are unique by (table, row index) without a look at the stored ones. Files that have
        not changed since the last load, and those of other chains and types, are not opened.
        """
        progress = self.progress()
        listed = files.landing_listing(self.spark, outputs, "*.csv")
        listed = self._with_enabled_chain(listed.withColumn("_t", names.split_table_name(names.table_of_path("path")))
                                          .select("path", "length", "modified", "_t.file_type", "_t.chain"))
        fresh = self._fresh_files(listed.select("path", "length", "modified"), "rows", batch)
        groups, broken = files.survey_landing(self.spark, fresh)
        loads = [self._load_group(columns, paths, progress, f"{self._path('_scratch')}/batch-{batch}-{n}", broken)
                 for n, (columns, paths) in enumerate(groups)]
        packed, bad = [p for p, _ in loads], [b for _, b in loads if b is not None]
        if dumps is not None:
            of_dumps, broken_rows, tables_held = self._load_dumps(dumps, layouts, batch, progress)
            both = tables_held & self._tables_of(fresh)
            if both:
                raise ValueError(f"tables with new CSV rows and new dumps: {sorted(both)}")
            packed.extend(rows.repartition("file_type", "chain", F.shiftright("row_index", ROW_BITS[0])) for rows in of_dumps)
            bad.extend(broken_rows)
        # Without new rows too, the batch is written: an earlier try of it may have left some.
        none = self.spark.createDataFrame([], STORED_ROW)
        packed = functools.reduce(lambda a, b: a.unionByName(b), packed) if packed else none
        store.write_rows(packed.withColumn("batch_id", F.lit(batch)).select(*STORED_ROW.names),
                         self._path("rows"), batch, placed=True)
        none = self.spark.createDataFrame([], QUARANTINE)
        bad = functools.reduce(lambda a, b: a.unionByName(b), bad).withColumn("batch_id", F.lit(batch)) if bad else none
        together(self.spark, lambda: store.write_batch(bad, self._path("quarantine"), batch),
                  lambda: self._load_progress(progress, batch))

    def _tables_of(self, paths):
        """(file type, chain) of the tables of CSV files; as many as the registry at most."""
        named = self.spark.createDataFrame([(p,) for p in paths], "path string").withColumn(
            "_t", names.split_table_name(names.table_of_path("path")))
        return {(r.file_type, r.chain) for r in self._with_enabled_chain(named.select("_t.file_type", "_t.chain")).toLocalIterator()}

    def _load_group(self, columns, paths, progress, scratch, broken):
        """Rows past the mark of the files of one header: (packed rows, quarantined rows or None)."""
        content = [c for c in columns if c not in KEY_COLUMNS]
        landed = files.read_csv_rows(self.spark, paths, columns, folder=scratch, broken=broken)
        landed = (landed.withColumn("_t", names.split_table_name("table_name"))
                  .select("table_name", "_t.file_type", "_t.chain", "row_index", "found_folder", "file_name", *content))
        fresh = ingest.rows_after(self._with_enabled_chain(landed), progress)
        # One row per table: where its new rows begin, and whether its first row has keys.
        begin = fresh.groupBy("table_name").agg(F.min_by(ingest.has_keys(), "row_index").alias("ok"))
        begins = {r.table_name: r.ok for r in begin.toLocalIterator()}
        carry = progress.where(F.col("table_name").isin(list(begins))).select(
            *TABLE, F.col("last_row").alias("row_index"), "found_folder", "file_name",
            *[F.col("content")[c].alias(c) for c in content])
        packed, _ = ingest.ingest(fresh, TABLE, content, carry=carry)
        held = {r.table_name for r in carry.select("table_name").toLocalIterator()}
        keyless = sorted(table for table, ok in begins.items() if not ok and table not in held)
        if not keyless:
            return packed, None
        # Only the rows of these tables go through the pass again.
        return packed, ingest.ingest(fresh.where(F.col("table_name").isin(keyless)), TABLE, content)[1]

    def _with_enabled_chain(self, rows):
        """Table names are lower case; give rows the chain's own spelling, and drop other chains."""
        spelling = F.create_map(*[F.lit(x) for c in sorted(self.chains) for x in (c.lower(), c)])
        named = rows.withColumn("chain", spelling[F.col("chain")])
        return named.where(F.col("chain").isNotNull() & F.col("file_type").isin(*self.file_types))

    def _load_progress(self, progress, batch):
        """Markers and per-table state, computed from the rows just written."""
        rows = self._stored("rows", STORED_ROW, {"batch_id": batch})
        rows = rows.withColumn("table_name", names.table_name("file_type", "chain"))
        held = progress.select(*TABLE, "file_name", "first_row", "last_row", "n_rows")
        scratch = f"{self._path('_scratch')}/runs-{batch}"
        # Kept, so that the rows are cut into runs once for markers and state.
        found = ingest.continued_runs(rows, held, TABLE)
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(scratch)
        runs = self.spark.read.schema(found.schema).parquet(scratch)
        marks = runs.where("has_new_rows").select(
            F.lit(ingest.COMPLETE).alias("file_complete"), "file_name",
            F.col("n_rows").alias("total_expected_records"), "first_row", "file_type", "chain",
            F.lit(batch).cast("bigint").alias("batch_id"))
        # Marks are found by number, so that no content of other rows is moved or sorted.
        ends = rows.groupBy(*PARTITIONS).agg(F.max("row_index").alias("row_index"))
        last_rows = access.latest(
            rows.join(broadcast_if_small(ends), [*PARTITIONS, "row_index"])
            .select(*TABLE, F.col("row_index").alias("last_row"), "found_folder", "content"), TABLE, F.col("last_row"))
        kept = progress.select(*TABLE, "last_row", "found_folder", "content")
        last_rows = merge.last_per_key(kept.unionByName(last_rows), TABLE, "last_row")
        open_runs = access.latest(runs.select(*TABLE, "run_id", "file_name", "first_row", "n_rows"), TABLE, F.col("run_id"))
        state = last_rows.join(open_runs.drop("run_id"), TABLE, "left").withColumn("batch_id", F.lit(batch).cast("bigint"))
        state = state.select("table_name", "file_type", "chain", "last_row", "found_folder", "file_name",
                             "content", "first_row", "n_rows", "batch_id")
        together(self.spark, lambda: store.write_batch(marks, self._path("markers"), batch),
                  lambda: store.write_batch(state, self._path("progress"), batch))

    def ledger(self, kind):
        """ST2: ids of the events pushed so far from scraper or parser logs."""
        known = self._read("ledger", LEDGER)
        return known.where(F.col("kind") == kind).select("source_file", "digest")

    def _load_status(self, folders, batch):
        """New events of the logs in ``folders`` (by kind), in one pass over the files of both kinds.

        A file that both kinds list is read once, and its events go to the tables of both.
        """
        read = {}
        for kind, folder in folders.items():
            listed = files.landing_listing(self.spark, folder, "*.json")
            broken = self.broken_logs().where(F.col("kind") == kind).select("source_file")
            for path in self._fresh_files(listed, kind, batch, broken):
                read.setdefault(path, []).append(kind)
        kinds = sorted({kind for some in read.values() for kind in some})
        for kind in sorted(set(folders) - set(kinds)):
            # An earlier try of this batch may have left something.
            for name in STATUS_OF[kind]:
                store.create_empty(self.spark, self._path(f"status/{name}"), STATUS_DOC, batch)
            for name, schema in (("ledger", LEDGER), ("broken_logs", BROKEN)):
                (self.spark.createDataFrame([], schema).drop("kind", "batch_id").write.mode("overwrite")
                 .option("partitionOverwriteMode", "static").parquet(f"{self._path(name)}/batch_id={batch}/kind={kind}"))
        if not read:
            return
        scratch = f"{self._path('_scratch')}/logs-{batch}"
        logs, broken = status_logs.read_logs(self.spark, sorted(read), scratch, paths=True)
        # One row per file and kind; listings and readers write the scheme of a path differently.
        of_kind = self.spark.createDataFrame([(p, k) for p in sorted(read) for k in read[p]], "path string, kind string")
        of_kind = broadcast_if_small(of_kind.select(names.without_scheme("path").alias("_path"), "kind"))

        def by_kind(rows):
            return rows.withColumn("_path", names.without_scheme("path")).join(of_kind, "_path").drop("_path", "path")

        # A generator's columns are computed once: the document of an event is parsed once for all its fields.
        logs = logs.select("*", F.inline(F.array(F.struct(
            F.from_json("payload", "map<string,string>").alias("_event"), values.identity("payload").alias("_identity")))))
        event = F.col("_event")
        # Older events name chain and type in a composite index only.
        index = names.decode_index(event["index"], ["file_type", "chain", "when_date"])
        events = by_kind(logs.select(
            "path", "source_file", "part", "seq", "payload", event["task_id"].alias("task_id"), event["status"].alias("status"),
            F.coalesce(event["requested_store_enum"], event["chain"], event["scraper"], index["chain"]).alias("chain"),
            F.coalesce(event["requested_file_type"], event["file_type"], F.nullif(index["file_type"], F.lit("")))
            .alias("file_type"),
            F.sha2(F.concat("source_file", F.lit("\u0001"), "_identity"), 256).alias("digest")))
        # Kept, so that the logs are parsed and looked up once for all tables.
        known = self._read("ledger", LEDGER).select("kind", "source_file", "digest")
        with swept(self.spark):
            (status.new_events(events, known, "seq", ["kind"]).write.options(**PACKED).mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy("kind", "part").parquet(f"{scratch}/fresh"))
        fresh = tables.read_table(self.spark, f"{scratch}/fresh", events.schema)
        remove(self.spark, f"{scratch}/parsed")
        # Logs grow, so a broken one is set aside by every load until it can be read.
        broken = by_kind(broken)

        def store_of(kind, name, rows):
            # A folder per kind inside the batch, so that either kind can be rewritten alone.
            (rows.write.options(**PACKED).mode("overwrite").option("partitionOverwriteMode", "static")
             .parquet(f"{self._path(name)}/batch_id={batch}/kind={kind}"))

        def store_part(kind, part, target):
            docs = fresh.where((F.col("kind") == kind) & (F.col("part") == part)).select(
                F.col("digest").alias("index"), "source_file", "task_id", "status", "chain", "file_type", "payload",
                F.lit(batch).cast("bigint").alias("batch_id"))
            store.write_batch(docs.sortWithinPartitions("chain", "file_type"), self._path(f"status/{target}"), batch)

        steps = []
        for kind in kinds:
            steps.append(functools.partial(store_of, kind, "broken_logs", broken.where(F.col("kind") == kind).drop("kind")))
            steps.append(functools.partial(
                store_of, kind, "ledger", fresh.where(F.col("kind") == kind).select("source_file", "digest")))
            steps.extend(functools.partial(store_part, kind, part, target) for part, target in zip(status_logs.PARTS, STATUS_OF[kind]))
        together(self.spark, *steps)
        # The rows of the load may take longer than its logs.
        remove(self.spark, scratch)

    # --- read queries --------------------------------------------------------------------------

    def list_available_chains(self):
        return self.spark.createDataFrame([(c,) for c in sorted(self.chains)], "chain string")

    def list_available_file_types(self):
        return self.spark.createDataFrame([(t,) for t in FILE_TYPES], "file_type string")

    def _file_documents(self):
        """Parser documents with chain, file type, time and file list; chain and type reach the scan."""
        doc = F.from_json("payload", "timestamp string, response struct<files_to_process:array<string>>")
        return self.status("ParserStatus").select(
            "chain", "file_type", values.parse_ts(doc["timestamp"]).alias("ts"),
            doc["response"]["files_to_process"].alias("files"))

    def list_files(self, chain, file_type=None):
        """Files of a chain, optionally of a type."""
        filters.check_domain(self.chains, chain, file_type)
        docs = filters.match_columns(self._file_documents(), chain, file_type)
        return access.explode_files(docs)

    def list_files_with_filters(self, chain, file_type=None, store_number=None, after_extracted_date=None,
                                only_latest=False):
        """Files of a chain by type, store and date (ISO text); ``only_latest`` keeps the newest one."""
        filters.check_domain(self.chains, chain, file_type)
        docs = filters.match_columns(self._file_documents(), chain, file_type)
        if after_extracted_date is not None:
            docs = filters.since(docs, "ts", values.parse_ts(F.lit(after_extracted_date)))
        found = access.explode_files(filters.with_store(docs, store_number), keep=["chain", "ts"])
        if only_latest:
            found = access.latest_file(found, ["chain"])
        return found.select("file_name")

    def _one_file(self, chain, file):
        kind = filters.check_domain(self.chains, chain, file=file, needs_file=True)
        return access.to_row_content(self.rows({"file_type": kind, "chain": chain, "file_name": file}))

    def file_content(self, chain, file):
        """All rows of a file in row order."""
        return self._one_file(chain, file).orderBy("row_index")

    def file_content_paginated(self, chain, file, chunk_size=PAGE_SIZE, offset=0):
        """(rows, one-row metadata) of a page."""
        rows = self._one_file(chain, file)
        return access.page(rows, offset, chunk_size), access.page_meta(rows, offset, chunk_size)

    def file_content_with_cursor(self, chain, file, limit=PAGE_SIZE, cursor=None):
        """(rows, one-row metadata) of the page at a cursor."""
        return self.file_content_paginated(chain, file, limit, access.parse_cursor(cursor))

    def file_content_after(self, chain, file, last_row=None, limit=PAGE_SIZE):
        """Rows after a row index: paging that skips nothing."""
        return access.page_after(self._one_file(chain, file), last_row, limit)

    def _health(self, stamps, as_of, seconds):
        # A total without groups has one row even where there is no stamp.
        fresh = access.freshness(stamps.select(values.parse_ts("at").alias("ts")), [], "ts", values.parse_ts(F.lit(as_of)), seconds)
        return fresh.select("is_updated", values.format_ts("last_update").alias("last_update"))

    def short_term_health(self, as_of, seconds=SHORT_TERM_SECONDS, table="ParserStatus"):
        """Whether a status table got rows in the last hour before ``as_of``; one row."""
        loads = self.status(table).select("batch_id").distinct()
        return self._health(self._stored("commits", COMMITS).join(loads, "batch_id", "left_semi")
                            .withColumnRenamed("as_of", "at"), as_of, seconds)

    def long_term_health(self, as_of, seconds=LONG_TERM_SECONDS):
        """Whether a snapshot was published in the day before ``as_of``; one row."""
        return self._health(self.versions().withColumnRenamed("created_at", "at"), as_of, seconds)

    # --- snapshots -----------------------------------------------------------------------------

    def versions(self):
        """ST7: published versions."""
        return self._stored("versions", VERSIONS)

    def current_version(self):
        """The highest published version, -1 when there is none."""
        return versions.current_version(self.versions()).first()[0]

    def publish(self, as_of):
        """SNK8: write the committed rows and status as the next version; returns it.

        The version row is written last, so a publish that failed is simply run again.
        """
        version = self.current_version() + 1
        events = functools.reduce(lambda a, b: a.unionByName(b), [
            self.status(t).withColumn("table_name", F.lit(t)) for t in sorted(STATUS_TABLES)])
        snapshot.write_snapshot(self.rows(), events, self.root, version)
        text = names.snapshot_message(F.lit(as_of), sorted(self.chains), self.file_types)
        row = self.spark.range(1).select(F.lit(as_of).alias("created_at"), text.alias("message"))
        row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self._path('versions')}/version={version}")
        return version

    def restore(self, version=None, part="data"):
        """SRC10: data or status of a version, for the enabled chains."""
        if version is None:
            version = self.current_version()
        return snapshot.read_snapshot(self.spark, self.root, version, part, list(self.chains))

    def load_version(self, as_of, version=None):
        """SRC10, ST7: the store as a version left it, as the first batch; returns the batch id.

        Rows of the enabled chains and all status events are stored again; marks, open runs and markers come from
        the rows, the ledger from the events. So a load of the same landing folders finds nothing new, and one of
        longer files goes on where the version ended. What the store held before is gone. The batch counts once
        it is committed; one that failed is run again. Rows set aside are in no version: the next load finds them.
        """
        rows, events = self.restore(version), self.restore(version, "status")
        self.restart()
        batch = 0

        def store_rows():
            store.write_rows(rows.select(*STORED_ROW.names), self._path("rows"), batch)
            self._load_progress(self.progress(), batch)

        def store_events(table):
            docs = events.where(F.col("table_name") == table).select(*STATUS_DOC.names)
            store.write_batch(docs.sortWithinPartitions("chain", "file_type"), self._path(f"status/{table}"), batch)

        def store_ledger():
            kind = F.when(F.col("table_name").contains("Scraper"), "scraper").otherwise("parser")
            (events.select("source_file", F.col("index").alias("digest"), kind.alias("kind"))
             .write.options(**PACKED).mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("kind")
             .parquet(f"{self._path('ledger')}/batch_id={batch}"))

        together(self.spark, store_rows, store_ledger, *[functools.partial(store_events, table) for table in STATUS_TABLES])
        commit = self.spark.createDataFrame([(as_of, batch)], COMMITS)
        store.write_batch(commit.coalesce(1), self._path("commits"), batch)
        return batch

    def snapshot_files(self, version=None):
        """SRC8: names of what a version holds: a CSV name per table, the status files, the index."""
        data = self.restore(version).select(names.table_name("file_type", "chain").alias("n")).distinct()
        logs = self.restore(version, "status").select(F.col("source_file").alias("file_name")).distinct()
        index = self.spark.createDataFrame([(versions.INDEX_FILE,)], "file_name string")
        return (data.select(F.concat("n", F.lit(".csv")).alias("file_name")).unionByName(logs).unionByName(index))

    def list_snapshot_files(self, chain=None, extension=None, version=None):
        """SRC8, X11: names in a version by chain and extension."""
        listing = self.snapshot_files(version)
        return listing.where(names.matches_file("file_name", chain, extension))

    def manifest(self, version=None):
        """SNK9: path and description of every status file of a version."""
        logs = self.restore(version, "status").select(
            F.col("source_file").alias("file_name"),
            F.when(F.col("table_name").contains("Parser"), "Parser").otherwise("Scraper").alias("stage")).distinct()
        return versions.manifest(logs)

    def clear_ledger(self):
        """ST6: after a publish the next day starts from empty tables."""
        self.restart()

    # --- checks --------------------------------------------------------------------------------

    def reconcile(self, outputs):
        """JN7: rows of the landing files against stored rows, per table."""
        counts = [files.count_csv_rows(self.spark, paths, columns)
                  for columns, paths in files.landing_groups(self.spark, outputs)]
        source = (functools.reduce(lambda a, b: a.unionByName(b), counts)
                  .groupBy("table_name").agg(F.sum("source_rows").alias("source_rows")))
        stored = self.rows().select(names.table_name("file_type", "chain").alias("table_name"), "row_index")
        return quality.reconcile_counts(source, stored)

    def missing_files(self, version=None):
        """JN8: files a version should list but does not."""
        return catalog.missing_expected(catalog.expected_files(self.registry()), self.snapshot_files(version))

    def task_checks(self, table, start="started", terminal=("completed", "failed"), expected_events=None):
        """Lifecycle of every task of a status table and its global table."""
        docs = self.status(table).unionByName(self.status(f"Global{table}"))
        event = F.from_json("payload", "timestamp string, when string, when_date string")
        timed = docs.withColumn("_e", event).withColumn(
            "ts", values.parse_ts(F.coalesce("_e.timestamp", "_e.when", "_e.when_date")))
        return status.lifecycle(timed, start, list(terminal), expected_events)
