"""Table schemas and the fixed vocabularies of the price-file model."""

from pyspark.sql import types as T

# File types and the file-name prefix of each; longer prefixes are tried first.
FILE_TYPES = ("STORE_FILE", "PRICE_FILE", "PROMO_FILE", "PRICE_FULL_FILE", "PROMO_FULL_FILE")
TYPE_BY_PREFIX = {
    "pricefull": "PRICE_FULL_FILE",
    "promofull": "PROMO_FULL_FILE",
    "price": "PRICE_FILE",
    "promo": "PROMO_FILE",
    "store": "STORE_FILE",
}

# Status tables and the key column of each.
STATUS_TABLES = {
    "ParserStatus": "index",
    "GlobalParserStatus": "index",
    "ScraperStatus": "index",
    "GlobalScraperStatus": "index",
}

# Limits of the read API.
PAGE_SIZE = 100
SHORT_TERM_SECONDS = 60 * 60
DEFAULT_SECONDS = 3 * 60 * 60
LONG_TERM_SECONDS = 24 * 60 * 60
LOSS_LIMIT = 0.02

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
CIVIL_ZONE = "Asia/Jerusalem"

# CSV cells that count as missing (the defaults of the CSV reader of pandas).
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

KEY_COLUMNS = ("row_index", "found_folder", "file_name")

DATA_ROW = T.StructType([
    T.StructField("row_index", T.LongType()),
    T.StructField("found_folder", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("content", T.MapType(T.StringType(), T.StringType())),
])

# Rows of every (file type, chain) live in one partitioned table.
STORED_ROW = T.StructType([
    *DATA_ROW.fields,
    T.StructField("file_type", T.StringType()),
    T.StructField("chain", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

MARKER = T.StructType([
    T.StructField("file_complete", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("total_expected_records", T.LongType()),
])

STORED_MARKER = T.StructType([
    *MARKER.fields,
    T.StructField("first_row", T.LongType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("chain", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

STATUS_DOC = T.StructType([
    T.StructField("index", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("task_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("chain", T.StringType()),
    T.StructField("file_type", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

PROGRESS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("last_row", T.LongType()),
])

LEDGER = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("digest", T.StringType()),
])

VERSIONS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("created_at", T.StringType()),
])

# Field names of the status documents, as they are written in the data.
EXECUTION_LOG = T.StructType([
    T.StructField("loaded", T.BooleanType()),
    T.StructField("succusfull", T.BooleanType()),
    T.StructField("detected_num_rows", T.LongType()),
    T.StructField("store_folder", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("prefix_file_name", T.StringType()),
    T.StructField("extracted_store_number", T.StringType()),
    T.StructField("extracted_chain_id", T.StringType()),
    T.StructField("extracted_date", T.StringType()),
    T.StructField("detected_filetype", T.StringType()),
    T.StructField("size", T.StringType()),
    T.StructField("is_expected_to_have_records", T.BooleanType()),
    T.StructField("error", T.StringType()),
])

PARSER_STATUS = T.StructType([
    T.StructField("index", T.StringType()),
    T.StructField("when_date", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("requested_limit", T.StringType()),
    T.StructField("requested_store_enum", T.StringType()),
    T.StructField("requested_file_type", T.StringType()),
    T.StructField("scaned_data_folder", T.StringType()),
    T.StructField("output_folder", T.StringType()),
    T.StructField("status", T.BooleanType()),
    T.StructField("response", T.StructType([
        T.StructField("status", T.BooleanType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("files_types", T.StringType()),
        T.StructField("processed_files", T.BooleanType()),
        T.StructField("execution_errors", T.BooleanType()),
        T.StructField("file_was_created", T.BooleanType()),
        T.StructField("file_created_path", T.StringType()),
        T.StructField("files_to_process", T.ArrayType(T.StringType())),
        T.StructField("execution_log", T.ArrayType(EXECUTION_LOG)),
    ])),
    T.StructField("file_name", T.StringType()),
])

DOWNLOAD_RESULT = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("downloaded", T.BooleanType()),
    T.StructField("extract_succefully", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("restart_and_retry", T.BooleanType()),
])

# The six payload shapes of a scraper status share one nullable struct; `status` tells them apart.
SCRAPER_STATUS = T.StructType([
    T.StructField("index", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("when", T.StringType()),
    T.StructField("status_data", T.StructType([
        T.StructField("limit", T.LongType()),
        T.StructField("files_requested", T.ArrayType(T.StringType())),
        T.StructField("store_id", T.StringType()),
        T.StructField("files_names_to_scrape", T.ArrayType(T.StringType())),
        T.StructField("when_date", T.StringType()),
        T.StructField("filter_nul", T.BooleanType()),
        T.StructField("filter_zero", T.BooleanType()),
        T.StructField("suppress_exception", T.BooleanType()),
        T.StructField("file_name_collected_from_site", T.ArrayType(T.StringType())),
        T.StructField("links_collected_from_site", T.ArrayType(T.StringType())),
        T.StructField("results", T.ArrayType(DOWNLOAD_RESULT)),
        T.StructField("folder_size", T.StructType([
            T.StructField("size", T.DoubleType()),
            T.StructField("unit", T.StringType()),
            T.StructField("folder", T.StringType()),
            T.StructField("folder_content", T.ArrayType(T.StringType())),
        ])),
        T.StructField("completed_successfully", T.BooleanType()),
        T.StructField("execption", T.StringType()),
        T.StructField("traceback", T.StringType()),
        T.StructField("download_urls", T.ArrayType(T.StringType())),
        T.StructField("file_names", T.ArrayType(T.StringType())),
        T.StructField("files", T.ArrayType(T.StringType())),
    ])),
])
