"""Functions over file, table and index names."""

import re

from pyspark.sql import functions as F

from retail_lake.schemas import FILE_TYPES, TYPE_BY_PREFIX

# The suffixes removed when files of two stages are compared; the scraping logs
# keep ``.aspx``.
STRIPPED = (".aspx", ".xml", ".gz")
SCRAPED = (".gz", ".xml")

# Fixed pattern of a dump name: kind, 13-digit chain id, optional store, date, optional time.
NAME_PATTERN = (
    r"(?i)^(stores?|pricefull|promofull|price|promo)(?:null)?(\d{13})-(?:(\d{1,5})-)?"
    r"(\d{4})-?(\d{2})-?(\d{2})(?:-?(\d{2})(\d{2})(\d{2})?)?(?:\D.*)?$"
)


def _text(col):
    return F.col(col) if isinstance(col, str) else col


def strip_ext(col, suffixes=STRIPPED):
    """Remove the suffixes wherever they occur in the name."""
    out = _text(col)
    for suffix in suffixes:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    return out


def file_type(col):
    """File type of a dump name, null when no type matches; ``NULL`` inside it is ignored."""
    name = F.lower(F.replace(_text(col), F.lit("NULL"), F.lit("")))
    out = F.lit(None).cast("string")
    for prefix in sorted(TYPE_BY_PREFIX, key=len):
        out = F.when(name.startswith(prefix), F.lit(TYPE_BY_PREFIX[prefix])).otherwise(out)
    return out


def file_type_of(name):
    """X2 for one name on the driver (argument checks)."""
    text = name.replace("NULL", "").lower()
    matching = [p for p in TYPE_BY_PREFIX if text.startswith(p)]
    return TYPE_BY_PREFIX[max(matching, key=len)] if matching else None


def name_parts(col):
    """struct(chain_id, store_number, file_date, file_time) of a dump name; null parts if absent."""
    text = _text(col)

    def part(i):
        return F.nullif(F.regexp_extract(text, NAME_PATTERN, i), F.lit(""))

    return F.struct(
        part(2).alias("chain_id"),
        part(3).alias("store_number"),
        F.nullif(F.concat_ws("-", part(4), part(5), part(6)), F.lit("")).alias("file_date"),
        F.nullif(F.concat_ws(":", part(7), part(8), part(9)), F.lit("")).alias("file_time"),
    )


def table_name(file_type_col, chain_col):
    """``lower(file_type)_lower(chain)``."""
    return F.concat_ws("_", F.lower(_text(file_type_col)), F.lower(_text(chain_col)))


def read_from():
    """Path of the file a row was read from, as the readers take it: Spark's column has it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def without_scheme(path):
    """A path without its scheme, which listings write ``file:/`` and readers ``file:///``."""
    return F.regexp_replace(_text(path), r"\A[^/]*/+", "/")


def base_name(path):
    """Last component of a path."""
    return F.element_at(F.split(_text(path), "/"), -1)


def table_of_path(path):
    """Table of a landing file: its base name up to the first dot."""
    return F.substring_index(base_name(path), ".", 1)


def split_table_name(col):
    """X4 read back: struct(file_type, chain) of a table name; null when no file type fits."""
    text = _text(col)
    kind = F.lit(None).cast("string")
    for name in sorted(FILE_TYPES, key=len):
        kind = F.when(text.startswith(name.lower() + "_"), F.lit(name)).otherwise(kind)
    return F.struct(kind.alias("file_type"),
                    F.substr(text, F.length(kind) + 2).alias("chain"))


def encode_index(*cols):
    """Composite index of a status document, parts joined by ``@``."""
    return F.concat_ws("@", *[_text(c) for c in cols])


def decode_index(col, names):
    """Struct of the named parts of a composite index."""
    parts = F.split(_text(col), "@")
    return F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def file_glob(chain=None, extension=None):
    """X11 as a glob for ``pathGlobFilter``."""
    stem = f"*{chain.lower()}" if chain else "*"
    return f"{stem}.{extension}" if extension else stem


def matches_file(col, chain=None, extension=None):
    """X11 as a predicate: the whole name matches, the chain is taken literally."""
    tail = re.escape(chain.lower()) if chain else ""
    if extension:
        tail += re.escape("." + extension)
    elif not chain:
        return _text(col).isNotNull()
    return F.rlike(_text(col), F.lit(f"^.*{tail}$"))


def snapshot_message(as_of, chains=None, types=None):
    """Message of a snapshot; ``ALL`` where no list is given."""
    def listed(names):
        return F.lit(",".join(names) if names else "ALL")

    return F.format_string("Update-Time: %s, Scrapers:%s, Files:%s",
                           _text(as_of), listed(chains), listed(types))
