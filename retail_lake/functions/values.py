"""Functions over values, timestamps and documents."""

from pyspark.sql import functions as F

from retail_lake.schemas import CIVIL_ZONE, TIMESTAMP_FORMAT


def _text(col):
    return F.col(col) if isinstance(col, str) else col


def digest(source, cols):
    """sha256 of the source file and the row as JSON with sorted keys; nulls keep their key.

    ``cols`` maps field names to columns. Cast numbers to strings or decimals first.
    """
    doc = F.to_json(F.struct(*[cols[k].alias(k) for k in sorted(cols)]),
                    {"ignoreNullFields": "false"})
    return F.sha2(F.concat(_text(source), F.lit("\u0001"), doc), 256)


def int_guard(col):
    """struct(int_value, text_value): integers beyond 64 bits stay as text."""
    text = F.trim(_text(col))
    number = F.when(F.rlike(text, F.lit(r"^[+-]?\d+$")), text).try_cast("bigint")
    return F.struct(number.alias("int_value"),
                    F.when(number.isNull(), _text(col)).alias("text_value"))


# Tokens of JSON: a string, a number, a word, a mark. Strings are matched without backtracking, whatever their length.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
_JSON_TOKEN = rf"(?s){_STRING}|{_NUMBER}|true|false|null|[{{}}\[\]:,]"
# The same, and what stands between strings and numbers as it is.
_ANY_TOKEN = rf'(?s){_STRING}|{_NUMBER}|[^"0-9-]++|.'
_BODY = r'[^"\\]*+(?:\\.[^"\\]*+)*+"'
# What stands before a number, strings whole, and the number.
_NUMBERS = rf'(?s)\G((?:[^"0-9-]++|{_STRING}|"|-(?![0-9]))*+)({_NUMBER})'
# An object of plain members: no escape, white space or control character, names of word characters, at most one level of
# objects below, none in arrays. Groups are matched without backtracking; a loop over one class of single characters is
# greedy, which runs much faster and can end in one place only. Names sort as the texts of their members do.
_PLAIN_NAME = r'"\w+":'
_PLAIN_STRING = '"[^"' + "".join(rf"\x{c:02x}" for c in (*range(32), ord("\\"))) + ']*"'
_PLAIN_CELL = rf"(?:{_PLAIN_STRING}|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)"
_PLAIN_VALUE = rf"(?:{_PLAIN_CELL}|\[(?:{_PLAIN_CELL}(?:,{_PLAIN_CELL})*+)?+\])"
_FLAT_MEMBER = f"{_PLAIN_NAME}{_PLAIN_VALUE}"
_FLAT = rf"\{{(?:{_FLAT_MEMBER}(?:,{_FLAT_MEMBER})*+)?+\}}"
_PLAIN_MEMBER = f"{_PLAIN_NAME}(?:{_PLAIN_VALUE}|{_FLAT})"
_PLAIN = rf"\A\{{(?:{_PLAIN_MEMBER}(?:,{_PLAIN_MEMBER})*+)?+\}}\z"
# A marked string or number of canonical JSON.
_MARKED = rf'(?s)(")s({_BODY})|"n([^"]*+)"'


def _is_string(token):
    return token.startswith('"') & (F.length(token) > 1)


def once(value, use):
    """``use(value)`` with the value computed once, however often it is used: an optimizer that merges projections
    would write out its expression at each place."""
    return F.transform(F.array(value), use)[0]


def _name(member):
    return F.substring_index(member, ":", 1)


def _sorted_members(text, member, form=None):
    """An object with its plain members in order, each as ``form`` gives it; null if a name is doubled or a form null."""
    def joined(members):
        formed = members if form is None else F.transform(members, form)
        pairs = once(formed, lambda found: F.when(
            F.size(F.array_compact(found)) == F.size(members), F.array_join(F.sort_array(found), ",")))
        return F.when(F.size(F.array_distinct(F.transform(members, _name))) == F.size(members),
                      F.concat(F.lit("{"), pairs, F.lit("}")))

    return once(F.regexp_extract_all(text, F.lit(member), F.lit(0)), joined)


def _plain_document(text):
    """Canonical JSON of an object of plain members: they are sorted as they stand, nothing is parsed. Null for others."""
    def flat(member):
        below = F.substr(member, F.length(_name(member)) + 2)
        return F.when(below.startswith("{"), F.concat(_name(member), F.lit(":"), _sorted_members(below, _FLAT_MEMBER))).otherwise(member)

    return F.when(F.rlike(text, F.lit(_PLAIN)), _sorted_members(text, _PLAIN_MEMBER, flat))


def _sorted_document(text):
    """Canonical JSON by the variant parser, which sorts keys; null where it refuses the text.

    The parser would round numbers, so they pass as strings, told from real ones by a first letter. In
    brackets nothing may stand behind the document.
    """
    strings = F.regexp_replace(text, F.lit(rf'(?s)"({_BODY})'), F.lit('"s$1'))
    marked = F.regexp_replace(strings, F.lit(_NUMBERS), F.lit('$1"n$2"'))

    def plain(parsed):
        unmarked = F.regexp_replace(parsed, F.lit(_MARKED), F.lit("$1$2$3"))
        # An array of one member, or the text was none or several documents.
        return F.when(F.json_array_length(parsed) == 1, once(unmarked, lambda t: F.substr(t, F.lit(2), F.length(t) - 2)))

    return once(F.to_json(F.try_parse_json(F.concat(F.lit("["), marked, F.lit("]")))), plain)


_FRAME = "struct<is_object:boolean,keys:array<string>,items:array<string>>"


def _frame(is_object, keys, items):
    return F.struct(is_object.alias("is_object"), keys.alias("keys"), items.alias("items")).cast(_FRAME)


def _closed(frame):
    """Canonical text of a frame: keys in order, of doubled ones the last."""
    names, items = frame["keys"], frame["items"]
    pairs = F.transform(F.array_sort(F.array_distinct(names)), lambda k: F.concat(
        k, F.lit(":"), F.element_at(F.filter(items, lambda _, i: F.get(names, i) == k), -1)))
    return F.when(frame["is_object"], F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise(
        F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))


def _folded_document(text):
    """Canonical JSON by a fold over the tokens with a stack of open objects and arrays: for doubled keys."""
    none = F.array().cast("array<string>")
    tokens = F.transform(F.regexp_extract_all(text, F.lit(_JSON_TOKEN), F.lit(0)),
                         lambda t: F.when(_is_string(t), F.to_json(F.try_parse_json(t))).otherwise(t))
    start = F.array(_frame(F.lit(False), none, none)).cast(f"array<{_FRAME}>")

    def step(stack, t):
        top, below = F.element_at(stack, -1), F.slice(stack, 1, F.size(stack) - 1)
        closed, parent = _closed(top), F.get(stack, F.size(stack) - 2)
        lower = F.slice(stack, 1, F.greatest(F.size(stack) - 2, F.lit(0)))

        def on(frames, frame):
            return F.concat(frames, F.array(frame).cast(f"array<{_FRAME}>"))

        named = _frame(top["is_object"], F.concat(top["keys"], F.array(F.element_at(top["items"], -1))),
                       F.slice(top["items"], 1, F.size(top["items"]) - 1))
        return (F.when(t.isin("{", "["), on(stack, _frame(t == "{", none, none)))
                .when(t.isin("}", "]"), on(lower, _frame(parent["is_object"], parent["keys"], F.concat(parent["items"], F.array(closed)))))
                .when(t == ":", on(below, named)).when(t == ",", stack)
                .otherwise(on(below, _frame(top["is_object"], top["keys"], F.concat(top["items"], F.array(t))))))

    folded = F.aggregate(tokens, start, lambda stack, t: step(stack, t).cast(f"array<{_FRAME}>"))
    # Only texts that are JSON, and one document, are folded.
    whole = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.when(whole & F.rlike(F.regexp_replace(text, _JSON_TOKEN, ""), F.lit(r"\A\s*\z")), folded[0]["items"][0])


def canonical_json(doc):
    """A JSON document with its keys sorted at every level; null where the text is not one JSON document.

    Any JSON value has a form: objects, arrays, text, numbers, ``true`` and ``null``. Numbers stay as written,
    so ``1``, ``1.0`` and ``"1"`` are three documents and integers of any length are told apart; order of keys,
    white space and escapes make no difference; of doubled keys the last one counts.
    """
    text = _text(doc)
    return F.coalesce(_plain_document(text), _sorted_document(text), _folded_document(text))


def identity(doc):
    """What two documents have in common if, and only if, they are the same: never null.

    The canonical form of JSON, else the text as it is; a first letter tells the two apart.
    """
    text = _text(doc)
    return F.coalesce(F.concat(F.lit("j"), canonical_json(text)), F.concat(F.lit("t"), text), F.lit("n"))


def guard_document(doc):
    """X7 on a JSON document: integers beyond 64 bits become text at every level, all else stays.

    The result is the canonical form of the document; null where it is no JSON.
    """
    tokens = F.regexp_extract_all(canonical_json(doc), F.lit(_ANY_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(
        F.rlike(t, F.lit("^-?[0-9]+$")) & t.try_cast("bigint").isNull(), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t)), "")


def coerce_store(col):
    """A store number is text."""
    return _text(col).cast("string")


def coerce_limit(col):
    """An empty limit means -1; text that is no number is null."""
    text = _text(col).cast("string")
    return F.when(text == "", F.lit(-1).cast("bigint")).otherwise(text.try_cast("bigint"))


def coerce_links(col):
    """Links given as text: empty means no links, else a JSON array."""
    text = _text(col)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.from_json(text, "array<string>"))


def parse_ts(col, zone=None):
    """ISO text (``T``, ``Z`` or an offset) or ``yyyy-MM-dd HH:mm:ss`` to a UTC TIMESTAMP_NTZ.

    Text without an offset is taken to be in ``zone``, UTC when none is given. Null if unreadable.
    """
    text = F.trim(_text(col))
    offset = F.regexp_extract(text, r"([+-]\d{2}:?\d{2}|Z)$", 1)
    has_time = F.length(text) > 10
    wall = F.when(has_time & (offset != ""), F.regexp_replace(text, r"([+-]\d{2}:?\d{2}|Z)$", "")) \
        .otherwise(text).try_cast("timestamp_ntz")
    sign = F.when(offset.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = sign * (F.substring(digits, 1, 2).try_cast("int") * 60
                      + F.substring(digits, 3, 2).try_cast("int"))
    shifted = wall - F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    local = wall if zone is None else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return (F.when(has_time & offset.isin("Z"), wall)
            .when(has_time & (offset != ""), shifted)
            .otherwise(local))


def parse_civil(col):
    """Civil time of the price sites to UTC."""
    return parse_ts(col, CIVIL_ZONE)


def format_ts(col):
    """Timestamps are written as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_text(col), TIMESTAMP_FORMAT)


def backfill(as_of, hours=0):
    """The clock of a run, ``hours`` before ``as_of``."""
    return _text(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def micros(col):
    """Microseconds since 1970 of a TIMESTAMP_NTZ, whatever the session time zone is."""
    ts = _text(col)
    return (F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
            + F.hour(ts).cast("bigint") * 3_600_000_000
            + F.minute(ts).cast("bigint") * 60_000_000
            + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))


def encode_doc(cols):
    """A document as JSON text; ``cols`` are columns or names."""
    return F.to_json(F.struct(*[_text(c) for c in cols]), {"ignoreNullFields": "false"})


def decode_doc(col, schema):
    """struct(doc, raw): the parsed document, or the raw text where it is no JSON."""
    text = _text(col)
    valid = F.try_parse_json(text).isNotNull()
    return F.struct(F.when(valid, F.from_json(text, schema)).alias("doc"),
                    F.when(~valid, text).alias("raw"))


def error_label(error, loaded):
    """The error of a failed file, ``empty file`` if it was not loaded, else ``unknown``."""
    return F.coalesce(_text(error),
                      F.when(F.coalesce(_text(loaded), F.lit(False)), F.lit("unknown"))
                      .otherwise(F.lit("empty file")))


def is_ok(*flags):
    """true when every flag is set; a missing flag counts as a failure."""
    ok = F.lit(True)
    for flag in flags:
        ok = ok & F.coalesce(_text(flag), F.lit(False))
    return ok
