"""Quality rules, lines first: judge each line, remove what fails, then judge what is left.

A line fails if it is

* noise: of its characters without white space more than 10 % are signs such as ``# * $ % & | !``
  (prose signs like full stop, comma and quotes do not count),
* navigation: at least 3 separators (``|``, ``>``) and a separator for every 4 words at least, or
  nothing but menu words,
* boilerplate: it holds a fixed phrase of legal notices, cookie banners and sign-up boxes.

A document is kept if the base rules hold (20 words, no more than 30 % of the words in repeated
8-word windows) and the removed lines hold at most half of its characters in words.

Defined cases: a null or empty text has no words and fails the base rules; a text without line break
is one line; repeated rows give repeated results; only doc_id and text are read.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from retail_lake.llm import batches

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
NOISE_PERCENT = 10
LOSS_PERCENT = 50

# The word lists of the line rules.
MENU_WORDS = ("home", "menu", "login", "logout", "register", "next", "previous", "search", "contact", "sitemap", "back", "top",
              "share", "print", "skip", "close")
PHRASES = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "accept cookies",
           "enable javascript", "click here", "sign up for", "subscribe to our", "lorem ipsum")
# Signs that make a line noise, counted signs, separators.
NOISE_SIGNS = "#*$%&|<>!=_^~{}[]\\@+"
COUNTED_SIGNS = "#*$%&|<>"
SEPARATORS = "|>"

_WHITE = bytes([0x20, *range(0x09, 0x0E)])
_TAILS = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
_PHRASES = re.compile(b"|".join(re.escape(p.encode()) for p in PHRASES))
_MENU = frozenset(w.encode() for w in MENU_WORDS)


def _without(data, signs):
    return len(data) - len(data.translate(None, signs))


def line_fails(line):
    """True if the line (bytes) breaks one of the line rules; the caller knows it has a word."""
    chars = len(line.translate(None, _WHITE + _TAILS))
    if 100 * _without(line, NOISE_SIGNS.encode()) > NOISE_PERCENT * chars:
        return True
    words = len(line.split())
    separators = _without(line, SEPARATORS.encode())
    if separators >= 3 and 4 * separators >= words:
        return True
    low = line.lower()
    if _PHRASES.search(low):
        return True
    return all(w in _MENU for w in low.split())


def repeated_words(words):
    """Number of words inside 8-word windows that occur at least twice, given the list of words."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.uint64, count=len(words))
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n] + np.uint64(1)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    first = {}  # windows with equal mixes are compared word by word
    found = np.zeros(n, dtype=bool)
    for i in np.flatnonzero(twice).tolist():
        j = first.setdefault(ids[i:i + WINDOW].tobytes(), i)
        if j != i:
            found[i] = found[j] = True
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(found)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def judge(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lines removed,
    characters removed) of one text in UTF-8."""
    words = text.split()
    word_chars = len(text.translate(None, _WHITE + _TAILS))
    repeats = removed = gone = lost = 0
    seen = set()
    for line in text.split(b"\n"):
        if not line.strip(_WHITE):
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        if line_fails(line):
            removed += 1
            gone += len(line.translate(None, _WHITE + _TAILS))
    lost = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * lost > REPEAT_PERCENT * len(words)
    return (len(words), word_chars, _without(text, COUNTED_SIGNS.encode()), repeats, lost, failed,
            not failed and 100 * gone <= LOSS_PERCENT * word_chars, removed, gone)


def clean_text(text):
    """The text (bytes) without its failing lines; lines without a word stay."""
    return b"\n".join(x for x in text.split(b"\n") if not x.strip(_WHITE) or not line_fails(x))


COLUMNS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, kept boolean, n_removed_lines bigint, removed_chars bigint")


def quality_rules(docs, with_text=False):
    """Verdict and figures of every document; ``with_text`` adds the cleaned text."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
              "n_removed_lines", "removed_chars")
    fields = [("doc_id", pa.int64()), *[(c, pa.bool_() if c in ("base_failed", "kept") else pa.int64()) for c in counts]]
    schema = pa.schema(fields + [("clean_text", pa.string())] * with_text)

    def run(parts):
        for part in batches.chunks(parts, "text"):
            texts = [t or b"" for t in part.column("text").to_pylist()]
            columns = [part.column("doc_id"), *(list(c) for c in zip(*map(judge, texts)))]
            if with_text:
                columns.append([clean_text(t).decode("utf-8", "replace") for t in texts])
            yield batches.records(columns, schema)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary").alias("text"))
    return batches.map_arrow(rows, run, f"doc_id bigint, {COLUMNS}" + ", clean_text string" * with_text)


# DuckDB: the same rules over unnested lines and windows.
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
windows AS (
  SELECT row, i, words[i:i + {WINDOW - 1}] AS piece
  FROM (SELECT row, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM worded)),
twice AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, piece) > 1),
covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range({WINDOW})) AS k) GROUP BY row),
lines AS (
  SELECT row, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
         regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS words,
         length(regexp_replace(line, '[^#*$%&|<>!=_^~{{}}\[\]\\@+]', '', 'g')) AS noise,
         length(regexp_replace(line, '[^|>]', '', 'g')) AS bars
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT row, line, chars,
         100 * noise > {NOISE_PERCENT} * chars OR (bars >= 3 AND 4 * bars >= len(words))
         OR regexp_matches(lower(line), '{'|'.join(PHRASES)}')
         OR len(list_filter(words, lambda x: x NOT IN ({', '.join(repr(w) for w in MENU_WORDS)}))) = 0 AS failing
  FROM lines),
by_row AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (failing) AS n_removed_lines,
         coalesce(sum(chars) FILTER (failing), 0) AS removed_chars
  FROM judged GROUP BY row),
counted AS (
  SELECT w.row, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_removed_lines, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars
  FROM worded w LEFT JOIN by_row USING (row) LEFT JOIN covered c ON w.row = c.row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)
       AND 100 * removed_chars <= {LOSS_PERCENT} * word_chars AS kept, n_removed_lines, removed_chars
FROM counted
"""
