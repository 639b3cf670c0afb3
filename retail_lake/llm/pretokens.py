"""Cut texts into pre-tokens with array operations.

The usual pattern of byte-level vocabularies is a rule on classes of neighbouring characters: a run
of letters, of numbers or of other signs, contractions after an apostrophe, and white space of which
the last space goes to the next word. So the cuts of a whole chunk of texts are found at once from
one class per character. The class table is asked from the tokenizer library itself, whose Unicode
version therefore holds.
"""

import functools
import itertools

import numpy as np

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_APOSTROPHE = ord("'")
# The contractions of the pattern, by length of what follows the apostrophe.
_SHORT = np.array([ord(c) for c in "stmd"], dtype=np.uint32)
_LONG = ("re", "ve", "ll")


@functools.lru_cache(maxsize=1)
def class_table():
    """One class per code point, as the tokenizer libraries' regular expressions see it."""
    import tiktoken

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(found.encode_ordinary(text)).decode("utf-8")
        table[np.frombuffer(members.encode("utf-32-le"), dtype=np.uint32)] = kind
    return table


def _joined(texts):
    """Code points of all texts, the place where each text starts, and the joined UTF-8 bytes."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    starts = np.fromiter(itertools.accumulate((len(t) for t in texts), initial=0), dtype=np.int64,
                         count=len(texts) + 1)
    return points, starts, whole.encode("utf-8")


def _widths(points):
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def _cuts(points, starts, word_form):
    """True where a pre-token begins, or where dropped white space begins (``word_form``)."""
    n = len(points)
    kind = class_table()[points]
    first = np.zeros(n + 1, dtype=bool)  # a text starts here; so it does behind the end
    first[starts] = True
    before, first_here, first_next = np.empty(n, dtype=np.uint8), first[:n], first[1:]
    before[0] = SPACE
    before[1:] = kind[:-1]
    cut = (kind != before) | first_here
    space = kind == SPACE
    follows = np.zeros(n, dtype=bool)  # a sign of the same text comes next
    follows[:-1] = ~space[1:]
    follows &= ~first_next
    if word_form:
        cut |= kind == NUMBER
    else:
        # The last white space before a word stands alone or, if a plain space, leads the word.
        cut |= space & follows
        leads = space & follows & (points == 32)
        cut[1:][leads[:-1]] = False
    mark = np.flatnonzero((points == _APOSTROPHE) & cut & follows)
    if len(mark):
        after = points[mark + 1]
        short = np.isin(after, _SHORT)
        room = mark + 2 < n
        third = np.where(room, points[np.minimum(mark + 2, n - 1)], 0)
        same = room & ~first_here[np.minimum(mark + 2, n - 1)]
        long = np.zeros(len(mark), dtype=bool)
        for a, b in _LONG:
            long |= same & (after == ord(a)) & (third == ord(b))
        cut[mark[short | long] + 1] = False
        for at in (mark[short] + 2, mark[long] + 3):
            cut[at[at < n]] = True
    return cut, kind


def split(texts, word_form=False):
    """(pieces as bytes, number of pieces up to each text): pre-tokens of every text in order.

    With ``word_form`` numbers are single and white space is dropped, as in vocabularies with word
    ends. Texts never share a pre-token; an empty text has none.
    """
    points, starts, data = _joined(texts)
    if not len(points):
        return [], np.zeros(len(texts) + 1, dtype=np.int64)
    cut, kind = _cuts(points, starts, word_form)
    at = np.flatnonzero(cut)
    place = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(_widths(points), out=place[1:])
    bounds = np.searchsorted(at, starts)
    begin, end = place[at], np.append(place[at[1:]], len(data))
    if word_form:
        kept = kind[at] != SPACE
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        begin, end = begin[kept], end[kept]
    return [data[a:b] for a, b in zip(begin.tolist(), end.tolist())], bounds
