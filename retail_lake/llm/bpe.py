"""Byte pair encoding of many strings at once, in padded numpy matrices.

Strings of like length share a matrix with one symbol per cell. In each round every row merges its
leftmost pair of least rank, found by ``argmin``; the rest of the row moves up by one cell, and only
the two pairs beside the new symbol are looked up again. Rows without a pair left are taken out.
Pair ranks come from an open-addressing hash table in flat arrays.

A string of over ``LONG`` symbols would take one round per merge over the whole row, so it goes
through a heap instead; the order of merges, and so the result, is the same.
"""

import base64
import functools
import heapq
import itertools
import json
import struct

import numpy as np

LONG = 256
NONE = np.int32(2**31 - 1)
_WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, LONG)
_CELLS = 1 << 17
_ID = struct.Struct("<I")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of a pair of symbols by hashing; -1 stands for no merge."""

    def __init__(self, left, right, ranks):
        keys = (np.asarray(left, dtype=np.uint64) << np.uint64(32)) | np.asarray(right, dtype=np.uint64)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, 2**64 - 1, dtype=np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, dtype=np.int32)
        ranks, slots, left = np.asarray(ranks, dtype=np.int32), self._slots(keys), np.arange(len(keys))
        while len(left):
            at = slots[left]
            free = self.keys[at] == np.uint64(2**64 - 1)
            self.keys[at[free]] = keys[left[free]]  # of several for one slot the last one stays
            done = self.keys[at] == keys[left]
            self.ranks[at[done]] = ranks[left[done]]
            left = left[~done]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys):
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left, right):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2**64 - 1))]
        return out


class Merges:
    """A vocabulary's merges: first symbols of bytes, pair ranks, and the symbol each rank makes."""

    def __init__(self, first, pairs, ranks, made, tokens, last=None, whole=None):
        self.first = np.asarray(first, dtype=np.int32)  # symbol of a byte
        self.last = None if last is None else np.asarray(last, dtype=np.int32)  # of a string's last byte
        self.table = PairTable([a for a, _ in pairs], [b for _, b in pairs], ranks)
        self.made = np.asarray(made, dtype=np.int32)  # by rank
        self.tokens = tokens  # bytes by id
        self.whole = whole or {}  # strings that are one id whatever the merges say
        self._pairs = np.array([(a, b, r) for (a, b), r in zip(pairs, ranks)], dtype=np.int32).reshape(-1, 3)

    @functools.cached_property
    def plain(self):
        """Ranks by pair for the heap; made when the first long string comes."""
        return {(a, b): r for a, b, r in self._pairs.tolist()}

    def encode(self, strings):
        """Ids of each byte string as little-endian 32-bit integers, in a list of bytes."""
        whole = self.whole
        out = [whole.get(s) for s in strings] if whole else [None] * len(strings)
        lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        waiting = np.array([i for i, x in enumerate(out) if x is None], dtype=np.int64)
        if whole:
            out = [x if x is None else _ID.pack(x) for x in out]
        waiting = waiting[np.argsort(lengths[waiting], kind="stable")]
        ends = np.searchsorted(lengths[waiting], (0, *_WIDTHS), side="right").tolist()
        for i in waiting[:ends[0]].tolist():
            out[i] = b""
        for width, begin, end in zip(_WIDTHS, ends, ends[1:]):
            rows = max(1, _CELLS // width)
            for at in range(begin, end, rows):
                part = waiting[at:min(end, at + rows)].tolist()
                for i, ids in zip(part, self._matrix([strings[i] for i in part], width)):
                    out[i] = ids
        for i in waiting[ends[-1]:].tolist():
            out[i] = np.array(self._heap(strings[i]), dtype="<u4").tobytes()
        return out

    def _symbols(self, data, ends):
        symbols = self.first[data]
        if self.last is not None:
            symbols[ends - 1] = self.last[data[ends - 1]]
        return symbols

    def _matrix(self, strings, width):
        n = len(strings)
        lengths = np.fromiter(map(len, strings), dtype=np.int64, count=n)
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        columns = np.arange(width)
        cells = np.full((n, width + 1), -1, dtype=np.int32)
        cells[:, :width][columns < lengths[:, None]] = self._symbols(data, ends)
        ranks = np.full((n, width), NONE, dtype=np.int32)
        pair = (columns + 1) < lengths[:, None]
        ranks[pair] = self.table.lookup(cells[:, :-1][pair], cells[:, 1:][pair])

        ready, sizes = np.empty((n, width), dtype="<u4"), np.empty(n, dtype=np.int64)
        rows, counts = np.arange(n), lengths
        while len(rows):
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            best = ranks[line, at]
            going = best != NONE
            if not going.all():
                done = ~going
                ready[rows[done]], sizes[rows[done]] = cells[done, :width], counts[done]
                rows, cells, ranks, counts = rows[going], cells[going], ranks[going], counts[going]
                at, best, line = at[going], best[going], np.arange(len(rows))
                if not len(rows):
                    break
            cells[line, at] = self.made[best]
            moved = columns > at[:, None]  # compaction: the row moves up behind the merge
            cells[:, :-1] = np.where(moved, cells[:, 1:], cells[:, :-1])
            ranks[:, :-1] = np.where(moved[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            counts = counts - 1
            has = at + 1 < counts
            ranks[line, at] = NONE
            r = line[has]
            ranks[r, at[has]] = self.table.lookup(cells[r, at[has]], cells[r, at[has] + 1])
            has = at > 0
            r = line[has]
            ranks[r, at[has] - 1] = self.table.lookup(cells[r, at[has] - 1], cells[r, at[has]])
        flat = ready[columns < sizes[:, None]].tobytes()
        upto = (4 * np.cumsum(sizes)).tolist()
        return [flat[a:b] for a, b in zip([0, *upto], upto)]

    def _heap(self, string):
        """Merges of one long string: least rank first, then leftmost."""
        data = np.frombuffer(string, dtype=np.uint8)
        symbols = self._symbols(data, np.array([len(data)])).tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        plain, made = self.plain, self.made
        heap = [(r, i, a, b) for i, (a, b) in enumerate(itertools.pairwise(symbols))
                if (r := plain.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = int(made[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := plain.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (r := plain.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return [s for s in symbols if s >= 0]


def from_ranks(content):
    """Merges of a rank file: any two tokens merge whose bytes together are a token."""
    ranks = {}
    for line in content.split(b"\n"):
        if line.strip():
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    pairs, order = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                pairs.append((a, b))
                order.append(rank)
    size = max(ranks.values()) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    return Merges([ranks[bytes([i])] for i in range(256)], pairs, order, np.arange(size), tokens, whole=ranks)


def byte_letters():
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return letters


def from_json(content):
    """Merges of a tokenizer description: only the pairs it lists, in their order."""
    described = json.loads(content)
    model = described["model"]
    vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
    letters = byte_letters()
    back = {c: b for b, c in letters.items()}
    special = {t["content"] for t in described["added_tokens"]}
    pairs, made = [], []
    for merge in model["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append((vocab[a], vocab[b]))
        made.append(vocab[a + b])
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if token not in special:
            tokens[i] = bytes(back[c] for c in token.removesuffix(end)) if end else bytes(back[c] for c in token)
    return Merges([vocab[letters[b]] for b in range(256)], pairs, range(len(pairs)), made, tokens,
                  last=[vocab[letters[b] + end] for b in range(256)] if end else None)


class PieceCache:
    """Ids of pre-tokens as little-endian 32-bit integers; unknown ones are encoded together.

    Pre-tokens are kept in two generations of ``limit``: when the newer one is full the older one goes,
    and what is used again moves to the newer. So memory is bounded and frequent words stay.
    """

    def __init__(self, merges, limit=150_000):
        self.merges, self.limit, self.known, self.older = merges, limit, {}, {}

    def ids(self, pieces):
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, pieces))
        if None in found:
            gaps = [i for i, x in enumerate(found) if x is None]
            missing = {pieces[i] for i in gaps}
            fresh = []
            for piece in missing:
                ids = older.get(piece)
                if ids is None:
                    fresh.append(piece)
                else:
                    known[piece] = ids
            known.update(zip(fresh, self.merges.encode(fresh)))
            for i in gaps:
                found[i] = known[pieces[i]]
        return found
