"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows read, state of the grammar ``(s?(ua)+)?``); its edges are the edits keep,
rerole, delete and insert. A forward heap starts at the first row and a reverse heap at the accepted
ends. They meet, finish every crossing of the least cost, and of those the least concatenated audit wins.

1. The lattice needs no text: rows go in order (``repartitionByRange``) as flags and a digest, equal rows
   as one with their number. A conversation is cut at the edges of partitions and after ``SEGMENT``
   rows, so a conversation with a third of all rows is many tasks. A whole conversation is one search; of
   a piece, the least edits from each state to each state are kept.
2. The pieces of a conversation are chained in order. Audits of equal cost are told apart by their rank
   among the four states: all have read the same rows, so none is the beginning of another.
3. Texts meet the audits in one shuffle and are hashed as a stream, row by row. SHA-256 has no parallel
   form, so a conversation is hashed by one task, which holds one record batch and the audit.

Defined cases: null values count as one space, but a null turn stays null, comes first and has no part in
the gaps; rows of one turn come by role, then by MD5 of the text; repeated rows are duplicates; an empty
role has the initial of a space, which is never legal; a null conv_id is a conversation of its own; a
conversation without rows after the damage has zeros, an empty audit and the hash of nothing; an empty
table gives no rows. Other columns are not read.
"""

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from retail_lake.llm import batches
from retail_lake.llm.scratch import written

# Rows of a conversation in one lattice.
SEGMENT = 512
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 5, 1, 2, 5
# States: nothing yet, after system, after user, after assistant.
STATES = range(4)
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
# The only next role of a state that an insert or a rerole can give, and who leads to each state so.
FORCED = {0: 2, 1: 2, 2: 3, 3: 2}
FORCED_FROM = {0: (), 1: (), 2: (0, 1, 3), 3: (2,)}
LEGAL_PAIRS = {"su", "ua", "au"}
_INF = float("inf")


def _steps(row):
    """(letter, cost, [(state before, state after)]) of the edits that read a row (initial, doomed, truncated)."""
    initial, doomed, truncated = row
    steps = [("D", DELETE, [(s, s) for s in STATES])]
    if not doomed:
        extra = KEEP_TRUNCATED if truncated else 0
        steps.append(("K", extra, list(AFTER.get(initial, {}).items())))
        steps.append(("R", REROLE + extra, list(FORCED.items())))
    return steps


_FORWARD, _REVERSE = {}, {}


def _edges(row):
    """Edges of a row by the state before, and by the state after; there are few kinds of row."""
    if row not in _FORWARD:
        ahead, back = [[] for _ in STATES], [[] for _ in STATES]
        for letter, cost, moves in _steps(row):
            for s, t in moves:
                ahead[s].append((letter, cost, t))
                back[t].append((letter, cost, s))
        _FORWARD[row], _REVERSE[row] = ahead, back
    return _FORWARD[row], _REVERSE[row]


def least_edits(rows, start, ends, trailing):
    """(cost, audit) from state ``start`` before ``rows`` to one of the states ``ends`` after them.

    Without ``trailing`` nothing is inserted behind the last row. None if there is no way. A heap is ordered
    by cost, then along the rows in its direction, so that edges without cost reach a node before it is done.
    """
    n = len(rows)
    kinds = [_edges(row) for row in rows]
    ahead, back = {(0, start): (0, "")}, {(n, t): (0, "") for t in ends}
    front, rear = [(0, 0, start)], [(0, -n, t) for t in ends]
    done, undone, best = set(), set(), _INF
    heapq.heapify(rear)

    def reach(labels, others, heap, node, cost, audit, order):
        nonlocal best
        old = labels.get(node)
        if old is None or (cost, audit) < old:
            labels[node] = cost, audit
            if old is None or cost < old[0]:
                heapq.heappush(heap, (cost, order, node[1]))
            if node in others:
                best = min(best, cost + others[node][0])

    if (0, start) in back:
        best = 0
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, i, s = heapq.heappop(front)
            if (i, s) in done:
                continue
            done.add((i, s))
            audit = ahead[i, s][1]
            if i < n or trailing:
                reach(ahead, back, front, (i, FORCED[s]), cost + INSERT, audit + "I", i)
            if i < n:
                for letter, price, t in kinds[i][0][s]:
                    reach(ahead, back, front, (i + 1, t), cost + price, audit + letter, i + 1)
        else:
            cost, i, t = heapq.heappop(rear)
            i = -i
            if (i, t) in undone:
                continue
            undone.add((i, t))
            audit = back[i, t][1]
            if i < n or trailing:
                for s in FORCED_FROM[t]:
                    reach(back, ahead, rear, (i, s), cost + INSERT, "I" + audit, -i)
            if i:
                for letter, price, s in kinds[i - 1][1][t]:
                    reach(back, ahead, rear, (i - 1, s), cost + price, letter + audit, 1 - i)
    if best == _INF:
        return None
    return best, min(ahead[v][1] + back[v][1] for v in ahead.keys() & back.keys() if ahead[v][0] + back[v][0] == best)


def _piece(rows, whole):
    """[(cost, audit)] of a piece: of a whole conversation one, else one for each pair of states, or none."""
    if whole:
        return [least_edits(rows, 0, (0, 3), True)]
    return [least_edits(rows, s, (t,), False) for s in STATES for t in STATES]


class Chain:
    """The least edits from the beginning of a conversation to each state, piece by piece."""

    def __init__(self):
        self.at = {0: (0, 0, None)}  # state: cost, rank of the audit, linked list of its parts

    def add(self, pairs):
        found = {}
        for t in STATES:
            ways = [(cost + pairs[4 * s + t][0], rank, pairs[4 * s + t][1], s) for s, (cost, rank, _) in self.at.items()
                    if pairs[4 * s + t] is not None]
            if ways:
                found[t] = min(ways)
        order = sorted(found, key=lambda t: found[t][1:3])
        self.at = {t: (found[t][0], order.index(t), (self.at[found[t][3]][2], found[t][2])) for t in found}

    def close(self):
        """(cost, audit) of the whole conversation; a half pair is completed by inserts."""
        missing = {0: 0, 1: 2, 2: 1, 3: 0}
        cost, _, state = min((cost + INSERT * missing[t], rank, t) for t, (cost, rank, _) in self.at.items())
        parts, link = ["I" * missing[state]], self.at[state][2]
        while link is not None:
            link, part = link
            parts.append(part)
        return cost, "".join(reversed(parts))


def damaged(conversations):
    """conv_id, turn, role, text of the rows after the damage that the CRC-32 of ``conv_id:turn`` decides."""
    def text_of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text_of("role").alias("role"),
                                text_of("text").alias("text"),
                                (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("kind"))
    rows = rows.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def _flags(rows):
    """One row per different row: conv_id, turn, role, digest, blank, truncated, first, n."""
    space = r"[\x20\x09-\x0D]"
    marked = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"),
                         (~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).alias("blank"),
                         (~F.rlike("text", F.lit(rf"[.!?]{space}*\z"))).alias("truncated"))
    marked = marked.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("n"))
    firsts = marked.groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("at"))
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
                           F.col("at.turn").alias("_turn"), F.lit(True).alias("first"))
    # Both sides have one row per key, so no key of the join is hot.
    same = (F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
            & F.col("turn").eqNullSafe(F.col("_turn")))
    return marked.join(firsts, same, "left").select(*marked.columns, F.coalesce("first", F.lit(False)).alias("first"))


_COUNTS = ["n_rows", "blank", "duplicate", "truncated", "illegal"]
_TURNS = ["first_turn", "last_turn", "n_turns"]
_PIECE = ("part int, seq bigint, whole boolean, n_rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "first_turn bigint, last_turn bigint, n_turns bigint, opening string, closing string, "
          "costs array<bigint>, audits array<string>")


class _Piece:
    def __init__(self):
        self.rows, self.opening, self.closing = [], None, None
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = None
        self.n_turns = 0

    def add(self, turn, role, blank, truncated, duplicate):
        initial, counts = role[:1] or " ", self.counts
        counts["n_rows"] += 1
        counts["blank"] += blank
        counts["duplicate"] += duplicate and not blank
        counts["truncated"] += truncated and not blank and not duplicate
        if self.opening is None:
            self.opening = initial
        else:
            counts["illegal"] += self.closing + initial not in LEGAL_PAIRS
        self.closing = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.n_turns = turn, self.n_turns + 1
        self.rows.append((initial, blank or duplicate, truncated))


def _pieces(parts, conv_type):
    """Rows in the order of conversations -> the pieces of each conversation."""
    schema = pa.schema([("conv_id", conv_type), ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_())]
                       + [(c, pa.int64()) for c in [*_COUNTS, *_TURNS]]
                       + [("opening", pa.string()), ("closing", pa.string()), ("costs", pa.list_(pa.int64())),
                          ("audits", pa.list_(pa.string()))])
    part, out = TaskContext.get().partitionId(), []
    # A conversation at the edge of a partition may go on beyond it.
    conv, piece, seq, edge = None, None, 0, True

    def flush(whole):
        found = _piece(piece.rows, whole)
        out.append([conv, part, seq, whole, *piece.counts.values(), piece.first_turn, piece.last_turn, piece.n_turns,
                    piece.opening, piece.closing, [f and f[0] for f in found], [f and f[1] for f in found]])

    def sent():
        rows = list(zip(*out))
        out.clear()
        return batches.records(rows, schema)

    for batch in parts:
        names = ["conv_id", "turn", "role", "blank", "truncated", "first", "n"]
        for own, turn, role, blank, truncated, first, n in zip(*(batch.column(c).to_pylist() for c in names)):
            if piece is None or own != conv:
                if piece is not None:
                    flush(not edge)
                    seq, edge = seq + 1, False
                conv, piece = own, _Piece()
            for copy in range(n):
                if len(piece.rows) == SEGMENT:
                    flush(False)
                    piece, seq, edge = _Piece(), seq + 1, True
                    if len(out) >= 64:
                        yield sent()
                piece.add(turn, role, blank, truncated, not first or copy > 0)
        if len(out) >= 64:
            yield sent()
    if piece is not None:
        flush(False)
    if out:
        yield sent()


def _chained(parts, conv_type):
    """Pieces in the order of conversations -> one row per conversation."""
    schema = pa.schema([("conv_id", conv_type), ("gaps", pa.int64())] + [(c, pa.int64()) for c in _COUNTS[1:]]
                       + [("cost", pa.int64()), ("audit", pa.string())])
    out, conv, open_ = [], None, None

    def add(row):
        nonlocal open_
        if open_ is None:
            open_ = {"counts": np.zeros(len(_COUNTS), dtype=np.int64), "first": None, "last": None, "turns": 0,
                     "closing": None, "chain": Chain(), "found": None}
        own = open_
        own["counts"] += [row[c] for c in _COUNTS]
        if own["closing"] is not None:
            own["counts"][-1] += own["closing"] + row["opening"] not in LEGAL_PAIRS
        own["closing"] = row["closing"]
        if row["n_turns"]:
            own["turns"] += row["n_turns"] - (own["last"] == row["first_turn"])
            own["first"] = row["first_turn"] if own["first"] is None else own["first"]
            own["last"] = row["last_turn"]
        if row["whole"]:
            own["found"] = row["costs"][0], row["audits"][0]
        else:
            own["chain"].add([None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])])

    def close():
        cost, audit = open_["found"] or open_["chain"].close()
        gaps = open_["last"] - open_["first"] + 1 - open_["turns"] if open_["turns"] else 0
        out.append([conv, gaps, *open_["counts"][1:].tolist(), cost, audit])

    for batch in parts:
        for row in batch.to_pylist():
            if open_ is not None and row["conv_id"] != conv:
                close()
                open_ = None
            conv = row["conv_id"]
            add(row)
        if out:
            yield batches.records(list(zip(*out)), schema)
            out.clear()
    if open_ is not None:
        close()
        yield batches.records(list(zip(*out)), schema)


def _repaired(parts, conv_type):
    """Audits and rows in the order of conversations -> the hash of each repaired conversation."""
    schema = pa.schema([("conv_id", conv_type), ("n_repaired", pa.int64()), ("repaired_sha256", pa.string())])
    names = {2: "user", 3: "assistant"}
    out, conv, audit, at, state, n, digest = [], None, None, 0, 0, 0, None

    def emit(role, text):
        nonlocal n
        digest.update((f"\n{role}:" if n else f"{role}:").encode() + text)
        n += 1

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, FORCED[state]
            emit(names[state], b"")

    def close():
        inserts()
        out.append([conv, n, digest.hexdigest()])

    for batch in parts:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]
        for own, found, role, text in zip(*columns):
            if found is not None:
                if audit is not None:
                    close()
                conv, audit, at, state, n, digest = own, found, 0, 0, 0, hashlib.sha256()
                continue
            inserts()
            letter, at = audit[at], at + 1
            if letter == "K":
                state = AFTER[role[:1]][state]
                emit(role, text)
            elif letter == "R":
                state = FORCED[state]
                emit(names[state], text)
        if out:
            yield batches.records(list(zip(*out)), schema)
            out.clear()
    if audit is not None:
        close()
        yield batches.records(list(zip(*out)), schema)


def repairs(rows):
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of the conversations of ``rows``.

    ``rows`` has conv_id, turn, role and text without nulls but for conv_id and turn.
    """
    name, conv_type = rows.schema["conv_id"].dataType.simpleString(), _arrow_type(rows)
    order = ["conv_id", "turn", "role", "digest"]
    flags = _flags(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = batches.map_arrow(flags, lambda parts: _pieces(parts, conv_type), f"conv_id {name}, {_PIECE}")
    pieces = written(pieces, "conversation-pieces").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return batches.map_arrow(
        pieces, lambda parts: _chained(parts, conv_type),
        f"conv_id {name}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def _arrow_type(rows):
    return to_arrow_type(rows.schema["conv_id"].dataType)


def repaired(conversations):
    """One row per conversation: its faults, the least edits that repair it, and the hash of the repaired text."""
    rows = damaged(conversations)
    found = written(repairs(rows), "conversation-repairs")
    name, conv_type = rows.schema["conv_id"].dataType.simpleString(), _arrow_type(rows)
    texts = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", F.md5("text").alias("digest"),
                        F.col("text").cast("binary").alias("text"))
    heads = found.select("conv_id", "audit", *[F.lit(None).cast(t).alias(c) for c, t in
                                               (("turn", "bigint"), ("role", "string"), ("digest", "string"), ("text", "binary"))])
    both = heads.unionAll(texts).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), "turn", "role", "digest")
    hashes = batches.map_arrow(both, lambda parts: _repaired(parts, conv_type),
                               f"conv_id {name}, n_repaired bigint, repaired_sha256 string")
    every = conversations.select("conv_id").distinct()
    joined = every
    for own in (found, hashes):
        own = own.withColumnRenamed("conv_id", "_conv")
        joined = joined.join(own, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = ["gaps", *_COUNTS[1:], "cost", "n_repaired"]
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
