"""Plain versions of the operators, a document at a time, to hold the jobs against."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, again = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed)


def simhash(text, shingle=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, near):
    """Least index of each item's component, where ``near(a, b)`` links items."""
    least = list(range(len(prints)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if near(prints[i], prints[j]):
                a, b = root(i), root(j)
                least[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def simhash_rows(rows):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = {d: simhash(t) for d, t in rows}
    values = sorted(set(prints.values()))
    roots = dict(zip(values, components(values, lambda a, b: (a ^ b).bit_count() <= 2)))
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(least.get(roots[p], d), d)
    return sorted((d, f"{p:016x}", least[roots[p]]) for d, p in prints.items())


def suffix_rows(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows in document order."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        covered = np.zeros(len(data) + 1, dtype=bool)
        for p in range(len(data) - length + 1):
            piece = data[p:p + length]
            if piece in seen:
                covered[p:p + length] = True
            seen.add(piece)
        kept = bytes(np.frombuffer(data, dtype=np.uint8)[~covered[:len(data)]])
        spans = int((covered[:-1] & ~np.concatenate([[False], covered[:-2]])).sum()) if len(data) else 0
        out.append((doc, len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def nearest_rows(rows, every=100, k=10):
    """(query_id, rank, vec_id, score) of (vec_id, vector) rows."""
    fine = [(i, np.array(v, dtype=float)) for i, v in rows
            if i is not None and v is not None and all(x is not None for x in v)]
    fine = [(i, v) for i, v in fine if np.isfinite(v).all() and v.any()]
    out = []
    for q, own in fine:
        if q % every == 0:
            near = sorted((float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in fine if i != q and len(v) == len(own))
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(near[:k])]
    return sorted(set(out))


def damaged_rows(rows):
    """(conv_id, turn, role, text) rows after the damage, in the order of the contract."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of the damaged rows of one conversation.

    A table of the least (cost, audit) and its repaired rows for each state, row by row.
    """
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else
                      "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] or " " for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, kept) in list(best.items()):
                for role in ("user", "assistant"):
                    to = step.get((state, role[0]))
                    if to and (to not in best or (cost + 5, audit + "I") < best[to][:2]):
                        best[to] = cost + 5, audit + "I", [*kept, role + ":"]
        return best

    best = inserted({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults):
        found = {}
        for state, (cost, audit, kept) in best.items():
            ways = [(state, cost + 2, audit + "D", kept)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                ways.append((step.get((state, role[:1])), cost + more, audit + "K", [*kept, f"{role}:{text}"]))
                ways += [(step.get((state, new[0])), cost + 1 + more, audit + "R", [*kept, f"{new}:{text}"]) for new in ("user", "assistant")]
            for to, *way in ways:
                if to is not None and (to not in found or tuple(way[:2]) < found[to][:2]):
                    found[to] = tuple(way)
        best = inserted(found)
    cost, audit, kept = min(best[s] for s in ("", "a") if s in best)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest())


def repair_rows(rows):
    """One tuple per conversation of (conv_id, turn, role, text) rows, as ``op11`` returns it."""
    after, out = {}, []
    for row in damaged_rows(rows):
        after.setdefault(row[0], []).append(row)
    for conv in {r[0] for r in rows}:
        out.append((conv, *repair(after.get(conv, []))))
    return sorted(out, key=repr)
