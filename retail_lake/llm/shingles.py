"""Shingles of whole texts as 64-bit hashes."""

import itertools

import numpy as np
import xxhash

SEED = 42


def mix(x):
    """A second hash of 64-bit hashes (steps of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text, shingle):
    """XXH64 of each shingle of a text in UTF-8; of fewer words the whole sequence is one."""
    words = text.lower().split()  # of bytes: lowers A-Z and splits at white space of ASCII only
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = list(itertools.accumulate(map(len, words), lambda a, b: a + b + 1))
    begins = [0, *(e + 1 for e in ends[:len(words) - shingle])]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1:])]


def shingle_set(text, shingle):
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(np.array(shingle_hashes(text, shingle), dtype=np.uint64))


def set_name(own):
    """The node of a set: a 64-bit hash of it, which stands for it as a hash stands for a shingle."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64)) if len(own) else None
