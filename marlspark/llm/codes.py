"""Words and n-grams of whole texts as 64-bit codes, computed on byte arrays without a loop over words.

A word is a maximal run of ASCII letters, digits and characters outside ASCII,
in lower case. Its code is a polynomial of its bytes modulo 2^64, finished by a
bit mixer, and so is the same on every machine.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = U(pow(int(_P), -1, 1 << 64))
_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
IS_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
IS_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits look independent."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; kept between calls up to a few MB."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (_P, _P_INVERSE):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        if size > 1 << 22:
            return made[0], made[1]
        _powers = made[0], made[1]
    return _powers


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in lower case, with a newline after each, and where each text starts."""
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8), starts


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last item must be False."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words in order, the text each is in, and how many words each text has."""
    data, starts = encode(texts)
    a, b = spans(IS_WORD[data])
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    doc = np.searchsorted(starts, a, side="right") - 1
    return hash_spans(data, a, b), doc, np.bincount(doc, minlength=len(texts))


def word_codes(text: str) -> np.ndarray:
    return words([text])[0]


_STEP = mix(np.arange(1, 65, dtype=np.uint64) * U(0xD1342543DE82EF95)) | U(1)


def shingles(code: np.ndarray, doc: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of runs of k words within a text and the text of each; a shorter text with words is one shingle."""
    n = len(code)
    out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= k:
        total = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            total += code[i : n - k + 1 + i] * _STEP[i]
        whole = doc[: n - k + 1] == doc[k - 1 :]
        out, owner = mix(total[whole]), doc[: n - k + 1][whole]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = np.cumsum(count) - count
        extra = np.array([mix(np.array([(code[first[d] : first[d] + count[d]] * _STEP[: count[d]]).sum(dtype=np.uint64) + U(count[d])]))[0] for d in short], dtype=np.uint64)
        out, owner = np.concatenate([out, extra]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from the upper 53 bits."""
    return ((x >> U(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))
