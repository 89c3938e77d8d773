"""Words and hashes of many texts at once, as numpy arrays over Arrow buffers.

A batch of texts is handled in runs of rows of about ``CHUNK_BYTES`` bytes (a
longer text is a run of its own, always whole), so the memory of a task follows
the run and the longest text, not the number of rows in a batch.

Word hashes are polynomial hashes of the word's bytes modulo 2**64, taken from
one running sum over the run: with ``S[i] = sum(T[b_j] * P**j for j < i)`` the
hash of bytes s..e is ``(S[e] - S[s]) * P**-s``, then mixed. They depend on the
word alone, on any machine and in any process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

U = np.uint64
_P = U(0x9E3779B97F4A7C15)                       # odd, so it has an inverse mod 2**64
_P_INV = U(pow(int(_P), -1, 1 << 64))
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(30))
    x = x * _M1
    x = x ^ (x >> U(27))
    x = x * _M2
    return x ^ (x >> U(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + U(seed * int(_P) & 0xFFFFFFFFFFFFFFFF))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes form words, and the byte each one counts as. A word is a run of
    bytes of one group; group 0 lies between words."""

    group: np.ndarray      # uint8[256]
    inside: np.ndarray     # bool[256]
    fold: np.ndarray       # uint8[256]; bytes outside words become a space
    code: np.ndarray       # uint64[256]


def alphabet(group, lower: bool) -> Alphabet:
    groups = np.array([int(group(b)) for b in range(256)], np.uint8)
    ins = groups > 0
    fold = np.array([(b + 32 if lower and 65 <= b <= 90 else b) if ins[b] else 32
                     for b in range(256)], np.uint8)
    return Alphabet(groups, ins, fold, mix(fold.astype(U) + U(1)))


# letters, digits and everything outside ASCII, A-Z counted as a-z
ALNUM = alphabet(lambda b: b >= 0x80 or chr(b).isalnum(), lower=True)
# everything but space, \t, \n, \v, \f, \r
NONSPACE = alphabet(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D), lower=False)
# as NONSPACE, cut where letters, digits and non-ASCII meet punctuation
PIECES = alphabet(lambda b: 0 if not NONSPACE.inside[b] else 1 if ALNUM.inside[b] else 2,
                  lower=False)


_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow.get("p", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        tables = []
        for base in (_P, _P_INV):
            steps = np.full(size, base, U)
            steps[0] = U(1)
            tables.append(np.multiply.accumulate(steps))
        if size > 4 * CHUNK_BYTES:               # a very long text: not kept
            return tables[0], tables[1]
        _pow["p"], _pow["i"] = tables
    return _pow["p"], _pow["i"]


@dataclass
class Words:
    """The words of a run of texts. Row r has words first[r] .. first[r + 1]."""

    data: np.ndarray       # uint8, all bytes of the run
    start: np.ndarray      # byte position of each word
    end: np.ndarray
    hash: np.ndarray       # uint64
    first: np.ndarray
    kind: Alphabet

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def joined(self, i: int, j: int) -> bytes:
        """Words i .. j - 1, folded, with one space between them."""
        part = self.kind.fold[self.data[self.start[i]:self.end[j - 1]]].tobytes()
        return b" ".join(part.split(b" ")) if b"  " not in part else b" ".join(
            w for w in part.split(b" ") if w)


def words(data: np.ndarray, offsets: np.ndarray, kind: Alphabet = ALNUM) -> Words:
    n = len(data)
    group = kind.group[data]
    inside = group > 0
    cut = offsets[(offsets > 0) & (offsets < n)]
    change = group[1:] != group[:-1]
    opens = inside.copy()
    opens[1:] &= change
    opens[cut] = inside[cut]
    closes = inside.copy()
    closes[:-1] &= change
    closes[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    p, inv = _powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(kind.code[data] * p[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inv[start])
    return Words(data, start, end, h, np.searchsorted(start, offsets), kind)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``size`` consecutive words and the word each begins at."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    last = np.repeat(w.first[1:], w.counts)[:n]
    at = np.flatnonzero(np.arange(n) + size <= last)
    h = w.hash[at]
    for k in range(1, size):
        h = h * _P + w.hash[at + k]
    return mix(h + U(size)), at


def runs(column: pa.Array, max_bytes: int = CHUNK_BYTES
         ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo .. hi of a string column as (lo, hi, bytes, offsets); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, off, raw = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each row's range of words."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


LONG = 64


def same_bytes(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray,
               size: np.ndarray) -> np.ndarray:
    """Whether ``x[a:a + size]`` and ``y[b:b + size]`` are equal, for each pair."""
    same = np.ones(len(size), bool)
    live = np.flatnonzero(size > 0)
    for j in range(LONG):
        if not len(live):
            return same
        same[live] = x[a[live] + j] == y[b[live] + j]
        live = live[same[live] & (size[live] > j + 1)]
    for i in live.tolist():
        n = size[i]
        same[i] = np.array_equal(x[a[i]:a[i] + n], y[b[i]:b[i] + n])
    return same


class Lookup:
    """Places of hashes in a sorted table; a bitmap drops most misses first."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys.astype(U))
        bits = max(16, int(len(self.keys) * 16).bit_length())
        self.mask = U((1 << bits) - 1)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[self.keys & self.mask] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in h, places in keys) of the hashes that are keys."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.bitmap[h & self.mask])
        place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[place] == h[at]
        return at[ok], place[ok]
