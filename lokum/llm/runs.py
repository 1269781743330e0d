"""Periodic run detection by block convolution.

A run is a longest stretch of words with smallest period q that holds at least
``max(MIN_WORDS, MIN_PERIODS * q)`` words. Documents are word sequences; many are
laid end to end, with a word of its own between two, so that no run crosses.

1. At dyadic scales B = 8, 16, ... the sequence is cut into blocks. A run with a
   period in [B, 2B) (at the first scale [1, 2B)) holds a whole block and its
   repetition one period on, as it is three periods and ``MIN_WORDS`` words long.
2. Where a block recurs in the windows after it is read off the sums of squared
   differences at all distances of the scale: one correlation by a number theoretic
   transform modulo 2^16 + 1 a block and window. It is exact integer arithmetic: a
   place without a mismatch always gives 0. Blocks over ``LARGEST`` words are
   represented by their first ``LARGEST``, which keeps transforms short at every scale.
3. A distance seeds an extension to both sides, for all seeds at once by bisection
   on prefix hashes; accepted stretches are then compared word by word, so neither
   a sum that is 0 by chance nor a hash can make a run.
4. All distances that span the same stretch are multiples of its smallest period:
   the smallest found is it.

Defined cases: null and empty texts have no words; null ids are never altered by
``looped``; repeated rows are ordinary rows; texts are read whole, at any length;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import by_bytes, col, give_back

MIN_WORDS = 24
MIN_PERIODS = 3
FIRST = 8              # smallest block; 3 * FIRST <= MIN_WORDS
LARGEST = 1024         # words that stand for a longer block
CHUNK_WORDS = 1 << 15  # words of documents that are laid end to end
PRIME = (1 << 16) + 1
ROOT = 3               # generates the residues of PRIME
HASH_PRIME = (1 << 31) - 1
HASH_BASES = (1_000_003, 998_244_341)


def fold(x: np.ndarray) -> np.ndarray:
    """A smaller number that is the same modulo 2^16 + 1."""
    return (x & 0xFFFF) - (x >> 16)


@lru_cache(maxsize=None)
def tables(size: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray, int]:
    """Of a transform of ``size`` values: twiddles there and back, the places of
    the negated frequencies and signs (-1)^frequency in its output order, 1/size."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    there, back = [], []
    half = size // 2
    while half:
        w = pow(root, size // (2 * half), PRIME)
        powers = [1]
        for _ in range(half - 1):
            powers.append(powers[-1] * w % PRIME)
        there.append(np.array(powers)[:, None])
        back.append(np.array([pow(p, -1, PRIME) for p in powers])[:, None])
        half //= 2
    bits = size.bit_length() - 1
    order = np.zeros(size, np.int64)
    for k in range(bits):
        order |= (np.arange(size) >> k & 1) << (bits - 1 - k)
    negated = order[(-order) % size]
    return there, back, negated, 1 - 2 * (order & 1), pow(size, -1, PRIME)


def transform(x: np.ndarray) -> np.ndarray:
    """Along the first axis, in bit-reversed order; values stay below 2^48."""
    size, many = x.shape
    half = size // 2
    for w in tables(size)[0]:
        pairs = x.reshape(-1, 2, half, many)
        out = np.empty_like(pairs)
        np.add(pairs[:, 0], pairs[:, 1], out=out[:, 0])
        out[:, 1] = fold((pairs[:, 0] - pairs[:, 1]) * w)
        x = out.reshape(size, many)
        half //= 2
    return fold(fold(x))


def restore(x: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``, up to the factor 1 / size."""
    size, many = x.shape
    half = 1
    for w in reversed(tables(size)[1]):
        pairs = x.reshape(-1, 2, half, many)
        turned = fold(pairs[:, 1] * w)
        out = np.empty_like(pairs)
        np.add(pairs[:, 0], turned, out=out[:, 0])
        np.subtract(pairs[:, 0], turned, out=out[:, 1])
        x = out.reshape(size, many)
        half *= 2
    return x


class Blocks:
    """Transforms of all blocks of ``size`` words, padded to twice their length."""

    def __init__(self, values: np.ndarray, size: int):
        self.size = size
        self.count = -(-len(values) // size)
        padded = np.zeros((self.count + 2) * size, np.int64)
        padded[:len(values)] = values
        # rows: words of a block, columns: blocks
        x = np.zeros((2 * size, self.count + 2), np.int64)
        x[:size] = padded.reshape(-1, size).T
        self.f = transform(x)
        self.squares = np.concatenate(([0], np.cumsum(padded * padded)))

    def matches(self, stride: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, distance) without a mismatch, of every ``stride``-th block with the
        distances from ``shift`` blocks on, a block's length of them."""
        size = self.size
        at = np.arange(0, self.count - shift, stride)
        if not len(at):
            return at, at
        _, _, negated, sign, inverse = tables(2 * size)
        window = self.f[:, at + shift] + sign[:, None] * self.f[:, at + shift + 1]
        product = fold(fold(self.f[negated][:, at] * fold(window)))
        both = restore(product)[:size] % PRIME * inverse
        start = at[None, :] * size
        slide = start + (shift * size + np.arange(size))[:, None]
        own = self.squares[start + size] - self.squares[start]
        other = self.squares[slide + size] - self.squares[slide]
        step, which = np.nonzero((own + other - 2 * both) % PRIME == 0)
        return at[which], step + shift * size


class Prefixes:
    """Prefix hashes of a sequence, for comparing stretches of it."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.n, self.ids = n, ids
        self.sums, self.powers = [], []
        for base in HASH_BASES:
            power = self.power_of(base, n + 1)
            terms = (ids + 1) % HASH_PRIME * power[:n] % HASH_PRIME
            self.sums.append(np.concatenate(([0], np.cumsum(terms) % HASH_PRIME)))
            self.powers.append(power)

    @staticmethod
    def power_of(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.int64)
        done = 1
        while done < n:
            more = min(done, n - done)
            out[done:done + more] = out[:more] * pow(base, done, HASH_PRIME) % HASH_PRIME
            done += more
        return out

    def equal(self, a: np.ndarray, d: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from a and from a + d are the same, by hash."""
        out = np.ones(len(a), bool)
        for s, p in zip(self.sums, self.powers):
            left = (s[a + size] - s[a]) % HASH_PRIME * p[d] % HASH_PRIME
            out &= left == (s[a + d + size] - s[a + d]) % HASH_PRIME
        return out

    def reach(self, a: np.ndarray, d: np.ndarray, back: bool) -> np.ndarray:
        """How many words before (from) a are the same as those d on."""
        lo = np.zeros(len(a), np.int64)
        hi = a.copy() if back else self.n - a - d
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.equal(a - mid if back else a, d, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def find_runs(ids: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, end, period) of all runs of a sequence of word numbers, by start
    and period. No run is longer than ``longest`` (the whole sequence)."""
    n = len(ids)
    longest = n if longest is None else min(longest, n)
    none = np.zeros((0, 5), np.int64)
    if longest < MIN_WORDS:
        return none[:, :3]
    # spread over the residues, so that different words seldom look alike
    values = (ids * 40_503 + 12_345) % PRIME
    prefixes = Prefixes(ids)
    known = none
    blocks, size = None, FIRST
    while (1 if size == FIRST else size) * MIN_PERIODS <= longest:
        short = min(size, LARGEST)
        if blocks is None or blocks.size != short:
            blocks = Blocks(values, short)
        stride = size // short
        for shift in range(0 if size == FIRST else stride, 2 * stride):
            at, d = blocks.matches(stride, shift)
            at = at * short
            inside = (d > 0) & (at + d < n)
            at, d = at[inside], d[inside]
            if len(at) and len(known):
                # a seed inside a known run whose period divides its distance spans that run again;
                # runs that hold one stretch of two of their periods are one, so the run that reaches
                # furthest is the only one that may
                run = known[np.maximum(np.searchsorted(known[:, 0], at, "right") - 1, 0)]
                again = (run[:, 0] <= at) & (at + short + d <= run[:, 3]) & (run[:, 4] <= short) & (d % run[:, 4] == 0)
                at, d = at[~again], d[~again]
            if len(at):
                known = joined(known, extended(prefixes, at, d))
        size *= 2
    out = known[:, :3]
    for s, e, q in out.tolist():
        if not (np.array_equal(ids[s:e - q], ids[s + q:e]) and (s == 0 or ids[s - 1] != ids[s - 1 + q])
                and (e == n or ids[e] != ids[e - q])):
            raise ArithmeticError("two different stretches of words have one hash")
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def extended(prefixes: Prefixes, at: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Rows (start, end, distance) of the seeds' longest stretches, if long enough."""
    start = at - prefixes.reach(at, d, back=True)
    end = at + d + prefixes.reach(at, d, back=False)
    long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * d)
    return np.stack((start, end, d), axis=1)[long]


def joined(known: np.ndarray, more: np.ndarray) -> np.ndarray:
    """All runs, of one stretch that with the smallest period; by start, with the
    furthest end of the runs up to each and that run's period."""
    if not len(more):
        return known
    rows = np.concatenate((known[:, :3], more))
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    furthest = np.maximum.accumulate(rows[:, 1])
    which = np.maximum.accumulate(np.where(rows[:, 1] == furthest, np.arange(len(rows)), 0))
    return np.column_stack((rows, furthest, rows[which, 2]))


def looped(words: list[bytes], doc_id) -> list[bytes]:
    """The words with the tail that the contract makes periodic."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    body = words[a:a + p]
    return (words[:a] + body * -(-(n - a) // len(body)))[:n]


def report(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    keep = None
    best = None
    lines = []
    for s, e, q in runs:
        if keep is None:
            keep = np.ones(len(words), bool)
        keep[s + q:e] = False
        lines.append(f"{s},{e - s},{q}\n")
        # exact comparison of length / period; runs come by start, then period
        if best is None or (e - s) * best[2] > (best[1] - best[0]) * q:
            best = (s, e, q)
    left = words if keep is None else [words[k] for k in np.flatnonzero(keep).tolist()]
    first = (None,) * 4 if best is None else (
        best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    return (len(runs), *first, hashlib.sha256("".join(lines).encode()).hexdigest(),
            hashlib.sha256(b" ".join(left)).hexdigest())


def by_size(documents: list[list[bytes]], most: int = CHUNK_WORDS):
    """Lists of document numbers, of like lengths and about ``most`` words together."""
    part, held = [], 0
    for k in sorted(range(len(documents)), key=lambda k: len(documents[k])):
        n = len(documents[k])
        if part and (held + n > most or n > 2 * len(documents[part[0]]) + MIN_WORDS):
            yield part
            part, held = [], 0
        part.append(k)
        held += n
    if part:
        yield part


def runs_of(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for part in by_size(documents):
        longest = len(documents[part[-1]])
        if longest < MIN_WORDS:
            continue
        laid = [w for k in part for w in (*documents[k], k)]  # between two documents a number
        numbers = dict(zip(dict.fromkeys(laid), count()))
        ids = np.fromiter(map(numbers.__getitem__, laid), np.int64, len(laid))
        starts = np.concatenate(([0], np.cumsum([len(documents[k]) + 1 for k in part])))
        found = find_runs(ids, longest)
        where = np.searchsorted(starts, found[:, 0], "right") - 1
        for j, (s, e, q) in zip(where.tolist(), (found - np.stack(
                (starts[where], starts[where], np.zeros_like(where)), axis=1)).tolist()):
            out[part[j]].append((s, e, q))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loop: bool = False) -> DataFrame:
    """doc_id, n_runs, the run with the greatest length / period (start, length,
    period, exponent_milli), runs_sha256, collapsed_sha256. ``loop`` first alters
    the documents by ``looped``."""
    rows = docs.select(col(id_col).alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        try:
            for b in batches:
                for part in by_bytes(b, 1):
                    ids = part.column(0).to_pylist()
                    documents = [(t or b"").split() for t in part.column(1).to_pylist()]
                    if loop:
                        documents = [looped(w, k) for w, k in zip(documents, ids)]
                    got = list(zip(*map(report, documents, runs_of(documents))))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), *[pa.array(c, pa.int64()) for c in got[:5]],
                         *[pa.array(c, pa.string()) for c in got[5:]]],
                        ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                         "collapsed_sha256"])
        finally:
            give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, "
                                "exponent_milli long, runs_sha256 string, collapsed_sha256 string")
