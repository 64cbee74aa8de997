"""Periodic runs of words, by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)``
long, that neither neighbouring word extends.  The words of some documents are
laid end to end, numbered so that documents share no word, and then

1. prefix doubling sorts the suffixes.  Its round k ranks the stretches of 2^k
   words, and the stretches that equal a block lie side by side in the suffix
   array.  Stretches that occur once take no part in later rounds.
2. A wavelet matrix over the suffix array answers range-successor queries: the
   nearest occurrence of a block at or behind a position.
3. Every dyadic block (2^k words from a multiple of 2^k) asks for its own next
   occurrence in the window of its size behind it, and for the first two in
   the window before it.  Occurrences so near form a progression, whose step
   is a candidate period; no smaller step is possible.
4. Steps of 2^(k-1) to 2^k - 1 words are extended to both sides by the ranks
   of all rounds, and kept if long enough.

A run of period q with 2^(k-1) <= q < 2^k holds a whole block of round k (its
2^(k+1) - 1 words are at most 4 q), and the block's occurrence q words behind or
q words before lies in the run too, so no run is missed.

Cases: null and empty texts, and texts without a word, have no run and an empty
collapsed text; invalid UTF-8 is read as bytes and given back with replacement
marks; repeated rows are rows of their own; a null id is an id; an empty table
gives no rows; columns other than the id and the text are not read.  A text of
any length is worked on whole: about 100 bytes a word, and 4 for each round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import map_arrow, slices

#: A run's least length, in words and in periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words of documents that are worked on at one time (one document may be longer).
GROUP_WORDS = 1 << 17


def suffix_ranks(words: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """ranks[k][i]: where in the suffix array the stretches equal to the 2^k
    words from i begin (one more value, -1, at the end); repeated[k]: positions
    whose stretch occurs elsewhere too; sizes[k]: how often it occurs."""
    n = len(words)
    counts = np.bincount(words)
    first = np.concatenate((np.cumsum(counts) - counts, [-1])).astype(np.int32)
    ranks = [first[np.concatenate((words, [-1]))]]
    active = np.flatnonzero(counts[words] > 1)
    repeated, sizes = [active], [counts[words[active]]]
    step = 1
    while len(active):
        last = ranks[-1]
        own = last[active].astype(np.int64)
        behind = active + step
        key = own * (n + 1) + np.where(behind < n, last[np.minimum(behind, n)], -1) + 1
        order = np.argsort(key)
        key, own, active = key[order], own[order], active[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((new, [len(key)])))
        # the place of a stretch: where its class begins, and how far in it is
        begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        width = np.diff(np.concatenate((begin, [len(own)])))
        place = own + np.arange(len(own)) - np.repeat(begin, width)
        now = last.copy()
        now[active] = np.repeat(place[new], size)
        ranks.append(now)
        many = np.repeat(size, size)
        active = active[many > 1]
        repeated.append(active)
        sizes.append(many[many > 1])
        step *= 2
    return ranks, repeated, sizes


class WaveletMatrix:
    """Counts and order statistics of values in ranges of an array."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros, self.n_zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b) & 1 == 0
            self.zeros.append(np.concatenate(([0], np.cumsum(zero, dtype=np.int32))).astype(np.int32))
            self.n_zeros.append(int(self.zeros[-1][-1]))
            values = np.concatenate((values[zero], values[~zero]))

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Per query, how many values of the range [lo, hi) are below ``bound``."""
        every = bound >= 1 << self.bits
        bound = np.clip(bound, 0, (1 << self.bits) - 1)
        width, count = hi - lo, np.zeros(len(lo), np.int64)
        for zeros, nz, b in zip(self.zeros, self.n_zeros, range(self.bits - 1, -1, -1)):
            lo0, hi0 = zeros[lo], zeros[hi]
            one = (bound >> b) & 1 == 1
            count += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, nz + lo - lo0, lo0), np.where(one, nz + hi - hi0, hi0)
        return np.where(every, width, count)

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Per query, the value of rank ``n`` (from 0) in the range [lo, hi)."""
        value, n = np.zeros(len(lo), np.int64), n.copy()
        for zeros, nz, b in zip(self.zeros, self.n_zeros, range(self.bits - 1, -1, -1)):
            lo0, hi0 = zeros[lo], zeros[hi]
            one = n >= hi0 - lo0
            n -= np.where(one, hi0 - lo0, 0)
            value |= one.astype(np.int64) << b
            lo, hi = np.where(one, nz + lo - lo0, lo0), np.where(one, nz + hi - hi0, hi0)
        return value


def _extended(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of the longest stretch around i with words
    j - i apart identical."""
    gap, n = j - i, len(ranks[0]) - 1
    left, right = i.copy(), j.copy()
    for k in range(len(ranks) - 1, -1, -1):
        rank, size = ranks[k], 1 << k
        right += np.where((right < n) & (rank[np.minimum(right, n)] == rank[np.minimum(right - gap, n)]), size, 0)
        at = left - size
        left -= np.where((at >= 0) & (rank[np.maximum(at, 0)] == rank[np.maximum(at, 0) + gap]), size, 0)
    return left, right


def runs_of(words: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and then period."""
    none = np.empty((0, 3), np.int64)
    if len(words) < LEAST_WORDS:
        return none
    ranks, repeated, sizes = suffix_ranks(words)
    if len(repeated) < 2 or not len(repeated[1]):
        return none
    # only stretches that are repeated from round 1 on are ever asked for
    order = np.argsort(ranks[-1][repeated[1]])
    held = repeated[1][order]
    at = np.concatenate(([0], np.cumsum(np.bincount(ranks[-1][held], minlength=len(words)))))
    tree = WaveletMatrix(held)
    found = [none]
    for k in range(1, len(repeated)):
        size = 1 << k
        own = repeated[k] % size == 0
        block = repeated[k][own]
        if not len(block):
            continue
        first = ranks[k][block].astype(np.int64)
        lo, hi = at[first], at[first + sizes[k][own]]
        before = tree.below(lo, hi, block - size)
        here = tree.below(lo, hi, block)
        until = tree.below(lo, hi, block + size + 1)
        pairs = []
        q = np.flatnonzero(until - here > 1)
        if len(q):
            pairs.append((block[q], tree.nth(lo[q], hi[q], here[q] + 1)))
        q = np.flatnonzero(here > before)
        if len(q):
            pairs.append((tree.nth(lo[q], hi[q], before[q]), tree.nth(lo[q], hi[q], before[q] + 1)))
        for i, j in pairs:
            step = j - i
            fits = (step >= size >> 1) & (step < size)
            if fits.any():
                i, j = i[fits], j[fits]
                start, end = _extended(ranks, i, j)
                step = j - i
                long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * step)
                found.append(np.stack((start, end, step), axis=1)[long])
    rows = np.concatenate(found)
    if not len(rows):
        return none
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))]


def _solve(texts: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    """Per document (its words): its runs, and the words that stay joined."""
    numbers, starts, base = [], [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        starts.append(len(numbers))
        numbers += [base + own.setdefault(w, len(own)) for w in words]
        base += len(own)
    rows = runs_of(np.array(numbers, np.int64))
    runs: list[list[dict]] = [[] for _ in texts]
    dropped = {}
    begin = np.array(starts, np.int64)
    of = np.searchsorted(begin, rows[:, 0], side="right") - 1
    for d, (start, end, period) in zip(of.tolist(), rows.tolist()):
        at = starts[d]
        runs[d].append({"start": start - at, "length": end - start, "period": period})
        dropped.setdefault(d, np.ones(len(texts[d]), bool))[start - at + period:end - at] = False
    kept = [b" ".join(w if d not in dropped else [w[i] for i in np.flatnonzero(dropped[d])]) for d, w in enumerate(texts)]
    return runs, kept


RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _find(batches, name):
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))

    def answer(ids, texts):
        runs, kept = _solve(texts)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(list(map(len, texts)), pa.int64()), pa.array(runs, kind),
             pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())], [name, "n_words", "runs", "collapsed"])

    for b in slices(batches):
        texts, size, first = [], 0, 0
        for i, raw in enumerate(b.column(1).to_pylist()):
            words = raw.split() if raw else []
            if texts and size + len(words) > GROUP_WORDS:
                yield answer(b.column(0).slice(first, len(texts)), texts)
                texts, size, first = [], 0, i
            texts.append(words)
            size += len(words)
        if texts:
            yield answer(b.column(0).slice(first, len(texts)), texts)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length and period in
    words, by start and then period) and collapsed (the text's words, joined by
    one space, without those that repeat a run's first period)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("raw"))
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(
        f"n_words bigint, runs {RUN}, collapsed string").fields])
    return map_arrow(rows, lambda it: _find(it, "doc_id"), schema)


def longest_run(runs: str) -> F.Column:
    """The run of greatest length of a column ``runs``; of equally long ones
    that of smallest start, then period."""
    return F.expr(f"""array_max(transform({runs}, r -> struct(r.length, -r.start AS back, -r.period AS short)))""")
