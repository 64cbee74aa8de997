"""Quality rules: counts over the whole text, and line labels by a
linear-chain conditional random field.

The lines of a document that hold a word are a sequence.  Every line is
described by a few binned features (its words, symbols, capitals, repeats);
a chain of two labels, content and boilerplate, is decoded by the Viterbi
algorithm, and the share of words on content lines decides whether the
document stays.  The field is trained by maximum likelihood (forward-backward
gradients) on a bounded sample of labelled documents that are not held out:
the lines of documents of quality 1 are content, those of quality 0
boilerplate.  Of a sampled document at most ``STRETCHES`` stretches of
``STRETCH`` lines, evenly spaced, are taken, each as a sequence of its own, so
that training is bounded for documents of any length.  As no document has both
labels, stretches of both kinds are also joined in pairs, so that changes of
label are learned.

Every row is judged alone, so nothing but the sample is shuffled.  Cases: a
null or empty text has no words and fails the base rules; without labelled
documents of both classes the base rules decide alone; repeated rows are
judged one by one; bytes that are no UTF-8 count as U+FFFD; an empty table
gives no rows; other columns pass through
``keep_good`` untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickpulse.llm.common import map_arrow, slices, texts_of
from clickpulse.llm.sampling import labelled_documents

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
#: Documents of each label that the field is trained on, about.
SAMPLE_PER_CLASS = 1000
ITERATIONS = 80
#: Lines of a training sequence, and sequences of one sampled document at most.
STRETCH = 256
STRETCHES = 16
#: Joined pairs, and lines that either side gives at most.
JOINED = 300
JOINED_LINES = 32

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_ENDS = frozenset(b".!?:;\"')")

#: Upper bin limits of the features of a line; a feature has one bin more.
BINS = {
    "words": (1, 2, 4, 8, 16, 32),
    "symbols_per_word": (0.0, 0.1, 0.3, 0.6, 1.0, 2.0),
    "capitals": (0.0, 0.05, 0.15, 0.4, 0.7),
    "ends": (0.0,),
    "seen_before": (0.0,),
    "distinct": (0.2, 0.4, 0.6, 0.8, 0.95),
    "digits": (0.0, 0.05, 0.2, 0.5),
    "shouts_per_word": (0.0, 0.1, 0.3, 0.6),
    "bars_per_word": (0.0, 0.1, 0.3),
    "repeated": (0.0, 0.1, 0.3, 0.6, 0.9),
}
_WIDTH = 8


@dataclass
class Counts:
    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


def repeated_words(words: list[bytes]) -> np.ndarray:
    """Per word: does it stand in a 3-word window that occurs twice or more?"""
    n = len(words)
    out = np.zeros(n, bool)
    if n < 4:
        return out
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    size = len(ids)
    code = w[:-1] * size + w[1:]
    if size > 1 << 20:  # keeps the product below 64 bits
        code = np.unique(code, return_inverse=True)[1].astype(np.int64)
    code = code[:-1] * size + w[2:]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for k in range(3):
        out[k:n - 2 + k] |= twice
    return out


def describe(text: str | None) -> tuple[Counts, np.ndarray, np.ndarray]:
    """The counts; per line with a word its number of words and its bins."""
    raw = text.encode() if text else b""
    out = Counts()
    words = raw.split()
    out.n_words = len(words)
    if not words:
        return out, np.zeros(0, np.int64), np.zeros((0, len(BINS)), np.uint8)
    out.word_chars = len(text) - (len(raw) - len(raw.translate(None, _SPACE)))
    out.n_symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    again = repeated_words(words)
    out.n_repeat_words = int(again.sum())
    upto = np.concatenate(([0], np.cumsum(again))).tolist()
    seen: set[bytes] = set()
    rows: list[tuple] = []
    sizes: list[int] = []
    at = 0
    for line in raw.split(b"\n"):
        mine = line.split()
        n = len(mine)
        if not n:
            continue
        dup = line in seen
        seen.add(line)
        out.n_dup_lines += dup
        size = len(line)
        upper = size - len(line.translate(None, _UPPER))
        lower = size - len(line.translate(None, _LOWER))
        rows.append((
            n,
            (size - len(line.translate(None, _SYMBOLS))) / n,
            upper / (upper + lower) if upper else 0.0,
            mine[-1][-1] in _ENDS,
            dup,
            len(set(mine)) / n,
            (size - len(line.translate(None, _DIGITS))) / size,
            line.count(b"!!") / n,
            line.count(b"|") / n,
            (upto[at + n] - upto[at]) / n,
        ))
        sizes.append(n)
        at += n
    values = np.array(rows, np.float64)
    bins = np.empty(values.shape, np.uint8)
    for k, limits in enumerate(BINS.values()):
        bins[:, k] = np.searchsorted(limits, values[:, k], side="left")
    return out, np.array(sizes, np.int64), bins


class LineField:
    """Two labels: 0 boilerplate, 1 content.  ``emit`` (features x bins) and
    ``start`` are the scores of content against boilerplate, ``move`` those of
    the transitions."""

    def __init__(self, emit=None, start: float = 0.0, move=None):
        self.emit = np.zeros((len(BINS), _WIDTH)) if emit is None else emit
        self.start = start
        self.move = np.zeros((2, 2)) if move is None else move

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return self.emit[np.arange(len(BINS)), bins].sum(axis=1)

    def decode(self, bins: np.ndarray) -> list[int]:
        """The labels of highest total score (Viterbi); ties: boilerplate."""
        (m00, m01), (m10, m11) = self.move.tolist()
        back: list[tuple[int, int]] = []
        s0, s1 = 0.0, self.start
        for t, e in enumerate(self.scores(bins).tolist()):
            if t:
                from0, from1 = int(s1 + m10 > s0 + m00), int(s1 + m11 > s0 + m01)
                back.append((from0, from1))
                s0, s1 = (s1 + m10 if from0 else s0 + m00), (s1 + m11 if from1 else s0 + m01) + e
            else:
                s1 += e
        label = int(s1 > s0)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def train(self, docs: list[tuple], iterations: int = ITERATIONS, rate: float = 0.3,
              decay: float = 1e-3) -> "LineField":
        """Adagrad on the mean log-likelihood per line; ``docs``: (label of all
        lines or array of their labels, bins of the lines)."""
        docs = sorted((d for d in docs if len(d[1])), key=lambda d: -len(d[1]))
        if not docs:
            return self
        lengths = np.array([len(b) for _, b in docs])
        gold = [np.broadcast_to(np.asarray(y, np.int64), len(b)) for y, b in docs]
        n, steps = len(docs), int(lengths[0])
        live = [int((lengths > t).sum()) for t in range(steps)]
        flat = np.concatenate([b[t:t + 1] for t in range(steps) for _, b in docs[:live[t]]])
        at = np.concatenate(([0], np.cumsum(live)))
        total = len(flat)
        cols = np.arange(len(BINS))
        target = np.array([g[t] for t in range(steps) for g in gold[:live[t]]], float)
        kept = np.zeros((2, 2))
        for g in gold:
            np.add.at(kept, (g[:-1], g[1:]), 1)
        sums = [np.full_like(self.emit, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
        for _ in range(iterations):
            e = self.scores(flat)
            alpha = [None] * steps
            a = np.stack([np.zeros(n), self.start + e[:n]])
            alpha[0] = a
            for t in range(1, steps):
                a = a[:, :live[t]]
                a = np.logaddexp(a[0] + self.move[0][:, None], a[1] + self.move[1][:, None])
                a[1] += e[at[t]:at[t + 1]]
                alpha[t] = a
            prob = np.empty(total)
            moved = np.zeros((2, 2))
            beta = np.zeros((2, live[-1]))
            for t in range(steps - 1, -1, -1):
                k = live[t]
                if t + 1 < steps:
                    nxt = np.zeros((2, k))
                    j = live[t + 1]
                    ahead = beta.copy()
                    ahead[1] += e[at[t + 1]:at[t + 2]]
                    joint = alpha[t][:, None, :j] + self.move[:, :, None] + ahead[None]
                    top = joint.max(axis=(0, 1))
                    z = top + np.log(np.exp(joint - top).sum(axis=(0, 1)))
                    moved += np.exp(joint - z).sum(axis=2)
                    nxt[:, :j] = np.logaddexp(self.move[:, 0][:, None] + ahead[0], self.move[:, 1][:, None] + ahead[1])
                    beta = nxt
                s = alpha[t] + beta
                prob[at[t]:at[t + 1]] = 1 / (1 + np.exp(np.clip(s[0] - s[1], -500, 500)))
            gap = (target - prob) / total
            grad = np.zeros_like(self.emit)
            for k in cols:
                grad[k] = np.bincount(flat[:, k], weights=gap, minlength=_WIDTH)[:_WIDTH]
            grads = [grad - decay * self.emit / total, gap[:n].sum(), (kept - moved) / total - decay * self.move / total]
            for i, g in enumerate(grads):
                sums[i] = sums[i] + np.square(g)
            self.emit = self.emit + rate * grads[0] / np.sqrt(sums[0])
            self.start += rate * grads[1] / np.sqrt(sums[1])
            self.move = self.move + rate * grads[2] / np.sqrt(sums[2])
        return self


def stretches(bins: np.ndarray) -> list[np.ndarray]:
    """The training sequences of a document's lines."""
    n = len(bins)
    if n <= STRETCH * STRETCHES:
        return [bins[i:i + STRETCH] for i in range(0, max(n, 1), STRETCH)]
    return [bins[i:i + STRETCH] for i in np.linspace(0, n - STRETCH, STRETCHES).astype(int)]


def joined(docs: list[tuple[int, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Content before boilerplate and the other way round, in turn."""
    kinds = [[b[:JOINED_LINES] for y, b in docs if y == k and len(b)] for k in (0, 1)]
    n = min(JOINED, *map(len, kinds))
    # evenly spaced, as the documents are sorted by their lines
    pairs = [[k[int(i)] for i in np.linspace(0, len(k) - 1, n)] if n else [] for k in kinds]
    out = []
    for i, two in enumerate(zip(*pairs)):
        order = (i % 2, 1 - i % 2)
        out.append((np.concatenate([np.full(len(two[k]), k) for k in order]), np.concatenate([two[k] for k in order])))
    return out


def train_field(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS,
                iterations: int = ITERATIONS, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality") -> LineField | None:
    """The field fitted to the sample; None without both labels in it."""
    sample = labelled_documents(docs, labels, label_col, per_class, id_col, text_col)

    def run(batches):
        for b in slices(batches):
            got = [(y, s.tobytes()) for y, t in zip(b.column(0).to_pylist(), texts_of(b.column(1)))
                   for s in stretches(describe(t)[2])]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in got], pa.int32()), pa.array([s for _, s in got], pa.binary())],
                                             ["label", "bins"])

    rows = map_arrow(sample.selectExpr("CAST(label AS int) AS label", "text"), run, "label int, bins binary").collect()
    got = [(int(r.label), np.frombuffer(bytes(r.bins), np.uint8).reshape(-1, len(BINS))) for r in rows]
    got = sorted(((y, b) for y, b in got if y in (0, 1)), key=lambda d: (d[0], len(d[1]), d[1].tobytes()))
    if {y for y, b in got if len(b)} != {0, 1}:
        return None
    return LineField().train(got + joined(got), iterations)


def judge(text: str | None, field: LineField | None, min_share: float) -> tuple[Counts, float, bool]:
    """The counts, the share of words on content lines, and whether it stays."""
    counts, sizes, bins = describe(text)
    if not len(sizes):
        return counts, 0.0, False
    share = 1.0
    if field is not None:
        share = float((sizes * np.array(field.decode(bins))).sum() / sizes.sum())
    return counts, share, not counts.base_failed and share >= min_share


def quality_verdicts(docs: DataFrame, field: LineField | None, *, min_share: float = MIN_CONTENT_SHARE,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the five counts, base_failed, content_share and kept."""
    rows = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS string) AS text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names],
                           T.StructField("base_failed", T.BooleanType()),
                           T.StructField("content_share", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        for b in slices(batches):
            got = [judge(t, field, min_share) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([getattr(c, n) for c, _, _ in got], pa.int64()) for n in names),
                 pa.array([c.base_failed for c, _, _ in got]), pa.array([s for _, s, _ in got], pa.float64()),
                 pa.array([k for _, _, k in got])], schema.names)

    return map_arrow(rows, run, schema)


def keep_good(docs: DataFrame, field: LineField | None, *, min_share: float = MIN_CONTENT_SHARE,
              text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            yield b.filter(pa.array([judge(t, field, min_share)[2] for t in texts_of(b.column(at))], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
