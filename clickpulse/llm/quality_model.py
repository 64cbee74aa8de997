"""Quality classifier: logistic regression on hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

A word counts with its letters (lower case) and with its shape (runs of lower
case, capitals and digits and of any other character are one sign each), so
that unseen words carry weight too.  The n-grams are single words, pairs of
words, single shapes, and pairs of shapes with a flag for a repeated word; they
are hashed into ``2**BITS`` weights.  A document is the counts of its n-grams, scaled to
length one, and its score the logistic function of a sparse dot product.

The weights are fitted to a bounded sample of the labelled documents that are
not held out; every document is scored whole, and alone, so only the sample
is shuffled and only the weights (of fixed size) are broadcast.

Cases: a null or empty text is scored by the bias alone; texts are read as
bytes, valid UTF-8 or not, and words of any length whole; labels other than 0
and 1 are left out; without labels of both kinds every score is the share of
label 1 in the sample (0.5 without any); repeated rows are scored one by one;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import held_out, map_arrow, slices
from clickpulse.llm.sampling import labelled_documents

BITS = 18
#: Documents of each label that the model is trained on, about.
SAMPLE_PER_CLASS = 1500
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
THRESHOLD = 0.7
#: Cached words of one Python worker (longer words than ``CACHE_BYTES`` are
#: hashed each time); a full cache starts anew.
CACHE_WORDS = 500_000
CACHE_BYTES = 64

_RUNS = ((re.compile(rb"[a-z\x80-\xff]+"), b"x"), (re.compile(rb"[A-Z]+"), b"X"),
         (re.compile(rb"[0-9]+"), b"9"), (re.compile(rb"([^xX9])\1+"), rb"\1"))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Word -> (hash of its letters, hash of its shape), both below 2**32."""

    def __missing__(self, word: bytes):
        from xxhash import xxh32_intdigest
        shape = word
        for run, sign in _RUNS:
            shape = run.sub(sign, shape)
        out = xxh32_intdigest(word.lower()) | xxh32_intdigest(shape, 1) << 32
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = out
        return out


_words = _Words()


def ngrams(text: str | bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text and their values, scaled to length one."""
    words = (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).split() if text else []
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    both = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    word, shape = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
    same = (word[1:] == word[:-1]).astype(np.uint64)
    pair = shape[:-1] * np.uint64(0x100000001B3) + shape[1:] * np.uint64(2) + same
    two = word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[1:] * np.uint64(0x165667B19E3779F9)
    hashed = np.concatenate([word, two, shape + (np.uint64(1) << np.uint64(33)), pair + (np.uint64(1) << np.uint64(62))])
    index, count = np.unique((hashed * _MIX) >> np.uint64(64 - bits), return_counts=True)
    value = np.sqrt(count)
    return index.astype(np.int64), value / np.sqrt((value * value).sum())


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, text: str | bytes | None) -> float:
        index, value = ngrams(text, self.bits)
        x = self.bias + float((self.weights[index] * value).sum())
        return float(1 / (1 + np.exp(-x))) if x > -500 else 0.0


def fit(samples: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, epochs: int = EPOCHS,
        alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-proximal over (label, n-grams, values), in a fixed shuffled order."""
    size = (1 << bits) + 1  # the last one is the bias
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(7)

    def weights(i):
        w = (np.sign(z[i]) * l1 - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    positive = sum(y for y, _, _ in samples)
    if not positive or positive == len(samples):
        share = (positive + 1) / (len(samples) + 2)
        return Model(np.zeros(1 << bits, np.float32), float(np.log(share / (1 - share))), bits)
    for _ in range(epochs):
        for k in order.permutation(len(samples)):
            y, index, value = samples[k]
            i, x = np.append(index, size - 1), np.append(value, 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip((w * x).sum(), -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(size))
    return Model(w[:-1].astype(np.float32), float(w[-1]), bits)


def train_quality(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS, bits: int = BITS,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **options) -> Model:
    """The model of a label column; the n-grams are made on the executors and
    only those of the bounded sample come to the driver."""
    sample = labelled_documents(docs, labels, label_col, per_class, id_col, text_col)

    def run(batches):
        for b in slices(batches):
            got = [ngrams(t, bits) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([i.astype("<i4").tobytes() for i, _ in got], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in got], pa.binary())], ["label", "index", "value"])

    rows = map_arrow(sample.selectExpr("CAST(label AS int) AS label", "CAST(text AS binary) AS text"), run,
                     "label int, index binary, value binary").collect()
    rows = sorted((r.label, bytes(r["index"]), bytes(r["value"])) for r in rows)
    return fit([(y, np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for y, i, v in rows],
               bits, **options)


def score_quality(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from the threshold)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        m = sent.value
        for b in slices(batches):
            scores = [m.score(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())], schema.names)

    return map_arrow(rows, run, schema)
