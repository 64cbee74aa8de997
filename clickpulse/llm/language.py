"""Language identification with a bit-sliced Bloom filter of n-grams.

One filter serves all languages: each of its slots holds a bit mask with one
bit per language, in as many words of 64 bits as the languages need (one
narrower word where that is enough).  An n-gram hashes to ``HASHES`` slots, and the AND of their
masks is the set of languages that hold it.  A text's windows of ``N``
characters are looked up, and the hits of every language are counted from the
masks.  A language whose slice is filled to the share q gets false hits at a
rate of ``q**HASHES``; the counts are corrected for them, and the largest
decides.  The score is its share of all corrected counts.

The n-grams of a language are all those of a bounded sample of its documents
(not held out): the filter denies none that was learned.  They are placed in
the filter on the executors, and only its slots come to the driver.  Every document is looked up whole, and alone; the filter
is the only thing sent to the executors, and its size is fixed by the number
of languages: 8 MB for each 64.

Cases: a null text and one without a letter are ``und`` with score 0; a text
with letters but no known n-gram gets the largest language of the sample with
score 0; so does any text if nothing was learned, as ``und``; ties go to the
language that sorts first; every language with a document is learned; equal
rows are looked up one by one; bytes that are no UTF-8 count as U+FFFD, which
is no letter; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import held_out, map_arrow, slices, texts_of

N = 4
SLOT_BITS = 20
HASHES = 3
#: Documents of each language that n-grams are learned from, about.
SAMPLE_PER_LANGUAGE = 800
UNKNOWN = "und"
#: Code points of a text that are looked up at one time.
CHUNK = 1 << 20

_MULT = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Per code point: is it a letter?  Made once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def windows(text: str, n: int = N):
    """Codes of the windows of ``n`` characters of the lower-case text, in
    which anything but letters is a border, and borders stand at the ends
    only.  Yields them in pieces of bounded size."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letters = letter_table()
    points = np.concatenate((np.zeros(1, "<u4"), points, np.zeros(1, "<u4")))
    for a in range(0, len(points) - n + 1, CHUNK):
        piece = points[a:a + CHUNK + n - 1].astype(np.uint64)
        inner = letters[piece.astype(np.int64)]
        piece = np.where(inner, piece, np.uint64(0))
        k = len(piece) - n + 1
        ok = np.ones(k, bool)
        code = np.zeros(k, np.uint64)
        for j in range(n):
            code = (code << np.uint64(16)) ^ (piece[j:j + k] * np.uint64(0x9E37))
            if 0 < j < n - 1:
                ok &= inner[j:j + k]
        yield code[ok]


def slots(code: np.ndarray, slot_bits: int = SLOT_BITS, hashes: int = HASHES):
    mixed = code ^ (code >> np.uint64(31))
    for m in _MULT[:hashes]:
        yield (mixed * m) >> np.uint64(64 - slot_bits)


@dataclass
class LanguageFilter:
    languages: list[str]
    masks: np.ndarray
    default: str
    slot_bits: int = SLOT_BITS
    hashes: int = HASHES

    def __post_init__(self):
        self.false_rate = np.array([float(np.mean(self.has(self.masks, i))) ** self.hashes
                                    for i in range(len(self.languages))])

    @staticmethod
    def has(masks: np.ndarray, i: int) -> np.ndarray:
        """Per row of masks, is language ``i`` among them?"""
        word = masks if masks.ndim == 1 else masks[:, i // 64]
        return (word & word.dtype.type(1 << i % 64)) != 0

    def lookup(self, code: np.ndarray) -> np.ndarray:
        """Per n-gram, the mask (or its words) of the languages that hold it."""
        got = None
        for s in slots(code, self.slot_bits, self.hashes):
            m = self.masks[s.astype(np.int64)]
            got = m if got is None else got & m
        return got

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if not self.languages:
            return self.default, 0.0
        n, hits = 0, np.zeros(len(self.languages))
        for code in windows(text):
            got = self.lookup(code)
            n += len(got)
            for i in range(len(hits)):
                hits[i] += np.count_nonzero(self.has(got, i))
        real = np.maximum(0.0, (hits - n * self.false_rate) / (1 - self.false_rate))
        total = real.sum()
        if total <= 0:
            return self.default, 0.0
        best = int(np.argmax(real))
        return self.languages[best], float(real[best] / total)


def empty_masks(languages: list[str], slot_bits: int) -> np.ndarray:
    n = len(languages)
    if n > 64:
        return np.zeros((1 << slot_bits, -(-n // 64)), np.uint64)
    return np.zeros(1 << slot_bits, np.uint8 if n <= 8 else np.uint16 if n <= 16 else np.uint32 if n <= 32 else np.uint64)


def build(grams: list[tuple[int, int]], languages: list[str], default: str, slot_bits: int = SLOT_BITS,
          hashes: int = HASHES) -> LanguageFilter:
    """The filter of (n-gram code, mask of its languages)."""
    masks = empty_masks(languages, slot_bits)
    code = np.array([g for g, _ in grams], np.int64).view(np.uint64)
    for w in range(-(-len(languages) // 64)):
        mask = np.array([m >> 64 * w & (1 << 64) - 1 for _, m in grams], np.uint64).astype(masks.dtype)
        word = masks if masks.ndim == 1 else masks[:, w]
        for s in slots(code, slot_bits, hashes) if len(code) else ():
            np.bitwise_or.at(word, s.astype(np.int64), mask)
    return LanguageFilter(languages, masks, default, slot_bits, hashes)


def train_language(docs: DataFrame, *, per_language: int = SAMPLE_PER_LANGUAGE, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang") -> LanguageFilter:
    """Learn from the texts and languages of documents that are not held out."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).cast("string").alias("text")) \
        .where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).where(~held_out("doc_id"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = sorted(r.lang for r in counts)
    if not languages:
        return build([], [], UNKNOWN)
    n = {r.lang: r["count"] for r in counts}
    # a row per language, joined rather than written into expressions, which many languages would make deep
    about = F.broadcast(docs.sparkSession.createDataFrame(
        [(x, i // 64, i % 64, min(1.0, per_language / n[x]) * float(1 << 32)) for i, x in enumerate(languages)],
        "lang string, word int, bit int, below double"))
    # rows without an id are told apart by their text
    own = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    sample = known.join(about, "lang").where(F.pmod(own, F.lit(1 << 32)) < F.col("below"))

    def run(batches):
        for b in slices(batches):
            found: dict = {}
            for word, bit, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
                for g in np.unique(np.concatenate([np.zeros(0, np.uint64), *windows(text)])).view(np.int64).tolist():
                    found[g, word] = found.get((g, word), 0) | 1 << bit
            masks = np.array(list(found.values()), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int32()),
                 pa.array(masks, pa.int64())], ["gram", "word", "mask"])

    grams = map_arrow(sample.select("word", "bit", "text"), run, "gram bigint, word int, mask bigint") \
        .groupBy("gram", "word").agg(F.bit_or("mask").alias("mask"))

    def place(batches):
        for b in batches:
            code = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for s in slots(code):
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int64)), b.column(1), b.column(2)], ["slot", "word", "mask"])

    # one row per filled slot and word: bounded by the filter's size, whatever was learned
    filled = map_arrow(grams, place, "slot bigint, word int, mask bigint") \
        .groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = empty_masks(languages, SLOT_BITS)
    at = filled["slot"].to_numpy() if masks.ndim == 1 else (filled["slot"].to_numpy(), filled["word"].to_numpy())
    masks[at] = filled["mask"].to_numpy().view(np.uint64).astype(masks.dtype)
    return LanguageFilter(languages, masks, counts[0].lang)


def predict_language(docs: DataFrame, model: LanguageFilter, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        m = sent.value
        for b in slices(batches):
            got = [m.predict(t) for t in texts_of(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in got], pa.string()),
                 pa.array([s for _, s in got], pa.float64())], schema.names)

    return map_arrow(rows, run, schema)
