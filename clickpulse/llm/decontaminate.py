"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items make one automaton.  Every document's words are
streamed through it; the automaton's state tells the longest run of words up
to here that some item holds.  Runs of ``window`` words or more (and whole
items that are shorter) are hit spans.  Removal takes the hit spans out of the
text, and drops the document where they cover more than ``max_coverage``.

The benchmark is cut into parts of about ``part_words`` words, by a running
sum, and each part has its own automaton.  A longer item is cut into pieces
that overlap by all but one word of a window, so what a task holds is bounded
for any benchmark.  With one part the documents are walked and finished in one
pass.  With more, each part is a pass that writes the hits only, under a digest
of the text, and in the last step documents meet the hits of all parts.  Words
that no item holds end every match, so only runs of known words that are as
long as the shortest window are walked.

Cases: a null or empty text has no words and is clean; an item without words
never occurs; items without an id hit like others and are one null among the
items, which op7 counts but does not name; items of equal text are all
reported; bytes that are no UTF-8 count as U+FFFD; repeated rows are judged one by one; empty tables give no rows or
clean documents; other columns of the documents pass through untouched,
whatever their names, and other columns of the benchmark are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.automaton import SuffixAutomaton
from clickpulse.llm.common import free_name, map_arrow, remove, slices, stored, texts_of

WINDOW = 10
MAX_COVERAGE = 0.5
#: Words of the benchmark in one automaton.
PART_WORDS = 200_000

#: ASCII other than letters and digits separates words; A-Z are lower-cased.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_TABLE).split() if raw else []


class Hits:
    """Hit spans of one document: word ranges, merged, and the items."""

    def __init__(self, n_words: int, spans: list[tuple[int, int]], items: set):
        self.n_words = n_words
        self.items = items
        self.spans: list[list[int]] = []
        for a, b in sorted(spans):
            if self.spans and a <= self.spans[-1][1]:
                self.spans[-1][1] = max(b, self.spans[-1][1])
            else:
                self.spans.append([a, b])
        self.n_hit = sum(b - a for a, b in self.spans)


def find_hits(words: list[bytes], machine: SuffixAutomaton) -> Hits:
    spans: list[tuple[int, int]] = []
    items: set = set()
    least = machine.shortest
    if len(words) >= least:
        ids = np.fromiter(map(machine.vocab.get, words, _Unknown()), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        runs = edge.reshape(-1, 2)
        for a, b in runs[runs[:, 1] - runs[:, 0] >= least].tolist():
            machine.scan(ids[a:b].tolist(), a, spans, items)
    return Hits(len(words), spans, items)


class _Unknown:
    """Endless default for ``map``."""

    def __iter__(self):
        return self

    def __next__(self):
        return -1


def without_spans(raw: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]])


def _pieces(batches, part_words, window):
    """Items as their words, cut where they are longer than a part."""
    step = max(part_words, window) - window + 1
    for b in slices(batches, 16):
        ids, texts = [], []
        for name, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
            words = words_of(text.encode() if text else None)
            for i in range(0, max(1, len(words) - window + 1), step):
                ids.append(name)
                texts.append(b" ".join(words[i:i + step + window - 1]).decode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["item_id", "text"])


def benchmark_parts(benchmark: DataFrame, part_words: int, item_col: str, text_col: str, window: int) -> list[DataFrame]:
    """The items (item_id, words joined by a space) in parts of bounded size.
    The running sum goes over one number per item, in groups of item hashes."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")) \
        .where("text IS NOT NULL")
    items = stored(map_arrow(items, lambda it: _pieces(it, part_words, window), "item_id string, text string"), "items")
    size = F.length("text")
    total = items.agg(F.sum(size)).first()[0] or 0
    if total <= part_words * 2:  # a word is at least a letter and a separator
        return [items]
    n = -(-total // (part_words * 2))
    marked = items.withColumn("group", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    longest = marked.withColumn("before", F.sum(size).over(
        Window.partitionBy("group").orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, -1)))
    marked = stored(longest.withColumn("part", F.floor(F.coalesce("before", F.lit(0)) / (part_words * 2))), "items")
    remove(items)
    keys = marked.select("group", "part").distinct().orderBy("group", "part").collect()
    return [marked.where((F.col("group") == k.group) & (F.col("part") == k.part)).select("item_id", "text")
            for k in keys]


_KIND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                      T.StructField("spans", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))])
_machines: dict = {}


def _machine(items: list, window: int) -> SuffixAutomaton:
    """The automaton of a broadcast list of items, built once per worker."""
    if _machines.get("of") is not items:
        _machines.update({"of": items, "is": SuffixAutomaton(items, window)})
    return _machines["is"]


def _sorted(items: set) -> list:
    return sorted(items, key=lambda i: (i is None, i or ""))


def _spans(raw: bytes) -> list[list[int]]:
    return np.frombuffer(raw, "<i4").reshape(-1, 2).tolist()


def _walked(batches, items, window, text_at, finish):
    """The hits of one automaton; ``finish`` makes the batch of them."""
    machine = _machine(items.value, window)
    for b in slices(batches):
        texts = texts_of(b.column(text_at))
        yield finish(b, texts, [find_hits(words_of(t.encode() if t else None), machine) for t in texts])


def _met(batches, text_at, finish):
    """Rows with the hits of all parts in two last columns."""
    for b in slices(batches):
        texts = texts_of(b.column(text_at))
        spans, items = (b.column(b.num_columns - k).to_pylist() for k in (2, 1))
        found = [Hits(len(words_of(t.encode() if t else None)), [tuple(x) for raw in s or () for x in _spans(raw)],
                      {x for some in i or () for x in some}) for t, s, i in zip(texts, spans, items)]
        yield finish(b, texts, found)


def _hit_rows(b, texts, found):
    at = [k for k, h in enumerate(found) if h.n_hit]
    return pa.RecordBatch.from_arrays(
        [b.column(1).take(pa.array(at, pa.int64())), pa.array([np.array(found[k].spans, "<i4").tobytes() for k in at], pa.binary()),
         pa.array([_sorted(found[k].items) for k in at], pa.list_(pa.string()))], ["digest", "spans", "items"])


def _run(docs, benchmark, text_col, window, item_col, item_text_col, part_words, finish, schema):
    """The hits of all parts over ``docs``, ended with ``finish``."""
    spark, text = docs.sparkSession, F.col(f"`{text_col}`").cast("string")
    parts = benchmark_parts(benchmark, part_words, item_col, item_text_col, window)

    def sent(part):
        return spark.sparkContext.broadcast([(r.item_id, words_of(r.text.encode())) for r in part.collect()])

    text_at = docs.columns.index(text_col)
    if len(parts) == 1:
        items = sent(parts[0])
        return map_arrow(docs, lambda it: _walked(it, items, window, text_at, finish), schema)
    rows = docs.select(text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))
    found = None
    for part in parts:  # one automaton at a time in a task; a text's copies have the same hits
        items = sent(part)
        hits = stored(map_arrow(rows, lambda it, items=items: _walked(it, items, window, 0, _hit_rows),
                                "digest string, spans binary, items array<string>").dropDuplicates(["digest"]), "hits")
        found = hits if found is None else found.unionByName(hits)
    digest, spans, items = (free_name(docs, n) for n in ("digest", "spans", "items"))
    # few texts have hits; written first, so that a text of very many copies is split
    merged = stored(found.groupBy(F.col("digest").alias(digest)).agg(F.collect_list("spans").alias(spans),
                                                                     F.collect_list("items").alias(items)), "hits")
    met = docs.withColumn(digest, F.sha2(text.cast("binary"), 256)).join(merged, digest, "left") \
        .select(*[F.col(f"`{c}`") for c in docs.columns], spans, items)
    return map_arrow(met, lambda it: _met(it, text_at, finish), schema)


def document_hits(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  part_words: int = PART_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (word ranges, pairs
    of 32-bit integers) and items (ids as text, sorted; a null for those without one)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *_KIND.fields])

    def finish(b, texts, found):
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([h.n_words for h in found], pa.int64()), pa.array([h.n_hit for h in found], pa.int64()),
             pa.array([np.array(h.spans, "<i4").tobytes() for h in found], pa.binary()),
             pa.array([_sorted(h.items) for h in found], pa.list_(pa.string()))], schema.names)

    return _run(rows, benchmark, "text", window, item_col, item_text_col, part_words, finish, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, max_coverage: float = MAX_COVERAGE,
                  window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", part_words: int = PART_WORDS) -> DataFrame:
    """``docs`` without hit spans and without the documents that they cover by
    more than ``max_coverage``; a column n_chars follows the new text."""
    names = docs.columns
    at = names.index(text_col)

    def finish(b, texts, found):
        for i, h in enumerate(found):
            if h.n_hit:
                texts[i] = without_spans(texts[i].encode(), h.spans).decode()
        b = pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field(i).type) if i == at else b.column(i)
                                        for i in range(len(names))], names)
        return b.filter(pa.array([h.n_hit <= max_coverage * h.n_words for h in found]))

    out = _run(docs, benchmark, text_col, window, item_col, item_text_col, part_words, finish, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out
