import collections
import hashlib

import pyarrow as pa
import pytest

from clickpulse.llm import exact_dedup
from clickpulse.llm.common import BATCH_BYTES, SLICE_ROWS, small_batches
from clickpulse.llm.exact_dedup import ContentTable, drop_copies, exact_copies

from .fixtures import clashing, documents, frame, rows_of


def brute(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r[1] or "").encode()].append(r[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = [keep]
        for i in ids:
            kept = i == keep and bool(stays)
            if kept:
                stays.pop()
            out.append((i, keep, len(ids), kept, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


def test_table_tells_equal_hashes_apart():
    table = ContentTable()
    texts = [b"%d" % i for i in range(3000)]
    for t in texts:
        e = table.find(7, t)
        assert e < 0
        table.add(-1 - e, 7, t)
    assert [table.find(7, t) for t in texts[::97]] == list(range(0, 3000, 97))
    assert table.find(8, texts[0]) < 0


@pytest.mark.parametrize("options", [{}, {"table_bytes": 60_000, "members": 3, "fan": 8}])
def test_copies_match_brute_force(spark, options):
    rows = documents() + [(20_000 + i, "hot text", None, None, 8) for i in range(120)] + [(None, "only null ids", None, None, 1)] * 3 \
        + [(30_000, "long " * 600_000, None, None, 1), (30_001, "long " * 600_000, None, None, 1), (30_002, "long " * 600_000 + "x", None, None, 1)]
    got = exact_copies(clashing(frame(spark, rows, 6)), **options)
    assert rows_of(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == brute(rows)


def test_one_row_of_each_text_stays(spark):
    rows = documents()
    kept = drop_copies(clashing(frame(spark, rows)))
    assert set(kept.columns) == set(clashing(frame(spark, rows)).columns)
    want = collections.Counter((r[0], (r[1] or "")) for r in [(b[0], b[4]) for b in brute(rows) if b[3]])
    got = collections.Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in kept.collect())
    assert got == want


def test_invalid_utf8_and_empty_tables(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'ff61' AS STRING) AS text UNION ALL SELECT 2L, CAST(X'fe61' AS STRING) UNION ALL SELECT 3L, CAST(X'ff61' AS STRING)")
    assert rows_of(exact_copies(docs).select("doc_id", "keep_id", "group_size")) == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]
    assert exact_copies(docs.limit(0)).count() == 0
    assert drop_copies(docs.limit(0)).count() == 0


def test_a_hot_text_is_no_large_task(spark):
    """The join that names the answers: rows of a third of the table with one text."""
    docs = spark.range(9000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text").repartition(12)
    out = exact_copies(docs, members=64, fan=8)
    assert out.where("keep_id = 8997 AND group_size = 3000").count() == 3000
    assert out.where("kept").count() == 6001


BATCH_KEYS = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def test_a_file_has_the_answers_of_several_buckets(spark, monkeypatch):
    """Every file costs two processes on the local file system, and a bucket has few answers."""
    seen = []

    def spy(df, name, files=None, options=None, kept=exact_dedup.stored):
        out = kept(df, name, files, options)
        seen.append((name, len(out.inputFiles()), tuple(map(spark.conf.get, BATCH_KEYS))))
        return out

    monkeypatch.setattr(exact_dedup, "stored", spy)
    before = [spark.conf.get(k, None) for k in BATCH_KEYS]
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "CAST(id % 1500 AS STRING) AS text")
    out = exact_copies(docs, table_bytes=20_000)
    assert out.where("kept").count() == 1500 and out.count() == 2000
    buckets = -(-2 * sum(len(str(i)) + exact_dedup.OVERHEAD for i in range(1500)) // 20_000)
    assert buckets // 8 < max(n for name, n, _ in seen if name == "buckets") <= buckets // 2
    assert {b for name, _, b in seen if name != "hot"} == {(str(BATCH_BYTES), str(SLICE_ROWS))}
    assert [spark.conf.get(k, None) for k in BATCH_KEYS] == before


def test_answers_go_out_together(spark):
    from pyspark.sql import types as T
    kind = T.LongType()
    part, solved = (exact_dedup._arrow(T.StructType([*f, *exact_dedup._fields(kind), *g])) for f, g in (
        ([T.StructField("id", kind), T.StructField("row", kind)], []), ([], [T.StructField("sha", T.BinaryType())])))
    docs = pa.RecordBatch.from_pydict({"id": list(range(3000)), "h": list(range(3000)), "raw": [b"%d" % i for i in range(3000)]})
    parts = [b.filter(b["h"].is_valid()) for b in exact_dedup._merge([docs], 1 << 24, 9, part, True)]
    answers = list(exact_dedup._solve((b for b in parts if b.num_rows), 1 << 24, solved))
    assert len(answers) == 1
    assert collections.Counter(answers[0]["keep_id"].to_pylist()) == collections.Counter(range(3000))
    assert set(answers[0]["sha"].to_pylist()) == {hashlib.sha256(b"%d" % i).digest() for i in range(3000)}


def test_texts_go_to_python_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    texts = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 10000) AS t")
    with small_batches(spark, 100_000):
        got = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 400 and max(got) <= 20


def test_parts_are_deflated(spark):
    from pyspark.sql import types as T
    text = b"the same words " * 1000
    docs = pa.RecordBatch.from_pydict({"id": [1, 2], "h": [7, 7], "raw": [text, text]})
    schema = exact_dedup._arrow(T.StructType([T.StructField("id", T.LongType()), T.StructField("row", T.LongType()), *exact_dedup._fields(T.LongType())]))
    out = pa.Table.from_batches(list(exact_dedup._merge([docs], 1 << 20, 9, schema, True)))
    assert out.nbytes < len(text) // 10
    assert [p["n"] for p in out.to_pylist() if p["h"] is not None] == [2]
