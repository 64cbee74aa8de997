import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickpulse.llm.common import new_folder
from clickpulse.llm.encoders import encoder
from clickpulse.llm.packing import capacities, pack, pack_documents
from clickpulse.llm.token_files import export_and_read, read_token_files, write_token_files

from .fixtures import clashing, documents, frame, rows_of

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind,path", [("byte", BYTE), ("word", WORD)])
def test_cached_ids_equal_the_librarys(kind, path):
    rng = random.Random(1)
    signs = ["a", "b c", " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "　", "'s", "'ll", "12", "é", "e\u0301", "ñ",
             "İ", "Σ", "ß", "!", ".", "...", "<|endoftext|>", "日本", "😀", "\u200b", "\x00", "Ab", "_", "\u0301"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [r[1] for r in documents()]
    mine, theirs = encoder(kind, path), library(path)
    for t in texts:
        assert np.frombuffer(mine(t), "<u4").tolist() == theirs(t), repr(t)


def test_capacities_add_up():
    for n in (0, 1, 1023, 1024, 1025, 5000):
        sizes = capacities(n, 1024)
        assert sum(sizes) == n and all(s & (s - 1) == 0 for s in sizes)


def brute_pack(lengths, capacity, linear, quadratic):
    """The rule itself: every piece scans all sequences."""
    room = capacities(sum(lengths), capacity)
    size, cost, out = list(room), [0.0] * len(room), []
    todo = sorted(((i, a, min(capacity, n - a)) for i, n in enumerate(lengths) for a in range(0, n, capacity)), key=lambda p: -p[2])
    for doc, start, n in todo:
        while n:
            fit = [k for k in range(len(room)) if room[k] >= n] or [k for k in range(len(room)) if room[k]]
            k = min(fit, key=lambda k: (cost[k], k))
            used = min(n, room[k])
            out.append((doc, start, used, k, size[k] - room[k]))
            cost[k] += linear * used + quadratic * used * used
            room[k] -= used
            start, n = start + used, n - used
    return out


def test_packing_follows_the_rule():
    rng = random.Random(2)
    for trial in range(20):
        lengths = [rng.choice([1, 2, rng.randint(1, 30), rng.randint(1, 200)]) for _ in range(rng.randint(0, 80))]
        assert pack(lengths, 64, 1.0, 1 / 64) == brute_pack(lengths, 64, 1.0, 1 / 64)


@pytest.mark.parametrize("group", [1 << 20, 3000])
def test_packed_documents_are_whole_and_sequences_gapless(spark, group):
    rows = [r for r in documents() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    got = pack_documents(clashing(frame(spark, rows)), BYTE, group_tokens=group).collect()
    ids = library(BYTE)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == {r[0] for r in rows}
    for doc, text, *_ in rows:
        want, at = [*ids(text), 0], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    padding = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_small_partitions_leave_few_stubs(spark):
    docs = spark.range(0, 1000, 1, 200).selectExpr("id AS doc_id", "repeat(concat('some words of text ', id, ' '), CAST(5 + id % 40 AS INT)) AS text")
    got = pack_documents(docs, BYTE)
    sizes = [r["n"] for r in got.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(n < 1024 for n in sizes) <= max(10, 0.02 * len(sizes)) and all(n & (n - 1) == 0 for n in sizes)
    whole = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert whole.count() == 1000 and whole.where("n <> t").count() == 0


def test_ranges_are_read_by_many_tasks(spark):
    docs = spark.range(0, 400, 1, 4).selectExpr("id AS doc_id", "concat('words ', id) AS text")
    folder = new_folder(spark, "ranges")
    manifest = write_token_files(docs, WORD, folder)
    read = read_token_files(manifest, folder, read_docs=10)
    per_task = [r["n"] for r in read.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 400 and len(per_task) > 8 and max(per_task) < 0.3 * 400


def test_packing_of_an_empty_table_and_of_repeats(spark):
    docs = frame(spark)
    assert pack_documents(docs.limit(0), BYTE).count() == 0
    total = sum(len(library(BYTE)(r[1])) + 1 for r in documents())
    assert pack_documents(docs, BYTE).agg({"length": "sum"}).first()[0] == total


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files_round_trip(spark, parts):
    rows = documents()
    ids = library(WORD)
    got = export_and_read(clashing(frame(spark, rows, parts)), WORD).collect()
    full = {}
    want = collections.Counter()
    for doc, text, *_ in rows:
        tokens = [*ids(text), 2]
        want[doc, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        full.setdefault(r.start, r.doc_id)
        at += r.n_tokens
    order = [-1 if d is None else d for d in full.values()]
    assert order == sorted(order)
    assert rows_of(export_and_read(frame(spark, rows[:1]).limit(0), WORD)) == []
