import collections
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from clickpulse.llm import quality_rules, secret_scan
from clickpulse.llm.common import read_table
from clickpulse.llm.decontaminate import Hits, without_spans, words_of

from .test_dedup_and_leaks import brute_fingerprint, brute_groups
from .test_tokens import BYTE, library

SF = "/root/testdata/sf0.001"


def brute_spans(words, items, window=10):
    """Hit spans by comparing every window."""
    spans = []
    for item in items:
        n = min(window, len(item))
        starts = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)} if n else set()
        spans += [(j, j + n) for j in range(len(words) - n + 1) if tuple(words[j:j + n]) in starts]
    return Hits(len(words), spans, set())


def test_pipeline_matches_a_plain_run(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").orderBy("doc_id").collect()]
    field = quality_rules.train_field(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    docs = [d for d in docs if quality_rules.judge(d[1], field, 0.5)[2]]
    groups = brute_groups([brute_fingerprint(t) for _, t in docs], 4)
    docs = [d for i, d in enumerate(docs) if groups[i] == i]
    items = [words_of(r.text.encode()) for r in read_table(spark, SF, "benchmark").collect()]
    clean = []
    for doc, text in docs:
        hits = brute_spans(words_of(text.encode()), items)
        if hits.n_hit <= 0.5 * hits.n_words:
            clean.append((doc, without_spans(text.encode(), hits.spans).decode()))
    enc = secret_scan._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want, ids = {}, library(BYTE)
    for doc, text in clean:
        base = secret_scan.base_spans(text)
        text = secret_scan.masked(text, base + secret_scan.random_spans(text, base, enc, 2.0), "[secret]")
        want[doc] = [*ids(text), 0]
    got = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for doc, pieces in got.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want[doc]))
            assert r.ids_crc32 == zlib.crc32(np.array(want[doc][at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want[doc])


@pytest.mark.parametrize("k", range(4))
def test_stages_return_the_columns_of_documents(spark, k):
    docs = read_table(spark, SF, "documents")
    out = corpus_pipeline.STAGES[k][1](spark, docs, SF)
    assert out.columns == docs.columns and 0 < out.count() <= docs.count()


def test_stages_take_empty_tables(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_registered_queries():
    import __spark_entry__ as e
    names = list(e.queries())
    for n in range(1, 11):
        assert any(x.startswith(f"op{n}_") for x in names)
    assert "pipeline" in names
