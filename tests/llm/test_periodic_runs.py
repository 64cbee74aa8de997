import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from clickpulse.llm.periodic_runs import WaveletMatrix, find_runs, runs_of, suffix_ranks
from clickpulse.llm.queries import with_planted_runs

from .fixtures import SF, clashing, documents, frame, rows_of


def brute_runs(w):
    """Every stretch that no neighbour extends, for every period."""
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                s = w[i:j + q]
                if all(s[d:] != s[:-d] for d in range(1, q)):
                    out.add((i, j + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(w)
    gone = {x for s, e, q in runs for x in range(s + q, e)}
    return (i, len(w), [(s, e - s, q) for s, e, q in runs], " ".join(x for k, x in enumerate(w) if k not in gone))


def periodic(rng, n, letters):
    """Random words with periodic stretches, also nested and touching ones."""
    w = []
    while len(w) < n:
        root = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            root = root * rng.randint(2, 5) + [rng.choice(letters)]
        w += (root * rng.randint(1, 9))[:rng.randint(1, 60)]
    return w[:n]


@pytest.mark.parametrize("seed", range(30))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    w = periodic(rng, rng.randint(0, 300), "ab" if seed % 3 else "abcdefgh")
    got = runs_of(np.array([ord(c) - 97 for c in w], np.int64))
    assert [tuple(r) for r in got.tolist()] == brute_runs(w)


def test_ranks_and_range_queries():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 3, 200)
    ranks, _, _ = suffix_ranks(words)
    order = np.argsort(ranks[-1][:-1])
    assert order.tolist() == sorted(range(200), key=lambda i: words[i:].tolist())
    values = rng.integers(0, 90, 120)
    tree = WaveletMatrix(values)
    lo = rng.integers(0, 60, 50)
    hi = lo + rng.integers(1, 60, 50)
    bound = rng.integers(-5, 140, 50)
    assert tree.below(lo, hi, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound)]
    nth = (hi - lo) // 2
    assert tree.nth(lo, hi, nth).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(lo, hi, nth)]


def test_documents_match_brute_force(spark):
    rng = random.Random(1)
    rows = documents(60) + [(50_000 + i, " \n".join(periodic(rng, 200, ["aa", "b", "ccc", "é"])), None, None, 0) for i in range(40)]
    rows = [r for r in rows if len((r[1] or "").split()) < 2500]
    got = [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in find_runs(clashing(frame(spark, rows))).collect()]
    assert sorted(got, key=repr) == sorted((brute_row(r[0], r[1]) for r in rows), key=repr)


def test_planted_runs(spark):
    rows = documents(200)
    got = dict((r[0], r[1]) for r in with_planted_runs(frame(spark, rows)).where("doc_id IS NOT NULL").collect())
    n_planted = 0
    for i, text, *_ in rows:
        w, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str(i).encode())
        if i is None:
            continue
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = " ".join(w[:a] + [w[a + (k - a) % p] for k in range(a, n)])
            n_planted += 1
        else:
            want = text
        assert got[i] == want
    assert n_planted > 5


def test_whole_query_matches_brute_force(spark):
    from clickpulse.llm.queries import op12_periodic_runs
    texts = with_planted_runs(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    want = {}
    for i, text in texts:
        if len(text.split()) > 1500:
            continue
        _, _, runs, collapsed = brute_row(i, text)
        s, n, q = min(((s, n, q) for s, n, q in runs), key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want[i] = (len(runs), s, n, q, None if n is None else 1000 * n // q,
                   hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
                   hashlib.sha256(collapsed.encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in op12_periodic_runs(spark, SF).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    assert len(got) == len(texts) and len(want) > 100 and sum(v[0] > 0 for v in want.values()) > 10
    assert {i: got[i] for i in want} == want


def test_long_texts_bytes_and_empty_tables(spark):
    long = "a b c " * 400_000 + "x"
    rows = [(1, long, None, None, 0), (2, None, None, None, 0)]
    got = {r["doc_id"]: r for r in find_runs(frame(spark, rows)).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 1_200_000, 3)] and got[1]["collapsed"] == "a b c x"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == ""
    odd = spark.sql("SELECT 1L AS doc_id, CAST(X'ff20ff20ff20ff20ff20ff' AS STRING) AS text")
    assert [tuple(x) for x in find_runs(odd).first()["runs"]] == [(0, 6, 1)]
    assert find_runs(odd.limit(0)).count() == 0
