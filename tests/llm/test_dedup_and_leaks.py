import collections
import hashlib
import random
import re

import numpy as np
import pytest

from clickpulse.llm.components import connected_components
from clickpulse.llm.decontaminate import decontaminate, document_hits
from clickpulse.llm.simhash import forest, one_per_group, simhash_components

from .fixtures import SF, clashing, documents, frame, rows_of


def brute_fingerprint(text):
    import xxhash
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    pieces = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(values, max_bits):
    """Index of the first member of each value's group."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= max_bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("block", [16_384, 3])
def test_simhash_components_match_brute_force(spark, block):
    rows = documents()
    prints = [brute_fingerprint(r[1]) for r in rows]
    groups = brute_groups(prints, 4)
    least = {}
    for g, r in zip(groups, rows):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    want = sorted(((r[0], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups)), key=repr)
    got = simhash_components(clashing(frame(spark)), block=block).select("doc_id", "fingerprint", "component_id")
    assert rows_of(got) == want


def test_planted_bit_distances_link_exactly():
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:30]:
        for d in (1, 2, 3, 4, 5):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), d)))
    values = np.array(sorted(values), np.uint64)
    groups = brute_groups([int(v) for v in values], 4)
    links = forest(values, 4)
    index = {int(v): i for i, v in enumerate(values)}
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    assert len(links) == len(values) - len(set(groups))
    assert all(groups[index[a]] == groups[index[b]] for a, b in links)


def test_links_find_every_planted_pair(spark):
    from clickpulse.llm.simhash import links
    rng = random.Random(11)
    values = []
    for _ in range(150):
        v = rng.getrandbits(64)
        values += [v, v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))]
    signed = [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(values)]
    groups = brute_groups([v & (1 << 64) - 1 for v in signed], 4)
    parts = connected_components(links(spark.createDataFrame([(v,) for v in signed], "fp long")))
    got = {r.node: r.component for r in parts.collect()}
    got.update({c: c for c in got.values()})
    together = collections.defaultdict(set)
    for v, g in zip(signed, groups):
        together[g].add(v)
    assert {frozenset(s) for s in together.values() if len(s) > 1} == \
        {frozenset(k for k in got if got[k] == c) for c in set(got.values())}


def test_components_of_a_long_chain_and_no_edges(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(7, 7), (900, 901), (901, 900)], "a long, b long")
    got = {r.node: r.component for r in connected_components(chain).collect()}
    assert got == {**{i: 0 for i in range(1, 71)}, 901: 900}
    assert connected_components(chain.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = clashing(frame(spark))
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    rows = documents()
    groups = brute_groups([brute_fingerprint(r[1]) for r in rows], 4)
    best = {}
    for g, r in zip(groups, rows):
        if r[0] is not None:
            best[g] = min(r[0], best.get(g, r[0]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(best.values())
    assert one_per_group(docs.limit(0)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")))


def brute_hits(docs, items, window):
    windows = collections.defaultdict(set)
    for name, text in items:
        w = normal(text)
        for j in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[j:j + window])].add(str(name))
    out = []
    for doc, text in docs:
        w, hit, found = normal(text), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                names = windows.get(tuple(w[j:j + n]))
                if names:
                    hit.update(range(j, j + n))
                    found |= names
        out.append((doc, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


def hits_of(frame_):
    return sorted(((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in frame_.collect()), key=repr)


@pytest.mark.parametrize("window,part_words", [(4, 10**6), (10, 20)])
def test_hits_match_brute_force(spark, window, part_words):
    rng = random.Random(window)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12])))) for i in range(12)]
    items += [(99, None), (100, "--"), (101, items[-1][1])]
    docs = [(i, " - ".join(rng.choice(["a", "b", "C", "d", "É"]) for _ in range(rng.randint(0, 40)))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (3, docs[3][1])]
    got = document_hits(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"), window=window, part_words=part_words)
    assert hits_of(got) == brute_hits(docs, items, window)


def test_hits_over_the_tables_match_brute_force(spark):
    docs = [(r[0], r[1]) for r in documents()]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = brute_hits(docs, items, 10)
    assert hits_of(document_hits(clashing(frame(spark)), bench)) == want
    assert sum(w[2] > 0 for w in want) > 0


@pytest.mark.parametrize("part_words", [10**6, 20])
def test_items_without_an_id_hit_as_in_the_sql(spark, monkeypatch, part_words):
    import duckdb
    import pandas as pd
    from clickpulse.llm import decontaminate as module, oracles, queries
    passage, other = (" ".join(f"{c}{i}" for i in range(14)) for c in "qr")
    docs = [(1, f"before {passage} after", "en", "s", 0), (2, f"{other} {passage}", "en", "s", 0), (3, "nothing of it", "en", "s", 0)]
    items = [(None, passage), (None, passage + " more"), (7, other), (8, " ".join(f"z{i}" for i in range(40)))]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([d[:2] for d in docs], columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    tables = {"documents": frame(spark, docs), "benchmark": spark.createDataFrame(items, "item_id long, text string")}
    monkeypatch.setattr(queries, "read_table", lambda spark, sf_dir, name: tables[name])
    cut = module.document_hits
    monkeypatch.setattr(module, "document_hits", lambda *a: cut(*a, part_words=part_words))
    got = queries.QUERIES["op7_decontaminate"](spark, None)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(oracles.DECONTAMINATE).fetchall())
    assert {r.doc_id: r.n_hit for r in got.collect()} == {1: 14, 2: 28, 3: 0}
    left = {r.doc_id: r.text for r in decontaminate(tables["documents"], tables["benchmark"], max_coverage=0.9, part_words=part_words).collect()}
    assert left == {1: "before  after", 3: "nothing of it"}


def test_decontamination_cuts_spans_and_keeps_the_rest(spark):
    passage = " ".join(f"q{i}" for i in range(12))
    rows = [(1, f"Clean words that stand before it: {passage}! and clean words after it\nnext line, too", "en", "s", 0),
            (2, passage, "en", "s", 0), (3, "nothing of it", "en", "s", 0), (4, None, "en", "s", 0), (5, "", "en", "s", 0)]
    bench = spark.createDataFrame([(7, passage.upper())], "item_id long, text string")
    docs = clashing(frame(spark, rows))
    got = {r.doc_id: r for r in decontaminate(docs, bench).collect()}
    assert sorted(got) == [1, 3, 4, 5]
    assert got[1].text == "Clean words that stand before it: ! and clean words after it\nnext line, too"
    assert got[1].n_chars == len(got[1].text) and got[1].hits == "own"
    assert got[3].text == "nothing of it" and got[4].text is None
    assert decontaminate(docs, bench.limit(0)).count() == 5
    assert decontaminate(docs.limit(0), bench).count() == 0


def test_op7_digest_columns(spark):
    from clickpulse.llm.queries import QUERIES
    got = QUERIES["op7_decontaminate"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [(d, n, h, len(i.split(",")) if i else 0, hashlib.sha256(i.encode()).hexdigest(), h > 0)
            for d, n, h, i in brute_hits(docs, items, 10)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_long_items_and_many_parts_leave_no_copies_of_texts(spark):
    from clickpulse.llm.common import shared_root
    import os
    rng = random.Random(8)
    item = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(3000)]
    benchmark = spark.createDataFrame([("long", " ".join(item)), *[(f"s{i}", f"only {i} of these words") for i in range(300)]], "item_id string, text string")
    docs = [(i, " ".join(["before", *item[a:a + 40], "behind", f"only {i} of these words", "filler " * 300]), None, None, 0)
            for i, a in enumerate(range(0, 2960, 37))]
    docs += [(1000 + i, docs[0][1], None, None, 0) for i in range(50)] + [(5000, None, None, None, 0), (5001, "clean text", None, None, 0)]
    df = clashing(frame(spark, docs))
    root = shared_root(spark)
    before = {os.path.join(d, n) for d, _, ns in os.walk(root) for n in ns}
    many = {r.doc_id: r for r in document_hits(df, benchmark, part_words=2000).collect()}
    new = [p for d, _, ns in os.walk(root) for n in ns if (p := os.path.join(d, n)) not in before and n.endswith(".parquet")]
    assert sum(os.path.getsize(p) for p in new) < sum(len(d[1] or "") for d in docs)  # hits, no texts
    one = {r.doc_id: r for r in document_hits(df, benchmark).collect()}
    assert many == one and one[0].n_hit == 45 and one[1049].items == ["long", "s0"] and one[5000].n_words == 0
    kept = sorted((r.doc_id, r.text or "") for r in decontaminate(df, benchmark, part_words=2000).collect())
    assert kept == sorted((r.doc_id, r.text or "") for r in decontaminate(df, benchmark).collect())


def test_components_of_a_hub(spark):
    edges = spark.range(1, 4000).selectExpr("IF(id % 2 = 0, 0L, id) AS a", "IF(id % 2 = 0, id, 0L) AS b")
    got = connected_components(edges)
    assert got.count() == 3999 and got.where("component <> 0").count() == 0


def test_small_tables_have_few_files(spark):
    """However many partitions a shuffle has: components of 300 edges and the
    rows of 200 documents are not written to hundreds of files."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(3 * i + j, 3 * i + j + 1) for i in range(150) for j in (0, 1)], "a long, b long")
        parts = connected_components(edges)
        assert rows_of(parts) == sorted([(3 * i + j, 3 * i) for i in range(150) for j in (1, 2)], key=repr)
        assert len(parts.inputFiles()) == 1
        cores = spark.sparkContext.defaultParallelism
        docs = frame(spark)
        assert len(simhash_components(docs).inputFiles()) <= max(3, cores)
        assert one_per_group(docs.dropDuplicates(["doc_id", "text"]).repartition(3)).rdd.getNumPartitions() <= max(3, cores)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
