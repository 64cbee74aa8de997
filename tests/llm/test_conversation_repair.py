import collections
import functools
import hashlib
import random
import re
import zlib

import pytest

from clickpulse.llm.conversation_repair import audit, repair_report, repaired_turns, total_cost
from clickpulse.llm.queries import damaged, op13_conversations

from .fixtures import SF, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def brute_audit(rows):
    """rows (initial, must go, truncated) -> least (cost, audit), from the end."""
    @functools.lru_cache(None)
    def best(i, state, inserts):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            initial, gone, cut = rows[i]
            steps = [("D", 2, state)]
            if not gone:
                steps.append(("R", 1 + 5 * cut, NEXT[state]))
                if initial == NEXT[state] or (initial == "s" and state == ""):
                    steps.append(("K", 5 * cut, initial))
            for e, c, to in steps:
                cost, rest = best(i + 1, to, 0)
                options.append((c + cost, e + rest))
        if inserts < 3:
            cost, rest = best(i, NEXT[state], inserts + 1)
            options.append((5 + cost, "I" + rest))
        return min(options, default=(10 ** 9, ""))

    return best(0, "", 0)


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        d = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def brute_report(rows):
    """Rows after damage of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, count, kinds = set(), collections.Counter(), []
    for _, _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        count[fault] += 1
        kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
    cost, edits = brute_audit(tuple(kinds))
    lines, state, at = [], "", 0
    for e in edits:
        if e == "D":
            at += 1
            continue
        if e == "I":
            role, text = {"u": "user", "a": "assistant"}[NEXT[state]], ""
            state = NEXT[state]
        else:
            role, text = rows[at][2:]
            state = role[:1] if e == "K" else NEXT[state]
            role = role if e == "K" else {"u": "user", "a": "assistant"}[state]
            at += 1
        lines.append(f"{role}:{text}")
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows):
    groups = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        groups[r[0]].append(r)
    return sorted(((c, *brute_report(g)) for c, g in groups.items()), key=repr)


def awkward(n=60, seed=4):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "no", "", " \t", "What?\n", "end.\x0b ", "é", "same.", "a.b", None, "long " * 3000 + "."]
    for c in range(n):
        for t in range(rng.randint(1, 12)):
            role = ("user", "assistant")[t % 2] if rng.random() < 0.7 else rng.choice(["system", "user", "assistant", "tool", "", None, "alien"])
            rows.append((c if c else None, rng.choice([t, t, t, t + 1, None]), role, rng.choice(texts) if rng.random() < 0.5 else f"{c} {t}."))
    return rows + rows[:25]


@pytest.mark.parametrize("seed", range(40))
def test_audit_matches_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = tuple((rng.choice("suuaax" if seed % 2 else "ua"), rng.random() < 0.1, rng.random() < 0.3) for _ in range(rng.randint(0, 40)))
        kinds = bytes(8 if gone else {"s": 0, "u": 1, "a": 2}.get(i, 3) + 4 * cut for i, gone, cut in rows)
        cost, want = brute_audit(rows)
        assert audit(kinds) == want and total_cost(want, kinds) == cost


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("segment", [4096, 3])
def test_reports_match_brute_force(spark, segment):
    rows = brute_damage(awkward()) + [(7, i, "user" if i % 3 else "assistant", "hot." if i % 2 else f"{i}.") for i in range(300)]
    got = repair_report(spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS part", "'x' AS kind"), segment=segment)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    assert rows_of(got.select(COLUMNS)) == sorted(((c, *brute_report(g)) for c, g in groups.items()), key=repr)


@pytest.mark.parametrize("segment", [4096, 3])
def test_repaired_turns_read_as_the_digest(spark, segment):
    rows = spark.createDataFrame(brute_damage(awkward(20)), SCHEMA)
    lines = collections.defaultdict(list)
    for r in repaired_turns(rows, segment=segment).orderBy("conv_id", "part", "segment", "place").collect():
        lines[r["conv_id"]] += [f"{r['role']}:{r['text']}"] if r["role"] is not None else []
    for r in repair_report(rows).collect():
        text = "\n".join(lines[r["conv_id"]])
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]
        initials = "".join(x[0] for x in lines[r["conv_id"]])
        assert re.fullmatch("(s?(ua)+)?", initials)


def test_damage_and_whole_query(spark, scratch):
    rows = awkward(80, 9) + [(900 + i, 0, "user", "alone.") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/conversations.parquet")
    assert rows_of(damaged(spark.read.parquet(f"{scratch}/conversations.parquet"))) == sorted(brute_damage(rows), key=repr)
    got = op13_conversations(spark, scratch)
    want = brute(rows)
    assert rows_of(got.select(COLUMNS)) == want
    assert any(w[7] == "" for w in want)


def test_table_and_empty_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op13_conversations(spark, SF).select(COLUMNS)) == brute(rows)
    assert repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation_is_many_segments(spark):
    rows = spark.range(6000).selectExpr("IF(id % 3 = 0, -1L, id) AS conv_id", "id AS turn",
                                        "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, '.') AS text")
    got = repair_report(rows.repartition(7), segment=100).where("conv_id = -1").collect()
    assert len(got) == 1 and got[0]["audit"] == "K" * 2000 and got[0]["cost"] == 0 and got[0]["illegal"] == 0
