import functools
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from telemetry_engine.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, fault string, letters int, part string"
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        convs = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if kind == 4:
            role = "user"
        convs += [(turn, role, text)] * (2 if kind == 3 else 1)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], md5(x[2]))) for c, r in out.items()}


def solved(rows):
    """(conv_id -> report row), by search over all edits with whole strings as tie-breakers."""
    out = {}
    for conv, turns in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in turns:
            solid = text.rstrip(BLANK)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

        @functools.cache
        def best(i, last, inserted):
            """Least (cost, initials, turns) from row i on, where the role put last is ``last``."""
            made = [("u", "user"), ("a", "assistant")]
            options = [(0, "", ())] if i == len(turns) and last in ("", "a") else []
            if inserted < 3:
                for c, name in made:
                    if (last, c) in legal:
                        cost, audit, rest = best(i, c, inserted + 1)
                        options.append((cost + 3, "I" + audit, (f"{name}:", *rest)))
            if i < len(turns):
                cost, audit, rest = best(i + 1, last, 0)
                options.append((cost + 4, "D" + audit, rest))
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 if faults[i] == "truncated" else 0
                    _, role, text = turns[i]
                    if (last, role[:1]) in legal:
                        cost, audit, rest = best(i + 1, role[:1], 0)
                        options.append((cost + more, "K" + audit, (f"{role}:{text}", *rest)))
                    for c, name in made:
                        if (last, c) in legal:
                            cost, audit, rest = best(i + 1, c, 0)
                            options.append((cost + more + 3, "R" + audit, (f"{name}:{text}", *rest)))
            return min(options, default=(10 ** 9, "", ()))

        cost, audit, rest = best(0, "", 0)
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(rest).encode()).hexdigest())
    return out


def made_rows(n, seed, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "Üser", "u"])
            text = rng.choice(["Yes.", "No!", "Why?", "cut of", "x. ", "\t\n", "", None, "a\x1c", "é.", "long " * 50 + "."])
            number = rng.choice([turn, turn, turn, turn + 3, None, 0])
            rows += [(conv if rng.random() > 0.05 else None, number, role, text)] * rng.choice([1, 1, 1, 3])
    return rows


def report(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, "p") for r in rows], SCHEMA)
    got = repair.report(df, **how).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_reports_equal_a_search_over_all_edits(spark):
    rows = made_rows(150, 1)
    assert report(spark, rows) == solved(rows)


@pytest.fixture()
def many_tasks(spark):
    """Shuffles keep all their partitions, as those of large tables do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize(("segment", "block"), [(3, 2), (8, 3), (5, 4)])
def test_conversations_cut_into_segments_give_the_same(spark, many_tasks, segment, block):
    rows = made_rows(12, 2, longest=40) + [(7, t, "user", "again.") for t in range(60)] + [(8, 5, "user", "same")] * 30
    assert report(spark, rows, segment=segment, block=block) == solved(rows)


def test_lost_conversations_empty_tables_and_very_long_texts(spark):
    lost = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    rows = [(lost, 0, "user", "Hi."), (lost + 1, 5, "user", "long " * 300_000), (lost + 1, 6, "assistant", "Yes.")]
    got = report(spark, rows)
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == solved(rows)
    assert report(spark, []) == {}


def test_repaired_turns_follow_the_pattern(spark):
    rows = made_rows(40, 3)
    df = spark.createDataFrame([(*r, "x", 1, "p") for r in rows], SCHEMA)
    turns = repair.repaired(df, damage=True).orderBy("conv_id", "part", "segment", "place", "step").collect()
    lines = {}
    for t in turns:
        lines.setdefault(t["conv_id"], []).append(t)
    expected = solved(rows)
    for conv, own in lines.items():
        text = "\n".join(f"{t['role']}:{t['text']}" for t in own)
        assert hashlib.sha256(text.encode()).hexdigest() == expected[conv][-1]
        initials = "".join(t["role"][:1] for t in own)
        assert initials.lstrip("s") == "ua" * (len(initials.lstrip("s")) // 2) and not initials.startswith("ss")


def test_tables_are_small_and_blocks_equal_steps():
    t = repair.tables(3)
    assert t.n < 100
    rng = random.Random(4)
    for _ in range(200):
        v, s = rng.randrange(t.n), [rng.randrange(10) for _ in range(3)]
        one = v
        for x in reversed(s):
            one = t.step[one, x]
        assert t.blocks[v, s[0] * 100 + s[1] * 10 + s[2]] == one


def test_a_long_conversation_runs_in_many_tasks(spark, many_tasks):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                    F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    steps = repair.steps(rows, segment=256)
    assert steps.select("part").distinct().count() > 1
    assert steps.groupBy("part", "segment").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] <= 256
