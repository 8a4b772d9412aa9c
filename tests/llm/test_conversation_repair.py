"""Conversation repair against an exhaustive search, with spilling, batches and the defined cases."""

import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from proficio.llm import conversation_repair as R

ROWS = "conv_id bigint, turn bigint, role string, text string"
VALID = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        shown = text.strip(R.SPACE)
        found.append("blank" if not shown else "duplicate" if (role, text) in seen else
                     "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def cheapest(rows):
    """Dijkstra over (rows read, messages written): the least (cost, audit) whose initials are valid."""
    found = faults(rows)
    heap, best = [(0, "", 0, (), ())], {}
    while heap:
        cost, audit, i, roles, shown = heapq.heappop(heap)
        text = "".join(r[:1] for r in roles)
        if i == len(rows) and VALID.fullmatch(text):
            return cost, audit, "\n".join(shown)
        if not VALID.fullmatch(text) and not VALID.fullmatch(text + "a") and not VALID.fullmatch(text + "ua"):
            continue
        state = (i, text[-1:] if text != "" else "^")
        if best.get(state, (cost, audit)) < (cost, audit):
            continue
        best[state] = (cost, audit)
        if i < len(rows):
            role, said = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles, shown))
            if found[i] not in ("blank", "duplicate"):
                more = 5 if found[i] == "truncated" else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + (role,), shown + (f"{role}:{said}",)))
                for to in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, roles + (to,), shown + (f"{to}:{said}",)))
        for to in ("user", "assistant"):
            if audit.count("I") < 4:
                heapq.heappush(heap, (cost + 5, audit + "I", i, roles + (to,), shown + (f"{to}:",)))


def conversations(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", "user", "assistant", " ", "usher"])
            text = rng.choice(["hi.", "yes!", "why?", "cut", "", " \t", "ok.", f"t{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows


def ordered(rows, conv):
    mine = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
    return sorted(mine, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))


def check(rows, got):
    for conv, r in got.items():
        mine = ordered(rows, conv)
        pairs = [(role, text) for _, role, text in mine]
        found = faults(pairs)
        cost, audit, shown = cheapest(pairs)
        assert (r.cost, r.audit) == (cost, audit), (conv, pairs)
        assert r.repaired_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated) == tuple(found.count(f) for f in ("blank", "duplicate", "truncated"))
        initials = [role[:1] for role, _ in pairs]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = {t for t, _, _ in mine if t is not None}
        assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)


def test_repairs_equal_an_exhaustive_search(spark):
    rows = conversations(150, 3)
    got = {r.conv_id: r for r in R.repair_report(spark.createDataFrame(rows, ROWS).repartition(5)).collect()}
    assert set(got) == {r[0] for r in rows}
    check(rows, got)


def test_messages_are_the_repaired_conversation(spark):
    rows = conversations(40, 4)
    df = spark.createDataFrame(rows, ROWS)
    report = {r.conv_id: r for r in R.repair_report(df).collect()}
    said = {}
    for r in sorted(R.repaired_messages(df).collect(), key=lambda r: (r.conv_id, r.place)):
        said.setdefault(r.conv_id, []).append(r)
    for conv, r in report.items():
        mine = said.get(conv, [])
        assert [m.place for m in mine] == list(range(len(mine)))
        assert "".join(m.edit for m in mine) == r.audit.replace("D", "")
        assert VALID.fullmatch("".join(m.role[:1] for m in mine))
        assert hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in mine).encode()).hexdigest() == r.repaired_sha256


def test_a_giant_conversation_spills_and_spans_batches(spark, monkeypatch):
    n = 30_000
    rows = spark.range(n).select(
        F.lit(9007199254740993).alias("conv_id"), F.col("id").alias("turn"), F.expr("if(id % 2 = 0, 'user', 'assistant')").alias("role"),
        F.expr("concat('said ', id, if(id % 1000 = 7, '', '.'), repeat(' ', 500))").alias("text"))
    got = R.repair_report(rows).collect()
    assert len(got) == 1 and got[0].conv_id == 9007199254740993
    assert got[0].truncated == n // 1000 and len(got[0].audit.replace("I", "")) == n
    # a cut-off message is cheaper deleted than kept, and so is a neighbour of it
    assert got[0].cost == 4 * n // 1000
    small = R.Conversation("1", {})
    monkeypatch.setattr(R, "SPILL_BYTES", 1000)
    spilled = R.Conversation("1", {})
    for c in (small, spilled):
        for t in reversed(range(200)):
            c.add(t, "user" if t % 2 == 0 else "assistant", f"x{t}" + ("." if t % 9 else ""), None if t % 9 else "truncated", 1 + t % 3)
        if c is small:
            monkeypatch.setattr(R, "SPILL_BYTES", 1000)
    assert spilled.places and small.report() == spilled.report()
    spilled.close()


def test_defined_cases(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (1, 5, "user", ""), (1, 5, "user", ""),
            (2, 1, "user", "x" * 1_000_000 + "."), (3, -3, "assistant", "A."), (3, 4, "user", "B."), (4, 1, "system", "S.")]
    rows += [(5, 1, "user", "Same.")] * 500 + [(5, 2, "assistant", "Same.")] * 500
    df = spark.createDataFrame(rows, ROWS).withColumn("digest", F.lit(1)).withColumn("copies", F.lit(1)).withColumn("conv", F.lit("x"))
    got = {r.conv_id: r for r in R.repair_report(df).collect()}
    check([r for r in rows if r[0] != 5], {k: v for k, v in got.items() if k != 5})
    assert got[5].audit == "K" + "D" * 499 + "K" + "D" * 499 and got[5].cost == 2 * 998 and got[5].duplicate == 998
    assert got[5].illegal == 998 and got[5].gaps == 0
    assert got[None].audit == "DKK" and got[1].audit == "DD" and got[2].audit == "D"
    assert R.repair_report(df.limit(0)).count() == 0 and R.repaired_messages(df.limit(0)).count() == 0
    assert R.damage_report(df.limit(0)).count() == 0


def test_damage_keeps_every_conversation(spark):
    import zlib
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Say {t}. Yes!") for c in range(60) for t in range(c % 5 + 1)]
    rows += [(None, None, None, None)]
    df = spark.createDataFrame(rows, ROWS)
    after = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if k == 4:
            role = "user"
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        after += [(c, t, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    got = {r.conv_id: r for r in R.damage_report(df).collect()}
    assert set(got) == {r[0] for r in rows}
    alive = {r[0] for r in after}
    check(after, {c: r for c, r in got.items() if c in alive})
    for c, r in got.items():
        if c not in alive:
            assert (r.gaps, r.cost, r.audit, r.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("column", ["has_conv", "conv_key", "turn_key", "fault", "first", "at", "copies", "digest"])
def test_other_columns_do_not_clash(spark, column):
    df = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 2, "assistant", "Ho.")], ROWS).withColumn(column, F.lit(None))
    assert [r.audit for r in R.repair_report(df).collect()] == ["KK"]
