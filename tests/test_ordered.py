"""Running aggregates must not depend on how the order is cut into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.feed import in_batches
from tidemark.operators.freshness import fold_state, judge
from tidemark.operators.notices import coalesced
from tidemark.operators.ordered import Running, chunk_of, running


def feed(n, seed):
    """A feed whose key 1 holds two thirds of all rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 1 if rng.random() < 0.66 else rng.randrange(2, 9)
        action = rng.choices([1, 2, 3], [20, 1, 3])[0] if i > n // 3 else 1
        rows.append((i, i, key, action, i * 10 - rng.choice([0, 0, 0, 35]), f"m{i}"))
    return rows


SCHEMA = "seq bigint, event_id bigint, ID bigint, Action int, InsertTime bigint, Message string"


def expected_verdicts(rows, strict=True):
    newest, dead, out = {}, set(), {}
    for seq, event, key, action, at, _ in sorted(rows):
        if action == 2:
            dead.add(key)
            out[event] = "valid"
            continue
        if action == 3 and not strict:
            dead.discard(key)
            newest.pop(key, None)
        if key not in dead or strict:
            newest[key] = max(newest.get(key, at), at)
        if action == 3:
            out[event] = "valid"
        elif key in dead:
            out[event] = "tombstoned"
        else:
            out[event] = "valid" if newest[key] == at else "stale"
    return out


@pytest.mark.parametrize("width, hot", [(1, 0), (7, 0), (50, 40), (10_000, 0), (50, 10_000)])
def test_running_is_independent_of_chunks(spark, width, hot):
    rows = feed(300, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    out = running(
        df, ["ID"], [F.col("seq")], chunk_of(F.col("seq"), width),
        Running("top", "max", F.col("InsertTime")), Running("low", "min", F.col("InsertTime")),
        Running("total", "sum", F.col("seq")), Running("n", "count"),
        Running("before", "max", F.col("InsertTime"), before=True),
        limit=hot,
    ).collect()
    seen = {}
    got = {r["seq"]: r for r in out}
    assert len(got) == len(rows)
    for seq, _, key, _, at, _ in sorted(rows):
        past = seen.setdefault(key, [])
        r = got[seq]
        assert r["before"] == (max(a for _, a in past) if past else None)
        past.append((seq, at))
        assert (r["top"], r["low"]) == (max(a for _, a in past), min(a for _, a in past))
        assert (r["total"], r["n"]) == (sum(s for s, _ in past), len(past))


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("width", [5, 64, 10_000])
def test_verdicts_match_the_rule(spark, strict, width):
    rows = feed(400, 11)
    df = spark.createDataFrame(rows, SCHEMA)
    out = judge(df, keys=("ID",), chunk=chunk_of(F.col("seq"), width), strict=strict, hot_rows=30)
    got = {r["event_id"]: r["verdict"] for r in out.select("event_id", "verdict").collect()}
    assert got == expected_verdicts(rows, strict)


def test_state_carries_over_batches(spark):
    rows = feed(300, 5)
    got, state = {}, None
    for part in (rows[:100], rows[100:180], rows[180:]):
        df = spark.createDataFrame(part, SCHEMA)
        got |= {r["event_id"]: r["verdict"] for r in judge(df, ("ID",), state=state, hot_rows=20, chunk=chunk_of(F.col("seq"), 9)).collect()}
        state = fold_state(df, state, ("ID",))
    assert got == expected_verdicts(rows)
    assert state.count() == len({r[2] for r in rows})


def test_state_needs_the_strict_rule(spark):
    df = spark.createDataFrame(feed(5, 1), SCHEMA)
    with pytest.raises(ValueError):
        judge(df, ("ID",), strict=False, state=fold_state(df, keys=("ID",)))


@pytest.mark.parametrize("width", [3, 1000])
def test_batches_follow_the_global_order(spark, width):
    rows = [(i, i, i % 4, 1, (i * 37) % 101, i % 3, 0) for i in range(230)]
    df = spark.createDataFrame(
        rows, "seq bigint, event_id bigint, ID bigint, Action int, InsertTime bigint, JMSPriority int, ProducerStatus int"
    )
    got = {r["event_id"]: (r["batch"], r["high_water"]) for r in in_batches(df, 2, ("seq",), 50, width).collect()}
    order = sorted(rows, key=lambda r: (-r[5], r[0]))
    for i, row in enumerate(order):
        lot = order[i // 50 * 50 : i + 1]
        assert got[row[1]] == (i // 50, max(r[4] for r in lot))


@pytest.mark.parametrize("width", [40, 100_000])
def test_notices_match_a_sequential_run(spark, width):
    rng, at, rows = random.Random(2), 0, []
    for i in range(500):
        at += rng.choice([1, 2, 3, 3, 60]) if i > 260 else 1
        rows.append(("a" if rng.random() < 0.8 else "b", at, i, 1))
    df = spark.createDataFrame(rows, "item_type string, at_ms bigint, event_id bigint, Action int")
    chunk = F.floor(F.col("at_ms") / width)
    got = coalesced(df, ["item_type"], "at_ms", ["event_id"], chunk, quiet_ms=20, hot_rows=100).collect()
    want = []
    for key in ("a", "b"):
        lot = []

        def flush():
            if len(lot) > 3:
                want.append((key, -1, len(lot), lot[0], lot[-1]))
            else:
                want.extend((key, 1, 1, t, t) for t in lot)
            lot.clear()

        for _, t, _, _ in [r for r in rows if r[0] == key]:
            if lot and (t - lot[-1] > 20 or len(lot) == 100):
                flush()
            lot.append(t)
        flush()
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("limit", [60, 500, 10_000])
def test_running_by_position_needs_no_arrival_number(spark, limit):
    rows = [(None if i % 11 == 0 else f"k{i % 3}", f"{(i * 7919) % 501:05d}", i) for i in range(501)]
    rows += [("all", f"{(i * 104729) % 2003:05d}", i) for i in range(2003)]
    df = spark.createDataFrame(rows, "k string, at string, v bigint")
    out = running(
        df, ["k"], [F.col("at")], None, Running("total", "sum", F.col("v")), Running("n", "count"),
        Running("before", "max", F.col("v"), before=True), limit=limit,
    ).collect()
    by_key = {}
    for k, at, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        by_key.setdefault(k, []).append((at, v))
    want = {}
    for k, found in by_key.items():
        total, top = 0, None
        for n, (at, v) in enumerate(found, 1):
            total += v
            want[(k, at)] = (total, n, top)
            top = v if top is None else max(top, v)
    assert {(r["k"], r["at"]): (r["total"], r["n"], r["before"]) for r in out} == want


def test_one_key_with_all_rows_is_many_tasks(spark):
    """The order column has few, small values: chunks follow positions, so no task holds more than one."""
    df = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("sort"), "id")
    out = running(df, ["k"], [F.col("sort"), F.col("id")], None, Running("n", "count"), limit=2_000)
    per_task = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert max(r["count"] for r in per_task) <= 2_000 and sum(r["count"] for r in per_task) == 40_000
    assert out.where("n <> sort * 8000 + floor(id / 5) + 1").count() == 0
