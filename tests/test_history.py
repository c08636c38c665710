"""SCD-2 and per-key windows against plain Python models, hot keys included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import scd2, windows

KINDS = {
    "date": lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i),
    "timestamp_ntz": lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(minutes=13 * i),
    "bigint": lambda i: i * 40_000,
}


def model(rows, tracked=None):
    """(key, seq, event, state) -> (key, seq, event, state, start, end)."""
    out = []
    for key in {r[0] for r in rows}:
        best = {}
        for r in rows:
            if r[0] == key and (r[1] not in best or r[2] > best[r[1]][2]):
                best[r[1]] = r
        line = [best[s] for s in sorted(best)]
        if tracked:
            line = [r for i, r in enumerate(line) if i == 0 or line[i - 1][3] != r[3]]
        for i, r in enumerate(line):
            out.append((*r, r[1], line[i + 1][1] if i + 1 < len(line) else None))
    return sorted(out, key=repr)


def events(rng, kind, n=400):
    make = KINDS[kind]
    hot = lambda: 0 if rng.random() < 0.4 else rng.randrange(1, 15)
    return [(hot(), make(rng.randrange(120)), e, rng.choice(["up", "down", None])) for e in range(n)]


@pytest.mark.parametrize("kind", KINDS)
def test_history_equals_the_model(spark, kind):
    rows = events(random.Random(kind), kind)
    df = spark.createDataFrame(rows, f"k int, seq {kind}, event int, state string")
    got = scd2.scd2_history(df, ["k"], "seq", [F.desc("event")])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == model(rows)

    subset = scd2.scd2_history(df, ["k"], "seq", [F.desc("event")], tracked=["state"])
    want = sorted(((k, s, st, a, b) for k, s, _, st, a, b in model(rows, tracked=True)), key=repr)
    assert sorted((tuple(r) for r in subset.collect()), key=repr) == want


def test_zone_free_sequence_across_a_skipped_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = dt.datetime(2024, 3, 10)
        rows = [(1, start + dt.timedelta(minutes=15 * i), i, "x") for i in range(40)]
        df = spark.createDataFrame(rows, "k int, seq timestamp_ntz, event int, state string")
        got = scd2.scd2_history(df, ["k"], "seq", [F.desc("event")])
        assert sorted((tuple(r) for r in got.collect()), key=repr) == model(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_arrival_order_does_not_matter(spark):
    rng = random.Random(7)
    rows = events(rng, "date", 200)
    schema = "k int, seq date, event int, state string"
    how = (["k"], "seq", [F.desc("event")])
    shuffled = rows + rng.sample(rows, 30)
    rng.shuffle(shuffled)
    history = scd2.scd2_history(spark.createDataFrame(shuffled[:60], schema), *how)
    for start in (60, 130):
        batch = spark.createDataFrame(shuffled[start : start + 100] or shuffled[-1:], schema)
        history = scd2.scd2_apply(history, batch, *how)
    got = [tuple(r) for r in history.collect()]
    assert sorted(got, key=repr) == model(rows)

    open_rows = [r[0] for r in got if r[5] is None]
    assert sorted(open_rows) == sorted({r[0] for r in rows})
    assert all(r[5] is None or r[4] < r[5] for r in got)
    day = dt.date(2020, 2, 15)
    valid = scd2.scd2_as_of(history, F.lit(day)).collect()
    assert len({r["k"] for r in valid}) == len(valid)


def test_missing_sequence_is_refused(spark):
    df = spark.createDataFrame([(1, None, 1, "x")], "k int, seq date, event int, state string")
    with pytest.raises(Exception, match="seq is set"):
        scd2.scd2_history(df, ["k"], "seq", [F.desc("event")]).collect()


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour_is_the_same_with_and_without_pieces(spark, ahead):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    plain = windows.neighbour(df, ["k"], "n", F.col("n") * 2, "out", ahead)
    pieces = windows.neighbour(df, ["k"], "n", F.col("n") * 2, "out", ahead, split=F.floor(F.col("n") / 17))
    assert plain.exceptAll(pieces).isEmpty() and pieces.exceptAll(plain).isEmpty()
    assert pieces.columns == plain.columns


def test_global_rank_with_a_dominant_value(spark):
    rng = random.Random(3)
    values = [5 if rng.random() < 0.35 else rng.randrange(1000) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v bigint")
    want = {i: 1 + sum(o > v for o in values) for i, v in enumerate(values)}
    for rank in (windows.global_rank, windows.bounded_rank):
        assert {r["id"]: r["r"] for r in rank(df, "v", "r").collect()} == want
    assert windows.global_rank(df.limit(0), "v", "r").count() == 0


def test_tracked_columns_in_any_order_of_arrival(spark):
    import random

    draw = random.Random(4)
    rows = [(k, s, draw.choice("ab"), s * 10 + i) for k in range(12) for s in draw.sample(range(30), 12) for i in range(draw.choice([1, 1, 2]))]
    rows += [(99, s, None if s % 3 else "a", s) for s in range(40)]
    how = (["k"], "seq", [F.desc("event")])
    frame = lambda part: spark.createDataFrame(part, "k int, seq int, state string, event int")
    want = sorted(map(tuple, scd2.scd2_history(frame(rows), *how, tracked=["state"]).collect()), key=repr)
    for _ in range(3):
        draw.shuffle(rows)
        cuts = [0, 30, 31, 90, len(rows)]
        state = scd2.scd2_versions(frame(rows[:0]), *how, ["state"])
        for a, b in zip(cuts, cuts[1:], strict=False):
            state = spark.createDataFrame(scd2.scd2_apply(state, frame(rows[a:b]), *how, tracked=["state"]).toArrow())
        got = scd2.scd2_merged(state, ["k"], "seq", ["state"])
        assert sorted(map(tuple, got.collect()), key=repr) == want
        assert scd2.scd2_current(got).count() == 13
