"""Moving frames against direct evaluation, with NULLs, ties, hot groups and wide frames."""
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.frames import micros, moving_distinct, moving_extremes, previous, sliding_distinct, sliding_extremes
from tidewater.operators.skew import running

SCHEMA = "id long, g string, at long, v double, _note string"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    out = []
    for i in range(600):
        g = draw.choice(["hot", "hot", "hot", "a", "b", None])
        at = draw.choice([None, draw.randint(-50, 50), draw.randint(0, 400)])
        v = draw.choice([None, float(draw.randint(0, 6)), draw.random() * 100 - 50])
        out.append((i, g, at, v, "n"))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def range_frame(rows, g, at, width):
    own = [r for r in rows if r[1] == g]
    if at is None:
        return [r[3] for r in own if r[2] is None and r[3] is not None]
    return [r[3] for r in own if r[2] is not None and at - width <= r[2] <= at and r[3] is not None]


@pytest.mark.parametrize("max_rows", [7, 10_000])
@pytest.mark.parametrize("width", [0, 1, 13, 1000])
def test_sliding(table, rows, width, max_rows):
    low = sliding_extremes(table, ["g"], "at", width, F.col("v"), "low", "high", max_rows).collect()
    kinds = sliding_distinct(table, ["g"], "at", width, F.col("v"), "n", max_rows).collect()
    places = {(r[1], r[2]) for r in rows}
    assert len(low) == len(kinds) == len(places)
    for r in low:
        frame = range_frame(rows, r["g"], r["at"], width)
        assert (r["low"], r["high"]) == (min(frame, default=None), max(frame, default=None))
    for r in kinds:
        assert r["n"] == len(set(range_frame(rows, r["g"], r["at"], width)))


@pytest.mark.parametrize("max_rows", [7, 10_000])
@pytest.mark.parametrize("size", [1, 5, 90])
def test_moving(table, rows, size, max_rows):
    value = F.col("v")
    low = moving_extremes(table, ["g"], ["id"], value, size, "low", "high", max_rows)
    kinds = moving_distinct(table, ["g"], ["id"], value, size, "n", max_rows)
    assert low.columns == [*table.columns, "low", "high"] and kinds.columns == [*table.columns, "n"]
    want = {}
    for r in rows:
        own = [x[3] for x in rows if x[1] == r[1] and x[0] <= r[0]][-size:]
        want[r[0]] = [v for v in own if v is not None]
    got = low.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["low"], r["high"]) == (min(want[r["id"]], default=None), max(want[r["id"]], default=None))
    assert {r["id"]: r["n"] for r in kinds.collect()} == {i: len(set(f)) for i, f in want.items()}


def test_frames_without_keys_and_of_nothing(spark, table, rows):
    got = sliding_extremes(table, [], "at", 20, F.col("v"), "low", "high", 50).collect()
    every = [(r[0], None, *r[2:]) for r in rows]
    for r in got:
        frame = range_frame(every, None, r["at"], 20)
        assert (r["low"], r["high"]) == (min(frame, default=None), max(frame, default=None))
    none = spark.createDataFrame([], SCHEMA)
    assert sliding_distinct(none, ["g"], "at", 5, F.col("v"), "n").count() == 0
    assert moving_extremes(none, ["g"], ["id"], F.col("v"), 500, "low", "high").count() == 0


@pytest.mark.parametrize("max_rows", [9, 10_000])
def test_running_extremes(table, rows, max_rows):
    folds = {"low": ("min", F.col("v")), "high": ("max", F.struct("v", "id")), "n": ("sum", F.lit(1))}
    for r in running(table, ["g"], [F.col("id")], folds, max_rows).collect():
        seen = [x for x in rows if x[1] == r["g"] and x[0] <= r["id"]]
        assert r["n"] == len(seen)
        assert r["low"] == min((x[3] for x in seen if x[3] is not None), default=None)
        highest = max((x[3] is not None, x[3] or 0.0, x[0]) for x in seen)
        assert tuple(r["high"]) == (highest[1] if highest[0] else None, highest[2])


@pytest.mark.parametrize("max_rows", [5, 10_000])
def test_previous(spark, max_rows):
    places = {(g, at) for g in ("hot", None, "a") for at in random.Random(2).sample(range(99), 40 if g == "hot" else 3)}
    df = spark.createDataFrame(sorted(places, key=repr), "g string, at long")
    for r in previous(df, ["g"], "at", "before", max_rows).collect():
        assert r["before"] == max((a for g, a in places if g == r["g"] and a < r["at"]), default=None)


def test_micros(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-02 00:00:01' AS a")
    assert df.select(micros(F.col("a")).alias("m")).first()["m"] == 86_401_000_000
    assert df.select(micros(F.lit("1969-12-31").cast("date")).alias("m")).first()["m"] == -86_400_000_000


def test_wide_frames_do_not_fold_rows_again(table):
    """No sliding window is planned for a wide frame: every window starts at its group's first row."""
    plan = moving_extremes(table, ["g"], ["id"], F.col("v"), 500, "low", "high")._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RowFrame, -" not in plan
