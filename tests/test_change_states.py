"""Stored add and delete sketches against replaying the changes."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.aggregates import daily_changes, fold_changes


@pytest.fixture(scope="module")
def changes():
    draw = random.Random(6)
    out = []
    for i in range(3000):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=draw.randint(0, 40), seconds=draw.randint(0, 9))
        out.append((i, draw.choice(["a", "a", None]), day, draw.choice([None, draw.randint(0, 200)]), draw.choice([True, False, None])))
    return out


def replay(changes, group):
    held = set()
    for _, g, ts, value, adds in sorted(changes, key=lambda c: (c[2], c[0])):
        if g == group and value is not None and adds is not None:
            (held.add if adds else held.discard)(value)
    return held


@pytest.fixture(scope="module")
def daily(spark, changes):
    df = spark.createDataFrame(changes, "id long, g string, ts timestamp_ntz, v long, adds boolean")
    return daily_changes(df, ["g"], F.to_date("ts"), "v", F.col("adds"), [F.col("ts"), F.col("id")])


def estimates(folded):
    return {r["g"]: r["n"] for r in folded.select("g", F.expr("theta_sketch_estimate(added)").alias("n")).collect()}


@pytest.mark.parametrize("fan", [2, 7, 100])
def test_fold_equals_replay(daily, changes, fan):
    """Sketches of so few values are exact."""
    assert estimates(fold_changes(daily, ["g"], fan=fan)) == {g: len(replay(changes, g)) for g in ("a", None)}


def test_folded_periods_fold_on(daily, changes):
    early = F.col("day") < F.lit("2024-01-20").cast("date")
    parts = fold_changes(daily.filter(early), ["g"]).withColumn("day", F.lit(1))
    parts = parts.unionByName(fold_changes(daily.filter(~early), ["g"]).withColumn("day", F.lit(2)))
    assert estimates(fold_changes(parts, ["g"])) == {g: len(replay(changes, g)) for g in ("a", None)}


def test_added_again_counts_again(spark):
    rows = [(1, dt.datetime(2024, 1, 1), True), (2, dt.datetime(2024, 1, 2), False), (3, dt.datetime(2024, 1, 3), True)]
    df = spark.createDataFrame([(i, "g", ts, 7, adds) for i, ts, adds in rows], "id long, g string, ts timestamp_ntz, v long, adds boolean")
    days = daily_changes(df, ["g"], F.to_date("ts"), "v", F.col("adds"), [F.col("ts"), F.col("id")])
    assert days.count() == 3
    assert estimates(fold_changes(days, ["g"])) == {"g": 1}
    assert estimates(fold_changes(days.filter("day < '2024-01-03'"), ["g"])) == {"g": 0}
    assert fold_changes(days.limit(0), ["g"]).count() == 0
