"""Hot groups take other paths; the results must not differ from plain windows and joins."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.ranges import count_below, laid_on_buckets, overlap_counts, overlap_join
from tidewater.operators.relational import band_join, exact_percentiles, rank_at_most
from tidewater.operators.skew import numbered, running_sums, salted_join, split_hot
from tidewater.operators.windows import moving_sum, navigate, ntile_of, ranks, sliding_totals


@pytest.fixture(scope="module")
def rows(spark):
    """600 rows; key 'hot' has a third of them, one key is NULL."""
    rng = random.Random(5)
    keys = ["hot"] * 200 + [None] * 60 + [f"k{i % 17}" for i in range(340)]
    data = [(i, k, rng.randint(0, 25), rng.choice(["a", "b", None])) for i, k in enumerate(keys)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "id bigint, k string, v bigint, s string").repartition(5).cache()


def collect(df, *columns):
    """Rows as sorted tuples; None sorts before everything else."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def test_split_hot_keeps_every_row(rows):
    cold, hot, n = split_hot(rows, ["k"], max_rows=50)
    assert n == 260
    assert {r["k"] for r in hot.select("k").distinct().collect()} == {"hot", None}
    assert cold.count() + hot.count() == rows.count()


@pytest.mark.parametrize("max_rows", [20, 1000])
def test_running_sums(rows, max_rows):
    w = Window.partitionBy("k").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = collect(rows.withColumn("r", F.sum("v").over(w)), "id", "r")
    got = running_sums(rows, ["k"], [F.col("v"), F.col("id")], {"r": F.col("v")}, max_rows)
    assert collect(got, "id", "r") == want


def test_running_sums_descending(rows):
    w = Window.partitionBy("k").orderBy(F.desc("v"), F.desc("id"))
    want = collect(rows.withColumn("rn", F.row_number().over(w)), "id", "rn")
    got = numbered(rows, ["k"], [F.desc("v"), F.desc("id")], "rn", max_rows=30)
    assert collect(got, "id", "rn") == want


@pytest.mark.parametrize("max_rows", [70, 10_000])
def test_running_sums_without_keys(rows, max_rows):
    got = numbered(rows, [], [F.col("v"), F.col("id")], "rn", max_rows)
    assert [r["rn"] for r in got.orderBy("v", "id").collect()] == list(range(1, 601))


def test_ranks_hot_equals_plain(rows):
    names = ["row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile"]
    plain = collect(ranks(rows, ["k"], "v", "id", 7), "id", *names)
    sliced = collect(ranks(rows, ["k"], "v", "id", 7, max_rows=15), "id", *names)
    assert sliced == plain


@pytest.mark.parametrize("total", [1, 5, 12, 13, 100])
def test_ntile_of(spark, total):
    df = spark.range(1, total + 1)
    w = Window.orderBy("id")
    both = df.select(F.ntile(5).over(w).alias("a"), ntile_of(F.col("id"), F.lit(total), 5).alias("b"))
    assert both.filter("a <> b").count() == 0


def test_navigate_hot_equals_plain(rows):
    names = ["lag_value", "lead_value", "first_value", "last_value", "nth_value", "last_known"]
    plain = collect(navigate(rows, ["k"], ["v", "id"], "s", 3), "id", *names)
    sliced = collect(navigate(rows, ["k"], ["v", "id"], "s", 3, max_rows=40), "id", *names)
    assert sliced == plain


def test_moving_sum_hot_equals_plain(rows):
    plain = collect(moving_sum(rows, ["k"], ["v", "id"], F.col("v"), 4, "m"), "id", "m")
    sliced = collect(moving_sum(rows, ["k"], ["v", "id"], F.col("v"), 4, "m", max_rows=33), "id", "m")
    assert sliced == plain


@pytest.mark.parametrize("max_rows", [25, 10_000])
def test_sliding_totals_equal_range_frame(rows, max_rows):
    timed = rows.withColumn("ts", F.timestamp_seconds(F.col("v") * 60).cast("timestamp_ntz"))
    w = Window.partitionBy("k").orderBy(F.col("v")).rangeBetween(-5, 0)
    want = timed.select("k", "ts", F.sum("id").over(w).alias("t"), F.count("id").over(w).alias("n")).distinct()
    got = sliding_totals(timed, ["k"], "ts", "5 MINUTE", {"t": F.col("id"), "n": F.lit(1).cast("bigint")}, max_rows)
    assert collect(got, "k", "ts", "t", "n") == collect(want, "k", "ts", "t", "n")


@pytest.mark.parametrize("max_rows", [5, 10_000])
def test_exact_percentiles(rows, max_rows):
    known = rows
    want = known.groupBy("k").agg(
        F.expr("percentile(v, 0.3)").alias("p"), F.expr("percentile_disc(0.3) WITHIN GROUP (ORDER BY v)").cast("bigint").alias("d")
    )
    got = exact_percentiles(known, ["k"], "v", {"p": 0.3}, max_rows).select("k", "p", F.col("p_disc").alias("d"))
    rounded = lambda df: [(k, round(p, 9), d) for k, p, d in collect(df, "k", "p", "d")]
    assert rounded(got) == rounded(want)
    whole = exact_percentiles(known, [], "v", {"p": 0.5}, max_rows).first()
    assert whole["p"] == known.agg(F.expr("percentile(v, 0.5)")).first()[0]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, rows, how):
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("k3", 3), ("zz", 4)], "k string, x int")
    got = salted_join(rows, small, ["k"], how, salt_by=["id"], max_rows=30)
    want = rows.join(small, "k", how)
    assert collect(got, *want.columns) == collect(want, *want.columns)


def test_rank_at_most_limits_before_the_shuffle(rows):
    top = rank_at_most(rows, ["k"], [F.desc("v"), F.asc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()
    assert top.groupBy("k").count().filter("count > 2").count() == 0


@pytest.mark.parametrize("max_rows", [10, 10_000])
def test_band_join(spark, max_rows):
    rng = random.Random(3)
    points = [(i, rng.choice([5.0, round(rng.uniform(-20, 20), 2)])) for i in range(300)]
    bands = [(i, lo := round(rng.uniform(-20, 20), 2), lo + rng.choice([0.0, 0.5, 7.0])) for i in range(60)]
    p = spark.createDataFrame(points, "id bigint, v double")
    b = spark.createDataFrame(bands, "band bigint, lo double, hi double")
    want = sorted((i, j) for i, v in points for j, lo, hi in bands if lo <= v < hi)
    got = band_join(p, b, "v", "lo", "hi", 2.0)
    assert sorted((r["id"], r["band"]) for r in got.collect()) == want
    semi = band_join(p, b, "v", "lo", "hi", 2.0, how="left_semi")
    assert sorted(r["id"] for r in semi.collect()) == sorted({i for i, _ in want})


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(8)

    def make(n, longest):
        out = []
        for i in range(n):
            a = rng.choice([1000, rng.randint(0, 20_000)])
            out.append((i, a, a + rng.randint(1, longest)))
        return out

    def frame(data, prefix):
        df = spark.createDataFrame(data, f"{prefix}id bigint, a bigint, b bigint")
        stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
        return df.select(f"{prefix}id", stamp("a").alias(f"{prefix}s"), stamp("b").alias(f"{prefix}e"))

    left, right = make(150, 4000), make(120, 900)
    pairs = sorted((i, j) for i, a, b in left for j, c, d in right if a < d and c < b)
    return frame(left, "l"), frame(right, "r"), pairs


@pytest.mark.parametrize("max_rows", [20, 100_000])
def test_overlap_join(spans, max_rows):
    left, right, pairs = spans
    got = overlap_join(left, right, ("ls", "le"), ("rs", "re"), "15 MINUTES", max_rows)
    assert sorted((r["lid"], r["rid"]) for r in got.collect()) == pairs


def test_overlap_join_compares_little_besides_its_pairs(spark):
    """Half hours and five minutes over a day, as dense as the events of many copies: two candidates a pair before."""
    at = lambda step: F.timestamp_seconds(F.col("id") * step).cast("timestamp_ntz")
    span = lambda step, minutes, p: spark.range(86_400 // step).select(
        F.col("id").alias(f"{p}id"), at(step).alias(f"{p}s"), (at(step) + F.expr(f"INTERVAL {minutes} MINUTE")).alias(f"{p}e")
    )
    left, right = span(61, 30, "l"), span(53, 5, "r")
    found = overlap_join(left, right, ("ls", "le"), ("rs", "re"), "30 MINUTE")
    laid = laid_on_buckets(left, right, ("ls", "le"), ("rs", "re"), "30 MINUTE")
    candidates = laid[0].join(laid[1], ["_left_holds", "_level", "_bucket"]).count()
    pairs = left.crossJoin(right).filter("ls < re AND rs < le").count()
    assert found.count() == found.distinct().count() == pairs
    assert candidates < 1.4 * pairs


@pytest.mark.parametrize("max_rows", [20, 100_000])
def test_overlap_counts(spans, max_rows):
    left, right, pairs = spans
    named = lambda df, p: df.select(f"{p}id", F.col(f"{p}s").alias("start"), F.col(f"{p}e").alias("end"))
    got = overlap_counts(named(left, "l"), named(right, "r"), "start", "end", max_rows=max_rows)
    want = {}
    for i, _ in pairs:
        want[i] = want.get(i, 0) + 1
    assert {r["lid"]: r["n_overlaps"] for r in got.collect() if r["n_overlaps"]} == want


def test_overlap_counts_unbounded(spark):
    span = lambda data: spark.createDataFrame(data, "id int, start string, end string").select(
        "id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")]
    )
    left = span([(1, None, None), (2, "2024-01-02", None), (3, None, "2024-01-01")])
    right = span([(1, "2024-01-01", "2024-01-02"), (2, "2024-01-05", None), (3, None, "2023-01-01")])
    got = {r["id"]: r["n_overlaps"] for r in overlap_counts(left, right, "start", "end").collect()}
    assert got == {1: 3, 2: 1, 3: 1}


def test_count_below_edges(spark):
    points = spark.createDataFrame([(1,), (2,), (5,)], "t int")
    values = spark.createDataFrame([(1,), (2,), (2,), (9,)], "t int")
    count = lambda inclusive: {
        r["t"]: r["n"] for r in count_below(points, "t", values, "t", inclusive, "n").collect()
    }
    assert count(False) == {1: 0, 2: 1, 5: 3}
    assert count(True) == {1: 1, 2: 3, 5: 3}


@pytest.fixture(scope="module")
def odd_rows(spark):
    """Values that are NULL at the head of slices, NaN, infinite or do not add exactly."""
    rng = random.Random(9)
    pick = lambda i: None if i % 5 < 2 else rng.choice([0.1, 0.2, 1e7, -1e7, 3.3])
    data = [(i, "hot" if i % 3 else "cold", i // 4, pick(i)) for i in range(240)]
    data += [(1000 + i, "odd", i, float("nan") if i == 7 else float("inf") if i == 19 else 0.1) for i in range(60)]
    data += [(2000 + i, "none", i, None) for i in range(40)]
    rows = spark.createDataFrame(data, "id bigint, k string, t bigint, v double")
    return rows.withColumn("ts", F.timestamp_seconds(F.col("t") * 30).cast("timestamp_ntz")).cache()


def same(a, b):
    return a == b or (a is not None and b is not None and (str(a) == str(b) == "nan" or a == pytest.approx(b, rel=1e-9, abs=1e-3)))


@pytest.mark.parametrize("max_rows", [6, 10_000])
def test_frames_over_odd_values_equal_plain_windows(odd_rows, max_rows):
    w = Window.partitionBy("k").orderBy("t", "id")
    want = odd_rows.withColumn("m", F.sum("v").over(w.rowsBetween(-2, 0)))
    got = moving_sum(odd_rows, ["k"], ["t", "id"], F.col("v"), 3, "m", max_rows)
    assert all(same(a[1], b[1]) for a, b in zip(collect(got, "id", "m"), collect(want, "id", "m")))
    day = F.expr("sum(v) OVER (PARTITION BY k ORDER BY ts RANGE BETWEEN INTERVAL 2 MINUTE PRECEDING AND CURRENT ROW)")
    want = odd_rows.select("k", "ts", day.alias("s")).distinct()
    got = sliding_totals(odd_rows, ["k"], "ts", "2 MINUTE", {"s": F.col("v")}, max_rows)
    wanted = {(r["k"], r["ts"]): r["s"] for r in want.collect()}
    rows = got.collect()
    assert len(rows) == len(wanted) and all(same(r["s"], wanted[r["k"], r["ts"]]) for r in rows)


@pytest.mark.parametrize("max_rows", [6, 10_000])
def test_running_sums_with_nulls(odd_rows, max_rows):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    whole = odd_rows.withColumn("v", F.when(F.col("k") != "odd", (F.col("v") * 10).cast("decimal(38,4)")))
    want = collect(whole.withColumn("r", F.sum("v").over(w)), "id", "r")
    got = running_sums(whole, ["k"], [F.col("t"), F.col("id")], {"r": F.col("v")}, max_rows)
    assert collect(got, "id", "r") == want


def test_salted_join_counts_pairs(spark):
    """A key that is not hot on either side but is by their product gets salts."""
    left = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    got = salted_join(left, right, ["k"], max_rows=210)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 40_000 and got.distinct().count() == 40_000


def test_long_bands_and_open_ranges(spark):
    points = spark.createDataFrame([(i, float(i * 1000)) for i in range(50)], "id bigint, v double")
    bands = spark.createDataFrame([(1, 0.0, 1e9), (2, 999.0, 1001.0), (3, -1e12, 2000.0)], "band bigint, lo double, hi double")
    got = sorted((r["id"], r["band"]) for r in band_join(points, bands, "v", "lo", "hi", 1.0).collect())
    want = sorted((i, b) for i in range(50) for b, lo, hi in ((1, 0, 1e9), (2, 999, 1001), (3, -1e12, 2000)) if lo <= i * 1000 < hi)
    assert got == want
    semi = band_join(points, bands.filter("band > 1"), "v", "lo", "hi", 1.0, how="left_semi")
    assert sorted(r["id"] for r in semi.collect()) == [0, 1]
    ts = lambda x: None if x is None else f"2024-01-{x:02d} 00:00:00"
    spans = [(1, ts(1), ts(3)), (2, None, ts(2)), (3, ts(2), None), (4, None, None), (5, ts(9), ts(9)), (6, ts(20), ts(21))]
    df = spark.createDataFrame(spans, "i int, s string, e string").select("i", *[F.col(c).cast("timestamp_ntz").alias(c) for c in "se"])
    other = df.select(F.col("i").alias("j"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    got = sorted((r["i"], r["j"]) for r in overlap_join(df, other, ("s", "e"), ("s2", "e2"), "1 HOUR").collect())
    low, high = (lambda x: x or "0"), (lambda x: x or "9")
    fine = [x for x in spans if x[0] != 5]
    assert got == sorted((a[0], b[0]) for a in fine for b in fine if low(a[1]) < high(b[2]) and low(b[1]) < high(a[2]))
