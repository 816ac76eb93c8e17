"""Differentially private group-by.

Every privacy unit (a user) is brought down to bounded influence first: at most
``max_groups`` groups, one pre-aggregated and clamped contribution to each. Only
then are groups summed, small groups suppressed and Laplace noise added; quantiles are
drawn by the exponential mechanism. The
bounds are the feature here, not a way to save work. With ``epsilon=None`` the
noise is left out and the result is exact, which is what the tests compare.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.frames import previous
from tidewater.operators.relational import exact_percentiles, rank_at_most
from tidewater.operators.skew import null_safe_join, running_sums
from tidewater.session import materialise


# Points a private quantile is chosen from, less one.
GRID = 1 << 20


@dataclass(frozen=True)
class Bounds:
    """Limits on one user's influence, and on what may be released."""

    max_groups: int = 2
    low: float = 0.0
    high: float = 100.0
    max_count: int = 10
    min_users: int = 3
    epsilon: float | None = None
    seed: str = ""


def _draw(seed: str, *keys: Column) -> Column:
    """A number above 0 and below 1 from a keyed hash."""
    digest = F.sha2(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def laplace(scale: float | Column, seed: str, *keys: Column) -> Column:
    """Laplace noise drawn from a keyed hash of the group, so a retried task draws the same.

    The seed must be secret and new for every release.
    """
    u = _draw(seed, *keys) - 0.5
    return -F.lit(scale) * F.signum(u) * F.log(1 - 2 * F.abs(u))


def private_quantiles(
    units: DataFrame, groups: Sequence[str], value: str, quantiles: dict[str, float], low: float, high: float,
    epsilon: float, seed: str,
) -> DataFrame:
    """Quantiles of a group by the exponential mechanism, ``epsilon`` for each; a group's users hold one value each.

    The answer is one of ``GRID`` + 1 even points from ``low`` to ``high``, to
    which values are rounded. A point weighs exp(-epsilon / 2 * d), where d says
    by how many users it misses the wanted rank; one user moves d by one at
    most. Unlike noise added to the quantile, this does not depend on how far
    apart ``low`` and ``high`` are. Points between two neighbouring values weigh
    the same and are drawn as one stretch, a value's own point apart. The draw
    takes the largest of the weights' logarithms plus Gumbel noise, hashed from
    the stretch: one aggregate, whatever the size of a group. NULL values and
    groups without others are left out.
    """
    groups = list(groups)
    step = (high - low) / GRID
    known = units.filter(F.col(value).isNotNull())  # NULL would be clamped to a bound
    clamped = F.least(F.greatest(F.col(value).cast("double"), F.lit(low)), F.lit(high))
    point = (F.round((clamped - low) / step) if step else F.lit(0)).cast("bigint")
    counted = materialise(known.groupBy(*groups, point.alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    ends = counted.groupBy(*groups).agg(F.sum("_n").alias("_total"), F.max("_v").alias("_last"))
    upto = previous(running_sums(counted, groups, [F.col("_v")], {"_upto": F.col("_n")}), groups, "_v", "_before")
    below = F.col("_upto") - F.col("_n")
    stretch = lambda first, n, low_rank, high_rank: F.struct(
        first.cast("bigint").alias("first"), n.cast("bigint").alias("n"), low_rank.alias("below"), high_rank.alias("upto")
    )
    free = F.coalesce(F.col("_before"), F.lit(-1)) + 1
    of_value = F.array(stretch(free, F.col("_v") - free, below, below), stretch(F.col("_v"), F.lit(1), below, F.col("_upto")))
    rows = null_safe_join(upto, ends, groups).select(*groups, "_total", F.explode(of_value).alias("s"))
    rest = stretch(F.col("_last") + 1, F.lit(GRID if step else 0) - F.col("_last"), F.col("_total"), F.col("_total"))
    stretches = rows.unionByName(ends.select(*groups, "_total", rest.alias("s"))).select(*groups, "_total", "s.*").filter("n > 0")
    keys = [F.col(g) for g in groups]
    picks = []
    for name, q in quantiles.items():
        place = [F.lit(name), *keys, F.col("first")]
        wanted = F.col("_total") * F.lit(float(q))
        missed = F.greatest(F.lit(0.0), F.col("below") - wanted, wanted - F.col("upto"))
        score = F.log(F.col("n")) - missed * F.lit(epsilon / 2) - F.log(-F.log(_draw(f"{seed}|stretch", *place)))
        drawn = F.col("first") + F.floor(F.col("n") * _draw(f"{seed}|point", *place))
        picks.append((F.max_by(drawn, score) * F.lit(step) + low).alias(name))
    return stretches.groupBy(*groups).agg(*picks)


def user_contributions(
    df: DataFrame, user: str, groups: Sequence[str], value: str, bounds: Bounds
) -> DataFrame:
    """One bounded row per (user, group): clamped row count, value sum and value mean.

    Rows are combined per (user, group) before anything else. Which groups a
    user keeps is decided by a hash, so that it does not depend on the values.
    """
    money = F.col(value).cast("decimal(18,2)")
    per_user = df.groupBy(user, *groups).agg(F.count(F.lit(1)).alias("n"), F.sum(money).alias("s"))
    lottery = F.md5(F.concat_ws("|", F.lit(bounds.seed), F.col(user).cast("string"), *[F.col(g).cast("string") for g in groups]))
    kept = rank_at_most(per_user, [user], [lottery], bounds.max_groups).drop("rn")
    clamp = lambda c, lo, hi: F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
    limit = lambda c: clamp(c, bounds.low, bounds.high).cast("decimal(18,2)")
    return kept.select(
        user,
        *groups,
        F.least("n", F.lit(bounds.max_count).cast("bigint")).alias("user_count"),
        limit(F.col("s").cast("double")).alias("user_sum"),
        clamp(F.col("s").cast("double") / F.col("n"), bounds.low, bounds.high).alias("user_mean"),
    )


def private_aggregate(
    df: DataFrame, user: str, groups: Sequence[str], value: str, bounds: Bounds, quantiles: dict[str, float] | None = None
) -> DataFrame:
    """Per group: count, sum, avg, var_pop, stddev_pop of bounded contributions, quantiles, and a report."""
    groups = list(groups)
    units = materialise(user_contributions(df, user, groups, value, bounds), "units")  # read twice below
    mean = F.col("user_mean").cast("decimal(28,12)")
    # name -> (figure, how far one user can move it)
    top = max(abs(bounds.low), abs(bounds.high))
    figures = {
        "n_users": (F.count(F.lit(1)).cast("double"), 1.0),
        "anon_count": (F.sum("user_count").cast("double"), float(bounds.max_count)),
        "anon_sum": (F.sum("user_sum").cast("double"), top),
        "_means": (F.sum(mean).cast("double"), top),
        "_squares": (F.sum((mean * mean).cast("decimal(34,16)")).cast("double"), top * top),
    }
    sums = units.groupBy(*groups).agg(*[c.alias(n) for n, (c, _) in figures.items()])
    reach = {n: r for n, (_, r) in figures.items()}
    # The budget is split evenly over the figures and over the groups a user may be in.
    figures_out = len(reach) + len(quantiles or {})
    share = None if bounds.epsilon is None else bounds.epsilon / (figures_out * bounds.max_groups)
    if quantiles:
        if share is None:
            spread = exact_percentiles(units, groups, "user_mean", quantiles).select(*groups, *quantiles)
        else:
            spread = private_quantiles(units, groups, "user_mean", quantiles, bounds.low, bounds.high, share, bounds.seed)
        sums = null_safe_join(sums, spread, groups)
    if share is not None:
        keys = [F.col(g) for g in groups]
        sums = sums.withColumns(
            {n: F.col(n) + laplace(r / share, f"{bounds.seed}|{n}", *keys) for n, r in reach.items()}
        )
    # Everything below uses released figures only.
    users = F.greatest(F.col("n_users"), F.lit(1.0))
    avg = F.col("_means") / users
    sums = sums.withColumns(
        {"anon_avg": avg, "anon_var_pop": F.greatest(F.col("_squares") / users - avg * avg, F.lit(0.0))}
    ).withColumn("n_users", F.round("n_users").cast("bigint")).drop("_means", "_squares")
    released = sums.filter(F.col("n_users") >= bounds.min_users).withColumn("anon_stddev_pop", F.sqrt("anon_var_pop"))
    report = F.to_json(
        F.struct(
            F.struct(F.lit(bounds.low).alias("low"), F.lit(bounds.high).alias("high")).alias("bounds"),
            F.lit(bounds.max_groups).alias("max_groups"),
            F.lit(bounds.epsilon).cast("double").alias("epsilon"),
        )
    )
    return released.withColumn("report", report)
