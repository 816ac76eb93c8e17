"""Privacy-preserving aggregate queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.private import Bounds, private_aggregate
from tidewater.plans.registry import query
from tidewater.session import table

BOUNDS = Bounds(max_groups=3, low=0.0, high=60.0, max_count=12, min_users=5)


@query(
    "private_agg",
    """
    WITH per_user AS (SELECT user_id, event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS s FROM events GROUP BY ALL),
    kept AS (SELECT * FROM per_user QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY md5('|' || user_id || '|' || event_type)) <= 3),
    bounded AS (SELECT event_type, least(n, 12) AS c, least(greatest(s::DOUBLE, 0), 60)::DECIMAL(18,2) AS t,
                       least(greatest(s::DOUBLE / n, 0), 60) AS m FROM kept)
    SELECT event_type, count(*) AS n_users, sum(c)::DOUBLE AS anon_count, sum(t)::DOUBLE AS anon_sum,
           round(avg(m), 6) AS anon_avg, round(var_pop(m), 4) AS anon_var_pop, round(stddev_pop(m), 4) AS anon_stddev_pop,
           round(quantile_cont(m, 0.5), 6) AS median, round(quantile_cont(m, 0.9), 6) AS p90,
           '{"bounds":{"low":0.0,"high":60.0},"max_groups":3}' AS report
    FROM bounded GROUP BY event_type HAVING count(*) >= 5
    """,
)
def private_agg(spark, sf_dir):
    """Bounded, clamped and thresholded figures per event type; noise off, so they can be compared."""
    events = table(spark, sf_dir, "events")
    out = private_aggregate(events, "user_id", ["event_type"], "value", BOUNDS, {"median": 0.5, "p90": 0.9})
    digits = {"anon_avg": 6, "anon_var_pop": 4, "anon_stddev_pop": 4, "median": 6, "p90": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})
