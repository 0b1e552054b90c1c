"""Drift measures and the drift report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.operators import daily_drift, dashboard, drift
from tradeflow.operators import enrich as en
from tradeflow.operators.quantiles import exact_percentiles
from tradeflow.plans import fixtures as fx
from tradeflow.plans.catalog import registry as reg
from tradeflow.plans.catalog.registry import query, r4, rounded, sql_r4
from tradeflow.session import fresh_path

_SIDES = f"""{reg.TRADES}, silver AS ({reg.enriched("trades")}),
sides AS (
  SELECT *, CASE WHEN "timestamp" > (SELECT max(ts) FROM events) - INTERVAL 1 DAY THEN 'current' ELSE 'reference' END AS side
  FROM silver WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 31 DAY)"""


def psi_sql(sides: str, features: list[str]) -> str:
    """CTE ``psi(feature, value)`` over a table with a ``side`` column."""
    pairs = " UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {sides} WHERE {f} IS NOT NULL" for f in features
    )
    probs = "[" + ", ".join(f"{i}/10.0" for i in range(11)) + "]"
    return f"""pairs AS ({pairs}),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(v, {probs}))) AS e FROM pairs WHERE side = 'reference' GROUP BY feature),
binned AS (
  SELECT p.feature, p.side, CASE WHEN v = e[len(e)] THEN len(e) - 1
           WHEN v < e[1] OR v > e[len(e)] THEN -1 ELSE len(list_filter(e, lambda x: x <= v)) END AS bin
  FROM pairs p JOIN edges USING (feature)),
sizes AS (
  SELECT feature, count(*) FILTER (WHERE side = 'reference') AS nr, count(*) FILTER (WHERE side = 'current') AS nc
  FROM pairs GROUP BY feature),
spine AS (SELECT feature, len(e) AS ne, unnest(range(1, len(e))) AS bin FROM edges),
shares AS (
  SELECT s.feature, s.bin,
         (count(b.side) FILTER (WHERE b.side = 'reference') + 1) / (any_value(nr) + any_value(ne)) AS r,
         (count(b.side) FILTER (WHERE b.side = 'current') + 1) / (any_value(nc) + any_value(ne)) AS c
  FROM spine s JOIN sizes USING (feature) LEFT JOIN binned b ON b.feature = s.feature AND b.bin = s.bin
  GROUP BY s.feature, s.bin),
psi AS (
  SELECT feature, coalesce(sum((c - r) * ln(c / r)), 0.0) AS value FROM edges LEFT JOIN shares USING (feature)
  GROUP BY feature)"""


def js_sql(sides: str, features: list[str]) -> str:
    """CTE ``js(feature, value)``."""
    pairs = " UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS VARCHAR) AS v FROM {sides} WHERE {f} IS NOT NULL" for f in features
    )
    return f"""cats AS (
  SELECT feature, v, count(*) FILTER (WHERE side = 'reference') AS r, count(*) FILTER (WHERE side = 'current') AS c
  FROM ({pairs}) GROUP BY feature, v),
pq AS (
  SELECT feature, (r / sum(r) OVER f + 1e-10) / (1 + count(*) OVER f * 1e-10) AS p,
         (c / sum(c) OVER f + 1e-10) / (1 + count(*) OVER f * 1e-10) AS q
  FROM cats WINDOW f AS (PARTITION BY feature)),
js AS (
  SELECT feature, sum(p * ln(2 * p / (p + q)) + q * ln(2 * q / (p + q))) / 2 AS value FROM pq GROUP BY feature)"""


_NUM = ["price", "volume", "hour_of_day", "minute_of_hour"]
_CAT = ["symbol", "exchange", "trade_type", "session_type"]


def _sides(spark, sf_dir):
    return drift.drift_windows(en.enrich(fx.trades(spark, sf_dir)))


@query(f"WITH {_SIDES}, {psi_sql('sides', _NUM)} SELECT feature, {sql_r4('value', 'value', 8)} FROM psi")
def psi_report(spark, sf_dir):
    return rounded(drift.psi(_sides(spark, sf_dir), _NUM), "value", digits=8)


@query(f"WITH {_SIDES}, {psi_sql('sides', _NUM)} SELECT feature, {sql_r4('value', 'value', 8)} FROM psi")
def psi_report_narrowed(spark, sf_dir):
    """The same report with the bin edges found by narrowing, as for very large windows."""
    return rounded(drift.psi(_sides(spark, sf_dir), _NUM, direct_limit=300), "value", digits=8)


@query(f"WITH {_SIDES}, {js_sql('sides', _CAT)} SELECT feature, {sql_r4('value', 'value', 8)} FROM js")
def js_report(spark, sf_dir):
    return rounded(drift.js_divergence(_sides(spark, sf_dir), _CAT), "value", digits=8)


_DRIFTED = f"""{_SIDES}, moved AS (
  SELECT * REPLACE (CASE WHEN side = 'current' THEN price * 3 ELSE price END AS price) FROM sides),
{psi_sql("moved", _NUM)}, {js_sql("moved", _CAT)},
report AS (
  SELECT feature, 'psi' AS metric, value, 0.2::DOUBLE AS threshold, value > 0.2 AS drifted FROM psi
  UNION ALL SELECT feature, 'js_divergence', value, 0.1::DOUBLE, value > 0.1 FROM js)"""


def _drifted(spark, sf_dir):
    tripled = F.when(F.col("side") == "current", F.col("price") * 3).otherwise(F.col("price"))
    return _sides(spark, sf_dir).withColumn("price", tripled)


@query(f"WITH {_DRIFTED} SELECT feature, metric, {sql_r4('value', 'value')}, threshold, drifted FROM report")
def drift_report(spark, sf_dir):
    return rounded(drift.drift_report(_drifted(spark, sf_dir), _NUM, _CAT), "value")


@query(
    f"""WITH {_DRIFTED}
SELECT (SELECT count(*) FROM moved WHERE side = 'reference') AS reference_size,
       (SELECT count(*) FROM moved WHERE side = 'current') AS current_size,
       bool_or(drifted) AS overall_drift,
       '[' || string_agg('"' || feature || '"', ',' ORDER BY feature) FILTER (WHERE drifted) || ']' AS drifted_features
FROM report"""
)
def drift_summary(spark, sf_dir):
    sides = _drifted(spark, sf_dir)
    summary = drift.drift_summary(sides, drift.drift_report(sides, _NUM, _CAT))
    return summary.select("reference_size", "current_size", "overall_drift", "drifted_features")


@query(
    f"""WITH {_DRIFTED}, g AS (SELECT *, least(value / threshold * 100, 100) AS used FROM report)
SELECT feature, metric, round(value, 4) AS value, threshold, drifted, round(used, 2) AS gauge_pct,
       CASE WHEN used > 80 THEN 'danger' WHEN used > 50 THEN 'warning' ELSE 'ok' END AS gauge_state FROM g"""
)
def drift_gauges(spark, sf_dir):
    return dashboard.drift_metrics(drift.drift_report(_drifted(spark, sf_dir), _NUM, _CAT))


# Whole days: the newest one, and the 30 before it. Midnight belongs to the day that ends.
_DAY = 'CAST(ceil(epoch_us("timestamp") / 86400000000.0) AS BIGINT)'
_BY_DAY = f"""{reg.TRADES}, silver AS ({reg.enriched("trades")}),
numbered AS (SELECT *, {_DAY} AS day, max({_DAY}) OVER () AS last_day FROM silver),
sides AS (SELECT *, CASE WHEN day = last_day THEN 'current' ELSE 'reference' END AS side FROM numbered WHERE day >= last_day - 30),
{psi_sql("sides", _NUM)}, {js_sql("sides", _CAT)},
report AS (
  SELECT feature, 'psi' AS metric, value, 0.2::DOUBLE AS threshold, value > 0.2 AS drifted FROM psi
  UNION ALL SELECT feature, 'js_divergence', value, 0.1::DOUBLE, value > 0.1 FROM js)"""


def _recorded(spark, sf_dir):
    """Daily counts recorded in two runs, the second of which reads the newest day only."""
    silver, folder = en.enrich(fx.trades(spark, sf_dir)), fresh_path(spark, "daily-drift")
    last_day = silver.agg(F.max(daily_drift.day_of(F.col("timestamp")))).first()[0]
    for day in (last_day - 1, last_day):
        daily_drift.record_new(silver, folder, _NUM, _CAT, day)
    return folder, last_day


@query(f"WITH {_BY_DAY} SELECT feature, metric, {sql_r4('value', 'value', 8)}, threshold, drifted FROM report")
def drift_report_daily(spark, sf_dir):
    """The report over whole days from stored daily counts."""
    return rounded(daily_drift.report(spark, *_recorded(spark, sf_dir)), "value", digits=8)


@query(
    f"""WITH {_BY_DAY}
SELECT (SELECT count(*) FROM sides WHERE side = 'reference') AS reference_size,
       (SELECT count(*) FROM sides WHERE side = 'current') AS current_size"""
)
def drift_sizes_daily(spark, sf_dir):
    return daily_drift.sizes(spark, *_recorded(spark, sf_dir))


_SCORES = f"""scores AS (
  SELECT ({reg.K} + event_id % 10) / 110.0::DOUBLE AS score,
         CASE WHEN ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY THEN 'current' ELSE 'reference' END AS side FROM events)"""


@query(
    f"""WITH {_SCORES}, {psi_sql("scores", ["score"])}
SELECT {sql_r4("value", "prediction_psi", 8)}, 0.2::DOUBLE AS threshold, value > 0.2 AS drifted FROM psi"""
)
def prediction_drift(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    k = fx.k_of_props()
    scored = events.select(
        F.col("ts").cast("timestamp").alias("timestamp"), ((k + F.col("event_id") % 10) / 110).alias("score")
    )
    return rounded(drift.prediction_drift(drift.drift_windows(scored), "score"), "prediction_psi", digits=8)


@query(
    """SELECT l_returnflag AS flag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.1) + 1.37e-6, 4) AS p10,
       round(quantile_cont(l_extendedprice, 0.5) + 1.37e-6, 4) AS p50, round(quantile_cont(l_extendedprice, 0.99) + 1.37e-6, 4) AS p99
FROM lineitem GROUP BY l_returnflag"""
)
def price_percentiles(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    found = exact_percentiles(lines, ["flag"], "l_extendedprice", [0.1, 0.5, 0.99], direct_limit=2_000)
    names = ["p10", "p50", "p99"]
    return found.select("flag", "n", *[r4(F.col("percentiles")[i]).alias(c) for i, c in enumerate(names)])


_NULL_GROUPS = """SELECT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag, count(*) AS n,
       round(quantile_cont(l_extendedprice, 0.5) + 1.37e-6, 4) AS p50, round(quantile_cont(l_extendedprice, 0.99) + 1.37e-6, 4) AS p99
FROM lineitem GROUP BY 1"""


def _null_groups(spark, sf_dir, **options):
    """Exact percentiles where the largest group's name is missing."""
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    lines = fx.table(spark, sf_dir, "lineitem").select(flag, "l_extendedprice")
    found = exact_percentiles(lines, ["flag"], "l_extendedprice", [0.5, 0.99], **options)
    return found.select("flag", "n", *[r4(F.col("percentiles")[i]).alias(c) for i, c in enumerate(["p50", "p99"])])


@query(_NULL_GROUPS)
def percentiles_null_group(spark, sf_dir):
    return _null_groups(spark, sf_dir)


@query(_NULL_GROUPS)
def percentiles_null_group_narrowed(spark, sf_dir):
    return _null_groups(spark, sf_dir, direct_limit=1_500)
