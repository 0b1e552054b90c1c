import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradeflow import schemas
from tradeflow.functions import scalar
from tradeflow.operators import enrich, quality

RAW = "trade_id string, symbol string, price double, volume double, timestamp string, exchange string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


@pytest.fixture
def bronze(spark):
    day = "2026-04-01 "
    return raw(
        spark,
        [
            ("1", "AAPL", 150.0, 100.0, day + "15:30:00", "US"),
            ("2", "MSFT", 300.0, 15000.0, day + "15:30:00", "US"),
            ("3", "GOOGL", 100.0, 50.0, day + "08:30:00", "US"),
            ("4", "AMZN", -10.0, 10.0, day + "15:30:00", "US"),
            ("1", "AAPL", 150.0, 100.0, day + "15:30:00", "US"),
        ],
    )


@pytest.mark.parametrize("profile", ["utc", "local"])
def test_bronze_to_silver(bronze, profile):
    rows = {r.trade_id: r for r in enrich.bronze_to_silver(bronze, session=profile).collect()}
    assert set(rows) == {"1", "2", "3"}
    first = rows["1"]
    assert (first.session_type, first.trade_type, first.hour_of_day, first.minute_of_hour) == ("regular", "standard", 15, 30)
    assert rows["2"].trade_type == "block"
    assert (rows["3"].session_type, rows["3"].trade_type) == ("pre_market", "odd_lot")
    assert first._processed_at is not None


@pytest.mark.parametrize(
    "profile, time, expected",
    [
        ("utc", "13:59", "pre_market"),
        ("utc", "14:00", "regular"),
        ("utc", "20:59", "regular"),
        ("utc", "21:00", "after_hours"),
        ("local", "08:59", "pre_market"),
        ("local", "09:00", "regular"),
        ("local", "15:59", "regular"),
        ("local", "16:00", "after_hours"),
    ],
)
def test_session_boundaries(spark, profile, time, expected):
    df = spark.sql(f"SELECT timestamp'2026-04-01 {time}:00' AS t")
    assert df.select(scalar.session_type(F.col("t"), profile)).first()[0] == expected


def test_null_inputs(spark):
    df = raw(spark, [("1", "A", 1.0, None, "2026-04-04 10:00:00", None)])
    row = enrich.bronze_to_silver(df).first()
    assert (row.volume, row.trade_type, row.exchange, row.is_weekend, row.day_of_week) == (0.0, "odd_lot", "US", True, 7)
    nothing = spark.sql("SELECT CAST(NULL AS timestamp) AS t")
    assert nothing.select(scalar.is_weekend(F.col("t"))).first()[0] is False


def test_fail_rule_aborts_even_when_column_is_unused(spark):
    df = raw(spark, [("1", "A", 1.0, 1.0, None, "US")])
    with pytest.raises(PySparkException, match="valid_timestamp"):
        enrich.bronze_to_silver(df).select("trade_id").collect()


def test_invalid_copy_does_not_hide_valid_one(spark):
    df = raw(
        spark, [("1", "A", -1.0, 1.0, "2026-04-01 10:00:00", "US"), ("1", "A", 2.0, 1.0, "2026-04-01 10:00:01", "US")]
    )
    assert [r.price for r in enrich.bronze_to_silver(df).collect()] == [2.0]


def test_earliest_copy_wins_and_plan_limits_before_shuffle(spark):
    rows = [("hot", "A", float(i), 1.0, f"2026-04-01 10:00:{i:02d}", "US") for i in range(50, 0, -1)]
    df = raw(spark, rows + [("cold", "A", 9.0, 1.0, "2026-04-01 10:00:00", "US")])
    kept = enrich.latest_copy_free(df)
    assert {(r.trade_id, r.price) for r in kept.collect()} == {("hot", 1.0), ("cold", 9.0)}
    plan = enrich.latest_copy_free(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unparsable_values_become_null(spark):
    df = spark.createDataFrame(
        [("1", "A", "abc", "x", "2026-04-01 10:00:00", "US")],
        "trade_id string, symbol string, price string, volume string, timestamp string, exchange string",
    )
    row = enrich.typed(df).first()
    assert row.price is None and row.volume is None and row.timestamp is not None


def test_rule_report_and_observed_warnings(spark, bronze):
    with_negative = bronze.withColumn("volume", F.when(F.col("trade_id") == "2", -1.0).otherwise(F.col("volume")))
    report = {r.rule: (r.action, r.passed, r.failed) for r in quality.rule_report(with_negative).collect()}
    assert report["valid_price"] == ("drop", 4, 1)
    assert report["valid_volume"] == ("warn", 4, 1)
    seen = Observation("quality")
    kept = quality.enforce(with_negative, quality.silver_rules(), seen)
    assert kept.count() == 4
    assert seen.get == {"valid_volume": 1}


def test_required_columns(bronze):
    with pytest.raises(ValueError, match="session_type, trade_type"):
        schemas.require_columns(bronze, schemas.REQUIRED_SILVER)


@pytest.mark.parametrize("symbol, venue", [("BINANCE:BTCUSDT", "BINANCE"), ("AAPL", "US")])
def test_exchange_of(spark, symbol, venue):
    df = spark.createDataFrame([(symbol,)], "s string")
    assert df.select(scalar.exchange_of(F.col("s"))).first()[0] == venue


def test_scalars(spark):
    df = spark.createDataFrame([(0.8,), (0.5,), (0.2,), (0.1,), (None,)], "p double")
    assert [r[0] for r in df.select(scalar.risk_level(F.col("p"))).collect()] == ["critical", "high", "medium", "low", "low"]
    one = spark.range(1)
    values = one.select(
        scalar.report_round(F.lit(0.12345)).alias("a"),
        scalar.sigmoid_calibrated(F.lit(0.0)).alias("b"),
        scalar.short_run_id(F.lit("abcdefghijk")).alias("c"),
        scalar.short_run_id(F.lit(None).cast("string")).alias("d"),
        F.length(scalar.alert_message(F.lit("x" * 400), F.lit("y" * 400))).alias("e"),
        scalar.gauge(F.lit(0.5), 0.2).alias("f"),
        scalar.gauge_state(F.lit(81.0)).alias("g"),
    ).first()
    assert tuple(values) == (0.1234, 0.5, "abcdefgh", "N/A", 500, 100.0, "danger")
