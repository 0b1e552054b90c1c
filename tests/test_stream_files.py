"""How the catalogue's streams deal their input."""

from pyspark.sql import functions as F

from tradeflow.plans.catalog import streams


def test_quarters_are_dealt_over_equally_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    spark.range(2_000).select(F.col("id").alias("event_id"), at.alias("ts"), F.lit("x").alias("props")).write.parquet(str(tmp_path / "events.parquet"))
    files = []
    monkeypatch.setattr(streams, "read_files", lambda spark, kind, folder, schema, **options: files.append((folder, options["max_files_per_trigger"])))
    streams._events_in_files(spark, str(tmp_path), late=False)
    folder, at_once = files[0]
    quarters = [spark.read.parquet(f"{folder}/{k}") for k in range(streams.FILES)]
    assert at_once > 1 and [len(q.inputFiles()) for q in quarters] == [at_once] * 4
    assert sum(q.count() for q in quarters) == 2_000
    assert quarters[0].agg(F.max("ts")).first()[0] < quarters[1].agg(F.min("ts")).first()[0]
