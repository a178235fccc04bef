"""Keyed tables and status changes on skewed data, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import changes, tables

UTC = dt.timezone.utc
BASE = dt.datetime(2026, 1, 1, tzinfo=UTC)
LOG_SCHEMA = (
    "topic string, partition int, offset long, equipmentId string, eventId string, timestamp timestamp, severity string"
)


def _log(n=3000, seed=1):
    """Half of the rows belong to one equipment; many share their time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT" if rng.random() < 0.5 else f"EQ-{rng.randrange(40)}"
        partition = sum(map(ord, key)) % 3
        time = BASE + dt.timedelta(seconds=rng.randrange(200))
        severity = rng.choice(["HEALTHY"] * 6 + ["WARNING", "CRITICAL"])
        rows.append(("t", partition, i, key, f"e{i:05d}", time, severity))
    return rows


def _expected(rows, order):
    last, found = {}, set()
    for row in sorted(rows, key=order):
        if last.get(row[3]) != row[6]:
            found.add((row[3], row[2], row[6], last.get(row[3])))
        last[row[3]] = row[6]
    return found


def _found(df):
    rows = df.select("equipmentId", "offset", "severity", "previousStatus").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("chunk_rows", [7, 100, 1_000_000])
def test_changes_in_log_order(spark, chunk_rows):
    rows = _log()
    df = spark.createDataFrame(rows, LOG_SCHEMA).repartition(5)
    got = _found(changes.status_changes(df, order=changes.LOG, chunk_rows=chunk_rows))
    assert got == _expected(rows, lambda r: (r[1], r[2]))


@pytest.mark.parametrize("chunks", [None, 1, 16, 64])
def test_changes_in_event_time(spark, chunks):
    rows = _log(seed=2)
    df = spark.createDataFrame(rows, LOG_SCHEMA).repartition(5)
    got = _found(changes.status_changes(df, chunks=chunks))
    assert got == _expected(rows, lambda r: (r[5], r[4]))


def test_hot_key_is_spread_over_tasks(spark):
    df = spark.createDataFrame(_log(6000), LOG_SCHEMA)
    spread = df.repartitionByRange(8, "equipmentId", "timestamp", "eventId")
    per_task = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) < 6000 / 4


def test_latest_with_tombstones(spark):
    rows = _log()
    df = spark.createDataFrame(rows, LOG_SCHEMA).withColumn(
        "severity", F.when(F.col("offset") % 3 != 0, F.col("severity")))
    got = {(r.equipmentId, r.offset, r.severity) for r in
           tables.latest_by_key(df, "equipmentId", tombstone="severity").collect()}
    last = {r[3]: r for r in sorted(rows, key=lambda r: (r[1], r[2]))}
    assert got == {(k, r[2], r[6]) for k, r in last.items() if r[2] % 3}


def test_latest_combines_before_the_shuffle(spark):
    df = spark.createDataFrame(_log(), LOG_SCHEMA)
    plan = tables.latest_by_key(df, "equipmentId", tombstone=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max_by")


def test_key_partitions_split_a_hot_key(spark):
    df = spark.createDataFrame(_log(), LOG_SCHEMA).withColumn("key", F.col("equipmentId"))
    laid_out = tables.key_pieces(df, 6, rows_per_piece=300).withColumn("task", F.spark_partition_id())
    assert laid_out.count() == 3000
    per_key = laid_out.groupBy("key").agg(F.countDistinct("keyPartition").alias("n"), F.countDistinct("task").alias("t"))
    rows = {r.key: r for r in per_key.collect()}
    assert all(r.n == 1 for r in rows.values())
    assert rows["HOT"].t >= 4
    # With the production size these few rows need one piece for each partition.
    whole = tables.key_pieces(df, 6).withColumn("task", F.spark_partition_id()).groupBy("keyPartition").agg(F.countDistinct("task").alias("t"))
    assert {r.t for r in whole.collect()} == {1}
    assert tables.key_pieces(df.limit(0), 6).count() == 0


def test_key_pieces_never_broadcast_the_records(spark, tmp_path):
    """However small their files are: the table of folders goes to the records' tasks."""
    spark.createDataFrame(_log(), LOG_SCHEMA).withColumn("key", F.col("equipmentId")).write.parquet(f"{tmp_path}/log")
    laid_out = tables.key_pieces(spark.read.parquet(f"{tmp_path}/log"), 6, rows_per_piece=300)
    assert laid_out.count() == 3000
    plan = laid_out._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


def test_chunks_follow_the_row_count(spark):
    df = spark.createDataFrame(_log(), LOG_SCHEMA)
    assert changes._chunks_for(df, 100) == 30
    assert changes._chunks_for(df, 20_000_000) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_retention_reaches_the_scan(spark, sf_dir):
    events = spark.read.schema("event_id bigint, ts timestamp").parquet(f"{sf_dir}/events.parquet")
    kept = tables.within_retention(events, "ts", 7, F.lit("2024-01-31 00:00:00").cast("timestamp"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan
    assert 0 < kept.count() < events.count()
