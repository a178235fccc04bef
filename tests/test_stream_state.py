"""Keyed state, event-time changes and stream metrics against batch results, over restarts and repeated batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import route
from pulsegrid.streaming import eventtime, metrics, sinks, state

UTC = dt.timezone.utc
BASE = dt.datetime(2026, 1, 1, tzinfo=UTC)
LOG = "partition int, offset long, equipmentId string, eventId string, timestamp timestamp, severity string"


def _rows(n=600, seed=4, tombstones=True):
    rng, out = random.Random(seed), []
    for i in range(n):
        key = "HOT" if rng.random() < 0.4 else f"EQ-{rng.randrange(25)}"
        severity = rng.choice(["HEALTHY", "WARNING", "CRITICAL", *([None] if tombstones else [])])
        out.append((sum(map(ord, key)) % 3, i, key, f"e{i:05d}", BASE + dt.timedelta(seconds=10 * i), severity))
    return out


def _files(spark, path, rows, pieces):
    step = -(-len(rows) // pieces)
    for i in range(pieces):
        spark.createDataFrame(rows[i * step:(i + 1) * step], LOG).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", "1").parquet(path)


@pytest.mark.parametrize("slices", [1, 8])
def test_state_holds_the_latest(spark, tmp_path, slices):
    rows, path, checkpoint = _rows(), f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for part in (rows[:300], rows[300:]):
        _files(spark, path, part, 2)
        query = state.run_latest_state(_stream(spark, path), checkpoint, slices=slices)
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    last = {r[2]: r for r in rows}
    want = {(k, r[1], r[5]) for k, r in last.items() if r[5]}
    got = state.latest_state(spark, checkpoint).select("equipmentId", "offset", "severity").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    # A hot key's records are spread over the slices; state is no more than that.
    held = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert held <= slices * len(last)


def test_older_rows_change_no_state(spark, tmp_path):
    path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    row = lambda offset, severity: (0, offset, "EQ", f"e{offset}", BASE, severity)
    for rows in ([row(5, "WARNING")], [row(9, None)], [row(7, "CRITICAL")]):
        _files(spark, path, rows, 1)
        state.run_latest_state(_stream(spark, path), checkpoint, slices=1, sink=f"{tmp_path}/out").awaitTermination()
    assert state.latest_state(spark, checkpoint).count() == 0
    assert sorted(r.offset for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [5, 9]


def _plain_changes(rows):
    last, out = {}, set()
    for r in sorted(rows, key=lambda r: (r[4], r[3])):
        if last.get(r[2]) != r[5]:
            out.add((r[2], r[1], r[5], last.get(r[2])))
        last[r[2]] = r[5]
    return out


def _changed(df):
    rows = [tuple(r) for r in df.select("equipmentId", "offset", "severity", "previousStatus").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("batches", [1, 6])
def test_event_time_changes_out_of_order(spark, tmp_path, batches):
    rows, rng = _rows(tombstones=False), random.Random(9)
    bound = dt.timedelta(seconds=300)
    arrived = sorted(rows, key=lambda r: r[4] + dt.timedelta(seconds=rng.uniform(0, 299)))
    table = eventtime.EventTimeChanges(lambda b: b, f"{tmp_path}/t", bound=bound, chunk_rows=50)
    step = -(-len(arrived) // batches)
    for i in range(batches):
        frame = spark.createDataFrame(arrived[i * step:(i + 1) * step], LOG)
        # Each batch runs twice, as after a loss before its commit.
        table(frame, i)
        table(frame, i)
    table.close(spark)
    table.close(spark)
    assert _changed(table.changes(spark)) == _plain_changes(rows) and table.late(spark).count() == 0


def test_late_rows_are_kept_apart(spark, tmp_path):
    rows = _rows(200, tombstones=False)
    late, timeless = [r for r in rows[:100] if r[1] % 7 == 0], (0, 9999, "EQ-1", "none", None, "CRITICAL")
    table = eventtime.EventTimeChanges(lambda b: b, f"{tmp_path}/t", bound=dt.timedelta(seconds=50))
    on_time = [r for r in rows if r not in late]
    table(spark.createDataFrame(on_time[:150], LOG), 0)
    table(spark.createDataFrame([*late, *on_time[150:], timeless], LOG), 1)
    table(spark.createDataFrame([], LOG), 2)
    table.close(spark)
    assert _changed(table.changes(spark)) == _plain_changes(on_time)
    assert {r.offset for r in table.late(spark).collect()} == {r[1] for r in late} | {9999}


def test_metrics_of_named_queries_and_repeated_batches(spark, tmp_path):
    path = f"{tmp_path}/in"
    _files(spark, path, _rows(tombstones=False), 3)
    run = lambda name, checkpoint: route.observed(_stream(spark, path), "seen").writeStream.queryName(name).format("noop").option(
        "checkpointLocation", f"{tmp_path}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()
    with metrics.MetricsTable(spark, f"{tmp_path}/metrics", queries=["mine"]):
        run("mine", "a")
        run("other", "b")
        run("mine", "a")  # nothing new: no new batch
    rows = metrics.metrics_table(spark, f"{tmp_path}/metrics").collect()
    assert {r.batch for r in rows} == {0, 1, 2} and len({r.run for r in rows}) == 1
    total = lambda m: sum(r.value for r in rows if r.metric == m)
    assert total("received") == 600 == total("critical") + total("warning") + total("healthy")


def test_copies_within_the_bound_are_dropped(spark, tmp_path):
    schema = "topic string, sourceTopic string, sourcePartition int, sourceOffset long, timestamp timestamp, value string"
    row = lambda i, copy="": ("t", "s", 0, i, BASE + dt.timedelta(minutes=i), f"v{i}{copy}")
    batches = [[row(i) for i in range(30)], [row(i, "again") for i in range(20, 30)] + [row(i) for i in range(30, 60)], [row(i) for i in range(60, 90)],
               [("t", None, None, None, BASE + dt.timedelta(minutes=80), "unplaced")] * 2]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in")
    query = sinks.once(stream, within="20 minutes").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(
        availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    values = sorted(r.value for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert values == sorted([f"v{i}" for i in range(90)] + ["unplaced"] * 2)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 60


def test_ranges_close_over_gaps(spark, tmp_path):
    """Batches with holes between their offsets are one range while none of them is missing; newer runs hide exactly what they read."""
    path = f"{tmp_path}/out"
    source = lambda offsets: spark.createDataFrame([("s", 0, o) for o in offsets], "topic string, partition int, offset long")

    def write(run, batch, offsets):
        rows = source(offsets)
        sinks.write_messages(rows.selectExpr(
            "topic AS sourceTopic", "partition AS sourcePartition", "offset AS sourceOffset", f"timestamp'{BASE:%Y-%m-%d}' AS recordTimestamp",
            "'k' AS key", f"'{run}' AS value", "'t' AS topic"), path, batch, run=run, source=rows)
    for i in range(10):
        write("a", i, [i * 100, i * 100 + 40])
    for i, batch in ((3, 0), (5, 1), (7, 3)):  # batch 2 of this run is not there
        write("b", batch, [i * 100 + 10, i * 100 + 90])
    ranges = {(r.run, r.firstOffset, r.lastOffset) for r in sinks.islands(sinks.commits(spark, path)).collect()}
    assert ranges == {("a", 0, 940), ("b", 310, 590), ("b", 710, 790)}
    force = sorted((r.firstOffset, r.lastOffset, r.seq) for r in sinks.in_force(sinks.islands(sinks.commits(spark, path))).collect())
    assert force == [(0, 309, 1), (310, 590, 2), (591, 709, 1), (710, 790, 2), (791, 940, 1)]
    got = {(r.run, r.sourceOffset) for r in sinks.messages_table(spark, path).collect()}
    want = {("a", o) for i in range(10) for o in (i * 100, i * 100 + 40) if not (310 <= o <= 590 or 710 <= o <= 790)}
    assert got == want | {("b", i * 100 + d) for i in (3, 5, 7) for d in (10, 90)}


def test_one_piece_for_each_task(spark):
    from pulsegrid.operators.tables import key_pieces

    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 40) END AS key", "id AS offset", "id div 2500 AS day")
    dealt = key_pieces(rows, 4, rows_per_piece=300, within=("day",)).withColumn("task", F.spark_partition_id())
    tasks = dealt.groupBy("task").agg(F.countDistinct("keyPartition", "day").alias("folders"), F.count(F.lit(1)).alias("n")).collect()
    assert {t.folders for t in tasks} == {1} and len(tasks) == dealt.rdd.getNumPartitions() and max(t.n for t in tasks) < 600
    assert dealt.count() == 5000 and dealt.groupBy("key").agg(F.countDistinct("keyPartition").alias("p")).filter("p > 1").count() == 0
    assert key_pieces(rows.limit(0), 4).count() == 0
