"""No task's share grows with the rows of one batch, one range of offsets or one key, nor the tasks with the folders."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import events as ev
from pulsegrid.operators.tables import key_pieces
from pulsegrid.streaming import sinks, state


def _messages(spark, n):
    return spark.range(n).selectExpr(
        "'t' AS sourceTopic", "0 AS sourcePartition", "id AS sourceOffset", "timestamp'2026-01-01 00:00:00' AS recordTimestamp",
        "concat('k', id % 3) AS key", "'text' AS value", "'status' AS topic")


def test_messages_are_not_dealt_out_by_batch_or_offset(spark, tmp_path):
    path, before = str(tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sinks.write_messages(_messages(spark, 500).repartition(4), path, 0)
    sinks.write_messages(_messages(spark, 500).filter("sourceOffset >= 400"), path, 0, run="run-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = sinks.messages_table(spark, path)
        # The rows stay in the tasks that read them, which are several.
        assert table.filter("run = 'run-0'").select(F.spark_partition_id()).distinct().count() > 1
        assert {(r.run, r["count"]) for r in table.groupBy("run").count().collect()} == {("run-0", 400), ("run-1", 100)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_offsets_are_taken_from_what_was_written(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch
    rows = _messages(spark, 300)
    sinks.write_messages(rows.mapInArrow(passed, rows.schema), str(tmp_path), 0)
    sinks.write_messages(rows.filter("sourceOffset < 5"), str(tmp_path), 1)
    assert made.value == 300
    got = {(r.batch, r.firstOffset, r.lastOffset) for r in sinks.commits(spark, str(tmp_path)).collect()}
    assert got == {(0, 0, 299), (1, 0, 4)}


def test_small_folders_share_a_task(spark):
    rows = spark.range(6000).selectExpr("concat('k', id % 40) AS key", "id AS offset", "id div 20 AS day")
    dealt = key_pieces(rows, 4, rows_per_piece=300, within=("day",)).withColumn("task", F.spark_partition_id())
    # 300 days in 4 partitions, and 20 pieces' worth of rows.
    assert dealt.rdd.getNumPartitions() <= 2 * 20 + 4
    folders = dealt.groupBy("keyPartition", "day").agg(F.countDistinct("task").alias("tasks"))
    assert folders.filter("tasks > 1").count() == 0 and dealt.count() == 6000
    assert dealt.groupBy("task").agg(F.countDistinct("keyPartition").alias("p"), F.count(F.lit(1)).alias("n")).filter("p > 1 OR n > 300").count() == 0


def test_pieces_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ev, "ROWS_PER_PIECE", 50)
    events = spark.range(1000).selectExpr(
        "id AS event_id", "timestamp'2026-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{\"k\": 7}' AS props")
    topic = ev.telemetry_topic(events, "status")
    assert topic.rdd.getNumPartitions() == 20 and topic.select("offset").distinct().count() == 1000
    assert ev.telemetry_topic(events.limit(0), "status").count() == 0


@pytest.mark.parametrize("held", [8, 1000])
def test_one_row_of_a_group_goes_to_the_state(held):
    rows = [{"equipmentId": None if i % 5 == 4 else f"EQ-{i % 5}", "partition": i % 2, "offset": 997 * i % 1000, "_slice": i % 3} for i in range(900)]
    batches = pa.Table.from_pylist(rows).to_batches(max_chunksize=50)
    want = {}
    for r in rows:
        name = r["equipmentId"], r["_slice"]
        want[name] = max(want.get(name, (-1, -1)), (r["partition"], r["offset"]))
    got = [r for b in state.newest(iter(batches), "equipmentId", held) for r in b.to_pylist()]
    assert {n: max((r["partition"], r["offset"]) for r in got if (r["equipmentId"], r["_slice"]) == n) for n in want} == want
    assert held < 900 or len(got) == len(want)
    assert list(state.newest(iter([]), "equipmentId")) == []
