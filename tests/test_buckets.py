"""The bucketed latest table: buckets a batch has not met stay as they are, over repeats, deletions and cleaning."""

import os

import pytest

from pulsegrid.streaming import sinks
from pulsegrid.streaming.buckets import BucketedLatest
from tests.test_stream_state import BASE, LOG, _files, _rows, _stream

SAME = lambda batch: batch


def _frame(spark, rows):
    return spark.createDataFrame(rows, LOG)


def _held(table, spark, schema, **how):
    return sorted((r.equipmentId or "", r.offset, r.severity) for r in table.snapshot(spark, schema, **how).collect())


def _want(rows):
    last = {r[2]: r for r in rows}
    return sorted((k or "", r[1], r[5]) for k, r in last.items() if r[5])


def _folders(path):
    return {b: sorted(d for d in os.listdir(f"{path}/rows/{b}") if d.startswith("bucket")) for b in os.listdir(f"{path}/rows")}


def test_one_equipment_rewrites_one_bucket(spark, tmp_path):
    rows, table = [r for r in _rows() if r[5]], BucketedLatest(SAME, str(tmp_path), buckets=8)
    schema = _frame(spark, rows).schema
    table(_frame(spark, rows), 0)
    first = len(_folders(tmp_path)["batch=0"])
    assert 4 < first <= 8
    more = [(0, 1000, "EQ-3", "e1000", BASE, "CRITICAL")]
    table(_frame(spark, more), 1)
    assert len(_folders(tmp_path)["batch=1"]) == 1
    assert _held(table, spark, schema) == _want(rows + more)
    assert _held(table, spark, schema, before=1) == _want(rows)
    assert sorted(table.versions(spark).values()) == [0] * (first - 1) + [1]


def test_repeats_deletions_and_empty_batches(spark, tmp_path):
    row = lambda offset, key, severity: (0, offset, key, f"e{offset}", BASE, severity)
    batches = [[], [row(1, "A", "HEALTHY"), row(2, None, "WARNING"), row(2, None, "WARNING")], [row(3, "A", None)], [], [row(5, "A", "CRITICAL"), row(4, "A", "WARNING")]]
    table, seen = BucketedLatest(SAME, str(tmp_path), buckets=4), []
    schema = _frame(spark, batches[1]).schema
    assert _held(table, spark, schema) == [] and table.clean(spark) == 0
    for n, rows in enumerate(batches):
        for _ in range(2):
            table(_frame(spark, rows), n)
        seen += sorted(rows, key=lambda r: r[1])
        assert _held(table, spark, schema) == _want(seen)


def test_batch_without_its_map_is_not_read_and_cleaning_keeps_the_last_two(spark, tmp_path):
    rows, table = _rows(), BucketedLatest(SAME, str(tmp_path), buckets=2)
    schema = _frame(spark, rows).schema
    for n in range(4):
        table(_frame(spark, rows[150 * n:150 * n + 150]), n)
    sinks._delete(spark, f"{tmp_path}/versions/batch=3")
    assert _held(table, spark, schema) == _want(rows[:450])
    table(_frame(spark, rows[450:]), 3)
    assert table.clean(spark) == 4
    assert _held(table, spark, schema) == _want(rows) and _held(table, spark, schema, before=3) == _want(rows[:450])
    assert table.clean(spark) == 0


@pytest.mark.parametrize("buckets", [1, 16])
def test_stream_with_a_loss_after_each_write(spark, tmp_path, buckets):
    rows, table, lost = _rows(), BucketedLatest(SAME, f"{tmp_path}/table", buckets=buckets), []
    _files(spark, f"{tmp_path}/in", rows, 3)

    def flaky(batch, batch_id):
        table(batch, batch_id)
        if batch_id == 1 and not lost:
            lost.append(batch_id)
            raise RuntimeError("executor lost")
    with pytest.raises(Exception, match="executor lost"):
        sinks.run_latest(_stream(spark, f"{tmp_path}/in"), flaky, f"{tmp_path}/c").awaitTermination()
    sinks.run_latest(_stream(spark, f"{tmp_path}/in"), flaky, f"{tmp_path}/c").awaitTermination()
    assert _held(table, spark, _frame(spark, rows).schema) == _want(rows)
