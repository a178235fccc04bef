"""The shape of the plans: what is decoded once, what is pushed down, what is shuffled."""

import re

import pytest

from checks import events as ev
from checks.queries import QUERIES
from pulsegrid.operators import route, rules_status, rules_stream
from pulsegrid.plans import health, ingest
from pulsegrid.schemas import ENVELOPE
from pulsegrid.streaming import sinks


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topic"))
    spark.createDataFrame([("k", "{}", "t", 0, 1, None)], ENVELOPE).write.mode("overwrite").parquet(path)
    return spark.read.schema(ENVELOPE).parquet(path)


@pytest.mark.parametrize("plan", [
    health.status_messages, health.stream_messages, ingest.messages,
    lambda t: route.critical_only(health.status_health(t)),
    lambda t: route.branched(health.stream_health(t)).filter("branch = 'warning'"),
    lambda t: ingest.outcomes(t), lambda t: ingest.outcomes(t).filter("route = 'rejected'").select("letter.*"),
    lambda t: sinks.laid_out(health.status_messages(t)), lambda t: sinks.laid_out(ingest.messages(t)),
])
def test_one_decode_and_no_shuffle(topic, plan):
    text = _plan(plan(topic))
    assert len(re.findall(r"from_json\(", text)) == 1
    assert "Exchange" not in text
    assert "PythonUDF" not in text and "Python" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    scored = rules_status.score(ev.telemetry(ev.read_events(spark, sf_dir))).select("temperatureScore")
    assert "ReadSchema: struct<event_id:bigint,value:double>" in _plan(scored)


@pytest.mark.parametrize("rules", [rules_status, rules_stream])
def test_a_filter_on_severity_does_not_repeat_the_rules(spark, sf_dir, rules):
    scored = rules.score(ev.telemetry(ev.read_events(spark, sf_dir)))
    plain, filtered = _plan(scored), _plan(route.critical_only(scored))
    assert len(filtered) < 1.5 * len(plain)


def test_scores_stay_in_generated_code(spark, sf_dir):
    scored = rules_stream.score(ev.telemetry(ev.read_events(spark, sf_dir)))
    body = [line for line in _plan(scored).splitlines() if "Project" in line]
    assert body and all("*(1)" in line for line in body)


@pytest.mark.parametrize(("name", "decodes"), [("v08_split", 1), ("t03_severity_branches", 0), ("c03_dead_letter_replay", 2), ("c04_contract_projections", 1)])
def test_split_queries_read_and_decode_once(spark, sf_dir, name, decodes):
    text = _plan(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"FileScan", text)) == 1
    assert len(re.findall(r"from_json\(", text)) == decodes


def test_latest_status_decodes_a_batch_once(spark, topic, tmp_path):
    table = sinks.LatestStatus(health.status_health, str(tmp_path), key="key", tombstone=None)
    plans = []
    keep = type(topic).persist
    try:
        type(topic).persist = lambda self, *a: plans.append(_plan(self)) or keep(self, *a)
        table(topic, 0)
    finally:
        type(topic).persist = keep
    assert len(plans) == 1 and len(re.findall(r"from_json\(", plans[0])) == 1


def test_backfill_gathers_files_by_topic_and_day(spark, sf_dir, tmp_path):
    topic = ev.telemetry_topic(ev.read_events(spark, sf_dir), "status")
    messages = health.status_messages(topic)
    sinks.write_messages(messages, f"{tmp_path}/plain", 0, source=topic)
    sinks.backfill(messages, topic, f"{tmp_path}/gathered")
    count = lambda p: spark.read.schema(sinks.MESSAGES).parquet(f"{p}/messages").select("_metadata.file_path").distinct().count()
    folders = sinks.messages_table(spark, f"{tmp_path}/gathered").select("topic", "day").distinct().count()
    assert count(f"{tmp_path}/gathered") == folders < count(f"{tmp_path}/plain")
