"""Fixtures: the ``events`` test table as telemetry, JSON records (clean or damaged) and ingestion bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalar import quoted, texts
from pulsegrid.sources.topics import envelope, table_files

EVENTS_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
TOPIC = "telemetry.raw"

# lpad alone would cut ids of more than four digits.
EQUIPMENT_ID = "concat('EQ-', CASE WHEN user_id < 1000 THEN lpad(CAST(user_id AS STRING), 4, '0') ELSE CAST(user_id AS STRING) END)"
K = "get_json_object(props, '$.k')"
NO_CODES = texts([])
# The table is one file; its texts are made and read in this many pieces at least, and in more if those had more rows than this.
PIECES = 8
ROWS_PER_PIECE = 250_000


def pieces(events: DataFrame) -> int:
    """Pieces for the rows of a table, which are counted."""
    return max(PIECES, -(-events.count() // ROWS_PER_PIECE))


def _pieces(events: DataFrame) -> DataFrame:
    """The table in pieces of neighbouring ids, as the segments of a topic are; so a piece has few days."""
    return events if events.isStreaming else events.repartitionByRange(pieces(events), "event_id")


def read_events(spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> DataFrame:
    return table_files(spark, sf_dir, "events", EVENTS_SCHEMA, streaming=streaming)


def telemetry(events: DataFrame) -> DataFrame:
    """Typed telemetry rows with their origin columns."""
    return events.selectExpr(
        "concat('k-', event_id) AS key",
        f"{quoted(TOPIC)} AS topic",
        "0 AS partition",
        "event_id AS offset",
        "ts AS recordTimestamp",
        "concat('evt-', event_id) AS eventId",
        f"{EQUIPMENT_ID} AS equipmentId",
        "concat('corr-', event_id) AS correlationId",
        "event_type AS equipmentType",
        "ts AS timestamp",
        "CASE WHEN event_id % 29 != 0 THEN value END AS temperature",
        f"CASE WHEN event_id % 31 != 0 THEN 0.4D + CAST({K} AS DOUBLE) * 0.012D END AS pressure",
        f"""CASE event_type
            WHEN 'error' THEN array(elt(CAST(event_id % 6 AS INT) + 1, 'E001', 'E002', 'E003', 'E010', 'E020', 'E999'))
            WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN array('W001', 'W002') ELSE {NO_CODES} END
            WHEN 'click' THEN CASE WHEN event_id % 7 = 0 THEN array('W010') ELSE {NO_CODES} END
            WHEN 'purchase' THEN CASE WHEN event_id % 4 = 0 THEN array('W001', 'W001', 'X1') ELSE {NO_CODES} END
            WHEN 'signup' THEN CASE WHEN event_id % 2 != 0 THEN {NO_CODES} END END AS errorCodes""",
    )


def _telemetry_json(*, profile: str) -> Column:
    """The record of one telemetry row as JSON text, ISO time, null fields written out."""
    names = {
        "status": ("correlationId", "equipmentId", "equipmentType"),
        "stream": ("eventId", "equipmentId", "correlationId"),
    }[profile]
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    record = F.struct(*names, iso, "temperature", "pressure", "errorCodes")
    return F.to_json(record, {"ignoreNullFields": "false"})


def telemetry_topic(events: DataFrame, profile: str) -> DataFrame:
    """Clean telemetry JSON, one record per event, in envelope columns."""
    rows = telemetry(_pieces(events))
    return envelope(
        rows, _telemetry_json(profile=profile), key=F.col("key"), topic=TOPIC,
        offset=F.col("offset"), timestamp=F.col("recordTimestamp"),
    )


def _swap(name: str, text: str) -> str:
    """The record with another value for one member; ``text`` is SQL."""
    pattern = quoted(rf'"{name}":("[^"]*"|\[[^\]]*\]|[^,}}]*)')
    return f"""regexp_replace(doc, {pattern}, concat('"{name}":', {text}))"""


def _plus(member: str) -> str:
    return f"concat(left(doc, length(doc) - 1), ',', {quoted(member)}, '}}')"


# What is done to a record, by event_id % 25; from 20 on it stays as it is.
RECORD_VARIANTS = (
    "CAST(NULL AS STRING)",
    "''",
    "'   '",
    "'null'",
    "'[]'",
    "concat('[', doc, ']')",
    "'\"text\"'",
    "left(doc, length(doc) - 5)",
    "concat(doc, ' tail')",
    _swap("temperature", "concat('\"', coalesce(CAST(temperature AS STRING), ''), '\"')"),
    _swap("temperature", "'\"hot\"'"),
    _swap("equipmentId", "'4711'"),
    _swap("errorCodes", "'{\"code\":\"E001\"}'"),
    _plus('"site":"F1"'),
    _plus('"schemaVersion":"1.0.0"'),
    _plus('"schemaVersion":1'),
    _swap("timestamp", "unix_millis(timestamp)"),
    "concat('{\"equipmentId\":\"', equipmentId, '\"}')",
    _swap("equipmentId", "'{\"id\":\"EQ\"}'"),
    _swap("temperature", "'\"\"'"),
)


def faulty_topic(events: DataFrame, profile: str) -> DataFrame:
    """Telemetry JSON where ``event_id % 25`` damages or varies the record."""
    rows = telemetry(_pieces(events)).withColumn("doc", _telemetry_json(profile=profile))
    value = _case("offset % 25", RECORD_VARIANTS, "doc")
    return envelope(
        rows, F.expr(value), key=F.col("key"), topic=TOPIC,
        offset=F.col("offset"), timestamp=F.col("recordTimestamp"),
    )


def _case(selector: str, variants: tuple[str, ...], other: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {variant}" for i, variant in enumerate(variants))
    return f"CASE {selector} {whens} ELSE {other} END"


def _quote(text: str) -> str:
    return f"concat('\"', {text}, '\"')"


def _payload(k: str) -> str:
    return f"""concat('{{"temperature":"', CAST(value AS DECIMAL(10,2)), '","k":', {k}, '}}')"""


MILLIS = "CAST(unix_millis(ts) AS STRING)"
MEMBERS = {
    "equipmentId": _quote(EQUIPMENT_ID),
    "timestamp": MILLIS,
    "payload": _payload(_quote(K)),
    "correlationId": _quote("concat('corr-', event_id)"),
    "schemaVersion": "'\"1.0.0\"'",
    "sourceSystem": _quote("concat('edge-', event_type)"),
    "metricName": "'null'",
    "unit": "'null'",
}


def _document(**changes: str | None) -> str:
    """The body of an event, member by member; a change to None leaves the member out."""
    members = {name: text for name, text in {**MEMBERS, **changes}.items() if text is not None}
    listed = ", ',', ".join(f"""'"{name}":', {text}""" for name, text in members.items())
    return f"concat('{{', {listed}, '}}')"


# The body of an event, by event_id % 20; from 12 on it has no fault.
BODY_VARIANTS = (
    "''",
    "'   '",
    f"left({_document()}, 40)",
    _document(correlationId=None),
    _document(timestamp=_quote(MILLIS)),
    _document(payload=_payload(K)),
    _document(equipmentId="'\"  \"'"),
    _document(correlationId="'null'"),
    _document(metricName="'{\"string\":\"temperature\"}'", unit="'{\"string\":\"C\"}'"),
    _document(site="'\"F1\"'"),
    _document(metricName="'\"temperature\"'"),
    _document(sourceSystem=None),
)


def ingestion_documents(events: DataFrame) -> DataFrame:
    """Raw ingestion bodies where ``event_id % 20`` picks one fault (0 to 7, 10, 11) or a variant."""
    return _bodies(events, _case("event_id % 20", BODY_VARIANTS, _document()))


def clean_documents(events: DataFrame) -> DataFrame:
    """Raw ingestion bodies without a fault, one per event."""
    return _bodies(events, _document())


def _bodies(events: DataFrame, value: str) -> DataFrame:
    return envelope(
        _pieces(events), F.expr(value), key=F.expr("concat('k-', event_id)"), topic="ingest",
        offset=F.col("event_id"), timestamp=F.col("ts"),
    )
