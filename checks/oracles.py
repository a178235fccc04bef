"""For every query, SQL that DuckDB runs on the same ``events`` table.

The SQL states the rules again in its own words; nothing is shared with the
Spark side but the numbers of the configurations under test.
"""

from __future__ import annotations

from pulsegrid.config import STATUS_PROFILE, STREAM_PROFILE, HealthConfig

from checks.queries import AS_OF, OTHER_STATUS, OTHER_STREAM, RAW_AS_OF

# -- common table expressions -----------------------------------------------------------------------

EQUIPMENT = "'EQ-' || CASE WHEN length(user_id::VARCHAR) < 4 THEN lpad(user_id::VARCHAR, 4, '0') ELSE user_id::VARCHAR END"

TELEMETRY = f"""
telemetry AS (
  SELECT event_id AS "offset", 'k-' || event_id AS key, ts, event_id,
         'evt-' || event_id AS eventId, {EQUIPMENT} AS equipmentId, 'corr-' || event_id AS correlationId,
         event_type AS equipmentType,
         CASE WHEN event_id % 29 <> 0 THEN value END AS temperature,
         CASE WHEN event_id % 31 <> 0 THEN CAST(0.4 AS DOUBLE)
           + CAST(json_extract_string(props, '$.k') AS DOUBLE) * CAST(0.012 AS DOUBLE) END AS pressure,
         CASE event_type
           WHEN 'error' THEN [(['E001', 'E002', 'E003', 'E010', 'E020', 'E999'])[CAST(event_id % 6 AS INTEGER) + 1]]
           WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN ['W001', 'W002'] ELSE CAST([] AS VARCHAR[]) END
           WHEN 'click' THEN CASE WHEN event_id % 7 = 0 THEN ['W010'] ELSE CAST([] AS VARCHAR[]) END
           WHEN 'purchase' THEN CASE WHEN event_id % 4 = 0 THEN ['W001', 'W001', 'X1'] ELSE CAST([] AS VARCHAR[]) END
           WHEN 'signup' THEN CASE WHEN event_id % 2 <> 0 THEN CAST([] AS VARCHAR[]) END
         END AS codes
  FROM events)"""


def _d(number: float) -> str:
    return f"CAST({number!r} AS DOUBLE)"


def _in(codes: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


def _hits(codes: tuple[str, ...]) -> str:
    return f"coalesce(len(list_filter(codes, lambda c: c IN {_in(codes)})), 0)"


def _measured(config: HealthConfig) -> str:
    """Telemetry with NaN read as null and the code matches counted."""
    return TELEMETRY + f""",
measured AS (
  SELECT *, CASE WHEN NOT isnan(temperature) THEN temperature END AS t,
         CASE WHEN NOT isnan(pressure) THEN pressure END AS p,
         {_hits(config.critical_codes)} AS n_critical,
         {_hits(tuple(w for w in config.warning_codes if w not in config.critical_codes))} AS n_warning
  FROM telemetry)"""


def _status(config: HealthConfig = STATUS_PROFILE) -> str:
    c = config
    return "WITH " + _measured(c) + f""",
scored AS (
  SELECT *,
    CAST(CASE WHEN t >= {_d(c.temperature_critical)} THEN 0
      WHEN t >= {_d(c.temperature_warning)} THEN trunc(50 * (1 - (t - {_d(c.temperature_warning)})
        / ({_d(c.temperature_critical)} - {_d(c.temperature_warning)}))) ELSE 100 END AS INTEGER) AS temperatureScore,
    CAST(CASE WHEN p <= {_d(c.pressure_critical_low)} OR p >= {_d(c.pressure_critical_high)} THEN 0
      WHEN p <= {_d(c.pressure_warning_low)} THEN trunc(50 * (1 - ({_d(c.pressure_warning_low)} - p)
        / ({_d(c.pressure_warning_low)} - {_d(c.pressure_critical_low)})))
      WHEN p >= {_d(c.pressure_warning_high)} THEN trunc(50 * (1 - (p - {_d(c.pressure_warning_high)})
        / ({_d(c.pressure_critical_high)} - {_d(c.pressure_warning_high)}))) ELSE 100 END AS INTEGER) AS pressureScore,
    CAST(CASE WHEN n_critical > 0 THEN 0 WHEN n_warning > 0 THEN greatest(30, 100 - 15 * n_warning)
      ELSE 100 END AS INTEGER) AS errorCodeScore
  FROM measured),
weighed AS (
  SELECT *, CAST((temperatureScore * {c.temperature_weight} + pressureScore * {c.pressure_weight}
      + errorCodeScore * {c.error_weight}) // {c.total_weight} AS INTEGER) AS healthScore,
    (temperatureScore = 0 OR pressureScore = 0 OR errorCodeScore = 0 OR n_critical > 0) AS isCritical
  FROM scored),
health AS (
  SELECT *, CASE WHEN isCritical OR healthScore < 30 THEN 'CRITICAL' WHEN healthScore < 70 THEN 'WARNING'
      ELSE 'HEALTHY' END AS severity
  FROM weighed)"""


def _stream(config: HealthConfig = STREAM_PROFILE) -> str:
    c = config
    return "WITH " + _measured(c) + f""",
scored AS (
  SELECT *,
    CASE WHEN temperature IS NULL THEN 'UNKNOWN' WHEN t >= {_d(c.temperature_critical)} THEN 'CRITICAL'
      WHEN t >= {_d(c.temperature_warning)} THEN 'WARNING' ELSE 'NORMAL' END AS temperatureStatus,
    CAST(CASE WHEN t >= {_d(c.temperature_critical)} THEN 0
      WHEN t >= {_d(c.temperature_warning)} THEN greatest(0, trunc(100 - (t - {_d(c.temperature_warning)})
        / ({_d(c.temperature_critical)} - {_d(c.temperature_warning)}) * 100)) ELSE 100 END AS INTEGER) AS temperatureScore,
    CASE WHEN pressure IS NULL THEN 'UNKNOWN'
      WHEN p <= {_d(c.pressure_critical_low)} OR p >= {_d(c.pressure_critical_high)} THEN 'CRITICAL'
      WHEN p <= {_d(c.pressure_warning_low)} OR p >= {_d(c.pressure_warning_high)} THEN 'WARNING'
      ELSE 'NORMAL' END AS pressureStatus,
    CAST(CASE WHEN p <= {_d(c.pressure_critical_low)} OR p >= {_d(c.pressure_critical_high)} THEN 0
      WHEN p <= {_d(c.pressure_warning_low)} THEN greatest(0, trunc(100 - ({_d(c.pressure_warning_low)} - p)
        / ({_d(c.pressure_warning_low)} - {_d(c.pressure_critical_low)}) * 100))
      WHEN p >= {_d(c.pressure_warning_high)} THEN greatest(0, trunc(100 - (p - {_d(c.pressure_warning_high)})
        / ({_d(c.pressure_critical_high)} - {_d(c.pressure_warning_high)}) * 100))
      ELSE 100 END AS INTEGER) AS pressureScore,
    CASE WHEN n_critical > 0 THEN 'CRITICAL' WHEN n_warning > 0 THEN 'WARNING' ELSE 'NONE' END AS errorStatus,
    CAST(CASE WHEN n_critical > 0 THEN 0 WHEN n_warning > 0 THEN greatest(0, 100 - 25 * n_warning)
      ELSE 100 END AS INTEGER) AS errorCodeScore
  FROM measured),
weighed AS (
  SELECT *, CAST(greatest(0, least(100, temperatureScore * {c.temperature_weight} // 100
      + pressureScore * {c.pressure_weight} // 100 + errorCodeScore * {c.error_weight} // 100)) AS INTEGER) AS healthScore
  FROM scored),
health AS (
  SELECT *, CASE WHEN 'CRITICAL' IN (temperatureStatus, pressureStatus, errorStatus) THEN 'CRITICAL'
      WHEN n_warn >= 2 OR healthScore < 40 THEN 'CRITICAL' WHEN n_warn = 1 THEN 'WARNING' ELSE 'HEALTHY' END AS severity
  FROM (SELECT *, CAST(temperatureStatus = 'WARNING' AS INTEGER) + CAST(pressureStatus = 'WARNING' AS INTEGER)
      + CAST(errorStatus = 'WARNING' AS INTEGER) AS n_warn FROM weighed))"""


def _id(kind: str, topic: str = "telemetry.raw") -> str:
    return f"""sha256('{kind}|{topic}|0|' || "offset")"""


ALERT_TYPE = """
    CASE WHEN CAST(temperatureStatus = 'CRITICAL' AS INTEGER) + CAST(pressureStatus = 'CRITICAL' AS INTEGER)
        + CAST(errorStatus = 'CRITICAL' AS INTEGER) > 1 THEN 'COMBINED_CRITICAL'
      WHEN temperatureStatus = 'CRITICAL' THEN 'TEMPERATURE_CRITICAL'
      WHEN pressureStatus = 'CRITICAL' THEN 'PRESSURE_CRITICAL'
      WHEN errorStatus = 'CRITICAL' THEN 'ERROR_CODE_CRITICAL' ELSE 'COMBINED_CRITICAL' END"""

# printf cuts binary fractions, the rules round decimal halves up: so round in decimal first.
ALERT_MESSAGE = """
    'Equipment ' || equipmentId || ' in CRITICAL state. Health score: ' || healthScore
    || CASE WHEN temperatureStatus = 'CRITICAL' THEN '. Temperature: '
         || CAST(CAST(round(CAST(temperature AS DECIMAL(18, 4)), 1) AS DECIMAL(18, 1)) AS VARCHAR) || '°C' ELSE '' END
    || CASE WHEN pressureStatus = 'CRITICAL' THEN '. Pressure: '
         || CAST(CAST(round(CAST(pressure AS DECIMAL(18, 4)), 2) AS DECIMAL(18, 2)) AS VARCHAR) || ' bar' ELSE '' END
    || CASE WHEN errorStatus = 'CRITICAL' THEN '. Error codes: [' || array_to_string(codes, ', ') || ']' ELSE '' END"""

CODES_TEXT = "CASE WHEN codes IS NULL THEN '-' ELSE array_to_string(codes, ',') END"

# The ingestion bodies, put together member by member.
_MEMBERS = f"""
  SELECT event_id AS "offset", event_id % 20 AS m, event_type, ts, 'corr-' || event_id AS corr,
    {EQUIPMENT} AS equipment, CAST(CAST(value AS DECIMAL(10, 2)) AS VARCHAR) AS temp,
    json_extract_string(props, '$.k') AS k, CAST((epoch_us(ts) // 1000) AS VARCHAR) AS ms FROM events"""
_BASE = """'{"equipmentId":"' || equipment || '","timestamp":' || ms || ',"payload":{"temperature":"' || temp
    || '","k":"' || k || '"},"correlationId":"' || corr || '","schemaVersion":"1.0.0","sourceSystem":"edge-'
    || event_type || '","metricName":null,"unit":null}'"""
BODIES = f"""
members AS ({_MEMBERS}),
based AS (SELECT *, {_BASE} AS base FROM members),
bodies AS (
  SELECT "offset", m, event_type, ts, corr, equipment, temp, k, CASE m
    WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN substr(base, 1, 40)
    WHEN 3 THEN replace(base, '"correlationId":"' || corr || '",', '')
    WHEN 4 THEN replace(base, '"timestamp":' || ms, '"timestamp":"' || ms || '"')
    WHEN 5 THEN replace(base, '"k":"' || k || '"', '"k":' || k)
    WHEN 6 THEN replace(base, '"equipmentId":"' || equipment || '"', '"equipmentId":"  "')
    WHEN 7 THEN replace(base, '"correlationId":"' || corr || '"', '"correlationId":null')
    WHEN 8 THEN replace(base, '"metricName":null,"unit":null', '"metricName":{{"string":"temperature"}},"unit":{{"string":"C"}}')
    WHEN 9 THEN replace(base, '"unit":null}}', '"unit":null,"site":"F1"}}')
    WHEN 10 THEN replace(base, '"metricName":null', '"metricName":"temperature"')
    WHEN 11 THEN replace(base, '"sourceSystem":"edge-' || event_type || '",', '')
    ELSE base END AS value
  FROM based)"""


def _checked(bodies: str = BODIES, source: str = "bodies", strict: bool = True) -> str:
    """Judge the body texts with DuckDB's own JSON functions."""
    def text(name: str) -> str:
        return f"""WHEN json_type(doc, '$.{name}') IS NULL THEN 'SchemaMismatch: field ''{name}'' is missing'
      WHEN json_type(doc, '$.{name}') <> 'VARCHAR' THEN 'SchemaMismatch: field ''{name}'' must be of type string'"""

    def optional(name: str) -> str:
        plain = "" if strict else f" OR json_type(doc, '$.{name}') = 'VARCHAR'"
        return f"""WHEN json_type(doc, '$.{name}') IS NULL THEN 'SchemaMismatch: field ''{name}'' is missing'
      WHEN NOT (json_type(doc, '$.{name}') = 'NULL' OR (json_type(doc, '$.{name}') = 'OBJECT'
        AND json_keys(doc, '$.{name}') = ['string'] AND json_type(doc, '$.{name}.string') = 'VARCHAR'){plain})
        THEN 'SchemaMismatch: field ''{name}'' must be of type optional string'"""

    return f"""WITH {bodies},
decoded AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS doc FROM {source}),
judged AS (
  SELECT *, CASE
      WHEN trim(value, ' ' || chr(9)) = '' THEN 'Request body must not be empty'
      WHEN doc IS NULL THEN 'Invalid JSON: the body is not one well-formed document'
      {text('equipmentId')}
      WHEN json_type(doc, '$.timestamp') IS NULL THEN 'SchemaMismatch: field ''timestamp'' is missing'
      WHEN json_type(doc, '$.timestamp') NOT IN ('UBIGINT', 'BIGINT') THEN 'SchemaMismatch: field ''timestamp'' must be of type long'
      WHEN json_type(doc, '$.payload') IS NULL THEN 'SchemaMismatch: field ''payload'' is missing'
      WHEN json_type(doc, '$.payload') <> 'OBJECT' OR len(list_filter(json_keys(doc, '$.payload'),
        lambda k: json_type(doc, '$.payload."' || k || '"') <> 'VARCHAR')) > 0
        THEN 'SchemaMismatch: field ''payload'' must be of type map<string>'
      {text('correlationId')}
      {text('schemaVersion')}
      {text('sourceSystem')}
      {optional('metricName')}
      {optional('unit')}
    END AS mismatch,
    list_filter([
      CASE WHEN trim(json_extract_string(doc, '$.equipmentId'), ' ' || chr(9)) = ''
        THEN 'Field ''equipmentId'' is required and must be non-blank' END,
      CASE WHEN trim(json_extract_string(doc, '$.correlationId'), ' ' || chr(9)) = ''
        THEN 'Field ''correlationId'' is required and must be non-blank' END,
      CASE WHEN trim(json_extract_string(doc, '$.schemaVersion'), ' ' || chr(9)) = ''
        THEN 'Field ''schemaVersion'' is required and must be non-blank' END],
      lambda e: e IS NOT NULL) AS blanks
  FROM decoded),
validated AS (
  SELECT *, CASE WHEN mismatch IS NOT NULL THEN [mismatch] ELSE blanks END AS errors,
    CASE WHEN doc IS NULL THEN 'UNKNOWN' WHEN json_type(doc, '$.equipmentId') IN ('OBJECT', 'ARRAY') THEN ''
      ELSE coalesce(json_extract_string(doc, '$.equipmentId'), 'UNKNOWN') END AS claimed_equipment,
    CASE WHEN doc IS NULL THEN '1.0.0' WHEN json_type(doc, '$.schemaVersion') IN ('OBJECT', 'ARRAY') THEN ''
      ELSE coalesce(json_extract_string(doc, '$.schemaVersion'), '1.0.0') END AS reported,
    coalesce(CASE WHEN position('"correlationId"' IN value) > 0
      THEN nullif(regexp_extract(value, '"correlationId"[^:]*:[^"]*("[^"]*")', 1), '')[2:-2] END, 'UNKNOWN') AS claimed
  FROM judged)"""


VALIDATED = _checked()
VALID = "len(errors) = 0"

# Which of the 25 variants of a telemetry record can be read.
STATUS_OK = "event_id % 25 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 10, 12, 13, 18)"
LENIENT_OK = "event_id % 25 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 10, 12, 18)"
STREAM_OK = "event_id % 25 NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 10, 12, 14, 18)"
_BARE = "event_id % 25 = 17"  # only the equipment is given

FIELDS = ("equipmentId", "timestamp", "payload", "correlationId", "schemaVersion", "sourceSystem", "metricName", "unit")
KINDS = ("string", "long", "map<string>", "string", "string", "string", "optional string", "optional string")


def _conformance() -> str:
    kinds = dict(zip(FIELDS, KINDS))
    whens = []
    for i, name in enumerate(FIELDS):
        wrong = f"SchemaMismatch: field ''{name}'' must be of type {kinds[name]}"
        whens.append(f"WHEN f = {i} AND fault = 0 THEN 'SchemaMismatch: field ''{name}'' is missing'")
        if kinds[name] != "optional string":
            whens.append(f"WHEN f = {i} AND fault = 1 THEN '{wrong}'")
        whens.append(f"WHEN f = {i} AND fault = 2 THEN '{wrong}'")
    return f"""SELECT "offset", error = '' AS valid, error FROM (
      SELECT event_id AS "offset", CASE {' '.join(whens)} ELSE '' END AS error
      FROM (SELECT event_id, event_id % 8 AS f, (event_id // 8) % 4 AS fault FROM events))"""


def _blank_texts() -> str:
    names = ("equipmentId", "correlationId", "schemaVersion")
    parts = ", ".join(
        f"CASE WHEN (event_id // {2 ** i}) % 2 = 1 THEN 'Field ''{n}'' is required and must be non-blank' END"
        for i, n in enumerate(names)
    )
    return f"""SELECT event_id AS "offset", array_to_string(list_filter([{parts}], lambda e: e IS NOT NULL), '; ') AS errors
      FROM events"""


def _changes(order: str, rows: str = "true") -> str:
    return _status() + f""",
lagged AS (SELECT *, lag(severity) OVER (PARTITION BY equipmentId ORDER BY {order}) AS previous FROM health WHERE {rows}),
changed AS (SELECT * FROM lagged WHERE previous IS NULL OR previous <> severity)"""


C01_LOG = _changes('"offset"') + """
  SELECT equipmentId, "offset", severity, coalesce(previous, '') AS previousStatus FROM changed"""

S07 = _status() + """
  SELECT topic, equipmentId AS key, "offset" AS sourceOffset, severity, CAST(healthScore AS VARCHAR) AS healthScore
  FROM (SELECT 'equipment.status' AS topic, * FROM health UNION ALL
        SELECT 'equipment.critical-alert' AS topic, * FROM health WHERE severity = 'CRITICAL')"""

# Every tenth record is a tombstone.
LATEST = """
  SELECT equipmentId, "offset", severity, healthScore FROM (
    SELECT *, row_number() OVER (PARTITION BY equipmentId ORDER BY "offset" DESC) AS r FROM health)
  WHERE r = 1 AND "offset" % 10 <> 0"""

_OTHER = '"offset", temperatureScore, pressureScore, errorCodeScore, healthScore, '


def _two(status_select: str, stream_select: str) -> str:
    """Rows of the status profile and of the stream profile in one result."""
    return f"SELECT * FROM ({_status()} {status_select}) UNION ALL SELECT * FROM ({_stream()} {stream_select})"


def _severities(prefix: str) -> str:
    return prefix + """
  SELECT severity, count(*) AS records, CAST(sum(healthScore) AS BIGINT) AS health,
    CAST(sum(temperatureScore) AS BIGINT) AS temperature, CAST(sum(pressureScore) AS BIGINT) AS pressure,
    CAST(sum(errorCodeScore) AS BIGINT) AS code FROM health GROUP BY severity"""


ORACLES: dict[str, str] = {
    "s01_telemetry_topic": f"""WITH {TELEMETRY}
  SELECT key, 'telemetry.raw' AS topic, CAST(0 AS INTEGER) AS "partition", "offset", equipmentId, correlationId, temperature
  FROM telemetry""",
    "s02_ingestion_bodies": f"""WITH {BODIES} SELECT "offset", value FROM bodies""",
    "s03_status_sink": _two(
        """SELECT 'status' AS profile, equipmentId AS key, "offset" AS sourceOffset, severity,
           CAST(healthScore AS VARCHAR) AS healthScore FROM health""",
        """SELECT 'stream' AS profile, key, "offset" AS sourceOffset, severity,
           CAST(healthScore AS VARCHAR) AS healthScore FROM health"""),
    "s04_alert_sink": _two(
        """SELECT 'equipment.critical-alert' AS topic, equipmentId AS key, "offset" AS sourceOffset, correlationId,
           CAST(healthScore AS VARCHAR) AS healthScore FROM health WHERE severity = 'CRITICAL'""",
        """SELECT 'alerts.critical' AS topic, key, "offset" AS sourceOffset, correlationId,
           CAST(healthScore AS VARCHAR) AS healthScore FROM health WHERE severity = 'CRITICAL'"""),
    "s05_validated_raw_sink": VALIDATED + f"""
  SELECT equipment AS key, "offset" AS sourceOffset, corr AS correlationId, temp AS temperature
  FROM validated WHERE {VALID}""",
    "s06_dead_letter_sink": VALIDATED + f"""
  SELECT CASE WHEN trim(claimed) = '' THEN 'UNKNOWN' ELSE claimed END AS key, "offset" AS sourceOffset,
    claimed_equipment AS equipmentId, value AS originalPayload FROM validated WHERE NOT ({VALID})""",
    "s07_replay_from_earliest": S07,
    "s08_exactly_once": _stream() + """
  SELECT topic, CAST(healthScore AS VARCHAR) AS healthScore, count(*) AS messages, count(DISTINCT "offset") AS records
  FROM (SELECT 'equipment.status' AS topic, * FROM health UNION ALL
        SELECT 'alerts.critical' AS topic, * FROM health WHERE severity = 'CRITICAL')
  GROUP BY topic, healthScore""",
    "s09_latest_status": _status() + LATEST,
    "s09_latest_status_stream": _status() + LATEST,
    "s10_retention": _status() + f"""
  SELECT 'raw' AS topic, "offset" FROM health WHERE ts >= TIMESTAMP '{RAW_AS_OF}' - INTERVAL 7 DAY
  UNION ALL
  SELECT 'alert' AS topic, "offset" FROM health
  WHERE severity = 'CRITICAL' AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""",
    "s11_key_partitions": f"""WITH {TELEMETRY}
  SELECT equipmentId AS key, count(*) AS records, CAST(1 AS BIGINT) AS partitions, CAST(0 AS INTEGER) AS out_of_range,
    true AS several_pieces
  FROM telemetry GROUP BY equipmentId""",

    "v01_empty_body": VALIDATED + """
  SELECT "offset", coalesce(errors[1] = 'Request body must not be empty', false) AS empty_body FROM validated""",
    "v02_malformed_json": VALIDATED + """
  SELECT "offset", coalesce(errors[1] LIKE 'Invalid JSON%', false) AS malformed FROM validated""",
    "v03_reported_version": VALIDATED + """
  SELECT "offset", CASE
      WHEN m IN (0, 1, 2) THEN '1.0.0'
      WHEN "offset" % 5 = 0 THEN '1.' || ("offset" % 7) || '.0' WHEN "offset" % 5 = 1 THEN '2'
      WHEN "offset" % 5 = 3 THEN '' ELSE '1.0.0' END AS reportedVersion FROM validated""",
    "v04_contract_conformance": _conformance(),
    "v05_required_semantics": _blank_texts(),
    "v06_error_list": VALIDATED + """
  SELECT "offset", CAST(len(errors) AS INTEGER) AS error_count, array_to_string(errors, '; ') AS reason FROM validated""",
    "v07_validation_result": VALIDATED + f"""
  SELECT "offset", {VALID} AS valid, CAST(len(errors) AS INTEGER) AS error_count, 'RawTelemetryEvent' AS schemaName,
    reported AS reportedVersion FROM validated""",
    "v08_split": VALIDATED + f"""
  SELECT CASE WHEN {VALID} THEN 'accepted' ELSE 'rejected' END AS route, "offset" FROM validated""",
    "v09_claimed_correlation_id": VALIDATED + """ SELECT "offset", claimed AS correlationId FROM validated""",
    "v10_enriched_event": VALIDATED + f"""
  SELECT "offset", equipment AS equipmentId, (epoch_us(ts) // 1000) AS millis, corr AS correlationId, '1.0.0' AS schemaVersion,
    'edge-' || event_type AS sourceSystem, CASE WHEN m = 8 THEN 'temperature' ELSE '' END AS metricName,
    CASE WHEN m = 8 THEN 'C' ELSE '' END AS unit, temp AS payload_temperature, k AS payload_k,
    'telemetry-ingestion' AS service, {_id('ingest', 'ingest')} AS ingestionId, true AS validated
  FROM validated WHERE {VALID}""",
    "v11_optional_text": VALIDATED + """
  SELECT "offset", CASE WHEN m = 8 THEN 'temperature' WHEN "offset" % 3 = 0 THEN '' ELSE 'm' || ("offset" % 3) END AS metricName,
    CASE WHEN m = 8 THEN 'C' ELSE '' END AS unit FROM validated WHERE len(errors) = 0""",
    "v12_source_system_default": VALIDATED + """
  SELECT "offset", CASE WHEN "offset" % 2 = 0 THEN 'unknown' ELSE 'edge-' || event_type END AS sourceSystem
  FROM validated WHERE len(errors) = 0""",
    "v13_dead_letter": VALIDATED + f"""
  SELECT "offset", claimed_equipment AS equipmentId, CASE WHEN trim(claimed) = '' THEN 'UNKNOWN' ELSE claimed END AS correlationId,
    '1.0.0' AS schemaVersion, 'telemetry.raw' AS originalTopic, 'RawTelemetryEvent' AS originalSchema,
    reported AS originalSchemaVersion, array_to_string(errors, '; ') AS failureReason, 'SCHEMA_VALIDATION' AS failureCode,
    value AS originalPayload, CAST(1 AS INTEGER) AS attemptCount, 'telemetry-ingestion' AS source,
    array_to_string(errors, '; ') AS errors FROM validated WHERE NOT ({VALID})""",
    "v14_claimed_equipment_id": VALIDATED + """ SELECT "offset", claimed_equipment AS equipmentId FROM validated WHERE len(errors) > 0""",
    "v15_acknowledgements": VALIDATED + f"""
  SELECT "offset", CASE WHEN {VALID} THEN 'ACCEPTED' ELSE 'REJECTED' END AS status,
    CASE WHEN {VALID} THEN corr ELSE claimed END AS correlationId,
    CASE WHEN {VALID} THEN 'telemetry.raw' ELSE '' END AS topic,
    CASE WHEN {VALID} THEN 'RawTelemetryEvent' ELSE '' END AS schemaName,
    CASE WHEN {VALID} THEN reported ELSE '' END AS schemaVersion, array_to_string(errors, '; ') AS errors
  FROM validated""",
    "v16_latest_contract": """
  SELECT 'telemetry.' || event_type AS subject, max(event_id) AS version,
    '{"type":"record","name":"V' || max(event_id) || '","fields":[]}' AS "schema" FROM events GROUP BY event_type""",

    "p01_parse_status": f"""WITH {TELEMETRY}
  SELECT "offset", CASE WHEN event_id % 25 = 11 THEN '4711' ELSE equipmentId END AS equipmentId,
    CASE WHEN {_BARE} THEN '' ELSE correlationId END AS correlationId,
    CASE WHEN {_BARE} THEN '' ELSE equipmentType END AS equipmentType,
    CASE WHEN {_BARE} THEN -1 ELSE (epoch_us(ts) // 1000) END AS millis,
    CASE WHEN event_id % 25 NOT IN (17, 19) THEN temperature END AS temperature,
    CASE WHEN NOT {_BARE} THEN pressure END AS pressure,
    CASE WHEN {_BARE} THEN '-' ELSE {CODES_TEXT} END AS codes,
    CASE event_id % 25 WHEN 14 THEN '1.0.0' WHEN 15 THEN '1' ELSE '' END AS schemaVersion
  FROM telemetry WHERE {STATUS_OK}""",
    "p02_parse_stream": f"""WITH {TELEMETRY}
  SELECT "offset", CASE WHEN event_id % 25 = 11 THEN '4711' ELSE equipmentId END AS equipmentId,
    CASE WHEN {_BARE} THEN '' ELSE correlationId END AS correlationId,
    CASE WHEN event_id % 25 NOT IN (17, 19) THEN temperature END AS temperature,
    CASE WHEN NOT {_BARE} THEN pressure END AS pressure
  FROM telemetry WHERE {STREAM_OK}""",
    "p03_stream_defaults": f"""WITH {TELEMETRY}
  SELECT "offset", CASE WHEN {_BARE} THEN {_id('telemetry')} ELSE eventId END AS eventId, (epoch_us(ts) // 1000) AS millis,
    CASE WHEN {_BARE} THEN '' ELSE coalesce(array_to_string(codes, ','), '') END AS codes,
    CAST(1 AS INTEGER) AS schemaVersion FROM telemetry WHERE {STREAM_OK}""",
    "p04_status_defaults": f"""WITH {TELEMETRY}
  SELECT "offset", CASE WHEN {_BARE} THEN '' ELSE coalesce(array_to_string(codes, ','), '') END AS codes, '{{}}' AS metadata,
    CASE event_id % 25 WHEN 15 THEN '1' ELSE '1.0.0' END AS schemaVersion FROM telemetry WHERE {STATUS_OK}""",
    "p05_drop_unusable": f"""
  SELECT 'status' AS profile, event_id AS "offset" FROM events WHERE {STATUS_OK} UNION ALL
  SELECT 'status lenient' AS profile, event_id AS "offset" FROM events WHERE {LENIENT_OK} UNION ALL
  SELECT 'stream' AS profile, event_id AS "offset" FROM events WHERE {STREAM_OK}""",
    "p06_rekey_by_equipment": f"""WITH {TELEMETRY} SELECT equipmentId AS key, "offset" FROM telemetry""",
    "p07_serialise": _two(
        """SELECT 'status' AS profile, "offset", equipmentId, correlationId, CAST(healthScore AS VARCHAR) AS healthScore,
           CAST(severity = 'CRITICAL' AND isCritical AS VARCHAR) AS isCritical, severity, '1.0.0' AS schemaVersion FROM health""",
        """SELECT 'stream' AS profile, "offset", equipmentId, correlationId, CAST(healthScore AS VARCHAR) AS healthScore,
           CAST(severity = 'CRITICAL' AS VARCHAR) AS isCritical, severity, '1' AS schemaVersion FROM health"""),
    "p09_observed_counts": _two(
        """SELECT 'status' AS profile, count(*) AS received, count(*) FILTER (severity = 'CRITICAL') AS critical,
           count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'HEALTHY') AS healthy FROM health""",
        """SELECT 'stream' AS profile, count(*) AS received, count(*) FILTER (severity = 'CRITICAL') AS critical,
           count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'HEALTHY') AS healthy FROM health"""),

    "h01_temperature_score": _status() + """ SELECT "offset", temperatureScore FROM health""",
    "h02_pressure_score": _status() + """ SELECT "offset", pressureScore FROM health""",
    "h03_error_score": _status() + """ SELECT "offset", errorCodeScore FROM health""",
    "h04_health_score": _status() + """ SELECT "offset", healthScore FROM health""",
    "h05_criticality": _status() + """ SELECT "offset", isCritical FROM health""",
    "h06_severity": _severities(_status()),
    "h10_other_configuration": _status(OTHER_STATUS) + f""" SELECT {_OTHER} isCritical, severity FROM health""",
    "h09_health_record": _status() + """
  SELECT "offset", correlationId, equipmentId, equipmentType, (epoch_us(ts) // 1000) AS millis, healthScore, isCritical, severity,
    '1.0.0' AS schemaVersion FROM health""",

    "r01_temperature": _stream() + """ SELECT "offset", temperatureStatus, temperatureScore FROM health""",
    "r02_pressure": _stream() + """ SELECT "offset", pressureStatus, pressureScore FROM health""",
    "r03_error_codes": _stream() + """ SELECT "offset", errorStatus, errorCodeScore FROM health""",
    "r04_matched_codes": "WITH " + _measured(STREAM_PROFILE) + f"""
  SELECT "offset", coalesce(array_to_string(CASE
      WHEN n_critical > 0 THEN list_filter(codes, lambda c: c IN {_in(STREAM_PROFILE.critical_codes)})
      ELSE list_filter(codes, lambda c: c IN {_in(STREAM_PROFILE.warning_codes)}) END, ','), '') AS matched FROM measured""",
    "r05_health_score": _stream() + """ SELECT "offset", healthScore FROM health""",
    "r06_severity": _severities(_stream()),
    "r07_health_record": _stream() + f"""
  SELECT "offset", {_id('health')} AS eventId, equipmentId, correlationId, healthScore, severity = 'CRITICAL' AS isCritical,
    severity, temperatureStatus, pressureStatus, errorStatus, eventId AS sourceEventId, CAST(1 AS INTEGER) AS schemaVersion
  FROM health""",
    "r08_alert_type": _stream() + f""" SELECT "offset", {ALERT_TYPE} AS alertType FROM health WHERE severity = 'CRITICAL'""",
    "r09_alert_message": _stream() + f""" SELECT "offset", {ALERT_MESSAGE} AS message FROM health WHERE severity = 'CRITICAL'""",
    "r10_alert_record": _stream() + f"""
  SELECT "offset", {_id('alert')} AS alertId, equipmentId, correlationId, healthScore, temperature AS temperatureValue,
    pressure AS pressureValue, {CODES_TEXT} AS codes, eventId AS sourceEventId, CAST(1 AS INTEGER) AS schemaVersion
  FROM health WHERE severity = 'CRITICAL'""",
    "r11_other_configuration": _stream(OTHER_STREAM) + f"""
  SELECT {_OTHER} temperatureStatus, pressureStatus, errorStatus, severity FROM health""",

    "t01_all_to_status": f"""
  SELECT topic, count(*) AS messages, CAST(sum("offset") AS BIGINT) AS offset_sum FROM ({_two(
      '''SELECT unnest(CASE WHEN severity = 'CRITICAL' THEN ['equipment.status', 'equipment.critical-alert']
         ELSE ['equipment.status'] END) AS topic, "offset" FROM health''',
      '''SELECT unnest(CASE WHEN severity = 'CRITICAL' THEN ['equipment.status', 'alerts.critical']
         ELSE ['equipment.status'] END) AS topic, "offset" FROM health''')}) GROUP BY topic""",
    "t02_critical_filter": _status() + """ SELECT "offset", healthScore FROM health WHERE severity = 'CRITICAL'""",
    "t03_severity_branches": _stream() + """ SELECT lower(severity) AS branch, "offset" FROM health""",
    "t04_critical_to_alerts": _stream() + f"""
  SELECT key, "offset" AS sourceOffset, {ALERT_TYPE} AS alertType, {ALERT_MESSAGE} AS message, eventId AS sourceEventId
  FROM health WHERE severity = 'CRITICAL'""",

    "c01_status_changes": _changes("ts, eventId") + """
  SELECT equipmentId, (epoch_us(ts) // 1000) AS millis, severity AS status, coalesce(previous, '') AS previousStatus, correlationId,
    eventId AS sourceEventId FROM changed""",
    "c01_status_changes_log_order": C01_LOG,
    "c01_status_changes_stream": C01_LOG,
    "c04_contract_projections": VALIDATED + f"""
  SELECT 'raw' AS contract, equipment AS equipmentId, corr AS correlationId, '1.0.0' AS schemaVersion,
    CAST(2 AS INTEGER) AS members, 'edge-' || event_type AS detail FROM validated WHERE {VALID}
  UNION ALL
  SELECT 'dead letter' AS contract, claimed_equipment AS equipmentId,
    CASE WHEN trim(claimed) = '' THEN 'UNKNOWN' ELSE claimed END AS correlationId, '1.0.0' AS schemaVersion,
    CAST(7 AS INTEGER) AS members, 'SCHEMA_VALIDATION' AS detail FROM validated WHERE NOT ({VALID})""",
    "c03_dead_letter_replay": _checked() + f""",
lenient AS (SELECT "offset", m, {VALID} AS strict_ok FROM validated)
  SELECT CASE WHEN m = 10 THEN 'accepted' ELSE 'dead letter' END AS route, "offset", CAST(2 AS INTEGER) AS attemptCount
  FROM lenient WHERE NOT strict_ok""",

    "f01_f06_numbers": """
  SELECT event_id AS "offset", CAST(trunc(value - 50) AS INTEGER) AS truncated,
    CAST(trunc((event_id - 500) / 7) AS INTEGER) AS quotient, event_id % 3 <> 0 AND value >= 90 AS at_least_90,
    CAST(greatest(0, least(100, event_id - 50)) AS INTEGER) AS clamped,
    CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS two_decimals,
    CAST(CAST(round(CAST(value AS DECIMAL(18, 2)), 1) AS DECIMAL(18, 1)) AS VARCHAR) AS one_decimal FROM events""",
    "f05_f14_texts": f"""WITH {TELEMETRY}
  SELECT "offset", {_hits(("W001", "E010"))} > 0 AS contains, CAST({_hits(("W001", "X1"))} AS INTEGER) AS occurrences,
    coalesce(array_to_string(list_filter(codes, lambda c: c IN ('W001', 'X1')), '+'), '-') AS kept,
    coalesce('[' || array_to_string(codes, ', ') || ']', '-') AS list_text, "offset" % 4 <> 2 AS blank,
    {_id('any')} AS origin_id, (epoch_us(ts) // 1000) AS millis, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
    '{{"equipment":"' || equipmentId || '"}}' AS map_json FROM telemetry""",
}


def _violations() -> str:
    """The texts of the status rules at their default numbers."""
    two = lambda c: f"CAST(CAST(round(CAST({c} AS DECIMAL(18, 4)), 2) AS DECIMAL(18, 2)) AS VARCHAR)"
    c = STATUS_PROFILE
    return f"""list_concat(
      CASE WHEN t >= 90 THEN ['CRITICAL: Temperature ' || {two('t')} || '°C exceeds critical threshold 90.00°C']
        WHEN t >= 75 THEN ['WARNING: Temperature ' || {two('t')} || '°C exceeds warning threshold 75.00°C']
        ELSE CAST([] AS VARCHAR[]) END,
      list_concat(
      CASE WHEN p <= {_d(0.5)} THEN ['CRITICAL: Pressure ' || {two('p')} || ' below critical low threshold 0.50']
        WHEN p >= {_d(1.5)} THEN ['CRITICAL: Pressure ' || {two('p')} || ' exceeds critical high threshold 1.50']
        WHEN p <= {_d(0.8)} THEN ['WARNING: Pressure ' || {two('p')} || ' below warning low threshold 0.80']
        WHEN p >= {_d(1.2)} THEN ['WARNING: Pressure ' || {two('p')} || ' exceeds warning high threshold 1.20']
        ELSE CAST([] AS VARCHAR[]) END,
      coalesce(list_transform(list_filter(codes, lambda c: c IN {_in(c.critical_codes + c.warning_codes)}),
        lambda c: CASE WHEN c IN {_in(c.critical_codes)} THEN 'CRITICAL' ELSE 'WARNING' END
          || ': Error code ' || c || ' detected'), CAST([] AS VARCHAR[]))))"""


ORACLES["h07_violations"] = _status() + f"""
  SELECT "offset", CAST(len(v) AS INTEGER) AS violation_count, array_to_string(v, ' | ') AS violations
  FROM (SELECT "offset", {_violations()} AS v FROM health)"""
ORACLES["h08_breakdown"] = _status() + f"""
  SELECT "offset", temperatureScore, pressureScore, errorCodeScore, CAST(len({_violations()}) AS INTEGER) AS violation_count
  FROM health"""

# The bridge reads other measurements: the body's own temperature text, and k * 0.02 as pressure.
_BRIDGED = f"""
telemetry AS (
  SELECT "offset", ts, equipment AS equipmentId, CAST(temp AS DOUBLE) AS temperature,
    CAST(k AS DOUBLE) * CAST(0.02 AS DOUBLE) AS pressure, CAST([] AS VARCHAR[]) AS codes
  FROM validated WHERE {VALID})"""


def _bridge() -> str:
    rules = lambda text: text.replace(TELEMETRY, f"{VALIDATED[len('WITH '):]}, {_BRIDGED}")
    return f"""SELECT a."offset", a.equipmentId, (epoch_us(a.ts) // 1000) AS millis, a.temperature, a.pressure,
      a.healthScore AS status_score, a.severity AS status_severity, b.healthScore AS stream_score, b.severity AS stream_severity
    FROM ({rules(_status())} SELECT * FROM health) a JOIN ({rules(_stream())} SELECT * FROM health) b ON a."offset" = b."offset" """


ORACLES["p08_measurement_bridge"] = _bridge()

ORACLES["c02_audit_trail"] = f"""
  SELECT * FROM ({VALIDATED}
    SELECT CASE WHEN {VALID} THEN equipment ELSE claimed_equipment END AS equipmentId,
      CASE WHEN {VALID} THEN corr WHEN trim(claimed) = '' THEN 'UNKNOWN' ELSE claimed END AS correlationId,
      act AS action, 'telemetry-ingestion' AS actor,
      CASE WHEN act = 'VALIDATE' AND NOT ({VALID}) THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome,
      CASE WHEN act = 'VALIDATE' THEN 'telemetry.raw-value' ELSE 'telemetry.dlq' END AS resource,
      CAST(len(errors) AS VARCHAR) AS detail
    FROM (SELECT *, unnest(CASE WHEN {VALID} THEN ['VALIDATE'] ELSE ['VALIDATE', 'DEAD_LETTER'] END) AS act FROM validated))
  UNION ALL
  SELECT * FROM ({_status()}
    SELECT equipmentId, correlationId, act AS action, 'status-profile' AS actor, 'SUCCESS' AS outcome,
      CASE WHEN act = 'EMIT_STATUS' THEN 'equipment.status' ELSE 'equipment.critical-alert' END AS resource, severity AS detail
    FROM (SELECT *, unnest(CASE WHEN severity = 'CRITICAL' THEN ['EMIT_STATUS', 'EMIT_ALERT'] ELSE ['EMIT_STATUS'] END) AS act
          FROM health))"""


# -- message tables over several runs and batches --------------------------------------------------

_PER_TOPIC = "count(*) AS messages, count(DISTINCT sourceOffset) AS records, CAST(sum(sourceOffset) AS BIGINT) AS offset_sum"
ORACLES["s07_replay_again"] = f"""
  SELECT topic, {_PER_TOPIC}, CAST(2 AS BIGINT) AS runs FROM ({S07}) GROUP BY topic"""
ORACLES["s10_compacted"] = f"""
  SELECT topic, count(*) AS messages, CAST(sum(sourceOffset) AS BIGINT) AS offset_sum, CAST(1 AS BIGINT) AS runs
  FROM ({S07}) GROUP BY topic"""
ORACLES["s10_expired_days_dropped"] = _status() + f"""
  SELECT topic, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS messages FROM (
    SELECT 'equipment.status' AS topic, * FROM health
    WHERE CAST(ts AS DATE) >= CAST(TIMESTAMP '{RAW_AS_OF}' - INTERVAL 7 DAY AS DATE)
    UNION ALL SELECT 'equipment.critical-alert' AS topic, * FROM health WHERE severity = 'CRITICAL')
  GROUP BY topic, CAST(ts AS DATE)"""
ORACLES["s08_kafka_copies"] = _stream() + """
  SELECT topic, 'telemetry.raw' AS sourceTopic, CAST(0 AS INTEGER) AS sourcePartition, count(*) AS messages,
    CAST(sum("offset") AS BIGINT) AS offset_sum
  FROM (SELECT 'equipment.status' AS topic, * FROM health UNION ALL
        SELECT 'alerts.critical' AS topic, * FROM health WHERE severity = 'CRITICAL') GROUP BY topic"""

# -- what one ingestion run writes beside events and letters -----------------------------------------

_KNOWN = f"CASE WHEN {VALID} THEN corr WHEN trim(claimed) = '' THEN 'UNKNOWN' ELSE claimed END"
ORACLES["v15_acknowledgements_sink"] = VALIDATED + f"""
  SELECT "offset" AS sourceOffset, {_KNOWN} AS key, CASE WHEN {VALID} THEN 'ACCEPTED' ELSE 'REJECTED' END AS status,
    CASE WHEN {VALID} THEN corr ELSE claimed END AS correlationId,
    CASE WHEN {VALID} THEN 'telemetry.raw' ELSE '' END AS target,
    CASE WHEN {VALID} THEN 'RawTelemetryEvent' ELSE '' END AS schemaName,
    CASE WHEN {VALID} THEN reported ELSE '' END AS schemaVersion, array_to_string(errors, '; ') AS errors
  FROM validated"""
ORACLES["c02_audit_sink"] = VALIDATED + f"""
  SELECT "offset" AS sourceOffset, CASE WHEN {VALID} THEN equipment ELSE claimed_equipment END AS key, act AS action,
    'telemetry-ingestion' AS actor, CASE WHEN act = 'VALIDATE' AND NOT ({VALID}) THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome,
    CASE WHEN act = 'VALIDATE' THEN 'telemetry.raw-value' ELSE 'telemetry.dlq' END AS resource, {_KNOWN} AS correlationId,
    CAST(len(errors) AS VARCHAR) AS detail
  FROM (SELECT *, unnest(CASE WHEN {VALID} THEN ['VALIDATE'] ELSE ['VALIDATE', 'DEAD_LETTER'] END) AS act FROM validated)"""
# The newest contract does not know metricName, whose plain text is the fault of every twentieth body.
ORACLES["v16_contract_of_the_registry"] = VALIDATED + f""",
found AS (SELECT *, unnest(['newest', 'missing', 'broken']) AS registry FROM validated),
judged_again AS (SELECT *, {VALID} OR (registry = 'newest' AND m = 10) AS ok FROM found)
  SELECT registry, "offset" AS sourceOffset, CASE WHEN ok THEN 'ACCEPTED' ELSE 'REJECTED' END AS status,
    CASE WHEN NOT ok THEN '' WHEN registry = 'newest' THEN 'Raw2' ELSE 'RawTelemetryEvent' END AS schemaName
  FROM judged_again"""
ORACLES["v02_repeated_members"] = """
  SELECT event_id AS "offset", true AS valid, json_extract_string(props, '$.k') AS k FROM events"""
ORACLES["p08_code_separators"] = VALIDATED + f"""
  SELECT unnest(['comma', 'bar', 'blank', 'dots']) AS separator, "offset", 'X9,W00' || ("offset" % 3 + 1) AS codes,
    CAST(85 AS INTEGER) AS errorCodeScore FROM validated WHERE {VALID}"""
ORACLES["p09_intake_counts"] = f"""
  SELECT 'status' AS profile, count(*) AS received, count(*) FILTER (NOT ({STATUS_OK})) AS dropped FROM events
  UNION ALL
  SELECT 'stream' AS profile, count(*) AS received, count(*) FILTER (NOT ({STREAM_OK})) AS dropped FROM events"""
ORACLES["c04_alert_contract"] = _stream() + f""",
typed AS (SELECT *, {ALERT_TYPE} AS alertType FROM health WHERE severity = 'CRITICAL')
  SELECT "offset", equipmentId, correlationId, '1.0.0' AS schemaVersion, false AS acknowledged, {_id('alert')} AS alertId,
    'CRITICAL' AS severity, 'Critical equipment state: ' || lower(replace(alertType, '_CRITICAL', '')) AS title,
    CASE alertType WHEN 'TEMPERATURE_CRITICAL' THEN '90.0' WHEN 'PRESSURE_CRITICAL' THEN '0.5 to 1.5' ELSE '' END AS threshold,
    CAST(healthScore AS VARCHAR) AS healthScore, eventId AS sourceEventId FROM typed"""


# The nodes of the five contracts in their order: path, and what a value must be.
_HEAD, _TAIL = "equipmentId=type string|timestamp=type long", "correlationId=type string|schemaVersion=type string"
_NODES = {
    "raw-telemetry": f"{_HEAD}|payload[k]=type string|{_TAIL}|sourceSystem=type string|metricName=type optional string|unit=type optional string",
    "equipment-status": f"{_HEAD}|payload=type record EquipmentStatusPayload|payload.status=one IDLE, RUNNING, SETUP, MAINTENANCE, DOWN, UNKNOWN"
    "|payload.previousStatus=type optional enum EquipmentStatus|payload.reasonCode=type optional string|payload.details[k]=type string"
    f"|{_TAIL}|sourceEventId=type optional string",
    "critical-alert": f"{_HEAD}|payload=type record CriticalAlertPayload|payload.alertId=type string|payload.severity=one CRITICAL, HIGH, MEDIUM, LOW"
    "|payload.title=type string|payload.description=type string|payload.threshold=type optional string|payload.observedValue=type optional string"
    f"|payload.attributes[k]=type string|{_TAIL}|acknowledged=type boolean",
    "dead-letter": f"{_HEAD}|payload=type record DeadLetterPayload|payload.originalTopic=type string|payload.originalSchema=type optional string"
    "|payload.originalSchemaVersion=type optional string|payload.failureReason=type string"
    "|payload.failureCode=one SCHEMA_VALIDATION, DESERIALIZATION, PROCESSING_ERROR, TIMEOUT, UNKNOWN|payload.originalPayload=type string"
    f"|payload.attemptCount=type int|{_TAIL}",
    "audit": f"{_HEAD}|payload=type record AuditPayload"
    "|payload.action=one INGEST, VALIDATE, TRANSFORM, EMIT_STATUS, EMIT_ALERT, DEAD_LETTER, REPLAY, SCHEMA_REGISTER, ACKNOWLEDGE"
    f"|payload.actor=type string|payload.outcome=one SUCCESS, FAILURE, SKIPPED|payload.resource=type string|payload.details[k]=type string|{_TAIL}",
}


def _nested_contracts() -> str:
    rows = ", ".join(
        f"({c}, '{name}', {i}, {listed.count('|') + 1}, '{node.split('=')[0]}', '{node.split('=')[1]}')"
        for c, (name, listed) in enumerate(_NODES.items()) for i, node in enumerate(listed.split("|")))
    return f"""WITH nodes(c, contract, i, n, path, rule) AS (VALUES {rows}),
  met AS (SELECT *, event_id % 5 AS c, event_id // 5 AS k FROM events),
  judged AS (SELECT event_id, user_id, contract, (k % (3 * n)) % 3 AS fault, path, rule FROM met JOIN nodes USING (c) WHERE (k % (3 * n)) // 3 = i),
  told AS (SELECT *, CASE fault WHEN 0 THEN 'SchemaMismatch: field ''' || replace(path, '[k]', '') || ''' is missing'
    WHEN 1 THEN 'SchemaMismatch: field ''' || path || ''' must be ' || CASE WHEN rule LIKE 'one %' THEN 'one of ' || rule[5:] ELSE 'of ' || rule END
    ELSE '' END AS error FROM judged)
  SELECT event_id AS "offset", contract, error = '' AS valid, error, CASE WHEN error = '' THEN {EQUIPMENT} ELSE '' END AS equipmentId,
    CAST(CASE WHEN error = '' THEN 1704153600250 ELSE -1 END AS BIGINT) AS millis FROM told"""


ORACLES["v04_nested_contracts"] = _nested_contracts()
ORACLES["v16_unreadable_is_reported"] = """
  SELECT 'telemetry.' || event_type AS subject, event_id AS version, event_id % 7 < 2 AS readable,
    CASE event_id % 7 WHEN 2 THEN 'unknown type number' WHEN 3 THEN 'a union needs branches of different types'
      WHEN 4 THEN 'no contract' WHEN 5 THEN 'no contract' WHEN 6 THEN 'type Loop holds itself' ELSE '' END AS problem FROM events"""
ORACLES["v16_fallback_is_audited"] = VALIDATED + f"""
  SELECT action, outcome, 'telemetry.raw-value' AS resource, '' AS problem, '' AS version, count(*) AS messages
  FROM (SELECT 'VALIDATE' AS action, CASE WHEN {VALID} THEN 'SUCCESS' ELSE 'FAILURE' END AS outcome FROM validated) GROUP BY ALL
  UNION ALL SELECT 'DEAD_LETTER', 'SUCCESS', 'telemetry.dlq', '', '', count(*) FROM validated WHERE NOT {VALID}
  UNION ALL SELECT 'SCHEMA_REGISTER', 'FAILURE', 'telemetry.raw-value', 'unknown type number', '4', 1 FROM events HAVING count(*) > 0"""
ORACLES["s07_replay_over_gaps"] = _status() + """,
placed AS (SELECT "offset" % 2 AS p, "offset" * 3 + "offset" % 2 AS place, severity FROM health),
bounds AS (SELECT min(place) AS low, max(place) AS high FROM placed),
batched AS (SELECT *, (place - low) // ((high - low + 12) // 12) AS b FROM placed, bounds),
sent AS (SELECT *, CASE WHEN b >= 6 THEN 'again' ELSE 'first' END AS run FROM batched WHERE p = 0 OR b NOT IN (4, 5)),
said AS (SELECT run, p, place, 'equipment.status' AS topic FROM sent
  UNION ALL SELECT run, p, place, 'equipment.critical-alert' FROM sent WHERE severity = 'CRITICAL')
  SELECT run, topic, CAST(p AS INTEGER) AS sourcePartition, count(*) AS messages, count(DISTINCT place) AS records, CAST(sum(place) AS BIGINT) AS offset_sum,
    CAST(2 AS BIGINT) AS ranges FROM said GROUP BY run, topic, p"""
ORACLES["s08_copies_on_a_stream"] = _stream() + """
  SELECT topic, count(*) AS messages, count(DISTINCT "offset") AS records, CAST(sum("offset") AS BIGINT) AS offset_sum, true AS bounded
  FROM (SELECT 'equipment.status' AS topic, "offset" FROM health UNION ALL SELECT 'alerts.critical', "offset" FROM health WHERE severity = 'CRITICAL')
  GROUP BY topic"""
ORACLES["s09_latest_status_state"] = _status() + LATEST
ORACLES["s09_latest_status_buckets"] = _status() + LATEST
ORACLES["p09_stream_metrics"] = f"""
  SELECT i.profile, CAST(4 AS BIGINT) AS batches, i.received, dropped, critical, warning, healthy
  FROM ({ORACLES['p09_intake_counts']}) i JOIN ({ORACLES['p09_observed_counts']}) o ON i.profile = o.profile"""
_LATE = "event_id % 50 = 0 AND floor(epoch(ts)) < (SELECT floor(epoch(min(ts))) + (floor(epoch(max(ts))) - floor(epoch(min(ts)))) // 2 FROM events)"
ORACLES["c01_status_changes_out_of_order"] = _changes("ts, eventId", f"NOT ({_LATE})") + f"""
  SELECT equipmentId, "offset", severity, coalesce(previous, '') AS previousStatus, false AS late FROM changed
  UNION ALL SELECT equipmentId, "offset", severity, '', true FROM health WHERE {_LATE}"""
