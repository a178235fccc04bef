"""Both rule profiles: the known cases, and the boundary grid against plain arithmetic."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from pulsegrid.config import STATUS_PROFILE, STREAM_PROFILE, HealthConfig
from pulsegrid.operators import rules_status, rules_stream

TELEMETRY = "temperature double, pressure double, errorCodes array<string>"
NAN = float("nan")
TEMPERATURES = [None, NAN, 74.99, 75.0, 75.01, 82.5, 89.69, 89.71, 89.99, 90.0, 120.0, 1e9]
PRESSURES = [None, NAN, -1.0, -0.001, 0.49, 0.5, 0.51, 0.79, 0.8, 0.81, 1.0, 1.19, 1.2, 1.21, 1.49, 1.5, 1.51]
CODES = [
    None, [], [None], ["X1"], ["W001"], ["W001"] * 4, ["W001"] * 5, ["W010"], ["E001"], ["W001", "E001"],
    [None, "W002", "E003", "it's"],
]
GRID = list(itertools.product(TEMPERATURES, PRESSURES, CODES))


def _scored(spark, rules, rows, config):
    return rules.score(spark.createDataFrame(rows, TELEMETRY), config).collect()


@pytest.mark.parametrize("t, p, codes, score, severity, critical", [
    (60.0, 1.0, [], 100, "HEALTHY", False),
    (95.0, 1.0, [], 70, "CRITICAL", True),
    # The weighted score is 79, so a warning temperature alone stays healthy.
    (80.0, 1.0, [], 79, "HEALTHY", False),
    (60.0, 0.3, [], 70, "CRITICAL", True),
    (60.0, 1.8, [], 70, "CRITICAL", True),
    (60.0, 1.0, ["E001"], 60, "CRITICAL", True),
    (60.0, 1.0, ["W001", "W002"], 88, "HEALTHY", False),
    (None, None, None, 100, "HEALTHY", False),
])
def test_status_cases(spark, t, p, codes, score, severity, critical):
    config = HealthConfig(critical_codes=("E001", "E002", "E003"), warning_codes=("W001", "W002"))
    row = _scored(spark, rules_status, [(t, p, codes)], config)[0]
    assert (row.healthScore, row.severity, row.isCritical) == (score, severity, critical)


def test_status_violations(spark):
    rows = _scored(spark, rules_status, [
        (95.0, 1.0, []), (60.0, 1.0, ["E001", "X", "W001"]), (80.125, 0.505, None), (60.0, -0.001, []),
        (60.0, 1e300, []), (60.0, float("inf"), []),
    ], STATUS_PROFILE)
    assert [r.violations for r in rows[:4]] == [
        ["CRITICAL: Temperature 95.00°C exceeds critical threshold 90.00°C"],
        ["CRITICAL: Error code E001 detected", "WARNING: Error code W001 detected"],
        ["WARNING: Temperature 80.13°C exceeds warning threshold 75.00°C",
         "WARNING: Pressure 0.51 below warning low threshold 0.80"],
        ["CRITICAL: Pressure -0.00 below critical low threshold 0.50"],
    ]
    assert rows[4].violations[0].startswith("CRITICAL: Pressure 1000000")
    assert rows[5].violations == ["CRITICAL: Pressure Infinity exceeds critical high threshold 1.50"]


@pytest.mark.parametrize("column, value, status, score", [
    ("temperature", 50.0, "NORMAL", 100), ("temperature", 82.5, "WARNING", 50),
    ("temperature", 95.0, "CRITICAL", 0), ("temperature", None, "UNKNOWN", 100),
    ("temperature", 75.0, "WARNING", 100), ("temperature", NAN, "NORMAL", 100),
    ("pressure", 1.0, "NORMAL", 100), ("pressure", 0.7, "WARNING", 66), ("pressure", 1.6, "CRITICAL", 0),
    ("error", [], "NONE", 100), ("error", ["E001"], "CRITICAL", 0), ("error", ["W001"], "WARNING", 75),
    ("error", ["W001"] * 5, "WARNING", 0),
])
def test_stream_dimensions(spark, column, value, status, score):
    row = {"temperature": (value, 1.0, []), "pressure": (50.0, value, []), "error": (50.0, 1.0, value)}[column]
    result = _scored(spark, rules_stream, [row], STREAM_PROFILE)[0]
    score_column = "errorCodeScore" if column == "error" else f"{column}Score"
    assert (result[f"{column}Status"], result[score_column]) == (status, score)


@pytest.mark.parametrize("statuses, score, severity", [
    (("CRITICAL", "NORMAL", "NONE"), 70, "CRITICAL"), (("WARNING", "WARNING", "NONE"), 55, "CRITICAL"),
    (("WARNING", "NORMAL", "NONE"), 85, "WARNING"), (("NORMAL", "NORMAL", "NONE"), 35, "CRITICAL"),
    (("NORMAL", "NORMAL", "NONE"), 100, "HEALTHY"),
])
def test_stream_severity(spark, statuses, score, severity):
    df = spark.createDataFrame([(*statuses, score)], [*rules_stream.STATUSES, "healthScore"])
    assert df.select(F.expr(rules_stream.severity())).first()[0] == severity


@pytest.mark.parametrize("scores, expected", [((100, 100, 100), 100), ((0, 100, 100), 70), ((33, 33, 33), 31)])
def test_stream_score_cuts_each_part(spark, scores, expected):
    df = spark.createDataFrame([scores], ["temperatureScore", "pressureScore", "errorCodeScore"])
    assert df.select(F.expr(rules_stream.health_score())).first()[0] == expected


def test_alert_type_and_message(spark):
    health = spark.createDataFrame([
        ("k", "t", 0, 1, None, "EQ-1", "c", None, 30, "CRITICAL", "CRITICAL", "NONE", 95.25, 0.3, ["W001", None], "e"),
        ("k", "t", 0, 2, None, "EQ-2", "c", None, 60, "NORMAL", "NORMAL", "CRITICAL", 20.0, 1.0, ["E001", None, "X"], "e"),
        ("k", "t", 0, 3, None, "EQ-3", "c", None, 55, "WARNING", "WARNING", "NONE", 80.0, 0.7, [], "e"),
    ], "key string, topic string, partition int, offset long, recordTimestamp timestamp, equipmentId string,"
       " correlationId string, timestamp timestamp, healthScore int, temperatureStatus string,"
       " pressureStatus string, errorStatus string, temperature double, pressure double,"
       " errorCodes array<string>, sourceEventId string")
    rows = rules_stream.alerts(health).orderBy("offset").collect()
    assert [r.alertType for r in rows] == ["COMBINED_CRITICAL", "ERROR_CODE_CRITICAL", "COMBINED_CRITICAL"]
    assert [r.message for r in rows] == [
        "Equipment EQ-1 in CRITICAL state. Health score: 30. Temperature: 95.3°C. Pressure: 0.30 bar",
        "Equipment EQ-2 in CRITICAL state. Health score: 60. Error codes: [E001, null, X]",
        "Equipment EQ-3 in CRITICAL state. Health score: 55",
    ]


def _band(distance, width, top):
    return int(top * (1 - distance / width)) if top == 50 else max(0, int(100 - (distance / width) * 100))


def _dimension(value, lows, highs, top):
    """(status, score) of a measured value with optional (critical, warning) bounds on either side."""
    if value is None:
        return "UNKNOWN", 100
    if math.isnan(value):
        return "NORMAL", 100
    if (lows and value <= lows[0]) or value >= highs[0]:
        return "CRITICAL", 0
    if lows and value <= lows[1]:
        return "WARNING", _band(lows[1] - value, lows[1] - lows[0], top)
    if value >= highs[1]:
        return "WARNING", _band(value - highs[1], highs[0] - highs[1], top)
    return "NORMAL", 100


def _expected(t, p, codes, c, profile):
    top = 50 if profile == "status" else 100
    ts, tsc = _dimension(t, None, (c.temperature_critical, c.temperature_warning), top)
    ps, psc = _dimension(p, (c.pressure_critical_low, c.pressure_warning_low),
                         (c.pressure_critical_high, c.pressure_warning_high), top)
    critical = sum(code in c.critical_codes for code in codes or [])
    warning = sum(code in c.warning_codes and code not in c.critical_codes for code in codes or [])
    weights = (c.temperature_weight, c.pressure_weight, c.error_weight)
    if profile == "status":
        esc = 0 if critical else (max(30, 100 - 15 * warning) if warning else 100)
        score = sum(s * w for s, w in zip((tsc, psc, esc), weights)) // sum(weights)
        flag = 0 in (tsc, psc, esc)
        return tsc, psc, esc, score, "CRITICAL" if flag or score < 30 else "WARNING" if score < 70 else "HEALTHY"
    esc = 0 if critical else (max(0, 100 - 25 * warning) if warning else 100)
    es = "CRITICAL" if critical else "WARNING" if warning else "NONE"
    score = max(0, min(100, sum(s * w // 100 for s, w in zip((tsc, psc, esc), weights))))
    warnings = [ts, ps, es].count("WARNING")
    if "CRITICAL" in (ts, ps, es) or warnings >= 2 or score < 40:
        return tsc, psc, esc, score, "CRITICAL"
    return tsc, psc, esc, score, "WARNING" if warnings else "HEALTHY"


OTHER = HealthConfig(
    temperature_warning=75.0, temperature_critical=75.0, pressure_warning_low=0.5, pressure_warning_high=1.2,
    pressure_critical_low=0.6, pressure_critical_high=1.21, critical_codes=("X1",), warning_codes=("X1", "W010", "it's"),
    temperature_weight=7, pressure_weight=3, error_weight=1,
)


@pytest.mark.parametrize("profile, rules, config", [
    ("status", rules_status, STATUS_PROFILE), ("status", rules_status, OTHER),
    ("stream", rules_stream, STREAM_PROFILE), ("stream", rules_stream, OTHER),
    ("status", rules_status, HealthConfig(critical_codes=(), warning_codes=())),
    ("stream", rules_stream, HealthConfig(critical_codes=(), warning_codes=("W001",))),
])
def test_boundary_grid(spark, profile, rules, config):
    names = ("temperatureScore", "pressureScore", "errorCodeScore", "healthScore", "severity")
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(GRID)], "i int, " + TELEMETRY)
    got = {r.i: tuple(r[n] for n in names) for r in rules.score(df, config).select("i", *names).collect()}
    wrong = [
        (row, got[i], _expected(*row, config, profile)) for i, row in enumerate(GRID)
        if got[i] != _expected(*row, config, profile)
    ]
    assert not wrong, wrong[:5]


def test_zero_weights_are_refused():
    with pytest.raises(ValueError):
        HealthConfig(temperature_weight=0, pressure_weight=0, error_weight=0)
