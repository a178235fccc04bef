"""Scalar building blocks as pieces of Spark SQL text.

The rules are long conditional expressions. As text they are read at a glance
and reach Spark in one call each; the operators turn them into columns with
``expr`` and Catalyst does the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: one character that is not white space. The default class of the regex engine
# covers ASCII only, so the other Unicode space separators (without the non-breaking ones)
# and the four ASCII separator controls are listed.
NON_BLANK = (
    r"[^\s\x1C-\x1F\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]"
)


def quoted(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(number: float) -> str:
    """A double literal with all digits (a bare 0.8 would be a decimal)."""
    if not math.isfinite(number):
        raise ValueError(f"not a finite number: {number}")
    return f"({float(number)!r}D)"


def texts(values: Iterable[str]) -> str:
    """An array literal of strings."""
    listed = ", ".join(quoted(v) for v in values)
    return f"CAST(array({listed}) AS ARRAY<STRING>)"


def is_blank(text: str) -> str:
    """True for null, empty and white-space-only text."""
    # Nearly all text begins with a printable ASCII character, which settles it.
    return (
        f"(CASE WHEN left({text}, 1) BETWEEN '!' AND '~' THEN false"
        f" ELSE NOT coalesce({text} RLIKE {quoted(NON_BLANK)}, false) END)"
    )


def truncated(number: str) -> str:
    """Double to int, cutting toward zero."""
    return f"CAST({number} AS INT)"


def quotient(dividend: str, divisor: int) -> str:
    """Integer division that cuts toward zero, as int."""
    return f"CAST(({dividend}) div {divisor} AS INT)"


def contains_any(values: str, wanted: Iterable[str]) -> str:
    """True when the array holds one of the wanted texts; false for a null array."""
    wanted = list(wanted)
    return f"coalesce(arrays_overlap({values}, {texts(wanted)}), false)" if wanted else "false"


def count_of(values: str, wanted: Iterable[str]) -> str:
    """How many elements (repeats included) are one of the wanted texts; 0 for a null array.

    One ``array_remove`` per wanted text keeps the expression inside code
    generation, which a lambda would leave.
    """
    removals = [f"size({values}) - size(array_remove({values}, {quoted(w)}))" for w in dict.fromkeys(wanted)]
    return f"coalesce({' + '.join(removals)}, 0)" if removals else "0"


def keep_only(values: str, wanted: Iterable[str]) -> str:
    """The elements that are one of the wanted texts, in order, repeats included."""
    wanted = list(wanted)
    if not wanted:
        return texts([])
    return f"filter({values}, e -> e IN ({', '.join(quoted(w) for w in wanted)}))"


def list_text(values: str) -> str:
    """``[a, b]`` with ``null`` for null elements."""
    return f"concat('[', array_join({values}, ', ', 'null'), ']')"


def fixed(number: str, digits: int) -> str:
    """Text with a fixed number of decimals, halves up.

    The decimal cast rounds the same way and is several times faster than the
    formatter, which only prints what a decimal cannot: huge numbers,
    infinities, and negative numbers that round to zero.
    """
    decimal = f"try_cast({number} AS DECIMAL(38,{digits}))"
    return (
        f"CASE WHEN {decimal} IS NULL OR ({decimal} = 0 AND {number} < 0)"
        f" THEN format_string('%.{digits}f', {number}) ELSE CAST({decimal} AS STRING) END"
    )


def stable_id(kind: str, *coordinates: str) -> str:
    """An id that is the same whenever the same record is processed again."""
    parts = ", ".join(f"CAST({c} AS STRING)" for c in coordinates)
    return f"sha2(concat_ws('|', {quoted(kind)}, {parts}), 256)"


def origin_id(kind: str) -> str:
    """The stable id of a record, from its place in the topic."""
    return stable_id(kind, "topic", "partition", "offset")


def iso_utc(instant: Column) -> Column:
    """ISO-8601 text in UTC, whatever the session time zone is."""
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else None
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        local = instant.cast("timestamp_ntz")
        instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def pinned(value: str | Column) -> Column:
    """The value as generator output, so that a filter on it stays above its computation.

    Catalyst pushes a filter on a computed column below the projections by
    inlining the whole computation, level by level. For a severity, which
    rests on three scores, that multiplies the work and outgrows generated code.
    """
    return F.explode(F.array(F.expr(value) if isinstance(value, str) else value))
