"""Numbers, ranks and enumerations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.text import strip

# Orderings, worst or most advanced first.
SEVERITIES = ("error", "warn", "info", "skipped")
PUBLICATION_STATES = ("absent", "partial", "complete")
REPORT_STATES = (
    "PASS",
    "PASS WITH WARNINGS",
    "PASS WITH NOTES",
    "FAIL",
    "PENDING",
    "STALE",
)
CURATION_STATES = ("confirmed", "not_found", "unreviewed")

# Fixed value: relative tolerance for two renderings of one number.
TOLERANCE = 1e-9


def rank_in(c: Column, ordered: tuple[str, ...]) -> Column:
    """Position of a value in a fixed ordering; null when it is not there."""
    position = F.array_position(F.array(*[F.lit(v) for v in ordered]), c)
    return F.when(position > 0, (position - 1).cast("int"))


def severity_rank(c: Column) -> Column:
    return rank_in(c, SEVERITIES)


# Decimal numbers and the words for what is none; no hex, no type suffix.
NUMBER = r"^[+-]?(\d[\d_]*\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)$"
NO_FINITE = r"^[+-]?(?i:inf|infinity|nan)$"


def as_number(c: Column) -> Column:
    """A double, or null when the text is no number."""
    t = strip(c.cast("string"))
    return F.when(t.rlike(NUMBER) | t.rlike(NO_FINITE), F.regexp_replace(t, r"(?<=\d)_(?=\d)", "").try_cast("double"))


def as_finite(c: Column) -> Column:
    """A double that is neither infinite nor NaN, or null."""
    n = as_number(c)
    return F.when(F.abs(n) < float("inf"), n)


def as_whole(c: Column) -> Column:
    """A bigint, or null when the number has a fraction or is too large; digits are kept exactly."""
    t = strip(c.cast("string"))
    n = as_finite(c)
    return F.coalesce(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), F.when((n == F.floor(n)) & (F.abs(n) < 2.0**63), n.try_cast("bigint")))


def close_enough(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return F.abs(a - b) <= F.lit(tolerance) * scale


def nested(body: Column, *keys: str) -> Column:
    """Text at a path of a JSON document; null when any level is absent."""
    return F.get_json_object(body, "$." + ".".join(keys))
