"""Scalar column functions (all built-in expressions, codegen-friendly)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_currency(c: ColumnOrName, symbol: str = "£") -> Column:
    """F1: '£12.50' -> 12.5 and '£1,234.50' -> 1234.5: a leading symbol and commas
    between groups of three digits removed, then a safe cast."""
    plain = F.regexp_replace(_c(c), "^" + re.escape(symbol), "")
    return F.regexp_replace(plain, r"(?<=\d),(?=\d{3}(\D|,|$))", "").try_cast("double")


def parse_offset_timestamp(c: ColumnOrName) -> Column:
    """text with a '+hh:mm'/'-hh:mm' suffix -> instant (UTC session)."""
    return F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX"))


def matches_any(c: ColumnOrName, names: Sequence[str]) -> Column:
    """contains any of the names; names join into one alternation and keep
    their regex meaning, as a pandas ``str.contains`` pattern does."""
    return _c(c).rlike("|".join(names))


def clean_name(c: ColumnOrName) -> Column:
    """lower-case, '.' and ' ' -> '_'."""
    return F.translate(F.lower(_c(c)), ". ", "__")


def clean_identifier(name: str) -> str:
    """F4 for column names (driver-side, on the schema only)."""
    return re.sub(r"[.\s]+", "_", name.strip().lower())


def time_on_date(time_text: ColumnOrName, trade_date: ColumnOrName) -> Column:
    """'HH:MM:SS' on an explicit trade date (no wall clock involved)."""
    return F.try_to_timestamp(F.concat_ws(" ", _c(trade_date).cast("string"), _c(time_text)),
                              F.lit("yyyy-MM-dd HH:mm:ss"))


def floor_minute(c: ColumnOrName) -> Column:
    """seconds set to zero."""
    return F.date_trunc("minute", _c(c))


def round_to_minute_plus(c: ColumnOrName, minutes: int = 0) -> Column:
    """F8: nearest minute, ties to even (00:00:30 -> 00:00, 00:01:30 -> 00:02),
    plus ``minutes``."""
    secs = F.unix_micros(_c(c)) / F.lit(1_000_000.0)
    whole = F.bround(secs / 60.0, 0) * 60 + F.lit(60 * minutes)
    return F.timestamp_seconds(whole.cast("long"))


def format_day(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """F9."""
    return F.date_format(_c(c), fmt)


def elapsed_millis(start: ColumnOrName, end: ColumnOrName) -> Column:
    """interval -> milliseconds."""
    return F.unix_millis(_c(end)) - F.unix_millis(_c(start))


def model_label(name: ColumnOrName, version: ColumnOrName) -> Column:
    """'{name}-v{version}'."""
    return F.format_string("%s-v%s", _c(name), _c(version))


def thousands(c: ColumnOrName) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(_c(c), 0)


def poly_terms(c: ColumnOrName, degree: int = 3, prefix: str = "x") -> list[Column]:
    """x, x^2, ..., x^degree."""
    return [F.pow(_c(c), F.lit(float(d))).alias(f"{prefix}{d}") for d in range(1, degree + 1)]


def in_domain(c: ColumnOrName, domain: Sequence[str]) -> Column:
    """F16: membership of an enum domain (null counts as outside)."""
    return F.coalesce(_c(c).isin(list(domain)), F.lit(False))


def ts_text(c: ColumnOrName, micros: bool = False) -> Column:
    """Timestamp as ISO text -- one printable form for reports and the
    cross-engine check."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss.SSSSSS" if micros else "yyyy-MM-dd HH:mm:ss")
