"""Typed parsing, comparison and money as native columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT, RATE, RESULT = "decimal(19,9)", "decimal(18,9)", "decimal(38,9)"
UNKNOWN = "DESCONOCIDO"
#: Names of the weekdays, Sunday first (fixed values of the published mart).
WEEKDAYS = ["domingo", "lunes", "martes", "miércoles", "jueves", "viernes", "sábado"]
KEY_SEPARATOR = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"
#: Months before the first and after the second count as that month when intervals are cut by month.
FIRST_MONTH, LAST_MONTH = "1900-01-01", "2100-01-01"


def norm_ts(c: Column | str) -> Column:
    """The instant of an ISO date or date and time; without a zone it is UTC, whatever the session's zone; null for anything else."""
    c = _col(c)
    iso = c.rlike(_ISO)
    c = F.regexp_replace(c, r"([T ]\d{2}:\d{2})($|Z|[+-])", "$1:00$2")
    zoned = F.regexp_replace(c, r"([T ].*[+-]\d{2})(\d{2})$", "$1:$2")
    text = F.when(c.rlike(r"[T ].*(Z|[+-][\d:]+)$"), zoned).when(c.rlike("[T ]"), F.concat(c, F.lit("Z"))).otherwise(F.concat(c, F.lit("T00:00:00Z")))
    return F.when(iso, text).try_cast("timestamp")


def utc_date(c: Column | str) -> Column:
    """The UTC date of a timestamp, whatever the session's zone."""
    return F.to_date(F.to_utc_timestamp(_col(c), F.current_timezone()))


def month_key(d: Column | str) -> Column:
    """The month of a date, by which intervals cut with ``month_keys`` are met."""
    bound = lambda m: F.lit(m).cast("date")
    return F.least(F.greatest(F.trunc(_col(d), "MM"), bound(FIRST_MONTH)), bound(LAST_MONTH))


def month_keys(start: Column | str, end: Column | str) -> Column:
    """The months that an interval touches, as an array; open ends are bounded by LAST_MONTH, so none is long."""
    return F.sequence(month_key(start), F.greatest(month_key(start), month_key(end)), F.expr("interval 1 month"))


def parse_date_multi(c: Column | str, day_first: bool = False) -> Column:
    """dd/mm/yyyy (if ``day_first``), an ISO date, or the UTC date of an ISO timestamp; null otherwise.

    Only a bare ISO date is cast as a date: a cast would drop a timestamp's zone.
    """
    c = F.trim(_col(c))
    iso = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date")).otherwise(utc_date(norm_ts(c)))
    if not day_first:
        return iso
    return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "d/M/yyyy")).otherwise(iso)


def parse_bool(c: Column | str) -> Column:
    """1/true and 0/false in any case; anything else is null."""
    text = F.lower(F.trim(_col(c)))
    return F.when(text.isin("1", "true"), True).when(text.isin("0", "false"), False)


def json_scalar(c: Column | str, path: str, parsed: Column | None = None) -> Column:
    """The scalar at a path as text; null for an object or an array there, or invalid JSON.

    ``parsed``: the column as a variant, for callers that read several paths and parse once.
    Texts and booleans are taken from the variant; only numbers are read from the JSON text, as they are written there.
    """
    whole = parsed if parsed is not None else F.try_parse_json(_col(c))
    kind = F.schema_of_variant(F.try_variant_get(whole, path, "variant"))
    nested = F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))
    return F.when(kind.isin("STRING", "BOOLEAN"), F.try_variant_get(whole, path, "string")).when(~nested, F.get_json_object(_col(c), path))


def source_key(*keys: Column | str) -> Column:
    """Key fields joined by a bar; null if one of them is null."""
    cols = [_col(k).cast("string") for k in keys]
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known &= c.isNotNull()
    return F.when(known, F.concat_ws(KEY_SEPARATOR, *cols))


def row_json(*cols: str) -> Column:
    """The columns as JSON, nulls included, in the order of their names."""
    return F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"})


def row_hash(*cols: str) -> Column:
    return F.sha2(row_json(*cols), 256)


def is_distinct(a: Column | str, b: Column | str) -> Column:
    return ~_col(a).eqNullSafe(_col(b))


def money(amount: Column | str, rate: Column | str) -> Column:
    """amount times rate to nine places, half up; null where it doesn't fit."""
    return F.try_multiply(_col(amount).cast(AMOUNT), _col(rate).cast(RATE)).cast(RESULT)


def ratio(a: Column, b: Column) -> Column:
    """A double; null where the divisor is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def clean_code(c: Column | str) -> Column:
    """Trimmed and upper-cased; blank is null."""
    return F.nullif(F.upper(F.trim(_col(c))), F.lit(""))


def with_unknowns(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in cols})


def without(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def calendar_columns(date: str) -> dict[str, Column]:
    """Month and its parts, under the published mart's names."""
    d = F.col(date)
    month = F.trunc(d, "MM")
    year = F.year(d).cast("string")
    return {
        "date": month, "year": F.year(d).cast("long"), "month": F.month(d).cast("long"), "day": F.lit(1).cast("long"),
        "year_month": F.date_format(d, "yyyy-MM"), "year_quarter": F.concat(year, F.lit("-Q"), F.quarter(d).cast("string")),
        "year_semester": F.concat(year, F.lit("-S"), F.when(F.month(d) <= 6, "1").otherwise("2")),
        "day_of_week": F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(month)),
    }
