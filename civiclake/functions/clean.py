"""ANSI-safe column expressions for cleaning raw text, numbers and JSON.

All helpers return ``Column`` expressions built from Spark's built-in
functions, so they stay inside whole-stage codegen.  Nothing here raises
on junk input under ANSI mode: unparsable values become NULL and can be
counted with :func:`unparsed_flag`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Trim spaces; empty string becomes NULL.

    ``trim`` strips the space character only, so a leading tab survives,
    as in the reference cleaning step.
    """
    t = F.trim(col_(c))
    return F.nullif(t, F.lit(""))


def clean_upper(c: str | Column) -> Column:
    """Trim + empty->NULL + upper case (P3 then P4)."""
    return F.upper(clean_text(c))


def clean_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply :func:`clean_text` to the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: clean_text(c) for c in present}) if present else df


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename existing columns (P1); unknown names are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def to_number(c: str | Column, dtype: str = "decimal(18,2)") -> Column:
    """String/number -> numeric without raising."""
    return col_(c).try_cast(dtype)


def to_date_safe(c: str | Column) -> Column:
    """Parse a date; junk becomes NULL (P10).

    Accepts ``yyyy-MM-dd`` and ISO date-times (the date part is kept).
    Uses the cast parser, which reports failure without exceptions (a
    pattern-based parser throws and catches per bad row, which is slow).
    """
    return col_(c).cast("string").try_cast("date")


def to_timestamp_safe(c: str | Column) -> Column:
    """Parse a timestamp (``yyyy-MM-ddTHH:mm[:ss]`` and variants); junk -> NULL."""
    return F.try_to_timestamp(col_(c).cast("string"))


def unparsed_flag(raw: str | Column, parsed: str | Column) -> Column:
    """1 when a non-NULL raw value failed to parse, else 0 (for profiles)."""
    return F.when(col_(raw).isNotNull() & col_(parsed).isNull(), 1).otherwise(0)


def json_field(c: str | Column, field: str, dtype: str | None = None) -> Column:
    """Field of a JSON document stored as text.

    Uses a JSON path, so it accepts both ``{"id":7}`` and ``{"id": 7}``
    and returns NULL for junk.  ``dtype`` casts without raising.
    """
    v = F.get_json_object(col_(c), f"$.{field}")
    return v.try_cast(dtype) if dtype else v


def parse_json_column(df: DataFrame, column: str, fields: Iterable[str]) -> DataFrame:
    """Add ``<column>_<field>`` for each field of a JSON text column (P5).

    The intended meaning of the reference helper: a JSON-path lookup that
    accepts spaced and compact JSON and numbers (its regex matched neither).
    A missing column leaves the frame unchanged.
    """
    if column not in df.columns:
        return df
    return df.withColumns({f"{column}_{f}": json_field(column, f) for f in fields})


def nested_to_json(df: DataFrame) -> DataFrame:
    """Turn every struct / array / map column into its JSON text."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    return df.withColumns({n: F.to_json(n) for n in nested}) if nested else df


def non_negative_or_null(c: str | Column) -> Column:
    """Validation predicate of the expense rule: NULL or >= 0."""
    c = col_(c)
    return c.isNull() | (c >= 0)


def abs_exceeds(c: str | Column, k: float) -> Column:
    """``abs(c) > k``; NULL stays NULL."""
    return F.abs(col_(c)) > F.lit(k)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col_(num), col_(den))


def money(c: str | Column) -> Column:
    """Monetary value as decimal(18,2) so sums are exact (§2.13 #8)."""
    return col_(c).try_cast("decimal(18,2)")


def money_sum(c: str | Column) -> Column:
    """Exact decimal sum of a money column, returned as double."""
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    """Exact decimal average of a money column, returned as double."""
    return F.avg(money(c)).cast("double")


def money_avg_from_parts(total: str | Column, count: str | Column) -> Column:
    """The average ``money_avg`` would give, rebuilt from a decimal sum and a count.

    Mirrors Spark's decimal average: sum as decimal(28,2) divided by the
    count as decimal(20,0), result cast to decimal(22,6), then to double.
    Lets a report aggregate per entity first and combine the parts later.
    """
    avg = (col_(total).cast("decimal(28,2)") / col_(count).cast("decimal(20,0)")).cast("decimal(22,6)")
    return F.when(col_(count) > 0, avg).cast("double")


def typed_null(dtype: str) -> Column:
    """A typed NULL constant."""
    return F.lit(None).cast(dtype)


def among(c: str, values) -> Column:
    """The column is one of some values, NULL among them if one is None (a filter that prunes partitions)."""
    values = list(values)
    known = [v for v in values if v is not None]
    found = F.col(c).isin(known) if known else F.lit(False)
    return found | F.col(c).isNull() if len(known) < len(values) else found
