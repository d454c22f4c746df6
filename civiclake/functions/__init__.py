"""Column-level helpers: cleaning, dates, JSON, keys."""

from civiclake.functions.clean import (  # noqa: F401
    abs_exceeds,
    clean_columns,
    clean_text,
    clean_upper,
    json_field,
    money,
    money_avg,
    money_sum,
    nested_to_json,
    non_negative_or_null,
    parse_json_column,
    rename,
    safe_ratio,
    to_date_safe,
    to_number,
    to_timestamp_safe,
    typed_null,
    unparsed_flag,
)
from civiclake.functions.dates import duration_hours, iso_week, month_label, week_start, year_month  # noqa: F401
from civiclake.functions.keys import surrogate_key  # noqa: F401
