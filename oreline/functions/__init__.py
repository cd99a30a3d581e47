"""Column-in, Column-out building blocks."""

from oreline.functions.columns import (
    blank_to_date,
    calendar_parts,
    cast_columns,
    date_key,
    is_open_ended,
    iso_week,
    lower,
    map_values,
    month_name,
    net_amount,
    surrogate_key,
    to_bit,
    typed_lit,
    upper,
    utc_naive,
    varchar,
    with_batch_id,
)
from oreline.functions.results import clean_result, phase_timing, status_flags

__all__ = [
    "blank_to_date",
    "calendar_parts",
    "cast_columns",
    "clean_result",
    "date_key",
    "is_open_ended",
    "iso_week",
    "lower",
    "map_values",
    "month_name",
    "net_amount",
    "phase_timing",
    "status_flags",
    "surrogate_key",
    "to_bit",
    "typed_lit",
    "upper",
    "utc_naive",
    "varchar",
    "with_batch_id",
]
