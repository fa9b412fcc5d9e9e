"""Relational operators built from DataFrame expressions."""

from .calendar import date_bounds, date_series
from .changes import has_changes, table_changes
from .dedupe import first_per_key
from .joins import fits_broadcast, lookup
from .keys import assign_keys, max_key
from .merge import merge, merge_counts
from .quality import (
    AcceptedValues,
    MaxLength,
    NotNull,
    Unique,
    check_accepted_values,
    check_max_length,
    check_not_null,
    check_unique,
    run_checks,
)
from .shaping import (
    null_placeholder,
    preview,
    project_fields,
    project_json,
    project_positions,
    rename_passthrough,
    required_key_filter,
    upper_bound_filter,
)

__all__ = [
    "AcceptedValues",
    "MaxLength",
    "NotNull",
    "Unique",
    "assign_keys",
    "check_accepted_values",
    "check_max_length",
    "check_not_null",
    "check_unique",
    "date_bounds",
    "date_series",
    "first_per_key",
    "fits_broadcast",
    "has_changes",
    "lookup",
    "max_key",
    "merge",
    "merge_counts",
    "null_placeholder",
    "preview",
    "project_fields",
    "project_json",
    "project_positions",
    "rename_passthrough",
    "required_key_filter",
    "run_checks",
    "table_changes",
    "upper_bound_filter",
]
