"""What each raw table loads: source format, fields, types and error rule, as plain records."""

from __future__ import annotations

from dataclasses import dataclass, replace

JSON_FILES = r".*\.json(\.gz)?"  # fixed value: name pattern of JSON files


@dataclass(frozen=True)
class Field:
    """One column of a raw table.

    ``mode`` is ``strict`` (a value that does not cast rejects the row) or ``try`` (it gives
    NULL). ``null_text`` is a text that means NULL. ``source`` is the JSON field when it differs.
    """

    name: str
    type: str = "string"
    mode: str = "strict"
    null_text: str | None = None
    required: bool = False
    source: str | None = None

    @property
    def record_field(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class LoadSpec:
    """One raw table; ``identity`` names an id column numbered at load."""

    table: str
    format: str
    fields: tuple[Field, ...]
    pattern: str | None = None
    on_error: str = "abort"
    identity: str | None = None
    multi_line: bool | None = None

    def with_options(self, **changes) -> LoadSpec:
        return replace(self, **changes)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def _texts(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n) for n in names)


# Columns, types and error rules of the raw tables.
SPECS: dict[str, LoadSpec] = {
    s.table: s
    for s in (
        LoadSpec("cities", "json", (Field("city_name", "varchar(50)", required=True),), identity="city_id"),
        LoadSpec("branches", "json", _texts("branch_name", "city_name"), identity="branch_id"),
        LoadSpec(
            "campaigns",
            "csv",
            _texts(
                "campaign_id", "city_id", "channel_id", "impressions", "clicks",
                "conversions", "spend", "start_date", "end_date",
            ),
        ),
        LoadSpec(
            "campaign_channels", "json", (Field("channel_id", "decimal(38,0)"), Field("channel_name")), on_error="continue"
        ),
        LoadSpec(
            "employees",
            "json",
            (
                *_texts("employee_id", "first_name", "last_name", "email", "phone"),
                Field("hire_date", "timestamp_ntz"),
                Field("role"),
            ),
            pattern=JSON_FILES,
            on_error="continue",
        ),
        LoadSpec("products", "csv", _texts("product_id", "product_name", "category", "price"), on_error="continue"),
        LoadSpec("staff", "json", _texts("staff_id", "employee_id"), pattern=JSON_FILES, on_error="continue"),
        LoadSpec(
            "staff_branch_assignments",
            "json",
            (
                Field("staff_id"),
                Field("branch_id", "decimal(38,0)"),
                Field("start_date", "timestamp_ntz"),
                Field("end_date", "timestamp_ntz", mode="try", null_text="NaT"),
            ),
            pattern=JSON_FILES,
            on_error="continue",
        ),
        LoadSpec(
            "sales",
            "csv",
            (
                Field("sale_id", "decimal(38,0)"),
                Field("branch_id", "decimal(38,0)"),
                Field("staff_id"),
                Field("product_id", "decimal(38,0)"),
                Field("sale_date", "timestamp_ntz"),
                Field("volume_sold", "decimal(12,2)"),
                Field("price", "decimal(12,2)"),
                Field("cost", "decimal(12,2)"),
                Field("revenue", "decimal(12,2)"),
            ),
            on_error="continue",
        ),
    )
}
