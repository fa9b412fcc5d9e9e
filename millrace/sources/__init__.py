"""Staged files and how they are loaded into raw tables."""

from .files import list_stage, read_csv, read_json, read_parquet, stream_csv, stream_json
from .loads import LandingZone, parse, split
from .specs import SPECS, Field, LoadSpec

__all__ = [
    "SPECS",
    "Field",
    "LandingZone",
    "LoadSpec",
    "list_stage",
    "parse",
    "read_csv",
    "read_json",
    "read_parquet",
    "split",
    "stream_csv",
    "stream_json",
]
