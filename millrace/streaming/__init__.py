"""Structured Streaming: file auto-ingest and delta merges."""

from .deltas import merge_deltas, merge_sales_delta
from .ingest import auto_ingest

__all__ = ["auto_ingest", "merge_deltas", "merge_sales_delta"]
