"""Inputs and outputs: raw files, declared sources, calendars, tables."""

from layercake.sources.adapter import as_raw, raw_tables
from layercake.sources.calendar import date_spine, time_spine
from layercake.sources.readers import BadRows, freshness, load_raw, read_raw, source
from layercake.sources.schemas import RAW_SCHEMAS, SOURCES
from layercake.sources.sinks import as_view, catalog_view, layer_name, load_note, table_exists, write_table

__all__ = [
    "BadRows", "RAW_SCHEMAS", "SOURCES", "as_raw", "as_view", "catalog_view", "date_spine", "freshness", "layer_name",
    "load_note", "load_raw",
    "raw_tables", "read_raw", "source", "table_exists", "time_spine", "write_table",
]
