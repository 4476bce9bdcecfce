"""Relational operators on DataFrames."""

from layercake.operators.bitmaps import count_members, member_bitmaps, merge_bitmaps, number_members
from layercake.operators.counts import conditional_counts, grouped_median, grouped_mode, key_flags, weighted_mode
from layercake.operators.dedupe import keep_latest
from layercake.operators.documents import (
    dependency_filter,
    explode_items,
    feed_items,
    feed_summary,
    load_json_docs,
    replace_docs,
    validate_document,
)
from layercake.operators.incremental import (
    high_water_mark,
    new_rows,
    reconcile,
    upsert,
    read_upserted,
    replace_table,
    upsert_table,
)
from layercake.operators.joins import (
    left_join_where_left,
    lookup_key,
)
from layercake.operators.settle import settle
from layercake.operators.windows import (
    first_by,
    lag_growth,
    partition_avg,
    rank_by,
    rank_by_pieces,
    rolling_avg,
)

__all__ = [
    "conditional_counts", "count_members", "dependency_filter", "explode_items", "feed_items",
    "feed_summary", "first_by", "grouped_median", "grouped_mode", "high_water_mark", "keep_latest", "key_flags",
    "lag_growth", "left_join_where_left", "load_json_docs", "lookup_key", "member_bitmaps", "merge_bitmaps",
    "new_rows", "number_members", "partition_avg", "rank_by", "rank_by_pieces", "reconcile", "replace_docs", "rolling_avg",
    "settle", "upsert", "read_upserted", "replace_table", "upsert_table", "validate_document",
    "weighted_mode",
]
