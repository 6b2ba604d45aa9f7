"""Reading and writing: statement files, Parquet tables, and feeds made from other tables."""

from tillroll.sources.feeds import event_spend, lineitem_feed, order_spend
from tillroll.sources.scratch import scratch_path
from tillroll.sources.statements import read_statements, stream_statements
from tillroll.sources.tables import (
    append_partitioned,
    append_table,
    count_per_value,
    find_table,
    read_table,
    replace_partitions,
    replace_table,
)

__all__ = [
    "append_partitioned",
    "append_table",
    "count_per_value",
    "event_spend",
    "find_table",
    "lineitem_feed",
    "order_spend",
    "read_statements",
    "read_table",
    "replace_partitions",
    "replace_table",
    "scratch_path",
    "stream_statements",
]
