from weirflow.sources.feed import (
    activity_feed,
    change_feed,
    exclusions_feed,
    jobs_feed,
    keyed_by_customer_feed,
    revenue_feed,
    unmapped_feed,
    wide_rows_feed,
)
from weirflow.sources.tables import read_table, stream_table
from weirflow.sources.topics import (
    as_topic,
    read_change_files,
    read_topics,
    split_topics,
    stream_change_files,
)

__all__ = [
    "activity_feed",
    "as_topic",
    "change_feed",
    "exclusions_feed",
    "jobs_feed",
    "keyed_by_customer_feed",
    "read_change_files",
    "read_table",
    "read_topics",
    "revenue_feed",
    "split_topics",
    "stream_change_files",
    "stream_table",
    "unmapped_feed",
    "wide_rows_feed",
]
