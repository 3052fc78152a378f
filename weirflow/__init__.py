"""Change-event merging on Spark: parse, map, audit and merge database change
events into one wide keyed table, in batch or as a stream."""
