"""DataFrame operators that shuffle: joins, grouping, ids, statistics."""
