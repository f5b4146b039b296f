"""DataFrame operators: profiling, missing data, grouping, ordering, statistics."""
