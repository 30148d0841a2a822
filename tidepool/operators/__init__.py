"""DataFrame -> DataFrame operators: scans, windows, aggregates, top-N,
patterns, keyed rules and interval joins."""
