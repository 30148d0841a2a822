"""Sources (record readers, test-data views) and sinks."""
