"""Feed readers, sinks and the adapter from the benchmark tables."""
