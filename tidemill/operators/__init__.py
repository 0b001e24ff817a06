"""DataFrame operators: aggregation, profiling, cleaning, assembly, search."""
