"""Table-level operators: profiling, balancing, splitting, encoding, selection, metrics."""
