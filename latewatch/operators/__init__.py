"""DataFrame operators: clean, splits, profile, lookups, matrix, encoders, ranges, metrics, model, gate, monitor."""
