"""DataFrame operators: statistics, lookups, ranks, splits, fitted transforms, metrics, blends."""
