"""Column-level building blocks (no shuffles): keys, time, JSON arrays."""
