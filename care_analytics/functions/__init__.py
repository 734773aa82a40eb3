"""Driver-side parameter parsing and column-level helpers."""
