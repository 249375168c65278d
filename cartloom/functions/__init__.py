"""Column-level helpers: time, labels, metrics, masking."""
