"""Classification, multi-label, per-group models and metrics."""
