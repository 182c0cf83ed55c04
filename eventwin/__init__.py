"""Event-window analytics on Spark: interval joins, profiles, splits, metrics and attribution."""
