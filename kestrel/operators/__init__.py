"""DataFrame-in, DataFrame-out operators grouped by data shape."""
