"""DataFrame-in, DataFrame-out operators and the tables they maintain."""
