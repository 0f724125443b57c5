"""Jobs that run the operators end to end, and the query library over the metric tables."""
