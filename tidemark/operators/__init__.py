"""DataFrame-to-DataFrame operators: cleaning, rollups, metric tables and quality checks."""
