"""Sources: test tables, profile files, synthetic data."""
