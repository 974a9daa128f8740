"""Table-level operators: profile, merge, summary, filters, publish."""
