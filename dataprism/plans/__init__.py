"""Query plans wired to the test tables (the catalogue behind __spark_entry__)."""
