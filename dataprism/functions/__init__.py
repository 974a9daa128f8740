"""Column functions: time buckets, statistics, envelope codecs."""
