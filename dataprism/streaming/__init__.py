"""Streaming: intentionally empty.

The reference profiles batch partitions only and has no streaming operator, so none is built here. A stream can be
profiled per micro-batch with ``writeStream.foreachBatch(lambda df, _: publish(profile(df, ...), path, ...))``;
profiles of the same bucket from different batches combine with ``merge_profiles``.
"""
