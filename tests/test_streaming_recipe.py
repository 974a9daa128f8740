from dataprism import merge_profiles, profile, publish, read_store
from dataprism.session import scratch_path
from conftest import SF_SMALL


def test_foreach_batch_profiles_and_publishes(spark):
    """The documented recipe: profile + publish per micro-batch; batches of one bucket merge afterwards."""
    src = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    store = scratch_path(spark, "stream-store")
    stream = spark.readStream.schema(src.schema).parquet(f"{SF_SMALL}/events*.parquet")

    def batch(df, _):
        publish(profile(df, "ts", segments="event_type", serialize=True), store, dataset_id="live").collect()

    q = (stream.writeStream.foreachBatch(batch).trigger(availableNow=True)
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).start())
    q.awaitTermination(300)
    merged = merge_profiles(read_store(spark, store, dataset_id="live"), ["dataset_timestamp", "segment"],
                            rows_col=None)
    got = {(r.dataset_timestamp, r.segment): r.profile["columns"]["value"]["count"] for r in merged.collect()}
    direct = {(r.dataset_timestamp, r.segment): r.segment_rows for r in
              profile(src, "ts", segments="event_type", columns=["value"]).collect()}
    assert got == direct
