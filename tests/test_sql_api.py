from dataprism.plans.sql_api import register_profile_view, register_receipts_view
from dataprism.session import scratch_path
from dataprism.sources.tables import table
from conftest import SF_SMALL


def test_sql_pipeline_views(spark):
    """raw SELECT -> profile view -> SQL over profiles -> receipts view, all through spark.sql."""
    table(spark, SF_SMALL, "events").createOrReplaceTempView("t_events")
    register_profile_view(spark, "t_profiled", "SELECT to_date(ts) AS day, * FROM t_events WHERE event_type = 'click'",
                          "ts", partition_by=["day"], segments="event_type", serialize=True)
    n = spark.sql("SELECT count(*) AS n, sum(segment_rows) AS rows FROM t_profiled").first()
    clicks = spark.sql("SELECT count(*) FROM t_events WHERE event_type = 'click'").first()[0]
    assert n.rows == clicks and n.n > 0
    register_receipts_view(spark, "t_receipts", "SELECT 'ds' AS dataset_id, * FROM t_profiled",
                           path=scratch_path(spark, "store"))
    r = spark.sql("SELECT result, count(*) AS c FROM t_receipts GROUP BY result").collect()
    assert [(x.result, x.c) for x in r] == [("Ok", n.n)]
