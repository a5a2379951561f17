from tidewell.operators import merge
from tidewell.plans import catalog


def test_the_whole_log_is_replayed(spark, tmp_path, monkeypatch):
    rows = spark.range(9000).selectExpr("id AS event_id", "id % 7 AS user_id", "'view' AS event_type", "1.0D AS value")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    seen, current = [], merge.current
    monkeypatch.setattr(merge, "current", lambda rows, *args: (seen.append(rows.count()), current(rows, *args))[1])
    assert catalog.replay_idempotent(spark, str(tmp_path)).count() == 7
    assert seen == [18000]
