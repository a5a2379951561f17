"""The mirror's query on logs whose event ids have gaps or repeat, and rows that move along chains of keys."""

import pytest
from compare import spark_rows, sql_rows
from test_mirror import Log, live
from test_mirror_whole import NOTES, change, loaded

from tidewell.plans.catalog import QUERIES, SQL
from tidewell.sources.tables import Replica
from tidewell.streaming import drain


def test_a_second_tombstone_of_a_key_does_not_share_the_life_that_the_first_one_ended(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one")])
    log = Log()
    log.transaction(10, change("U", [11, 1, "u"], [1, None, None]), change("U", [21, 1, "first"], [11, None, None]))
    log.transaction(20, change("U", [12, 2, "second"], [1, None, None]), change("U", [21, 3, "u"]), change("U", [13, 2, "u"], [1, None, None]))
    drain.drain(spark, log.write(spark, tmp_path / "log"), Replica(spark, f"{tmp_path}/dst"), {"notes": NOTES}, 20, 1)
    assert live(spark, tmp_path, "notes", ["id"]) == [(12, 2, "second"), (13, 2, None), (21, 3, "first")]


KINDS = "element_at(array('signup', 'view', 'purchase', 'click', 'error', 'view', 'purchase', 'view'), cast(1 + pmod(hash(id, 3), 8) AS int))"
#: By name the event ids and users: a gap in the middle, each id for seven users, one row, none.
EVENTS = {
    "gap": (300, "id + 1000000 * (id DIV 150)", "pmod(hash(id), 4) * 1000 + pmod(hash(id, 1), 3)"),
    "repeated": (700, "id DIV 7", "pmod(hash(id DIV 7), 5) + 1500 * (id % 7)"),
    "one": (1, "id", "id"),
    "none": (0, "id", "id"),
}


@pytest.mark.parametrize("name", EVENTS)
def test_drain_log_equals_its_sql_on_other_ids(spark, tmp_path, name):
    rows, event, user = EVENTS[name]
    events = spark.range(rows).selectExpr(f"{event} AS event_id", f"{user} AS user_id", f"{KINDS} AS event_type", "id + 0.5D AS value")
    events.coalesce(1).write.parquet(f"{tmp_path}/parts")
    (found,) = (tmp_path / "parts").glob("*.parquet")
    found.rename(tmp_path / "events.parquet")
    assert spark_rows(QUERIES["drain_log"](spark, str(tmp_path))) == sql_rows(SQL["drain_log"], str(tmp_path))
