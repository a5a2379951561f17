"""The mirror applies all that the log says, or stops."""

import struct
from dataclasses import replace
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_mirror import Log, live, run, source

from tidewell import model
from tidewell.operators import load, merge
from tidewell.plans import mirror, planner
from tidewell.sources import pgoutput as pg
from tidewell.sources.tables import Replica
from tidewell.streaming import drain

NOTES = model.Relation(31, "public", "notes", (model.Field("id", 23, True), model.Field("rank", 23), model.Field("body", 25)))


def change(kind, new=None, old=None, rel=31, **more):
    return pg.encode_change(kind, rel, new, old, **more)


def drained(spark, tmp_path, log, target, batch=1, after=0, fresh=frozenset(), relation=NOTES, name="log"):
    replica = Replica(spark, f"{tmp_path}/dst")
    path = log.write(spark, tmp_path / f"{name}{batch}")
    drain.drain(spark, path, replica, {"notes": relation}, target, batch, after, fresh)
    return live(spark, tmp_path, "notes", ["id"])


def loaded(spark, tmp_path, rows, schema="id int, rank int, body string"):
    source(spark, tmp_path, "notes", rows, schema)
    cfg = run({"notes": ["id"]}, tmp_path)
    load.load_table(mirror.Source(spark, cfg.source), Replica(spark, f"{tmp_path}/dst"), "notes", 31)
    return cfg


def test_values_that_an_update_did_not_send_are_kept(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one"), (2, 2, "two"), (3, 3, None), (4, 4, "four"), (5, 5, "five"), (7, 7, "seven")])
    log = Log()
    log.transaction(10, change("U", [1, 11, "u"]), change("U", [3, 33, "u"]), change("U", [5, 55, "sent"]), change("U", [5, 56, "u"]))
    log.transaction(20, change("U", [20, 2, "u"], [2, None, None]), change("U", [21, 2, "u"], [20, None, None]), change("U", [22, 2, "u"], [21, None, None]), change("U", [23, 2, "u"], [22, None, None]))
    log.transaction(30, change("D", old=[4, None, None]), change("I", [4, 40, None]), change("U", [4, 41, "u"]))
    log.transaction(40, change("U", [7, 70, "u"], [7, 7, "whole old row"], key_kind="O"))
    # The key 1 passes to another row, then the first one is renamed into 2.
    log.transaction(50, change("U", [2, 12, "u"], [1, None, None]), change("U", [1, 51, "u"], [5, None, None]))
    want = [(1, 51, "sent"), (2, 12, "one"), (3, 33, None), (4, 41, None), (7, 70, "whole old row"), (23, 2, "two")]
    assert drained(spark, tmp_path, log, 50) == want
    rows = Replica(spark, f"{tmp_path}/dst").read("notes")
    assert rows.where(F.size(model.UNSENT) > 0).count() == 0
    log.transaction(60, change("U", [23, 3, "u"]), change("U", [8, 8, "u"], [1, None, None]))
    later = [(2, 12, "one"), (3, 33, None), (4, 41, None), (7, 70, "whole old row"), (8, 8, "sent"), (23, 3, "two")]
    for _ in range(2):
        assert drained(spark, tmp_path, log, 60, 2, 50, name=f"again{_}") == later
    assert drained(spark, tmp_path, log, 60, 3, 0) == later


def test_an_overlapping_snapshot_gives_unsent_values(spark, tmp_path):
    """The log moves row 1 to 2 and reuses 1, and the snapshot was taken after that."""
    source(spark, tmp_path, "notes", [(1, 9, "new"), (2, 2, "old")], "id int, rank int, body string")
    log = Log()
    log.transaction(10, change("U", [1, 2, "u"]), change("U", [2, 2, "u"], [1, None, None]), change("I", [1, 9, "new"]))
    log.transaction(20, change("U", [3, 3, "u"]), change("D", old=[3, None, None]))
    cfg = run({"notes": ["id"]}, tmp_path)
    mirror.mirror(spark, cfg, {"notes": NOTES}, log.write(spark, tmp_path / "log"))
    assert live(spark, tmp_path, "notes", ["id"]) == [(1, 9, "new"), (2, 2, "old")]


def test_a_value_that_is_not_known_stays_marked(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one")])
    log = Log()
    log.transaction(10, change("U", [9, 9, "u"]))
    assert drained(spark, tmp_path, log, 10) == [(1, 1, "one"), (9, 9, None)]
    marked = Replica(spark, f"{tmp_path}/dst").read("notes").where(F.size(model.UNSENT) > 0).select("id", model.UNSENT).collect()
    assert [tuple(r) for r in marked] == [(9, ["body"])]


def test_malformed_messages_stop_the_drain(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one")])
    log = Log()
    log.transaction(10, change("U", [1, 2, "two"]))
    log.transaction(20, change("U", [1, 3, "three"])[:-2], b"D\0\0\0\x1fX")
    with pytest.raises(drain.FaultyLog, match="2 malformed messages"):
        drained(spark, tmp_path, log, 20)
    assert live(spark, tmp_path, "notes", ["id"]) == [(1, 1, "one")]
    assert drained(spark, tmp_path, log, 10, 2) == [(1, 2, "two")]
    log.frame(pg.encode_begin(30)[:5], 30)
    with pytest.raises(drain.FaultyLog, match="1 malformed messages"):
        drained(spark, tmp_path, log, 30, 3, 20)


def test_a_tombstone_ends_what_is_carried(spark):
    rows = spark.createDataFrame([(1, 1, "a", False, 0), (1, 2, "", True, 1), (1, 3, None, True, 0), (1, 4, "b", False, 0), (1, 5, None, True, 0)], "k int, v int, x string, unsent boolean, gone int")
    got = merge.carry_forward(rows, ["k"], ["v"], {"x": "unsent"}, "gone").orderBy("v").collect()
    assert [r["x"] for r in got] == ["a", "", None, "b", "b"]


def test_binary_cells_are_applied(spark, tmp_path):
    kinds = {"id": 20, "small": 21, "whole": 23, "flag": 16, "f4": 700, "f8": 701, "day": 1082, "at": 1114, "zone": 1184, "price": 1700, "uid": 2950, "body": 25}
    relation = model.Relation(31, "public", "notes", tuple(model.Field(n, o, n in ("id", "body"), (10 << 16 | 2) + 4 if o == 1700 else -1) for n, o in kinds.items()))
    schema = ", ".join(f"`{f.name}` {model.spark_type(f.oid, f.modifier)}" for f in relation.fields)
    source(spark, tmp_path, "notes", [], schema)
    cfg = run({"notes": ["id", "body"]}, tmp_path)
    load.load_table(mirror.Source(spark, cfg.source), Replica(spark, f"{tmp_path}/dst"), "notes", 31)
    b = lambda form, x: ("b", struct.pack(">" + form, x))
    uid = "00112233-4455-6677-8899-aabbccddeeff"
    cells = lambda i: [b("q", i), b("h", -2), b("i", -3), b("?", True), b("f", 0.1), b("d", -1e-300), b("i", -1), b("q", -1), b("q", 0), ("b", bytes.fromhex("0002000000000002000c1388")), ("b", bytes.fromhex(uid.replace("-", ""))), ("b", "naïve".encode())]
    log = Log()
    log.transaction(10, change("I", cells(2**40)), change("I", cells(-5)), change("I", cells(6)), change("I", [7, *cells(7)[1:]]))
    log.transaction(20, change("D", old=[b("q", 6), *[None] * 10, ("b", "naïve".encode())]), change("D", old=[b("q", -5), ("b", "naïve".encode())]))
    log.transaction(30, change("U", [b("q", 7), b("h", 1), *[None] * 9, ("b", "naïve".encode())]), change("I", [b("q", 8), None, None, None, None, b("d", float("inf")), b("i", 2**31 - 1), b("q", 2**63 - 1), None, ("b", bytes.fromhex("00000000c0000000")), None, ("b", b"")]))
    drain.drain(spark, log.write(spark, tmp_path / "log"), Replica(spark, f"{tmp_path}/dst"), {"notes": relation}, 30, 1)
    got = live(spark, tmp_path, "notes", ["id", "body"])
    rest = (-2, -3, True, struct.unpack(">f", struct.pack(">f", 0.1))[0], -1e-300, date(1999, 12, 31), datetime(1999, 12, 31, 23, 59, 59, 999999), datetime(2000, 1, 1, tzinfo=timezone.utc).astimezone().replace(tzinfo=None), Decimal("12.50"), uid, "naïve")
    assert got == [(7, 1, *[None] * 9, "naïve"), (8, None, None, None, None, float("inf"), None, None, None, None, None, ""), (2**40, *rest)]


def test_each_schema_version_is_read_by_its_own_fields(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one"), (2, 2, "two"), (3, 3, "three")])
    fields = dict(zip(("id", "rank", "body"), NOTES.fields, strict=True))
    described = lambda *f: pg.encode_relation(model.Relation(31, "public", "notes", f))
    log = Log()
    log.transaction(10, described(*NOTES.fields), change("U", [1, 10, "uno"]))
    log.transaction(20, described(fields["id"], fields["body"]), change("U", [2, "dos"]), change("U", [22, "u"], [2, None]))
    log.transaction(30, described(fields["body"], fields["id"], model.Field("rank", 20), model.Field("extra", 701)), change("I", ["four", 4, 44, 4.5]), change("U", [("b", b"drei"), 3, ("b", struct.pack(">q", 33)), "u"]))
    assert drained(spark, tmp_path, log, 30) == [(1, 10, "uno", None), (3, 33, "drei", None), (4, 44, "four", 4.5), (22, 2, "dos", None)]
    log.transaction(40, described(fields["id"], fields["body"]), change("I", [5, "five"]))
    assert drained(spark, tmp_path, log, 40, 2, 30)[-2:] == [(5, None, "five", None), (22, 2, "dos", None)]


def test_a_change_without_description_stops_the_drain(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one")])
    log = Log()
    log.transaction(10, change("U", [1, 2, "two"]), change("I", [1], rel=77))
    log.transaction(20, pg.encode_relation(model.Relation(77, "public", "other", (model.Field("id", 23, True),))), change("I", [2], rel=77))
    with pytest.raises(Exception, match="no description of relation 77"):
        drained(spark, tmp_path, log, 20)
    assert live(spark, tmp_path, "notes", ["id"]) == [(1, 1, "one")]
    assert drained(spark, tmp_path, log, 20, 2, 10) == [(1, 1, "one")]


def test_runs_go_on_where_the_last_one_ended(spark, tmp_path):
    """The second run gets a log without what the first one has confirmed, relations included, and keeps the first one's rows."""
    source(spark, tmp_path, "notes", [(1, 1, "one"), (2, 2, "two")], "id int, rank int, body string")
    cfg = run({"notes": ["id"]}, tmp_path)
    turned = model.Relation(31, "public", "notes", (NOTES.fields[2], NOTES.fields[0], NOTES.fields[1]))
    log = Log()
    log.transaction(10, pg.encode_relation(turned), change("U", ["uno", 1, 10]))
    first = mirror.mirror(spark, cfg, {"notes": NOTES}, log.write(spark, tmp_path / "log1"))
    assert (first["batch"], first["slot"]["exists"], first["applied"]) == (1, False, {"notes": 1})
    trimmed = Log()
    trimmed.at = 10
    trimmed.rows = [None] * len(log.rows)
    trimmed.transaction(20, change("U", ["u", 1, 11]), change("I", ["three", 3, 3]))
    trimmed.rows = [r for r in trimmed.rows if r]
    path = trimmed.write(spark, tmp_path / "log2")
    second = mirror.mirror(spark, cfg, {"notes": NOTES}, path)
    want = [(1, 11, "uno"), (2, 2, "two"), (3, 3, "three")]
    assert live(spark, tmp_path, "notes", ["id"]) == want
    assert second["batch"] == 2 and second["slot"] == {"exists": True, "confirmed": "0/A", "lag": "10 bytes"}
    again = mirror.mirror(spark, cfg, {"notes": NOTES}, path)
    assert again["applied"] == {} and live(spark, tmp_path, "notes", ["id"]) == want


def test_a_run_reports_what_it_leaves_out(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one")])
    other = model.Relation(40, "public", "other", (model.Field("id", 23, True),))
    log = Log()
    log.transaction(10, pg.encode_relation(other), pg.encode_relation(model.Relation(31, "public", "notes", NOTES.fields, "n")), change("I", [5], rel=40), change("I", [2, 2, "two"]))
    log.transaction(20, pg.encode_relation(model.Relation(99, "public", "notes", NOTES.fields)), change("I", [3, 3, "of a later table"], rel=99), b"T" + struct.pack(">IBI", 1, 0, 31))
    log.transaction(30, change("U", [9, 2, "two"], [2, None, None]), change("D", old=[1, None, None]))
    report = {}
    drain.drain(spark, log.write(spark, tmp_path / "log"), Replica(spark, f"{tmp_path}/dst"), {"notes": NOTES}, 30, 1, report=report)
    assert live(spark, tmp_path, "notes", ["id"]) == [(9, 2, "two")]
    assert report["skipped"] == [{"namespace": "public", "name": "other", "changes": 1}]
    assert report["stale"] == [{"namespace": "public", "name": "notes", "rel_id": 99, "changes": 1}]
    assert report["lost"] == ["notes"] and report["truncated"] == [{"rel_id": 31, "times": 1}] and report["mismatched"] == []
    assert report["changes"] == [{"table": "notes", "inserts": 1, "updates": 1, "deletes": 2, "applied": 4}]


def test_tables_that_are_added_again_are_loaded_again(spark, tmp_path):
    source(spark, tmp_path, "notes", [(1, 1, "one")], "id int, rank int, body string")
    source(spark, tmp_path, "more", [(1,)], "id int")
    more = model.Relation(32, "public", "more", (model.Field("id", 23, True),))
    both, one = run({"notes": ["id"], "more": ["id"]}, tmp_path), run({"more": ["id"]}, tmp_path)
    log = Log()
    log.transaction(10)
    path = log.write(spark, tmp_path / "log")
    relations = {"notes": NOTES, "more": more}
    assert mirror.mirror(spark, both, relations, path)["actions"] == {"more": "CREATE + LOAD", "notes": "CREATE + LOAD"}
    assert mirror.mirror(spark, one, {"more": more}, path)["actions"] == {"more": "CDC"}
    source(spark, tmp_path, "notes", [(1, 1, "one"), (2, 2, "missed meanwhile")], "id int, rank int, body string")
    assert mirror.mirror(spark, both, relations, path)["actions"]["notes"] == "RELOAD (re-added)"
    assert live(spark, tmp_path, "notes", ["id"]) == [(1, 1, "one"), (2, 2, "missed meanwhile")]


def test_an_empty_replica_is_loaded_if_the_source_has_rows(spark):
    rows = [("a", True, False, -1, None, 0, False, True), ("b", True, False, -1, None, 0, False, False)]
    stats = spark.createDataFrame(rows, "table string, table_exists boolean, has_rows boolean, est_rows long, max_commit_lsn long, raw_rows long, readded boolean, source_has_rows boolean")
    assert [r["action"] for r in planner.plan(stats).orderBy("table").collect()] == ["LOAD", "SKIP (empty)"]


def test_a_rewrite_that_ends_early_leaves_the_table(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one"), (2, 2, "two")])
    replica = Replica(spark, f"{tmp_path}/dst")

    def broken(rows):
        return rows.withColumn("id", F.raise_error(F.lit("stop")).cast("int"))

    with pytest.raises(Exception, match="stop"):
        replica.rewrite("notes", broken)
    assert [r[0] for r in live(spark, tmp_path, "notes", ["id"])] == [1, 2]
    replica.rewrite("notes", lambda rows: rows.where("id = 2"))
    assert [r[0] for r in live(spark, tmp_path, "notes", ["id"])] == [2]
    replica.truncate("notes")
    assert replica.read("notes").count() == 0


def test_a_database_of_views_shows_current_rows(spark, tmp_path):
    loaded(spark, tmp_path, [(1, 1, "one"), (2, 2, "two")])
    log = Log()
    log.transaction(10, change("U", [1, 10, "uno"]), change("D", old=[2, None, None]))
    drained(spark, tmp_path, log, 10)
    Replica(spark, f"{tmp_path}/dst").register("mirrored", {"notes": ["id"]})
    assert [tuple(r) for r in spark.sql("SELECT * FROM mirrored.notes").collect()] == [(1, 10, "uno")]
    spark.sql("DROP DATABASE mirrored CASCADE")


def test_following_a_log(spark, tmp_path):
    source(spark, tmp_path, "notes", [(1, 1, "one")], "id int, rank int, body string")
    cfg = run({"notes": ["id"]}, tmp_path)
    log = Log()
    log.transaction(10, change("U", [1, 10, "uno"]))
    path = log.write(spark, tmp_path / "log")
    mirror.follow(spark, replace(cfg, settings=replace(cfg.settings, flush_interval_secs=1, timeout_secs=30)), {"notes": NOTES}, path, f"{tmp_path}/state")
    assert live(spark, tmp_path, "notes", ["id"]) == [(1, 10, "uno")]
