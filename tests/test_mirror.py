"""The scenarios: load, key changes, reload with overlapping replay, deletes with a scattered key."""

from decimal import Decimal

import pytest

from tidewell import config, model
from tidewell.functions import keys, lsn
from tidewell.operators import bind, diff, load, merge, normalize
from tidewell.plans import mirror
from tidewell.sources import pgoutput as pg
from tidewell.sources.tables import NoKey, Replica, check_key
from tidewell.streaming import drain

SIMPLE = model.Relation(11, "public", "simple", (model.Field("id", 23, True), model.Field("name", 25)))
COMPOSITE = model.Relation(12, "public", "composite", (model.Field("entity_id", 25, True), model.Field("value", 701), model.Field("category", 23, True)))
AFFILIATES = model.Relation(13, "public", "affiliates", (model.Field("entity_id", 25, True), model.Field("affiliated_id", 25, True), model.Field("pct_held", 701), model.Field("aff_type_code", 23, True)))


class Log:
    """Frames of a stream, one transaction at a time."""

    def __init__(self):
        self.rows, self.at = [], 0

    def frame(self, payload: bytes, lsn_end: int) -> None:
        self.rows.append((len(self.rows) + 1, self.at, lsn_end, bytearray(payload)))

    def transaction(self, commit: int, *payloads: bytes) -> None:
        self.frame(pg.encode_begin(commit), commit)
        for p in payloads:
            self.frame(p, commit)
        self.frame(b"C", commit)
        self.at = commit

    def write(self, spark, path) -> str:
        spark.createDataFrame(self.rows, drain.FRAMES).write.parquet(str(path))
        return str(path)


def run(tables, tmp_path, levels=None):
    spec = "".join(f"\n  - {{name: {t}, key: [{', '.join(k)}], level: {(levels or {}).get(t, 'primary_keys')}}}" for t, k in tables.items())
    return config.parse(f"mirror_name: m\nsource: {{path: {tmp_path}/src}}\ndestination: {{path: {tmp_path}/dst, database: d}}\ntables:{spec}\n")


def source(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/src/{name}.parquet")


def live(spark, tmp_path, table, key):
    rows = merge.current(Replica(spark, f"{tmp_path}/dst").read(table), key)
    return sorted(tuple(r) for r in rows.select(*[c for c in rows.columns if not c.startswith(model.META)]).collect())


def test_load_and_compare(spark, tmp_path):
    source(spark, tmp_path, "orders", [(100, 1, Decimal("1.50")), (100, 2, Decimal("2.50"))], "order_id int, line_num int, amount decimal(10,2)")
    log = Log()
    log.transaction(10)
    cfg = run({"orders": ["order_id", "line_num"]}, tmp_path)
    relation = model.Relation(21, "public", "orders", (model.Field("order_id", 23, True), model.Field("line_num", 23, True), model.Field("amount", 1700, modifier=(10 << 16 | 2) + 4)))
    done = mirror.mirror(spark, cfg, {"orders": relation}, log.write(spark, tmp_path / "log"))
    assert done["actions"] == {"orders": "CREATE + LOAD"} and done["loads"][0]["rows"] == 2
    assert [r.status for r in mirror.compare(spark, cfg)] == ["Match"]
    again = mirror.mirror(spark, cfg, {"orders": relation}, str(tmp_path / "log"), batch=2)
    assert again["actions"] == {"orders": "CDC"} and again["loads"] == []


def test_key_changes_leave_no_phantoms(spark, tmp_path):
    source(spark, tmp_path, "simple", [(1, "alpha"), (2, "bravo"), (3, "charlie")], "id int, name string")
    source(spark, tmp_path, "composite", [("E1", 10.0, 1), ("E2", 20.0, 2), ("E3", 30.0, 3)], "entity_id string, value double, category int")
    log = Log()
    up = lambda rel, old, new: pg.encode_change("U", rel, new, old)
    log.transaction(20, up(11, [1, None], [10, "alpha"]), up(11, [2, None], [20, "bravo-updated"]))
    log.transaction(30, up(12, ["E1", None, 1], ["E1", 10.0, 99]), up(12, ["E2", None, 2], ["E2-NEW", 20.0, 2]), up(12, ["E3", None, 3], ["E3-NEW", 30.0, 33]))
    cfg = run({"simple": ["id"], "composite": ["entity_id", "category"]}, tmp_path)
    done = mirror.mirror(spark, cfg, {"simple": SIMPLE, "composite": COMPOSITE}, log.write(spark, tmp_path / "log"))
    assert done["applied"] == {"simple": 4, "composite": 6}
    assert live(spark, tmp_path, "simple", ["id"]) == [(3, "charlie"), (10, "alpha"), (20, "bravo-updated")]
    assert live(spark, tmp_path, "composite", ["entity_id", "category"]) == [("E1", 10.0, 99), ("E2-NEW", 20.0, 2), ("E3-NEW", 30.0, 33)]


def test_replay_over_a_reload(spark, tmp_path):
    final = [("E1", 11.0, 1), ("E2", 22.0, 2), ("E3", 33.0, 3), ("E4", 40.0, 1), ("E5", 50.0, 2)]
    source(spark, tmp_path, "composite", final, "entity_id string, value double, category int")
    log = Log()
    steps = [("-", "E1", 1), ("-", "E2", 2), ("+", "E6", 3, 60), ("+", "E7", 1, 70), ("-", "E6", 3), ("-", "E7", 1), ("+", "E1", 1, 11), ("+", "E2", 2, 22), ("-", "E3", 3), ("+", "E3", 3, 33), ("+", "E8", 2, 80), ("-", "E8", 2)]
    for i, (what, name, category, *value) in enumerate(steps):
        payload = pg.encode_change("I", 12, [name, value[0], category]) if what == "+" else pg.encode_change("D", 12, old=[name, None, category])
        log.transaction(100 + i, payload)
    cfg = run({"composite": ["entity_id", "category"]}, tmp_path)
    path = log.write(spark, tmp_path / "log")
    for batch in (1, 2):
        mirror.mirror(spark, cfg, {"composite": COMPOSITE}, path, batch=batch)
        assert live(spark, tmp_path, "composite", ["entity_id", "category"]) == final
    changes = drain.changes_of(drain.with_transaction(pg.decode_frames(drain.frames(spark, path))), COMPOSITE)
    assert changes.groupBy("op").count().rdd.collectAsMap() == {"I": 6, "D": 6}


def test_deletes_by_a_scattered_key(spark, tmp_path):
    rows = [("ENT-A", "AFF-1", 50.0, 2), ("ENT-B", "AFF-1", 75.5, 3), ("ENT-C", "AFF-2", None, 2), ("ENT-D", "AFF-3", 100.0, 2), ("ENT-E", "AFF-1", 25.0, 3)]
    source(spark, tmp_path, "affiliates", rows, "entity_id string, affiliated_id string, pct_held double, aff_type_code int")
    log = Log()
    log.transaction(50, pg.encode_change("D", 13, old=["ENT-A", "AFF-1", None, 2]))
    log.transaction(60, pg.encode_change("D", 13, old=["ENT-B", "AFF-1", 3]))  # a sender that omits other columns
    log.transaction(70, pg.encode_change("D", 13, old=["ENT-C", "AFF-2", None, 2]))
    key = ["entity_id", "affiliated_id", "aff_type_code"]
    cfg = run({"affiliates": key}, tmp_path)
    path = log.write(spark, tmp_path / "log")
    replica = Replica(spark, f"{tmp_path}/dst")
    load.load_table(mirror.Source(spark, cfg.source), replica, "affiliates", 13)
    drain.drain(spark, path, replica, {"affiliates": AFFILIATES}, 65, 1)  # the third transaction commits later
    assert [r[0] for r in live(spark, tmp_path, "affiliates", key)] == ["ENT-C", "ENT-D", "ENT-E"]
    dead = [tuple(r)[:4] for r in replica.read("affiliates").where(f"{model.IS_DELETED} = 1").orderBy("entity_id").collect()]
    assert dead == [("ENT-A", "AFF-1", 0.0, 2), ("ENT-B", "AFF-1", 0.0, 3)]
    replica.rewrite("affiliates", lambda rows: merge.compact(rows, key, purge=True))
    assert replica.read("affiliates").count() == 3


def test_stale_relation_is_not_applied(spark, tmp_path):
    source(spark, tmp_path, "simple", [(1, "a")], "id int, name string")
    log = Log()
    log.transaction(20, pg.encode_change("I", 99, [2, "b"]))
    cfg = run({"simple": ["id"]}, tmp_path)
    load.load_table(mirror.Source(spark, cfg.source), Replica(spark, f"{tmp_path}/dst"), "simple", 11)
    stale = model.Relation(99, "public", "simple", SIMPLE.fields)
    assert drain.drain(spark, log.write(spark, tmp_path / "log"), Replica(spark, f"{tmp_path}/dst"), {"simple": stale}, 100, 1) == {}
    assert live(spark, tmp_path, "simple", ["id"]) == [(1, "a")]


def test_diff_flags_every_kind(spark):
    make = lambda rows: spark.createDataFrame(rows, "a int, b int")
    left, right = make([(1, 1), (2, 1), (3, 1), (3, 2), (4, 1)]), make([(1, 1), (3, 1), (4, 9), (5, 1)])
    found = {r["lead"]: r["status"] for r in diff.compare_keys(left, right, ["a", "b"]).collect()}
    assert found == {"1": "match", "2": "source_only", "3": "count_mismatch", "4": "hash_mismatch", "5": "dest_only"}
    result = diff.diff_table("t", "primary_keys", left, right, ["a", "b"], lambda: 0, lambda: 0)
    assert result.status == "Mismatch" and diff.exit_status([result]) == 1
    assert diff.run([("t", lambda: 1 / 0)], {"t": "x"})[0].status == "Error"
    for estimate, raw, strict, status in ((10, 8, False, "Match"), (10, 12, False, "Match"), (10, 13, False, "Mismatch"), (-1, 5, False, "Match"), (-1, 5, True, "Mismatch")):
        assert diff.diff_table("t", "metadata_count", left, right, ["a"], lambda e=estimate: e, lambda r=raw: r, strict).status == status


def test_keys(spark):
    row = spark.range(1).select(keys.hash32([keys.canonical(c, "int") for c in (keys.F.lit(1), keys.F.lit(2))])).first()
    assert row[0] == 3350746234
    with pytest.raises(keys.UnsupportedKeyType):
        keys.canonical(keys.F.lit(1.0), "double")
    with pytest.raises(NoKey):
        check_key(spark.createDataFrame([(1,), (1,)], "a int"), ["a"])
    with pytest.raises(NoKey):
        check_key(spark.range(1), [])


def test_positions():
    assert lsn.parse("3C7D/2F652920") == 66508363737376
    assert lsn.format(66508363737376) == "3C7D/2F652920"


def test_unknown_relation_stops_the_run(spark):
    changes = spark.createDataFrame([(5, 1)], "arrival_seq long, rel_id long")
    relations = spark.createDataFrame([(9, 1)], "arrival_seq long, rel_id long")
    with pytest.raises(Exception, match="no description of relation"):
        bind.bind_relations(changes, relations).collect()
    assert bind.bind_relations(changes, relations, strict=False).count() == 0


def test_several_identities_are_fatal(spark):
    with pytest.raises(ValueError):
        bind.expected_identity(spark.createDataFrame([(1,), (2,), (0,)], f"{model.REL_ID} long"))


def test_failed_loads_stop_the_run():
    def fail(*_):
        raise OSError("unreachable")

    with pytest.raises(load.LoadFailed, match="unreachable"):
        load.load_all([("t", 1, 1)], fail, 2)


def test_configuration():
    cfg = config.parse("mirror_name: x\ntables: [a, {name: b, level: exact_count}]")
    assert cfg.publication == cfg.slot == "tidewell_x" and cfg.source.port == 5432 and cfg.destination.port == 8123
    assert [t.level for t in cfg.tables] == ["metadata_count", "exact_count"] and cfg.settings.batch_size == 1000
    with pytest.raises(ValueError):
        config.parse("tables: []")


def test_replaying_a_prefix_changes_nothing(spark):
    log = spark.createDataFrame([(i % 5, i, i % 7 == 0) for i in range(60)], "k int, v int, gone boolean").withColumn("d", keys.F.col("gone").cast("int"))
    want = sorted(map(tuple, merge.current(log, ["k"], ["v"], "d").collect()))
    for cut in (1, 17, 60):
        again = log.unionAll(log.where(f"v < {cut}"))
        assert sorted(map(tuple, merge.current(again, ["k"], ["v"], "d").collect())) == want


def test_counters_total(spark):
    rows = spark.createDataFrame([("t", "U", True), ("t", "I", False)], "table string, op string, moved boolean")
    rows = rows.withColumn("old", keys.F.when(keys.F.col("moved"), keys.F.lit(1)))
    total = normalize.counters(rows).where("table IS NULL").first()
    assert (total["inserts"], total["updates"], total["deletes"], total["applied"]) == (1, 1, 1, 3)


def test_transactions_across_blocks(spark, tmp_path, monkeypatch):
    log = Log()
    log.frame(pg.encode_relation(SIMPLE), 1)
    for commit in (10, 20, 30):
        log.transaction(commit, *[pg.encode_change("I", 11, [commit + i, "x"]) for i in range(7)])
    messages = pg.decode_frames(drain.frames(spark, log.write(spark, tmp_path / "log")))
    for size in (1, 3, 100):
        monkeypatch.setattr(drain, "ARRIVAL_BLOCK", size)
        got = sorted((r["new"]["id"], r["commit_lsn"], r["ordinal"]) for r in drain.changes_of(drain.with_transaction(messages), SIMPLE).collect())
        assert got == [(c + i, c, i + 1) for c in (10, 20, 30) for i in range(7)]
    bound = bind.bind_relations(messages.where("kind = 'I'").select("rel_id", "arrival_seq"), bind.relations_of(messages)).collect()
    assert len(bound) == 21 and {(r["namespace"], r["name"], r["identity"]) for r in bound} == {("public", "simple", "d")}
