"""Named queries over the engine's operators on the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell import model, store
from tidewell.config import Endpoint
from tidewell.functions import formats, keys, lsn
from tidewell.operators import bind, diff, merge, normalize
from tidewell.plans import planner
from tidewell.sources import lookups, pgoutput
from tidewell.sources.tables import Replica, Source
from tidewell.streaming import drain
from tidewell.streaming.position import Progress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query of its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change log: key user_id, version event_id, errors are tombstones."""
    return _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", (F.col("event_type") == "error").cast("int").alias("is_deleted"))


EVENT_LOG = "(SELECT user_id, event_id, event_type, value, (event_type = 'error')::INT AS is_deleted FROM events)"
LAST_EVENT = f"SELECT * FROM {EVENT_LOG} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"


@query(f"SELECT * FROM ({LAST_EVENT}) WHERE is_deleted = 0")
def lww_current_state(spark, sf_dir):
    return merge.current(_event_log(spark, sf_dir), ["user_id"], ["event_id"], "is_deleted")


@query(LAST_EVENT)
def lww_include_tombstones(spark, sf_dir):
    return merge.latest(_event_log(spark, sf_dir), ["user_id"], ["event_id"])


@query(f"SELECT user_id, event_type, value FROM ({LAST_EVENT}) WHERE is_deleted = 0")
def lww_few_columns(spark, sf_dir):
    return merge.current_columns(_event_log(spark, sf_dir), ["user_id"], ["event_type", "value"], F.col("event_id"), "is_deleted")


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_VERSION = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LAST_LINE = f"SELECT {', '.join(LINE_KEY + LINE_VERSION)} FROM lineitem QUALIFY row_number() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(v + ' DESC' for v in LINE_VERSION)}) = 1"


@query(LAST_LINE)
def lww_composite_key(spark, sf_dir):
    return merge.latest(_table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_VERSION), LINE_KEY, LINE_VERSION)


@query("SELECT (SELECT count(*) FROM lineitem) AS raw_rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS current_rows")
def raw_vs_current_count(spark, sf_dir):
    return merge.row_counts(_table(spark, sf_dir, "lineitem"), LINE_KEY)


def _event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as row changes: signup inserts, error deletes by key, purchase moves the key up by 1000, others update."""
    e = _table(spark, sf_dir, "events")
    row = lambda user: F.struct(user.alias("user_id"), F.col("event_type"), F.col("value"))
    kind = F.col("event_type")
    op = F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")
    return e.select(
        op.alias("op"),
        F.when(kind.isin("error", "purchase"), row(F.col("user_id"))).alias("old"),
        F.when(kind != "error", row(F.when(kind == "purchase", F.col("user_id") + 1000).otherwise(F.col("user_id")))).alias("new"),
        F.lit("K").alias("key_kind"),
        F.col("event_id").alias("commit_lsn"),
        F.lit(1).alias("ordinal"),
        F.lit(7).alias("rel_id"),
        F.lit("events").alias("table"),
    )


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "event_type", "value", F.col(model.IS_DELETED).alias("is_deleted"), F.col(f"{model.VERSION}.commit_lsn").alias("commit_lsn"), F.col(f"{model.VERSION}.part").alias("part"))


VERSIONED = """
    (SELECT user_id, '' AS event_type, 0.0::DOUBLE AS value, 1 AS is_deleted, event_id AS commit_lsn, 0 AS part FROM events WHERE event_type IN ('error', 'purchase')
     UNION ALL
     SELECT CASE WHEN event_type = 'purchase' THEN user_id + 1000 ELSE user_id END, event_type, value, 0, event_id, 1 FROM events WHERE event_type != 'error')"""


@query(f"SELECT * FROM {VERSIONED}")
def apply_insert_update_delete(spark, sf_dir):
    return _flat(normalize.to_versions(_event_changes(spark, sf_dir), ["user_id"]))


@query(f"SELECT user_id, event_type, value FROM {VERSIONED} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY commit_lsn DESC, part DESC) = 1 AND is_deleted = 0")
def pk_update_fanout(spark, sf_dir):
    rows = normalize.to_versions(_event_changes(spark, sf_dir), ["user_id"])
    return merge.current(rows, ["user_id"]).select("user_id", "event_type", "value")


@query(f"SELECT user_id, event_type, value, commit_lsn FROM {VERSIONED} WHERE is_deleted = 1")
def tombstone_defaults(spark, sf_dir):
    rows = _flat(normalize.to_versions(_event_changes(spark, sf_dir), ["user_id"]))
    return rows.where("is_deleted = 1").select("user_id", "event_type", "value", "commit_lsn")


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a subset of orders: keys divisible by 10 are deleted, by 7 repriced."""
    o = _table(spark, sf_dir, "orders").where("o_orderkey % 10 = 0 OR o_orderkey % 7 = 0")
    gone = F.col("o_orderkey") % 10 == 0
    row = lambda price: F.struct("o_orderkey", price.alias("o_totalprice"))
    return o.select(F.when(gone, "D").otherwise("U").alias("op"), F.when(gone, row(F.col("o_totalprice"))).alias("old"), F.when(~gone, row(F.col("o_totalprice") * 2)).alias("new"), F.lit("K").alias("key_kind"), F.lit(100).alias("commit_lsn"), F.col("o_orderkey").alias("ordinal"), F.lit(9).alias("rel_id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 != 0")
def snapshot_plus_cdc(spark, sf_dir):
    snapshot = normalize.snapshot_rows(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 9)
    changes = normalize.to_versions(_order_changes(spark, sf_dir), ["o_orderkey"])
    return merge.current(snapshot.unionByName(changes), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(f"SELECT * FROM ({LAST_EVENT}) WHERE is_deleted = 0")
def replay_idempotent(spark, sf_dir):
    log = _event_log(spark, sf_dir)
    return merge.current(log.unionByName(log), ["user_id"], ["event_id"], "is_deleted")


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events of three tables, each under an old and a new relation id."""
    e = _table(spark, sf_dir, "events").withColumn("name", F.concat(F.lit("t"), (F.col("user_id") % 3).cast("string")))
    rel = F.when(F.col("event_id") % 2 == 0, 100 + F.col("user_id") % 3).otherwise(200 + F.col("user_id") % 3)
    return e.select("event_id", F.lit("public").alias("namespace"), "name", rel.alias("rel_id"))


IDENTIFIED = "(SELECT event_id, 'public' AS namespace, 't' || (user_id % 3) AS name, CASE WHEN event_id % 2 = 0 THEN 100 + user_id % 3 ELSE 200 + user_id % 3 END AS rel_id FROM events)"


@query(f"SELECT * FROM {IDENTIFIED} WHERE NOT (name = 't0' AND rel_id != 100) AND NOT (name = 't1' AND rel_id != 201)")
def stale_identity_filter(spark, sf_dir):
    expected = spark.createDataFrame([("public", "t0", 100), ("public", "t1", 201), ("public", "t2", 0)], "namespace string, name string, expected_id long")
    return bind.drop_stale(_identified(spark, sf_dir), expected).select("event_id", "namespace", "name", "rel_id")


@query(f"SELECT name, count(DISTINCT rel_id) AS ids, min(rel_id) AS first_id FROM {IDENTIFIED} GROUP BY name")
def expected_identity(spark, sf_dir):
    return bind.identities(_identified(spark, sf_dir), "rel_id", ["name"])


@query(f"SELECT * FROM {IDENTIFIED} WHERE name IN ('t0', 't2')")
def route_configured_tables(spark, sf_dir):
    tables = spark.createDataFrame([("public", "t0"), ("public", "t2"), ("other", "t1")], "namespace string, name string")
    return bind.route(_identified(spark, sf_dir), tables).select("event_id", "namespace", "name", "rel_id")


@query(f"SELECT namespace, name, count(*) AS changes FROM {IDENTIFIED} WHERE name = 't1' GROUP BY ALL")
def skipped_tables_report(spark, sf_dir):
    tables = spark.createDataFrame([("public", "t0"), ("public", "t2"), ("other", "t1")], "namespace string, name string")
    return bind.skipped(_identified(spark, sf_dir), tables)


@query("""
    WITH relations AS (SELECT i AS rel_id, 500 * v AS seq, v AS schema_version FROM range(0, 3) a(i), range(0, 12) b(v)),
    changes AS (SELECT event_id, event_id AS seq, user_id % 3 AS rel_id FROM events)
    SELECT event_id, rel_id, schema_version FROM changes ASOF JOIN relations USING (rel_id, seq)""")
def bind_relation_asof(spark, sf_dir):
    versions = spark.range(12).select((F.col("id") * 500).alias("arrival_seq"), F.col("id").alias("schema_version"))
    relations = versions.withColumn("rel_id", F.explode(F.array(*[F.lit(i).cast("long") for i in range(3)])))
    changes = _table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("arrival_seq"), (F.col("user_id") % 3).alias("rel_id"))
    return bind.bind_relations(changes, relations).select("event_id", "rel_id", "schema_version")


@query("SELECT 'public' AS namespace, n AS name, l AS identity, n = 'c' AS changes_lost FROM (VALUES ('a', 'default'), ('b', 'full'), ('c', 'nothing'), ('d', 'index'), ('e', 'unknown')) t(n, l)")
def replica_identity_audit(spark, sf_dir):
    rows = spark.createDataFrame([("public", n, i) for n, i in zip("abcde", "dfnix", strict=True)], "namespace string, name string, identity string")
    return bind.audit_identities(rows)


@query("SELECT event_id, event_id * 16 AS commit_lsn, user_id FROM events WHERE event_id * 16 > 8000 AND event_id * 16 <= 64000")
def lsn_bounded_drain(spark, sf_dir):
    changes = _table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 16).alias("commit_lsn"), "user_id")
    return drain.bounded(changes, 64000, 8000)


@query("SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) // 1000)::BIGINT AS flush FROM events")
def batch_assignment(spark, sf_dir):
    return drain.flush_batches(_table(spark, sf_dir, "events").select("event_id"), "event_id", 1000)


CHANGE_COUNTS = """count(*) FILTER (event_type = 'signup') AS inserts, count(*) FILTER (event_type NOT IN ('signup', 'error')) AS updates,
    count(*) FILTER (event_type IN ('error', 'purchase')) AS deletes, count(*) + count(*) FILTER (event_type = 'purchase') AS applied"""


@query(f"SELECT 'events' AS \"table\", {CHANGE_COUNTS} FROM events UNION ALL SELECT NULL, {CHANGE_COUNTS} FROM events")
def change_counters(spark, sf_dir):
    return normalize.counters(_event_changes(spark, sf_dir))


@query(f"""SELECT 't' || user_id % 5 AS "table", {CHANGE_COUNTS} FROM events GROUP BY 1 HAVING count(*) > 0""")
def change_summary(spark, sf_dir):
    e = _event_changes(spark, sf_dir).withColumn("table", F.concat(F.lit("t"), (F.coalesce("new", "old")["user_id"] % 5).cast("string")))
    return normalize.summary(normalize.counters(e))


@query("""
    SELECT event_id, reached, CASE WHEN target > 5000 AND reached > 5000 THEN least((reached - 5000) / (target - 5000) * 100, 100.0) ELSE 0.0 END AS percent,
    CASE WHEN sent > processed AND event_id > 0 THEN 'flushing' WHEN reached > processed THEN 'decoding' ELSE '' END AS waits_for
    FROM (SELECT *, greatest(nullif(sent, 0), nullif(ended, 0), nullif(processed, 0)) AS reached FROM
        (SELECT event_id, event_id * 16 AS processed, event_id % 3 * event_id * 16 AS sent, event_id % 4 * event_id * 10 AS ended, (SELECT max(event_id) * 16 FROM events) AS target FROM events))""")
def cdc_progress(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("event_id")
    rows = e.withColumns({"processed": F.col("event_id") * 16, "sent": F.col("event_id") % 3 * F.col("event_id") * 16, "ended": F.col("event_id") % 4 * F.col("event_id") * 10})
    target = F.lit(e.agg(F.max("event_id")).first()[0] * 16)
    rows = rows.withColumn("reached", lsn.furthest(F.col("sent"), F.col("ended"), F.col("processed")))
    return rows.select("event_id", "reached", lsn.cdc_percent(F.col("reached"), F.lit(5000), target).alias("percent"), lsn.cdc_bottleneck(F.col("processed"), F.col("sent"), F.col("reached"), F.col("event_id")).alias("waits_for"))


def _perturbed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """orders, and a replica of it with missing, moved and surplus rows."""
    o = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    kept = o.where("o_orderkey % 97 != 0 AND o_custkey % 50 != 1")
    moved = kept.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 101 == 0, F.col("o_orderkey") + 1_000_000).otherwise(F.col("o_orderkey")))
    extra = o.where("o_orderkey % 499 = 0").withColumn("o_custkey", F.col("o_custkey") + 100_000)
    return o, moved.unionAll(extra)


COMPARED = """
    WITH src AS (SELECT o_custkey, o_orderkey FROM orders),
    rep AS (SELECT o_custkey, CASE WHEN o_orderkey % 101 = 0 THEN o_orderkey + 1000000 ELSE o_orderkey END AS o_orderkey FROM src WHERE o_orderkey % 97 != 0 AND o_custkey % 50 != 1
        UNION ALL SELECT o_custkey + 100000, o_orderkey FROM src WHERE o_orderkey % 499 = 0),
    a AS (SELECT o_custkey::VARCHAR AS lead, count(*) AS n, sum(('0x' || substr(md5(o_custkey || '|' || o_orderkey), 25, 8))::BIGINT) AS h FROM src GROUP BY 1),
    b AS (SELECT o_custkey::VARCHAR AS lead, count(*) AS n, sum(('0x' || substr(md5(o_custkey || '|' || o_orderkey), 25, 8))::BIGINT) AS h FROM rep GROUP BY 1),
    compared AS (SELECT lead, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS replica_rows,
        CASE WHEN b.n IS NULL THEN 'source_only' WHEN a.n IS NULL THEN 'dest_only' WHEN a.n != b.n THEN 'count_mismatch' WHEN a.h != b.h THEN 'hash_mismatch' ELSE 'match' END AS status
        FROM a FULL JOIN b USING (lead))"""


@query(f"{COMPARED} SELECT * FROM compared")
def diff_primary_keys(spark, sf_dir):
    return diff.compare_keys(*_perturbed(spark, sf_dir), ["o_custkey", "o_orderkey"])


@query(f"""{COMPARED} SELECT {', '.join(f"count(*) FILTER (status = '{s}') AS {s}_groups" for s in ('match', 'source_only', 'dest_only', 'count_mismatch', 'hash_mismatch'))},
    coalesce(sum(source_rows) FILTER (status = 'source_only'), 0)::BIGINT AS source_only_rows, coalesce(sum(replica_rows) FILTER (status = 'dest_only'), 0)::BIGINT AS dest_only_rows FROM compared""")
def diff_summary(spark, sf_dir):
    return diff.summarise(diff.compare_keys(*_perturbed(spark, sf_dir), ["o_custkey", "o_orderkey"]))


@query(f"""{COMPARED} SELECT status, (row_number() OVER w)::INT AS place, lead, source_rows, replica_rows, greatest(count(*) OVER (PARTITION BY status) - 20, 0) AS more
    FROM compared WHERE status != 'match' WINDOW w AS (PARTITION BY status ORDER BY lead) QUALIFY place <= 20""")
def diff_top_mismatches(spark, sf_dir):
    return diff.top_mismatches(diff.compare_keys(*_perturbed(spark, sf_dir), ["o_custkey", "o_orderkey"]))


@query(f"{COMPARED} SELECT s, r, s = r AS matches FROM (SELECT count(*) AS s FROM src), (SELECT count(*) AS r FROM rep)")
def diff_exact_count(spark, sf_dir):
    return diff.exact_counts(*_perturbed(spark, sf_dir))


@query(f"{COMPARED} SELECT s, r, CASE WHEN s > 0 THEN r / s ELSE 1.0 END AS ratio, CASE WHEN s > 0 THEN r / s BETWEEN 0.8 AND 1.2 ELSE true END AS matches FROM (SELECT count(*) AS s FROM src), (SELECT count(*) AS r FROM rep)")
def diff_metadata_count(spark, sf_dir):
    counts = diff_exact_count(spark, sf_dir)
    return counts.select("s", "r", diff.count_ratio(F.col("s"), F.col("r")).alias("ratio"), diff.counts_match(F.col("s"), F.col("r")).alias("matches"))


@query("""
    SELECT o_orderkey, o_orderkey::VARCHAR AS k_long, o_orderpriority AS k_text, strftime(least(o_orderdate::DATE, DATE '2299-12-31'), '%Y-%m-%d') AS k_date,
    strftime(least(o_orderdate, TIMESTAMP '2299-12-31 00:00:00'), '%Y-%m-%d %H:%M:%S') AS k_time, trunc(o_totalprice::DECIMAL(18,2))::BIGINT::VARCHAR AS k_numeric,
    CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE '0' END AS k_bool FROM orders""")
def canonical_key_text(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    text = lambda c, kind, name: keys.canonical(c.cast(kind), kind).alias(name)
    return o.select("o_orderkey", text(F.col("o_orderkey"), "bigint", "k_long"), text(F.col("o_orderpriority"), "string", "k_text"), text(F.col("o_orderdate"), "date", "k_date"), text(F.col("o_orderdate"), "timestamp_ntz", "k_time"), text(F.col("o_totalprice"), "decimal(18,2)", "k_numeric"), keys.canonical(F.col("o_custkey") % 2 == 0, "boolean").alias("k_bool"))


@query("SELECT l_orderkey, l_linenumber, ('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 25, 8))::BIGINT AS h FROM lineitem")
def pk_hash32(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return rows.select(*LINE_KEY, keys.hash32(keys.key_columns(rows, LINE_KEY)).alias("h"))


# (table, table_exists, has_rows, est_rows, max_commit_lsn, raw_rows, readded, loaded)
STATS = [
    ("a", False, False, 10, None, 0, False, True),
    ("b", True, False, 10, None, 0, False, True),
    ("c", True, False, 0, None, 0, False, False),
    ("d", True, False, -1, None, 0, False, False),
    ("e", True, True, 1000, 0, 1, False, True),
    ("f", True, True, 1001, 0, 799, False, True),
    ("g", True, True, 1001, 0, 800, False, True),
    ("h", True, True, 5000, 7, 10, False, True),
    ("i", True, True, 5, 7, 10, True, True),
]
STATS_COLUMNS = "table string, table_exists boolean, has_rows boolean, est_rows long, max_commit_lsn long, raw_rows long, readded boolean, loaded boolean"


def _stats(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATS, STATS_COLUMNS)


def _literal(x) -> str:
    if isinstance(x, bool):
        return str(x).lower()
    return f"'{x}'" if isinstance(x, str) else f"{'NULL' if x is None else x}::BIGINT"


STATS_SQL = "(VALUES " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in STATS) + ') s("table", table_exists, has_rows, est_rows, max_commit_lsn, raw_rows, readded, loaded)'


@query(f"""SELECT "table", CASE WHEN has_rows AND readded THEN 'RELOAD (re-added)' WHEN has_rows AND est_rows > 1000 AND max_commit_lsn = 0 AND raw_rows < trunc(est_rows * 0.8) THEN 'RELOAD (incomplete load)'
    WHEN NOT table_exists THEN 'CREATE + LOAD' WHEN NOT has_rows AND est_rows > 0 THEN 'LOAD' WHEN has_rows THEN 'CDC' ELSE 'SKIP (empty)' END AS action FROM {STATS_SQL}""")
def plan_table_actions(spark, sf_dir):
    return planner.plan(_stats(spark)).select("table", "action")


@query(f"""SELECT "table", has_rows AND readded OR has_rows AND est_rows > 1000 AND max_commit_lsn = 0 AND raw_rows < trunc(est_rows * 0.8) OR NOT table_exists OR NOT has_rows AND est_rows > 0 AS load,
    CASE WHEN est_rows >= 0 THEN est_rows::VARCHAR ELSE '?' END AS source_shown,
    CASE WHEN has_rows AND (readded OR est_rows > 1000 AND max_commit_lsn = 0 AND raw_rows < trunc(est_rows * 0.8)) THEN 'STALE' WHEN NOT table_exists THEN '—' WHEN NOT has_rows THEN '0' ELSE '✓' END AS replica_shown FROM {STATS_SQL}""")
def plan_display(spark, sf_dir):
    return planner.plan(_stats(spark)).select("table", "load", "source_shown", "replica_shown")


@query(f"""SELECT "table", est_rows, raw_rows, est_rows > 1000 AND raw_rows < trunc(est_rows * 0.8) AS suspect FROM {STATS_SQL} WHERE loaded""")
def integrity_check(spark, sf_dir):
    return planner.integrity(_stats(spark)).select("table", "est_rows", "raw_rows", "suspect")


COUNTED = ("region", "nation", "supplier", "customer", "part", "orders", "events")


@query("SELECT *, (row_number() OVER (ORDER BY est_rows, ordinal))::INT AS place FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", {i} AS ordinal, count(*) AS est_rows FROM {t}" for i, t in enumerate(COUNTED)) + ")")
def load_order(spark, sf_dir):
    source = Source(spark, Endpoint(path=sf_dir))
    rows = [(t, i, source.estimated_rows(t)) for i, t in enumerate(COUNTED)]
    return planner.load_order(spark.createDataFrame(rows, "table string, ordinal int, est_rows long"))


KEYS = {"orders": ["o_orderkey"], "lineitem": ["l_linenumber", "l_orderkey"], "events": []}


@query("""
    SELECT t."table", (list_position(k, column_name) - 1)::INT AS place, column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' END AS type
    FROM (VALUES ('orders', ['o_orderkey']), ('lineitem', ['l_linenumber', 'l_orderkey'])) t("table", k) JOIN information_schema.columns c ON c.table_name = t."table" AND list_contains(k, column_name)""")
def key_discovery(spark, sf_dir):
    """Keys of driver tables, from a catalogue made of their columns; the second index of a table is no key."""
    attributes, indexes, kinds = [], [], {}
    for rel, (table, key) in enumerate(KEYS.items()):
        dtypes = _table(spark, sf_dir, table).dtypes
        names = [n for n, _ in dtypes]
        attributes += [(rel, i + 1, n, kinds.setdefault(k, len(kinds))) for i, (n, k) in enumerate(dtypes)]
        indexes += [(rel, True, [names.index(n) + 1 for n in key])] * bool(key) + [(rel, False, [1, 2])]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    found = lookups.key_columns(frame(indexes, "indrelid long, indisprimary boolean, indkey array<int>"), frame(attributes, "attrelid long, attnum int, attname string, atttypid long"), frame([(o, k) for k, o in kinds.items()], "oid long, typname string"))
    tables = F.element_at(F.array(*[F.lit(t) for t in KEYS]), (F.col("rel_id") + 1).cast("int"))
    return found.select(tables.alias("table"), "place", "name", "type")


@query("SELECT event_id AS pid, event_type AS state, event_id * 16 AS sent_lsn FROM events WHERE props LIKE '%7%' AND event_type != 'view'")
def sender_lookup(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    replication = e.where("event_type != 'view'").select(F.col("event_id").alias("pid"), F.col("event_type").alias("state"), (F.col("event_id") * 16).alias("sent_lsn"))
    return lookups.senders(replication, e.select(F.col("event_id").alias("pid"), F.col("props").alias("query")), "7")


@query("SELECT * FROM (VALUES ('public.a'), ('public.b'), ('public.c')) t(name) EXCEPT SELECT 'public.b'")
def publication_delta(spark, sf_dir):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    return planner.publication_delta(names("public.a", "public.b", "public.c"), names("public.b", "public.z"))


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type != 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS value FROM events""")
def unchanged_carry_forward(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("event_type") == "view").alias("unsent"))
    return merge.carry_forward(e, ["user_id"], ["event_id"], {"value": "unsent"}).select("user_id", "event_id", "value")


@query("SELECT event_id, printf('%X/%X', p >> 32, p & 4294967295) AS lsn, p AS position, greatest(p - 1000000, 0) / 1073741824.0::DOUBLE AS gap_gb FROM (SELECT event_id, event_id * 7919999999 AS p FROM events)")
def lsn_parse_format(spark, sf_dir):
    p = _table(spark, sf_dir, "events").select("event_id", lsn.format_lsn(F.col("event_id") * F.lit(7919999999)).alias("lsn"))
    p = p.withColumn("position", lsn.parse_lsn(F.col("lsn")))
    return p.withColumn("gap_gb", lsn.gap_gb(F.col("position"), F.lit(1000000)))


@query("SELECT event_id, strftime(ts - INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S.%f') AS utc FROM events")
def timestamptz_to_utc(spark, sf_dir):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    return _table(spark, sf_dir, "events").select("event_id", formats.timestamptz_to_utc(text).alias("utc"))


def _scaled(unit: int, letter: str) -> str:
    tenths = f"((abs(n) + {unit // 20}) // {unit // 10})"
    return f"CASE WHEN n < 0 THEN '-' ELSE '' END || {tenths} // 10 || '.' || {tenths} % 10 || '{letter}'"


@query(f"SELECT o_orderkey, CASE WHEN abs(n) >= 1000000000 THEN {_scaled(10**9, 'B')} WHEN abs(n) >= 1000000 THEN {_scaled(10**6, 'M')} WHEN abs(n) >= 1000 THEN {_scaled(1000, 'K')} ELSE n::VARCHAR END AS shown FROM (SELECT o_orderkey, (o_orderkey - 5000) * (o_orderkey % 9) * (o_orderkey % 9) * 37 AS n FROM orders)")
def format_number(spark, sf_dir):
    n = (F.col("o_orderkey") - 5000) * (F.col("o_orderkey") % 9) * (F.col("o_orderkey") % 9) * 37
    return _table(spark, sf_dir, "orders").select("o_orderkey", formats.format_number(n).alias("shown"))


@query("SELECT o_orderkey, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad((s // 60 % 60)::VARCHAR, 2, '0') || 'm' WHEN s >= 60 THEN (s // 60) || 'm' || lpad((s % 60)::VARCHAR, 2, '0') || 's' ELSE s || 's' END AS shown FROM (SELECT o_orderkey, o_orderkey * 3 AS s FROM orders)")
def format_duration(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", formats.format_duration(F.col("o_orderkey") * 3).alias("shown"))


@query(r"SELECT event_id, replace(replace(replace(raw, '\', '\\'), chr(9), '\t'), chr(10), '\n') AS tsv, url_encode(raw) AS url FROM (SELECT event_id, event_type || chr(9) || props || chr(10) || '\~*' AS raw FROM events)")
def text_export(spark, sf_dir):
    raw = F.concat("event_type", F.lit("\t"), F.col("props"), F.lit("\n\\~*"))
    return _table(spark, sf_dir, "events").select("event_id", formats.escape_tsv(raw).alias("tsv"), formats.percent_encode(raw).alias("url"))


CODEC = model.Relation(5, "public", "orders", (model.Field("o_orderkey", 20, True), model.Field("o_custkey", 23), model.Field("o_totalprice", 701), model.Field("o_price", 1700, modifier=(18 << 16 | 2) + 4), model.Field("o_orderdate", 1114), model.Field("o_orderpriority", 25)))
CODEC_SQL = "SELECT o_orderkey, o_custkey::INT AS o_custkey, o_totalprice, round(o_totalprice, 2)::DECIMAL(18,2) AS o_price, o_orderdate, o_orderpriority FROM orders"


def _codec_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("int"), "o_totalprice", F.round("o_totalprice", 2).cast("decimal(18,2)").alias("o_price"), "o_orderdate", "o_orderpriority")


def _cells(df: DataFrame) -> Column:
    """A row as text cells on the wire, in expressions: tag, length and bytes of each column."""
    four = lambda n: F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0"))
    out = [F.unhex(F.lpad(F.hex(F.lit(len(df.columns))), 4, "0"))]
    for name, kind in df.dtypes:
        text = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind == "timestamp_ntz" else F.col(name).cast("string")
        data = F.encode(text, "UTF-8")
        out.append(F.coalesce(F.concat(F.lit(b"t"), four(F.octet_length(data)), data), F.lit(b"n")))
    return F.concat(*out)


@query(CODEC_SQL)
def decode_roundtrip(spark, sf_dir):
    rows = _codec_rows(spark, sf_dir)
    payload = F.concat(F.lit(b"I" + (5).to_bytes(4, "big") + b"N"), _cells(rows))
    frames = rows.select(F.col("o_orderkey").alias("arrival_seq"), F.col("o_orderkey").alias("lsn_start"), payload.alias("payload"))
    typed = pgoutput.typed_rows(F.col("new"), CODEC.fields)
    return pgoutput.decode_frames(frames).select(typed.alias("r")).select("r.*")


@query("SELECT o_orderkey, o_custkey::INT AS o_custkey, o_orderdate FROM orders")
def decode_binary_roundtrip(spark, sf_dir):
    fields = (CODEC.fields[0], CODEC.fields[1], CODEC.fields[4])
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("int"), "o_orderdate")
    fixed = lambda n, width: F.unhex(F.lpad(F.hex(n), 2 * width, "0"))
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) - 946684800000000
    cell = lambda n, width: F.concat(F.lit(b"b" + width.to_bytes(4, "big")), fixed(n, width))
    payload = F.concat(F.lit(b"I" + (5).to_bytes(4, "big") + b"N" + b"\0\3"), cell(F.col("o_orderkey"), 8), cell(F.col("o_custkey").cast("long"), 4), cell(micros, 8))
    frames = rows.select(F.col("o_orderkey").alias("arrival_seq"), F.col("o_orderkey").alias("lsn_start"), payload.alias("payload"))
    return pgoutput.decode_frames(frames).select(pgoutput.typed_rows(F.col("new"), fields).alias("r")).select("r.*")


@query("SELECT o_orderkey, round(o_totalprice, 2)::DECIMAL(18,2) AS o_price FROM orders")
def decode_numeric_roundtrip(spark, sf_dir):
    """Prices as base-10000 numbers on the wire: two groups before the point and one after."""
    fields = (CODEC.fields[0], CODEC.fields[3])
    price = F.round("o_totalprice", 2).cast("decimal(18,2)")
    cents = (price * 100).cast("long")
    group = lambda n: F.unhex(F.lpad(F.hex(n.cast("long")), 4, "0"))
    number = F.concat(F.lit(bytes.fromhex("0003000100000002")), group(F.floor(cents / 1_000_000)), group(F.floor(cents / 100) % 10_000), group(cents % 100 * 100))
    key = F.concat(F.lit(b"b" + (8).to_bytes(4, "big")), F.unhex(F.lpad(F.hex("o_orderkey"), 16, "0")))
    payload = F.concat(F.lit(b"I" + (5).to_bytes(4, "big") + b"N" + b"\0\2"), key, F.lit(b"b" + (14).to_bytes(4, "big")), number)
    frames = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("arrival_seq"), F.col("o_orderkey").alias("lsn_start"), payload.alias("payload"))
    cells = pgoutput.text_cells(F.col("new"), fields)
    return pgoutput.decode_frames(frames).select(pgoutput.typed_rows(cells, fields).alias("r")).select("r.*")


LOGGED = model.Relation(8, "public", "events", (model.Field("user_id", 20, True), model.Field("event_type", 25), model.Field("value", 701)))


def _event_frames(spark: SparkSession, sf_dir: str, turn: int) -> DataFrame:
    """events as a log, a transaction for each event_id: signup inserts, error deletes by key, purchase moves the key up by 1000,
    click updates with binary cells, view updates and leaves value unsent. From event ``turn`` on, which must be there, the
    columns are in another order. Inside a transaction larger users come first, so a key is left before another row moves to it."""
    e = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    most = e.groupBy("event_id").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
    same = Window.partitionBy("event_id")
    e = e.withColumns({"nth": F.row_number().over(same.orderBy(F.desc("user_id"), "event_type", "value")), "last": F.count("*").over(same)})
    fixed = lambda n, width: F.unhex(F.lpad(F.hex(n.cast("long")), 2 * width, "0"))
    cell = lambda tag, data: F.concat(F.lit(tag.encode()), fixed(F.octet_length(data), 4), data)
    text = lambda c: F.encode(c.cast("string"), "UTF-8")
    none, turned = F.lit(b"n"), F.col("event_id") >= turn

    def row(user: Column, kind: Column, value: Column) -> Column:
        return F.concat(F.lit(b"\0\3"), F.when(turned, F.concat(value, user, kind)).otherwise(F.concat(user, kind, value)))

    user, kind, value = cell("t", text(F.col("user_id"))), cell("t", text(F.col("event_type"))), cell("t", text(F.col("value")))
    head = lambda op, mark: F.lit(op + LOGGED.rel_id.to_bytes(4, "big") + mark)
    of = F.col("event_type")
    change = (
        F.when(of == "signup", F.concat(head(b"I", b"N"), row(user, kind, value)))
        .when(of == "error", F.concat(head(b"D", b"K"), row(user, none, none)))
        .when(of == "purchase", F.concat(head(b"U", b"K"), row(user, none, none), F.lit(b"N"), row(cell("t", text(F.col("user_id") + 1000)), kind, value)))
        .when(of == "click", F.concat(head(b"U", b"N"), row(cell("b", fixed(F.col("user_id"), 8)), cell("b", text(F.col("event_type"))), value)))
        .otherwise(F.concat(head(b"U", b"N"), row(user, kind, F.lit(b"u"))))
    )
    end = (F.col("event_id") + 1) * 100
    begin = F.when(F.col("nth") == 1, F.concat(F.lit(b"B"), fixed(end, 8), F.lit(b"\0" * 12)))
    described = F.when((F.col("event_id") == turn) & (F.col("nth") == 1), F.lit(pgoutput.encode_relation(replace(LOGGED, fields=(LOGGED.fields[2], *LOGGED.fields[:2])))))
    commit = F.when(F.col("nth") == F.col("last"), F.lit(b"C"))
    parts = e.select("event_id", "nth", (end - 100).alias("lsn_start"), end.alias("lsn_end"), F.posexplode(F.array(begin, described, change, commit)).alias("place", "payload"))
    place = F.col("place") + F.when(F.col("place") < 2, 0).otherwise(F.col("nth") - 1)
    return parts.where("payload IS NOT NULL").select((F.col("event_id") * (most + 3) + place).alias("arrival_seq"), "lsn_start", "lsn_end", "payload")


@query("""
    WITH versions AS (
        SELECT user_id, event_id, 0 AS part, 1 AS dead, event_type, value, false AS sent FROM events WHERE event_type IN ('error', 'purchase')
        UNION ALL SELECT CASE WHEN event_type = 'purchase' THEN user_id + 1000 ELSE user_id END, event_id, 1, 0, event_type, value, event_type != 'view' FROM events WHERE event_type != 'error'),
    lives AS (SELECT *, coalesce(sum(dead) OVER (PARTITION BY user_id ORDER BY event_id, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS life FROM versions),
    filled AS (SELECT user_id, event_id, part, dead, event_type, last_value(CASE WHEN sent THEN value END IGNORE NULLS) OVER (PARTITION BY user_id, life ORDER BY event_id, part ROWS UNBOUNDED PRECEDING) AS value FROM lives)
    SELECT user_id, event_type, value FROM filled QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, part DESC) = 1 AND dead = 0""")
def drain_log(spark, sf_dir):
    """The whole path of a mirror: frames are decoded, bound, routed and applied by two bounded runs, the second one from where the first ended."""
    ids = _table(spark, sf_dir, "events").select("event_id")
    half = ids.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0] // 2
    turn = ids.where(F.col("event_id") >= half).agg(F.min("event_id")).first()[0]
    log = store.scratch(spark, "event-log")
    _event_frames(spark, sf_dir, turn).write.parquet(log)
    replica = Replica(spark, store.scratch(spark, "event-replica"))
    replica.create("events", spark.createDataFrame([], "user_id long, event_type string, value double").schema)
    progress = Progress(spark, replica.folder, "events")
    for target in ((half // 2 * 3 + 1) * 100, drain.target_position(drain.frames(spark, log))):
        slot, report = progress.slot(), {}
        drain.drain(spark, log, replica, {"events": LOGGED}, target, slot.batch + 1, slot.confirmed, remembered=progress.relations(), report=report)
        progress.acknowledge(slot.batch + 1, target, report.get("relations"))
    return merge.current(replica.read("events"), ["user_id"]).select("user_id", "event_type", "value")


@query(f"SELECT user_id, event_id, event_type, value FROM ({LAST_EVENT}) WHERE is_deleted = 0")
def streaming_drain(spark, sf_dir):
    """The event log as a file stream, appended batch by batch to a replica and read back as its current state."""
    replica = Replica(spark, store.scratch(spark, "streamed"))
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select("user_id", "event_id", "event_type", "value")
    replica.create("events", stream.schema)

    def apply(rows: DataFrame, batch: int) -> None:
        made = {model.REL_ID: F.lit(8), model.SYNCED_AT: F.current_timestamp(), model.IS_DELETED: (F.col("event_type") == "error").cast("int"), model.VERSION: model.version(F.col("event_id")), model.UNSENT: F.array()}
        replica.write("events", rows.withColumns(made), batch)

    drain.run(stream, apply, store.scratch(spark, "stream-state")).awaitTermination()
    return merge.current(replica.read("events"), ["user_id"]).select("user_id", "event_id", "event_type", "value")
