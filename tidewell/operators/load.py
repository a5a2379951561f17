"""Initial loads of whole tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from tidewell.functions import formats
from tidewell.operators.normalize import snapshot_rows
from tidewell.sources.tables import Replica, Source

#: The batch that holds a table's snapshot; drained batches count from 1.
SNAPSHOT_BATCH = 0


class LoadFailed(RuntimeError):
    """Some tables could not be loaded, so no change may be applied."""


def load_table(source: Source, replica: Replica, table: str, rel_id: int, expected: int = -1) -> dict:
    """Create or empty the replica and fill it; executors move the rows. Returns figures of the load."""
    began = time.time()
    rows = source.read(table)
    if not replica.exists(table):
        replica.create(table, rows.schema)
    replica.truncate(table)
    replica.write(table, snapshot_rows(rows, rel_id), SNAPSHOT_BATCH)
    done = replica.read(table).count()
    return {"table": table, "rows": done, **formats.progress(done, expected, time.time() - began)}


def load_all(tables: list[tuple[str, int, int]], load: Callable[[str, int, int], dict], parallel: int) -> list[dict]:
    """Load (table, rel_id, estimate) in the order given, ``parallel`` at a time; Spark's fair pools share the executors.

    All loads run to their end; if any failed the whole run stops with their names.
    """
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        started = [(t, pool.submit(load, t, rel, est)) for t, rel, est in tables]
    failed = [f"{t}: {f.exception()}" for t, f in started if f.exception()]
    if failed:
        raise LoadFailed("; ".join(failed)[:2000])
    return [f.result() for _, f in started]
