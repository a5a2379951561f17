"""Types, metadata columns and tombstone defaults of mirrored tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

META = "_tw_"
REL_ID, SYNCED_AT, IS_DELETED, VERSION, UNSENT = (META + n for n in ("rel_id", "synced_at", "is_deleted", "version", "unsent"))
#: Types of the metadata columns. A version is (commit_lsn, ordinal in the transaction, part), compared left to right.
VERSION_TYPE = "struct<commit_lsn:bigint,ordinal:bigint,part:int>"
#: UNSENT names the columns whose value the source did not send and no earlier version has.
META_TYPES = {REL_ID: "bigint", SYNCED_AT: "timestamp", IS_DELETED: "int", VERSION: VERSION_TYPE, UNSENT: "array<string>"}

# The source's type identifiers, with the type and the tombstone default of each.
OIDS = {
    16: ("boolean", "false"),
    20: ("bigint", "0"),
    21: ("smallint", "0"),
    23: ("int", "0"),
    25: ("string", ""),
    700: ("float", "0"),
    701: ("double", "0"),
    1043: ("string", ""),
    1082: ("date", "1970-01-01"),
    1114: ("timestamp_ntz", "1970-01-01 00:00:00"),
    1184: ("timestamp", "1970-01-01 00:00:00"),
    1700: ("decimal", "0"),
    2950: ("string", "00000000-0000-0000-0000-000000000000"),
}


def spark_type(oid: int, modifier: int = -1) -> str:
    """The Spark type of a column; unknown types are strings, numerics take precision and scale from the modifier."""
    name = OIDS.get(oid, ("string", ""))[0]
    if name != "decimal":
        return name
    if modifier < 4:
        return "decimal(38,18)"
    precision, scale = (modifier - 4) >> 16, (modifier - 4) & 0x7FF
    return f"decimal({min(precision, 38)},{min(scale, 38)})"


def default_text(oid: int) -> str:
    """What a tombstone holds, as text, in a column that is not part of the key."""
    return OIDS.get(oid, ("string", ""))[1]


#: Tombstone defaults by Spark type, for tables whose source types are not known.
DEFAULTS = {"boolean": "false", "string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "timestamp_ntz": "1970-01-01 00:00:00"}


def default(kind: str) -> Column:
    """The tombstone default of a Spark type, typed."""
    return F.lit(DEFAULTS.get(kind, "0")).cast(kind)


def version(commit_lsn: Column | int, ordinal: Column | int = 0, part: Column | int = 0) -> Column:
    """A version value. Snapshot rows have 0 in all parts."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(commit_lsn).cast("long").alias("commit_lsn"), lit(ordinal).cast("long").alias("ordinal"), lit(part).cast("int").alias("part"))


@dataclass(frozen=True)
class Field:
    """A source column: key columns have ``key`` set."""

    name: str
    oid: int
    key: bool = False
    modifier: int = -1


@dataclass(frozen=True)
class Relation:
    """A source table as its log describes it."""

    rel_id: int
    namespace: str
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)
    identity: str = "d"
