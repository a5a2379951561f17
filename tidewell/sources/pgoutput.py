"""Messages of a logical replication stream: decoding, and encoding for fixtures.

Layout (all integers big-endian): a type byte, then
R id, namespace, name, identity, columns of (flags, name, type, modifier);
I id, 'N' row; U id, optionally 'K' or 'O' row, 'N' row; D id, 'K' or 'O' row;
B final position, time, transaction; C; T count, options, ids.
A row is a count of cells: 'n' null, 'u' unchanged, 't' or 'b' and length and
bytes. A message that does not parse is reported with its fault, never lost.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from decimal import Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell import model

CELL = "struct<tag:string,data:binary>"
FIELD = "struct<name:string,oid:bigint,key:boolean,modifier:int>"
MESSAGE = {
    "arrival_seq": "bigint",
    "lsn_start": "bigint",
    "kind": "string",
    "rel_id": "bigint",
    "namespace": "string",
    "name": "string",
    "identity": "string",
    "fields": f"array<{FIELD}>",
    "key_kind": "string",
    "old": f"array<{CELL}>",
    "new": f"array<{CELL}>",
    "final_lsn": "bigint",
    "committed_at": "timestamp",
    "xid": "bigint",
    "truncated": "array<bigint>",
    "fault": "string",
}
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)


class Malformed(ValueError):
    """A message that ends early or has an unknown mark."""


class Cursor:
    """Reads fields off a message from the front."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, form: str):
        try:
            (value,) = struct.unpack_from(">" + form, self.data, self.at)
        except struct.error as e:
            raise Malformed("message ends early") from e
        self.at += struct.calcsize(">" + form)
        return value

    def bytes(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise Malformed("value ends early")
        self.at += n
        return self.data[self.at - n : self.at]

    def text(self) -> str:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise Malformed("text has no end")
        found = self.data[self.at : end].decode("utf-8", "replace")
        self.at = end + 1
        return found


def decode(payload: bytes) -> dict | None:
    """The fields of a message; None for kinds that carry no change (origin, type and unknown ones)."""
    if not payload:
        return None
    kind, c = chr(payload[0]), Cursor(payload[1:])
    if kind == "R":
        found = {"rel_id": c.take("I"), "namespace": c.text(), "name": c.text(), "identity": chr(c.take("B"))}
        fields = []
        for _ in range(c.take("H")):
            flags = c.take("B")
            fields.append({"name": c.text(), "oid": c.take("I"), "key": bool(flags & 1), "modifier": c.take("i")})
        return {"kind": kind, **found, "fields": fields}
    if kind in "IUD":
        old, new = Rows(), Rows()
        rel_id, key_kind = change_parts(kind, payload, old, new)
        return {"kind": kind, "rel_id": rel_id, "key_kind": key_kind, "old": old.array()[0].as_py(), "new": new.array()[0].as_py()}
    if kind == "B":
        lsn, at, xid = c.take("Q"), c.take("q"), c.take("I")
        return {"kind": kind, "final_lsn": lsn, "committed_at": EPOCH + timedelta(microseconds=at), "xid": xid}
    if kind == "C":
        return {"kind": kind}
    if kind == "T":
        n = c.take("I")
        c.take("B")
        return {"kind": kind, "truncated": [c.take("I") for _ in range(n)]}
    return None


def envelope(data: bytes) -> tuple[int, int, bytes] | None:
    """(start, end, payload) of a data frame of a stream; None for keepalives and frames that are too short."""
    if len(data) < 25 or data[:1] != b"w":
        return None
    start, end, _ = struct.unpack_from(">QQq", data, 1)
    return start, end, data[25:]


def keepalive(data: bytes) -> tuple[int, bool] | None:
    """(end position, whether a reply is asked) of a keepalive frame."""
    if len(data) < 18 or data[:1] != b"k":
        return None
    return struct.unpack_from(">Q", data, 1)[0], data[17] == 1


def status_update(position: int, micros: int) -> bytes:
    """An acknowledgement: written, flushed and applied up to ``position``, at microseconds since 2000."""
    return struct.pack(">cQQQqB", b"r", position, position, position, micros, 0)


class Rows:
    """A list column of cells, built flat: tags and data of all cells and where each row ends."""

    def __init__(self):
        self.tags, self.data, self.ends, self.valid = [], [], [0], []

    def none(self) -> None:
        self.ends.append(len(self.tags))
        self.valid.append(False)

    def add(self, message: bytes, at: int) -> int:
        """Parse the row at ``at`` and return where it ends; leaves nothing behind if it is malformed."""
        tags, data, size = self.tags, self.data, len(message)
        start = len(tags)
        try:
            if at + 2 > size:
                raise Malformed("message ends early")
            cells = message[at] << 8 | message[at + 1]
            at += 2
            for _ in range(cells):
                if at >= size:
                    raise Malformed("message ends early")
                tag = TAGS.get(message[at])
                if tag is None:
                    raise Malformed(f"mark {chr(message[at])!r} is none of nutb")
                at += 1
                value = None
                if tag in "tb":
                    if at + 4 > size:
                        raise Malformed("message ends early")
                    end = at + 4 + int.from_bytes(message[at : at + 4], "big", signed=True)
                    if not at + 4 <= end <= size:
                        raise Malformed("value ends early")
                    value = message[at + 4 : end]
                    at = end
                tags.append(tag)
                data.append(value)
        except Malformed:
            del tags[start:], data[start:]
            raise
        self.ends.append(len(tags))
        self.valid.append(True)
        return at

    def array(self) -> pa.Array:
        cells = pa.StructArray.from_arrays([pa.array(self.tags, pa.string()), pa.array(self.data, pa.binary())], ["tag", "data"])
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), cells, mask=pa.array([not v for v in self.valid], pa.bool_()))


TAGS = {ord(c): c for c in "nutb"}
#: Messages whose cells are held at once.
AT_ONCE = 4096


def change_parts(kind: str, payload: bytes, old: Rows, new: Rows) -> tuple[int, str | None]:
    """(relation id, key kind) of a row change whose rows are added to ``old`` and ``new``."""
    if len(payload) < 6:
        raise Malformed("message ends early")
    rel_id, mark, at = int.from_bytes(payload[1:5], "big"), chr(payload[5]), 6
    if mark not in {"I": "N", "U": "KON", "D": "KO"}[kind]:
        raise Malformed(f"mark {mark!r} does not begin a row of {kind}")
    before = len(old.valid), len(old.tags)
    try:
        if mark == "N":
            old.none()
        else:
            at = old.add(payload, at)
        if kind == "D":
            new.none()
        else:
            if mark != "N":
                if payload[at : at + 1] != b"N":
                    raise Malformed("mark of the new row is missing")
                at += 1
            new.add(payload, at)
    except Malformed:
        if len(old.valid) > before[0]:
            del old.valid[before[0] :], old.ends[before[0] + 1 :], old.tags[before[1] :], old.data[before[1] :]
        raise
    return rel_id, None if mark == "N" else mark


def decode_frames(frames: DataFrame, spread: bool = True) -> DataFrame:
    """Messages of ``frames`` (arrival_seq, lsn_start, payload); the only Python step of the engine.

    Rows of changes are parsed into flat columns, the rarer kinds one by one.
    With ``spread`` a log of fewer partitions than there are cores is dealt
    over all of them, since decoding is bound by the CPU.
    """
    field = pa.list_(pa.struct([("name", pa.string()), ("oid", pa.int64()), ("key", pa.bool_()), ("modifier", pa.int32())]))
    cell = pa.list_(pa.struct([("tag", pa.string()), ("data", pa.binary())]))
    arrow = {"bigint": pa.int64(), "string": pa.string(), f"array<{FIELD}>": field, f"array<{CELL}>": cell, "timestamp": pa.timestamp("us", "UTC"), "array<bigint>": pa.list_(pa.int64())}
    schema = pa.schema([(name, arrow[kind]) for name, kind in MESSAGE.items()])
    plain = [name for name in MESSAGE if name not in ("old", "new")]

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        held, old, new = {name: [] for name in plain}, Rows(), Rows()
        for seq, lsn, payload in zip(*[c.to_pylist() for c in part.columns], strict=True):
            if not payload:
                continue
            kind = chr(payload[0])
            found = {"arrival_seq": seq, "lsn_start": lsn, "kind": kind}
            try:
                if kind in "IUD":
                    found["rel_id"], found["key_kind"] = change_parts(kind, payload, old, new)
                else:
                    other = decode(payload)
                    if other is None:
                        continue
                    found |= other
                    old.none()
                    new.none()
            except Malformed as e:
                found["fault"] = str(e)
                old.none()
                new.none()
            for name in plain:
                held[name].append(found.get(name))
        arrays = {name: pa.array(values, schema.field(name).type) for name, values in held.items()} | {"old": old.array(), "new": new.array()}
        return pa.RecordBatch.from_arrays([arrays[name] for name in MESSAGE], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                yield batch(b.slice(at, AT_ONCE))

    frames = frames.select("arrival_seq", "lsn_start", "payload")
    cores = frames.sparkSession.sparkContext.defaultParallelism
    if spread and not frames.isStreaming and frames.rdd.getNumPartitions() < cores:
        frames = frames.repartition(cores)
    return frames.mapInArrow(work, ", ".join(f"{name} {kind}" for name, kind in MESSAGE.items()))


def numeric(data: bytes) -> Decimal | None:
    """A base-10000 number; None for infinities and not-a-number, which a decimal cannot hold."""
    c = Cursor(data)
    n, weight, sign, scale = c.take("H"), c.take("h"), c.take("H"), c.take("H")
    if sign not in (0, 0x4000):
        return None
    whole = 0
    for _ in range(n):
        whole = whole * 10000 + c.take("H")
    value = Decimal(whole).scaleb(4 * (weight - n + 1))
    try:
        return (-value if sign else value).quantize(Decimal(1).scaleb(-scale))
    except InvalidOperation:
        return -value if sign else value


def value(tag: str, data: bytes | None, oid: int):
    """A binary cell of PYTHON_OIDS as a Python value. Wrong lengths give the type's default."""
    if tag != "b" or data is None:
        return None
    if oid == 1700:
        try:
            return numeric(data)
        except Malformed:
            return Decimal(0)
    form = {700: ">f", 701: ">d"}[oid]
    return struct.unpack(form, data)[0] if len(data) == struct.calcsize(form) else 0


#: Types whose binary form no expression reads.
PYTHON_OIDS = (700, 701, 1700)


def text_of(tag: str, data: bytes | None, oid: int) -> tuple[str, bytes | None]:
    """A binary cell of PYTHON_OIDS as the text cell of the same value, null where a text cell of it would be read as null."""
    if tag != "b" or oid not in PYTHON_OIDS:
        return tag, data
    found = value(tag, data, oid)
    if found is None:
        return "n", None
    text = format(found, "f") if isinstance(found, Decimal) else str(found)
    return "t", text.encode()


def text_cells(cells: Column, fields: tuple[model.Field, ...], compact_key: bool = False) -> Column:
    """``cells`` with binary ones of PYTHON_OIDS turned to text; rows without binary cells are not handed to Python.

    ``compact_key`` is as in :func:`typed_rows`.
    """
    oids, keys = [f.oid for f in fields], [f.oid for f in fields if f.key]
    if not set(oids) & set(PYTHON_OIDS):
        return cells

    @F.udf(f"array<{CELL}>", useArrow=True)
    def turned(row):
        if row is None:
            return None
        kinds = keys if compact_key and len(row) == len(keys) else oids
        kinds = [*kinds, *[25] * (len(row) - len(kinds))]
        return [dict(zip(("tag", "data"), text_of(c["tag"], c["data"], o), strict=True)) for c, o in zip(row, kinds, strict=False)]

    binary = F.exists(cells, lambda c: c["tag"] == "b")
    return F.when(binary, turned(F.when(binary, cells))).otherwise(cells)


def binary_value(data: Column, oid: int, kind: str) -> Column:
    """A binary cell as a value of the Spark type ``kind``; wrong lengths give the type's default."""
    width = {16: 1, 20: 8, 21: 2, 23: 4, 1082: 4, 1114: 8, 1184: 8, 2950: 16}.get(oid)
    if not width:
        return F.make_valid_utf8(data.cast("string")).try_cast(kind)
    number = F.conv(F.hex(data), 16, -10).cast("long")
    if width < 8:
        number = F.when(number >= 1 << (8 * width - 1), number - (1 << 8 * width)).otherwise(number)
    if oid == 16:
        found = number != 0
    elif oid == 1082:
        # Infinite and far dates and times, beyond the years 1 to 9999, have no value.
        found = F.date_add(F.lit("2000-01-01").cast("date"), F.when(number.between(-730_119, 2_921_939), number).cast("int"))
    elif oid in (1114, 1184):
        near = F.when(number.between(-63_082_281_600_000_000, 252_455_615_999_999_999), number)
        found = F.timestamp_micros(near + 946_684_800_000_000).cast(kind)
    elif oid == 2950:
        text = F.lower(F.hex(data))
        found = F.concat_ws("-", *[F.substring(text, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    else:
        found = number.cast(kind)
    default = F.lit(model.default_text(oid)).cast(kind)
    return F.when(F.octet_length(data) == width, found).when(data.isNotNull(), default)


def typed_rows(cells: Column, fields: tuple[model.Field, ...], compact_key: bool = False) -> Column:
    """A row's cells as a typed struct, in DataFrame expressions; unchanged and null cells are null.

    Binary cells of PYTHON_OIDS are to be turned by :func:`text_cells` before.

    Booleans are ``t``; times with offset are read in UTC. With ``compact_key``
    the row may hold key columns only, as some senders write it.
    """
    keys = [i for i, f in enumerate(fields) if f.key]

    def cell(i: int) -> Column:
        full = F.get(cells, F.lit(i))
        if compact_key and i in keys:
            return F.when(F.size(cells) == len(keys), F.get(cells, F.lit(keys.index(i)))).otherwise(full)
        return full

    def typed(i: int, f: model.Field) -> Column:
        kind = model.spark_type(f.oid, f.modifier)
        text = F.when(cell(i)["tag"] == "t", F.make_valid_utf8(cell(i)["data"].cast("string")))
        said = F.when(text.isNotNull(), text == "t") if f.oid == 16 else text.try_cast(kind)
        if f.oid in PYTHON_OIDS:
            return said
        return F.when(cell(i)["tag"] == "b", binary_value(cell(i)["data"], f.oid, kind)).otherwise(said)

    return F.struct(*[typed(i, f).alias(f.name) for i, f in enumerate(fields)])


def encode_row(cells: list) -> bytes:
    """Cells as None, an (tag, bytes) pair, or text."""
    out = [struct.pack(">H", len(cells))]
    for c in cells:
        if c is None or c == "u":
            out.append(b"n" if c is None else b"u")
        else:
            tag, data = c if isinstance(c, tuple) else ("t", str(c).encode())
            out.append(tag.encode() + struct.pack(">i", len(data)) + data)
    return b"".join(out)


def encode_relation(r: model.Relation) -> bytes:
    fields = b"".join(struct.pack(">B", f.key) + f.name.encode() + b"\0" + struct.pack(">Ii", f.oid, f.modifier) for f in r.fields)
    return b"R" + struct.pack(">I", r.rel_id) + r.namespace.encode() + b"\0" + r.name.encode() + b"\0" + r.identity.encode() + struct.pack(">H", len(r.fields)) + fields


def encode_change(kind: str, rel_id: int, new: list | None = None, old: list | None = None, key_kind: str = "K") -> bytes:
    return kind.encode() + struct.pack(">I", rel_id) + (key_kind.encode() + encode_row(old) if old is not None else b"") + (b"N" + encode_row(new) if new is not None else b"")


def encode_begin(final_lsn: int, micros: int = 0, xid: int = 1) -> bytes:
    return b"B" + struct.pack(">QqI", final_lsn, micros, xid)
