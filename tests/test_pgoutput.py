import struct
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell import model
from tidewell.sources import pgoutput as pg


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("0002000000000002000c1388", Decimal("12.50")),
        ("0001ffff400000011388", Decimal("-0.5")),
        ("00010001000000000001", Decimal(10000)),
        ("0003000100000002000109291a2c", Decimal("12345.67")),
        ("0000000000000002", Decimal("0.00")),
        ("00000000c0000000", None),
        ("00000000d0000000", None),
        ("0001fffe0000000804d2", Decimal("0.00001234")),
    ],
)
def test_numeric(raw, expected):
    assert pg.numeric(bytes.fromhex(raw)) == expected


@pytest.mark.parametrize(
    "oid, raw, expected",
    [
        (23, "fffffffe", -2),
        (20, "fffffffffffffffe", -2),
        (21, "ffff", -1),
        (16, "01", True),
        (23, "ff", 0),
        (1082, "ffffffff", date(1999, 12, 31)),
        (1082, "ff", date(1970, 1, 1)),
        (1114, "ffffffffffffffff", datetime(1999, 12, 31, 23, 59, 59, 999999)),
        (1184, "0000000000000000", datetime(2000, 1, 1, tzinfo=timezone.utc)),
        (2950, "00112233445566778899aabbccddeeff", "00112233-4455-6677-8899-aabbccddeeff"),
        (2950, "00", "00000000-0000-0000-0000-000000000000"),
        (25, "ff", "�"),
    ],
)
def test_binary_values(spark, oid, raw, expected):
    cells = spark.createDataFrame([([("b", bytearray.fromhex(raw)), ("n", None), ("u", None)],)], f"cells array<{pg.CELL}>")
    fields = tuple(model.Field(n, oid) for n in "abc")
    got = cells.select(pg.typed_rows(pg.text_cells(F.col("cells"), fields), fields).alias("r")).first()["r"]
    want = expected.astimezone().replace(tzinfo=None) if isinstance(expected, datetime) and expected.tzinfo else expected
    assert tuple(got) == (want, None, None)


@pytest.mark.parametrize("oid, raw, expected", [(701, "3ff8000000000000", 1.5), (701, "3f", 0), (700, "3fc00000", 1.5), (1700, "0002000000000002000c1388", Decimal("12.50")), (1700, "00", Decimal(0))])
def test_binary_values_in_python(oid, raw, expected):
    assert pg.value("b", bytes.fromhex(raw), oid) == expected


@given(st.lists(st.tuples(st.sampled_from("IUD"), st.booleans(), st.lists(st.sampled_from([None, "u", "text", ("b", b"\x00")]), max_size=4), st.integers(0, 40)), max_size=12))
def test_a_malformed_message_leaves_its_neighbours_whole(messages):
    """Some messages are cut short; the flat columns hold the others as they are parsed alone."""
    old, new, want = pg.Rows(), pg.Rows(), []
    for kind, keyed, cells, cut in messages:
        data = pg.encode_change(kind, 7, None if kind == "D" else cells, cells[::-1] if kind == "D" or (keyed and kind == "U") else None)
        data = data[: len(data) - cut // 10] if cut >= 30 else data
        try:
            alone = pg.decode(data)
            pg.change_parts(kind, data, old, new)
            want.append((alone["old"], alone["new"]))
        except pg.Malformed:
            pass
    assert list(zip(old.array().to_pylist(), new.array().to_pylist(), strict=True)) == want


@given(st.binary(max_size=80))
def test_any_bytes_parse_or_are_malformed(data):
    try:
        pg.decode(data)
    except pg.Malformed:
        pass


@pytest.mark.parametrize("data", [b"I\0\0\0\1N\0\1t\0\0\0\5ab", b"I\0\0\0\1X", b"D\0\0\0\1N\0\0", b"U\0\0\0\1N\0\1z", b"R\0\0\0\1public"])
def test_faults(data):
    with pytest.raises(pg.Malformed):
        pg.decode(data)


def test_kinds_without_changes():
    assert pg.decode(b"") is None
    assert pg.decode(b"O...") is None
    assert pg.decode(b"C") == {"kind": "C"}
    assert pg.decode(b"T" + struct.pack(">IBII", 2, 0, 7, 8))["truncated"] == [7, 8]


def test_frames():
    frame = b"w" + struct.pack(">QQq", 16, 32, 0) + b"C"
    assert pg.envelope(frame) == (16, 32, b"C")
    assert pg.envelope(frame[:20]) is None
    assert pg.keepalive(b"k" + struct.pack(">Qq", 48, 0) + b"\1") == (48, True)
    assert len(pg.status_update(48, 0)) == 34


def test_types_of_columns():
    assert model.spark_type(1700, (10 << 16 | 2) + 4) == "decimal(10,2)"
    assert model.spark_type(99999) == "string"
    assert model.default_text(99999) == ""


def test_malformed_messages_are_reported(spark):
    rows = spark.createDataFrame([(1, 1, bytearray(b"I\0\0\0\1X")), (2, 2, bytearray(b"C"))], "arrival_seq long, lsn_start long, payload binary")
    found = {r["arrival_seq"]: r["fault"] for r in pg.decode_frames(rows).collect()}
    assert found[1] and found[2] is None
