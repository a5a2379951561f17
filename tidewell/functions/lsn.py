"""Log positions: 64-bit integers written as two hexadecimal halves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_lsn(text: Column) -> Column:
    """``3C7D/2F652920`` as a long; null if it is not of that form."""
    halves = F.split(text, "/")
    number = lambda i: F.conv(F.get(halves, F.lit(i)), 16, 10).cast("long")
    return F.when(F.regexp_like(text, F.lit("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")), F.shiftleft(number(0), 32).bitwiseOR(number(1)))


def format_lsn(position: Column) -> Column:
    """Upper-case hexadecimal halves without padding."""
    return F.concat(F.hex(F.shiftrightunsigned(position, 32)), F.lit("/"), F.hex(position.bitwiseAND(F.lit(0xFFFFFFFF))))


def parse(text: str) -> int:
    high, _, low = text.partition("/")
    return int(high, 16) << 32 | int(low, 16)


def format(position: int) -> str:
    return f"{position >> 32:X}/{position & 0xFFFFFFFF:X}"


def gap_gb(ahead: Column, behind: Column) -> Column:
    """Distance of two positions in GiB, at least 0."""
    return F.greatest(ahead - behind, F.lit(0)) / F.lit(float(1 << 30))


def furthest(*positions: Column) -> Column:
    """The largest of positions that may be null or 0; null if all are."""
    return F.greatest(*[F.nullif(p, F.lit(0)) for p in positions])


def cdc_percent(reached: Column, confirmed: Column, target: Column) -> Column:
    """How much of the way from the confirmed position to the target is done, 0 to 100."""
    moving = (target > confirmed) & (reached > confirmed)
    return F.when(moving, F.least((reached - confirmed) / (target - confirmed) * 100, F.lit(100.0))).otherwise(F.lit(0.0))


def cdc_bottleneck(processed: Column, sent: Column, reached: Column, messages: Column) -> Column:
    """What a drain waits for: rows that were sent and are being applied, the sender's decoding, or nothing."""
    return F.when((F.coalesce(sent, F.lit(0)) > processed) & (messages > 0), "flushing").when(reached > processed, "decoding").otherwise("")
