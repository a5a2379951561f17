"""Text forms of numbers, durations, times and exported values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_number(n: Column) -> Column:
    """Whole numbers with one decimal and B, M or K from 1e9, 1e6 and 1e3 on, rounded half up; sign kept."""
    magnitude, sign = F.abs(n), F.when(n < 0, F.lit("-")).otherwise(F.lit(""))

    def scaled(unit: int, letter: str) -> Column:
        tenths = F.floor((magnitude + unit // 20) / F.lit(unit // 10))
        return F.concat(sign, F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(letter))

    plain = n.cast("string")
    return F.when(magnitude >= 10**9, scaled(10**9, "B")).when(magnitude >= 10**6, scaled(10**6, "M")).when(magnitude >= 1000, scaled(1000, "K")).otherwise(plain)


def format_duration(seconds: Column) -> Column:
    """``2h05m`` from an hour on, ``3m07s`` from a minute on, else ``42s``."""
    whole = seconds.cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    part = lambda by: F.floor(whole / by)
    return F.when(whole >= 3600, F.concat(part(3600).cast("string"), F.lit("h"), two(part(60) % 60), F.lit("m"))).when(whole >= 60, F.concat(part(60).cast("string"), F.lit("m"), two(whole % 60), F.lit("s"))).otherwise(F.concat(whole.cast("string"), F.lit("s")))


def size_pretty(size: Column) -> Column:
    """Bytes with the largest unit that keeps the number below 10,240."""
    out = F.concat(size.cast("string"), F.lit(" bytes"))
    for power, unit in ((1, "kB"), (2, "MB"), (3, "GB"), (4, "TB")):
        limit = 10240 * 1024 ** (power - 1)
        out = F.when(F.abs(size) >= limit, F.concat(F.round(size / F.lit(1024**power)).cast("long").cast("string"), F.lit(f" {unit}"))).otherwise(out)
    return out


def size_text(size: int) -> str:
    """:func:`size_pretty` of a number on the driver."""
    power = next((p for p in (4, 3, 2, 1) if abs(size) >= 10240 * 1024 ** (p - 1)), 0)
    return f"{size} bytes" if not power else f"{int(size / 1024**power + 0.5)} {('kB', 'MB', 'GB', 'TB')[power - 1]}"


def timestamptz_to_utc(text: Column) -> Column:
    """A time with offset as UTC with six decimals and no offset; other text stays as it is. The session's zone must be UTC."""
    form = F.regexp_like(text, F.lit(r"^\d{4,}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d+)?[+-]\d\d(:?\d\d)?$"))
    return F.coalesce(F.when(form, F.date_format(text.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")), text)


def escape_tsv(text: Column) -> Column:
    """For text export: null is the mark ``\\N``; backslash, tab and line feed are escaped."""
    escaped = text
    for raw, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(written))
    return F.coalesce(escaped, F.lit("\\N"))


def percent_encode(text: Column) -> Column:
    """RFC 3986: unreserved characters stay, other bytes become %XX."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def progress(done: int, expected: int, seconds: float) -> dict:
    """Share in percent (100 at most), rows a second, and the time left of a load."""
    share = min(100.0, 100.0 * done / expected) if expected > 0 else 0.0
    rate = done / seconds if seconds > 0 else 0.0
    left = (expected - done) / rate if rate > 0 else None
    eta = "unknown" if left is None else "finishing" if left <= 0 else f"{left / 3600:.1f}h" if left >= 3600 else f"{left / 60:.0f}m"
    return {"percent": share, "rows_per_second": rate, "eta": eta}


def remaining(percent: float, elapsed: float) -> float | None:
    """Seconds left of work of which ``percent`` is done."""
    return elapsed / percent * 100 - elapsed if percent > 0 else None
