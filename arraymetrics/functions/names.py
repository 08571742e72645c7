"""Names, labels and dates as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitise(name: Column, prefix: str = "") -> Column:
    """F2: a display name as a metric name of letters, digits and single underscores."""
    c = F.replace(name, F.lit("(%)"), F.lit("percent"))
    c = F.translate(c, "/-().,:[]", "__")
    c = F.replace(F.replace(F.replace(c, F.lit("+∞"), F.lit("inf")), F.lit("+"), F.lit("plus")), F.lit("∞"), F.lit("inf"))
    c = F.regexp_replace(F.lower(c), r"(?U)\s+", "_")
    c = F.regexp_replace(F.regexp_replace(c, "_+", "_"), "^_|_$", "")
    return F.concat(F.lit(prefix), c)


def short_name(name: Column, prefix: str = "am_") -> Column:
    """a terser variant; ``%`` is ``pct``, a slash is ``p`` but for operations per second."""
    c = F.lower(name)
    for old, new in (("io/s", "iops"), ("i/os", "io"), ("/", "p"), ("%", "pct")):
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(F.regexp_replace(c, "[^0-9a-z]+", "_"), "^_|_$", "")
    return F.concat(F.lit(prefix), c)


def interval_label(seconds: Column) -> Column:
    """5s, 1m, 1h; whole units, rounded down."""
    return F.when(seconds < 60, F.concat(seconds.cast("string"), F.lit("s"))).when(seconds < 3600, F.concat(F.floor(seconds / 60).cast("string"), F.lit("m"))).otherwise(F.concat(F.floor(seconds / 3600).cast("string"), F.lit("h")))


def unit_of(metric: Column) -> Column:
    """the unit that a metric name suggests; the first rule that fits."""
    has = lambda *words: F.lower(metric).rlike("|".join(words))
    return (
        F.when(has("percent", "usage", "ratio", r"\(%\)"), "percent").when(has("mb_s", "mb/s"), "MBs").when(has("kb_s", "kb/s"), "KBs")
        .when(has("timeus", r"\(us\)", "_us"), "µs").when(has("_ms", r"\(ms\)"), "ms").when(has("iops", "io_s", "io/s"), "ops").otherwise("short")
    )


def conversion(divisor: Column) -> Column:
    """F8: ``÷1024``, ``×1024`` and so on; empty where nothing is converted."""
    return F.when(divisor.isNull() | (divisor == 1), "").when(divisor < 1, F.concat(F.lit("×"), F.round(1 / divisor).cast("long").cast("string"))).otherwise(F.concat(F.lit("÷"), divisor.cast("long").cast("string")))


def file_fields(path: Column) -> Column:
    """model, sn, sp and dump time from a dump's file name; empty text or null where a part is missing."""
    name = F.element_at(F.split(path, "/"), -1)
    pattern = r"PerfData_(.+?)_SN_([0-9A-Z]+)_SP(\d+)_\d+_(\d{14})"
    part = lambda i: F.regexp_extract(name, pattern, i)
    stamp = F.try_to_timestamp(F.concat(F.nullif(part(4), F.lit("")), F.lit("+00:00")), F.lit("yyyyMMddHHmmssxxx"))
    sn = F.regexp_extract(name, r"_SN_([0-9A-Z]+)_SP\d+", 1)
    return F.named_struct(F.lit("model"), part(1), F.lit("sn"), sn, F.lit("sp"), F.nullif(part(3), F.lit("")).cast("int"), F.lit("dumped"), stamp)


def sn_of(member: Column, archive: Column) -> Column:
    """the serial number from the member's name, the archive's, its folder's, an address in parentheses, else unknown."""
    found = lambda c, p, i=1: F.nullif(F.regexp_extract(c, p, i), F.lit(""))
    folder = F.element_at(F.concat(F.array(F.lit("")), F.split(archive, "/")), -2)
    address = F.replace(found(archive, r"\((\d+\.\d+\.\d+\.\d+)\)"), F.lit("."), F.lit("_"))
    return F.coalesce(found(member, r"_SN_([0-9A-Z]+)_SP\d+"), found(archive, r"_(21[0-9A-Z]{18,})\.(?:zip|7z)$"), found(folder, r"^(21[0-9A-Z]{18,})$"), F.concat(F.lit("UNKNOWN_"), address), F.lit("UNKNOWN_SN"))


def iso(ts: Column) -> Column:
    """UTC text of a timestamp, with a Z."""
    return F.concat(F.date_format(utc_date(ts), "yyyy-MM-dd"), F.lit("T"), _clock(ts), F.lit("Z"))


def us_date(ts: Column) -> Column:
    """as wide exports print it."""
    return F.concat(F.date_format(utc_date(ts), "MM/dd/yy"), F.lit(" "), _clock(ts))


def header_text(name: str) -> str:
    """a column header without commas in ranges."""
    return name.replace(",+∞)", "_+8)").replace(",", "_")


def utc_date(ts: Column) -> Column:
    """The day of a moment in UTC, whatever the session's zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int"))


def _clock(ts: Column) -> Column:
    """HH:mm:ss in UTC."""
    s = F.pmod(F.unix_seconds(ts), F.lit(86_400))
    return F.concat_ws(":", *(F.lpad(F.floor(x).cast("string"), 2, "0") for x in (s / 3600, s % 3600 / 60, s % 60)))


def utc_hour(ts: Column) -> Column:
    """The hour of a moment in UTC, whatever the session's zone is."""
    return F.pmod(F.floor(F.unix_seconds(ts) / 3_600), F.lit(24)).cast("int")


def utc_moment(at) -> Column:
    """A datetime as a moment: naive ones are UTC, whatever the zones of host and session are."""
    at = at.replace(tzinfo=dt.timezone.utc) if at.tzinfo is None else at
    return F.timestamp_micros(F.lit((at - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)))
