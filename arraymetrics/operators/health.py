"""Hardware health: memory errors, disks, batteries, and a roll-up of all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import band, bbu_status, disk_status, rank
from .select import select_labels

SMART = ("smart_disk_health", "smart_reallocated_sectors", "smart_reallocated_events", "smart_pending_sectors", "smart_offline_uncorrectable", "smart_available_spare", "smart_temperature")
BBU = ("bbu_temperature", "bbu_capacity_percent", "bbu_voltage")


def entity_table(health: DataFrame, key: str, metrics) -> DataFrame:
    """For each entity the last value of each metric, and the moment of the first metric, in the order given, that it has."""
    at = lambda m, c: F.when(F.col("metric") == m, F.col(c))
    rows = health.where(F.col("metric").isin(*metrics) & F.col(key).isNotNull() & F.col("value").isNotNull())
    return rows.groupBy("sn", key).agg(*(F.max_by(at(m, "value"), at(m, "ts")).alias(m) for m in metrics), F.coalesce(*(F.max(at(m, "ts")) for m in metrics)).alias("ts"))


def smart_report(health: DataFrame, sn: str | None = None) -> DataFrame:
    """Disks with their status, worst first (``place``)."""
    t = entity_table(select_labels(health, sn=sn), "disk_id", SMART)
    status = disk_status(F.col("smart_offline_uncorrectable"), F.col("smart_pending_sectors"), F.col("smart_reallocated_sectors"), F.col("smart_reallocated_events"), F.col("smart_disk_health"))
    t = t.withColumn("status", status)
    return t.withColumn("place", F.row_number().over(Window.partitionBy("sn").orderBy(F.desc(rank(F.col("status"))), "disk_id")))


def bbu_report(health: DataFrame, sn: str | None = None) -> DataFrame:
    """D22."""
    t = entity_table(select_labels(health, sn=sn), "bbu_id", BBU)
    return t.withColumn("status", bbu_status(F.col("bbu_temperature"), F.col("bbu_capacity_percent")))


def status_counts(report: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return report.groupBy("sn").agg(F.count("*").alias("total"), n("healthy"), n("warning"), n("critical"))


def _last(health: DataFrame, metric: str, *keys: str) -> DataFrame:
    return health.where((F.col("metric") == metric) & F.col("value").isNotNull()).groupBy("sn", *keys).agg(F.max_by("value", "ts").alias("value"))


def ecc_dimms(health: DataFrame, sn: str | None = None) -> DataFrame:
    """Last count of each memory module, most errors first, with machine checks."""
    h = select_labels(health, sn=sn)
    mce = _last(h, "mce_dimm", "controller", "dimm").select("sn", "controller", "dimm", (F.col("value") > 0).alias("mce"))
    out = _last(h, "ecc_dimm", "controller", "dimm").join(mce, ["sn", "controller", "dimm"], "left").withColumn("mce", F.coalesce("mce", F.lit(False)))
    return out.withColumn("place", F.row_number().over(Window.partitionBy("sn").orderBy(F.desc("value"), "controller", "dimm")))


def ecc_report(health: DataFrame, sn: str | None = None) -> DataFrame:
    """For each array the controllers' totals, modules with errors, and whether a machine check makes it critical."""
    h = select_labels(health, sn=sn)
    total = _last(h, "ecc_total", "controller").groupBy("sn").agg(F.sum("value").alias("ecc_total"))
    dimms = ecc_dimms(h).groupBy("sn").agg(F.count_if(F.col("value") > 0).alias("dimms_with_errors"), F.max("value").alias("worst_dimm"), F.bool_or("mce").alias("has_critical"))
    return total.join(dimms, "sn", "full_outer")


KINDS = {"total": ("ecc_total",), "dimm": ("ecc_dimm", "mce_dimm"), "disk": SMART, "bbu": BBU}


def entities(health: DataFrame) -> DataFrame:
    """For each array, kind (total, dimm, disk, bbu) and entity (k1, k2) the last value of each metric, in one pass over the points. An array that has none of
    these metrics has a row with null kind."""
    kind = F.coalesce(*(F.when(F.col("metric").isin(*names), F.lit(k)) for k, names in KINDS.items()))
    k1 = F.when(kind == "disk", F.col("disk_id")).when(kind == "bbu", F.col("bbu_id")).when(kind.isNotNull(), F.col("controller"))
    rows = health.select("sn", kind.alias("kind"), k1.alias("k1"), F.when(kind == "dimm", F.col("dimm")).alias("k2"), "metric", "value", F.when(F.col("value").isNotNull(), F.col("ts")).alias("ts"))
    at = lambda m, c: F.when(F.col("metric") == m, F.col(c))
    return rows.groupBy("sn", "kind", "k1", "k2").agg(*(F.max_by(at(m, "value"), at(m, "ts")).alias(m) for names in KINDS.values() for m in names))


def judged(health: DataFrame) -> DataFrame:
    """``entities`` with their status, and ``place`` in the order in which they are told: modules by errors, disks by status, batteries of one status by name."""
    e = entities(health)
    disk = disk_status(*(F.col(c) for c in ("smart_offline_uncorrectable", "smart_pending_sectors", "smart_reallocated_sectors", "smart_reallocated_events", "smart_disk_health")))
    known = F.coalesce(*(F.col(m) for m in SMART + BBU)).isNotNull() & F.col("k1").isNotNull()
    status = F.when(known & (F.col("kind") == "disk"), disk).when(known & (F.col("kind") == "bbu"), bbu_status(F.col("bbu_temperature"), F.col("bbu_capacity_percent")))
    e = e.withColumn("status", status).withColumn("errors", F.when(F.col("kind") == "dimm", F.col("ecc_dimm"))).withColumn("mce", F.col("errors").isNotNull() & F.coalesce(F.col("mce_dimm") > 0, F.lit(False)))
    group = F.when(F.col("kind") == "bbu", F.concat(F.lit("bbu "), F.coalesce("status", F.lit("")))).otherwise(F.col("kind"))
    order = [F.coalesce(F.col("errors"), rank(F.col("status")).cast("double")).desc_nulls_last(), "k1", "k2"]
    return e.withColumn("place", F.row_number().over(Window.partitionBy("sn", group).orderBy(*order)))


def _told(e: DataFrame) -> DataFrame:
    """A row for each recommendation: sn, section, place, status, text."""
    module = F.concat_ws("/", "k1", "k2")
    say = lambda when, section, status, text, name: F.when(when, F.struct(F.lit(section).alias("section"), F.lit(status).alias("status"), F.concat(F.lit(text), name).alias("text")))
    of = lambda kind, status: (F.col("kind") == kind) & (F.col("status") == status)
    found = F.array_compact(F.array(
        say(F.col("errors") > 10000, 1, "warning", "Replace memory module ", module), say((F.col("errors") > 1000) & (F.col("errors") <= 10000), 1, "healthy", "Monitor memory module ", module),
        say(F.col("mce"), 2, "critical", "Machine check on memory module ", module), say(of("disk", "critical"), 3, "critical", "Replace disk ", F.col("k1")), say(of("disk", "warning"), 4, "warning", "Watch disk ", F.col("k1")),
        say(of("bbu", "critical"), 5, "critical", "Replace battery ", F.col("k1")), say(of("bbu", "warning"), 6, "warning", "Watch battery ", F.col("k1")),
    ))
    return e.select("sn", "place", F.explode(found).alias("r")).select("sn", "r.section", "place", "r.status", "r.text")


def recommendations(health: DataFrame) -> DataFrame:
    """sn, section, place, status and text; memory first, then machine checks, disks, batteries."""
    return _told(judged(health))


def health_summary(health: DataFrame, most: int = 10) -> DataFrame:
    """For each array the worst status, the error totals, and up to ``most`` recommendations in order. The points are read and grouped once."""
    e = judged(health)
    first = _told(e).withColumn("no", F.row_number().over(Window.partitionBy("sn").orderBy("section", "place", "text"))).where(F.col("no") <= most)
    texts = first.groupBy(F.col("sn").alias("_sn")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "text"))), lambda x: x["text"]), "; ").alias("recommendations"))
    worst = F.greatest(rank(F.col("status")), F.when(F.col("mce"), 2).otherwise(0), F.when(F.col("errors") > 10000, 1).otherwise(0))
    sums = e.groupBy("sn").agg(
        F.max(worst).alias("r"), F.sum(F.when(F.col("kind") == "total", F.col("ecc_total"))).alias("ecc_total"), F.count_if(F.col("errors") > 0).alias("dimms_with_errors"), F.bool_or("mce").alias("mce")
    )
    out = sums.join(texts, F.col("sn").eqNullSafe(F.col("_sn")), "left")
    return out.select(
        "sn", F.element_at(F.array(F.lit("healthy"), F.lit("warning"), F.lit("critical")), F.col("r") + 1).alias("status"), F.coalesce("ecc_total", F.lit(0.0)).alias("ecc_total"),
        "dimms_with_errors", "mce", F.coalesce("recommendations", F.lit("")).alias("recommendations"),
    )


def bands(health: DataFrame) -> DataFrame:
    """colour of the last value of every health series."""
    keys = ["sn", "metric", "controller", "dimm", "disk_id", "bbu_id"]
    rows = health.where(F.col("value").isNotNull()).groupBy(*keys).agg(F.max_by("value", "ts").alias("value"))
    return rows.withColumn("colour", band(F.col("metric"), F.col("value")))
