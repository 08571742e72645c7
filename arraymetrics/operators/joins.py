"""Names, units, and joins with dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import conversion, sanitise, unit_of


def named_metrics(dim: DataFrame, prefix: str = "") -> DataFrame:
    """The metric dictionary with the sanitised name, worked out once for each entry."""
    return dim.withColumn("metric", sanitise(F.col("display_name"), prefix))


def resolve_names(df: DataFrame, metrics: DataFrame, resources: DataFrame, prefix: str = "") -> DataFrame:
    """Metric and resource names of ids; unknown ids keep theirs in a name of their own. Dictionaries are broadcast if Spark
    finds them small."""
    m, r = named_metrics(metrics, prefix).select("metric_id", "metric"), resources.select("resource_id", "resource")
    unknown = sanitise(F.concat(F.lit("UNKNOWN_METRIC_"), F.col("metric_id")), prefix)
    out = df.drop("metric", "resource").join(m, "metric_id", "left").join(r, "resource_id", "left")
    return out.withColumn("metric", F.coalesce("metric", unknown)).withColumn("resource", F.coalesce("resource", F.concat(F.lit("UNKNOWN_RESOURCE_"), F.col("resource_id"))))


def convert_units(df: DataFrame, metrics: DataFrame) -> DataFrame:
    """Values over their metric's divisor."""
    d = metrics.select("metric_id", F.col("divisor").alias("_divisor"))
    return df.join(d, "metric_id", "left").withColumn("value", F.col("value") / F.coalesce("_divisor", F.lit(1.0))).drop("_divisor")


def skip_existing(archives: DataFrame, points: DataFrame) -> DataFrame:
    """Archives whose array has no points yet; unknown arrays, those without a serial number too, are never skipped."""
    known = points.select(F.col("sn").alias("_sn")).distinct()
    return archives.join(known, (F.col("sn") == F.col("_sn")) & ~F.col("sn").startswith("UNKNOWN_"), "left_anti")


def rename_unknown(points: DataFrame, metrics: DataFrame, drop_old: bool = False) -> DataFrame:
    """Points of metrics named unknown, under the name that the dictionary has by now; the old rows stay unless dropped. All other points stay as they
    are, those without a metric too."""
    named = named_metrics(metrics).select(F.col("metric_id").alias("_id"), F.col("metric").alias("_new"))
    both = points.join(named, (F.col("metric_id") == F.col("_id")) & F.col("metric").startswith("unknown_metric_"), "left")
    kinds = F.array(F.col("_new")) if drop_old else F.array("metric", "_new")
    return both.withColumn("metric", F.explode(F.when(F.col("_new").isNull(), F.array("metric")).otherwise(kinds))).select(*points.columns)


def metric_mapping(metrics: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """The dictionary with names, units and conversions, and whether points have the metric (``-``: not asked)."""
    out = named_metrics(metrics).select("metric_id", "display_name", "metric", unit_of(F.col("metric")).alias("unit"), conversion(F.col("divisor")).alias("conversion"))
    if points is None:
        return out.withColumn("present", F.lit("-"))
    have = points.select("metric_id").distinct().withColumn("_have", F.lit(True))
    return out.join(have, "metric_id", "left").withColumn("present", F.when(F.col("_have"), "yes").otherwise("no")).drop("_have")


def unknown_ids(df: DataFrame, metrics: DataFrame, resources: DataFrame) -> DataFrame:
    """For each file the metric ids and the resource ids that the dictionaries lack."""
    parts = []
    for col, dim in (("metric_id", metrics), ("resource_id", resources)):
        missing = df.join(dim.select(col), col, "left_anti")
        parts.append(missing.groupBy("source_file").agg(F.array_join(F.array_sort(F.collect_set(col)), ",").alias("ids")).withColumn("kind", F.lit(col)))
    return parts[0].unionByName(parts[1])


def dedupe(df: DataFrame, by: str = "source_file") -> DataFrame:
    """H5: one point for each series and moment, that of the last file (or other tie-break)."""
    keys = [c for c in ("sn", "resource_id", "resource", "element", "metric_id", "metric", "scrape_interval", "ts", "dt") if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c != by]
    out = df.groupBy(*keys).agg(F.max(F.struct(F.col(by).alias("_by"), *rest)).alias("_s"))
    return out.select(*(F.col(f"_s.{c}").alias(c) if c in rest else (F.col("_s._by").alias(c) if c == by else F.col(c)) for c in df.columns))


def files_by_sn(files: DataFrame) -> DataFrame:
    """Input files of each array; files without one are left out."""
    from ..functions.names import file_fields

    named = files.withColumn("sn", file_fields(F.col("path"))["sn"]).where("sn <> ''")
    return named.groupBy("sn").agg(F.count("*").alias("n_files"), F.array_sort(F.collect_list("path")).alias("paths"))


def write_mapping(mapping: DataFrame, path: str) -> None:
    """The mapping as CSV with a header and as JSON lines."""
    mapping.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    mapping.write.mode("overwrite").json(f"{path}/json")


def ingest_outcome(points: DataFrame, quarantine: DataFrame, seconds: float) -> DataFrame:
    """Files that gave points, files that failed, points, and points a second."""
    done = points.agg(F.count_distinct("source_file").alias("files_ok"), F.count("*").alias("n_points")).withColumn("_", F.lit(1))
    lost = quarantine.agg(F.count_distinct("path", F.coalesce("member", F.lit(""))).alias("files_failed")).withColumn("_", F.lit(1))
    return done.join(lost, "_").drop("_").withColumn("points_per_second", F.round(F.col("n_points") / F.lit(seconds), 2))


def ingest_summary(points: DataFrame) -> DataFrame:
    """Rows of each file and resource."""
    return points.groupBy("source_file", "resource_id").agg(F.count("*").alias("n_rows"))


def batch_summary(results: DataFrame) -> DataFrame:
    """Of loads (sn, status, n_points, seconds): totals by status and mean time."""
    return results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"), F.count_if(F.col("n_points") > 0).alias("with_data"), F.round(F.avg("seconds"), 9).alias("avg_seconds"),
    )


def merge_by_resource(parts: list[DataFrame], order: list[str]) -> DataFrame:
    """H4: the rows of several files, parted by resource: those of earlier files first, each file's in its own ``order``. ``part`` is the file's number, ``place`` the row's
    number in its resource. No resource meets in one task."""
    from .timegrid import renumber

    out = parts[0].withColumn("part", F.lit(0))
    for n, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("part", F.lit(n)))
    return renumber(out, "resource_id", ["part", *order]).withColumnRenamed("no", "place")


def union_points(*parts: DataFrame) -> DataFrame:
    """H1: the points of several sources, by name of column; columns that some lack are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
