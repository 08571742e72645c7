"""Tables that users supply: dictionaries, conversions, and the columns of wide exports; read, checked, and refused with all that is wrong."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import METRICS, RESOURCES, WIDE, WIDE_META

#: Columns of a configuration, which the driver holds.
MOST_COLUMNS = 100_000
#: What a meta column can hold beside a constant.
RULES = ("@sn", "@element", "@slot")


class BadConfiguration(ValueError):
    """A table that can't be used; the message has a line for each fault."""


@dataclass(frozen=True)
class Wide:
    """The wide export of one resource: its file, the prefix of its rows, meta columns (name, constant or rule) and metrics (id, header), both in order."""

    resource_id: str
    file: str
    prefix: str
    meta: tuple[tuple[str, str], ...]
    metrics: tuple[tuple[str, str], ...]


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _faults(df: DataFrame, key: list[str], name: str, wrong: Column) -> list[str]:
    """Rows that are wrong and keys that stand twice; 20 of each are told."""
    bad = [f"{name}: {tuple(r)}" for r in df.where(wrong).limit(20).collect()]
    return bad + [f"{name}: {tuple(r)[:-1]} stands {r['count']} times" for r in df.groupBy(*key).count().where("count > 1").limit(20).collect()]


def load_dims(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The metric and resource dictionaries in ``path``: metrics.csv (metric_id, display_name, divisor), resources.csv (resource_id, resource) and, if it is there,
    conversions.csv (metric_id, divisor), which overrides. A metric without a divisor is not converted. Ids must be there once, with a name, and divisors above 0."""
    metrics = _csv(spark, f"{path}/metrics.csv", "metric_id string, display_name string, divisor double")
    resources = _csv(spark, f"{path}/resources.csv", "resource_id string, resource string")
    faults = _faults(metrics, ["metric_id"], "metrics", F.col("metric_id").isNull() | F.col("display_name").isNull() | (F.col("divisor") <= 0) | F.isnan("divisor"))
    faults += _faults(resources, ["resource_id"], "resources", F.col("resource_id").isNull() | F.col("resource").isNull())
    if _exists(spark, f"{path}/conversions.csv"):
        own = _csv(spark, f"{path}/conversions.csv", "metric_id string, divisor double")
        faults += _faults(own, ["metric_id"], "conversions", F.col("metric_id").isNull() | F.col("divisor").isNull() | (F.col("divisor") <= 0) | F.isnan("divisor"))
        metrics = metrics.join(own.withColumnRenamed("divisor", "_own"), "metric_id", "left").select("metric_id", "display_name", F.coalesce("_own", "divisor").alias("divisor"))
    if faults:
        raise BadConfiguration("\n".join(faults))
    return metrics.withColumn("divisor", F.coalesce("divisor", F.lit(1.0))), resources


def load_wide(spark: SparkSession, path: str, metrics: DataFrame) -> list[Wide]:
    """The wide exports in ``path``: wide_resources.csv (resource_id, file, prefix) and wide_columns.csv (resource_id, place, kind, name, value), whose columns
    stand in order of ``place``: of kind ``meta`` with a name and a constant or one of RULES, or of kind ``metric`` with a metric's id as name. Headers of metrics come from
    the dictionary; ids that it lacks are named unknown. Metrics follow meta columns, whatever their places."""
    files = _csv(spark, f"{path}/wide_resources.csv", "resource_id string, file string, prefix string")
    columns = _csv(spark, f"{path}/wide_columns.csv", "resource_id string, place int, kind string, name string, value string")
    faults = _faults(files, ["resource_id"], "wide_resources", F.col("resource_id").isNull() | F.col("file").isNull() | F.col("prefix").isNull())
    rule = F.col("value").startswith("@") & ~F.col("value").isin(*RULES)
    wrong = F.col("resource_id").isNull() | F.col("place").isNull() | F.col("name").isNull() | ~F.coalesce(F.col("kind").isin("meta", "metric"), F.lit(False)) | (F.col("kind") == "meta") & (F.col("value").isNull() | rule)
    faults += _faults(columns, ["resource_id", "place"], "wide_columns", wrong) + _faults(columns, ["resource_id", "kind", "name"], "wide_columns", F.lit(False))
    faults += [f"wide_columns: no resource {r[0]}" for r in columns.join(files, "resource_id", "left_anti").select("resource_id").distinct().limit(20).collect()]
    faults += [f"wide_resources: {r[0]} has no metric" for r in files.join(columns.where("kind = 'metric'"), "resource_id", "left_anti").select("resource_id").limit(20).collect()]
    if not faults and columns.count() > MOST_COLUMNS:
        faults.append(f"wide_columns: over {MOST_COLUMNS} columns")
    if faults:
        raise BadConfiguration("\n".join(faults))
    named = columns.join(metrics.select(F.col("metric_id").alias("name"), "display_name"), "name", "left").collect()
    own: dict[str, list] = {}
    for r in sorted(named, key=lambda r: r.place):
        own.setdefault(r.resource_id, []).append(r)
    return [
        Wide(f.resource_id, f.file, f.prefix, tuple((r.name, r.value) for r in own[f.resource_id] if r.kind == "meta"), tuple((r.name, r.display_name or f"UNKNOWN_METRIC_{r.name}") for r in own[f.resource_id] if r.kind == "metric"))
        for f in files.orderBy("resource_id").collect()
    ]


def write_seed(spark: SparkSession, path: str) -> None:
    """The seed dictionaries and wide exports as the tables that ``load_dims`` and ``load_wide`` read: a pattern to fill in."""
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).option("escape", '"').csv(f"{path}/{name}")
    put([(m, n) for m, n, _ in METRICS], "metric_id string, display_name string", "metrics.csv")
    put([(m, d) for m, _, d in METRICS if d != 1.0], "metric_id string, divisor double", "conversions.csv")
    put(RESOURCES, "resource_id string, resource string", "resources.csv")
    put([(r, f, p) for r, f, p, _ in WIDE_META], "resource_id string, file string, prefix string", "wide_resources.csv")
    columns = [(r, n, "meta", name, value) for r, _, _, meta in WIDE_META for n, (name, value) in enumerate(meta)]
    columns += [(r, 100 + n, "metric", m, None) for r, ids in WIDE.items() for n, m in enumerate(ids)]
    put(columns, "resource_id string, place int, kind string, name string, value string", "wide_columns.csv")


def seed_wide() -> list[Wide]:
    """The seed's wide exports, without files."""
    names = {m: n for m, n, _ in METRICS}
    return [Wide(r, f, p, tuple(meta), tuple((m, names[m]) for m in WIDE[r])) for r, f, p, meta in sorted(WIDE_META)]
