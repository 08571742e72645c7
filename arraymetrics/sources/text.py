"""Text formats of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import header_text, iso, us_date
from ..operators.timegrid import renumber
from .config import Wide, seed_wide

LONG_CSV = "resource string, metric string, element string, value double, time string, unix_time double"
SERIES_JSON = "metric map<string,string>, values array<double>, timestamps array<bigint>"


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def exposition(df: DataFrame) -> DataFrame:
    """``name{Element="..",Resource="..",SN="..",scrape_interval=".."} value ts_ms``, a line for each point."""
    label = lambda n, c: F.concat(F.lit(f'{n}="'), _escaped(F.col(c).cast("string")), F.lit('"'))
    labels = F.concat_ws(",", label("Element", "element"), label("Resource", "resource"), label("SN", "sn"), label("scrape_interval", "scrape_interval"))
    return df.select(F.concat(F.col("metric"), F.lit("{"), labels, F.lit("} "), F.col("value").cast("string"), F.lit(" "), F.unix_millis("ts").cast("string")).alias("value"))


def write_exposition(df: DataFrame, path: str, compression: str | None = None) -> None:
    """A8, A12."""
    exposition(df).write.option("compression", compression or "none").text(path)


def read_exposition(spark: SparkSession, path: str) -> DataFrame:
    """Lines that aren't in the format are left out."""
    v = F.col("value")
    label = lambda n: F.replace(F.replace(F.regexp_extract(v, rf'[{{,]{n}="((?:[^"\\]|\\.)*)"', 1), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    tail = lambda i: F.regexp_extract(v, r"\} (\S+) (-?\d+)$", i)
    rows = spark.read.text(path).where(v.rlike(r"^[A-Za-z_][^{]*\{.*\} \S+ -?\d+$"))
    return rows.select(
        F.regexp_extract(v, r"^([^{]+)\{", 1).alias("metric"), label("Element").alias("element"), label("Resource").alias("resource"), label("SN").alias("sn"),
        label("scrape_interval").cast("int").alias("scrape_interval"), tail(1).cast("double").alias("value"), F.timestamp_millis(tail(2).cast("long")).alias("ts"),
    )


def long_csv(df: DataFrame) -> DataFrame:
    """A10: the columns of the long CSV, with sn to part the files by."""
    return df.select("sn", "resource", "metric", "element", "value", iso(F.col("ts")).alias("time"), (F.unix_millis("ts") / 1000).alias("unix_time"))


def write_long_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    long_csv(df).write.option("sep", ";").option("compression", compression or "none").partitionBy("sn").csv(path)


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LONG_CSV + ", sn string").option("sep", ";").csv(path)


def wide_meta(df: DataFrame, w: Wide) -> DataFrame:
    """Begin, end and the meta columns of one resource's rows; a slot is the element without ``CTE`` and dashes."""
    slot = F.translate(F.replace("element", F.lit("CTE"), F.lit("")), "-", "")
    rules = {"@sn": F.col("sn"), "@element": F.col("element"), "@slot": slot}
    at = us_date(F.col("ts"))
    return df.withColumns({"BgnDateTime": at, "EndDateTime": at} | {f"meta_{n}": rules.get(v, F.lit(v)) for n, v in w.meta})


def wide_rows(df: DataFrame, wides: list[Wide], fill: str = "0") -> DataFrame:
    """For each resource, array, element and moment the values of the exported metrics (a map of texts), numbered in each resource by time and
    element. All resources are grouped in one shuffle and numbered in one deal."""
    pairs = df.sparkSession.createDataFrame([(w.resource_id, m) for w in wides for m, _ in w.metrics], "resource_id string, metric_id string")
    keys = ["resource_id", "sn", "element", "ts"]
    own = df.join(F.broadcast(pairs), ["resource_id", "metric_id"], "left_semi").groupBy(*keys, "metric_id").agg(F.max("value").alias("v"))
    rows = own.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("metric_id", F.coalesce(F.col("v").cast("string"), F.lit(fill))))).alias("values"))
    return renumber(rows, "resource_id", ["ts", "element", "sn"])


def wide(rows: DataFrame, w: Wide, fill: str = "0") -> DataFrame:
    """One resource's file out of ``wide_rows``. Names of columns are those of the file's header, in which they may repeat."""
    own = wide_meta(rows.where(F.col("resource_id") == w.resource_id), w)
    metrics = [F.coalesce(F.try_element_at("values", F.lit(m)), F.lit(fill)).alias(header_text(n)) for m, n in w.metrics]
    return own.select(F.lit(w.prefix).alias(w.prefix), F.col("no").alias("#"), "BgnDateTime", "EndDateTime", *(F.col(f"`meta_{n}`").alias(n) for n, _ in w.meta), *metrics)


def write_wide_csv(df: DataFrame, path: str, compression: str | None = None, wides: list[Wide] | None = None, fill: str = "0") -> None:
    """One dataset with a header for each resource; ``wides`` are those of ``config.load_wide``, by default the seed's."""
    wides = seed_wide() if wides is None else wides
    rows = wide_rows(df, wides, fill)
    for w in wides:
        wide(rows, w, fill).write.option("header", True).option("compression", compression or "none").mode("overwrite").csv(f"{path}/{w.file}")


def series_json(df: DataFrame) -> DataFrame:
    """One row for each series and day, so that no series is one value without bound."""
    names = ["sn", "resource", "element", "scrape_interval"]
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    rows = df.groupBy(F.col("metric").alias("_m"), *names, F.to_date("ts").alias("_day")).agg(F.array_sort(F.collect_list(F.struct(F.unix_millis("ts").alias("t"), F.col("value").alias("v")))).alias("s"))
    return rows.select(F.create_map(F.lit("__name__"), F.col("_m"), *pairs).alias("metric"), F.col("s.v").alias("values"), F.col("s.t").alias("timestamps"))


def export_series_json(df: DataFrame, path: str) -> None:
    series_json(df).write.json(path)


def import_series_json(spark: SparkSession, path: str) -> DataFrame:
    """A14."""
    rows = spark.read.schema(SERIES_JSON).json(path).select("metric", F.explode(F.arrays_zip("values", "timestamps")).alias("p"))
    m = F.col("metric")
    return rows.select(m["__name__"].alias("metric"), m["sn"].alias("sn"), m["resource"].alias("resource"), m["element"].alias("element"), m["scrape_interval"].cast("int").alias("scrape_interval"), F.col("p.values").alias("value"), F.timestamp_millis("p.timestamps").alias("ts"))
