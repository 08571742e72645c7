"""Test tables as the engine's tables, in Spark and, for the oracle, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_METRIC = {"click": "68", "view": "23", "purchase": "26", "signup": "384", "error": "385"}
_RESOURCE = {1: "207", 2: "10", 3: "11", 4: "21", 5: "212", 6: "216"}
_FLAGS = {"AF": "22", "NO": "511", "RF": "384", "AO": "1164", "NF": "1090"}


def _case(c, pairs: dict, default: str):
    out = F.lit(default)
    for k, v in pairs.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from ``events``."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    metric_id = _case(F.col("event_type"), _METRIC, "68")
    names = _case(metric_id, {"68": "avg_cpu_usage_percent", "23": "read_bandwidth_mb_s", "26": "write_bandwidth_mb_s", "384": "avg_read_i_o_response_timeus"}, "avg_write_i_o_response_timeus")
    return e.select(
        F.concat(F.lit("SN"), F.lpad((F.col("user_id") % 8).cast("string"), 2, "0")).alias("sn"), F.lit("207").alias("resource_id"), F.lit("Controller").alias("resource"),
        F.concat(F.lit("CTE"), F.expr("user_id div 8").cast("string")).alias("element"), metric_id.alias("metric_id"), names.alias("metric"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("value"), F.when(F.col("user_id") % 2 == 0, 60).otherwise(300).alias("scrape_interval"),
        F.concat(F.lit("f"), (F.col("event_id") % 16).cast("string")).alias("source_file"), F.to_date("ts").alias("dt"),
    )


def raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with ids only from ``lineitem``; ``tie`` orders points of one series and moment."""
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return x.select(
        F.concat(F.lit("SN"), F.lpad((F.col("l_suppkey") % 8).cast("string"), 2, "0")).alias("sn"), _case(F.col("l_linenumber"), _RESOURCE, "99").alias("resource_id"),
        F.concat(F.lit("E"), (F.col("l_suppkey") % 10).cast("string")).alias("element"), _case(F.concat("l_returnflag", "l_linestatus"), _FLAGS, "98765").alias("metric_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"), F.floor("l_extendedprice").cast("double").alias("value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tie"),
        F.concat(F.lit("f"), (F.col("l_orderkey") % 16).cast("string")).alias("source_file"),
    )


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health series: disks and batteries from ``events``, memory from ``lineitem``."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    no = F.lit(None).cast("string")
    sn = F.concat(F.lit("SN"), F.lpad((F.col("user_id") % 8).cast("string"), 2, "0"))
    k, r = F.col("k"), F.col("event_id") % 7
    smart = [
        ("smart_disk_health", 40 + 0.6 * k), ("smart_reallocated_sectors", 1.2 * k), ("smart_reallocated_events", 0.6 * k), ("smart_pending_sectors", F.greatest(F.lit(0), k - 88)),
        ("smart_offline_uncorrectable", F.when(k >= 95, 1).otherwise(0)), ("smart_available_spare", k), ("smart_temperature", 20 + k % 30),
    ]
    bbu = [("bbu_temperature", 25 + k / 4), ("bbu_capacity_percent", F.least(F.lit(100), k + 20)), ("bbu_voltage", 11 + k / 100)]

    def pick(rules, c, what):
        out = F.lit(None)
        for i, rule in enumerate(rules):
            out = F.when(c == i, rule[what] if what else F.lit(rule[0])).otherwise(out)
        return out

    ts = F.col("ts").cast("timestamp").alias("ts")
    disks = e.select(sn.alias("sn"), pick(smart, r, 0).alias("metric"), no.alias("controller"), no.alias("dimm"), F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("disk_id"), no.alias("bbu_id"), ts, pick(smart, r, 1).cast("double").alias("value"))
    r3 = F.col("event_id") % 3
    bbus = e.select(sn.alias("sn"), pick(bbu, r3, 0).alias("metric"), no.alias("controller"), no.alias("dimm"), no.alias("disk_id"), F.concat(F.lit("B"), (F.col("user_id") % 4).cast("string")).alias("bbu_id"), ts, pick(bbu, r3, 1).cast("double").alias("value"))
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # dates repeat: a few microseconds tell the rows of one date apart
    at = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    base = x.select(
        F.concat(F.lit("SN"), F.lpad((F.col("l_suppkey") % 8).cast("string"), 2, "0")).alias("sn"), F.concat(F.lit("C"), (F.col("l_linenumber") % 2).cast("string")).alias("controller"),
        F.concat(F.lit("DIMM"), (F.col("l_partkey") % 12).cast("string")).alias("dimm"), at.alias("ts"), (F.col("l_quantity") * 300).alias("q"), F.floor("l_extendedprice").cast("double").alias("p"), F.when(F.col("l_discount") >= 0.1, 1.0).otherwise(0.0).alias("m"),
    )
    memory = lambda metric, dimm, v: base.select("sn", F.lit(metric).alias("metric"), "controller", dimm.alias("dimm"), no.alias("disk_id"), no.alias("bbu_id"), "ts", F.col(v).cast("double").alias("value"))
    return disks.unionByName(bbus).unionByName(memory("ecc_dimm", F.col("dimm"), "q")).unionByName(memory("ecc_total", no, "p")).unionByName(memory("mce_dimm", F.col("dimm"), "m"))


_SN = "'SN' || lpad(CAST({} % 8 AS VARCHAR), 2, '0')"
POINTS_SQL = f"""points AS (
  SELECT {_SN.format("user_id")} AS sn, '207' AS resource_id, 'Controller' AS resource, 'CTE' || (user_id // 8) AS element,
    CASE event_type WHEN 'click' THEN '68' WHEN 'view' THEN '23' WHEN 'purchase' THEN '26' WHEN 'signup' THEN '384' ELSE '385' END AS metric_id,
    CASE event_type WHEN 'click' THEN 'avg_cpu_usage_percent' WHEN 'view' THEN 'read_bandwidth_mb_s' WHEN 'purchase' THEN 'write_bandwidth_mb_s'
      WHEN 'signup' THEN 'avg_read_i_o_response_timeus' ELSE 'avg_write_i_o_response_timeus' END AS metric,
    ts, value, CASE WHEN user_id % 2 = 0 THEN 60 ELSE 300 END AS scrape_interval, 'f' || (event_id % 16) AS source_file
  FROM events),
kpis AS (SELECT * FROM (VALUES ('cpu','68','%',1.0),('bandwidth_read','23','MB/s',1.0),('bandwidth_write','26','MB/s',1.0),
  ('latency_read','384','ms',1000.0),('latency_write','385','ms',1000.0)) t(kpi, metric_id, unit, divisor)),
kp AS (SELECT points.* EXCLUDE (value), kpi, unit, value / CAST(divisor AS DOUBLE) AS value FROM points JOIN kpis USING (metric_id))"""
RAW_SQL = f"""raw AS (
  SELECT {_SN.format("l_suppkey")} AS sn,
    CASE l_linenumber WHEN 1 THEN '207' WHEN 2 THEN '10' WHEN 3 THEN '11' WHEN 4 THEN '21' WHEN 5 THEN '212' WHEN 6 THEN '216' ELSE '99' END AS resource_id,
    'E' || (l_suppkey % 10) AS element,
    CASE l_returnflag || l_linestatus WHEN 'AF' THEN '22' WHEN 'NO' THEN '511' WHEN 'RF' THEN '384' WHEN 'AO' THEN '1164' WHEN 'NF' THEN '1090' ELSE '98765' END AS metric_id,
    l_shipdate AS ts, floor(l_extendedprice) AS value, l_orderkey * 10 + l_linenumber AS tie, 'f' || (l_orderkey % 16) AS source_file
  FROM lineitem),
dim_metric AS (SELECT metric_id, display_name, CAST(divisor AS DOUBLE) AS divisor FROM (VALUES ('68','Avg. CPU usage (%)',1.0),('23','Read Bandwidth (MB/s)',1.0),('26','Write Bandwidth (MB/s)',1.0),
  ('384','Avg. Read I/O Response Time(us)',1.0),('385','Avg. Write I/O Response Time(us)',1.0),('25','Read IOPS (IO/s)',1.0),('28','Write IOPS (IO/s)',1.0),
  ('265','Read Ratio (%)',1.0),('69','Cache Usage (%)',1.0),('22','Throughput IOPS(IO/s)',1.0),('511','Link Bandwidth (KB/s)',1024.0),
  ('1164','Total Capacity (GB)',1.0/1024),('1090','Service Time(us)',1000.0),('1629','Read Bandwidth (MB/s)',1.0)) t(metric_id, display_name, divisor)),
dim_resource AS (SELECT * FROM (VALUES ('207','Controller'),('10','Disk'),('11','LUN'),('21','Host'),('212','FC port'),('216','Storage pool'),('225','File system'),('266','Disk domain')) t(resource_id, resource)),
names AS (SELECT metric_id, display_name, divisor, {{sanitise}} AS metric FROM dim_metric)"""


def sanitise_sql(c: str) -> str:
    c = f"replace({c}, '(%)', 'percent')"
    c = f"translate({c}, '/-().,:[]', '__')"
    c = f"replace(replace(replace({c}, '+∞', 'inf'), '+', 'plus'), '∞', 'inf')"
    c = f"regexp_replace(lower({c}), '\\s+', '_', 'g')"
    return f"regexp_replace(regexp_replace({c}, '_+', '_', 'g'), '^_|_$', '', 'g')"


RAW_SQL = RAW_SQL.format(sanitise=sanitise_sql("display_name"))
HEALTH_SQL = f"""ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, {_SN.format("user_id")} AS sn FROM events),
li AS (SELECT *, {_SN.format("l_suppkey")} AS sn, 'C' || (l_linenumber % 2) AS controller, 'DIMM' || (l_partkey % 12) AS dimm,
  l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber) AS moment FROM lineitem),
health AS (
  SELECT sn, CASE event_id % 7 WHEN 0 THEN 'smart_disk_health' WHEN 1 THEN 'smart_reallocated_sectors' WHEN 2 THEN 'smart_reallocated_events'
      WHEN 3 THEN 'smart_pending_sectors' WHEN 4 THEN 'smart_offline_uncorrectable' WHEN 5 THEN 'smart_available_spare' ELSE 'smart_temperature' END AS metric,
    CAST(NULL AS VARCHAR) AS controller, CAST(NULL AS VARCHAR) AS dimm, 'D' || user_id AS disk_id, CAST(NULL AS VARCHAR) AS bbu_id, ts,
    CAST(CASE event_id % 7 WHEN 0 THEN 40 + CAST(0.6 AS DOUBLE) * k WHEN 1 THEN CAST(1.2 AS DOUBLE) * k WHEN 2 THEN CAST(0.6 AS DOUBLE) * k WHEN 3 THEN greatest(0, k - 88)
      WHEN 4 THEN CASE WHEN k >= 95 THEN 1 ELSE 0 END WHEN 5 THEN k ELSE 20 + k % 30 END AS DOUBLE) AS value FROM ev
  UNION ALL
  SELECT sn, CASE event_id % 3 WHEN 0 THEN 'bbu_temperature' WHEN 1 THEN 'bbu_capacity_percent' ELSE 'bbu_voltage' END, NULL, NULL, NULL, 'B' || (user_id % 4), ts,
    CAST(CASE event_id % 3 WHEN 0 THEN 25 + k / 4 WHEN 1 THEN least(100, k + 20) ELSE 11 + k / 100 END AS DOUBLE) FROM ev
  UNION ALL SELECT sn, 'ecc_dimm', controller, dimm, NULL, NULL, moment, l_quantity * 300 FROM li
  UNION ALL SELECT sn, 'ecc_total', controller, NULL, NULL, NULL, moment, floor(l_extendedprice) FROM li
  UNION ALL SELECT sn, 'mce_dimm', controller, dimm, NULL, NULL, moment, CASE WHEN l_discount >= 0.1 THEN 1.0 ELSE 0.0 END FROM li)"""
