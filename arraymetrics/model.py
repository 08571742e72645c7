"""Schemas and the small fixed tables of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POINTS = "sn string, resource_id string, resource string, element string, metric_id string, metric string, ts timestamp, value double, scrape_interval int, source_file string, dt date"
SERIES = ["sn", "resource", "element", "metric_id", "metric", "scrape_interval"]
QUARANTINE = "path string, member string, reason string, detail string, attempt int"

#: Kpi, metric id, unit, divisor applied when a report is made.
KPIS = [
    ("cpu", "68", "%", 1.0),
    ("bandwidth_read", "23", "MB/s", 1.0),
    ("bandwidth_write", "26", "MB/s", 1.0),
    ("latency_read", "384", "ms", 1000.0),
    ("latency_write", "385", "ms", 1000.0),
    ("iops_read", "25", "IO/s", 1.0),
    ("iops_write", "28", "IO/s", 1.0),
    ("rw_ratio", "265", "%", 1.0),
    ("cache", "69", "%", 1.0),
]

#: Seed of the dictionaries that users supply: metric id, display name, divisor.
METRICS = [
    ("68", "Avg. CPU usage (%)", 1.0),
    ("23", "Read Bandwidth (MB/s)", 1.0),
    ("26", "Write Bandwidth (MB/s)", 1.0),
    ("384", "Avg. Read I/O Response Time(us)", 1.0),
    ("385", "Avg. Write I/O Response Time(us)", 1.0),
    ("25", "Read IOPS (IO/s)", 1.0),
    ("28", "Write IOPS (IO/s)", 1.0),
    ("265", "Read Ratio (%)", 1.0),
    ("69", "Cache Usage (%)", 1.0),
    ("22", "Throughput IOPS(IO/s)", 1.0),
    ("511", "Link Bandwidth (KB/s)", 1024.0),
    ("1164", "Total Capacity (GB)", 1.0 / 1024.0),
    ("1090", "Service Time(us)", 1000.0),
    ("1629", "Read Bandwidth (MB/s)", 1.0),
]
RESOURCES = [("207", "Controller"), ("10", "Disk"), ("11", "LUN"), ("21", "Host"), ("212", "FC port"), ("216", "Storage pool"), ("225", "File system"), ("266", "Disk domain")]

#: Wide export, fixed values: resource id, file, row prefix, and the meta columns with a constant, or @ and where the value comes from.
WIDE_META = [
    ("207", "cpu_output.csv", "CPUPERF", [("Serial", "@sn"), ("Slot", "@slot"), ("Type", "'CPU'")]),
    ("10", "disk_output.csv", "RGPERF", [("Serial", "@sn"), ("MpCnt", "'1'"), ("Rg", "@element"), ("PgCnt", "'1'"), ("LdCnt", "'1'"), ("Alias", "'-'")]),
    ("11", "lun_output.csv", "LDEVPERF", [("Serial", "@sn"), ("DefMp", "'?'"), ("DaCnt", "'1'"), ("Rg", "'01-01'"), ("Ld", "@element"), ("Alias", "'-'")]),
    ("21", "host_output.csv", "HAPERF", [("Serial", "@sn"), ("DefMp", "'1'"), ("DaCnt", "'1'"), ("RgCnt", "'1'"), ("PgCnt", "'1'"), ("Alias", "@element")]),
    ("212", "fcp_output.csv", "PORTPERF", [("Serial", "@sn"), ("Slot", "'1'"), ("Port", "@element"), ("Mode", "'Tgt'"), ("Alias", "'---'")]),
    ("216", "pool_output.csv", "POOLPERF", [("Serial", "@sn"), ("Mode", "'AOU'"), ("Alias", "@element"), ("State", "'POLN'"), ("Alias2", "@element")]),
    ("266", "disk_domain_output.csv", "DISKDOMAIN", [("Serial", "@sn"), ("Domain", "@element"), ("Alias", "@element")]),
    ("225", "fc_repl_link_output.csv", "FCREPLLINK", [("Serial", "@sn"), ("Link", "@element"), ("Alias", "@element")]),
]
#: Ordered metric ids of each: a seed; users hand in their own (``config.load_wide``).
WIDE = {"207": ["68", "22", "511"], "10": ["22", "384", "1090"], "11": ["22", "384", "1164", "1090"], "21": ["22", "384"], "212": ["511", "22"], "216": ["1164", "22"], "266": ["22"], "225": ["511"]}

#: model, kpi, warning, critical.
THRESHOLDS = [("SN00", "cpu", 300.0, 420.0), ("_default", "cpu", 350.0, 450.0), ("_default", "bandwidth_read", 300.0, 480.0), ("_default", "latency_read", 0.3, 0.46)]


def kpi_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KPIS, "kpi string, metric_id string, unit string, divisor double")


def metric_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRICS, "metric_id string, display_name string, divisor double")


def resource_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RESOURCES, "resource_id string, resource string")


def wide_dim(spark: SparkSession) -> DataFrame:
    rows = [(r, m, i) for r, ids in WIDE.items() for i, m in enumerate(ids)]
    return spark.createDataFrame(rows, "resource_id string, metric_id string, place int")


def threshold_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "model string, kpi string, warning double, critical double")
