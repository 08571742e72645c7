"""One query for each operator that the supplied tables can feed, with the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, rules
from ..model import metric_dim, resource_dim, wide_dim
from ..operators import coverage, health, joins, reports, select, stats, timegrid
from ..sources import config, scratch, store, text
from . import adapters
from .adapters import HEALTH_SQL, POINTS_SQL, RAW_SQL, sanitise_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_START, _END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20)
_SERIES = "sn, resource, element, metric_id, metric, scrape_interval"


def _flat(df: DataFrame) -> DataFrame:
    """Moments as microseconds, so that both engines return the same type."""
    return df.select(*(F.unix_micros(c).alias(c) if t == "timestamp" else F.col(f"`{c}`") for c, t in df.dtypes))


def _add(name: str, table: str, f, sql: str | None) -> None:
    read = {"points": adapters.points, "raw": adapters.raw_points, "health": adapters.health}[table]
    cte = {"points": POINTS_SQL, "raw": RAW_SQL, "health": HEALTH_SQL}[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(f(read(spark, sf_dir)))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        ORACLE_SQL[name] = f"WITH {cte}{sql if sql.lstrip().startswith(',') else ' ' + sql}"


def _agg(v: str = "value") -> str:
    r = lambda e, n: f"round({e}, 9) AS {n}"
    return ", ".join([r(f"max({v})", '"max"'), r(f"min({v})", '"min"'), r(f"avg({v})", '"avg"'), r(f"quantile_cont({v}, 0.5)", "median"), r(f"quantile_cont({v}, 0.95)", "p95"), f"count({v}) AS n"])


def _dims(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return metric_dim(df.sparkSession), resource_dim(df.sparkSession)


def _named(df: DataFrame) -> DataFrame:
    return joins.resolve_names(df, *_dims(df))


_TS = "epoch_us(ts) AS ts"
_UNKNOWN = sanitise_sql("'UNKNOWN_METRIC_' || raw.metric_id")
_NAMED = f""", named AS (SELECT raw.*, coalesce(names.metric, {_UNKNOWN}) AS metric, coalesce(r.resource, 'UNKNOWN_RESOURCE_' || raw.resource_id) AS resource, coalesce(names.divisor, 1.0) AS divisor
  FROM raw LEFT JOIN names USING (metric_id) LEFT JOIN dim_resource r USING (resource_id))"""

# ---- selection
_add("b01_select_ids", "raw", lambda d: select.select_ids(d, ["207", "10", "99"], ["22", "511", "98765"], False, (_dims(d)[1], _dims(d)[0])).select("sn", "resource_id", "metric_id", "tie", "value"),
     "SELECT sn, resource_id, metric_id, tie, value FROM raw WHERE resource_id IN ('207', '10') AND metric_id IN ('22', '511')")
_add("b03_invalid_ids", "raw", lambda d: select.invalid_ids(d.select("metric_id").distinct(), metric_dim(d.sparkSession), "metric_id"), "SELECT DISTINCT metric_id FROM raw WHERE metric_id NOT IN (SELECT metric_id FROM dim_metric)")
_WIDE_SQL = "SELECT resource_id, unnest(ids) AS metric_id FROM (VALUES ('207', ['68','22','511']), ('10', ['22','384','1090']), ('11', ['22','384','1164','1090']), ('21', ['22','384']), ('212', ['511','22']), ('216', ['1164','22']), ('266', ['22']), ('225', ['511'])) t(resource_id, ids)"
_add("b04_select_wide", "raw", lambda d: select.select_wide(d, wide_dim(d.sparkSession)).groupBy("resource_id", "metric_id").agg(F.count("*").alias("n")), f"SELECT resource_id, metric_id, count(*) AS n FROM raw SEMI JOIN ({_WIDE_SQL}) USING (resource_id, metric_id) GROUP BY ALL")
_add("b05_select_labels", "points", lambda d: select.select_labels(d, sn="SN03", element=None).select("sn", "element", "metric", "ts", "value"), f"SELECT sn, element, metric, {_TS}, value FROM points WHERE sn = 'SN03'")
_add("b06_select_health", "health", lambda d: select.select_labels(d, sn="SN01", bbu_id="B1").select("sn", "metric", "ts", "value"), f"SELECT sn, metric, {_TS}, value FROM health WHERE sn = 'SN01' AND bbu_id = 'B1'")
_add("b07_match_labels", "points", lambda d: select.match_labels(d, sn="SN0[1-3]", metric=".*bandwidth.*", element=".+").groupBy("sn", "metric").agg(F.count("*").alias("n")), "SELECT sn, metric, count(*) AS n FROM points WHERE regexp_full_match(sn, 'SN0[1-3]') AND contains(metric, 'bandwidth') GROUP BY ALL")
_add("b08_between", "points", lambda d: select.between(d, "now-20d", "now-10d", dt.datetime(2024, 1, 30)).select("sn", "metric", "element", "ts", "value"), f"SELECT sn, metric, element, {_TS}, value FROM points WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'")
_add("b09_time_of_day", "points", lambda d: select.time_of_day(d, "night").groupBy("sn").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")), "SELECT sn, count(*) AS n, round(sum(value), 4) AS total FROM points WHERE hour(ts) < 5 OR hour(ts) >= 19 GROUP BY sn")
_add("b10_present", "raw", lambda d: select.present(d.withColumn("value", F.when(F.col("value") < 20000, float("nan")).when(F.col("value") < 30000, None).otherwise(F.col("value")))).groupBy("sn").agg(F.count("*").alias("n")), "SELECT sn, count(*) AS n FROM raw WHERE value >= 30000 GROUP BY sn")
_add("b11_nonzero", "health", lambda d: select.nonzero(stats.last_value(d.where("metric = 'smart_pending_sectors'"), keys=["sn", "disk_id"])).select("sn", "disk_id", "value"), "SELECT sn, disk_id, max_by(value, ts) AS value FROM health WHERE metric = 'smart_pending_sectors' GROUP BY ALL HAVING max_by(value, ts) > 0")
_add("b13_search_metrics", "points", lambda d: select.search_metrics(d, "Bandwidth"), "SELECT DISTINCT metric FROM points WHERE contains(lower(metric), 'bandwidth')")


def _meta_lines(d: DataFrame) -> DataFrame:
    """The meta columns of every resource's rows, as one text."""
    parts = []
    for w in config.seed_wide():
        own = text.wide_meta(d.where(F.col("resource_id") == w.resource_id), w)
        parts.append(own.groupBy(F.col("resource_id"), F.lit(w.prefix).alias("prefix"), F.concat_ws(",", *(f"meta_{n}" for n, _ in w.meta)).alias("meta")).agg(F.min("BgnDateTime").alias("first"), F.count("*").alias("n")))
    return functools.reduce(DataFrame.unionAll, parts)


def _with_more(d: DataFrame) -> DataFrame:
    """Raw points with those of the unknown resource dealt to two that the tables lack, and elements named as controllers are."""
    more = F.when(F.col("resource_id") == "99", F.when(F.col("element") < "E5", "266").otherwise("225")).otherwise(F.col("resource_id"))
    return d.withColumn("resource_id", more).withColumn("element", F.concat(F.lit("CTE"), F.col("element"), F.lit("-A")))


_MORE = """, more AS (SELECT * REPLACE (CASE WHEN resource_id = '99' THEN CASE WHEN element < 'E5' THEN '266' ELSE '225' END ELSE resource_id END AS resource_id, 'CTE' || element || '-A' AS element) FROM raw),
cfg AS (SELECT * FROM (VALUES ('207','CPUPERF'),('10','RGPERF'),('11','LDEVPERF'),('21','HAPERF'),('212','PORTPERF'),('216','POOLPERF'),('266','DISKDOMAIN'),('225','FCREPLLINK')) t(resource_id, prefix)),
lines AS (SELECT more.*, prefix, sn || ',' || replace(CASE resource_id WHEN '207' THEN replace(replace(element, 'CTE', ''), '-', '') || ',~CPU~' WHEN '10' THEN '~1~,' || element || ',~1~,~1~,~-~' WHEN '11' THEN '~?~,~1~,~01-01~,' || element || ',~-~'
  WHEN '21' THEN '~1~,~1~,~1~,~1~,' || element WHEN '212' THEN '~1~,' || element || ',~Tgt~,~---~' WHEN '216' THEN '~AOU~,' || element || ',~POLN~,' || element ELSE element || ',' || element END, '~', chr(39)) AS meta FROM more JOIN cfg USING (resource_id))"""
_add("b14_wide_meta", "raw", lambda d: _meta_lines(_with_more(d)), f"{_MORE} SELECT resource_id, prefix, meta, min(strftime(ts, '%m/%d/%y %H:%M:%S')) AS \"first\", count(*) AS n FROM lines GROUP BY ALL")


def _wide_lines(d: DataFrame) -> DataFrame:
    """The lines of all wide files."""
    wides = config.seed_wide()
    rows = text.wide_rows(_with_more(d), wides)
    files = ((w, text.wide(rows, w)) for w in wides)
    return functools.reduce(DataFrame.unionAll, (f.toDF(*(f"c{i}" for i in range(len(f.columns)))).select(F.lit(w.resource_id).alias("resource_id"), F.concat_ws(",", *(F.col(f"c{i}").cast("string") for i in range(len(f.columns)))).alias("line")) for w, f in files))


_add("a11_wide_csv", "raw", _wide_lines,
     f"""{_MORE}, ids AS ({_WIDE_SQL.replace("unnest(ids) AS metric_id", "ids")}), wide AS (SELECT resource_id, prefix, sn, element, lines.ts, meta, map_from_entries(list((metric_id, value))) AS vs
     FROM (SELECT resource_id, prefix, sn, element, ts, meta, metric_id, max(value) AS value FROM lines SEMI JOIN ({_WIDE_SQL}) USING (resource_id, metric_id) GROUP BY ALL) AS lines GROUP BY ALL)
     SELECT resource_id, prefix || ',' || row_number() OVER (PARTITION BY resource_id ORDER BY wide.ts, element, sn) || ',' || strftime(ts, '%m/%d/%y %H:%M:%S') || ',' || strftime(ts, '%m/%d/%y %H:%M:%S') || ',' || meta || ',' || list_aggregate(list_transform(ids, lambda m: coalesce(CAST(vs[m] AS VARCHAR), '0')), 'string_agg', ',') AS line
     FROM wide JOIN ids USING (resource_id)""")
_add("b15_lookup", "raw", lambda d: select.lookup(d, "10", "22", "E3", dt.datetime(1996, 1, 2)).unionByName(select.select_labels(d, resource_id="10", metric_id="22", element="E3")).select("sn", "ts", "value"),
     f"SELECT sn, {_TS}, value FROM raw WHERE resource_id = '10' AND metric_id = '22' AND element = 'E3' UNION ALL SELECT sn, {_TS}, value FROM raw WHERE resource_id = '10' AND metric_id = '22' AND element = 'E3' AND ts = TIMESTAMP '1996-01-02'")

# ---- joins and names
_add("c01_resolve_names", "raw", lambda d: _named(d).groupBy("resource", "metric").agg(F.count("*").alias("n")), f"{_NAMED} SELECT resource, metric, count(*) AS n FROM named GROUP BY ALL")
_add("c02_convert_units", "raw", lambda d: joins.convert_units(d, metric_dim(d.sparkSession)).select("tie", "metric_id", F.round("value", 9).alias("value")), f"{_NAMED} SELECT tie, metric_id, round(value / divisor, 9) AS value FROM named")
_add("c03_add_series", "points", lambda d: stats.add_series(*(stats.avg_over_time(d.where(F.col("metric_id") == m)) for m in ("23", "26"))).withColumn("value", F.round("value", 9)),
     ", a AS (SELECT sn, resource, element, scrape_interval, metric_id, avg(value) AS v FROM points GROUP BY ALL) SELECT x.sn, x.resource, x.element, x.scrape_interval, round(x.v + y.v, 9) AS value FROM a x JOIN a y USING (sn, resource, element, scrape_interval) WHERE x.metric_id = '23' AND y.metric_id = '26'")
_add("c04_compare_arrays", "points", lambda d: reports.compare_arrays(d, "SN01", "SN02", digits=9),
     """, s AS (SELECT kpi, avg(value) FILTER (sn = 'SN01') AS a1, avg(value) FILTER (sn = 'SN02') AS a2, quantile_cont(value, 0.95) FILTER (sn = 'SN01') AS p1, quantile_cont(value, 0.95) FILTER (sn = 'SN02') AS p2 FROM kp WHERE sn IN ('SN01', 'SN02') GROUP BY kpi)
     SELECT kpi, round(a1, 9) AS avg_1, round(a2, 9) AS avg_2, round(p1, 9) AS p95_1, round(p2, 9) AS p95_2, round(100 * (a2 - a1) / nullif(a1, 0), 1) AS avg_diff_percent, round(100 * (p2 - p1) / nullif(p1, 0), 1) AS p95_diff_percent FROM s""")
_add("c05_entity_table", "health", lambda d: health.entity_table(d, "disk_id", health.SMART),
     f", t AS (SELECT sn, disk_id, {', '.join(f'max_by(value, ts) FILTER (metric = {m!r}) AS {m}, max(ts) FILTER (metric = {m!r}) AS t{i}' for i, m in enumerate(health.SMART))} FROM health WHERE disk_id IS NOT NULL GROUP BY ALL) SELECT * EXCLUDE ({', '.join(f't{i}' for i in range(7))}), epoch_us(coalesce({', '.join(f't{i}' for i in range(7))})) AS ts FROM t")


def _expected(d: DataFrame) -> DataFrame:
    more = d.select("resource").distinct().withColumn("metric", F.explode(F.array(*(F.lit(m) for m in ("read_bandwidth_mbs", "queue_length", "cache_hits")))))
    return d.select("resource", "metric").distinct().unionByName(more)


def _available(d: DataFrame) -> DataFrame:
    return d.where("NOT (metric_id = '68' AND resource = 'Controller')")


def _cov(d: DataFrame) -> DataFrame:
    return coverage.coverage(_expected(d), _available(d))


_COV = """, e AS (SELECT DISTINCT resource, metric FROM points UNION SELECT DISTINCT resource, unnest(['read_bandwidth_mbs', 'queue_length', 'cache_hits']) FROM points),
a AS (SELECT DISTINCT resource, metric FROM points WHERE NOT (metric_id = '68' AND resource = 'Controller')),
cov AS (SELECT coalesce(e.resource, a.resource) AS resource, coalesce(e.metric, a.metric) AS metric, CASE WHEN e.metric IS NULL THEN 'extra' WHEN a.metric IS NULL THEN 'missing' ELSE 'ok' END AS status FROM e FULL JOIN a USING (resource, metric))"""
_add("c06_coverage", "points", _cov, f"{_COV} SELECT * FROM cov")
_add("c07_suggest", "points", lambda d: coverage.suggest(_cov(d).where("status = 'missing'"), _available(d), 0.5),
     # the longest common run of two stretches (the first of several), then those of what stands before and behind it
     f"""{_COV.replace(", e AS", ", RECURSIVE_MARK e AS", 1)}, pairs AS (SELECT DISTINCT m.metric AS name, p.metric AS other FROM (SELECT metric FROM cov WHERE status = 'missing') m, (SELECT metric FROM a) p),
     cell AS (SELECT name, other, i, j FROM pairs, unnest(range(1, length(name) + 1)) AS x(i), unnest(range(1, length(other) + 1)) AS y(j) WHERE name[i:i] = other[j:j]),
     isle AS (SELECT *, i - row_number() OVER (PARTITION BY name, other, i - j ORDER BY i) AS g FROM cell),
     run AS (SELECT name, other, i, j, max(i) OVER (PARTITION BY name, other, i - j, g) - i + 1 AS k FROM isle),
     seg AS (SELECT name, other, 1 AS al, length(name) + 1 AS ah, 1 AS bl, length(other) + 1 AS bh, 0 AS k FROM pairs
       UNION ALL
       SELECT name, other, unnest([al, m.k - m.ni]) AS al, unnest([-m.ni, ah]) AS ah, unnest([bl, m.k - m.nj]) AS bl, unnest([-m.nj, bh]) AS bh, unnest([m.k, 0]) AS k
       FROM (SELECT seg.name, seg.other, al, ah, bl, bh, max({{'k': least(run.k, ah - i, bh - j), 'ni': -i, 'nj': -j}}) AS m
             FROM seg JOIN run ON run.name = seg.name AND run.other = seg.other AND i >= al AND i < ah AND j >= bl AND j < bh GROUP BY ALL)),
     score AS (SELECT name, other, 2.0 * sum(k) / (length(name) + length(other)) AS r FROM seg GROUP BY name, other)
     SELECT name AS metric, arg_min(other, (-r, other)) AS suggestion, round(max(r), 6) AS ratio FROM score WHERE r >= 0.5 GROUP BY name""")
ORACLE_SQL["c07_suggest"] = ORACLE_SQL["c07_suggest"].replace("WITH ", "WITH RECURSIVE ", 1).replace("RECURSIVE_MARK ", "", 1)
_add("c08_skip_existing", "points", lambda d: joins.skip_existing(d.select(F.when(F.col("sn") < "SN04", F.col("sn")).otherwise(F.concat(F.lit("UNKNOWN_"), "sn")).alias("sn")).distinct(), d.where("sn < 'SN03'")), "SELECT DISTINCT CASE WHEN sn < 'SN04' THEN sn ELSE 'UNKNOWN_' || sn END AS sn FROM points WHERE sn >= 'SN03'")
_add("c09_rename_unknown", "raw", lambda d: joins.rename_unknown(d.withColumn("metric", F.concat(F.lit("unknown_metric_"), "metric_id")), metric_dim(d.sparkSession), True).groupBy("metric").agg(F.count("*").alias("n")), "SELECT coalesce(names.metric, 'unknown_metric_' || raw.metric_id) AS metric, count(*) AS n FROM raw LEFT JOIN names USING (metric_id) GROUP BY ALL")
_add("c11_with_original", "raw", lambda d: coverage.with_original(_named(d).select("metric").distinct(), metric_dim(d.sparkSession)), f"{_NAMED}, o AS (SELECT metric, min_by(display_name, metric_id) AS display_name FROM names GROUP BY metric) SELECT DISTINCT named.metric, o.display_name, o.display_name IS NOT NULL AS in_dictionary FROM named LEFT JOIN o USING (metric)")


def _loaded(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The dictionaries as a user has them: tables in a folder."""
    path = f"{scratch.shared_dir(spark)}/dims-{uuid.uuid4().hex}"
    config.write_seed(spark, path)
    return config.load_dims(spark, path)


_add("a06_dims_used", "raw", lambda d: joins.named_metrics(_loaded(d.sparkSession)[0]).join(d.groupBy("metric_id").agg(F.count("*").alias("n")), "metric_id"), "SELECT names.*, n FROM names JOIN (SELECT metric_id, count(*) AS n FROM raw GROUP BY ALL) USING (metric_id)")
_add("a08_exposition", "raw", lambda d: text.exposition(_named(d).withColumn("scrape_interval", F.lit(60)).withColumn("value", F.col("value").cast("long"))),
     f"""{_NAMED} SELECT metric || '{{Element="' || element || '",Resource="' || resource || '",SN="' || sn || '",scrape_interval="60"}} ' || CAST(CAST(value AS BIGINT) AS VARCHAR) || ' ' || (epoch_us(ts) // 1000) AS value FROM named""")
_add("a10_long_csv", "points", lambda d: text.long_csv(d).select("sn", "resource", "metric", "element", "value", "time"), "SELECT sn, resource, metric, element, value, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time FROM points")
_add("a15_delete_points", "points", lambda d: store.without(d, (F.col("sn") == "SN02") | (F.col("metric_id") == "26")).groupBy("sn", "metric").agg(F.count("*").alias("n")), "SELECT sn, metric, count(*) AS n FROM points WHERE NOT (sn = 'SN02' OR metric_id = '26') GROUP BY ALL")
_add("a16_metric_mapping", "raw", lambda d: joins.metric_mapping(metric_dim(d.sparkSession), d).select("metric_id", "metric", "conversion", "present"),
     "SELECT metric_id, metric, CASE WHEN divisor = 1 THEN '' WHEN divisor < 1 THEN '×' || CAST(round(1 / divisor) AS BIGINT) ELSE '÷' || CAST(divisor AS BIGINT) END AS conversion, CASE WHEN metric_id IN (SELECT metric_id FROM raw) THEN 'yes' ELSE 'no' END AS present FROM names")

# ---- aggregates
for _label in ("sn", "resource", "element", "metric"):
    _add(f"d01_label_values_{_label}", "points", lambda d, c=_label: stats.label_values(d, c), f"SELECT DISTINCT {_label} FROM points")
_add("d02_series", "points", stats.series, f"SELECT DISTINCT {_SERIES} FROM points")
_add("d02_series_count", "points", stats.series_count, f"SELECT metric, count(*) AS n_series FROM (SELECT DISTINCT {_SERIES} FROM points) GROUP BY metric")
_add("d03_metrics_by_resource", "raw", lambda d: stats.metrics_by_resource(_named(d), "SN02"), f"{_NAMED} SELECT resource, count(*) AS n, string_agg(DISTINCT metric, ',' ORDER BY metric) AS metrics FROM named WHERE sn = 'SN02' GROUP BY resource")
_add("d04_stats", "points", lambda d: stats.stats(d, ["sn", "metric"], digits=9), f"SELECT sn, metric, {_agg()} FROM points GROUP BY ALL")
_add("d05_percentile", "points", lambda d: stats.pct(d, ["sn", "metric"], 0.75).withColumn("value", F.round("value", 9)), "SELECT sn, metric, round(quantile_cont(value, 0.75), 9) AS value FROM points GROUP BY ALL")
_add("d06_upper_median", "points", lambda d: stats.upper_median(d, ["sn", "metric"]), "SELECT sn, metric, percentile_disc(0.5) WITHIN GROUP (ORDER BY value DESC) AS value FROM points GROUP BY ALL")
_add("d07_max_over_time", "points", lambda d: stats.max_over_time(d, ["sn", "metric"]), "SELECT sn, metric, max(value) AS value FROM points GROUP BY ALL")
_add("d08_quantile_over_time", "points", lambda d: stats.quantile_over_time(d, ["sn", "metric"], 0.9).withColumn("value", F.round("value", 9)), f"SELECT sn, metric, round(max(v), 9) AS value FROM (SELECT {_SERIES}, quantile_cont(value, 0.9) AS v FROM points GROUP BY ALL) GROUP BY ALL")
_BAND = """, b AS (SELECT sn, element, scrape_interval, max(value) FILTER (metric_id = '23') + max(value) FILTER (metric_id = '26') AS m, quantile_cont(value, 0.5) FILTER (metric_id = '23') + quantile_cont(value, 0.5) FILTER (metric_id = '26') AS q FROM points WHERE metric_id IN ('23', '26') GROUP BY ALL),
band AS (SELECT sn, round(max(m), 9) AS max_total, round(max(q), 9) AS median_total FROM b GROUP BY sn)"""
_add("d09_bandwidth_total", "points", lambda d: stats.bandwidth_total(d).select("sn", F.round("max_total", 9).alias("max_total"), F.round("median_total", 9).alias("median_total")), f"{_BAND} SELECT * FROM band")
_add("d09_bandwidth_window", "points", lambda d: stats.bandwidth_total(d, dt.datetime(2024, 1, 8, 12), dt.datetime(2024, 1, 15, 6)).select("sn", F.round("max_total", 9).alias("max_total"), F.round("median_total", 9).alias("median_total")),
     f"""{_BAND.replace("WHERE metric_id", "WHERE ts > TIMESTAMP '2024-01-08 06:00:00' AND ts <= TIMESTAMP '2024-01-15 06:00:00' AND metric_id")} SELECT * FROM band""")
_add("d10_avg_over_time", "points", lambda d: stats.avg_over_time(d).withColumn("value", F.round("value", 9)), f"SELECT {_SERIES}, round(avg(value), 9) AS value FROM points GROUP BY ALL")
_add("d11_time_range", "points", stats.time_range, "SELECT sn, epoch_us(min(ts)) // 1000 AS first_ms, epoch_us(max(ts)) // 1000 AS last_ms FROM points GROUP BY sn")
_add("d12_arrays_metadata", "points", stats.arrays_metadata, "SELECT sn, min(scrape_interval) AS scrape_interval, CASE WHEN min(scrape_interval) = 60 THEN '1m' ELSE '5m' END AS label FROM points GROUP BY sn")
_add("d13_last_value", "points", lambda d: stats.last_value(d, _END, F.expr("INTERVAL 10 DAYS")), f"SELECT {_SERIES}, max_by(value, ts) AS value, epoch_us(max(ts)) AS ts FROM points WHERE ts <= TIMESTAMP '2024-01-20' AND ts > TIMESTAMP '2024-01-10' GROUP BY {_SERIES}")
_GRID = f""", g AS (SELECT {_SERIES}, CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-05')) / 3600000000) AS BIGINT) AS bucket, max_by(value, ts) AS value
FROM points WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY ALL), grid AS (SELECT {_SERIES}, epoch_us(TIMESTAMP '2024-01-05') + bucket * 3600000000 AS ts, value FROM g)"""
_add("d14_query_range", "points", lambda d: stats.query_range(d, _START, _END, 3600, 9), f'{_GRID} SELECT {_SERIES}, min_by(value, ts) AS "first", max_by(value, ts) AS "last", {_agg()} FROM grid GROUP BY {_SERIES}')
_HOURS = f""", g AS (SELECT {_SERIES}, CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-05')) / 3600000000) AS BIGINT) AS bucket, max_by(value, ts) AS value
FROM points WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY ALL), kg AS (SELECT sn, kpi, unit, g.value / divisor AS value FROM g JOIN kpis USING (metric_id))"""
_add("d15_array_summary_grid", "points", lambda d: reports.array_summary(d, digits=9, reference=_END, lookback=15), f"{_HOURS}, w AS (SELECT sn, count(DISTINCT resource) AS n_resources, count(DISTINCT metric_id) AS n_metrics, epoch_us(min(ts)) AS first_ts, epoch_us(max(ts)) AS last_ts FROM points GROUP BY sn) SELECT * FROM (SELECT sn, kpi, unit, {_agg()} FROM kg GROUP BY ALL) JOIN w USING (sn)")
_add("d15_array_summary", "points", lambda d: reports.array_summary(d, digits=9), f", w AS (SELECT sn, count(DISTINCT resource) AS n_resources, count(DISTINCT metric_id) AS n_metrics, epoch_us(min(ts)) AS first_ts, epoch_us(max(ts)) AS last_ts FROM points GROUP BY sn) SELECT * FROM (SELECT sn, kpi, unit, {_agg()} FROM kp GROUP BY ALL) JOIN w USING (sn)")
_add("d16_performance_stats", "points", lambda d: reports.performance_stats(d, digits=9), f"SELECT sn, kpi, unit, {_agg()} FROM kp GROUP BY ALL")
_add("d16_performance_stats_day", "points", lambda d: reports.performance_stats(d, start=_START, end=_END, period="day", digits=9), f"SELECT sn, kpi, unit, {_agg()} FROM kp WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND hour(ts) BETWEEN 5 AND 18 GROUP BY ALL")
_IDS = ["22", "384", "511", "1090", "1164"]
_add("d17_to_wide", "raw", lambda d: reports.to_wide(joins.dedupe(d.drop("source_file"), "tie").where(F.col("resource_id") == "10").withColumn("value", F.col("value").cast("long")), _IDS),
     ", u AS (SELECT sn, resource_id, element, metric_id, ts, max_by(value, tie) AS value FROM raw WHERE resource_id = '10' GROUP BY ALL) SELECT sn, resource_id, element, epoch_us(ts) AS ts, " + ", ".join(f"coalesce(CAST(CAST(max(value) FILTER (metric_id = '{i}') AS BIGINT) AS VARCHAR), '0') AS m{i}" for i in _IDS) + " FROM u GROUP BY sn, resource_id, element, u.ts")
_add("d18_day_night", "points", lambda d: reports.day_night_report(d, digits=9), "SELECT sn, kpi, CASE WHEN hour(ts) BETWEEN 5 AND 18 THEN 'day' ELSE 'night' END AS daypart, round(max(value), 9) AS \"max\", round(quantile_cont(value, 0.95), 9) AS p95, round(percentile_disc(0.5) WITHIN GROUP (ORDER BY value DESC), 9) AS median FROM kp GROUP BY ALL")
_add("d19_period_report", "points", lambda d: reports.period_report(d, digits=9),
     f"{_BAND}, k AS (SELECT sn, " + ", ".join(f"round(max(value) FILTER (kpi = '{k}'), 9) AS {k}_max, round(quantile_cont(value, 0.95) FILTER (kpi = '{k}'), 9) AS {k}_p95" for k in ("latency_read", "latency_write", "cpu")) + " FROM kp GROUP BY sn) SELECT *, true AS available FROM (SELECT DISTINCT sn FROM points) LEFT JOIN band USING (sn) LEFT JOIN k USING (sn)")
_add("d24_ingest_summary", "raw", joins.ingest_summary, "SELECT source_file, resource_id, count(*) AS n_rows FROM raw GROUP BY ALL")
_add("d25_unknown_ids", "raw", lambda d: joins.unknown_ids(d, *_dims(d)), "SELECT source_file, string_agg(DISTINCT metric_id, ',' ORDER BY metric_id) AS ids, 'metric_id' AS kind FROM raw WHERE metric_id NOT IN (SELECT metric_id FROM dim_metric) GROUP BY ALL UNION ALL SELECT source_file, string_agg(DISTINCT resource_id, ',' ORDER BY resource_id), 'resource_id' FROM raw WHERE resource_id NOT IN (SELECT resource_id FROM dim_resource) GROUP BY ALL")
_add("d26_batch_summary", "raw", lambda d: joins.batch_summary(d.groupBy("source_file").agg(F.count("*").alias("n_points"), (F.sum("value") / 1e6).alias("seconds")).withColumn("status", F.when(F.col("source_file") == "f3", "failed").when(F.col("source_file") == "f5", "skipped").otherwise("ok"))),
     ", r AS (SELECT source_file, count(*) AS n, sum(value) / 1e6 AS s FROM raw GROUP BY ALL) SELECT count(*) AS total, count(*) FILTER (source_file NOT IN ('f3', 'f5')) AS ok, count(*) FILTER (source_file = 'f3') AS failed, count(*) FILTER (source_file = 'f5') AS skipped, count(*) AS with_data, round(avg(s), 9) AS avg_seconds FROM r")
_add("d27_coverage_summary", "points", lambda d: coverage.coverage_summary(_cov(d)), f"{_COV} SELECT count(*) FILTER (status <> 'extra') AS expected, count(*) FILTER (status <> 'missing') AS available, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'extra') AS extra FROM cov")
_RW = """, r AS (SELECT sn, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) AS q, quantile_cont(value, 0.95) AS p, min(ts) AS lo, max(ts) AS hi, count(DISTINCT element) AS c FROM points WHERE metric_id = '68' GROUP BY sn)"""
_add("d28_rw_ratio", "points", lambda d: reports.rw_ratio_report(d, "68", digits=9), f"{_RW} SELECT sn, round(m, 9) AS read_median, round(q, 9) AS read_p75, round(p, 9) AS read_p95, round(100 - m, 9) AS write_median, epoch_us(lo) AS first_ts, epoch_us(hi) AS last_ts, round((epoch_us(hi) - epoch_us(lo)) / 86400000000, 9) AS days, c AS n_controllers, CASE WHEN m >= 60 THEN 'read' WHEN m <= 40 THEN 'write' ELSE 'mixed' END AS workload, CASE WHEN epoch_us(hi) - epoch_us(lo) >= 7 * 86400000000 THEN 'full' ELSE 'partial' END AS coverage FROM r")
_add("d28_rw_classes", "points", lambda d: reports.rw_class_distribution(reports.rw_ratio_report(d, "68")), f"{_RW} SELECT CASE WHEN m >= 60 THEN 'read' WHEN m <= 40 THEN 'write' ELSE 'mixed' END AS workload, count(*) AS n_arrays FROM r GROUP BY ALL")
_add("d29_compare_picks", "points", lambda d: reports.compare_picks(d, d.sparkSession.createDataFrame([(1, "Controller", "CTE0", "avg_cpu_usage_percent"), (2, "Controller", "CTE1", "read_bandwidth_mb_s")], "pick int, resource string, element string, metric string"), 9),
     "SELECT CAST(CASE WHEN metric = 'avg_cpu_usage_percent' THEN 1 ELSE 2 END AS INTEGER) AS pick, sn, resource, element, metric, round(quantile_cont(value, 0.95), 9) AS p95, round(avg(value), 9) AS \"avg\", min(value) AS \"min\", max(value) AS \"max\" FROM points WHERE (element, metric) IN (('CTE0', 'avg_cpu_usage_percent'), ('CTE1', 'read_bandwidth_mb_s')) GROUP BY ALL")
_add("d30_files_by_sn", "raw", lambda d: joins.files_by_sn(d.select(F.concat(F.lit("/in/PerfData_M1_SN_"), F.when(F.col("sn") == "SN07", "x").otherwise(F.col("sn")), F.lit("_SP0_0_20240101000000."), "source_file").alias("path")).distinct()).withColumn("paths", F.array_join("paths", ";")),
     ", f AS (SELECT DISTINCT sn, '/in/PerfData_M1_SN_' || sn || '_SP0_0_20240101000000.' || source_file AS path FROM raw WHERE sn <> 'SN07') SELECT sn, count(*) AS n_files, string_agg(path, ';' ORDER BY path) AS paths FROM f GROUP BY sn")

# ---- grids and periods
_add("e01_renumber", "raw", lambda d: timegrid.renumber(joins.dedupe(d.drop("source_file"), "tie"), "resource_id", ["ts", "sn", "element", "metric_id"]).select("resource_id", "ts", "sn", "element", "metric_id", "no"), ", u AS (SELECT DISTINCT resource_id, ts, sn, element, metric_id FROM raw) SELECT resource_id, epoch_us(ts) AS ts, sn, element, metric_id, row_number() OVER (PARTITION BY resource_id ORDER BY u.ts, sn, element, metric_id) AS no FROM u")
_add("e02_step_grid", "points", lambda d: timegrid.step_grid(d, _START, _END, 3600), f"{_GRID} SELECT * FROM grid")

_add("e02_step_grid_lookback", "points", lambda d: timegrid.step_grid(d, _START, _END, 3600, 7200),
     f""", g AS (SELECT {_SERIES}, ts, value, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-05') AS m FROM points WHERE ts > TIMESTAMP '2024-01-04 22:00:00' AND ts <= TIMESTAMP '2024-01-20'),
     b AS (SELECT *, unnest(range(greatest(CAST(ceil(m / 3600000000) AS BIGINT), 0), least(CAST(ceil((m + 7200000000) / 3600000000) AS BIGINT), 361))) AS bucket FROM g)
     SELECT {_SERIES}, epoch_us(TIMESTAMP '2024-01-05') + bucket * 3600000000 AS ts, max_by(value, b.ts) AS value FROM b GROUP BY {_SERIES}, bucket""")


def _spans(d: DataFrame) -> DataFrame:
    return d.groupBy("sn", "element").agg(((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 86_400_000_000).alias("days"), F.max("ts").alias("last"))


_SPANS = ", s AS (SELECT sn, element, (epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000 AS days, max(ts) AS last FROM points GROUP BY ALL)"
_add("e03_adaptive_step", "points", lambda d: _spans(d).select("sn", "element", *(timegrid.adaptive_step(F.col("days"), k).alias(k) for k in timegrid.LADDERS)), f"{_SPANS} SELECT sn, element, CASE WHEN days <= 14 THEN 300 WHEN days <= 45 THEN 600 ELSE 3600 END AS performance, CASE WHEN days <= 7 THEN 300 WHEN days <= 30 THEN 900 WHEN days <= 90 THEN 3600 ELSE 21600 END AS outliers, CASE WHEN days <= 45 THEN 300 ELSE 600 END AS report, CASE WHEN days <= 14 THEN 60 ELSE 300 END AS rw_ratio FROM s")
_add("e04_last_full_week", "points", lambda d: _spans(d).select("sn", "element", timegrid.last_full_week(F.col("last"))[0].alias("start_ts"), timegrid.last_full_week(F.col("last"))[1].alias("end_ts")), f"{_SPANS} SELECT sn, element, epoch_us(date_trunc('week', last)) - 604800000000 AS start_ts, epoch_us(date_trunc('week', last)) - 1000000 AS end_ts FROM s")
_add("e05_effective_date", "points", lambda d: _spans(d).select("sn", "element", timegrid.effective_date(F.col("last"), F.when(F.col("sn") < "SN05", select.as_column(dt.datetime(2024, 1, 29))), _END).alias("at")), f"{_SPANS} SELECT sn, element, epoch_us(CASE WHEN sn < 'SN05' THEN least(last, TIMESTAMP '2024-01-29') ELSE last END) AS at FROM s")
_add("e06_last_datapoint", "points", timegrid.last_datapoint, "SELECT sn, epoch_us(max(ts)) AS last_ts FROM points GROUP BY sn")
_add("e07_data_period", "points", lambda d: timegrid.data_period(d, "68", _START, _END).withColumn("days", F.round("days", 9)), "SELECT sn, epoch_us(min(ts)) AS first_ts, epoch_us(max(ts)) AS last_ts, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000, 9) AS days FROM points WHERE metric_id = '68' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY sn")
_add("e08_available_range", "points", lambda d: timegrid.available_range(d.where("sn < 'SN04' OR ts < TIMESTAMP '2024-01-10'"), dt.datetime(2024, 1, 15), _END, _END),
     """, o AS (SELECT sn, count(*) FILTER (ts BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-20') AS n, min(ts) AS lo, max(ts) AS hi FROM points WHERE sn < 'SN04' OR ts < TIMESTAMP '2024-01-10' GROUP BY sn)
     SELECT sn, epoch_us(CASE WHEN n > 0 THEN TIMESTAMP '2024-01-15' ELSE greatest(lo, hi - INTERVAL 7 DAYS) END) AS start_ts, epoch_us(CASE WHEN n > 0 THEN TIMESTAMP '2024-01-20' ELSE hi END) AS end_ts, true AS available FROM o""")

# ---- functions
_add("f01_file_fields", "raw", lambda d: d.select(F.concat(F.lit("/in/PerfData_M1_SN_"), "sn", F.lit("_SP"), F.col("resource_id"), F.lit("_0_"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit(".tgz")).alias("p")).select(names.file_fields(F.col("p")).alias("x")).select("x.*").distinct(), "SELECT DISTINCT 'M1' AS model, sn, CAST(resource_id AS INTEGER) AS sp, epoch_us(ts) AS dumped FROM raw")
_add("f02_sanitise", "raw", lambda d: d.select(F.concat("sn", F.lit(" Read I/O: [128K,+x) "), "element", F.lit("(%)-"), "metric_id").alias("n")).distinct().select("n", names.sanitise(F.col("n"), "p_").alias("s")), f", x AS (SELECT DISTINCT sn || ' Read I/O: [128K,+x) ' || element || '(%)-' || metric_id AS n FROM raw) SELECT n, 'p_' || {sanitise_sql('n')} AS s FROM x")
_add("f03_short_name", "raw", lambda d: d.select(F.concat(F.lit("Read IO/s of "), "element", F.lit(" (MB/s) %")).alias("n")).distinct().select("n", names.short_name(F.col("n")).alias("s")), ", x AS (SELECT DISTINCT 'Read IO/s of ' || element || ' (MB/s) %' AS n, element FROM raw) SELECT n, 'am_read_iops_of_' || lower(element) || '_mbps_pct' AS s FROM x")
_add("f04_sn_of", "raw", lambda d: d.select(F.when(F.col("metric_id") == "22", F.concat(F.lit("PerfData_M_SN_"), "sn", F.lit("_SP0_0_20240101000000.tgz"))).otherwise("x.tgz").alias("m"), F.when(F.col("resource_id") == "10", "/in/a_2102355THQFSQ2100014.zip").when(F.col("resource_id") == "11", "/in/(10.0.0.7)/b.zip").otherwise("/in/b.zip").alias("a")).distinct().select("m", "a", names.sn_of(F.col("m"), F.col("a")).alias("s")),
     ", x AS (SELECT DISTINCT CASE WHEN metric_id = '22' THEN 'PerfData_M_SN_' || sn || '_SP0_0_20240101000000.tgz' ELSE 'x.tgz' END AS m, CASE resource_id WHEN '10' THEN '/in/a_2102355THQFSQ2100014.zip' WHEN '11' THEN '/in/(10.0.0.7)/b.zip' ELSE '/in/b.zip' END AS a FROM raw) SELECT m, a, coalesce(nullif(regexp_extract(m, '_SN_([0-9A-Z]+)_SP', 1), ''), nullif(regexp_extract(a, '_(21[0-9A-Z]{18,})[.]zip', 1), ''), 'UNKNOWN_' || replace(nullif(regexp_extract(a, '[(]([0-9.]+)[)]', 1), ''), '.', '_'), 'UNKNOWN_SN') AS s FROM x")
_add("f06_interval_label", "raw", lambda d: d.select((F.col("tie") % 9000).cast("int").alias("s")).distinct().select("s", names.interval_label(F.col("s")).alias("label")), ", x AS (SELECT DISTINCT CAST(tie % 9000 AS INTEGER) AS s FROM raw) SELECT s, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm' ELSE (s // 3600) || 'h' END AS label FROM x")
_add("f07_units", "raw", lambda d: _named(d).select("metric").distinct().select("metric", names.unit_of(F.col("metric")).alias("unit")), f"{_NAMED} SELECT DISTINCT metric, CASE WHEN metric = 'link_bandwidth_kb_s' THEN 'KBs' WHEN contains(metric, 'timeus') THEN 'µs' WHEN contains(metric, 'iops') THEN 'ops' ELSE 'short' END AS unit FROM named")
_add("f11_rounding", "raw", lambda d: stats.stats(d, ["sn"], F.lit(1024.0), 2).select("sn", F.col("avg").alias("v")), "SELECT sn, round(avg(value) / 1024, 2) AS v FROM raw GROUP BY sn")
_add("f12_thresholds", "points", lambda d: reports.threshold_report(d, digits=9),
     """, q AS (SELECT sn, kpi, round(quantile_cont(value, 0.95), 9) AS p95 FROM kp GROUP BY ALL), t AS (SELECT *, CASE WHEN kpi = 'cpu' AND sn = 'SN00' THEN 300.0 WHEN kpi = 'cpu' THEN 350.0 WHEN kpi = 'bandwidth_read' THEN 300.0 ELSE 0.3 END AS warning, CASE WHEN kpi = 'cpu' AND sn = 'SN00' THEN 420.0 WHEN kpi = 'cpu' THEN 450.0 WHEN kpi = 'bandwidth_read' THEN 480.0 ELSE 0.46 END AS critical FROM q WHERE kpi IN ('cpu', 'bandwidth_read', 'latency_read'))
     SELECT sn, kpi, p95, CAST(warning AS DOUBLE) AS warning, CAST(critical AS DOUBLE) AS critical, CASE WHEN p95 >= critical THEN 'critical' WHEN p95 * 1.3 >= critical THEN 'forecast_critical' WHEN p95 >= warning THEN 'warning' WHEN p95 * 1.3 >= warning THEN 'forecast_warning' ELSE 'passed' END AS outcome FROM t""")
_SMART = ", t AS (SELECT sn, disk_id, " + ", ".join(f"max_by(value, ts) FILTER (metric = '{m}') AS {m}" for m in health.SMART) + """ FROM health WHERE disk_id IS NOT NULL GROUP BY ALL),
smart AS (SELECT *, CASE WHEN coalesce(smart_offline_uncorrectable, 0) > 0 OR coalesce(smart_pending_sectors, 0) > 10 OR coalesce(smart_disk_health, 100) < 50 THEN 'critical' WHEN coalesce(smart_reallocated_sectors, 0) > 100 OR coalesce(smart_reallocated_events, 0) > 50 OR coalesce(smart_pending_sectors, 0) > 0 OR coalesce(smart_disk_health, 100) < 80 THEN 'warning' ELSE 'healthy' END AS status FROM t),
smartp AS (SELECT *, CAST(row_number() OVER (PARTITION BY sn ORDER BY CASE status WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END, disk_id) AS INTEGER) AS place FROM smart)"""
_BBU = ", bt AS (SELECT sn, bbu_id, " + ", ".join(f"max_by(value, ts) FILTER (metric = '{m}') AS {m}" for m in health.BBU) + """ FROM health WHERE bbu_id IS NOT NULL GROUP BY ALL),
bbu AS (SELECT *, CASE WHEN coalesce(bbu_temperature, 0) > 45 OR coalesce(bbu_capacity_percent, 100) < 50 THEN 'critical' WHEN coalesce(bbu_temperature, 0) > 40 OR coalesce(bbu_capacity_percent, 100) < 80 THEN 'warning' ELSE 'healthy' END AS status FROM bt)"""
_ECC = """, dl AS (SELECT sn, controller, dimm, max_by(value, ts) FILTER (metric = 'ecc_dimm') AS value, max_by(value, ts) FILTER (metric = 'mce_dimm') > 0 AS mce FROM health WHERE dimm IS NOT NULL GROUP BY ALL),
dimms AS (SELECT *, CAST(row_number() OVER (PARTITION BY sn ORDER BY value DESC, controller, dimm) AS INTEGER) AS place FROM dl),
tot AS (SELECT sn, sum(v) AS ecc_total FROM (SELECT sn, controller, max_by(value, ts) AS v FROM health WHERE metric = 'ecc_total' GROUP BY ALL) GROUP BY sn),
ecc AS (SELECT tot.sn, ecc_total, n AS dimms_with_errors, worst_dimm, has_critical FROM tot JOIN (SELECT sn, count(*) FILTER (value > 0) AS n, max(value) AS worst_dimm, bool_or(mce) AS has_critical FROM dimms GROUP BY sn) USING (sn))"""
_add("d20_ecc_dimms", "health", health.ecc_dimms, f"{_ECC} SELECT * FROM dimms")
_add("d20_ecc_report", "health", health.ecc_report, f"{_ECC} SELECT * FROM ecc")
_add("d21_smart_report", "health", lambda d: health.smart_report(d).select("sn", "disk_id", *health.SMART, "status", "place"), f"{_SMART} SELECT * FROM smartp")
_add("d21_smart_counts", "health", lambda d: health.status_counts(health.smart_report(d)), f"{_SMART} SELECT sn, count(*) AS total, count(*) FILTER (status = 'healthy') AS healthy, count(*) FILTER (status = 'warning') AS warning, count(*) FILTER (status = 'critical') AS critical FROM smart GROUP BY sn")
_add("d22_bbu_report", "health", lambda d: health.bbu_report(d).drop("ts"), f"{_BBU} SELECT * FROM bbu")
_REC = f"""{_SMART}{_BBU}{_ECC}, rec AS (
SELECT sn, 1 AS section, place, 'warning' AS status, 'Replace memory module ' || controller || '/' || dimm AS text FROM dimms WHERE value > 10000
UNION ALL SELECT sn, 1, place, 'healthy', 'Monitor memory module ' || controller || '/' || dimm FROM dimms WHERE value > 1000 AND value <= 10000
UNION ALL SELECT sn, 2, place, 'critical', 'Machine check on memory module ' || controller || '/' || dimm FROM dimms WHERE mce
UNION ALL SELECT sn, 3, place, 'critical', 'Replace disk ' || disk_id FROM smartp WHERE status = 'critical'
UNION ALL SELECT sn, 4, place, 'warning', 'Watch disk ' || disk_id FROM smartp WHERE status = 'warning'
UNION ALL SELECT sn, 5, CAST(row_number() OVER (PARTITION BY sn ORDER BY bbu_id) AS INTEGER), 'critical', 'Replace battery ' || bbu_id FROM bbu WHERE status = 'critical'
UNION ALL SELECT sn, 6, CAST(row_number() OVER (PARTITION BY sn ORDER BY bbu_id) AS INTEGER), 'warning', 'Watch battery ' || bbu_id FROM bbu WHERE status = 'warning')"""
_add("f15_recommendations", "health", health.recommendations, f"{_REC} SELECT * FROM rec")
_add("d23_health_summary", "health", health.health_summary, f"""{_REC}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sn ORDER BY section, place, text) AS no FROM rec), tx AS (SELECT sn, string_agg(text, '; ' ORDER BY no) AS recommendations FROM ranked WHERE no <= 10 GROUP BY sn),
worst AS (SELECT sn, max(CASE status WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) AS r FROM rec GROUP BY sn)
SELECT sn, CASE coalesce(r, 0) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS status, coalesce(ecc_total, 0) AS ecc_total, coalesce(dimms_with_errors, 0) AS dimms_with_errors, coalesce(has_critical, false) AS mce, coalesce(recommendations, '') AS recommendations
FROM (SELECT DISTINCT sn FROM health) LEFT JOIN worst USING (sn) LEFT JOIN ecc USING (sn) LEFT JOIN tx USING (sn)""")
_add("f14_bands", "health", health.bands, """, l AS (SELECT sn, metric, controller, dimm, disk_id, bbu_id, max_by(value, ts) AS value FROM health GROUP BY ALL)
SELECT *, CASE metric WHEN 'ecc_total' THEN CASE WHEN value >= 50 THEN 'red' WHEN value >= 10 THEN 'yellow' ELSE 'green' END
 WHEN 'ecc_dimm' THEN CASE WHEN value >= 10000 THEN 'red' WHEN value >= 1000 THEN 'orange' WHEN value >= 100 THEN 'yellow' ELSE 'green' END
 WHEN 'smart_disk_health' THEN CASE WHEN value >= 90 THEN 'green' WHEN value >= 75 THEN 'yellow' WHEN value >= 60 THEN 'orange' ELSE 'red' END
 WHEN 'smart_available_spare' THEN CASE WHEN value >= 50 THEN 'green' WHEN value >= 30 THEN 'yellow' ELSE 'red' END
 WHEN 'bbu_temperature' THEN CASE WHEN value >= 50 THEN 'red' WHEN value >= 40 THEN 'yellow' ELSE 'green' END
 WHEN 'bbu_capacity_percent' THEN CASE WHEN value >= 80 THEN 'green' WHEN value >= 50 THEN 'yellow' ELSE 'red' END
 ELSE CASE WHEN metric LIKE 'smart_%' AND metric <> 'smart_temperature' THEN CASE WHEN value >= 10 THEN 'red' WHEN value >= 1 THEN 'yellow' ELSE 'green' END END END AS colour FROM l""")

# ---- top-k and sets
_add("g01_top_loaded", "points", lambda d: reports.top_loaded(d, "latency_read", 5, digits=9), f", t AS (SELECT sn, {_agg()} FROM kp WHERE kpi = 'latency_read' GROUP BY sn) SELECT *, coalesce(nullif(p95, 0), nullif(\"max\", 0), 0) AS load FROM t ORDER BY load DESC, sn LIMIT 5")
_add("g01_top_loaded_grid", "points", lambda d: reports.top_loaded(d, "latency_read", 5, _START, _END, 9, step=3600), f"{_HOURS}, t AS (SELECT sn, {_agg()} FROM kg WHERE kpi = 'latency_read' GROUP BY sn) SELECT *, coalesce(nullif(p95, 0), nullif(\"max\", 0), 0) AS load FROM t ORDER BY load DESC, sn LIMIT 5")
_add("g02_outliers", "points", lambda d: reports.outliers(d, 1.2),
     f""", p AS (SELECT sn, metric_id, quantile_cont(value, 0.95) AS p95 FROM points GROUP BY ALL), f AS (SELECT points.*, p95 FROM points JOIN p USING (sn, metric_id) WHERE value > p95 * 1.2),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY sn, metric_id ORDER BY value DESC, ts, element) AS INTEGER) AS rank, count(*) OVER (PARTITION BY sn, metric_id) AS n_outliers FROM f) SELECT sn, metric_id, element, {_TS}, value, round(p95, 9) AS p95, rank, n_outliers FROM r WHERE rank <= 50""")
_add("h02_metric_sets", "points", lambda d: coverage.metric_sets(_expected(d), _available(d)), f"{_COV} SELECT resource, metric, CASE status WHEN 'ok' THEN 'both' ELSE status END AS part FROM cov")
_add("h04_merge_by_resource", "raw", lambda d: joins.merge_by_resource([d.where("source_file < 'f3'"), d.where("source_file >= 'f3'")], ["source_file", "tie"]).select("resource_id", "part", "source_file", "tie", "place"),
     ", p AS (SELECT *, CAST(CASE WHEN source_file < 'f3' THEN 0 ELSE 1 END AS INTEGER) AS part FROM raw) SELECT resource_id, part, source_file, tie, row_number() OVER (PARTITION BY resource_id ORDER BY part, source_file, tie) AS place FROM p")
_add("h05_dedupe", "raw", lambda d: joins.dedupe(d.drop("source_file"), "tie"), "SELECT sn, resource_id, element, metric_id, epoch_us(ts) AS ts, max_by(value, tie) AS value, max(tie) AS tie FROM raw GROUP BY sn, resource_id, element, metric_id, raw.ts")
_add("h01_union", "points", lambda d: joins.union_points(d.where("sn < 'SN04'"), d.where("sn >= 'SN04'").drop("source_file")).groupBy("resource", "metric").agg(F.count("*").alias("n")), "SELECT resource, metric, count(*) AS n FROM points GROUP BY ALL")
