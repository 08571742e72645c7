"""Status and threshold rules as column expressions. The limits are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANK = {"healthy": 0, "warning": 1, "critical": 2}


def disk_status(offline: Column, pending: Column, reallocated: Column, events: Column, health: Column) -> Column:
    """missing counters count as 0, a missing health as 100."""
    o, p, r, e = (F.coalesce(c, F.lit(0.0)) for c in (offline, pending, reallocated, events))
    h = F.coalesce(health, F.lit(100.0))
    return F.when((o > 0) | (p > 10) | (h < 50), "critical").when((r > 100) | (e > 50) | (p > 0) | (h < 80), "warning").otherwise("healthy")


def bbu_status(temperature: Column, capacity: Column) -> Column:
    t, c = F.coalesce(temperature, F.lit(0.0)), F.coalesce(capacity, F.lit(100.0))
    return F.when((t > 45) | (c < 50), "critical").when((t > 40) | (c < 80), "warning").otherwise("healthy")


def rank(status: Column) -> Column:
    return F.when(status == "critical", 2).when(status == "warning", 1).otherwise(0)


#: For each metric the lower limits and colours, from the lowest.
BANDS = {
    "ecc_total": [(None, "green"), (10, "yellow"), (50, "red")],
    "ecc_dimm": [(None, "green"), (100, "yellow"), (1000, "orange"), (10000, "red")],
    "smart_counter": [(None, "green"), (1, "yellow"), (10, "red")],
    "smart_disk_health": [(None, "red"), (60, "orange"), (75, "yellow"), (90, "green")],
    "smart_available_spare": [(None, "red"), (30, "yellow"), (50, "green")],
    "bbu_temperature": [(None, "green"), (40, "yellow"), (50, "red")],
    "bbu_capacity_percent": [(None, "red"), (50, "yellow"), (80, "green")],
}


def band(metric: Column, value: Column) -> Column:
    """the colour of the highest limit that the value reaches; null for metrics without bands."""
    kind = F.when(metric.startswith("smart_") & ~metric.isin("smart_disk_health", "smart_available_spare", "smart_temperature"), "smart_counter").otherwise(metric)
    out = F.lit(None).cast("string")
    for name, limits in BANDS.items():
        colour = F.lit(limits[0][1])
        for low, c in limits[1:]:
            colour = F.when(value >= low, c).otherwise(colour)
        out = F.when((kind == name) & value.isNotNull(), colour).otherwise(out)
    return out


def threshold_check(value: Column, warning: Column, critical: Column, growth: float = 0.3) -> Column:
    """the value, then the value grown by ``growth``, against both limits."""
    ahead = value * (1 + growth)
    return F.when(value >= critical, "critical").when(ahead >= critical, "forecast_critical").when(value >= warning, "warning").when(ahead >= warning, "forecast_warning").otherwise("passed")
