"""The four analytical table shapes as a distributed generator job.

``spark.range`` + per-column ``rand(seed)`` draws: every row is generated inside its own task
(no driver-side pandas), so the job scales with ``scale`` like any other scan.  Same shapes
and domains as the reference's generator, not the same random bits.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The domains, weights and anchors of the four tables.
REFERENCE_DATE = datetime(2026, 7, 15)
MODELS = ["CNC-X1000", "Lathe-Z500", "Press-M200", "Welder-A300"]
LINES = ["Line-A", "Line-B", "Line-C"]
LOCATIONS = ["Building-1", "Building-2"]
PRODUCTS = ["Widget-A", "Widget-B", "Gear-X", "Shaft-Y"]
ORDER_STATUS = [("pending", 0.2), ("in_progress", 0.3), ("completed", 0.5)]
TICKET_PRIORITY = [("low", 0.3), ("medium", 0.4), ("high", 0.2), ("critical", 0.1)]
TICKET_STATUS = [("open", 0.3), ("in_progress", 0.3), ("resolved", 0.4)]
TICKET_TEXT = ["Unusual vibration detected", "Temperature spike", "Scheduled maintenance",
               "Belt replacement needed", "Calibration required"]
BASE_ROWS = {"machines": 50, "sensor_readings": 10_000, "production_orders": 200,
             "maintenance_tickets": 120}


def _uniform_choice(values: Sequence[str], seed: int) -> Column:
    idx = F.floor(F.rand(seed) * len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def _weighted_choice(pairs: Sequence[tuple[str, float]], seed: int) -> Column:
    u = F.rand(seed)
    expr, acc = None, 0.0
    for value, w in pairs[:-1]:
        acc += w
        expr = (F.when(u < acc, value) if expr is None else expr.when(u < acc, value))
    return expr.otherwise(pairs[-1][0])


def _uniform_real(lo: float, hi: float, decimals: int, seed: int) -> Column:
    return F.round(F.lit(lo) + F.rand(seed) * (hi - lo), decimals)


def _randint(lo: int, hi_excl: int, seed: int) -> Column:
    return (F.lit(lo) + F.floor(F.rand(seed) * (hi_excl - lo))).cast("bigint")


def seed_tables(spark: SparkSession, scale: float = 1.0, seed: int = 42,
                partitions: int | None = None) -> dict[str, DataFrame]:
    """The four tables (machines, sensor_readings, production_orders, maintenance_tickets)
    with ``scale`` times the reference row counts."""
    n = {k: max(1, int(v * scale)) for k, v in BASE_ROWS.items()}
    ref = F.lit(REFERENCE_DATE).cast("timestamp_ntz")
    n_m = n["machines"]

    def rng(count: int, start: int = 1) -> DataFrame:
        return spark.range(start, start + count, numPartitions=partitions)

    machines = rng(n_m).select(
        F.col("id").alias("machine_id"),
        _uniform_choice(MODELS, seed).alias("model"),
        _uniform_choice(LINES, seed + 1).alias("line"),
        (F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz")
         + F.make_interval(days=_randint(0, 1000, seed + 2).cast("int"))).alias("install_date"),
        _uniform_choice(LOCATIONS, seed + 3).alias("location"))

    readings = rng(n["sensor_readings"]).select(
        F.col("id").alias("reading_id"),
        _randint(1, n_m + 1, seed + 10).alias("machine_id"),
        (ref - F.make_interval(days=F.lit(30))
         + F.make_interval(mins=((F.col("id") - 1) * 5).cast("int"))).alias("ts"),
        _uniform_real(50, 90, 1, seed + 11).alias("temperature_c"),
        _uniform_real(0.5, 8.0, 2, seed + 12).alias("vibration_mm_s"),
        _uniform_real(20, 95, 1, seed + 13).alias("load_pct"))

    orders = rng(n["production_orders"], 1001).select(
        F.col("id").alias("order_id"),
        _randint(1, n_m + 1, seed + 20).alias("machine_id"),
        _uniform_choice(PRODUCTS, seed + 21).alias("product"),
        _randint(50, 500, seed + 22).alias("qty"),
        _weighted_choice(ORDER_STATUS, seed + 23).alias("status"),
        (ref + F.make_interval(days=_randint(0, 60, seed + 24).cast("int"))).alias("due_date"))

    tickets = rng(n["maintenance_tickets"]).select(
        F.col("id").alias("ticket_id"),
        _randint(1, n_m + 1, seed + 30).alias("machine_id"),
        (ref - F.make_interval(days=F.lit(60))
         + F.make_interval(hours=((F.col("id") - 1) * 12).cast("int"))).alias("opened_at"),
        _weighted_choice(TICKET_PRIORITY, seed + 31).alias("priority"),
        _weighted_choice(TICKET_STATUS, seed + 32).alias("status"),
        _uniform_choice(TICKET_TEXT, seed + 33).alias("description"))

    return {"machines": machines, "sensor_readings": readings, "production_orders": orders,
            "maintenance_tickets": tickets}
