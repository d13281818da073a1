"""The job queue as relations: priority, routes, states, idle gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Job types with a route of their own; anything else is deskewed. States that end a job.
ROUTES = ("crop", "pipeline", "decon")
TERMINAL = ("completed", "failed")


def next_ticket(tickets: DataFrame, keys: list[str]) -> DataFrame:
    """The queued ticket whose name comes first, so crops before decons before deskews before pipelines."""
    return tickets.where("state = 'queued'").groupBy(*keys).agg(F.min("ticket").alias("ticket"))


def route(job_type: Column) -> Column:
    return F.when(job_type.isin(*ROUTES), job_type).otherwise("deskew")


def last_state(tickets: DataFrame, key: str) -> DataFrame:
    """Each key's latest state; of equal times the last ticket name."""
    best = F.max(F.struct("ts", "ticket", "state")).alias("m")
    return tickets.groupBy(key).agg(best).select(key, F.col("m.state").alias("state"), F.col("m.ts").alias("ts"))


def idle_sessions(tickets: DataFrame, key: str, gap: str) -> DataFrame:
    """(key, started, tickets) of each stretch without a pause of `gap` or more."""
    return tickets.groupBy(key, F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("tickets")).select(key, F.col("s.start").alias("started"), "tickets")


def iteration_errors(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Errors of successive iterations over the first, and a tenth of their change.

    Over a first error of 0 they are infinite, or NaN for 0, as doubles are by IEEE 754; Spark's own division raises there, or gives null.
    """
    w = Window.partitionBy(key).orderBy(order)
    first = F.first(value).over(w)
    over = F.when(first == 0, F.col(value) * F.pow(first, F.lit(-1.0))).otherwise(F.col(value) / first)
    ratio = rows.select(key, F.row_number().over(w).alias("k"), over.alias("ratio"))
    by_k = Window.partitionBy(key).orderBy("k")
    return ratio.withColumn("change", F.abs(F.col("ratio") - F.lag("ratio").over(by_k)) / 10)


def iterations_for(method: str, given: int | None = None) -> int:
    """Deconvolution steps: as given, else by the method."""
    return given if given else 2 if method == "omw" else 25
