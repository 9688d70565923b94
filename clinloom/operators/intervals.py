"""Joins of days and spans by cells of a person and a month, so that no person is one task's work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def by_month(spans: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """A row with ``_month`` for each month that a span touches; a span without an end, or with one before its start, has none."""
    real = spans.where(F.col(start) <= F.col(end))
    return real.withColumn("_month", F.explode(F.sequence(month(F.col(start)), month(F.col(end)))))


def coverage(spans: DataFrame, keys: list[str], id: str | None = None) -> DataFrame:
    """(keys, _from, _to, candidates, only): the stretches of days, by ``keys``, that one span or more cover, how many, and the
    ``id`` (a whole number) of the one where it is one. Spans become steps up and down by day, summed before the shuffle, so a
    key has two rows a day at most, whatever its spans; ids are xor-ed along, which leaves the one that is open."""
    known = F.col(id).cast("long") if id else F.lit(0).cast("long")
    real = spans.where("start_date <= end_date").select(*keys, "start_date", "end_date", known.alias("_id"))
    step = lambda day, n: F.struct(day.alias("day"), F.lit(n).alias("n"))
    steps = real.select(*keys, "_id", F.explode(F.array(step(F.col("start_date"), 1), step(F.date_add("end_date", 1), -1))).alias("s"))
    days = steps.groupBy(*keys, "s.day").agg(F.sum("s.n").alias("n"), F.bit_xor("_id").alias("x"))
    order = Window.partitionBy(*keys).orderBy("day")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    out = days.select(
        *keys, F.col("day").alias("_from"), F.date_sub(F.lead("day").over(order), 1).alias("_to"), F.sum("n").over(running).alias("candidates"), F.bit_xor("x").over(running).alias("only")
    )
    return out.where("candidates > 0").withColumn("only", F.when(F.col("candidates") == 1, F.col("only")))


def with_coverage(days: DataFrame, spans: DataFrame, keys: list[str], day: str = "start_date", id: str | None = None) -> DataFrame:
    """``days`` with ``candidates``, the number of ``spans`` of the same ``keys`` that cover ``day`` (0 for none), and ``only``.
    A cell of a key and a month holds 31 stretches at most and each day meets one of them, so the join neither
    multiplies rows nor gathers a key; skewed cells can be split. Nulls in the keys or the day are covered by nothing."""
    cells = by_month(coverage(spans, keys, id), "_from", "_to").select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], "_month", "_from", "_to", "candidates", "only")
    same = month(F.col(day)) == F.col("_month")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_{i}"))
    met = days.drop("candidates", "only").join(cells, same & F.col(day).between(F.col("_from"), F.col("_to")), "left")
    return met.drop("_month", "_from", "_to", *[f"_{i}" for i in range(len(keys))]).withColumn("candidates", F.coalesce("candidates", F.lit(0)))


def inside_none(rows: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (start_date, end_date) that lie whole in no span of their ``keys``: rows meet the spans that touch the month
    of their start."""
    cells = by_month(spans).select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], "_month", F.col("start_date").alias("_from"), F.col("end_date").alias("_to"))
    whole = (F.col("start_date") >= F.col("_from")) & (F.col("end_date") <= F.col("_to")) & (month(F.col("start_date")) == F.col("_month"))
    for i, k in enumerate(keys):
        whole = whole & (F.col(k) == F.col(f"_{i}"))
    return rows.join(cells, whole, "left_anti")
