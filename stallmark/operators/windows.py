"""Period windows: either the table of canonical periods, or one range with literal bounds.

The period table is expanded to its days and joined by equality on the day (at most five rows a day,
so small enough to broadcast by the number of days in the calendar); a literal range is a plain filter that
reaches the scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL = "period_label"


@dataclass
class Windows:
    """frame: a row for each window; bounds: the literal bounds of a single range."""

    frame: DataFrame
    bounds: tuple[dt.date, dt.date] | None = None

    @staticmethod
    def of_range(lines: DataFrame, start: dt.date, end: dt.date, as_of: dt.date | None = None) -> Windows:
        if end < start:
            raise ValueError("the window ends before it starts")
        days = (end - start).days + 1
        prior_start, prior_end = start - dt.timedelta(days), start - dt.timedelta(1)
        first = F.coalesce(F.min("sale_date"), F.current_date() if as_of is None else F.lit(as_of).cast("date"))
        frame = lines.where("sale_date is not null").agg(first.alias("first_sale_date")).select(
            F.lit("range").alias(LABEL), F.lit(1).alias("period_order"), F.lit(days).alias("period_days"), F.lit(start).alias("period_start"), F.lit(end).alias("period_end"),
            F.lit(prior_start).alias("prior_start"), F.lit(prior_end).alias("prior_end"), (F.lit(prior_start) >= F.col("first_sale_date")).alias("prior_window_complete"),
        )
        return Windows(frame, (start, end))

    def attach_both(self, rows: DataFrame, day: str) -> DataFrame:
        """Rows with the label of each window that holds them or that they precede by one, and is_prior: one pass for both."""
        if self.bounds:
            start, end = self.bounds
            first = start - dt.timedelta((end - start).days + 1)
            return rows.where(F.col(day).between(F.lit(first), F.lit(end))).withColumns({LABEL: F.lit("range"), "is_prior": F.col(day) < F.lit(start)})
        tagged = lambda lo, hi, prior: F.transform(F.sequence(lo, hi), lambda d: F.struct(d.alias(day), F.lit(prior).alias("is_prior")))
        before = F.when(F.col("prior_start").isNotNull(), tagged("prior_start", "prior_end", True)).otherwise(F.array())
        days = self.frame.select(LABEL, F.inline(F.concat(tagged("period_start", "period_end", False), before)))
        return rows.join(F.broadcast(days), day)  # at most two rows for each period and calendar day

    def attach(self, rows: DataFrame, day: str, prior: bool = False) -> DataFrame:
        """Rows that lie in a window (or the one before), with its label; a row may lie in several."""
        if self.bounds:
            start, end = self.bounds
            if prior:
                start, end = start - dt.timedelta((end - start).days + 1), start - dt.timedelta(1)
            return rows.where(F.col(day).between(F.lit(start), F.lit(end))).withColumn(LABEL, F.lit("range"))
        lo, hi = ("prior_start", "prior_end") if prior else ("period_start", "period_end")
        days = self.frame.where(F.col(lo).isNotNull()).select(LABEL, F.explode(F.sequence(lo, hi)).alias(day))
        return rows.join(F.broadcast(days), day)  # at most one row for each period and calendar day
