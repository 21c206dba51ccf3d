"""Report filters: inclusive time range and IN-lists on status, country, method.

An empty selection, or one that names every value, means "no filter".
Fact predicates (time, status) go straight to the fact scan; the time range
also bounds ``event_month`` so a lake read prunes month partitions.
Country and method filters need a dimension and are applied after it joins.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elide(selected, all_values=None):
    """`None` when nothing or everything is selected, else a tuple."""
    if not selected:
        return None
    sel = tuple(selected)
    if all_values is not None and len(sel) == len(tuple(all_values)):
        return None
    return sel


def _ts(v) -> Column:
    if isinstance(v, datetime):
        return F.lit(v).cast("timestamp")
    return F.lit(str(v)).cast("timestamp")


@dataclass(frozen=True)
class Filters:
    start: datetime | str | None = None
    end: datetime | str | None = None
    statuses: tuple[int, ...] | None = None
    countries: tuple[str, ...] | None = None
    methods: tuple[str, ...] | None = None

    @classmethod
    def from_selection(cls, start=None, end=None, statuses=None, all_statuses=None,
                       countries=None, all_countries=None, methods=None, all_methods=None):
        return cls(start, end, elide(statuses, all_statuses), elide(countries, all_countries),
                   elide(methods, all_methods))

    def time_only(self) -> Filters:
        return Filters(self.start, self.end)

    def time_predicates(self, ts: str = "timestamp", with_month: bool = False) -> list[Column]:
        preds = []
        if self.start is not None:
            preds.append(F.col(ts) >= _ts(self.start))
            if with_month:
                preds.append(F.col("event_month") >= F.date_format(_ts(self.start), "yyyyMM"))
        if self.end is not None:
            preds.append(F.col(ts) <= _ts(self.end))
            if with_month:
                preds.append(F.col("event_month") <= F.date_format(_ts(self.end), "yyyyMM"))
        return preds

    def fact_predicates(self, with_month: bool = False) -> list[Column]:
        preds = self.time_predicates(with_month=with_month)
        if self.statuses is not None:
            preds.append(F.col("status").isin(*self.statuses))
        return preds

    def dims_needed(self) -> list[str]:
        out = []
        if self.countries is not None:
            out.append("dim_ip")
        if self.methods is not None:
            out.append("dim_request")
        return out

    def dim_predicates(self) -> list[Column]:
        preds = []
        if self.countries is not None:
            preds.append(F.col("country").isin(*self.countries))
        if self.methods is not None:
            preds.append(F.col("method").isin(*self.methods))
        return preds


NO_FILTERS = Filters()


def conjunction(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def apply(df: DataFrame, preds: list[Column]) -> DataFrame:
    c = conjunction(preds)
    return df if c is None else df.filter(c)
