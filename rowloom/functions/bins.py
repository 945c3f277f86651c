"""Cutting ordered values into bins of about equal numbers of rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Cuts:
    """Ascending different values that start bins ``1, 2, …`` (bin 0 lies below all), and per
    bin how many times the rows of an even bin it holds, about: more than once where one value
    is very common. ``rows`` is the number of values that were cut (0: not known)."""

    values: tuple
    weights: tuple[int, ...]
    type: str
    rows: int = 0

    @property
    def count(self) -> int:
        return len(self.values) + 1

    def bin(self, value: Column) -> Column:
        """The bin of a value (int; null values are in bin 0): a binary search."""
        if not self.values:
            return F.lit(0)
        value = value.cast("double") if self.type == "double" else value
        values = _literals(self.values, self.type)
        steps = [1 << k for k in reversed(range(len(self.values).bit_length()))]
        return F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, step: F.when(F.get(values, at + step - 1) <= value, at + step).otherwise(at),
        )

    def weight(self, bin_: Column) -> Column:
        """The weight of a bin."""
        return F.get(_literals(self.weights, "int"), bin_)

    def merged(self, times: int) -> Cuts:
        """Cuts whose even bins hold ``times`` as many rows; very common values keep their own."""
        values, weights = [], [self.weights[0]]
        for v, w in zip(self.values, self.weights[1:]):
            if weights[-1] >= times or w >= times:
                values.append(v)
                weights.append(w)
            else:
                weights[-1] += w
        return Cuts(tuple(values), tuple(max(1, round(w / times)) for w in weights), self.type, self.rows)


def _literals(values: tuple, kind: str) -> Column:
    """An array of these values: one text where they can be written without loss, as a literal
    for each makes plans slow to build."""
    if kind in ("double", "int"):
        texts = [repr(v) for v in values]
    elif kind in ("date", "timestamp_ntz"):
        texts = [v.isoformat() for v in values]
    elif kind == "timestamp":
        texts = [v.astimezone(dt.timezone.utc).isoformat() for v in values]
    else:
        return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    return F.split(F.lit(",".join(texts)), ",").cast(f"array<{kind}>")


def cuts(df: DataFrame, value: Column, bins: int) -> Cuts:
    """Cut ``value`` (numbers, dates, instants) at its quantiles.

    One pass with a mergeable sketch, of which ``bins`` values reach the driver.
    A value that fills several bins becomes one bin of that weight. The sketch
    holds doubles, so whole and decimal numbers are compared as such.
    """
    if bins < 1:
        raise ValueError("there is at least one bin")
    row = df.select(value.alias("v"))
    if isinstance(row.schema["v"].dataType, T.NumericType):
        row = row.select(F.col("v").cast("double").alias("v"))
    kind = row.schema["v"].dataType.simpleString()
    shares = [i / bins for i in range(1, bins)]
    found, rows = [], 0
    if shares:
        quantiles = F.percentile_approx("v", shares, max(10_000, 20 * bins))
        found, rows = row.agg(quantiles, F.count("v")).first()
    runs = [(v, len(list(own))) for v, own in groupby(found or [])]
    return Cuts(tuple(v for v, _ in runs), (1, *(n for _, n in runs)), kind, rows)
