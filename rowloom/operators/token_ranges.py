"""Splitting a table by token into ranges of equal numbers of rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.bins import Cuts, cuts
from rowloom.functions.types import col, row_hash

TOKEN, RANGE = "_token", "_range"
# ranges are cut on a token's upper 53 bits, which the sketch holds exactly
LOWER_BITS = 11
FINE = 16  # fine cuts for each range


@dataclass(frozen=True)
class TokenRange:
    """Tokens from ``low`` (none: the least) to below ``high`` (none: the greatest). Where one
    token holds more rows than a range should, its rows are dealt to ``parts`` ranges by a
    hash of the row."""

    low: int | None
    high: int | None
    part: int
    parts: int


@dataclass(frozen=True)
class TokenRanges:
    """All ranges of a table; every row is in exactly one."""

    cuts: Cuts

    @property
    def ranges(self) -> list[TokenRange]:
        ends = [None, *(int(v) << LOWER_BITS for v in self.cuts.values), None]
        return [
            TokenRange(low, high, part, parts)
            for low, high, parts in zip(ends, ends[1:], self.cuts.weights)
            for part in range(parts)
        ]

    def number(self, token: Column, rest: Column) -> Column:
        """The range of a row with this token; ``rest`` is a hash of the row."""
        before = [sum(self.cuts.weights[:i]) for i in range(self.cuts.count)]
        bin_ = self.cuts.bin(F.shiftright(token, LOWER_BITS))
        first = F.get(F.array(*[F.lit(b) for b in before]), bin_)
        return first + F.pmod(rest, self.cuts.weight(bin_)).cast("int")


def token_ranges(df: DataFrame, token: Column, n: int) -> TokenRanges:
    """Ranges of about ``1/n`` of the rows each, at most a few hundredths more.

    One pass with a mergeable sketch gives fine cuts, which are put together to
    ranges. A token with more rows than a range starts ranges of its own, so
    there may be some more than ``n``.
    """
    fine = cuts(df, F.shiftright(token, LOWER_BITS), FINE * n)
    values, weights, held = [], [], 0
    for value, weight in zip((None, *fine.values), fine.weights):
        hot = weight > FINE
        if value is not None and (hot or weights[-1] > 1 or held + weight > FINE):
            values.append(value)
            held = 0
        if value is None or held == 0:
            weights.append(-(-weight // FINE))
        held += weight
    return TokenRanges(Cuts(tuple(values), tuple(weights), fine.type))


def in_token_ranges(df: DataFrame, token: Column, ranges: TokenRanges) -> DataFrame:
    """``df`` with the columns ``_token`` and ``_range``. Exact copies of one row go by the task
    they come from where their token is dealt out."""
    rest = F.xxhash64(row_hash(df), F.spark_partition_id())
    with_token = df.withColumn(TOKEN, token)
    return with_token.withColumn(RANGE, ranges.number(F.col(TOKEN), rest))


def write_token_ranges(df: DataFrame, path: str, token: Column, ranges: TokenRanges) -> None:
    """Store the table range by range, each sorted by token (one shuffle). A null token is in
    the first range."""
    dealt = in_token_ranges(df, token, ranges).repartition(len(ranges.ranges), RANGE)
    dealt.sortWithinPartitions(RANGE, TOKEN).write.partitionBy(RANGE).parquet(path)


def scan_token_range(
    spark: SparkSession, path: str, number: int, low: int | None = None, high: int | None = None
) -> DataFrame:
    """One range of a stored table: no other file is read. ``low`` and ``high`` narrow it to
    tokens from ``low`` to below ``high``, by the files' statistics."""
    rows = spark.read.parquet(path).where(col(RANGE) == number)
    if low is not None:
        rows = rows.where(F.col(TOKEN) >= low)
    if high is not None:
        rows = rows.where(F.col(TOKEN) < high)
    return rows.drop(RANGE, TOKEN)
