"""Lookups: a query run once per incoming row, expressed as one join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rowloom.functions.types import col, quoted, row_hash, unused


def pairs_of(on: Mapping[str, str] | Sequence[str] | str) -> list[tuple[str, str]]:
    if isinstance(on, str):
        on = [on]
    pairs = list(on.items()) if isinstance(on, Mapping) else [(c, c) for c in on]
    if not pairs:
        raise ValueError("a lookup needs at least one equality between target and driver")
    return pairs


def lookup(
    driver: DataFrame,
    target: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    where: Column | None = None,
) -> DataFrame:
    """All target rows for each driver row; driver columns are dropped.

    ``on`` maps target columns to driver columns. ``where`` may add any further
    condition, naming driver columns as ``row.x`` and target columns as
    ``t.y``. A driver row without match gives nothing, equal driver rows repeat
    their result. The join is left to the optimizer: broadcast below its size
    threshold, else sort-merge, whose hot keys the adaptive plan splits.
    """
    row, t = driver.alias("row"), target.alias("t")
    condition = where if where is not None else F.lit(True)
    for target_col, driver_col in pairs_of(on):
        match = F.col(f"t.{quoted(target_col)}") == F.col(f"row.{quoted(driver_col)}")
        condition = match & condition
    return row.join(t, condition, "inner").select("t.*")


def lookup_limit(
    driver: DataFrame,
    target: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    order_by: Sequence[Column],
    n: int,
    where: Column | None = None,
) -> DataFrame:
    """Like :func:`lookup`, but at most ``n`` target rows per driver row.

    ``order_by`` picks them and must be total to make the result repeatable.
    Equal driver rows get equal answers, so the limit is taken once per key:
    each task keeps its own first ``n`` per key before rows are shuffled, hence
    a hot key never reaches one task whole. Spark does this up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``; above it, each key is
    first limited within as many parts as there are shuffle partitions.

    With ``where`` (a further condition on ``row.x`` and ``t.y``) driver rows of
    one key may have other answers: each distinct driver row is joined under the
    condition and limited, again in each task before the shuffle, so no more
    than ``n`` rows of a task leave it for each.
    """
    if where is not None:
        return _limited_where(driver, target, on, order_by, n, where)
    pairs = pairs_of(on)
    keys = [t for t, _ in pairs]
    wanted = driver.select(*[col(d).alias(t) for t, d in pairs])
    # Other keys are dropped before any sorting; the optimizer picks the join. It goes by a hash
    # as the limit does, so both share one shuffle.
    t, w = target.alias("t"), wanted.distinct().alias("w")
    both = [[F.col(f"{side}.{quoted(k)}") for k in keys] for side in "tw"]
    same = F.xxhash64(*both[0]) == F.xxhash64(*both[1])
    for mine, other in zip(*both):
        same = same & (mine == other)
    matched = t.join(w, same, "left_semi")
    return lookup(wanted, limited(matched.select(*[col(c) for c in target.columns]), keys, order_by, n), keys)


def _limited_where(
    driver: DataFrame,
    target: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    order_by: Sequence[Column],
    n: int,
    where: Column,
) -> DataFrame:
    asked = driver.dropna(subset=[d for _, d in pairs_of(on)])
    times = unused("_times", driver, target)
    rows = asked.groupBy(*[col(c) for c in driver.columns]).agg(F.count(F.lit(1)).alias(times))
    mine = [unused(f"_row{i}", driver, target) for i in range(len(driver.columns))]
    condition = where
    for target_col, driver_col in pairs_of(on):
        condition = (F.col(f"t.{quoted(target_col)}") == F.col(f"row.{quoted(driver_col)}")) & condition
    joined = rows.alias("row").join(target.alias("t"), condition, "inner").select(
        "t.*", F.col(f"row.{times}"), *[F.col(f"row.{quoted(c)}").alias(m) for c, m in zip(driver.columns, mine)]
    )
    found = limited(joined, mine, order_by, n)
    again = found.withColumn(times, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times))))
    return again.select(*[col(c) for c in target.columns])


def limited(target: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    if not order_by:
        raise ValueError("a limit per row needs an order")
    candidates, spark = target, target.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(row_hash(target), F.lit(parts))
        candidates = _first(candidates, Window.partitionBy(*[col(k) for k in keys], part), order_by, n)
    # The hash in the partitioning keeps the join below on a shuffle of its own, which
    # lets the adaptive plan split a driver key that repeats very often.
    by_key = Window.partitionBy(F.xxhash64(*[col(k) for k in keys]), *[col(k) for k in keys])
    return _first(candidates, by_key, order_by, n)


def _first(df: DataFrame, group: WindowSpec, order_by: Sequence[Column], n: int) -> DataFrame:
    name = unused("_nth", df)
    nth = F.row_number().over(group.orderBy(*order_by))
    return df.withColumn(name, nth).where(F.col(name) <= n).drop(name)
