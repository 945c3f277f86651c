"""Lookups by order instead of equality: values in a band, and the rows nearest in time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.bins import Cuts, cuts
from rowloom.functions.types import col, quoted, row_hash, unused
from rowloom.operators.lookup import pairs_of

# Most bins that quantiles are taken for.
MOST_BINS = 1024
# Rows of the target that even bins hold at least, if there are more than 4 for each partition.
BIN_ROWS = 1024
# Copies of driver rows that the optimizer may broadcast; it sizes them by the rows copied.
FEW_COPIES = 100_000
# Pairs of rows that a task compares, about, and the target's rows that a part of a bin holds at least.
TASK_PAIRS = 1 << 26
PART_ROWS = 256
# Bands that a task holds at once for the target's rows of a part, about.
HELD_BANDS = 1 << 16


def _bins(df: DataFrame) -> int:
    return min(MOST_BINS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _column(c: Column | str) -> Column:
    return col(c) if isinstance(c, str) else c


def _reach(ends: DataFrame, first: Column, last: Column, bins: int) -> tuple[int, list[int]]:
    """The number of bands, and how many of them reach each bin."""
    starts = F.struct(first.alias("at"), F.lit(1).alias("n"))
    stops = F.struct((last + 1).alias("at"), F.lit(-1).alias("n"))
    steps = ends.select(F.explode(F.array(starts, stops)).alias("s")).select("s.*")
    found = steps.groupBy("at").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("bands")).collect()
    change = {r["at"]: r["n"] for r in found}
    return sum(r["bands"] for r in found), list(accumulate(change.get(b, 0) for b in range(bins)))


def _dealt(found: Cuts, reach: Sequence[int]) -> tuple[list[int], list[int], int]:
    """The parts that target rows and bands of each bin are dealt to, and the number of tasks
    that all pairs fill."""
    rows = [found.rows * w / sum(found.weights) for w in found.weights]
    pairs = [r * n for r, n in zip(rows, reach)]
    wanted = [ceil(4 * p / TASK_PAIRS) for p in pairs]
    parts = [max(w, min(want, int(r // PART_ROWS))) for w, want, r in zip(found.weights, wanted, rows)]
    tiles = [max(1, ceil(want / p), ceil(n / HELD_BANDS)) for want, p, n in zip(wanted, parts, reach)]
    return parts, tiles, ceil(sum(pairs) / TASK_PAIRS)


def lookup_range(
    driver: DataFrame,
    target: DataFrame,
    value: str,
    low: Column | str | None = None,
    high: Column | str | None = None,
    *,
    on: Mapping[str, str] | Sequence[str] | str | None = None,
    where: Column | None = None,
    inclusive: str = "both",
    bins: Cuts | int | None = None,
) -> DataFrame:
    """For each driver row all target rows whose ``value`` lies from ``low`` to ``high``.

    ``value`` is a target column with an order (number, date, instant), ``low``
    and ``high`` are driver columns or expressions on them; one may be left out.
    ``inclusive`` is ``both``, ``low``, ``high`` or ``neither``. ``on`` adds
    equalities and ``where`` any further condition (``row.x``, ``t.y``), as in
    :func:`~rowloom.operators.lookup.lookup`; driver columns are dropped, equal
    driver rows repeat their result, nulls match nothing.

    Never a comparison of all pairs: target values are cut at their quantiles
    into ``bins`` (a number, or :func:`~rowloom.functions.bins.cuts` taken
    before), a driver row goes to every bin its band reaches, bins are joined by
    equality and the band is checked exactly. A band over k bins returns all
    rows of k - 2 of them, so copies of driver rows stay below the result; with
    ``on``, which leaves little of them, bins are by default as wide as the mean
    band. A bin that one very common value fills is dealt to as many parts as
    even bins it would fill, and the band goes to each.

    One pass over the driver counts the bands that reach each bin. Where the
    pairs to compare fill several tasks, bins are dealt by their pairs to as many
    partitions as they fill, however few bytes they hold: first the target's
    rows, and the bands too where a part would get few rows. Copies of driver
    rows are broadcast only where they are few.

    Without ``on`` the bands of a bin are held and the target's rows run past them,
    so what one target row returns to many bands stands together. The result
    grows with the product of both tables; its repeats, written so, take little
    disk in formats that store runs.
    """
    if low is None and high is None:
        raise ValueError("a band has a low or a high end")
    if inclusive not in ("both", "low", "high", "neither"):
        raise ValueError(f"inclusive is both, low, high or neither, not {inclusive!r}")
    bin_, part, tile, lo, hi = (unused(n, driver, target) for n in ("_bin", "_part", "_tile", "_low", "_high"))
    if bins is None:
        found = cuts(target, col(value), MOST_BINS)
        found = found.merged(MOST_BINS // min(MOST_BINS, max(_bins(target), found.rows // BIN_ROWS)))
    else:
        found = bins if isinstance(bins, Cuts) else cuts(target, col(value), bins)

    ends, conditions = driver, []
    t = F.col(f"t.{quoted(value)}")
    if low is not None:
        ends = ends.withColumn(lo, _column(low)).where(F.col(lo).isNotNull())
        own = F.col(f"row.{lo}")
        conditions.append(t >= own if inclusive in ("both", "low") else t > own)
    if high is not None:
        ends = ends.withColumn(hi, _column(high)).where(F.col(hi).isNotNull())
        own = F.col(f"row.{hi}")
        conditions.append(t <= own if inclusive in ("both", "high") else t < own)
    if low is not None and high is not None:
        ends = ends.where(F.col(lo) <= F.col(hi))

    def reached(within: Cuts) -> list[Column]:
        first = F.lit(0) if low is None else within.bin(F.col(lo))
        last = F.lit(within.count - 1) if high is None else within.bin(F.col(hi))
        return [first, last]

    bands, reach = _reach(ends, *reached(found), found.count)
    shares, tiles, tasks = (found.weights, [], 0) if on else _dealt(found, reach)
    copies = sum(n * s for n, s in zip(reach, shares))
    if on and bins is None and bands:
        shares = (found := found.merged(ceil(sum(reach) / bands))).weights
    share = replace(found, weights=tuple(shares)).weight

    known = target.where(col(value).isNotNull()).withColumn(bin_, found.bin(col(value)))
    # exact copies of a row are told apart by the task they come from
    deal = F.xxhash64(row_hash(target), F.spark_partition_id())
    known = known.withColumn(part, F.pmod(deal, share(F.col(bin_))).cast("int"))
    first, last = reached(found)
    dealt = ends.withColumn(bin_, F.explode(F.sequence(first, last)))
    dealt = dealt.withColumn(part, F.explode(F.sequence(F.lit(0), share(F.col(bin_)) - 1)))
    together = [bin_, part]
    if max(tiles, default=1) > 1:
        together.append(tile)
        across = replace(found, weights=tuple(tiles)).weight(F.col(bin_))
        deal = F.xxhash64(row_hash(driver), F.spark_partition_id())
        dealt = dealt.withColumn(tile, F.pmod(deal, across).cast("int"))
        known = known.withColumn(tile, F.explode(F.sequence(F.lit(0), across - 1)))
    if tasks > 1:
        count = max(tasks, int(target.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        known, dealt = (side.repartition(count, *together) for side in (known, dealt))
    if copies > FEW_COPIES:
        dealt = dealt.hint("merge")

    condition = F.lit(True)
    for c in (*[F.col(f"row.{c}") == F.col(f"t.{c}") for c in together], *conditions):
        condition = condition & c
    for target_col, driver_col in pairs_of(on) if on else ():
        condition = condition & (F.col(f"t.{quoted(target_col)}") == F.col(f"row.{quoted(driver_col)}"))
    if where is not None:
        condition = condition & where
    known, dealt = known.alias("t"), dealt.alias("row")
    # a merge join runs the left rows past the right ones of their key, which it holds in memory: tiles
    # bound the bands, while those of one value of ``on`` have no bound
    joined = dealt.join(known, condition, "inner") if on else known.join(dealt, condition, "inner")
    return joined.select(*[F.col(f"t.{quoted(c)}") for c in target.columns])


def lookup_as_of(
    driver: DataFrame,
    target: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    at: Mapping[str, str],
    n: int = 1,
    *,
    order_by: Sequence[Column] = (),
    direction: str = "before",
    exact: bool = True,
    slices: Cuts | int | None = None,
) -> DataFrame:
    """For each driver row the ``n`` target rows of its key that are nearest in time.

    ``on`` maps target keys to driver keys, ``at`` the target's time to the
    driver's. ``direction`` is ``before`` (the last ``n`` up to the row's time)
    or ``after`` (the first ``n`` from it); ``exact`` counts rows of the very
    time. Rows of one key and time follow ``order_by`` (target columns,
    ascending in time's sense), then a hash of the row. Driver columns are
    dropped, equal driver rows repeat their result, nulls match nothing.

    Time is cut into ``slices`` at its quantiles. Both sides are merged in order
    within (key, slice), which gives each row the number of target rows up to
    it; the counts of earlier slices are carried over as one row per (key,
    slice). A driver row then wants ``n`` numbers of its key, found by equality.
    So the rows of a very common key are ordered in as many tasks as they have
    slices, and are joined spread by number. Rows of one key at one instant
    stay together.
    """
    if n < 1:
        raise ValueError("a limit is at least one row")
    if direction not in ("before", "after"):
        raise ValueError(f"direction is before or after, not {direction!r}")
    (target_time, driver_time), pairs = next(iter(at.items())), pairs_of(on)
    names = [f"_key{i}" for i in range(len(pairs))]
    keys = [unused(k, driver, target) for k in names]
    time, mine, slice_, nth = (unused(c, driver, target) for c in ("_time", "_mine", "_slice", "_nth"))

    asked = driver.select(*[col(d).alias(k) for k, (_, d) in zip(keys, pairs)], col(driver_time).alias(time))
    asked = asked.dropna()
    # equal driver rows get equal answers
    wanted = asked.distinct()
    rows = target.dropna(subset=[*[t for t, _ in pairs], target_time])
    rows = rows.select("*", *[col(t).alias(k) for k, (t, _) in zip(keys, pairs)], col(target_time).alias(time))
    rows = rows.join(wanted.select(*keys).distinct(), keys, "left_semi")
    found = slices if isinstance(slices, Cuts) else cuts(target, col(target_time), slices or _bins(target))

    tie = unused("_tie", driver, target)
    both = rows.select("*", F.lit(True).alias(mine), row_hash(target).alias(tie)).unionByName(
        wanted.withColumn(mine, F.lit(False)), allowMissingColumns=True
    )
    both = both.withColumn(slice_, found.bin(F.col(time)))
    # whether target rows of the same time come before the row that asks
    counted = exact if direction == "before" else not exact
    first = F.col(mine).desc() if counted else F.col(mine).asc()
    inside = Window.partitionBy(*keys, slice_).orderBy(time, first, *order_by, tie)
    own = F.count_if(F.col(mine)).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    numbered = both.withColumn(nth, own)
    before = Window.partitionBy(*keys).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    carried = unused("_carried", driver, target)
    sums = both.groupBy(*keys, slice_).agg(F.count_if(F.col(mine)).alias(nth)).select(
        *keys, slice_, F.coalesce(F.sum(nth).over(before), F.lit(0)).alias(carried)
    )
    placed = numbered.join(sums, [*keys, slice_]).withColumn(nth, F.col(nth) + F.col(carried))

    held = placed.where(F.col(mine)).select(*keys, nth, *[col(c) for c in target.columns])
    ends = (F.col(nth) - n + 1, F.col(nth)) if direction == "before" else (F.col(nth) + 1, F.col(nth) + n)
    need = placed.where(~F.col(mine)).select(*keys, time, F.explode(F.sequence(*ends)).alias(nth))
    nearest = held.join(need, [*keys, nth]).drop(nth)
    return asked.join(nearest, [*keys, time]).select(*[col(c) for c in target.columns])
