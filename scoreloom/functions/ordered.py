"""Ordered scans that do not gather a whole sequence in one task.

A window over ``seq_id`` alone puts every note of a sequence into one task, and one sequence may hold a third of
all rows. The scans here cut each sequence into consecutive blocks and work in three steps:

1. a window inside each (key, block), where the block bounds the rows;
2. one summary row per block, and a window over those summaries for what each block needs from its neighbours;
3. an equi-join of the summary back on (key, block), which is already how the rows are partitioned.

Callers pick the block so that its size has a bound: a number of grid steps for a melody (one note per step),
or a number of pre-aggregated time cells. A stretch of time has no such bound: blocks of time that hold too many rows are counted
first and cut again at quantiles of their rows' times (``cut_dense``), so a second with a million events is many blocks. Where a whole key is known to be small (``SeqSet.bounded``) they pass
``block=None``: the plan is then a single window that shares its exchange with its neighbours.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled

BLOCK_STEPS = 4096
BLOCK_CELLS = 4096
BLOCK_SECONDS = 16.0
PART_ROWS = 1_000_000
# A block of time with more rows than this is cut into parts of about so many, up to this number of parts.
DENSE_ROWS = 100_000
DENSE_PARTS = 1024

StartsRun = Callable[[Column, Column], Column]


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    state: Sequence[str],
    *,
    block: Column | None = None,
    starts_run: StartsRun | None = None,
    reach: str | None = None,
    look_back: int = 1,
    look_ahead: bool = False,
    time: str | None = None,
) -> DataFrame:
    """Add what each row needs from the rows around it.

    ``order`` must be unique within ``keys`` and increase with ``block``. If ``block`` is a stretch of the column ``time``, of which
    ``order`` is a finer order, dense blocks are cut again. Added columns, with rows given as
    structs of ``order`` and ``state``:

    * ``prev`` (and ``prev2`` if ``look_back`` is 2): the rows before; ``next`` if ``look_ahead``;
    * ``reach``: with ``reach=column``, the largest value of that column over all earlier rows;
    * ``run_head`` and ``run_pos``: with ``starts_run(before, row)``, the first row of the current run and the
      1-based position in it. ``before`` is the previous row, or the reach if one is asked
      for; in the latter case a row that starts a run for some reach must also do so for any smaller reach.
    """
    keys = list(keys)
    inside = keys if block is None else [*keys, "_block"]
    if block is not None:
        df = df.withColumn("_block", block)
        if time is not None:
            (df,) = cut_dense([df], keys, time)
    base = df.columns
    ordered = Window.partitionBy(*inside).orderBy(order)
    upto, before = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, -1)

    row = F.struct(order, *state)
    local = {"_row": row, "_rn": F.row_number().over(ordered)}
    local["_prev"] = F.lag(row).over(ordered)
    if look_back == 2:
        local["_prev2"] = F.lag(row, 2).over(ordered)
    if look_ahead:
        local["_next"] = F.lead(row).over(ordered)
    if reach:
        local["_reach"] = F.max(reach).over(before)
    rows = df.withColumns(local)
    if starts_run:
        opens = F.coalesce(starts_run(F.col("_reach" if reach else "_prev"), F.col("_row")), F.lit(True))
        rows = rows.withColumn("_opens", opens)
        head = F.when(F.col("_opens"), F.struct("_rn", "_row"))
        rows = rows.withColumn("_head", F.last(head, ignorenulls=True).over(upto))

    if block is None:
        out = {"prev": F.col("_prev")}
        if look_back == 2:
            out["prev2"] = F.col("_prev2")
        if look_ahead:
            out["next"] = F.col("_next")
        if reach:
            out["reach"] = F.col("_reach")
        if starts_run:
            out["run_head"] = F.col("_head._row")
            out["run_pos"] = F.col("_rn") - F.col("_head._rn") + 1
        return rows.select(*base, *[c.alias(n) for n, c in out.items()])

    carry = _carry(rows, keys, order, starts_run, reach, look_back, look_ahead)
    joined = same_keys(rows, carry, inside)
    first = F.col("_rn") == 1
    out = {"prev": F.when(first, F.col("_c_prev")).otherwise(F.col("_prev"))}
    if look_back == 2:
        out["prev2"] = (
            F.when(first, F.col("_c_prev2")).when(F.col("_rn") == 2, F.col("_c_prev")).otherwise(F.col("_prev2"))
        )
    if look_ahead:
        out["next"] = F.coalesce("_next", "_c_next")
    if reach:
        out["reach"] = F.greatest("_reach", "_c_reach")
    if starts_run:
        run = F.when(_holds(starts_run, reach), _run()).otherwise(F.col("_c_run"))
        out["run_head"] = run["row"]
        out["run_pos"] = F.col("_c_n") + F.col("_rn") - run["rank"] + 1
    return joined.select(*[c for c in base if c != "_block"], *[c.alias(n) for n, c in out.items()])


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be missing: a missing key is equal to a missing key, so no row of ``left`` gets lost."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    equal = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, equal, how).drop(*[f"_right_{k}" for k in keys])


def cut_dense(tables: Sequence[DataFrame], keys: Sequence[str], time: str) -> list[DataFrame]:
    """The tables with dense blocks cut again: ``_block`` becomes a pair of the block and the part of it.

    Blocks are counted over all tables, which share ``keys``, ``_block`` and ``time``. Where none is dense, the
    usual case, the tables are returned as they are. Cuts are quantiles of the rows' times, so rows of one time stay together.
    """
    keys = [*keys, "_block"]
    every = functools.reduce(DataFrame.unionByName, [t.select(*keys, F.col(time).alias("_time")) for t in tables])
    dense = every.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > DENSE_ROWS)
    if dense.isEmpty():
        return list(tables)
    dense = settled(dense, "dense")
    fractions = F.array(*[F.lit(i / DENSE_PARTS) for i in range(1, DENSE_PARTS)])
    cuts = same_keys(every, dense, keys).groupBy(*keys, "_n").agg(F.percentile_approx("_time", fractions, F.lit(10 * DENSE_PARTS)).alias("_cuts"))
    # Of the quantiles every so manieth, for parts of about DENSE_ROWS.
    step = F.greatest(F.floor(F.lit(DENSE_PARTS * DENSE_ROWS) / F.col("_n")), F.lit(1))
    cuts = settled(cuts.select(*keys, F.filter("_cuts", lambda _, i: (i + 1) % step == 0).alias("_cuts")), "cuts")

    def cut(table: DataFrame) -> DataFrame:
        part = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col(time))), F.lit(0))
        found = same_keys(table, cuts, keys, "left").withColumn("_block", F.struct(F.col("_block").alias("block"), part.alias("part")))
        return found.select(*table.columns)

    return [cut(t) for t in tables]


def _carry(rows, keys, order, starts_run, reach, look_back, look_ahead) -> DataFrame:
    """One row per (key, block): what the blocks before and after hand over."""
    summary = [F.max_by("_row", order).alias("_last"), F.count(F.lit(1)).alias("_n")]
    if look_back == 2:
        summary.append(F.max_by("_prev", order).alias("_last2"))
    if look_ahead:
        summary.append(F.min_by("_row", order).alias("_first"))
    if reach:
        summary.append(F.max(reach).alias("_top"))
    if starts_run:
        summary.append(F.max_by("_head", order).alias("_head"))
    blocks = rows.groupBy(*keys, "_block").agg(*summary)

    ordered = Window.partitionBy(*keys).orderBy("_block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    out = {
        "_c_prev": F.lag("_last").over(ordered),
        "_c_n": F.coalesce(F.sum("_n").over(before), F.lit(0)),
    }
    if look_back == 2:
        out["_c_prev2"] = F.coalesce(F.lag("_last2").over(ordered), F.lag("_last", 2).over(ordered))
    if look_ahead:
        out["_c_next"] = F.lead("_first").over(ordered)
    if reach:
        out["_c_reach"] = F.max("_top").over(before)
    blocks = blocks.withColumns(out)
    if starts_run:
        run = F.when(_holds(starts_run, reach), _run())
        blocks = blocks.withColumn("_c_run", F.last(run, ignorenulls=True).over(before))
    return blocks.select(*keys, "_block", *out, *(["_c_run"] if starts_run else []))


def _holds(starts_run: StartsRun, reach: str | None) -> Column:
    """Whether the latest run head found inside a block is still one once the earlier blocks are known."""
    seen = F.col("_c_reach" if reach else "_c_prev")
    confirmed = F.coalesce(starts_run(seen, F.col("_head._row")), F.lit(True))
    return confirmed if reach else (F.col("_head._rn") > 1) | confirmed


def _run() -> Column:
    return F.struct(F.col("_head._row").alias("row"), (F.col("_c_n") + F.col("_head._rn")).alias("rank"))


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    values: Sequence[str],
    name: str = "match",
    bounded: bool = False,
    block_seconds: float = BLOCK_SECONDS,
    rows_per_part: int = PART_ROWS,
) -> DataFrame:
    """Add to each left row the struct ``name`` of the latest right row with ``right_time <= left_time``.

    ``right`` must be unique on (keys, right_time). A row without a time matches nothing, and a missing key matches a
    missing key. If a key is not known to be small, time is cut into blocks, and dense ones are cut again. A
    block that still has many left rows, as many have one time, is dealt to parts of about ``rows_per_part``, each of
    which sees the block's right rows; earlier blocks reach a block through one carried row. Either way the rows are sorted, and no
    left-right pairs are formed.
    """
    keys = list(keys)
    right = right.filter(F.col(right_time).isNotNull())
    hit = F.struct(F.col(right_time).alias("time"), *values)
    if bounded:
        one = left.withColumns({"_t": F.col(left_time), "_side": F.lit(1)})
        two = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), hit.alias("_hit"))
        both = one.unionByName(two, allowMissingColumns=True)
        ordered = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
        found = both.withColumn(name, F.last("_hit", ignorenulls=True).over(ordered)).filter("_side = 1")
        return found.select(*left.columns, name)
    lefts = left.withColumns({"_t": F.col(left_time), "_block": F.floor(F.col(left_time) / block_seconds)})
    rights = right.select(
        *keys,
        F.col(right_time).alias("_t"),
        F.floor(F.col(right_time) / block_seconds).alias("_block"),
        hit.alias("_hit"),
    )
    lefts, rights = cut_dense([lefts, rights], keys, "_t")
    # One row per (key, block): what earlier blocks hand over, and in how many parts to order its left rows.
    sizes = (
        lefts.select(*keys, "_block", F.lit(1).alias("_left"))
        .unionByName(rights.select(*keys, "_block", "_hit"), allowMissingColumns=True)
        .groupBy(*keys, "_block")
        .agg(F.max("_hit").alias("_hit"), F.count("_left").alias("_n"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parts = F.ceil(F.greatest(F.col("_n"), F.lit(1)) / rows_per_part).cast("int")
    blocks = sizes.select(
        *keys, "_block", F.last("_hit", ignorenulls=True).over(earlier).alias("_carry"), parts.alias("_parts")
    )

    inside = [*keys, "_block"]
    part = F.pmod(F.xxhash64(*left.columns), F.col("_parts")).cast("int")
    one = same_keys(lefts, blocks, inside).withColumns({"_part": part, "_side": F.lit(1)})
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    two = same_keys(rights, blocks.drop("_carry"), inside).withColumns({"_part": every, "_side": F.lit(0)})
    ordered = Window.partitionBy(*inside, "_part").orderBy("_t", "_side")
    found = F.last("_hit", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    both = one.unionByName(two, allowMissingColumns=True).withColumn("_found", found).filter("_side = 1")
    return both.select(*left.columns, F.coalesce("_found", "_carry").alias(name))


def block_of(column: Column | str, size: float, bounded: bool) -> Column | None:
    """Block number of a row, or None where its whole key is known to be small."""
    return None if bounded else F.floor((F.col(column) if isinstance(column, str) else column) / size)


def with_group(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], *, bounded: bool) -> DataFrame:
    """Add aggregates of each row's group: by a window where groups are known to be small, and otherwise by a
    mergeable aggregate that is joined back."""
    if bounded:
        group = Window.partitionBy(*keys)
        return df.withColumns({n: c.over(group) for n, c in aggregates.items()})
    return same_keys(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()]), list(keys))
