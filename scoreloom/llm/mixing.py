"""Mixing sources to target weights: how many words each source is to give, and which documents are repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.hashing import uniform
from scoreloom.llm.common import count_words, lookup, unused, whole_text

# The weights of the sources in code point order, repeating, and the most often a source is repeated.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix"

# The lookup of rates by source is shuffled beyond so many sources, which then spreads a hot source over this many keys.
SALTS = 64


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, target, rate`` of each source of ``sizes(source, size)``.

    The sources share the size of all in proportion to their weights. A target stops at ``cap`` times its source,
    and the excess is shared again by weight until no target is above. So in the end ``target = min(cap * size, level
    * weight)``, and the level is found in one pass over the sources in the order of ``size / weight``: the first
    source that its share does not fill decides it. From there on shares computed that way fall, so it is the largest of them. The table has one row per source, which is why windows over
    all of it are in order; the documents are summed before.

    A source without words gets the target and rate 0. Null is a source of its own, the last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % F.lit(len(weights))
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(after)
    steps = weighed.withColumn("level", level)
    open_level = F.when(cap * F.col("source_size") >= F.col("level") * F.col("weight"), F.col("level"))
    return (
        steps.withColumn("level", F.max(open_level).over(every))
        .withColumn("target", F.least(F.col("source_size") * F.lit(float(cap)), F.col("level") * F.col("weight")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "target", "rate")
    )


def draw_key(doc_id: str = "doc_id") -> Column:
    """What a row's draw depends on: its id, or without one its text. So the rows without an id of a source don't share one draw."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(whole_text())))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """The whole part of the rate, and one more with the probability of the fraction, drawn from the key's hash."""
    drawn = uniform(seed, key)
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def with_rates(docs: DataFrame, rates: DataFrame, draw: Column) -> DataFrame:
    """Join the rates by source, null included; the documents do not move while there are few enough sources."""
    key, salt = unused(docs, "source_key", "salt")
    named = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    keyed = docs.withColumn(key, named).withColumn(salt, F.pmod(F.xxhash64(draw), F.lit(SALTS)))
    rates = rates.withColumn(key, F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    rates = rates.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return lookup(keyed, rates, [key, salt], "inner").drop(key, salt)


def mixed_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` for each row of ``docs(doc_id, text, source)``.

    Size is the number of words; a missing text has none. Rows that repeat a ``doc_id`` in one source share their
    draw, and so do rows without one that repeat a text. An empty table gives no rows.
    """
    sized = docs.select("doc_id", "source", count_words(whole_text()).alias("size"), draw_key().alias("draw"))
    # Text columns are read twice rather than kept: a written table of sizes would move more than it saves.
    rates = source_targets(sized)
    return with_rates(sized, rates, F.col("draw")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies(F.col("rate"), F.col("draw"), seed).alias("copies"),
        (copies(F.col("rate"), F.col("draw"), seed) * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with the columns of ``docs``."""
    rates = source_targets(docs.select("source", count_words(whole_text()).alias("size")))
    rate, number = unused(docs, "rate", "number")
    rates = rates.select("source", F.col("rate").alias(rate))
    taken = with_rates(docs, rates, draw_key()).withColumn(number, copies(F.col(rate), draw_key(), seed))
    repeated = F.explode(F.array_repeat(F.lit(True), F.col(number).cast("int")))
    return taken.where(F.col(number) > 0).withColumn(number, repeated).select(*docs.columns)
