"""Document fingerprints by winnowing, in DataFrame functions alone.

A text is cut into pieces, never across white space: a word of up to ``LONG`` characters into strides of four, and a
longer one, such as a text in a script without spaces, into its single characters. So a piece's borders depend on its
word alone, and inside a long word they are everywhere. Hashes roll over every ``GRAM`` consecutive pieces; of each
``WINDOW`` consecutive hashes the least is marked, the rightmost of equal ones, with its position among the k-grams.

Of a passage that two texts share, both cut whole words alike, and also the part of a word at either end if it is longer than
``LONG``. So wherever it begins in a word, a passage leaves a mark that both have if it is of ``2 * LONG + 4 * (GRAM + WINDOW - 1)``
characters or more, white space not counted; from a word's start to a word's end, or inside long words, ``GRAM + WINDOW - 1`` pieces do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import whole_text

PIECE = r"[^\x20\x09-\x0D]{1,4}"
LONG = 16
# Each character of a long word: the first, and any that follows the match before.
LONG_WORD = rf"(?:(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]{{{LONG + 1}}})|(?<!^)\G)[^\x20\x09-\x0D]"
GRAM, WINDOW = 6, 4

# Ranges of ids per shuffle partition: several, so that hashing them to partitions evens out.
RANGES = 4


def with_marks(df: DataFrame, text: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds ``<text>_at`` and ``<text>_hash``: positions and hashes of the marked k-grams, in order.

    A text of fewer pieces than a k-gram has is one k-gram; a text without pieces, or a missing one, has no mark. If there are
    fewer k-grams than a window has, they are one window.
    """
    pieces, grams, at, out = (f"{text}_{x}" for x in ("pieces", "grams", "at", "hash"))
    parted = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), LONG_WORD, "$0 ")
    hashed = F.transform(F.regexp_extract_all(parted, F.lit(PIECE), F.lit(0)), lambda x: F.xxhash64(x))
    n = F.size(pieces)
    rolled = F.transform(F.sequence(F.lit(0), n - gram), lambda i: F.xxhash64(*[F.get(pieces, i + j) for j in range(gram)]))
    none = F.array().cast("array<bigint>")
    all_grams = F.when(n >= gram, rolled).when(n > 0, F.array(F.xxhash64(pieces))).otherwise(none)

    def marked(i: Column) -> Column:
        """Whether some window that holds position i has its rightmost minimum there."""
        own = F.get(grams, i)
        left = [F.coalesce(F.get(grams, i - j) >= own, F.lit(False)) for j in range(1, window)]
        right = [F.coalesce(F.get(grams, i + j) > own, F.lit(False)) for j in range(1, window)]
        cases = [left[:a] + right[: window - 1 - a] for a in range(window)]
        return reduce(Column.__or__, [reduce(Column.__and__, case, F.lit(True)) for case in cases])

    m = F.size(grams)
    single = F.array((m - F.array_position(F.reverse(grams), F.array_min(grams))).cast("int"))
    places = (
        F.when(m == 0, F.array().cast("array<int>"))
        .when(m < window, single)
        .otherwise(F.filter(F.sequence(F.lit(0), m - 1), marked))
    )
    return (
        df.withColumn(pieces, hashed)
        .withColumn(grams, all_grams)
        .withColumn(at, places)
        .withColumn(out, F.transform(at, lambda i: F.get(grams, i)))
        .drop(pieces, grams)
    )


def likeness(a: str, b: str) -> Column:
    """Shared hashes against all hashes of two fingerprints; two without marks are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def fingerprint(text: str) -> Column:
    """A short name of a fingerprint, of its hashes and their positions: equal for equal fingerprints."""
    halves = [F.xxhash64(f"{text}_hash"), F.xxhash64(F.lit(1), f"{text}_at", f"{text}_hash")]
    return F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def followed(texts: DataFrame, columns: list[str], prepare=lambda df: df) -> DataFrame:
    """Each row of ``texts(doc_id, text)`` with ``next_<column>`` of the row that follows by id, the first after the last.

    Ids are cut into ranges at their approximate quantiles, and each range is ordered by itself. The first row of
    a range is also put at the end of the range before, so no row waits for another range. To the driver come
    one quantile and one least id per range. ``prepare`` computes columns once the rows are in place. Rows without an id come first; rows that
    repeat an id follow one another by text, in one range.
    """
    spark = texts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = partitions * RANGES
    cuts = texts.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []
    cuts = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array().cast("array<bigint>")
    of_range = F.coalesce(F.size(F.filter(cuts, lambda cut: cut <= F.col("doc_id"))), F.lit(0))
    placed = texts.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(of_range))
    heads = placed.groupBy("range").agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("nameless"))
    heads = sorted(heads.collect())
    first = F.lit(False)
    before = F.lit(0)
    if heads:
        size = heads[-1]["range"] + 1
        ids, previous = [None] * size, [0] * size
        for i, head in enumerate(heads):
            ids[head["range"]] = None if head["nameless"] else head["id"]
            previous[head["range"]] = heads[i - 1]["range"]
        at = F.col("range") + 1
        first = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in ids]), at).eqNullSafe(F.col("doc_id"))
        before = F.element_at(F.array(*map(F.lit, previous)), at)
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(before.cast("int").alias("range"), F.lit(True).alias("guest"))
    places = F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own)))
    rows = placed.withColumn("place", places).select(*texts.columns, "place.range", "place.guest")
    rows = prepare(rows.repartition(partitions, "range"))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where(~F.col("guest")).drop("range", "guest")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Marks of each text, of its edited text, and their likeness, for each row of ``docs(doc_id, text)``.

    The edited text has its last quarter of code points (rounded down) replaced by as many from the start of the next document's
    text, or all of it. A missing text counts as empty. A table of one row is followed by itself; an empty one gives no rows.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    rows = followed(texts, ["text", "text_hash"], lambda df: with_marks(df, "text"))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = with_marks(rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited), "edited")
    return rows.withColumn("near_edited", likeness("text_hash", "edited_hash")).withColumn(
        "near_next", likeness("text_hash", "next_text_hash")
    )
