"""Audit of how the sources of a language differ in their use of terms, in exact whole numbers.

What a term adds to the divergence of two sources depends only on how often each has it. The joint table of two sources, which
says how many terms have count ``a`` here and ``b`` there, is therefore enough. It is one block of a product of matrices: with an
indicator column per (source, count) and a row per term, the transpose times the matrix holds the joint tables of all
pairs of sources. Terms are cut into blocks by hash, sources into blocks of a fixed number. A block's columns with many terms are
multiplied as dense matrices, the others as sparse ones. Each joint table is priced in its block, and prices are added up.

Count zero has no column: terms of which only one source has any are what its column holds beyond the joint table.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled
from scoreloom.llm.common import byte_slices, lookup, text_slices, whole_text

UNIT = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
SLICE = 1 << 20
# Different terms that a task holds before it sends their counts on.
HELD_TERMS = 1 << 18
# Sources in a block of the product; counts of terms in one.
SOURCES = 256
BLOCK_ENTRIES = 1 << 20
# Columns that are multiplied as dense ones, and terms in a step of that. Numbers below 2^24 are exact in single precision.
DENSE_COLUMNS = 256
DENSE_ROWS = 1 << 14

# Letters: ASCII ones in lower case, and all that is not ASCII. Everything else is written as a space.
LETTERS = bytes(b if b > 0x7F or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, documents``: occurrences, and documents with any, added up over tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        groups: dict[tuple, int] = {}
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            group, code, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            keys, place = np.unique(group * max(len(known), 1) + code, return_inverse=True)
            sums, rows = np.bincount(place, n, len(keys)).astype(np.int64), np.bincount(place, minlength=len(keys))
            names, terms = list(groups), pa.array(list(known), pa.binary()).cast(pa.string())
            own = (keys // max(len(known), 1)).tolist()
            columns = [pa.array([names[g][i] for g in own], pa.string()) for i in range(2)]
            columns += [terms.take(pa.array(keys % max(len(known), 1))), pa.array(sums), pa.array(rows.astype(np.int64))]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "documents"])

        size = 0
        for part, texts in text_slices(batches, "text", SLICE):
            for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts):
                group = groups.setdefault((lang, source), len(groups))
                codes = [np.zeros(0, np.int64)]
                for piece in byte_slices(text.encode("utf-8", "surrogatepass").translate(LETTERS), SLICE):
                    codes.append(np.array([known.setdefault(w, len(known)) for w in piece.split()], np.int64))
                code, n = np.unique(np.concatenate(codes), return_counts=True)
                held.append((np.full(len(code), group), code, n))
                size += len(code)
            if len(known) >= HELD_TERMS or size >= 8 * HELD_TERMS:
                yield flush()
                known.clear(), groups.clear(), held.clear()
                size = 0
        if size:
            yield flush()

    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], whole_text().alias("text"))
    rows = texts.mapInArrow(count, "lang string, source string, term string, n bigint, documents bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def level(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(UNIT * (count + 1) / total)``, exact for totals below 9 * 10^15: three digits at a time."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return 1 + whole


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / q)``; both are at most ``UNIT + 1``, so the square fits."""
    return (p - q) * (p - q) // q


def exact_sums(values: np.ndarray, times: np.ndarray, group: np.ndarray, groups: int) -> list[int]:
    """Sums of ``values * times`` by group, of any size: values below 2^60 in halves, each times numbers below 2^31."""
    found = []
    for half in (values & 0x3FFFFFFF, values >> 30):
        low, high = np.zeros(groups, np.int64), np.zeros(groups, np.int64)
        product = half * times
        np.add.at(low, group, product & 0x7FFFFFFF)
        np.add.at(high, group, product >> 31)
        found.append([(y << 31) + x for x, y in zip(low.tolist(), high.tolist())])
    return [x + (y << 30) for x, y in zip(*found)]


def joint_levels(term: np.ndarray, column: np.ndarray, terms: int, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries above the diagonal of the indicator matrix's transpose times itself: two columns and their common terms.

    ``term`` is sorted, with the columns of each in order.
    """
    sizes = np.bincount(column, minlength=columns)
    heavy = np.argsort(-sizes, kind="stable")[:DENSE_COLUMNS]
    heavy = np.sort(heavy[sizes[heavy] * 16 > terms])
    place = np.full(columns, -1, np.int64)
    place[heavy] = np.arange(len(heavy))
    dense = np.zeros((len(heavy), len(heavy)), np.int64)
    filled = place[column] >= 0
    for start in range(0, terms if len(heavy) else 0, DENSE_ROWS):
        part = slice(*np.searchsorted(term, [start, start + DENSE_ROWS]))
        rows, own = term[part][filled[part]] - start, place[column[part][filled[part]]]
        block = np.zeros((DENSE_ROWS, len(heavy)), np.float32)
        block[rows, own] = 1
        dense += (block.T @ block).astype(np.int64)
    x, y = np.nonzero(np.triu(dense, 1))
    keys, counts = [heavy[x] * columns + heavy[y]], [dense[x, y]]
    # The k-th neighbours of all entries within their term, unless both columns are dense.
    apart = 1
    here = np.arange(len(term))
    while len(here):
        here = here[here + apart < len(term)]
        here = here[term[here] == term[here + apart]]
        sparse = here[~(filled[here] & filled[here + apart])]
        found, n = np.unique(column[sparse] * columns + column[sparse + apart], return_counts=True)
        keys.append(found)
        counts.append(n)
        apart += 1
    keys, back = np.unique(np.concatenate(keys), return_inverse=True)
    return keys // columns, keys % columns, np.bincount(back, np.concatenate(counts), len(keys)).astype(np.int64)


def block_prices(key: tuple, rows: pa.Table, sources: pa.Table, per_block: int) -> pa.Table:
    """``lang, x, y, value``: what the terms of a block that two sources share add to their divergences, either way.

    ``key`` names the language and two blocks of ``per_block`` sources.

    A term with counts a and b is priced ``f(a, b) - f(a, 0) - f(0, b) + f(0, 0)``; ``marginal_prices`` has the rest.
    """
    sids, totals = sources.column("sid").to_numpy(), sources.column("total").to_numpy()
    order = np.argsort(sids)
    sids, totals = sids[order], totals[order]
    found: dict[tuple[int, int], int] = {}
    if len(rows):
        lists = rows.column("sids").combine_chunks()
        term = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
        source = np.searchsorted(sids, lists.flatten().to_numpy())
        count = rows.column("counts").combine_chunks().flatten().to_numpy()
        # A column of the indicator matrix for each source and count.
        (owner, own), column = np.unique(np.stack([source, count]), axis=1, return_inverse=True)
        column = column.ravel()
        order = np.lexsort((column, term))
        a, b, common = joint_levels(term[order], column[order], len(rows), len(owner))
        keep = owner[a] != owner[b]
        if key[1] != key[2]:
            keep &= sids[owner[a]] // per_block != sids[owner[b]] // per_block
        a, b, common = a[keep], b[keep], common[keep]
        p, zero = level(own, totals[owner]), level(np.zeros(len(sids), np.int64), totals)
        for a, b in ((a, b), (b, a)):
            x, y = owner[a], owner[b]
            pairs, group = np.unique(x * len(sids) + y, return_inverse=True)
            for sign, values in ((1, price(p[a], p[b])), (-1, price(p[a], zero[y])), (-1, price(zero[x], p[b])), (1, price(zero[x], zero[y]))):
                for pair, value in zip(pairs.tolist(), exact_sums(values, common, group, len(pairs))):
                    found[pair] = found.get(pair, 0) + sign * value
    pairs = np.array(list(found), np.int64)
    values = pa.array([Decimal(v) for v in found.values()], pa.decimal128(38, 0))
    langs = pa.array([key[0].as_py()] * len(pairs), pa.string())
    x, y = (pa.array(sids[at] if len(pairs) else pairs) for at in (pairs // max(len(sids), 1), pairs % max(len(sids), 1)))
    return pa.table({"lang": langs, "x": x, "y": y, "value": values})


def likelihood(count: Column, total: Column) -> Column:
    """``level`` as a column."""
    times = F.lit(UNIT).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + 1)
    return F.lit(1) + F.call_function("div", times, F.greatest(total, F.lit(1)).cast("decimal(20,0)"))


def cost(p: Column, q: Column) -> Column:
    """``price`` as a column."""
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The tables of an audit, each written once: ``terms(lang, term, n, entries)``, ``langs(lang, v, total)``, ``sources(lang, source, sid, total)``.

    A missing text, language or source counts as empty. Rows that repeat an id or a text count like any other; a term's documents are
    rows. Texts are read whole. An empty table gives no rows, and other columns are not read.
    """

    def __init__(self, docs: DataFrame) -> None:
        keys = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint") - 1
        named = settled(keys.withColumn("sid", number), "sources")
        counts = lookup(term_counts(docs), named, ["lang", "source"], "inner")
        terms = counts.groupBy("lang", "term").agg(
            F.sum("n").alias("n"), F.sum("documents").alias("documents"), F.collect_list(F.struct("sid", F.col("n").alias("count"))).alias("entries")
        )
        self.terms = settled(terms.where(F.col("documents") >= LEAST_DOCUMENTS).drop("documents"), "terms")
        self.entries = self.terms.select("lang", "term", "n", F.inline("entries"))
        kept = self.terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"), F.sum(F.size("entries")).alias("entries"))
        langs = keys.select("lang").distinct().join(kept, "lang", "left").na.fill(0)
        self.langs = settled(langs.withColumn("total", F.col("n") + F.col("v")).drop("n"), "langs")
        own = self.entries.groupBy("lang", "sid").agg(F.sum("count").alias("own"))
        sources = named.join(own, ["lang", "sid"], "left").join(self.langs.select("lang", "v"), "lang")
        self.sources = settled(sources.select("lang", "source", "sid", "v", (F.coalesce("own", F.lit(0)) + F.col("v")).alias("total")), "totals")

    def joint_prices(self) -> DataFrame:
        """``lang, x, y, value`` from the joint tables, one product of matrices per block of terms and two blocks of sources."""
        per_block = SOURCES

        def priced_block(key: tuple, rows: pa.Table, sources: pa.Table) -> pa.Table:
            return block_prices(key, rows, sources, per_block)

        blocks = self.sources.groupBy("lang").agg((F.max("sid") / per_block).cast("bigint").alias("last"))
        cuts = self.langs.where("v > 0").join(blocks, "lang")
        cuts = settled(cuts.select("lang", "last", F.ceil(F.col("entries") / BLOCK_ENTRIES).alias("shards")), "cuts")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))
        pairs = cuts.withColumn("a", every).withColumn("b", F.explode(F.sequence("a", "last")))
        inside = lambda sid: F.floor(sid / per_block).isin(F.col("a"), F.col("b"))
        shared = lookup(self.terms.where(F.size("entries") > 1), pairs, ["lang"], "inner")
        shared = shared.withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))
        shared = shared.withColumn("entries", F.filter("entries", lambda e: inside(e["sid"]))).where(F.size("entries") > 1)
        shared = shared.select("lang", "a", "b", "shard", F.col("entries.sid").alias("sids"), F.col("entries.count").alias("counts"))
        totals = self.sources.join(pairs, "lang").where(inside(F.col("sid")))
        totals = totals.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
        key = ["lang", "a", "b", "shard"]
        # New names, as both sides of the cogroup come from the same pairs of blocks.
        totals = totals.select(*[F.col(k).alias(k) for k in key], "sid", "total")
        priced = shared.groupBy(*key).cogroup(totals.groupBy(*key)).applyInArrow(priced_block, "lang string, x bigint, y bigint, value decimal(38,0)")
        return priced.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))

    def marginal_prices(self) -> DataFrame:
        """``lang, x, y, value``: what each source's counts add beyond count zero, as if the other source had none of its terms."""
        levels = self.entries.groupBy("lang", "sid", "count").agg(F.count(F.lit(1)).alias("terms"))
        own = levels.join(self.sources.select("lang", "sid", F.col("total").alias("mine")), ["lang", "sid"])
        other = self.sources.select("lang", F.col("sid").alias("other"), F.col("total").alias("theirs"))
        both = lookup(own, other, ["lang"], "inner").where("sid != other")
        p, p0, q0 = likelihood(F.col("count"), F.col("mine")), likelihood(F.lit(0), F.col("mine")), likelihood(F.lit(0), F.col("theirs"))
        both = both.select("lang", "sid", "other", F.col("terms").cast("decimal(18,0)").alias("terms"), p.alias("p"), p0.alias("p0"), q0.alias("q0"))
        there = F.col("terms") * (cost(F.col("p"), F.col("q0")) - cost(F.col("p0"), F.col("q0"))).cast("decimal(19,0)")
        back = F.col("terms") * (cost(F.col("q0"), F.col("p")) - cost(F.col("q0"), F.col("p0"))).cast("decimal(19,0)")
        sums = both.groupBy("lang", "sid", "other").agg(F.sum(there).alias("there"), F.sum(back).alias("back"))
        ways = F.array(F.struct(F.col("sid").alias("x"), F.col("other").alias("y"), F.col("there").alias("value")), F.struct(F.col("other").alias("x"), F.col("sid").alias("y"), F.col("back").alias("value")))
        return sums.select("lang", F.inline(ways)).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))

    def pairs(self) -> DataFrame:
        """``lang, source, item, value``: the divergence of each source from each other one of its language, over all terms."""
        added = self.joint_prices().unionByName(self.marginal_prices()).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
        one = self.sources.select("lang", "source", "v", F.col("sid").alias("x"), F.col("total").alias("mine"))
        two = self.sources.select("lang", F.col("source").alias("item"), F.col("sid").alias("y"), F.col("total").alias("theirs"))
        every = one.join(two, "lang").where("x != y").join(added, ["lang", "x", "y"], "left")
        none = cost(likelihood(F.lit(0), F.col("mine")), likelihood(F.lit(0), F.col("theirs"))).cast("decimal(19,0)") * F.col("v").cast("decimal(18,0)")
        value = F.when(F.col("v") > 0, F.coalesce("value", F.lit(0)) + none).otherwise(0).cast("bigint")
        return every.select("lang", "source", "item", value.alias("value"))

    def terms_above(self) -> DataFrame:
        """``lang, source, item, value`` of each term that is more likely in a source than in its language."""
        langs = self.langs.select("lang", F.col("total").alias("all"))
        found = lookup(lookup(self.entries, self.sources.select("lang", "source", "sid", "total"), ["lang", "sid"], "inner"), langs, ["lang"], "inner")
        p, q = likelihood(F.col("count"), F.col("total")), likelihood(F.col("n"), F.col("all"))
        found = found.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
        return found.select("lang", "source", "item", cost(F.col("p"), F.col("q")).alias("value"))


def audit_report(docs: DataFrame, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has all pairs of sources, part ``term`` each source's first ``top_terms`` terms.

    Ranks go by value, largest first, and then by the item's bytes.
    """
    audit = Audit(docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    pairs = audit.pairs().withColumn("rank", rank)
    terms = audit.terms_above().withColumn("rank", rank).where(F.col("rank") <= top_terms)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
