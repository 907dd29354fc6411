"""Collocations: phrases of two to four words that occur often, scored by how seldom their parts occur without each other.

Texts become chunks of word numbers, a row per chunk and language, which lie in a table bucketed by chunk. Phrases of one to
four words are counted in two steps.

1. Each chunk sends out the counts of its phrases by cells, high bits of a hash of language and words. In a bucket of cells
   the counts of all chunks meet; cells that reach the least count go back to the chunks that named them. A phrase can only be
   frequent if its own cell and those of all its parts are (Apriori): each chunk lists the phrases for which this
   holds. None is missing; some that share a cell may be too many. Chunks pack what they list by buckets, in each of
   which a phrase is kept once, however many chunks list it.
2. The candidates are cut into shards of a bounded number. For each shard a double-array trie is broadcast. All text
   positions start at the root of their language, and numpy moves all of them one word on, level by level; the states they
   reach are counted. The counts of all tasks are summed. These are the exact numbers of occurrences.

A phrase that all texts have is one entry per chunk, and one counter per task, so no key is hot. The trie's shards bound what is
broadcast; more phrases mean more passes over the chunks, which hold about two bytes a word.
"""

from __future__ import annotations

import functools
import itertools
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.storage import scratch_path, settled
from scoreloom.llm.common import byte_slices, from_gaps, from_planes, gaps, planes, small_batches, text_slices, whole_text

LEAST = 30
WORDS = 4
# Code points of text that are split at once; words of a chunk, and distinct words and bytes of them, before it is written.
SLICE = 1 << 18
CHUNK_WORDS = 1 << 22
CHUNK_DISTINCT = 1 << 18
CHUNK_BYTES = 1 << 24
# Cells per word of the corpus, as a power of two; cells met in one bucket.
CELL_BITS = 4
BUCKET_CELLS = 1 << 22
# Phrases in a trie.
SHARD = 1 << 19
# Places that are tried for a node's children, and slots that are looked at together.
TRIES, TRIED_SLOTS = 1 << 12, 1 << 20
# Counters that are sent in one row.
BLOCK = 1 << 14

# ASCII letters in lower case, white space within a piece as a space, and what ends a piece as a line feed.
PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\v\f\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
# Numbers of the end of a piece and of what stands between two separators; words start after them.
END, NOTHING = 0, 1


def spread(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Chunk:
    """Word numbers of consecutive texts in one language. Every text and piece ends with ``END``."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {b"\n": END, b"": NOTHING}
        self.codes: list[np.ndarray] = []
        self.words, self.size = 0, 0

    def add(self, text: str) -> None:
        known = self.known
        for part in byte_slices(text.encode("utf-8", "surrogatepass").translate(PIECES), SLICE):
            before = len(known)
            codes = np.array([known.setdefault(w, len(known)) for w in part.replace(b"\n", b" \n ").split(b" ")], np.int32)
            if len(known) > before:
                self.size += sum(map(len, itertools.islice(reversed(known), len(known) - before)))
            codes = codes[codes != NOTHING]
            self.words += int(np.count_nonzero(codes != END))
            self.codes.append(codes)
        self.codes.append(np.zeros(1, np.int32))

    @property
    def full(self) -> bool:
        return self.words >= CHUNK_WORDS or len(self.known) >= CHUNK_DISTINCT or self.size >= CHUNK_BYTES


def names(blob: bytes) -> list[bytes]:
    """The distinct words of a chunk, at the place that their number names."""
    return [b"\n", b"", *zstandard.decompress(blob).split(b"\n")]


def chunked(docs: DataFrame) -> DataFrame:
    """``chunk, lang, n_words, words, codes``: texts as chunks, a task's texts in one language together."""

    def row(number: int, lang: str, chunk: Chunk) -> pa.RecordBatch:
        words = zstandard.compress(b"\n".join(list(chunk.known)[2:]), 3)
        values = [[number], [lang], [chunk.words], [words], [planes(np.concatenate(chunk.codes))]]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["chunk", "lang", "n_words", "words", "codes"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, {}
        for part, texts in text_slices(batches, "text", SLICE):
            for lang, text in zip(part.column("lang").to_pylist(), texts):
                chunk = held.setdefault(lang, Chunk())
                chunk.add(text)
                # Many languages share what one may hold.
                over = sum(c.words for c in held.values()) >= 2 * CHUNK_WORDS or sum(c.size for c in held.values()) >= 4 * CHUNK_BYTES
                for name in list(held) if over else [lang] if chunk.full else []:
                    yield row(number, name, held.pop(name))
                    number += 1
        for name, chunk in held.items():
            yield row(number, name, chunk)
            number += 1

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))
    return texts.mapInArrow(split, "chunk bigint, lang string, n_words bigint, words binary, codes binary")


def phrase_hashes(lang: str, words: list[bytes], codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For lengths 1 to ``WORDS``: the positions at which so many words stand in one piece, and the phrases' hashes."""
    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))[codes]
    at = np.flatnonzero(codes != END)
    rolled = spread(own[at])
    yield 1, at, rolled
    for length in range(2, WORDS + 1):
        # Every text ends with END, so the word after a position exists.
        goes_on = codes[at + length - 1] != END
        at, rolled = at[goes_on], rolled[goes_on]
        rolled = spread(rolled * np.uint64(0x9E3779B97F4A7C15) + own[at + length - 1])
        yield length, at, rolled


def named_phrases(table: DataFrame, cell_bits: int, bucket_bits: int, least: int) -> DataFrame:
    """``bucket, lang, phrases``: of each chunk, those whose cell, and the cells of whose parts, are counted ``least`` times or more.

    The phrases of a chunk are packed by buckets of their hashes, so there are as many rows as chunks and buckets at most.
    """
    shift = np.uint64(64 - cell_bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lang, words, codes in zip(*[batch.column(c).to_pylist() for c in ("chunk", "lang", "words", "codes")]):
                found = [rolled >> shift for _, _, rolled in phrase_hashes(lang, names(words), from_planes(codes).astype(np.int64))]
                cells, counts = np.unique(np.concatenate(found).astype(np.int64), return_counts=True)
                numbers, firsts = np.unique(cells >> (cell_bits - bucket_bits), return_index=True)
                rows = [
                    (chunk, int(number), gaps(own), planes(np.minimum(n, least).astype(np.uint32)))
                    for number, own, n in zip(numbers, np.split(cells, firsts[1:]), np.split(counts, firsts[1:]))
                ]
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "cells", "counts"])

    def answer(rows: pa.Table) -> pa.Table:
        """The cells of a bucket that are counted often enough, for each chunk those that it asked for."""
        asked = [from_gaps(x.as_py()) for x in rows.column("cells")]
        counts = np.concatenate([from_planes(c.as_py()) for c in rows.column("counts")])
        cells, place = np.unique(np.concatenate(asked), return_inverse=True)
        # Each chunk's count stands for itself up to ``least``, at which the cell is frequent whatever is added.
        frequent = np.bincount(place, counts, len(cells))[place] >= least
        ends = np.cumsum([len(x) for x in asked])
        kept = [gaps(own[often]) for own, often in zip(asked, np.split(frequent, ends[:-1]))]
        return pa.table([rows.column("chunk"), rows.column("bucket"), pa.array(kept, pa.binary())], names=["chunk", "bucket", "cells"])

    def name(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        lang, words = chunk.column("lang")[0].as_py(), names(chunk.column("words")[0].as_py())
        codes = from_planes(chunk.column("codes")[0].as_py()).astype(np.int64)
        order = np.argsort(answers.column("bucket").to_numpy())
        frequent = np.concatenate([np.zeros(0, np.int64), *[from_gaps(answers.column("cells")[int(i)].as_py()) for i in order]])
        phrases, buckets, parts = [], [], None
        for length, at, rolled in phrase_hashes(lang, words, codes):
            if parts is not None:
                safe = parts[at] & parts[at + 1]
                at, rolled = at[safe], rolled[safe]
            cells = (rolled >> shift).astype(np.int64)
            place = np.minimum(np.searchsorted(frequent, cells), max(len(frequent) - 1, 0))
            often = frequent[place] == cells if len(frequent) else np.zeros(len(cells), bool)
            at, rolled = at[often], rolled[often]
            parts = np.zeros(len(codes) + 1, bool)
            parts[at] = True
            rolled, firsts = np.unique(rolled, return_index=True)
            phrases += [b" ".join([words[c] for c in codes[i : i + length]]) for i in at[firsts]]
            buckets.append((rolled >> shift).astype(np.int64) >> (cell_bits - bucket_bits))
        packed: dict[int, list[bytes]] = {}
        for bucket, phrase in zip(np.concatenate(buckets).tolist(), phrases):
            packed.setdefault(bucket, []).append(phrase)
        # Sorted phrases begin alike, which packs them closer.
        blobs = [zstandard.compress(b"\n".join(sorted(own)), 3) for own in packed.values()]
        langs = pa.array([lang] * len(packed), pa.string())
        return pa.table({"bucket": pa.array(list(packed), pa.int64()), "lang": langs, "phrases": pa.array(blobs, pa.binary())})

    asked = table.mapInArrow(ask, "chunk bigint, bucket bigint, cells binary, counts binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "chunk bigint, bucket bigint, cells binary")
    kept = table.select("chunk", "lang", "words", "codes")
    return kept.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(name, "bucket bigint, lang string, phrases binary")


def frequent_candidates(named: DataFrame) -> DataFrame:
    """``lang, phrase`` of all phrases that chunks have named, each once."""

    def once(rows: pa.Table) -> pa.Table:
        found: dict[str, set[bytes]] = {}
        for lang, phrases in zip(rows.column("lang").to_pylist(), rows.column("phrases")):
            found.setdefault(lang, set()).update(zstandard.decompress(phrases.as_py()).split(b"\n"))
        langs = pa.array([lang for lang, own in found.items() for _ in own], pa.string())
        phrases = pa.array([phrase for own in found.values() for phrase in own], pa.binary()).cast(pa.string())
        return pa.table({"lang": langs, "phrase": phrases})

    return named.groupBy("bucket").applyInArrow(once, "lang string, phrase string")


class Trie:
    """A double-array trie over words: the state after ``code`` is ``base[state] + code``, if ``check`` there names ``state``.

    The first level are languages, the others words; each has its own numbers, from 1. ``accepting`` has the state of each phrase.
    """

    def __init__(self, langs: pa.Array, phrases: pa.Array) -> None:
        named, split = langs.dictionary_encode(), pc.split_pattern(phrases, " ")
        self.langs = {lang: i for i, lang in enumerate(named.dictionary.to_pylist(), 1)}
        words = split.flatten().dictionary_encode()
        place = words.indices.to_numpy()
        # Common words get small numbers, so that rows with many words are dense.
        common = np.argsort(-np.bincount(place, minlength=len(words.dictionary)), kind="stable")
        code = np.empty(len(common), np.int64)
        code[common] = np.arange(1, len(common) + 1)
        self.codes = {word: i for i, word in enumerate(words.dictionary.take(pa.array(common)).cast(pa.binary()).to_pylist(), 1)}
        sizes = pc.list_value_length(split).to_numpy()
        keys = np.zeros((len(phrases), 1 + WORDS), np.int64)
        keys[:, 0] = named.indices.to_numpy() + 1
        depth = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys[np.repeat(np.arange(len(sizes)), sizes), 1 + depth] = code[place]
        order = np.lexsort(keys.T[::-1])
        keys = keys[order]
        nodes, parents, steps, states = 1, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(keys), np.int64)
        differs = np.zeros(len(keys), bool)
        differs[:1] = True
        above = np.zeros(len(keys), np.int64)
        for depth in range(1 + WORDS):
            differs[1:] |= keys[1:, depth] != keys[:-1, depth]
            goes_on = keys[:, depth] > 0
            opens = differs & goes_on
            own = np.where(goes_on, nodes - 1 + np.cumsum(opens), 0)
            parents.append(above[opens])
            steps.append(keys[opens, depth])
            nodes += int(opens.sum())
            above = own
            states = np.where(goes_on, own, states)
        ends = np.zeros(len(keys), np.int64)
        ends[order] = states
        self.place(np.concatenate(parents), np.concatenate(steps), ends)

    def place(self, parents: np.ndarray, steps: np.ndarray, ends: np.ndarray) -> None:
        """Give the children of each node free slots.

        Nodes with many children come first, at some place between the others where they fit, or else behind them. Such places are
        easily found while the array is sparse, and later for few children. Those with one fill what is left.
        """
        nodes, widest = len(parents) + 1, int(steps.max(initial=0))
        order = np.lexsort((steps, parents))
        heads, firsts, sizes = np.unique(parents[order], return_index=True, return_counts=True)
        base_of = np.zeros(nodes, np.int64)
        used = np.zeros(2 * (widest + nodes) + 64, bool)
        used[0], end = True, 1
        # Always the same numbers, so that a task that is run again builds the same array.
        draw = np.random.default_rng(0)
        for row in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
            codes = steps[order[firsts[row] : firsts[row] + sizes[row]]]
            base = end
            for tries in (TRIES >> 6, TRIES):
                tried = draw.integers(0, end, min(tries, TRIED_SLOTS // len(codes)))
                fits = ~used[tried[:, None] + codes].any(axis=1)
                if fits.any():
                    base = int(tried[np.argmax(fits)])
                    break
            base_of[heads[row]] = base
            used[base + codes] = True
            end = max(end, base + int(codes[-1]) + 1)
            if end + widest >= len(used):
                used = np.append(used, np.zeros(len(used) + widest, bool))
        single = np.flatnonzero(sizes == 1)
        if len(single):
            codes = steps[order[firsts[single]]]
            free = np.append(np.flatnonzero(~used), np.arange(len(used), len(used) + widest + len(single)))
            # Slots after the largest number, so that no base is negative.
            slots = free[np.searchsorted(free, widest) :][: len(single)]
            base_of[heads[single]] = slots - codes
            end = max(end, int(slots[-1]) + 1)
        slots = np.zeros(nodes, np.int64)
        slots[1:] = base_of[parents] + steps
        self.base, self.check = np.zeros(end + widest + 1, np.int32), np.full(end + widest + 1, -1, np.int32)
        self.base[slots], self.check[slots[1:]] = base_of, slots[parents]
        self.accepting = slots[ends].astype(np.int32)

    def __getstate__(self) -> dict:
        arrays = {name: zstandard.compress(getattr(self, name).tobytes(), 3) for name in ("base", "check", "accepting")}
        return {**arrays, "langs": self.langs, "codes": zstandard.compress(b"\n".join(self.codes), 3)}

    def __setstate__(self, state: dict) -> None:
        self.langs = state["langs"]
        self.codes = {word: i for i, word in enumerate(zstandard.decompress(state["codes"]).split(b"\n"), 1)}
        for name in ("base", "check", "accepting"):
            setattr(self, name, np.frombuffer(zstandard.decompress(state[name]), np.int32))

    def count(self, lang: str, words: list[bytes], codes: np.ndarray, totals: np.ndarray) -> None:
        """Add to ``totals`` how often a text reaches each state. All its positions advance together, one word a level."""
        if lang not in self.langs:
            return
        own = np.fromiter((self.codes.get(w, 0) for w in words), np.int32, len(words))
        own[END] = 0
        steps = np.append(own[codes], np.zeros(WORDS, np.int32))
        at = np.flatnonzero(steps)
        states = np.full(len(at), self.base[0] + self.langs[lang], np.int32)
        for level in range(WORDS):
            code = steps[at + level]
            after = self.base[states] + code
            reached = (self.check[after] == states) & (code > 0)
            at, states = at[reached], after[reached]
            totals += np.bincount(states, minlength=len(totals))


def tries(candidates: DataFrame, shard: int) -> DataFrame:
    """``shard, place, lang, phrase, trie``: candidates dealt to tries of about ``shard`` phrases, each of which lies in its first row."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("lang", "ascending"), ("phrase", "ascending")])
        trie = pickle.dumps(Trie(rows.column("lang").combine_chunks(), rows.column("phrase").combine_chunks()))
        place = pa.array(np.arange(len(rows)))
        return rows.append_column("place", place).append_column("trie", pa.array([trie, *[None] * (len(rows) - 1)], pa.binary()))

    shards = int(1.1 * candidates.count() / shard) + 1
    dealt = candidates.select(F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards)).alias("shard"), "lang", "phrase")
    return dealt.groupBy("shard").applyInArrow(build, "shard bigint, lang string, phrase string, place bigint, trie binary")


def shard_counts(table: DataFrame, shard: int, trie: bytes) -> DataFrame:
    """``shard, place, n``: how often each phrase of a trie occurs; every task sends its counters, which are added up in blocks."""
    shared = table.sparkSession.sparkContext.broadcast(pickle.loads(trie))

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, totals = shared.value, np.zeros(0, np.int64)
        for batch in batches:
            for lang, words, codes in zip(*[batch.column(c).to_pylist() for c in ("lang", "words", "codes")]):
                totals = totals if len(totals) else np.zeros(len(trie.base), np.int64)
                trie.count(lang, names(words), from_planes(codes).astype(np.int64), totals)
        if len(totals):
            counts = totals[trie.accepting]
            for start in range(0, len(counts), BLOCK):
                part = counts[start : start + BLOCK]
                halves = [[planes(half.astype(np.uint32))] for half in (part & 0x7FFFFFFF, part >> 31)]
                columns = [pa.array([start], pa.int64()), *[pa.array(half, pa.binary()) for half in halves]]
                yield pa.RecordBatch.from_arrays(columns, names=["start", "low", "high"])

    def add_up(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, total = 0, None
        for batch in rows:
            for start, low, high in zip(*[batch.column(c).to_pylist() for c in ("start", "low", "high")]):
                part = from_planes(low).astype(np.int64) + (from_planes(high).astype(np.int64) << 31)
                total = part if total is None else total + part
        place = pa.array(np.arange(start, start + len(total)))
        yield pa.RecordBatch.from_arrays([place, pa.array(total)], names=["place", "n"])

    parts = table.select("lang", "words", "codes").mapInArrow(advance, "start bigint, low binary, high binary")
    summed = parts.groupBy("start").applyInArrow(add_up, "place bigint, n bigint")
    return summed.select(F.lit(shard).cast("bigint").alias("shard"), "place", "n")


def phrase_counts(docs: DataFrame, least: int = LEAST, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, f`` of the phrases of one to four words that occur ``least`` times or more, and ``lang, n`` of all words.

    A missing text has no words; one whose language is missing counts for ``und``. Rows that repeat an id or a text count like
    any other. An empty table gives no phrases and no languages; columns other than ``lang`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"chunks_{uuid.uuid4().hex}"
    written = chunked(docs).write.bucketBy(partitions, "chunk").option("compression", "zstd")
    with small_batches(spark):
        written.option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    table = spark.table(name)
    totals = settled(table.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
    words = int(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    cell_bits = min(62, max(16, words.bit_length() + CELL_BITS))
    bucket_bits = min(cell_bits, (max(partitions, WORDS * words // BUCKET_CELLS) - 1).bit_length())
    candidates = settled(frequent_candidates(named_phrases(table, cell_bits, bucket_bits, least)), "candidates")
    placed = settled(tries(candidates, shard), "tries")
    found = [
        settled(shard_counts(table, row["shard"], row["trie"]), "counts")
        for number in [r["shard"] for r in placed.select("shard").where("place = 0").collect()]
        for row in placed.where((F.col("place") == 0) & (F.col("shard") == number)).select("shard", "trie").collect()
    ]
    none = spark.createDataFrame([], "shard bigint, place bigint, n bigint")
    counts = functools.reduce(DataFrame.unionByName, found, none).where(F.col("n") >= least)
    counted = placed.join(counts, ["shard", "place"]).select("lang", "phrase", F.col("n").alias("f"))
    return settled(counted, "phrases"), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = 2000, percent: int = 80, shard: int = SHARD) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two to four words of each language.

    ``a`` is how often a phrase occurs, ``l`` and ``r`` how often the two parts of its weakest cut do: that with the least
    ``score = floor(2000000 * a / (l + r))``, and of such the one with the shortest first part. Phrases of which ``percent`` percent or more
    lie in one longer phrase are left out. Ties go by ``a`` and then by the phrase's bytes. Rows are read as by ``phrase_counts``.
    """
    counts, totals = phrase_counts(docs, least, shard)
    words = F.split("phrase", " ")
    phrases = counts.where(F.size(words) > 1).select("lang", "phrase", F.col("f").alias("a"), words.alias("words"))
    joined = lambda start, size: F.concat_ws(" ", F.slice("words", start, size))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    part = lambda column, name: counts.select("lang", F.col("phrase").alias(column), F.col("f").alias(name))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # Shorter phrases of two words or more that lie in longer ones.
    inner = phrases.where(F.size("words") > 2).select("lang", F.col("a").alias("longer"), "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)))
    inner = inner.groupBy("lang", joined(F.col("start"), F.col("size")).alias("phrase")).agg(F.max("longer").alias("longer"))
    covered = F.col("longer").cast("decimal(20, 0)") * 100 >= F.col("a").cast("decimal(20, 0)") * percent
    kept = weakest.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "cut.score")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
