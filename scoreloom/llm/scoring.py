"""Scoring texts with a bigram language model by Katz's backoff.

Counts are Good-Turing discounted: counts up to five give up mass by Katz's formula. What a context gives up goes to the words not
seen after it, in proportion to their discounted unigram probabilities, and the backoff weight makes the probabilities of a
context sum to one. What the unigrams give up is the probability of an unknown word.

Documents are kept in chunks, as places in the chunk's list of distinct words. Words, and then word pairs, go out by
buckets of a hash, once per chunk with their counts; buckets merge the counts of all chunks, and answer. So a
frequent word is one entry per chunk. Pairs are dealt by context, which lets a bucket sum up a whole context; a context
with more than a bucket's share of the tokens is split over as many buckets, whose sums are added afterwards.
The tables of words and of pairs are written out, a partition's rows holding the counts for one chunk and bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import scratch_path, settled
from scoreloom.llm.common import text_slices, whole_text

# Code points of text in a chunk, and in what is tokenized at once.
CHUNK = 12 << 20
SLICE = 1 << 20
# Counts above this one are not discounted.
MOST = 5
# Stand for the end of a text and for its beginning; no word holds white space.
END, BEGIN = b"\n", b"\t"

BLOBS = pa.binary()


def pack(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, compressed byte plane after byte plane."""
    values = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), 8).T).tobytes(), 1)


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def discounts(having: np.ndarray) -> np.ndarray:
    """Katz's factors for the counts 0..MOST, from the numbers of items that have the counts 0..MOST+1.

    Where the formula gives none between 0 and 1, as few data may, the factor takes half a count away.
    """
    r = np.arange(1, MOST + 1)
    plain = (r - 0.5) / r
    if having[1] == 0:
        return np.append(1.0, plain)
    n = np.maximum(having.astype(float), 1e-300)
    large = (MOST + 1) * n[MOST + 1] / n[1]
    factors = ((r + 1) * n[2 : MOST + 2] / n[1 : MOST + 1] / r - large) / (1 - large) if large != 1 else plain
    good = (having[1 : MOST + 1] > 0) & (factors > 0) & (factors < 1)
    return np.append(1.0, np.where(good, factors, plain))


@dataclass(frozen=True)
class Unigrams:
    """What all tasks know of single words: tokens and types in training, and the discounts."""

    tokens: int
    types: int
    factors: np.ndarray
    unknown: float
    scarce: bool

    @classmethod
    def of(cls, tokens: int, types: int, having: np.ndarray) -> Unigrams:
        factors = discounts(having)
        counts = np.arange(MOST + 1)
        given = float((having[: MOST + 1] * counts * (1 - factors)).sum())
        scarce = given <= 0 and tokens > 0
        if scarce:  # no count is small enough to be discounted: half a count is taken from each type
            given = 0.5 * types
        return cls(tokens, types, factors, given / tokens if tokens else 1.0, scarce)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if self.scarce:
            kept = counts - 0.5
        else:
            kept = counts * np.where(counts <= MOST, self.factors[np.minimum(counts, MOST)], 1.0)
        return np.where(counts > 0, kept / max(self.tokens, 1), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: one of five, by the CRC-32 of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def places(docs: DataFrame, buckets: int, chunk_size: int) -> DataFrame:
    """Rows of a chunk: one with its documents, and one per bucket with hashes of distinct words and their training counts."""

    def rows(chunk: int, words: dict[bytes, int], ids: list, held: list[bool], slots: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((hashes, bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = np.zeros(len(words), np.int64)
        for own, out in zip(slots, held):
            if not out:
                counts += np.bincount(own, minlength=len(words)) if len(own) * 8 > len(words) else 0
                if len(own) * 8 <= len(words):
                    np.add.at(counts, own, 1)
        counts[words[BEGIN]] = held.count(False)
        found, firsts = np.unique(bucket[order], return_index=True)
        cut = list(zip(firsts, np.append(firsts[1:], len(order))))
        n = len(found)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk] * (n + 1), pa.int64()),
                pa.array([*found.tolist(), None], pa.int64()),
                pa.array([*firsts.tolist(), int(place[words[BEGIN]])], pa.int64()),
                pa.array([pack(hashes[order[a:b]]) for a, b in cut] + [pack(place[np.concatenate(slots)])], BLOBS),
                pa.array([pack(counts[order[a:b]]) for a, b in cut] + [None], BLOBS),
                pa.array([None] * n + [ids], pa.list_(kind)),
                pa.array([None] * n + [held], pa.list_(pa.bool_())),
                pa.array([None] * n + [[len(s) for s in slots]], pa.list_(pa.int64())),
            ],
            names=["chunk", "bucket", "first", "data", "counts", "doc_ids", "held", "sizes"],
        )

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        words, ids, held, slots = {BEGIN: 0, END: 1}, [], [], []
        for part, texts in text_slices(batches, "text", SLICE):
            for doc_id, out, text in zip(part.column("doc_id").to_pylist(), part.column("held").to_pylist(), texts):
                own = [words.setdefault(w, len(words)) for w in text.encode("utf-8", "surrogatepass").lower().split()]
                own.append(1)
                ids.append(doc_id)
                held.append(out)
                slots.append(np.array(own, np.int32))
                size += len(text) + 1
                if size >= chunk_size:
                    yield rows(number, words, ids, held, slots)
                    number, size = number + 1, 0
                    words, ids, held, slots = {BEGIN: 0, END: 1}, [], [], []
        if ids:
            yield rows(number, words, ids, held, slots)

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[doc_type]
    schema = (
        "chunk bigint, bucket bigint, first bigint, data binary, counts binary, "
        f"doc_ids array<{doc_type}>, held array<boolean>, sizes array<bigint>"
    )
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held"), whole_text().alias("text")).mapInArrow(tokenize, schema)


def histogram(counts: np.ndarray) -> np.ndarray:
    """How many items have the counts 0..MOST+1."""
    return np.bincount(counts[counts <= MOST + 1], minlength=MOST + 2)


def word_answers(table: DataFrame, buckets: int) -> DataFrame:
    """For each chunk and bucket the ids and counts of its words; a row of the bucket's totals has no chunk."""
    begin = xxhash.xxh3_64_intdigest(BEGIN)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        hashes = [unpack(x.as_py(), np.uint64) for x in rows.column("data")]
        counts = np.concatenate([unpack(x.as_py()) for x in rows.column("counts")])
        known, place = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(place, counts, len(known)).astype(np.int64)
        ids = np.arange(len(known), dtype=np.int64) * buckets + key[0].as_py()
        ends = np.cumsum([len(h) for h in hashes])
        cut = list(zip(np.append(0, ends[:-1]), ends))
        words = sums[known != begin]
        totals = np.concatenate([[words.sum(), (words > 0).sum()], histogram(words)])
        return pa.table(
            {
                "chunk": pa.array([*rows.column("chunk").to_pylist(), None], pa.int64()),
                "bucket": pa.array([*[-1] * len(cut), None], pa.int64()),
                "first": pa.array([*rows.column("first").to_pylist(), None], pa.int64()),
                "a": pa.array([pack(ids[place[x:y]]) for x, y in cut] + [pack(totals.astype(np.int64))], BLOBS),
                "b": pa.array([pack(sums[place[x:y]]) for x, y in cut] + [None], BLOBS),
                "c": pa.array([None] * (len(cut) + 1), BLOBS),
            }
        )

    wanted = table.where("bucket is not null").select("bucket", "chunk", "first", "data", "counts")
    return wanted.groupBy("bucket").applyInArrow(merge, ANSWERS)


# Of words: the first slot, ids and counts. Of pairs: counts, then six sums per context and the probability of its seen words.
ANSWERS = "chunk bigint, bucket bigint, first bigint, a binary, b binary, c binary"


class Chunk:
    """A chunk's tokens as pairs of words, in the order in which the buckets are asked for them."""

    def __init__(self, docs: pa.Table, words: pa.Table, tokens: int, buckets: int) -> None:
        order = np.argsort(words.column("first").to_numpy())
        part = lambda name: np.concatenate([unpack(words.column(name)[int(i)].as_py()) for i in order])
        ids, self.counts = part("a"), part("b")
        self.sizes = docs.column("sizes")[0].values.to_numpy()
        self.held = np.array(docs.column("held")[0].as_py(), bool)
        self.slots = unpack(docs.column("data")[0].as_py())
        self.starts = np.append(0, np.cumsum(self.sizes)[:-1])
        before = np.append(0, self.slots[:-1])
        before[self.starts] = docs.column("first")[0].as_py()
        pairs, self.place = np.unique(before * len(ids) + self.slots, return_inverse=True)
        trained = np.repeat(~self.held, self.sizes)
        self.trained = np.bincount(self.place, trained, len(pairs)).astype(np.int64)
        self.context, self.word = np.divmod(pairs, len(ids))
        context, word = ids[self.context], ids[self.word]
        self.split = np.maximum(1, -(-self.counts[self.context] * buckets // max(1, tokens)))
        self.bucket = ((mixed(context) + mixed(word + 1) % self.split.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        self.order = np.lexsort((word, context, self.bucket))
        self.context_id, self.word_id = context, word

    def asked(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each bucket with the pairs asked of it, and where a new context begins among them."""
        buckets = self.bucket[self.order]
        starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(buckets))):
            pairs = self.order[a:b]
            context = self.context_id[pairs]
            yield int(buckets[a]), pairs, np.flatnonzero(np.append(True, context[1:] != context[:-1]))


def pair_questions(kept: DataFrame, words: DataFrame, tokens: int, buckets: int) -> DataFrame:
    """Of each chunk and bucket: contexts, how many words each has, over how many buckets it is split, words, and counts."""

    def ask(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(docs, answers, tokens, buckets)
        rows = []
        for bucket, pairs, runs in chunk.asked():
            heads = pairs[runs]
            lengths = np.diff(np.append(runs, len(pairs)))
            parts = (chunk.context_id[heads], lengths, chunk.split[heads], chunk.word_id[pairs], chunk.trained[pairs], chunk.counts[chunk.word[pairs]])
            rows.append((bucket, *map(pack, parts)))
        columns = list(zip(*rows))
        arrays = [pa.array([key[0].as_py()] * len(rows), pa.int64()), pa.array(columns[0], pa.int64())]
        return pa.Table.from_arrays(arrays + [pa.array(c, BLOBS) for c in columns[1:]], names=["chunk", "bucket", *"abcdef"])

    blobs = ", ".join(f"{x} binary" for x in "abcdef")
    return kept.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(ask, f"chunk bigint, bucket bigint, {blobs}")


def pair_answers(questions: DataFrame, unigrams: Unigrams) -> DataFrame:
    """For each chunk and bucket the training counts of its pairs and sums of their contexts.

    The sums of a context are the numbers of words seen 1..MOST times after it and of all words seen, and the unigram probability of
    those. A row without a chunk has the bucket's totals, with the sums of contexts that are split.
    """

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        read = lambda name: [unpack(x.as_py()) for x in rows.column(name)]
        contexts, lengths, splits, words = read("a"), read("b"), read("c"), read("d")
        context = np.concatenate([np.repeat(c, n) for c, n in zip(contexts, lengths)])
        split = np.concatenate([np.repeat(s, n) for s, n in zip(splits, lengths)])
        word, counts, single = np.concatenate(words), np.concatenate(read("e")), np.concatenate(read("f"))
        order = np.lexsort((word, context))
        context, word = context[order], word[order]
        new_context = np.append(True, context[1:] != context[:-1])
        new_pair = new_context | np.append(True, word[1:] != word[:-1])
        pair_of = np.cumsum(new_pair) - 1
        heads = np.flatnonzero(new_pair)
        sums = np.add.reduceat(counts[order], heads)
        context_of = (np.cumsum(new_context) - 1)[heads]
        n = int(context_of[-1]) + 1
        seen = sums > 0
        stats = np.zeros((MOST + 1, n), np.int64)
        for r in range(1, MOST + 1):
            stats[r - 1] = np.bincount(context_of[sums == r], minlength=n)
        stats[MOST] = np.bincount(context_of[seen], minlength=n)
        mass = np.bincount(context_of[seen], unigrams.probability(single[order][heads][seen]), n)
        back = np.empty(len(order), np.int64)
        back[order] = pair_of
        ends = np.cumsum([len(w) for w in words])
        a, b, c = [], [], []
        for x, y, runs in zip(np.append(0, ends[:-1]), ends, lengths):
            own = back[x:y]
            at = context_of[own[np.append(0, np.cumsum(runs)[:-1])]]
            a.append(pack(sums[own]))
            b.append(pack(stats[:, at].ravel()))
            c.append(pack(mass[at]))
        first = np.flatnonzero(new_context)
        hot = np.flatnonzero(split[order][first] > 1)
        a.append(pack(histogram(sums)))
        b.append(pack(np.concatenate([context[first][hot], stats[:, hot].ravel()])))
        c.append(pack(mass[hot]))
        return pa.table(
            {
                "chunk": pa.array([*rows.column("chunk").to_pylist(), None], pa.int64()),
                "bucket": pa.array([key[0].as_py()] * (len(words) + 1), pa.int64()),
                "first": pa.array([None] * (len(words) + 1), pa.int64()),
                "a": pa.array(a, BLOBS),
                "b": pa.array(b, BLOBS),
                "c": pa.array(c, BLOBS),
            }
        )

    return questions.groupBy("bucket").applyInArrow(merge, ANSWERS)


@dataclass(frozen=True)
class Katz:
    """The model as far as all tasks know it: discounts of pairs, and the sums of the contexts that are split."""

    unigrams: Unigrams
    factors: np.ndarray
    split: dict[int, tuple[np.ndarray, float]]

    def log_probability(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray, stats: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """log10 P(word | context), from the counts of the pair, its context and its word.

        A pair that was seen has its discounted share of the context. Another falls back to the word's own
        probability, times what the context gave up by what its unseen words have; after an unseen context that is all.
        """
        single = self.unigrams.probability(word)
        r = np.arange(1, MOST + 1)
        given = (stats[:MOST] * (r * (1 - self.factors[1:]))[:, None]).sum(axis=0)
        scarce = given <= 0  # a context without small counts gives up half a count of each
        given = np.where(scarce, 0.5 * stats[MOST], given)
        kept = np.where(scarce, pair - 0.5, pair * np.where(pair <= MOST, self.factors[np.minimum(pair, MOST)], 1.0))
        total = np.maximum(context, 1)
        weight = given / total / np.maximum(1 - mass, 1e-300)
        fallback = np.where(context > 0, weight, 1.0) * single
        return np.log10(np.where(pair > 0, kept / total, fallback))


def scored(kept: DataFrame, answers: DataFrame, model: Katz, buckets: int) -> DataFrame:
    shared = kept.sparkSession.sparkContext.broadcast(model)

    def score(key: tuple, docs: pa.Table, rows: pa.Table) -> pa.Table:
        model = shared.value
        single = pc.is_valid(rows.column("first"))
        chunk = Chunk(docs, rows.filter(single), model.unigrams.tokens, buckets)
        found = rows.filter(pc.invert(single))
        at = {bucket: i for i, bucket in enumerate(found.column("bucket").to_pylist())}
        logs = np.empty(len(chunk.order))
        for bucket, pairs, runs in chunk.asked():
            a, b, c = (found.column(x)[at[bucket]].as_py() for x in "abc")
            counts, stats, mass = unpack(a), unpack(b).reshape(MOST + 1, -1), unpack(c, np.float64)
            stats, mass = stats.copy(), mass.copy()
            for i in np.flatnonzero(chunk.split[pairs[runs]] > 1):
                stats[:, i], mass[i] = model.split[int(chunk.context_id[pairs[runs[i]]])]
            run = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(pairs))))
            logs[pairs] = model.log_probability(
                counts, chunk.counts[chunk.context[pairs]], chunk.counts[chunk.word[pairs]], stats[:, run], mass[run]
            )
        counts = chunk.counts[chunk.slots]
        total = lambda x: np.add.reduceat(x, chunk.starts)
        return pa.table(
            {
                "doc_id": docs.column("doc_ids")[0].values,
                "held_out": pa.array(chunk.held),
                "n_tokens": pa.array(chunk.sizes),
                "n_known": pa.array(total((counts > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(chunk.sizes), model.unigrams.tokens)),
                "base_score": pa.array(total(model.unigrams.base(counts))),
                "score": pa.array(total(logs[chunk.place])),
            }
        )

    kind = next(f.dataType.elementType.simpleString() for f in kept.schema if f.name == "doc_ids")
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    return kept.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def katz_scores(docs: DataFrame, chunk_size: int = CHUNK) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs(doc_id, text)``.

    The model learns from the documents that are not held out. Words are lower-cased in A-Z; each text ends in one end token, which
    counts, so an empty or missing text has one token. Rows that repeat an id or a text are learned and scored as often as they
    occur. Without any training row every token has the probability one. An empty table gives no rows; other columns are not read.

    To the driver come a row of totals per bucket, and the sums of contexts that are split, at most two per bucket.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    length = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    buckets = max(partitions, length // (chunk_size // 2))
    name = f"tokens_{uuid.uuid4().hex}"
    made = places(docs, buckets, chunk_size).write.bucketBy(partitions, "chunk").option("path", scratch_path(spark, "tokens"))
    made.saveAsTable(name)
    table = spark.table(name)
    kept = table.where("bucket is null").select("chunk", "first", "data", "doc_ids", "held", "sizes")
    words = settled(word_answers(table, buckets), "words")
    totals = [unpack(r["a"]) for r in words.where("chunk is null").select("a").toLocalIterator()]
    sums = np.sum(totals, axis=0) if totals else np.zeros(MOST + 4, np.int64)
    unigrams = Unigrams.of(int(sums[0]), int(sums[1]), sums[2:])
    words = words.where("chunk is not null")
    pairs = settled(pair_answers(pair_questions(kept, words, unigrams.tokens, buckets), unigrams), "pairs")
    having, split = np.zeros(MOST + 2, np.int64), {}
    for row in pairs.where("chunk is null").select("a", "b", "c").toLocalIterator():
        having += unpack(row["a"])
        hot = unpack(row["b"]).reshape(MOST + 2, -1)
        for context, stats, mass in zip(hot[0], hot[1:].T, unpack(row["c"], np.float64)):
            known = split.get(int(context), (0, 0.0))
            split[int(context)] = (known[0] + stats, known[1] + mass)
    model = Katz(unigrams, discounts(having), split)
    return scored(kept, words.unionByName(pairs.where("chunk is not null")), model, buckets)
