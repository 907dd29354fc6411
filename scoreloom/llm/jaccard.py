"""Similarity join of word-shingle sets by PartEnum signatures.

Sizes are cut into bands. Two sets of a band, or of neighbouring ones, that are similar enough differ in at most k elements,
k following from the band's largest size. The domain of elements is cut by hash into more than k / 2 parts, so in some part the sets
differ in one element at most. Each part is cut into three; of these, the sets agree on two. A signature is the hash of
what a set has in one of the three pairs of such a part: similar sets share one.

Signatures that occur once tell nothing. The signatures of many sets are a chunk, a row of a table bucketed by chunk. To find those
that occur again, each chunk sends out the high bits of its signatures, sorted and as differences, by ranges in which those of all
chunks meet. A bit for each goes back to the chunk, and only signatures that occur again leave it with their sets. Signatures of the same
sets tell the same, so one of them is kept.

Nothing is emitted for all pairs of a signature's sets. In each signature the set that shares most with others leads, and each set is
compared with one of its leaders, so a round has no more pairs than sets. Linked sets are joined to components; then again with leaders of other
components. Only sets that then share a signature but no component are compared with one another,
after parity sketches have ruled out nearly all: each element flips one of 2048 bits, so the sketches
of similar sets differ in at most k bits. For large sets that says little, so they have sketches of 8192 bits besides, and pairs
that are left are compared by sketches of at least 4 k bits. All filters are exact; every link between components is verified on whole sets, which are built for the pairs that pass.

Elements are 64-bit hashes of shingles, and equal sets are known by a 64-bit hash: among n different sets, two are mistaken for
equal with a probability of n² / 2⁶⁵.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import scratch_path, settled
from scoreloom.llm.common import few, from_gaps, from_planes, gaps, give_back, lookup, planes, small_batches, text_slices, unused, whole_text
from scoreloom.llm.components import connected_components

CHUNK = 1 << 20
# Longs of parities; broadcast for up to so many sets, else shuffled with the pairs.
SKETCH = 32
SKETCHED_SETS = 200_000
# Longs of the parities that large sets have besides: those whose linked partners may differ in a quarter of the first ones' bits.
MORE = 128
# Rows of sets with their sketches that a task compares by signature, some 300 bytes each and 1 KB more for large sets.
COMPARED_ROWS = 1 << 16
# The sets of a signature are compared block by block. Rows of a block, those a worker gathers, at least, before it compares, pairs it
# holds at once, and longs of sketches after which it goes on with the pairs that are left.
BLOCK_ROWS = 1 << 11
GATHERED_ROWS = 1 << 13
HELD_PAIRS = 1 << 15
LOOKS = (8, 16)
# A band ends where its first size has grown by the least ratio of linked sizes so many times.
BAND = 2
# Signatures that more than one set has are broadcast up to this number, else shuffled.
SHARED_SIGNATURES = 2_000_000
# Bits of a signature that are kept: two that agree in these make a candidate, which is verified like any other.
SIGNATURE_BITS = 62
# The pairs of the three pieces of a part, and numbers that tell first and second apart.
PAIRS = np.array([[0, 1], [0, 2], [1, 2]])
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# Signatures of a chunk, those that meet in a range, and bits sent beyond their number's.
HELD = 1 << 20
RANGE = 1 << 20
SPARE_BITS = 10
# Rounds in which sets are compared with a leader. They only spare comparisons: what they don't join is compared afterwards.
STAR_ROUNDS = 3
MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins. Sorting is left out, whose copies of millions of numbers workers would keep."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of signatures with their component, which is the set itself while it has no link."""
    rows = members.join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
    return rows.withColumn("component", F.coalesce("component", "set_id"))


@dataclass(frozen=True)
class Join:
    """Shingles of ``words`` words; two sets link when 100 times their intersection is ``percent`` times their union or more."""

    words: int = 5
    percent: int = 80

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """The sorted hashes of each text's shingles: none without words, and one if there are fewer words than a shingle has."""
        known: dict[bytes, int] = {}
        places = [
            np.array([known.setdefault(w, len(known)) for w in t.encode("utf-8", "surrogatepass").lower().split()], np.int64)
            for t in texts
        ]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
        found = []
        for place in places:
            own, n = hashes[place], len(place)
            size = min(n, self.words)
            rolled = np.full(n - size + 1 if n else 0, size, np.uint64)
            for i in range(size):
                rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + own[i : n - size + 1 + i])
            found.append(np.unique(rolled))
        return found

    def set_id(self, elements: np.ndarray) -> int:
        return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)

    def band(self, size: int) -> list[tuple[int, int]]:
        """Number and largest size of the bands in which a set of this size is signed: its own and, if a partner may be larger, the next."""
        number, low, high = 0, 1, 1
        while high < size:
            number, low = number + 1, high + 1
            high = max(low, low * 100**BAND // self.percent**BAND)
        bands = [(number, high)]
        if size * 100 // self.percent > high:
            low = high + 1
            bands.append((number + 1, max(low, low * 100**BAND // self.percent**BAND)))
        return bands

    def parts(self, high: int) -> tuple[int, int]:
        """Parts of the domain for sets up to this size, and how many of them are spare.

        Two sets that differ in k elements differ in two or more in at most k / 2 parts. With as many spare parts as a set has
        weak ones, in which a pair of pieces is empty, its partners agree with it on a pair that is not.
        """
        differ = 2 * high * (100 - self.percent) // (100 + self.percent)
        if not differ:
            return 0, 0
        need = differ // 2 + 1
        low = high * self.percent**BAND / 100**BAND
        spare = 1 + int(6 * need * np.exp(-2 * low / need / 3))
        return need + spare, spare

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """The signatures of one set. A set so small that only equal ones link has none."""
        found = []
        for number, high in self.band(len(elements)):
            parts, spare = self.parts(high)
            if not parts:
                continue
            spread = mixed(elements + np.uint64(number * 0x9E3779B97F4A7C15 & MASK))
            piece = ((spread >> np.uint64(32)) * np.uint64(3 * parts) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(3 * parts, np.uint64)
            np.add.at(sums, piece, mixed(elements))
            empty = (np.bincount(piece, minlength=3 * parts) == 0).reshape(parts, 3)
            full = ~empty[:, PAIRS].all(axis=2)
            if parts - full.all(axis=1).sum() > spare:
                full[:] = True
            one, two = sums.reshape(parts, 3)[:, PAIRS].transpose(2, 0, 1)
            names = np.arange(3 * parts, dtype=np.uint64).reshape(parts, 3) + np.uint64((number << 32) + (parts << 44))
            found.append(mixed(mixed(one + FIRST) * FIRST + mixed(two + SECOND) * SECOND + mixed(names))[full])
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    @staticmethod
    def sketch(elements: np.ndarray) -> np.ndarray:
        """Parities of the numbers of elements in each of 2048 classes."""
        bits = np.bincount((elements % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
        return np.packbits(bits.astype(np.uint8)).view(np.int64)

    def alike(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= self.percent * (len(a) + len(b) - common)

    def possible(self, a: str, b: str) -> Column:
        """Whether sizes and sketches of two rows let their sets link."""
        x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
        sizes = (100 * x >= self.percent * y) & (100 * y >= self.percent * x)
        flips = sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(SKETCH)), F.lit(0))
        return sizes & (flips * (100 + self.percent) <= (x + y) * (100 - self.percent))

    def large(self, size: int) -> bool:
        return 8 * size * (100 - self.percent) // (100 + self.percent) > 64 * SKETCH

    def meeting(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs ``a, b`` of rows ``signature, side, set_id, component, n, s0..., more`` of one signature, if sizes and sketches let them link.

        Rows come sorted by signature. Those of side 0 meet one another and those of side 2, those of side 1 only the latter.
        """
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= GATHERED_ROWS:
                rows = pa.Table.from_batches(held)
                last = int(starts(rows.column("signature").to_numpy())[-1])
                yield from self.met(rows.slice(0, last))
                held = rows.slice(last).to_batches()
                size = len(rows) - last
        if size:
            yield from self.met(pa.Table.from_batches(held))
        give_back()

    def met(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        signature, side, ids, component, n = (rows.column(c).to_numpy() for c in ("signature", "side", "set_id", "component", "n"))
        # Bits are counted in numbers without a sign.
        sketch = [rows.column(f"s{i}").to_numpy().view(np.uint64) for i in range(SKETCH)]
        longer, more = np.zeros(len(rows), bool), np.zeros((0, MORE), np.uint64)
        if "more" in rows.column_names:
            lists = rows.column("more").combine_chunks()
            longer, more = lists.is_valid().to_numpy(zero_copy_only=False), lists.flatten().to_numpy().view(np.uint64).reshape(-1, MORE)
        more_at = np.where(longer, np.cumsum(longer) - 1, -1)
        found = []
        firsts = starts(signature)
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(rows)]):
            own, one, two = (a + np.flatnonzero(side[a:b] == x) for x in range(3))
            for left, right, among in ((own, own, True), (np.concatenate([own, one]), two, False)):
                if not len(left) or not len(right):
                    continue
                step = max(1, HELD_PAIRS // len(right))
                for at in range(0, len(left), step):
                    x, y = left[at : at + step], right[at:] if among else right
                    found.append(self.possible_of(x, y, among, component, n, sketch, more, more_at))
        pairs = np.concatenate(found, axis=1)
        pairs = np.sort(ids[pairs], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    def possible_of(self, x, y, among: bool, component, n, sketch, more, more_at) -> np.ndarray:
        """Places of the pairs of a row in ``x`` and one in ``y`` whose sizes and sketches let their sets link. ``among`` takes pairs that come later in both."""
        p, q = n[x], n[y]
        may = np.not_equal.outer(component[x], component[y])
        may &= np.greater_equal.outer(100 * p, self.percent * q)
        may &= np.less_equal.outer(self.percent * p, 100 * q)
        if among:
            may = np.triu(may, 1)
        shape, most = may.shape, (p + q[:, None]).T * (100 - self.percent) // (100 + self.percent)
        flips, own, bits = np.zeros(shape, np.uint16), np.empty(shape, np.uint64), np.empty(shape, np.uint8)
        for word in sketch[: LOOKS[0]]:
            np.bitwise_count(np.bitwise_xor.outer(word[x], word[y], out=own), out=bits)
            flips += bits
        may &= flips <= np.minimum(most, 64 * SKETCH).astype(np.uint16)
        one, two = np.nonzero(may)
        one, two, flips, most = x[one], y[two], flips[one, two], most[one, two]
        for first, end in zip(LOOKS, [*LOOKS[1:], SKETCH]):
            for word in sketch[first:end]:
                flips += np.bitwise_count(word[one] ^ word[two])
            left = flips <= most
            one, two, flips, most = one[left], two[left], flips[left], most[left]
        # Sets that are not large have no longer sketches.
        large = np.flatnonzero((more_at[one] >= 0) & (more_at[two] >= 0))
        left = np.ones(len(one), bool)
        for at in range(0, len(large), HELD_PAIRS // MORE):
            part = large[at : at + HELD_PAIRS // MORE]
            flips = np.bitwise_count(more[more_at[one[part]]] ^ more[more_at[two[part]]]).sum(axis=1)
            left[part] = flips <= most[part]
        one, two = one[left], two[left]
        return np.stack([one, two])

    def documents(self, texts: DataFrame) -> DataFrame:
        """``doc_id, mark, n, set_id`` of ``texts(doc_id, text)``, with a hash of the text as its mark."""

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, own in text_slices(batches, "text", CHUNK):
                sets = self.sets(own)
                columns = [part.column("doc_id"), part.column("mark"), pa.array([len(s) for s in sets], pa.int64())]
                columns.append(pa.array([self.set_id(s) for s in sets], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n", "set_id"])

        marked = texts.select("doc_id", F.xxhash64("text").alias("mark"), "text")
        return marked.mapInArrow(measure, marked.drop("text").schema.add("n", "long").add("set_id", "long"))

    def each_set(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        """The id and the elements of each set that a task meets, once, if it has any."""
        seen: set[int] = set()
        for _, own in text_slices(batches, "text", CHUNK):
            for elements in self.sets(own):
                name = self.set_id(elements)
                if len(elements) and name not in seen:
                    seen.add(name)
                    yield name, elements

    def chunks(self, texts: DataFrame) -> DataFrame:
        """``chunk, ids, owners, signatures``: the sorted signatures of many sets, and for each the place of its set's id. Equal sets of two tasks count as two."""

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, ids, held, size = TaskContext.get().partitionId() << 32, [], [], 0

            def row() -> pa.RecordBatch:
                owners = np.repeat(np.arange(len(held), dtype=np.uint32), [len(x) for x in held])
                signatures = np.concatenate(held)
                held.clear()
                signatures >>= np.uint64(64 - SIGNATURE_BITS)
                order = np.argsort(signatures)
                owners = planes(owners[order])
                signatures = signatures.view(np.int64)[order]
                del order
                values = [np.array(ids, np.int64).tobytes(), owners, gaps(signatures)]
                columns = [pa.array([number], pa.int64()), *[pa.array([v], pa.binary()) for v in values]]
                return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "owners", "signatures"])

            for name, elements in self.each_set(batches):
                signatures = self.signatures(elements)
                if len(signatures):
                    ids.append(name)
                    held.append(signatures)
                    size += len(signatures)
                if size >= HELD:
                    yield row()
                    number, ids, held, size = number + 1, [], [], 0
            if size:
                yield row()
            give_back()

        spark, name = texts.sparkSession, f"signatures_{uuid.uuid4().hex}"
        made = texts.select("text").mapInArrow(sign, "chunk bigint, ids binary, owners binary, signatures binary")
        written = made.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
        written.option("path", scratch_path(spark, "signatures")).saveAsTable(name)
        return spark.table(name)

    @staticmethod
    def signed(chunks: DataFrame, bits: int, range_bits: int) -> DataFrame:
        """``signature, set_id`` of the signatures whose highest ``bits`` bits occur more than once; rows may repeat."""

        def cells_of(signatures: bytes) -> tuple[np.ndarray, ...]:
            """The cells of a chunk, how many signatures each has, and the ranges of cells and where they start."""
            cells = from_gaps(signatures)
            cells >>= SIGNATURE_BITS - bits
            own = starts(cells)
            counts, cells = np.diff(own, append=len(cells)), cells[own]
            ranges = cells >> (bits - range_bits)
            firsts = starts(ranges)
            return cells, counts, ranges[firsts], firsts

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, signatures in zip(batch.column("chunk").to_pylist(), batch.column("signatures")):
                    cells, counts, ranges, firsts = cells_of(signatures.as_py())
                    again = [np.packbits(n > 1).tobytes() for n in np.split(counts, firsts[1:])]
                    sent = [gaps(c) for c in np.split(cells, firsts[1:])]
                    columns = [pa.array([chunk] * len(ranges), pa.int64()), pa.array(ranges), pa.array(sent, pa.binary()), pa.array(again, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["chunk", "range", "cells", "again"])
            give_back()

        def meet(rows: pa.Table) -> pa.Table:
            sent = [from_gaps(x.as_py()) for x in rows.column("cells")]
            again = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(c)) for x, c in zip(rows.column("again"), sent)])
            ends = np.cumsum([len(c) for c in sent])[:-1]
            cells = np.concatenate(sent)
            sent.clear()
            order = np.argsort(cells)
            firsts = starts(cells[order])
            counts = np.diff(firsts, append=len(cells))
            often = np.empty(len(cells), bool)
            often[order] = np.repeat((counts > 1) | (np.maximum.reduceat(again[order], firsts) > 0), counts)
            answers = [np.packbits(x).tobytes() for x in np.split(often, ends)]
            del cells, order, again, firsts, counts, often
            give_back()
            return pa.table([rows.column("chunk"), rows.column("range"), pa.array(answers, pa.binary())], names=["chunk", "range", "often"])

        def pick(chunk: pa.Table, answers: pa.Table) -> pa.Table:
            signatures = chunk.column("signatures")[0].as_py()
            cells, counts, ranges, firsts = cells_of(signatures)
            told = dict(zip(answers.column("range").to_pylist(), answers.column("often").to_pylist()))
            sizes = np.diff(np.append(firsts, len(cells)))
            often = np.concatenate([np.unpackbits(np.frombuffer(told[r], np.uint8), count=n) for r, n in zip(ranges.tolist(), sizes)])
            kept = np.repeat(often > 0, counts)
            del cells, counts, often
            give_back()
            owners = from_planes(chunk.column("owners")[0].as_py())[kept]
            ids = np.frombuffer(chunk.column("ids")[0].as_py(), np.int64)
            return pa.table({"signature": from_gaps(signatures)[kept], "set_id": ids[owners]})

        sent = chunks.select("chunk", "signatures").mapInArrow(send, "chunk bigint, range bigint, cells binary, again binary")
        answers = sent.groupBy("range").applyInArrow(meet, "chunk bigint, range bigint, often binary")
        return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(pick, "signature long, set_id long")

    def built(self, texts: DataFrame, name: str, more: str, columns) -> DataFrame:
        """``set_id`` and what ``columns`` makes of the sets of ``texts(text, again)``, each set once.

        A set that one task meets again is given once. Those that several tasks may meet are marked by ``again``, and shuffled.
        """

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for part, own in text_slices(batches, "text", CHUNK // 4):
                sets = {self.set_id(s): (s, again) for s, again in zip(self.sets(own), part.column("again").to_pylist())}
                new = [name for name in sets if name not in seen]
                seen.update(new)
                found = {"set_id": pa.array(new, pa.int64()), **columns([sets[n][0] for n in new]), "again": pa.array([sets[n][1] for n in new], pa.bool_())}
                yield pa.RecordBatch.from_pydict(found)
            give_back()

        made = settled(texts.select("text", "again").mapInArrow(build, f"set_id long, {more}, again boolean"), name)
        met_again = settled(made.where("again").dropDuplicates(["set_id"]), f"{name}-again")
        return made.where("not again").unionByName(met_again).drop("again")

    def light(self, texts: DataFrame) -> DataFrame:
        """``set_id, n, s0..., more``: sizes, sketches, and longer sketches of large sets."""
        names = [f"s{i}" for i in range(SKETCH)]

        def columns(sets: list[np.ndarray]) -> dict[str, pa.Array]:
            sketches = np.array([self.sketch(s) for s in sets]).reshape(-1, SKETCH)
            more = [self.parities(s, 64 * MORE).view(np.int64) if self.large(len(s)) else None for s in sets]
            own = {"n": pa.array([len(s) for s in sets], pa.int64()), "more": pa.array(more, pa.list_(pa.int64()))}
            return {**own, **{x: pa.array(np.ascontiguousarray(sketches[:, i])) for i, x in enumerate(names)}}

        return self.built(texts, "light", "n long, more array<long>, " + ", ".join(f"{x} long" for x in names), columns)

    @staticmethod
    def parities(elements: np.ndarray, bits: int) -> np.ndarray:
        return np.packbits((np.bincount((elements % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8))

    def wide_sketch(self, elements: np.ndarray) -> bytes:
        """The set's size, and parities in a power of two of classes, at least 2048 and four times the elements that linked sets of this size differ in."""
        differ = 2 * len(elements) * (100 - self.percent) // (100 + self.percent)
        return len(elements).to_bytes(8, "little") + self.parities(elements, max(64 * SKETCH, 1 << (4 * differ).bit_length())).tobytes()

    def wide_possible(self, a: bytes, b: bytes) -> bool:
        """Whether wide sketches let two sets link. The longer one is folded to the length of the other."""
        sizes = [int.from_bytes(x[:8], "little") for x in (a, b)]
        one, two = (np.frombuffer(x, np.uint8, offset=8) for x in (a, b))
        shape = min(len(one), len(two))
        flips = np.bitwise_xor.reduce(one.reshape(-1, shape)) ^ np.bitwise_xor.reduce(two.reshape(-1, shape))
        return int(np.bitwise_count(flips).sum()) * (100 + self.percent) <= sum(sizes) * (100 - self.percent)

    def verified(self, pairs: DataFrame, wanted: DataFrame, keyed: DataFrame) -> DataFrame:
        """The pairs ``a, b`` whose sets are similar: by wide sketches first, then by their whole sets.

        ``wanted(set_id, row_key, again)`` names the row of ``keyed`` that a set is built from.
        """
        whole = lambda a, b: self.alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
        near = self.compared(pairs, wanted, keyed, "wide", self.wide_sketch, self.wide_possible)
        return self.compared(near, wanted, keyed, "whole", lambda s: s.tobytes(), whole)

    def compared(self, pairs: DataFrame, wanted: DataFrame, keyed: DataFrame, name: str, value, accepts) -> DataFrame:
        """The pairs that ``accepts`` by what ``value`` makes of the two sets. Only sets of the pairs are built."""

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sides = [[x.as_buffer() for x in batch.column(c)] for c in ("x", "y")]
                yield batch.select(["a", "b"]).filter(pa.array([accepts(x, y) for x, y in zip(*sides)], pa.bool_()))
            give_back()

        pairs = settled(pairs, "pairs")
        if pairs.isEmpty():
            return pairs
        ids = settled(pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "asked")
        rows = settled(lookup(wanted, ids, ["set_id"], "inner").select("row_key", "again"), "rows")
        asked = lookup(keyed, rows, ["row_key"], "inner")
        values = self.built(asked, name, "value binary", lambda sets: {"value": pa.array([value(s) for s in sets], pa.binary())})
        both = pairs.join(values.toDF("a", "x"), "a").join(values.toDF("b", "y"), "b").select("a", "b", "x", "y")
        return both.mapInArrow(compare, "a long, b long")

    def components(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_shingles, component_id`` of each row of ``docs(doc_id, text)``, and a hash of its text as ``mark``.

        A component is the smallest ``doc_id`` that links reach. A missing text counts as empty; texts without words link with
        nothing. Rows that repeat an id or a text have equal sets and so one component. Rows without an id take part and
        name no component; one that no row with an id is linked to has none. An empty table gives no rows; other columns are not read.
        """
        with small_batches(docs.sparkSession):
            return self.grouped(docs).drop("lead")

    def grouped(self, docs: DataFrame) -> DataFrame:
        """``components``, and as ``lead`` the least mark in the component of a row that is not alone there."""
        texts = docs.select("doc_id", whole_text().alias("text"))
        measured = settled(self.documents(texts), "documents")
        # A set's elements are built from the row of the least key: every set has one, also where no row of it has an id.
        row_key = F.xxhash64("doc_id", "mark")
        firsts = measured.where("n > 0").groupBy("set_id").agg(
            F.min("doc_id").alias("first"), F.min("mark").alias("lead"), F.min(row_key).alias("row_key"), F.count(F.lit(1)).alias("rows")
        )
        firsts = settled(firsts, "sets")
        size = int(measured.agg(F.coalesce(F.sum("n") + 16 * F.count(F.lit(1)), F.lit(0))).first()[0])
        bits = min(62, size.bit_length() + SPARE_BITS)
        signed = self.signed(self.chunks(texts), bits, max(0, (size // RANGE).bit_length()))
        members = settled(self.shared(settled(signed.repartition("signature").distinct(), "signed")), "members")
        wanted = members.select("set_id").distinct().join(firsts, "set_id").select("set_id", "row_key", (F.col("rows") > 1).alias("again"))
        wanted = settled(wanted, "wanted")
        keyed = texts.withColumn("mark", F.xxhash64("text")).withColumn("row_key", row_key)
        light = self.light(lookup(keyed, wanted.drop("set_id"), ["row_key"], "inner"))
        verified = lambda pairs: settled(self.verified(pairs, wanted, keyed), "links")
        tried = links = docs.sparkSession.createDataFrame([], "a long, b long")
        # Leaders stay the same in all rounds, so sketches are compared, and sent to all tasks, once.
        led = settled(self.led(members.withColumn("component", F.col("set_id")), light), "led")
        for number in range(STAR_ROUNDS):
            left = self.parted(led, settled(connected_components(links), "places")) if number else led
            stars = settled(self.nearest(left, tried), "stars")
            if stars.isEmpty():
                break
            tried, links = tried.unionByName(stars), links.unionByName(verified(stars))
        apart = self.apart(placed(members, settled(connected_components(links), "places")), light)
        links = links.unionByName(verified(apart))
        found = settled(connected_components(links), "components")
        return self.named(measured, firsts, found)

    @staticmethod
    def shared(signed: DataFrame) -> DataFrame:
        """``signature, set_id, weight`` of ``signed`` for signatures of several sets; of signatures of the same sets, one.

        The weight says how many other sets a set meets in the signature and in those left out.
        """
        name = lambda seed: F.bit_xor(F.xxhash64("set_id", F.lit(seed)))
        same = [F.min("set_id").alias("least"), F.max("set_id").alias("most"), F.count(F.lit(1)).alias("sets"), name(1).alias("x"), name(2).alias("y")]
        groups = signed.groupBy("signature").agg(*same).where("sets > 1").groupBy("least", "most", "sets", "x", "y")
        groups = groups.agg(F.min("signature").alias("signature"), F.count(F.lit(1)).alias("times"))
        groups = settled(groups.select("signature", ((F.col("sets") - 1) * F.col("times")).alias("weight")), "groups")
        return lookup(signed, groups, ["signature"], "inner", SHARED_SIGNATURES)

    def possible_pairs(self, pairs: DataFrame, light: DataFrame) -> DataFrame:
        """The rows of ``pairs(a, b)`` whose sizes and sketches let their sets link."""
        if few(light, SKETCHED_SETS):
            light = F.broadcast(light)
        p, q = light.withColumnRenamed("set_id", "a").alias("p"), light.withColumnRenamed("set_id", "b").alias("q")
        return pairs.join(p, "a").join(q, "b").where(self.possible("p", "q")).select(*pairs.columns)

    def stars(self, rows: DataFrame, tried: DataFrame, light: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of a leader and a set of another component: for each set one, of the leaders it may link with that with which it shares most."""
        return self.nearest(self.led(rows, light), tried)

    def led(self, rows: DataFrame, light: DataFrame) -> DataFrame:
        """``a, b, meets, share`` of all pairs of a leader and a set of another component, if sizes and sketches let them link.

        In each signature the set leads that meets the most others in all of its own. Where a group of copies surrounds its original,
        that is the original or a set near it.
        """
        meets = rows.groupBy("set_id").agg(F.sum("weight").alias("meets"))
        known = rows.join(meets, "set_id")
        leaders = known.groupBy("signature").agg(F.max(F.struct("meets", "set_id", "component")).alias("lead"), F.min("component").alias("low"), F.max("component").alias("high"))
        leaders = leaders.where("low != high").select("signature", "lead")
        found = rows.join(leaders, "signature").where(F.col("component") != F.col("lead.component"))
        found = found.groupBy(F.col("lead.set_id").alias("a"), F.col("set_id").alias("b"), F.col("lead.meets").alias("meets")).agg(F.sum("weight").alias("share"))
        return self.possible_pairs(found, light)

    @staticmethod
    def parted(pairs: DataFrame, found: DataFrame) -> DataFrame:
        """The rows of ``pairs(a, b)`` whose sets are in different components. A set without a link is its own."""
        both = pairs.join(found.toDF("a", "x"), "a", "left").join(found.toDF("b", "y"), "b", "left")
        return both.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select(*pairs.columns)

    @staticmethod
    def nearest(led: DataFrame, tried: DataFrame) -> DataFrame:
        """For each set ``b`` the leader ``a`` with which it shares most, of those it was not tried with."""
        best = led.join(tried, ["a", "b"], "left_anti").groupBy("b").agg(F.max(F.struct("share", "meets", "a")).alias("best"))
        return best.select(F.col("best.a").alias("a"), "b")

    def apart(self, rows: DataFrame, light: DataFrame) -> DataFrame:
        """Pairs of sets that share a signature and are in different components, if sizes and sketches let them link.

        In each signature the component with the most sets is not compared with itself, so a large group of
        copies costs nothing here once its sets are joined.
        """
        sizes = rows.groupBy("signature", "component").agg(F.count(F.lit(1)).alias("sets"))
        largest = sizes.groupBy("signature").agg(
            F.max(F.struct("sets", "component"))["component"].alias("most"),
            F.count(F.lit(1)).alias("parts"),
            F.max("sets").alias("alike"),
            F.sum("sets").alias("all"),
        )
        blocks = lambda sets: F.ceil(sets / BLOCK_ROWS).cast("int")
        mixed_up = largest.where("parts > 1").select("signature", "most", blocks(F.col("all") - F.col("alike")).alias("others"), blocks(F.col("alike")).alias("alike"))
        rows = rows.join(mixed_up, "signature").select("signature", "set_id", "component", "most", "others", "alike")
        rows = settled(self.dealt(rows), "apart")
        # Few sketches are looked up after rows have met by signature, so that they are not shuffled with each of them.
        narrow = few(light, SKETCHED_SETS)
        # They are ten times as wide as the rows, whose bytes would otherwise say how many a task sorts.
        tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // COMPARED_ROWS)
        known = rows.repartition(tasks, "signature").join(F.broadcast(light), "set_id") if narrow else rows.join(light, "set_id").repartition(tasks, "signature")
        return known.sortWithinPartitions("signature").mapInArrow(self.meeting, "a long, b long").distinct()

    @staticmethod
    def dealt(rows: DataFrame) -> DataFrame:
        """``signature, side, set_id, component`` of ``rows(signature, set_id, component, most, others, alike)``.

        Sets outside the component with the most are in ``others`` blocks, those in it in ``alike``. For each two blocks to be compared there
        is a signature of its own, unless there is one of each kind.
        """
        cut = (F.col("others") > 1) | (F.col("alike") > 1)
        other = F.col("component") != F.col("most")
        block = F.pmod(F.xxhash64("set_id"), F.when(other, F.col("others")).otherwise(F.col("alike"))).cast("int")
        rows = rows.withColumn("block", block)
        ends = F.when(other, F.col("others") + F.col("alike") - 2).otherwise(F.col("others") - 1)
        rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), ends)))
        k, own, among = F.col("k"), F.col("block"), F.col("k") < F.col("others")
        left = F.when(~other, k).when(among, F.least(own, k)).otherwise(own)
        right = F.when(~other, F.when(own == 0, k).otherwise(F.col("others") + own)).when(among, F.greatest(own, k)).otherwise(k + 1)
        side = F.when(~other, 2).when(~among, 1).when(k == own, 0).when(k > own, 1).otherwise(2)
        name = F.when(cut, F.xxhash64("signature", left, right)).otherwise(F.col("signature"))
        return rows.select(name.alias("signature"), side.alias("side"), "set_id", "component")

    @staticmethod
    def named(measured: DataFrame, firsts: DataFrame, found: DataFrame) -> DataFrame:
        """Documents with the least id and mark of their component. Only sets that more than one row has, or that link, are looked up."""
        joined = firsts.join(found.withColumnRenamed("node", "set_id"), "set_id", "left").where("rows > 1 or component is not null")
        joined = joined.withColumn("component", F.coalesce("component", "set_id"))
        least = joined.groupBy("component").agg(F.min("first").alias("least"), F.min("lead").alias("lead"))
        names = settled(joined.drop("lead").join(least, "component").select("set_id", "least", "lead"), "names")
        own = lookup(measured, names, ["set_id"])
        component = F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
        return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "mark", "lead")

    def without_near_copies(self, docs: DataFrame) -> DataFrame:
        """One document of each group of linked ones: that whose id names the component. The columns are those of ``docs``.

        Rows without an id have no component to name, and go if a linked row has an id; of linked rows none of which has an id,
        one with the text of the least hash stays. Rows that repeat an id are told apart by their text; those that repeat the
        id that names a component all stay.
        """
        with small_batches(docs.sparkSession):
            found = self.grouped(docs)
        nameless = F.col("doc_id").isNull() & F.col("component_id").isNull() & F.col("lead").isNotNull()
        goes = ~F.col("component_id").eqNullSafe(F.col("doc_id")) | (nameless & (F.col("mark") != F.col("lead")))
        found = settled(found.where(goes | nameless).select("doc_id", "mark", goes.alias("goes")).distinct(), "going")
        key, mark = unused(docs, "key", "mark")
        named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
        keyed = docs.withColumn(key, named(F.col("doc_id"))).withColumn(mark, F.xxhash64(whole_text()))
        going = found.where("goes").select(named(F.col("doc_id")).alias(key), F.col("mark").alias(mark))
        left = lookup(keyed, going, [key, mark], "left_anti")
        leads = found.where("not goes").select(F.col("mark").alias(mark))
        if leads.isEmpty():
            return left.select(*docs.columns)
        (lead,) = unused(left, "lead")
        left = lookup(left, leads.withColumn(lead, F.lit(True)), [mark])
        led = F.coalesce(lead, F.lit(False)) & F.col("doc_id").isNull()
        return left.where(~led).select(*docs.columns).unionByName(left.where(led).dropDuplicates([mark]).select(*docs.columns))
