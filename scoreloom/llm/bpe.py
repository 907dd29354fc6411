"""BPE encoding and decoding through a table of distinct words.

Texts are split into words in chunks of documents. A chunk keeps, per document, the places of its words in the chunk's own
list of distinct words, and sends that list out by buckets of a hash. In a bucket the lists of all chunks meet, and
each distinct word is encoded once. The ids go back to the chunks, where they take the words' positions.
A word that every document has is one entry per chunk, so no bucket is hot. Texts never move; the places lie in a
table bucketed by chunk, so they don't move either.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from scoreloom.functions.storage import scratch_path
from scoreloom.llm.common import from_planes, give_back, planes, small_batches, text_slices, whole_text

# Code points of text in a chunk, distinct words and their characters; code points split at once.
CHUNK = 16 << 20
CHUNK_WORDS = 1 << 19
CHUNK_CHARACTERS = 8 << 20
SLICE = 1 << 18
# Documents of a batch that goes back to Spark.
BATCH_ROWS = 500


# Code points below this one, whose categories are the same in every version of Unicode.
LATIN_END = 0x250


def characters(kinds: str) -> str:
    """Members of an expression's brackets: the Latin characters of some categories."""
    return "".join(f"\\u{code:04x}" for code in range(LATIN_END) if unicodedata.category(chr(code))[0] in kinds)


# How byte-level vocabularies split a text, with white space, letters and numbers spelled out.
SPACE, LETTER, NUMBER = r"\t\n\x0b\x0c\r \x85\xa0", characters("L"), characters("N")
LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
FOREIGN = re.compile(rf"[^\u0000-\u{LATIN_END - 1:04x}]")


class Vocabulary:
    """A byte-level BPE vocabulary of the tokenizers library, as its JSON text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.text = file.read()
        # Tokens that stand for themselves wherever their text occurs.
        self.special = {token["content"]: token["id"] for token in json.loads(self.text).get("added_tokens", [])}

    @functools.cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_str(self.text)

    def __getstate__(self) -> dict:
        return {"text": self.text, "special": self.special}

    def words(self, text: str) -> list[str]:
        """The words of a text, in the letters that stand for bytes; a special token is a word of its own."""
        known: dict[str, int] = {}
        places = self.places(text, known)
        names = [self.spelled(word) for word in known]
        return [names[i] for i in places]

    def spelled(self, word: str) -> str:
        """A word in the letters that stand for its bytes. A special token, which nothing else is split into, stays as it is."""
        return word if word in self.special else "".join([self.spelling[b] for b in word.encode()])

    def places(self, text: str, known: dict[str, int]) -> list[int]:
        """The places in ``known`` of the words of a text; new words are added.

        Texts in common Latin letters are split by an expression that says the same as the vocabulary's own, which the library
        applies to all others.
        """
        found = []
        for part in self.parts(text):
            if part in self.special:
                found.append(known.setdefault(part, len(known)))
                continue
            for piece in pieces(part):
                if FOREIGN.search(piece):
                    spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
                    found += [known.setdefault(piece[start:end], len(known)) for _, (start, end) in spans]
                else:
                    found += [known.setdefault(word, len(known)) for word in LATIN.findall(piece)]
        return found

    def parts(self, text: str) -> list[str]:
        parts = [text]
        for token in self.special:
            cut = [x.split(token) if x not in self.special else x for x in parts]
            parts = []
            for x in cut:
                for i, piece in enumerate([x] if isinstance(x, str) else x):
                    parts += [token, piece] if i else [piece]
        return [p for p in parts if p]

    def encode(self, word: str) -> list[int]:
        """The ids of one word, merged by the vocabulary's ranks."""
        return [self.special[word]] if word in self.special else [t.id for t in self.tokenizer.model.tokenize(word)]

    @functools.cached_property
    def letters(self) -> dict[str, int]:
        """Fixed values of byte-level vocabularies: the letter that stands for each byte. Printable bytes stand for themselves."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    @functools.cached_property
    def spelling(self) -> list[str]:
        return [letter for _, letter in sorted((b, letter) for letter, b in self.letters.items())]

    @functools.cached_property
    def piece_bytes(self) -> list[bytes]:
        """The table from ids to the bytes of their pieces."""
        table = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for piece, i in self.tokenizer.get_vocab().items():
            table[i] = piece.encode() if i in self.special.values() else bytes(self.letters[c] for c in piece)
        return table

    def text_of(self, ids: list[int]) -> str:
        piece = self.piece_bytes
        return b"".join([piece[i] for i in ids]).decode("utf-8", "replace")


def pieces(text: str) -> Iterator[str]:
    """A long text in parts of about ``SLICE``, cut where a word begins whatever stands around it.

    That is at a single space between two characters that are no white space. A text without such a place is left whole.
    """
    at = 0
    while len(text) - at > SLICE:
        cut = text.find(" ", at + SLICE)
        while 0 < cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if not 0 < cut < len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of each run, one run after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def places(docs: DataFrame, vocabulary, buckets: int, chunk_size: int) -> DataFrame:
    """Rows of a chunk: one with its documents, and one per bucket with distinct words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"chunk bigint, bucket int, first int, words binary, doc_ids array<{kind}>, sizes array<int>, ranks binary, slots binary"

    def rows(chunk: int, known: dict[str, int], doc_ids: list[pa.Array], slots: list[np.ndarray]) -> pa.RecordBatch:
        """Words are listed by bucket. Documents name them by how frequent they are, which compresses well; ``ranks`` tells the place."""
        words = [vocabulary.value.spelled(word) for word in known]
        bucket = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        names = np.array(words, dtype=object)[order]
        found, firsts = np.unique(bucket[order], return_index=True)
        said = np.concatenate(slots)
        frequent = np.argsort(-np.bincount(said, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[frequent] = np.arange(len(order))
        lists = [zstandard.compress("\n".join(x).encode(), 3) for x in np.split(names, firsts[1:])] if len(names) else []
        n, ids = len(found), pa.concat_arrays(doc_ids)
        ends = pa.array([0] * (n + 1) + [len(ids)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk] * (n + 1), pa.int64()),
                pa.array([*found.tolist(), None], pa.int32()),
                pa.array([*firsts.tolist(), None], pa.int32()),
                pa.array([*lists, None], pa.binary()),
                pa.ListArray.from_arrays(ends, ids),
                pa.array([None] * n + [[len(s) for s in slots]], pa.list_(pa.int32())),
                pa.array([None] * n + [planes(place[frequent])], pa.binary()),
                pa.array([None] * n + [planes(rank[said])], pa.binary()),
            ],
            names=["chunk", "bucket", "first", "words", "doc_ids", "sizes", "ranks", "slots"],
        )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, letters = TaskContext.get().partitionId() << 32, 0, 0
        known, doc_ids, slots = {}, [], []
        for part, texts in text_slices(batches, "text", SLICE):
            for i, text in enumerate(texts):
                before = len(known)
                slots.append(np.array(vocabulary.value.places(text, known), np.int32))
                letters += sum(map(len, itertools.islice(reversed(known), len(known) - before)))
                held += len(text)
                doc_ids.append(part.column("doc_id").slice(i, 1))
                if held >= chunk_size or len(known) >= CHUNK_WORDS or letters >= CHUNK_CHARACTERS:
                    yield rows(number, known, doc_ids, slots)
                    number, held, letters = number + 1, 0, 0
                    known, doc_ids, slots = {}, [], []
                    give_back()
        if doc_ids:
            yield rows(number, known, doc_ids, slots)
        known, doc_ids, slots = {}, [], []
        give_back()

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(split, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk_size: int = CHUNK, digests: bool = False) -> DataFrame:
    """``doc_id, ids`` of each row of ``docs(doc_id, text)``: the ids that the vocabulary gives the whole text.

    With ``digests`` also ``ids_sha256``, of the ids as little-endian unsigned 32-bit integers, and ``decoded_sha256``, of the text
    that they stand for, as ``decode`` gives it. They are made where the ids are put back, so that neither goes back to Spark.

    A missing or empty text has no ids. Rows that repeat an id or a text are encoded like any other. An empty
    table gives no rows; other columns are not read. ``doc_id`` may have any type.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    length = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    buckets = max(partitions, length // chunk_size)
    name = f"places_{uuid.uuid4().hex}"
    made = places(docs, shared, buckets, chunk_size).write.bucketBy(partitions, "chunk").option("compression", "zstd")
    with small_batches(spark):
        made.option("path", scratch_path(spark, "places")).saveAsTable(name)
    table = spark.table(name)

    def encode_bucket(key: tuple, rows: pa.Table) -> pa.Table:
        """Each distinct word of a bucket is encoded once, whichever chunks ask for it."""
        known: dict[str, int] = {}
        asked = []
        for blob in rows.column("words"):
            asked.append([known.setdefault(w, len(known)) for w in zstandard.decompress(blob.as_py()).decode().split("\n")])
        coded = [shared.value.encode(word) for word in known]
        sizes = np.array([len(x) for x in coded], np.int64)
        flat = np.array([i for x in coded for i in x], np.int64)
        starts = np.append(0, np.cumsum(sizes))[:-1]
        counts = [planes(sizes[own]) for own in asked]
        ids = [planes(flat[ragged(starts[own], sizes[own])]) for own in asked]
        del known, asked, coded
        give_back()
        columns = [rows.column("chunk"), rows.column("first"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())]
        return pa.table(columns, names=["chunk", "first", "counts", "ids"])

    answers = (
        table.where(F.col("bucket").isNotNull())
        .select("bucket", "chunk", "first", "words")
        .groupBy("bucket")
        .applyInArrow(encode_bucket, "chunk bigint, first int, counts binary, ids binary")
    )

    def put_back(key: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
        """The ids of a chunk's words at the words' positions."""
        order = np.argsort(found.column("first").to_numpy())
        part = lambda name: np.concatenate([np.zeros(0, "<u4"), *[from_planes(found.column(name)[int(i)].as_py()) for i in order]])
        # A chunk has fewer ids than 2 ** 31, as its lists do.
        counts, ids = part("counts").astype(np.int32), part("ids").astype(np.int32)
        starts = np.append(0, np.cumsum(counts, dtype=np.int32))[:-1]
        place = from_planes(docs.column("ranks")[0].as_py())
        slots = place[from_planes(docs.column("slots")[0].as_py())] if len(place) else place
        word_ends = np.append(0, np.cumsum(docs.column("sizes")[0].values.to_numpy()))
        doc_ids, batches = docs.column("doc_ids")[0].values, []
        # Several batches, so that Spark holds one of them at a time.
        for first in range(0, max(1, len(doc_ids)), BATCH_ROWS):
            words = word_ends[first : first + BATCH_ROWS + 1]
            own = slots[words[0] : words[-1]]
            ends = np.append(0, np.cumsum(counts[own]))[words - words[0]]
            runs = [own[at : at + SLICE] for at in range(0, len(own), SLICE)]
            text_ids = np.concatenate([np.zeros(0, np.int32), *[ids[ragged(starts[run], counts[run])] for run in runs]])
            rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(text_ids, pa.int32()))
            made = {"doc_id": doc_ids.slice(first, BATCH_ROWS), "ids": rows}
            if digests:
                own = [text_ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                made["ids_sha256"] = pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own], pa.string())
                texts = (shared.value.text_of(x.tolist()) for x in own)
                made["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string())
            batches.append(pa.RecordBatch.from_pydict(made))
        del counts, ids, starts, place, slots
        give_back()
        return pa.Table.from_batches(batches)

    kept = table.where(F.col("bucket").isNull()).select("chunk", "doc_ids", "sizes", "ranks", "slots")
    kind = docs.schema["doc_id"].dataType.simpleString()
    together = kept.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    more = ", ids_sha256 string, decoded_sha256 string" if digests else ""
    return together.applyInArrow(put_back, f"doc_id {kind}, ids array<int>{more}")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``, special tokens included.

    The table from ids to pieces has a row per id of the vocabulary, a fixed number, and is looked up by position.
    Bytes that are no UTF-8 come out as replacement characters; a missing list of ids gives a missing text.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf(T.StringType())
    def text_of(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else shared.value.text_of(x.tolist()))

    return encoded.withColumn("decoded", text_of("ids"))


def encoding_report(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the texts encoded and decoded with the vocabulary at ``path``.

    The digests are missing for no row: an empty list of ids has that of no bytes. ``keep_ids`` adds the ids.
    """
    vocabulary = Vocabulary(path)
    both = encode(docs, vocabulary, digests=True)
    tokens = F.size("ids").cast("long").alias("n_tokens")
    return both.select("doc_id", tokens, "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else []))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
