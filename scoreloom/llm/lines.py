"""Quality rules: repetition inside a document, and lines that many documents of a host share.

The normalised lines of each text are hashed and written as a table once. From it the different texts of a host
that contain a line are counted, and lines above the limits are collected for the texts that have them. A second pass over the
documents measures each text, removes those lines, and rejects documents of which too little is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled
from scoreloom.llm.common import lookup, text_slices, whole_text

SLICE = 1 << 20
WINDOW = 5
SPACE, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
# Normalised lines: ASCII letters in lower case, each ASCII digit as a zero, one space between words.
NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "words_left")


def repeated_words(texts: list[list[bytes]]) -> np.ndarray:
    """For each list of words, how many lie in a window of ``WINDOW`` words that occurs twice or more in the list.

    Windows are numbered word by word through sorted pairs of numbers, so that different windows differ.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for t in texts for w in t], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    last = max(len(codes) - WINDOW + 1, 0)
    starts = np.flatnonzero(owner[:last] == owner[len(codes) - last :])
    number = owner[starts]
    for i in range(WINDOW):
        _, number = np.unique(number * len(known) + codes[starts + i], return_inverse=True)
    again = starts[np.bincount(number, minlength=1)[number] > 1]
    covers = np.zeros(len(codes) + 1, np.int64)
    covers[again] += 1
    covers[again + WINDOW] -= 1
    return np.bincount(owner[np.cumsum(covers)[:-1] > 0], minlength=len(texts))


def line_hash(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


@dataclass(frozen=True)
class LineRules:
    """A line goes if more than ``most_documents`` texts of its host have it, and more than ``most_percent`` percent of the host's texts.

    A document goes if it fails the rules on words, or if after that fewer than ``least_words`` words or less than ``least_percent``
    percent of its words are left. Equal texts of a host count once, so that copies alone make no line frequent. The host is
    named by the column ``host``; documents without one are a host of their own.
    """

    most_documents: int = 20
    most_percent: int = 1
    least_words: int = 10
    least_percent: int = 50
    repeated_percent: int = 20
    host: str = "source"

    def keyed(self, docs: DataFrame) -> DataFrame:
        """``host, mark, text, row``: each document as a whole beside what its lines depend on."""
        host = F.when(F.col(self.host).isNull(), "").otherwise(F.concat(F.lit("="), F.col(self.host).cast("string")))
        text = whole_text()
        return docs.select(host.alias("host"), F.xxhash64(text).alias("mark"), text.alias("text"), F.struct(*docs.columns).alias("row"))

    def lines(self, keyed: DataFrame) -> DataFrame:
        """``host, mark, lines``: hashes of the different normalised lines of each text that have a word."""

        def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, texts in text_slices(batches, "text", SLICE):
                own = [[w for w in map(bytes.split, t.encode("utf-8", "surrogatepass").translate(NORMAL).split(b"\n")) if w] for t in texts]
                found = pa.array([list({line_hash(w) for w in lines}) for lines in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("host"), part.column("mark"), found], names=["host", "mark", "lines"])

        return keyed.select("host", "mark", "text").mapInArrow(hashes, "host string, mark bigint, lines array<bigint>")

    def frequent(self, lines: DataFrame) -> DataFrame:
        """``host, line, documents`` of the lines above the limits. Rows of ``lines`` are ``host, mark, lines``."""
        texts = lines.select("host", "mark").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
        each = lines.select("host", "mark", F.explode("lines").alias("line")).distinct()
        counted = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") > self.most_documents)
        above = lookup(counted, settled(texts, "texts"), ["host"], "inner").where(F.col("documents") * 100 > F.col("texts") * self.most_percent)
        return above.select("host", "line", "documents")

    def going(self, keyed: DataFrame) -> DataFrame:
        """``host, mark, going``: the frequent lines of each text that has any."""
        lines = settled(self.lines(keyed), "lines")
        each = lines.select("host", "mark", F.explode("lines").alias("line"))
        found = lookup(each, settled(self.frequent(lines), "frequent"), ["host", "line"], "inner")
        return found.groupBy("host", "mark").agg(F.collect_set("line").alias("going"))

    def measured(self, docs: DataFrame) -> DataFrame:
        """``row``, the document; ``cleaned``, its text without frequent lines; counts; ``base_failed``; and ``kept``, the verdict."""
        keyed = self.keyed(docs)
        marked = lookup(keyed, settled(self.going(keyed), "going"), ["host", "mark"]).select("row", "text", "going")

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, texts in text_slices(batches, "text", SLICE):
                raw = [t.encode("utf-8", "surrogatepass") for t in texts]
                words = [t.split() for t in raw]
                chars = [len(text) - len(data) + len(data.translate(None, SPACE)) for text, data in zip(texts, raw)]
                symbols = [len(data) - len(data.translate(None, SYMBOLS)) for data in raw]
                lines = [[line for line in data.split(b"\n") if line.strip(SPACE)] for data in raw]
                repeats = [len(own) - len(set(own)) for own in lines]
                cut = [self.cut(text, data, gone) for text, data, gone in zip(texts, raw, part.column("going").to_pylist())]
                counts = [[len(w) for w in words], chars, symbols, repeats, repeated_words(words), [len(w) - n for w, (_, n) in zip(words, cut)]]
                columns = [part.column("row"), pa.array([t for t, _ in cut], pa.string()), *[pa.array(c, pa.int64()) for c in counts]]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "cleaned", *MEASURES])

        schema = marked.select("row").schema.add("cleaned", "string")
        for name in MEASURES:
            schema = schema.add(name, "long")
        found = marked.mapInArrow(measure, schema)
        failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * self.repeated_percent)
        depleted = (F.col("words_left") < self.least_words) | (F.col("words_left") * 100 < F.col("n_words") * self.least_percent)
        return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)

    @staticmethod
    def cut(text: str, data: bytes, going: list[int] | None) -> tuple[str, int]:
        """A text without the lines that go, and the number of words in those."""
        if not going:
            return text, 0
        going, gone, kept = set(going), 0, []
        for line, normal in zip(text.split("\n"), data.translate(NORMAL).split(b"\n")):
            words = normal.split()
            if words and line_hash(words) in going:
                gone += len(words)
            else:
                kept.append(line)
        return "\n".join(kept), gone

    def report(self, docs: DataFrame) -> DataFrame:
        """``doc_id``, counts and verdict of each row of ``docs``.

        A missing text counts as empty and is rejected, as are all of under ten words. Rows that repeat an id are judged each by
        their own text; rows that repeat a text of the same host get the same verdict. Texts are measured whole, however long. An
        empty table gives no rows; columns other than ``doc_id``, ``text`` and the host may have any names.
        """
        return self.measured(docs).select("row.doc_id", *MEASURES, "base_failed", "kept")

    def cleaned(self, docs: DataFrame) -> DataFrame:
        """The documents that are kept, with the columns of ``docs`` and without their frequent lines."""
        found = self.measured(docs).where("kept")
        return found.select(*[F.col("cleaned").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
