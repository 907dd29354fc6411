"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.hashing import uniform
from scoreloom.llm.common import text_slices

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
# Texts whose best language has a lower score are in none; see `recognised`.
LEAST_SCORE = 0.5
# The classifier is fitted on about this many labelled documents of each language, chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 3000
# Code points scored at once by one task; each takes about 150 bytes there, and a worker keeps the memory it once had.
CHUNK = 1 << 18


@functools.cache
def folding() -> np.ndarray:
    """Maps each code point to its lower case if it is a letter, else to a space."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        if chr(code).isalpha():
            low = chr(code).lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def gram_buckets(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a batch: hashed n-grams one after another, where each text begins, and which texts have letters.

    A space stands before and after each text and for each run of characters that are no letters in it, so n-grams know the
    ends of words. N-grams of spaces alone, and those that would reach into the next text, fall into bucket ``buckets``.
    """
    joined = "".join(f" {t} \n" for t in texts).encode("utf-32-le", "surrogatepass")
    raw = np.frombuffer(joined, np.uint32)
    ends = np.cumsum([len(t) + 3 for t in texts])
    starts = np.append(0, ends[:-1])
    codes = folding()[raw]
    keep = np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))
    keep[starts] = True
    before = np.append(0, np.cumsum(keep))
    codes, starts = codes[keep].astype(np.uint64), before[starts]
    lettered = np.add.reduceat((codes != 32).astype(np.int64), starts) > 0
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(codes))))
    grams = np.full((len(codes), len(ORDERS)), buckets, np.int64)
    for column, n in enumerate(ORDERS):
        size = len(codes) - n + 1
        if size <= 0:
            continue
        mixed = np.full(size, n * 0x9E3779B97F4A7C15 & (2**64 - 1), np.uint64)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + size]) * np.uint64(0xFF51AFD7ED558CCD)
            mixed ^= mixed >> np.uint64(29)
        inside = (owner[:size] == owner[n - 1 :]) & ((codes[:size] != 32) | (n > 1))
        grams[:size, column] = np.where(inside, (mixed >> np.uint64(20)) % np.uint64(buckets), buckets)
    return grams, starts, lettered


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: one of three, by the CRC-32 of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(labelled: DataFrame, sample: int = SAMPLE_PER_LANGUAGE, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of log-probabilities of ``labelled(doc_id, text, lang)``, a row per bucket.

    The last row, of n-grams that don't count, is zero. Counts of the sample are summed in Spark; what comes to the
    driver is a number per language and bucket.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((buckets + 1, 0), np.float32)
    share = F.lit(None).cast("double")
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / sizes[lang]))).otherwise(share)
    chosen = labelled.where(uniform("language", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) < share)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, texts in text_slices(batches, "text", CHUNK):
            grams, starts, _ = gram_buckets(texts, buckets)
            for lang in set(names := part.column("lang").to_pylist()):
                rows = np.repeat([name == lang for name in names], np.diff(np.append(starts, len(grams))))
                found = np.bincount(grams[rows].ravel(), minlength=buckets + 1)[:buckets]
                sums[lang] = sums.get(lang, 0) + found
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    totals = chosen.select("lang", "text").mapInArrow(counted, "lang string, bucket long, n long")
    matrix = np.zeros((buckets + 1, len(languages)))
    for row in totals.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        matrix[row["bucket"], languages.index(row["lang"])] = row["n"]
    smoothed = matrix[:buckets] + SMOOTHING
    matrix[:buckets] = np.log(smoothed / smoothed.sum(axis=0))
    return languages, matrix.astype(np.float32)


def identify(docs: DataFrame, languages: list[str], matrix: np.ndarray, keep: list[str]) -> DataFrame:
    """``lang_pred, score`` of each row of ``docs``, with the columns in ``keep``, which must not have these names.

    Only ``text`` decides. The batch of texts is a sparse matrix of documents by buckets; its product with the broadcast
    log-probabilities is a gather and a sum per document. The score is the posterior of the language under
    equal priors, with the evidence divided by the number of n-gram orders, which count each character more than once.
    A missing text, one without a letter, and any text when nothing was learned, is ``und`` with score 0. Equal
    evidence goes to the first language in code point order.
    """
    model = docs.sparkSession.sparkContext.broadcast((languages, matrix))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def score(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        names, weights = model.value
        grams, starts, lettered = gram_buckets(texts, len(weights) - 1)
        sums = np.zeros((len(texts), len(names)))
        for column in range(grams.shape[1]):
            sums += np.add.reduceat(weights[grams[:, column]], starts, axis=0, dtype=np.float64)
        sums = np.exp((sums - sums.max(axis=1, keepdims=True)) / len(ORDERS))
        best = sums.argmax(axis=1)
        found = np.where(lettered, np.array(names, dtype=object)[best], UNKNOWN)
        return found, np.where(lettered, 1 / sums.sum(axis=1), 0.0)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text", CHUNK):
            names, scores = score(texts) if model.value[0] else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            columns = [part.column(name) for name in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(predict, schema)


def predicted_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs(doc_id, text, lang)``, learned from two thirds of it."""
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    languages, matrix = fit(rows.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return identify(rows, languages, matrix, ["doc_id", "held_out"])


def recognised(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that are in some language. Columns and values stay as they are.

    Those without any letter go, and those for which no language has a score of ``least``: by default, the best must be likelier than all
    others together. The label columns are only used to learn from.
    """
    languages, matrix = fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    if not languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    columns = [f"_{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*columns).withColumn("text", F.col(columns[docs.columns.index("text")]))
    found = identify(renamed, languages, matrix, columns)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).drop("lang_pred", "score").toDF(*docs.columns)
