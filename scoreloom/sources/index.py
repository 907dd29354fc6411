"""Dataset indexes: the entries of a dataset and their files, as one JSON document or as a line of JSON per entry.

A document is read in pieces that end at closing braces, which Spark's text source cuts out of any byte range of the file. Whether a
piece begins inside a string, and how deep in braces, follows from the pieces before it: quotes and braces are added up inside each
range for both cases, ranges are lined up by one row each, and a piece's own case is then known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.functions.ordered import scan
from scoreloom.functions.storage import settled

# Entries are kept as JSON text first: which metadata object an entry has differs from dataset to dataset.
ENTRY = "struct<id string, files map<string, struct<path string, checksum string>>>"
STRING = r'"(?:[^"\\]++|\\.)*+"'
# What stands before an object, and the object with all that follows.
BEFORE_OBJECT = rf'((?:[^"{{]++|{STRING})*+)(\{{.*)'


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of one JSON document: ``collection_name, entry_id, files, metadata_json``.

    The document may be of any size: it is read by a task per range of the file. Entries are the objects in its
    array ``entries``; the name is its ``id``, wherever these two stand.
    """
    found = objects(pieces(spark, path))
    entries = found.filter("array = 'entries' and body is not null").select("file", F.col("body").alias("entry"))
    named = entries.join(document_ids(found), "file", "left")
    return _parsed(named.select(F.col("id").alias("collection_name"), "entry"))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, range, at, value, ends``: the document's pieces in the order of (range, at), and whether an object of it ends with one.

    A piece stands without the brace that ends it. The table is written once, as what follows reads it twice.
    """
    read = spark.read.option("lineSep", "}").text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("range"), F.monotonically_increasing_id().alias("at"), "value"
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))

    def deeper(inside: int) -> Column:
        """How much deeper in braces a piece ends than it begins, if it begins inside a string or not."""
        outside = F.regexp_replace(F.concat(F.lit('"' * inside), bare), '(?s)"[^"]*+("|$)', "")
        opens = F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))
        return opens - F.when((quotes + inside) % 2 == 1, 0).otherwise(1)

    rows = read.withColumns({"quotes": quotes, "deeper0": deeper(0), "deeper1": deeper(1)})
    here = Window.partitionBy("file", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("seen", F.coalesce(F.sum("quotes").over(here), F.lit(0)))
    # By the case of the range: begun outside a string, or inside.
    for case in (0, 1):
        rows = rows.withColumn(f"by{case}", F.when((F.col("seen") + case) % 2 == 0, F.col("deeper0")).otherwise(F.col("deeper1")))
    rows = rows.withColumns({f"depth{case}": F.coalesce(F.sum(f"by{case}").over(here), F.lit(0)) for case in (0, 1)})

    ranges = rows.groupBy("file", "range").agg(*[F.sum(c).alias(c) for c in ("quotes", "by0", "by1")])
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("case", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    ranges = ranges.withColumn("by", F.when(F.col("case") == 0, F.col("by0")).otherwise(F.col("by1")))
    ranges = ranges.select("file", "range", "case", F.coalesce(F.sum("by").over(before), F.lit(0)).alias("start"))

    known = rows.join(ranges, ["file", "range"])
    own = lambda name: F.when(F.col("case") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    closes = (F.col("case") + F.col("seen") + F.col("quotes")) % 2 == 0
    ends = closes & (F.col("start") + own("depth") + own("by") == 1)
    return settled(known.select("file", "range", "at", "value", ends.alias("ends")), "pieces")


def objects(pieces: DataFrame) -> DataFrame:
    """``file, place, before, body, array``: the objects that are directly in the document, in the order of ``place``.

    ``before`` is what stands between an object and the one before it, ``array`` the name of the array that it is in. The last row of a
    file has what follows its last object, and no body.
    """
    placed = pieces.withColumn("place", F.struct("range", "at")).withColumn("end", F.when(F.col("ends"), F.struct("range", "at")))
    placed = scan(placed, ["file"], "place", [], block=F.col("range"), reach="end")
    text = F.concat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "value"))), lambda p: p["value"]), "}"), F.lit("}"))
    joined = placed.groupBy("file", F.col("reach").alias("after")).agg(F.min("place").alias("place"), text.alias("text"))
    # The first object's text begins with the document's own brace.
    joined = joined.withColumn("text", F.when(F.col("after").isNull(), F.regexp_replace("text", r"^[\s\uFEFF]*\{", "")).otherwise(F.col("text")))
    part = lambda i: F.regexp_extract("text", f"(?s)^{BEFORE_OBJECT}$", i)
    rest = F.regexp_replace("text", r"[\s}]*+$", "")
    split = joined.select("file", "place", F.when(part(2) != "", part(1)).otherwise(rest).alias("before"), F.nullif(part(2), F.lit("")).alias("body"))
    opens = F.regexp_extract("before", rf"({STRING})\s*:\s*\[\s*$", 1)
    name = F.when(opens != "", F.from_json(F.concat(F.lit('{"a":'), opens, F.lit("}")), "a string")["a"]).when(F.trim("before") != ",", "")
    named = split.withColumn("name", F.when(F.regexp_like("before", F.lit(r"^\s*,\s*$")), F.lit(None)).otherwise(name))
    named = named.withColumn("named", F.when(F.col("name").isNotNull(), F.struct("place", "name")))
    filled = scan(named, ["file"], "place", [], block=F.col("place.range"), reach="named")
    return filled.select("file", "place", "before", "body", F.coalesce("name", F.col("reach.name")).alias("array"))


def document_ids(objects: DataFrame) -> DataFrame:
    """``file, id``: the document's own field, from what stands outside the objects in it."""
    around = objects.filter(~F.regexp_like("before", F.lit(r"^\s*,\s*$")))
    head = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "before"))), lambda p: p["before"]), "null")
    heads = around.groupBy("file").agg(F.concat(F.lit("{"), head, F.lit("}")).alias("head"))
    return heads.select("file", F.from_json("head", "id string")["id"].alias("id"))


def read_entries(spark: SparkSession, path: str, collection_name: str) -> DataFrame:
    """The same from files with a line of JSON per entry, which many tasks read. Lines without text are passed over."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return _parsed(lines.select(F.lit(collection_name).alias("collection_name"), F.col("value").alias("entry")))


def _parsed(entries: DataFrame) -> DataFrame:
    # The metadata is the entry's one object besides its id and files.
    fields = F.from_json("entry", "map<string, string>")
    others = F.map_filter(fields, lambda k, _: ~k.isin("id", "files"))
    metadata = F.get(F.map_values(others), F.lit(0))
    parsed = F.from_json("entry", ENTRY)
    return entries.select(
        "collection_name",
        parsed["id"].alias("entry_id"),
        parsed["files"].alias("files"),
        metadata.alias("metadata_json"),
    )


def entries_of_type(index: DataFrame, file_type: str) -> DataFrame:
    """Entries with their file of one type: ``seq_id, filepath, checksum, collection_name, metadata_json``.

    ``seq_id`` is the last part of the entry's path-like id; ``filepath`` is null where the type is missing.
    """
    file = F.try_element_at("files", F.lit(file_type))
    return index.select(
        F.element_at(F.split("entry_id", "/"), -1).alias("seq_id"),
        file["path"].alias("filepath"),
        file["checksum"].alias("checksum"),
        "collection_name",
        "metadata_json",
    )
