"""One large JSON document, an array of objects, read by many tasks.

Spark's multi-line JSON source reads a file in one task. Here the text source cuts the file at every closing brace,
splits of it in different tasks, and each piece tells what it does to the state of a reader: whether
it turns quoted to unquoted text, and how many braces it opens in either case. Sums of these over the pieces before give the
state in which a piece starts, and so the braces that close an object of the array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from siltstone.sinks.staging import stage
from siltstone.sources.rejects import Scan, judge_json

RECORD = "record"


def _segments(piece: Column) -> Column:
    """The piece cut at its quotes; escaped characters are put out of the way first."""
    return F.split(F.regexp_replace(piece, r"(?s)\\.", ""), '"', -1)


def _opened(segments: Column, first: int) -> Column:
    """Opening braces in every other segment, from the first or the second on."""
    every = F.filter(segments, lambda s, i: i % 2 == first)
    text = F.array_join(every, "")
    return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))


def _before(value: str, rows: WindowSpec, total: str) -> Column:
    """Sum of ``value`` over all earlier pieces of the file: of earlier blocks, and of earlier pieces of the block."""
    return F.coalesce(F.sum(value).over(rows), F.lit(0)) + F.col(total)


def _offsets(pieces: DataFrame, value: str, total: str) -> DataFrame:
    """(file, block, total): for every block of a file the sum of ``value`` over the blocks before. One row per block."""
    sums = pieces.groupBy("file", "block").agg(F.sum(value).alias("sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias(total))


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """Every object of the top-level arrays (or objects in a row) of the files as text, column ``record``.

    Objects nested in others stay in their text. Braces and quotes inside strings do not count, escapes are followed. A
    file may be of any size; a task works on one split of it and on whole objects. What is shuffled is the text once, by
    object; the sums that cross splits are one row per split. Text between objects is ignored; an object that is not closed is not returned.
    """
    columns = ["file", "block", "at"]
    found = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # grows with the place in the split, which is one task's
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece"),
    )
    segments = _segments(F.col("piece"))
    pieces = found.select(
        *columns, "piece",
        ((F.size(segments) - 1) % 2).alias("turns"),
        _opened(segments, 0).alias("opened"),
        _opened(segments, 1).alias("opened_if_quoted"),
    )
    pieces = stage(pieces, "json_pieces")
    earlier = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    with_start = pieces.join(_offsets(pieces, "turns", "turns_before"), ["file", "block"])
    quoted = (_before("turns", earlier, "turns_before") % 2) == 1
    # a piece ends with a closing brace; inside a string that is text
    closes = F.col("quoted") == (F.col("turns") == 1)
    stepped = with_start.withColumn("quoted", quoted).select(
        *columns, "piece",
        closes.alias("closes"),
        (F.when(F.col("quoted"), F.col("opened_if_quoted")).otherwise(F.col("opened")) - closes.cast("int")).alias("step"),
    )
    depth = _before("step", earlier, "step_before") + F.col("step")
    deep = stepped.join(_offsets(stepped, "step", "step_before"), ["file", "block"])
    ended = deep.select(
        *columns, "piece", (F.col("closes") & (depth == 0)).cast("int").alias("ends")
    )
    numbered = ended.join(_offsets(ended, "ends", "ends_before"), ["file", "block"]).select(
        *columns, "piece", "ends", _before("ends", earlier, "ends_before").alias("number")
    )
    objects = numbered.groupBy("file", "number").agg(
        F.max("ends").alias("whole"), F.array_sort(F.collect_list(F.struct("block", "at", "piece"))).alias("pieces")
    )
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["piece"]), "}"), F.lit("}"))
    return objects.where("whole = 1").select(F.regexp_extract(text, r"(?s)\{.*", 0).alias(RECORD))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_json(..., multi_line=True)`` for arrays of objects: fields bind by exact name, ill-typed ones are NULL."""
    parsed = read_json_objects(spark, path).select(F.from_json(RECORD, schema).alias("row"))
    return parsed.select(*(F.col(f"row.`{n}`").alias(n) for n in schema.names))


def scan_json_array(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> Scan:
    """As ``scan_json`` for arrays of objects."""
    return judge_json(read_json_objects(spark, path), schema, required)
