"""Readers for raw and cleaned listing files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise import schemas

_RAW = {"DE": schemas.RAW_DE, "US": schemas.RAW_US}
_CLEANED = {"DE": schemas.CLEANED_DE, "US": schemas.CLEANED_US}


FILE_ROWS = 1 << 33  # more rows than a partition can number


def _headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, header)`` of every file, its first line as text, read by one distributed job."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), "_metadata.file_block_start")
    first = lines.where("file_block_start = 0").withColumn("place", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "place").alias("header"))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None) -> DataFrame:
    """CSV with a header; every column text unless a schema is given, quoted line breaks allowed.

    Files are read by their own headers: those that agree in it together, the rest apart, and the results are put
    together by column name; a column that a file lacks is null there. The driver gets the file names of groups
    only where headers differ. Quoted line breaks make a single file unsplittable: land large inputs as many files.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    headers = _headers(spark, path)
    kinds = headers.groupBy("header").agg(F.min("file").alias("first")).orderBy("first").collect()
    if len(kinds) < 2:
        df = reader.csv(path)
    else:
        parts = []
        for kind in kinds:
            names = headers.where(F.col("header").eqNullSafe(kind["header"])).orderBy("file").select("file")
            parts.append(reader.csv([r["file"] for r in names.collect()]))
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part, allowMissingColumns=True)
    if schema is None:
        return df
    known = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[F.col(f"`{c}`").try_cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in df.columns]
    )


def _positioned(df: DataFrame, file: str, position: str = "row_pos") -> DataFrame:
    """Put rows in the order of their files' names and of their place in the file.

    A file of these formats is read by one task, so numbers inside a task grow along it, however Spark packs files.
    """
    files = df.select(file).distinct()
    ranked = files.withColumn("__rank", F.row_number().over(Window.orderBy(file)) - 1)
    place = F.monotonically_increasing_id().bitwiseAND(FILE_ROWS - 1)
    numbered = df.withColumn("__place", place)
    return (
        numbered.join(ranked, file)
        .withColumn(position, F.col("__rank").cast("bigint") * F.lit(FILE_ROWS) + F.col("__place"))
        .drop("__rank", "__place", file)
    )


def read_raw(spark: SparkSession, path: str | Sequence[str], market: str) -> DataFrame:
    """Raw listings as text with their input position ``row_pos``, which grows with file name and place in the file."""
    if market.upper() not in _RAW:
        raise ValueError(f"unknown market: {market}")
    return _positioned(read_csv(spark, path).withColumn("__file", F.input_file_name()), "__file")


def read_cleaned(spark: SparkSession, path: str, market: str, fmt: str = "parquet") -> DataFrame:
    """A cleaned table; Parquet keeps its types, CSV gets them from the fixed schema."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_csv(spark, path, _CLEANED[market.upper()])


def read_json_pages(spark: SparkSession, path: str, schema: StructType | None = None, lines: bool = False) -> DataFrame:
    """Records of landed JSON pages ``{"data": [...]}``; an empty page gives no rows.

    A file is one page, or has one page in each line if ``lines`` is set: such files can hold any number of pages and are
    read in splits. Without a schema Spark derives the union of all keys from the files. ``row_pos`` is the position
    in the input; with ``lines`` positions have gaps.
    """
    reader = spark.read.option("multiLine", not lines)
    found = (reader.schema(schema) if schema else reader).json(path)
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pages = found.withColumn("__split", split)
    records = pages.select("__split", F.posexplode("data").alias("row_pos", "record"))
    splits = pages.select("__split").distinct()
    ranked = splits.withColumn("__rank", F.row_number().over(Window.orderBy("__split")) - 1)
    if lines:  # a split is read by one task, so numbers inside a task grow along it
        records = records.withColumn("row_pos", F.monotonically_increasing_id().bitwiseAND(FILE_ROWS - 1))
    place = F.col("__rank").cast("bigint") * F.lit(FILE_ROWS) + F.col("row_pos")
    return records.join(ranked, "__split").select("record.*", place.alias("row_pos"))


def page_records(pages: DataFrame) -> DataFrame:
    """One row per element of ``data``."""
    records = pages.select(F.explode("data").alias("record"))
    return records.select("record.*").withColumn("row_pos", F.monotonically_increasing_id())
