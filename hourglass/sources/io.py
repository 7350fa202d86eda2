"""Readers and writers.

Large tables stay partitioned on write; ``single_file=True`` is only offered for
small aggregate results (it funnels every row through one task).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.session import scratch_path


def string_schema(names: Sequence[str]) -> T.StructType:
    """All-string schema: raw CSV columns are read as text and cast tolerantly later."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# --- S1 ----------------------------------------------------------------------

def read_lines(spark: SparkSession, path: str, with_offsets: bool = False) -> DataFrame:
    """Lines of text files as ``value``.

    ``with_offsets=True`` adds ``offset``, the byte position of each line in its file (the key
    a Hadoop text input gives), without Python rows: lines are summed up within the file block
    their task read, and blocks start where the blocks before them end. Lines end in
    LF or CR LF; files must not be compressed (a compressed file is one block).
    """
    if not with_offsets:
        return spark.read.text(path)
    return _placed_lines(spark, path)[0].select("offset", "value")


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """S1 over a folder of files as one text, in the order of their part numbers: (``offset``, ``line_no``, ``value``).

    ``offset`` is the byte position in all files put together, ``line_no`` counts from 0 without gaps. A
    file starts where the sums of the files before it end: a prefix sum over one row per file.
    """
    lines, blocks = _placed_lines(spark, path)
    order = Window.orderBy(F.length("_f"), "_f").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = blocks.groupBy("_f").agg(F.sum("_size").alias("_size"), F.sum("_count").alias("_count"))
    files = files.select(F.col("_f").alias("_name"), F.coalesce(F.sum("_size").over(order), F.lit(0)).alias("_bytes"),
                         F.coalesce(F.sum("_count").over(order), F.lit(0)).alias("_lines"))
    return lines.join(files, F.col("_file") == F.col("_name")).select(
        (F.col("offset") + F.col("_bytes")).alias("offset"), (F.col("_line") + F.col("_lines")).alias("line_no"), "value")


def _placed_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines with their byte and line position in their file, bytes and lines of every file block)."""
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_nth"))  # read order within a block
    size = (F.octet_length("value") + 1).cast("bigint")
    in_block = Window.partitionBy("_file", "_block").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b")).agg(
        F.sum(size).alias("_size"), F.count(F.lit(1)).alias("_count"))
    starts = blocks.select("_f", "_b", *[F.coalesce(F.sum(c).over(in_file), F.lit(0)).alias(f"_start{c}") for c in ("_size", "_count")])
    lines = lines.withColumns({"_before": F.coalesce(F.sum(size).over(in_block), F.lit(0)),
                               "_nth": F.count(F.lit(1)).over(in_block)})
    out = lines.join(starts, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return out.select("_file", (F.col("_start_size") + F.col("_before")).alias("offset"),
                      (F.col("_start_count") + F.col("_nth")).alias("_line"), F.rtrim("value", F.lit("\r")).alias("value")), blocks


# --- S2 ----------------------------------------------------------------------

def read_csv_strings(spark: SparkSession, path: str, names: Sequence[str] | None = None,
                     header: bool = True, sep: str = ",",
                     corrupt_column: str | None = None, null_value: str | None = None) -> DataFrame:
    """CSV with a header, every column a string (no inference pass over the data).

    Malformed rows are kept (PERMISSIVE); with ``corrupt_column`` the raw text of
    such rows is kept in that column for quarantine. By default an empty cell reads
    as null; pass ``null_value`` (the marker the writer used) to keep empty strings.
    """
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if names is not None:
        fields = list(string_schema(names).fields)
        if corrupt_column:
            fields.append(T.StructField(corrupt_column, T.StringType(), True))
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(T.StructType(fields))
    return reader.csv(path)


# --- S3 / S4 / S5 / S6 -------------------------------------------------------

def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite",
              null_value: str | None = None) -> str:
    """S3: CSV with a header. ``single_file`` only for small results.

    ``null_value`` writes nulls as a marker so empty strings survive a re-read.
    """
    out = df.repartition(1) if single_file else df  # the work before the write stays parallel
    writer = out.write.mode(mode).option("header", True)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)
    return path


def save_stage(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
               mode: str = "overwrite") -> str:
    """Persist a prepared table as parquet (types kept; later jobs get pushdown)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "stage") -> DataFrame:
    """S4 laid out for reuse: ``df`` as a table bucketed and sorted by ``keys``, read back.

    Two tables with as many buckets on their join keys meet without a shuffle, in every job that uses
    them. The files are under the shared root; the layout is known to the catalog of the session.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").option("path", scratch_path(spark, table)).bucketBy(buckets, *keys).sortBy(*keys)
     .saveAsTable(table))
    return spark.table(table)


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    """S4 reload."""
    return spark.read.parquet(path)


def write_lines(df: DataFrame, path: str, col: str = "value", sort: bool = True,
                mode: str = "overwrite") -> str:
    """One text line per row; sorted by bytes through a range-partitioned sort
    (part files in order; repeated lines may span parts, see ``order.sort_lines``)."""
    from hourglass.operators.order import sort_lines
    out = df.select(F.col(col).alias("value"))
    if sort:
        out = sort_lines(out, "value")
    out.write.mode(mode).text(path)
    return path


def write_kv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    """label/value rows with a custom separator, no header."""
    df.write.mode(mode).option("sep", sep).option("header", False).csv(path)
    return path


def read_kv(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    return spark.read.option("sep", sep).schema(string_schema(names)).csv(path)


# --- S7 ----------------------------------------------------------------------

def save_model(model, path: str) -> str:
    """Save a fitted model (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind: str = "logistic"):
    """Load a saved model of the given kind."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import (
        LogisticRegressionModel,
        NaiveBayesModel,
        RandomForestClassificationModel,
    )
    loaders = {
        "logistic": LogisticRegressionModel,
        "naive_bayes": NaiveBayesModel,
        "random_forest": RandomForestClassificationModel,
        "pipeline": PipelineModel,
    }
    return loaders[kind].load(path)


# --- S8 ----------------------------------------------------------------------

def rows_to_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A small typed table from driver rows in one call (no union chain).

    Only for bounded metadata-sized inputs (model parameters, settings); results
    computed from data are built by aggregates instead (see ``operators.scale``).
    """
    return spark.createDataFrame(list(rows), schema)
