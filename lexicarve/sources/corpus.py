"""Scans and sinks for labelled text and feature matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import any_vote
from ..session import shared

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Stand-in vote columns of the test tables (see README: data binding).
VOTE_COLUMNS = ("toxic", "quality")
CLASS_VOTES = ("toxic",)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined with their labels: doc_id, text, lang, n_chars, toxic, quality."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    return docs.join(labels, "doc_id")


def with_class(df: DataFrame, votes: Sequence[str] = CLASS_VOTES, name: str = "bin_class") -> DataFrame:
    return df.withColumn(name, any_vote(votes))


def labelled_schema(vote_columns: Sequence[str], key: str | None = None) -> T.StructType:
    fields = [T.StructField(key, T.LongType())] if key else []
    fields.append(T.StructField("text", T.StringType()))
    fields += [T.StructField(v, T.DoubleType()) for v in vote_columns]
    return T.StructType(fields)


CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "", "encoding": "UTF-8",
}


def read_labelled_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                      key: str = "doc_id") -> DataFrame:
    """Labelled text CSV (header; text may hold quoted commas and newlines).

    A file with line breaks inside quotes cannot be split, so one file is
    one task: give a large corpus as many files. With an explicit schema
    nothing is inferred. When the files carry no key column, ``key`` is
    (rank of the file path, position within the file) in one long, written
    once to the shared folder, so later reads agree on it and it does not
    depend on how files are packed into tasks.
    """
    r = spark.read.options(**CSV_OPTIONS)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", "true").csv(path)
    if key in df.columns:
        return df
    # within a partition ids grow with the position, and a file is never cut: the smallest id of a file is its start
    placed = shared(df.select("*", F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("_id")), "csv-rows")
    files = placed.groupBy("_path").agg(F.min("_id").alias("_start"))  # one row per file
    files = files.withColumn("_file", F.row_number().over(Window.orderBy("_path")) - 1)
    out = placed.join(files, "_path")
    return out.select(F.expr("shiftleft(cast(_file as bigint), 40) + (_id - _start)").alias(key), *df.columns).select(*df.columns, key)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def vector_to_line(key: str, vec: str) -> F.Column:
    """S3 line format: key, then the values, blank-separated (doubles print exactly)."""
    vals = F.transform(F.col(vec).cast("array<double>"), lambda x: x.cast("string"))
    return F.concat_ws(" ", F.col(key).cast("string"), F.array_join(vals, " ")).alias("value")


def write_features_text(df: DataFrame, path: str, key: str = "doc_id", vec: str = "features") -> None:
    """S3: one row per line, key first, then the feature values."""
    df.select(vector_to_line(key, vec)).write.mode("overwrite").text(path)


def read_features_text(spark: SparkSession, path: str, key: str = "doc_id",
                       vec: str = "features") -> DataFrame:
    """Parse the text matrix back to (key BIGINT, features ARRAY<DOUBLE>)."""
    parts = F.split(F.trim(F.col("value")), " +")
    return spark.read.text(path).select(
        parts.getItem(0).cast("long").alias(key),
        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("double")).alias(vec))


def write_parquet(df: DataFrame, path: str) -> None:
    """Evaluation tables (e.g. the confusion matrix) go to parquet."""
    df.write.mode("overwrite").parquet(path)
