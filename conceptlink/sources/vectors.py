"""Word-vector tables: ``(token string, vec array<float>)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# header line of the text form: word count and dimension, nothing else
HEADER = r"^\d+ \d+\s*$"


def parse_vector_lines(lines: DataFrame) -> DataFrame:
    """Text-form word-vector lines (column ``value``) to tokens and vectors."""
    parts = F.split(F.rtrim("value"), " ")
    body = lines.filter(~F.col("value").rlike(HEADER))
    return body.select(
        parts[0].alias("token"),
        F.slice(parts, F.lit(2), F.size(parts) - 1).cast("array<float>").alias("vec"),
    )


def read_vectors_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_vector_lines(spark.read.text(path))


def vector_lines(vectors: DataFrame) -> DataFrame:
    """Tokens and vectors to text-form lines."""
    return vectors.select(F.concat_ws(" ", "token", F.col("vec").cast("array<string>")).alias("value"))


def write_vectors(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("errorifexists").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("token", "vec")
