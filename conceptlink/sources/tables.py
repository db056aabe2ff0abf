"""Document tables, dictionaries, file listings and saved matrices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from conceptlink.operators.sampling import subsample

DOCUMENT_SCHEMA = "doc_id long, text string, keywords string"


def any_missing(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """True for rows with at least one null."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns or df.columns])


def missing_share(df: DataFrame) -> DataFrame:
    """One row: the share of rows with at least one null."""
    return df.agg(F.avg(any_missing(df).cast("double")).alias("missing_share"))


def incomplete_rows(df: DataFrame) -> DataFrame:
    return df.filter(any_missing(df))


def drop_incomplete(df: DataFrame, how: str = "any", columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null (or, with ``how='all'``, only nulls).

    With ``how='all'`` every row left must also be complete, as readers rely on
    it; a row that is not fails the job while it runs, without a second scan.
    """
    kept = df.dropna(how=how, subset=list(columns) if columns else None)
    if how == "any":
        return kept
    complete = F.assert_true(~any_missing(kept, columns), F.lit("rows with missing values are left"))
    return kept.filter(complete.isNull())


def read_documents(
    spark: SparkSession,
    path: str,
    schema: str | StructType = DOCUMENT_SCHEMA,
    file_format: str = "csv",
    dropna: bool = True,
    how: str = "any",
    n: int | None = None,
    id_cols: Sequence[str] = ("doc_id",),
    seed: int = 7,
    multiline: bool = True,
) -> DataFrame:
    """Read a table under an explicit schema, drop incomplete rows, optionally keep n random rows.

    CSV fields may hold line breaks, so a CSV file is read by one task; ``multiline=False`` splits files.
    """
    reader = spark.read.schema(schema)
    if file_format == "csv":
        reader = reader.options(header=True, multiLine=multiline, quote='"', escape='"')
    df = reader.format(file_format).load(path)
    if dropna:
        df = drop_incomplete(df, how)
    return subsample(df, n, id_cols, seed) if n else df


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(header=True, sep=sep, quote='"', escape='"').csv(path)


def read_dictionary(spark: SparkSession, path: str, key: str = "source", value: str = "target") -> DataFrame:
    """Space-delimited two-column dictionary with a header, with each entry's file order: file, block, row."""
    lines = spark.read.schema(f"{key} string, {value} string").csv(path, sep=" ", header=True)
    block = F.col("_metadata.file_block_start")
    return lines.withColumn("entry", F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("row")))


def list_files(spark: SparkSession, folder: str, patterns: Sequence[str] = ("*.dat", "*.csv")) -> DataFrame:
    """Path and size of the files below ``folder`` that match a pattern; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "{" + ",".join(patterns) + "}")
        .load(folder)
    )
    return found.select("path", "length")


def save_matrix(df: DataFrame, path: str, split: str, run: int = 0) -> None:
    """Store keyed features (and an optional label) as one split of one run."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/split={split}/run={run}"
    df.write.mode("overwrite").parquet(target)


def load_matrix(spark: SparkSession, path: str, split: str, run: int = 0) -> DataFrame:
    """Read one split of one run with that split's own columns; other folders are not touched."""
    return spark.read.parquet(f"{path.rstrip('/')}/split={split}/run={run}")


def load_document_vectors(spark: SparkSession, path: str, run: int = 0, test: bool = False) -> DataFrame:
    return load_matrix(spark, path, "simple-doc" if test else "doc", run)


def load_pair_vectors(spark: SparkSession, path: str, run: int = 0, test: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training and test pairs of a run."""
    prefix = "simple-" if test else ""
    return load_matrix(spark, path, f"{prefix}train", run), load_matrix(spark, path, f"{prefix}test", run)
