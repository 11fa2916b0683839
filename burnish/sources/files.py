"""Reading and writing tables; bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.functions.text import null_tokens

# Texts that mean "no value" in a loaded file.
NULL_TOKENS = ["", "NULL", "None", "nan", "NaN", "NaT"]
CORRUPT = "_corrupt_record"


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, permissive: bool = False, multiline: bool = False
) -> DataFrame:
    """CSV with a header and optional quotes.

    Without a schema every column is text (types are a later, separate step).
    ``permissive`` accepts short and long rows and keeps the odd ones' text in
    ``_corrupt_record``.  ``multiline`` gives up splitting files, so ask for it only
    when values contain line breaks.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multiline)
    if permissive:
        if schema is None:
            schema = reader.csv(path).schema
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV part files with a header each; ``append`` adds parts, so nothing is re-read."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def normalise_null_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """The listed texts become NULL in every text column, NaN in every number column."""
    words = tokens or NULL_TOKENS

    def value(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return null_tokens(c, words).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c).alias(f.name)
        return c

    return df.select(*[value(f) for f in df.schema.fields])


def write_table(df: DataFrame, namespace: str, name: str, fmt: str = "parquet", path: str | None = None) -> str:
    """Create or replace ``namespace.name`` with the rows and types of ``df``.

    ``path`` puts the files in a chosen shared folder instead of the warehouse.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{namespace}`")
    writer = df.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(f"`{namespace}`.`{name}`")
    return f"{namespace}.{name}"


def head_sample(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a total order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def key_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Rows whose key falls in a fixed share of the residues; repeatable, unlike a random sample."""
    number = isinstance(df.schema[key].dataType, T.IntegralType)
    spread = F.pmod(F.col(key) * F.lit(7919) if number else F.xxhash64(key), F.lit(1000))
    return df.filter(spread < F.lit(round(fraction * 1000)))


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Unbiased sample for profiling."""
    return df.sample(fraction=fraction, seed=seed)
