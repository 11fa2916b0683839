"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of one Arrow batch: a Python worker holds one batch of whole texts at a time.
ARROW_ROWS = 500
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound what a Python worker receives at once, however long the texts are."""
    conf = df.sparkSession.conf
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES),
    ):
        now = conf.get(key, None)
        plain = now if now and now.lstrip("-").isdigit() else None
        if plain is None or not 0 < int(plain) <= most:
            conf.set(key, str(most))
    return df


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def words_regex() -> str:
    return "[^\\x20\\x09-\\x0D]+"
