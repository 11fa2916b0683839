"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A document's vector: counts of its hashed byte trigrams over the whole text, damped,
weighted by inverse document frequency, projected on the leading singular vectors and
scaled to length one.  The singular vectors are fitted on about ``SVD_ROWS`` labelled rows,
and about ``LABEL_ROWS`` labelled rows vote; a hash of the id picks them, so both bounds hold
at any size.  The labelled vectors (``LABEL_ROWS`` x ``DIMENSIONS`` floats) are broadcast, and
every document is compared with all of them exactly, block by block.  The ``NEIGHBOURS``
most similar vote for their label with their similarity as weight.

Defined cases: a null or empty text, or one like no labelled row, scores the mean label;
without labelled rows the score is 0.5; several labels of one doc_id are averaged, a null
label is none; a doc_id's text is any one of its rows; equal similarities go to the smaller doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.llm.common import held_out, small_batches

HASHED = 4_096
DIMENSIONS = 64
SVD_ROWS = 1_500
LABEL_ROWS = 6_000
NEIGHBOURS = 25
ROUNDED = 5  # digits of a similarity
BLOCK = 1 << 20  # bytes of a text hashed at once


def trigrams(text: str | None) -> np.ndarray:
    """Damped counts of the hashed byte trigrams of a whole text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    counts = np.zeros(HASHED, np.int64)
    for at in range(0, max(0, len(data) - 2), BLOCK):
        part = data[at : at + BLOCK + 2].astype(np.uint32)
        mixed = part[:-2] * np.uint32(0x9E3779B1) ^ part[1:-1] * np.uint32(0x85EBCA77) ^ part[2:] * np.uint32(0xC2B2AE3D)
        counts += np.bincount((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(20), minlength=HASHED)
    return np.sqrt(counts.astype(np.float32))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@F.pandas_udf(T.BinaryType())
def _raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([trigrams(t).tobytes() for t in texts], dtype=object)


def _project(texts, space: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    idf, axes = space
    return _unit(_unit(np.stack([trigrams(t) for t in texts]) * idf) @ axes) if len(texts) else np.zeros((0, axes.shape[1]), np.float32)


def _sampled(labels: DataFrame, rows: int, total: int) -> DataFrame:
    chance = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) / 1e6
    return labels.filter(chance < rows / max(1, total))


def fit(docs: DataFrame, labels: DataFrame, svd_rows: int = SVD_ROWS, label_rows: int = LABEL_ROWS) -> dict | None:
    """Documents (doc_id, text) and labels (doc_id, label) -> the space and the voters."""
    spark = docs.sparkSession
    labels = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("label").alias("label"))
    total = labels.count()
    if not total:
        return None
    def texts(rows: int) -> DataFrame:
        return docs.join(F.broadcast(_sampled(labels, rows, total)), "doc_id")

    raw = texts(svd_rows).select("doc_id", _raw("text").alias("v")).groupBy("doc_id").agg(F.min("v").alias("v")).orderBy("doc_id").limit(2 * svd_rows).collect()
    if not raw:
        return None
    matrix = np.stack([np.frombuffer(r.v, np.float32) for r in raw])
    idf = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    matrix = _unit(matrix * idf)
    values, vectors = np.linalg.eigh(matrix @ matrix.T)
    best = np.argsort(-values)[:DIMENSIONS]
    best = best[values[best] > 1e-6]
    axes = (matrix.T @ (vectors[:, best] / np.sqrt(values[best]))).astype(np.float32)
    shared = spark.sparkContext.broadcast((idf, axes))

    @F.pandas_udf(T.BinaryType())
    def vector(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series([v.astype(np.float32).tobytes() for v in _project(part, shared.value)], dtype=object)

    voters = texts(label_rows).select("doc_id", "label", vector("text").alias("v")).groupBy("doc_id").agg(F.min("label").alias("label"), F.min("v").alias("v"))
    voters = voters.orderBy("doc_id").limit(2 * label_rows).collect()
    return {
        "space": (idf, axes),
        "vectors": np.stack([np.frombuffer(r.v, np.float32) for r in voters]),
        "labels": np.array([r.label for r in voters], np.float64),
    }


def _nearest(similar: np.ndarray, neighbours: int) -> np.ndarray:
    """Positions of the most similar of each row; of equal ones the first, which have the smaller doc_id."""
    if similar.shape[1] <= neighbours:
        return np.broadcast_to(np.arange(similar.shape[1]), similar.shape)
    least = -np.partition(-similar, neighbours - 1, axis=1)[:, neighbours - 1 : neighbours]
    over, level = similar > least, similar == least
    taken = over | (level & (level.cumsum(axis=1) <= neighbours - over.sum(axis=1, keepdims=True)))
    return np.nonzero(taken)[1].reshape(len(similar), neighbours)


def votes(texts, model: dict, neighbours: int = NEIGHBOURS) -> np.ndarray:
    # Rounded, as the last digits of a product depend on what it is computed beside.
    similar = np.round((_project(texts, model["space"]) @ model["vectors"].T).astype(np.float64), ROUNDED)
    near = _nearest(similar, neighbours)
    weight = np.maximum(np.take_along_axis(similar, near, axis=1), 0)
    total = weight.sum(axis=1)
    voted = (weight * model["labels"][near]).sum(axis=1) / np.where(total > 0, total, 1)
    return np.clip(np.where(total > 1e-9, voted, model["labels"].mean()), 0, 1)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text) and (doc_id, quality) -> doc_id, held_out, score, predicted of every document."""
    learnt = labels.filter(~held_out()).select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = small_batches(docs)
    model = fit(docs.select("doc_id", F.col("text").cast("string").alias("text")), learnt)
    if model is None:
        value = F.lit(0.5)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf(T.DoubleType())
        def voted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(votes(texts, shared.value))

        value = voted(F.col("text").cast("string"))
    done = docs.select("doc_id", held_out().alias("held_out"), value.alias("score"))
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
