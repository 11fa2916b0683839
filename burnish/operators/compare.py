"""Raw against cleaned: cell differences, metrics, distributions, load totals."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators.dedupe import dedupe_first, duplicate_rows
from burnish.operators.profile import value_counts
from burnish.session import materialise


def same_key(left: DataFrame, right: DataFrame, key: list[str], suffix: str) -> Column:
    """Null-safe equality of the key columns; ``right`` holds them under ``<name><suffix>``."""
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}{suffix}`"]) for k in key])


def cell_diff(
    raw: DataFrame,
    cleaned: DataFrame,
    key: list[str],
    cols: list[str],
    order_by: list[str] | None = None,
    printed: Callable[[Column, T.DataType], Column] | None = None,
) -> DataFrame:
    """One row per changed cell: key, column_name, raw and cleaned value, change type.

    Only the first row of a key (by ``order_by``, then all compared columns) is paired; its
    other copies are ROW_DELETED in the raw table, ROW_ADDED in the cleaned one.  Keys are
    compared null-safely.  Both sides have one row per key when they meet, so no key is
    hot in the join.  ``printed`` renders values; the default is their text form.
    Unchanged cells are dropped before the rows are multiplied by their columns.
    """
    show = printed or (lambda value, kind: value.cast("string"))
    order = order_by or []
    extra = [c for c in order if c not in key and c not in cols]
    kinds = {c: raw.schema[c].dataType for c in cols}

    def narrow(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
        df = materialise(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*key, *cols, *[x for x in extra if x in df.columns]])]), name)
        by = [c for c in order if c in df.columns]
        repeated = df.groupBy(*[F.col(f"`{k}`") for k in key]).count().filter("count > 1")
        if repeated.isEmpty():
            return df, None
        return dedupe_first(df, key, by), duplicate_rows(df, key, by)

    left, left_copies = narrow(raw, "diff-raw")
    right, right_copies = narrow(cleaned, "diff-cleaned")
    values = lambda df, name: F.struct(*[F.col(f"`{c}`") for c in cols]).alias(name)
    left = left.select(*[F.col(f"`{k}`") for k in key], values(left, "_r"))
    right = right.select(*[F.col(f"`{k}`").alias(f"{k}_2") for k in key], values(right, "_c"))
    both = left.join(right, same_key(left, right, key, "_2"), "left")
    cells = [
        F.when(
            F.col("_c").isNotNull() & ~F.col(f"_r.`{c}`").eqNullSafe(F.col(f"_c.`{c}`")),
            F.struct(
                F.lit(c).alias("column_name"),
                show(F.col(f"_r.`{c}`"), kinds[c]).alias("raw_value"),
                show(F.col(f"_c.`{c}`"), kinds[c]).alias("cleaned_value"),
                F.when(F.col(f"_r.`{c}`").isNull(), F.lit("FILLED"))
                .when(F.col(f"_c.`{c}`").isNull(), F.lit("NULLED"))
                .otherwise(F.lit("CHANGED"))
                .alias("change_type"),
            ),
        )
        for c in cols
    ]

    def whole_row(change: str) -> Column:
        nothing = F.lit(None).cast("string")
        return F.struct(
            nothing.alias("column_name"), nothing.alias("raw_value"), nothing.alias("cleaned_value"),
            F.lit(change).alias("change_type"),
        )

    names = [F.col(f"`{k}`") for k in key]
    paired = both.select(*names, F.explode(F.array_compact(F.array(F.when(F.col("_c").isNull(), whole_row("ROW_DELETED")), *cells))).alias("_d"))
    added = right.join(left, same_key(left, right, key, "_2"), "left_anti").select(*[F.col(f"`{k}_2`").alias(k) for k in key])
    rows = [
        paired.select(*names, "_d.*"),
        *[df.select(*names, whole_row(change).alias("_d")).select(*names, "_d.*") for df, change in ((left_copies, "ROW_DELETED"), (right_copies, "ROW_ADDED"), (added, "ROW_ADDED")) if df is not None],
    ]
    return reduce(DataFrame.unionByName, rows)


def recompute_log(diff: DataFrame, cols: list[str]) -> DataFrame:
    """Original against recomputed values of the given columns."""
    return diff.filter(F.col("column_name").isin(cols) & (F.col("change_type") == "CHANGED")).drop("change_type")


def diff_sample(diff: DataFrame, key: list[str], columns: int = 10, rows: int = 20) -> DataFrame:
    """Cells of the most-changed columns in the first rows that have any."""
    changed = diff.filter(F.col("column_name").isNotNull())
    top = (
        changed.groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "column_name")
        .limit(columns)
        .select("column_name")
    )
    picked = changed.join(F.broadcast(top), "column_name", "left_semi")
    firsts = picked.select(*key).distinct().orderBy(*key).limit(rows)
    return picked.join(F.broadcast(firsts), key, "left_semi")


def compare_metrics(layers: dict[str, DataFrame], aggs: list[Column]) -> DataFrame:
    """The same aggregates over each layer, one row per layer."""
    pieces = [df.agg(*aggs).select(F.lit(layer).alias("layer"), "*") for layer, df in layers.items()]
    return reduce(DataFrame.unionByName, pieces)


def compare_distribution(layers: dict[str, DataFrame], column: str, n: int | None = None) -> DataFrame:
    pieces = [value_counts(df, column, n).select(F.lit(layer).alias("layer"), "*") for layer, df in layers.items()]
    return reduce(DataFrame.unionByName, pieces)


def layer_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(table_schema, table_name, row_count) of loaded tables."""
    pieces = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "row_count"
        )
        for (schema, name), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, pieces)


def layer_summary(counts: DataFrame) -> DataFrame:
    """Raw tables joined to their cleaned twins by name: rows, removed, percentage."""
    raw = counts.filter("table_schema = 'RAW'").select(
        F.col("table_name").alias("raw_table"),
        F.col("row_count").alias("raw_rows"),
        F.replace("table_name", F.lit("_RAW"), F.lit("")).alias("_base"),
    )
    cleaned = counts.filter("table_schema = 'CLEANED'").select(
        F.col("table_name").alias("cleaned_table"),
        F.col("row_count").alias("cleaned_rows"),
        F.replace("table_name", F.lit("_CLEANED"), F.lit("")).alias("_base"),
    )
    removed = F.col("raw_rows") - F.col("cleaned_rows")
    return (
        raw.join(cleaned, "_base")
        .drop("_base")
        .withColumn("rows_removed", removed)
        .withColumn("pct_removed", F.round(F.try_divide(removed, F.col("raw_rows")) * 100, 2))
        .orderBy(F.desc("raw_rows"), "raw_table")
    )


def reconcile_load(expected: DataFrame, counts: DataFrame, rejects: DataFrame) -> DataFrame:
    """Expected, loaded and rejected rows per table; the difference must be explained."""
    return (
        expected.join(counts, "table_name", "left")
        .join(rejects, "table_name", "left")
        .select(
            "table_name",
            "expected_rows",
            F.coalesce("row_count", F.lit(0)).alias("loaded_rows"),
            F.coalesce("rejected_rows", F.lit(0)).alias("rejected_rows"),
        )
        .withColumn("unexplained", F.col("expected_rows") - F.col("loaded_rows") - F.col("rejected_rows"))
        .withColumn("status", F.when(F.col("unexplained") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))
    )
