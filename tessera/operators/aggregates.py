"""Aggregations (A1-A12). All are grouped aggregates with partial
(map-side) aggregation; no group is ever collected whole."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.schemas import README_MISSING, UNCATEGORIZED
from tessera.session import cut_lineage


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A1: counts per value, nulls left out."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: nulls per column: one pass, then ``stack`` into rows."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, null_count)")


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3: count, mean, sample std, min, quartiles, max per column, one row
    per column. Quartiles interpolate between exact order statistics, which are
    found without a sort (``order_statistics``)."""
    values = cut_lineage(df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]))
    one = values.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                F.min(v).alias("min"), F.max(v).alias("max")).alias(f"s{i}") for i, (c, v) in enumerate((c, F.col(f"x{i}")) for i, c in enumerate(cols))])
    rows = [r for r in one.first()]  # one row for each column
    wanted = []
    for r in rows:
        at = [(r["count"] - 1) * q / 4 for q in (1, 2, 3)] if r["count"] else []
        wanted.append(sorted({x for h in at for x in (math.floor(h), math.ceil(h))}))
    found = order_statistics(values, wanted)
    out = []
    for r, at in zip(rows, found, strict=True):
        cuts = [None] * 3
        if r["count"]:
            places = [(r["count"] - 1) * q / 4 for q in (1, 2, 3)]
            cuts = [at[math.floor(h)] + (at[math.ceil(h)] - at[math.floor(h)]) * (h - math.floor(h)) if h % 1 else at[math.floor(h)] for h in places]
        out.append((r["column_name"], r["count"], r["mean"], r["std"], r["min"], *cuts, r["max"]))
    return df.sparkSession.createDataFrame(out, "column_name string, count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double")


#: Bits of a value that a pass over the columns settles.
DIGIT_BITS = 16


def order_statistics(values: DataFrame, ranks: Sequence[Sequence[int]]) -> list[dict[int, float]]:
    """For each double column of ``values`` its values at some ranks (from 0;
    nulls left out, NaN last).

    A double's bits, turned so that they grow with it, are its digits. Each of
    four passes counts the next 16 bits of all columns at once, of the values
    that begin like one of those sought, so a rank's value is known digit by
    digit. A task counts in arrays; only its counts travel. The number of passes
    is the same for any number of columns and rows."""
    import numpy as np
    import pyarrow as pa

    passes = 64 // DIGIT_BITS
    #: column -> {rank: (digits so far, rank among the values that begin so)}
    sought = [{rank: (0, rank) for rank in column} for column in ranks]
    for step in range(passes):
        prefixes = [np.array(sorted({p for p, _ in s.values()}), dtype=np.uint64) for s in sought]
        shift = np.uint64(64 - DIGIT_BITS * (step + 1))

        def count(batches, prefixes=prefixes, shift=shift, first=step == 0):
            size = 1 << DIGIT_BITS
            counts = [np.zeros((len(p), size), dtype=np.int64) for p in prefixes]
            for batch in batches:
                for table, known, column in zip(counts, prefixes, batch.columns, strict=True):
                    if not len(known):
                        continue
                    x = column.drop_null().to_numpy(zero_copy_only=False)
                    bits = np.where(np.isnan(x), np.inf, x).view(np.uint64)
                    digits = np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))
                    digits[np.isnan(x)] = np.uint64((1 << 64) - 1)
                    begin = np.zeros(len(digits), dtype=np.uint64) if first else digits >> (shift + np.uint64(DIGIT_BITS))
                    at = np.minimum(np.searchsorted(known, begin), len(known) - 1)
                    same = known[at] == begin
                    digit = (digits[same] >> shift & np.uint64(size - 1)).astype(np.int64)
                    np.add.at(table.reshape(-1), at[same] * size + digit, 1)
            for c, table in enumerate(counts):
                p, digit = np.nonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), c)), pa.array(p), pa.array(digit), pa.array(table[p, digit])], names=["c", "p", "digit", "n"])

        # At most 2^16 rows for each value sought, however many rows there are.
        counted = values.mapInArrow(count, "c long, p long, digit long, n long").groupBy("c", "p", "digit").agg(F.sum("n").alias("n"))
        tables: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in counted.collect():
            tables.setdefault((r["c"], r["p"]), []).append((r["digit"], r["n"]))
        for c, column in enumerate(sought):
            for rank, (prefix, left) in column.items():
                p = int(np.searchsorted(prefixes[c], np.uint64(prefix)))
                for digit, n in sorted(tables[c, p]):
                    if left < n:
                        break
                    left -= n
                column[rank] = (prefix << DIGIT_BITS | digit, left)
    out = []
    for column in sought:
        digits = np.array([d for d, _ in column.values()], dtype=np.uint64)
        bits = np.where(digits >> np.uint64(63) == 1, digits & np.uint64((1 << 63) - 1), ~digits)
        x = np.where(digits == np.uint64((1 << 64) - 1), np.nan, bits.view(np.float64)) if len(digits) else np.zeros(0)
        out.append(dict(zip(column, x.tolist(), strict=True)))
    return out


def schema_profile(df: DataFrame) -> DataFrame:
    """A4: type and non-null count per column, plus the row count."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"n{i}").alias("non_null"))
            for i, c in enumerate(cols)
        ]
    )
    return agg.select(F.col("__rows").alias("row_count"), F.explode(rows).alias("s")).select(
        "s.column_name", "s.data_type", "s.non_null", "row_count"
    )


def missing_ratio(df: DataFrame, col: str = "readme_snippet") -> DataFrame:
    """A5: count and share of sentinel READMEs (zero rows -> null share)."""
    return df.agg(
        F.count_if(F.col(col) == F.lit(README_MISSING)).alias("missing"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("share", F.try_divide(F.col("missing"), F.col("total")))


def unique_vs_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples (null counts as a value) against all rows."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count(F.lit(1)).alias("unique_keys"), F.sum("n").cast("bigint").alias("total_rows"))


def total_score(cols: Sequence[str]):
    """Row sum of scores with null as 0 (all null -> 0)."""
    expr = F.lit(0.0)
    for c in cols:
        expr = expr + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return expr


def score_long(df: DataFrame, slugs: Sequence[str], keys: Sequence[str] = ("account", "name"),
               extra: Sequence[str] = ()) -> DataFrame:
    """Wide ``<slug>_score``/``<slug>_reason`` columns to long form
    ``(goal, score, reason)`` without a shuffle."""
    arr = F.array(
        *[
            F.struct(
                F.lit(s).alias("goal"),
                F.col(f"{s}_score").cast("double").alias("score"),
                (F.col(f"{s}_reason") if f"{s}_reason" in df.columns else F.lit(None).cast("string")).alias("reason"),
            )
            for s in slugs
        ]
    )
    return df.select(*keys, *extra, F.explode(arr).alias("__g")).select(*keys, *extra, "__g.*")


def score_histogram(df: DataFrame, slugs: Sequence[str], lo: int = 0, hi: int = 5) -> DataFrame:
    """Rows per integer score bin per goal, nulls dropped, fractions
    in their floor bin, zero-filled over the goal x bin grid."""
    long = score_long(df, slugs, keys=()).filter(F.col("score").isNotNull())
    binned = long.select("goal", F.floor("score").cast("int").alias("score_bin")).filter(
        F.col("score_bin").between(lo, hi)
    )
    counts = binned.groupBy("goal", "score_bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(s, b) for s in slugs for b in range(lo, hi + 1)], "goal string, score_bin int")
    return grid.join(counts, ["goal", "score_bin"], "left").select(
        "goal", "score_bin", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count")
    )


def final_topics(df: DataFrame, col: str = "topic") -> DataFrame:
    """Distinct labels plus Uncategorized (sorting is the caller's
    ``orderBy`` at output time)."""
    spark = df.sparkSession
    unc = spark.createDataFrame([(UNCATEGORIZED,)], f"{col} string")
    return df.select(col).filter(F.col(col).isNotNull()).union(unc).distinct()


def cluster_count(df: DataFrame, col: str = "cluster_id") -> DataFrame:
    """A10: clusters without the outlier id -1."""
    return df.agg(F.count_distinct(F.when(F.col(col) != -1, F.col(col))).alias("clusters"))


def cluster_prompt_text(sample: DataFrame, cluster_col: str = "cluster_id", text_col: str = "summary",
                        rank_col: str = "sample_rank") -> DataFrame:
    """The (at most n) sampled texts of a cluster joined into one bullet
    text, in sample order. Groups are bounded by the sample size."""
    items = F.array_sort(F.collect_list(F.struct(F.col(rank_col), F.col(text_col).alias("t"))))
    return sample.groupBy(cluster_col).agg(
        F.array_join(F.transform(items, lambda s: s["t"]), "\n- ").alias("summaries")
    )


def headline(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value with its count (ties by value)."""
    return value_counts(df, col).orderBy(F.desc("count"), F.asc(col)).limit(1)
