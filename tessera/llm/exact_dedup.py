"""Exact dedup by a tree-merge of sorted digest runs.

The digests of the rows form runs, one for each leaf slot. In each binomial
round the runs that differ in one group of slot bits exchange their entries by
those bits of the digest and are merged, so that after the last round a slot
owns a range of digests. Each merge keeps the verified entry (SHA-256, length
and a second hash agree) with the identifier that stays and adds the counts.
The answers go down the same tree. On either way an entry meets at most
2^``bits`` others of its digest in a slot, so a text that a third of all rows
share never gathers in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, temporary

KEY = ["sha", "n_bytes", "check"]


def _digests(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    return {"sha": F.unhex(F.sha2(whole, 256)), "n_bytes": F.octet_length(whole).cast("long"), "check": F.xxhash64(whole)}


def copy_groups(docs: DataFrame, keep: str = "max", rounds: int = 2, bits: int = 5) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256.

    Equal texts (byte for byte; null counts as empty) form a group; the row
    with the largest ("max") or smallest ("min") doc_id stays, null ids being
    smallest. Of repeated rows, which tie, exactly one is kept. Further columns
    are ignored; texts of any length are hashed whole; an empty table gives an
    empty one."""
    best = {"max": F.max, "min": F.min}[keep]
    hashed = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("row"), *(c.alias(n) for n, c in _digests(F.col("text")).items()))
    # Written once: the row numbers must be the same wherever they are read.
    hashed = cut_lineage(hashed.withColumn("slot", F.pmod(F.xxhash64("doc_id", "row"), F.lit(1 << rounds * bits))))

    def exchanged(level: int) -> Column:
        mask = ((1 << bits) - 1) << level * bits
        return F.col("slot").bitwiseAND(~mask).bitwiseOR(F.col("check").bitwiseAND(mask))

    runs = [cut_lineage(hashed.groupBy("slot", *KEY).agg(best(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("n")))]
    for level in range(rounds):
        merged = runs[-1].withColumn("slot", exchanged(level)).groupBy("slot", *KEY).agg(best("best").alias("best"), F.sum("n").alias("n"))
        runs.append(cut_lineage(merged) if level < rounds - 1 else merged)
    answer = runs[-1].filter("n > 1").select(F.col("slot").alias("up"), *KEY, "best", "n")
    for level in reversed(range(rounds)):
        below = runs[level].select("slot", *KEY, exchanged(level).alias("up"))
        answer = below.join(answer, ["up", *KEY]).select(F.col("slot").alias("up"), *KEY, "best", "n")
    answer = answer.withColumnRenamed("up", "slot")
    alone = F.col("n").isNull()
    return hashed.join(answer, ["slot", *KEY], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def same_row(docs: DataFrame, doc_id: str = "doc_id", sha: Column | None = None) -> Column:
    """One string for rows of equal doc_id and text (null text: empty)."""
    sha = F.sha2(F.coalesce("text", F.lit("")), 256) if sha is None else sha
    return F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("none")), F.lit(":"), sha)


def one_row_each(docs: DataFrame, kept: Column, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (as from ``same_row``) of ``rows``,
    each once. Rows that repeat are merged inside tasks first, then texts are
    sent once: the join finds them where the merge has put them."""
    name = temporary(docs, "same")
    return docs.withColumn(name, same_row(docs)).dropDuplicates([name]).join(rows.select(kept.alias(name)).distinct(), name, "left_semi").drop(name)


def drop_copies(docs: DataFrame, keep: str = "max", **how) -> DataFrame:
    """``docs`` without all but one row of each group of equal texts (null
    counts as empty; texts of any length are compared whole). Rows that repeat
    both doc_id and text count as one, whatever else they hold; all columns stay."""
    groups = copy_groups(docs.select("doc_id", "text"), keep, **how).filter("kept")
    return one_row_each(docs, same_row(groups, sha=F.col("text_sha256")), groups)
