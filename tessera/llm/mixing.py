"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree.

A hash orders the documents of each source and cuts them into blocks; the mix
takes a source's blocks from the front, pass after pass, until its target is
met. The numbers of blocks it takes are exact quotas. A binary tree splits them
among the output shards: each node draws its left half's share of every source
without replacement. A shard then takes its share from a permutation of each
source's blocks, so shards are disjoint, and shuffles its documents locally.

The driver holds one row for each source (a mix names its sources: more than
``MAX_SOURCES`` are refused) and never documents or blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, cut_lineage, temporary, word_count

MAX_SOURCES = 20_000


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, where none exceeds ``most`` times its
    size: the excess is shared again by weight until none is above."""
    out, left, open_ = [0.0] * len(sizes), float(total), list(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard (sources x shards). Shards get
    equal totals, up to one block; a node's draw depends on seed and place only."""
    out = np.zeros((len(quotas), shards), dtype=np.int64)
    nodes = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while nodes:
        lo, hi, have = nodes.pop()
        if hi - lo == 1:
            out[:, lo] = have
            continue
        mid = (lo + hi) // 2
        take = int(have.sum()) * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(have, take, method="marginals")
        nodes += [(lo, mid, left), (mid, hi, have - left)]
    return out


def _between(taken_before: Column, size: Column) -> Column:
    return F.greatest(F.lit(0), F.least(size, taken_before)).cast("long")


def plan_mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, shards: int = 64, block: int = 500, seed: int = 7, row: str | None = None) -> DataFrame:
    """What the mix takes of each row of ``docs``: doc_id, source, size (words),
    source_size, target, taken, and ``draws``, an array of the passes that take
    it with (pass, shard, place, words); and ``row``, a column of ``docs`` that
    names its rows, if one is given.

    Sources are in code point order, null last, with ``weights`` repeating; the
    mix has ``share`` times all words. A source's words are taken to within
    half a word of its target: all of its documents are whole except the last
    one of its last pass, of which the first words are taken. Documents without
    words are never taken. Repeated rows count each; reruns agree (a tie of
    hash, doc_id and size is one of equal rows). Rows lie on the tape by a hash of
    doc_id and text, so rows without a doc_id, or of one doc_id, fall into
    different blocks. More than ``MAX_SOURCES`` sources are refused; texts of any
    length are read whole. An empty table gives an empty one."""
    spark = docs.sparkSession
    rows = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"), *([F.col(row).alias("row")] if row else [])))
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source))
    wanted = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share * sum(r["size"] for r in found), most) if found else []
    sources = spark.createDataFrame(
        [(i, r.source, r["size"], t, int(t + 0.5), -(-r.n // block)) for i, (r, t) in enumerate(zip(found, wanted, strict=True))],
        "s int, source string, source_size long, target double, quota long, blocks long",
    )
    share_of = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    by = rows["source"].eqNullSafe(sources["source"])
    # One row for each source: bounded by MAX_SOURCES.
    named = ["row"] if row else []
    laid = rows.join(F.broadcast(sources), by).select(*named, rows["doc_id"], rows["source"], rows["size"], "h", "s", "source_size", "target", "quota", F.floor(share_of * F.col("blocks")).cast("long").alias("b"))

    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    tape = laid.groupBy("s", "b", "source_size", "quota").agg(F.sum("size").alias("words"))
    tape = cut_lineage(tape.withColumn("begin", F.coalesce(F.sum("words").over(before), F.lit(0))))
    passes = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass")
    drawn = tape.select("s", "b", "words", "begin", "source_size", "quota", passes)
    drawn = drawn.filter(_between(F.col("quota") - F.col("pass") * F.col("source_size") - F.col("begin"), F.col("words")) > 0)
    quotas = {r.s: r["count"] for r in drawn.groupBy("s").count().collect()}  # a row for each source
    ends = np.cumsum(split_quotas([quotas.get(i, 0) for i in range(len(found))], shards, seed), axis=1) if found else []
    dealt = spark.createDataFrame([(i, [int(x) for x in e]) for i, e in enumerate(ends)], "s int, ends array<long>")
    order = Window.partitionBy("s").orderBy(F.xxhash64("s", "b", "pass", F.lit(seed)), "b", "pass")
    drawn = drawn.withColumn("rank", F.row_number().over(order) - 1).join(F.broadcast(dealt), "s")
    drawn = drawn.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
    placed = tape.select("s", "b", "begin").join(drawn.groupBy("s", "b").agg(F.map_from_entries(F.collect_list(F.struct("pass", "shard"))).alias("shards")), ["s", "b"], "left")

    inside = Window.partitionBy("s", "b").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(placed, ["s", "b"])

    def draw(p):
        words = _between(F.col("quota") - p * F.col("source_size") - F.col("begin") - F.col("ahead"), F.col("size"))
        shard = F.col("shards")[p]
        return F.struct(p.alias("pass"), shard.alias("shard"), F.xxhash64(shard, "h", p, F.lit(seed)).alias("place"), words.alias("words"))

    draws = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), draw), lambda d: d["words"] > 0)
    return laid.withColumn("draws", draws).select(
        *named, "doc_id", "source", "size", "source_size", "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]).alias("taken"), "draws",
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``: a document
    that is taken twice comes twice, the one that ends a source's quota comes
    up to the end of its last taken word, as it is written, and rows lie by
    shard in shuffled order. ``docs`` is numbered and written first, so every row
    gets its own draws, whatever it shares with others; cases as in ``plan_mix``."""
    draws, size, row = temporary(docs, "draws"), temporary(docs, "size"), temporary(docs, "row")
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    planned = plan_mix(numbered, row=row, **how).filter("taken > 0").select(F.col("row").alias(row), F.col("size").alias(size), F.col("draws").alias(draws))
    taken = numbered.join(planned, row).withColumn(draws, F.explode(draws))
    part = F.col(draws)["words"] < F.col(size)
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col(draws)["words"].cast("int"))
    blanks = F.slice(F.split("text", WORD, -1), F.lit(1), F.col(draws)["words"].cast("int"))  # before each word
    text = F.when(part, F.array_join(F.zip_with(blanks, words, lambda b, w: F.concat(b, w)), "")).otherwise(F.col("text"))
    changed = {"text": text} | ({"n_chars": F.when(part, F.length(text).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    shard, place = F.col(draws)["shard"], F.col(draws)["place"]
    # A shard is dealt in 16 stretches of its shuffled order, so no task holds it whole.
    return taken.repartition(shard, F.shiftrightunsigned(place, 60)).sortWithinPartitions(shard, place).withColumns(changed).select(*docs.columns)
