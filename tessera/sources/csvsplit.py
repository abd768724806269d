"""Quoted CSV read in byte ranges.

Spark reads a file with line breaks inside quotes as one task. Here it is read as
lines, which Spark splits by byte ranges, and the records are found in two passes.
A line break ends a record where the quotes before it are even in number; so the
first pass counts the quotes of each range, and their sums from the start of the
file tell in which ranges the first line goes on with a record of an earlier one.
The second pass joins the lines of each range to records; pieces at the borders,
at most two for each range, are put together across ranges.

This holds for cells in which a quote stands only inside quotes, doubled (as RFC
4180 has it and Spark writes it)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

#: Ranges that begin inside quotes; more are joined by a shuffle, not sent to all tasks.
BROADCAST_RANGES = 1_000_000
#: What a piece is: a whole record; the end of one; the start of one; a range inside one.
WHOLE, END, START, INSIDE = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, value, quotes) of each line, in the order of the file
    within a range."""
    text = spark.read.option("lineSep", "\n").text(path)
    count = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), "value", count.alias("quotes"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, range, kind, text, head) of lines (file, range, value, quotes,
    inside); ``head`` marks what a file begins with."""
    at, held, odd, opened, fresh = None, [], 0, False, False

    def row(kind: int, lines: list[str]) -> tuple:
        nonlocal fresh
        head = fresh and any(line.strip("\r") for line in lines)  # the first that is not empty
        fresh = fresh and not head
        return *at, kind, "\n".join(lines), head

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int8(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "range", "kind", "text", "head"])

    for batch in batches:
        rows: list[tuple] = []
        file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        value, quotes = batch.column(2), batch.column(3).to_numpy()
        borders = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (start[1:] != start[:-1]))) if len(file) else []
        for low, high in zip(borders, np.append(borders[1:], len(file)) if len(file) else [], strict=True):
            key = (int(file[low]), int(start[low]))
            if key != at:
                if held:
                    rows.append(row(INSIDE if opened else START, held))
                at, held, opened, fresh = key, [], bool(batch.column(4)[int(low)].as_py()), key[1] == 0
                odd = int(opened)
            within = (odd + np.cumsum(quotes[low:high])) & 1
            ends = np.flatnonzero(within == 0)
            first = 0
            texts = value.slice(low, high - low).to_pylist()
            for end in ends.tolist():
                rows.append(row(END if opened else WHOLE, [*held, *texts[first : end + 1]]))
                held, opened, first = [], False, end + 1
            held += texts[first:]
            odd = int(within[-1])
        yield out(rows)
    if held:
        yield out([row(INSIDE if opened else START, held)])


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The records of CSV files under ``path``, each with a header, by ``schema``
    and Spark's CSV ``options``; order is not kept. Empty lines are no records."""
    lines = _lines(spark, path)
    ranges = cut_lineage(lines.groupBy("file", "range").agg(F.sum("quotes").alias("quotes")))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("before", F.coalesce(F.sum("quotes").over(before), F.lit(0))).filter("before % 2 = 1").select("file", "range", F.lit(True).alias("inside"))
    inside = cut_lineage(inside)
    if inside.count() <= BROADCAST_RANGES:
        marked = lines.join(F.broadcast(inside), ["file", "range"], "left")
    else:
        placed = lines.withColumn("place", F.monotonically_increasing_id()).join(inside, ["file", "range"], "left")
        marked = placed.repartition("file", "range").sortWithinPartitions("file", "range", "place")
    marked = marked.select("file", "range", "value", "quotes", F.coalesce("inside", F.lit(False)).alias("inside"))
    pieces = cut_lineage(marked.mapInArrow(_pieces, "file long, range long, kind byte, text string, head boolean"))
    # A record that crosses borders: its start, ranges inside it, and its end.
    broken = pieces.filter(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("range", F.when(F.col("kind") == START, 1).otherwise(0))
    named = broken.withColumn("record", F.last(F.when(F.col("kind") == START, F.col("range")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    part = F.struct("range", F.when(F.col("kind") == START, 1).otherwise(0).alias("last"), "text")
    joined = named.groupBy("file", "record").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("head").alias("head"))
    joined = joined.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"), "head")
    records = pieces.filter(F.col("kind") == WHOLE).select("text", "head").unionByName(joined).filter(~F.col("head"))
    # A record that ends with two characters comes from a file with such line
    # ends; inside its cells too they are one character, as Spark's reader has it.
    bare = F.replace(F.expr("substring(text, 1, length(text) - 1)"), F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.col("text").endswith("\r"), bare).otherwise(F.col("text"))
    parsed = records.select(text.alias("text")).filter("text <> ''").select(F.from_csv("text", _ddl(schema), {k: v for k, v in options.items() if k not in ("header", "multiLine")}).alias("r"))
    return parsed.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
