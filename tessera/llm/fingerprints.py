"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A document is the set of its paragraph digests. Its sketch has 2^k tables
of ``CELLS`` cells; a digest belongs to one table and, there, to one cell in
each third. A cell holds the count, the XOR of the digests and the XOR of their
checks. Two sketches of one size subtract cell by cell, and peeling the cells
that hold a single digest recovers exactly the digests that differ. Where
peeling gets stuck, the table is built again with twice the cells. All of it is
SQL expressions on the row; the only shuffle brings neighbours together."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of a paragraph at most; longer lines are cut into such pieces.
PARAGRAPH = 256
#: Digests that a table is made for, its cells (three thirds), how often they are doubled.
PER_TABLE, CELLS, DOUBLINGS = 8, 48, 4
#: Steps in which digests are dealt to tables (at most 5 bits each).
STEPS = 4
#: Rounds of peeling: each takes all cells that hold one digest.
ROUNDS = 24


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def paragraph_digests(text: Column) -> Column:
    """The set of digests of a text's paragraphs (null or empty: none)."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[^\n]{1,%d}" % PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def tables_log2(digests: Column) -> Column:
    """k: as many tables (2^k) as keep about PER_TABLE digests in each."""
    return F.ceil(F.log2(F.least(F.lit(float(1 << 20)), F.greatest(F.lit(1.0), F.size(digests) / F.lit(float(PER_TABLE)))))).cast("int")


def _bits(value: Column, at: int, count: Column) -> Column:
    return F.shiftrightunsigned(value, at).bitwiseAND(count.cast("long") - 1)


def by_table(digests: Column, k: Column) -> Column:
    """The digests of each of 2^k tables. They are split in ``STEPS`` steps by
    about k / STEPS bits each, as a digest is looked at once for every part
    that its step makes."""
    groups = F.array(digests)
    for i in range(STEPS):
        parts = F.pow(F.lit(2.0), F.floor((k + i) / STEPS)).cast("long")

        def split(group: Column) -> Column:
            return F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda v: F.filter(group, lambda d: _bits(d, 42 + 5 * i, parts) == v))

        groups = F.flatten(F.transform(groups, split))
    return F.when(k == 0, F.array(digests)).otherwise(groups)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def sketch_table(digests: Column, cells: int) -> Column:
    """One table: an array of cells (n, key, check)."""
    third = cells // 3

    def cell(part: int):
        def of(i: Column) -> Column:
            def filled(mine: Column) -> Column:
                xor = lambda a, d: a.bitwiseXOR(d)
                zero = F.lit(0).cast("long")
                return F.struct(F.size(mine).alias("n"), F.aggregate(mine, zero, xor).alias("key"), F.aggregate(mine, zero, lambda a, d: a.bitwiseXOR(_check(d))).alias("check"))

            return _let(F.filter(digests, lambda d: _bits(d, 14 * part, F.lit(third)) == i), filled)

        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(third - 1).cast("long")), of)

    return F.concat(cell(0), cell(1), cell(2))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(cells: Column, size: int) -> Column:
    """The digests that a difference of tables holds, as (n, key) with n = 1
    for the first table's and -1 for the second's, or null where peeling gets
    stuck."""
    third = size // 3
    pure = lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))

    def state(cells: Column, taken: Column) -> Column:
        found = F.array_distinct(F.transform(F.filter(cells, pure), lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"))))
        return F.struct(cells.alias("cells"), found.alias("found"), taken.alias("taken"))

    def step(now: Column, _: Column) -> Column:
        def less(cell: Column, i: Column) -> Column:
            part, place = F.floor(i / third).cast("int"), (i % third).cast("long")
            in_cell = lambda d: F.when(part == 0, _bits(d["key"], 0, F.lit(third))).when(part == 1, _bits(d["key"], 14, F.lit(third))).otherwise(_bits(d["key"], 28, F.lit(third))) == place
            return F.aggregate(
                F.filter(now["found"], in_cell), cell,
                lambda c, d: F.struct((c["n"] - d["n"]).alias("n"), c["key"].bitwiseXOR(d["key"]).alias("key"), c["check"].bitwiseXOR(_check(d["key"])).alias("check")),
            )

        # Rounds behind the last pure cell cost nothing.
        rest = _let(F.transform(now["cells"], less), lambda c: state(c, F.concat(now["taken"], now["found"])))
        return F.when(F.size(now["found"]) > 0, rest).otherwise(now)

    none = F.array().cast("array<struct<n:int,key:bigint>>")
    empty = lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return _let(cells, lambda c: F.aggregate(rounds, state(c, none), step, lambda s: F.when(F.forall(s["cells"], empty), s["taken"])))


def sketch(digests: Column, k: Column) -> Column:
    return F.transform(by_table(digests, k), lambda t: sketch_table(t, CELLS))


def differing(a_digests: Column, b_digests: Column, a_sketch: Column, b_sketch: Column, k: Column) -> Column:
    """The digests that are in one of two documents only, as (n, key) with n = 1
    for the first's and -1 for the second's: their sketches (both of 2^k tables)
    subtracted and peeled, with larger tables where that fails. A difference
    that no size of table peels is taken from the digests."""
    sides = F.zip_with(by_table(a_digests, k), by_table(b_digests, k), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def again(side: Column) -> Column:
        sizes = [CELLS << i for i in range(1, DOUBLINGS + 1)]
        tries = [peel(subtract(sketch_table(side["a"], s), sketch_table(side["b"], s)), s) for s in sizes]
        signed = lambda keys, n: F.transform(keys, lambda d: F.struct(F.lit(n).alias("n"), d.alias("key")))
        return F.coalesce(*tries, F.concat(signed(F.array_except(side["a"], side["b"]), 1), signed(F.array_except(side["b"], side["a"]), -1)))

    first = F.zip_with(a_sketch, b_sketch, lambda x, y: peel(subtract(x, y), CELLS))
    mended = lambda found: F.zip_with(found, sides, lambda c, side: F.coalesce(c, again(side)))
    return F.flatten(_let(first, lambda found: F.when(F.exists(found, lambda c: c.isNull()), mended(found)).otherwise(found)))


def with_difference(rows: DataFrame, name: str, a: tuple[str, str, str], b: tuple[str, str, str]) -> DataFrame:
    """``rows`` with what differs between two documents in column ``name``; ``a``
    and ``b`` name the columns of digests, sketch and k. The smaller sketch is
    made again at the size of the larger."""
    rows = rows.withColumn("at", F.greatest(a[2], b[2]))
    for side, (digests, own, k) in {"a_at": a, "b_at": b}.items():
        # A projection of its own: the analyzer resolves one nested function a pass.
        rows = rows.withColumn(side, F.when(F.col(k) == F.col("at"), F.col(own)).otherwise(sketch(F.col(digests), F.col("at"))))
    differs = differing(F.col(a[0]), F.col(b[0]), F.col("a_at"), F.col("b_at"), F.col("at"))
    return rows.withColumn(name, differs).drop("at", "a_at", "b_at")


def likeness(a_digests: Column, b_digests: Column, differ: Column) -> Column:
    """2 x shared digests / all digests of both, 0 to 1 (both empty: 1)."""
    both = F.size(a_digests) + F.size(b_digests)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - F.size(differ)) / both)


def _digest(sketched: Column) -> Column:
    return F.sha2(F.to_json(sketched), 256)


def _constant(values: list[int]) -> Column:
    """An array of numbers as one folded constant, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _not_below(cuts: list[int], key: Column) -> Column:
    """How many of the falling ``cuts`` are at least ``key``: found among every
    n-th of them, then among the n behind it."""
    step = max(1, math.isqrt(len(cuts)))
    among = lambda some: F.size(F.filter(some, lambda c: c >= key))
    begin = among(_constant(cuts[step - 1 :: step])) * step
    return begin + among(F.slice(_constant(cuts), begin + 1, F.lit(step)))


def range_of(docs: DataFrame, ranges: int) -> Column:
    """The range of a row (columns doc_id and hash), numbered in the order of
    falling doc_id, nulls last, then hash. Ranges end at quantiles of doc_id. An
    id that holds several quantiles, and the null ids, are cut by their hash
    into as many ranges."""
    quantiles = [i / ranges for i in range(1, ranges)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", quantiles, 10 * ranges).alias("q"), F.count("*").alias("n"), (F.count("*") - F.count("doc_id")).alias("nulls")).first()
    held = Counter(found.q or [])
    cuts = sorted(held, reverse=True)
    width = ranges + 2
    part = lambda n: F.least(F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * n).cast("long"), n - F.lit(1).cast("long"))
    null_parts = max(1, math.ceil(ranges * found.nulls / max(1, found.n)))
    last = (len(cuts) + 1) * width + part(F.lit(null_parts).cast("long"))
    if not cuts:
        return last

    def cut(r: Column) -> Column:
        # Range r begins with its cut, the (r - 1)-th, which may be a held id.
        n = F.get(_constant([held[c] for c in cuts]), r - 1)
        first = F.col("doc_id") == F.get(_constant(cuts), r - 1)
        return r * width + F.when(n > 1, F.when(first, part(n)).otherwise(n)).otherwise(0)

    return F.when(F.col("doc_id").isNull(), last).otherwise(_let(_not_below(cuts, F.col("doc_id")).cast("long"), cut))


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows in their ranges (``range_of``), in column ``range``, with the ghost
    of the row that follows the last of each range. One shuffle."""
    docs = docs.withColumn("hash", F.xxhash64("text"))
    docs = docs.withColumn("range", range_of(docs, ranges))
    first = F.max(F.struct("doc_id", F.bitwise_not("hash").alias("hash"))).alias("head")  # greatest id, least hash
    heads = sorted(docs.groupBy("range").agg(first).collect(), key=lambda r: r.range)  # one row a range
    # The row that follows a range's last one heads the range behind it.
    goes = [(r.range, r.head.doc_id, ~r.head.hash, heads[i - 1].range) for i, r in enumerate(heads)]
    heads_df = F.broadcast(docs.sparkSession.createDataFrame(goes, "range long, head long, head_hash long, ghost_of long"))
    own = F.struct(F.col("range"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("ghost_of").alias("range"), F.lit(True).alias("ghost"))
    heads_it = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash"))
    rows = docs.join(heads_df, "range").withColumn("place", F.explode(F.when(heads_it, F.array(own, ghost)).otherwise(F.array(own))))
    return rows.select("doc_id", "text", "hash", "place.range", "place.ghost").repartition("range")


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, removed_digests and added_digests of every row.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many, or all, of the next document in descending doc_id; after the
    last comes the first. A null text counts as empty, null ids come last, rows
    of equal doc_id follow each other by a hash of the text; a single document
    follows itself. A fingerprint is the SHA-256 of the sketch, a likeness
    compares the sketches, whose peeled differences are the digests of the
    paragraphs that the edit removed and added. Rows of equal doc_id and equal
    text are the same row, several times. A text is worked on whole, however
    long, in memory. Further columns are ignored; an empty table gives an
    empty one. ``ranges``: stretches of doc_id that tasks work on."""
    ranges = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), ranges)
    rows = rows.withColumn("digests", paragraph_digests(F.col("text"))).withColumn("k", tables_log2(F.col("digests")))
    rows = rows.withColumn("sketch", sketch(F.col("digests"), F.col("k")))
    follows = Window.partitionBy("range").orderBy("ghost", F.desc_nulls_last("doc_id"), "hash")
    rows = rows.withColumn("next", F.lead(F.struct("text", "digests", "k", "sketch")).over(follows)).filter(~F.col("ghost"))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)))
    rows = rows.withColumn("e_digests", paragraph_digests(F.col("edited"))).withColumn("e_k", tables_log2(F.col("e_digests")))
    rows = rows.withColumn("e_sketch", sketch(F.col("e_digests"), F.col("e_k")))
    own = ("digests", "sketch", "k")
    rows = with_difference(rows, "e_apart", own, ("e_digests", "e_sketch", "e_k"))
    rows = with_difference(rows, "next_apart", own, ("next.digests", "next.sketch", "next.k"))
    only = lambda n: F.transform(F.filter("e_apart", lambda d: d["n"] == n), lambda d: d["key"])
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        _digest(F.col("sketch")).alias("fingerprint"), _digest(F.col("e_sketch")).alias("edited_fingerprint"),
        likeness(F.col("digests"), F.col("e_digests"), F.col("e_apart")).alias("near_edited"),
        likeness(F.col("digests"), F.col("next.digests"), F.col("next_apart")).alias("near_next"),
        only(1).alias("removed_digests"), only(-1).alias("added_digests"),
    )
