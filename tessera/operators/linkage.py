"""Exact density hierarchy (C2): single linkage, condensed tree, excess of mass.

With one minimum sample the mutual-reachability distance is the plain distance,
so the hierarchy is that of the components at every distance w: two points are
together at w when a way of steps of at most w joins them. All steps of one
length count at once.

**Rounds.** Equal vectors are one point with a number of copies. In each round
every component but the largest finds its least step outwards: from the exact
lists of nearest neighbours while they reach out of it, else by a search within
the best step known. The components that the steps join are the next round's;
the step ``t`` of each is kept. (The largest component rests, so that its points
are never searched; its least step follows from the next round's.) That is a
spanning forest by Boruvka's rounds, at most log2(points) of them.

**Chains.** The steps inside one round's component lead, ever shorter, to one
root, so the component grows from its root by one item after the other, in the
order of their steps: a chain. A chain lasts while its steps are shorter than
the component's own step outwards; items with longer steps belong to the chain
that the component ends up in, and move up. So the whole dendrogram is a table
of items (chain, w, size), of which a chain that ended is one of the next.

**Condensed tree.** In a chain nothing matters until ``min_size`` points are
together, which the first ``min_size`` items tell. From then on an item that has
a cluster of its own splits the chain, and any other leaves the chain's cluster
at 1 / w. Clusters, their links, stabilities (the sum over points of 1 / w where
they leave less 1 / w where the cluster began) and the choice by excess of mass
follow chain by chain, in as many steps as there were rounds. Nothing is gathered
on the driver but a row for each partition or pivot and, of at most ``DRIVER_PARTS``,
for each component, chain or cluster."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.neighbours import Blocks, distances, lay_out, nearest_outside, star_forest, within
from tessera.session import cut_lineage, merging

#: Neighbours listed for each point before the rounds; any number gives the same result.
NEAREST = 8
#: Components whose steps are joined on the driver; more are joined by Spark. Also the
#: most rows of a table that is sent to every task.
DRIVER_PARTS = 1 << 16


def _side(table: DataFrame, few: bool) -> DataFrame:
    """The side of a join that has a row for each component, chain or cluster."""
    return F.broadcast(table) if few else merging(table)


def _is_few(table: DataFrame) -> bool:
    return table.count() <= DRIVER_PARTS


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Rounds -----------------------------------------------------------------------
def rounds(points: DataFrame, metric: str) -> list[DataFrame]:
    """The rounds over ``points`` (id, v): for each a table (node, t, up) of its
    components. ``up`` is a component of the next round; the last is one."""
    from tessera.operators.vectors import connected_components

    blocks = lay_out(points, NEAREST)
    if blocks is None:
        return []
    nn = within(blocks, metric, NEAREST)
    order = Window.partitionBy("src").orderBy("distance", "dst")
    nn = nn.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEAREST)
    edges = cut_lineage(nn.select("src", "distance", F.col("src").alias("l"), F.col("dst").alias("other")))
    # Nothing outside the list is nearer than its last; a shorter list is complete.
    listed = F.when(F.count("*") >= NEAREST, F.max("distance")).otherwise(F.lit(float("inf")))
    far = cut_lineage(edges.groupBy(F.col("src").alias("id")).agg(listed.alias("far")))
    labels = cut_lineage(points.select("id", F.col("id").alias("label")))
    tables: list[DataFrame] = []
    while True:
        sizes = cut_lineage(labels.groupBy(F.col("label").alias("node")).count())
        # The largest component, the least node of equals; a sort with a limit would
        # send that many rows of every task to the driver.
        found = sizes.agg(F.count("*").alias("n"), F.min(F.struct(-F.col("count"), "node")).alias("first")).first()
        if found["n"] < 2:
            break
        rests, few = found["first"]["node"], found["n"] <= DRIVER_PARTS
        best = cut_lineage(edges.groupBy(F.col("l").alias("label")).agg(F.min(F.struct("distance", "other")).alias("b")).select("label", "b.*"))
        closed = labels.filter(F.col("label") != rests).join(merging(edges.select(F.col("src").alias("id")).distinct()), "id", "left_anti")
        open_ = closed.join(merging(far), "id").join(_side(best.select("label", "distance"), few), "label", "left").filter(F.col("distance").isNull() | (F.col("far") < F.col("distance")))
        reach = F.sqrt(2 * F.col("distance")) if metric == "cosine" else F.col("distance")  # chords are searched
        open_ = cut_lineage(open_.select("id", "label", F.coalesce(reach, F.lit(float("inf"))).alias("bound")))
        if not open_.isEmpty():
            queries = cut_lineage(_bounded(open_, points, labels, blocks, few))
            best = best.unionByName(nearest_outside(blocks, queries, labels, metric))
            best = best.groupBy("label").agg(F.min(F.struct("distance", "other")).alias("b")).select("label", "b.*")
        best = cut_lineage(best.filter(F.col("label") != rests))
        if few:
            steps = best.collect()
            up = _joined([r["node"] for r in sizes.select("node").collect()], [(r["label"], r["other"]) for r in steps])
            t = {r["label"]: r["distance"] for r in steps}
            tables.append(points.sparkSession.createDataFrame([(n, t.get(n), up[n]) for n in up], "node long, t double, up long"))
            ups = tables[-1].select("node", "up")
        else:
            steps = best.select(F.col("label").alias("src"), F.col("other").alias("dst"))
            joined = connected_components(sizes.select(F.col("node").alias("id")), steps.unionByName(steps.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
            ups = cut_lineage(joined.select(F.col("id").alias("node"), F.col("label").alias("up")))
            tables.append(cut_lineage(ups.join(merging(best.select(F.col("label").alias("node"), F.col("distance").alias("t"))), "node", "left").select("node", "t", "up")))
        ups = _side(ups, few)
        labels = cut_lineage(labels.join(ups.withColumnRenamed("node", "label"), "label").select("id", F.col("up").alias("label")))
        one, two = (ups.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in ("l", "other"))
        moved = edges.join(one, "l").join(two, "other").select("src", "distance", F.col("l_up").alias("l"), F.col("other_up").alias("other"))
        edges = cut_lineage(moved.filter(F.col("l") != F.col("other")))
    return _resting(tables)


def _joined(nodes: list[int], steps: list[tuple[int, int]]) -> dict[int, int]:
    """The least node of each node's component."""
    src, dst = np.array(steps, dtype=np.int64).reshape(-1, 2).T
    moved, roots = star_forest(src, dst)
    return {n: n for n in nodes} | dict(zip(moved.tolist(), roots.tolist(), strict=True))


def _bounded(open_: DataFrame, points: DataFrame, labels: DataFrame, blocks: Blocks, few: bool) -> DataFrame:
    """Bounds for components that know of no step out: the distance of a point
    of theirs to a pivot of another component is one."""
    spark = points.sparkSession
    at = spark.createDataFrame([(int(i),) for i in blocks.pivot_ids], "id long")  # the first level's pivots
    of = {r["id"]: r["label"] for r in labels.join(F.broadcast(at), "id").collect()}
    pivots, owners = blocks.pivots, np.array([of[int(i)] for i in blocks.pivot_ids])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if len(b):
                d = distances(np.stack(b["v"].to_numpy()), pivots)
                d[owners[None, :] == b["label"].to_numpy()[:, None]] = np.inf
                yield pd.DataFrame({"label": b["label"], "reach": d.min(axis=1)})

    lost = open_.filter(F.col("bound") == float("inf")).select("id", "label").join(merging(points), "id")
    reach = lost.select("label", "v").mapInPandas(run, "label long, reach double").groupBy("label").agg(F.min("reach").alias("reach"))
    return open_.join(_side(reach, few), "label", "left").select("id", "label", F.least("bound", F.coalesce("reach", F.lit(float("inf")))).alias("bound"))


def _resting(tables: list[DataFrame]) -> list[DataFrame]:
    """The least step of a component that rested: to what joined it, or the step
    of what they became."""
    above, few = None, True
    for k in reversed(range(len(tables))):
        table = tables[k]
        joined = table.groupBy("up").agg(F.min("t").alias("first"))
        if above is None:
            joined = joined.withColumn("t_up", F.lit(float("inf")))
        else:
            joined = joined.join(_side(above.select(F.col("node").alias("up"), F.col("t").alias("t_up")), few), "up")
        above = cut_lineage(table.join(_side(joined, few), "up").select("node", F.coalesce("t", F.least(F.coalesce("first", F.lit(float("inf"))), "t_up")).alias("t"), "up"))
        tables[k], few = above, _is_few(above)
    return tables


# Chains -----------------------------------------------------------------------
def _inverse(w) -> Column:
    w = F.col(w) if isinstance(w, str) else w
    return F.when(w > 0, 1.0 / F.when(w > 0, w)).otherwise(F.lit(float("inf")))


def fill_down(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """``rows`` (written) in which a null ``value`` is the last one before it in
    the order of its key. Ranges of (key, order) are filled each by itself and
    take over what the ranges before them end with, so no key is one task's."""
    laid = cut_lineage(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("part", F.spark_partition_id()))
    ends = laid.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    last = laid.filter(F.col(value).isNotNull()).groupBy("part", key).agg(F.max_by(value, F.struct(*order)).alias("last"))
    known = ends.join(merging(last), (last["part"] == ends["part"]) & (last[key] == ends["high"]), "left").select(ends["part"], "low", "high", "last")
    carry, at, took = [], None, None  # a row for each range
    for r in sorted(known.collect()):
        if at is not None and r["low"] == at and took is not None:
            carry.append((r["part"], r["low"], took))
        if r["high"] != at:
            at, took = r["high"], r["last"]
        elif r["last"] is not None:
            took = r["last"]
    types = dict(rows.dtypes)
    carried = rows.sparkSession.createDataFrame(carry, f"part int, low {types[key]}, carry {types[value]}")
    inside = Window.partitionBy("part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = laid.withColumn("filled", F.last(value, ignorenulls=True).over(inside))
    filled = filled.join(F.broadcast(carried.withColumnRenamed("low", key)), ["part", key], "left")
    return filled.withColumn(value, F.coalesce("filled", "carry")).select(*rows.columns)


class Tree:
    """Tables of the condensed tree, a list entry for each round."""

    def __init__(self):
        self.stops: list[DataFrame] = []  # level, node -> cid, or in_level, in_node
        self.parts: list[DataFrame] = []  # cid, n, s: points that leave, sum of 1 / w
        self.links: list[DataFrame] = []  # child, parent, w: clusters that meet a chain
        self.onward: list[DataFrame] = []  # the same inside a chain
        self.chains: list[DataFrame] = []  # node, w, cid, alias
        self.root: DataFrame | None = None


def condensed(weights: DataFrame, tables: list[DataFrame], min_size: int) -> Tree:
    """The condensed tree of ``weights`` (id, copies) over the rounds' tables."""
    tree, m = Tree(), min_size
    own = F.when((F.col("copies") >= m) & (F.col("t") > 0), F.concat(F.lit("0:"), F.col("node").cast("string")))
    items = tables[0].join(merging(weights.withColumnRenamed("id", "node")), "node").select(
        F.col("up").alias("node"), F.col("t").alias("w"), F.col("copies").alias("size"), own.alias("cid"), F.lit(0).alias("level"), F.col("node").alias("item"))
    items = cut_lineage(items)
    tree.parts.append(items.filter("cid IS NOT NULL").select("cid", F.col("size").alias("n"), F.lit(float("inf")).alias("s")))
    for k in range(1, len(tables) + 1):
        last = k == len(tables)
        few = last or _is_few(tables[k])  # chains
        if last:
            here = items.select("*", F.lit(float("inf")).alias("t"), F.lit(None).cast("long").alias("up"))
        else:
            here = items.join(_side(tables[k], few), "node")
        here = cut_lineage(here)
        stopped = here.filter(F.col("w") < F.col("t"))
        climbed = here.filter(F.col("w") >= F.col("t")).select(F.col("up").alias("node"), "w", "size", "cid", "level", "item")
        chains = stopped.groupBy("node").agg(F.sum("size").alias("total"), F.first("t").alias("t"), F.first("up").alias("up"))
        first = Window.partitionBy("node").orderBy("w", "level", "item")
        early = stopped.join(_side(chains.filter(F.col("total") >= m).select("node"), few), "node", "left_semi").select("node", "w", "size", "level", "item")
        early = early.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= m)
        starts = early.withColumn("sum", F.sum("size").over(first)).filter(F.col("sum") >= m).groupBy("node").agg(F.min("w").alias("start"))
        starts = cut_lineage(starts)
        of_large = cut_lineage(stopped.join(_side(starts, few), "node").select("node", "w", "size", "cid", "level", "item", "start"))
        # Where chains begin to be clusters, and where clusters meet.
        meets = of_large.filter("cid IS NOT NULL").groupBy("node", "w", "start").agg(F.count("*").alias("met"), F.min("cid").alias("one"), F.sum("size").alias("size"))
        begins = starts.select("node", F.col("start").alias("w"), "start").join(merging(meets.drop("start")), ["node", "w"], "left")
        begins = begins.unionByName(meets.filter(F.col("w") > F.col("start")).select(begins.columns))
        alias = (F.col("w") == F.col("start")) & (F.coalesce("met", F.lit(0)) == 1)
        named = F.concat_ws(":", F.lit(str(k)), F.col("node").cast("string"), F.col("w").cast("string"))
        segments = cut_lineage(begins.select("node", "w", "start", F.when(alias, F.col("one")).otherwise(named).alias("cid"), alias.alias("alias"), F.coalesce("size", F.lit(0)).cast("long").alias("met_size")))
        # Items without a cluster leave the cluster that the chain then is.
        small = of_large.filter("cid IS NULL").select("node", F.greatest("w", "start").alias("w"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("cid"), "size", "level", "item")
        marks = segments.select("node", "w", F.lit(0).alias("kind"), "cid", F.lit(0).cast("long").alias("size"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("item"))
        left = cut_lineage(fill_down(small.unionByName(marks), "node", ["w", "kind", "item"], "cid").filter("kind = 1"))
        tree.stops.append(left.select("level", F.col("item").alias("node"), "cid", F.lit(None).cast("int").alias("in_level"), F.lit(None).cast("long").alias("in_node")))
        lost = stopped.join(_side(starts.select("node"), few), "node", "left_anti")
        tree.stops.append(lost.select("level", F.col("item").alias("node"), F.lit(None).cast("string").alias("cid"), F.lit(k).alias("in_level"), F.col("node").alias("in_node")))
        tree.parts.append(left.groupBy("cid").agg(F.sum("size").alias("n"), F.sum(F.col("size") * _inverse("w")).alias("s")))
        held = segments.join(merging(left.groupBy("cid", "node").agg(F.sum("size").alias("left"))), ["cid", "node"], "left")
        before = Window.partitionBy("node").orderBy("w")
        held = held.withColumn("whole", F.col("met_size") + F.coalesce("left", F.lit(0)))
        held = held.withColumns({"core": F.coalesce(F.sum("whole").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "prior": F.lag("cid").over(before), "next": F.lead("w").over(before)})
        held = cut_lineage(held)
        bottom = F.when(~F.col("alias"), F.col("met_size") + F.col("core"))
        tree.parts.append(held.select("cid", bottom.alias("n"), "w").filter("n > 0").select("cid", "n", (F.col("n") * _inverse("w")).alias("s")))
        tree.onward.append(held.filter("prior IS NOT NULL").select(F.col("prior").alias("child"), F.col("cid").alias("parent"), "w"))
        into = held.filter("NOT alias").select("node", "w", F.col("cid").alias("parent"))
        tree.links.append(of_large.filter("cid IS NOT NULL").select("node", "w", F.col("cid").alias("child")).join(merging(into), ["node", "w"]).select("child", "parent", "w"))
        tree.chains.append(held.select("node", "w", "cid", "alias"))
        tops = held.filter("next IS NULL").select("node", "cid")
        ended = chains.join(_side(tops, few), "node", "left")
        if last:
            tree.root = cut_lineage(tops.select("cid"))
        else:
            more = ended.select(F.col("up").alias("node"), F.col("t").alias("w"), F.col("total").alias("size"), "cid", F.lit(k).alias("level"), F.col("node").alias("item"))
            items = cut_lineage(climbed.unionByName(more))
    return tree


# Excess of mass -----------------------------------------------------------------
def _chain_stream(rows: DataFrame, order: Column, step, columns: list[str], types: list, schema: str) -> DataFrame:
    """``step`` over each chain's rows in order: it takes the state (None at the
    start of a chain) and a row, and gives the state and an answer (or None).
    Rows stream; none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["node"] != node:
                    node, state = row["node"], None
                state, answer = step(state, row)
                if answer is not None:
                    out.append(answer)
            columns_ = zip(*out, strict=True) if out else [()] * len(columns)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns_, types, strict=True)], names=columns)

    return rows.repartition("node").sortWithinPartitions("node", order).mapInArrow(run, schema)


def chosen(tree: Tree) -> DataFrame:
    """(cid, owner): the cluster that each cluster counts to, itself or the one
    above it that is chosen (null: none)."""
    met = cut_lineage(_union(tree.links))
    links = cut_lineage(_union([met, *tree.onward]))
    parts = _union(tree.parts).groupBy("cid").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    # A cluster without a link is the root, which is never chosen.
    stable = parts.join(merging(links), parts["cid"] == links["child"], "left").select("cid", F.when(F.col("parent").isNull(), 0.0).otherwise(F.col("s") - F.col("n") * _inverse("w")).alias("stability"), F.col("parent").isNull().alias("is_root"))
    stable = cut_lineage(stable)
    none = stable.filter(F.col("cid").startswith("0:"))
    best = [cut_lineage(none.select("cid", F.col("stability").alias("best"), (~F.col("is_root")).alias("keep")))]

    def mass(prior, row):
        if row["alias"]:
            return row["known"], None
        child = (prior or 0.0) + (row["items"] or 0.0)
        keep = not row["is_root"] and row["stability"] >= child
        value = max(row["stability"], child)
        return value, (row["cid"], value, keep)

    for chain in tree.chains:
        sums = met.join(merging(_union(best)), F.col("child") == F.col("cid")).groupBy("parent").agg(F.sum("best").alias("items"))
        known = _union(best).select("cid", F.col("best").alias("known"))
        rows = chain.join(merging(stable), "cid", "left").join(merging(sums), F.col("cid") == F.col("parent"), "left").join(merging(known), "cid", "left").select("node", "w", "cid", "alias", "stability", "is_root", "items", "known")
        best.append(cut_lineage(_chain_stream(rows, F.asc("w"), mass, ["cid", "best", "keep"], [pa.string(), pa.float64(), pa.bool_()], "cid string, best double, keep boolean")))
    kept = cut_lineage(_union(best).select("cid", "keep"))
    owners = [tree.root.select("cid", F.lit(None).cast("string").alias("owner"))]

    def choose(state, row):
        owner = row["above"] if state is None else state[0]
        if row["alias"]:
            return (owner,), None
        if owner is None and row["keep"]:
            owner = row["cid"]
        return (owner,), (row["cid"], owner)

    zero = none.select(F.col("cid").alias("node"), F.lit(0.0).alias("w"), "cid", F.lit(False).alias("alias"))
    for chain in [*reversed([c.withColumn("node", F.col("node").cast("string")) for c in tree.chains]), zero]:
        above = links.join(merging(_union(owners).withColumnRenamed("cid", "parent")), "parent").select(F.col("child").alias("cid"), F.col("owner").alias("above"))
        rows = chain.join(merging(kept), "cid", "left").join(merging(above), "cid", "left").select("node", "w", "cid", "alias", "keep", "above")
        owners.append(cut_lineage(_chain_stream(rows, F.desc("w"), choose, ["cid", "owner"], [pa.string(), pa.string()], "cid string, owner string")))
    return _union(owners).groupBy("cid").agg(F.max("owner").alias("owner"))


def density_hierarchy(points: DataFrame, min_size: int, metric: str) -> DataFrame:
    """(id, cluster_id) of ``points`` (id, v): the chosen cluster's least id, -1
    for points in none. A cluster has ``min_size`` points at least; the whole set
    is never one. Equal ids count as one point."""
    points = cut_lineage(points.groupBy("id").agg(F.first("v").alias("v")))
    same = cut_lineage(points.groupBy("v").agg(F.min("id").alias("point"), F.count("*").alias("copies")))
    members = cut_lineage(points.join(merging(same.drop("copies")), "v").select("id", "point"))
    weights = same.select(F.col("point").alias("id"), "copies")
    tables = rounds(same.select(F.col("point").alias("id"), "v"), metric)
    if not tables:
        return members.select("id", F.lit(-1).cast("long").alias("cluster_id"))
    tree = condensed(weights, tables, min_size)
    if tree.root.isEmpty():
        return members.select("id", F.lit(-1).cast("long").alias("cluster_id"))
    stops = cut_lineage(_union(tree.stops))
    clustered = tables[0].join(merging(weights), F.col("node") == F.col("id")).filter((F.col("copies") >= min_size) & (F.col("t") > 0)).select(F.col("node").alias("point"), F.concat(F.lit("0:"), F.col("node").cast("string")).alias("cid"))
    found = [cut_lineage(clustered)]
    at = stops.filter("level = 0").select(F.col("node").alias("point"), "cid", "in_level", "in_node")
    while True:  # each chain at least doubles the size, so a small one leads on min_size times at most
        at = cut_lineage(at)
        found.append(at.filter("cid IS NOT NULL").select("point", "cid"))
        open_ = at.filter("cid IS NULL").select("point", F.col("in_level").alias("level"), F.col("in_node").alias("node"))
        if open_.isEmpty():
            break
        at = open_.join(merging(stops), ["level", "node"]).select("point", "cid", "in_level", "in_node")
    owners = cut_lineage(chosen(tree).filter("owner IS NOT NULL"))
    few = _is_few(owners)
    owned = _union(found).join(_side(owners, few), "cid").select("point", "owner")
    owned = cut_lineage(members.join(merging(owned), "point", "left").select("id", "owner"))
    least = owned.filter("owner IS NOT NULL").groupBy("owner").agg(F.min("id").alias("least"))
    return owned.join(_side(least, few), "owner", "left").select("id", F.coalesce("least", F.lit(-1)).cast("long").alias("cluster_id"))
