"""Exact neighbour search in blocks of vectors.

Points are laid out once: two levels of pivots put near points into one block of
at most about ``TILE`` points, a row with its ids, its vectors packed as bytes,
its centre and its radius. A search takes, for every block, how far its points
have to look (their bounds) and finds by the triangle inequality the blocks that
can hold an answer: first the cells of the first level, whose pivots are few
enough to be sent everywhere, then the blocks inside those cells. The blocks meet
in a grid of tasks: a task holds the blocks of its row and lets those of its column
that can meet one of them stream by, each once. A ``Tile`` is what it knows of its
points, and compares many of them with many that come at once.

A k-nearest search has two phases. Inside a point's own block the distance to
the k-th nearest member is a true upper bound; with that bound the second phase
looks everywhere else; what it finds in a task narrows the bound there."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage, merging

#: Pivots of a level, which the driver holds; points of a block; headers or
#: probes of one task's tile; rows of a batch that a tile's answers fill; bytes of
#: vectors that a task holds.
MAX_PIVOTS = 4096
LEAF, TILE = 128, 512
PROBES = 2048
OUT_ROWS = 1 << 18
HELD_BYTES = 1 << 25
#: Held points of one product, and points that come to it together; coordinates that
#: a held point counts for at least.
ROWS, TOGETHER, LEAST_DIMS = 1024, 256, 64
DIGITS = 12  # of a distance


@dataclass
class Blocks:
    """``table``: block, cell, n, centre, radius, ids, bounds, rows (packed
    float64). ``pivots`` and ``reach`` are the first level's: the farthest point
    of each cell."""

    table: DataFrame
    pivot_ids: np.ndarray
    pivots: np.ndarray
    reach: np.ndarray
    n: int

    @property
    def slack(self) -> float:
        """A distance of nearly equal vectors is the root of a rounding error."""
        return 1e-6 * (1 + float(np.sqrt((self.pivots * self.pivots).sum(1)).max(initial=0.0)))

    @property
    def frame(self) -> tuple[np.ndarray, float]:
        """A point in the middle of all, and how far others are from it at most."""
        middle = self.pivots.mean(axis=0)
        away = np.sqrt(((self.pivots - middle) ** 2).sum(1)) + np.maximum(self.reach, 0.0)
        return middle, float(away.max(initial=0.0)) or 1.0


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances from x to y, near enough for bounds."""
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * x @ y.T
    return np.sqrt(np.maximum(square, 0.0))


def exact(x: np.ndarray, y: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(squares, distances, norms). Squares are compared, to within the rounding
    of a dot product: copies are at distance 0. Distances have ``DIGITS`` digits,
    so copies tie."""
    return _measured(x @ y.T, (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :], metric)


def _measured(dot: np.ndarray, norms: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    square = 2.0 * (1.0 - dot) if metric == "cosine" else norms - 2.0 * dot
    square[np.abs(square) <= 1e-13 * norms] = 0.0
    return square, np.round(square / 2 if metric == "cosine" else np.sqrt(np.maximum(square, 0.0)), DIGITS), norms


def _share(c: str):
    """A hash of the id as a number from 0 to 1."""
    return F.shiftrightunsigned(F.xxhash64(c), 11) / F.lit(float(1 << 53))


def _first_by_hash(points: DataFrame, n: int, m: int) -> list:
    """The first ``m`` of ``n`` points by a hash of their id. Only rows with hashes
    that are low enough are sorted, for every task sends its first ``m`` to the
    driver."""
    key, share = F.md5(F.col("id").cast("string")), (m + 8 * math.sqrt(m) + 16) / n
    while share < 1:
        low = points.filter(key.isNull() | (key < F.lit(f"{int(share * 16**12):012x}")))
        rows = low.orderBy(key, "id").limit(m).collect()
        if len(rows) == m:
            return rows
        share *= 4
    return points.orderBy(key, "id").limit(m).collect()


def lay_out(points: DataFrame, k: int | None) -> Blocks | None:
    """The blocks of ``points`` (id, v: a written table, which is read again and
    again), written; None for fewer than two. With ``k`` the bounds are the
    distances to the k-th nearest pivot or, if less, to the k-th nearest inside the
    own block (the first phase); else infinite."""
    n = points.count()
    if n < 2:
        return None
    m = min(MAX_PIVOTS, max((k or 1) + 1, math.ceil(math.sqrt(n))))
    rows = _first_by_hash(points, n, m)
    pivot_ids, pivots = np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows], dtype=np.float64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                ids = part.column("id").to_numpy()
                d = distances(_matrix(part.column("v")), pivots)
                cell = d.argmin(1)
                far, bound = d[np.arange(len(d)), cell], np.full(len(d), np.inf)
                if k is not None and len(pivots) > k:
                    d[pivot_ids[None, :] == ids[:, None]] = np.inf
                    bound = np.partition(d, k - 1, axis=1)[:, k - 1]
                columns = [part.column("id"), part.column("v"), pa.array(cell, pa.int32()), pa.array(far), pa.array(bound)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "cell", "far", "bound"])

    cells = cut_lineage(points.select("id", "v").mapInArrow(assign, "id long, v array<double>, cell int, far double, bound double"))
    per_cell = {r["cell"]: r for r in cells.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    reach = np.array([per_cell[c]["far"] if c in per_cell else -np.inf for c in range(len(pivots))])
    # The second level: a cell is dealt in parts; each meets all of its pivots.
    plan = points.sparkSession.createDataFrame(
        [(c, min(1.0, math.ceil(r["n"] / LEAF) / r["n"], MAX_PIVOTS / r["n"]) if r["n"] > LEAF else 0.0, math.ceil(r["n"] / PROBES)) for c, r in per_cell.items()],
        "cell int, share double, parts int",
    )
    cells = cells.join(F.broadcast(plan), "cell")  # a row for each pivot
    inner = cells.filter(_share("id") < F.col("share")).select(F.col("cell").alias("of"), F.col("v").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("of_part"))
    dealt = cells.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.col("parts")).cast("int"))

    def nearest(pts: pa.Table, inner: pa.Table) -> pa.Table:
        pts = pts.select(["cell", "id", "v", "bound"]).combine_chunks()
        leaf = np.zeros(pts.num_rows, dtype=np.int32)
        if pts.num_rows and inner.num_rows:
            x, near = _matrix(pts.column("v")), _in_order(_matrix(inner.column("pivot")))
            for low in range(0, len(x), ROWS):
                leaf[low : low + ROWS] = distances(x[low : low + ROWS], near).argmin(1)
        return pts.add_column(1, "leaf", pa.array(leaf))

    leaves = cut_lineage(dealt.groupBy("cell", "part").cogroup(inner.groupBy("of", "of_part")).applyInArrow(nearest, "cell int, leaf int, id long, v array<double>, bound double"))
    sizes = leaves.groupBy("cell", "leaf").agg(F.ceil(F.count("*") / TILE).alias("splits"))
    split = F.pmod(F.xxhash64("id", F.lit("split")), F.col("splits")).alias("split")
    listed = leaves.join(sizes, ["cell", "leaf"]).select("cell", "leaf", split, F.struct("id", "v", "bound").alias("p")).groupBy("cell", "leaf", "split").agg(F.array_sort(F.collect_list("p")).alias("p"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell, p in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, bounds = p.values.field("id"), p.values.field("bound")
                x = p.values.field("v").flatten().to_numpy().reshape(len(ids), -1)
                centre = x.mean(axis=0)
                radius = float(np.sqrt(((x - centre) ** 2).sum(1).max()))
                bound = bounds.to_numpy() if k is None else _own_bound(x, bounds.to_numpy(), k)
                out.append((cell, len(ids), centre.tolist(), radius, ids.to_pylist(), bound.tolist(), x.tobytes()))
            types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary()]
            columns = zip(*out, strict=True) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["cell", "n", "centre", "radius", "ids", "bounds", "rows"])

    packed = listed.select("cell", "p").mapInArrow(pack, "cell int, n int, centre array<double>, radius double, ids array<long>, bounds array<double>, rows binary")
    return Blocks(cut_lineage(packed.withColumn("block", F.monotonically_increasing_id())), pivot_ids, pivots, reach, n)


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row for each vector; all have one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    x = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = vectors.offsets.to_numpy()
    if len(vectors) and (np.diff(ends) != ends[1] - ends[0]).any():
        raise ValueError("vectors of different lengths")
    return x.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def _in_order(x: np.ndarray) -> np.ndarray:
    """Pivots in an order of their own, so that every part of a cell numbers
    them alike."""
    return x[np.lexsort(x.T[::-1])]


def unpacked(rows: bytes, n: int) -> np.ndarray:
    return np.frombuffer(rows, dtype=np.float64).reshape(n, -1)


def _own_bound(x: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
    """Bounds of a block's points, not above the k-th nearest of the block."""
    if len(x) <= k:
        return bound
    d = distances(x, x)
    np.fill_diagonal(d, np.inf)
    return np.minimum(bound, np.partition(d, k - 1, axis=1)[:, k - 1])


def own_bounds(blocks: Blocks, k: int) -> Blocks:
    """Bounds not above the k-th nearest inside the own block, for another ``k``
    than the blocks were laid out with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for n, rows, old in zip(batch.column("n").to_pylist(), batch.column("rows"), batch.column("bounds"), strict=True):
                bounds.append(_own_bound(unpacked(rows.as_py(), n), old.values.to_numpy(), k).tolist())
            columns = [pa.array(bounds, pa.list_(pa.float64())) if name == "bounds" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return Blocks(cut_lineage(blocks.table.mapInArrow(run, blocks.table.schema)), blocks.pivot_ids, blocks.pivots, blocks.reach, blocks.n)


def _chunks(have: dict[int, int]) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[int, int]]]:
    """Cells put together to chunks of about ``PROBES`` headers: (cell, chunk) in
    the order of chunks, and for each cell its first chunk and how many it has."""
    cells, chunks, of, at, filled = [], [], {}, 0, 0
    for c, n in sorted(have.items()):
        if filled and filled + n > PROBES:
            at, filled = at + 1, 0
        parts = math.ceil(n / PROBES)
        of[c] = (at, parts)
        cells += [c] * parts
        chunks += range(at, at + parts)
        at, filled = (at + parts, 0) if parts > 1 else (at, filled + n)
    return np.array(cells, dtype=np.int64), np.array(chunks, dtype=np.int64), of


def meeting(blocks: Blocks, probes: DataFrame, rows: int | None = None) -> DataFrame:
    """(a, b), written: the blocks b that can hold a point within ``look`` of
    block a's points. ``probes``: block, centre, look (radius and bound). With
    ``rows`` (row, b): the rows of the grid that have such a block a, so there are
    far fewer of them than pairs."""
    pivots, reach, slack = blocks.pivots, blocks.reach, blocks.slack
    headers = blocks.table.select("cell", F.col("block").alias("b"), F.col("centre").alias("b_centre"), "radius")
    # At most one row for each pivot.
    cells, chunks, of = _chunks({r["cell"]: r["count"] for r in headers.groupBy("cell").count().collect()})
    opens = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1]))

    def cells_near(b: pd.DataFrame) -> np.ndarray:
        return distances(np.stack(b["centre"].to_numpy()), pivots) - reach[None, :] <= b["look"].to_numpy()[:, None] + slack

    def to_chunks(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if len(b):
                a, chunk = np.nonzero(np.logical_or.reduceat(cells_near(b)[:, cells], opens, axis=1))
                yield pd.DataFrame({"a": b["block"].to_numpy()[a], "centre": b["centre"].to_numpy()[a], "look": b["look"].to_numpy()[a], "chunk": chunks[opens][chunk].astype("int32")})

    probing = cut_lineage(probes.select("block", "centre", "look").mapInPandas(to_chunks, "a long, centre array<double>, look double, chunk int"))
    # A row for each chunk, fewer than pivots and headers / PROBES.
    asked = {r["chunk"]: math.ceil(r["count"] / PROBES) for r in probing.groupBy("chunk").count().collect()}
    spark = probes.sparkSession
    sizes = F.broadcast(spark.createDataFrame(list(asked.items()), "chunk int, t int"))
    places = F.broadcast(spark.createDataFrame([(c, first, parts) for c, (first, parts) in of.items()], "cell int, first int, parts int"))
    left = probing.join(sizes, "chunk").select("chunk", "a", "centre", "look", F.pmod(F.xxhash64("a"), F.col("t")).cast("int").alias("part"), row_of("a", rows or 1).alias("row"))
    right = headers.join(places, "cell").withColumn("of", (F.col("first") + F.pmod(F.xxhash64("b"), F.col("parts"))).cast("int"))
    right = right.join(sizes.withColumnRenamed("chunk", "of"), "of").select("of", "cell", "b", "b_centre", "radius", F.explode(F.sequence(F.lit(0), F.col("t") - 1)).alias("of_part"))

    names = ["a" if rows is None else "row", "b"]

    def match(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({name: [] for name in names})
        d = distances(np.stack(x["centre"].to_numpy()), np.stack(y["b_centre"].to_numpy()))
        near = d - y["radius"].to_numpy()[None, :] <= x["look"].to_numpy()[:, None] + slack
        near &= cells_near(x)[:, y["cell"].to_numpy()]
        first = x["a"].to_numpy()
        if rows is not None:
            first = np.unique(x["row"].to_numpy())
            near = np.stack([near[x["row"].to_numpy() == row].any(axis=0) for row in first])
        i, j = np.nonzero(near)
        return pd.DataFrame({names[0]: first[i], "b": y["b"].to_numpy()[j]})

    return cut_lineage(left.groupBy("chunk", "part").cogroup(right.groupBy("of", "of_part")).applyInPandas(match, f"{names[0]} long, b long"))


def row_of(block: str, rows: int) -> Column:
    """The row of the grid that holds a block."""
    return F.pmod(F.xxhash64(block), F.lit(rows))




def grid(blocks: Blocks, tasks: int) -> tuple[int, int]:
    """Rows and columns of the tasks that blocks are dealt to: a row's blocks are at
    most about ``HELD_BYTES``. What a task knows of a point counts as ``LEAST_DIMS``."""
    size, most = blocks.n * max(blocks.pivots.shape[1], LEAST_DIMS) * 8, math.ceil(blocks.n / LEAF)
    rows = max(math.ceil(size / HELD_BYTES), math.ceil(math.sqrt(min(tasks, most))))
    return rows, math.ceil(min(tasks, most) / rows)


def _tasks(df: DataFrame) -> int:
    return 2 * df.sparkSession.sparkContext.defaultParallelism


def dealt(blocks: Blocks, pairs: DataFrame, left: DataFrame, right: DataFrame, half: bool = False) -> DataFrame:
    """The rows of both sides, each once for a task that needs it, as a partition
    for each task: first the left ones, then the right ones that may meet one of
    them. ``pairs``: (a, b) or (row, b). With ``half`` two rows of the grid meet
    once, not in both of them."""
    rows, columns = grid(blocks, _tasks(pairs))
    if "row" not in pairs.columns:
        pairs = pairs.select(row_of("a", rows).alias("row"), "b")
    if half:
        pairs = pairs.filter(F.pmod(row_of("b", rows) - F.col("row"), F.lit(rows)) <= rows // 2)
    column = F.pmod(F.xxhash64("b", F.lit("column")), F.lit(columns))
    task = (F.col("row") * columns + F.col("column")).cast("int").alias("task")
    held = left.withColumns({"row": row_of("block", rows), "column": F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))})
    held = held.select(task, F.lit(0).alias("side"), *[F.col(c).alias(f"a_{c}") for c in left.columns])
    streamed = pairs.distinct().withColumn("column", column).select(task, F.col("b").alias("block")).join(merging(right), "block")
    streamed = streamed.select("task", F.lit(1).alias("side"), *[F.col(c).alias(f"b_{c}") for c in right.columns])
    both = held.unionByName(streamed, allowMissingColumns=True)
    return both.repartitionById(rows * columns, F.col("task")).sortWithinPartitions("task", "side")


def over_tiles(blocks: Blocks, pairs: DataFrame, left: DataFrame, right: DataFrame, work: Callable[[list[dict]], Tile], schema: str, names: list[str], types: list, half: bool = False) -> DataFrame:
    """The answers of ``work`` in every task of the grid: a ``Tile`` made of the
    left rows, that looks at one right row after the other. ``left`` and ``right``
    hold a row for each block."""

    def side_of(batch: pa.RecordBatch, at: int, prefix: str) -> dict:
        row = {name[2:]: batch.column(k)[at] for k, name in enumerate(batch.schema.names) if name.startswith(prefix)}
        plain = {c: np.array(v.values) if isinstance(v, pa.ListScalar) else v.as_py() for c, v in row.items()}  # copies, that let go of the batch
        return plain | {"rows": unpacked(plain["rows"], plain["n"])}

    def sent(columns: tuple | None) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(columns[0]) if columns else 0, OUT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[low : low + OUT_ROWS], t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, tile = None, [], None
        for batch in batches:
            tasks, sides = batch.column("task").to_numpy(), batch.column("side").to_numpy()
            for at in range(batch.num_rows):
                if tasks[at] != task:
                    if tile is not None:
                        yield from sent(tile.last())
                    task, held, tile = tasks[at], [], None
                if sides[at] == 0:
                    held.append(side_of(batch, at, "a_"))
                    continue
                if tile is None:
                    if not held:
                        continue
                    tile, held = work(held), []
                tile.look(side_of(batch, at, "b_"))
                if tile.size >= OUT_ROWS:
                    yield from sent(tile.taken())
        if tile is not None:
            yield from sent(tile.last())

    return dealt(blocks, pairs, left, right, half).mapInArrow(run, schema)


def _joined(blocks: list[dict], column: str) -> np.ndarray:
    return np.concatenate([b[column] for b in blocks])


class Near:
    """Points that come to a tile: blocks put together, in the order of their ids.
    ``v``: float32, in the tile's frame, with half their squares below, so that one
    product with (u, 1) tells how far they are."""

    def __init__(self, blocks: list[dict], frame: tuple[np.ndarray, float]):
        middle, size = frame
        by = np.argsort(_joined(blocks, "ids"), kind="stable")
        self.y, self.ids = _joined(blocks, "rows")[by], _joined(blocks, "ids")[by]
        self.labels = _joined(blocks, "labels")[by] if "labels" in blocks[0] else None
        self.norm = float((self.y * self.y).sum(1).max())
        self.v, self.most = Near.half((self.y - middle) / size)
        self.ball = None
        if len(blocks) == 1:
            centre, most = Near.half((blocks[0]["centre"] - middle)[None] / size)
            self.ball = centre[:, 0], most, blocks[0]["radius"]

    @staticmethod
    def half(v: np.ndarray) -> tuple[np.ndarray, float]:
        square = (v * v).sum(1)
        return np.concatenate([v.T, -square[None] / 2]).astype(np.float32), float(np.sqrt(square.max()))


class Tile:
    """The points that a task holds. ``allow`` is the square of how far each of
    them looks, which may become less. Blocks that most of the points have to look
    into are put together; of others only the blocks and points that are near.

    A product in float32 leaves out the pairs that lie too far by more than its
    rounding; what it lets pass is compared in float64."""

    def __init__(self, held: list[dict], frame: tuple[np.ndarray, float], slack: float, metric: str, asks: np.ndarray | None = None):
        self.frame, self.slack, self.metric = frame, slack, metric
        self.x, self.ids, bounds = (_joined(held, c) for c in ("rows", "ids", "bounds"))
        self.labels = _joined(held, "labels") if "labels" in held[0] else None
        counts = np.array([h["n"] for h in held])
        if asks is not None:
            counts = np.add.reduceat(asks.astype(np.int64), np.cumsum(counts) - counts)
            self.x, self.ids, bounds, self.labels = (c if c is None else c[asks] for c in (self.x, self.ids, bounds, self.labels))
        some = counts > 0
        self.counts, self.starts = counts[some], (np.cumsum(counts) - counts)[some]
        self.centres, self.radii = np.stack([h["centre"] for h in held])[some], np.array([h["radius"] for h in held])[some]
        u = (self.x - frame[0]) / frame[1]
        self.square, self.norm = (u * u).sum(1), (self.x * self.x).sum(1)
        self.length = np.sqrt(self.square)
        self.u = np.concatenate([u, np.ones((len(u), 1))], axis=1).astype(np.float32)
        self.allow = bounds**2
        self.queue: list[dict] = []
        self.answers: list[tuple] = []
        self.size = 0  # of the answers
        self.narrowed()

    def narrowed(self) -> None:
        """To be called when ``allow`` has become less."""
        self.far = np.sqrt(np.maximum.reduceat(self.allow, self.starts)) if len(self.starts) else np.zeros(0)

    def look(self, b: dict) -> None:
        open_ = distances(self.centres, b["centre"][None])[:, 0] - self.radii - b["radius"] <= self.far + self.slack
        near = self.counts[open_].sum()
        if 2 * near > len(self.x):
            self.queue.append(b)
            if sum(q["n"] for q in self.queue) >= TOGETHER:
                self.look_at_all()
        elif near:
            self.meet(Near([b], self.frame), np.flatnonzero(np.repeat(open_, self.counts)))

    def look_at_all(self) -> None:
        queue, self.queue = self.queue, []
        if queue:
            self.meet(Near(queue, self.frame), np.arange(len(self.x)))

    def meet(self, near: Near, at: np.ndarray) -> None:
        """Compare the held points ``at`` with those that came."""
        raise NotImplementedError

    def taken(self) -> tuple | None:
        """The answers so far, as columns."""
        answers, self.answers, self.size = self.answers, [], 0
        return tuple(np.concatenate(c) for c in zip(*answers, strict=True)) if answers else None

    def last(self) -> tuple | None:
        self.look_at_all()
        return self.taken()

    def apart(self, i: np.ndarray, near: Near, j: np.ndarray) -> np.ndarray | bool:
        """Which pairs count at all."""
        return True

    def fewer(self, ok: np.ndarray, dist: np.ndarray) -> np.ndarray:
        """Of a table of pairs those that matter."""
        return ok

    def _least(self, at: np.ndarray, allow: np.ndarray, most: float) -> np.ndarray:
        """What the product of a held point with one that is near enough is at least,
        whatever the rounding."""
        t = (self.square[at] - allow / self.frame[1] ** 2) / 2
        off = (self.u.shape[1] + 4) * 2.0**-23 * (self.length[at] + most) ** 2
        return (t - off - 2.0**-22 * np.abs(t)).astype(np.float32)

    def near(self, at: np.ndarray, near: Near, columns: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, distance): the pairs of a point of ``at`` and one (of ``columns``)
        that came, within what it allows, piece by piece."""
        v, y = (near.v, near.y) if columns is None else (np.ascontiguousarray(near.v[:, columns]), near.y[columns])
        name = np.arange(len(near.y)) if columns is None else columns
        for low in range(0, len(at), ROWS):
            part = at[low : low + ROWS]
            if part[-1] - part[0] + 1 == len(part):
                u = self.u[part[0] : part[-1] + 1]
            else:
                u = self.u[part]
            if near.ball is not None:
                centre, most, radius = near.ball
                reach = np.sqrt(self.allow[part]) + radius + self.slack
                close = u @ centre >= self._least(part, reach * reach, most)
                if not close.all():
                    part, u = part[close], u[close]
                    if not len(part):
                        continue
            allow = self.allow[part] + 1e-12 * (self.norm[part] + near.norm)
            least, s = self._least(part, allow, near.most), u @ v
            hit = np.flatnonzero(s.max(axis=1) >= least)
            if not len(hit):
                continue
            i, j = np.nonzero(s[hit] >= least[hit, None])
            if 32 * len(i) > s.size:
                square, dist, norms = exact(self.x[part], y, self.metric)
                ok = (square <= self.allow[part][:, None] + 1e-12 * norms) & self.apart(part[:, None], near, name[None, :])
                i, j = np.nonzero(self.fewer(ok, dist))
                yield part[i], name[j], dist[i, j]
            else:
                i, j = part[hit[i]], name[j]
                square, dist, norms = self.exact_pairs(i, near.y, j)
                ok = (square <= self.allow[i] + 1e-12 * norms) & self.apart(i, near, j)
                yield i[ok], j[ok], dist[ok]

    def exact_pairs(self, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``exact`` of some pairs."""
        dot = np.concatenate([np.einsum("nd,nd->n", self.x[i[k : k + ROWS]], y[j[k : k + ROWS]]) for k in range(0, len(i), ROWS)] or [np.zeros(0)])
        return _measured(dot, self.norm[i] + (y * y).sum(1)[j], self.metric)


class All(Tile):
    """Every pair of different ids."""

    def apart(self, i, near, j):
        return self.ids[i] != near.ids[j]

    def meet(self, near, at):
        for i, j, dist in self.near(at, near):
            self.answers.append((self.ids[i], near.ids[j], dist))
            self.size += len(i)


class Nearest(All):
    """The ``k`` nearest, by distance and id. What a point has found so far bounds
    how far it looks on."""

    def __init__(self, held, frame, slack, metric, k: int):
        super().__init__(held, frame, slack, metric)
        self.k, self.found, self.waiting = k, [], 0
        self.best, self.who = np.full((len(self.x), k), np.inf), np.full((len(self.x), k), np.iinfo(np.int64).max)

    def fewer(self, ok, dist):
        if ok.shape[1] <= self.k:
            return ok
        # Columns are in the order of ids.
        masked = np.where(ok, dist, np.inf)
        last = np.partition(masked, self.k - 1, axis=1)[:, self.k - 1 : self.k]
        tie = masked == last
        room = self.k - (masked < last).sum(axis=1, keepdims=True)
        return ok & ((masked < last) | (tie & (np.cumsum(tie, axis=1) <= room)))

    def meet(self, near, at):
        for i, j, dist in self.near(at, near):
            self.found.append((i, dist, near.ids[j]))
            self.waiting += len(i)
            if self.waiting >= OUT_ROWS:
                self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        i, dist, who = (np.concatenate(c) for c in zip(*self.found, strict=True))
        self.found, self.waiting, k = [], 0, self.k
        by = np.argsort(i, kind="stable")
        i, dist, who = i[by], dist[by], who[by]
        points, first, count = np.unique(i, return_index=True, return_counts=True)
        nth, width = np.arange(len(i)) - np.repeat(first, count), np.ceil(np.log2(count) / 2).astype(int)
        for w in np.unique(width):  # points with nearly as many
            here, these = width == w, np.repeat(width == w, count)
            rows, row = points[here], np.repeat(np.arange(here.sum()), count[here])
            d = np.concatenate([self.best[rows], np.full((len(rows), count[here].max()), np.inf)], axis=1)
            ids = np.concatenate([self.who[rows], np.full((len(rows), count[here].max()), np.iinfo(np.int64).max)], axis=1)
            d[row, k + nth[these]], ids[row, k + nth[these]] = dist[these], who[these]
            pick = np.argpartition(d, k - 1, axis=1)[:, :k]
            last = np.take_along_axis(d, pick[:, -1:], axis=1)
            tie = (d <= last).sum(axis=1) > k
            if tie.any():
                pick[tie] = np.lexsort((ids[tie], d[tie]), axis=-1)[:, :k]
            self.best[rows], self.who[rows] = np.take_along_axis(d, pick, axis=1), np.take_along_axis(ids, pick, axis=1)
            self.allow[rows] = np.minimum(self.allow[rows], _allowed(last[:, 0], self.metric))
        self.narrowed()

    def last(self):
        self.look_at_all()
        self.settle()
        i, j = np.nonzero(np.isfinite(self.best))
        return self.ids[i], self.who[i, j], self.best[i, j]


class Forest(Tile):
    """Edges with the connectivity of all pairs within the bounds (one for all
    points): ``root`` is the place of a point of the same component. Who came and
    is known to meet the largest component needn't be compared with the rest of it."""

    def __init__(self, held, frame, slack, metric):
        super().__init__(held, frame, slack, metric)
        self.root, self.largest = np.arange(len(self.x)), 0

    def meet(self, near, at):
        inside = self.root[at] == self.largest
        main, came, alone = at[inside], np.full(len(near.y), -1), np.arange(len(near.y))
        low, step = 0, ROWS // 8
        while len(alone) and low < len(main):
            self.join(came, near, main[low : low + step], alone)
            low, step, alone = low + step, ROWS, np.flatnonzero(came < 0)
        self.join(came, near, at[~inside])
        linked = np.flatnonzero(came >= 0)
        self.answers.append((near.ids[linked], self.ids[came[linked]]))
        self.size += len(linked)

    def join(self, came: np.ndarray, near: Near, at: np.ndarray, columns: np.ndarray | None = None) -> None:
        """Take up the pairs of ``at`` with those that came; ``came``: the place of a
        point that each of them is joined to, or -1."""
        n, m, found, size = len(self.x), len(self.x) + len(came), [], 0
        for i, j, _ in self.near(at, near, columns):
            found.append(self.root[i] * m + n + j)
            size += len(i)
            if size >= OUT_ROWS:
                found, size = [np.unique(np.concatenate(found))], 0
        found = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
        if not len(found):
            return
        linked = np.flatnonzero(came >= 0)
        nodes, roots = star_forest(np.append(found // m, self.root[came[linked]]), np.append(found % m, n + linked))
        ours, to = nodes < n, np.arange(n)
        if ours.any():
            to[nodes[ours]] = roots[ours]
            self.root = to[self.root]
            self.largest = np.bincount(self.root).argmax()
        came[nodes[~ours] - n] = roots[~ours]

    def last(self):
        self.look_at_all()
        i = np.flatnonzero(self.root != np.arange(len(self.x)))
        self.answers.append((self.ids[i], self.ids[self.root[i]]))
        return self.taken()


class Outside(Tile):
    """For each label of the points that ask (their bound is not below 0) the nearest
    point of another label."""

    def __init__(self, held, frame, slack, metric):
        super().__init__(held, frame, slack, metric, _joined(held, "bounds") >= 0)
        self.names, self.of = np.unique(self.labels, return_inverse=True)
        self.best, self.who = np.full(len(self.names), np.inf), np.full(len(self.names), np.iinfo(np.int64).max)

    def apart(self, i, near, j):
        return self.labels[i] != near.labels[j]

    def meet(self, near, at):
        if (near.labels == near.labels[0]).all():
            at = at[self.labels[at] != near.labels[0]]
        for i, j, dist in self.near(at, near):
            if not len(i):
                continue
            of, other = self.of[i], near.labels[j]
            by = np.lexsort((other, dist, of))
            first = by[np.append(True, of[by][1:] != of[by][:-1])]
            of, dist, other = of[first], dist[first], other[first]
            less = (dist < self.best[of]) | ((dist == self.best[of]) & (other < self.who[of]))
            self.best[of[less]], self.who[of[less]] = dist[less], other[less]
            if less.any():
                self.allow = np.minimum(self.allow, _allowed(self.best, self.metric)[self.of])
                self.narrowed()

    def last(self):
        self.look_at_all()
        found = np.isfinite(self.best)
        return self.names[found], self.best[found], self.who[found]


class Cost(Tile):
    """How many blocks, and points in them, each point looks into."""

    def __init__(self, held, frame, slack, metric):
        super().__init__(held, frame, slack, metric)
        self.blocks, self.points = np.zeros((2, len(self.x)), dtype=np.int64)

    def look(self, b):
        to_centre = np.sqrt(((self.x - b["centre"][None, :]) ** 2).sum(1))
        looks = to_centre - b["radius"] <= np.sqrt(self.allow) + self.slack
        self.blocks += looks
        self.points += b["n"] * looks

    def last(self):
        return self.ids, self.blocks, self.points


def _allowed(dist: np.ndarray, metric: str) -> np.ndarray:
    """The square within which a point is as near as ``dist``, ties included."""
    dist = dist + 10.0**-DIGITS
    return 2.0 * dist if metric == "cosine" else dist * dist


SIDE = ["block", "n", "ids", "rows"]
BALL = [*SIDE, "centre", "radius"]


def _over_all(blocks: Blocks, work: type, metric: str, schema: str, names: list[str], types: list, half: bool = False, **kw) -> DataFrame:
    """``work`` over all blocks that meet under the bounds of ``blocks``."""
    look = F.col("radius") + F.array_max("bounds")
    pairs = meeting(blocks, blocks.table.select("block", "centre", look.alias("look")), grid(blocks, _tasks(blocks.table))[0])
    made = partial(work, frame=blocks.frame, slack=blocks.slack, metric=metric, **kw)
    return over_tiles(blocks, pairs, blocks.table.select(*BALL, "bounds"), blocks.table.select(*BALL), made, schema, names, types, half)


def within(blocks: Blocks, metric: str, k: int | None) -> DataFrame:
    """(src, dst, distance) within the bounds of ``blocks``; with ``k`` only the k
    nearest that a task finds for each point."""
    work, more = (All, {}) if k is None else (Nearest, {"k": k})
    return _over_all(blocks, work, metric, "src long, dst long, distance double", ["src", "dst", "distance"], [pa.int64(), pa.int64(), pa.float64()], **more)


def star_forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest id of its component) of the graph given by the
    pairs: the same connectivity with at most one edge per node."""
    nodes, inv = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = inv[: len(src)], inv[len(src):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        m = np.minimum(label[a], label[b])
        np.minimum.at(label, a, m)
        np.minimum.at(label, b, m)
        label = label[label]  # pointer jumping
        if np.array_equal(label, before):
            break
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def connecting(blocks: Blocks, metric: str) -> DataFrame:
    """(src, dst) that connect what pairs within the bounds (one for all points)
    connect: of each task a forest of the points it holds, and an edge for each
    point that came and is joined to one of them."""
    return _over_all(blocks, Forest, metric, "src long, dst long", ["src", "dst"], [pa.int64(), pa.int64()], half=True)


def search_cost(blocks: Blocks) -> DataFrame:
    """(id, blocks, points): how many blocks, and points in them, each point has
    to look into under the bounds of ``blocks``."""
    met = _over_all(blocks, Cost, "euclidean", "id long, blocks long, points long", ["id", "blocks", "points"], [pa.int64()] * 3)
    return met.groupBy("id").agg(F.sum("blocks").alias("blocks"), F.sum("points").alias("points"))


def nearest_outside(blocks: Blocks, queries: DataFrame, labels: DataFrame, metric: str) -> DataFrame:
    """(label, distance, other): for each label of ``queries`` (id, label, bound)
    the nearest pair from one of its points to a point of another label, as far
    as one lies within the bounds. ``labels``: (id, label) of all points."""
    members = blocks.table.select("block", F.posexplode("ids").alias("place", "id"))
    marked = members.join(merging(labels), "id").join(merging(queries.select("id", "bound")), "id", "left")
    row = F.struct("place", "label", F.coalesce("bound", F.lit(-1.0)).alias("bound"))
    marked = marked.groupBy("block").agg(F.array_sort(F.collect_list(row)).alias("m"))
    # Vectors stay in the blocks' own table; only labels and bounds are written.
    marks = cut_lineage(marked.select("block", F.col("m.label").alias("labels"), F.col("m.bound").alias("bounds")))
    asking = marks.select("block", F.array_max("bounds").alias("bound")).filter("bound >= 0").join(merging(blocks.table.select("block", "centre", "radius")), "block")
    pairs = meeting(blocks, asking.select("block", "centre", (F.col("radius") + F.col("bound")).alias("look")), grid(blocks, _tasks(marks))[0])
    sides = blocks.table.drop("bounds").join(merging(marks), "block")
    left = sides.filter(F.array_max("bounds") >= 0).select(*BALL, "labels", "bounds")
    made = partial(Outside, frame=blocks.frame, slack=blocks.slack, metric=metric)
    met = over_tiles(blocks, pairs, left, sides.select(*BALL, "labels"), made, "label long, distance double, other long", ["label", "distance", "other"], [pa.int64(), pa.float64(), pa.int64()])
    return met.groupBy("label").agg(F.min(F.struct("distance", "other")).alias("best")).select("label", "best.*")
