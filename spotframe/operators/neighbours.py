"""Neighbour graphs on coordinates, on the lattice and on principal-component scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import SPOT, distance
from ..functions.storage import stable
from .blocks import BLOCK, MEETING, block_pairs, each_pair, one_by_one, pack_blocks, pieces

# Cells are a hair larger than the search radius, so that rounding in the division cannot push a
# neighbour at exactly that distance two cells away.
SLACK = 1.0 + 1e-9
DENSE_CELL = 64
MAX_HALVINGS = 40


def _cell(coordinate: str, side: str = "side") -> Column:
    return F.floor(F.col(coordinate) / F.col(side))


def _around(df: DataFrame) -> DataFrame:
    """Repeat every row for the 9 cells around its own cell (gx, gy)."""
    nine = F.sequence(F.lit(-1), F.lit(1))
    return (
        df.withColumn("_dx", F.explode(nine))
        .withColumn("_dy", F.explode(nine))
        .withColumns({"gx": F.col("gx") + F.col("_dx"), "gy": F.col("gy") + F.col("_dy")})
        .drop("_dx", "_dy")
    )


def count_within(points: DataFrame, radius: DataFrame, block: int = BLOCK) -> DataFrame:
    """Number of other points of the sample at distance strictly below the sample's radius.

    Points are packed into bounded chunks of grid cells (side = radius); chunks of neighbouring cells meet
    in an equi-join and only counts per point leave the task, so no pair of points ever becomes a row.
    """
    cell = ["sample_id", "gx", "gy"]
    placed = (
        points.select(*SPOT, "px", "py")
        .join(radius.where(F.col("radius") > 0), "sample_id")
        .withColumn("side", F.col("radius") * F.lit(SLACK))
        .withColumns({"gx": _cell("px"), "gy": _cell("py")})
    )
    packed = pack_blocks(placed, [*cell, "radius"], ["obs_id", "px", "py"], block=block)
    sources = _around(packed.select(*cell, "radius", F.col("pts").alias("a")))
    sizes = packed.select(*cell, "n_blocks").distinct()
    spread = sources.join(sizes, cell).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    met = spread.join(packed.select(*cell, "block", F.col("pts").alias("b")), [*cell, "block"])
    # The blocks around one block go to Python together: a batch of thousands of packed rows would outgrow a worker.
    keys = [*cell, "block"]
    rows = met.select(
        *keys,
        "radius",
        F.col("a.obs_id").alias("ids"),
        F.col("a.px").alias("ax"),
        F.col("a.py").alias("ay"),
        F.col("b.px").alias("bx"),
        F.col("b.py").alias("by"),
    )

    def tally(r) -> pd.DataFrame:
        near = np.zeros(len(r.ids), dtype=np.int64)
        for at in range(0, len(r.ids), 256):
            piece = slice(at, at + 256)
            dx, dy = np.subtract.outer(r.ax[piece], r.bx), np.subtract.outer(r.ay[piece], r.by)
            near[piece] = (np.sqrt(dx * dx + dy * dy) < r.radius).sum(axis=1)
        return pd.DataFrame({"sample_id": r.sample_id, "obs_id": r.ids, "n": near})

    counted = one_by_one(rows, keys, tally, "sample_id string, obs_id long, n long")
    # A point meets itself exactly once.
    return counted.groupBy(*SPOT).agg((F.sum("n") - 1).alias("n_within"))


def radius_graph(points: DataFrame, radius: float) -> DataFrame:
    """All ordered pairs of different spots of a sample within ``radius`` (inclusive); radius 0 leaves spots at one place."""
    # Any side will do for radius 0, as equal places share a cell.
    side = F.lit(radius * SLACK or 1.0)
    placed = points.select(*SPOT, "px", "py", F.floor(F.col("px") / side).alias("gx"), F.floor(F.col("py") / side).alias("gy"))
    a = _around(placed).select("sample_id", "gx", "gy", F.col("obs_id").alias("src"), F.col("px").alias("ax"), F.col("py").alias("ay"))
    b = placed.select("sample_id", "gx", "gy", F.col("obs_id").alias("dst"), F.col("px").alias("bx"), F.col("py").alias("by"))
    d = distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    met = a.join(b, ["sample_id", "gx", "gy"]).withColumn("distance", d)
    return met.where((F.col("src") != F.col("dst")) & (F.col("distance") <= radius)).select(
        "sample_id", "src", "dst", "distance", F.lit(1.0).alias("weight")
    )


def _cell_sides(places: DataFrame, reps: DataFrame, k: int, by: list[str]) -> DataFrame:
    """Starting cell side per group: about k places per cell, halved while some cell stays crowded."""
    w, h = F.max("px") - F.min("px"), F.max("py") - F.min("py")
    box = places.groupBy(*by).agg(w.alias("_w"), h.alias("_h"), F.count(F.lit(1)).alias("_n"))
    by_area = F.sqrt(F.col("_w") * F.col("_h") * F.lit(float(k)) / F.col("_n"))
    by_line = F.greatest("_w", "_h") * F.lit(float(k)) / F.col("_n")
    side = F.greatest(by_area, by_line)
    sides = stable(
        box.select(*by, F.greatest("_w", "_h").alias("extent"), F.when(side > 0, side).otherwise(1.0).alias("side"))
    )
    limit = max(DENSE_CELL, 8 * k)
    for _ in range(MAX_HALVINGS):
        cells = reps.join(sides, by).groupBy(*by, _cell("px").alias("gx"), _cell("py").alias("gy")).count()
        crowded = stable(cells.groupBy(*by).agg(F.max("count").alias("_most")).where(F.col("_most") > limit))
        if crowded.isEmpty():
            break
        halve = F.when(F.col("_most").isNotNull(), F.col("side") / 2).otherwise(F.col("side"))
        sides = stable(sides.join(crowded, by, "left").select(*by, "extent", halve.alias("side")))
    return sides


def nearest_neighbours(points: DataFrame, k: int, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Exact k nearest other points of the group by (distance, id): (by..., src, dst, rank, distance).

    Coincident points are represented by their k + 1 lowest ids, since no list can need more of them, and
    the search runs once per distinct place. It starts on a grid fine enough that no cell is crowded; a
    place is final once k + 1 representatives lie within one cell side, the others go on with doubled
    cells. An open place has fewer than k + 1 representatives within the last side, so few places of a
    cell stay open and the work of every round stays linear in the number of points.
    """
    by, want = list(by), k + 1
    spot = [*by, "px", "py"]
    pts = points.select(*spot, "obs_id")
    rank = F.row_number().over(Window.partitionBy(*spot).orderBy("obs_id"))
    reps = stable(pts.withColumn("_r", rank).where(F.col("_r") <= want))
    places = reps.where(F.col("_r") == 1).select(*spot)
    reps = reps.drop("_r")
    sides = _cell_sides(places, reps, want, by)
    nearest = Window.partitionBy(*spot).orderBy("_d", "_dst")
    found, todo, left = None, places, places.count()
    while left:
        cells = {"gx": _cell("px"), "gy": _cell("py")}
        sources = _around(todo.join(sides, by).withColumns(cells))
        targets = reps.join(sides.select(*by, "side"), by).withColumns(cells).select(
            *by, "gx", "gy", F.col("px").alias("_bx"), F.col("py").alias("_by"), F.col("obs_id").alias("_dst")
        )
        whole = F.col("side") >= F.col("extent")
        d = distance(F.col("px"), F.col("py"), F.col("_bx"), F.col("_by"))
        near = (
            sources.join(targets, [*by, "gx", "gy"])
            .withColumn("_d", d)
            .where(whole | (F.col("_d") * F.lit(SLACK) <= F.col("side")))
            .select(*spot, "_dst", "_d", whole.alias("_whole"), F.row_number().over(nearest).alias("_r"))
            .where(F.col("_r") <= want)
            .groupBy(*spot)
            .agg(F.array_sort(F.collect_list(F.struct("_d", "_dst"))).alias("near"), F.max("_whole").alias("_whole"))
        )
        done = stable(near.where(F.col("_whole") | (F.size("near") >= want)).select(*spot, "near"))
        found = done if found is None else found.unionByName(done)
        todo = stable(todo.join(done.select(*spot), spot, "left_anti"))
        left = todo.count()
        sides = sides.withColumn("side", F.col("side") * 2)
    if found is None:
        found = places.withColumn("near", F.lit(None).cast("array<struct<_d:double,_dst:bigint>>"))
    others = F.slice(F.filter("near", lambda e: e["_dst"] != F.col("obs_id")), 1, k)
    listed = pts.join(found, spot).select(*by, F.col("obs_id").alias("src"), F.posexplode(others).alias("_p", "_e"))
    return listed.select(
        *by, "src", F.col("_e._dst").alias("dst"), (F.col("_p") + 1).alias("rank"), F.col("_e._d").alias("distance")
    )


def spatial_graph(points: DataFrame, n_neighbors: int = 10, radius: float | None = None) -> DataFrame:
    """Directed graph on coordinates: k nearest spots, or all within ``radius`` when that is given."""
    if radius is not None:
        return radius_graph(points, radius)
    return nearest_neighbours(points, n_neighbors).select(
        "sample_id", "src", "dst", "distance", F.lit(1.0).alias("weight")
    )


# First-ring steps (row, column) on the hexagonal lattice, where columns advance by two.
RING_STEPS = ((0, -2), (0, 2), (-1, -1), (-1, 1), (1, -1), (1, 1))


def lattice_graph(obs: DataFrame, n_rings: int = 1, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Neighbours on the hexagonal lattice, at most ``n_rings`` steps away through occupied positions."""
    by = list(by)
    spots = obs.select(*by, "obs_id", "array_row", "array_col")
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in RING_STEPS])
    moved = spots.withColumn("_s", F.explode(steps)).select(
        *by,
        F.col("obs_id").alias("src"),
        (F.col("array_row") + F.col("_s.r")).alias("array_row"),
        (F.col("array_col") + F.col("_s.c")).alias("array_col"),
    )
    one = moved.join(spots, [*by, "array_row", "array_col"]).select(*by, "src", F.col("obs_id").alias("dst"))
    one = one.dropDuplicates()
    reached = one.withColumn("ring", F.lit(1))
    edge = one
    for ring in range(2, n_rings + 1):
        step = one.select(*by, F.col("src").alias("dst"), F.col("dst").alias("_next"))
        wider = edge.join(step, [*by, "dst"]).select(*by, "src", F.col("_next").alias("dst"))
        wider = wider.where(F.col("src") != F.col("dst")).distinct()
        edge = stable(wider.join(reached, [*by, "src", "dst"], "left_anti"))
        reached = reached.unionByName(edge.withColumn("ring", F.lit(ring)))
    return reached.withColumn("weight", F.lit(1.0))


def degree_stats(obs: DataFrame, edges: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Mean, population std, min and max of the row sums; isolated spots count as 0."""
    by = list(by)
    degree = edges.groupBy(*by, F.col("src").alias("obs_id")).agg(F.sum("weight").alias("_degree"))
    filled = obs.select(*by, "obs_id").join(degree, [*by, "obs_id"], "left").fillna(0.0, ["_degree"])
    return filled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.avg("_degree").alias("mean_degree"),
        F.stddev_pop("_degree").alias("std_degree"),
        F.min("_degree").alias("min_degree"),
        F.max("_degree").alias("max_degree"),
    )


def vector_neighbours(scores: DataFrame, k: int, column: str = "pcs", block: int = BLOCK) -> DataFrame:
    """Exact k nearest other spots of the sample on score vectors, by (distance, id).

    Blocks of vectors meet pairwise; each task row keeps the k best per source, which are merged at the end.
    """
    packed = pack_blocks(
        scores.select(*SPOT, F.col(column).alias("v")), ["sample_id"], ["obs_id", "v"], block=block, meeting=MEETING
    )

    def best(r) -> pd.DataFrame:
        b, ids = np.vstack(r.bv), np.asarray(r.bid)
        found = [_nearest(np.asarray(r.aid[p]), np.vstack(r.av[p]), ids, b, k) for p in pieces(len(r.aid), len(ids), 1 << 19)]
        src, dst, d = (np.concatenate(c) for c in zip(*found))
        return pd.DataFrame({"sample_id": r.sample_id, "src": src, "dst": dst, "distance": d})

    columns = [F.col(f"{s}.{f}").alias(f"{s}{n}") for s in "ab" for f, n in (("obs_id", "id"), ("v", "v"))]
    schema = "sample_id string, src long, dst long, distance double"
    near = each_pair(block_pairs(packed, ["sample_id"]), ["sample_id"], columns, best, schema)
    order = Window.partitionBy("sample_id", "src").orderBy("distance", "dst")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _nearest(
    aid: np.ndarray, a: np.ndarray, ids: np.ndarray, b: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(src, dst, distance) of the k points of ``b`` nearest to each one of ``a``, by (distance, id), without itself.

    Matrix products tell which few points can be among them, with room for their rounding; only these are measured
    position by position.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    same = aid[:, None] == ids[None, :]
    if np.isfinite(na).all() and np.isfinite(nb).all():
        rough = na[:, None] + nb[None, :] - 2.0 * (a @ b.T)
        rough[same] = np.inf
        slack = 8.0 * (a.shape[1] + 4) * np.finfo(float).eps * (na + nb.max())
        limit = np.partition(rough, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1] + 2.0 * slack
        row, col = np.nonzero((rough <= limit[:, None]) & ~same)
        d = np.zeros(len(row))
        for p in range(a.shape[1]):
            diff = a[row, p] - b[col, p]
            d += diff * diff
        d = np.sqrt(d)
    else:
        d = np.sqrt(_squared_distances(a, b))
        row, col = np.nonzero(np.isfinite(d) & ~same)
        d = d[row, col]
    order = np.lexsort((ids[col], d, row))
    row, col, d = row[order], col[order], d[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return aid[row[kept]], ids[col[kept]], d[kept]


def _squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances summed per position, free of the cancellation of the dot-product form."""
    out = np.zeros((len(a), len(b)))
    for p in range(a.shape[1]):
        diff = np.subtract.outer(a[:, p], b[:, p])
        diff *= diff
        out += diff
    return out


def fuzzy_weights(neighbours: DataFrame, k: int) -> DataFrame:
    """Symmetric fuzzy weights of a kNN list; ``k`` counts the spot itself.

    Distances are shifted by the smallest positive one and scaled so that memberships sum to log2(k);
    both directions are joined as a + b - a * b.
    """
    packed = neighbours.groupBy("sample_id", "src").agg(
        F.array_sort(F.collect_list(F.struct("distance", "dst"))).alias("e")
    )

    @F.pandas_udf("array<double>")
    def memberships(distances: pd.Series) -> pd.Series:
        return pd.Series([_memberships(np.asarray(d, dtype=float), np.log2(k)) for d in distances])

    member = F.explode(F.arrays_zip(F.col("e.dst").alias("dst"), F.col("e.distance").alias("d"), F.col("w").alias("w")))
    directed = packed.withColumn("w", memberships(F.col("e.distance"))).select("sample_id", "src", member.alias("m"))
    directed = directed.select(
        "sample_id", "src", F.col("m.dst").alias("dst"), F.col("m.d").alias("distance"), F.col("m.w").alias("w")
    )
    both = directed.withColumn("v", F.lit(None).cast("double")).unionByName(
        directed.select(
            "sample_id",
            F.col("dst").alias("src"),
            F.col("src").alias("dst"),
            "distance",
            F.lit(None).cast("double").alias("w"),
            F.col("w").alias("v"),
        )
    )
    a, b = F.coalesce(F.max("w"), F.lit(0.0)), F.coalesce(F.max("v"), F.lit(0.0))
    return (
        both.groupBy("sample_id", "src", "dst")
        .agg(F.max("distance").alias("distance"), (a + b - a * b).alias("weight"))
        .where(F.col("weight") > 0)
    )


def _memberships(d: np.ndarray, target: float, steps: int = 64) -> np.ndarray:
    positive = d[d > 0]
    if not len(positive):
        return np.ones_like(d)
    shifted = np.maximum(d - positive.min(), 0.0)
    low, high, sigma = 0.0, np.inf, 1.0
    for _ in range(steps):
        total = np.exp(-shifted / sigma).sum()
        if abs(total - target) < 1e-5:
            break
        if total > target:
            high = sigma
            sigma = (low + high) / 2
        else:
            low = sigma
            sigma = sigma * 2 if np.isinf(high) else (low + high) / 2
    sigma = max(sigma, 1e-3 * d.mean())
    return np.exp(-shifted / sigma)


def expression_graph(scores: DataFrame, n_neighbors: int = 15, column: str = "pcs") -> DataFrame:
    """Fuzzy kNN graph on score vectors; ``n_neighbors`` counts the spot itself."""
    return fuzzy_weights(vector_neighbours(scores, n_neighbors - 1, column), n_neighbors)
