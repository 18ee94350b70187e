"""Oversampling of the smaller classes by interpolation between near neighbours."""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from plyscope.functions.numbers import hash_fraction
from plyscope.operators.indices import block_distances
from plyscope.operators.ranking import md5_row_number
from plyscope.schema import SEED
from plyscope.session import cut_lineage, scratch_path

TILE_ROWS = 2048
PIVOTS = 6
#: Rows of a class up to which pairs of tiles are joined; beyond, a task reads the tiles it needs from the shared folder.
PAIRED_ROWS = 1 << 14
#: Queries that pass through the tiles together, and tiles whose bounds are worked out at once.
GROUP_ROWS = 1 << 14
BATCH_TILES = 64
#: Cells around a query's own that are looked at first.
FIRST_CELLS = 8


def tile_count(rows: int, tile_rows: int = TILE_ROWS) -> int:
    """Tiles of a class; larger classes have larger tiles, so that their number grows with the root of the rows."""
    return max(1, math.ceil(rows / max(tile_rows, 2 * math.isqrt(rows))))


def nearest_in_class(
    queries: DataFrame,
    rows: DataFrame,
    columns: list[str],
    label: str,
    key: str,
    class_sizes: dict,
    k: int = 5,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Exact k nearest rows of the same class: ``key``, ``neighbours`` (keys, nearest first).

    Rows lie in tiles around pivots, a hash sample of their class; what exceeds a tile's size is dealt to further
    tiles by hash. A tile has a bounding ball. The queries of a tile first meet the tiles of their own pivot, which
    bounds the distance of their k-th neighbour; after that they meet only tiles whose balls reach into that bound, and
    within such a pair only the queries that the ball can concern. A pair of tiles is a bounded numpy block that
    returns up to k candidates per query row within its bound, and the best k of those are the answer. Ties go to the smaller key.

    The tiles' pairs grow with the rows, and each would carry both of its tiles. So in classes of more than
    ``PAIRED_ROWS`` rows no pairs are made: see ``searched_tiles``.
    """
    tiles = {c: tile_count(n, tile_rows) for c, n in class_sizes.items()}
    left, right, pivots = _placed(queries, rows, columns, label, key, class_sizes, tiles)
    if max(tiles.values(), default=1) > 1 and max(class_sizes.values()) > PAIRED_ROWS:
        return searched_tiles(left, right, pivots, columns, k)
    own = left.join(right, ["_class", "_cell"])
    if max(tiles.values(), default=1) == 1:
        return _best(_candidates(own, columns, k), k)
    left, right = cut_lineage(left), cut_lineage(right)
    near = _candidates(left.join(right, ["_class", "_cell"]), columns, k)
    return _best(_candidates(tile_pairs(left, right, near, columns, k), columns, k), k)


def placed_tiles(queries, rows, columns, label, key, class_sizes: dict, tiles: dict) -> tuple[DataFrame, DataFrame]:
    """Query tiles and row tiles (class, cell, tile, keys, points), cells being those of the nearest pivot."""
    return _placed(queries, rows, columns, label, key, class_sizes, tiles)[:2]


def _placed(queries, rows, columns, label, key, class_sizes: dict, tiles: dict) -> tuple[DataFrame, DataFrame, dict]:
    """``placed_tiles`` and the pivots of each class, in the order of their cells."""
    point = F.array(*[F.col(c).cast("double") for c in columns])
    spread = hash_fraction("pivot", F.col(key))
    share = F.element_at(F.create_map(*[F.lit(x) for c, n in class_sizes.items() for x in (c, float(PIVOTS * tiles[c]) / n)]), F.col(label))
    pivots: dict = {}
    if max(tiles.values(), default=1) > 1:
        # a few pivots for each tile, so that a ball holds what lies together; their number is of the order of the root
        some = rows.where(F.col(label).isin([c for c, t in tiles.items() if t > 1]) & (spread < share))
        for r in some.select(F.col(label).alias("c"), point.alias("p")).distinct().collect():
            pivots.setdefault(r["c"], []).append(r["p"])
    pivots = {c: np.array(sorted(p)) for c, p in pivots.items()}
    width = len(columns)

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["point"].tolist(), dtype=float).reshape(len(frame), width)
            cell = np.zeros(len(frame), dtype=np.int64)
            for c, centers in pivots.items():
                at = np.flatnonzero((frame["_class"] == c).to_numpy())
                for begin in range(0, len(at), 1024):
                    part = at[begin : begin + 1024]
                    cell[part] = block_distances(x[part], centers).argmin(axis=1)
            yield frame.assign(_cell=cell)

    kind = rows.schema[label].dataType.simpleString()

    def placed(df: DataFrame) -> DataFrame:
        flat = df.select(F.col(label).alias("_class"), F.col(key).cast("string").alias("key"), point.alias("point"))
        if not pivots:
            return flat.withColumn("_cell", F.lit(0).cast("long"))
        return flat.mapInPandas(cells, f"_class {kind}, key string, point array<double>, _cell long")

    def packed(df: DataFrame, prefix: str) -> DataFrame:
        placed_rows = cut_lineage(placed(df))
        sizes = placed_rows.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("_n"))
        limit = F.element_at(
            F.create_map(*[F.lit(x) for c, n in class_sizes.items() for x in (c, math.ceil(n / tiles[c]))]), F.col("_class")
        )
        part = F.pmod(F.xxhash64("key"), F.ceil(F.col("_n") / limit)).cast("int")
        return (
            placed_rows.join(sizes, ["_class", "_cell"])
            .withColumn("_part", part)
            .groupBy("_class", "_cell", "_part")
            .agg(F.collect_list(F.struct("key", "point")).alias("r"))
            .select("_class", "_cell", F.col("_part").alias(f"{prefix}part"), F.col("r.key").alias(f"{prefix}key"), F.flatten("r.point").alias(f"{prefix}points"))
        )

    return packed(queries, "q_"), packed(rows, "r_"), pivots


def nearest_rows(a: np.ndarray, b: np.ndarray, k: int, bounds: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` and distances of the k rows of ``b`` nearest each row of ``a`` (and within its bound), nearest first.

    One matrix product gives squared distances but for rounding, whose size is bounded; only the pairs that may be among
    the answer are measured coordinate by coordinate. Ties go to the row that stands first.
    """
    width = a.shape[1]
    center = b.mean(axis=0)
    p, q = a - center, b - center
    with np.errstate(invalid="ignore", over="ignore"):
        pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
        # squared distances less pp
        rough = np.column_stack([-2.0 * p, np.ones(len(p))]) @ np.column_stack([q, qq]).T
    if not (np.isfinite(rough).all() and np.isfinite(pp).all()):
        gaps = block_distances(a, b)
        j = np.argsort(gaps, axis=1, kind="stable")[:, :k]
        i, j = np.repeat(np.arange(len(a)), j.shape[1]), j.ravel()
        distance = gaps[i, j]
    else:
        slack = 8 * (width + 8) * np.finfo(float).eps * (pp + qq.max(initial=0.0))
        limit = np.full(len(a), np.inf) if bounds is None else bounds**2 * (1 + 1e-12) - pp + slack
        near = rough <= limit[:, None]
        many = np.flatnonzero(np.count_nonzero(near, axis=1) > 4 * k)
        if len(many):
            some = rough[many]
            limit[many] = np.minimum(limit[many], np.partition(some, k - 1, axis=1)[:, k - 1] + 2 * slack[many])
            near[many] = some <= limit[many][:, None]
        i, j = np.nonzero(near)
        squares = np.zeros(len(i))
        for c in range(width):
            squares += (a[i, c] - b[j, c]) ** 2
        distance = np.sqrt(squares)
        order = np.lexsort((j, distance, i))
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        order = order[rank < k]
        i, j, distance = i[order], j[order], distance[order]
    keep = slice(None) if bounds is None else ~(distance > bounds[i])
    return i[keep], j[keep], distance[keep]


def _candidates(pairs: DataFrame, columns: list[str], k: int) -> DataFrame:
    """(key, neighbour, distance): the k best of every pair of tiles for each of its queries."""
    width = len(columns)
    bounded = "q_bounds" in pairs.columns

    def candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                a = np.asarray(row.q_points, dtype=float).reshape(-1, width)
                b = np.asarray(row.r_points, dtype=float).reshape(-1, width)
                ids, names, bounds = np.asarray(row.r_key), np.asarray(row.q_key), None
                if bounded:
                    bounds = np.asarray(row.q_bounds, dtype=float)
                    center = b.mean(axis=0)
                    radius = np.sqrt(((b - center) ** 2).sum(axis=1)).max()
                    reach = np.sqrt(((a - center) ** 2).sum(axis=1)) - radius
                    some = reach <= bounds * (1 + 1e-9) + 1e-9
                    a, names, bounds = a[some], names[some], bounds[some]
                    if not len(a):
                        continue
                by_id = np.argsort(ids, kind="stable")
                i, j, distance = nearest_rows(a, b[by_id], k + 1, bounds)
                yield pd.DataFrame({"key": names[i], "neighbour": ids[by_id][j], "distance": distance})

    return pairs.mapInPandas(candidates, "key string, neighbour string, distance double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy("distance", "neighbour")
    return found.where(F.col("key") != F.col("neighbour")).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)


def _best(found: DataFrame, k: int) -> DataFrame:
    return (
        _ranked(found, k)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("_r", "neighbour"))).alias("n"))
        .select("key", F.col("n.neighbour").alias("neighbours"))
    )


def tile_pairs(left: DataFrame, right: DataFrame, near: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The pairs of tiles that can hold a k-th neighbour, with the bound of each query in ``q_bounds``.

    The balls of the row tiles, whose number grows with the root of the rows, are known to every task.
    """
    width = len(columns)
    numbered = right.withColumn("_tile", F.concat_ws("|", "_cell", "r_part"))
    balls: dict = {}

    def ball(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                x = np.asarray(row.r_points, dtype=float).reshape(-1, width)
                center = x.mean(axis=0)
                yield pd.DataFrame({"c": [row.c], "t": [row.t], "center": [center], "radius": [np.sqrt(((x - center) ** 2).sum(axis=1)).max()]})

    kind = right.schema["_class"].dataType.simpleString()
    known = numbered.select(F.col("_class").alias("c"), F.col("_tile").alias("t"), "r_points")
    for r in known.mapInPandas(ball, f"c {kind}, t string, center array<double>, radius double").collect():
        balls.setdefault(r["c"], []).append((r["t"], r["center"], r["radius"]))
    # a query with fewer than k neighbours so far has no bound
    bound = F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound")
    bounds = _ranked(near, k).groupBy("key").agg(bound)
    names = left.select("_class", "_cell", "q_part", F.posexplode("q_key").alias("at", "key")).join(bounds, "key", "left")
    told = names.groupBy("_class", "_cell", "q_part").agg(
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("bound", F.lit(float("inf"))).alias("b")))).alias("q_bounds")
    )
    asked = left.join(told.withColumn("q_bounds", F.col("q_bounds.b")), ["_class", "_cell", "q_part"])

    def reach(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lists = []
            for row in frame.itertuples(index=False):
                x = np.asarray(row.q_points, dtype=float).reshape(-1, width)
                there = balls.get(row.c, [])
                centers, radii = np.array([b[1] for b in there]), np.array([b[2] for b in there])
                touched = np.zeros(len(there), dtype=bool)
                for q, limit in zip(x, row.q_bounds, strict=True):
                    touched |= np.sqrt(((centers - q) ** 2).sum(axis=1)) - radii <= limit * (1 + 1e-9) + 1e-9
                lists.append([there[i][0] for i in np.flatnonzero(touched)])
            yield frame.assign(tiles=lists)

    fields = f"c {kind}, q_key array<string>, q_points array<double>, q_bounds array<double>"
    reached = asked.select(F.col("_class").alias("c"), "q_key", "q_points", "q_bounds").mapInPandas(reach, f"{fields}, tiles array<string>")
    pairs = reached.withColumn("_tile", F.explode("tiles")).withColumnRenamed("c", "_class").drop("tiles")
    return pairs.join(numbered.select("_class", "_tile", "r_key", "r_points"), ["_class", "_tile"])


def _grouped_cells(centers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Numbers of groups of neighbouring cells, of up to ``GROUP_ROWS`` rows or one cell each."""
    group, open_, number = np.zeros(len(rows), dtype=np.int64), [np.arange(len(rows))], 0
    while open_:
        some = open_.pop()
        if len(some) > 1 and rows[some].sum() > GROUP_ROWS:
            axis = np.nan_to_num(centers[some]).var(axis=0).argmax()
            some = some[np.argsort(centers[some, axis], kind="stable")]
            open_ += [some[len(some) // 2 :], some[: len(some) // 2]]
        else:
            group[some], number = number, number + 1
    return group


def searched_tiles(left: DataFrame, right: DataFrame, pivots: dict, columns: list[str], k: int) -> DataFrame:
    """``key``, ``neighbours``: queries of neighbouring cells pass through the row tiles together.

    The row tiles lie in the shared folder, a file each. A group of queries first reads the tiles of its own and of the
    nearest cells, then one tile after the other that can hold a nearer row than the k found so far. A tile cannot where
    its ball is out of reach, nor where the plane between the pivots of its cell and the query's is. So what is moved and
    written grows with the rows alone. The balls, whose number grows with the root of the rows, are known to every task.
    """
    spark, width = left.sparkSession, len(columns)
    folder = scratch_path(spark, "tiles")
    kind = right.schema["_class"].dataType.simpleString()

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = _store(folder)
        store.create_dir(place)
        for frame in frames:
            for row in frame.itertuples(index=False):
                x = np.asarray(row.r_points, dtype=float).reshape(-1, width)
                ids = np.asarray(row.r_key, dtype=object)
                order = np.argsort(ids, kind="stable")
                center, name = x.mean(axis=0), uuid.uuid4().hex
                radius = np.sqrt(((x - center) ** 2).sum(axis=1)).max()
                with store.open_output_stream(f"{place}/{name}") as out:
                    out.write(pickle.dumps((ids[order].tolist(), x[order].tobytes())))
                yield pd.DataFrame({"c": [row.c], "cell": [row.cell], "file": [name], "center": [center], "radius": [radius], "n": [len(x)]})

    tiles = right.select(F.col("_class").alias("c"), F.col("_cell").alias("cell"), "r_key", "r_points")
    balls: dict = {}
    # a row for each tile; only files that a finished task names are read
    for r in tiles.mapInPandas(keep, f"c {kind}, cell long, file string, center array<double>, radius double, n long").collect():
        balls.setdefault(r["c"], []).append(r)
    known, groups = {}, {}
    for c, found in balls.items():
        found.sort(key=lambda r: (r["cell"], r["file"]))
        cells = np.array([r["cell"] for r in found])
        centers, rows = np.array([r["center"] for r in found]), np.array([r["n"] for r in found])
        known[c] = ([r["file"] for r in found], cells, centers, np.array([r["radius"] for r in found]), pivots.get(c))
        own, first = np.unique(cells, return_index=True)
        sums = np.add.reduceat(rows, first)
        groups[c] = {int(cell): (int(g), bool(n > GROUP_ROWS)) for cell, g, n in zip(own, _grouped_cells(centers[first], sums), sums, strict=True)}
    shared = spark.sparkContext.broadcast((known, groups))

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = []
            for c, cell, part in zip(frame["c"], frame["cell"], frame["part"], strict=True):
                g, alone = shared.value[1].get(c, {}).get(cell, (0, False))
                names.append(f"{g}|{part}" if alone else str(g))
            yield frame.assign(g=names)

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        store, place = _store(folder)
        names = np.concatenate([np.asarray(v, dtype=object) for v in frame["q_key"]])
        a = np.concatenate([np.asarray(v, dtype=float) for v in frame["q_points"]]).reshape(-1, width)
        cell = np.repeat(frame["cell"].to_numpy(), [len(v) for v in frame["q_key"]])
        best = _Nearest(names, k)
        if frame["c"].iloc[0] in shared.value[0]:
            files, cells, centers, radii, around = shared.value[0][frame["c"].iloc[0]]

            def meet(tile: int, some: np.ndarray) -> None:
                with store.open_input_stream(f"{place}/{files[tile]}") as stream:
                    ids, data = pickle.loads(stream.read())
                i, j, distance = nearest_rows(a[some], np.frombuffer(data).reshape(-1, width), k + 1, best.bounds[some])
                best.add(some[i], distance, np.asarray(ids, dtype=object)[j])

            _pass_through(a, cell, cells, centers, radii, around, best, meet)
        return best.frame()

    asked = left.select(F.col("_class").alias("c"), F.col("_cell").alias("cell"), F.col("q_part").alias("part"), "q_key", "q_points")
    placed = asked.mapInPandas(dealt, f"c {kind}, cell long, part long, q_key array<string>, q_points array<double>, g string")
    several = placed.repartition(max(1, min(1024, sum(len(set(v.values())) for v in groups.values()))), "c", "g").groupBy("c", "g")
    found = several.applyInPandas(search, "key string, found array<struct<distance double, neighbour string>>")
    # rows of one key share their answer
    merged = found.groupBy("key").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("n"))
    return merged.select("key", F.col("n.neighbour").alias("neighbours"))


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class _Nearest:
    """The k nearest rows found so far of every query, nearest first, ties by key."""

    def __init__(self, names: np.ndarray, k: int):
        self.names, self.k = names, k
        self.distance = np.full((len(names), k), np.inf)
        self.key = np.full((len(names), k), None, dtype=object)
        self.count = np.zeros(len(names), dtype=np.int64)

    @property
    def bounds(self) -> np.ndarray:
        """A query with fewer than k neighbours so far has no bound."""
        return np.where(self.count >= self.k, self.distance[:, -1], np.inf)

    def add(self, i: np.ndarray, distance: np.ndarray, key: np.ndarray) -> None:
        """Candidates of one tile: places of queries, in order, at most k + 1 for each."""
        other = np.fromiter((a != b for a, b in zip(self.names[i], key, strict=True)), bool, len(i))
        i, distance, key = i[other], distance[other], key[other]
        if not len(i):
            return
        rows, row, n = np.unique(i, return_inverse=True, return_counts=True)
        at = self.k + np.arange(len(i)) - (np.cumsum(n) - n)[row]
        gaps, keys = np.full((len(rows), 2 * self.k + 1), np.inf), np.full((len(rows), 2 * self.k + 1), None, dtype=object)
        gaps[:, : self.k], keys[:, : self.k] = self.distance[rows], self.key[rows]
        gaps[row, at], keys[row, at] = distance, key
        # places that hold nothing come last, after distances that are no finite numbers
        empty = np.arange(gaps.shape[1]) >= np.where(np.arange(gaps.shape[1]) < self.k, self.count[rows][:, None], self.k + n[:, None])
        order = np.lexsort((gaps, empty), axis=1)
        gaps, keys = np.take_along_axis(gaps, order, 1), np.take_along_axis(keys, order, 1)
        count = self.count[rows] + n
        width = np.minimum(count, self.k + 1)
        tied = (gaps[:, 1 : self.k + 1] == gaps[:, : self.k]) & (np.arange(1, self.k + 1) < width[:, None])
        for r in np.flatnonzero(tied.any(axis=1)):
            some = sorted(range(count[r]), key=lambda x, r=r: (gaps[r, x], keys[r, x]) if gaps[r, x] == gaps[r, x] else (np.inf, keys[r, x]))
            gaps[r, : count[r]], keys[r, : count[r]] = gaps[r, some], keys[r, some]
        self.distance[rows], self.key[rows], self.count[rows] = gaps[:, : self.k], keys[:, : self.k], np.minimum(count, self.k)

    def frame(self) -> pd.DataFrame:
        some = np.flatnonzero(self.count)
        lists = [[{"distance": d, "neighbour": x} for d, x in zip(self.distance[r, :n], self.key[r, :n], strict=True)] for r, n in zip(some, self.count[some], strict=True)]
        return pd.DataFrame({"key": self.names[some], "found": pd.Series(lists, dtype=object)})


def _pass_through(a: np.ndarray, cell: np.ndarray, cells: np.ndarray, centers: np.ndarray, radii: np.ndarray, pivots, best: _Nearest, meet) -> None:
    """``meet(tile, queries)`` for every tile, near ones first, and the queries that can have a neighbour in it."""
    own, which = np.unique(cell, return_inverse=True)
    met = np.zeros((len(own), len(cells)), dtype=bool)
    members = np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which))[:-1])
    for r, mine in enumerate(members):
        middle = a[mine].mean(axis=0)
        order = np.argsort(((centers - middle) ** 2).sum(axis=1), kind="stable")
        near = np.concatenate([np.flatnonzero(cells == own[r]), order[:FIRST_CELLS]])
        for tile in dict.fromkeys(near.tolist()):
            bounds = best.bounds[mine]
            reach = np.sqrt(((a[mine] - centers[tile]) ** 2).sum(axis=1)) - radii[tile]
            some = mine[reach <= bounds * (1 + 1e-9) + 1e-9]
            met[r, tile] = True
            if len(some):
                meet(tile, some)
    middle = a.mean(axis=0)
    b = a - middle
    squares = (b * b).sum(axis=1)

    def gaps(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of all queries to some points, and how far rounding may have moved them."""
        q = points - middle
        sums = squares[:, None] + (q * q).sum(axis=1)[None, :]
        return sums - 2.0 * (b @ q.T), sums * (1e-14 * (width + 8))

    width = a.shape[1]
    order = np.argsort(((centers - middle) ** 2).sum(axis=1), kind="stable")
    home = pivots[own] if pivots is not None else None
    if home is not None:
        mine = ((a - home[which]) ** 2).sum(axis=1)
    for begin in range(0, len(order), BATCH_TILES):
        some = order[begin : begin + BATCH_TILES]
        limit = best.bounds * (1 + 1e-9) + 1e-9
        square, slack = gaps(centers[some])
        # not "beyond", so that what is no number is met
        beyond = np.sqrt(np.maximum(square - slack, 0.0)) - radii[some] > limit[:, None]
        if home is not None:
            there = pivots[cells[some]]
            apart = np.sqrt(((home[:, None] - there[None]) ** 2).sum(axis=2))[which]
            square, slack = gaps(there)
            with np.errstate(divide="ignore", invalid="ignore"):
                beyond |= (square - slack - mine[:, None] * (1 + 1e-12)) / (2.0 * apart) > limit[:, None]
        open_ = ~(beyond | met[which][:, some])
        for at in np.flatnonzero(open_.any(axis=0)):
            meet(some[at], np.flatnonzero(open_[:, at]))


def oversample(
    df: DataFrame,
    columns: list[str],
    label: str = "label",
    key: str = "player",
    k: int = 5,
    seed: int = SEED,
) -> DataFrame:
    """All rows plus synthetic ones until every class has the size of the largest.

    Row r of a class (in md5 order) is drawn need // n times, the first need % n rows once
    more. A draw picks one of the k nearest rows and a point between, both from hashes of
    the key, so a rerun gives the same rows. A class of n ≤ k rows has n − 1 neighbours a row,
    and the only row of a class is repeated. Output: key (string), label, columns, synthetic.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    largest = max(sizes.values(), default=0)
    plain = df.select(
        F.col(key).cast("string").alias(key), label, *columns, F.lit(False).alias("synthetic")
    )
    short = {c: n for c, n in sizes.items() if n < largest}
    if not short:
        return plain
    smaller = df.where(F.col(label).isin(list(short)))
    need = F.lit(largest) - F.col("_n")
    ranked = md5_row_number(smaller, [label], [seed, F.col(key)], "_rank", "_n", [F.col(key)])
    drawn = ranked.withColumn(
        "_draws", (F.floor(need / F.col("_n")) + (F.col("_rank") <= need % F.col("_n")).cast("long")).cast("int")
    ).where(F.col("_draws") > 0)
    base = drawn.select(
        F.col(key).cast("string").alias("key"), label, *columns, F.explode(F.sequence(F.lit(1), "_draws")).alias("_draw")
    )
    neighbours = nearest_in_class(drawn, smaller, columns, label, key, short, k)
    found = F.col("neighbours")
    pick = (F.floor(hash_fraction(seed, "n", F.col("key"), F.col("_draw")) * F.size(found)) + 1).cast("int")
    nearest = F.when(found.isNull(), F.col("key")).otherwise(F.element_at(found, pick))
    chosen = base.join(neighbours, "key", "left").withColumn("neighbour", nearest)
    other = smaller.select(F.col(key).cast("string").alias("neighbour"), *[F.col(c).alias(f"_o_{c}") for c in columns])
    share = hash_fraction(seed, "u", F.col("key"), F.col("_draw"))
    synthetic = (
        chosen.join(other, "neighbour")
        .withColumn("_u", share)
        .select(
            F.concat_ws("#", "key", "_draw").alias(key),
            label,
            *[(F.col(c) + F.col("_u") * (F.col(f"_o_{c}") - F.col(c))).alias(c) for c in columns],
            F.lit(True).alias("synthetic"),
        )
    )
    return plain.unionByName(synthetic)
