"""Exact k-nearest-neighbour mean as a partitioned join with triangle-inequality bounds.

Training points belong to a near pivot, and so do queries: the nearest pivot of the nearest
group of pivots, so that finding it takes work with the root of the pivots. A query first looks
among the points of its own pivot, which gives a true bound on its k-th distance, and
then visits only the other pivots whose ball reaches within that bound, group by group, in
blocks of bounded size. Equal points are first reduced to the k that could ever be chosen, and
equal queries to one, so repeated vectors do not add work. Points are numbered by key
once, so ties are settled by a number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.contract import KEYS
from cohortlens.operators.joins import dimension_join, skew_join
from cohortlens.operators.ranking import global_row_number
from cohortlens.session import materialize

# Pivots grow with the square root of the points, between these bounds; the driver holds them
# and sends them to every machine once.
PIVOTS = (32, 1 << 20)
BLOCK_ROWS = 4_096
# Bytes of the distances that a task holds at once.
DISTANCE_BYTES = 64 << 20
SALTS = 64
# Slack for rounding in square roots; it only lets a few more pivots be visited.
SLACK = 1e-9


def _whole(points: np.ndarray) -> bool:
    """Whether all numbers are whole and so small that no sum of their products is rounded."""
    most = np.abs(points).max(initial=0.0)
    return bool(4 * points.shape[1] * most * most < 2**53 and (points == np.rint(points)).all())


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances, exact for whole-number features; those take one matrix product."""
    if _whole(left) and _whole(right):
        total = left @ (-2 * right.T)
        total += np.sum(left * left, axis=1)[:, None]
        total += np.sum(right * right, axis=1)[None, :]
        return total
    total = np.zeros((len(left), len(right)))
    for column in range(left.shape[1]):
        total += (left[:, column, None] - right[None, :, column]) ** 2
    return total


def _points(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["vector"].tolist(), dtype=float).reshape(len(frame), -1)


def _first_rows(df: DataFrame, by: Sequence[str], order_by: Sequence[str], k: int) -> DataFrame:
    """The first k rows per group; a large group is cut down in salted parts first."""
    some = W.partitionBy(*by, "_salt").orderBy(*order_by)
    few = (
        df.withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
        .withColumn("_place", F.row_number().over(some))
        .where(F.col("_place") <= k)
    )
    return (
        few.withColumn("_place", F.row_number().over(W.partitionBy(*by).orderBy(*order_by)))
        .where(F.col("_place") <= k)
        .drop("_salt", "_place")
    )


def _training_points(df: DataFrame, features: Sequence[str], target: str, k: int) -> DataFrame:
    """Per distinct vector, the first k rows by key, numbered; later ones can never be chosen."""
    vector = F.array(*[F.col(name).cast("double") for name in features])
    rows = df.select(*KEYS, vector.alias("vector"), F.col(target).cast("double").alias("y"))
    numbered = global_row_number(rows, list(KEYS), "key").select("vector", "key", "y")
    return _first_rows(numbered, ["vector"], ["key"], k)


def _slices(rows: int, columns: int) -> Iterator[slice]:
    """Cuts of ``rows`` whose distances to ``columns`` others fit in the stated bytes."""
    step = max(1, DISTANCE_BYTES // (8 * max(1, columns)))
    return (slice(low, low + step) for low in range(0, rows, step))


@dataclass(frozen=True)
class Pivots:
    """Pivots in groups around some of them; ``members`` are the pivots of each group."""

    points: np.ndarray
    centers: np.ndarray
    members: list[np.ndarray]

    @classmethod
    def of(cls, points: np.ndarray) -> Pivots:
        centers = points[: int(np.ceil(np.sqrt(len(points))))]
        group = np.zeros(len(points), int)
        for part in _slices(len(points), len(centers)):
            group[part] = _distances(points[part], centers).argmin(axis=1)
        members = [np.flatnonzero(group == number) for number in range(len(centers))]
        held = [number for number, own in enumerate(members) if len(own)]
        return cls(points, centers[held], [members[number] for number in held])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A near pivot of each vector and the distance to it."""
        group = np.zeros(len(vectors), int)
        for part in _slices(len(vectors), len(self.centers)):
            group[part] = _distances(vectors[part], self.centers).argmin(axis=1)
        pivot, radius = np.zeros(len(vectors), "int32"), np.zeros(len(vectors))
        for number, own in enumerate(self.members):
            rows = np.flatnonzero(group == number)
            for part in _slices(len(rows), len(own)):
                far = np.sqrt(_distances(vectors[rows[part]], self.points[own]))
                pivot[rows[part]] = own[far.argmin(axis=1)]
                radius[rows[part]] = far.min(axis=1)
        return pivot, radius

    def within(
        self, vectors: np.ndarray, bound: np.ndarray, reach: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and pivots whose balls (of radius ``reach``) come within the rows' bounds."""
        for center, own in zip(self.centers, self.members):
            # The group's ball holds those of its pivots.
            spread = np.sqrt(_distances(center[None, :], self.points[own]))[0] + reach[own]
            away = np.sqrt(_distances(vectors, center[None, :]))[:, 0]
            rows = np.flatnonzero(away - spread.max() <= bound + SLACK)
            for part in _slices(len(rows), len(own)):
                far = np.sqrt(_distances(vectors[rows[part]], self.points[own]))
                near, place = np.nonzero(far - reach[own][None, :] <= bound[rows[part]][:, None])
                yield rows[part][near], own[place]


def _with_pivots(points: DataFrame, pivots: Broadcast[Pivots]) -> DataFrame:
    """Add a near pivot and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nearest, radius = pivots.value.nearest(_points(batch))
            yield batch.assign(pivot=nearest, radius=radius)

    schema = points.schema.simpleString()[len("struct<"):-1]
    return points.mapInPandas(assign, f"{schema},pivot:int,radius:double")


def _visits(
    queries: DataFrame, pivots: Broadcast[Pivots], reach: Broadcast[np.ndarray]
) -> DataFrame:
    """One row per query and other pivot whose ball reaches within the query's ``bound``.

    ``reach`` is each pivot's largest radius.
    """

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors, own = _points(batch), batch["pivot"].to_numpy()
            bound = batch["bound"].to_numpy(float) * (1 + SLACK) + SLACK
            held = batch["vector"].to_numpy()
            for rows, cells in pivots.value.within(vectors, bound, reach.value):
                other = cells != own[rows]
                yield pd.DataFrame({"vector": held[rows[other]], "pivot": cells[other].astype("int32")})

    return queries.mapInPandas(visit, "vector array<double>, pivot int")


def _with_blocks(df: DataFrame, sizes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add ``_blocks``, how many blocks of about ``BLOCK_ROWS`` the pivot's rows of a side take."""
    counts = sizes.select("pivot", F.ceil(F.col("rows") / F.lit(BLOCK_ROWS)).cast("int").alias("_blocks"))
    return dimension_join(df, counts, ["pivot"], salt_by=on)


def _blocks(df: DataFrame, sizes: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Spread the rows of a pivot evenly over enough blocks."""
    place = F.pmod(F.xxhash64(*on), F.col("_blocks")).cast("int")
    return _with_blocks(df, sizes, on).withColumn(name, place).drop("_blocks")


def _other_blocks(df: DataFrame, sizes: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Copy each row to every block of the other side of its pivot."""
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return _with_blocks(df, sizes, on).withColumn(name, every).drop("_blocks")


def _block_nearest(k: int):
    def nearest(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        """The k nearest points of one block for each query of one block."""
        parts = []
        if len(points):
            points = points.sort_values("key")
            keys, values = points["key"].to_numpy(), points["y"].to_numpy()
            asked, held = _points(queries), _points(points)
            most = min(k, len(points))
            for part in _slices(len(queries), len(points)):
                found = _distances(asked[part], held)
                # All points up to the k-th distance, then by distance and key: ties are whole.
                edge = np.partition(found, most - 1, axis=1)[:, most - 1]
                rows, picked = np.nonzero(found <= edge[:, None])
                order = np.lexsort((picked, found[rows, picked], rows))
                rows, picked = rows[order], picked[order]
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                rows, picked = rows[place < k], picked[place < k]
                parts.append(
                    pd.DataFrame(
                        {
                            "vector": queries["vector"].to_numpy()[part][rows],
                            "distance": found[rows, picked],
                            "key": keys[picked],
                            "y": values[picked],
                        }
                    )
                )
        columns = ["vector", "distance", "key", "y"]
        return pd.concat(parts) if parts else pd.DataFrame({name: [] for name in columns})

    return nearest


def _search(visits: DataFrame, placed: DataFrame, point_sizes: DataFrame, k: int) -> DataFrame:
    """The k nearest points per query and block of the pivots that it visits."""
    visit_sizes = materialize(visits.groupBy("pivot").agg(F.count(F.lit(1)).alias("rows")))
    left = _other_blocks(
        _blocks(visits, visit_sizes, ["vector"], "query_block"), point_sizes, ["vector"], "point_block"
    )
    points = placed.drop("radius")
    right = _other_blocks(
        _blocks(points, point_sizes, ["key"], "point_block"), visit_sizes, ["key"], "query_block"
    )
    block = ["pivot", "query_block", "point_block"]
    return (
        left.groupBy(*block)
        .cogroup(right.groupBy(*block))
        .applyInPandas(_block_nearest(k), "vector array<double>, distance double, key long, y double")
    )


def nearest_mean(
    training: DataFrame, queries: DataFrame, features: Sequence[str], target: str, k: int = 5
) -> DataFrame:
    """Query keys, their target and the mean target of the k nearest training rows.

    Equal distances go by key. Features must not be null.
    """
    vector = F.array(*[F.col(name).cast("double") for name in features])
    points = materialize(_training_points(training, features, target, k))
    asked = queries.select(*KEYS, F.col(target).alias("actual"), vector.alias("vector"))
    distinct = materialize(asked.select("vector").distinct())

    # Pivots are spread by hash over the distinct vectors; the driver holds them all.
    wanted = int(np.clip(np.sqrt(points.count()), *PIVOTS))
    sample = points.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(wanted)
    chosen = np.array([row["vector"] for row in sample.collect()], dtype=float)
    context = training.sparkSession.sparkContext
    pivots = context.broadcast(Pivots.of(chosen.reshape(len(chosen), len(features))))
    placed = materialize(_with_pivots(points, pivots))
    point_sizes = materialize(
        placed.groupBy("pivot").agg(
            F.max("radius").alias("reach"), F.count(F.lit(1)).alias("rows")
        )
    )
    # A pivot without points reaches nothing.
    far = np.full(len(chosen), -np.inf)
    for fact in point_sizes.collect():
        far[fact["pivot"]] = fact["reach"]
    reach = context.broadcast(far)

    at_home = materialize(_with_pivots(distinct, pivots).drop("radius"))
    first = materialize(
        _first_rows(_search(at_home, placed, point_sizes, k), ["vector"], ["distance", "key"], k)
    )
    found = first.groupBy("vector").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_d"))
    # Fewer than k points at home bound nothing.
    bound = F.when(F.col("_n") >= k, F.sqrt("_d")).otherwise(F.lit(float("inf")))
    bounded = at_home.join(found, "vector", "left").select("vector", "pivot", bound.alias("bound"))
    visits = materialize(_visits(bounded, pivots, reach))
    partial = first.unionByName(_search(visits, placed, point_sizes, k))
    answers = (
        _first_rows(partial, ["vector"], ["distance", "key"], k)
        .groupBy("vector")
        .agg(F.avg("y").alias("predicted"))
    )
    return skew_join(asked, answers, ["vector"]).select(*KEYS, "actual", "predicted")
