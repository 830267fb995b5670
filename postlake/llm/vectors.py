"""Embedding near-duplicates by collision-counting projections.

Two vectors link at a cosine of ``LEAST`` or more. On unit vectors that is a distance
of at most ``d``, so on a random Gaussian direction near vectors differ by about ``d``
and most others by more.

* Equal vectors are one class, with its number of rows.
* Cells keep the work in proportion to the table: a bundle of grid projections deals
  vectors out into cells, several bundles make up for pairs that one bundle parts.
  Their numbers follow from the number of classes and the recall asked for.
* Within a cell vectors are sorted along a projection, another one in every bundle,
  and each looks at the window of half-width ``WINDOW * d`` centred on it; a pair that
  one bundle's sorting parts is left to the other bundles. A pair's collisions are
  counted, the number of ``WINDOWS`` further projections in whose windows it lies;
  pairs that reach the count which a pair at the threshold reaches with near certainty
  are verified by their exact cosine in double precision. So a link is never wrong,
  and ``RECALL`` of the pairs just at the threshold are found, more of the nearer ones.

Defined results: a vector that is null, empty, zero or has a null or non-finite
component links with nothing and is its own component; vectors of unequal lengths
don't link; a null id counts in links and components but names none, and isn't kept;
rows that repeat an id are each reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch, map_batches, stored
from postlake.llm.components import components

LEAST = 0.95
RECALL = 0.99
# In units of d: the width of a grid cell and the half-width of a window.
CELL, WINDOW = 4.0, 2.0
WINDOWS = 16
# Chance that counting loses a pair at the threshold; every bundle counts alike.
MISS = 1e-3
# Other vectors in a cell that a vector may meet on average.
MET = 8
SEED = 20240601
PLACES = "bundle int, cell long, value double, id long, marks binary"
PAIRS = "a long, b long"


def plan(n: int, least: float = LEAST, recall: float = RECALL) -> tuple[int, int, int]:
    """(grid projections of a bundle, bundles, collisions asked for) for n classes."""
    d = sqrt(2 - 2 * least)
    width = CELL * d
    # Chances that a grid projection keeps a pair in one cell: one at the threshold,
    # and one of unrelated unit vectors, whose projections differ like N(0, 2).
    z = np.linspace(0, width, 2001)

    def together(spread: float) -> float:
        density = 2 * np.exp(-((z / spread) ** 2) / 2) / (spread * sqrt(2 * pi))
        return float(np.trapezoid(density * (1 - z / width), z))

    near, far = together(d), together(sqrt(2))
    hit = erf(WINDOW / sqrt(2))
    miss = min(MISS, (1 - recall) / 10)
    lost, count = 0.0, 0
    while True:
        more = comb(WINDOWS, count) * hit**count * (1 - hit) ** (WINDOWS - count)
        if lost + more > miss:
            break
        lost += more
        count += 1
    grids = max(1, ceil(log(max(2.0, n / MET)) / -log(far)))
    # A bundle finds a pair that its grids keep together and its sort window holds.
    bundles = max(1, ceil(log(1 - recall / (1 - lost)) / log(1 - near**grids * hit)))
    return grids, bundles, count


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, k1, k2), keys null where a vector can't link, and the classes
    (id, k1, k2, first, n, vector)."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    keyed = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.coalesce(usable, F.lit(False)), vector).alias("vector"),
    )
    # 128 bits of hash stand for the vector.
    keyed = keyed.withColumns(
        {
            "k1": F.when(F.col("vector").isNotNull(), F.xxhash64("vector")),
            "k2": F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(SEED), F.col("vector"))),
        }
    )
    found = (
        keyed.filter("vector is not null")
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("vector").alias("vector"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    return keyed.select("vec_id", "k1", "k2"), stored(found, "vector-classes")


def _by_length(vectors: list[list[float]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and unit vectors, length by length."""
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, unit(np.array([vectors[i] for i in at], np.float64))


def places(found: DataFrame, grids: int, bundles: int, least: float = LEAST) -> DataFrame:
    """Each class once per bundle: its cell, sort value and window projections."""
    d = sqrt(2 - 2 * least)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part["id"].to_numpy()
            for at, units in _by_length(part["vector"].to_pylist()):
                length = units.shape[1]
                rng = np.random.default_rng([SEED, length])
                marks = (units @ rng.standard_normal((length, WINDOWS))).astype("<f4")
                for bundle in range(bundles):
                    value = units @ rng.standard_normal(length)
                    offset = rng.random(grids)
                    grid = np.floor(units @ rng.standard_normal((length, grids)) / (CELL * d) + offset)
                    odd = rng.integers(1 << 62, size=grids, dtype=np.int64) * 2 + 1
                    with np.errstate(over="ignore"):
                        cell = (grid.astype(np.int64) * odd).sum(axis=1) + length
                    yield batch(
                        PLACES,
                        pa.array(np.full(len(at), bundle, np.int32)),
                        pa.array(cell),
                        pa.array(value),
                        pa.array(ids[at]),
                        [row.tobytes() for row in marks],
                    )

    return map_batches(found.select("id", "vector"), step, PLACES)


def window_pairs(
    group: np.ndarray, value: np.ndarray, marks: np.ndarray, half: float, count: int, fresh: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, sorted by group and value, in each other's window that collide in
    ``count`` windows or more; the later row is number ``fresh`` or after."""
    at = np.arange(len(value))
    offset = 1
    while True:
        at = at[at + offset < len(value)]
        other = at + offset
        near = (group[at] == group[other]) & (value[other] - value[at] <= half)
        at = at[near]
        if not len(at):
            return
        asked = at[at + offset >= fresh]
        hits = (np.abs(marks[asked] - marks[asked + offset]) <= half).sum(axis=1) >= count
        if hits.any():
            yield asked[hits], asked[hits] + offset
        offset += 1


def candidates(placed: DataFrame, count: int, least: float = LEAST) -> DataFrame:
    """Distinct (a, b) of classes whose collisions reach the count."""
    half = WINDOW * sqrt(2 - 2 * least)
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(tasks, "bundle", "cell").sortWithinPartitions("bundle", "cell", "value", "id")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None
        for part in batches:
            if not part.num_rows:
                continue
            rows = [part[c].to_numpy() for c in ("bundle", "cell", "value", "id")]
            rows.append(
                np.frombuffer(b"".join(part["marks"].to_pylist()), "<f4").reshape(-1, WINDOWS)
            )
            fresh = 0
            if kept:
                fresh = len(kept[0])
                rows = [np.concatenate([k, r]) for k, r in zip(kept, rows, strict=True)]
            bundle, cell, value, ids, marks = rows
            changes = np.concatenate([[False], (np.diff(cell) != 0) | (np.diff(bundle) != 0)])
            for i, j in window_pairs(np.cumsum(changes), value, marks, half, count, fresh):
                yield batch(
                    PAIRS, pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))
                )
            # What the next batch's first rows may still see.
            tail = (cell == cell[-1]) & (bundle == bundle[-1]) & (value >= value[-1] - half)
            kept = tuple(r[tail] for r in rows)

    return map_batches(dealt, step, PAIRS).distinct()


def verified(pairs: DataFrame, found: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose cosine reaches the threshold."""
    left = found.select(F.col("id").alias("a"), F.col("vector").alias("va"))
    right = found.select(F.col("id").alias("b"), F.col("vector").alias("vb"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keep = np.zeros(part.num_rows, bool)
            va, vb = part["va"].to_pylist(), part["vb"].to_pylist()
            lengths = np.array([len(v) if len(v) == len(w) else 0 for v, w in zip(va, vb, strict=True)])
            for length in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == length)
                x, y = (unit(np.array([v[i] for i in at], np.float64)) for v in (va, vb))
                keep[at] = np.einsum("ij,ij->i", x, y) >= least
            mask = pa.array(keep)
            yield batch(PAIRS, part["a"].filter(mask), part["b"].filter(mask))

    return map_batches(pairs.join(left, "a").join(right, "b"), step, PAIRS)


def links(found: DataFrame, least: float = LEAST, recall: float = RECALL) -> DataFrame:
    """(a, b), a < b: classes that link."""
    grids, bundles, count = plan(found.count(), least, recall)
    placed = places(found, grids, bundles, least)
    return verified(candidates(placed, count, least), found, least)


def near_duplicates(vectors: DataFrame, least: float = LEAST, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows, found = classes(vectors)
    linked = stored(links(found, least, recall), "vector-links")
    sizes = found.select("id", "first", "n")
    both = linked.select("a", "b").union(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = (
        both.join(sizes.select(F.col("id").alias("b"), "n"), "b")
        .groupBy(F.col("a").alias("id"))
        .agg(F.sum("n").alias("others"))
    )
    rooted = (
        sizes.join(components(linked).withColumnRenamed("node", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    rooted = stored(rooted, "vector-roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = (
        rooted.join(named, "root")
        .join(degree, "id", "left")
        .select("id", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    of_class = stored(
        of_class.join(found.select("id", "k1", "k2"), "id").select("k1", "k2", "component_id", "n_links"),
        "vector-results",
    )
    single = F.col("k1").isNull()
    component = F.when(single, F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.join(of_class, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
