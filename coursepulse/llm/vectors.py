"""Near-duplicate embeddings by cosine: a PCA-ordered, tiled comparison.

Unit vectors are turned into the axes of their second moments, the strongest first. Two vectors of cosine c lie
sqrt(2 - 2c) apart, so in each axis at most that far: vectors are dealt to cells of that width in the leading axes, and
only neighbouring cells meet. A cell that holds more than a tile is cut along further axes, up to ``DEEPEST``; what is still too
large is cut into tiles of bounded size. Each tile knows the box of its vectors in the first ``BOX`` axes and the range of the
norms of what follows; pairs of tiles whose boxes lie too far apart are dropped before any vector is joined. A pair of tiles is
compared by accumulating products over the leading axes first; after each stretch of axes the products that are still
missing are bounded by the norms of the suffixes, and pairs that cannot reach the threshold are dropped. What is left after
the last stretch is computed from the given vectors in double precision, and that value alone decides.

What is shuffled for vectors without leading axes, where no box rules out another, grows with the square of their number
divided by the size of a tile, so tiles are as large as ``TILE_BYTES`` allows.

Hot groups: equal vectors are one representative with a weight. A tile pair returns link counts per vector and a
star for each linked group, so its output is bounded by its vectors, however many links there are.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of each
length are compared among themselves, with axes of their own; every row is a vector and gives a row; rows without an id come after all
others, so their component has an id if any of it has, and else null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .links import components
from .shared import each_row, ship, stage

STRETCHES = (8, 24)  # leading axes after which the bound is applied
DEEPEST = 6  # axes along which cells are cut at most
BOX = 16  # axes of a tile's box
TILE_BYTES = 2 << 20  # vectors of a tile, as given
SUM_BYTES = 1 << 20  # moments that travel in one row
SUM_TASKS = 256  # tasks that add up the moments of one such row before they meet


def links(rows: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector: str = "embedding",
          tile: int | None = None, axes: int = 2) -> DataFrame:
    """One row per vector: id, n_links, component_id. ``tile``: vectors of a tile, by default as many as ``TILE_BYTES`` hold;
    ``axes``: leading axes that make the cells."""
    ship(rows.sparkSession)
    numbered = each_row(rows, id_col, F.col(f"`{vector}`").cast("array<double>"), "v")
    given = stage(numbered.rows.withColumn("sound", _sound(F.col("v"))), "vectors")
    # Equal vectors are one class; its smallest id stands for it.
    every = stage(given.filter("sound").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "classes")
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    single = rows.schema[vector].dataType.elementType.typeName() == "float"
    kind = np.float32 if single else np.float64  # as given, so that nothing is rounded
    # A table holds vectors of a few models, so of a few lengths.
    found: DataFrame | None = None
    for n in sorted(r["n"] for r in every.select(F.size("v").alias("n")).distinct().collect()):
        classes = every.filter(F.size("v") == n)
        basis, leading = _axes(classes, n), min(axes, n)
        size = tile or max(256, TILE_BYTES // (n * np.dtype(kind).itemsize))
        tiles = stage(_tiles(classes, basis, width, leading, size, kind), "tiles")
        pairs = stage(_compare(tiles, basis, threshold, width, leading, kind), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return numbered.named(given.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")), "id", "component_id")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = components(found.filter("b IS NOT NULL").select("a", "b"))
    per_class = (
        every.select(F.col("id").alias("rep"), "v", "weight").join(counts, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("v", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    sound = given.filter("sound").join(per_class, "v", "left")
    linked = sound.unionByName(given.filter("NOT sound"), allowMissingColumns=True).select(
        "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return numbered.named(linked, "id", "component_id")


def _sound(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _axes(classes: DataFrame, n: int) -> np.ndarray:
    """Eigenvectors of the second moments of the unit vectors, the strongest first. The driver gets n * n numbers, packed."""
    step = max(1, SUM_BYTES // (8 * n))
    columns = "i int, part int, m binary"

    def packed(sums: dict[int, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
        for i, m in sums.items():
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "part": pa.array([part], pa.int32()), "m": pa.array([m.tobytes()])})

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            if len(batch):
                u = _unit(np.array(batch["v"].flatten()).reshape(-1, n))
                total += u.T @ u
        yield from packed({i: total[i:i + step] for i in range(0, n, step)}, TaskContext.get().partitionId() % SUM_TASKS)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, m in zip(batch["i"].to_pylist(), batch["m"].to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(m)
        yield from packed(sums, 0)

    sums = classes.select("v").mapInArrow(moments, columns).repartition("i", "part").mapInArrow(added, columns)
    rows = sums.repartition("i").mapInArrow(added, columns).orderBy("i").collect()
    _, vectors = np.linalg.eigh(np.concatenate([np.frombuffer(r["m"]) for r in rows]).reshape(n, n))
    return vectors[:, ::-1].copy()


def _tiles(classes: DataFrame, basis: np.ndarray, width: float, axes: int, tile: int, kind: type) -> DataFrame:
    """cell, number, ids, weights, vectors, low, high: bounded tiles of each cell, packed, with their boxes.

    A vector's cell is its shortest one, from ``axes`` axes on, that holds no more than a tile, or the one of ``DEEPEST`` axes; so no
    cell is a part of another.
    """
    deepest = min(max(axes, DEEPEST), len(basis))

    @F.pandas_udf("array<int>")
    def path(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            turned = _unit(np.stack(batch.to_numpy())) @ basis[:, :deepest] if len(batch) else np.zeros((0, deepest))
            yield pd.Series(list(np.floor(turned / width).astype(np.int32)), dtype=object)

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows["v"].to_numpy())
        turned = _unit(vectors) @ basis
        box = np.column_stack([turned[:, :BOX], np.sqrt((turned[:, BOX:] ** 2).sum(axis=1))])
        return pd.DataFrame({
            "cell": [list(key[0])], "number": [key[1]], "ids": [rows["id"].to_numpy(np.int64).tobytes()],
            "weights": [rows["weight"].to_numpy(np.int64).tobytes()], "vectors": [vectors.astype(kind).tobytes()],
            "low": [box.min(axis=0)], "high": [box.max(axis=0)]})

    placed = stage(classes.withColumn("path", path("v")), "cells")
    cells = (
        placed.groupBy("path").agg(F.count("*").alias("n"))
        .select("path", "n", F.explode(F.sequence(F.lit(axes), F.lit(deepest))).alias("depth"))
        .withColumn("cell", F.slice("path", 1, F.col("depth")))
    )
    sizes = cells.groupBy("cell").agg(F.ceil(F.sum("n") / tile).cast("int").alias("parts"))
    own = (
        cells.join(sizes, "cell").filter((F.col("parts") == 1) | (F.col("depth") == deepest))
        .groupBy("path").agg(F.min_by(F.struct("cell", "parts"), "depth").alias("own")).select("path", "own.*")
    )
    dealt = placed.join(own, "path").withColumn("number", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return dealt.groupBy("cell", "number").applyInPandas(
        packed, "cell array<int>, number int, ids binary, weights binary, vectors binary, low array<double>, high array<double>")


def _neighbours(cell: Column) -> Column:
    """All cells of as many axes that touch ``cell``, itself included."""
    return F.aggregate(cell, F.array(F.array().cast("array<int>")), lambda found, x: F.flatten(F.transform(
        found, lambda p: F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.concat(p, F.array(x + d))))))


def _tile_pairs(tiles: DataFrame, width: float, axes: int) -> DataFrame:
    """left_cell, left_number, cell, number: the pairs of tiles that may hold linked vectors, each once, a tile with itself too.

    The tile of the cell of more axes looks for the other, among the neighbours of what its cell is in fewer axes.
    """
    boxes = tiles.select("cell", "number", "low", "high")
    near = F.flatten(F.transform(F.sequence(F.lit(axes), F.size("cell")), lambda d: _neighbours(F.slice("cell", 1, d))))
    left = boxes.select(*[F.col(c).alias(f"left_{c}") for c in boxes.columns], F.explode(near).alias("cell"))
    once = (F.size("left_cell") > F.size("cell")) | (F.struct("left_cell", "left_number") <= F.struct("cell", "number"))
    after, before = (F.zip_with(a, b, lambda x, y: x - y) for a, b in (("low", "left_high"), ("left_low", "high")))
    gaps = F.zip_with(after, before, lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    return left.join(boxes, "cell").filter(once & (apart <= width * width)).select("left_cell", "left_number", "cell", "number")


def _compare(tiles: DataFrame, basis: np.ndarray, threshold: float, width: float, axes: int, kind: type) -> DataFrame:
    """Rows (a, null, n): vector a has n links in one pair of tiles. Rows (a, b, 0): a and b hang together in it, a star for each group."""
    pairs = _tile_pairs(tiles, width, axes)
    left = tiles.select(F.col("cell").alias("left_cell"), F.col("number").alias("left_number"), F.col("ids").alias("left_ids"),
                        F.col("weights").alias("left_weights"), F.col("vectors").alias("left_vectors"))
    n = len(basis)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["left_cell"] == row["cell"] and row["left_number"] == row["number"]
                counts, forest = _tile_links(
                    *(np.frombuffer(row[k], np.int64) for k in ("left_ids", "ids", "left_weights", "weights")),
                    *(np.frombuffer(row[k], kind).reshape(-1, n).astype(np.float64) for k in ("left_vectors", "vectors")), same, basis, threshold)
                a = [*counts[0], *forest[0]]
                if a:
                    yield pa.RecordBatch.from_pydict({
                        "a": pa.array(a, pa.int64()), "b": pa.array([None] * len(counts[0]) + list(forest[1]), pa.int64()),
                        "n": pa.array([*counts[1], *[0] * len(forest[0])], pa.int64())})

    return (
        pairs.join(left, ["left_cell", "left_number"]).join(tiles, ["cell", "number"])
        .select("left_cell", "left_number", "cell", "number", "left_ids", "ids", "left_weights", "weights", "left_vectors", "vectors")
        .mapInArrow(compare, "a long, b long, n long")
    )


def _tile_links(left_ids, ids, left_weights, weights, left_raw, raw, same, basis, threshold, block: int = 512):
    """Link counts of the vectors of two tiles with each other, and the groups that these links make."""
    slack = 1e-5
    left_unit, unit = _unit(left_raw), _unit(raw)
    left, right = (left_unit @ basis).astype(np.float32), (unit @ basis).astype(np.float32)
    ends = [e for e in STRETCHES if e < len(basis)] + [len(basis)]
    # The norms of what is left of each vector after a stretch.
    left_rest, right_rest = ([np.sqrt((side[:, e:] ** 2).sum(axis=1)) for e in ends] for side in (left, right))
    left_count, right_count = np.zeros(len(left_ids), np.int64), np.zeros(len(ids), np.int64)
    shift = 0 if same else len(left_ids)
    label = np.arange(shift + len(ids))
    for start in range(0, len(left), block):
        part = slice(start, start + block)
        others = slice(start, None) if same else slice(None)
        first = ends[0]
        bound = left[part, :first] @ right[others, :first].T
        i, j = np.nonzero(bound + left_rest[0][part, None] * right_rest[0][None, others] >= threshold - slack)
        partial = bound[i, j]
        i, j = i + start, j + (start if same else 0)
        if same:
            keep = j > i
            i, j, partial = i[keep], j[keep], partial[keep]
        for k in range(1, len(ends)):
            if not len(i):
                break
            chunk = slice(ends[k - 1], ends[k])
            partial = partial + np.einsum("ij,ij->i", left[i, chunk], right[j, chunk])
            keep = partial + left_rest[k][i] * right_rest[k][j] >= threshold - slack
            i, j, partial = i[keep], j[keep], partial[keep]
        if not len(i):
            continue
        exact = np.concatenate([np.einsum("ij,ij->i", left_unit[i[s:s + 65536]], unit[j[s:s + 65536]]) for s in range(0, len(i), 65536)])
        i, j = i[exact >= threshold], j[exact >= threshold]
        np.add.at(left_count, i, weights[j])
        np.add.at(right_count, j, left_weights[i])
        _merge(label, i, j + shift)
    if same:
        left_count += right_count
        hit = np.nonzero(left_count)[0]
        counted = (left_ids[hit].tolist(), left_count[hit].tolist())
    else:
        a, b = np.nonzero(left_count)[0], np.nonzero(right_count)[0]
        counted = (left_ids[a].tolist() + ids[b].tolist(), left_count[a].tolist() + right_count[b].tolist())
    every = ids if same else np.concatenate([left_ids, ids])
    tied = np.nonzero(label != np.arange(len(label)))[0]
    return counted, (every[label[tied]].tolist(), every[tied].tolist())


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked positions the same label, the smallest of their group."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(further := label[label], label):
            label[:] = further
