"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with a cosine of at least c lie within the squared distance 2 - 2c. All vectors are turned
by one random rotation, which spreads their lengths evenly over the coordinates, and split into blocks
of ``WIDTH`` coordinates. The squared distance of a pair is the sum over its blocks, so in some block it
is at most the block's share of the bound. Each block is range-joined under that budget; the union of
its candidates is verified with the whole vectors in double precision, so the result is exact.

A block's range join deals the vectors to cells of its first coordinates, twice the budget's radius
wide. A vector is at home in one cell and a guest in the later ones its ball reaches; the more vectors
there are, the more coordinates make the cells (``CELL_ROWS``). A cell sorts its vectors by the next
coordinate and compares its home vectors with each other and with the guests, tile by tile, where that
coordinate allows. A pair that several blocks find counts in the first of them. Tasks return link counts
and links that span their groups, never the pairs themselves.

Equal vectors are one class from the start: they are counted, not paired, so a vector that a third of
all rows share costs as much as any other. Different vectors that lie close together are all compared,
because their links have to be counted.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing. Vectors of different lengths are not compared. A null id is never the smallest of its group
unless all are null. Repeated rows count as vectors of their own. An empty table gives an empty result.
Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import attach, col, ship_code, stored, table
from nestmetrics.llm.components import components, smallest_members
from nestmetrics.llm.simhash import local_groups

COSINE = 0.95
WIDTH = 8
#: From so many distinct vectors on per coordinate's worth of cells, cells take one coordinate more.
CELL_ROWS = 100_000
CELL_FACTOR = 8
TILE = 512
#: Candidate pairs verified at a time.
PAIRS = 50_000
SEED = 7


@lru_cache(8)
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))[0]


def blocks(size: int) -> list[slice]:
    """Coordinates of the blocks; the last may be wider."""
    count = max(1, size // WIDTH)
    return [slice(b * WIDTH, (b + 1) * WIDTH if b < count - 1 else size) for b in range(count)]


def block_budgets(size: int, cosine: float) -> np.ndarray:
    """Squared distance by block, in proportion to its width; a hair more, for rounding."""
    return np.array([(2 - 2 * cosine) * (b.stop - b.start) / size for b in blocks(size)]) * (1 + 1e-9)


def classes(vectors: DataFrame, embedding: str) -> DataFrame:
    """vec_id, size and digest (k1, k2) of each row, with its unit vector in bytes; size 0: links with nothing."""
    schema = "vec_id long, size int, k1 long, k2 long, unit binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                unit = None
                values = value.values if value.is_valid else None
                if values is not None and len(values) and not values.null_count:
                    vector = values.to_numpy(zero_copy_only=False).astype(np.float64)
                    most = np.abs(vector).max()
                    if np.isfinite(most) and most > 0:
                        vector = vector / most  # so that squares neither overflow nor vanish
                        unit = (vector / np.sqrt(vector @ vector)).tobytes()
                digest = hashlib.blake2b(unit or b"", digest_size=16).digest()
                rows.append((len(unit) // 8 if unit else 0, int.from_bytes(digest[:8], signed=True), int.from_bytes(digest[8:], signed=True), unit))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["vec_id", "size", "k1", "k2", "unit"])

    ship_code(vectors.sparkSession)
    rows = vectors.select(col(vectors, "vec_id").cast("long").alias("vec_id"), col(vectors, embedding).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, schema)


def dealt(distinct: DataFrame, cosine: float, dimensions: int) -> DataFrame:
    """Each class (id, size, rows, unit) in the cells of every block: at home in one, a guest in later ones."""
    schema = "cell string, size int, block int, home boolean, id long, rows long, turned binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, size, rows, unit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                turned = np.frombuffer(unit) @ rotation(size)
                data = turned.tobytes()
                for b, (where, budget) in enumerate(zip(blocks(size), block_budgets(size, cosine), strict=True)):
                    radius = float(np.sqrt(budget)) * (1 + 1e-9)
                    lead = turned[where][:dimensions] / (2 * radius)
                    own = tuple(np.floor(lead).astype(int).tolist())
                    reach = product(*(range(int(np.floor(x - 0.5)), int(np.floor(x + 0.5)) + 1) for x in lead.tolist()))
                    out.extend((f"{size}/{b}/{cell}", size, b, cell == own, id_, rows, data) for cell in reach if cell >= own)
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["cell", "size", "block", "home", "id", "rows", "turned"])

    return distinct.select("id", "size", "rows", "unit").mapInArrow(run, schema)


def cell_links(turned: np.ndarray, home: np.ndarray, block: int, cosine: float, dimensions: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs with that cosine, one of them at home, whose first block within budget is this one; each once."""
    size = turned.shape[1]
    where, budgets = blocks(size), block_budgets(size, cosine)
    part = turned[:, where[block]]
    lead = part[:, min(dimensions, part.shape[1] - 1)]
    radius = float(np.sqrt(budgets[block])) * (1 + 1e-9)
    narrow = part.astype(np.float32)
    length = np.einsum("ij,ij->i", narrow, narrow)[:, None]
    one = np.ones_like(length)
    # The product of a left and a right row is their squared distance, up to single precision.
    left = np.ascontiguousarray(np.hstack([-2 * narrow, length, one]))
    right = np.ascontiguousarray(np.hstack([narrow, one, length]))
    limit = np.float32(budgets[block] + 1e-5)
    own, guests = (x[np.argsort(lead[x], kind="stable")] for x in (np.flatnonzero(home), np.flatnonzero(~home)))
    at_own, at_guests = lead[own], lead[guests]
    for a in range(0, len(own), TILE):
        mine = own[a : a + TILE]
        low, high = at_own[a] - radius, at_own[min(a + TILE, len(own)) - 1] + radius
        after = own[a : np.searchsorted(at_own, high, side="right")]
        visiting = guests[np.searchsorted(at_guests, low) : np.searchsorted(at_guests, high, side="right")]
        rows = left[mine]
        for others, same in ((after, True), (visiting, False)):
            for b in range(0, len(others), 4 * TILE):
                tile = others[b : b + 4 * TILE]
                flat = np.flatnonzero(rows @ right[tile].T <= limit)
                i, j = flat // len(tile), flat % len(tile)
                if same:  # both lists start at a: a pair counts from its earlier member
                    later = j + b > i
                    i, j = i[later], j[later]
                u, v = mine[i], tile[j]
                for k in range(0, len(u), PAIRS):
                    x, y = u[k : k + PAIRS], v[k : k + PAIRS]
                    near = np.einsum("ij,ij->i", turned[x], turned[y]) >= cosine
                    x, y = x[near], y[near]
                    squares = (turned[x] - turned[y]) ** 2
                    first = np.full(len(x), -1)
                    for w in reversed(range(len(where))):
                        first[squares[:, where[w]].sum(axis=1) <= budgets[w]] = w
                    counts = first == block
                    yield x[counts], y[counts]


def linked(cells: DataFrame, cosine: float, dimensions: int) -> DataFrame:
    """(id, links, root): links counted in one cell, and a link that spans the cell's groups."""

    def run(group: pa.Table) -> pa.Table:
        size, block = group.column("size")[0].as_py(), group.column("block")[0].as_py()
        turned = np.frombuffer(b"".join(group.column("turned").to_pylist())).reshape(-1, size)
        home = group.column("home").to_numpy().astype(bool)
        ids, rows = group.column("id").to_numpy(), group.column("rows").to_numpy()
        links, label = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for u, v in cell_links(turned, home, block, cosine, dimensions):
            for x, y in ((u, v), (v, u)):
                links += np.bincount(x, weights=rows[y], minlength=len(ids)).astype(np.int64)
            label = local_groups(len(ids), u, v, label)
        some = np.flatnonzero((links > 0) | (label != np.arange(len(ids))))
        return pa.table({"id": ids[some], "links": links[some], "root": ids[label[some]]})

    return cells.groupBy("cell").applyInArrow(run, "id long, links long, root long")


def near_vectors(vectors: DataFrame, embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row."""
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be over 0 and at most 1")
    rows = stored(classes(vectors, embedding), "vectors")
    sound = rows.where("size > 0")
    grouped = sound.groupBy("k1", "k2", "size").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("rows"), F.any_value("unit").alias("unit"))
    # Classes get numbers of their own: ids may be null or repeated.
    distinct = stored(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    count = distinct.count()
    dimensions = 1
    while dimensions < WIDTH and count > CELL_ROWS * CELL_FACTOR ** (dimensions - 1):
        dimensions += 1
    found = stored(linked(dealt(distinct, cosine, dimensions), cosine, dimensions), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    members = smallest_members(distinct.select(F.col("id").alias("node"), F.col("vec_id").alias("id")), roots)
    known = distinct.select("id", "k1", "k2", "rows").join(links, "id", "left").join(members.withColumnRenamed("node", "id"), "id")
    known = stored(
        known.select(
            F.struct("k1", "k2").alias("key"), "rows", "component_id",
            (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "known",
    )
    keyed = sound.select("vec_id", F.struct("k1", "k2").alias("key"))
    total = known.agg(F.sum("rows")).first()[0] or 0
    answered = attach(keyed, known, "key", "rows", total).select("vec_id", "n_links", "component_id")
    alone = rows.where("size = 0").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return answered.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embeddings(spark, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
