"""Hard-negative mining with Four-Russians scoring.

Vectors are integers. A candidate is kept as bit planes: plane p holds bit p of each component in
two's complement, eight components to a byte. For an anchor and a group of eight components a table holds
the sums of all 256 subsets of the anchor's components; a candidate's byte is the index of the subset
that its plane selects. The score is the sum over planes of 2**p times the looked-up sums (the top plane
counts negatively), taken from the top plane down by doubling and adding. Scores are exact integers.

Anchors meet all rows block by block: rows and anchors are dealt to blocks by the hash of a row number, so
no block depends on labels or on how many copies a vector has, and each pair of blocks is one
group of ``ANCHORS`` x ``CANDIDATES`` rows at most, on average. A group returns only the rows that can
still be among the first of their list: ``positives`` for an anchor, ``negatives`` for an anchor and a
positive. The lists are merged by rank. A first pass scores rows of an anchor's own label, a second one
all others.

Defined cases: rows with a null vec_id, label or vector, or with a null or non-finite component take no
part, nor do those with a component of ``LIMIT`` or more in size, whose scores would not fit a long
integer. Only vectors of one length are compared; empty ones score 0. Rows are told apart by row, not by
id: a repeated row is another row. Ties come by vec_id. An empty table, or one without anchors, gives an
empty result. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nestmetrics.llm.common import col, ship_code, stored, table

SCALE = 256
LIMIT = 2**24
GROUP = 8
#: Rows of a block, on average.
ANCHORS = 1024
CANDIDATES = 8192
#: Anchors and candidates scored at a time.
ANCHOR_TILE = 256
CANDIDATE_TILE = 1024


def planes_of(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Packed bit planes of integer vectors: row x plane x group of eight components."""
    bits = (vectors[:, None, :] >> np.arange(planes)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def plane_count(vector: np.ndarray) -> int:
    """Bits that hold all components in two's complement; one at least."""
    if not len(vector):
        return 1
    return max(int(max(vector.max(), ~vector.min())), 0).bit_length() + 1


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """group x subset x anchor: sums of the components of each group that a byte selects."""
    rows, size = anchors.shape
    groups = -(-size // GROUP)
    padded = np.zeros((rows, groups * GROUP), dtype=np.int64)
    padded[:, :size] = anchors
    sums = np.zeros((groups, 1 << GROUP, rows), dtype=np.int64)
    for g in range(groups):
        for j in range(GROUP):
            sums[g, 1 << j : 2 << j] = sums[g, : 1 << j] + padded[:, g * GROUP + j]
    return sums


def scores(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """candidate x anchor: exact inner products, by lookups, from the top plane down."""
    rows, planes, groups = packed.shape
    out = np.zeros((rows, sums.shape[2]), dtype=np.int64)
    for lo in range(0, rows, CANDIDATE_TILE):
        tile, total = packed[lo : lo + CANDIDATE_TILE], out[lo : lo + CANDIDATE_TILE]
        for p in reversed(range(planes)):
            total <<= 1
            for g in range(groups):
                looked = sums[g].take(tile[:, p, g], axis=0)
                if p == planes - 1:
                    total -= looked
                else:
                    total += looked
    return out


def quantised(vectors: DataFrame, embedding: str, label: Column, scale: int) -> DataFrame:
    """row, vec_id, label, size, planes, bits and, in eight bytes a component, ints of each row that takes part."""
    schema = "vec_id long, label long, size int, planes int, bits binary, ints binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                values = value.values
                if values.null_count:
                    continue
                whole = np.floor(values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if not (np.abs(whole) < LIMIT).all():  # nor are NaN and infinities
                    continue
                vector = whole.astype(np.int64)
                planes = plane_count(vector)
                rows.append((id_, kind, len(vector), planes, planes_of(vector[None], planes).tobytes(), vector.tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["vec_id", "label", "size", "planes", "bits", "ints"])

    ship_code(vectors.sparkSession)
    rows = vectors.select(col(vectors, "vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), col(vectors, embedding).cast("array<double>").alias("v"))
    sound = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return sound.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


class _Block:
    """Rows of one group as arrays, in the order of ties, by vector length and number of planes."""

    def __init__(self, rows: pa.Table):
        order = np.lexsort((rows.column("row").to_numpy(), rows.column("vec_id").to_numpy()))
        rows = rows.take(pa.array(order))
        self.row, self.id, self.label = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.size = rows.column("size").to_numpy()
        self.table = rows

    def ints(self, some: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(self.table.column("ints").take(pa.array(some)).to_pylist()), dtype=np.int64).reshape(len(some), -1)

    def scored(self, anchors: np.ndarray, some: np.ndarray) -> np.ndarray:
        """anchor x candidate: scores of these rows (places in the block)."""
        out = np.zeros((len(anchors), len(some)), dtype=np.int64)
        size = anchors.shape[1]
        if not size:
            return out
        sums, planes = subset_sums(anchors), self.table.column("planes").to_numpy()[some]
        for count in np.unique(planes):
            mine = np.flatnonzero(planes == count)
            data = b"".join(self.table.column("bits").take(pa.array(some[mine])).to_pylist())
            packed = np.frombuffer(data, dtype=np.uint8).reshape(len(mine), count, -1)
            out[:, mine] = scores(sums, packed).T
        return out


def _cells(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors in every pair of their blocks (a, c)."""
    a = max(1, -(-anchors.count() // ANCHORS))
    c = max(1, -(-rows.count() // CANDIDATES))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = anchors.select(*(F.col(x).alias(x) for x in anchors.columns))  # columns apart from those of rows
    return (
        rows.drop("ints").withColumn("c", block(c)).withColumn("a", every(a)),
        own.withColumn("a", block(a)).withColumn("c", every(c)),
    )


def positives(rows: DataFrame, anchors: DataFrame, first: int) -> DataFrame:
    """(row, positive_row, positive_id, positive_score): the first other rows of an anchor's label."""
    schema = "row long, positive_row long, positive_id long, positive_score long"

    def run(candidates: pa.Table, anchored: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and anchored.num_rows:
            block, asked = _Block(candidates), _Block(anchored)
            for size, label in sorted(set(zip(asked.size.tolist(), asked.label.tolist(), strict=True))):
                some = np.flatnonzero((block.size == size) & (block.label == label))
                mine = np.flatnonzero((asked.size == size) & (asked.label == label))
                for lo in range(0, len(mine), ANCHOR_TILE):
                    tile = mine[lo : lo + ANCHOR_TILE]
                    for anchor, found in zip(tile, block.scored(asked.ints(tile), some), strict=True):
                        best = np.argsort(-found, kind="stable")[: first + 1]
                        best = best[block.row[some[best]] != asked.row[anchor]][:first]
                        out.extend((asked.row[anchor], block.row[some[k]], block.id[some[k]], found[k]) for k in best)
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "positive_row", "positive_id", "positive_score"])

    cells, asked = _cells(rows, anchors)
    found = cells.groupBy("a", "c").cogroup(asked.groupBy("a", "c")).applyInArrow(run, schema)
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first).drop("rank")


def negatives(rows: DataFrame, anchors: DataFrame, first: int, least: int, most: int) -> DataFrame:
    """For anchors with a list of positives: the first rows of other labels with a score between the shares
    (in hundredths) of each positive's."""
    schema = "row long, positive_row long, negative_row long, negative_id long, negative_score long"

    def run(candidates: pa.Table, anchored: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and anchored.num_rows:
            block, asked = _Block(candidates), _Block(anchored)
            lists = asked.table.column("positives").to_pylist()
            for size in np.unique(asked.size):
                some = np.flatnonzero(block.size == size)
                mine = np.flatnonzero(asked.size == size)
                for lo in range(0, len(mine), ANCHOR_TILE):
                    tile = mine[lo : lo + ANCHOR_TILE]
                    for anchor, found in zip(tile, block.scored(asked.ints(tile), some), strict=True):
                        others = np.flatnonzero(block.label[some] != asked.label[anchor])
                        order = others[np.argsort(-found[others], kind="stable")]
                        falling = -found[order]
                        for positive in lists[anchor]:
                            score = positive["positive_score"]
                            lowest, highest = -(-least * score // 100), most * score // 100
                            begin, end = np.searchsorted(falling, -highest, "left"), np.searchsorted(falling, -lowest, "right")
                            for k in order[begin : min(begin + first, end)]:
                                out.append((asked.row[anchor], positive["positive_row"], block.row[some[k]], block.id[some[k]], found[k]))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "positive_row", "negative_row", "negative_id", "negative_score"])

    cells, asked = _cells(rows, anchors)
    found = cells.groupBy("a", "c").cogroup(asked.groupBy("a", "c")).applyInArrow(run, schema)
    order = Window.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)


def mine(
    vectors: DataFrame, anchor: Column, label: Column, embedding: str = "embedding", scale: int = SCALE,
    n_positives: int = 5, n_negatives: int = 10, least: int = 30, most: int = 90,
) -> DataFrame:
    """Hard negatives of each anchor and positive.

    ``anchor`` is a condition on vec_id, ``label`` a column of vectors. A negative has another label and a
    score from least to most hundredths of the positive's.
    """
    rows = stored(quantised(vectors, embedding, label, scale), "planes")
    anchors = rows.where(anchor).drop("bits", "planes")
    found = stored(positives(rows, anchors, n_positives), "positives")
    lists = found.groupBy("row").agg(F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))
    listed = stored(negatives(rows, anchors.join(lists, "row"), n_negatives, least, most), "negatives")
    named = rows.select("row", F.col("vec_id").alias("anchor_id"))
    return (
        listed.join(found, ["row", "positive_row"])
        .join(named, "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Ten hard negatives for five positives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % 100 == 0, label)


OP12_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same, list_inner_product(a.v, o.v)::BIGINT AS score
  FROM sound a JOIN sound o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""
