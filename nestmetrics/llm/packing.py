"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bounded-space online best-fit: a group of pieces meets a fixed number of open bins. The bins are kept
in a bitset keyed by free space, so the tightest bin that takes a piece is the lowest set bit at or
above its length. If none takes it, a new bin opens; when all bins are open, the fullest closes first.

Documents are encoded once, cut into pieces, and only the pieces' numbers are shuffled. A group gets
about ``GROUP_SEQUENCES`` sequences' worth of pieces by a hash, whatever document they are from, and
takes the long ones first. Best-fit leaves at most one bin under half full, so twice that many bins
always suffice: ``OPEN_BINS`` is more, no bin closes early, and a group wastes part of one sequence.

Defined cases: a null or empty text is one piece of the end id alone. Repeated rows are packed as
often as they occur. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.bpe import WORD_BPE, library_codec
from nestmetrics.llm.common import col, releasing, ship_code, stored, table, text_of
from nestmetrics.session import LONG_TEXTS, settings

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 4096
GROUP_SEQUENCES = 1500
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


class OpenBins:
    """A fixed number of open bins, found by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f: some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.opened = self.open = 0

    def _take(self, space: int) -> int:
        found = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin of a piece and its offset there."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            found = self._take(space)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, found = self.capacity, self.opened
            self.opened += 1
        if left := space - length:
            if not self.bins[left]:
                self.free |= 1 << left
            self.bins[left].append(found)
            self.open += 1
        return found, self.capacity - space


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of the capacity at most."""
    tail = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        this = library_codec(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = this.encode(text.as_py()) + tail
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    ship_code(docs.sparkSession)
    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(releasing(run), PIECES)


def pack(cut: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """Pieces (stored: they are read twice) with the sequence and offset of each."""
    tokens = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // (group_sequences * capacity)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins = OpenBins(capacity, open_bins)
        placed = [bins.place(n) for n in group.column("length").to_pylist()]
        at = np.array(placed, dtype=np.int64).reshape(-1, 2)
        number = group.column("group")[0].as_py()
        columns = [group.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        return pa.table([*columns, pa.array(at[:, 0] + (number << 32)), pa.array(at[:, 1])], names=[*(c.split()[0] for c in PACKED.split(", "))])

    ship_code(cut.sparkSession)
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("long"))
    return dealt.groupBy("group").applyInArrow(run, PACKED)


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    with settings(docs.sparkSession, LONG_TEXTS):
        cut = stored(pieces(docs, path), "pieces")
    return pack(cut)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
