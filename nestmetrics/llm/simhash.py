"""SimHash near-dedup by a binary trie self-join.

A document's fingerprint has a bit set where over half of the hashes of its word shingles have it. The
distinct fingerprints form a binary trie, and the join walks pairs of its nodes down together, adds up
the bits in which they differ, and leaves a pair as soon as its error budget is spent.

A walk with the full budget from the top would visit a share of all pairs. So the trie is built over
the four rotations of the fingerprint by a quarter of its bits: of two fingerprints that differ in at
most k bits, some rotation has at most k/4 of them in its first quarter, k/2 in its first half and so
on (the pigeonhole argument on a ring), and these are the budgets. Subtrees are dealt to tasks: with
prefixes of p bits, a task gets the fingerprints below one prefix and those of the prefixes within the
first quarter's budget. p follows the fullest prefix of a window (below), so a task's share stays bounded as the
input grows; what all tasks get grows faster, so some turns are dealt at a time, and their shuffle files deleted
before the next.

64 bits tell apart what differs in a few bits only. Where near copies at a similarity of 0.8 count, each
fingerprint has 192 bits more, from the same hashes mixed anew, and a pair is linked if at most 51 of the
256 bits differ. Then some part of 64 bits differs in at most 12, so the trie is walked over each of the
four parts with that budget, and no pair within the bound is missed. Sets of shingles whose sizes are
further apart than 4 to 5 cannot be that similar, so a trie holds a window of sizes only; the windows
overlap, and any two sizes within that ratio share one.

Bits only propose such pairs: within the groups that they form, texts are linked if the exact Jaccard
similarity of their sets of shingles (64-bit hashes) is at least 0.8. Groups are compared by an inverted
index, many small ones or one in a task. In a group too large for that, each text is first held against
one of the group; those not near it, if any, are dealt in blocks against blocks of the whole group.

A task returns links that span its groups, not all pairs: a first walk with a budget of one joins
what is close, and pairs of subtrees that lie within one group already are left. Links join up in
``components``. Copies of a fingerprint count once, so no group of copies is expanded.

Defined cases: null and empty texts have fingerprint zero and are linked like any other. A null id
stays null and is never the smallest of its group unless all are null. Repeated rows get the same
component. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import attach, col, digest_of, free_shuffles, keep_rows, release, releasing, ship_code, stored, table, text_of
from nestmetrics.llm.components import components, smallest_members

BITS = 64
TURNS = 4
QUARTER = BITS // TURNS
SEED = 42
#: Bits of 256 that differ at most at a similarity of 0.8, and bits of some part of 64 then.
WIDE_PARTS = 4
WIDE_MOST = BITS * WIDE_PARTS // 5
NEAR_MOST = WIDE_MOST // WIDE_PARTS
#: Most fingerprints in one task of the join, as far as prefixes of a quarter allow.
TASK_ROWS = 150_000
#: Rows that are dealt to tasks at a time, and as a multiple of the fingerprints; more are dealt in several passes.
PASS_ROWS = 8_000_000
PASS_SHARE = 6
#: Bytes of a text that are split into words at a time.
SEGMENT = 4 << 20
WHITE = b" \t\n\x0b\x0c\r"
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def segments(text: bytes, size: int = SEGMENT) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + size, n)
        while end < n and text[end] not in WHITE:
            end += 1
        yield text[at:end].split()
        at = end


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, lowest bit first."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(octets) < 256:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, b], minlength=256) @ BYTE_BITS for b in range(8)])


def mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Other hashes from hashes; k = 0 leaves them."""
    if not k:
        return hashes
    x = (hashes + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, words_in_shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles, a segment at a time; fewer words make one shingle."""
    hashed = xxhash.xxh64_intdigest
    none, before = True, []
    for words in segments(text.lower()):
        words = before + words
        if len(words) < words_in_shingle:
            before = words
            continue
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(lengths)
        line = b" ".join(words)
        starts = (ends - lengths)[: len(words) - words_in_shingle + 1].tolist()
        stops = (ends[words_in_shingle - 1 :] - 1).tolist()
        hashes = np.array([hashed(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)
        yield hashes
        none, before = False, words[len(words) - words_in_shingle + 1 :]
    if none and before:
        yield np.array([hashed(b" ".join(before), SEED)], dtype=np.uint64)


def fingerprint(text: bytes, words_in_shingle: int = 4, parts: int = 1, repeats: bool = True) -> list[int]:
    """SimHash of a text's word shingles in parts of 64 bits; zero without words."""
    return sized_fingerprint(text, words_in_shingle, parts, repeats)[0]


def sized_fingerprint(text: bytes, words_in_shingle: int, parts: int, repeats: bool) -> tuple[list[int], int]:
    """The fingerprint, and of how many shingles. Repeats count each time, or once only."""
    total, counts = 0, np.zeros((parts, BITS), dtype=np.int64)
    seen = np.zeros(0, dtype=np.uint64)
    for hashes in shingle_hashes(text, words_in_shingle):
        if not repeats:
            hashes = np.setdiff1d(hashes, seen)
            seen = np.union1d(seen, hashes)
        for k in range(parts):
            counts[k] += bit_counts(mixed(hashes, k))
        total += len(hashes)
    return [sum(1 << b for b in np.flatnonzero(row * 2 > total).tolist()) for row in counts], total


def fingerprints(docs: DataFrame, words_in_shingle: int = 4, parts: int = 1, repeats: bool = True, digest: bool = False) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of each row, more parts (wide) with the number of shingles, if asked the text's digest."""
    kept = "doc_id long, digest binary" if digest else "doc_id long"
    wide = ", wide array<long>, shingles long" if parts > 1 else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sized = [sized_fingerprint(t.as_py(), words_in_shingle, parts, repeats) for t in batch.column(0)]
            found = np.array([f for f, _ in sized], dtype=np.uint64).reshape(-1, parts).view(np.int64)
            more = [pa.array(list(found[:, 1:]), pa.list_(pa.int64())), pa.array([n for _, n in sized], pa.int64())] if parts > 1 else []
            names = [*batch.schema.names[1:], "fp", *["wide", "shingles"][: len(more)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found[:, 0]), *more], names=names)

    ship_code(docs.sparkSession)
    text = text_of(docs)
    columns = [text.cast("binary").alias("text"), col(docs, "doc_id").cast("long").alias("doc_id")]
    if digest:
        columns.append(digest_of(text).alias("digest"))
    return docs.select(*columns).mapInArrow(run, f"{kept}, fp long{wide}")


def local_groups(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest member of each of n nodes' components under the edges (u, v) and earlier labels."""
    label = np.arange(n) if label is None else label
    while len(u):
        u, v = label[u], label[v]
        apart = u != v
        u, v = u[apart], v[apart]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(label, up := label[label]):
            label = up
    return label


class TrieWalk:
    """Walks pairs of nodes of the binary trie over sorted keys, distinct unless they have wide bits."""

    #: Pairs of subtrees with so few pairs of leaves are compared at once.
    LEAF_PAIRS = 16
    #: Node pairs in one step; more wait, and the deepest go first, so memory is bounded.
    FRONT = 1 << 16
    #: Pairs of leaves compared at a time below equal keys.
    DENSE = 1 << 18

    def __init__(self, keys: np.ndarray, depth: int, wide: np.ndarray | None = None, wide_most: int = 0):
        self.keys, self.wide, self.wide_most = keys, wide, wide_most
        self.levels: list[np.ndarray] = []  # first leaf of each node, from the depth on; the end last
        self.depth = depth
        for d in range(depth, BITS + 1):
            top = keys >> np.uint64(BITS - d) if d else np.zeros_like(keys)
            self.levels.append(np.append(np.flatnonzero(np.append(True, top[1:] != top[:-1])), len(keys)))

    def node(self, leaf: int) -> int:
        return int(np.searchsorted(self.levels[0], leaf, side="right") - 1)

    def links(self, a: np.ndarray, b: np.ndarray, budgets: list[int], label: np.ndarray) -> np.ndarray:
        """Groups after adding the pairs below the node pairs (a, b) that keep within the budgets."""
        wrong = np.bitwise_count(self._prefix(a) ^ self._prefix(b)).astype(np.int8)
        waiting = [(0, a, b, wrong)]
        while waiting:
            level, a, b, wrong = waiting.pop()
            if len(a) > self.FRONT:
                waiting.append((level, a[self.FRONT :], b[self.FRONT :], wrong[self.FRONT :]))
                a, b, wrong = a[: self.FRONT], b[: self.FRONT], wrong[: self.FRONT]
            starts = self.levels[level]
            size_a, size_b = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
            # What is one group already has nothing to find.
            low, high = (f.reduceat(label, starts[:-1]) for f in (np.minimum, np.maximum))
            open_ = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            open_ &= ~((a == b) & (size_a == 1))
            small = open_ & (size_a * size_b <= self.LEAF_PAIRS)
            if small.any():
                label = self._compare(starts, a[small], b[small], budgets[-1], label)
            large = open_ & ~small
            a, b, wrong = a[large], b[large], wrong[large]
            if self.depth + level == BITS:  # repeated keys that differ in other bits
                label = self._dense(starts, a, b, budgets[-1], label)
                continue
            below = self._below(level, a, b, wrong, budgets)
            if len(below[0]):
                waiting.append((level + 1, *below))
        return label

    def _prefix(self, nodes: np.ndarray) -> np.ndarray:
        return self.keys[self.levels[0][nodes]] >> np.uint64(BITS - self.depth) if self.depth else np.zeros(len(nodes), np.uint64)

    def _below(self, level, a, b, wrong, budgets):
        starts, under = self.levels[level], self.levels[level + 1]
        first = np.searchsorted(under, starts[:-1])
        forked = np.append(first[1:], len(under) - 1) - first == 2
        shift = np.uint64(BITS - self.depth - level - 1)
        bit = (self.keys[under[:-1]] >> shift) & np.uint64(1)
        parts = []
        for right_a, right_b in ((0, 0), (0, 1), (1, 0), (1, 1)):
            some = (forked[a] | (not right_a)) & (forked[b] | (not right_b))
            if right_a and not right_b:
                some &= a != b  # the mirror image of (0, 1)
            x, y = first[a[some]] + right_a, first[b[some]] + right_b
            parts.append((x, y, wrong[some] + (bit[x] != bit[y])))
        x, y, wrong = (np.concatenate(p) for p in zip(*parts, strict=True))
        within = wrong <= budgets[self.depth + level + 1]
        return x[within], y[within], wrong[within].astype(np.int8)

    def _dense(self, starts, a, b, most, label):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            right = np.arange(starts[y], starts[y + 1])
            step = max(1, self.DENSE // len(right))
            for at in range(starts[x], starts[x + 1], step):
                left = np.arange(at, min(at + step, starts[x + 1]))
                u, v = np.repeat(left, len(right)), np.tile(right, len(left))
                apart = label[u] != label[v]
                label = self._near(u[apart], v[apart], most, label)
        return label

    def _compare(self, starts, a, b, most, label):
        size_a, size_b = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
        n = size_a * size_b
        pair = np.repeat(np.arange(len(a)), n)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        u = starts[a][pair] + within // size_b[pair]
        v = starts[b][pair] + within % size_b[pair]
        return self._near(u, v, most, label)

    def _near(self, u, v, most, label):
        apart = np.bitwise_count(self.keys[u] ^ self.keys[v]).astype(np.int64)
        near = (u != v) & (apart <= most)
        if self.wide is not None:
            u, v = u[near], v[near]
            near = apart[near] + np.bitwise_count(self.wide[u] ^ self.wide[v]).sum(axis=1) <= self.wide_most
        return local_groups(len(label), u[near], v[near], label)


def budgets(most: int) -> list[int]:
    """By depth, the differing bits that a pair may have above it in one of its rotations."""
    return [most * -(-d // QUARTER) // TURNS for d in range(BITS + 1)]


def turned(fp: Column, turn: Column) -> Column:
    """Fingerprint rotated left by so many quarters."""
    out = fp
    for k in range(1, TURNS):
        rotated = F.shiftleft(fp, k * QUARTER).bitwiseOR(F.shiftrightunsigned(fp, BITS - k * QUARTER))
        out = F.when(turn == k, rotated).otherwise(out)
    return out


def in_passes(passes: int, links: Callable[[int], DataFrame]) -> DataFrame:
    """The links of all passes. One at a time is dealt, stored and its shuffle files deleted."""
    found = None
    for k in range(passes):
        part = stored(links(k), "links")
        free_shuffles(part.sparkSession)
        found = part if found is None else found.unionByName(part)
    return found


def _looked_up(values: dict[int, Column], key: Column) -> Column:
    return F.create_map(*(x for k, v in values.items() for x in (F.lit(k).cast("long"), v)))[key.cast("long")]


def _depths(turns: DataFrame, masks: dict[int, list[int]], task_rows: int) -> tuple[dict[int, int], dict[int, int]]:
    """The shortest prefix of each window under which no task gets too much, and the rows of each window."""
    depths, sizes = {}, {}
    for p in masks:
        top = F.shiftrightunsigned("key", BITS - p) if p else F.lit(0).cast("long")
        left = turns.where(~F.col("window").isin(list(depths))) if depths else turns
        counts = left.groupBy("turn", "window", top.alias("top")).agg(F.count("*").alias("n"))
        for r in counts.groupBy("window").agg(F.max("n").alias("fullest"), F.sum("n").alias("n")).collect():
            sizes[r["window"]] = r["n"]
            if p == QUARTER or r["fullest"] * (len(masks[p]) + 1) // 2 <= task_rows:
                depths[r["window"]] = p
        if len(depths) == len(sizes):
            break
    return depths, sizes


def trie_links(prints: DataFrame, most: int = 4, wide_most: int = 0, task_rows: int = TASK_ROWS, pass_rows: int = PASS_ROWS) -> DataFrame:
    """Links (u, v) that span the groups of fingerprints within so many bits.

    prints: distinct fp. With a bound for all bits, distinct (fp, wide), a number of each, node, that
    the links hold, and, where only some pairs count, windows: prints that share none are not compared.
    most is then the budget of each part of 64 bits; wide has the WIDE_PARTS - 1 others.
    """
    flips = most // TURNS  # bits that may differ in the first quarter
    more = [*(f"wide{k}" for k in range(WIDE_PARTS - 1)), "node"] if wide_most else []
    if wide_most:  # each part in turn is the key, the others are wide
        parts = F.concat(F.array("fp"), "wide")
        each = F.transform(parts, lambda x, i: F.struct(i.alias("part"), x.alias("fp"), F.filter(parts, lambda _, j: j != i).alias("wide")))
        windows = "windows" if "windows" in prints.columns else F.array(F.lit(0))
        prints = prints.withColumn("window", F.explode(windows)).select(F.inline(each), "node", F.col("window").cast("long"))
        prints = prints.withColumns({f"wide{k}": F.get("wide", F.lit(k)) for k in range(WIDE_PARTS - 1)})
    else:
        prints = prints.select(F.lit(0).alias("part"), "fp", F.lit(0).cast("long").alias("window"))
    turns = prints.select("fp", "part", "window", *more, F.explode(F.array([F.lit(k) for k in range(TURNS)])).alias("turn"))
    turns = turns.withColumn("key", turned(F.col("fp"), F.col("turn"))).withColumn("turn", F.col("part") * TURNS + F.col("turn"))
    masks = {p: [m for m in range(1 << p) if m.bit_count() <= flips] for p in range(0 if wide_most else 2, QUARTER + 1, 2)}
    depths, sizes = _depths(turns, masks, task_rows)
    if not depths:
        return prints.sparkSession.createDataFrame([], "u long, v long")
    # To its own prefix and to the smaller ones of the prefixes that few bits tell from it.
    depth = _looked_up({w: F.lit(p) for w, p in depths.items()}, F.col("window"))
    near = _looked_up({p: F.array(*(F.lit(m).cast("long") for m in masks[p])) for p in set(depths.values())}, F.col("depth"))
    home = F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(key, {BITS} - depth)"))
    each_near = F.filter(F.transform(near, lambda m: F.col("home").bitwiseXOR(m)), lambda x: x <= F.col("home"))
    dealt = turns.withColumn("depth", depth).withColumn("home", home).withColumn("prefix", F.explode(each_near))
    # Window, turn and prefix in one number: a row is no more than its bits, its node and its place.
    place = F.col("window") * F.lit(1 << 24) + F.col("turn") * F.lit(1 << 16) + F.col("prefix")
    dealt = dealt.select("turn", place.alias("place"), "key", *more)
    allowed = budgets(most)

    def run(group: pa.Table) -> pa.Table:
        place = group.column("place")[0].as_py()
        turn, prefix, depth = place >> 16 & 0xFF, place & 0xFFFF, depths[place >> 24]
        keys = group.column("key").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        keys = keys[order]
        wide = None
        if wide_most:
            wide = np.column_stack([group.column(c).to_numpy().view(np.uint64)[order] for c in more[:-1]])
        walk = TrieWalk(keys, depth, wide, wide_most)
        tops = walk._prefix(np.arange(len(walk.levels[0]) - 1)).tolist()
        label = np.arange(len(keys))
        if prefix in tops:
            own, others = tops.index(prefix), np.arange(len(tops))
            mine = np.full(len(tops), own)
            for k in sorted({min(1, most), min(4, most), most}):
                within = [min(k, x) for x in allowed]
                label = walk.links(np.minimum(mine, others), np.maximum(mine, others), within, label)
        linked = np.flatnonzero(label != np.arange(len(keys)))
        if wide_most:
            node = group.column("node").to_numpy()[order]
            del walk, wide, group
            release()
            return pa.table({"u": node[linked], "v": node[label[linked]]})
        back = np.uint64(turn * QUARTER)
        plain = keys if not turn else (keys >> back) | (keys << (np.uint64(BITS) - back))
        plain = plain.view(np.int64)
        return pa.table({"u": plain[linked], "v": plain[label[linked]]})

    def links(rows: DataFrame) -> DataFrame:
        return rows.drop("turn").groupBy("place").applyInArrow(run, "u long, v long")

    n_turns = TURNS * (WIDE_PARTS if wide_most else 1)
    rows = sum(n * (len(masks[depths[w]]) + 1) / 2 for w, n in sizes.items())
    passes = min(n_turns, math.ceil(rows / max(pass_rows, PASS_SHARE * sum(sizes.values()) / n_turns)))
    if passes <= 1:
        return links(dealt)
    return in_passes(passes, lambda k: links(dealt.where(F.col("turn") % passes == k)))


def near_groups(rows: DataFrame, most: int = 4) -> DataFrame:
    """Rows (doc_id, fp, ...; stored) with component_id, the smallest id reachable by links."""
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "fingerprints")
    roots = components(trie_links(prints, most))
    groups = smallest_members(prints.select(F.col("fp").alias("node"), "id"), roots)
    groups = stored(groups.withColumnRenamed("node", "fp").join(prints.select("fp", "rows"), "fp"), "groups")
    total = prints.agg(F.sum("rows")).first()[0] or 0
    return attach(rows, groups, "fp", "rows", total)


#: The largest size in a window, as a multiple of its smallest without the overlap.
WINDOW = (5 / 4) ** 2


def size_windows(size: Column) -> Column:
    """One or two windows of sizes; of two sizes that are at most 4 to 5 apart, some window has both.

    The one that the size falls into, and the one that four fifths of it fall into.
    """
    size = F.greatest(size, F.lit(1)).cast("double")
    # A little less than four fifths, so that rounding never parts two sizes that are exactly so far apart.
    windows = [F.floor(F.ln(x) / F.ln(F.lit(WINDOW))) for x in (size, size * (0.8 - 1e-9))]
    return F.array_distinct(F.array(*windows))


def candidate_groups(texts: DataFrame) -> DataFrame:
    """Texts (fp, wide, shingles, ...; stored) that have others within WIDE_MOST bits, with their group (long).

    A group is what chains of such pairs connect, of texts of which some have numbers of shingles in one
    window; equal fingerprints are in one group.
    """
    sizes = F.flatten(F.collect_set(size_windows(F.col("shingles"))))
    nodes = texts.groupBy("fp", "wide").agg(F.count("*").alias("texts"), F.array_distinct(sizes).alias("windows"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "fingerprints")
    roots = components(trie_links(nodes, NEAR_MOST, WIDE_MOST))
    groups = nodes.join(roots, "node", "left").where("root IS NOT NULL OR texts > 1")
    groups = stored(groups.select("fp", "wide", "texts", F.coalesce("root", "node").alias("group")), "groups")
    total = nodes.agg(F.sum("texts")).first()[0] or 0
    return attach(texts, groups, ["fp", "wide"], "texts", total).drop("texts")


#: Shingles of the texts that one task compares, and of one block of a larger group.
BLOCK = 1 << 16
#: Bytes of shingle sets in one Arrow batch.
SETS_BATCH = 16 << 20


def shingle_sets(docs: DataFrame, words_in_shingle: int) -> DataFrame:
    """digest and shingles (sorted distinct hashes) of each row."""
    schema = pa.schema([("digest", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, at, held = [], 0, 0
            for i, text in enumerate(batch.column(0)):
                found = [np.unique(h) for h in shingle_hashes(text.as_py(), words_in_shingle)]
                found = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
                sets.append(found.view(np.int64))
                held += found.nbytes
                if held > SETS_BATCH or i == len(batch) - 1:
                    lists = pa.array(sets, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, len(sets)), lists], schema=schema)
                    sets, at, held = [], i + 1, 0

    ship_code(docs.sparkSession)
    text = text_of(docs)
    return docs.select(text.cast("binary").alias("text"), digest_of(text).alias("digest")).mapInArrow(releasing(run), "digest binary, shingles array<long>")


def near_sets(sets: list[np.ndarray], label: np.ndarray, asked: np.ndarray, anchor: int) -> np.ndarray:
    """Groups after linking the sets asked with all others at a Jaccard similarity of at least 0.8.

    label may have more members than there are sets. What is in the anchor's group is left: of a pair
    not compared, both are in it, or it is compared where its other set is asked.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    ends = np.cumsum(np.bincount(codes)) if len(codes) else np.zeros(0, np.int64)
    first = np.cumsum(sizes) - sizes
    for x in asked.tolist():
        if x != anchor and label[x] == label[anchor]:
            continue
        own = codes[first[x] : first[x] + sizes[x]]
        starts = np.where(own > 0, ends[own - 1], 0)
        held = ends[own] - starts
        at = np.repeat(starts - (np.cumsum(held) - held), held) + np.arange(held.sum())
        common = np.bincount(owner[at], minlength=n)
        # common / (a + b - common) >= 4 / 5, in whole numbers
        near = np.flatnonzero((9 * common >= 4 * (sizes + sizes[x])) & (label[:n] != label[x]))
        label = local_groups(len(label), np.full(len(near), x), near, label)
    return label


#: Longs in a table that may be broadcast: 32 MB.
BROADCAST_LONGS = 4 << 20


def bounded(df: DataFrame, longs: int) -> DataFrame:
    """A side of a join, to be broadcast if it holds so few longs; larger ones are left to a shuffle."""
    return F.broadcast(df) if longs <= BROADCAST_LONGS else df


#: Shingles that pairs of blocks hold at a time: 256 MB, or this multiple of what is in large groups.
PASS_SHINGLES = 32 << 20


def near_links(members: DataFrame, block: int = BLOCK, pass_shingles: int = PASS_SHINGLES) -> DataFrame:
    """Links (u, v) that span the parts of each group that chains of pairs at 0.8 connect.

    members: (member, group, shingles), stored; each member once.
    """
    schema = "u long, v long"
    weight = F.greatest(F.size("shingles"), F.lit(1)).cast("long")
    sizes = stored(members.groupBy("group").agg(F.sum(weight).alias("weight"), F.min("member").alias("pivot")), "group-sizes")
    large = sizes.where(F.col("weight") > block)
    many = large.count()
    light = sizes.where(F.col("weight") <= block).agg(F.sum("weight")).first()[0] or 0

    def sets_of(table: pa.Table) -> list[np.ndarray]:
        lists = table.column("shingles").combine_chunks()
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    def small(bucket: pa.Table) -> pa.Table:
        bucket = bucket.take(pa.array(np.argsort(bucket.column("group").to_numpy(), kind="stable")))
        member, group, sets = bucket.column("member").to_numpy(), bucket.column("group").to_numpy(), sets_of(bucket)
        starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        u, v = [], []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            label = near_sets(sets[a:b], np.arange(b - a), np.arange(b - a), 0)
            linked = np.flatnonzero(label != np.arange(b - a))
            u.append(member[a + linked])
            v.append(member[a + label[linked]])
        return pa.table({"u": np.concatenate(u), "v": np.concatenate(v)})

    buckets = 1 + light * 8 // block
    each = members.join(bounded(large.select("group"), many), "group", "left_anti") if many else members
    each = each.withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    links = each.groupBy("bucket").applyInArrow(small, schema)
    if not many:
        return links

    wide = members.join(bounded(large, 3 * many), "group")
    pivots = wide.where("member = pivot").select("group", F.col("shingles").alias("model"))
    common = F.size(F.array_intersect("shingles", "model"))
    near = 9 * common >= 4 * (F.size("shingles") + F.size("model"))
    pivots = stored(pivots, "pivots")
    wide = wide.join(bounded(pivots, pivots.agg(F.sum(F.size("model") + 3)).first()[0]), "group").withColumn("near", near).drop("model")
    wide = stored(wide, "large-groups")
    links = links.unionByName(wide.where("near AND member <> pivot").select(F.col("member").alias("u"), F.col("pivot").alias("v")))
    loose = wide.where("NOT near")
    blocks = loose.groupBy("group").agg(F.sum(weight).alias("loose_weight"))
    blocks = blocks.join(large.select("group", "weight"), "group").withColumns({"loose_blocks": F.ceil(F.col("loose_weight") / block), "all_blocks": F.ceil(F.col("weight") / block)})
    blocks = stored(blocks, "blocks")
    deals = F.col("loose_weight") * F.col("all_blocks") + F.col("weight") * F.col("loose_blocks")
    total = blocks.agg(F.sum(deals).alias("dealt"), F.sum("weight").alias("weight"), F.max("loose_blocks").alias("most")).first()
    if total["dealt"] is None:
        return links
    passes = min(total["most"], math.ceil(total["dealt"] / max(pass_shingles, PASS_SHARE * total["weight"])))
    blocks = blocks.select("group", "loose_blocks", "all_blocks")
    dealt = F.xxhash64("member")
    row, column = F.pmod(dealt, F.col("loose_blocks")), F.pmod(dealt, F.col("all_blocks"))
    kept = ["group", "member", "pivot", "near", "shingles"]
    few = bounded(blocks, 3 * many)
    rows = loose.join(few, "group").withColumn("row", row)
    rows = rows.select(*kept, "row", F.explode(F.expr("sequence(0, all_blocks - 1)")).alias("column"), F.lit(True).alias("asked"))
    columns = wide.join(few, "group").withColumn("column", column)
    columns = columns.select(*kept, F.explode(F.expr("sequence(0, loose_blocks - 1)")).alias("row"), "column", F.lit(False).alias("asked"))

    def large_pair(block: pa.Table) -> pa.Table:
        member, pivot = block.column("member").to_numpy(), block.column("pivot")[0].as_py()
        near, asked = (block.column(c).to_numpy() for c in ("near", "asked"))
        n = len(member)
        # One more member stands for the pivot, and what is near it is in its group. Who is asked may
        # be among the others too.
        label = np.where(np.append(near, True), n, np.arange(n + 1))
        label[label == n] = np.flatnonzero(label == n)[0]
        label = near_sets(sets_of(block), label, np.flatnonzero(asked), n)
        names = np.append(member, pivot)
        linked = np.flatnonzero(label != np.arange(n + 1))
        return pa.table({"u": names[linked], "v": names[label[linked]]})

    dealt = rows.unionByName(columns)
    if passes <= 1:
        return links.unionByName(dealt.groupBy("group", "row", "column").applyInArrow(large_pair, schema))
    return links.unionByName(
        in_passes(passes, lambda k: dealt.where(F.col("row") % passes == k).groupBy("group", "row", "column").applyInArrow(large_pair, schema))
    )


def drop_near_copies(docs: DataFrame, words_in_shingle: int = 5) -> DataFrame:
    """One document of each group at a similarity of 0.8: the one with the smallest id.

    Groups are what chains of pairs with a Jaccard similarity of at least 0.8 connect. Of equal ids,
    that with the smallest digest stays.
    """
    free_shuffles(docs.sparkSession)
    rows = fingerprints(docs, words_in_shingle, WIDE_PARTS, repeats=False, digest=True)
    texts = stored(rows.groupBy("digest", "fp", "wide", "shingles").agg(F.min("doc_id").alias("doc_id")), "simhash")
    found = stored(candidate_groups(texts).select("doc_id", "digest", "group"), "candidates")
    free_shuffles(docs.sparkSession)
    sets = shingle_sets(keep_rows(docs, found.select("doc_id", "digest")), words_in_shingle)
    members = sets.join(found, "digest").withColumn("member", F.monotonically_increasing_id())
    members = stored(members, "shingles")
    free_shuffles(docs.sparkSession)
    roots = components(near_links(members.select("member", "group", "shingles")))
    linked = members.select("doc_id", "digest", F.col("member").alias("node")).join(roots, "node")
    linked = stored(linked.select("doc_id", "digest", "root"), "near-copies")
    free_shuffles(docs.sparkSession)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    firsts = linked.groupBy("root").agg(F.min(first).alias("first")).select("first.doc_id", "first.digest")
    alone = texts.join(linked.select("digest"), "digest", "left_anti")
    return keep_rows(docs, alone.select("doc_id", "digest").unionByName(firsts))


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = stored(fingerprints(table(spark, sf_dir, "documents")), "simhash")
    return near_groups(rows).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
