"""Exact removal of long byte strings that occur more than once, by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes, all places
alike. No task could sort the suffixes of a whole corpus, so the starts are dealt to small groups
first. Each start has an anchor: of the ``GRAM``-byte strings inside its window the one with the
smallest hash (the rightmost of equals). Equal windows have equal anchors at equal distances, so windows
can only be equal inside the group of one anchor's content. An anchor's starts are consecutive; the
stretch of text that their windows cover is a segment.

1. Each text gives its anchors, and each segment's digest, in one pass. Anchors whose content has one
   place only are done. A segment whose digest occurs twice is a repeat with all its bytes.
2. Where an anchor has several different segments, one of each goes to the anchor's group. All of a
   group's segments agree around the anchor; that common run becomes one symbol, and a suffix array
   (``suffix_array``) of the rest puts starts with equal windows side by side.
3. Groups of more than ``GROUP`` different segments would make long tasks. Their windows are counted
   by digest instead, one row a window, with partial sums: exact at any size.
4. The repeated stretches of a text are joined up and cut out.

Segments are told by two 64-bit hashes (anchor and segment), windows by 128 bits of BLAKE2. Ids and
digests together are the keys where texts move, so no key is hot; everything else that is shuffled is
a few numbers for each anchor, summed first.

Strings can also be counted in words (maximal runs of other bytes than ASCII white space) instead of
bytes: a text is then the sequence of its words' 64-bit hashes, and all of the above holds for these
symbols. A cut takes the words with the white space up to the next word.

Defined cases: null counts as empty. Texts shorter than the length stay, also when they are copies.
Repeated rows are copies. An empty table gives an empty result. Extra columns play no part. Where texts
are rewritten, parts of characters that a cut leaves are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import col, free_shuffles, releasing, ship_code, stored, table, text_of
from nestmetrics.llm.simhash import segments as word_lists
from nestmetrics.llm.suffix_array import suffix_array

LENGTH = 400
GRAM = 200
#: Different segments of one anchor that are sorted together.
GROUP = 1000
#: Starts in one step of the hashing; anchors' places fit the low bits.
BLOCK = 1 << 18
PLACE_BITS = np.uint64((1 << 20) - 1)
#: Odd multipliers and byte values of the rolling hash, from a fixed seed.
_RNG = np.random.default_rng(20240501)
BYTE_VALUES = _RNG.integers(1, 2**63, size=256, dtype=np.uint64)
MULTIPLIERS = _RNG.integers(1, 2**62, size=40, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def symbols_of(text: bytes, words: bool) -> np.ndarray:
    """What a text is a sequence of: its bytes, or 64-bit hashes of its words."""
    if not words:
        return np.frombuffer(text, dtype=np.uint8)
    hashed = [np.fromiter(map(xxhash.xxh64_intdigest, some), np.uint64, len(some)) for some in word_lists(text)]
    return np.concatenate(hashed) if hashed else np.zeros(0, dtype=np.uint64)


def gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each string of so many symbols, by doubling."""
    power, step, level = BYTE_VALUES[text] if text.dtype == np.uint8 else text, 1, 0
    whole, done = None, 0

    def joined(a, b, shift, k):
        return (a ^ (a >> np.uint64(29))) * MULTIPLIERS[k] + b[shift : shift + len(a)]

    while True:
        if size & step:
            if whole is None:
                whole, done = power, step
            else:
                whole = joined(whole[: len(text) - done - step + 1], power, done, 20 + level)
                done += step
        if done == size:
            break
        power = joined(power[: len(power) - step], power, step, level)
        step, level = step * 2, level + 1
    return (whole ^ (whole >> np.uint64(32))) * MULTIPLIERS[-1]


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    step = 1
    while step * 2 <= size:
        values = np.minimum(values[: len(values) - step], values[step:])
        step *= 2
    rest = size - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(first start, number of starts, anchor's distance from the first, anchor's hash), by blocks."""
    for base in range(0, len(text) - length + 1, BLOCK):
        part = text[base : base + BLOCK + length - 1]
        hashes = gram_hashes(part, gram)
        packed = (hashes & ~PLACE_BITS) | (PLACE_BITS - np.arange(len(hashes), dtype=np.uint64))
        least = sliding_least(packed, length - gram + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        place = (PLACE_BITS - (least[first] & PLACE_BITS)).astype(np.int64)
        yield first + base, np.diff(np.append(first, len(least))), place - first, hashes[place].view(np.int64)


def text_key(text: bytes) -> tuple[int, int]:
    digest = hashlib.sha256(text).digest()
    return int.from_bytes(digest[:8], signed=True), int.from_bytes(digest[8:16], signed=True)


def scanned(docs: DataFrame, length: int, gram: int, words: bool = False) -> DataFrame:
    """Each row's id, text key, own repeats and anchors.

    An anchor is packed as start, number of starts and distance (p), with the hashes of its string (h)
    and of its segment (g). Of equal segments of one text, as periodic text has in thousands, one is
    listed, with two places (w); all of them are the text's own repeats.
    """
    schema = "doc_id long, k1 long, k2 long, own array<struct<b:long,e:long>>, at array<struct<p:long,h:long,g:long,w:long>>"
    anchor = pa.struct([(c, pa.int64()) for c in "phgw"])
    stretch = pa.struct([(c, pa.int64()) for c in "be"])

    def lists(counts, parts, kind):
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] or [[]] * kind.num_fields
        flat = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, own_counts, counts, own, parts = [], [], [], [], []
            for value in batch.column(1):
                text = value.as_py()
                keys.append(text_key(text))
                symbols = symbols_of(text, words)
                found = list(anchors(symbols, length, gram))
                first, n, away, hashes = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, dtype=np.int64)] * 4
                digests = b"".join([
                    hashlib.blake2b(symbols[l : l + m], digest_size=8).digest()
                    for l, m in zip(first.tolist(), (n + length - 1).tolist(), strict=True)
                ])
                segment = np.frombuffer(digests, dtype="<i8")
                _, one, group, times = np.unique(segment, return_index=True, return_inverse=True, return_counts=True)
                again = times[group] > 1
                own.append((first[again], (first + n + length - 1)[again]))
                own_counts.append(int(again.sum()))
                parts.append(((first << 24 | n << 12 | away)[one], hashes[one], segment[one], np.minimum(times, 2)))
                counts.append(len(one))
            pairs = np.array(keys, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), lists(own_counts, own, stretch), lists(counts, parts, anchor)],
                names=["doc_id", "k1", "k2", "own", "at"],
            )

    if length - gram >= 1 << 12:
        raise ValueError("the strings must be at most 4095 symbols longer than their anchors")
    ship_code(docs.sparkSession)
    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def common_prefix(a: Sequence[int], b: Sequence[int]) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # equal up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def repeated_starts(segments: list[Sequence[int]], distances: list[int], length: int) -> list[np.ndarray]:
    """For each of the different segments around one anchor, which of its starts have equals.

    A start counts if its window also starts in another segment of the group.
    """
    left = [s[:a][::-1] for s, a in zip(segments, distances, strict=True)]
    right = [s[a:] for s, a in zip(segments, distances, strict=True)]
    # What all share around the anchor: that of the first and the last in order.
    before = common_prefix(min(left), max(left))
    after = common_prefix(min(right), max(right))
    run = before + after
    if not after:
        return [np.zeros(len(s) - length + 1, dtype=bool) for s in segments]
    # Text of symbols above 2; 2 is the common run, 1 ends a segment, 0 ends the text.
    symbols: list[int] = []
    heads: list[int] = []  # where a segment's run stands
    for l, r in zip(left, right, strict=True):
        symbols.extend(b + 3 for b in reversed(l[before:]))
        heads.append(len(symbols))
        symbols.append(2)
        symbols.extend(b + 3 for b in r[after:])
        symbols.append(1)
    symbols.append(0)
    order = suffix_array(symbols)
    place = [0] * len(order)
    for at, i in enumerate(order):
        place[i] = at
    line = "".join(map(chr, symbols))
    marks = []
    owner = {head: k for k, head in enumerate(heads)}
    runs = sorted(owner, key=place.__getitem__)  # suffixes that start with the run stand together
    # What a segment's right side shares at most with another's, beyond the run.
    beyond = [0] * len(segments)
    for x, y in zip(runs, runs[1:]):
        i, j = owner[x], owner[y]
        shared = common_prefix(right[i][after:], right[j][after:])
        beyond[i], beyond[j] = max(beyond[i], shared), max(beyond[j], shared)
    for k, (segment, distance) in enumerate(zip(segments, distances, strict=True)):
        starts = len(segment) - length + 1
        found = np.zeros(starts, dtype=bool)
        outside = min(starts, distance - before)  # starts left of the common run
        for i in range(outside):
            at = heads[k] - (distance - before - i)
            need = distance - before - i + 1 + max(0, length - (distance - before - i) - run)
            window = line[at : at + need]
            rank = place[at]
            for other in (rank - 1, rank + 1):
                if 0 <= other < len(order) and line.startswith(window, order[other]):
                    found[i] = True
                    break
        # A start inside the run needs what of its window lies beyond the run.
        inside = np.arange(max(0, distance - before), starts)
        found[inside] = inside + length - (distance + after) <= beyond[k]
        marks.append(found)
    return marks


def stretches(marks: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (first, past the last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _long_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def numbered(segments: list[bytes]) -> list[list[int]]:
    """Segments of hashed words as small numbers, equal for equal words."""
    hashes = [np.frombuffer(s, dtype=np.uint64) for s in segments]
    numbers = np.unique(np.concatenate(hashes), return_inverse=True)[1]
    return [part.tolist() for part in np.split(numbers, np.cumsum([len(h) for h in hashes])[:-1])]


def _sorted_groups(length: int, words: bool):
    """Rows (h, g, file, l, a, segment) sorted by h to repeated stretches (file, b, e)."""

    def solve(rows: dict[int, tuple]) -> Iterator[tuple]:
        if len(rows) > 1:
            group = list(rows.values())
            segments = [x[3] for x in group]
            marks = repeated_starts(numbered(segments) if words else segments, [x[2] for x in group], length)
            for (file, l, _, _), found in zip(group, marks, strict=True):
                for b, e in stretches(found):
                    yield file, l + b, l + e - 1 + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, rows = None, {}
        for part in batches:
            found = []
            for h, g, *rest in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if h != anchor:
                    found.extend(solve(rows))
                    anchor, rows = h, {}
                rows[g] = rest
            yield _long_batch(found, ["file", "b", "e"])
        yield _long_batch(list(solve(rows)), ["file", "b", "e"])

    return run


def _segments_of(length: int, words: bool):
    """Texts with wanted anchors (file, text, want) to (h, g, file, l, a, segment)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "g", "file", "l", "a", "segment"]
        for batch in batches:
            rows = []
            for file, text, want in zip(*batch.columns, strict=True):
                file, symbols = file.as_py(), symbols_of(text.as_py(), words)
                for w in want.as_py():
                    l, n, a = w["p"] >> 24, w["p"] >> 12 & 4095, w["p"] & 4095
                    rows.append((w["h"], w["g"], file, l, a, symbols[l : l + n + length - 1].tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.binary())], names=names)

    return run


def _windows(length: int, words: bool):
    """Segments to a row for each window: its digest and its place."""
    width = 8 if words else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, l, segment in zip(*(batch.column(c).to_pylist() for c in ("file", "l", "segment")), strict=True):
                for i in range(len(segment) // width - length + 1):
                    digest = hashlib.blake2b(segment[i * width : (i + length) * width], digest_size=16).digest()
                    rows.append((int.from_bytes(digest[:8], signed=True), int.from_bytes(digest[8:], signed=True), file, l + i))
            yield _long_batch(rows, ["w1", "w2", "file", "b"])

    return run


def repeated_stretches(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, words: bool = False) -> DataFrame:
    """doc_id, k1, k2 and cuts (sorted [b, e) of the bytes, or words, to go) of each row that has any."""
    rows = stored(scanned(docs, length, gram, words).withColumn("file", F.monotonically_increasing_id()), "anchors")
    flat = rows.select("file", F.explode("at").alias("x")).select("file", "x.*")
    # Anchors whose string stands in more than one place, and their segments.
    shared = flat.groupBy("h").agg(F.sum("w").alias("n")).where("n > 1").select("h")
    places = stored(flat.hint("merge").join(shared.hint("merge"), "h", "left_semi"), "places")
    segments = stored(places.groupBy("h", "g").agg(F.sum("w").alias("n"), F.min(F.struct("file", "p")).alias("one")), "segments")
    begin, starts = F.shiftright("p", 24), F.shiftright("p", 12).bitwiseAND(F.lit(4095))
    whole = places.join(segments.where("n > 1").select("h", "g").hint("merge"), ["h", "g"], "left_semi").select(
        "file", begin.alias("b"), (begin + starts + length - 1).alias("e")
    )
    # One of each different segment of the anchors that have several.
    sizes = segments.groupBy("h").agg(F.count("*").alias("different")).where("different > 1")
    mixed = segments.join(sizes.hint("merge"), "h").select("one.file", "one.p", "h", "g", "different")
    want = mixed.groupBy("file").agg(F.collect_list(F.struct("p", "h", "g", "different")).alias("want"))
    ids = rows.select("file", "doc_id", "k1", "k2")
    want = stored(want.join(ids, "file"), "wanted")
    some, _ = split_by_key(id_and_text(docs), want)
    chosen = joined_by_key(some, want, "inner").select("file", "text", "want")
    shape = "h long, g long, file long, l long, a long, segment binary"
    small = F.filter("want", lambda w: w["different"] <= group)
    pieces = chosen.withColumn("want", small).where(F.size("want") > 0).mapInArrow(_segments_of(length, words), shape)
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = pieces.repartition(spread, "h").sortWithinPartitions("h")
    cuts = whole.unionByName(sorted_.mapInArrow(_sorted_groups(length, words), "file long, b long, e long"))
    cuts = cuts.unionByName(rows.select("file", F.explode("own").alias("x")).select("file", "x.*"))
    if not sizes.where(F.col("different") > group).isEmpty():
        large = F.filter("want", lambda w: w["different"] > group)
        pieces = chosen.withColumn("want", large).where(F.size("want") > 0).mapInArrow(_segments_of(length, words), shape)
        windows = stored(pieces.mapInArrow(_windows(length, words), "w1 long, w2 long, file long, b long"), "windows")
        again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1")
        same = windows.join(again.hint("merge"), ["w1", "w2"], "left_semi")
        cuts = cuts.unionByName(same.select("file", "b", (F.col("b") + length).alias("e")))
    listed = cuts.groupBy("file").agg(F.array_sort(F.collect_set(F.struct("b", "e"))).alias("cuts"))
    listed = listed.join(ids, "file").select("doc_id", "k1", "k2", "cuts")
    return stored(listed.dropDuplicates(["doc_id", "k1", "k2"]), "cuts")


def keyed(df: DataFrame, doc_id, text) -> DataFrame:
    """The frame with doc_id, k1 and k2, the id and the text's key as ``text_key`` gives it."""
    digest = F.sha2(text.cast("binary"), 256)
    k1, k2 = (F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17))
    return df.withColumns({"doc_id": doc_id.cast("long"), "k1": k1, "k2": k2})


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id, text in bytes, k1, k2."""
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return keyed(rows, F.col("doc_id"), F.col("text"))


#: Bits of the map of keys that says which texts need not be shuffled: 8 MB at any input size.
KEY_BITS = 1 << 26


def split_by_key(texts: DataFrame, facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts that may have facts (keyed by k1), and those that surely have none.

    The facts' keys mark bits of a map of fixed size, which is broadcast. A bit that other keys mark too
    costs a shuffle of one text, never a fact.
    """
    slot = F.pmod("k1", F.lit(KEY_BITS)) + 1
    bits = facts.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    marked = texts.withColumns({"bucket": F.bitmap_bucket_number(slot), "bit": F.bitmap_bit_position(slot)})
    marked = marked.join(F.broadcast(stored(bits, "key-bits")), "bucket", "left")
    octet = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.expr("shiftright(octet, cast(bit % 8 as int)) & 1") == 1, F.lit(False))
    marked = marked.withColumn("octet", octet).withColumn("is_set", is_set).drop("bucket", "bits", "bit", "octet")
    return marked.where("is_set").drop("is_set"), marked.where("NOT is_set").drop("is_set")


def with_cuts(texts: DataFrame, cuts: DataFrame) -> DataFrame:
    """All texts with their cuts or null; those without stay where they are."""
    some, none = split_by_key(texts, cuts)
    return joined_by_key(some, cuts, "left").unionByName(none.withColumn("cuts", F.lit(None).cast(cuts.schema["cuts"].dataType)))


def joined_by_key(texts: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """Texts with what is known of them, by id and key; the facts are hashed, so texts are not sorted."""
    facts = facts.withColumnsRenamed({"doc_id": "fact_id", "k1": "fact_k1", "k2": "fact_k2"}).hint("shuffle_hash")
    same = texts["doc_id"].eqNullSafe(facts["fact_id"]) & (texts["k1"] == facts["fact_k1"]) & (texts["k2"] == facts["fact_k2"])
    return texts.join(facts, same, how).drop("fact_id", "fact_k1", "fact_k2")


def kept_bytes(text: bytes, cuts: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left, how many bytes went, and in how many runs."""
    kept, at, removed, runs, open_to = [], 0, 0, 0, -1
    for cut in cuts or ():
        b, e = cut["b"], cut["e"]
        if b > open_to:
            runs += 1
            kept.append(text[at:b])
        removed += max(0, e - max(b, at))
        at = open_to = max(open_to, e)
    kept.append(text[at:])
    return b"".join(kept), removed, runs


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, cuts in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_py()
                kept, removed, runs = kept_bytes(text, cuts.as_py())
                rows.append((len(text), removed, runs, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = with_cuts(id_and_text(docs), repeated_stretches(docs, length))
    return found.select("doc_id", "text", "cuts").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


#: Texts rewritten at a time.
SLICE = 256


def in_bytes(text: bytes, cuts: list[dict]) -> list[dict]:
    """Cuts of words as cuts of bytes, each up to the next word."""
    starts = [word.start() for word in re.finditer(rb"\S+", text)] + [len(text)]
    return [{"b": starts[cut["b"]], "e": starts[cut["e"]]} for cut in cuts]


def cut_repeats(docs: DataFrame, length: int = LENGTH, words: bool = False) -> DataFrame:
    """The documents without their repeated stretches; n_chars, where there is one, follows.

    The length is in bytes, or in words; the anchors of words are a third as long.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    lower = [c.lower() for c in docs.columns]
    text_at, size_at = lower.index("text"), lower.index("n_chars") if "n_chars" in lower else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, len(b), SLICE)):
            columns = list(batch.columns[:-1])
            texts = columns[text_at].to_pylist()
            sizes = columns[size_at].to_pylist() if size_at is not None else []
            for i, cuts in enumerate(batch.columns[-1].to_pylist()):
                if cuts:
                    text = texts[i].encode()
                    texts[i] = kept_bytes(text, in_bytes(text, cuts) if words else cuts)[0].decode("utf-8", "ignore")
                    if sizes:
                        sizes[i] = len(texts[i])
            columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
            if sizes:
                columns[size_at] = pa.array(sizes, batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    plain = docs.toDF(*names)
    texts = keyed(plain, F.col(names[lower.index("doc_id")]), text_of(plain, names[text_at]))
    free_shuffles(docs.sparkSession)
    cuts = repeated_stretches(docs, length, max(1, length // 3) if words else GRAM, words=words)
    free_shuffles(docs.sparkSession)
    found = with_cuts(texts, cuts)
    return found.select(*names, "cuts").mapInArrow(releasing(run), plain.schema).toDF(*docs.columns)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What goes and stays of every document."""
    return removal_report(table(spark, sf_dir, "documents"))
