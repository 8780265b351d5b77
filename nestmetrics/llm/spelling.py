"""Spelling variant grouping by FM-index search schemes.

Two words are near if one insertion, deletion or replacement of a code point turns one into the other.
One error leaves one half of a word untouched, so two searches find all near words: one matches the first
half exactly and extends to the right with one error, the other matches the second half exactly and
extends to the left. Each runs on an FM-index over the delimited, sorted vocabulary: the text itself for
extensions to the left, the reversed words for extensions to the right. A search state is an interval of
suffix ranks; a whole word between two delimiters ends as an interval of word numbers.

The vocabulary is dealt out by halves: a word is looked for under its own half, and listed under the
halves that words of its length and of one more or less are looked for under, so a search
finds all its words in one shard. Shards hold ``SHARD`` listings on average. A half with more listings than
``HOT`` gets shards of its own: its listings are dealt among them, its searches run in each. A shard returns
one row for each word searched: the number of near words and the most frequent one. No pairs leave a shard.

Words follow their forms to the last by pointer doubling. A form occurs ten times as often as
the word, so a chain has fewer steps than a long integer has digits, and five rounds do.

Defined cases: words are compared by code points. Null, empty and repeated words take no part in
``variants`` (its counts are summed by word before). A null text has no words, a null doc_id counts as empty in
the hash. Very long words are searched like any other. Ties of frequency go to the smallest word in
code-point order. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import ascii_lower, col, ship_code, stored, table, text_of

SHARD = 100_000
HOT = 200_000
#: Code points of the words searched at a time.
BATCH = 60_000
#: How much more often a form occurs than the words that point to it.
FACTOR = 10
LEFT, RIGHT = 0, 1


class FMIndex:
    """Intervals of suffix ranks over sorted words between delimiters.

    Delimiters are ordered by their place, so the delimiter before the nth word has rank n. Ranks of a
    letter are kept as counts every 64 suffixes and a bit mask for those between.
    """

    def __init__(self, words: list[str]):
        n = len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.letters = np.unique(points)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        text = np.zeros((int(ends[-1]) if n else 0) + 1, dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[0] = inside[ends] = False
        text[inside] = np.searchsorted(self.letters, points) + 1
        self.words = n
        suffixes = _suffix_order(text, n)
        before = text[suffixes - 1]
        # One column for each letter, one for letters that are not there. The first suffix has nothing before it.
        self.width = len(self.letters) + 2
        blocks = len(text) // 64 + 1
        at = np.arange(1, len(text))
        cell = (at >> 6) * self.width + before[1:]
        masks = np.zeros(blocks * self.width, dtype=np.uint64)
        np.bitwise_or.at(masks, cell, np.uint64(1) << (at & 63).astype(np.uint64))
        self.masks = masks.reshape(blocks, self.width)
        counts = np.bincount(cell, minlength=blocks * self.width).reshape(blocks, self.width)
        self.counts = np.cumsum(counts, axis=0) - counts
        totals = np.bincount(text, minlength=self.width)
        self.first = np.cumsum(totals) - totals
        self.first[0] = 0

    def codes(self, words: list[str], size: int) -> np.ndarray:
        """word x place: letters as numbers, 0 (the delimiter) behind the end."""
        out = np.zeros((len(words), size), dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        found = np.searchsorted(self.letters, points)
        known = np.zeros(len(points), dtype=bool)
        known[found < len(self.letters)] = self.letters[found[found < len(self.letters)]] == points[found < len(self.letters)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out[np.arange(size) < lengths[:, None]] = np.where(known, found + 1, self.width - 1)
        return out

    def rank(self, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the letter stands before the first suffixes."""
        block, below = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[block, letter] + np.bitwise_count(self.masks[block, letter] & below)

    def extend(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with the letter put in front."""
        return self.first[letter] + self.rank(letter, low), self.first[letter] + self.rank(letter, high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, letter, low, high) of every letter that stands before some suffix of each interval."""
        def ranks(at):
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            return self.counts[at >> 6] + np.bitwise_count(self.masks[at >> 6] & below[:, None])

        lows, highs = ranks(low), ranks(high)
        which, letter = np.nonzero(highs[:, 1:-1] > lows[:, 1:-1])
        letter += 1
        return which, letter, self.first[letter] + lows[which, letter], self.first[letter] + highs[which, letter]


def _suffix_order(text: np.ndarray, words: int) -> np.ndarray:
    """Suffixes by rank, by doubling: as many rounds as the longest word's length has bits."""
    rank = text + words
    marks = np.flatnonzero(text == 0)
    rank[marks] = np.arange(len(marks))
    reach, size = 1, len(text)
    while True:
        key = rank * (size + words + 2)
        key[: size - reach] += rank[reach:] + 1
        order = np.argsort(key)
        changes = np.diff(key[order]) > 0
        if changes.all():
            return order
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(changes)))
        reach *= 2


def near_words(index: FMIndex, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word number) of all words whose last ``exact`` letters are the query's and that differ from it
    by one error before them; each once.

    Queries are read from the right. An error in a run of equal letters is made behind the run's last letter
    in that direction, so that each word is reached in one way.
    """
    lengths = np.fromiter(map(len, queries), np.int64, len(queries))
    size = int(lengths.max()) + 2
    read = index.codes([q[::-1] for q in queries], size)
    low, high = np.zeros(len(queries), np.int64), np.full(len(queries), index.words + 1)
    for at in range(int(exact.max())):
        some = np.flatnonzero((at < exact) & (low < high))
        low[some], high[some] = index.extend(read[some, at], low[some], high[some])
    pending: list[tuple[np.ndarray, ...]] = []
    at = exact.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        letter = read[live, at[live]]
        # Delete the query's letter.
        cut = live[(letter > 0) & (letter != read[live, at[live] + 1])]
        pending.append((cut, at[cut] + 1, low[cut], high[cut]))
        # Another letter instead of the query's, or before it. Queries in one state share its children.
        _, firsts, state = np.unique(low[live] * (len(index.masks) * 64 + 1) + high[live], return_index=True, return_inverse=True)
        which, child, child_low, child_high = index.children(low[live[firsts]], high[live[firsts]])
        begins = np.searchsorted(which, np.arange(len(firsts) + 1))
        numbers = (begins[1:] - begins[:-1])[state]
        mine = np.repeat(np.arange(len(live)), numbers)
        entry = np.arange(len(mine)) - np.repeat(np.cumsum(numbers) - numbers, numbers) + begins[state[mine]]
        other = child[entry] != letter[mine]
        mine, entry = mine[other], entry[other]
        query = live[mine]
        pending.append((query, at[query], child_low[entry], child_high[entry]))
        instead = letter[mine] > 0
        pending.append((query[instead], at[query[instead]] + 1, child_low[entry[instead]], child_high[entry[instead]]))
        # Go on without an error, up to the delimiter.
        live, letter = live[letter > 0], letter[letter > 0]
        low[live], high[live] = index.extend(letter, low[live], high[live])
        at[live] += 1
        live = live[low[live] < high[live]]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    query, at, low, high = (np.concatenate(x) for x in zip(*pending, strict=True)) if pending else [np.zeros(0, np.int64)] * 4
    while len(query):
        letter = read[query, at]
        low, high = index.extend(letter, low, high)
        some = low < high
        whole = some & (letter == 0)
        found.append((query[whole], low[whole]))  # words are different, so the interval is one word
        some &= letter > 0
        query, at, low, high = query[some], at[some] + 1, low[some], high[some]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    queries_found, words_found = (np.concatenate(x) for x in zip(*found, strict=True))
    return queries_found, words_found


def search_shard(side: int, listed: dict[str, int], asked: list[str]) -> list[tuple[str, int, int, str]]:
    """(word, near words found, most frequent one's count, that one) of the words asked for, if any.

    LEFT finds words that share the first half, RIGHT those that share the second half only.
    """
    turn = (lambda w: w[::-1]) if side == LEFT else (lambda w: w)
    words = sorted(map(turn, listed))
    if not words:
        return []
    index = FMIndex(words)
    plain = [turn(w) for w in words]
    counts = np.fromiter((listed[w] for w in plain), np.int64, len(plain))
    order = np.empty(len(plain), np.int64)
    order[sorted(range(len(plain)), key=plain.__getitem__)] = np.arange(len(plain))
    asked = sorted(asked, key=len)
    out = []
    begin = 0
    while begin < len(asked):
        end = begin + 1
        while end < len(asked) and len(asked[end]) * (end + 1 - begin) <= BATCH:
            end += 1
        batch = asked[begin:end]
        begin = end
        lengths = np.fromiter(map(len, batch), np.int64, len(batch))
        exact = lengths // 2 if side == LEFT else lengths - lengths // 2
        query, word = near_words(index, [turn(w) for w in batch], exact)
        if side == RIGHT and len(query):  # those that share the first half too are found there
            new = [not plain[v].startswith(batch[q][: len(batch[q]) // 2]) for q, v in zip(query.tolist(), word.tolist(), strict=True)]
            query, word = query[new], word[new]
        best = np.lexsort((order[word], -counts[word], query))
        some, firsts, numbers = np.unique(query[best], return_index=True, return_counts=True)
        for q, v, n in zip(some.tolist(), word[best[firsts]].tolist(), numbers.tolist(), strict=True):
            out.append((batch[q], n, int(counts[v]), plain[v]))
    return out


def dealt(vocabulary: DataFrame) -> DataFrame:
    """Each word (word, n) in the shards of its halves: group, side, word, n, listed, asked."""
    length = F.length("word")
    # Lengths of the halves that a word is looked for under, and listed under besides.
    left, right = F.floor(length / 2), F.ceil(length / 2)
    odd = length % 2 == 1
    halves = [
        (LEFT, left, True), (LEFT, F.when(odd, left + 1).otherwise(left - 1), False),
        (RIGHT, right, True), (RIGHT, F.when(odd, right - 1).otherwise(right + 1), False),
    ]

    def half(side: int, size: Column, asked: bool) -> Column:
        part = F.substring("word", F.lit(1), size) if side == LEFT else F.substring("word", length - size + 1, size)
        return F.struct(F.lit(side).alias("side"), F.xxhash64(F.lit(side), part).alias("key"), F.lit(asked).alias("asked"))

    entries = vocabulary.select("word", "n", F.explode(F.array(*(half(s, k.cast("int"), a) for s, k, a in halves))).alias("e")).select("word", "n", "e.*")
    shards = max(1, 4 * vocabulary.count() // SHARD)
    hot = entries.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > HOT)
    hot = stored(hot.select("key", F.ceil(F.col("rows") / HOT).cast("int").alias("parts")), "hot-halves")
    if hot.isEmpty():
        marked = entries.withColumn("parts", F.lit(0))
    else:
        marked = entries.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(0)))
    own = F.pmod(F.xxhash64("word"), F.greatest("parts", F.lit(1))).cast("int")
    every = F.when(F.col("asked") & (F.col("parts") > 0), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    spread = marked.withColumn("own", own).select("*", F.explode(every).alias("part"))
    group = F.when(F.col("parts") > 0, F.concat_ws("/", "side", "key", "part")).otherwise(F.concat_ws("/", "side", F.pmod("key", F.lit(shards))))
    return spread.select(group.alias("group"), "side", "word", "n", (F.col("part") == F.col("own")).alias("listed"), "asked")


def variants(vocabulary: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of a vocabulary (word, n); see the module's text."""
    if factor < 2:
        raise ValueError("a form occurs at least twice as often as its word")
    ship_code(vocabulary.sparkSession)
    vocabulary = stored(vocabulary.where("word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "vocabulary")

    def run(rows: pa.Table) -> pa.Table:
        words, counts = rows.column("word").to_pylist(), rows.column("n").to_pylist()
        listed = {w: n for w, n, yes in zip(words, counts, rows.column("listed").to_pylist(), strict=True) if yes}
        asked = sorted({w for w, yes in zip(words, rows.column("asked").to_pylist(), strict=True) if yes})
        found = search_shard(rows.column("side")[0].as_py(), listed, asked)
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["word", "n_near", "near_n", "near"])

    found = dealt(vocabulary).groupBy("group").applyInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= factor * F.col("n")
    rows = vocabulary.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    rows = stored(rows, "forms")
    roots = _last_forms(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _last_forms(links: DataFrame) -> DataFrame:
    """Where each link (word, root) leads in the end: every round doubles the steps that a link spans."""
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def noisy_words(docs: DataFrame, least: int, noise: int) -> DataFrame:
    """The words of all texts, one code point deleted where ``noise`` divides the hash of id and word.

    Runs shorter than the least length can only get shorter, so they are not looked at.
    """
    run = F.explode(F.regexp_extract_all(ascii_lower(text_of(docs)), F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0)))
    id_ = F.coalesce(col(docs, "doc_id").cast("string"), F.lit(""))
    runs = docs.select(id_.alias("id"), run.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of all documents, of seven letters or more and found twice or more."""
    words = noisy_words(table(spark, sf_dir, "documents"), 7, 31)
    return variants(words.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2"))


_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b))"
OP13_SQL = f"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), hashed AS (
  SELECT run, xor(list_reduce(
      flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
        THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)),
      lambda h, b: xor(h >> 8, t[xor(h & 255, b) + 1]), 4294967295), 4294967295) AS h
  FROM runs, crc WHERE length(run) >= 7
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed
), vocabulary AS MATERIALIZED (
  SELECT word, count(*) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), holes AS MATERIALIZED (
  SELECT DISTINCT word, n, place, left(word, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM vocabulary)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b USING (place, rest) WHERE a.word <> b.word
  UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocabulary v ON v.word = h.rest
  UNION SELECT h.rest, h.word, h.n FROM holes h JOIN vocabulary v ON v.word = h.rest
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS MATERIALIZED (
  SELECT word, CASE WHEN near_n >= {FACTOR} * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {FACTOR} * n THEN near_n END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)
), chains AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT c.word, c.next, f.form FROM c JOIN forms f ON f.word = c.next
  ) SELECT word, root FROM c WHERE next IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN chains USING (word)
"""
