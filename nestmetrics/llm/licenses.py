"""License scan by a positional index of rare words.

The words of every text are looked up in the words of the licence templates. A template matches where
its mandatory key phrase stands word for word; its score there is the share of all its words that stand
at their places relative to the phrase.

A file is only looked at closer if it has all words of some key phrase. For these files, each
template's phrase is represented by its rarest word (highest inverse document frequency, counted over
all files). That word's places propose places of the template; the other words' postings are
intersected with the proposals by relative position; the key phrase is verified by its words being
complete. A match contains the rarest word, so none is missed. Everything is DataFrame work: counts are
partial sums, and postings are keyed by file, template and place, so no key is hot. Only the templates'
own postings are broadcast; they have ``MAX_TEMPLATE_WORDS`` rows at most.

Defined cases: a null text is empty: no words, no places, empty labels, score 0. Repeated rows are
scanned as often as they occur. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import ascii_lower, col, stored, table, text_of

MAX_TEMPLATE_WORDS = 100_000
#: What separates words: all ASCII but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Share of a template's words from which the method adds its label.
LEAST_SCORE = 0.8

# Base phrases: (label, words).
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Templates of the method: (label, mandatory phrase, whole notice).
TEMPLATES = [
    ("gpl-3", "gnu general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2", "this work is licensed under the gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license", "licensed under the gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "licensed under the gnu affero general public license"),
    ("apache-2", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
]


def template_words() -> list[tuple]:
    """(template, label, base, word, place, mandatory, key_words, words) of base phrases and templates.

    Places count from the start of the mandatory phrase.
    """
    rows = []
    base = [(f"base:{label}", label, True, phrase, phrase) for label, phrase in BASE]
    more = [(f"{label}:{key}", label, False, key, notice) for label, key, notice in TEMPLATES]
    for name, label, is_base, key, notice in base + more:
        words, phrase = notice.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        rows.extend(
            (name, label, is_base, word, i - at, at <= i < at + len(phrase), len(phrase), len(words)) for i, word in enumerate(words)
        )
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words to broadcast")
    return rows


def split_words(text: Column) -> Column:
    """The words; a separator at an end leaves an empty one there."""
    return F.split(ascii_lower(text), SEPARATORS)


def scan(docs: DataFrame) -> DataFrame:
    """n_words, base places, labels and score of each row; see the module's text."""
    spark = docs.sparkSession
    rows = template_words()
    index = F.broadcast(spark.createDataFrame(rows, "template string, label string, base boolean, word string, place int, mandatory boolean, key_words int, words int"))
    keys: dict[str, set[str]] = {}
    for name, _, _, word, _, mandatory, _, _ in rows:
        if mandatory:
            keys.setdefault(name, set()).add(word)
    vocabulary = sorted(set().union(*keys.values()))
    listed = F.array(*map(F.lit, vocabulary))
    # A file that has all words of some key phrase; phrases that hold another's words add nothing.
    least = [k for k in {frozenset(x) for x in keys.values()} if not any(set(o) < k for o in keys.values())]

    words = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), split_words(text_of(docs)).alias("words"))
    empty_first = (F.col("words")[0] == "").cast("int")
    n = F.size("words")
    looked = words.select(
        "doc_id",
        (n - empty_first - F.when((n > 1) & (F.element_at("words", -1) == ""), 1).otherwise(0)).cast("long").alias("n_words"),
        F.array_intersect("words", listed).alias("present"),
        empty_first.alias("shift"),
        "words",
    )
    complete = F.lit(False)
    for k in sorted(map(sorted, least)):
        part = F.lit(True)
        for w in k:
            part = part & F.array_contains("present", w)
        complete = complete | part
    # Words are kept of the files to look at; the row number tells repeated rows apart.
    files = stored(
        looked.withColumn("words", F.when(complete, F.col("words"))).withColumn("file", F.monotonically_increasing_id()), "licence-files"
    )

    frequency = files.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("files"))
    order = {w: r for r, w in enumerate(x["word"] for x in frequency.orderBy("files", "word").limit(len(vocabulary)).collect())}
    rarest = {name: min(ws, key=lambda w: (order.get(w, -1), w)) for name, ws in keys.items()}
    anchors = F.broadcast(spark.createDataFrame([(name, word) for name, word in rarest.items()], "template string, anchor string"))

    postings = (
        files.where(F.col("words").isNotNull())
        .select("file", "shift", F.posexplode("words").alias("at", "word"))
        .select("file", (F.col("at") - F.col("shift")).alias("at"), "word")
    )
    hits = postings.join(index, "word").join(anchors, "template")
    hits = hits.select("file", "template", "label", "base", (F.col("at") - F.col("place")).alias("start"), "mandatory", "key_words", "words", ((F.col("word") == F.col("anchor")) & F.col("mandatory")).alias("proposes"))
    matches = (
        hits.groupBy("file", "template", "label", "base", "start", "key_words", "words")
        .agg(F.count("*").alias("found"), F.count_if("mandatory").alias("key_found"), F.max("proposes").alias("proposed"))
        .where("proposed AND key_found = key_words")
    )
    label = F.when(F.col("base") | (F.col("found") >= F.ceil(F.col("words") * LEAST_SCORE)), F.col("label"))
    by_file = matches.groupBy("file").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"),
        F.max(F.when(~F.col("base"), F.col("found") / F.col("words"))).alias("score"),
    )
    return files.select("file", "doc_id", "n_words").join(by_file, "file", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op9_licenses(spark, sf_dir: str) -> DataFrame:
    """Base phrases, labels and score of every document."""
    return scan(table(spark, sf_dir, "documents"))


def _sql_values() -> str:
    return ", ".join(f"('{t}', '{l}', {str(b).lower()}, '{w}', {p}, {str(m).lower()}, {k}, {n})" for t, l, b, w, p, m, k, n in template_words())


OP9_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS file, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), postings AS (
  SELECT file, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS at FROM split
), templates(template, label, base, word, place, mandatory, key_words, words) AS (VALUES {_sql_values()}
), matches AS (
  SELECT p.file, t.template, t.label, t.base, p.at - t.place AS start, t.words, count(*) AS found
  FROM postings p JOIN templates t USING (word)
  GROUP BY ALL HAVING count(*) FILTER (t.mandatory) = any_value(t.key_words)
), by_file AS (
  SELECT file, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR found >= ceil(words * {LEAST_SCORE})) AS labels,
    max(found / words) FILTER (NOT base) AS score
  FROM matches GROUP BY file
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM split LEFT JOIN by_file USING (file)
"""
