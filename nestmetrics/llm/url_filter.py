"""URL filter: a memory-mapped sorted array of 64-bit digests, probed by vectorised binary search.

A rule is (host, path, verdict). It fits its host and all subdomains where the url's path starts
with the rule's path; the longest fitting rule wins, of equally long ones that of the longer host.

The rules' keys (host + path) are hashed with XXH64 and kept as one sorted array beside their
strings. Each executor gets one copy of that index as files and maps it into memory, so its workers
share the pages. A batch of urls becomes one array of candidate digests, looked up with one binary
search; every hit is confirmed against the stored string. Candidates are only made for the
(host length, path length) pairs that some rule has, so odd urls with thousands of labels stay cheap.

The index goes to every executor only while it is small (``MAX_INDEXED_RULES``, checked by a count).
A longer list is joined: candidate keys are shuffled to the rules by key.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule. Rules
with a null or empty host or an unknown verdict are refused; a null path counts as empty. Of rules
with one key, block wins. Extra columns of the input stay where they are.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from nestmetrics.llm.common import ascii_lower, col, ship_code, table, write_bytes
from nestmetrics.session import scratch_path

# Longest rule list that is copied to the executors: about 60 bytes a rule.
MAX_INDEXED_RULES = 1_000_000
VERDICTS = ("allow", "block")
RULE_SCHEMA = "host string, path string, verdict string"

# The list the registered query judges by.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.coalesce(F.substring_index(_after_scheme(url), "#", 1), F.lit(""))
    return ascii_lower(F.substring_index(F.substring_index(rest, "?", 1), "/", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = F.coalesce(F.substring_index(F.substring_index(_after_scheme(url), "#", 1), "?", 1), F.lit(""))
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substr(rest, slash)).otherwise("")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def checked_rules(spark, rules: DataFrame | Iterable[tuple]) -> DataFrame:
    """Rules as (host, path, verdict), one per key; raises on rules that mean nothing."""
    df = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), RULE_SCHEMA)
    df = df.select(
        ascii_lower(col(df, "host")).alias("host"),
        F.coalesce(col(df, "path"), F.lit("")).alias("path"),
        col(df, "verdict").alias("verdict"),
    )
    wrong = df.where(
        F.col("host").isNull()
        | (F.col("host") == "")
        | F.col("host").contains("/")
        | ~(F.col("path").startswith("/") | (F.col("path") == ""))
        | ~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))
    )
    if first := wrong.limit(1).collect():
        raise ValueError(f"not a rule: {first[0]}")
    return df.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


class RuleIndex:
    """Sorted digests with their rules' strings, in files that are mapped into memory."""

    ARRAYS = ("digests", "starts", "host_lengths", "verdicts", "blob")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        ends = self.starts[1:] - self.starts[:-1]
        pairs = np.unique(np.stack([self.host_lengths, ends - self.host_lengths], axis=1), axis=0)
        #: Path lengths by host length, in bytes.
        self.shapes: dict[int, list[int]] = {}
        for host, path in pairs.tolist():
            self.shapes.setdefault(host, []).append(path)

    @staticmethod
    def arrays(rules: Iterable[tuple[str, str, str]]) -> dict[str, np.ndarray]:
        keyed = sorted((xxhash.xxh64_intdigest(k := (h + p).encode()), k, len(h.encode()), VERDICTS.index(v)) for h, p, v in rules)
        return {
            "digests": np.array([x[0] for x in keyed], dtype=np.uint64),
            "starts": np.cumsum([0, *(len(x[1]) for x in keyed)], dtype=np.int64),
            "host_lengths": np.array([x[2] for x in keyed], dtype=np.int64),
            "verdicts": np.array([x[3] for x in keyed], dtype=np.uint8),
            "blob": np.frombuffer(b"".join(x[1] for x in keyed), dtype=np.uint8),
        }

    @classmethod
    def mapped(cls, label: str) -> RuleIndex:
        """The index whose files Spark has brought to this executor."""
        return cls({name: np.load(SparkFiles.get(f"{label}-{name}.npy"), mmap_mode="r") for name in cls.ARRAYS})

    def key(self, i: int) -> bytes:
        return self.blob[self.starts[i] : self.starts[i + 1]].tobytes()

    def candidates(self, host: bytes, path: bytes) -> Iterator[bytes]:
        """Keys some rule may have, longest host first."""
        at, end = 0, len(host)
        while at < end:
            for n in self.shapes.get(end - at, ()):
                if n <= len(path):
                    yield host[at:] + path[:n]
            dot = host.find(b".", at)
            if dot < 0:
                return
            at = dot + 1

    def best(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        """For each url the place of its longest rule, or -1."""
        keys, owners = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for key in self.candidates(host, path):
                keys.append(key)
                owners.append(i)
        best = np.full(len(hosts), -1, dtype=np.int64)
        if not keys or not len(self.digests):
            return best
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))
        at = np.searchsorted(self.digests, digests)
        hits = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == digests)
        rank = [(0, 0)] * len(hosts)
        for j in hits.tolist():
            key, place = keys[j], int(at[j])
            while place < len(self.digests) and self.digests[place] == digests[j]:  # equal digests of unlike keys
                if self.key(place) == key:
                    this = (len(key), int(self.host_lengths[place]))
                    if this > rank[owners[j]]:
                        rank[owners[j]], best[owners[j]] = this, place
                    break
                place += 1
        return best


def _probe(label: str, schema: T.StructType):
    """Batches that end in host and path, with rule and verdict added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex.mapped(label)
        target = to_arrow_schema(schema)
        for batch in batches:
            hosts, paths = ([x.encode() for x in column.to_pylist()] for column in batch.columns[-2:])
            best = index.best(hosts, paths).tolist()
            rules = pa.array([None if i < 0 else index.key(i).decode() for i in best], pa.string())
            verdicts = pa.array([None if i < 0 else VERDICTS[index.verdicts[i]] for i in best], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rules, verdicts], schema=target)

    return run


def judge_urls(
    df: DataFrame,
    rules: DataFrame | Iterable[tuple],
    url: str = "url",
    default: str = "allow",
    max_indexed: int = MAX_INDEXED_RULES,
) -> DataFrame:
    """The frame with host, path, rule (its text, or null) and verdict of each row's url.

    Columns of these four names in the input give way to the results.
    """
    spark = df.sparkSession
    rules = checked_rules(spark, rules)
    kept = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    link = col(df, url).cast("string")
    parts = df.select(*(col(df, c) for c in kept), url_host(link).alias("host"), url_path(link).alias("path"))
    # One row more than the bound tells whether the list fits it.
    head = rules.limit(max_indexed + 1).collect()
    judged = _by_index(parts, head) if len(head) <= max_indexed else _by_join(parts, rules)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _by_index(parts: DataFrame, rules: list) -> DataFrame:
    spark = parts.sparkSession
    label = f"url-rules-{uuid.uuid4().hex}"
    root = scratch_path(spark, "url-filter")
    for name, array in RuleIndex.arrays(rules).items():
        np.save(out := io.BytesIO(), array)
        path = f"{root}/{label}-{name}.npy"
        write_bytes(spark, path, out.getvalue())
        spark.sparkContext.addFile(path)
    ship_code(spark)
    plain = parts.toDF(*(f"c{i}" for i in range(len(parts.columns))))
    added = [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    schema = T.StructType([*plain.schema.fields, *added])
    return plain.mapInArrow(_probe(label, schema), schema).toDF(*parts.columns, "rule", "verdict")


def _by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidate keys shuffled to the rules; the best rule goes back to the rows by (host, path)."""
    pairs = parts.select("host", "path").where(F.col("host") != "").distinct()
    shapes = rules.select(F.length("host").alias("h"), F.length("path").alias("p")).distinct()
    lengths = shapes.agg(F.max("h").alias("h"), F.max("p").alias("p")).first()
    labels = F.split("host", r"\.")
    suffixes = pairs.select(
        "host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))).alias("tail")
    ).where(F.length("tail") <= (lengths["h"] or 0))
    suffixes = suffixes.where(F.length("tail") > 0)
    keys = suffixes.select(
        "host", "path", F.col("tail").alias("rule_host"),
        F.explode(F.sequence(F.lit(0), F.least(F.length("path"), F.lit(lengths["p"] or 0)))).alias("n"),
    ).select("host", "path", "rule_host", F.substr("path", F.lit(1), F.col("n")).alias("rule_path"))
    named = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict"))
    best = (
        keys.join(named, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("rule_host") + F.length("rule_path")).alias("n"),
                    F.length("rule_host").alias("h"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    "verdict",
                )
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    return parts.join(best, ["host", "path"], "left").select(*(col(parts, c) for c in parts.columns), "rule", best["verdict"])


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's url judged by the fixed rules; what no rule fits is allowed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), plain AS (
  SELECT page_id, split_part(split_part(rest, '#', 1), '?', 1) AS rest FROM cut
), parts AS (
  SELECT page_id,
    translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM plain
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ranked AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE place = 1
"""
