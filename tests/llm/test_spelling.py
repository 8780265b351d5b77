import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nestmetrics.llm import spelling


def holes(word):
    return [word[:i] + word[i + 1 :] for i in range(len(word))]


def near(a, b):
    """By definition: exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and short in holes(long)


def slow(counts, factor=10):
    forms = {}
    rows = []
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= factor * n:
            forms[w] = best
        rows.append((w, n, len(others)))
    out = []
    for w, n, n_near in rows:
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, n_near, counts[forms[w]] if w in forms else None))
    return sorted(out)


def found(spark, counts):
    frame = spark.createDataFrame([(w, n, 0) for w, n in counts], "word string, n long, side int")
    return sorted(tuple(r) for r in spelling.variants(frame).collect())


def words(seed, number, letters="abé", least=1, most=9):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(least, most))): rng.choice([2, 3, 20, 25, 300, 4000]) for _ in range(number)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=7), min_size=1, max_size=25, unique=True))
def test_searches_find_each_near_word_once(vocabulary):
    listed = {w: i + 1 for i, w in enumerate(vocabulary)}
    got = Counter()
    for side in (spelling.LEFT, spelling.RIGHT):
        for word, number, _, _ in spelling.search_shard(side, listed, vocabulary):
            got[word] += number
    assert {w: got[w] for w in vocabulary} == {w: sum(near(w, v) for v in vocabulary) for w in vocabulary}


@pytest.mark.parametrize("limits", [(100_000, 200_000), (50, 20)])
def test_forms_against_all_pairs(spark, monkeypatch, limits):
    monkeypatch.setattr(spelling, "SHARD", limits[0])
    monkeypatch.setattr(spelling, "HOT", limits[1])
    counts = words(3, 400) | {"aaaaaaaaab": 2, "aaaaaaaaaa": 20, "aaaaaaaaa": 200, "aaaaaaaa": 3000, "a𝄞b": 5, "\x00a": 4, "x" * 3000: 9, "x" * 3001: 90}
    repeated = [*counts.items(), (None, 4), ("", 5)]
    assert found(spark, repeated) == slow(counts)


def test_words_of_texts(spark, docs):
    texts = [
        (1, "Receive receive RECEIVE recieve, Ünder Über-übersetzen ÜBERSETZEN\nübersetzen"), (2, "receive " * 500), (3, None), (4, ""), (None, "receives receives"),
        (5, "x" * 50_000 + " " + "x" * 50_000), (6, "receive " * 500), (7, "abcdef abcdefg abcdefg ×÷×÷×÷× ×÷×÷×÷×"),
    ]
    counts = Counter()
    for id_, text in texts:
        for run in spelling_runs(text or ""):
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    frame = spelling.noisy_words(docs(texts), 7, 31).groupBy("word").count()
    assert dict(frame.collect()) == counts
    assert any(zlib.crc32(f"{i}:receive".encode()) % 31 == 0 for i in range(200))


def spelling_runs(text):
    import re

    return [r.translate({c: c + 32 for c in range(65, 91)}) for r in re.findall("[A-Za-zÀ-ÿ]+", text)]


def test_deleted_code_point(spark, docs):
    ids = [i for i in range(2000) if zlib.crc32(f"{i}:receive".encode()) % 31 == 0 or zlib.crc32(f"{i}:forgotten".encode()) % 31 == 0]
    got = sorted(r["word"] for r in spelling.noisy_words(docs([(i, "receive FORGOTTEN") for i in ids]), 7, 31).collect())
    want = []
    for i in ids:
        for run in ("receive", "forgotten"):
            h = zlib.crc32(f"{i}:{run}".encode())
            want.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run)
    assert got == sorted(w for w in want if len(w) >= 7)


def test_empty_table(spark, docs):
    assert found(spark, []) == []
    assert spelling.noisy_words(docs([]), 7, 31).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), factor=1)
