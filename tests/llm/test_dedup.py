import hashlib
import random
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from nestmetrics.llm import exact_dedup, simhash, suffix_dedup
from nestmetrics.llm.components import components
from nestmetrics.llm.suffix_array import suffix_array
from nestmetrics.session import scratch_path

TEXTS = [(1, "a"), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "a"), (None, "z"), (5, "ä" * 50_000), (6, "ä" * 50_000), (7, "b")]


def test_exact_dedup_cases(docs):
    rows = {}
    for r in exact_dedup.decide(docs(TEXTS)).collect():
        rows.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert rows[1] == [(4, 4, False)] and rows[4] == [(4, 4, True)] * 2
    assert sorted(rows[None], key=str) == [(4, 4, False), (None, 1, True)]
    assert rows[2] == [(3, 2, False)] and rows[3] == [(3, 2, True)] and rows[5] == [(6, 2, False)] and rows[7] == [(7, 1, True)]


def test_exact_dedup_keeps_one_row_for_each_text(docs):
    kept = exact_dedup.drop_copies(docs(TEXTS))
    assert kept.columns == docs([]).columns
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:1]) for r in kept.collect()) == [("3", ""), ("4", "a"), ("6", "ä"), ("7", "b"), ("None", "z")]
    assert exact_dedup.drop_copies(docs([])).count() == 0


def test_the_index_persists_and_known_texts_keep_their_id(spark, docs):
    path = scratch_path(spark, "index-test")
    index = exact_dedup.DigestIndex.create(spark, path, 10)
    exact_dedup.decide(docs([(1, "a"), (2, "b")]), index).count()
    again = exact_dedup.DigestIndex.open(spark, path)
    rows = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.decide(docs([(9, "a"), (8, "c"), (7, "c")]), again).collect()}
    assert rows == {9: (1, False), 8: (8, True), 7: (8, False)}
    assert again.rows().count() == 3


def slow_fingerprint(text, n):
    w = text.encode().lower().split()
    shingles = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    rnd = random.Random(2)
    texts = ["", " \t", "One", "a b c", "Ä ö\u00a0x y z"] + [" ".join(rnd.choice("ab cd ef gh".split()) for _ in range(rnd.randint(1, 700))) for _ in range(20)]
    for size in (simhash.SEGMENT, 7):
        monkeypatch.setattr(simhash.segments, "__defaults__", (size,))
        for t in texts:
            assert simhash.fingerprint(t.encode())[0] == slow_fingerprint(t, 4)


def slow_groups(keys, most):
    label = list(range(len(keys)))
    for _ in keys:
        for i, a in enumerate(keys):
            for j, b in enumerate(keys):
                if (a ^ b).bit_count() <= most:
                    label[j] = label[i] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("most", [0, 4, 12])
def test_trie_join_finds_the_groups_of_all_pairs(spark, most):
    rnd = random.Random(most)
    base = [rnd.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    keys = sorted({b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, most + 3))) for b in base for _ in range(6)})
    signed = [int(np.uint64(k).view(np.int64)) for k in keys]
    links = simhash.trie_links(spark.createDataFrame([(k,) for k in signed], "fp long"), most, task_rows=20)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    got, label = [roots.get(k, k) for k in signed], slow_groups(keys, most)
    assert len(set(zip(got, label))) == len(set(got)) == len(set(label))


@pytest.mark.parametrize("base_parts", [4, 1])
def test_wide_trie_join_finds_the_groups_of_all_pairs(spark, base_parts):
    """All pairs within 51 of 256 bits, however the bits lie in the parts; base_parts 1: many equal first parts."""
    rnd = random.Random(base_parts)
    most, prints = simhash.WIDE_MOST, set()
    for _ in range(40):
        base = rnd.getrandbits(64 * base_parts) << 64 * (4 - base_parts) | rnd.getrandbits(64 * (4 - base_parts) + 1)
        for n in (0, most, most, most + 1):
            prints.add(base ^ sum(1 << k for k in rnd.sample(range(256 if base_parts > 1 else 192), n)))
    if base_parts == 1:  # one first part for all
        prints = {p & (1 << 192) - 1 | 5 << 192 for p in prints}
    prints = sorted(prints)
    rows = []
    for i, p in enumerate(prints):
        parts = [int(np.uint64(p >> s & (1 << 64) - 1).view(np.int64)) for s in (192, 128, 64, 0)]
        rows.append((parts[0], parts[1:], i))
    frame = spark.createDataFrame(rows, "fp long, wide array<long>, node long")
    links = simhash.trie_links(frame, simhash.NEAR_MOST, most, task_rows=500)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    got, label = [roots.get(i, i) for i in range(len(prints))], slow_groups(prints, most)
    assert len(set(label)) < len(label)
    assert len(set(zip(got, label))) == len(set(got)) == len(set(label))


def test_near_groups_cases(spark, docs):
    line = " ".join(f"w{i}" for i in range(400))
    frame = docs([(3, line), (9, line + " end"), (1, None), (2, "  "), (None, line), (5, "other words here altogether"), (5, "other words here altogether")])
    rows = simhash.near_groups(simhash.stored(simhash.fingerprints(frame), "t"), 4)
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in rows.collect()) == [("1", 1), ("2", 1), ("3", 3), ("5", 5), ("5", 5), ("9", 3), ("None", 3)]
    kept = simhash.drop_near_copies(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5]
    assert simhash.drop_near_copies(docs([])).count() == 0


def edited(rnd, words, share):
    return [f"e{rnd.getrandbits(40)}" if rnd.random() < share else w for w in words]


def slow_sets(texts, n=5):
    out = []
    for t in texts:
        w = t.lower().split()
        out.append({" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def slow_near(sets):
    """Components of all pairs with Jaccard of at least 0.8."""
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) * 5 >= len(a | b) * 4 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_near_copies_are_those_of_all_pairs_at_their_jaccard(spark, docs):
    """Texts edited to shingle similarities of about 0.6 to 0.95, short ones and ones without words."""
    rnd = random.Random(3)
    texts = ["", " ", "a b", "a  B", "a b c", "p q r s t u v w x y", "p q r s t u v w x z"]
    for share in (0.005, 0.01, 0.015, 0.02, 0.025, 0.03, 0.035, 0.04) * 5:
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(300, 700))]
        texts += [" ".join(base)] + [" ".join(edited(rnd, base, share)) for _ in range(2)]
    label = slow_near(slow_sets(texts))
    assert len(set(label)) > 50
    kept = simhash.drop_near_copies(docs(list(enumerate(texts))))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label))


@pytest.mark.parametrize("block", [1 << 16, 3000])
def test_near_links_of_small_and_large_groups(spark, block):
    """Groups with chains, many copies of one text and texts near none; large ones go in blocks."""
    rnd = random.Random(8)
    rows, sets, groups = [], [], []
    for g in range(3):
        base = rnd.sample(range(10**6), 200)
        for _ in range(30):
            some = rnd.sample(range(200), rnd.randint(0, 30))
            sets.append({rnd.randrange(10**6, 10**7) if i in some else x for i, x in enumerate(base)})
        chain = list(rnd.sample(range(10**7, 10**8), 200))
        for k in range(12):
            sets.append({x + 10**9 if i < 15 * k else x for i, x in enumerate(chain)})
        sets += [set(), set()]
        groups += [g] * 44
    rows = [(i, g, sorted(x)) for i, (g, x) in enumerate(zip(groups, sets))]
    frame = simhash.stored(spark.createDataFrame(rows, "member long, group long, shingles array<long>"), "t")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(frame, block)).collect()}
    got = [roots.get(i, -1 - i) for i in range(len(rows))]
    label = [(g, x) for g in range(3) for x in slow_near(sets[44 * g : 44 * g + 44])]
    assert len(set(zip(got, label))) == len(set(got)) == len(set(label))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(50)]
    frame = spark.createDataFrame(chain + star + [(7, 7), (5000, 5001), (5001, 5000)], "u long, v long")
    roots = {}
    for r in components(frame).collect():
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, roots.values())) == [list(range(61)), list(range(1000, 1050)), [5000, 5001]]
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_suffix_array_against_sorting():
    rnd = random.Random(3)
    for _ in range(3000):
        s = [rnd.randint(1, rnd.choice([1, 2, 3, 6])) for _ in range(rnd.randint(0, 30))] + [0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    assert suffix_array([1] * 20_000 + [0]) == list(range(20_000, -1, -1))


def slow_removal(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [1000, 1])
def test_removal_against_all_windows(spark, group):
    """With one segment a group, every mixed group takes the way for large ones."""
    rnd = random.Random(group)
    base = ["".join(rnd.choice("abä ") for _ in range(90)) for _ in range(5)] + ["ab" * 60, "c" * 150]
    texts = [None, "", "short"] + ["".join(rnd.choice(base)[rnd.randint(0, 30) :][: rnd.randint(10, 90)] for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    texts += texts[10:13]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(3, "short"), (None, texts[20])], "doc_id long, text string")
    every = [(r["text"] or "").encode() for r in frame.collect()]
    expected = sorted(slow_removal(every, 40))
    cuts = suffix_dedup.repeated_stretches(frame, 40, 24, group)
    found = suffix_dedup.joined_by_key(suffix_dedup.id_and_text(frame), cuts, "left").collect()
    got = []
    for r in found:
        kept, removed, runs = suffix_dedup.kept_bytes(bytes(r["text"]), r["cuts"])
        got.append((len(r["text"]), removed, runs, hashlib.sha256(kept).hexdigest()))
    assert sorted(got) == expected


def test_removal_report_and_cut_documents(spark, docs):
    passage = " ".join(f"é{i}" for i in range(200))
    frame = docs([(1, "start " + passage + "x"), (2, "," + passage + "y"), (3, "nothing"), (4, None), (5, "pq" * 400)])
    report = {r["doc_id"]: r for r in suffix_dedup.removal_report(frame).collect()}
    assert report[3]["n_removed"] == 0 and report[4]["n_bytes"] == 0 and report[5]["n_removed"] == 800 and report[5]["n_spans"] == 1
    left = {r["doc_id"]: r["text"] for r in suffix_dedup.cut_repeats(frame).collect()}
    assert left[1] == "start x" and left[2] == ",y" and left[3] == "nothing" and left[4] is None and left[5] == ""
    assert suffix_dedup.cut_repeats(docs([])).columns == frame.columns
    assert suffix_dedup.removal_report(docs([])).count() == 0


def test_a_passage_goes_from_400_bytes_on_however_many_words_it_has(docs):
    stays, goes = (" ".join(f"{c}{i:04}" for i in range(67))[:n] for c, n in (("s", 399), ("g", 400)))
    assert min(len(stays.split()), len(goes.split())) > 50
    frame = docs([(1, "a" + stays + "b"), (2, "c" + stays + "d"), (3, "a" + goes + "b"), (4, "c" + goes + "d")])
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.removal_report(frame).collect()} == {1: 0, 2: 0, 3: 400, 4: 400}


@pytest.mark.parametrize("group", [1000, 1])
def test_removal_in_words_against_all_windows(spark, group):
    rnd = random.Random(group)
    base = [[rnd.choice("a b ä cc".split()) for _ in range(40)] for _ in range(5)] + [["a", "b"] * 20, ["c"] * 40]
    texts = [None, "", " a\n"]
    for _ in range(60):
        words = [w for _ in range(rnd.randint(1, 6)) for w in rnd.choice(base)[rnd.randint(0, 15) :][: rnd.randint(5, 40)]]
        texts.append(rnd.choice(["", "\n"]) + "".join(w + rnd.choice([" ", "  ", "\n", " \t"]) for w in words))
    lists = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + 12]) for w in lists for i in range(len(w) - 11))
    expected = {}
    for k, w in enumerate(lists):
        gone = {j for i in range(len(w) - 11) if seen[tuple(w[i : i + 12])] > 1 for j in range(i, i + 12)}
        expected[k] = b" ".join(x for j, x in enumerate(w) if j not in gone)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cuts = suffix_dedup.repeated_stretches(frame, 12, 5, group, words=True)
    found = suffix_dedup.joined_by_key(suffix_dedup.id_and_text(frame), cuts, "left").collect()
    got = {}
    for r in found:
        text = bytes(r["text"])
        got[r["doc_id"]] = b" ".join(suffix_dedup.kept_bytes(text, suffix_dedup.in_bytes(text, r["cuts"] or []))[0].split())
    assert got == expected
    assert len({k for k, w in enumerate(lists) if got[k] != b" ".join(w)}) > 20


def test_sizes_up_to_4_to_5_apart_share_a_window(spark):
    sizes = sorted({*range(300), *(5**k * 4**j for k in range(9) for j in range(9)), *(s * 5 // 4 for s in range(300, 9000, 7)), *range(300, 9000, 7)})
    frame = spark.createDataFrame([(s,) for s in sizes], "shingles long")
    windows = {r["shingles"]: set(r["w"]) for r in frame.select("shingles", simhash.size_windows(F.col("shingles")).alias("w")).collect()}
    assert all(windows[a] & windows[b] for b in sizes for a in sizes if 4 * b <= 5 * a <= 5 * b)
    assert not windows[100] & windows[200] and max(map(len, windows.values())) == 2


def test_the_walk_leaves_pairs_of_sizes_too_far_apart(spark):
    """Prints that share no window are not compared, however near; a print may be in several."""
    rows = [(1, [2, 3, 4], i, w) for i, w in enumerate([[1], [1, 2], [3], [2], [4, 5], [5]])]
    rows = [(fp ^ i, wide, i, w) for fp, wide, i, w in rows]
    frame = spark.createDataFrame(rows, "fp long, wide array<long>, node long, windows array<long>")
    links = simhash.trie_links(frame, simhash.NEAR_MOST, simhash.WIDE_MOST)
    assert {r["node"]: r["root"] for r in components(links).collect()}.keys() == {0, 1, 3, 4, 5}
    assert {frozenset((r["u"], r["v"])) for r in links.collect()} == {frozenset(x) for x in ((0, 1), (1, 3), (4, 5))}


def test_passes_find_the_links_of_one_deal(spark, monkeypatch):
    """Turns dealt a pass at a time, stored and their shuffle files deleted in between."""
    rnd = random.Random(12)
    bases = [[rnd.getrandbits(64) for _ in range(4)] for _ in range(30)]
    rows = []
    for i in range(400):
        fp, *wide = (x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 8))) for x in rnd.choice(bases))
        signed = [x - (1 << 64) if x >> 63 else x for x in (fp, *wide)]
        rows.append((signed[0], signed[1:], i, [-1] if i % 4 else [-1, 3]))
    frame = simhash.stored(spark.createDataFrame(rows, "fp long, wide array<long>, node long, windows array<long>"), "t")
    bits = np.array([[r[0], *r[1]] for r in rows], dtype=np.int64).view(np.uint64)
    apart = np.bitwise_count(bits[:, None] ^ bits).sum(axis=2)
    u, v = np.nonzero(apart <= simhash.WIDE_MOST)
    label = simhash.local_groups(len(rows), u, v)
    expected = {frozenset(np.flatnonzero(label == g).tolist()) for g in set(label) if (label == g).sum() > 1}
    dealt, plain = [], simhash.in_passes
    monkeypatch.setattr(simhash, "in_passes", lambda passes, links: dealt.append(passes) or plain(passes, links))
    groups = {}
    for r in components(simhash.trie_links(frame, simhash.NEAR_MOST, simhash.WIDE_MOST, 1000, 3000)).collect():
        groups.setdefault(r["root"], set()).add(r["node"])
    assert set(map(frozenset, groups.values())) == expected
    assert dealt == [3]


def test_blocks_of_large_groups_in_passes(spark, monkeypatch):
    rnd = random.Random(5)
    chain = rnd.sample(range(10**7), 300)
    rows = [(k, 0, sorted(x + 10**9 if i < 20 * k else x for i, x in enumerate(chain))) for k in range(16)]
    frame = simhash.stored(spark.createDataFrame(rows, "member long, group long, shingles array<long>"), "t")
    dealt, plain = [], simhash.in_passes
    monkeypatch.setattr(simhash, "in_passes", lambda passes, links: dealt.append(passes) or plain(passes, links))
    monkeypatch.setattr(simhash, "PASS_SHARE", 1)
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(frame, 600, 1000)).collect()}
    assert dealt and dealt[0] > 1 and len(roots) == 16 and len(set(roots.values())) == 1


def test_shuffle_files_of_steps_that_are_over_are_deleted(spark):
    """A stored step leaves no shuffle behind once they are freed."""
    from nestmetrics.llm.common import free_shuffles

    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    free_shuffles(spark)
    simhash.stored(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    before = tracker.shuffleStatuses().size()
    assert before > 0
    free_shuffles(spark)
    for _ in range(100):
        if tracker.shuffleStatuses().size() < before:
            break
        time.sleep(0.1)
    assert tracker.shuffleStatuses().size() < before
