import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from nestmetrics.llm import bpe, html_text, licenses, packing, toxicity

PATH = public_tokenizers.path(bpe.WORD_BPE)
ALPHABETS = [
    "abcdefghijklmnop", "thereingandou", "aaaab", "'sdt vmrel", "é ü ß İ Σς ſ ﬁ", "\x1c\x1d \x85\xa0　\x00\x7f²¼9٣",
    "日本語 한국 हि न्दी é Å", "<|endoftext|> <|startoftext|>", "ǅȺȾ😀👍🏽",
]


def test_encoding_and_decoding_equal_the_library():
    library, ours = Tokenizer.from_file(PATH), bpe.codec(PATH)
    rnd = random.Random(1)
    texts = ["", " ", "a" * 5000, "the" * 3000, "it's we'll I'D", "<|endoftext|><|ENDOFTEXT|>x"]
    for _ in range(2500):
        chars = [c for a in rnd.sample(ALPHABETS, rnd.randint(1, 3)) for c in a]
        text = "".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40)))
        texts.append(text + (rnd.choice(list(ours.special)) + text if rnd.random() < 0.1 else ""))
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        mine = ours.encode(text)
        assert np.frombuffer(mine, dtype="<u4").tolist() == ids
        assert bpe.library_codec(PATH).encode(text) == mine
        assert ours.decode(mine) == library.decode(ids, skip_special_tokens=False)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 5)
    made = []
    memory = bpe.Memory(lambda k: made.append(k) or k.encode())
    for k in "abcdefga" * 3:
        assert memory[k] == k.encode()
    assert len(memory) <= 5 and len(memory.older) <= 5


def test_encoded_digests_cases(docs):
    rows = bpe.encoded_digests(docs([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "x " * 60_000)]), PATH).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 60_000)]
    assert bpe.encoded_digests(docs([]), PATH).count() == 0


def slow_place(lengths, capacity, most):
    """The same rules over plain lists."""
    bins, opened, out = [], 0, []
    for n in lengths:
        fitting = [b for b in bins if b[0] >= n]
        if fitting:
            found = min(fitting, key=lambda b: b[0])
        else:
            if len(bins) >= most:
                bins.remove(min(bins, key=lambda b: b[0]))
            found = [capacity, opened]
            bins.append(found)
            opened += 1
        out.append(capacity - found[0])
        found[0] -= n
        bins = [b for b in bins if b[0]]
    return opened, out


def test_best_fit_with_few_open_bins():
    rnd = random.Random(7)
    for most in (1, 2, 5, 100):
        lengths = [rnd.randint(1, 40) for _ in range(400)]
        bins = packing.OpenBins(40, most)
        placed = [bins.place(n) for n in lengths]
        assert (bins.opened, [o for _, o in placed]) == slow_place(lengths, 40, most)
        used = {}
        for (b, o), n in zip(placed, lengths):
            assert o == used.get(b, 0) and o + n <= 40
            used[b] = o + n


def test_packing_cases(docs):
    frame = docs([(1, None), (2, "a " * 10_000), (3, "b"), (3, "b"), (None, "c")])
    rows = packing.pack_documents(frame, PATH).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"]) for r in rows) == [
        ("1", 0, 0, 1), ("2", 0, 0, 4096), ("2", 1, 4096, 4096), ("2", 2, 8192, 1809), ("3", 0, 0, 2), ("3", 0, 0, 2), ("None", 0, 0, 2),
    ]
    assert len({r["sequence_id"] for r in rows}) == 3
    for s in {r["sequence_id"] for r in rows}:
        parts = sorted((r["offset"], r["length"]) for r in rows if r["sequence_id"] == s)
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 4096
    assert packing.pack_documents(docs([]), PATH).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now, please.</div><article><h1>Title &amp; more</h1>
<p><b>First <i>one</i>.<br><p>Second,&nbsp;
 two.</p><aside>Side</aside><div class="comments"><p>Reader, says.</p></div><form><p>Mail.</p></form><p>Third.</article><footer>&copy; x</footer>"""


def test_main_text_of_pages(spark):
    assert html_text.main_text(PAGE) == "Title & more\nFirst one.\nSecond, two.\nThird."
    assert html_text.main_text("") == "" and html_text.main_text("<p>") == "" and html_text.main_text("plain  text") == "plain text"
    assert html_text.main_text("<article>a<script>never") == "a" and html_text.main_text("x <!-- y") == "x"
    assert html_text.main_text("<div>" * 3000 + "<p>Deep, here.</p>") == "Deep, here."
    unmarked = "<div class='menu'><a href=x>A</a></div><div><p>Long text, with marks. And more of it.</p><p>More text, with marks.</p></div><ul><li><a href=y>Next page</a></li></ul>"
    assert html_text.main_text(unmarked) == "Long text, with marks. And more of it.\nMore text, with marks."
    pages = spark.createDataFrame([(1, "u", None, 0), (2, None, PAGE, 0), (2, None, PAGE, 0)], "page_id long, url string, html string, text int")
    rows = html_text.extract(pages, ["page_id", "url"]).collect()
    assert sorted((r["page_id"], r["n_chars"] == len(r["text"]), bool(r["text"])) for r in rows) == [(1, True, False), (2, True, True), (2, True, True)]


def slow_phrases(text):
    import re

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = [(i, label) for label, phrase in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_license_scan_against_a_plain_loop(spark, docs):
    rnd = random.Random(5)
    vocabulary = "GNU general Public license apache CC by mit nc the é cc-by gnu General".split()
    texts = [None, "", "...", "mit", "MIT-License!", "x" * 50_000 + " apache license"]
    texts += [rnd.choice(["", "."]) + rnd.choice([" ", "\n", "-"]).join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    rows = licenses.scan(docs([*enumerate(texts), (4, texts[4])])).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == slow_phrases(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    full = licenses.scan(docs([(1, "Released under the MIT License."), (2, "Licensed under the Apache License, Version 2.0.")])).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in full} == {1: ("mit", 1.0), 2: ("apache,apache-2", 1.0)}
    assert licenses.scan(docs([])).count() == 0


def test_grams_do_not_depend_on_segments(monkeypatch):
    text = "Ein längerer Text über alles, was toxisch ist. " * 5
    whole = sorted(np.concatenate(list(toxicity.gram_buckets(text))).tolist())
    monkeypatch.setattr(toxicity, "SEGMENT", 7)
    assert sorted(np.concatenate(list(toxicity.gram_buckets(text))).tolist()) == whole


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(900):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        bad = rnd.random() < 0.3
        if bad:
            text[rnd.randrange(len(text))] = rnd.choice(["bofwag", "wagbof", "zzkrumpf"]) + rnd.choice(["", "!", "ing"])
        rows.append((i, " ".join(text), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_held_out_rows(labelled):
    weights, bias = toxicity.train(labelled.select("doc_id", "text"), labelled)
    keep = [labelled["doc_id"], toxicity.is_held_out(labelled["doc_id"]), labelled["toxic"]]
    rows = toxicity.scored(labelled, weights, bias, keep).toDF("doc_id", "held", "toxic", "score").where("held").collect()
    hits = sum((r["score"] >= toxicity.THRESHOLD) == bool(r["toxic"]) for r in rows)
    assert len(rows) > 200 and hits >= 0.95 * len(rows)


def test_toxicity_cases(spark, docs, labelled):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    frame = docs([(1, None), (2, ""), (2, ""), (None, "a" * 50_000)])
    weights, bias = toxicity.train(frame, none)
    assert not weights.any() and bias == 0.0
    kept = toxicity.drop_toxic(frame, none)
    assert kept.columns == frame.columns and kept.count() == 4
    assert toxicity.drop_toxic(docs([]), labelled).count() == 0
