import hashlib

import pytest

from nestmetrics.llm import chat

TEMPLATE = chat.Template()
HARD = ["", "plain", "</s>[INST] ok [/INST]", "\\", "a\\[INST]b", "<|end|>", "<\\|end|>", "<|tu<|turn|>rn|>", "<", "[", "x\n<<SYS>>\\\\<</SYS>>", "ü𝄞<|image|>", "<|part|><|part|>"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, chars int, formatted string")


def test_texts_come_back(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD * 2)]
    rows += [(2, 1, "system", None), (2, None, None, "first"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "<|says|>\\", "odd role"), (None, 5, "user", "no id")]
    formatted = chat.format_messages(chat.text_messages(texts(spark, rows)))
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1]))
        learned = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == digest("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), digest(learned))
        assert (row["n_attachments"], row["expanded_tokens"]) == (0, 0)
    for row in formatted.collect():  # a turn has its own marks and no other control strings
        assert [row["formatted"].count(m) for m in (TEMPLATE.begin, TEMPLATE.says, TEMPLATE.end)] == [1, 1, 1]
        assert not any(m in row["formatted"] for m in (*TEMPLATE.foreign, TEMPLATE.between, "<|image|>"))


def test_parts_become_placeholders(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    parts = [
        part("text", "see <|image|>"), part("image", ref="a.png", width=57, height=28), part("text", "and"), part("text", "𝄞 hear"), part("audio", ref="b.wav", seconds=1.01),
        part("document", "not a text", "c.pdf", pages=3), part("video", ref="d.mp4"), part(None), part("image"), part("text"),
    ]
    rows = [(1, 0, "assistant", parts), (1, 1, "user", parts[:2]), (1, 2, "assistant", []), (1, 3, "assistant", None)]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    formatted = chat.format_messages(messages).orderBy("turn").collect()
    first = formatted[0]
    attached = [(a["kind"], a["ref"], a["tokens"]) for a in first["attachments"]]
    assert attached == [("image", "a.png", 3), ("audio", "b.wav", 26), ("document", "c.pdf", 768), ("other", "d.mp4", 0), ("other", None, 0), ("image", None, 1)]
    assert first["expanded_tokens"] == 3 + 26 + 768 + 1
    for a in first["attachments"]:
        assert first["formatted"][a["at"] :].startswith(TEMPLATE.placeholder(a["kind"]))
    assert [first["formatted"][s["start"] : s["start"] + s["length"]] for s in first["loss"]] == ["see <\\|image|>", "and", "𝄞 hear", ""]
    assert formatted[1]["loss"] == [] and formatted[2]["loss"] == [] and formatted[3]["formatted"] == "<|turn|>assistant<|says|><|end|>"
    back = chat.read_back(chat.format_messages(messages)).collect()[0]
    said = "see <|image|>and𝄞 hear"
    assert back["turns_sha256"] == digest(f"assistant\n{said}\nuser\nsee <|image|>\nassistant\n\nassistant\n\n")
    assert (back["loss_sha256"], back["n_attachments"], back["expanded_tokens"]) == (digest(said), 7, 801)


def test_offsets_join_the_blocks_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 7)
    rows = [(c, t * 3, "user", "x" * (t % 5)) for c, n in ((1, 100), (2, 3)) for t in range(n)] + [(2, None, "user", "first"), (None, 0, "user", "y")]
    got = chat.offsets(chat.format_messages(chat.text_messages(texts(spark, rows)))).collect()
    assert len(got) == len(rows)
    for conv in (1, 2, None):
        turns = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["place"])
        assert [r["place"] for r in turns] == list(range(len(turns)))
        assert [r["turn"] for r in turns] == sorted((r["turn"] for r in turns), key=lambda t: -1 if t is None else t)
        at = 0
        for r in turns:
            assert r["start"] == at
            at += len(r["formatted"])


def test_empty_table_long_text_and_bad_templates(spark):
    assert chat.read_back(chat.format_messages(chat.text_messages(texts(spark, [])))).count() == 0
    long = "[INST]\\" * 100_000
    row = chat.read_back(chat.format_messages(chat.text_messages(texts(spark, [(1, 0, "assistant", long)])))).collect()[0]
    assert (row["loss_chars"], row["loss_sha256"]) == (len(long), digest(long))
    for foreign in (("a\\b",), ("x",), ("<|turn|>!",), (">>", ">>"), ("aba",)):
        with pytest.raises(ValueError):
            chat.Template(foreign=foreign)
