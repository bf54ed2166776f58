"""Fingerprints, toxicity and chat formatting."""

import hashlib
import pickle
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from llm_frames import frame  # noqa: F401

from tidemill.llm import chat_format, fingerprints, toxicity

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return set(zip(w, w[1:], w[2:], w[3:], w[4:])) if len(w) >= 5 else {tuple(w)} if w else set()


def test_edited_texts_and_likeness(frame):
    r = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts = {i * 7: " ".join(r.choice(words) for _ in range(r.choice([0, 1, 4, 40, 900]))) for i in range(300)}
    texts[21], texts[28], texts[35] = None, "", "\U0001f600 one two"
    got = {x.doc_id: x for x in fingerprints.compare_edited(frame(list(texts.items()))).collect()}
    ids = sorted(texts, reverse=True)
    prints, errors = {}, []
    for at, i in enumerate(ids):
        text, after = texts[i] or "", texts[ids[(at + 1) % len(ids)]] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert (row.near_next == 1) == (shingles(text) == shingles(after)) and (row.near_next == 0 or text.split() == after.split())
        a, b = shingles(text), shingles(edited)
        true = len(a & b) / len(a | b) if a | b else 1.0
        errors.append(abs(row.near_edited - true))
        # sixteen hashes at least: four standard deviations of a share estimated from them
        assert errors[-1] < (4 * 0.5 / 16**0.5 if len(a) > 16 else 1e-9)
    assert sum(errors) / len(errors) < 0.1


def test_containment_of_unequal_documents_and_merge(frame):
    r = random.Random(6)
    small = " ".join(f"s{r.randrange(9999)}" for _ in range(1500))
    large = small + " " + " ".join(f"l{r.randrange(9999)}" for _ in range(20_000))
    df = fingerprints.fingerprints(frame([(1, small), (2, large), (3, large[len(small) + 1 :])]))
    s = {x.doc_id: x.sketch for x in df.collect()}
    pair = df.sparkSession.createDataFrame([(s[1], s[2], s[3])], "a array<bigint>, b array<bigint>, c array<bigint>")
    near, contained, merged = pair.select(
        fingerprints.resemblance(F.col("a"), F.col("b")), fingerprints.containment(F.col("a"), F.col("b")), fingerprints.merge(F.col("a"), F.col("c"))
    ).first()
    assert near < 0.2 and contained > 0.95
    assert len(set(s[2]) - set(merged)) <= 4  # shingles across the seam belong to neither part


def test_order_of_repeated_and_missing_ids(frame):
    rows = [(5, "five"), (5, "five"), (2, "two two"), (None, "none none none"), (9, "nine")]
    got = fingerprints.followed(fingerprints.fingerprints(frame(rows)))
    follow = sorted(((r.doc_id, r.next_text) for r in got.collect()), key=repr)
    assert follow == sorted([(9, "five"), (5, "five"), (5, "two two"), (2, "none none none"), (None, "nine")], key=repr)
    assert fingerprints.compare_edited(frame(rows).where("doc_id = 0")).count() == 0
    assert fingerprints.compare_edited(frame([(None, "a b c")])).first().edited_sha256 == hashlib.sha256(b"a b a").hexdigest()


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in rows if a.toxic for b in rows if not b.toxic]
    # few rows to learn from and to judge by at this size: 0.80 measured
    assert sum(pairs) / len(pairs) > 0.7


def test_offending_sentences_are_found(spark, frame):
    r = random.Random(1)
    plain = [f"word{i}" for i in range(200)]

    def text(bad):
        sentences = [" ".join(r.choice(plain) for _ in range(8)) for _ in range(6)]
        if bad:
            sentences[r.randrange(6)] += r.choice([" vile", " nasty"])
        return ". ".join(sentences) + "."

    rows = [(i, text(i % 4 == 0)) for i in range(400)] + [(900, None), (901, ""), (None, "vile"), (902, "Vile " * 20_000)]
    docs = frame(rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t in rows[:400]:
        assert (got[i].score >= toxicity.THRESHOLD) == (i % 4 == 0)
        for s in got[i].offending:
            assert re.search("vile|nasty", t[s.start : s.end])
    assert got[900].score == got[901].score < toxicity.THRESHOLD and got[902].score > 0.9
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.score(docs, toxicity.train(docs, labels.where("toxic > 9"))).agg(F.max("score")).first()[0] == 0


def test_learning_from_an_id_that_repeats(spark, frame, monkeypatch):
    """One text of an id is learned from, so a repeated id cannot break the bound of the sample."""
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda docs: fitted.append(docs) or toxicity.Model())
    docs = frame([(4, f"text {i:03}") for i in range(500)] + [(5, "other"), (6, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in (4, 5, 6) for _ in range(3)], "doc_id bigint, toxic int")
    toxicity.train(docs, labels)
    assert set(fitted[0]) <= {("text 000", 0), ("other", 1), (None, 0)} and len(fitted[0]) == len(set(fitted[0])) > 0


def test_what_is_broadcast_needs_no_package():
    sent = toxicity.Model({"a": 1.0}, 0.5, 0.1).values()
    assert b"tidemill" not in pickle.dumps(sent) and toxicity.Model(*sent) == toxicity.Model({"a": 1.0}, 0.5, 0.1)


def test_chat_round_trip():
    r = random.Random(1)
    bits = ["a", "\\", "#", "###", "### ", ": ", ":", "\n", "</turn>", "</turn>\n", "<", "<|", "|>", "<|image:0|>", "é"]
    for _ in range(3000):
        turns = [tuple("".join(r.choice(bits) for _ in range(r.randint(0, 8))) for _ in range(2)) for _ in range(r.randint(1, 4))]
        visitor = chat_format.Visitor()
        text = "".join(chat_format.format_turn(role, [chat_format.Part("text", t)], visitor)[0] for role, t in turns)
        assert [(role, t) for role, t, _, _ in chat_format.read_turns(text)] == turns
        assert not [m for m in chat_format.PLACEHOLDER.finditer(text) if m.group(1)]
    with pytest.raises(ValueError):
        list(chat_format.read_turns("### user: open"))


def test_texts_cut_anywhere_give_the_same_output():
    """Control strings that begin in one text part and end in the next."""
    r = random.Random(2)
    bits = ["a", "\\", "#", "##", ": ", ":", " ", "\n", "</tu", "rn>", "</turn>\n", "<", "|image:0|>", "<|audio:1|>"]
    make = chat_format.Part
    for _ in range(3000):
        said = "".join(r.choice(bits) for _ in range(r.randint(0, 10)))
        cuts = sorted(r.randint(0, len(said)) for _ in range(r.randint(0, 4)))
        parts = [make("text", said[a:b]) for a, b in zip([0, *cuts], [*cuts, len(said)])]
        whole = chat_format.format_turn("user", [make("text", said)], chat_format.Visitor())
        assert chat_format.format_turn("user", parts, chat_format.Visitor()) == whole
        at = r.randint(0, len(parts))
        visitor = chat_format.Visitor()
        text, start, end = chat_format.format_turn("user", [*parts[:at], make("image", reference="i", width=1, height=1), *parts[at:]], visitor)
        found = [m for m in chat_format.PLACEHOLDER.finditer(text[start:end]) if m.group(1)]
        assert [m.group() for m in found] == ["<|image:0|>"] and len(visitor.attachments) == 1
        (turn,) = chat_format.read_turns(text)
        mark = len("".join(p.text for p in parts[:at]))
        assert turn[:2] == ("user", said[:mark] + "<|image:0|>" + said[mark:])


def test_typed_parts():
    parts = [
        chat_format.Part("text", "see <|image:0|> "), chat_format.Part("image", reference="a.png", width=28, height=15),
        chat_format.Part("audio", reference="b.wav", seconds=1.5), chat_format.Part("document", reference="c.pdf", pages=2),
    ]
    visitor = chat_format.Visitor()
    text, start, end = chat_format.format_turn("user", parts, visitor)
    assert text[start:end] == "see \\<|image:0|> <|image:0|><|audio:1|><|document:2|>"
    assert [(a.kind, a.place, a.reference, a.tokens) for a in visitor.attachments] == [
        ("image", 0, "a.png", 4), ("audio", 1, "b.wav", 38), ("document", 2, "c.pdf", 2048)
    ]
    with pytest.raises(ValueError):
        visitor.flatten([chat_format.Part("video")])


def test_conversations_of_any_length(spark, monkeypatch):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} ### </turn> \\ é") for t in range(700)]
    rows += [(2, 0, "user", None), (2, 0, "user", None), (2, None, None, "first"), (None, 1, "assistant", ""), (3, 0, "assistant", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' AS formatted", "1 AS segment")
    segments = chat_format.format_conversations(df)
    assert segments.where("conv_id = 1").count() >= 700 // chat_format.SEGMENT
    got = {r.conv_id: r for r in chat_format.digests(segments).collect()}
    assert set(got) == {1, 2, None, 3}
    for conv in got:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0))
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in mine)
        loss = "".join(text or "" for _, role, text in mine if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(got[conv])[1:5] == (len(mine), sha(turns), len(loss), sha(loss))
    assert chat_format.digests(chat_format.format_conversations(df.where("conv_id = 9"))).count() == 0
