"""BPE against the library, on hand-made and random strings."""

import gc
import hashlib
import random
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from llm_frames import frame  # noqa: F401

from tidemill.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    r = random.Random(5)
    letters = "aābcdé'’ \t\n0١²<|>endoftxßİſKΣ̈̈́中😀\x7f\x01\xa0\xad\x1c "
    made = ["".join(r.choice(letters) for _ in range(80)) for _ in range(200)]
    return [
        None, "", " ", "Hello's it'll I'M x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|>", "ΑΣΣ ς İstanbul ǅ", "a" * 5000,
        "aaaa bbbb " * 3000, "don't_stop_me__now!!! #$%^&*", *made,
    ]


def test_like_the_library(frame, library):
    rows = list(enumerate(texts())) + [(3, "again"), (3, "again"), (None, "no id")]
    got = sorted(tuple(r) for r in bpe.digests(frame(rows), PATH).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").na.fill(-1).collect())
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((-1 if i is None else i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)


def test_shared_prefixes_are_computed_once():
    v = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    asked = []
    v.stable = type("Counting", (dict,), {"__missing__": lambda self, pair: asked.append(pair) or bpe._StablePairs(v)[pair]})()
    bpe.encode_words({"internation"}, v)
    once = len(asked)
    bpe.encode_words({"internationa", "internation", "internationb"}, v)
    assert len(asked) < 3 * once


def test_empty_table(frame):
    assert bpe.digests(frame([(1, "a")]).where("doc_id = 2"), PATH).count() == 0


def test_no_search_for_cycles_while_words_are_learned():
    gc.collect()
    v, searched = bpe.Vocabulary(open(PATH, encoding="utf-8").read()), []
    words = [f"word{i}x" for i in range(20_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join(words)])], names=["doc_id", "text"])
    learn = bpe._Chunks.learn

    class Seen(bpe._Chunks):
        def learn(self, new):
            note = lambda phase, info: searched.append(phase)
            gc.callbacks.append(note)
            learn(self, new)
            gc.callbacks.remove(note)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bpe, "_Chunks", Seen)
        list(bpe._encoded(iter([batch]), SimpleNamespace(value=v.text)))
    assert not searched and gc.isenabled()


def test_a_task_leaves_no_vocabulary_behind():
    text = open(PATH, encoding="utf-8").read()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["Some words, ünd more.", None, " "])], names=["doc_id", "text"])
    on = gc.isenabled()
    gc.collect()
    gc.disable()
    try:
        (out,) = bpe._encoded(iter([batch]), SimpleNamespace(value=text))
        assert not any(isinstance(o, (bpe.Vocabulary, bpe._Chunks)) for o in gc.get_objects())
    finally:
        if on:
            gc.enable()
    assert [len(ids) > 0 for ids in out.column("ids").to_pylist()] == [True, False, False]


def test_texts_pass_to_python_by_the_thousand(frame, monkeypatch):
    import corpus_pipeline

    def noted(docs, vocabulary):
        docs = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([b.column(0), pa.array([str(b.num_rows)] * b.num_rows)], names=["doc_id", "text"]) for b in batches), "doc_id bigint, text string")
        return docs.selectExpr("doc_id", "int(text) AS n")

    monkeypatch.setattr(bpe, "digests", noted)
    docs = frame([(i, "a") for i in range(5000)]).coalesce(1)
    sizes = corpus_pipeline.encoded(docs.sparkSession, docs, "").selectExpr("max(n)", "count(*)").first()
    assert sizes[0] <= 1000 and sizes[1] == 5000
