"""Fill-in-middle against a plain version, and the way back."""

import hashlib
import random
import re
from collections import Counter

from conftest import plan
from llm_frames import frame  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import fill_in_middle as M


def plain(doc_id, text):
    text = text or ""
    units = re.findall(M.UNIT, text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return (doc_id, len(units), "plain", None, None, sha(text), sha(text))
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(units), form, len(p), len(m), sha(out), sha(text))


def test_against_a_plain_version(frame):
    r = random.Random(7)
    letters = "abZ  \n\t$1\\\U0001f600é<>P\x00"
    rows = [(i, "".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 9, 200])))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "a <P> b"), (1002, "a <M> b"), (1003, "<S>"), (1004, "$0 $1 \\1 \\E"), (1004, "$0 $1 \\1 \\E")]
    rows += [(1010 + i, "word, " * 60_000) for i in range(3)] + [(1020, "x" * 500_000), (-5, "negative id"), (1030, "\r\n  line ends")]
    df = M.digests(frame(rows))
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((plain(*x) for x in rows), key=repr)
    assert not re.search("EvalPython|InPandas|InArrow", plan(df))
    assert M.digests(frame(rows).limit(0)).collect() == []


def test_forms_in_their_shares_and_cuts_between_units(frame):
    rows = [(i, f"some words of document {i}, to be cut") for i in range(3000)]
    got = M.fill_in_middle(frame(rows)).select("form", M.pieces_of(F.col("output"), F.col("form")).alias("p"), "text").collect()
    share = Counter(x.form for x in got)
    assert abs(share["plain"] / 3000 - 0.1) < 0.03 and abs(share["spm"] / 3000 - 0.18) < 0.03
    for x in got:
        if x.form != "plain":
            assert x.p.prefix + x.p.middle + x.p.suffix == x.text
            assert re.findall(M.UNIT, x.p.prefix) + re.findall(M.UNIT, x.p.middle) + re.findall(M.UNIT, x.p.suffix) == re.findall(M.UNIT, x.text)
