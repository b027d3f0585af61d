import os
import re

import pytest

from spindle.llm import license_scan as L
from spindle.llm.license_texts import DIGESTS, KNOWN, MIT

#: Where a Debian system keeps the published texts.
PUBLISHED = "/usr/share/common-licenses"


def found(df):
    return {r.doc_id: (r.license, r.notices) for r in df.collect()}


def test_equivalent_forms_have_one_digest():
    same = ["Released under the MIT Licence!", "RELEASED under the mit LICENSE", "released — under\tthe *MIT* license"]
    assert len({L.canonical(s.lower().split("\n")) for s in same}) == 1
    assert L.canonical(["copyright (c) 2020 someone", "all rights reserved.", "some words"]) == "some words"
    assert L.canonical(["copyright notice, this list of conditions"]) == "copyright notice this list of conditions"


def test_whole_texts_and_lines(spark):
    texts = [(i, t) for i, (_, t) in enumerate(KNOWN)]
    texts += [(100, "Copyright (c) 2011 A. Author\n\n" + MIT.replace("sublicense", "sublicense").upper()),
              (101, MIT + " And one word more"), (102, "Intro.\nReleased under the MIT License.\nMore text"),
              (103, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (104, "nothing here")]
    got = found(L.scan(spark.createDataFrame(texts, "doc_id long, text string")))
    for i, (name, _) in enumerate(KNOWN):
        assert name in got[i][0].split(",")
    assert got[100][0] == "MIT"
    assert got[101] == (None, None)
    assert got[102] == (None, "MIT")
    assert got[103] == (None, "CC-BY-NC-4.0,MIT")
    assert got[104] == (None, None)


@pytest.mark.skipif(not os.path.isdir(PUBLISHED), reason="no published texts on this system")
def test_whole_published_licences(spark):
    """Whole long licences, as published, in other case, with other line breaks,
    spellings and an own copyright line; with a word more they are none."""
    texts, want = [], {}
    for i, (name, _) in enumerate(DIGESTS):
        file = name.removesuffix("-only")
        file = file.removesuffix(".0") if "GPL" in file else file
        with open(os.path.join(PUBLISHED, file), encoding="utf-8") as f:
            text = f.read()
        other = re.sub(r"\bLICENSE(S|D|)\b", r"LICENCE\1", text.upper()).replace("  ", " \t ")
        texts += [(10 * i, text), (10 * i + 1, "Copyright (c) 2020 Somebody\n\n" + other), (10 * i + 2, text + "\nand more"), (10 * i + 3, text[: len(text) // 2])]
        want |= {10 * i: name, 10 * i + 1: name, 10 * i + 2: None, 10 * i + 3: None}
    got = found(L.scan(spark.createDataFrame(texts, "doc_id long, text string")))
    assert {i: whole for i, (whole, _) in got.items()} == want


def test_own_list_and_edges(spark, edge_docs, no_docs):
    known = spark.createDataFrame([("A", "The quick brown fox jumps over the lazy dog it runs away"), ("B", "the QUICK brown fox jumps over the lazy dog. It runs away"),
                                   ("C", ""), (None, "word"), ("D", None)], "license string, text string")
    rows = L.scan(edge_docs, known).collect()
    assert len(rows) == edge_docs.count()
    assert [r.license for r in rows if r.doc_id in (1, -5)].count("A,B") == 3
    assert all(r.license is None for r in rows if r.n_words == 0)
    assert {r.digest for r in rows if r.doc_id in (2, 3, 4)} == {L.EMPTY}
    assert L.scan(no_docs).collect() == []
    assert L.scan(edge_docs, known.limit(0)).where("license IS NOT NULL").count() == 0
