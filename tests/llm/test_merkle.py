import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from spindle.llm import merkle as M
from tests.llm.conftest import EDGE_ROWS


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n\té\r", max_size=400))
def test_leaves_cover_the_text(text):
    root, tree = M.read(M.fingerprint(text))
    assert len(root) == 32
    assert sum(n for s in tree for p in s for _, n in p) == len(text)
    assert M.likeness(M.fingerprint(text), M.fingerprint(text)) == 1.0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=60), st.text(alphabet="ab .\n", max_size=60))
def test_roots_tell_equality(a, b):
    assert (M.fingerprint(a)[:32] == M.fingerprint(b)[:32]) == (a == b)


def test_differing_branches_locate_an_edit():
    text = "\n\n".join(f"Section {i} starts here. It goes on with a few more words.\nA second line in {i}." for i in range(30))
    at = text.index("Section 17")
    new = text[:at] + "CHANGED 17" + text[at + 10:]
    spans = M.differing(M.fingerprint(new), M.fingerprint(text))
    assert len(spans) == 1 and spans[0][0] <= at and spans[0][1] >= at + 10 and spans[0][1] - spans[0][0] < 120
    assert M.differing(M.fingerprint(text), M.fingerprint(text)) == []
    assert 0.95 < M.likeness(M.fingerprint(text), M.fingerprint(new)) < 1.0


def expected(rows):
    """(id, text) in order of ids downwards, nulls last; each followed by the next."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        k = len(text) // 3
        new = text[:len(text) - k] + after[:k]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), M.fingerprint(text), M.fingerprint(new),
                    M.likeness(M.fingerprint(text), M.fingerprint(new)), M.likeness(M.fingerprint(text), M.fingerprint(after))))
    return out


def test_whole_table_against_a_plain_version(spark, small_docs):
    rows = sorted(((r.doc_id, r.text) for r in small_docs.collect()), reverse=True)
    want = sorted(expected(rows))
    for parts in (1, 7, 40):
        assert sorted(map(tuple, M.fingerprints(small_docs, parts=parts).collect())) == want
    likely = [r for r in want if r[1] > 300]
    assert sum(r[5] > 0.5 for r in likely) > 0.9 * len(likely)
    assert sum(r[5] > r[6] for r in want) > 0.95 * len(want)


def test_edges(spark, edge_docs, no_docs):
    got = M.fingerprints(edge_docs, parts=5).collect()
    assert len(got) == len(EDGE_ROWS)
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got)) == sorted((a is None, a or 0, len(t or "")) for a, t, *_ in EDGE_ROWS)
    prints = {}
    texts = {}
    for a, t, *_ in EDGE_ROWS:
        texts.setdefault((a, len(t or "")), set()).add(M.fingerprint(t or ""))
    for r in got:
        assert r.fingerprint in texts[(r.doc_id, r.n_chars)]
        prints.setdefault(r.fingerprint, r.doc_id)
        assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
    # Distinct ids in order: 9, 8, 7, ... each is edited with the next one's head.
    by = {r.doc_id: r for r in got if r.doc_id in (8, 9)}
    nine, eight = EDGE_ROWS[12][1], EDGE_ROWS[11][1]
    k = len(nine) // 3
    assert by[9].edited_sha256 == hashlib.sha256((nine[:len(nine) - k] + eight[:k]).encode()).hexdigest()
    assert M.fingerprints(no_docs).collect() == []
    one = M.fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1.0
