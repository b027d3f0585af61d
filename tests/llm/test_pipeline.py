import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from spindle.llm import langid, mixing
from spindle.llm.common import table
from spindle.llm.queries import DOMAIN, SHARES
from tests.llm.conftest import SMALL, with_clashes
from tests.llm.test_jump_shard import plain_jump
from tests.llm.test_simhash import plain_components, plain_print
from tests.llm.test_template_decon import plain_pairs


def plain_language(text, model):
    """Language and whether the text is kept: the nearest centroid, gram by gram."""
    if not any(c.isalpha() for c in text or ""):
        return None, False
    dims = len(model.idf)
    raw = (" " + " ".join("".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split()) + " ").encode()
    grams = Counter(sum(b << 8 * (n - 1 - j) for j, b in enumerate(raw[i:i + n])) + (n << 24) for i in range(len(raw) - 2) for n in (1, 2, 3))
    counts = np.zeros(dims)
    for code, times in grams.items():
        counts[code * 2654435761 % 2 ** 32 * dims >> 32] += times
    v = np.log1p(counts) * model.idf
    cosines = v / np.linalg.norm(v) @ model.matrix
    lang = model.langs[int(cosines.argmax())]
    size = sum(3 * b <= counts.sum() for b in langid.SIZES)
    return lang, cosines.max() >= model.limits[lang][size] - 1e-6


def test_stages_against_plain_versions(spark, small_docs):
    """Each stage on what the one before kept, by versions that share no code
    with the operators (the language and domain models are taken as fitted)."""
    assert [name for name, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    docs = small_docs
    for name, stage in P.STAGES[:-1]:
        made = P.solid(stage(spark, docs, SMALL), "test")
        assert made.columns == small_docs.columns
        before, after = {r.doc_id: r.asDict() for r in docs.collect()}, made.collect()
        assert all(before[r.doc_id] == r.asDict() for r in after)          # rows as they were
        ids = sorted(r.doc_id for r in after)
        if name == "language_id":
            model = langid.fit(docs)
            assert ids == sorted(i for i, r in before.items() if plain_language(r["text"], model)[1])
        elif name == "simhash_near_dedup":
            order = sorted(before)
            groups = plain_components([plain_print(before[i]["text"]) for i in order])
            assert ids == sorted(order[g] for g in set(groups)) and len(ids) < len(before)
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
            leaks = {d for d, _ in plain_pairs([(i, r["text"]) for i, r in before.items()], items)}
            assert leaks and ids == sorted(set(before) - leaks)
        else:
            domains, steps, features, targets, _ = mixing.plan(docs, table(spark, SMALL, "labels"), F.expr(DOMAIN), SHARES)
            rows = features.select("doc_id", "n", "p").collect()
            n, p = np.array([r.n for r in rows], float), np.array([r.p for r in rows])
            assert all(r.n == len((before[r.doc_id]["text"] or "").split()) for r in rows)
            w = last = np.ones(len(rows))
            for momentum, gradient in steps:
                w, last = np.maximum(0, w + momentum * (w - last) - p @ gradient), w
            miss, start = np.abs(p.T @ (n * w) - targets).sum(), np.abs(p.T @ n - targets).sum()
            assert miss < 0.05 * start or miss < 1e-5 * targets.sum()
            times = Counter(ids)
            assert all(times[r.doc_id] in (int(x), int(x) + 1) for r, x in zip(rows, w, strict=True))
        docs = made
    rows = P.STAGES[-1][1](spark, docs, SMALL).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id])) for r in rows)
    assert all(r.shard == plain_jump(r.doc_id, 40) for r in rows)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_run_and_edges(spark, edge_docs, no_docs):
    assert P.run(spark, SMALL).count() > 0
    for docs in (edge_docs, no_docs, with_clashes(table(spark, SMALL, "documents").limit(5)).select("score", "text", "doc_id", "lang", "rejected")):
        for _, stage in P.STAGES[:-1]:
            made = P.solid(stage(spark, docs, SMALL), "test")
            assert made.columns == docs.columns
            docs = made
        assert P.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_entry_registers_everything():
    import __spark_entry__ as E
    names = list(E.queries())
    assert [n for n in names if n.startswith("op")] == sorted((n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
