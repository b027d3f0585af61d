import numpy as np
from pyspark.sql import functions as F

from spindle.llm import langid as L
from spindle.llm.common import crc_of_id, table
from tests.llm.conftest import EDGE_ROWS


def test_held_out_accuracy(small_docs):
    held_out = crc_of_id() % 3 == 1
    model = L.fit(small_docs.where(~held_out))
    rows = L.predict(small_docs, model, "text", F.col("doc_id"), F.col("lang"), held_out.alias("held_out")).collect()
    assert len(rows) == small_docs.count()
    out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_unlearned_languages_are_rejected(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held_out = crc_of_id() % 3 == 1
    model = L.fit(docs.where(~held_out))
    rng = np.random.default_rng(0)
    letters = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), n)) for n in (150, 400, 2000)]
    texts = ["La vita è bella e il sole splende sopra le montagne mentre i bambini giocano nel giardino della nonna con il cane e il gatto dorme. ",
             "Suomen kesä on lyhyt mutta kaunis, ja monet ihmiset viettävät aikaa järvien rannalla mökillä ystävien kanssa ja uivat joka ilta. ",
             "Wczoraj wieczorem poszliśmy do kina, aby zobaczyć nowy film o historii naszego miasta i jego mieszkańców sprzed wielu lat. ",
             "Bugün hava çok güzel olduğu için arkadaşlarımla birlikte parka gittik ve uzun süre yürüyüş yaptık, sonra eve döndük. ",
             "今天天气很好我们一起去公园散步然后在河边吃了一顿美味的午餐大家都很开心。" * 2, *letters]
    odd = spark.createDataFrame([(t * n,) for t in texts for n in (1, 5)], "text string")
    assert [r.lang_pred for r in L.predict(odd, model, "text").collect() if not r.rejected] == []
    held = L.predict(docs.where(held_out & F.col("text").rlike("\\p{L}")), model, "text").collect()
    assert len(held) > 200 and sum(r.rejected for r in held) <= 0.02 * len(held)


def test_prediction_is_the_nearest_centroid(small_docs):
    model = L.fit(small_docs, dims=1024, clusters=2, per_lang=80)
    for r in L.predict(small_docs.limit(40), model, "text", F.col("text")).collect():
        counts = np.zeros(1024)
        raw = (" " + " ".join("".join(c if c.isalpha() or ord(c) > 127 else " " for c in r.text.lower()).split()) + " ").encode()
        for i in range(len(raw) - 2):
            for n in (1, 2, 3):
                code = sum(b << 8 * (n - 1 - j) for j, b in enumerate(raw[i:i + n])) + (n << 24)
                counts[code * 2654435761 % 2**32 >> 22] += 1
        v = np.log1p(counts) * model.idf
        cosines = v / np.linalg.norm(v) @ model.matrix
        assert model.langs[int(cosines.argmax())] == r.lang_pred and abs(cosines.max() - r.score) < 1e-4


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Ein Satz mit Wörtern, 123 und mehr. " * 50
    want = L.gram_counts(text, 512)
    monkeypatch.setattr(L, "CHUNK", 64)
    assert (L.gram_counts(text, 512) == want).all()


def test_centroids_follow_clusters():
    rng = np.random.default_rng(0)
    centers = np.eye(8)[:3]
    x = np.concatenate([c + 0.05 * rng.random((20, 8)) for c in centers])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = L.kmeans(x.astype(np.float32), 3)
    assert (got @ centers.T).max(0).min() > 0.95
    assert len(L.kmeans(x[:2].astype(np.float32), 5)) == 2


def test_edges(edge_docs, no_docs):
    model = L.fit(edge_docs)
    assert set(model.langs) == {"en", "fr"}
    rows = L.predict(edge_docs, model, "text", F.col("doc_id"), F.col("score").alias("kept")).collect()
    assert len(rows) == len(EDGE_ROWS)
    for r in rows:
        if r.doc_id in (2, 3, 4, 5):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        elif r.doc_id in (1, 6, 8, 9, -5):
            assert r.lang_pred in ("en", "fr")
    assert {r.lang_pred for r in rows if r.doc_id in (1, -5)} == {"en"} and [r.lang_pred for r in rows if r.doc_id == 6] == ["fr"]
    assert L.predict(no_docs, model, "text", F.col("doc_id")).collect() == []
    unlearnt = L.fit(no_docs)
    assert {(r.lang_pred, r.rejected) for r in L.predict(edge_docs, unlearnt, "text").collect()} == {("und", True)}
    assert L.fit(edge_docs.withColumn("lang", F.lit(None).cast("string"))).langs == []
