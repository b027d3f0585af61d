"""Segments become one without counting stored postings again."""
import os

import pytest
from pyspark.sql import functions as F

from spindle.operators.index import build_index, level_table, lexicon_table, merge_index
from spindle.plans.jobs import add_job, build_job
from spindle.sources import store
from spindle.sources.documents import corpus
from spindle.sources.store import compact_index, load_index, read_manifest, segment_table

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def parts(spark):
    docs = corpus(spark, SF_SMALL).withColumn("title", F.when(F.col("title") != "7", F.col("title")))
    return docs, [docs.where("title % 2 = 1 OR title IS NULL").select("title", F.concat("text", F.lit(" new new xx")).alias("text")),
                  spark.createDataFrame([("1", "new the xx xx"), (None, "xx xx"), ("other", "esat")], "title string, text string")]


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("layout", ["append", "resort"])
def test_tables_of_one_segment_equal_those_of_its_postings(spark, scratch, monkeypatch, forward, layout):
    docs, new = parts(spark)
    root = os.path.join(scratch, "0")
    build_job(docs, root, n_buckets=4, forward=forward)
    want, sorts = build_index(docs), []
    writing = store.write_postings
    monkeypatch.setattr(store, "write_postings", lambda *a, **k: sorts.append(a[1]) or writing(*a, **k))
    for i, part in enumerate(new, 1):
        old, root = root, os.path.join(scratch, str(i))
        sorts.clear()
        add_job(spark, part, old, root, forward=forward, layout=layout)
        # The new postings are sorted into the segment they end in, and only there.
        assert sorts == [read_manifest(spark, root).segments[-1].path]
        want = merge_index(want, build_index(part))
    monkeypatch.setattr(store, "level_table", None)              # stored postings are not counted again
    compact_index(spark, root, os.path.join(scratch, "one"))
    m = read_manifest(spark, os.path.join(scratch, "one"))
    flat = want.flat().cache()
    assert len(m.segments) == 1 and m.segments[0].rows == m.n_postings == flat.count() and m.segments[0].forward == forward
    one = load_index(spark, os.path.join(scratch, "one"))
    assert rows(one.flat()) == rows(flat) and (not forward or rows(one.forward()) == rows(flat))
    assert rows(one.documents()) == rows(want.documents())
    assert rows(segment_table(spark, m.segments[0], "levels").select("term", "tf", "n")) == rows(level_table(flat))
    assert rows(one.lexicon_df.select("term", "df", "cf", "max_tf")) == rows(lexicon_table(flat))
    assert rows(one.stats()) == rows(want.stats())
