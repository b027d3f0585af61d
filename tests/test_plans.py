"""Plan properties that the scale design relies on (checked on explain)."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from spindle.operators.index import build_index, inverted_blocks
from spindle.operators.joins import broadcast_if_small
from spindle.operators.rank import matched_scores, rank_batch
from spindle.sources.documents import corpus, load_table
from spindle.sources.store import save_index
from tests.conftest import SF_SMALL


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "idx")
    return save_index(build_index(corpus(spark, SF_SMALL)), root, n_buckets=8)


def test_build_reads_two_columns_and_combines_map_side(spark):
    text = plan_text(build_index(corpus(spark, SF_SMALL)).flat())
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert "partial_count" in text


def test_single_query_prunes_buckets_and_pushes_terms(stored):
    text = plan_text(matched_scores(stored, "esat estion", "bm25"))
    assert "PartitionFilters: [term_bucket" in text
    assert "PushedFilters: [In(term, [esat,estion])" in text
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert "partial_sum" in text


def test_batch_prunes_buckets_and_limits_groups_map_side(spark, stored):
    text = plan_text(rank_batch(stored, load_table(spark, SF_SMALL, "benchmark"), "bm25", 10,
                                "item_id", "text"))
    assert text.count("WindowGroupLimit") >= 2
    assert "dynamicpruning" in text and "term_bucket" in text.split("dynamicpruning")[1][:80]


def test_add_does_not_shuffle_the_old_index(spark, stored):
    new = broadcast_if_small(build_index(corpus(spark, SF_SMALL, "benchmark")).flat())
    kept = stored.postings.join(F.broadcast(new.select("title", "term")), ["title", "term"],
                                "left_anti").sortWithinPartitions("term_bucket", "term", "title")
    text = plan_text(kept)
    assert "BroadcastHashJoin LeftAnti" in text
    assert "Exchange" not in text.replace("BroadcastExchange", "")


def test_blocks_are_grouped_by_term_and_block(stored):
    text = plan_text(inverted_blocks(stored, 64))
    assert "partial_collect_list" in text
    assert "hashpartitioning(term" in text and "block" in text
