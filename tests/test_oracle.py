"""Every registered query against its SQL on the small tables, and a look at its plan."""

import pytest

import __spark_entry__ as entry
from catalog.base import QUERIES
from signalpost import scale
from tools.compare import compare, connect
from tools.plans import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


# The operators for training text have tests of their own.
OWN = [name for name in entry.queries() if name in QUERIES]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, db, name):
    result = compare(spark, db, name, SF)
    assert not result.startswith("FAIL"), result


@pytest.mark.parametrize("name", ["i01_interest_series", "i02_trigger_report", "i03_similar_cases", "i04_post_ingest", "i06_today_summary",
                                  "i08_news_alerts", "i10_rising_keywords", "c05_candidate_cases", "c07_case_news", "c14_posts_in_ranges"])
def test_plan_has_no_cross_pairing(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["b16_dictionary_tags_by_join", "b23_minmax", "b28_lexicon_count_by_join", "c03_trigger_posts",
                                  "c06_posts_with_triggers", "c07_case_news", "c11_tracked_news", "h02_stream_daily_features"])
def test_way_for_tables_too_large_to_broadcast(spark, db, name, monkeypatch):
    monkeypatch.setattr(scale, "SMALL_ROWS", -1)
    result = compare(spark, db, name, SF)
    assert not result.startswith("FAIL"), result


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["car_name", "issue", "upload_date", "score", "n_posts"] and df.count() == 686


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql())
