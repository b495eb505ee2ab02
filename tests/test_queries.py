"""Registered queries against their DuckDB oracle on the smallest scale
factor (the driver's gate runs the same comparison at sf0.01)."""
import duckdb
import pytest

from oracle_check import TABLES, compare
from conftest import SF_SMALL

# one or more per operator family; every registered query is compared at
# sf0.01 by ``python tests/oracle_check.py`` (and by the driver)
FAST = ["catalogue_validate", "normalize_names", "catalogue_dedup", "duplicate_count", "category_last_wins",
        "score_ratio", "score_token_set", "score_weighted", "best_match", "adaptive_threshold",
        "threshold_sweep", "extract_links", "filter_links", "resolve_urls", "first_seen_links", "page_offsets",
        "missing_pages", "page_batches", "resume_point", "state_upsert", "state_semi", "state_anti",
        "state_stats", "state_clear", "route_links", "output_batches", "product_fields", "ingredients",
        "ingredient_ratings", "hashtags", "highlights", "extract_errors", "product_match", "stream_dedup",
        "stream_resume", "stream_stats", "stream_two_runs", "topk_per_scorer", "recommendation"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from catalog_engine.plans.registry import ORACLE, QUERIES
    # study_names: compared with its SQL in test_study.py
    assert set(QUERIES) - {"study_names"} == set(ORACLE)


@pytest.mark.parametrize("threshold", [80, 90, 95])
def test_best_match_is_the_best_of_all_pairs(spark, con, threshold):
    """The pruned join against SQL that scores every pair."""
    from catalog_engine.operators import matching as M
    from catalog_engine.plans import fixtures as FX
    from catalog_engine.plans.registry import _best_match_sql
    run = lambda s, sf: M.best_match(FX.query_names(s, sf), FX.catalogue(s, sf), threshold=threshold)
    r = compare(spark, con, f"best_match_{threshold}", run, _best_match_sql(threshold, pruned=False), SF_SMALL)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    r = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert {"matched", "matched_name", "category", "score"} <= set(df.columns)
