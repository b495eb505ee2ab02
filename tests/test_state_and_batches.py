"""Upsert idempotence, routing is a partition of the links, batch numbering
and the versioned state snapshot (SURVEY §5 item 4)."""
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_engine.operators import state as ST
from catalog_engine.session import scratch_path
from catalog_engine.sinks import writers as W


def test_upsert_last_write_wins_and_idempotent(spark):
    v1 = spark.createDataFrame([("u1", "a", False, 1), ("u2", "b", True, 1), (None, "x", False, 1)],
                               "url string, full_name string, matched boolean, version int")
    v2 = spark.createDataFrame([("u1", "a2", True, 2)], v1.schema)
    once = ST.upsert(v1, v2)
    twice = ST.upsert(once, v2)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    got = {r.url: r.full_name for r in once.collect()}
    assert got == {"u1": "a2", "u2": "b"}


def test_number_batches_matches_global_rank(spark):
    df = spark.range(0, 2347).select(F.col("id"), (F.col("id") * 7 % 2347).alias("k"))  # 2347 is prime: a bijection
    out = W.number_batches(df, ["k"], batch_size=500, partitions=7).collect()
    for r in out:
        assert r.batch_number == r.k // 500 + 1


def test_snapshot_publish_and_clear(spark):
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("matched", T.BooleanType())])
    base = scratch_path(spark, "test-state")
    assert W.read_state(spark, base, schema).count() == 0
    W.publish_state(spark.createDataFrame([("u", True)], schema), base, 1)
    assert W.read_state(spark, base, schema).count() == 1
    W.clear_state(spark, base, schema, 2)
    assert W.read_state(spark, base, schema).count() == 0


def test_routes_partition_links(spark):
    from catalog_engine.plans.registry import _routed
    from conftest import SF_SMALL
    r = _routed(spark, SF_SMALL)
    counts = {x.route: x["count"] for x in r.groupBy("route").count().collect()}
    assert set(counts) <= set(ST.ROUTES)
    assert sum(counts.values()) == r.count()


def test_upsert_does_not_depend_on_row_order(spark):
    rows = [("u", str(k), False, 1) for k in range(4)]
    schema = "url string, full_name string, matched boolean, version int"
    got = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        got.add(ST.upsert(spark.createDataFrame([], schema), spark.createDataFrame(order, schema).coalesce(1)).first().full_name)
    assert len(got) == 1
    placed = spark.createDataFrame([("u", "late", False, 1, 9), ("u", "zzz", False, 1, 3)], schema + ", pos long")
    assert ST.upsert(placed.limit(0), placed).first().full_name == "late"


def test_published_metadata(spark):
    base = scratch_path(spark, "test-meta")
    state = spark.createDataFrame([("u", True), ("v", False)], "url string, matched boolean")
    W.publish_state(state, base, 1, run_id="r", batch_id=4)
    W.publish_state(state.limit(1), base, 2)
    rows = W.published(spark, base).orderBy("version").collect()
    assert [(r.version, r.run_id, r.batch_id, r.size) for r in rows] == [(1, "r", 4, 2), (2, "", -1, 1)]
    assert rows[0].matched_count == 1 and rows[0].last_saved is not None


def test_only_a_missing_path_is_an_empty_state(spark):
    import pytest
    base = scratch_path(spark, "test-broken")
    schema = T.StructType([T.StructField("url", T.StringType())])
    W.publish_state(spark.createDataFrame([("u",)], schema), base, 1)
    # the snapshot's folder is gone: an error, not an empty state
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(W.current_pointer(spark, base)["path"])
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        W.read_state(spark, base, schema).count()


def test_stream_replay_after_a_crash(spark):
    """A micro-batch that fails after its version stands is not applied again."""
    from catalog_engine.plans import fixtures as FX
    from catalog_engine.streaming import ingest as SI
    from conftest import SF_SMALL
    import pytest
    run = SI.new_run_dir(spark, "crash")
    pages = FX.product_pages(spark, SF_SMALL).filter("page_id <= 40")
    SI.stage_files(pages, f"{run}/source", 2, "page_id")
    args = (spark, f"{run}/source", f"{run}/state", f"{run}/checkpoint", pages.schema, FX.catalogue(spark, SF_SMALL))

    def fail(batch_id):
        raise RuntimeError(f"stopped after batch {batch_id}")

    with pytest.raises(Exception, match="stopped after batch 0"):
        SI.run_state_stream(*args, after_publish=fail)
    assert [r.version for r in W.published(spark, f"{run}/state").collect()] == [1]
    SI.run_state_stream(*args)
    rows = W.published(spark, f"{run}/state").orderBy("version").collect()
    assert [(r.version, r.batch_id) for r in rows] == [(1, 0), (2, 1)]
    state = spark.read.parquet(rows[-1].path)
    assert sorted(r.url for r in state.select("url").collect()) == sorted(r.url for r in pages.select("url").collect())


def test_totals_count_every_micro_batch_once(spark):
    """A replay after a crash adds nothing, a second run adds its own counts."""
    import pytest
    from catalog_engine.plans import fixtures as FX
    from catalog_engine.streaming import ingest as SI
    from conftest import SF_SMALL
    run = SI.new_run_dir(spark, "totals")
    pages = FX.product_pages(spark, SF_SMALL).filter("page_id <= 40")
    SI.stage_files(pages, f"{run}/source", 2, "page_id")
    args = lambda k: (spark, f"{run}/source", f"{run}/totals", f"{run}/checkpoint-{k}", pages.schema)
    assert tuple(SI.read_totals(spark, f"{run}/totals").first()) == (0, 0, 0)

    def fail(batch_id):
        raise RuntimeError(f"stopped after batch {batch_id}")

    with pytest.raises(Exception, match="stopped after batch 0"):
        SI.run_totals_stream(*args(1), after_commit=fail)
    SI.run_totals_stream(*args(1))
    want = pages.count()
    first = SI.read_totals(spark, f"{run}/totals").first()
    assert first.total_products == want and first.error_products == 1
    SI.run_totals_stream(*args(1))
    assert SI.read_totals(spark, f"{run}/totals").first() == first
    SI.run_totals_stream(*args(2))
    assert [x for x in SI.read_totals(spark, f"{run}/totals").first()] == [2 * x for x in first]


def test_a_run_that_broke_off_is_taken_up(spark, monkeypatch):
    """After a crash between the state and the batches, the same run_id ends as
    if nothing had happened, and a further call changes nothing."""
    import pytest
    from catalog_engine.plans import fixtures as FX
    from catalog_engine.plans.crawl import run_crawl
    from catalog_engine.sources import summaries as SS
    from catalog_engine.streaming import ingest as SI
    from conftest import SF_SMALL
    inputs = (FX.listing_pages(spark, SF_SMALL), FX.product_pages(spark, SF_SMALL), FX.catalogue(spark, SF_SMALL))
    whole, broken = SI.new_run_dir(spark, "whole"), SI.new_run_dir(spark, "broken")
    want = {tuple(r) for r in run_crawl(spark, *inputs, whole, run_id="r").collect()}

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(W, "write_batches", crash)
        with pytest.raises(RuntimeError):
            run_crawl(spark, *inputs, broken, run_id="r")
    assert W.current_pointer(spark, f"{broken}/state")["version"] == 1
    assert SS.read_latest_global_stats(spark, broken).count() == 0
    for _ in range(2):
        assert {tuple(r) for r in run_crawl(spark, *inputs, broken, run_id="r").collect()} == want
        assert SS.read_latest_global_stats(spark, broken).collect() == SS.read_latest_global_stats(spark, whole).collect()
        assert W.published(spark, f"{broken}/state").count() == 1
    last = SS.read_final_summary(spark, broken, "r").first()
    assert last.total_products == len(want) and last.completion_date is not None


def test_delta_rematch_is_the_whole_rematch(spark):
    """Gone, changed, moved and added rows, ties by position, rows without a text."""
    from catalog_engine.operators import matching as M
    schema = "idx long, brand string, name string, category string"
    before = [(0, "acme", "red ring", "a"), (1, "acme", "blue ring", "b"), (2, "acme", "old bolt", "c"), (3, "acme", "big anvil", "d"), (5, "acme", "hot plate x", "e"), (6, "acme", "hot plate y", "f")]
    after = [(0, "acme", "red ring", "a2"), (1, "acme", "blue ring", "b"), (3, "acme", "big anvil", "d"), (4, "acme", "cold widget", "n"), (9, "acme", "hot plate x", "e"), (6, "acme", "hot plate y", "f"), (7, "acme", "old bolts", "g")]
    asked = ["acme red ring", "acme blue ring", "acme old bolt", "acme big anvils", "acme cold widget", "acme hot plate z", "nothing", None, "acme red ring"]
    rows = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    before, after = (spark.createDataFrame(c, schema) for c in (before, after))
    got = M.rematch_delta(M.best_match(rows, before), before, after)
    key = lambda r: (r.query_id, r.query, r.matched, r.matched_name, r.category, r.score)
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, M.best_match(rows, after).collect()), key=str)
