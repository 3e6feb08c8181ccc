import datetime as dt

from pyspark.sql import functions as F

from curato.operators import outputs, reconcile
from curato.plans.selection import select_and_reconcile
from curato.policy import Policy

IMG = ("image_id long, hotel_id long, width long, height long, created_at timestamp, "
       "is_active boolean, cdn_url string")
TAGS = "image_id long, tag string, version string, probability double"
PICKS = "hotel_id long, image_id long, cdn_url string"
D = dt.datetime(2005, 6, 1)


def frames(spark):
    images = spark.createDataFrame([
        (1, 10, 1920, 1080, D, True, "u1"),      # hotel 10 current pick, good
        (2, 10, 800, 600, D, True, "u2"),
        (3, 20, 1920, 1080, D, False, "u3"),     # hotel 20 pick is inactive
        (4, 20, 1920, 1080, D, True, "u4"),
        (5, 30, 1920, 1080, D, None, "u5"),      # hotel 30 pick has null flag: deleted but candidate
        (6, 40, 1920, 1080, D, False, "u6"),     # hotel 40: only candidate inactive -> none
        (7, 50, 1920, 1080, D, True, "u7"),      # hotel 50 has no pick -> insert
        (8, 60, 1920, 1080, D, True, "u8"),      # image of hotel 60, current pick of hotel 70
    ], IMG)
    tags = spark.createDataFrame([
        (1, "pool", "1", 0.9), (2, "pool", "1", 0.1), (4, "lobby", "1", 0.5), (5, "room", "1", 0.8),
        (7, "x", "1", 0.3), (8, "y", "1", 0.3)], TAGS)
    picks = spark.createDataFrame([
        (10, 1, "old1"), (20, 3, "old3"), (30, 5, "old5"), (40, 6, "old6"), (70, 8, "old8"),
        (80, 999, "gone")], PICKS)
    return images, tags, picks


def test_lifecycle_classes(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "is_active boolean")
    got = sorted(r.change_type for r in reconcile.with_lifecycle(df).collect())
    assert got == ["deleted", "inactive", "other"]
    text = spark.createDataFrame([("true",), ("nope",)], "is_active string")
    assert sorted(r.change_type for r in reconcile.with_lifecycle(text).collect()) == ["deleted", "other"]


def test_reconcile_branches(spark):
    images, tags, picks = frames(spark)
    sel = select_and_reconcile(images, tags, picks, Policy(as_of=dt.date(2006, 1, 1)))
    st = {r.hotel_id: r for r in sel.status.collect()}
    assert st[10].change_type == "other" and st[10].new_image_id == 1 and st[10].updated is False
    assert st[20].change_type == "inactive" and st[20].new_image_id == 4 and st[20].updated is True
    assert st[30].change_type == "deleted" and st[30].old_image_score is not None and st[30].updated is True
    assert st[40].change_type == "inactive" and st[40].new_image_id is None and st[40].updated is True
    # a pick whose image belongs to another hotel keeps the pick's hotel; that hotel has no candidate
    assert st[70].change_type == "other" and st[70].new_image_id is None and st[70].updated is False
    assert st[80].change_type == "deleted" and st[80].is_active is None
    assert set(st) == {10, 20, 30, 40, 70, 80}


def test_updated_picks_urls(spark):
    images, tags, picks = frames(spark)
    new = {r.hotel_id: r for r in select_and_reconcile(images, tags, picks,
                                                        Policy(as_of=dt.date(2006, 1, 1))).updated_picks.collect()}
    legacy = {r.hotel_id: r for r in select_and_reconcile(
        images, tags, picks, Policy(as_of=dt.date(2006, 1, 1), legacy_url=True)).updated_picks.collect()}
    assert new[20].image_id == 4 and new[20].cdn_url == "u4"
    assert legacy[20].image_id == 4 and legacy[20].cdn_url == "u3"     # old image's url
    assert legacy[80].cdn_url is None and new[80].image_id is None


def test_cdc_applied_to_old_picks_gives_snapshot(spark):
    images, tags, picks = frames(spark)
    sel = select_and_reconcile(images, tags, picks, Policy(as_of=dt.date(2006, 1, 1)))
    feed = {r.hotel_id: r for r in sel.cdc.collect()}
    assert feed[50].op == "insert" and feed[50].reason == "new"
    assert feed[20].op == "update" and feed[20].reason == "inactive"
    assert feed[40].op == "delete" and feed[80].op == "delete" and feed[70].op == "delete"
    assert 10 not in feed and 30 not in feed          # unchanged
    applied = sorted(tuple(r) for r in outputs.apply_cdc(picks, sel.cdc).collect())
    snap = sorted((r.hotel_id, r.image_id) for r in sel.snapshot.collect())
    assert applied == snap


def test_metrics_and_new_groups(spark):
    images, tags, picks = frames(spark)
    sel = select_and_reconcile(images, tags, picks, Policy(as_of=dt.date(2006, 1, 1)))
    m = {r.metric: r.value for r in sel.metrics.collect()}
    assert m["picks_deleted"] == 2 and m["cdc_inserts"] == 2 and m["cdc_deletes"] == 3
    assert m["picks_updated"] + m["picks_unchanged"] == 6
    new = sorted(r.hotel_id for r in reconcile.new_groups(sel.scored, picks).collect())
    assert new == [50, 60]


def test_require_active_drops_null_flags(spark):
    images, tags, picks = frames(spark)
    sel = select_and_reconcile(images, tags, picks, Policy(as_of=dt.date(2006, 1, 1), require_active=True))
    assert 30 not in {r.hotel_id for r in sel.snapshot.collect()}


def test_live_groups_sides(spark):
    images, _, picks = frames(spark)
    by_image = sorted(r.hotel_id for r in reconcile.groups_with_live_pick(images, picks, "images").collect())
    by_pick = sorted(r.hotel_id for r in reconcile.groups_with_live_pick(images, picks, "picks").collect())
    assert by_image == [10, 60] and by_pick == [10, 70]


def test_empty_inputs(spark):
    images, tags, picks = frames(spark)
    sel = select_and_reconcile(images.limit(0), tags.limit(0), picks.limit(0), Policy(as_of=dt.date(2006, 1, 1)))
    assert sel.snapshot.count() == 0 and sel.cdc.count() == 0
    assert {r.metric: r.value for r in sel.metrics.collect()}["snapshot_rows"] == 0


def test_duplicate_image_ids_collapse(spark):
    images, tags, picks = frames(spark)
    dup = images.unionByName(images.filter(F.col("image_id") == 1).withColumn("cdn_url", F.lit("u1-copy")))
    sel = select_and_reconcile(dup, tags, picks, Policy(as_of=dt.date(2006, 1, 1)))
    assert sel.scored.filter(F.col("image_id") == 1).count() == 1
    assert sel.status.filter(F.col("hotel_id") == 10).count() == 1
