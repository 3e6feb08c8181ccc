import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from curato.operators import scoring
from curato.policy import Policy

IMG_SCHEMA = ("image_id long, hotel_id long, width long, height long, created_at timestamp, "
              "is_active boolean, cdn_url string, probability double, tag string, version string")


def ts(y, m, d):
    return dt.datetime(y, m, d)


def score_rows(spark, rows, policy):
    df = spark.createDataFrame(rows, IMG_SCHEMA)
    out = scoring.score_images(df, policy).orderBy("image_id").collect()
    return {r.image_id: r for r in out}


def base(i, **kw):
    row = dict(image_id=i, hotel_id=1, width=1920, height=1080, created_at=ts(2005, 1, 1),
               is_active=True, cdn_url=f"u{i}", probability=0.5, tag="t", version="1")
    row.update(kw)
    return tuple(row[k] for k in ["image_id", "hotel_id", "width", "height", "created_at", "is_active",
                                  "cdn_url", "probability", "tag", "version"])


def test_resolution_branches_a(spark, policy_a):
    r = score_rows(spark, [base(1, width=0), base(2, width=None), base(3, width=400, height=400),
                           base(4, width=1920, height=1080), base(5, width=100, height=100)], policy_a)
    assert r[1].score_resolution == 0.0
    assert r[2].score_resolution == 1.0            # least() skips the null
    assert r[3].score_resolution == pytest.approx(0.0)
    assert r[4].score_resolution == 1.0            # capped
    assert r[5].score_resolution < 0               # no lower bound on tiny images
    expected = math.log(10000 / 160000) / math.log(2073600 / 160000)
    assert r[5].score_resolution == pytest.approx(expected)


def test_resolution_branches_b(spark, policy_b):
    r = score_rows(spark, [base(1, width=0), base(2, width=None), base(4, width=1920, height=1080)], policy_b)
    assert r[1].score_resolution == 0.0
    assert r[2].score_resolution is None           # CASE keeps the null
    assert r[4].score_resolution == 1.0


def test_aspect_ratio_bounds(spark, policy_a):
    r = score_rows(spark, [base(1, width=3, height=10), base(2, width=93, height=20),
                           base(3, width=1, height=10), base(4, width=10, height=0),
                           base(5, width=None)], policy_a)
    assert r[1].aspect_ratio == pytest.approx(0.3) and r[1].score_aspect_ratio == 1.0
    assert r[2].aspect_ratio == pytest.approx(4.65) and r[2].score_aspect_ratio == 1.0
    assert r[3].score_aspect_ratio == 0.0
    assert r[4].aspect_ratio is None and r[4].score_aspect_ratio == 0.0
    assert r[5].score_aspect_ratio == 0.0


def test_freshness_branches(spark, policy_a, policy_b):
    as_of = policy_a.as_of
    rows = [base(1, created_at=dt.datetime.combine(as_of - dt.timedelta(days=3650), dt.time())),
            base(2, created_at=dt.datetime.combine(as_of - dt.timedelta(days=3651), dt.time())),
            base(3, created_at=ts(2010, 1, 1)),
            base(4, created_at=None),
            base(5, created_at=dt.datetime.combine(as_of - dt.timedelta(days=365), dt.time()))]
    a = score_rows(spark, rows, policy_a)
    assert a[1].score_freshness == 0.0
    assert a[2].score_freshness == 0.0
    assert a[3].score_freshness == 1.0             # future: capped at 1
    assert a[4].score_freshness == 1.0             # undated: least() skips the null
    assert a[5].score_freshness == pytest.approx(0.9)
    b = score_rows(spark, rows, policy_b)
    assert b[1].score_freshness == 0.0
    assert b[3].score_freshness == 1.0
    assert b[4].score_freshness is None
    assert b[5].score_freshness == pytest.approx(0.9)


def test_tag_and_composite(spark, policy_a, policy_b):
    rows = [base(1, probability=None), base(2, probability=1.0)]
    a = score_rows(spark, rows, policy_a)
    assert a[1].score_tag_priority is None and a[1].image_score is None
    expected = (6 * a[2].score_resolution + 2 * a[2].score_aspect_ratio + 2 * a[2].score_freshness + 3 * 1.0) / 13
    assert a[2].image_score == pytest.approx(expected)
    b = score_rows(spark, rows, policy_b)
    assert b[1].score_tag_priority == 0.0 and b[1].image_score is not None


def test_score_digits_rounds_before_ranking(spark):
    p = Policy(as_of=dt.date(2006, 1, 1), score_digits=2)
    r = score_rows(spark, [base(1)], p)
    assert r[1].image_score == round(r[1].image_score, 2)


def test_policy_validation():
    with pytest.raises(ValueError):
        Policy(variant="C")
    with pytest.raises(ValueError):
        Policy(min_resolution=10, max_resolution=5)


def test_untagged_image_ranks_last(spark, policy_a):
    images = spark.createDataFrame([base(1)[:7], base(2)[:7]],
                                   "image_id long, hotel_id long, width long, height long, "
                                   "created_at timestamp, is_active boolean, cdn_url string")
    tags = spark.createDataFrame([(2, "t", "1", 0.1)], "image_id long, tag string, version string, probability double")
    scored = scoring.scored_candidates(images, tags, policy_a)
    top = scoring.top_images(scored).collect()
    assert [r.image_id for r in top] == [2]


def test_variant_b_matches_fan_out(spark, policy_b):
    """The reduced plan picks what the literal fan-out (every tag a candidate) picks."""
    images = spark.createDataFrame(
        [(1, 1, 1920, 1080, ts(2005, 1, 1), True, "u1"), (2, 1, 1920, 1080, ts(2005, 1, 1), True, "u2"),
         (3, 2, 800, 600, ts(2004, 1, 1), None, "u3"), (4, 2, 800, 600, ts(2004, 1, 1), False, "u4"),
         (5, 1, 4000, 3000, ts(2005, 12, 1), False, "u5")],
        "image_id long, hotel_id long, width long, height long, created_at timestamp, is_active boolean, cdn_url string")
    tags = spark.createDataFrame(
        [(1, "a", "1", 0.2), (1, "b", "1", 0.9), (2, "a", "1", 0.8), (2, "c", "2", None), (4, "z", "1", 1.0), (5, "b", "1", 0.9)],
        "image_id long, tag string, version string, probability double")
    top = {r.hotel_id: r for r in scoring.select_variant_b(images, tags, policy_b).collect()}
    # brute force
    fan = images.join(tags, "image_id", "left").fillna({"probability": 0.0})
    fan = scoring.score_images(fan, policy_b)
    best = {}
    for r in fan.collect():
        k = (-(r.image_score if r.image_score is not None else -1e9), r.image_id, -r.probability, r.tag or "")
        if r.hotel_id not in best or k < best[r.hotel_id][0]:
            best[r.hotel_id] = (k, r)
    assert set(top) == set(best)
    assert top[2].image_id == 4 and top[1].image_id == 5     # inactive images win: scorer B does not look
    for h, (_, r) in best.items():
        assert (top[h].image_id, top[h].tag, top[h].probability) == (r.image_id, r.tag, r.probability)
        assert top[h].image_score == pytest.approx(r.image_score)
