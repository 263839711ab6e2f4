from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.encoding import base64_text, column_family, column_qualifier
from tallyloom.functions.maps import merge_maps, swap
from tallyloom.functions.times import epoch_millis_now, from_second_text, to_day, to_second_text
from tallyloom.operators.mentions import explode_mentions, mention_counts, sliding_counts, track_posts
from tallyloom.operators import posts
from tests.conftest import rows_of

TEXTS = ["Chopin", "chopin", "CHOPIN", "chopin chopin", "xChopiny Miles Davis", "miles davis", "", None]


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("others", [0, 200])
def test_mentions(spark, others):
    words = ["Miles Davis", "Chopin", "RATM", "Chopin", *[f"word{i}" for i in range(others)]]
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = frame.select("text", text.mentioned_words("text", words)).collect()
    want = [[w for w in words if t is not None and (w in t or w.lower() in t)] for t in TEXTS]
    assert [r[1] for r in got] == want


def test_empty_keyword_matches_every_text(spark):
    frame = spark.createDataFrame([("a",), ("",)], "text string")
    assert [r[0] for r in frame.select(text.mentioned_words("text", [""])).collect()] == [[""], [""]]


def test_mention_counts_once_per_post(spark):
    rows = [("Chopin", "es"), ("chopin chopin", "es"), ("CHOPIN", "es"), ("chopin", "en")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert rows_of(mention_counts(frame, ["Chopin"])) == [("Chopin", "en", 1), ("Chopin", "es", 2)]
    # "Chopin" itself does not hold "chop".
    assert explode_mentions(frame, ["Chopin", "chop"]).count() == 5


def test_track_posts(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    assert {r[0] for r in track_posts(frame, ["Chopin"]).collect()} == {
        "Chopin", "chopin", "chopin chopin", "xChopiny Miles Davis"
    }


@pytest.mark.parametrize("window, slide", [(60, 20), (50, 20), (20, 20), (140, 20)])
def test_sliding_counts(spark, window, slide):
    start = datetime.datetime(2024, 1, 1)
    seconds = [0, 5, 19, 20, 61, 61, 200]
    rows = [(start + datetime.timedelta(seconds=s), "k") for s in seconds]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, key string")
    got = {r["win_start"]: r["n"] for r in sliding_counts(frame, "ts", ["key"], window, slide).collect()}
    want = {}
    epoch = int((start - datetime.datetime(1970, 1, 1)).total_seconds())
    first = (epoch - window) // slide * slide
    for begin in range(first, epoch + 300, slide):
        n = sum(begin <= epoch + s < begin + window for s in seconds)
        if n:
            want[datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=begin)] = n
    assert got == want


def test_small_functions(spark):
    moment = F.lit("2014-03-01 12:33:40").cast("timestamp_ntz")
    assert one(spark, to_second_text(moment), to_day(moment)) == (
        "2014-03-01 12:33:40",
        datetime.date(2014, 3, 1),
    )
    assert one(spark, from_second_text(F.lit("2014-03-01 12:33:40"))) == (
        datetime.datetime(2014, 3, 1, 12, 33, 40),
    )
    now = one(spark, epoch_millis_now())[0]
    assert abs(now - datetime.datetime.now().timestamp() * 1000) < 60_000
    assert one(spark, base64_text(F.lit("am9obg=="))) == ("john",)
    name = F.lit("visits:a:b")
    assert one(spark, column_family(name), column_qualifier(name)) == ("visits", "a:b")
    maps = merge_maps(
        F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3))
    )
    assert one(spark, maps) == ({"a": 1, "b": 3},)
    pair = F.struct(F.lit(1).alias("first"), F.lit("x").alias("second"))
    assert tuple(one(spark, swap(pair))[0]) == ("x", 1)


@pytest.fixture(scope="module")
def nested(spark):
    moment = datetime.datetime(2014, 3, 1, 12, 33, 40)
    tags = ([(t,) for t in ("b", "B", "A", "a")],)
    rows = [
        ("hi", 3, True, None, None, None, "es", moment, "web", ("ann",), tags, ("Madrid",)),
        ("yo", None, None, "ann", 2, False, "en", moment, "app", ("bob",), ([],), None),
    ]
    return spark.createDataFrame(rows, posts.NESTED_POST_SCHEMA)


def test_projection(nested):
    flat = {r["text"]: r for r in posts.project_post(nested).collect()}
    assert flat["hi"]["hashtags_texts"] == "A|B|a|b" and flat["yo"]["hashtags_texts"] == ""
    assert flat["hi"]["place_full_name"] == "Madrid" and flat["yo"]["place_full_name"] is None
    assert flat["hi"]["created_at"] == "2014-03-01 12:33:40"
    listed = {r["text"]: r for r in posts.project_post(nested, as_list=True).collect()}
    assert listed["hi"]["hashtags_texts"] == ["b", "B", "A", "a"]
    assert posts.short_post(nested).columns == ["text", "favorite_count", "created_at"]


def test_absent_fields_become_null(nested):
    flat = posts.project_post(nested.drop("retweeted", "source")).first()
    assert flat["retweeted"] is None and flat["source"] is None


def test_tuple_and_types(nested):
    tuples = posts.post_tuple(posts.project_post(nested), F.lit("Valencia"), F.lit("#x"))
    assert tuples.columns == posts.TUPLE_FIELDS
    typed = posts.bind_types(tuples)
    kinds = dict(typed.dtypes)
    assert kinds["created_at"] == "timestamp_ntz" and kinds["favorite_count"] == "int"
    rows = {r["text"]: r for r in typed.collect()}
    assert rows["hi"]["place"] == rows["yo"]["place"] == "Valencia"
    assert rows["yo"]["favorite_count"] is None and rows["hi"]["possibly_sensitive"] is None


def test_popular_nested_and_places(spark):
    shape = "topic string, id int, favorite_count int, lang string"
    rows = [("x", 1, 5, "es"), ("x", 2, 9, "en"), ("x", 3, 5, "es"), ("y", 4, 1, "es")]
    frame = spark.createDataFrame(rows, shape)
    best = posts.popular_posts(frame, "topic", [F.col("id")], count=2)
    assert rows_of(best.select("topic", "rank", "id")) == [("x", 1, 2), ("x", 2, 1), ("y", 1, 4)]
    spanish = posts.popular_posts(frame, "topic", [F.col("id")], where={"lang": "es"})
    assert {r["id"] for r in spanish.collect()} == {1, 3, 4}
    trends = spark.createDataFrame([("x",), ("z",)], "topic string")
    tweets = {r["topic"]: r["tweets"] for r in posts.nest_posts(trends, best, "topic", ["id"]).collect()}
    assert [t["id"] for t in tweets["x"]] == [2, 1] and tweets["z"] == []
    places = spark.createDataFrame([("P",), ("Q",)], "place string")
    local = spark.createDataFrame([("P", "x"), ("P", "y"), ("R", "x")], "place string, topic string")
    found = posts.posts_of_places(places, local, frame, "topic", tie_break=[F.col("id")], count=1)
    assert rows_of(found.select("place", "topic", "id")) == [("P", "x", 2), ("P", "y", 4)]
    assert rows_of(posts.favs_by(frame, ["topic"])) == [("x", 19), ("y", 1)]


def test_trend_names(spark):
    trend = F.struct(F.lit("#a").alias("name"), F.lit("%23a").alias("query"), F.lit(1).alias("x"))
    row = spark.range(1).select(posts.trend_names(F.array(trend)).alias("t")).first()["t"]
    assert [tuple(t) for t in row] == [("#a", "%23a")]
    assert one(spark, F.url_decode(F.lit("%23a"))) == ("#a",)
