from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import commits
from tallyloom.operators.commits import BatchLog
from tallyloom.operators.merge import read_batches, write_batch
from tallyloom.operators.toplists import TopLists
from tallyloom.sources.files import list_names
from tallyloom.streaming.topics import place_posts_stream
from tests.conftest import rows_of


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def seen(spark, log, *paths):
    return [sorted((r["batch_id"], r["n"]) for r in log.read(spark, p).collect()) for p in paths]


def test_tables_show_a_batch_together_or_not_at_all(spark, tmp_path, monkeypatch):
    log, good, bad = BatchLog(f"{tmp_path}/log"), f"{tmp_path}/good", f"{tmp_path}/bad"
    assert log.entries(spark).count() == 0
    log.commit(spark, 0, {good: numbers(spark, 1, 2), bad: numbers(spark, 3)})

    def dies(rows, path, batch_id):
        if path == bad:
            raise RuntimeError("lost")
        write_batch(rows, path, batch_id)

    with monkeypatch.context() as broken:
        broken.setattr(commits, "write_batch", dies)
        with pytest.raises(RuntimeError):
            log.commit(spark, 1, {good: numbers(spark, 4), bad: numbers(spark, 5)})
    # One table holds the batch, neither shows it.
    assert read_batches(spark, good).where("batch_id = 1").count() == 1
    assert seen(spark, log, good, bad) == [[(0, 1), (0, 2)], [(0, 3)]]
    for _ in range(2):
        log.commit(spark, 1, {good: numbers(spark, 4), bad: numbers(spark, 5)})
    assert seen(spark, log, good, bad) == [[(0, 1), (0, 2), (1, 4)], [(0, 3), (1, 5)]]


def test_an_entered_batch_is_not_written_again(spark, tmp_path):
    log, path = BatchLog(f"{tmp_path}/log"), f"{tmp_path}/table"
    log.commit(spark, 7, {path: numbers(spark, 1)})
    log.commit(spark, 7, {path: numbers(spark, 2)})
    assert seen(spark, log, path) == [[(7, 1)]] and log.holds(spark, 7) and not log.holds(spark, 8)


def test_an_entry_that_was_cut_short_does_not_count(spark, tmp_path):
    log, path = BatchLog(f"{tmp_path}/log"), f"{tmp_path}/table"
    log.commit(spark, 0, {path: numbers(spark, 1)})
    (tmp_path / "log" / "batch_id=1" / "_temporary").mkdir(parents=True)
    write_batch(numbers(spark, 9), path, 1)
    assert seen(spark, log, path) == [[(0, 1)]]
    log.commit(spark, 1, {path: numbers(spark, 2)})
    assert seen(spark, log, path) == [[(0, 1), (1, 2)]]


def best(rows, k):
    want = set()
    for topic in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == topic]
        mine.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {(*r, rank) for rank, r in enumerate(mine[:k], 1)}
    return want


@pytest.mark.parametrize("key", [(), ("id",)])
def test_lists_equal_the_first_rows_of_all_batches(spark, tmp_path, key):
    pick = random.Random(5)
    rows = [(pick.choice(["hot", "hot", "b", None]), pick.choice([None, 1, 2, 3, 9]), i, f"text {i}") for i in range(120)]
    lists = TopLists(f"{tmp_path}/lists", "topic", "favs", ["id"], 4, key=key)
    with pytest.raises(ValueError):
        lists.read(spark)
    for number in range(6):
        part = spark.createDataFrame(rows[number * 20 : number * 20 + 20], "topic string, favs int, id int, text string")
        for _ in range(2):
            lists.write(part, number)
            assert {tuple(r) for r in lists.read(spark).collect()} == best(rows[: number * 20 + 20], 4)
    assert len(list_names(spark, lists.path)) == lists.keep


def test_an_empty_batch_leaves_the_lists(spark, tmp_path):
    lists = TopLists(f"{tmp_path}/lists", "topic", "favs", ["id"], 2)
    rows = spark.createDataFrame([("a", 1, 1)], "topic string, favs int, id int")
    lists.write(rows, 0)
    lists.write(rows.where("false"), 1)
    assert rows_of(lists.read(spark)) == [("a", 1, 1, 1)]


def nested_posts(spark, rows):
    flat = spark.createDataFrame(rows, "topic string, favorite_count bigint, id int, text string")
    return flat.withColumns(
        {
            "created_at": F.lit("2014-03-02").cast("timestamp_ntz"),
            "author": F.struct(F.lit("me").alias("screen_name")),
            "entities": F.struct(F.array(F.struct(F.lit("tag").alias("text"))).alias("hashtags")),
        }
    )


def test_places_read_the_lists_of_the_moment(spark, tmp_path):
    lists = TopLists(f"{tmp_path}/lists", "topic", "favorite_count", ["id"], 2)
    trends = spark.createDataFrame([("Madrid", "a"), ("Madrid", "none"), ("Donostia", "b")], "place string, topic string")
    flow = place_posts_stream(None, trends, lists.read, "topic", ["id"], count=2)
    places = spark.createDataFrame([("Madrid",), ("Madrid",), ("Oslo",)], "place string")
    log = BatchLog(f"{tmp_path}/log")
    sink = flow.into_tables(log, f"{tmp_path}/posts", f"{tmp_path}/rejects")
    lists.write(nested_posts(spark, [("a", 5, 1, "x"), ("a", 7, 2, "y")]), 0)
    sink(places, 0)
    lists.write(nested_posts(spark, [("a", 6, 3, "z"), ("b", 1, 4, "w")]), 1)
    sink(places, 1)
    posts = log.read(spark, f"{tmp_path}/posts").select("batch_id", "place", "text", "favorite_count")
    assert rows_of(posts) == [(0, "Madrid", "x", 5), (0, "Madrid", "y", 7), (1, "Madrid", "y", 7), (1, "Madrid", "z", 6)]
    missing = log.read(spark, f"{tmp_path}/rejects").where("batch_id = 1").select("place", F.coalesce("topic", F.lit("-")))
    assert rows_of(missing) == [("Madrid", "none"), ("Oslo", "-")]
