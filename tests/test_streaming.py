from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import offsets
from tallyloom.operators.mentions import explode_mentions, sliding_counts
from tallyloom.operators.merge import CountingUpsert, read_batches, read_offsets, read_snapshot
from tallyloom.operators.posts import NESTED_POST_SCHEMA, post_tuple, project_post
from tallyloom.operators.ticks import tick_times, ticked_places
from tallyloom.session import require_conf, scratch_dir
from tallyloom.sources import files
from tallyloom.sources.cells import counter_cells
from tallyloom.sources.payload import parse_payload
from tallyloom.streaming import sinks, sources
from tests.conftest import rows_of

START = datetime.datetime(2024, 1, 1)
WORDS = ["Miles Davis", "Chopin"]


def moment(second: float) -> datetime.datetime:
    return START + datetime.timedelta(seconds=second)


@pytest.fixture
def post_files(spark, tmp_path):
    """Three files of posts, out of time order, one file per micro-batch."""
    folder = tmp_path / "posts"
    batches = [
        [(5, "Chopin", "es"), (130, "chopin, Miles Davis", "en")],
        [(1, "chopin", "es"), (19, "nothing", "es")],
        [(61, "Chopin", "es"), (5, "miles davis", "en")],
    ]
    for number, rows in enumerate(batches):
        shaped = [(moment(s), text, lang) for s, text, lang in rows]
        frame = spark.createDataFrame(shaped, "ts timestamp_ntz, text string, lang string")
        frame.coalesce(1).write.parquet(str(folder / f"part{number}"))
    return str(folder)


def stream_of(spark, folder, schema):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", "true").parquet(folder)


def test_windowed_mentions_as_stream_equal_the_batch(spark, post_files, tmp_path):
    batch = spark.read.option("recursiveFileLookup", "true").parquet(post_files)
    keys = ["word", "lang"]
    want = rows_of(sliding_counts(explode_mentions(batch, WORDS), "ts", keys))
    stream = explode_mentions(stream_of(spark, post_files, batch.schema), WORDS)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    sinks.run_available(sliding_counts(stream, "ts", keys), sinks.updates_sink(out), checkpoint, "update")
    assert read_batches(spark, out).select("batch_id").distinct().count() == 3
    got = sinks.latest_updates(spark, out, ["win_start", *keys], "n")
    assert rows_of(got.select("win_start", *keys, "n")) == want and len(want) > 5


def test_watermarked_stream_appends_closed_windows(spark, post_files, tmp_path):
    schema = "ts timestamp, text string, lang string"
    batch = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(post_files)
    batch.coalesce(1).write.parquet(str(tmp_path / "utc"))
    stream = explode_mentions(stream_of(spark, str(tmp_path / "utc"), schema), WORDS)
    counted = sliding_counts(stream.withWatermark("ts", "10 seconds"), "ts", ["word"])
    out = str(tmp_path / "out")
    sinks.run_available(counted, sinks.append_sink(out), str(tmp_path / "c"))
    closed = {(r["win_start"], r["word"], r["n"]) for r in read_batches(spark, out).collect()}
    everything = sliding_counts(explode_mentions(batch, WORDS), "ts", ["word"])
    whole = {(r["win_start"], r["word"], r["n"]) for r in everything.collect()}
    end = moment(130 - 10)
    assert closed == {w for w in whole if w[0] + datetime.timedelta(seconds=60) <= end} and closed


def test_mentions_to_snapshot(spark, post_files, tmp_path):
    schema = "ts timestamp_ntz, text string, lang string"
    counts = explode_mentions(stream_of(spark, post_files, schema), WORDS).groupBy("word", "lang").count()
    path = str(tmp_path / "snapshot")
    sink = sinks.snapshot_sink(path, lambda rows: counter_cells(rows, "word", "lang", "count"))
    sinks.run_available(counts, sink, str(tmp_path / "c"), "complete")
    got = read_snapshot(spark, path).select("row_key", "family", "qualifier", "value")
    assert rows_of(got) == [
        ("Chopin", "mentions", "en", "1"),
        ("Chopin", "mentions", "es", "3"),
        ("Miles Davis", "mentions", "en", "2"),
    ]


def test_counting_sink_with_rejects(spark, post_files, tmp_path):
    schema = "ts timestamp_ntz, text string, lang string"
    store = CountingUpsert(str(tmp_path / "t"), ["lang"], ["ts"])
    sink = sinks.counting_sink(store, F.length("text") < 10, str(tmp_path / "bad"))
    for run in range(2):
        # The second run finds nothing new behind the same checkpoint.
        sinks.run_available(stream_of(spark, post_files, schema), sink, str(tmp_path / "c"))
    assert sum(r["hits"] for r in store.read(spark).collect()) == 4
    assert {r["text"] for r in read_batches(spark, str(tmp_path / "bad")).collect()} == {
        "chopin, Miles Davis",
        "miles davis",
    }


def test_posts_as_json_stream(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    post = {
        "text": "hi", "lang": "es", "created_at": "2014-03-01T12:33:40",
        "author": {"screen_name": "ann"}, "entities": {"hashtags": [{"text": "b"}, {"text": "A"}]},
    }
    (folder / "a.json").write_text(json.dumps(post) + "\n")
    stream = sources.json_posts(spark, str(folder), NESTED_POST_SCHEMA, max_files_per_trigger=1)
    flat = post_tuple(project_post(stream), F.lit("Madrid"), F.lit("#x"))
    out = str(tmp_path / "out")
    sinks.run_available(flat, sinks.append_sink(out), str(tmp_path / "c"))
    row = read_batches(spark, out).first()
    assert (row["author_screen_name"], row["hashtags_texts"], row["place"]) == ("ann", "A|b", "Madrid")
    assert row["created_at"] == "2014-03-01 12:33:40" and row["favorite_count"] is None


def records(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")


LOG = [("a", "x", "t", 0, 4), ("b", "y", "t", 0, 7), ("c", "z", "t", 1, 2)]


def test_offset_ranges(spark):
    log = records(spark, LOG)
    ranged = offsets.with_batch_offsets(log).select("offset", "from_offset", "until_offset")
    assert rows_of(ranged) == [(2, 2, 3), (4, 4, 8), (7, 4, 8)]
    single = offsets.with_record_offsets(log).select("offset", "from_offset", "until_offset")
    assert rows_of(single) == [(2, 2, 3), (4, 4, 5), (7, 7, 8)]
    assert offsets.envelope(single.join(log, "offset")).columns == offsets.ENVELOPE
    assert rows_of(offsets.handle_messages(log, [F.upper("key")])) == [("A",), ("B",), ("C",)]


def test_offsets_sink_twice(spark, tmp_path):
    sink = sinks.offsets_sink(str(tmp_path / "log"))
    for batch_id in (0, 0, 1):
        sink(records(spark, LOG), batch_id)
    assert read_offsets(spark, str(tmp_path / "log")).count() == 3


def test_payload(spark):
    log = records(spark, [("a", '{"f1": "x", "n": 3}', "t", 0, 1)])
    rows = parse_payload(log.withColumn("value", F.col("value").cast("binary")), "f1 string, n int", "json")
    assert rows.columns == ["key", "topic", "partition", "offset", "f1", "n"]
    assert rows.first()["f1"] == "x"
    with pytest.raises(Exception):
        parse_payload(records(spark, [("a", "{", "t", 0, 1)]), "f1 string", "json").collect()
    with pytest.raises(ValueError):
        parse_payload(log, "f1 string", "xml")


def test_log_options():
    assert sources.starting_offsets("earliest") == "earliest"
    assert json.loads(sources.starting_offsets({"t": {0: 23, 1: -1}})) == {"t": {"0": 23, "1": -1}}
    with pytest.raises(ValueError):
        sources.starting_offsets("middle")
    options = sources.kafka_options("h:9092", ["a", "b"], "latest", 100)
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "100"


def test_ticks_and_bounded_run(spark, tmp_path):
    out = str(tmp_path / "out")
    places = ticked_places(sources.ticks(spark, 2), ["P", "Q"])
    query = sinks.start(
        places, sinks.append_sink(out), str(tmp_path / "c"), trigger={"processingTime": "200 milliseconds"}
    )
    sinks.run_for(query, 8)
    assert not query.isActive
    rows = read_batches(spark, out).collect()
    got = [(r["tick"], r["place"]) for r in rows]
    assert 2 <= len(got) <= 2 * 5 and len(set(got)) == len(got)
    assert set(got) == {(t, p) for t, _ in got for p in "PQ"}
    times = sorted({r["at"] for r in rows})
    assert all((b - a).total_seconds() == 2 for a, b in zip(times, times[1:]))
    frame = spark.createDataFrame([(moment(1),), (moment(9),), (moment(31),)], "ts timestamp_ntz")
    assert rows_of(tick_times(frame, "ts", 10)) == [(moment(s),) for s in (0, 10, 20, 30)]
    days = spark.createDataFrame([(moment(0),), (moment(3 * 86_400),)], "ts timestamp_ntz")
    assert tick_times(days, "ts", 3600).count() == 73


def test_console(spark, post_files, tmp_path):
    stream = stream_of(spark, post_files, "ts timestamp_ntz, text string, lang string")
    query = sinks.console(stream, str(tmp_path / "c"))
    query.processAllAvailable()
    query.stop()


def test_clear_scratch(spark, monkeypatch):
    from tallyloom import session

    monkeypatch.setattr(session, "_SCRATCH", {})
    folder = scratch_dir(spark, "gone")
    spark.range(3).write.parquet(folder)
    session.clear_scratch(spark)
    assert not files.path_exists(spark, folder)


def test_csv_json_and_collections(spark, tmp_path):
    frame = files.rows_table(spark, [("a", 1), ("b", 2)], "k string, n int")
    frame.write.csv(str(tmp_path / "csv"))
    assert rows_of(files.csv_table(spark, str(tmp_path / "csv"), "k string, n int")) == rows_of(frame)
    with pytest.raises(Exception):
        files.csv_table(spark, str(tmp_path / "csv"), "k int, n int").collect()
    config = '{"Madrid": {"lat": 40.4, "long": -3.6833}}'
    places = files.places_rows(spark.createDataFrame([(config,)], "config string"))
    assert rows_of(places) == [("Madrid", 40.4, -3.6833)]
    with pytest.raises(ValueError):
        files.jdbc_table(spark, "jdbc:x", "t", partition_column="k")


def test_scratch_dir_needs_a_shared_folder_on_a_cluster(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:
            get = staticmethod(lambda _name, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster, "x")


def test_path_uri(spark):
    assert files.path_uri(spark, "/tmp/x") == "file:///tmp/x"
    assert files.path_uri(spark, "file:///tmp/x") == "file:///tmp/x"


def test_required_conf(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert require_conf(spark).conf.get("spark.sql.session.timeZone") == "UTC"
