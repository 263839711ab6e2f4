from __future__ import annotations

import datetime
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.merge import read_batches
from tallyloom.streaming import sinks, windows
from tallyloom.streaming.windows import sliding_totals

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "arrived timestamp, word string, favs int"


def batch_of(spark, folder, number, rows):
    stamped = [(None if s is None else START + datetime.timedelta(seconds=s), *rest) for s, *rest in rows]
    spark.createDataFrame(stamped, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{number:03}")


def stream_of(spark, folder):
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", "true").parquet(str(folder))


def brute(batches, weigh=lambda favs: 1, window=60, slide=20):
    """Every row in each of its windows, by plain counting."""
    n, last = Counter(), max(s for rows in batches for s, *_ in rows if s is not None)
    for rows in batches:
        for second, word, favs in rows:
            if second is not None:
                for start in range(second // slide * slide - window + slide, second + 1, slide):
                    n[start, word] += weigh(favs)
    closed = last // slide * slide
    return {(start, word): total for (start, word), total in n.items() if start + window <= closed}


def totals_in(spark, out):
    rows = read_batches(spark, str(out)).collect()
    found = {(round((r["win_start"] - START.replace(tzinfo=None)).total_seconds()), r["word"]): r["n"] for r in rows}
    assert len(found) == len(rows)
    return found


BATCHES = [
    [(1, "a", 3), (1, "a", None), (2, None, 1), (None, "a", 9)],
    [(3, "a", 5), (19, "b", -2), (25, "b", 2)],
    [(41, "b", 1), (41, "c", 1)],
    [(300, "b", 4)],
    [(305, "a", 4), (330, "c", 0)],
    [(1000, "z", 1)],
]


@pytest.mark.parametrize("weighted", [False, True])
def test_totals_of_stamped_batches_equal_plain_counting(spark, tmp_path, weighted):
    out, checkpoint = tmp_path / "out", str(tmp_path / "checkpoint")
    weight = F.col("favs") if weighted else None
    # One run per batch: state and watermark come back from the checkpoint.
    for number, rows in enumerate(BATCHES):
        batch_of(spark, tmp_path / "in", number, rows)
        totals = sliding_totals(stream_of(spark, tmp_path / "in"), "arrived", ["word"], weight=weight)
        sinks.run_available(totals, sinks.append_sink(str(out)), checkpoint)
    want = brute(BATCHES, (lambda favs: favs or 0) if weighted else lambda favs: 1)
    got = totals_in(spark, out)
    # Idle keys have windows of their own, and a sum of zero is a total too.
    assert got == want and (260, "c") not in want and (40, "c") in want
    assert not weighted or 0 in got.values()


def test_state_holds_panes_of_open_windows_only(spark, tmp_path):
    rows = [(s, f"w{s % 3}", 1) for s in range(0, 400)] * 5
    batch_of(spark, tmp_path / "in", 0, rows)
    batch_of(spark, tmp_path / "in", 1, [(5000, "end", 1)])
    totals = sliding_totals(stream_of(spark, tmp_path / "in"), "arrived", ["word"], 120, 10)
    query = sinks.start(totals, sinks.append_sink(str(tmp_path / "out")), str(tmp_path / "c"), trigger={"availableNow": True})
    query.awaitTermination()
    kept = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(kept) == 4 and kept[-1] == 1
    assert totals_in(spark, tmp_path / "out") == brute([rows, [(5000, "end", 1)]], window=120, slide=10)


def test_a_clock_ends_windows_without_rows(spark, tmp_path):
    batch_of(spark, tmp_path / "in", 0, [(5, "a", 1)])
    batch_of(spark, tmp_path / "ticks", 0, [(600, None, None)])
    clock = stream_of(spark, tmp_path / "ticks").select(F.col("arrived").alias("at"))
    totals = sliding_totals(stream_of(spark, tmp_path / "in"), "arrived", ["word"], clock=clock)
    sinks.run_available(totals, sinks.append_sink(str(tmp_path / "out")), str(tmp_path / "c"))
    assert totals_in(spark, tmp_path / "out") == {(-40, "a"): 1, (-20, "a"): 1, (0, "a"): 1}


def test_a_window_is_a_multiple_of_its_slide(spark, tmp_path):
    batch_of(spark, tmp_path / "in", 0, [(5, "a", 1)])
    with pytest.raises(ValueError):
        sliding_totals(stream_of(spark, tmp_path / "in"), "arrived", ["word"], 50, 20)


@pytest.mark.parametrize("slide", [10, 60])
def test_a_backlog_of_one_key_is_many_small_states(spark, tmp_path, monkeypatch, slide):
    monkeypatch.setattr(windows, "STRETCH", 16)
    pick = random.Random(slide)
    backlog = [(pick.randrange(6000) * 2, "a", 1) for _ in range(700)]
    batches = [backlog, [(11990 + s, "a", 1) for s in range(0, 400, 7)], [(50000, "end", 1)]]
    for number, rows in enumerate(batches):
        batch_of(spark, tmp_path / "in", number, rows)
    totals = sliding_totals(stream_of(spark, tmp_path / "in"), "arrived", ["word"], 60, slide)
    query = sinks.start(totals, sinks.append_sink(str(tmp_path / "out")), str(tmp_path / "c"), trigger={"availableNow": True})
    query.awaitTermination()
    kept = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(kept) > 10 and kept[-1] == 1
    assert totals_in(spark, tmp_path / "out") == brute(batches, window=60, slide=slide)
