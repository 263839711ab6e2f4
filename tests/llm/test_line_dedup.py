from __future__ import annotations

from tallyloom.llm import line_dedup as op


def brute(rows, ratio, least):
    pages, lines = {}, {}
    for _, text, host in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in set((text or "").split("\n")):
            if line.strip(" "):
                lines[host, line] = lines.get((host, line), 0) + 1
    gone = {k for k, n in lines.items() if n >= least and n / pages[k[0]] > ratio}
    out = []
    for doc_id, text, host in rows:
        split = (text or "").split("\n")
        kept = [line for line in split if (host, line) not in gone]
        out.append((doc_id, text if len(kept) == len(split) else "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in frame.collect()), key=str)


def test_equals_brute_force(make):
    rows = [(i, f"menu\nunique {i}\nshared {i % 4}\n\nmenu", f"s{i % 3}") for i in range(60)]
    rows += [(70, None, "s0"), (71, "", "s0"), (72, "menu", None), (73, "menu", None), (None, "menu\nx", "s1")]
    rows += [(74, "menu\nonly", "small"), (75, "menu", "s2"), (75, "menu", "s2"), (76, "a\r\nmenu\n" * 5000, "s2")]
    for ratio, least in ((0.5, 3), (0.2, 5), (0.99, 1)):
        assert rows_of(op.without_boilerplate(make(rows), "source", ratio, least)) == brute(rows, ratio, least)


def test_columns_and_no_rows(make, empty):
    assert op.without_boilerplate(empty).collect() == []
    out = op.without_boilerplate(make([(1, "x")]))
    assert out.columns == [c for c in make([]).columns if c != "n_removed"] + ["n_lines", "n_removed"]


def test_small_hosts_have_boilerplate(make):
    rows = [(i, f"menu\nonly {i}", "small") for i in range(4)] + [(9, "menu", "single")]
    out = op.without_boilerplate(make(rows)).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {**{i: f"only {i}" for i in range(4)}, 9: "menu"}


def test_any_column_names(spark):
    names = ["drop", "lines", "kept", "row", "host", "of", "_drop", "_kept", "a.b"]
    rows = [(i, f"menu\n{i}", "s", *names) for i in range(3)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    out = op.without_boilerplate(frame)
    assert out.columns == ["doc_id", "text", "source", *names, "n_lines", "n_removed"]
    assert sorted(map(tuple, out.collect())) == [(i, str(i), "s", *names, 2, 1) for i in range(3)]
