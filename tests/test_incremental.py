"""Micro-batches over arriving files."""

from datetime import datetime

from conftest import rows

from starloom.sources.files import text_schema
from starloom.streaming import incremental

COLUMNS = ["course_id", "platform", "title", "description", "skills", "course_url", "line"]


def drop(folder, name, *lines):
    head = ",".join(COLUMNS)
    (folder / name).write_text("\n".join([head, *[f"{i},P,{t},d,s,/u,{n}" for i, t, n in lines]]) + "\n")


def test_seen_ids_are_skipped(spark, tmp_path):
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()

    def run():
        stream = incremental.new_files(spark, str(feed), text_schema(COLUMNS))
        incremental.append_unseen(stream, out, "course_id", "line", "unseen").awaitTermination()
        return rows(spark.read.parquet(out).select("course_id", "title"))

    drop(feed, "1.csv", (1, "a", 1), (2, "b", 2), (2, "b2", 3))
    assert run() == [("1", "a"), ("2", "b2")]
    assert run() == [("1", "a"), ("2", "b2")]
    drop(feed, "2.csv", (2, "c", 1), (3, "d", 2))
    assert run() == [("1", "a"), ("2", "b2"), ("3", "d")]


def test_history_follows_the_files(spark, tmp_path):
    feed, out = tmp_path / "feed", str(tmp_path / "history")
    feed.mkdir()
    days = ["2024-01-01", "2024-02-01"]

    def run():
        stream = incremental.new_files(spark, str(feed), text_schema(COLUMNS))
        incremental.merge_history(stream, out, lambda n: days[n], "history").awaitTermination()

    drop(feed, "1.csv", (1, "a", 1), (2, "b", 1))
    run()
    drop(feed, "2.csv", (1, "a", 2), (2, "b2", 2))
    run()
    got = incremental.read_history(spark, out, 1).select("course_id", "title", "valid_from", "valid_to")
    first, second = (datetime.fromisoformat(d) for d in days)
    assert rows(got) == sorted([("1", "a", first, None), ("2", "b", first, second), ("2", "b2", second, None)], key=repr)


def files(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def test_a_batch_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    feed, out = tmp_path / "feed", tmp_path / "history"
    feed.mkdir()

    def run():
        stream = incremental.new_files(spark, str(feed), text_schema(COLUMNS))
        incremental.merge_history(stream, str(out), lambda n: f"2024-0{n + 1}-01", "buckets").awaitTermination()

    state = {i: [("a", 0, None)] for i in range(300)}

    def plain(number, changes):
        for i, title in changes:
            versions = state.setdefault(i, [])
            if not versions or versions[-1][0] != title:
                if versions:
                    versions[-1] = (*versions[-1][:2], number)
                versions.append((title, number, None))

    drop(feed, "0.csv", *[(i, "a", 0) for i in range(300)])
    run()
    whole = files(out / "open")
    many = len({f.split("/")[1] for f in whole})
    assert many > 100
    batches = [[(1, "b"), (2, "a")], [(1, "c")], [(777, "new"), (1, "c")], [(3, "x"), (1, "d")]]
    for number, changes in enumerate(batches, 1):
        drop(feed, f"{number}.csv", *[(i, t, number) for i, t in changes])
        run()
        plain(number, changes)
        written = {f for f in files(out / "open") if f.startswith(f"batch={number}/")}
        assert 1 <= len(written) <= len(changes)
        got = incremental.read_history(spark, str(out), number).select("course_id", "title", "valid_from", "valid_to").collect()
        assert sorted((int(r[0]), r[1], r[2].month - 1, r[3] and r[3].month - 1) for r in got) == sorted(
            (i, *v) for i, versions in state.items() for v in versions)
    # the first batch's buckets that the batches before the last touched are gone, the others are as they were written
    left = {f for f in files(out / "open") if f.startswith("batch=0/")}
    assert left < whole and len({f.split("/")[1] for f in left}) in (many - 4, many - 3, many - 2)
    assert len(files(out / "open")) < many + 6


def test_a_batch_reads_the_buckets_that_it_hits_only(spark, tmp_path, monkeypatch):
    feed, out = tmp_path / "feed", tmp_path / "out"
    feed.mkdir()
    opened = []
    real = incremental._seen_ids
    monkeypatch.setattr(incremental, "_seen_ids", lambda s, base, buckets, *rest: opened.append(list(buckets)) or real(s, base, buckets, *rest))

    def run():
        stream = incremental.new_files(spark, str(feed), text_schema(COLUMNS))
        incremental.append_unseen(stream, str(out), "course_id", "line", "seen-buckets").awaitTermination()

    def ids():
        return sorted(int(r[0]) for r in spark.read.parquet(str(out)).select("course_id").collect())

    drop(feed, "0.csv", *[(i, "a", i) for i in range(400)])
    run()
    drop(feed, "1.csv", *[(i, "b", i) for i in range(398, 405)])
    run()
    drop(feed, "2.csv", *[(i, "c", i) for i in (5, 404, 405, 405, 406)])
    run()
    drop(feed, "3.csv", *[(i, "d", i) for i in range(1000, 1010)])
    run()
    assert ids() == sorted([*range(407), *range(1000, 1010)])
    assert opened[0] == [] and opened[3] == [] and 1 <= len(opened[1]) <= 2 and 1 <= len(opened[2]) <= 2


def test_a_batch_that_is_run_again_neither_loses_nor_doubles_ids(spark, tmp_path, frame):
    """The work of one batch, done twice, as after a lost commit."""
    out = str(tmp_path / "out")
    schema = "course_id string, line int"
    batches = [[("a", 1), (None, 2), ("b", 3)], [("b", 4), ("c", 5), (None, 6)], [("c", 7), ("d", 8)]]

    class Stream:
        """Takes the place of a stream: hands over each batch, the second one twice."""
        sparkSession, schema = spark, frame([], "course_id string, line int").schema

    done = []
    real = incremental._run
    try:
        incremental._run = lambda stream, name, each: done.append(each)
        incremental.append_unseen(Stream, out, "course_id", "line", "again")
    finally:
        incremental._run = real
    for number, repeat in ((0, 1), (1, 2), (2, 1)):
        for _ in range(repeat):
            done[0](frame(batches[number], schema), number)
    got = rows(spark.read.parquet(out).select("course_id"))
    assert [r for r in got if r[0] is not None] == [("a",), ("b",), ("c",), ("d",)]
