"""Windows of a stream of files: equal to those of the table, late rows, state that is taken up again."""

import datetime as dt
import time

import pytest

from ratelens.streaming.windows import event_files, run_available, sessions, windowed

START = dt.datetime(2024, 1, 1)


def rows(times, user="u"):
    return [(user, START + dt.timedelta(seconds=t), float(t % 7)) for t in times]


@pytest.fixture
def folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    number = iter(range(100))

    def add(data):
        """One more file, later than the ones before."""
        part = tmp_path / f"part{next(number)}"
        spark.createDataFrame(data, "user string, ts timestamp, value double").coalesce(1).write.parquet(str(part))
        file = next(part.glob("*.parquet"))
        time.sleep(0.02)
        file.rename(tmp_path / "in" / f"{part.name}.parquet")
        return spark.read.parquet(str(tmp_path / "in"))

    add.path = str(tmp_path / "in")
    add.out = str(tmp_path / "out")
    return add


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("slide", [None, "20 seconds"])
def test_stream_equals_table(spark, folder, slide):
    table = folder(rows(range(0, 600, 7)) + rows(range(3, 400, 11), "v"))
    stream = event_files(spark, folder.path, table.schema)
    closed = run_available(windowed(stream, ["user"], "value", "1 minute", slide), "w", folder.out)
    latest = START + dt.timedelta(seconds=595)
    whole = windowed(table, ["user"], "value", "1 minute", slide)
    assert collected(closed) == [r for r in collected(whole) if r[2] <= latest]


def test_late_rows_within_the_delay_count_and_others_do_not(spark, folder):
    folder(rows([0, 10, 200]))
    folder(rows([201]))
    late = rows([50, 130])  # the watermark stands at 200 - 100: the window of 50 is closed, that of 130 is not
    table = folder(late)
    folder(rows([1000]))
    stream = event_files(spark, folder.path, table.schema, files_at_once=1)
    closed = run_available(windowed(stream, ["user"], "value", "1 minute", delay="100 seconds"), "w", folder.out)
    got = {(r["Window_Start"] - START).seconds: r["Events"] for r in closed.collect()}
    assert got == {0: 2, 120: 1, 180: 2}


def test_a_later_call_goes_on(spark, folder):
    table = folder(rows([0, 10, 70]))

    def run():
        stream = event_files(spark, folder.path, table.schema)
        return {(r["Window_Start"] - START).seconds: r["Events"] for r in run_available(windowed(stream, ["user"], "value", "1 minute"), "w", folder.out).collect()}

    assert run() == {0: 2}
    assert run() == {0: 2}
    folder(rows([80, 300]))
    assert run() == {0: 2, 60: 2}


def brute_sessions(data, gap):
    out = {}
    for user in {u for u, _, _ in data}:
        own = sorted((t, v) for u, t, v in data if u == user)
        groups = []
        for t, v in own:
            if groups and t - groups[-1][-1][0] <= gap:
                groups[-1].append((t, v))
            else:
                groups.append([(t, v)])
        for group in groups:
            out[user, group[0][0]] = (user, group[0][0], group[-1][0] + gap, len(group), sum(v for _, v in group),
                                      min(v for _, v in group), max(v for _, v in group))
    return sorted(out.values())


def test_sessions(spark, folder):
    times = [0, 5, 9, 20, 29, 39, 60, 61, 90, 100, 101, 102, 300]
    data = rows(times) + rows([1, 2, 40, 49, 200], "v")
    table = folder(data[::2])
    folder(data[1::2])  # joins sessions of the first file
    gap = dt.timedelta(seconds=10)
    want = brute_sessions(data, gap)
    assert collected(sessions(spark.read.parquet(folder.path), ["user"], "value", "10 seconds")) == want
    stream = event_files(spark, folder.path, table.schema, files_at_once=1)
    closed = run_available(sessions(stream, ["user"], "value", "10 seconds", delay="500 seconds"), "s", folder.out)
    assert collected(closed) == []  # none is older than the delay
    folder(rows([2000]))
    stream = event_files(spark, folder.path, table.schema, files_at_once=1)
    closed = run_available(sessions(stream, ["user"], "value", "10 seconds", delay="500 seconds"), "s", folder.out)
    assert collected(closed) == want
