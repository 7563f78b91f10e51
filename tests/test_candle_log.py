"""Upkeep of the candle log, its change feed, and alerts that need no history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candlespark import schemas
from candlespark.session import shared_dir
from candlespark.sinks import candle_log
from candlespark.streaming import trades as jobs

START = dt.datetime(2024, 1, 1)


def candle(symbol, minute, close, count=1):
    at = START + dt.timedelta(minutes=minute)
    return (symbol, at, at + dt.timedelta(minutes=1), close, close, close, close, 1.0, count)


def write(spark, path, batch_id, rows):
    candle_log.append_candle_log(spark.createDataFrame(rows, schemas.CANDLE).coalesce(1), batch_id, path)


def folders(spark, path):
    return candle_log.numbered(spark, f"{path}/log/batch_id=*"), candle_log.numbered(spark, f"{path}/base/upto=*")


def test_folders_stay_few_and_no_state_is_lost(spark):
    path, state, most = shared_dir(spark, "log"), {}, 0
    for batch in range(50):
        rows = [candle("AB"[batch % 2], minute, float(batch)) for minute in (batch % 7, batch)]
        state |= {(r[0], r[1]): r for r in rows}
        for _ in range(1 + (batch % 10 == 4)):  # a repeated batch, sometimes one that has just been compacted
            write(spark, path, batch, list({r[1]: r for r in rows}.values()))
            candle_log.upkeep(spark, path, batch, every=5, keep=6)
        batches, bases = folders(spark, path)
        most = max(most, len(batches) + len(bases))
    assert most <= 6 + 2 * 5 + 3
    assert sorted(map(tuple, candle_log.latest_candles_view(spark, path).collect())) == sorted(state.values())
    batches, bases = folders(spark, path)
    assert batches == list(range(40, 50)) and bases == [39, 44, 49]
    for upto in (44, 46, 49):  # states of the last batches can be read
        assert candle_log.latest_candles_view(spark, path, upto).agg(F.max("close")).first()[0] == float(upto)


def test_unfinished_bases_do_not_count(spark):
    path = shared_dir(spark, "log")
    for batch in range(3):
        write(spark, path, batch, [candle("A", batch, 1.0)])
    spark.createDataFrame([candle("A", 99, 9.0)], schemas.CANDLE).write.parquet(f"{path}/base/upto=2")
    candle_log.remove(spark, f"{path}/base/upto=2/_SUCCESS")
    assert candle_log.finished_bases(spark, path) == [] and candle_log.prune(spark, path, 0) == []
    assert candle_log.latest_candles_view(spark, path).count() == 3


def test_feed_goes_on_after_batches_were_removed(spark, plan):
    path = shared_dir(spark, "log")
    for batch in range(6):
        write(spark, path, batch, [candle("A", 0, float(batch)), candle("A", batch, float(batch))][batch == 0 :])
    kinds = lambda df: sorted((r.batch_id, r.start_time.minute, r.change) for r in df.collect())
    whole = kinds(candle_log.candle_changes(spark, path))
    assert [k for k in whole if k[2] == "insert"] == [(b, b, "insert") for b in range(6)] and len(whole) == 11
    candle_log.compact(spark, path, 1)
    candle_log.compact(spark, path, 3)
    assert kinds(candle_log.candle_changes(spark, path)) == whole
    for after in (-1, 0, 1, 3, 4, 5):
        assert kinds(candle_log.candle_changes(spark, path, after)) == [k for k in whole if k[0] > after]
    assert candle_log.prune(spark, path, 2) == ["log/batch_id=0", "log/batch_id=1"]
    assert kinds(candle_log.candle_changes(spark, path)) == [k for k in whole if k[0] > 1]
    assert kinds(candle_log.candle_changes(spark, path, 4)) == [k for k in whole if k[0] > 4]
    text = plan(candle_log.candle_changes(spark, path, 4))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def crossings(state, threshold):
    out, symbols = [], {s for s, _ in state}
    for symbol in symbols:
        previous = None
        for at in sorted(t for s, t in state if s == symbol):
            close = state[symbol, at]
            if previous is not None and (previous < threshold) != (close < threshold):
                out.append((symbol, at, close, previous, "up" if previous < threshold else "down"))
            previous = close
    return sorted(out)


@pytest.mark.parametrize("late", [False, True])
def test_alerts_read_history_only_for_late_candles(spark, monkeypatch, late):
    rng, state = random.Random(6), {}
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    path, target = paths.data("c"), paths.data("alerts")
    reads, real = [], jobs.logged_candles
    monkeypatch.setattr(jobs, "logged_candles", lambda *a: (reads.append(a[-1]), real(*a))[1])
    alert = jobs.alert_on_batch(path, target, 5.0, remember=3)
    for batch in range(7):
        rows = {}
        for symbol in "AB":
            # In order: from the newest candle but one on. Late: anywhere.
            low = 0 if late else max(0, 3 * batch - 2)
            for minute in rng.sample(range(low, 3 * batch + 3), 3):
                rows[symbol, minute] = candle(symbol, minute, float(rng.randrange(10)))
        write(spark, path, batch, list(rows.values()))
        state |= {(s, START + dt.timedelta(minutes=m)): r[6] for (s, m), r in rows.items()}
        for _ in range(1 + batch % 2):  # repeated batches write the same
            alert(spark.createDataFrame(list(rows.values()), schemas.CANDLE), batch)
        assert sorted(map(tuple, jobs.latest_alerts(spark, target).drop("batch_id").collect())) == crossings(state, 5.0)
    assert len(candle_log.numbered(spark, f"{target}-state/batch_id=*")) <= 4
    # The first batch looks for a log that is older than the alerts.
    assert (set(reads) > {-1}) if late else (set(reads) == {-1})


def test_alerts_may_start_on_an_older_log(spark):
    paths = jobs.StreamPaths(shared_dir(spark, "stream"))
    path, target = paths.data("c"), paths.data("alerts")
    write(spark, path, 0, [candle("A", 0, 1.0), candle("A", 1, 9.0)])
    write(spark, path, 1, [candle("A", 2, 1.0)])
    jobs.alert_on_batch(path, target, 5.0)(spark.createDataFrame([candle("A", 2, 1.0)], schemas.CANDLE), 1)
    (found,) = jobs.latest_alerts(spark, target).collect()
    assert (found.start_time.minute, found.direction, found.previous) == (2, "down", 9.0)
