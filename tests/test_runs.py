"""State that runs and batches carry on: the stream's ledger, fetch state, the stored
watchlist, exports by day."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import watchlist
from tidemark.sources import bhavcopy, landing, storage, widgets
from tidemark.streaming import fetch_state, ingest


def csv(symbols):
    return "\n".join([",".join(bhavcopy.BHAVCOPY_COLUMNS), *(f"{s},EQ,01-Jan-2024,1,1,1,1,1,1,1,5,1,1,5,1" for s in symbols)]) + "\n"


def files(spark, named):
    return spark.createDataFrame([(f"sec_bhavdata_full_{d}012024.csv", csv(s)) for d, s in named], "filename string, content string")


def test_a_replayed_batch_is_skipped_unread(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    batch = files(spark, [("05", "AB"), ("05", "AB"), ("08", "C")])
    assert ingest.append_batch(batch, "q", 0, bronze)
    broken = batch.withColumn("content", F.raise_error(F.lit("read")).cast("string"))
    assert not ingest.append_batch(broken, "q", 0, bronze)
    assert ingest.append_batch(files(spark, [("08", "D"), ("09", "E")]), "q", 1, bronze)
    assert sorted(r.SYMBOL for r in ingest.read_bronze(spark, bronze).collect()) == list("ABCE")
    assert ingest.committed(spark, bronze) == ["q-0", "q-1"]
    assert ingest.read_bronze(spark, str(tmp_path / "none")).count() == 0


def test_a_batch_that_died_before_its_commit_is_written_anew(spark, tmp_path, monkeypatch):
    bronze = str(tmp_path / "bronze")

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(storage, "put_new", dies)
        with pytest.raises(KeyboardInterrupt):
            ingest.append_batch(files(spark, [("05", "AB")]), "q", 0, bronze)
    assert ingest.read_bronze(spark, bronze).count() == 0
    assert ingest.append_batch(files(spark, [("05", "AB")]), "q", 0, bronze)
    assert ingest.read_bronze(spark, bronze).count() == 2


def tasks_of(spark, group):
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return [i.numTasks for i in map(tracker.getStageInfo, stages) if i is not None]


def test_a_folder_for_each_file_is_listed_by_a_few_tasks(spark, tmp_path):
    """By the stream, and by the batch path; both read every file."""
    sc, landed, bronze = spark.sparkContext, tmp_path / "landing", str(tmp_path / "bronze")
    most = 4 * sc.defaultParallelism
    names = [f"sec_bhavdata_full_b{i}_05012024.csv" for i in range(most + 40)]
    for i, name in enumerate(names):
        (landed / f"filename={name}").mkdir(parents=True)
        (landed / f"filename={name}" / "part-0.txt").write_text(csv([f"S{i}"]))
    query = ingest.stream_ingest(spark, str(landed), bronze, str(tmp_path / "ckpt"))
    assert {r.SYMBOL for r in ingest.read_bronze(spark, bronze).collect()} == {f"S{i}" for i in range(len(names))}
    assert 0 < max(tasks_of(spark, str(query.runId))) <= most
    sc.setJobGroup("land", "")
    try:
        got = landing.land_files(spark, str(landed))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < max(tasks_of(spark, "land")) <= most
    assert sorted(r.filename for r in got.select("filename").collect()) == sorted(names)


def test_the_names_of_a_batch_are_one_file(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    ingest.append_batch(files(spark, [(f"{d:02}", "A") for d in range(1, 29)]).repartition(16), "q", 0, bronze)
    found = [n for n, _ in storage.names(spark, f"{ingest.ledger_path(bronze)}/q-0")]
    assert len([n for n in found if n.endswith(".parquet")]) == 1


def test_landing_writes_nothing_beside_the_files(spark, tmp_path):
    """No checksum files: on a local disk each costs a process."""
    folder = tmp_path / "landing"
    landing.write_landing(files(spark, [("05", "A"), ("08", "B")]), str(folder))
    found = [p for p in folder.glob("filename=*/*") if p.is_file()]
    assert len(found) == 2 and not [p for p in found if p.name.endswith(".crc")]


def test_landing_starts_no_process_for_a_file(spark, tmp_path):
    """Odd names, repeated ones and texts without end are as Spark's writer has them."""
    started = lambda: int(re.search(r"(?m)^processes (\d+)$", open("/proc/stat").read())[1])
    raw = [(f"f{i}_05012024.csv", f"é{i}\n") for i in range(600)] + [("a/b=c d%\"[x]'{^?*#:\\.csv", "x"), ("twice.csv", "a\n"), ("twice.csv", "b"), ("none.csv", None)]
    df = spark.createDataFrame(raw, "filename string, content string")
    landing.write_landing(df.limit(1), str(tmp_path / "warm"))
    before = started()
    landing.write_landing(df, str(tmp_path / "landing"))
    assert started() - before < 600
    few = df.filter("filename not like 'f%' or filename like 'f7_%'")
    few.repartition(1).write.partitionBy("filename").text(str(tmp_path / "plain"))
    landing.write_landing(few, str(tmp_path / "few"))
    read = lambda d: sorted((r.filename, sorted(r.content.split())) for r in landing.read_landing(spark, str(tmp_path / d)).collect())
    assert read("few") == read("plain") and len(read("few")) == 14 and len(read("landing")) == 603


def test_a_line_is_parsed_once(spark):
    """The stock filter does not parse it again."""
    raw = spark.createDataFrame([("a_05012024.csv", csv(["A"]))], "filename string, content string")
    plan = bhavcopy.bronze_rows(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_a_batch_reads_no_bronze(spark, tmp_path, monkeypatch):
    """The bronze folders of earlier batches may even be gone."""
    bronze = str(tmp_path / "bronze")
    ingest.append_batch(files(spark, [("05", "A")]), "q", 0, bronze)
    storage.delete(spark, f"{bronze}/q-0")
    assert ingest.append_batch(files(spark, [("05", "A"), ("08", "B")]), "q", 1, bronze)
    assert [r.SYMBOL for r in spark.read.parquet(f"{bronze}/q-1").collect()] == ["B"]


# ---------------------------------------------------------------- fetch state
ATTEMPT = "feed string, filename string, ts timestamp, seq long, status int"


def fold(attempts, limit=5, keep=365):
    out = {}
    for feed in {a[0] for a in attempts}:
        run, made, reached, stop, strikes = 0, 0, False, (None, None), {}
        own = sorted((a for a in attempts if a[0] == feed), key=lambda a: a[2:4])
        for _, name, ts, seq, status in own:
            if reached and stop[0] is None:
                stop = (ts, seq)
            if not reached:
                made += 1
                if status is not None:
                    run = 0 if status in (200, 0) else run + 1
                    reached = run >= limit
            if status == 404:
                strikes[name] = (strikes.get(name, (0, ts))[0] + 1, ts)
            elif status == 200:
                strikes.pop(name, None)
        last = own[-1][2]
        out[feed] = (made, reached, *stop, {f: n for f, (n, t) in strikes.items() if (last - t).days <= keep})
    return out


@pytest.mark.parametrize("keep", [365, 3])
def test_state_over_batches_is_that_of_one_log(spark, tmp_path, keep):
    r = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    feeds = ["a", "b", "c", None]
    log = [(f, f"f{r.randrange(4)}", start + dt.timedelta(hours=h), h, r.choice([404, 404, 404, 200, 500, -1, 0, None])) for h in range(240) for f in feeds if r.random() < 0.6]
    log += [("late", "x", start + dt.timedelta(days=9), 1, 404)]
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "ckpt"))
    for part in (log[:150], log[150:151], log[151:]):
        spark.createDataFrame(part, ATTEMPT).write.mode("append").parquet(path)
        fetch_state.run_fetch_state(spark, path, ATTEMPT, out, checkpoint, keep_days=keep)
    fetch_state.run_fetch_state(spark, path, ATTEMPT, out, checkpoint, keep_days=keep)  # nothing new
    got = {x.feed: (x.rows_made, x.reached_limit, x.stop_ts, x.stop_seq, x.strikes) for x in fetch_state.latest_state(spark, out).collect()}
    want = fold(log, keep=keep)
    if keep == 365:
        assert got == want
    else:  # an expired file starts anew, so its count may be lower than that of one log
        assert {f: x[:4] for f, x in got.items()} == {f: x[:4] for f, x in want.items()}
        assert all(set(got[f][4]) == set(want[f][4]) and all(n <= want[f][4][k] for k, n in got[f][4].items()) for f in want)


# ------------------------------------------------------------------ watchlist
def test_merge_is_that_of_one_change_after_another(spark):
    r = random.Random(8)
    start = dt.datetime(2024, 1, 1)
    symbols = [f"S{i}" for i in range(12)]
    current = [(i + 5, s, f"n{i}", None, None, i % 2 == 0, f"e{i}" if i % 3 else None) for i, s in enumerate(symbols[:8])]
    changes = [(start + dt.timedelta(hours=7 * k), k, r.choice(["upsert", "upsert", "delete"]), r.choice([*symbols, "", None]), f"note{k}", f"d{k}", None, f"v{k}" if r.random() < 0.4 else None) for k in range(120)]
    table = {s: [i, n, f, e, b] for i, s, n, f, _, b, e in current}
    fresh = {}
    for _, k, op, s, note, name, _, event in changes:
        if not s:
            continue
        if op == "delete":
            table.pop(s, None)
            fresh.pop(s, None)
        elif s in table:
            table[s][1:3], table[s][3] = [note, name], event or table[s][3]
        else:
            table[s] = [None, note, name, event, False]
            fresh[s] = k
    for n, s in enumerate(sorted(fresh, key=fresh.get)):
        table[s][0] = max(i for i, *_ in current) + n + 1
    cur = spark.createDataFrame(current, watchlist.WATCHLIST_SCHEMA)
    ch = spark.createDataFrame(changes, "ts timestamp, seq long, op string, symbol string, note string, file_name string, reminder_time string, event_id string")
    # a symbol that was there and is deleted and put in again is new
    deleted = {s for _, _, op, s, *_ in changes if op == "delete"}
    got = {x.symbol: [x.id, x.note, x.file_name, x.event_id, x.is_notified] for x in watchlist.watchlist_apply(cur, ch).collect()}
    assert got == table and deleted & set(got)
    by_key = ch.groupBy("symbol").count()
    assert by_key.count() > 0 and rows(watchlist.watchlist_apply(cur, ch.limit(0))) == rows(cur)


# -------------------------------------------------------------------- exports
def test_exports_of_many_days_in_one_job(spark, tmp_path):
    out = str(tmp_path / "out")
    one = spark.createDataFrame([(dt.date(2024, 1, 5), 1.5, "a"), (dt.date(2024, 1, 8), 2.5, "b,c")], "day date, x double, s string")
    widgets.write_widget_csv(one, out, "day")
    two = spark.createDataFrame([(dt.date(2024, 1, 8), 3.5, 'd"e'), (dt.date(2024, 1, 9), None, "f")], "day date, x double, s string")
    widgets.write_widget_csv(two, out, "day")
    assert {n for n, _ in storage.names(spark, out)} >= {f"file=wl_volume_gain_0{d}012024" for d in (5, 8, 9)}
    assert rows(widgets.read_widget_csv(spark, out, "x double, s string")) == rows(one.filter("day = '2024-01-05'").unionByName(two))
