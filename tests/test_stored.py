"""Stored totals: any cut into batches, crashes, lag, late rows, merging, what is read."""

import datetime as dt
import json
import os
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from cartstream.plans.panels import PANELS
from cartstream.plans.stored import lake_panel
from cartstream.schemas import ITEMS, PRIMARY_KEYS, TOPICS
from cartstream.sinks import compact_closed
from cartstream.sources import Lake, TextTopic, keyed, read_table
from cartstream.sources.files import names_in, read_text, remove, write_text
from cartstream.sources.lake import LANDED_AT
from cartstream.streaming import AVAILABLE_NOW, start_items, start_keys, start_landing
from cartstream.streaming import keys as keys_module
from cartstream.streaming.keys import follow_batch, panels_of, store_of
from test_plans import plan

DAY = dt.date(2025, 1, 2)


def user(rng):
    return {
        "user_id": rng.choice([None, *(f"u{n}" for n in range(25))]),
        "name": rng.choice(["A", "B"]),
        "location": rng.choice(["X, North", "Y, South", "Z", None]),
        "registered_at": rng.choice([None, *(f"2025-01-0{d} 0{h}:00:00" for d in (1, 2, 3) for h in (1, 2))]),
    }


def payment(rng):
    return {
        "transaction_id": rng.choice([None, *(f"t{n}" for n in range(25))]),
        "user_id": rng.choice(["a", None]),
        "timestamp": rng.choice([None, *(f"2025-01-0{d} 0{h}:00:00" for d in (1, 2, 3) for h in (1, 2))]),
        "transaction_amount": rng.choice([None, 100000.0, 250000.0]),
        "payment_status": rng.choice(["successful", "successful", "failed", None]),
    }


MAKE = {"users": user, "transactions": payment}


class Landed:
    """A lake that messages are landed in, one file of them at a time."""

    def __init__(self, spark, folder, table, seed=0):
        self.spark, self.table, self.path = spark, table, f"{folder}/topic"
        self.lake, self.rng, self.n = Lake(f"{folder}/lake"), random.Random(seed), 0
        os.makedirs(self.path)

    def land(self, n):
        with open(f"{self.path}/{self.n}.txt", "w") as file:
            file.writelines(json.dumps(MAKE[self.table](self.rng)) + "\n" for _ in range(n))
        self.n += 1
        topic = TOPICS[self.table]
        start_landing(self.spark, topic, TextTopic(self.path), self.lake, AVAILABLE_NOW).awaitTermination()

    def follow(self, files=2):
        start_keys(self.spark, self.lake, self.table, AVAILABLE_NOW, files).awaitTermination()

    def check(self):
        """Every panel, from what is stored, against the whole table."""
        whole = read_table(self.spark, self.lake, self.table)
        for name in panels_of(self.table):
            for day in (DAY, DAY + dt.timedelta(days=1), dt.date(2031, 1, 1)):
                expected = [tuple(r) for r in PANELS[name].run(whole, day).collect()]
                actual = [tuple(r) for r in lake_panel(self.spark, self.lake, name, day).collect()]
                assert actual == expected, (name, day)


@pytest.mark.parametrize("table", PRIMARY_KEYS)
def test_stored_totals_equal_the_whole_table(spark, folder, table, monkeypatch):
    monkeypatch.setattr(keyed, "FAN_IN", 2)
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 6)
    run = Landed(spark, folder, table)
    run.check()  # nothing landed
    run.land(15)
    run.check()  # nothing stored
    run.follow()
    run.check()
    run.land(20)
    run.check()  # landed, not followed
    run.follow()
    run.land(10)
    run.follow()
    run.land(10)
    run.check()
    note = store_of(run.lake, table).note(spark)
    assert max(r.level for r in note.runs) > 0 and max(r.buckets for r in note.runs) > 1


def test_a_crash_anywhere_in_a_batch_changes_nothing(spark, folder, monkeypatch):
    run = Landed(spark, folder, "users", seed=3)
    store = store_of(run.lake, "users")
    run.land(20)
    run.follow()
    run.land(20)

    class Crash(RuntimeError):
        pass

    def crash(*_, **__):
        raise Crash

    for broken in (
        partial(monkeypatch.setattr, keys_module, "stored_totals", crash),  # after the run
        partial(monkeypatch.setattr, keyed.KeyedStore, "finish", crash),  # after the totals
        partial(monkeypatch.setattr, keyed, "write_text", crash),  # before the note
    ):
        broken()
        with pytest.raises(Exception, match="Crash"):
            run.follow(100)
        monkeypatch.undo()
        run.check()
    run.follow(100)
    run.check()
    # After the note, before the stream's own: the whole batch comes again.
    commits = run.lake.checkpoint("keys_users") + "/commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    aside = f"{folder}/aside"
    os.makedirs(aside)
    for name in (str(last), f".{last}.crc"):
        os.rename(f"{commits}/{name}", f"{aside}/{name}")
    assert store.note(spark).epoch == last
    run.follow(100)
    run.check()


def test_a_lost_checkpoint_starts_the_store_anew(spark, folder):
    run = Landed(spark, folder, "users", seed=4)
    for _ in range(3):
        run.land(10)
        run.follow()
    os.rename(run.lake.checkpoint("keys_users"), f"{folder}/lost")
    run.follow(100)
    assert store_of(run.lake, "users").note(spark).epoch == 0
    run.check()


def batch_of(spark, *rows):
    columns = "user_id string, name string, email string, location string, registered_at timestamp_ntz"
    rows = [(key, name, None, "X, Y", dt.datetime(2025, 1, day)) for key, name, day in rows]
    return spark.createDataFrame(rows, columns).withColumn(LANDED_AT, F.current_timestamp())


def test_a_batch_writes_what_it_changes_and_no_more(spark, folder):
    store = keyed.KeyedStore("users", f"{folder}/keys")
    follow_batch(batch_of(spark, *((f"u{n}", "a", 2) for n in range(5000))), 0, store)
    # New, earlier, later, the same again, twice in the batch.
    rows = [("new", "n", 1), ("u1", "a", 1), ("u2", "a", 3), ("u3", "a", 2), ("u4", "b", 1), ("u4", "a", 1)]
    follow_batch(batch_of(spark, *rows), 1, store)
    runs = store.note(spark).runs
    assert [run.rows for run in runs] == [5000, 3]
    stored = {r.user_id: (r.name, r.registered_at.day) for r in store.runs.read(spark, runs).collect()}
    assert len(stored) == 5001
    assert stored["u1"] == ("a", 1) and stored["u2"] == stored["u3"] == ("a", 2) and stored["u4"] == ("a", 1)
    per_day = spark.read.parquet(store.totals(1, "new_users_today"))
    assert sorted(map(tuple, per_day.collect())) == [(dt.date(2025, 1, 1), 3), (dt.date(2025, 1, 2), 4998)]


def test_only_the_buckets_of_a_batch_are_opened(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "FAN_IN", 2)
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 50)
    store = keyed.KeyedStore("users", f"{folder}/keys")
    for epoch in range(2):
        rows = ((f"u{n}", "a", 2) for n in range(500 * epoch, 500 * epoch + 500))
        follow_batch(batch_of(spark, *rows), epoch, store)
    note = store.note(spark)
    assert [run.buckets for run in note.runs] == [32]
    changes = store.changes(batch_of(spark, ("u7", "a", 1)).drop(LANDED_AT), note)
    text = plan(changes)
    opened = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "bucket" in opened and changes.count() == 1
    read = [f for f in store.runs.read(spark, note.runs, {32: [0]}).inputFiles()]
    assert len({f.split("/")[-2] for f in read}) == 32  # all are there
    touched = spark.read.parquet(f"{store.root}/runs/{note.runs[0].name}").where("bucket = 0").count()
    assert 0 < touched < 100


def test_old_runs_and_totals_go(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "FAN_IN", 3)
    store = keyed.KeyedStore("users", f"{folder}/keys")
    for epoch in range(12):
        follow_batch(batch_of(spark, (f"u{epoch}", "a", 2)), epoch, store)
    names = names_in(spark, f"{store.root}/notes")
    assert sorted(int(n) for n in names if n.isdigit()) == [8, 9, 10, 11]
    assert sorted(names_in(spark, f"{store.root}/totals")) == ["10", "11", "8", "9"]
    assert len(names_in(spark, f"{store.root}/runs")) < 10
    assert store.runs.read(spark, store.note(spark).runs).count() == 12


def test_a_followed_lake_opens_no_history(spark, folder):
    """Today's answer reads the totals and what landed since, nothing else."""
    run = Landed(spark, folder, "transactions", seed=6)
    for _ in range(3):
        run.land(20)
    run.follow()
    text = plan(lake_panel(spark, run.lake, "revenue_today", DAY))
    scans = [line for line in text.splitlines() if line.startswith("Location")]
    assert any("/totals/" in line for line in scans)
    whole = read_table(spark, run.lake, "transactions").inputFiles()
    frontier = store_of(run.lake, "transactions").note(spark).frontier
    since = [f for f in whole if os.path.getmtime(f.removeprefix("file://")) * 1e6 >= frontier - 1000]
    assert len(since) < len(whole)
    assert "file_modification_time" in text


def test_partial_totals_of_closed_periods(spark, folder):
    path = f"{folder}/topic"
    lake = Lake(f"{folder}/lake", "month")
    os.makedirs(path)
    rng = random.Random(8)

    def land(name, months):
        with open(f"{path}/{name}.txt", "w") as file:
            for _ in range(30):
                products = [
                    {"product_id": "p", "quantity": rng.choice([1, 2, None]), "unit_price": 50000.0,
                     "product_category": rng.choice(["Books", "Toys", None])}
                ]
                time = rng.choice([None, *(f"2025-0{m}-05 10:00:00" for m in months)])
                row = {"transaction_id": str(rng.random()), "timestamp": time, "products": products}
                file.write(json.dumps(row) + "\n")
        start_landing(spark, TOPICS["transactions"], TextTopic(path), lake, AVAILABLE_NOW).awaitTermination()
        start_items(spark, lake, AVAILABLE_NOW).awaitTermination()

    def check():
        whole = read_table(spark, lake, ITEMS)
        for name in ("top_categories", "revenue_by_category"):
            expected = [tuple(r) for r in PANELS[name].run(whole).collect()]
            assert [tuple(r) for r in lake_panel(spark, lake, name).collect()] == expected

    land("one", [1, 2, 3])
    check()
    compact_closed(spark, lake, ITEMS, dt.date(2025, 2, 1), settled=dt.datetime.now())
    check()
    land("late", [1, 2])
    check()
    compact_closed(spark, lake, ITEMS, dt.date(2025, 3, 1), settled=dt.datetime.now())
    check()
    land("more", [3, 4])
    check()
    text = plan(lake_panel(spark, lake, "revenue_by_category"))
    assert "/partials/" in text and "/compacted/" not in text
    # A compaction from before totals were kept.
    remove(spark, f"{lake.partials('top_categories')}/run=0")
    check()


def test_text_files(spark, folder):
    path = f"{folder}/notes/1"
    assert names_in(spark, f"{folder}/notes") == []
    write_text(spark, path, "é\n")
    write_text(spark, path, "second")
    assert read_text(spark, path) == "second" and names_in(spark, f"{folder}/notes") == ["1"]
