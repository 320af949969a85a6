"""What a job leaves on disk: no shuffle files of its writes, no tables that it settled on the way."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from cardlake.entries import reports, scans, tables  # noqa: F401
from cardlake.entries.lake import QUERIES, Lake
from cardlake.plans import curation, pipeline
from cardlake.sources import datasets
from cardlake.sources.raw import write_raw
from cardlake.sources.sample_raw import COLUMNS
from cardlake.sources.shared import discard, dropping_shuffles, fresh_path, scratch, settle, shared_root
from cardlake.streaming import upsert
from cardlake.streaming.ingest import append_unseen

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*.data")}


def left_soon(spark, before, seconds=10):
    """Shuffle files beyond those of before; Spark deletes them a moment after the execution."""
    until = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def settled(spark):
    root = shared_root(spark).removeprefix("file:")
    return {os.path.relpath(p, root) for p in glob.glob(f"{root}/cardlake/*/*")}


def labels(spark, before):
    return {os.path.basename(p) for p in settled(spark) - before}


def shuffled(spark, n=1000):
    return spark.range(n).select((F.col("id") % 10).alias("k"), "id").repartition(4, "k")


def transactions(spark):
    """Raw rows of three ids, one twice, in two months."""
    values = {"transaction_currency": "AED", "billing_amount": "1.50", "billing_currency": "AED", "mcc": "5000"}
    made = [
        [{"id": i, "card_id": f"c{i}", "transaction_timestamp": f"2024-0{m}-01 00:00:00", **values}.get(c) for c in COLUMNS["transactions"]]
        for i, m in (("1", 1), ("2", 1), ("3", 2), ("2", 2))
    ]
    return spark.createDataFrame(made, ", ".join(f"{c} string" for c in COLUMNS["transactions"]))


def lake(spark, monkeypatch):
    """A lake of a few own rows."""
    made = Lake(spark, "none")
    text = {s: ", ".join(f"`{c}` string" for c in COLUMNS[s]) for s in COLUMNS}
    cards = [[{"id": "c1", "card_type": "virtual", "organization_id": "o"}.get(c) for c in COLUMNS["cards"]]]
    clearing = [
        [{"Transaction ID": i, "Period": p, "MCC": "5000"}.get(c) for c in COLUMNS["clearing"]]
        for i, p in (("1", "2024-01"), ("1", "2024-02"), ("9", None))
    ]
    rows = {
        "transactions": transactions(spark),
        "cards": spark.createDataFrame(cards, text["cards"]),
        "clearing": spark.createDataFrame(clearing, text["clearing"]),
        **{s: spark.createDataFrame([], text[s]) for s in ("users", "orgs")},
    }
    monkeypatch.setattr(made, "raw", rows.__getitem__)
    return made


# The helpers ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("write", [
    lambda df: settle(df, "t"),
    lambda df: datasets.write_dataset(df, fresh_path(df.sparkSession, "t"), ["k"]),
    lambda df: write_raw(df.selectExpr("cast(k AS string) AS k"), fresh_path(df.sparkSession, "t")),
])
def test_a_write_leaves_no_shuffle_files(spark, write):
    before = shuffle_files(spark)
    write(shuffled(spark))
    assert not left_soon(spark, before)


def test_the_setting_returns_with_the_last_block(spark):
    old = spark.conf.get(CLEANUP)
    inside, go = threading.Event(), threading.Event()

    def other():
        with dropping_shuffles(spark):
            inside.set()
            go.wait(10)

    thread = threading.Thread(target=other)
    with pytest.raises(KeyError), dropping_shuffles(spark):
        thread.start()
        inside.wait(10)
        raise KeyError
    assert spark.conf.get(CLEANUP) == "true"
    go.set()
    thread.join()
    assert spark.conf.get(CLEANUP) == old


def test_tables_of_a_scratch_block_are_deleted(spark):
    before = settled(spark)
    with scratch(spark):
        settle(spark.range(3), "outer")
        with pytest.raises(KeyError), scratch(spark):
            settle(spark.range(3), "inner")
            raise KeyError
        assert labels(spark, before) == {"outer"}
    kept = settle(spark.range(3), "kept")
    assert labels(spark, before) == {"kept"} and kept.count() == 3
    discard(kept)
    assert settled(spark) == before


# The findings --------------------------------------------------------------------------------------


def test_arriving_batches_leave_the_table_alone(spark):
    target, before = fresh_path(spark, "target"), settled(spark)
    handle, files = upsert.curate_into("transactions", target), shuffle_files(spark)
    rows = transactions(spark)
    for number in ("0", "1", "1"):
        handle(rows if number == "0" else rows.filter("id != '1'").withColumn("status", F.lit("X")), number)
    append_unseen(rows.select("id", "mcc"), f"{target}-ids", "id", "0")
    assert labels(spark, before) == {"target", "target-ids"}
    got = upsert.read_upserted(spark, target)
    both = rows.unionByName(rows.filter("id != '1'").withColumn("status", F.lit("X")))
    expected = curation.curate_transactions(both)
    assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    wide = {f for f in left_soon(spark, files, 3) if os.path.getsize(f) > 20_000}
    assert not wide


def test_catalogue_copies_folders_without_a_shuffle(spark, monkeypatch):
    made, how = lake(spark, monkeypatch), []
    write = datasets.write_dataset
    monkeypatch.setattr(scans.datasets, "write_dataset", lambda *a, **k: (how.append(k.get("dealt")), write(*a, **k))[1])
    monkeypatch.setattr(scans.catalog, "crawl", lambda spark, tables, state: spark.createDataFrame(
        [(t,) for t in tables], "table_name string"))
    monkeypatch.setattr(spark, "table", lambda name: spark.range(1))
    before = settled(spark)
    assert QUERIES["register_catalog"](made).count() == 10
    assert how == [None, True] * 5  # curated, then copied
    assert "unique_rows" not in labels(spark, before)


def test_star_tables_leave_nothing_settled(spark, monkeypatch):
    made, before = lake(spark, monkeypatch), settled(spark)
    found = {(r.table_name, r.kind, r.column_name): r.violations for r in QUERIES["warehouse_constraints"](made).collect()}
    assert len(found) == 20 and found["fact_transactions", "not_null", "card_key"] == 2
    names = {"dim_organizations", "dim_users", "dim_cards", "dim_merchants", "dim_dates", "fact_transactions", "fact_clearing"}
    assert labels(spark, before) == names | {"orgs", "users", "cards", "transactions", "clearing"}


def test_a_run_leaves_nothing_settled_and_curates_in_turn(spark, monkeypatch):
    made, before, open_now, most = lake(spark, monkeypatch), settled(spark), [], []
    write = pipeline.write_curated

    def noted(source, raw, path):
        open_now.append(source)
        most.append(len(open_now))
        time.sleep(0.5)
        done = write(source, raw, path)
        open_now.remove(source)
        return done

    monkeypatch.setattr(pipeline, "write_curated", noted)
    steps = {r.step: r.rows for r in QUERIES["pipeline_run"](made).collect()}
    assert len(steps) == 12 and steps["curate_transactions"] == 3 and steps["load_fact_clearing"] == 2
    assert most == [1] * 5
    assert labels(spark, before) == {"raw", "run"}


def test_the_scorecard_over_time_writes_one_table_at_a_time(spark, monkeypatch):
    made, open_now, most = lake(spark, monkeypatch), [], []
    write = reports.write_dataset

    def noted(*given, **how):
        open_now.append(1)
        most.append(len(open_now))
        time.sleep(0.3)
        done = write(*given, **how)
        open_now.pop()
        return done

    monkeypatch.setattr(reports, "write_dataset", noted)
    card = {r.rule: r for r in QUERIES["dq_scorecard_over_time"](made).collect()}
    assert card["transactions_no_duplicate_ids"].violations == 1 and card["transactions_no_duplicate_ids"].checked == 4
    assert most == [1] * 6
