"""Raw files are compressed and bounded; rows are deduplicated before they gain derived columns."""

import os

from cardlake.entries import scans  # noqa: F401
from cardlake.entries.lake import QUERIES, Lake
from cardlake.operators import dedup, layout, lookups
from cardlake.plans import curation
from cardlake.sources import datasets, raw
from cardlake.sources.sample_raw import COLUMNS, ROWS_PER_TASK, join_tasks, sample_raw
from cardlake.sources.shared import fresh_path
from cardlake.streaming import ingest


def names(folder):
    return sorted(n for n in os.listdir(folder.removeprefix("file:")) if n.endswith((".csv", ".gz")))


def test_raw_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(raw, "ROWS_PER_FILE", 10)
    root = fresh_path(spark, "raw")
    rows = spark.range(25).selectExpr("cast(id AS string) AS id", "concat('  v', id, ' ') AS v").coalesce(1)
    raw.write_raw(rows, f"{root}/orgs")
    assert [n.endswith(".csv.gz") for n in names(f"{root}/orgs")] == [True] * 3
    assert sorted(raw.read_raw(spark, root, "orgs").collect()) == sorted(rows.collect())
    assert sorted(raw.read_raw(spark, root, "orgs", merge=True).collect()) == sorted(rows.collect())


def test_plain_and_compressed_files_are_found(spark):
    root, out = fresh_path(spark, "raw"), fresh_path(spark, "out")
    rows = spark.createDataFrame([("1", "a")], "id string, v string")
    raw.write_raw(rows, f"{root}/orgs")
    rows.write.option("header", True).csv(f"{root}/users")
    present = {r.source for r in raw.source_presence(spark, root).filter("present").collect()}
    assert present == {"orgs", "users"}
    taken = []
    handlers = {s: lambda df, _, s=s: taken.append((s, df.count())) for s in ("orgs", "users")}
    ingest.ingest(spark, root, out, handlers).awaitTermination()
    assert sorted(taken) == [("orgs", 1), ("users", 1)]


def test_derived_columns_stay_out_of_the_deduplication(spark):
    table = spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS["transactions"]))
    above, _, below = curation.curate_transactions(table)._jdf.queryExecution().analyzed().toString().partition("Window ")
    for name in ("merchant_normalized", "usd_amount"):
        assert name in above and name not in below


def test_clearing_times_stay_out_of_the_deduplication(spark):
    table = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in COLUMNS["clearing"]))
    curated = curation.curate_clearing(table)
    plan = curated._jdf.queryExecution().optimizedPlan().toString().partition("Window ")
    assert "settlement_date_utc" in plan[0] and "settlement_date_utc" not in plan[2]
    assert curated.columns == curation.add_period(curation.type_clearing(table)).columns


def test_joins_of_raw_rows_are_sized_by_rows(spark):
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert join_tasks(spark, 0) == fewest
    assert join_tasks(spark, 1000 * ROWS_PER_TASK + 1) == 1001


def wide_shuffles(df):
    """Columns of each shuffle, in their order."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = [b for b in text.split("\n\n") if ") Exchange" in b.split("\n")[0]]
    inputs = [next(line for line in b.split("\n") if line.startswith("Input")) for b in blocks]
    return [[c.split("#")[0].strip() for c in i.split(": [", 1)[1].rstrip("]").split(",")] for i in inputs]


def test_varying_texts_are_shuffled_last(spark):
    types = "k string, t string, n bigint, s string, d decimal(18,4), wide decimal(30,2), `a.b` date"
    given = spark.createDataFrame([("x", "long", 1, None, None, None, None), ("x", "l", 1, "", None, None, None)], types)
    moved = layout.narrow_first(given, ["t", "k", "n", "absent"])
    assert moved.columns == ["n", "d", "a.b", "s", "wide", "t", "k"]
    plain = given.drop("a.b")
    unique = dedup.one_per_key(plain, ["k"], varying=["t"])
    assert unique.columns == plain.columns
    assert [s[:6] for s in wide_shuffles(unique)] == [["n", "d", "s", "wide", "t", "k"]]
    assert [tuple(r) for r in unique.collect()] == [("x", "l", 1, "", None, None)]


def test_columns_that_follow_are_not_shuffled_into_folders(spark, monkeypatch):
    """The written rows are those of the plain curation, and no shuffle carries what follows from a row."""
    plans = []

    def recorded(df, path, partition_by=(), varying=(), finish=None):
        dealt = layout.narrow_first(df, varying).hint("rebalance", *partition_by).select(*layout.quoted(df.columns))
        plans.append(wide_shuffles(finish(dealt)))
        return datasets.write_counted(df, path, partition_by, varying=varying, finish=finish)

    monkeypatch.setattr(curation, "write_counted", recorded)
    late = {"transactions": {"merchant_normalized", "usd_amount"}, "clearing": {"capture_date_utc", "settlement_date_utc"}}
    for source, added in late.items():
        raw = sample_raw(spark, "/root/testdata/sf0.001", source)
        written, count = curation.write_curated(source, raw, fresh_path(spark, source))
        plain = curation.CURATE[source](raw)
        written = written.select(plain.columns)  # reading puts the folders' columns last
        assert written.dtypes == plain.dtypes and count == plain.count()
        assert written.exceptAll(plain).isEmpty() and plain.exceptAll(written).isEmpty()
        assert plans and not any(added & set(columns) for columns in plans.pop())


def test_small_owners_are_broadcast_before_rows_are_shuffled(spark):
    """Spark can't tell the size of a join and shuffled the rows first."""
    root = fresh_path(spark, "dims")
    frames = {
        "rows": ([("t1", "c1"), ("t2", None), ("t3", "c9")], "id string, card_id string"),
        "cards": ([(1, "c1", "o1"), (2, "c2", None)], "card_key bigint, card_id string, org_id string"),
        "orgs": ([(7, "o1")], "org_key bigint, org_id string"),
    }
    for name, (rows, types) in frames.items():
        spark.createDataFrame(rows, types).write.parquet(f"{root}/{name}")
    rows, cards, orgs = (spark.read.parquet(f"{root}/{n}") for n in frames)
    owners = cards.join(orgs, "org_id", "left")
    found = lookups.lookup(rows, owners, [("card_id", "card_id")], ["card_key", "org_key"], small=True)
    assert not any("id" in columns for columns in wide_shuffles(found))
    assert sorted(map(tuple, found.collect())) == [("t1", "c1", 1, 7), ("t2", None, None, None), ("t3", "c9", None, None)]


def test_rows_that_lie_in_folders_are_written_again_without_a_shuffle(spark):
    rows = [(i, "a" if i < 900 else None if i < 950 else f"b{i % 7}") for i in range(1000)] * 2
    given = spark.createDataFrame(rows, "id bigint, kind string").repartition(8)
    first = datasets.write_dataset(given, fresh_path(spark, "first"), ["kind"])
    group, path = "rewritten", fresh_path(spark, "second")
    spark.sparkContext.setJobGroup(group, group)
    again = datasets.write_dataset(first, path, ["kind"], dealt=True)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    track = spark.sparkContext.statusTracker()
    assert [len(track.getJobInfo(j).stageIds) for j in track.getJobIdsForGroup(group)] == [1]
    assert sorted(map(tuple, again.collect()), key=str) == sorted(rows, key=str)
    assert len(again.inputFiles()) <= len(first.inputFiles())
    assert {f.split("/")[-2] for f in again.inputFiles()} == {f.split("/")[-2] for f in first.inputFiles()}


def test_layout_of_curated_tables_is_kept_by_their_sink(spark, monkeypatch):
    lake, plain, calls = Lake(spark, "/root/testdata/sf0.001"), datasets.write_dataset, []

    def recorded(df, path, partition_by=(), **how):
        calls.append((df.inputFiles(), list(partition_by), how))
        return plain(df, path, partition_by, **how)

    curated = {s: lake.curated(s) for s in ("cards", "clearing", "transactions")}
    monkeypatch.setattr(datasets, "write_dataset", recorded)
    got = QUERIES["sink_partition_one"](lake)
    QUERIES["sink_partition_year_month"](lake)
    assert [by for _, by, _ in calls] == [["card_type"], ["period"], *[["year", "month"]] * 2]
    for files, by, how in calls:
        assert how["dealt"] and files and all(f"/{column}=" in f for f in files for column in by)
    want = curated["cards"].selectExpr("'cards'", "card_type", "id").union(
        curated["clearing"].selectExpr("'clearing'", "period", "transaction_id")
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
