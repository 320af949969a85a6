"""Invariants of the curated tables, the star schema, the reports and the whole run."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cardlake.entries.lake import lake_of
from cardlake.operators.quality import DataQualityError
from cardlake.plans import curation, governance, marts, panels, pipeline, warehouse
from cardlake.sources import datasets
from cardlake.sources.raw import read_raw, source_presence, write_raw
from cardlake.sources.sample_raw import sample_raw
from cardlake.sources.shared import fresh_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    return lake_of(spark, SF_DIR)


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_curation_is_repeatable(spark):
    raw = sample_raw(spark, SF_DIR, "transactions")
    once = rows(curation.curate_transactions(raw))
    again = rows(curation.curate_transactions(raw.repartition(5)))
    assert once == again


def test_no_secret_column_in_users(lake):
    columns = set(lake.curated("users").columns)
    assert not columns & {"email", "phone_number", "password"}
    assert {"email_hash", "phone_hash"} <= columns


def test_strict_users_have_no_names(spark):
    strict = curation.curate_users(sample_raw(spark, SF_DIR, "users"), strict=True)
    assert strict.filter(F.length("first_name") != 64).count() == 0


def test_columns_that_clash_after_renaming(spark):
    df = spark.createDataFrame([("a", "b")], ["Card ID", "card__id"])
    with pytest.raises(ValueError, match="card_id"):
        curation.snake_case(df)


def test_clearing_without_optional_columns(spark):
    df = spark.createDataFrame([("1", "5")], ["Transaction ID", "GTV"])
    got = curation.curate_clearing(df).first()
    assert got.period == "unknown" and str(got.gtv) == "5.000000"


def test_month_stays_text_and_missing_date_stays_missing(lake):
    read = lake.curated("transactions")
    assert dict(read.dtypes)["month"] == "string"
    undated = read.filter("transaction_timestamp IS NULL")
    assert undated.count() > 0 and undated.filter("year IS NOT NULL").count() == 0


def test_fact_does_not_multiply_rows(lake):
    fact = lake.star("fact_transactions")
    assert fact.count() == lake.curated("transactions").count()
    assert fact.filter("merchant_key IS NULL").count() == 0
    assert lake.star("fact_clearing").count() == lake.curated("clearing").count()


def test_missing_and_blank_cities_are_two_merchants(spark, lake):
    """A merchant known with a blank and with a missing city must not double its transactions."""
    rows = lake.curated("transactions").withColumn(
        "merchant_city",
        F.when(F.col("mcc") < "5020", "").when(F.col("mcc") < "5035", F.col("merchant_city")),
    ).withColumn("mcc", F.lit("5000"))
    dims = [lake.star(d) for d in ("dim_cards", "dim_organizations")]
    fact = warehouse.resolve_keys(rows, *dims, warehouse.dim_merchants(rows))
    assert fact.count() == rows.count()
    assert fact.filter("merchant_key IS NULL").count() == 0


def test_merchants_keep_their_keys(lake):
    transactions = lake.curated("transactions")
    first = warehouse.dim_merchants(transactions.filter("year < '1997'"))
    second = warehouse.dim_merchants(transactions, first)
    third = warehouse.dim_merchants(transactions, second)
    assert rows(third.select(*second.columns)) == rows(second)
    kept = second.join(first.select(F.col("merchant_key").alias("k"), "merchant_name", "mcc"), F.col("k") == F.col("merchant_key"))
    assert kept.count() == first.count()


def test_organisation_versions(spark):
    schema = "id string, business_name string, country string, business_type string, number_of_employees int, created_at timestamp, updated_at timestamp, deleted_at timestamp"
    orgs = spark.sql(
        f"""SELECT * FROM VALUES
        ('1', 'old', 'AE', 't', 1, TIMESTAMP'2020-01-01', TIMESTAMP'2020-01-01', NULL),
        ('1', 'new', 'AE', 't', 1, TIMESTAMP'2020-01-01', TIMESTAMP'2021-01-01', NULL),
        ('2', 'gone', 'AE', 't', 1, TIMESTAMP'2020-01-01', TIMESTAMP'2021-01-01', TIMESTAMP'2022-01-01')
        AS t({', '.join(c.split()[0] for c in schema.split(', '))})"""
    )
    assert [r.business_name for r in warehouse.dim_organizations(orgs).orderBy("org_id").collect()] == ["new", "gone"]
    assert warehouse.dim_organizations(orgs, active_only=True).count() == 1


def test_settled_total_agrees_across_reports(lake):
    """With orphan cards set aside, every report has the same settled amount."""
    known = lake.star("fact_transactions").filter("org_key IS NOT NULL")
    ids = known.select(F.col("transaction_id").alias("id"))
    transactions = lake.curated("transactions").join(ids, "id", "left_semi")
    orgs, cards = lake.star("dim_organizations"), lake.star("dim_cards")

    def total(df, column):
        return float(df.agg(F.sum(column)).first()[0])

    dated = transactions.filter("year IS NOT NULL")
    expected = total(transactions.filter("status = 'SETTLED'"), "billing_amount")
    assert total(marts.spend_by_org(known, orgs), "settled_aed") == pytest.approx(expected)
    assert total(marts.fx_exposure(known), "total_billing_aed") == pytest.approx(expected)
    assert total(marts.card_utilization(cards, known, orgs), "total_spend_aed") == pytest.approx(expected)
    assert total(panels.kpis(transactions), "total_spend_aed") == pytest.approx(expected)
    dated_expected = total(dated.filter("status = 'SETTLED'"), "billing_amount")
    assert total(marts.currency_breakdown(dated), "total_billing_aed") == pytest.approx(dated_expected)


def test_month_bounds_prune_partitions(lake):
    transactions = lake.curated("transactions")
    bounded = marts.monthly_volume(transactions, "1997-03", "1997-05")
    assert [(r.year, r.month) for r in bounded.collect()] == [("1997", m) for m in ("03", "04", "05")]
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_reports_of_empty_tables(lake):
    nothing = lake.curated("transactions").limit(0)
    fact = lake.star("fact_transactions").limit(0)
    assert marts.top_merchants(nothing).count() == 0
    assert marts.spend_by_org(fact, lake.star("dim_organizations")).count() == 0
    assert panels.kpis(nothing).first().settled_pct == 0.0
    assert panels.cards_panel(lake.curated("cards").limit(0)).first().active_rate_pct == 0.0
    assert panels.lag_histogram(panels.lags(nothing)).count() == panels.BINS


def test_touched_partitions_only(spark):
    path = fresh_path(spark, "t")
    whole = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    datasets.write_dataset(whole, path, ["p"])
    part = spark.createDataFrame([(9, "a")], "v int, p string")
    assert rows(datasets.write_dataset(part, path, ["p"], replace="touched")) == [("2", "b"), ("9", "a")]
    assert rows(datasets.write_dataset(part, path, ["p"])) == [("9", "a")]


def test_nested_values_load_as_json(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 2) AS s, array(1, 2) AS l")
    got = datasets.load_columns(df, {"first": "a", "detail": "s", "many": "l"}).first()
    assert tuple(got) == (1, '{"x":2}', "[1,2]")


def test_curated_first_else_fallback(spark):
    path = fresh_path(spark, "t")
    fallback = spark.createDataFrame([("raw",)], "x string")
    assert datasets.read_first(spark, path, None, lambda: fallback).first().x == "raw"
    datasets.write_dataset(spark.createDataFrame([("curated",)], "x string"), path)
    assert datasets.read_first(spark, path, None, lambda: fallback).first().x == "curated"


def test_view_refuses_secret_columns(lake):
    with pytest.raises(PermissionError, match="email"):
        governance.governed_view(lake.curated("users"), "v", ["id", "email"])


def test_bucketed_join_needs_no_shuffle(lake):
    spark, path = lake.spark, fresh_path(lake.spark, "fact")
    fact = lake.star("fact_transactions").select("transaction_key", "card_key", "date_key", "status")
    stored = warehouse.lay_out_fact(fact, "bucketed_fact", path, ["date_key", "status"], buckets=4)
    assert rows(stored) == rows(fact)
    cards = lake.star("dim_cards").select("card_key", "org_id")
    warehouse.lay_out_fact(cards, "bucketed_cards", fresh_path(spark, "c"), ["org_id"], buckets=4)
    joined = spark.table("bucketed_fact").hint("merge").join(spark.table("bucketed_cards"), "card_key")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_and_missing_cards_stay_out_of_the_buckets(spark):
    given = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS card_key", "id % 50 AS date_key"
    )
    stored = warehouse.lay_out_fact(given, "spread_fact", fresh_path(spark, "f"), ["date_key"], rows_per_bucket=500)
    assert rows(stored) == rows(given)
    assert spark.table("spread_fact").filter("card_key IS NULL OR card_key = 7").count() == 0
    assert spark.table("spread_fact_spread").filter("card_key IS NULL OR card_key = 7").count() == 2000
    numbers = spark.sql("DESCRIBE EXTENDED spread_fact").filter("col_name = 'Num Buckets'").first()
    assert numbers["data_type"] == "6"


def test_layout_refuses_a_managed_table(spark):
    spark.range(3).selectExpr("id AS card_key", "id AS d").write.mode("overwrite").saveAsTable("kept_fact")
    with pytest.raises(ValueError, match="managed"):
        warehouse.lay_out_fact(spark.table("kept_fact"), "kept_fact", fresh_path(spark, "f"), ["d"])
    assert spark.table("kept_fact").count() == 3


def test_a_filter_skips_files_of_a_clustered_fact(spark):
    fact = spark.range(20_000).selectExpr("id", "pmod(xxhash64(id), 1000) AS date_key", "id % 3 AS status")
    stored = warehouse.cluster_fact(fact, fresh_path(spark, "c"), ["date_key", "status"], rows_per_file=1000)
    found = warehouse.files_met(stored, "date_key", 100, 140).first()
    assert found.files >= 15 and found.files_met <= 4
    assert rows(stored) == rows(fact)


def _wide_exchanges(df, column):
    """Shuffles that carry a column which only whole rows have."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found, node = 0, ""
    for line in text.split("\n"):
        if line.startswith("("):
            node = line
        elif line.startswith("Input") and ") Exchange" in node and column in line:
            found += 1
    return found


def test_facts_shuffle_whole_rows_once(lake):
    spark = lake.spark
    dims = [lake.star(d) for d in ("dim_cards", "dim_organizations", "dim_merchants")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = warehouse.fact_transactions(lake.curated("transactions"), *dims)
        assert _wide_exchanges(fact, "fee_amount") == 1
        clearing = warehouse.fact_clearing(lake.curated("clearing"), lake.star("fact_transactions"))
        assert _wide_exchanges(clearing, "gtv") == 1
        assert rows(fact) == rows(lake.star("fact_transactions"))
        assert rows(clearing) == rows(lake.star("fact_clearing"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


# The whole run -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def raw_root(spark):
    root = fresh_path(spark, "raw")
    for source in curation.CURATE:
        write_raw(sample_raw(spark, SF_DIR, source), f"{root}/{source}")
    return root


def test_run_is_stopped_by_the_gate(spark, raw_root):
    out = fresh_path(spark, "run")
    with pytest.raises(DataQualityError, match="null_card_ids"):
        pipeline.run(spark, raw_root, out)
    assert not os.path.exists(f"{out}/star")


def test_run_needs_every_source(spark, raw_root):
    root = fresh_path(spark, "raw")
    write_raw(read_raw(spark, raw_root, "orgs"), f"{root}/orgs")
    presence = {r.source: r.present for r in source_presence(spark, root).collect()}
    assert presence == {"orgs": True, "users": False, "cards": False, "transactions": False, "clearing": False}
    with pytest.raises(FileNotFoundError, match="cards, clearing, transactions, users"):
        pipeline.run(spark, root, fresh_path(spark, "run"))


def test_files_with_other_headers(spark):
    root = fresh_path(spark, "raw")
    spark.createDataFrame([("1", "a")], "id string, name string").coalesce(1).write.option("header", True).csv(f"{root}/orgs")
    later = spark.createDataFrame([("b", "2", "x")], "name string, id string, region string")
    later.coalesce(1).write.mode("append").option("header", True).csv(f"{root}/orgs")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, root, "orgs").collect()
    merged = read_raw(spark, root, "orgs", merge=True).select("id", "name", "region")
    assert sorted(tuple(r) for r in merged.collect()) == [("1", "a", None), ("2", "b", "x")]


def test_managed_table_is_not_replaced(spark):
    path = fresh_path(spark, "table")
    spark.range(3).write.parquet(path)
    spark.range(2).write.mode("overwrite").saveAsTable("kept_by_spark")
    with pytest.raises(ValueError, match="managed"):
        datasets.register_tables(spark, {"kept_by_spark": ("parquet", path)})
    assert spark.table("kept_by_spark").count() == 2
    for _ in range(2):
        datasets.register_tables(spark, {"kept_outside": ("parquet", path)})
    assert spark.table("kept_outside").count() == 3


def test_stored_merchants_keep_their_keys(spark, lake):
    out = fresh_path(spark, "star")
    curated = {s: lake.curated(s) for s in curation.CURATE}
    late = curated | {"transactions": curated["transactions"].filter("merchant_normalized >= 'M'")}
    keys = []
    for tables in (late, curated):
        star = pipeline.load_star(spark, tables, out, ("1997-01-01", "1997-01-31"))
        keys.append({tuple(r)[1:]: r.merchant_key for r in star["dim_merchants"][0].collect()})
    assert keys[0].items() <= keys[1].items()
    assert len(keys[1]) > len(keys[0]) and len(set(keys[1].values())) == len(keys[1])


def test_import_needs_no_session():
    # the card queries all have SQL; the training-text ones, where present, only where SQL can express them
    code = (
        "import __spark_entry__ as e; from cardlake.entries.lake import QUERIES; "
        "assert set(QUERIES) and set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())"
    )
    folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=folder, check=True, timeout=120)
