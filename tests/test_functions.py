"""Column expressions on hand-written rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardlake import fixed_values
from cardlake.functions import amounts, calendar, casting, text


def values(spark, rows, schema, expression):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [r[0] for r in df.select(expression).collect()]


def texts(spark, rows, expression):
    return values(spark, [(r,) for r in rows], "x string", expression)


X = "x"


def test_money_takes_numbers_only(spark):
    got = texts(spark, ["100.5", "-3", "n/a", "", None], casting.money(F.col(X), 4))
    assert got == [Decimal("100.5000"), Decimal("-3.0000"), None, None, None]


def test_whole_number_and_band(spark):
    assert texts(spark, ["40", "11-25", None], casting.whole_number(F.col(X))) == [40, None, None]
    low, high = casting.band_edges(F.col(X))
    assert texts(spark, ["11-25", "40", "many", None], low) == [11, 40, None, None]
    assert texts(spark, ["11-25", "40", "many", None], high) == [25, 40, None, None]


def test_flag(spark):
    got = texts(spark, ["TRUE", "false", "yes", "maybe", None], casting.flag(F.col(X)))
    assert got == [True, False, True, None, None]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("2023-10-05 10:20:30", dt.datetime(2023, 10, 5, 10, 20, 30)),
        ("2023-10-05T10:20:30Z", dt.datetime(2023, 10, 5, 10, 20, 30)),
        ("2023-10-05T10:20:30+04:00", dt.datetime(2023, 10, 5, 6, 20, 30)),
        ("2023-10-05T10:20:30.250+04:00", dt.datetime(2023, 10, 5, 6, 20, 30, 250000)),
        ("2023-10-05T10:20:30-0330", dt.datetime(2023, 10, 5, 13, 50, 30)),
        ("05/10/2023 01:02:03", dt.datetime(2023, 10, 5, 1, 2, 3)),
        ("10/25/2023 01:02:03", dt.datetime(2023, 10, 25, 1, 2, 3)),
        ("31/02/2023 00:00:00", None),
        ("2023-02-30 00:00:00", None),
        ("2023-10-05", None),
        ("unknown", None),
        (None, None),
    ],
)
def test_clearing_times(spark, given, expected):
    parsed = casting.first_instant(F.col(X), fixed_values.CLEARING_TIME_PATTERNS)
    got = texts(spark, [given], F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert got == [expected and expected.strftime("%Y-%m-%d %H:%M:%S.%f")]


def test_merchant_names(spark):
    got = texts(
        spark,
        ["Meta Platforms, Inc.", " FACEBOOK ", "GOOGLE LLC", "b tech", "corner  shop", "o'neil", None],
        text.merchant_name(F.col(X)),
    )
    assert got == ["Meta", "Meta", "Google", "B.Tech", "Corner  Shop", "O'neil", None]


def test_every_spelling_is_known(spark):
    spellings = list(fixed_values.MERCHANT_SPELLINGS)
    got = texts(spark, [s.upper() for s in spellings], text.merchant_name(F.col(X)))
    assert got == [fixed_values.MERCHANT_SPELLINGS[s] for s in spellings]


def test_city_title_case(spark):
    assert texts(spark, ["  dubai ", "CAIRO", "new york"], text.title_words(F.col(X))) == [
        "Dubai",
        "Cairo",
        "New York",
    ]


@pytest.mark.parametrize("given", ["nation_1 trading", "o'neil & co", "B2B SHOP", "x", "", "9lives 2go"])
def test_title_letters_equals_python_title(spark, given):
    assert texts(spark, [given], text.title_letters(F.col(X))) == [given.title()]


def test_hashes(spark):
    folded = texts(spark, [" A@B.com ", "a@b.COM", None], text.digest_folded(F.col(X)))
    assert folded[0] == folded[1] and len(folded[0]) == 64 and folded[2] is None
    short = texts(spark, [" A ", "A", "a", "  ", None], text.digest_short(F.col(X)))
    assert short[0] == short[1] != short[2] and len(short[0]) == 16 and short[3:] == ["", ""]


def test_usd(spark):
    rows = [(Decimal("100"), "AED"), (Decimal("50"), "USD"), (Decimal("1"), "XYZ"), (None, "AED")]
    got = values(spark, rows, "a decimal(18,4), c string", amounts.usd(F.col("a"), F.col("c")))
    assert got == [Decimal("27.230000"), Decimal("50.000000"), None, None]


def test_usd_default_rate(spark):
    rows = [(Decimal("100"), "KWD"), (Decimal("100"), None), (Decimal("100"), "EUR")]
    rated = amounts.usd_with_default(F.col("a"), F.col("c"))
    got = values(spark, rows, "a decimal(18,4), c string", rated)
    assert got == [Decimal("27.230000"), Decimal("27.230000"), Decimal("108.000000")]


def test_ratios_on_nothing(spark):
    rows = [(3, 0), (3, 7), (0, 5)]
    part, whole = F.col("p"), F.col("w")
    assert values(spark, rows, "p int, w int", amounts.percent(part, whole)) == [None, 42.86, 0.0]
    assert values(spark, rows, "p int, w int", amounts.percent_or_zero(part, whole)) == [
        300.0,
        42.9,
        0.0,
    ]


def test_rate_bands(spark):
    rates = [(0.0,), (49.9,), (50.0,), (79.9,), (80.0,), (100.0,)]
    got = values(spark, rates, "x double", amounts.rate_band(F.col(X)))
    assert got == ["low", "low", "medium", "medium", "high", "high"]


def test_period(spark):
    at = F.lit("2021-01-15 00:00:00").cast("timestamp")
    given = ["2023-10", "2023-10-05 x", "October 1, 2023", "Smarch 1, 2023", "", None]
    got = texts(spark, given, calendar.period_key(F.col(X), at))
    assert got == ["2023-10", "2023-10", "2023-10", "2021-01", "2021-01", "2021-01"]
    missing = F.lit(None).cast("timestamp")
    assert texts(spark, [None], calendar.period_key(F.col(X), missing)) == ["unknown"]


def test_hour_boundaries_count_marks_not_hours(spark):
    rows = [
        ("2024-01-01 00:59:00", "2024-01-01 01:01:00"),
        ("2024-01-01 00:01:00", "2024-01-01 00:59:00"),
        ("2024-01-01 01:01:00", "2024-01-01 00:59:00"),
    ]
    ends = [F.col(c).cast("timestamp") for c in "ab"]
    got = values(spark, rows, "a string, b string", calendar.hour_boundaries(*ends))
    assert got == [1, 0, -1]


def test_day_boundaries_may_be_negative(spark):
    rows = [("2024-01-01 23:59:00", "2024-01-02 00:01:00"), ("2024-01-02 00:00:00", "2024-01-01 00:00:00")]
    ends = [F.col(c).cast("timestamp") for c in "ab"]
    assert values(spark, rows, "a string, b string", calendar.day_boundaries(*ends)) == [1, -1]


def test_year_and_month_text(spark):
    at = F.col(X).cast("timestamp")
    assert texts(spark, ["2024-03-15 10:00:00"], calendar.year_text(at)) == ["2024"]
    assert texts(spark, ["2024-03-15 10:00:00"], calendar.month_text(at)) == ["03"]
