"""The scorecard over time equals the scorecard of all rows, whatever folders came or changed."""

import pytest

from cardlake.operators import quality, quality_states
from cardlake.operators.quality import Rule
from cardlake.sources import versions
from cardlake.sources.datasets import write_dataset

RULES = (
    Rule("filled", "t", "complete", "card"),
    Rule("above", "t", "positive", "amount", where="kind = 'x'"),
    Rule("one_each", "t", "unique", "id"),
    Rule("known", "t", "reference", "card", ("cards", "id")),
    Rule("kinds", "t", "in_set", "kind", ("x", "y")),
)
SCHEMA = "id int, card string, amount double, kind string, month string"
ROWS = [
    (1, "a", 1.0, "x", "01"), (1, "a", -1.0, "x", "02"), (None, "b", None, "x", "01"), (None, None, 0.0, "y", "02"),
    (2, "gone", 5.0, None, "03"), (2, "gone", 5.0, "z", "03"), (3, "gone", 2.0, "x", "01"), (4, "", -3.0, "y", "a=b"),
]


@pytest.fixture
def place(spark, tmp_path):
    cards = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)

    def write(rows):
        write_dataset(frame(rows), f"{tmp_path}/data", ["month"], replace="touched")

    def refresh():
        return quality_states.refresh(
            spark, RULES, "t", f"{tmp_path}/data", frame([]).schema, f"{tmp_path}/states"
        )

    def same(rows):
        got = quality_states.merged(spark, RULES, {"cards": cards}, f"{tmp_path}/states")
        want = quality.scorecard(RULES, {"t": frame(rows), "cards": cards})
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))

    return write, refresh, same


def test_folders_come_and_change(place):
    write, refresh, same = place
    first = [r for r in ROWS if r[4] in ("01", "a=b")]
    write(first)
    assert refresh() == 2
    same(first)
    write([r for r in ROWS if r[4] not in ("01", "a=b")])
    assert refresh() == 2
    same(ROWS)  # ids repeat across folders
    assert refresh() == 0
    same(ROWS)
    changed = [(9, "a", 7.0, "x", "03"), (1, None, 7.0, "q", "03")]
    write(changed)
    assert refresh() == 1
    same([r for r in ROWS if r[4] != "03"] + changed)


def test_a_refresh_that_fails_is_repeated(place, monkeypatch):
    write, refresh, same = place
    write(ROWS[:3])
    refresh()
    write(ROWS[4:6])

    def fail(*_args, **_kwargs):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "publish", fail)
        with pytest.raises(OSError):
            refresh()
    assert refresh() == 1
    same(ROWS[:3] + ROWS[4:6])


def test_only_changed_folders_are_read(place, spark, monkeypatch):
    write, refresh, _ = place
    write(ROWS)
    refresh()
    write([(5, "a", 1.0, "x", "02")])
    seen = []
    rows_of = quality_states.row_states
    monkeypatch.setattr(
        quality_states, "row_states", lambda rows, rules: seen.extend(rows.inputFiles()) or rows_of(rows, rules)
    )
    assert refresh() == 1
    assert seen and all("month=02" in name for name in seen)
