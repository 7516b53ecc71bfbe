import datetime as dt

import pytest

from tidemark.plans.monthly import MonthlyTable

SCHEMA = "id long, at date, amount decimal(10,2), note string"


def rows_of(spark, extra=(), without=()):
    days = [(i, dt.date(2024, 1 + i % 4, 1 + i % 28), i, "x") for i in range(200)] + [(900, None, 1, None), (901, None, 2, "y")]
    kept = [r for r in days if r[0] not in without] + list(extra)
    return spark.createDataFrame(kept, "id long, at date, amount int, note string").selectExpr(
        "id", "at", "cast(amount as decimal(10,2)) as amount", "note"
    )


@pytest.fixture
def table(spark, tmp_path):
    return MonthlyTable(spark, f"file://{tmp_path}/model", "at")


def same(got, want):
    assert sorted(map(str, got.drop("month").collect())) == sorted(map(str, want.collect()))


def test_one_new_day_rewrites_one_month(spark, table):
    same(table.refresh(rows_of(spark)), rows_of(spark))
    first = table.log.newest()
    assert set(first[1]["changed"]) == {"2024-01", "2024-02", "2024-03", "2024-04", "__HIVE_DEFAULT_PARTITION__"}
    more = rows_of(spark, [(500, dt.date(2024, 3, 9), 7, "new")])
    same(table.refresh(more), more)
    number, state = table.log.newest()
    assert number == first[0] + 1 and state["changed"] == ["2024-03"]
    assert {m for m, r in state["runs"].items() if r != first[1]["runs"][m]} == {"2024-03"}


def test_unchanged_rows_in_another_order_write_nothing(spark, table):
    table.refresh(rows_of(spark))
    before = table.log.newest()
    same(table.refresh(rows_of(spark).repartition(7)), rows_of(spark))
    assert table.log.newest() == before


def test_changed_repeated_and_vanished_rows(spark, table):
    table.refresh(rows_of(spark))
    again = rows_of(spark, [(4, dt.date(2024, 1, 5), 4, "x")])  # a row that is there already
    same(table.refresh(again), again)
    assert table.log.newest()[1]["changed"] == ["2024-01"]
    without = rows_of(spark, without=[*range(1, 200, 4), 900, 901])
    same(table.refresh(without), without)
    state = table.log.newest()[1]
    assert set(state["runs"]) == {"2024-01", "2024-03", "2024-04"} and state["changed"] == ["2024-01"]
    nothing = rows_of(spark).limit(0)
    assert table.refresh(nothing).count() == 0 and table.refresh(nothing).columns == [*nothing.columns, "month"]
    same(table.refresh(rows_of(spark)), rows_of(spark))


def test_a_run_that_breaks_off_changes_nothing(spark, table, monkeypatch):
    table.refresh(rows_of(spark))
    more = rows_of(spark, [(500, dt.date(2024, 3, 9), 7, "new")])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(table.log, "publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            table.refresh(more)
    same(table.refresh(rows_of(spark)), rows_of(spark))
    same(table.refresh(more), more)


def test_the_later_of_two_runs_compares_again(spark, table, monkeypatch):
    table.refresh(rows_of(spark))
    other = MonthlyTable(spark, table.path, "at")
    march = rows_of(spark, [(500, dt.date(2024, 3, 9), 7, "new")])
    both = rows_of(spark, [(500, dt.date(2024, 3, 9), 7, "new"), (501, dt.date(2024, 2, 9), 7, "new")])
    publish, met = table.log.publish, []

    def late(number, content):
        if not met:
            met.append(1)
            other.refresh(march)
        return publish(number, content)

    monkeypatch.setattr(table.log, "publish", late)
    same(table.refresh(both), both)
    assert table.log.newest()[1]["changed"] == ["2024-02"]


def test_new_columns_rewrite_all_months(spark, table):
    table.refresh(rows_of(spark))
    wider = rows_of(spark).selectExpr("*", "id % 3 as third")
    same(table.refresh(wider), wider)
    assert len(table.log.newest()[1]["changed"]) == 5


def test_a_period_opens_its_months(spark, table):
    whole = table.refresh(rows_of(spark))
    found = table.between(whole, dt.date(2024, 2, 3), dt.date(2024, 3, 20))
    want = rows_of(spark).where("at between '2024-02-03' and '2024-03-20'")
    same(found, want)
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("\n")[0]
