import json

import duckdb
import pytest

from turnout.functions.schema import COUNT_TABLE_DDL, KEYS
from turnout.operators.counts import current_counts
from turnout.operators.newest import (
    GRID_COLUMNS,
    bar_series,
    grid,
    head_rows,
    json_records,
    max_batch,
    newest_batch,
    top_groups,
    with_refresh_time,
    yes_no_counts,
)
from turnout.plans.dashboard import dashboard
from turnout.sources.results import count_table, top_groups_sql


def row(name, response, count, batch, city="c"):
    return (name, "us", None, city, "1", "2", response, count, batch)


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame(rows, COUNT_TABLE_DDL)

    return make


def test_newest_batch_is_what_changed_last_not_the_largest(table):
    frame = table([row("a", "yes", 900, 0), row("b", "no", 2, 1), row("d", "waitlist", 1, 1)])
    assert {r.group_name for r in newest_batch(frame).collect()} == {"b", "d"}
    assert max_batch(frame).collect()[0].max_batch_id == 1


def test_empty_table(table):
    frame = table([])
    assert max_batch(frame).collect()[0].max_batch_id is None
    assert newest_batch(frame).collect() == []
    assert bar_series(yes_no_counts(newest_batch(frame))).collect() == []


def test_yes_no_waitlist_and_null(table):
    frame = table(
        [
            row("a", "yes", 5, 0),
            row("b", "no", 4, 0),
            row("c", "waitlist", 3, 0),
            row("d", None, 2, 0),
            row("e", "YES", 1, 0),
        ]
    )
    assert [tuple(r) for r in yes_no_counts(frame).collect()] == [
        ("a", 5, 0),
        ("b", 0, 4),
        ("c", 0, 0),
        ("d", 0, 0),
        ("e", 0, 0),
    ]


def test_yes_and_no_of_one_group_stay_two_rows(table):
    frame = table([row("a", "yes", 5, 0), row("a", "no", 5, 0)])
    assert [tuple(r) for r in yes_no_counts(frame).collect()] == [("a", 0, 5), ("a", 5, 0)]


def test_ties_at_the_cut_follow_the_keys_with_nulls_last(table):
    rows = [row(name, "yes", 7, 0) for name in ["k", "b", None, *"jihgfedca"]]
    names = [r.group_name for r in top_groups(table(rows).repartition(5)).collect()]
    assert names == list("abcdefghij")
    names = [r.group_name for r in top_groups(table(rows).repartition(3), 12).collect()]
    assert names == [*"abcdefghijk", None]


def test_both_shapes_take_the_same_rows(table):
    rows = [row(f"g{i}", "yes" if i % 2 else "no", i // 3, 0) for i in range(40)]
    frame = table(rows).repartition(4)
    top = [(r.group_name, r.response_count) for r in top_groups(frame).collect()]
    bars = [(r[0], r[1] + r[2]) for r in yes_no_counts(frame).collect()]
    assert top == bars and len(top) == 10


def test_grid_columns_are_in_name_order_without_the_group_name(table):
    frame = grid(table([row("a", "yes", 1, 0)]))
    assert tuple(frame.columns) == GRID_COLUMNS == tuple(sorted(GRID_COLUMNS))
    assert "group_name" not in frame.columns


def test_bar_series(table):
    frame = bar_series(yes_no_counts(table([row("a", "yes", 3, 0)])))
    assert {tuple(r) for r in frame.collect()} == {
        ("a", "yes_response_count", 3),
        ("a", "no_response_count", 0),
    }


def test_json_records_keep_nulls(table):
    record = json_records(grid(table([row("a", "yes", 3, 0)]))).collect()[0].record
    assert json.loads(record)["group_state"] is None
    assert list(json.loads(record)) == list(GRID_COLUMNS)


def test_head_rows(table):
    rows = [row(f"g{i}", "yes", i, 0) for i in range(9)]
    assert [r.response_count for r in head_rows(table(rows)).collect()] == [8, 7, 6, 5, 4]


def test_dashboard_has_a_refresh_time(table):
    shapes = dashboard(table([row("a", "yes", 3, 0), row("b", "no", 2, 1)]))
    found = shapes.rows.filter("refreshed_at rlike '^[0-9-]{10} [0-9:]{8}$'").collect()
    assert [r.response_count for r in found] == [2]
    assert [tuple(r) for r in shapes.bars.collect()] == [("b", 0, 2)]
    assert len(shapes.series.collect()) == 2
    assert with_refresh_time(shapes.bars).columns[-1] == "refreshed_at"


def test_sql_for_databases_gives_the_same_rows(table):
    rows = [
        row(name, response, count, batch)
        for batch in (0, 1)
        for count in (3, 3, 5)
        for name in ["b", "a", None]
        for response in ("yes", "no", None)
    ]
    frame = table(rows)
    expected = top_groups(newest_batch(frame).distinct()).collect()
    columns = ", ".join(frame.columns)
    with duckdb.connect() as connection:
        connection.execute(f"CREATE TABLE counts ({COUNT_TABLE_DDL.replace('STRING', 'VARCHAR')})")
        connection.executemany(f"INSERT INTO counts ({columns}) VALUES (?,?,?,?,?,?,?,?,?)", rows)
        found = connection.execute(top_groups_sql("counts")).fetchall()
    assert found == [tuple(r) for r in expected] and len(found) == 10


def test_newest_batch_reads_one_partition(table, spark, tmp_path):
    rows = [row(f"g{i}", "yes", i, i % 5) for i in range(50)]
    path = str(tmp_path / "counts")
    table(rows).write.partitionBy("batch_id").parquet(path)
    newest = newest_batch(count_table(spark, path))
    assert {tuple(r) for r in newest.collect()} == {r for r in rows if r[-1] == 4}
    assert newest.columns == [*KEYS, "response_count", "batch_id"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    assert "Join" not in plan


def test_responses_under_a_collation(table):
    frame = table([row("a", "YES", 5, 0), row("b", "No", 4, 0), row("c", "yes", 3, 0), row("d", None, 2, 0)])
    plain = [tuple(r) for r in yes_no_counts(frame).collect()]
    assert plain == [("a", 0, 0), ("b", 0, 0), ("c", 3, 0), ("d", 0, 0)]
    found = yes_no_counts(frame, collation="UTF8_LCASE")
    assert [tuple(r) for r in found.collect()] == [("a", 5, 0), ("b", 0, 4), ("c", 3, 0), ("d", 0, 0)]
    assert found.schema == yes_no_counts(frame).schema
    assert [r.group_name for r in yes_no_counts(frame, 2, "UTF8_LCASE").collect()] == ["a", "b"]


def test_current_counts_take_the_last_batch_not_the_largest_total(table):
    rows = [row("a", "yes", 9, 0), row("a", "yes", 2, 7), row("b", None, 0, 3), row(None, "no", 1, 1)]
    rows += [row("a", "yes", 2, 7), row("a", "no", 5, 2)]  # a batch that was written again
    found = {(r.group_name, r.response): (r.response_count, r.batch_id) for r in current_counts(table(rows)).collect()}
    assert found == {("a", "yes"): (2, 7), ("b", None): (0, 3), (None, "no"): (1, 1), ("a", "no"): (5, 2)}
    assert [r.group_name for r in top_groups(current_counts(table(rows)), 1).collect()] == ["a"]
    assert current_counts(table([])).isEmpty()
