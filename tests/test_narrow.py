"""Rows that are narrow while they are shuffled, and steps whose size follows the input."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from pathlib import Path

import numpy as np
import pytest
from tests.conftest import SF_DIR
from tests.test_forecast import P
from tests.test_long_series import _points, _values

import __spark_entry__ as registry
from tallymart.functions import narrow
from tallymart.functions.calendar import time_features, with_time_features
from tallymart.operators import cleaning, long_series
from tallymart.sources import files, schema, staging

ODD = ["", "a", "a\x00", "a\x00b", "a\x01", "a\x01\x01", "a\x01\x02\x00", "a\x02", "ab", "\x00", "\x01", "2", "é", None]


def test_packed_texts_come_back_and_sort_as_they_do(spark):
    rows = [(a, b, i) for i, (a, b) in enumerate((a, b) for a in ODD for b in ODD)]
    table = spark.createDataFrame(rows, "a string, b string, i int")
    (text, _), (number, _) = narrow.packed(list(table.schema))
    moved = table.select(text.alias("_0"), number.alias("_1"))
    back = narrow.unpacked(list(table.schema), [moved["_0"], moved["_1"]])
    assert sorted(map(tuple, moved.select(*(back[c].alias(c) for c in "abi")).collect()), key=lambda r: r[2]) == rows

    def key(row):
        return [(cell is None, (cell or "").encode()) for cell in row[:2]]

    assert [r["_1"] for r in moved.orderBy("_0").collect()] == [r[2] for r in sorted(rows, key=key)]


def test_the_first_copy_is_as_before(spark, make_orders):
    copies = [{"order_id": "A", "category": c, "product": p} for c in (None, "b\x00", "b") for p in (None, "x")]
    kept = cleaning.drop_duplicate_orders(make_orders(*copies), copies="n").first()
    assert (kept["category"], kept["product"], kept["n"]) == ("b", "x", 6)


def test_calendar_columns_stay_behind_but_others_are_kept(spark, make_orders, tmp_path):
    rows = make_orders({}, {"order_date": dt.datetime(2024, 12, 30, 8)}, {"order_date": None})
    dated = with_time_features(rows)
    odd = dated.withColumn("week", time_features()["week"] + 1)
    for table in (dated, odd):
        assert narrow.unfolded(narrow.folded(table), table.columns).collect() == table.collect()
        files.write_orders(table, str(tmp_path / uuid.uuid4().hex))
    node = files._by_month(dated)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "RebalancePartitions":
        node = node.children().head()
    moved = node.output().mkString(",")
    assert "year_month" in moved and not any(f",{c}#" in f",{moved}" for c in ("product", "category", "day_name", "year_week"))
    # rows of one date sort by their calendar cells, those that follow from the date among them
    weeks = [dated.withColumn("week", time_features()["week"] + i).filter("order_id = 'O0'") for i in (1, 0, -1)]
    table = weeks[0].unionByName(weeks[1]).unionByName(weeks[2])
    folded = narrow.folded(table)
    least = cleaning.drop_duplicate_orders(folded)
    assert narrow.unfolded(least, table.columns).collect() == cleaning.drop_duplicate_orders(table).collect() == weeks[2].collect()


def test_a_load_is_stored_once_and_missing_cells_are_counted(spark, make_orders, tmp_path, monkeypatch):
    name, staged = f"orders_{uuid.uuid4().hex}", []
    schema.create_order_table(spark, name, str(tmp_path / "orders"))
    real = files.stage
    monkeypatch.setattr(files, "stage", lambda df, what: staged.append(what) or real(df, what))
    day = dt.datetime(2025, 1, 2)
    load = make_orders(
        {"order_id": None}, {"order_id": None}, {"order_id": None, "order_date": day}, {"order_id": None, "order_date": None},
        {"order_id": "A", "order_date": None}, {"order_id": "A"}, {"order_id": "A"}, {"order_id": "B", "order_date": None},
    )
    found = files.insert_new_orders(with_time_features(load), name).collect()
    usual = dt.datetime(2025, 1, 6, 10)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [
        (None, usual, "missing"), (None, usual, "missing"), (None, day, "missing"), (None, None, "missing"),
        ("A", None, "missing"), ("A", usual, "repeated"), ("B", None, "missing"),
    ]))
    assert staged == ["known"]
    assert [(r["order_id"], r["order_date"], r["day_name"]) for r in spark.table(name).collect()] == [("A", usual, "Monday")]
    spark.sql(f"DROP TABLE {name}")


def test_files_of_late_orders_follow_the_input(spark, monkeypatch):
    seen = []
    real = files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path: seen.append(df) or real(df, path))
    registry.queries()["dedup_input_order"](spark, SF_DIR)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "REPARTITION_BY_NUM" not in plan


def test_late_orders_are_dealt_without_the_joins_and_leave_compressed_files_alone(spark, monkeypatch):
    """What the joins shuffled and the lines that were stored for the ranges are gone when the files are read."""
    seen, paths, before = [], [], shuffle_files(spark)
    real = files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path: (seen.append(df), paths.append(path), real(df, path)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        registry.queries()["dedup_input_order"](spark, SF_DIR)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = [Path(p.removeprefix("file:")) for p in seen[0].inputFiles()]
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and stored and not any(p.exists() for p in stored)
    folder = Path(paths[0].removeprefix("file:"))
    assert list(folder.glob("part-*.csv.gz")) and not list(folder.glob("part-*.csv"))
    assert not left_after(spark, before)


def shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = disk.getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_after(spark, before: set[str]) -> set[str]:
    """Files are deleted in the background."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    return left


def test_a_write_releases_its_shuffles(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting, None)
    with pytest.raises(KeyError), staging.shuffles_released(spark):
        spark.range(1000).repartition(4).write.parquet(str(tmp_path / "t"))
        raise KeyError
    assert not left_after(spark, before) and spark.conf.get(setting, None) == was
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_blocks_are_not_copied_for_each_set(spark):
    blocks, by_block = long_series._fitted(_points(spark, _values(200)), [], P, 14)
    assert by_block.count() == blocks.count() == 15


@pytest.mark.parametrize("size", [2, 3, 256])
def test_groups_of_groups_give_the_states_between_blocks(spark, size):
    rng = np.random.default_rng(1)
    responses, powers = rng.normal(size=(20, 2, 3)), rng.normal(size=(2, 3, 3)) / 3
    rows = [(s, k, x.T.ravel().tolist()) for s in (7, 8) for k, x in enumerate(responses[: 20 if s == 7 else 5])]
    found = long_series._befores(spark.createDataFrame(rows, long_series._MAPS).repartition(3), powers, size).collect()
    assert len(found) == 25
    for row in found:
        state = np.zeros((2, 3))
        for x in responses[: row["k"]]:
            state = np.einsum("sij,sj->si", powers, state) + x
        assert row["x"] == pytest.approx(state.T.ravel().tolist(), rel=1e-9, abs=1e-12)
