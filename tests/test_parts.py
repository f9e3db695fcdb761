"""Tables that change in place: what is not hit keeps its files."""

import os

import pytest
from pyspark.sql import functions as F

from plexus.sources.parts import PartTable, StoredWorkflow, delete_edges


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def stored(spark, tmp_path):
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("_uniqueid"), (F.col("id") % 50).alias("group"), F.col("id").alias("v"),
                                    F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("note"))
    return PartTable.write(rows, str(tmp_path / "t"), parts=20), rows


def test_delete_rewrites_only_its_parts(stored, spark):
    table, rows = stored
    before = files(table.path)
    touched = table.delete({"v": ["in", [3, 700]]})
    after = files(table.path)
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if int(f.split("_part=")[1].split("/")[0]) not in touched}
    assert kept and kept <= after and not (before - kept) & after
    assert table.rows().dtypes == rows.dtypes
    assert sorted(r.v for r in table.rows().collect()) == [i for i in range(1000) if i not in (3, 700)]
    # again: nothing is hit, nothing is written
    assert table.delete({"v": ["in", [3, 700]]}) == [] and files(table.path) == after


def test_delete_keys(stored, spark):
    table, rows = stored
    before = files(table.path)
    ids = spark.createDataFrame([("k5",), ("k5",), ("k999",), ("none",), (None,)], "id string")
    touched = table.delete_keys(ids)
    assert 1 <= len(touched) <= 2 and len(before & files(table.path)) >= len(before) - 2
    assert {r.v for r in rows.collect()} - {r.v for r in table.rows().collect()} == {5, 999}
    assert table.delete_keys(ids.where("false")) == []


def test_a_part_that_is_emptied(stored, spark):
    table, rows = stored
    part = rows.where(table._part(F.col("_uniqueid")) == 7)
    n = part.count()
    assert n and table.delete_keys(part.select("_uniqueid")) == [7]
    assert table.rows().count() == 1000 - n
    table.delete({"v": [">=", 0]})
    assert table.rows().count() == 0 and table.rows().dtypes == rows.dtypes


def test_update(stored, spark):
    table, rows = stored
    before = files(table.path)
    touched = table.update({"v": ["==", 12]}, {"group": F.col("group") + 100, "note": "new"}, [])
    assert len(touched) == 1 and len(before & files(table.path)) == len(before) - 1
    table.update({"v": ["==", 13]}, remove=["note"])
    got = {r.v: (r.group, r.note) for r in table.rows().where("v IN (11, 12, 13)").collect()}
    assert got == {11: (11, "11"), 12: (112, "new"), 13: (13, None)} and table.rows().count() == 1000
    with pytest.raises(ValueError):
        table.update({}, {"other": 1})
    with pytest.raises(ValueError):
        table.update({}, {"_uniqueid": "x"})
    with pytest.raises(ValueError):
        PartTable.write(rows, table.path, parts=0)


def test_specs_with_all_that_hangs_on_them(spark, tmp_path):
    def write(name, rows, schema, key):
        return PartTable.write(spark.createDataFrame(rows, schema), str(tmp_path / name), key, parts=8)

    specs = write("specs", [("a",), ("b",)], "spec_id string", "spec_id")
    runs = write("runs", [("r1", "a"), ("r2", "b"), ("r3", "a")], "run_id string, spec_id string", "run_id")
    events = write("events", [(f"e{i}", "ab"[i % 2]) for i in range(40)], "_uniqueid string, spec_id string", "_uniqueid")
    blobs = write("blobs", [(f"x{i}", i) for i in range(40)], "_uniqueid string, size int", "_uniqueid")
    edges = write("edges", [(f"e{i}", f"x{i}") for i in range(40)] + [(f"r{1 + i % 3}", f"e{i}") for i in range(40)] + [("e1", "e0"), ("e3", "e5")],
                  "_src string, _dst string", "_src")
    work = StoredWorkflow(specs, runs, {"Event": events, "Blob": blobs}, edges)
    changed = work.delete_specs(specs.rows().where("spec_id = 'a'"), owned=["Blob"])
    assert {r.spec_id for r in specs.rows().collect()} == {"b"} and {r.run_id for r in runs.rows().collect()} == {"r2"}
    assert {r["_uniqueid"] for r in events.rows().collect()} == {f"e{i}" for i in range(1, 40, 2)}
    assert {r["_uniqueid"] for r in blobs.rows().collect()} == {f"x{i}" for i in range(1, 40, 2)}
    got = {(r["_src"], r["_dst"]) for r in edges.rows().collect()}
    assert got == {(f"e{i}", f"x{i}") for i in range(1, 40, 2)} | {("r2", f"e{i}") for i in range(1, 40, 2) if i % 3 == 1} | {("e3", "e5")}
    assert set(changed) == {"Event", "Blob", "edges", "runs", "specs"}
    again = work.delete_specs(spark.createDataFrame([("a",)], "spec_id string"), owned=["Blob"])
    assert not any(again.values())
    assert delete_edges(edges, spark.createDataFrame([("e5",)], "id string")) and edges.rows().where("_dst = 'e5' OR _src = 'e5'").count() == 0
