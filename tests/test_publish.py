"""Snapshots, whole JSON documents and the files of a published run."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from parcella.plans import publish
from parcella.sources import readers, snapshots, writers
from parcella.sources.layout import Layout


def test_a_reader_keeps_its_version_and_the_next_sees_the_new_one(spark, tmp_path):
    root = f"{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        snapshots.table(spark, root)
    snapshots.replace(spark.range(3), root, "a")
    before = snapshots.table(spark, root)
    snapshots.replace(spark.range(10, 15), root, "b")
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert sorted(r.id for r in snapshots.table(spark, root).collect()) == [10, 11, 12, 13, 14]
    assert snapshots.current(spark, root)["version"] == "b"


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path):
    root = f"{tmp_path}/table"
    snapshots.replace(spark.range(3), root, "a")

    def half(folder):
        spark.range(2).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        snapshots.commit(spark, root, half, "b")
    broken = spark.range(9).select(F.raise_error(F.lit("bad row")).cast("long").alias("id"))
    with pytest.raises(Exception, match="bad row"):
        snapshots.replace(broken, root, "c")
    assert snapshots.table(spark, root).count() == 3
    assert not [f for f in os.listdir(root) if f.endswith(".tmp")]
    assert len(os.listdir(f"{root}/versions")) > 1
    gone = snapshots.forget(spark, root, keep=0)
    assert gone and snapshots.table(spark, root).count() == 3 and len(os.listdir(f"{root}/versions")) == 1


def test_publish_latest_is_a_snapshot(spark, tmp_path):
    paths = Layout(str(tmp_path))
    for day, n in (("2024-01-01", 2), ("2024-02-01", 5)):
        writers.parquet(spark.range(n), paths.gold("t", day))
        publish.publish_latest(paths, "t", day, spark)
        assert snapshots.table(spark, paths.latest("t")).count() == n


def test_documents_are_valid_json_one_file_a_key(spark, tmp_path):
    rows = [(f"{i % 3:02d}", i, None if i % 4 else f'q"{i}\n') for i in range(50)] + [("2A", 99, "x"), (None, 7, "n")]
    df = spark.createDataFrame(rows, "dep string, n int, t string").repartition(6)
    assert writers.json_documents(df, f"{tmp_path}/out", order=["n"], split_by="dep") == 4
    assert sorted(f for f in os.listdir(f"{tmp_path}/out") if not f.startswith(".")) == ["00.json", "01.json", "02.json", "2A.json"]
    for dep in ("00", "01", "02", "2A"):
        with open(f"{tmp_path}/out/{dep}.json") as file:
            want = sorted((r for r in rows if r[0] == dep), key=lambda r: r[1])
            assert json.load(file) == [{"dep": d, "n": n, "t": t} for d, n, t in want]
    for frame, size in ((df, len(rows)), (df.limit(0), 0)):
        assert writers.json_documents(frame, f"{tmp_path}/one", order=["n"]) == 1
        with open(f"{tmp_path}/one.json") as file:
            assert len(json.load(file)) == size
    assert sorted(f for f in os.listdir(tmp_path) if not f.startswith(".")) == ["one.json", "out"]


def test_collections_come_back_as_features(spark, tmp_path, outlines):
    shapes = outlines.withColumn("dep", F.substring("code_commune", 1, 2))
    assert writers.feature_collections(shapes, f"{tmp_path}/geo", digits=2, order=["code_commune"], split_by="dep") == 2
    with open(f"{tmp_path}/geo/01.geojson") as file:
        got = json.load(file)
    assert got["type"] == "FeatureCollection" and [f["properties"]["code_commune"] for f in got["features"]] == ["01001", "01002"]
    back = readers.feature_collection(spark, f"{tmp_path}/geo", "code_commune string, dep string")
    assert {r.code_commune: r.geom for r in back.collect()} == {
        r.code_commune: r.geom for r in outlines.collect()
    }
    writers.feature_collections(shapes.limit(0), f"{tmp_path}/none", digits=2, order=["code_commune"])
    with open(f"{tmp_path}/none.geojson") as file:
        assert json.load(file) == {"type": "FeatureCollection", "features": []}


def test_runs_of_one_day_get_folders_of_their_own(spark, tmp_path):
    paths = Layout(str(tmp_path))
    assert publish._fresh_base(spark, paths, "2024-01-01") == "runs/2024-01-01"
    os.makedirs(f"{paths.web()}/runs/2024-01-01")
    assert publish._fresh_base(spark, paths, "2024-01-01") == "runs/2024-01-01.2"
    assert publish.published_base(spark, paths) is None
    snapshots.write_small(spark, f"{paths.web()}/meta.json", '{"base": "runs/x"}')
    assert publish.published_base(spark, paths).endswith("/runs/x")
