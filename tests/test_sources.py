"""FeatureCollections read by split, clustered sinks, run records."""

import glob
import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from locus.operators import results
from locus.runtime import scratch_path
from locus.sources import geojson, points as P, runlog


def collection(n, rnd):
    """Features whose members stand in any order, over any lines, with awkward names."""
    feats = []
    for i in range(n):
        x = float(i)
        members = {"type": "Feature",
                   "properties": {"prov_name": rnd.choice(['A "quoted" }{ name', "Forlì", "type", f"p{i % 7}", "}],"]), "reg_name": f"r{i}",
                                  "more": {"list": [{"a": 1}, {"b": "]}"}]}},
                   "geometry": {"type": "Polygon", "coordinates": [[[x, 0.0], [x + 1, 0.0], [x, 1.5], [x, 0.0]]]}}
        if i % 3 == 0:
            members["id"] = rnd.choice([i, f"s{i}"])
        keys = list(members)
        rnd.shuffle(keys)
        feats.append({k: members[k] for k in keys})
    return feats


def written(tmp_path, docs):
    for i, text in enumerate(docs):
        (tmp_path / f"c{i}.json").write_text(text, encoding="utf-8")
    return f"file://{tmp_path}"


def as_read(rows):
    return [(r["feature_order"]["file"].rpartition("/")[2], r["feature_id"], r["prov_name"], r["reg_name"], r["geometry"]) for r in rows]


def as_json(docs):
    out = []
    for i, text in enumerate(docs):
        for f in json.loads(text)["features"]:
            g, number = f["geometry"], f.get("id")
            out.append((f"c{i}.json", number if isinstance(number, int) else None, f["properties"]["prov_name"], f["properties"]["reg_name"],
                        [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]))
    return out


@pytest.mark.parametrize("split", ["128m", "700", "97"])
def test_collections_are_read_by_split(spark, tmp_path, split):
    rnd = random.Random(5)
    docs = [json.dumps({"type": "FeatureCollection", "crs": {"x": [1]}, "features": collection(60, rnd)}),
            json.dumps({"features": collection(25, rnd), "type": "FeatureCollection"}, indent=2),
            json.dumps({"type": "FeatureCollection", "features": collection(9, rnd)}, separators=(",", ":"), ensure_ascii=False),
            json.dumps({"type": "FeatureCollection", "features": []}),
            json.dumps({"type": "FeatureCollection", "features": collection(1, rnd)})]
    path = written(tmp_path, docs)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        if split != "128m":
            assert spark.read.option("lineSep", geojson.MARK).text(path).rdd.getNumPartitions() > 10
        got = geojson.read_regions(spark, path, collection=True).orderBy("feature_order.file", "feature_order.pos").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert as_read(got) == as_json(docs)


def test_a_feature_within_a_feature_raises(spark, tmp_path):
    bad = {"type": "Feature", "properties": {"prov_name": "p", "inner": {"type": "Feature"}}, "geometry": None}
    path = written(tmp_path, [json.dumps({"type": "FeatureCollection", "features": [bad]})])
    with pytest.raises(Exception, match="Feature"):
        geojson.read_regions(spark, path, collection=True).collect()


def test_a_folder_has_as_few_files_as_its_rows_need(spark, tmp_path):
    # One group with a third of the rows (half of them copies of one row), many small ones, a null one; far more tasks than files.
    rows = [("hot", "x y/z", i if i % 2 else 1) for i in range(1000)] + [(f"g{i % 40}", None if i % 3 else "b", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "reg STRING, prov STRING, v BIGINT").repartition(23)
    # As with large data: tasks aren't merged because they are small.
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    old = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        P.write_points(df, str(tmp_path / "out"), ["reg", "prov"], fmt="parquet", file_rows=100)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("reg", "prov", "v").collect()), key=repr) == sorted(rows, key=repr)
    sizes = {}
    for r in back.groupBy("reg", "prov", F.input_file_name().alias("f")).count().collect():
        sizes.setdefault((r["reg"], r["prov"]), []).append(r["count"])
    for group, files in sizes.items():
        assert len(files) <= -(-sum(files) // 100), group
    assert len(sizes["hot", "x y/z"]) > 5 and max(sizes["hot", "x y/z"]) < 500
    assert len(glob.glob(str(tmp_path / "out/*/*/part-*"))) == sum(map(len, sizes.values()))


def test_run_records_are_added_once(spark):
    path = scratch_path(spark, "test-runs")
    assert runlog.append_run(spark, path, 5, 20, 8, 1.5, run_id="a")
    assert not runlog.append_run(spark, path, 5, 20, 8, 1.5, run_id="a")
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda i: runlog.append_run(spark, path, 5, 20, i // 2, float(i), run_id=f"w{i // 2}"), range(8)))
    assert sum(done) == 4
    runlog.append_run(spark, path, 5, 20, 9, 2.0)
    runlog.append_run(spark, path, 5, 20, 9, 2.0)
    rows = sorted(tuple(r)[2] for r in runlog.read_runs(spark, path).collect())
    assert rows == [0, 1, 2, 3, 8, 9, 9]
    with pytest.raises(ValueError):
        runlog.append_run(spark, path, 1, 2, 1, 0.1, run_id="../x")


def test_sequential_baseline_does_not_depend_on_row_order(spark):
    long = spark.createDataFrame(
        [("d", "kmeans", results.SEQUENTIAL, 1, None, c, m, 0.1) for c, m in ((4, 7.0), (1, 9.0), (1, 8.0))]
        + [("d", "kmeans", "Parallel", 1, 0, 8, 2.0, 0.1)],
        "dataset STRING, algorithm STRING, scenario STRING, managers INT, workers INT, cores INT, mean DOUBLE, std DOUBLE")
    for n in (1, 4):
        got = results.speedup_vs_baseline(long.repartition(n)).filter("scenario = 'Parallel'").first()
        assert got["speedup"] == 4.0
