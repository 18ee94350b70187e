from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from plyscope.operators import classifiers
from plyscope.plans.analysis import analyse
from plyscope.sources.stages import MANIFEST, StageCache
from verification import tables


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(10).write.parquet(path)
    return path


def test_an_entry_is_known_by_files_schema_and_parameters(spark, source, tmp_path):
    calls = []

    def run(inputs=None, force=False, **params):
        def build():
            calls.append(params)
            return spark.read.parquet(source).withColumn("n", F.lit(len(calls)))

        table = StageCache(spark, str(tmp_path / "cache")).table("s", build, inputs or [spark.read.parquet(source)], params, force)
        return table.agg(F.max("n")).first()[0]

    assert (run(), run(), len(calls)) == (1, 1, 1)
    assert (run(k=2), run(k=3), run(k=2)) == (2, 3, 2)
    assert run([spark.read.parquet(source).select((F.col("id") + 1).alias("other"))]) == 4  # another schema
    assert (run([source]), run([source])) == (5, 5)  # a bare path
    assert (run(force=True), run(), run(k=2)) == (6, 6, 2)
    spark.range(3).write.mode("append").parquet(source)
    assert (run(), run()) == (7, 7)
    file = next(str(p) for p in (tmp_path / "in").glob("*.parquet"))
    os.utime(file, (1, 1))
    assert run() == 8
    with pytest.raises(ValueError):
        run([spark.createDataFrame([(1,)], "id long")])


def test_an_unfinished_write_is_never_read(spark, source, tmp_path):
    cache = StageCache(spark, str(tmp_path / "cache"))

    def fails(path):
        spark.range(2).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        cache.stored("s", fails, spark.read.parquet, [source])
    made = cache.table("s", lambda: spark.range(4), [source])
    assert made.count() == 4 and len(list((tmp_path / "cache" / "s").iterdir())) == 1
    (entry,) = (tmp_path / "cache" / "s").iterdir()
    assert len([p for p in entry.iterdir() if p.name.startswith(MANIFEST)]) == 1
    assert len([p for p in entry.iterdir() if p.name.startswith("data-")]) == 2


def test_models_are_stages_too(spark, source, tmp_path):
    rows = [(f"p{i}", "ab"[i % 2], float(i % 2) + i / 100) for i in range(40)]
    df = spark.createDataFrame(rows, "player string, label string, x double")
    cache, fits = StageCache(spark, str(tmp_path / "cache")), []

    def write(path):
        fits.append(1)
        classifiers.fit_model(df, ["x"], ["a", "b"], classifiers.BOOSTED, boosted_params={"maxIter": 3, "maxDepth": 2}).save(path)

    for _ in range(2):
        model = cache.stored("model", write, lambda path: classifiers.load_model(spark, path), [source], {"kind": "boosted"})
    assert len(fits) == 1 and model.predict(df).where("predicted = label").count() == 40


def test_whole_analysis_runs_and_reuses_its_stages(spark, sf, tmp_path):
    games = tmp_path / "games"
    tables.games(spark, sf).write.parquet(str(games))
    small = {"forest_params": {"numTrees": 4, "maxDepth": 3}, "boosted_params": {"maxIter": 2, "maxDepth": 2}, "restarts": 2, "min_games": 5}
    full = spark.read.parquet(str(games))
    first = analyse(spark, full, str(tmp_path / "out"), **small)
    second = analyse(spark, full, str(tmp_path / "out"), **small)
    assert first.features.inputFiles() == second.features.inputFiles()
    assert first.players.inputFiles() == second.players.inputFiles()
    row = second.summary.first()
    assert row["clustering"]["silhouette_score"] > 0 and 0 <= row["classification"]["test_accuracy"] <= 1
    fewer = analyse(spark, full, str(tmp_path / "out"), **{**small, "min_games": 6})
    assert fewer.features.inputFiles() == first.features.inputFiles()
    assert fewer.players.inputFiles() != first.players.inputFiles()
