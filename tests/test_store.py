"""Stages and fitted artefacts outlive the session that wrote them; shared folders are asked for on clusters."""

import types

import pytest
from pyspark.sql import functions as F

from tables import SF001
from faresight import session
from faresight.operators import segment as SG
from faresight.operators.lambdamart import LambdaMARTModel, train_lambdamart
from faresight.operators.options import option_features
from faresight.plans.catalog import fit_segmentation
from faresight.operators.customers import customer_features
from faresight.schema import segment_columns, snake_case, with_snake_case_columns
from faresight.sources import candidates
from faresight.sources.artefacts import load_segmentation, save_segmentation
from faresight.sources.store import load_or_build, staged


def test_stage_is_built_once_and_rebuilt_without_its_columns(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(5).withColumn("a", F.col("id") * 2)

    path = str(tmp_path / "stage")
    assert load_or_build(spark, path, build, ["a"]).count() == 5
    other = spark.newSession()
    assert load_or_build(other, path, build, ["a"]).agg(F.sum("a")).first()[0] == 20
    assert built == [1]
    load_or_build(spark, path, build, ["b"])
    assert built == [1, 1]


def test_cluster_without_shared_folder_is_an_error():
    def fake(master, conf=None):
        sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d: conf))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.checkpoint_dir(fake(master))
    assert session.checkpoint_dir(fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert session.checkpoint_dir(fake("local[4]"))


def test_segmentation_round_trip_assigns_alike(spark, tmp_path):
    cust = staged(customer_features(candidates(spark, SF001)), "test-customers")
    inliers, reduced, fitted = fit_segmentation(cust, ks=[2, 3])
    assert inliers.count() == cust.count() - cust.count() * 5 // 100 == reduced.count()
    sizes = [r["n"] for r in fitted.centroids.orderBy("cluster").collect()]
    assert sizes == sorted(sizes, reverse=True)
    save_segmentation(fitted, str(tmp_path))
    loaded = load_segmentation(spark.newSession(), str(tmp_path))
    want = sorted(map(tuple, fitted.assign(cust).collect()))
    got = sorted(map(tuple, loaded.assign(cust).collect()))
    assert [w[:2] for w in want] == [g[:2] for g in got]
    assert all(abs(w[2] - g[2]) < 1e-9 for w, g in zip(want, got, strict=True))


def test_ranker_round_trip_scores_alike(spark, tmp_path):
    opts = staged(option_features(candidates(spark, SF001), single_row_percentile=50.0), "test-options")
    model = train_lambdamart(opts, rounds=2, min_instances=5, max_bins=32)
    assert "primary_carrier" in model.binning.values
    model.save(str(tmp_path / "ranker"))
    loaded = LambdaMARTModel.load(str(tmp_path / "ranker"))
    unseen = opts.withColumn("primary_carrier", F.when(F.col("Id") % 2 == 0, "new").otherwise(F.col("primary_carrier")))
    a, b = (sorted((r.Id, round(r.y_pred, 12)) for r in m.score(unseen).select("Id", "y_pred").collect()) for m in (model, loaded))
    assert a == b and len({s for _, s in a}) > 5


def test_coinciding_points_and_quantiles(spark):
    points = spark.createDataFrame([(i, i % 2, [1.0, 2.0]) for i in range(6)], "id long, label int, features array<double>")
    assert SG.silhouette_sq(points, "label").first().silhouette == 0.0
    df = spark.createDataFrame([(float(x), 5.0, None if x < 2 else float(x)) for x in (4, 1, 2, 3)], "a double, b double, c double")
    got = {r["name"]: (r["center"], r["scale"]) for r in SG.robust_scaling(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (2.5, 1.5), "b": (5.0, 1.0), "c": (3.0, 1.0)}


def test_names():
    assert snake_case("departureFrom") == "departure_from" and snake_case("ABCd") == "ab_cd"
    assert snake_case("legs0_segments1_cabinClass") == "legs0_segments1_cabin_class" and snake_case("isAccess3D") == "is_access3_d"
    have = ["legs1_segments0_duration", "legs0_segments2_duration", "x", "legs0_segments0_duration"]
    assert segment_columns("duration", have) == ["legs0_segments0_duration", "legs0_segments2_duration", "legs1_segments0_duration"]


def test_renamed_frame(spark):
    assert with_snake_case_columns(spark.range(1).withColumnRenamed("id", "rankerId")).columns == ["ranker_id"]


def test_a_stage_of_other_input_or_parameters_is_rebuilt(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "stage")
    spark.range(3).write.parquet(source)
    built = []

    def stage(**parameters):
        def build():
            built.append(parameters)
            return spark.read.parquet(source)
        return load_or_build(spark, path, build, ["id"], inputs=[source], parameters=parameters).count()

    assert stage(k=1) == 3 and stage(k=1) == 3 and len(built) == 1
    assert stage(k=2) == 3 and len(built) == 2
    spark.range(5).write.mode("append").parquet(source)
    assert stage(k=2) == 8 and len(built) == 3 and stage(k=2) == 8 and len(built) == 3
