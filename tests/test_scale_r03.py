"""Steps that must stay small as tables grow: what they shuffle, and how they are compiled."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tables import SF001
from faresight.operators import clustering, iforest, segment
from faresight.operators.customers import customer_features, row_inputs, with_customer_windows
from faresight.session import METHOD_BYTES
from faresight.sources import candidates
from faresight.sources.store import staged


def test_methods_beyond_the_compiler_are_not_generated(spark):
    candidates(spark, SF001)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= METHOD_BYTES


def test_customers_join_sessions_before_options(spark):
    """The customer's columns reach the options with their session, not by a shuffle of all options."""
    plan = candidates(spark, SF001)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = {k: next(len(line) - len(line.lstrip(" :+-")) for line in plan if "Join Inner" in line and k in line)
             for k in ("(l_orderkey#", "= c_custkey#")}
    assert depth["(l_orderkey#"] < depth["= c_custkey#"]


def test_only_selected_rows_carry_ranks(spark):
    rows = staged(row_inputs(candidates(spark, SF001)), "rows")
    selected, counted = with_customer_windows(rows)
    assert selected.count() == rows.filter("selected = 1").count()
    assert counted.agg(F.sum("_copies")).first()[0] == rows.count()


def test_repeated_ids_meet_the_ranks_of_every_copy(spark):
    rows = row_inputs(candidates(spark, SF001)).filter("profileId % 7 = 1")
    twice = staged(rows.unionByName(rows), "twice")
    selected, counted = with_customer_windows(twice)
    assert selected.count() == 16 * rows.filter("selected = 1").count()
    assert counted.agg(F.sum(F.col("_copies") ** 3)).first()[0] == 16 * rows.count()


def test_customer_without_selection_keeps_its_values(spark):
    c = candidates(spark, SF001)
    one = c.select("profileId").first()[0]
    got = customer_features(c.filter(F.col("profileId") == one).withColumn("selected", F.lit(0))).first()
    assert got["total_flights_searched"] == c.filter(F.col("profileId") == one).count()
    assert (got["consistent_price_tier"], got["baggage_qty_preference"], got["avg_cabin_class"]) == (1.0, 0.0, 0.0)


def test_quantiles_tally_few_values(spark, monkeypatch):
    """Exact against numpy, and what is shuffled is a small part of the values."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=200_000), np.round(rng.exponential(size=200_000), 1)
    table = staged(spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": 1.0})).select(
        "*", F.lit(None).cast("double").alias("d"), F.when(F.col("a") > 0, F.lit(float("nan"))).otherwise(F.col("a")).alias("e"),
        F.when(F.col("a") > 1, F.col("b")).alias("f")), "columns")
    written = {}
    monkeypatch.setattr(segment, "staged", lambda df, name: written.setdefault(name, staged(df, name)))
    got = {r["name"]: (r["q0"], r["q1"], r["q2"]) for r in segment.column_quantiles(table, list("abcdef")).collect()}
    for name, values in (("a", a), ("b", b), ("c", np.ones(1)), ("f", b[a > 1])):
        np.testing.assert_allclose(got[name], np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-12)
    assert got["d"] == (None, None, None)
    assert got["e"][0] == np.sort(a)[49_999] + 0.75 * (np.sort(a)[50_000] - np.sort(a)[49_999]) and np.isnan(got["e"][2])
    assert written["quantiles"].filter("name = 'a'").count() < 10_000


def test_forest_walk_of_all_trees_equals_each_row_alone():
    rng = np.random.default_rng(5)
    trees = [iforest._grow(pd.DataFrame(rng.normal(size=(64, 3)), columns=list("xyz")).assign(_tree=t), list("xyz"), 6, 1) for t in range(9)]
    x = rng.normal(size=(200, 3))
    x[0, 1] = np.nan

    def alone(row):
        total = 0.0
        for t in trees:
            node, depth = t.iloc[0], 0
            while node["feature"] >= 0:
                node, depth = t.iloc[int(node["left"] if row[int(node["feature"])] < node["threshold"] else node["right"])], depth + 1
            total += depth + iforest._c(node["size"])
        return total

    assert iforest._path_lengths(x, *iforest._flat(trees)).tolist() == [alone(row) for row in x]


def test_moments_of_all_models_share_the_products():
    rng = np.random.default_rng(7)
    x, resp = rng.normal(size=(2_500, 4)), {"a": rng.random((2_500, 3)), "b": rng.random((2_500, 2))}
    got = clustering._moments(resp, x)
    for name, r in resp.items():
        want = np.hstack([r.sum(0)[:, None], r.T @ x, np.einsum("nk,ni,nj->kij", r, x, x).reshape(r.shape[1], 16)])
        np.testing.assert_allclose(got[name], want, rtol=1e-10, atol=1e-9)
