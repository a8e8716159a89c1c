"""Silhouette and nearest centroid against brute force in numpy."""

import numpy as np

from faresight.operators import segment as SG


def _blobs(spark, n=40, seed=3):
    rnd = np.random.default_rng(seed)
    centers = np.array([[0, 0, 0], [5, 5, 0], [0, 6, 6]], dtype=float)
    lab = np.arange(n) % 3
    x = centers[lab] + rnd.normal(size=(n, 3))
    rows = [(int(i), int(lab[i]), [float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label int, features array<double>"), x, lab


def test_silhouette_sq_matches_brute_force(spark):
    df, x, lab = _blobs(spark)
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    got = SG.silhouette_sq(df, "label").first().silhouette
    assert abs(got - np.mean(s)) < 1e-9


def test_nearest_centroid(spark):
    df, x, lab = _blobs(spark)
    cents = SG.centroids(df, "label")
    out = {r.id: r for r in SG.nearest_centroid(df, cents, "label").collect()}
    c = np.stack([x[lab == k].mean(0) for k in range(3)])
    d = np.sqrt(((x[:, None, :] - c[None]) ** 2).sum(-1))
    for i in range(len(x)):
        assert out[i].customer_segment == int(d[i].argmin())
        assert abs(out[i].min_distance - d[i].min()) < 1e-9


def test_every_family_sweeps_its_own_sizes(spark, monkeypatch):
    """The registered query hands each family the sizes of J7, J9 and J12."""
    from faresight.plans import catalog
    seen = {}

    def note(points, kmeans_ks=(), gmm_ks=(), ward_ks=(), linkage_ks=(), seed=42):
        seen.update(kmeans=list(kmeans_ks), gmm=list(gmm_ks), ward=list(ward_ks), linkage=list(linkage_ks))
        return None, {"kmeans:4": 0.1, "gmm:15": 0.2, "ward:10": 0.3, "linkage:ward_euclidean_4": 0.4}

    df, *_ = _blobs(spark)
    monkeypatch.setattr(SG.clustering, "sweep_all", note)
    monkeypatch.setattr(SG.density, "dbscan_sweep", lambda *a: {"dbscan:0.5": 0.5, "dbscan:0.7": 0.6})
    monkeypatch.setattr(catalog, "_cust", lambda *a: None)
    monkeypatch.setattr(catalog, "staged", lambda df, name: df)
    monkeypatch.setattr(catalog, "remove_outliers", lambda *a: (None, None))
    monkeypatch.setattr(catalog, "reduced_customers", lambda c: (df.withColumnRenamed("id", "profileId"), None))
    rows = catalog.q_clustering_methods(spark, "").collect()
    j12 = list(range(4, 17))
    assert seen == {"kmeans": j12, "gmm": [15, 20, 25, 30, 35, 40], "ward": list(range(10, 36, 5)), "linkage": j12}
    assert [(r.method, r.setting) for r in rows] == [("kmeans", "4"), ("gmm", "15"), ("dbscan", "0.7"), ("ward", "10"),
                                                     ("linkage", "ward_euclidean_4")]
