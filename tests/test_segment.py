import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orbita.contracts import KMEANS_FEATURES
from orbita.errors import ModelInputRefused
from orbita.operators import segment as SG


def test_missing_feature_is_rejected(spark, behaviour):
    with pytest.raises(ModelInputRefused):
        SG.kmeans_input(behaviour.drop("edad"))


def test_population_std_scaling(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4])], "id_cliente long, x double")
    st = SG.scaler_stats(df, ["x"]).collect()[0]
    assert st["std"] == pytest.approx(1.118033988749895)
    z = [r["x"] for r in SG.scale(df, [st], ["x"], vector=False).orderBy("id_cliente").collect()]
    assert z[0] == pytest.approx(-1.3416407864998738)


def test_three_blobs_sweep_and_relabel(spark):
    rows = []
    for c, (cx, spend) in enumerate([(0.0, 300.0), (10.0, 100.0), (20.0, 200.0)]):
        for j in range(20):
            rows.append((c * 100 + j, cx + (j % 5) * 0.1, spend + j))
    df = spark.createDataFrame(rows, "id_cliente long, a double, gasto_mensual double")
    stats = SG.scaler_stats(df, ["a", "gasto_mensual"]).collect()
    scaled = SG.scale(df, stats, ["a", "gasto_mensual"]).persist()
    sweep = SG.k_sweep(scaled, 60, k_max=5, restarts=2, features=["a", "gasto_mensual"])
    rows_k = [tuple(r) for r in sweep.table.collect()]
    k, method = SG.choose_k(rows_k)
    assert k == 3
    assigned = scaled.select("id_cliente", SG.assign_expr(sweep.centres[3], ["a", "gasto_mensual"]).alias("cluster"))
    rel = SG.relabel_by_spend(assigned, df).join(df, "id_cliente")
    means = {r["cluster"]: r["m"] for r in rel.groupBy("cluster").agg(F.avg("gasto_mensual").alias("m")).collect()}
    assert means[0] < means[1] < means[2]


def test_streaming_scoring_scores_and_rejects(spark, tmp_path):
    import json
    from orbita.streaming import scoring_stream as SS
    src = tmp_path / "in"
    src.mkdir()
    reqs = [{"id_cliente": i, **{c: str(v) for c, v in zip(KMEANS_FEATURES, [40, 150, 20, 5, 55, 100, 5, 0.3, 30, 40,
                                                                             2, 0.5, 3, 2, 20])}} for i in (1, 2)]
    reqs[1]["porcentaje_uso_app_movil"] = "3.0"  # out of range: rejected
    (src / "r.json").write_text("\n".join(json.dumps(r) for r in reqs))
    score = lambda df: df.select("id_cliente", (F.col("gasto_mensual") * 2).alias("y"))
    q = SS.start(spark, str(src), score, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    ok = spark.read.parquet(str(tmp_path / "ok")).collect()
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [r["id_cliente"] for r in ok] == [1] and ok[0]["y"] == 300.0
    assert [r["id_cliente"] for r in bad] == [2] and "porcentaje_uso_app_movil:above_maximum" in bad[0]["motivos"]


def test_batched_restarts_match_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    pts = np.vstack([rng.normal(c, 0.6, size=(40, 3)) for c in ([0, 0, 0], [4, 4, 0], [0, 4, 4])])
    feats = ["a", "b", "c"]
    df = spark.createDataFrame([(i + 1, *map(float, p)) for i, p in enumerate(pts)],
                               "id_cliente long, a double, b double, c double")
    configs = [(k, 29 + s) for k in (2, 3, 4) for s in range(3)]
    fits = SG.kmeans_restarts(df.repartition(3), feats, configs)
    again = SG.kmeans_restarts(df.repartition(1), feats, configs)
    assert set(fits) == set(range(len(configs)))
    for c, (k, _) in enumerate(configs):
        centres, inertia = fits[c]
        assert centres.shape == (k, 3)
        d = ((pts[:, None, :] - centres[None]) ** 2).sum(-1)
        lab = d.argmin(1)
        assert inertia == pytest.approx(d.min(1).sum(), rel=1e-9)  # cost of the final centres
        for j in range(k):  # converged: each non-empty centre is the mean of its points
            if (lab == j).any():
                assert np.allclose(centres[j], pts[lab == j].mean(0), atol=1e-6)
        assert np.allclose(centres, again[c][0])  # seeding and passes do not depend on partitioning
        got = [r["cl"] for r in df.orderBy("id_cliente").select(SG.assign_expr(centres, feats).alias("cl")).collect()]
        assert got == lab.tolist()
    best3 = min(fits[c][1] for c, (k, _) in enumerate(configs) if k == 3)
    best2 = min(fits[c][1] for c, (k, _) in enumerate(configs) if k == 2)
    assert best3 < 0.5 * best2


def test_silhouette_of_given_labels_matches_pairs(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [(["a", "b", "b", "c"][int(rng.integers(4))], *map(float, rng.normal(size=3))) for _ in range(40)]
    rows.append(("alone", 0.0, 0.0, 0.0))
    got = {r.s: r for r in SG.silhouette_given(spark.createDataFrame(rows, "s string, x double, y double, z double"), "s",
                                               ["x", "y", "z"]).collect()}
    x, label = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows])
    dist = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    for seg in set(label):
        values = []
        for i in np.flatnonzero(label == seg):
            own = label == seg
            if own.sum() == 1:
                values.append(0.0)
                continue
            a = dist[i][own].sum() / (own.sum() - 1)
            b = min(dist[i][label == o].mean() for o in set(label) - {seg})
            values.append((b - a) / max(a, b))
        assert abs(got[seg].silhouette_sq - np.mean(values)) < 1e-9 and got[seg].usuarios == len(values)
    one = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "s string, x double")
    assert [r.silhouette_sq for r in SG.silhouette_given(one, "s", ["x"]).collect()] == [0.0]


def test_restarts_by_task_equal_the_distributed_passes(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3)) + rng.integers(0, 4, 400)[:, None] * 3.0
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id_cliente=rng.permutation(400))).repartition(3)
    configs = [(k, 29 + i) for k in (2, 3, 4, 5) for i in range(2)]
    one = SG.kmeans_restarts(df, list("abc"), configs)
    many = SG.kmeans_restarts(df, list("abc"), configs, local_rows=0)
    for c in many:
        assert np.allclose(one[c][0], many[c][0]) and abs(one[c][1] / many[c][1] - 1) < 1e-9


def test_passes_fill_the_cores_and_draw_once_a_seed(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert SG.partitions(spark, 900_000) % cores == 0 and SG.partitions(spark, 5_400_000) >= 27
    drawn, step = [], SG._seed_step
    monkeypatch.setattr(SG, "_seed_step", lambda f, i, todo, *rest: drawn.append(len(todo)) or step(f, i, todo, *rest))
    df = spark.createDataFrame([(i, float(i % 7), float(i * i % 11)) for i in range(1, 60)], "id_cliente long, a double, b double")
    configs = [(k, 29 + i) for k in (2, 3, 4) for i in range(2)]
    SG.kmeans_restarts(df, ["a", "b"], configs, local_rows=0)
    assert drawn == [2, 2, 2, 2]  # one draw a seed and step; one a restart before: 6, 6, 4, 2
