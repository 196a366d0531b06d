import pytest
from pyspark.sql import functions as F

from orbita.contracts import CLASSIFICATION_TARGET
from orbita.errors import ModelInputRefused
from orbita.operators import supervised as SV


def test_leakage_guard(spark, behaviour):
    with pytest.raises(ModelInputRefused):
        SV.check_supervised_input(behaviour, ["sesiones_semana"], CLASSIFICATION_TARGET)
    with pytest.raises(ModelInputRefused):
        SV.check_supervised_input(behaviour, ["gasto_mensual"], "gasto_mensual")


def test_split_is_deterministic_and_about_twenty_percent(spark):
    df = spark.range(1, 5001).withColumnRenamed("id", "id_cliente")
    a = SV.train_test_split(df).filter("is_test = 1").count()
    b = SV.train_test_split(df.repartition(7)).filter("is_test = 1").count()
    assert a == b and 800 < a < 1200


def test_stratified_folds_are_balanced(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("id_cliente"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = SV.folds(df, k=5, label="y").groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in f if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_metrics_and_auc_against_brute_force(spark):
    rows = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.8), (4, 0, 0.3), (5, 1, 0.6), (6, 0, 0.1)]
    df = spark.createDataFrame(rows, "id_cliente long, valor_real int, probabilidad_riesgo double") \
        .withColumn("valor_predicho", (F.col("probabilidad_riesgo") >= 0.5).cast("int"))
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert SV.roc_auc(df).collect()[0][0] == round(brute, 6)
    m = SV.classification_metrics(df).collect()[0]
    assert m["precision"] == round(3 / 4, 6) and m["recall"] == 1.0 and m["accuracy"] == round(5 / 6, 6)
    cm = {(r["real"], r["predicho"]): r["n"] for r in SV.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 0, (1, 1): 3}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)], "valor_real double, valor_predicho double")
    m = SV.regression_metrics(df).collect()[0]
    assert m["mae"] == 0.5 and m["rmse"] == round((0.375) ** 0.5, 6)
