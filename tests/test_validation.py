import pytest
from pyspark.sql import functions as F

from orbita.contracts import BEHAVIOUR_COLUMNS, PROFILE_COLUMNS
from orbita.errors import JoinRefused, RulesViolated
from orbita.operators import integrate as I
from orbita.operators import validate as V


def codes(df):
    return {(r["code"], r["column_name"]) for r in df.collect()}


def test_clean_pair_has_no_errors_and_joins_one_to_one(behaviour, profile):
    issues = V.validate_sources(behaviour, profile)
    assert issues.filter("severity = 'error'").count() == 0
    res = I.join_one_to_one(behaviour, profile)
    assert res.base.count() == 12 and len(res.base.columns) == 16


def test_missing_column_is_an_error_and_blocks_integration(behaviour, profile):
    issues = V.validate_sources(behaviour.drop("gasto_mensual"), profile)
    assert ("MISSING_REQUIRED_COLUMNS", "gasto_mensual") in codes(issues)
    with pytest.raises(RulesViolated):
        V.raise_if_invalid(issues, "x")
    with pytest.raises(JoinRefused):
        I.check_gate(issues)


def test_null_is_only_a_warning(behaviour, profile):
    b = behaviour.withColumn("gasto_mensual", F.when(F.col("id_cliente") == 1001, None).otherwise(F.col("gasto_mensual")))
    issues = V.validate_sources(b, profile)
    assert ("NULL_VALUES", "gasto_mensual") in codes(issues)
    assert issues.filter("severity = 'error'").count() == 0


def test_duplicated_profile_id(behaviour, profile):
    issues = V.validate_sources(behaviour, profile.unionByName(profile.limit(1)))
    assert ("DUPLICATED_CUSTOMER_ID", "id_cliente") in codes(issues)
    # the id comparison is skipped when a source has an id error
    assert not any(c == "CUSTOMER_ID_MISMATCH" for c, _ in codes(issues))


def test_foreign_profile_id_is_a_mismatch(behaviour, profile):
    p = profile.withColumn("id_cliente", F.when(F.col("id_cliente") == 1001, 999999).otherwise(F.col("id_cliente")))
    issues = V.validate_sources(behaviour, p)
    assert ("CUSTOMER_ID_MISMATCH", "id_cliente") in codes(issues)
    only = [r[0] for r in V.ids_only_left(behaviour, p).collect()]
    assert only == [1001.0]


def test_text_and_infinite_values(spark, behaviour, profile):
    b = behaviour.withColumn("tiempo_promedio_sesion_min",
                             F.when(F.col("id_cliente") == 1002, F.lit("x")).otherwise(F.col("tiempo_promedio_sesion_min").cast("string")))
    b = b.withColumn("horas_consumo_mensual", F.when(F.col("id_cliente") == 1003, F.lit(float("inf"))).otherwise(F.col("horas_consumo_mensual")))
    got = codes(V.validate_source(b, BEHAVIOUR_COLUMNS, "s"))
    assert ("NON_NUMERIC_VALUES", "tiempo_promedio_sesion_min") in got
    assert ("INFINITE_VALUES", "horas_consumo_mensual") in got


def test_non_positive_and_unexpected(spark, profile):
    p = profile.withColumn("extra", F.lit(1)).withColumn(
        "id_cliente", F.when(F.col("id_cliente") == 1001, 0).otherwise(F.col("id_cliente")))
    got = codes(V.validate_source(p, PROFILE_COLUMNS, "p"))
    assert ("NON_POSITIVE_CUSTOMER_ID", "id_cliente") in got and ("UNEXPECTED_COLUMNS", "extra") in got


def test_empty_source_stops(spark, behaviour):
    got = codes(V.validate_source(behaviour.limit(0), BEHAVIOUR_COLUMNS, "s"))
    assert got == {("EMPTY_SOURCE", None)}


def test_homonym_columns_are_rejected(behaviour, profile):
    with pytest.raises(JoinRefused):
        I.join_one_to_one(behaviour, profile.withColumn("gasto_mensual", F.lit(1.0)))


def test_clean_validation_flags_out_of_range(behaviour, profile):
    base = I.join_one_to_one(behaviour, profile).base
    bad = base.withColumn("edad", F.when(F.col("id_cliente") == 1001, 7).otherwise(F.col("edad")))
    assert ("VALUE_BELOW_MINIMUM", "edad") in codes(V.validate_clean(bad))
    assert V.validate_clean(base).filter("severity = 'error'").count() == 0


def test_invalid_types(spark):
    assert codes(V.validate_source([1, 2], BEHAVIOUR_COLUMNS, "s")) == {("INVALID_SOURCE_TYPE", None)}
    assert codes(V.validate_clean({"a": 1})) == {("INVALID_CLEAN_DATASET_TYPE", None)}
