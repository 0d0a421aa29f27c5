import datetime as dt
from decimal import Decimal

from cartledger.plans import quality
from cartledger.plans.audit import AuditLog

SCHEMA = "i int, x double, s string, t timestamp_ntz, m decimal(18,2), f float, d decimal(9,4), b boolean"


def test_quality_report(spark):
    nan = float("nan")
    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, 0.0, "a", t, Decimal("1.10"), 0.5, Decimal("1.1000"), True),
        (1, -0.0, "", t, Decimal("1.10"), nan, None, False),
        (None, nan, "a", None, Decimal("2.00"), 0.5, Decimal("1.1000"), None),
    ]
    report = quality.quality_report(spark.createDataFrame(rows, SCHEMA))
    assert report.columns == [
        "Columna", "Tipo", "No_Nulos", "Nulos", "Porcentaje_Nulos", "Valores_Unicos",
    ]
    assert [tuple(r) for r in report.collect()] == [
        ("i", "int", 2, 1, 33.33, 1),
        ("x", "double", 2, 1, 33.33, 1),
        ("s", "string", 3, 0, 0.0, 2),
        ("t", "timestamp_ntz", 2, 1, 33.33, 1),
        ("m", "decimal(18,2)", 3, 0, 0.0, 2),
        ("f", "float", 2, 1, 33.33, 1),
        ("d", "decimal(9,4)", 2, 1, 33.33, 1),
        ("b", "boolean", 2, 1, 33.33, 2),
    ]


def test_quality_report_of_an_empty_table(spark):
    report = quality.quality_report(spark.createDataFrame([], "i int, s string"))
    assert [tuple(r) for r in report.collect()] == [
        ("i", "int", 0, 0, None, 0),
        ("s", "string", 0, 0, None, 0),
    ]


def test_table_info(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "i int, x double")
    assert [tuple(r) for r in quality.table_info(df, "t").collect()] == [
        ("t", 2, 2, "i, x", 0, "i", "int", 0),
        ("t", 2, 2, "i, x", 1, "x", "double", 2),
    ]


def test_audit_counts(spark):
    audit = AuditLog()
    audit.record("clean", "a", spark.range(5), spark.range(3))
    audit.record("clean", "b", spark.range(2), spark.range(2))
    rows = audit.counts().orderBy("position").collect()
    assert [(r.step, r.table, r.rows_in, r.rows_out, r.removed) for r in rows] == [
        ("clean", "a", 5, 3, 2),
        ("clean", "b", 2, 2, 0),
    ]
    assert all(r.ts is not None for r in rows)
