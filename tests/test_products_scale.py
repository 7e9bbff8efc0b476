"""The products of settings and sensors: code that the JVM compiles, and the rows of the SQL."""

from __future__ import annotations

import re

import duckdb

from wearline.bindings import QUERIES
from wearline.bindings import fixtures as fx
from wearline.session import COMPILED_METHOD_BYTES

SMALL = "/root/testdata/sf0.001"


def test_products_fit_into_a_method_that_is_compiled(spark):
    name = "spark.sql.adaptive.enabled"
    spark.conf.set(name, "false")
    try:
        plan = QUERIES["setting_sensor_products"](spark, SMALL)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set(name, "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < COMPILED_METHOD_BYTES  # before: 8628


def test_sensors_of_missing_measurements(spark, tmp_path):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(400)
    holes = {"l_extendedprice": 3, "l_quantity": 5, "l_discount": 7, "l_tax": 11}
    lines = lines.selectExpr(*[f"if(l_partkey % {holes[c]} = 0, null, {c}) as {c}" if c in holes else c for c in lines.columns])
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = fx.telemetry(spark, str(tmp_path))
    db = duckdb.connect()
    db.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = db.sql(f"with {fx.TELEMETRY_SQL} select {', '.join(got.columns)} from telemetry").fetchall()
    assert any(None in r for r in want)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
