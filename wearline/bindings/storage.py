"""Queries that write derived test data to the shared folder and read it back through the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.bindings import fixtures as fx
from wearline.bindings.monitoring import plain_times
from wearline.bindings.features import FEATURED_CTES, with_rul
from wearline.bindings.ready import ready_tables
from wearline.bindings.registry import oracle, query
from wearline.session import fresh_path
from wearline.sources import feedback as fb
from wearline.sources import requests as rq
from wearline.sources import telemetry as tele
from wearline.spec import SPEC

IN_FOLDER = r"subset=(\d+)/"


@query("read_telemetry_text", oracle("select * exclude (split) from telemetry where split = 'train'", "telemetry"))
def _read_text(spark, sf):
    path = fresh_path(spark, "text")
    df = fx.telemetry(spark, sf, "train")
    line = F.concat_ws("   ", *[F.col(c).cast("string") for c in (SPEC.entity, SPEC.order, *SPEC.base)])
    df.select("subset", F.concat(F.lit(" "), line, F.lit("  ")).alias("value")).write.partitionBy("subset").text(path)
    return tele.read_telemetry_text(spark, path, pattern=IN_FOLDER)


@query("tag_subset", oracle("select * from telemetry", "telemetry"))
def _tag(spark, sf):
    path = fresh_path(spark, "tag")
    # Sensors repeat digits of few columns, which zstd finds.
    fx.telemetry(spark, sf).write.partitionBy("subset").option("compression", "zstd").parquet(path)
    return tele.tag_subset(spark.read.parquet(path).drop("subset"), pattern=IN_FOLDER)


@query("read_rul_labels", oracle("select subset, line_no, rul from rul_labels", "labels"))
def _read_labels(spark, sf):
    # One file per group, lines in unit order.
    path = fresh_path(spark, "labels")
    (fx.rul_labels(spark, sf).repartition("subset").sortWithinPartitions("subset", "line_no")
     .select("subset", F.col("rul").cast("string").alias("value")).write.partitionBy("subset").text(path))
    return tele.read_rul_labels(spark, path, pattern=IN_FOLDER)


@query("write_prepared", oracle("select * from train_rul", "prepared"))
def _prepared(spark, sf):
    path = fresh_path(spark, "prepared")
    tele.write_prepared(with_rul(spark, sf, "train"), path)
    return tele.read_prepared(spark, path)


@query("write_prepared_csv", oracle("select * from test_rul", "prepared"))
def _prepared_csv(spark, sf):
    path = fresh_path(spark, "prepared-csv")
    tele.write_prepared(with_rul(spark, sf, "test"), path, fmt="csv")
    return tele.read_prepared(spark, path, fmt="csv")


_LABELLED = """
labelled as (
  select f.* exclude (split) replace (f.unit_number + 1000 * f.subset as unit_number), t."RUL"
  from featured f join {0}_rul t using (subset, unit_number, time_cycles) where f.split = '{0}')"""
_TRAIN_BANDS = """(subset in (1, 3) and "RUL" between 6 and 145) or (subset in (2, 4) and "RUL" between 6 and 194)"""


def _written(name: str, side: str, rows: str) -> None:
    """Every row and column of a ready table, as it is read back."""
    @query(name, oracle(f"select * from labelled {rows}", "prepared", ctes=(*FEATURED_CTES, _LABELLED.format(side))))
    def _run(spark, sf, table=name.removeprefix("write_ready_")):
        return getattr(ready_tables(spark, sf), table)


_written("write_ready_train", "train", f"where {_TRAIN_BANDS}")
_written("write_ready_test", "test", "")
_written("write_ready_test_last_rows", "test",
         "qualify row_number() over (partition by subset, unit_number order by time_cycles desc) = 1")


@query("write_ready", oracle(f"""
select 'train' as name, count(*) as n, cast(sum("RUL") as bigint) as rul, min(unit_number + 1000 * subset) as first_unit
from train_rul where {_TRAIN_BANDS}
union all
select 'test', count(*), cast(sum("RUL") as bigint), min(unit_number + 1000 * subset) from test_rul
union all
select 'test_last_rows', count(*), cast(sum("RUL") as bigint), min(unit_number + 1000 * subset) from (
  select * from test_rul qualify row_number() over (partition by subset, unit_number order by time_cycles desc) = 1) t""",
                              "prepared"))
def _ready(spark, sf):
    tables = ready_tables(spark, sf)
    out = None
    for name in ("train", "test", "test_last_rows"):
        row = getattr(tables, name).agg(F.count(F.lit(1)).alias("n"), F.sum("RUL").alias("rul"),
                                        F.min("unit_number").alias("first_unit")).select(F.lit(name).alias("name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


# -- feedback -----------------------------------------------------------------------------------

def _iso(c: str):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _records(spark, sf):
    """Feedback records as clients send them: text times, the engine as text, mixed metadata."""
    return fx.feedback(spark, sf).select(
        "prediction_id", "predicted_rul", "actual_rul", F.col("engine_id").cast("string").alias("engine_id"),
        _iso("feedback_timestamp").alias("prediction_timestamp"), _iso("feedback_timestamp").alias("feedback_timestamp"),
        F.create_map(F.lit("model_version"), F.col("model_version")).alias("metadata"))


_TYPED = "prediction_id, predicted_rul, actual_rul, engine_id, feedback_timestamp, model_version"


@query("append_feedback", oracle(f"""
select {_TYPED} from feedback where engine_id < 3000
union all select {_TYPED} from feedback where engine_id >= 3000""", "feedback"))
def _append(spark, sf):
    path = fresh_path(spark, "feedback")
    records = _records(spark, sf)
    fb.append_feedback(records.filter(F.col("engine_id").cast("int") < 3000), path)
    fb.append_feedback(records.filter(F.col("engine_id").cast("int") >= 3000), path)
    return plain_times(fb.read_feedback_lenient(spark, path).select(
        "prediction_id", "predicted_rul", "actual_rul", "engine_id", "feedback_timestamp",
        F.col("metadata")["model_version"].alias("model_version")))


def _damaged_lines(spark, sf):
    """JSON lines of which some are blank, cut off, without a time or with a bad one."""
    records = _records(spark, sf).withColumn("_k", F.substring("prediction_id", 6, 20).cast("bigint") % 10)
    timed = records.withColumn("feedback_timestamp", F.when(F.col("_k") == 2, None).when(F.col("_k") == 3, "yesterday")
                               .otherwise(F.col("feedback_timestamp")))
    text = F.to_json(F.struct(*[c for c in timed.columns if c != "_k"]))
    path = fresh_path(spark, "damaged")
    timed.select(F.when(F.col("_k") == 0, "").when(F.col("_k") == 1, F.substring(text, 1, 30)).otherwise(text)
                 .alias("value")).write.text(path)
    return path


@query("read_feedback_lenient", oracle("""
select prediction_id, predicted_rul, actual_rul, engine_id, feedback_timestamp from feedback
where cast(substr(prediction_id, 6) as bigint) % 10 > 3""", "feedback"))
def _lenient(spark, sf):
    return plain_times(fb.read_feedback_lenient(spark, _damaged_lines(spark, sf)).select(
        "prediction_id", "predicted_rul", "actual_rul", "engine_id", "feedback_timestamp"))


@query("feedback_rejects", """
select case event_id % 10 when 1 then 'bad_json' when 2 then 'no_timestamp' else 'bad_timestamp' end as reason, count(*) as n
from events where event_id % 10 between 1 and 3 group by 1""")
def _rejects(spark, sf):
    return fb.feedback_rejects(spark, _damaged_lines(spark, sf)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("read_feedback_strict", oracle("select prediction_id, predicted_rul, actual_rul, engine_id from feedback", "feedback"))
def _strict(spark, sf):
    path = fresh_path(spark, "strict")
    fb.append_feedback(_records(spark, sf), path)
    return fb.read_feedback_strict(spark, path).select("prediction_id", "predicted_rul", "actual_rul", "engine_id")


@query("parse_feedback_schema", oracle("""
select prediction_id, case when k = 1 then -1 else engine_id end as engine_id,
       case when k = 2 then null else actual_rul end as actual_rul, k > 2 or k = 0 as valid
from (select *, cast(substr(prediction_id, 6) as bigint) % 5 as k from feedback) t""", "feedback"))
def _parse(spark, sf):
    records = _records(spark, sf).withColumn("_k", F.substring("prediction_id", 6, 20).cast("bigint") % 5)
    damaged = records.withColumns({
        "engine_id": F.when(F.col("_k") == 1, "seven").otherwise(F.col("engine_id")),
        "actual_rul": F.when(F.col("_k") != 2, F.col("actual_rul"))})
    lines = damaged.select(F.to_json(F.struct(*[c for c in damaged.columns if c != "_k"])).alias("value"))
    return fb.parse_feedback_schema(lines).select(
        "prediction_id", F.coalesce("engine_id", F.lit(-1)).alias("engine_id"), "actual_rul", "valid")


# -- requests -----------------------------------------------------------------------------------

def _payloads(spark, sf):
    """One prediction request per event, a tenth of each kind of fault."""
    k = F.col("event_id") % 10
    row = F.struct(F.col("user_id").alias("unit"), F.col("value").alias("s_2"),
                   F.when(k != 3, F.col("value") * 2).alias("s_3"))
    good = F.to_json(F.struct(F.array(row, row).alias("rows")))
    value = (F.when(k == 0, None).when(k == 1, '{"rows": 7}').when(k == 2, '{"rows": []}')
             .when(k == 4, F.concat(F.lit('{"rows": [{"s_2": 1.5, "s_3": "high'), k.cast("string"), F.lit('"}]}')))
             .otherwise(good))
    return fx.table(spark, sf, "events").select("event_id", value.alias("value"))


@query("rows_payload_to_df", """
select event_id, user_id as unit, value as s_2, case when event_id % 10 <> 3 then value * 2 end as s_3
from events cross join (select unnest([1, 2]) as copy) c where event_id % 10 = 3 or event_id % 10 > 4
union all
select event_id, null, 1.5::double, null from events where event_id % 10 = 4""")
def _rows_payload(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("unit", T.LongType()), T.StructField("s_2", T.DoubleType()),
                           T.StructField("s_3", T.DoubleType())])
    return rq.rows_payload_to_df(_payloads(spark, sf), schema, keep=("event_id",))


@query("missing_features", """
select event_id, case event_id % 10 when 0 then null when 1 then null when 2 then 's_2,s_3,s_9' when 3 then 's_3,s_9' else 's_9' end as missing,
       case event_id % 10 when 0 then null when 1 then null when 2 then '' when 3 then 's_2,unit' when 4 then 's_2,s_3' else 's_2,s_3,unit' end as received
from events""")
def _missing(spark, sf):
    names = rq.missing_features(_payloads(spark, sf), ["s_2", "s_3", "s_9"])
    return names.select("event_id", *[F.when(F.col(f"{c}_features").isNotNull(), F.concat_ws(",", f"{c}_features")).alias(c)
                                      for c in ("missing", "received")])


@query("classify_requests", """
select event_id, event_id % 10 <> 2 as counted,
       case event_id % 10 when 0 then 'bad_input' when 1 then 'validation_error' when 2 then 'validation_error'
            when 3 then 'missing_features' when 4 then 'validation_error' when 5 then 'internal_error' else 'success' end as outcome
from events""")
def _classify(spark, sf):
    return rq.classify_requests(_payloads(spark, sf), ["s_2", "s_3"], failed=F.col("event_id") % 10 == 5).select(
        "event_id", "counted", "outcome")
