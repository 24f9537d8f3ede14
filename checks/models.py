"""Classifiers and the alerts they lead to.

The URI model of the query ``uri_model`` is of production size, the library's default
settings. The other models of the checks are small; all train on every row. Labels follow from the rows in a way a forest
can learn, so SQL knows the predictions too.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql_parts as sp
from checks.registry import query
from checks.tables import records
from flowvigil.functions import ORIGIN, clean_uri
from flowvigil.operators.alerts import (
    alerts_by_ports,
    alerts_by_record,
    attack_groups,
    injection_alerts,
)
from flowvigil.operators.evaluation import mean_ranks, rank_evaluation
from flowvigil.operators.features import netflow_features
from flowvigil.operators.http import http_flows
from flowvigil.operators.netflow import netflow_records
from flowvigil.operators.route import is_http
from flowvigil.operators.uri_flows import (
    COPIES,
    counted_rows,
    query_text,
    recent_queries,
    training_rows,
)
from flowvigil.plans.models import confusion, load_model, save_model
from flowvigil.plans.netflow_model import NetflowModelSettings, train_netflow_model
from flowvigil.plans.uri_model import (
    TextModelSettings,
    embedded_texts,
    train_counted_model,
    train_text_model,
)
from flowvigil.session import work_folder

NETFLOW_SETTINGS = NetflowModelSettings(trees=20, training_partitions=None)
URI_SETTINGS = TextModelSettings(
    vector_size=8,
    embedding_iterations=1,
    embedding_partitions=8,
    trees=20,
    regression_iterations=20,
)
TEXT_SETTINGS = TextModelSettings(
    text_column="text",
    vector_size=8,
    embedding_iterations=1,
    embedding_partitions=8,
    min_count=5,
    trees=10,
    regression_iterations=20,
)
# A rule the features reveal: protocol to label.
SQL_LABEL = "case proto when 'tcp' then 'DOS' when 'UDP' then 'FLOOD' else 'normal' end"


def labelled_features(spark: SparkSession, sf_dir: str, port_lists: bool = False) -> DataFrame:
    features = netflow_features(records(spark, sf_dir), port_lists=port_lists)
    return features.withColumn("label", F.expr(SQL_LABEL))


@cache
def _netflow_model_path(spark: SparkSession, sf_dir: str) -> str:
    path = work_folder(spark, "netflow-model")
    save_model(train_netflow_model(labelled_features(spark, sf_dir), NETFLOW_SETTINGS), path)
    return path


def netflow_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return load_model(_netflow_model_path(spark, sf_dir))


def _uri_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URI, by the queries that batch and stream scoring cut out of it."""
    labelled = fx.http_columns(fx.events(spark, sf_dir))
    cuts = F.explode(F.array(*[query_text(F.col("uri"), which) for which in ("first", "last")]))
    return training_rows(labelled.select("label", cuts.alias("uri")))


@cache
def _uri_texts_path(spark: SparkSession, sf_dir: str) -> str:
    path = work_folder(spark, "uri-texts")
    counted_rows(_uri_training(spark, sf_dir)).write.parquet(path)
    return path


def _uri_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training rows, counted: they are derived once for all models."""
    return spark.read.parquet(_uri_texts_path(spark, sf_dir))


@cache
def uri_model_path(spark: SparkSession, sf_dir: str) -> str:
    """A model of production size: all dimensions, trees and iterations, on as many tasks as there are cores."""
    path = work_folder(spark, "uri-model")
    tasks = max(URI_SETTINGS.embedding_partitions, spark.sparkContext.defaultParallelism)
    settings = TextModelSettings(embedding_partitions=tasks)
    save_model(train_text_model(_uri_texts(spark, sf_dir), settings), path)
    return path


@cache
def scoring_model_path(spark: SparkSession, sf_dir: str) -> str:
    """The small model of the queries that score flows."""
    path = work_folder(spark, "scoring-model")
    save_model(train_text_model(_uri_texts(spark, sf_dir), URI_SETTINGS), path)
    return path


def uri_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return load_model(uri_model_path(spark, sf_dir))


def scoring_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return load_model(scoring_model_path(spark, sf_dir))


@cache
def union_model_path(spark: SparkSession, sf_dir: str) -> str:
    """A model that takes selections by UNION for injections and nothing else.

    Its texts are those of the scoring model, and so is its embedding.
    """
    path = work_folder(spark, "union-model")
    label = F.when(F.col("uri").contains("union"), "sql").otherwise("normal")
    training = _uri_texts(spark, sf_dir).withColumn("label", label)
    save_model(train_text_model(training, URI_SETTINGS, like=scoring_model(spark, sf_dir)), path)
    return path


_GROUPS = sp.features("fx_netflow", SQL_LABEL)
_SHAPED = """
  cast(packernum as int) as packernum, cast(bytesize as int) as bytesize,
  cast(flownum as int) as flownuma, cast(src_flow_port_num as int) as flownums,
  cast(dst_flow_port_num as int) as flownumd"""


@query(
    "netflow_model",
    f"select srcip, proto, dstip, recordtime, label as predictedlabel from ({_GROUPS})",
)
def _netflow_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = netflow_model(spark, sf_dir).transform(labelled_features(spark, sf_dir))
    return scored.select(
        "srcip", "proto", "dstip", "recordtime", F.col("predictedLabel").alias("predictedlabel")
    )


@query(
    "netflow_score",
    f"""
select srcip, dstip, label as predictedlabel, recordtime, spandtime, srcports, dstports, proto,
  packernum, bytesize, flownum, src_flow_port_num, dst_flow_port_num
from ({_GROUPS}) where label <> 'normal'
""",
)
def _netflow_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    unlabelled = netflow_features(records(spark, sf_dir)).drop("label")
    alerts = attack_groups(netflow_model(spark, sf_dir).transform(unlabelled))
    return alerts.withColumnRenamed("predictedLabel", "predictedlabel")


@query(
    "model_confusion",
    f"select label, label as predicted, count(*) as n from ({_GROUPS}) group by label",
)
def _model_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = netflow_model(spark, sf_dir).transform(labelled_features(spark, sf_dir))
    counted = confusion(scored, "label", "predictedLabel")
    return counted.select("label", F.col("predictedLabel").alias("predicted"), F.col("count").alias("n"))


@query(
    "uri_model",
    "select label, label as predicted, 2 * count(*) as n from fx_http group by label",
)
def _uri_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = uri_model(spark, sf_dir).transform(_uri_training(spark, sf_dir))
    counted = confusion(scored, "label", "predictedLabelRF")
    return counted.select(
        "label", F.col("predictedLabelRF").alias("predicted"), F.col("count").alias("n")
    )


@query(
    "uri_counted_model",
    "select label, label as predicted, count(*) as n from fx_http group by label",
)
def _uri_counted_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifiers on vectors from counts, without a vocabulary on the driver."""
    rows = fx.http_columns(fx.events(spark, sf_dir)).select("event_id", "label", "uri")
    cut = rows.withColumn("uri", clean_uri(query_text(F.col("uri"))))
    settings = replace(URI_SETTINGS, min_count=2)
    vectors, model = train_counted_model(cut, settings, "event_id")
    scored = model.transform(embedded_texts(cut, vectors, settings, "event_id"))
    counted = confusion(scored, "label", "predictedLabelRF")
    return counted.select(
        "label", F.col("predictedLabelRF").alias("predicted"), F.col("count").alias("n")
    )


DAYS = 7
ALERT_ID = f"concat('ignore', md5({sp.HTTP_LINE}))"


@query(
    "uri_alerts",
    f"""
select {ALERT_ID} as id, make_timestamp(epoch_s * 1000000) as date, srcip, dstip, uri,
  1.0e0 as predictionnb, uri as url
from fx_http
where marker <> 'other' and label = 'sql' and epoch_s > {fx.NOW} - {DAYS} * 86400
  and epoch_s < {fx.NOW}
""",
)
def _uri_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.http_lines(fx.events(spark, sf_dir)).where(is_http(F.col("value")))
    recent = recent_queries(http_flows(lines), fx.NOW, DAYS)
    alerts = injection_alerts(scoring_model(spark, sf_dir).transform(recent))
    return alerts.select(
        "id",
        F.col("date").cast("timestamp_ntz").alias("date"),
        "srcip",
        "dstip",
        "uri",
        "predictionnb",
        "url",
    )


@query(
    "uri_regression",
    """
select label, 2 * count(*) as n, true as mostly_found, true as sure from fx_http group by label
""",
)
def _uri_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression with a penalty that leaves it weights, and both probabilities."""
    training = _uri_texts(spark, sf_dir)
    settings = replace(URI_SETTINGS, regularization=1e-4, elastic_net=0.0, regression_iterations=60)
    scored = train_text_model(training, settings).transform(training)
    sure = F.lit(True)
    for name in ("LR", "RF"):
        chosen = F.get(vector_to_array(F.col(f"probability{name}")), F.col(f"prediction{name}").cast("int"))
        sure &= chosen.between(0.5, 1.0)
    right = F.sum(F.when(F.col("label") == F.col("predictedLabelLR"), F.col(COPIES)).otherwise(0))
    return scored.groupBy("label").agg(
        F.sum(COPIES).alias("n"), (right / F.sum(COPIES) > 0.8).alias("mostly_found"), F.bool_and(sure).alias("sure")
    )


@query(
    "text_quality_model",
    """
with labelled as (
  select case when contains(coalesce(text, ''), ' the ') then 'good' else 'bad' end as label from documents)
select label, count(*) as n, true as mostly_found from labelled group by label
""",
)
def _text_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fx.labelled_texts(spark, sf_dir)
    scored = train_text_model(texts, TEXT_SETTINGS).transform(texts)
    found = F.avg((F.col("label") == F.col("predictedLabelRF")).cast("double")) > 0.8
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), found.alias("mostly_found"))


_JUDGED = """
judged as (
  select (l_quantity * 7 + l_partkey % 90)::double as score, l_returnflag = 'R' as positive from lineitem
  where l_partkey % 90 <> 3),
steps as (
  select score, count(*) filter (positive) as n_pos, count(*) filter (not positive) as n_neg from judged group by score)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with many ties, some of them null or no number."""
    rest = F.col("l_partkey") % 90
    score = (F.col("l_quantity") * 7 + rest).cast("double")
    broken = F.when(F.col("l_orderkey") % 2 == 0, F.lit(float("nan")))
    return fx.table(spark, sf_dir, "lineitem").select(
        F.when(rest == 3, broken).otherwise(score).alias("score"), (F.col("l_returnflag") == "R").alias("positive")
    )


@query(
    "model_ranks",
    f"""
with {_JUDGED},
ranked as (select score, positive, rank() over (order by score) as r, count(*) over (partition by score) as n from judged)
select score, count(*) filter (positive) as n_pos, count(*) filter (not positive) as n_neg,
  any_value(r + (n - 1) / 2.0::double)::double as rank
from ranked group by score
""",
)
def _model_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_ranks(_judged(spark, sf_dir), "score", "positive")


@query(
    "model_rank_evaluation",
    f"""
with {_JUDGED},
totals as (select sum(n_pos) as p, sum(n_neg) as n from steps),
ranked as (select positive, rank() over (order by score) as r, count(*) over (partition by score) as same from judged),
area as (
  select (sum(r + (same - 1) / 2.0::double) filter (positive) - any_value(p) * (any_value(p) + 1) / 2.0::double)
    / (any_value(p)::double * any_value(totals.n)) as area from ranked, totals),
curve as (
  select score, sum(n_pos) over (order by score desc)::bigint as tp, sum(n_neg) over (order by score desc)::bigint as fp from steps),
best as (
  select score, tp, fp, 2.0::double * tp / (tp + fp + p) as f1 from curve, totals order by f1 desc, score desc limit 1)
select p::bigint as n_pos, n::bigint as n_neg, area, score as threshold, f1, tp as true_pos, fp as false_pos
from totals, area, best
""",
)
def _model_rank_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_evaluation(_judged(spark, sf_dir), "score", "positive")


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = labelled_features(spark, sf_dir, port_lists=True)
    return features.withColumnRenamed("label", "predictedLabel")


@query(
    "netflow_alerts_by_ports",
    f"""
select 'ignore' as recordid, srcip, dstip, label as attacktype,
  make_timestamp(recordtime * 1000000) as recordtime, spandtime as costtime,
  cast(srcport as int) as srcport, cast(dstport as int) as dstport, proto, {_SHAPED}
from (select *, unnest(string_split(dstports, ',')) as dstport
  from (select *, unnest(string_split(srcports, ',')) as srcport
    from ({_GROUPS}) where label <> 'normal'))
""",
)
def _netflow_alerts_by_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_utc(alerts_by_ports(_ruled(spark, sf_dir)))


@query(
    "netflow_alerts_by_record",
    f"""
with attack as (select * exclude (srcports, dstports) from ({_GROUPS}) where label <> 'normal')
select concat('ignore', md5(concat({sp.NETFLOW_LINE}, '|0'))) as recordid, attack.srcip,
  attack.dstip, label as attacktype, make_timestamp(attack.recordtime * 1000000) as recordtime,
  spandtime * 1000 as costtime, cast(srcport as int) as srcport, cast(dstport as int) as dstport,
  attack.proto, {_SHAPED}
from (select *, {sp.NETFLOW_LINE} as line from fx_netflow) as fx_netflow
  join attack using (srcip, proto, dstip, recordtime)
""".replace(f"md5(concat({sp.NETFLOW_LINE}, '|0'))", "md5(concat(line, '|0'))"),
)
def _netflow_alerts_by_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = labelled_features(spark, sf_dir).withColumnRenamed("label", "predictedLabel")
    return _as_utc(alerts_by_record(scored, records(spark, sf_dir)))


@query(
    "netflow_alerts_duplicates",
    f"""
with twice as (select fx_netflow.* from fx_netflow, range(2)),
attack as (select * exclude (srcports, dstports) from ({sp.features("twice", SQL_LABEL)}) where label <> 'normal')
select attack.srcip, attack.dstip, attack.proto, attack.recordtime as second, count(*) as alerts,
  count(*) as ids, any_value(cast(flownum as int)) as flownuma
from twice join attack using (srcip, proto, dstip, recordtime)
group by attack.srcip, attack.dstip, attack.proto, attack.recordtime
""",
)
def _netflow_alerts_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line twice, told apart by its place."""
    lines = fx.netflow_lines(fx.events(spark, sf_dir))
    twice = lines.withColumn(ORIGIN, F.explode(F.array(F.lit("topic/0/1"), F.lit("topic/0/2"))))
    found = netflow_records(twice)
    scored = netflow_features(found, port_lists=False).withColumn("predictedLabel", F.expr(SQL_LABEL))
    return (
        alerts_by_record(scored, found)
        .groupBy("srcip", "dstip", "proto", F.unix_seconds("recordtime").alias("second"))
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.count_distinct("recordid").alias("ids"),
            F.max("flownuma").alias("flownuma"),
        )
    )


def _as_utc(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("recordtime", F.col("recordtime").cast("timestamp_ntz"))
