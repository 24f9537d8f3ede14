from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.models import URI_SETTINGS
from flowvigil.operators.features import netflow_features
from flowvigil.operators.netflow import netflow_records
from flowvigil.plans import jobs
from flowvigil.plans.netflow_model import NetflowModelSettings
from flowvigil.session import work_folder
from flowvigil.sources.sinks import Target
from flowvigil.sources.tables import Source

SF_DIR = "/root/testdata/sf0.001"


def parquet(spark, df, purpose):
    folder = work_folder(spark, purpose)
    df.write.parquet(folder)
    return Source("parquet", folder)


def test_netflow_jobs(spark):
    records = netflow_records(fx.netflow_lines(fx.events(spark, SF_DIR)))
    stored = parquet(spark, records, "records")
    normal, attacks, training, alerts = (
        Target("parquet", work_folder(spark, name)) for name in ("normal", "attack", "train", "alert")
    )
    jobs.build_netflow_features(spark, stored, normal)
    groups = spark.read.parquet(normal.location)
    assert groups.count() == netflow_features(records).count()
    few = Target("parquet", work_folder(spark, "few"))
    jobs.build_netflow_features(spark, stored, few, max_input_rows=10)
    assert spark.read.parquet(few.location).agg(F.sum("flownum")).first()[0] == 10

    captures = work_folder(spark, "captures")
    fx.attack_columns(fx.table(spark, SF_DIR, "lineitem")).write.option("header", True).csv(captures)
    jobs.build_attack_features(spark, [(captures, "DOS")], attacks)
    inputs = Source("parquet", attacks.location), Source("parquet", normal.location)
    jobs.build_attack_training_set(spark, *inputs, training)
    assert {r["label"] for r in spark.read.parquet(training.location).collect()} == {"DOS", "normal"}

    model = work_folder(spark, "model")
    settings = NetflowModelSettings(trees=5, training_partitions=2)
    jobs.train_conversation_model(spark, inputs[:1], inputs[1], model, 50, settings)
    # Records that look like the captures are alerts; ``now`` lies far before them.
    jobs.score_recent_conversations(spark, stored, model, alerts, now=0)
    columns = spark.read.parquet(alerts.location).columns
    assert columns[:4] == ["recordid", "srcip", "dstip", "attacktype"] and len(columns) == 14


def test_uri_jobs(spark):
    labelled = fx.http_columns(fx.events(spark, SF_DIR))
    training = parquet(
        spark, labelled.select("label", F.regexp_extract("uri", r"\?.*", 0).alias("uri")), "labelled"
    )
    flows = parquet(
        spark, labelled.select("uri", F.col("epoch_s").alias("date"), "srcip", "dstip"), "flows"
    )
    model = work_folder(spark, "model")
    jobs.train_uri_model(spark, training, model, URI_SETTINGS)
    alerts = Target("parquet", work_folder(spark, "alerts"))
    jobs.score_recent_uris(spark, flows, model, alerts, now=fx.NOW, days=30)
    expected = labelled.where((F.col("label") == "sql") & (F.col("epoch_s") < fx.NOW))
    assert spark.read.parquet(alerts.location).count() == expected.count()
