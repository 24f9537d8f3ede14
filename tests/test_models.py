import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowvigil.operators.alerts import attack_groups, injection_alerts
from flowvigil.operators.features import FEATURE_COLUMNS
from flowvigil.operators.http import http_flows
from flowvigil.operators.uri_flows import counted_rows, flow_messages, parse_flow_messages
from flowvigil.plans.models import confusion, evaluate, load_model, save_model
from flowvigil.plans.netflow_model import NetflowModelSettings, train_netflow_model
from flowvigil.plans.uri_model import (
    COPY_BLOCKS,
    TextModelSettings,
    _every_copy,
    _in_blocks,
    train_text_model,
    word_tokenizer,
)
from flowvigil.session import work_folder


def conversations(spark):
    tcp = (F.col("id") % 2).cast("double")
    values = {name: (F.col("id") % 7).cast("double") for name in FEATURE_COLUMNS} | {"tcp": tcp}
    label = F.when(tcp == 1, "DOS").otherwise("normal")
    df = spark.range(200).select(*[c.alias(n) for n, c in values.items()], label.alias("label"))
    return df.withColumn("packernum", F.when(F.col("spandtime") != 3, F.col("packernum")))


def test_defaults_are_the_production_settings():
    netflow, text = NetflowModelSettings(), TextModelSettings()
    assert (netflow.trees, netflow.tree_depth, netflow.max_categories) == (500, 4, 3)
    assert (text.trees, text.subsampling, text.max_categories) == (300, 0.8, 4)
    assert (text.vector_size, text.embedding_iterations, text.min_count) == (300, 300, 1)
    assert (text.regression_iterations, text.regularization, text.elastic_net) == (200, 0.3, 0.8)


def test_netflow_model(spark):
    rows = conversations(spark)
    model = train_netflow_model(rows, NetflowModelSettings(trees=5, training_partitions=2))
    path = work_folder(spark, "model")
    save_model(model, path)
    with pytest.raises(Exception, match="already exists"):
        save_model(model, path)
    save_model(model, path, overwrite=True)
    scored = load_model(path).transform(rows)
    counts = {tuple(row) for row in confusion(scored, "label", "predictedLabel").collect()}
    assert counts == {("DOS", "DOS", 100), ("normal", "normal", 100)}
    assert evaluate(scored) == evaluate(scored, metric="accuracy") == 1.0
    unlabelled = load_model(path).transform(rows.drop("label"))
    assert unlabelled.where("predictedLabel = 'DOS'").count() == 100
    keyed = scored.select(
        "*", *[F.lit("x").alias(name) for name in ("srcip", "dstip", "proto")], F.lit(1).alias("recordtime")
    )
    assert attack_groups(keyed).count() == 100


def test_missing_feature_fails_without_imputation(spark):
    settings = NetflowModelSettings(trees=2, training_partitions=None, impute=False)
    with pytest.raises(Exception, match="null|FAILED_EXECUTE_UDF"):
        train_netflow_model(conversations(spark), settings)


def test_text_model_and_alerts(spark):
    texts = {"sql": "union|select|pwd", "normal": "item|name|id"}
    rows = spark.range(60).select(
        F.when(F.col("id") % 3 == 0, "sql").otherwise("normal").alias("label"),
        F.when(F.col("id") % 3 == 0, texts["sql"]).otherwise(texts["normal"]).alias("uri"),
        F.lit("/u?v").alias("uri_ori"),
        F.col("id").alias("date"),
        F.lit("s").alias("srcip"),
        F.lit("d").alias("dstip"),
    )
    settings = TextModelSettings(
        vector_size=4, embedding_iterations=1, embedding_partitions=2, trees=5, regression_iterations=5
    )
    scored = train_text_model(rows, settings).transform(rows.drop("label"))
    alerts = injection_alerts(scored).collect()
    assert len(alerts) == 20
    assert {row["predictionnb"] for row in alerts} == {1.0}
    assert all(0.5 < row["probabilitynb"] <= 1 and row["id"].startswith("ignore") for row in alerts)
    assert len({row["id"] for row in alerts}) == 20
    named = injection_alerts(scored.withColumn("id", F.lit("n"))).first()
    assert named["id"] == "ignoren" and named["url"] == "/u?v"
    by_regression = scored.withColumn("predictedLabelRF", F.lit("normal")).withColumn(
        "predictedLabelLR", F.lit("sql")
    )
    assert injection_alerts(by_regression).count() == 60


def test_a_feed_of_models(spark):
    from flowvigil.plans.models import ModelFeed

    model = train_netflow_model(conversations(spark), NetflowModelSettings(trees=2, training_partitions=1))
    paths = [work_folder(spark, "model") for _ in range(2)]
    for path in paths:
        save_model(model, path)
    table = [(1, paths[0]), (None, "none"), (7, None)]
    feed = ModelFeed(lambda: spark.createDataFrame(table, "version int, location string"))
    first = feed()
    assert first[0] == 1 and feed()[1] is first[1]
    table.append((2, paths[1]))
    second = feed()
    assert second[0] == 2 and second[1] is not first[1]
    table.clear()
    with pytest.raises(ValueError, match="empty"):
        feed()


def test_the_regression_is_the_optimum(spark):
    """Beside Newton's method on the same vectors: label by label and in probability."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    texts = [("sql" if k % 3 == 0 else "normal", f"w{k % 5} {'select' if k % 7 < 3 + k % 3 else 'page'} w{k % 4}") for k in range(240)]
    rows = spark.createDataFrame(texts, "label string, uri string")
    settings = TextModelSettings(
        vector_size=4, embedding_iterations=1, embedding_partitions=1, trees=2, max_categories=2,
        regression_iterations=500, regularization=0.01, elastic_net=0.0,
    )
    scored = train_text_model(rows, settings).transform(rows).select(
        "indexedLabel", "predictionLR", vector_to_array("indexedFeatures").alias("x"), vector_to_array("probabilityLR").alias("p")
    ).collect()
    x, y = np.array([r.x for r in scored]), np.array([r.indexedLabel for r in scored])
    # The penalty is on weights of columns with unit deviation; the intercept has none.
    z = np.column_stack([x / x.std(axis=0, ddof=1), np.ones(len(x))])
    penalty = np.diag([settings.regularization] * x.shape[1] + [0.0])
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ w))
        slope = z.T @ (p - y) / len(y) + penalty @ w
        curve = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty
        w -= np.linalg.solve(curve, slope)
    p = 1 / (1 + np.exp(-z @ w))
    ours = np.array([r.p[1] for r in scored])
    assert np.abs(ours - p).max() < 1e-3
    clear = np.abs(p - 0.5) > 2e-3
    assert ((p > 0.5) == np.array([r.predictionLR for r in scored]))[clear].all()
    assert clear.mean() > 0.5


def test_texts_are_embedded_once(spark, monkeypatch):
    """The classifiers' many passes read stored vectors; the model still takes raw texts."""
    from flowvigil.plans import uri_model as plans

    given = []
    real = plans._classifiers

    def watched(rows, settings):
        given.append((rows.columns, rows.storageLevel.useMemory))
        return real(rows, settings)

    monkeypatch.setattr(plans, "_classifiers", watched)
    rows = spark.createDataFrame([("a", "x y z"), ("b", "p q r")] * 20, "label string, uri string")
    settings = TextModelSettings(vector_size=3, embedding_iterations=1, embedding_partitions=2, trees=3)
    model = train_text_model(rows, settings)
    assert given == [(["label", "words2vec"], True)]
    names = [type(stage).__name__ for stage in model.stages]
    assert names[:2] == ["RegexTokenizer", "Word2VecModel"] and names[-2:] == ["IndexToString"] * 2
    assert model.transform(rows.select("uri")).where("predictedLabelRF is not null").count() == 40


def test_counted_rows_train_as_many_copies(spark):
    """The embedding sees every copy, labels are ordered by copies, and a like model shares its embedding."""
    given = [("normal", "?|id|=|luannumber", 2500), ("sql", "?|u|=|union|select|pwd", 40), ("sql", "?|b|union|all", 1)]
    plain = [(label, uri) for label, uri, copies in given for _ in range(copies)]
    rows = counted_rows(spark.createDataFrame(plain, "label string, uri string").repartition(3))
    assert sorted(map(tuple, rows.collect())) == sorted(given)
    settings = TextModelSettings(vector_size=4, embedding_iterations=1, embedding_partitions=2, trees=5, regression_iterations=5)
    blocks = _in_blocks(rows, settings)
    assert blocks.count() == COPY_BLOCKS + 40 + 1
    texts = _every_copy(word_tokenizer("uri").transform(blocks)).groupBy("words").count().collect()
    assert sorted(row["count"] for row in texts) == [1, 40, 2500]
    # Twice as many rows say "sql", but most copies are normal.
    model = train_text_model(rows, settings)
    assert model.stages[2].labels == ["normal", "sql"]
    other = train_text_model(rows.withColumn("label", F.lit("none")), settings, like=model)
    vectors = [sorted(map(str, m.stages[1].getVectors().collect())) for m in (model, other)]
    assert vectors[0] == vectors[1]
    found = model.transform(rows).select("label", "predictedLabelRF").collect()
    assert all(row["label"] == row["predictedLabelRF"] for row in found)


def test_models_and_messages_run_once_for_the_alerts(spark):
    lines = spark.createDataFrame([('<13> netlog_http {"Uri":"/q?u=1 union","Date":"1706000000"}',)], "value string")
    parsed = parse_flow_messages(flow_messages(http_flows(lines)))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1
    scored = parsed.withColumns(
        {f"predictedLabel{m}": F.udf(lambda text: "sql")("uri") for m in ("RF", "LR")}
        | {f"prediction{m}": F.lit(1.0) for m in ("RF", "LR")}
        | {f"probability{m}": array_to_vector(F.array(F.lit(0.0), F.lit(1.0))) for m in ("RF", "LR")}
    )
    alerts = injection_alerts(scored)
    filters = [line for line in alerts._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in line]
    assert any("_hit" in line for line in filters) and not any("sql" in line for line in filters)
    assert alerts.count() == 1


def test_the_uri_model_is_of_production_size(spark, monkeypatch):
    from dataclasses import replace

    from checks import models

    given = []
    monkeypatch.setattr(models, "_uri_texts", lambda *_: "texts")
    monkeypatch.setattr(models, "train_text_model", lambda rows, settings: given.append((rows, settings)))
    monkeypatch.setattr(models, "save_model", lambda *_: None)
    models.uri_model_path.__wrapped__(spark, "folder")
    (rows, settings), = given
    assert rows == "texts" and settings.embedding_partitions >= spark.sparkContext.defaultParallelism
    assert replace(settings, embedding_partitions=64) == TextModelSettings()


def test_the_words_of_all_texts_are_not_cached(spark, monkeypatch):
    """The embedding reads them from files, which are gone when the model is there."""
    from flowvigil.plans import uri_model as plans

    seen = []
    real, pipeline = plans._embedding, plans.text_classifier

    def classifier(*args, **kwargs):
        plans._embedding = real
        try:
            return pipeline(*args, **kwargs)
        finally:
            plans._embedding = Watched

    class Watched:
        def __init__(self, settings):
            self.real = real(settings)

        def fit(self, words):
            seen.append((words._jdf.queryExecution().executedPlan().toString(), words.inputFiles()))
            return self.real.fit(words)

    monkeypatch.setattr(plans, "_embedding", Watched)
    monkeypatch.setattr(plans, "text_classifier", classifier)
    given = spark.createDataFrame([("a", "x y z"), ("b", "p q r")] * 20, "label string, uri string")
    settings = TextModelSettings(vector_size=3, embedding_iterations=1, embedding_partitions=2, trees=3)
    train_text_model(given, settings)
    train_text_model(counted_rows(given), settings)
    assert len(seen) == 2
    for plan, files in seen:
        assert "FileScan parquet" in plan and "InMemoryTableScan" not in plan
        assert files and spark.sparkContext._jvm.java.io.File(files[0].removeprefix("file:")).exists() is False

