import json
from pathlib import Path

import pytest

from flowvigil.operators.features import netflow_features
from flowvigil.operators.netflow import netflow_records
from flowvigil.operators.syslog import syslog_rows
from flowvigil.session import RECOMMENDED, builder, cut_lineage, work_folder
from flowvigil.sources.patterns import VENDOR_PATTERNS
from flowvigil.sources.sinks import (
    Target,
    document_target,
    documents,
    jdbc_target,
    kafka_target,
    rule_hits,
)
from flowvigil.sources.streams import file_lines, offsets_per_trigger
from flowvigil.sources.tables import (
    Source,
    bounded,
    jdbc_source,
    read_attack_csv,
    rows,
    rules_table,
    spread,
)
from flowvigil.streaming.network import start_network_etl
from flowvigil.streaming.run import StreamOptions
from flowvigil.streaming.syslog import start_syslog_etl


def test_batch_target_replaces_its_own_batch(spark):
    target = Target("parquet", work_folder(spark, "t"))
    target.write_batch(spark.range(5), 0)
    target.write_batch(spark.range(3), 1)
    target.write_batch(spark.range(4), 1)
    assert spark.read.parquet(target.location).groupBy("batch_id").count().orderBy(
        "batch_id"
    ).collect() == [(0, 5), (1, 4)]


def test_targets_without_a_location_append(spark):
    calls = []

    class Recording(Target):
        def write(self, df):
            assert df.columns == ["id", "stream_id", "batch_id"]
            calls.append((self.format, self.mode, dict(self.options), df.count()))

    base = jdbc_target("jdbc:x", "alerts", {"user": "u"}, batch_size=7, connections=3)
    Recording(base.format, None, base.mode, base.options).write_batch(spark.range(2), 9)
    assert calls == [
        (
            "jdbc",
            "append",
            {"user": "u", "url": "jdbc:x", "dbtable": "alerts", "batchsize": 7, "numPartitions": 3},
            2,
        )
    ]
    assert kafka_target("h:1", "flow").options == {"kafka.bootstrap.servers": "h:1", "topic": "flow"}


def test_sources():
    plain = jdbc_source("jdbc:x", "t")
    assert plain.options == {"url": "jdbc:x", "dbtable": "t", "fetchsize": 10_000}
    split = jdbc_source("jdbc:x", "t", {"user": "u"}, "id", 0, 99, 4)
    assert split.options["numPartitions"] == 4 and split.options["upperBound"] == 99
    assert offsets_per_trigger(80, 6, 10) == 4800


def test_documents_go_where_their_tags_say(spark):
    df = rows(spark, [("a", "x", "1", 5), ("b", "y", "2", None)], "es_index string, es_type string, k string, v int")
    folder = work_folder(spark, "docs")
    document_target(folder).write(documents(df, "k"))
    stored = spark.read.parquet(folder).where("es_index = 'a'").collect()
    assert [(row["id"], json.loads(row["document"])["v"]) for row in stored] == [("1", 5)]


def test_tables(spark):
    folder = work_folder(spark, "csv")
    spark.range(3).write.option("header", True).csv(folder)
    assert dict(read_attack_csv(spark, folder).dtypes)["id"] == "int"
    assert dict(read_attack_csv(spark, folder, "id string").dtypes)["id"] == "string"
    assert Source("csv", folder, {"header": True}).read(spark).count() == 3
    assert bounded(spark.range(9), 4, ["id"]).count() == 4
    assert bounded(spark.range(9), None, ["id"]).count() == 9
    assert spread(spark.range(9).coalesce(1), 4).rdd.getNumPartitions() == 4
    assert spread(spark.range(0, 90, 1, 64), None).rdd.getNumPartitions() == 64
    rules = rows(
        spark,
        [("r1", "a", "b", "c"), ("r2", "a", "b", "c")],
        "ruleid string, sourceip string, destip string, rule_regular_expression string",
    )
    assert [r["ruleid"] for r in rules_table(rules).orderBy("rule_pos").collect()] == ["r1", "r2"]


def test_rule_hits(spark):
    hits = rows(spark, [("r", 10, 20)], "ruleid string, rule_time bigint, match_time bigint")
    row = rule_hits(hits).first()
    assert (row["rule_time"].timestamp(), row["match_time"].timestamp()) == (10, 20)


def test_session_settings(spark):
    assert builder("x")._options["spark.sql.session.timeZone"] == "UTC"
    assert RECOMMENDED["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert work_folder(spark, "a") != work_folder(spark, "a")
    assert cut_lineage(spark.range(3)).count() == 3


@pytest.fixture
def feed(spark):
    """A folder of line files, one micro-batch each."""

    def make(*batches):
        folder = work_folder(spark, "feed")
        for batch in batches:
            values = [(None, value) for value in batch]
            spark.createDataFrame(values, "key string, value string").coalesce(1).write.mode(
                "append"
            ).parquet(folder)
        return file_lines(spark, folder, max_files_per_trigger=1)

    return make


def options(spark, **changes):
    return StreamOptions(work_folder(spark, "checkpoint"), interval=None, **changes)


def test_network_stream_equals_batch(spark, feed):
    from flowvigil.plans.network import network_tables

    http = [f'netlog_http {{"Uri":"/a?n={n}"}}' for n in range(6)]
    netflow = [f'send a message: [[{{"SrcIp":"{n}"}}]]' for n in range(4)]
    bad = ["netlog_http {x}"]
    rules = rows(
        spark,
        [(0, "r", "any", "any", "n=3")],
        "rule_pos int, ruleid string, sourceip string, destip string, "
        "rule_regular_expression string",
    )
    outputs = ("documents", "flow_messages", "netflow_messages", "letters")
    targets = {name: Target("parquet", work_folder(spark, name)) for name in outputs}
    stream = feed(http[:3] + bad, http[3:] + netflow)
    query = start_network_etl(stream, rules, targets, options(spark, name="network"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    everything = spark.createDataFrame([(v,) for v in http + netflow + bad], "value string")
    tables = network_tables(everything, rules)
    batch = {
        "documents": tables.documents(),
        "flow_messages": tables.flow_messages(),
        "netflow_messages": tables.netflow_messages(),
        "letters": tables.letters.drop("time"),
    }
    for name in outputs:
        written = spark.read.parquet(targets[name].location).drop("stream_id", "batch_id", "time")
        assert sorted(map(str, written.collect())) == sorted(map(str, batch[name].collect()))


def test_syslog_stream_equals_batch(spark, feed):
    from test_syslog import WAF, wrap

    texts = [wrap(WAF), wrap("nothing"), "broken"]
    targets = {name: Target("parquet", work_folder(spark, name)) for name in ("rows", "letters")}
    stream = feed(texts[:1], texts[1:])
    start_syslog_etl(stream, VENDOR_PATTERNS, targets, options(spark), now=5).awaitTermination()
    written = spark.read.parquet(targets["rows"].location).drop("stream_id", "batch_id")
    everything = spark.createDataFrame([(text,) for text in texts], "value string")
    expected = syslog_rows(everything, VENDOR_PATTERNS, now=5)
    assert sorted(map(str, written.collect())) == sorted(map(str, expected.collect()))
    letters = spark.read.parquet(targets["letters"].location)
    assert [row["log"] for row in letters.collect()] == ["broken"]


def test_failed_batch_is_run_again(spark, feed):
    target = Target("parquet", work_folder(spark, "retried"))
    stream = feed(["a"], ["b"])
    kept = options(spark)
    failures = ["once"]

    def each_batch(batch, batch_id):
        target.write_batch(batch, batch_id)
        if batch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        kept.start(stream, each_batch).awaitTermination()
    kept.start(stream, each_batch).awaitTermination()
    assert sorted(row["value"] for row in spark.read.parquet(target.location).collect()) == ["a", "b"]


def test_a_new_checkpoint_erases_nothing(spark, feed):
    target = Target("parquet", work_folder(spark, "twice"))
    for texts in (["a", "b"], ["c"]):
        options(spark).start(feed(texts), target.write_batch).awaitTermination()
    rows = spark.read.parquet(target.location).collect()
    assert sorted(row["value"] for row in rows) == ["a", "b", "c"]
    assert len({row["stream_id"] for row in rows}) == 2


def test_groups_split_over_batches_are_not_merged(spark, feed):
    line = 'send a message: [[{"srcip":"s","dstip":"d","proto":"tcp","recordtime":1,"srcport":1}]]'
    target = Target("parquet", work_folder(spark, "features"))

    def each_batch(batch, batch_id):
        target.write_batch(netflow_features(netflow_records(batch)), batch_id)

    options(spark).start(feed([line, line], [line]), each_batch).awaitTermination()
    assert sorted(row["flownum"] for row in spark.read.parquet(target.location).collect()) == [1, 2]


def test_work_folder_of_a_cluster_must_be_named(spark, monkeypatch):
    import flowvigil.session as session

    monkeypatch.setattr(session, "_configured_checkpoint_dir", lambda _: None)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(RuntimeError):
        work_folder(Cluster, "x")


def test_a_ledger_keeps_append_targets_from_repeating(spark):
    written = []

    class Recording(Target):
        def write(self, df):
            if not written or written[-1] != "fail":
                written.append((df.columns, df.count()))
            else:
                written.pop()
                raise RuntimeError("lost")

    for fmt, extra in (("jdbc", ["stream_id", "batch_id"]), ("kafka", [])):
        written.clear()
        target = Recording(fmt, ledger=work_folder(spark, "ledger"))
        target.write_batch(spark.range(2), 0)
        target.write_batch(spark.range(2), 0)
        written.append("fail")
        with pytest.raises(RuntimeError):
            target.write_batch(spark.range(3), 1)
        target.write_batch(spark.range(3), 1)
        target.write_batch(spark.range(3), 1)
        assert written == [(["id", *extra], 2), (["id", *extra], 3)]


def test_batches_are_dealt(spark, feed):
    seen = []
    dealt = options(spark, partitions=5)
    dealt.start(feed([str(n) for n in range(50)]), lambda b, _: seen.append(b.rdd.getNumPartitions())).awaitTermination()
    assert seen == [5]


def test_rules_change_under_a_stream(spark, feed):
    from flowvigil.operators.rule_versions import RuleFeed

    schema = "rule_pos int, ruleid string, sourceip string, destip string, rule_regular_expression string"
    tables = iter([rows(spark, [(0, name, "any", "any", "n=")], schema) for name in ("old", "new")])
    target = Target("parquet", work_folder(spark, "documents"))
    lines = [[f'netlog_http {{"Uri":"/a?n={n}"}}'] for n in range(2)]
    start_network_etl(feed(*lines), RuleFeed(lambda: next(tables)), {"documents": target}, options(spark)).awaitTermination()
    stored = spark.read.parquet(target.location).collect()
    found = [json.loads(r.document) for r in stored]
    assert {(one["uri"], one["ruleid"]) for one in found if "ruleid" in one} == {("/a?n=0", "old"), ("/a?n=1", "new")}


RECORD = 'send a message: [[{{"srcip":"s","dstip":"d","proto":"tcp","starttime":{at},"lasttime":{at},"srcport":{port}}}]]'


def test_sessions_go_on_over_batches(spark, feed):
    from pyspark.sql import functions as F

    from flowvigil.streaming.windows import session_features

    at = [0, 60, 121, 100, 400, 460, 5000]
    batches = [[RECORD.format(at=t, port=t % 3)] for t in at]
    batches.insert(2, ['send a message: [[{"srcip":"s","dstip":"d","proto":"tcp"}]]'])
    records = netflow_records(feed(*batches)).withColumn("t", F.timestamp_seconds("starttime"))
    target = work_folder(spark, "sessions")
    session_features(records, "t", "60 seconds", "10 minutes").writeStream.format("parquet").option(
        "checkpointLocation", work_folder(spark, "checkpoint")
    ).trigger(availableNow=True).start(target).awaitTermination()
    found = spark.read.parquet(target).select(
        F.unix_seconds("window_start"), F.unix_seconds("window_end"), "flownum", "src_flow_port_num"
    )
    # 100 comes after 121 and bridges 60 and 121; a pause of the whole gap still joins.
    assert sorted(map(tuple, found.collect())) == [(0, 181, 4.0, 2.0), (400, 520, 2.0, 1.0)]


def test_messages_that_come_again(spark, feed):
    from pyspark.sql import functions as F

    from flowvigil.streaming.scoring import seen_once

    stream = feed(["1 a", "1 a", "2 b"], ["1 a", "3 c"], ["9000 d", "2 b"], ["1 a", "9000 e"])
    at = F.timestamp_seconds(F.split("value", " ")[0].cast("bigint"))
    found = seen_once(stream.withColumn("at", at), ["value"], "at", "1 hour")
    target = Target("parquet", work_folder(spark, "seen"))
    options(spark).start(found, target.write_batch).awaitTermination()
    texts = sorted(r.value for r in spark.read.parquet(target.location).collect())
    assert texts == ["1 a", "2 b", "3 c", "9000 d", "9000 e"]


def test_once_and_letters_exclude_each_other(spark, feed):
    from flowvigil.streaming.scoring import start_netflow_scoring

    with pytest.raises(ValueError, match="stream of their own"):
        start_netflow_scoring(feed(["{}"]), None, None, options(spark), letters=Target(), once_within="1 hour")


def test_records_are_looked_up_once_a_batch(spark, feed):
    from pyspark.sql import functions as F

    from flowvigil.operators.netflow_messages import parse_json_messages
    from flowvigil.streaming.scoring import start_netflow_scoring

    class Model:
        def transform(self, features):
            return features.withColumn("predictedLabel", F.lit("DOS"))

    text = '{{"srcip":"s","dstip":"d","proto":"tcp","recordtime":0,"recordid":"{0}","starttime":{0},"srcport":"1"}}'
    batches = [[text.format(n) for n in (1, 2, 2, 3)], [text.format(n) for n in (3, 4)]]
    target = Target("parquet", work_folder(spark, "alerts"))
    running = start_netflow_scoring(
        feed(*batches), Model(), target, options(spark), parse_json_messages, once_within="1 hour"
    )
    running.awaitTermination()
    found = spark.read.parquet(target.location)
    assert sorted((r.recordid, r.flownuma) for r in found.collect()) == [
        ("ignore1", 3), ("ignore2", 3), ("ignore3", 3), ("ignore4", 1)
    ]
    # Alerts join the records with their own conversations: both read what is stored.
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in running.recentProgress) == 4


def state_folders(checkpoint):
    return sum(one.name.isdigit() for one in Path(checkpoint.removeprefix("file:")).joinpath("state", "0").iterdir())


def test_partitions_of_the_state(spark, feed):
    from flowvigil.streaming.scoring import seen_once

    before = spark.conf.get("spark.sql.shuffle.partitions")
    kept, target = options(spark, state=3), Target("parquet", work_folder(spark, "seen"))
    timed = feed(["a", "b", "a"]).selectExpr("value", "timestamp_seconds(9000) as at")
    kept.start(seen_once(timed, ["value"], "at", "1 hour"), target.write_batch).awaitTermination()
    assert (state_folders(kept.checkpoint), spark.conf.get("spark.sql.shuffle.partitions")) == (3, before)
    assert spark.read.parquet(target.location).count() == 2


def test_sessions_keep_their_state_in_a_few_partitions_a_core(spark, tmp_path, monkeypatch):
    from checks import registry, streams

    folders = {}

    def named(session, purpose):
        return folders.setdefault(purpose, work_folder(session, purpose))

    monkeypatch.setattr(streams, "work_folder", named)
    spark.range(40).selectExpr(
        "id as event_id", "cast(timestamp_seconds(1704067200 + id * 7200) as timestamp_ntz) as ts", "id % 2 as user_id"
    ).write.parquet(str(tmp_path / "events.parquet"))
    registry.QUERIES["stream_netflow_sessions"](spark, str(tmp_path)).collect()
    assert state_folders(folders["stream-checkpoint"]) == 2 * spark.sparkContext.defaultParallelism


def test_variants(spark):
    from flowvigil.sources.variants import document_keys, document_schema, variant_columns, variant_documents, variant_path

    texts = ['{"a": 1, "b.c": "x", "n": null}', '{"a": "1", "b\'d": [2]}', "{", None, "[1]", '{"a": 2.5, "a b": true}']
    table = rows(spark, [("t", text) for text in texts], "kind string, document string")
    docs = variant_documents(table)
    columns = variant_columns({"a": "int", "b.c": "string", "b'd": "array<int>", "a b": "boolean"})
    found = docs.select(*columns).collect()
    assert [tuple(r) for r in found] == [
        (1, "x", None, None), (1, None, [2], None), (None,) * 4, (None,) * 4, (None,) * 4, (2, None, None, True)
    ]
    keys = {(r.key, r.type): r.n for r in document_keys(docs, "kind").collect()}
    assert keys == {
        ("a", "BIGINT"): 1, ("a", "STRING"): 1, ("a", "DECIMAL(2,1)"): 1, ("b.c", "STRING"): 1, ("n", "VOID"): 1,
        ("b'd", "ARRAY<BIGINT>"): 1, ("a b", "BOOLEAN"): 1,
    }
    objects = docs.where(document_is_object())
    assert "a: VARIANT" in document_schema(objects, "kind").first()["schema"]
    with pytest.raises(ValueError, match="both quotation marks"):
        variant_path("\"'")


def document_is_object():
    from pyspark.sql import functions as F

    return F.schema_of_variant("doc").startswith("OBJECT")


def test_a_stream_of_one_file_is_dealt_to_all_cores(spark, tmp_path):
    from checks import streams

    spark.range(10).selectExpr(
        "id as event_id", "timestamp_seconds(1704067200 + id) as ts", "id as user_id"
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    plan = streams.event_stream(spark, str(tmp_path))._jdf.queryExecution().logical().toString()
    assert f"Repartition {spark.sparkContext.defaultParallelism}, true" in plan


def test_tables_of_a_batch_are_written_until_it_ends(spark, feed, monkeypatch):
    """The outputs of a batch read files, no cache, and the files go with the batch."""
    import glob

    from flowvigil.session import written
    from flowvigil.streaming import network

    seen = []
    real = network.write_outputs

    def watched(outputs, targets, batch_id):
        seen.extend((name, outputs[name]._jdf.queryExecution().executedPlan().toString(), outputs[name].inputFiles()) for name in targets)
        real(outputs, targets, batch_id)

    monkeypatch.setattr(network, "write_outputs", watched)
    rules = rows(spark, [], "rule_pos int, ruleid string, sourceip string, destip string, rule_regular_expression string")
    names = ("documents", "flow_messages", "netflow_messages", "letters")
    for wanted in (names, names[1:2], ()):
        targets = {name: Target("parquet", work_folder(spark, name)) for name in wanted}
        lines = feed(['netlog_http {"Uri":"/a"}', 'send a message: [[{"SrcIp":"1"}]]', "netlog_http {x}"])
        start_network_etl(lines, rules, targets, options(spark)).awaitTermination()
        assert all(spark.read.parquet(t.location).count() == (2 if name == "documents" else 1) for name, t in targets.items())
    assert [name for name, *_ in seen] == [*names, names[1]]
    assert all("FileScan parquet" in plan and "InMemoryTableScan" not in plan for _, plan, _ in seen)
    files = [file.removeprefix("file:") for *_, found in seen for file in found]
    assert files and not any(glob.glob(file.replace("//", "/")) for file in files)
    with pytest.raises(ValueError, match="on purpose"), written("gone", spark.range(3), spark.range(2)) as (three, two):
        assert (three.count(), two.count()) == (3, 2)
        files = three.inputFiles() + two.inputFiles()
        raise ValueError("on purpose")
    assert files and not any(glob.glob(file.removeprefix("file:").replace("//", "/")) for file in files)
