import hashlib
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from checks import tables  # noqa: F401  (registers the queries)
from checks.registry import QUERIES
from flowvigil.operators import sampling
from flowvigil.operators.alerts import alerts_by_ports, alerts_by_record
from flowvigil.operators.features import (
    FEATURE_COLUMNS,
    GROUP_KEYS,
    attack_features,
    netflow_features,
    recent_netflow_features,
)
from flowvigil.operators.netflow import explode_records, netflow_messages, netflow_records
from flowvigil.operators.netflow_messages import (
    TEXT_KEYS,
    json_message_errors,
    json_messages,
    parse_json_messages,
    parse_text_messages,
    text_messages,
)

RECORD = (
    '{"SrcIp":"1.1.1.1","dstip":"2.2.2.2","SRCPORT":5,"dstport":6,"proto":"tcp","proto7":"x",'
    '"starttime":1,"lasttime":4,"recordtime":9,"ups":1,"downs":2,"uppkts":3,"downpkts":4}'
)


def test_parse(lines):
    source = lines(
        f"a send a message: [[{RECORD},{RECORD}]]",
        "a send a message: [[]]",
        "a send a message: [[{]]",
        "a send a message [[{}]]",
    )
    rows = netflow_records(source).collect()
    assert len(rows) == 2 and rows[0]["recordid"] != rows[1]["recordid"]
    assert (rows[0]["srcip"], rows[0]["srcport"], rows[0]["packernum"]) == ("1.1.1.1", "5", 7)
    assert [row["records"] is None for row in netflow_messages(source).collect()] == [
        False,
        False,
        True,
    ]


@pytest.mark.parametrize(
    ("counts", "expected"),
    [
        ('"downpkts":1,"uppkts":2', 3),
        ('"downpkts":1', None),
        ('"downpkts":1.5,"uppkts":2', None),
        ('"downpkts":"x","uppkts":2', None),
    ],
)
def test_packets_need_two_whole_numbers(lines, counts, expected):
    rows = explode_records(netflow_messages(lines(f"send a message: [[{{{counts}}}]]")))
    assert rows.first()["packernum"] == expected


def test_messages(lines):
    records = netflow_records(lines(f"send a message: [[{RECORD}]]"))
    text = text_messages(records).first()["value"]
    assert text.startswith("Map(downpkts -> 4, packernum -> 7, srcip -> 1.1.1.1, lasttime -> 4, ")
    body = text[len("Map(") : -1].split(", ")
    shuffled = "Map(" + ", ".join(reversed(body)) + ")"
    parsed = parse_text_messages(lines(text, shuffled)).drop("netflow").collect()
    assert parsed[0] == parsed[1] == parse_json_messages(json_messages(records)).first()
    assert parsed[0]["packernum"] == 7.0 and parsed[0]["dstport"] == "6"
    for key in TEXT_KEYS:
        fewer = "Map(" + ", ".join(e for e in body if not e.startswith(f"{key} -> ")) + ")"
        assert parse_text_messages(lines(fewer)).count() == 0
    doubled = "Map(" + ", ".join([*reversed(body), "ups -> 77"]) + ")"
    assert parse_text_messages(lines(doubled)).first()["ups"] == 1.0
    broken = text.replace("ups -> 1", "ups -> x")
    assert parse_text_messages(lines(broken)).first()["ups"] is None


def brute_force(rows):
    groups = {}
    for row in rows:
        groups.setdefault((row[0], row[4], row[1], row[7]), []).append(row)

    def total(values):
        known = [value for value in values if value is not None]
        return float(sum(known)) if known else None

    for key, members in groups.items():
        src = sorted({str(m[2]) for m in members if m[2] is not None})
        dst = sorted({str(m[3]) for m in members if m[3] is not None})
        yield key, (
            total([m[6] - m[5] for m in members]),
            total([None if m[8] is None else m[8] + m[9] for m in members]),
            total([m[10] + m[11] for m in members]),
            float(len(src)),
            float(len(dst)),
            float(key[1] in ("tcp", "TCP")),
            float(key[1] in ("udp", "UDP")),
            float(len(members)),
            ",".join(src),
            ",".join(dst),
        )


def random_records(spark, seed=1, number=600):
    rng = random.Random(seed)
    rows = [
        (
            # one conversation holds a third of all rows
            "hot" if n % 3 == 0 else rng.choice("ab"),
            "d",
            rng.choice([None, *range(400)]) if n % 3 == 0 else rng.randrange(5),
            rng.randrange(300),
            "tcp" if n % 3 == 0 else rng.choice(["TCP", "Tcp", "udp", "icmp"]),
            10,
            10 + rng.randrange(9),
            0 if n % 3 == 0 else rng.randrange(2),
            rng.choice([None, 1, 2]),
            rng.randrange(4),
            rng.randrange(100),
            rng.randrange(100),
        )
        for n in range(number)
    ]
    schema = (
        "srcip string, dstip string, srcport int, dstport int, proto string, starttime bigint, "
        "lasttime bigint, recordtime bigint, uppkts bigint, downpkts bigint, ups bigint, "
        "downs bigint"
    )
    return rows, spark.createDataFrame(rows, schema).withColumn(
        "recordid", F.monotonically_increasing_id().cast("string")
    )


def test_features_against_brute_force(spark):
    rows, records = random_records(spark)
    got = {
        tuple(row[key] for key in GROUP_KEYS): tuple(
            row[name] for name in (*FEATURE_COLUMNS, "srcports", "dstports")
        )
        for row in netflow_features(records).collect()
    }
    assert got == dict(brute_force(rows))


def test_conversations_are_spread_over_their_ports(spark):
    """The first shuffle is by conversation and port, so a hot conversation is split."""
    _, records = random_records(spark)
    plan = netflow_features(records)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2
    assert "gid" in shuffles[1] and "srcport" in shuffles[1]


def test_recent(spark):
    _, records = random_records(spark)
    assert {r["recordtime"] for r in recent_netflow_features(records, 86400, 1).collect()} == {1}


def test_attack_features(spark):
    rows = spark.createDataFrame(
        [("s", "d", 1, "tcp", 1.5, 2, 3, 7, 8, "DOS"), ("s", "d", 1, "tcp", 2.0, 1, 1, 7, 9, "FLOOD")],
        "srcip string, dstip string, recordtime bigint, proto string, costtime double, "
        "packernum int, bytesize int, srcport int, dstport int, label string",
    )
    assert {r["label"]: r["spandtime"] for r in attack_features(rows).collect()} == {
        "DOS": 1.5,
        "FLOOD": 2.0,
    }
    joined = attack_features(rows, "PORTSCAN").first()
    assert (joined["label"], joined["spandtime"], joined["dstports"]) == ("PORTSCAN", 3.5, "8,9")


@pytest.mark.parametrize("number", [0, 1, 137, 999, 1000, 5000])
def test_take_rows(spark, monkeypatch, number):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    coarse = [row["id"] for row in sampling.take_rows(df, number, ["id"]).collect()]
    monkeypatch.setattr(sampling, "DIGITS", 1)
    monkeypatch.setattr(sampling, "EDGE_ROWS", 3)
    fine = sampling.take_rows(df, number, ["id"])
    assert fine.columns == df.columns
    wanted = sorted(range(1000), key=lambda n: hashlib.md5(str(n).encode()).hexdigest())[:number]
    assert sorted(coarse) == sorted(row["id"] for row in fine.collect()) == sorted(wanted)


def test_ports_that_are_none(spark):
    schema = "srcip string, dstip string, predictedLabel string, recordtime bigint, spandtime double, srcports string, dstports string, proto string, packernum double, bytesize double, flownum double, src_flow_port_num double, dst_flow_port_num double"
    scored = spark.createDataFrame([("a", "b", "DOS", 1, 2.0, "", "7,x", "icmp", 1.0, 1.0, 1.0, 0.0, 2.0)], schema)
    assert {(row["srcport"], row["dstport"]) for row in alerts_by_ports(scored).collect()} == {(None, None), (None, 7)}
    records = spark.createDataFrame([("a", "icmp", "b", 1, "r", "", "x")], "srcip string, proto string, dstip string, recordtime bigint, recordid string, srcport string, dstport string")
    row = alerts_by_record(scored, records).first()
    assert (row["srcport"], row["dstport"]) == (None, None)


def test_equal_lines_give_an_alert_each(spark):
    line = f"send a message: [[{RECORD}]]"
    frame = spark.createDataFrame([(line, f"t/0/{n}") for n in range(3)], "value string, origin string")
    records = netflow_records(frame)
    scored = netflow_features(records, port_lists=False).withColumn("predictedLabel", F.lit("DOS"))
    rows = alerts_by_record(scored, records).collect()
    assert len(rows) == len({row["recordid"] for row in rows}) == rows[0]["flownuma"] == 3


def test_documents_keep_every_key(spark, lines):
    from flowvigil.sources.sinks import documents
    from flowvigil.sources.tables import records_of

    odd = '{"srcip":"1.1.1.1","recordtime":1.7e9,"starttime":"1700000000.5","lasttime":4,"Vlan":7,"uppkts":1,"downpkts":2}'
    stored = documents(netflow_records(lines(f"send a message: [[{odd}]]")), "recordid")
    document = json.loads(stored.first()["document"])
    assert (document["vlan"], document["starttime"], document["lasttime"]) == ("7", "1700000000.5", 4)
    assert float(document["recordtime"]) == 1.7e9
    row = records_of(stored).first()
    assert (row["srcip"], row["lasttime"], row["packernum"], row["extra"]["vlan"]) == ("1.1.1.1", 4, 3, "7")


def test_messages_that_are_no_record_are_letters(lines):
    texts = lines("no json", "[1]", '{"srcip":"a","ups":"many"}', '{"srcip":"a","ups":1}')
    assert [row["srcip"] for row in parse_json_messages(texts).collect()] == ["a"]
    assert [row["error"] is None for row in json_message_errors(texts).collect()] == [False, False, False, True]


def test_a_hot_conversation_is_split(spark):
    """The final plan of the join reads the hot conversation in parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings if spark.conf.get(key, None) is not None}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        hot = n % 5 != 0
        records = spark.range(200_000).select(
            F.when(hot, "hot").otherwise(F.concat(F.lit("s"), (n % 50).cast("string"))).alias("srcip"),
            F.when(hot, "tcp").otherwise(F.concat(F.lit("p"), (n % 3).cast("string"))).alias("proto"),
            F.concat(F.lit("d"), F.when(hot, 0).otherwise(n % 7).cast("string")).alias("dstip"),
            F.when(hot, 0).otherwise(n % 4).alias("recordtime"),
            n.cast("string").alias("recordid"), (n % 100).alias("srcport"), (n % 90).alias("dstport"),
            n.alias("starttime"), n.alias("lasttime"), n.alias("uppkts"), n.alias("downpkts"), n.alias("ups"), n.alias("downs"),
        )
        scored = netflow_features(records, port_lists=False).withColumn("predictedLabel", F.lit("DOS"))
        alerts = alerts_by_record(scored, records)
        assert len(alerts.select("recordid").collect()) == 200_000
        alerts.collect()
        assert "skew=true" in alerts._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)


def test_oversample(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(label, n) for label, size in (("FLOOD", 7), ("DOS", 3), ("PORTSCAN", 2)) for n in range(size)],
        "label string, n int",
    )

    def sizes(df):
        return {row["label"]: row["count"] for row in df.groupBy("label").count().collect()}

    balanced = {"FLOOD": 7, "DOS": 6, "PORTSCAN": 6}
    assert sizes(sampling.oversample(rows)) == balanced
    assert sizes(sampling.oversample(rows, portscan_by_flood=True)) == balanced | {"PORTSCAN": 2}
    assert sampling.oversample(rows.limit(0)).count() == 0
    unlabelled = rows.limit(0).unionByName(
        spark.createDataFrame([("FLOOD", n) for n in range(6)] + [("PORTSCAN", 1), ("PORTSCAN", 2)] + [(None, n) for n in range(3)], rows.schema)
    )
    assert sizes(sampling.oversample(unlabelled, portscan_by_flood=True)) == {"FLOOD": 6, "PORTSCAN": 2, None: 6}
    monkeypatch.setattr(sampling, "COPY_BLOCK", 2)
    assert sizes(sampling.oversample(rows)) == balanced
    rare = rows.where("label = 'FLOOD'").crossJoin(spark.range(900)).drop("id").unionByName(rows.where("label = 'DOS' and n = 0"))
    assert sizes(sampling.oversample(rare)) == {"FLOOD": 6300, "DOS": 6300}


def test_training_sets(spark):
    attacks = spark.createDataFrame([("DOS", 1), ("DOS", 2), ("FLOOD", 3)], "label string, k int")
    normal = spark.range(100).select(F.lit("normal").alias("label"), F.col("id").cast("int").alias("k"))
    mixed = sampling.attack_training_set(attacks, normal, ["k"])
    assert mixed.where("label = 'normal'").count() == 20
    assert mixed.where("label <> 'normal'").count() == 4
    split = sampling.hash_split(normal, 30, ["k"])
    assert 10 < split.where("in_sample").count() < 50
    united = sampling.netflow_training_set([attacks], normal, 30, ["k"])
    assert united.count() == 3 + split.where("in_sample").count()
    sample, rest = sampling.random_split(normal, 0.05, 1)
    assert sample.count() + rest.count() == 100


def scored(spark, srcports, dstports, label="DOS"):
    return spark.createDataFrame(
        [("s", "d", 10.0, "tcp", label, 1.5, 3.9, 2.0, 1.0, 2.0, 3.0, srcports, dstports)],
        "srcip string, dstip string, recordtime double, proto string, predictedLabel string, "
        "spandtime double, packernum double, bytesize double, flownum double, "
        "src_flow_port_num double, dst_flow_port_num double, srcports string, dstports string",
    )


def test_alerts_by_ports(spark):
    src, dst = range(1, 601), range(1000, 1300)
    alerts = alerts_by_ports(scored(spark, ",".join(map(str, src)), ",".join(map(str, dst))))
    pairs = [(row["srcport"], row["dstport"]) for row in alerts.collect()]
    assert sorted(pairs) == sorted(itertools.product(src, dst))
    row = alerts.first()
    assert (row["recordid"], row["attacktype"], row["packernum"], row["costtime"]) == (
        "ignore",
        "DOS",
        3,
        1.5,
    )
    assert row["recordtime"].timestamp() == 10
    assert alerts_by_ports(scored(spark, "1", "2", "normal")).count() == 0


def test_alerts_by_record(spark):
    _, records = random_records(spark)
    records = records.unionByName(records.where("srcport = 3"))
    features = netflow_features(records)
    labels = F.when(F.col("srcip") == "hot", "DOS").otherwise("normal")
    alerts = alerts_by_record(features.withColumn("predictedLabel", labels), records)
    wanted = {f"ignore{row['recordid']}" for row in records.where("srcip = 'hot'").collect()}
    rows = alerts.collect()
    assert {row["recordid"] for row in rows} == wanted
    assert {row["flownuma"] for row in rows} == {len(rows)} == {records.where("srcip = 'hot'").count()}


def test_rows_of_few_classes_are_not_shuffled_to_their_label(spark):
    rows = spark.range(40).select(F.when(F.col("id") < 37, "FLOOD").otherwise("DOS").alias("label"), "id")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        balanced = sampling.oversample(rows)
        plan = balanced._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert {row["label"]: row["count"] for row in balanced.groupBy("label").count().collect()} == {"FLOOD": 37, "DOS": 36}
    finally:
        spark.conf.set(threshold, before)


def test_a_bounded_training_set_reads_stored_features(spark, tmp_path):
    events = spark.range(60).selectExpr("id as event_id", "timestamp_seconds(1704067200 + id) as ts", "id % 9 as user_id")
    lineitem = spark.range(60).selectExpr(
        "id as l_suppkey", "id * 3 as l_partkey", "id % 7 + 1 as l_linenumber", "date'1995-01-01' as l_shipdate",
        "element_at(array('A', 'N', 'R'), cast(id % 3 + 1 as int)) as l_returnflag", "id as l_quantity",
        "id * 1.5 as l_extendedprice", "id as l_orderkey",
    )
    for name, df in (("events", events), ("lineitem", lineitem)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    chosen = QUERIES["attack_train_set_bounded"](spark, str(tmp_path))
    assert not [name for name in chosen.inputFiles() if ".parquet/" in name]
    assert chosen.where("label <> 'normal'").count() > 0
