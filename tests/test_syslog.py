import random

from pyspark.sql import functions as F

from flowvigil.operators.deadletter import syslog_errors
from flowvigil.operators.syslog import (
    GENLOG_COLUMNS,
    SyslogPattern,
    classify,
    envelope,
    genlog_fields,
    syslog_rows,
)
from flowvigil.session import work_folder
from flowvigil.sources.patterns import (
    VENDOR_PATTERNS,
    pattern_table,
    read_patterns,
    write_patterns,
)

WAF = (
    "edge7 waf: stat_time:2024-02-03 04:05:06 event_type:xss dst_ip:192.0.2.7 dst_port:8080 "
    "url:/p1 src_ip:198.51.100.9 src_port:40001 method:POST"
)


def wrap(body, tail=""):
    return "|!".join(["1"] + ["x"] * 28 + ["10.0.0.9", "pad", body]) + tail


def test_envelope(lines):
    bodies = [wrap("the body"), wrap("the body", "|!ok"), wrap("the body", "|!|!|!"), "short|!line"]
    rows = envelope(lines(*bodies)).collect()
    assert [(row["reportip"], row["orglog"]) for row in rows[:3]] == [("10.0.0.9", "the body")] * 3
    assert rows[3]["reportip"] is None
    errors = [row["error"] for row in syslog_errors(lines(*bodies)).collect()]
    assert errors == [None, None, None, "syslog line has fewer than thirty fields"]


def test_patterns_survive_xml(spark):
    folder = work_folder(spark, "patterns")
    own = SyslogPattern("own", r"a<(\d+)>(b)? & c", (("sourceip", 1), ("url", 2)), ("a<",), ("url",))
    write_patterns(pattern_table(spark, [own, *VENDOR_PATTERNS]), folder)
    assert read_patterns(spark, folder) == (own, *VENDOR_PATTERNS)


def test_first_pattern_wins(lines):
    ads = "Attack:flood src=1.1.1.1 dst=2.2.2.2 sport=5 dport=80"
    both = wrap(f"{ads} {WAF}")
    rows = classify(lines(both, wrap(WAF), wrap("nothing")), VENDOR_PATTERNS).collect()
    assert [row["logruleid"] for row in rows] == ["ads", "waf", None]
    assert classify(lines(both), []).first()["logruleid"] is None


def test_shortcuts_change_no_match(spark):
    """Required texts and the anchored search against the bare expression."""
    rng = random.Random(7)
    samples = [
        WAF,
        "Attack:flood src=1.1.1.1 dst=2.2.2.2 sport=5 dport=80 x",
        "logtype=1;datetime=20/Dec/2017:02:45:25;eventID=7;dstip=1;eventType=d;severity=2;description=b",
        '99 attack_name(4)=sqli;app_protocol_name(3)=(2)http;protocol(1)=6;src_ip(3)=1;src_port(1)=9;'
        "dst_ip(1)=1;dst_port(1)=80;block_reason=0",
        'ids {"time":1,"source":{"ip":"1","port":1,"a":1},"z":0,"destination":{"ip":"1","port":8,"b":2},'
        '"protocol":"t","subject":"s","message":"m"}',
    ]
    texts = set(samples) | {f"{a}\n{b}" for a in samples for b in samples}
    for text in samples:
        for _ in range(40):
            start, end = sorted(rng.sample(range(len(text)), 2))
            texts.add(text[:start] + rng.choice(["", "\n", "=", "x"]) + text[end:])
    df = spark.createDataFrame([(text,) for text in sorted(texts)], "value string")
    for pattern in VENDOR_PATTERNS:
        groups = [group for _, group in pattern.fields]
        plain = [F.regexp_extract("value", pattern.pattern, group) for group in groups]
        short = [F.regexp_extract("value", pattern.search_pattern, group) for group in groups]
        rows = df.select(
            F.col("value").rlike(pattern.pattern).alias("plain"),
            pattern.found_in(F.col("value")).alias("short"),
            F.array(*plain).alias("plain_groups"),
            F.array(*short).alias("short_groups"),
        ).collect()
        assert any(row["plain"] for row in rows)
        assert all(row["plain"] == row["short"] for row in rows)
        assert all(row["plain_groups"] == row["short_groups"] for row in rows)


def test_genlog_fields(lines):
    classified = classify(envelope(lines(wrap(WAF))), VENDOR_PATTERNS)
    row = genlog_fields(classified, VENDOR_PATTERNS).first()
    assert row["firstrecvtime"] == 1706933106000
    assert (row["eventname"], row["sourceip"], row["sourceport"]) == (
        "xss ",
        "198.51.100.9 ",
        "40001",
    )
    assert row["eventname3"].endswith("hashcode") and row["eventname2"] == " "
    assert {name for name in GENLOG_COLUMNS if name not in row.asDict()} == {
        "row",
        "recordid",
        "orgid",
    }


def test_optional_group_is_null_and_absent_field_blank(lines):
    own = SyslogPattern("own", r"a(\d+)(b)?", (("sourceip", 1), ("url", 2)), (), ("url",))
    rows = genlog_fields(classify(envelope(lines(wrap("xa1b"), wrap("xxa2"))), [own]), [own], now=5)
    assert [(r["sourceip"], r["url"], r["destip"], r["firstrecvtime"]) for r in rows.collect()] == [
        ("1", "b", " ", 5000),
        ("2", None, " ", 5000),
    ]


def test_rows_of_one_line(lines):
    rows = syslog_rows(lines(wrap(WAF), wrap("nothing"), "bad"), VENDOR_PATTERNS, now=5).collect()
    assert [(row["es_type"], row["ismatch"]) for row in rows] == [
        ("syslog", 1),
        ("genlog", None),
        ("syslog", 0),
    ]
    assert rows[1]["orgid"] == rows[0]["recordid"] != rows[1]["recordid"]
    assert rows[0]["recvtime"] == 5000 and rows[0]["logcontent"] == wrap(WAF)
    assert rows[1]["orglog"] == WAF


def test_nested_ids_are_one_id(lines):
    frame = syslog_rows(lines(wrap(WAF)), VENDOR_PATTERNS, now=5)
    assert frame.collect() == frame.collect()
