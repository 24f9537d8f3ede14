import json
import time

import pytest
from pyspark.sql import functions as F

from flowvigil.operators import rules as rules_module
from flowvigil.operators.deadletter import (
    dead_letter_messages,
    dead_letters,
    fail_on_error,
    network_errors,
    parse_network,
)
from flowvigil.operators.http import FLOW_COLUMNS, complete, drop_static, http_flows, parse_http
from flowvigil.operators.route import route
from flowvigil.operators.rules import match_rules, resolve_rules, rule_rows
from flowvigil.operators.uri_flows import (
    flow_messages,
    parse_flow_messages,
    query_text,
    recent_queries,
)
from flowvigil.plans.network import network_tables
from flowvigil.sources.tables import rules_table


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("netlog_http {}", "http"),
        ("x netlog_bd {}", "http"),
        ("x netlog_http", "netflow"),
        ("netlog_http", "netflow"),
        ("netlog_httpnetlog_bd", "netflow"),
        ("netlog_http netlog_bd", "http"),
        ("netlog_http\n", "http"),
        ("netlog", "netflow"),
        ("", "netflow"),
    ],
)
def test_route(lines, line, expected):
    assert route(lines(line)).first()["route"] == expected


def test_route_by_one_marker(lines):
    rows = route(lines("netlog_bd {}", "netlog_http {}"), markers=["netlog_http"]).collect()
    assert [row["route"] for row in rows] == ["netflow", "http"]


def flow(**keys):
    return "netlog_http " + json.dumps(keys)


def test_parse_keeps_spans_and_marks_broken_ones(lines):
    rows = parse_http(lines(flow(Uri="/a"), "netlog_http none", "netlog_http {bad}")).collect()
    assert [row["flowcontent"] for row in rows] == [{"Uri": "/a"}, None]


def test_static_resources_by_exact_key(lines):
    uris = ["/a.css", "/b.jsp?x", "/c.json", "/d.CSS", "/e?f=1"]
    rows = drop_static(parse_http(lines(*[flow(Uri=uri) for uri in uris]))).collect()
    assert [row["flowcontent"]["Uri"] for row in rows] == ["/d.CSS", "/e?f=1"]
    assert drop_static(parse_http(lines(flow(uri="/a.css")))).count() == 1


def test_complete(lines):
    line = flow(URI="/x", uri="/y", Date="2017-12-20 02:45:25", es_type="own", Nested={"a": 1.5})
    row = complete(parse_http(lines(line))).first()
    assert row["uri"] == "/y"
    assert row["date"] == 1513737925
    assert row["es_type"] == "own" and row["es_index"] == "flow"
    assert row["extra"] == {"nested": '{"a":1.5}'}
    blank = set(FLOW_COLUMNS) - {"uri", "date"}
    assert all(row[name] == " " for name in blank)
    assert http_flows(lines(flow(Uri="/a"))).first()["date"] is None


def rule_frame(spark, *rules):
    values = [(position, *rule) for position, rule in enumerate(rules)]
    return spark.createDataFrame(
        values,
        "rule_pos int, ruleid string, sourceip string, destip string, "
        "rule_regular_expression string",
    )


def hits(spark, flows, *rules, **options):
    rows = match_rules(flows, rule_frame(spark, *rules), **options).collect()
    return [row["ruleid"] for row in rows]


def test_first_rule_wins_on_decoded_uri(spark, lines):
    flows = http_flows(lines(flow(Uri="/Q%20OR+1=1", SrcIp="1.2.3.4"), flow(Uri="/x")))
    assert hits(spark, flows, ("B", "any", "any", r"or\s1"), ("A", "any", "any", "q")) == ["B", None]


def test_addresses(spark, lines):
    flows = http_flows(lines(flow(Uri="/x", SrcIp="1.2.3.4", DstIp="5.6.7.8")))
    other = ("R", "9.9.9.9", "any", "x")
    assert hits(spark, flows, other) == ["R"]
    assert hits(spark, flows, other, ip_match="strict") == [None]
    assert hits(spark, flows, ("R", r"1\.2\.3\.4", "any", "x")) == [None]
    assert hits(spark, flows, ("R", "1.2.3.4", "5.6.7.8", "x"), ip_match="strict") == ["R"]
    with pytest.raises(ValueError):
        hits(spark, flows, other, ip_match="loose")


def test_bad_rules(spark, lines):
    flows = http_flows(lines(flow(Uri="/x")))
    rules = (("A", "any", "any", "nope"), ("B", "any", "any", "("), ("C", "any", "any", "x"))
    assert hits(spark, flows, *rules) == ["C"]
    assert hits(spark, flows, *rules, on_bad_rule="stop") == [None]
    with pytest.raises(ValueError):
        hits(spark, flows, ("A", None, "any", "x"))
    assert hits(spark, flows) == [None]


def test_a_thousand_rules_are_planned_in_seconds(spark, lines):
    table = rule_frame(spark, *[(f"R{n}", "any", r"10\.0\.0\.1", rf"it's\s{n}\b") for n in range(1000)])
    resolved = resolve_rules(table)
    started = time.perf_counter()
    matched = match_rules(http_flows(lines(flow(Uri="/a?it's 999", DstIp="10.0.0.1"))), resolved)
    assert time.perf_counter() - started < 4
    assert len(resolved) == 1000 and matched.isStreaming is False


def test_rules_beyond_one_case(spark, lines, monkeypatch):
    monkeypatch.setattr(rules_module, "RULES_PER_CASE", 2)
    flows = http_flows(lines(*[flow(Uri=f"/p{n};", N=n) for n in range(14)]))
    rules = [(f"R{n}", "any", "any", f"p{n};") for n in range(12)]
    rules.append(("late", "any", "any", "p"))
    expected = [f"R{n}" for n in range(12)] + ["late", "late"]
    assert hits(spark, flows, *rules) == expected
    stopped = [*rules[:6], ("bad", "any", "any", "["), *rules[6:]]
    assert hits(spark, flows, *stopped, on_bad_rule="stop") == expected[:6] + [None] * 8


def test_rule_rows_and_order_column(spark, lines):
    flows = http_flows(lines(flow(Uri="/x", es_index="own"), flow(Uri="/y")))
    rules = rules_table(rule_frame(spark, ("A", "any", "any", "x")), "rule_pos")
    rows = rule_rows(match_rules(flows, rules)).select("uri", "es_index", "ruleid").collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("/x", "flowlogrule", "A"),
        ("/x", "own", None),
        ("/y", "flow", None),
    ]


def test_flow_messages(lines):
    flows = http_flows(lines(flow(Uri="/a,b?x=1?y=2", Id="i", DstIp="d", SrcIp="s", Date="1513709125")))
    text = flow_messages(flows).first()
    assert text["key"] is None
    assert text["value"] == "id=i,uri=/a,b?x=1?y=2,dstip=d,srcip=s,date=1513709125"
    row = parse_flow_messages(flow_messages(flows)).first()
    assert tuple(row) == ("i", "y|=|luannumber", "/a", 1513709125, "s", "d")
    assert flow_messages(http_flows(lines(flow(Id="i")))).first()["value"].endswith("date= ")
    assert parse_flow_messages(lines("id=1,uri=/a,dstip=d,srcip=s,date=1")).count() == 0
    assert parse_flow_messages(lines("id=1,uri=/a?b,dstip=d,srcip=s,date=x")).first()["date"] is None


def test_query_text(lines):
    row = lines("/a?x=1?y=2").select(
        query_text(F.col("value")), query_text(F.col("value"), "last")
    ).first()
    assert tuple(row) == ("?x=1?y=2", "y=2")
    with pytest.raises(ValueError):
        query_text(F.col("value"), "middle")


def test_recent_queries_are_strictly_between(spark):
    day = 86400
    flows = spark.createDataFrame(
        [(uri, date, "s", "d") for uri in ("/a?b", "/a") for date in (0, 1, day - 1, day)],
        "uri string, date bigint, srcip string, dstip string",
    )
    rows = recent_queries(flows, day, 1).collect()
    assert [(row["uri"], row["uri_ori"], row["date"]) for row in rows] == [
        ("?|b", "/a?b", 1),
        ("?|b", "/a?b", day - 1),
    ]


def test_errors_become_letters(lines):
    good = [flow(Uri="/a", Date="2017-12-20 02:45:25"), "noise", "send a message: [[{}]]"]
    bad = ["netlog_http {bad", "netlog_http {bad}", flow(DATE="123"), "send a message: [[{]]"]
    checked = network_errors(lines(*good, *bad))
    letters = dead_letters(checked, "network", now="2020-01-01 00:00:00")
    assert [(row["log"], row["error"]) for row in letters.collect()] == [
        ("netlog_http {bad}", "http payload is no JSON object"),
        (flow(DATE="123"), "http date has fewer than ten digits"),
        ("send a message: [[{]]", "netflow payload is no JSON array of objects"),
    ]
    message = json.loads(dead_letter_messages(letters).first()["value"])
    assert message["stage"] == "network" and message["time"] == "2020-01-01 00:00:00"
    assert fail_on_error(network_errors(lines(*good))).count() == 3
    with pytest.raises(Exception, match="payload|ten digits"):
        fail_on_error(checked).collect()


def test_network_tables(spark, lines):
    rules = rule_frame(spark, ("A", "any", "any", "x"))
    source = lines(flow(Uri="/x"), 'a send a message: [[{"SrcIp":"1"},{"SrcIp":"2"}]]', "netlog_http {")
    tables = network_tables(source, rules)
    documents = tables.documents().collect()
    assert sorted(row["es_index"] for row in documents) == ["flow", "flowlogrule", "netflow", "netflow"]
    assert len({row["id"] for row in documents}) == 3
    assert tables.flow_messages().count() == 2
    assert tables.netflow_messages().count() == 2
    with pytest.raises(Exception, match="http payload"):
        network_tables(lines("netlog_http {x}"), rules, strict=True).documents().collect()


def test_tables_parse_their_own_lines_alone(spark):
    sorts = {"http": 'netlog_http {"Uri":"/a?b=1"}', "netflow": 'send a message: [[{"srcip":"1"}]]'}
    found = spark.createDataFrame([(line,) for line in sorts.values() for _ in range(20)], "value string")
    tables = network_tables(found, [])
    assert (tables.flows.count(), tables.records.count(), tables.letters.count()) == (20, 20, 0)

    for table in (tables.flows, tables.records):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter" in plan.split("Generate")[-1]


def test_the_date_of_a_line_is_looked_up_once(spark):
    parsed = parse_network(spark.createDataFrame([('netlog_http {"Date":"12","date":"17"}',)], "value string"))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_filter(") + plan.count("mapfilter(") == 2
    assert parsed.first()["error"] == "http date has fewer than ten digits"
