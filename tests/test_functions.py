import pytest
from pyspark.sql import functions as F

from flowvigil.functions import (
    captured_groups,
    clean_uri,
    java_hash,
    lower_keys,
    once,
    parse_time,
    record_id,
    uri_decode,
    uri_normalize,
    uri_tokens,
    uri_words,
)


def apply(lines, function, *texts):
    rows = lines(*texts).select(function(F.col("value")).alias("out")).collect()
    return [row["out"] for row in rows]


@pytest.mark.parametrize(
    ("text", "epoch"),
    [
        ("1513709125000", 1513709125),
        ("1513709125", 1513709125),
        ("151370912", None),
        ("20/Dec/2017:02:45:25", 1513737925),
        ("20/December/2017:02:45:25 +0800", 1513737925),
        ("2017-12-20 02:45:25  ", 1513737925),
        (" 2017-12-20   2:45:25.123", 1513737925),
        ("at 2017-12-20 02:45:25", 0),
        ("2017-13-20 02:45:25", 0),
        ("20/Foo/2017:02:45:25", 0),
        ("", 0),
        (" ", 0),
        (None, None),
        # Twelve-digit millis lose the wrong digit, very early ones count as no time.
        ("2000-01-01 00:00:00", 9466848000),
        ("1970-01-02 00:00:00", 0),
    ],
)
def test_parse_time(lines, text, epoch):
    assert apply(lines, parse_time, text) == [epoch]


def reference_hash(text):
    units = text.encode("utf-16-be")
    total = 0
    for high, low in zip(units[::2], units[1::2], strict=True):
        total = (31 * total + (high << 8 | low)) & 0xFFFFFFFF
    return total - (1 << 32) if total >> 31 else total


def test_java_hash(lines):
    texts = ["", "a", "csrf  ", "SYN-Flood", "跨站请求伪造", "a😀b", "polygenelubricants" * 5]
    assert apply(lines, java_hash, *texts) == [reference_hash(text) for text in texts]
    assert reference_hash("polygenelubricants") == -(1 << 31)


def test_uri_decode(lines):
    texts = ["/s?q=100%&B=%41+%zz", "/%E4%BD%A0", "%%41", "/a"]
    assert apply(lines, uri_decode, *texts) == ["/s?q=100%&b=a %zz", "/你", "%a", "/a"]


def test_uri_normalize(lines):
    texts = ["a1b2c3", "12ab34", "id=77&x", "abc", "a1-b2c"]
    expected = ["luancode", "luancode", "id=luannumber&x", "abc", "luancode-luancode"]
    assert apply(lines, uri_normalize, *texts) == expected


def test_uri_tokens(lines):
    assert apply(lines, uri_tokens, "/q?u=union select") == ["/|q|?|u|=|union|select"]

    def with_words(text):
        return uri_tokens(text, ["union", "unionall", "or", "."])

    assert apply(lines, with_words, "unionall.or xor") == ["unionall|.|or|xor"]


def test_clean_uri_and_words(lines):
    assert apply(lines, clean_uri, "/a?ID=12%20OR") == ["/|a|?|id|=|luannumber|or"]
    assert apply(lines, lambda text: uri_words(clean_uri(text)), "/a?ID=12%20OR") == [
        ["a", "id", "=", "luannumber", "or"]
    ]


def test_lower_keys_keeps_the_last_of_a_clash(spark):
    rows = spark.sql(
        "select map('Uri', 'a', 'uri', 'b', 'URI', 'c', 'X', '1') m union all select map('K', 'v')"
    )
    kept = [row[0] for row in rows.select(lower_keys(F.col("m"))).collect()]
    assert kept == [{"uri": "c", "x": "1"}, {"k": "v"}]


def test_captured_groups_agree_with_single_extraction(lines):
    pattern = r"(?<=x)a=(.*?);b=(\d*)(;c)?"
    texts = [
        "xa=1;b=2;c",
        "a=0;b=0 xa=3;b= tail",
        "two\nlines xa=4;b=5\nmore",
        "xa=\x1f;b=6",
        "none",
        r"xa=$1\;b=7 xa=8;b=9",
        "",
    ]
    groups = [1, 2, 3]
    rows = lines(*texts).select(
        captured_groups(F.col("value"), pattern, groups).alias("together"),
        F.array(*[F.regexp_extract("value", pattern, group) for group in groups]).alias("single"),
    )
    assert all(row["together"] == row["single"] for row in rows.collect())
    assert apply(lines, lambda text: captured_groups(text, "b=(.)", [1]), "b=x", "y") == [["x"], [""]]


def test_record_id(lines):
    assert apply(lines, lambda text: record_id("hash", text), "a", "a")[0] == (
        "0cc175b9c0f1b6a831c399e269772661"
    )
    assert len(set(apply(lines, lambda text: record_id("uuid", text), "a", "a"))) == 2
    with pytest.raises(ValueError):
        record_id("serial")


def test_filters_stay_above_once(spark):
    made = once(spark.range(10).select("id"), "costly", F.from_json(F.lit('{"a":1}'), "a int")["a"])
    assert made.where("costly = 1 and id > 3").count() == 6
    parsed = once(spark.range(10), "m", F.from_json(F.col("id").cast("string"), "map<string,string>"))
    plan = parsed.where("m is null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_addresses_with_the_same_letters_are_cut_once(spark, tmp_path):
    from checks.texts import _uri_least_cost

    urls = [(1, "http://shop/item1"), (1, "http://shop/item1"), (2, "http://shop/item22"), (3, None), (4, "12"), (5, "http://shop")]
    spark.createDataFrame(urls, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.sql("select 1L as event_id, timestamp '2024-01-01 00:00:00' as ts, 1L as user_id").where("event_id < 0").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    cut = _uri_least_cost(spark, str(tmp_path))
    assert "Aggregate [letters" in cut._jdf.queryExecution().optimizedPlan().toString()
    found = sorted(((row["id"], row["text"]) for row in cut.collect()), key=str)
    assert found == [
        (1, "http|shop|item"), (1, "http|shop|item"), (2, "http|shop|item"), (3, None), (4, ""), (5, "http|shop"),
    ]
