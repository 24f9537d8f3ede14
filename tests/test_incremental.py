"""Port bitmaps, partials, running totals, evaluation by rank, least-cost segments."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from flowvigil.functions.segments import WordCosts, segmented, word_counts
from flowvigil.functions.uris import clean_uri
from flowvigil.operators.evaluation import mean_ranks, rank_evaluation
from flowvigil.operators.features import netflow_features
from flowvigil.operators.partials import PartialStore, cell_partials
from flowvigil.operators.port_sets import merge_cells, port_cells, port_counts, port_lists
from flowvigil.operators.ranks import global_ranks, running_totals

PORTS = ["0", "1", "80", "32767", "32768", "32769", "65535", "65536", "007", "-1", "http", "", None, "80", "99999999999"]


def test_port_sets_are_exact(spark):
    rows = [("a", k % 2, port) for k, port in enumerate(PORTS)] + [("b", 0, None)]
    cells = port_cells(spark.createDataFrame(rows, "key string, day int, port string"), ["key", "day"], "port")
    assert cells.agg(F.max(F.octet_length("bits"))).first()[0] == 4096
    merged = merge_cells(cells, ["key"])
    counts = {row.key: row.n for row in port_counts(merged, ["key"], "n").collect()}
    want = {port for port in PORTS if port is not None}
    assert counts == {"a": float(len(want))}
    assert port_lists(merged, ["key"], "ports").first().ports == ",".join(sorted(want))


def test_port_cells_are_built_before_the_shuffle(spark):
    rows = spark.range(100_000).select(F.lit(1).alias("key"), (F.col("id") % 65536).alias("port"))
    plan = port_cells(rows, ["key"], "port")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan


RECORD = "srcip string, proto string, dstip string, recordtime long, lasttime long, starttime long, uppkts long, downpkts long, ups long, downs long, srcport string, dstport string"


def _records(seed, n, none=0.1):
    rng = random.Random(seed)
    maybe = lambda value: None if rng.random() < none else value
    return [
        (
            maybe(f"s{rng.randrange(3)}"), rng.choice(["tcp", "UDP"]), "d", rng.randrange(6) * 43_200, 9, 3, maybe(rng.randrange(9)),
            rng.randrange(9), 5, 6, maybe(str(rng.randrange(70_000))), maybe(rng.choice(["22", "80", "x"])),
        )
        for _ in range(n)
    ]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_partials_give_what_records_give(spark, tmp_path):
    batches = [_records(seed, 60) for seed in range(3)]
    store = PartialStore(str(tmp_path / "partials"))
    for name, rows in (("0", batches[0]), ("1", batches[2]), ("2", batches[2]), ("1", batches[1])):
        store.add(spark.createDataFrame(rows, RECORD), name)
    records = spark.createDataFrame([row for rows in batches for row in rows], RECORD)
    assert _sorted(store.features(spark)) == _sorted(netflow_features(records))
    since = 100_000
    recent = records.where(F.col("recordtime") > since)
    assert _sorted(store.features(spark, since, lists=False)) == _sorted(netflow_features(recent, port_lists=False))
    merged = PartialStore(str(tmp_path / "merged"))
    store.compact(spark, merged)
    assert _sorted(merged.features(spark)) == _sorted(netflow_features(records))
    plan = store._read(spark, "sums", since)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_running_totals_and_ranks(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), k, rng.randrange(9)) for k in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(5)
    order = [F.col("a").desc(), F.col("b")]
    ranked = {(row.a, row.b): row["rank"] for row in global_ranks(df, order).collect()}
    want = sorted(rows, key=lambda row: (-row[0], row[1]))
    assert [ranked[row[:2]] for row in want] == list(range(1, 201))
    totals = {(row.a, row.b): row.t for row in running_totals(df, order, {"t": F.col("c")}).collect()}
    assert [totals[row[:2]] for row in want] == list(itertools.accumulate(row[2] for row in want))
    assert global_ranks(df.where("false"), order).collect() == []


def test_rank_evaluation(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(12)), rng.random() < 0.4) for _ in range(150)]
    df = spark.createDataFrame([*rows, (None, True), (float("nan"), False), (1.0, None)], "s double, y boolean")
    got = rank_evaluation(df, "s", "y").first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    pairs = [(a > b) + 0.5 * (a == b) for a in pos for b in neg]
    assert got.area == pytest.approx(sum(pairs) / len(pairs))
    f1 = {t: 2 * sum(p >= t for p in pos) / (sum(s >= t for s, _ in rows) + len(pos)) for t, _ in rows}
    best = max(f1.items(), key=lambda one: (one[1], one[0]))
    assert (got.threshold, got.f1) == (best[0], pytest.approx(best[1]))
    ranks = {row.score: row["rank"] for row in mean_ranks(df, "s", "y").collect()}
    ordered = sorted(s for s, _ in rows)
    assert all(ranks[s] == ordered.index(s) + (ordered.count(s) + 1) / 2 for s in set(ordered))
    one_kind = rank_evaluation(df.where("y"), "s", "y").first()
    assert one_kind.area is None and one_kind.n_neg == 0
    assert rank_evaluation(df.where("false"), "s", "y").first().n_pos == 0


def _cheapest(run, words):
    """Over all cuts of a short run."""
    best = None
    for cuts in itertools.product([0, 1], repeat=max(0, len(run) - 1)):
        edges = [0, *[k + 1 for k, cut in enumerate(cuts) if cut], len(run)]
        pieces = [run[a:b] for a, b in itertools.pairwise(edges)]
        costs = [words.costs.get(piece, words.unknown if len(piece) == 1 else None) for piece in pieces]
        if None not in costs:
            key = (sum(costs), len(pieces), *reversed(edges))
            best = min(best, (key, pieces)) if best else (key, pieces)
    return best[1] if best else []


def test_segments_have_least_cost(spark):
    words = WordCosts.of_counts({"a": 4, "ab": 9, "abc": 2, "bc": 7, "ca": 3, "cab": 1, "bb": 5})
    rng = random.Random(6)
    runs = ["", "x", "abc", *("".join(rng.choice("abcx") for _ in range(rng.randrange(1, 10))) for _ in range(60))]
    df = spark.createDataFrame([(run,) for run in runs], "t string")
    got = {row.t: row.s for row in df.select("t", segmented(F.col("t"), words).alias("s")).collect()}
    assert got == {run: "|".join(_cheapest(run, words)) for run in runs}


def test_least_cost_words_in_an_address(spark):
    words = WordCosts.of_counts({"user": 5, "name": 5, "username": 3, "luannumber": 9})
    df = spark.createDataFrame([("userNAME=17&x",), (None,)], "u string")
    assert [row.s for row in df.select(clean_uri(F.col("u"), words).alias("s")).collect()] == ["username|=|luannumber|&|x", None]
    spoken = spark.createDataFrame([(["ab", "ab", "c", "x1", "abcdef"],), (["ab", "abc"],)], "w array<string>")
    assert word_counts(spoken, "w", 1, 5, 10) == {"ab": 3, "abc": 1}
    assert word_counts(spoken, "w", 1, 5, 1) == {"ab": 3}


def test_partials_derive_the_records_once(spark, tmp_path):
    names = ("starttime", "lasttime", "uppkts", "downpkts", "ups", "downs")
    derived = spark.sparkContext.accumulator(0)

    def seen(number):
        derived.add(1)
        return str(number)

    records = spark.range(12).select(
        F.lit("a").alias("srcip"), F.lit("tcp").alias("proto"), F.lit("b").alias("dstip"), F.lit(1).cast("bigint").alias("recordtime"),
        *[F.col("id").alias(name) for name in names],
        F.udf(seen)("id").alias("srcport"), F.when(F.col("id") > 0, "x").alias("dstport"),
    )
    plan = cell_partials(records)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 12") == 1
    store = PartialStore(str(tmp_path / "partials"))
    store.add(records, 0)
    assert derived.value == 12
    row = store.features(spark).first()
    assert (row["src_flow_port_num"], row["dst_flow_port_num"], row["dstports"], row["flownum"]) == (12.0, 1.0, "x", 12.0)
