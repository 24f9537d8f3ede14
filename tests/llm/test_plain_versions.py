"""Operators beside plain versions of them: exact counts, bisection, alignment of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_near_dedup import plain_survivors

import corpus_pipeline
from flowvigil.llm import language as lang
from flowvigil.llm.decontaminate import find_contamination, smith_waterman
from flowvigil.llm.mixing import mix_sources
from flowvigil.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="module")
def texts(spark):
    return {row.doc_id: row.text or "" for row in table(spark, "documents").select("doc_id", "text").collect()}


def paragraphs(text):
    return Counter(text.split("\n")) if text else Counter()


def runs(text):
    """Runs of three words in each paragraph, single words where there are fewer."""
    found = Counter()
    for paragraph in text.split("\n"):
        words = re.findall(r"[^\x20\x09-\x0D]+", paragraph)
        found.update([tuple(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [(w,) for w in words])
    return found


def plain_likeness(left, right):
    if paragraphs(left) == paragraphs(right):
        return 1.0
    a, b = runs(left), runs(right)
    norm = sum(n * n for n in a.values()) + sum(n * n for n in b.values())
    return 2 * sum(n * b[run] for run, n in a.items()) / norm if norm else 0.0


def test_op1_likeness_and_equality(spark, texts):
    got = {row.doc_id: row for row in QUERIES["op1_fingerprints"](spark, SF_DIR).collect()}
    ids = sorted(texts)
    errors, by_content = [], {}
    for k, doc_id in enumerate(ids):
        own, after = texts[doc_id], texts[ids[(k + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        row = got[doc_id]
        errors += [row.near_edited - plain_likeness(own, edited), row.near_next - plain_likeness(own, after)]
        for text, fingerprint in ((own, row.fingerprint), (edited, row.edited_fingerprint)):
            by_content.setdefault(frozenset(paragraphs(text).items()), set()).add(fingerprint)
    assert np.mean(np.abs(errors)) < 0.08 and np.max(np.abs(errors)) < 0.45
    assert all(len(found) == 1 for found in by_content.values())
    assert len(set().union(*by_content.values())) == len(by_content)


def plain_states(layer, raw):
    hidden = len(layer.bias)
    gate = lambda x: 1 / (1 + math.exp(-x))
    state, out = [0.0] * hidden, []
    for byte in raw:
        given = [float(layer.table[k, byte]) for k in range(3 * hidden)]
        held = [sum(float(layer.inner[k, j]) * state[j] for j in range(hidden)) for k in range(3 * hidden)]
        new = []
        for k in range(hidden):
            update, reset = gate(given[k] + held[k]), gate(given[hidden + k] + held[hidden + k])
            candidate = math.tanh(given[2 * hidden + k] + reset * (held[2 * hidden + k] + float(layer.bias[k, 0])))
            new.append(update * state[k] + (1 - update) * candidate)
        state = new
        out.append(state)
    return out


@settings(max_examples=25, deadline=None)
@given(st.binary(min_size=1, max_size=30), st.integers(0, 5))
def test_op2_forward_pass(raw, seed):
    model = lang.new_model(["a", "b", "c"], hidden=3, seed=seed)
    got = lang.position_probabilities(model, np.frombuffer(raw, np.uint8)[:, None])[:, :, 0]
    ahead, behind = plain_states(model.forward, raw), plain_states(model.backward, raw[::-1])[::-1]
    for k in range(len(raw)):
        both = [*ahead[k], *behind[k]]
        score = [math.exp(sum(float(w) * s for w, s in zip(row, both, strict=True)) + float(b)) for row, b in zip(model.out, model.bias[:, 0], strict=True)]
        assert got[k].tolist() == pytest.approx([s / sum(score) for s in score], abs=1e-4)


def plain_rates(sizes, goal):
    """Tilted rates of at most 3 whose words add up to the goal, by bisection."""
    mean = max(1.0, sum(sizes) / max(1, sum(size > 0 for size in sizes)))
    rate = lambda m, size: min(3.0, math.exp(min(m * size / mean, 50)))
    low, high = -1e3, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        if sum(rate(middle, size) * size for size in sizes) < goal:
            low = middle
        else:
            high = middle
    return [rate(high, size) for size in sizes]


def test_op3_rates(spark):
    by_source = {}
    for row in mix_sources(table(spark, "documents")).collect():
        by_source.setdefault(row.source, []).append(row)
    tilted = 0
    for found in by_source.values():
        if found[0].target > 2.999999 * found[0].source_size:
            assert all(row.rate == 3 for row in found)
            continue
        tilted += 1
        want = plain_rates([row["size"] for row in found], found[0].target)
        assert [row.rate for row in found] == pytest.approx(want, abs=1e-4)
        assert all(abs(row.copies - row.rate) < 2 for row in found)
    assert tilted


def test_op3_rows_that_nothing_tells_apart(spark):
    alike = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    others = spark.range(2_000).selectExpr("id as doc_id", "repeat('w ', cast(id % 50 as int)) as text", "'t' as source")
    got = mix_sources(alike.unionByName(others)).groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("copies").alias("copies")
    )
    for row in got.collect():
        assert row.n == {"s": 30_000, "t": 2_000}[row.source]
        assert row.taken == pytest.approx(row.target, rel=0.01) and row.copies <= 3


def plain_alignment(item, passage):
    before, best = [0] * (len(passage) + 1), 0
    for word in item:
        row = [0]
        for k, other in enumerate(passage):
            row.append(max(0, before[k] + (2 if word == other else -1), before[k + 1] - 1, row[k] - 1))
        before, best = row, max(best, *row)
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=9), st.lists(st.integers(1, 4), min_size=1, max_size=14)), min_size=1, max_size=5))
def test_op10_alignment(pairs):
    score, _ = smith_waterman([np.array(a, np.int64) for a, _ in pairs], [np.array(b, np.int64) for _, b in pairs])
    assert score.tolist() == [plain_alignment(a, b) for a, b in pairs]


def words_of(text, numbers):
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").lower().encode())
    return np.array([numbers.setdefault(word, len(numbers) + 1) for word in found], np.int64)


def all_pairs(texts, items):
    """Every document aligned with every item, whole texts: the pairs that count."""
    numbers = {}
    documents = sorted(((i, words_of(text, numbers)) for i, text in texts.items()), key=lambda x: len(x[1]))
    documents = [(i, words) for i, words in documents if len(words)]
    out = set()
    for item_id, text in items.items():
        item = words_of(text, numbers)
        for at in range(0, len(documents) if len(item) else 0, 32):
            group = documents[at : at + 32]
            score, _ = smith_waterman([item] * len(group), [words for _, words in group])
            out |= {(i, item_id) for (i, _), s in zip(group, score.tolist(), strict=True) if s >= len(item) or s >= 100}
    return out


def test_op10_beside_all_pairs(spark, texts):
    items = {row.item_id: row.text for row in table(spark, "benchmark").collect()}
    want = all_pairs(texts, items)
    got = {(row.doc_id, row.item_id) for row in QUERIES["op10_decontamination"](spark, SF_DIR).collect()}
    assert want and got <= want
    assert len(got) >= 0.95 * len(want)


def test_op10_edits_at_several_rates(spark, texts):
    rng = random.Random(4)
    items = {row.item_id: row.text for row in table(spark, "benchmark").collect() if row.text and len(row.text.split()) >= 20}
    vocabulary = " ".join(texts.values()).split()
    planted = {}
    for rate in (0.05, 0.1, 0.2, 0.3):
        for _ in range(30):
            words = [rng.choice(vocabulary) if rng.random() < rate else word for word in rng.choice(list(items.values())).split()]
            filler = [[rng.choice(vocabulary) for _ in range(80)] for _ in range(2)]
            planted[len(planted)] = " ".join([*filler[0], *words, *filler[1]])
    want = all_pairs(planted, items)
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    found = find_contamination(docs.unionByName(table(spark, "documents").selectExpr("doc_id + 1000 as doc_id", "text")), table(spark, "benchmark"))
    got = {(row.doc_id, row.item_id) for row in found.where("doc_id < 1000").collect()}
    assert len({i for i, _ in want}) > 60
    assert len(got & want) >= 0.9 * len(want)


def test_pipeline_keeps_one_of_each_family(spark):
    docs = corpus_pipeline.line_dedup(spark, table(spark, "documents"), SF_DIR)
    kept = {row.doc_id for row in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()}
    assert kept == plain_survivors({row.doc_id: row.text for row in docs.collect()})
