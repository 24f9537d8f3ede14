"""The training-data queries at the smallest scale: beside SQL, or beside brute force."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from compare import TABLES, compare

import corpus_pipeline
from flowvigil.llm import toxicity as tox
from flowvigil.llm.queries import ORACLES, QUERIES
from flowvigil.llm.queries_models import fold

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    database = duckdb.connect()
    for table in TABLES:
        database.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return database


@pytest.fixture(scope="module")
def documents(connection):
    return connection.sql("select * from documents order by doc_id").fetchall()


@pytest.fixture(scope="module")
def texts(connection):
    return dict(connection.sql("select doc_id, text from documents").fetchall())


def rows(spark, name):
    return {row[0]: row for row in QUERIES[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    good, text = compare(spark, connection, name, SF_DIR)
    assert good, text


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_op1_edits(spark, texts):
    got = rows(spark, "op1_fingerprints")
    ids = sorted(texts)
    assert set(got) == set(ids)
    for k, doc_id in enumerate(ids):
        own, after = texts[doc_id], texts[ids[(k + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        assert got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc_id].n_chars == len(own)
    same = {(texts[i], got[i].fingerprint) for i in ids}
    assert len({text for text, _ in same}) == len(same)
    near = np.array([[row.near_edited, row.near_next] for row in got.values()])
    assert near.min() >= 0 and near.max() <= 1
    assert np.median(near[:, 0]) > 0.3 > 0.1 > np.median(near[:, 1])


def test_op2_held_out_accuracy(spark, connection):
    lang = dict(connection.sql("select doc_id, lang from documents").fetchall())
    got = rows(spark, "op2_language").values()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in got)
    held = [row.lang_pred == lang[row.doc_id] for row in got if row.held_out]
    assert np.mean(held) > 0.9


def water_fill(sizes):
    weight = {source: (5, 2, 1)[k % 3] for k, source in enumerate(sorted(sizes))}
    total, target, free = sum(sizes.values()), {}, set(sizes)
    while True:
        left = total - sum(target.values())
        share = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / share > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / share for s in free}
        target |= {s: 3 * sizes[s] for s in over}
        free -= over


def test_op3_targets_and_copies(spark, documents):
    got = rows(spark, "op3_entropy_mixing")
    size = {d[0]: len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in documents}
    by_source = Counter()
    for d in documents:
        by_source[d[3]] += size[d[0]]
    target = water_fill(by_source)
    taken = Counter()
    for d in documents:
        row = got[d[0]]
        assert (row.size, row.source_size) == (size[d[0]], by_source[d[3]])
        assert row.target == pytest.approx(target[d[3]])
        assert row.taken <= 3 * row.size and row.taken % max(1, row.size) == 0
        taken[d[3]] += row.taken
    for source, goal in target.items():
        assert abs(taken[source] - goal) < 0.05 * goal
    again = rows(spark, "op3_entropy_mixing")
    assert got == again


def test_op4_held_out(spark, connection):
    toxic = dict(connection.sql("select doc_id, toxic from labels").fetchall())
    got = rows(spark, "op4_toxicity")
    assert all(row.predicted == (row.score >= 0.5) for row in got.values())
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in got.values())
    right = [got[i].predicted == y for i, y in toxic.items() if i in got and got[i].held_out]
    assert right and np.mean(right) > 0.9


def test_op4_swaps_act_on_its_own_table(spark):
    """Training rows hold terms, and the penalty brings the scores of swapped sentences together."""
    folder = SF_DIR.replace("0.001", "0.01")
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    known = labels.where(fold(labels["doc_id"], 5) != 0)
    sample = tox.training_rows(documents, known, 1500)
    pairs = tox.found_pairs(sample)
    assert len(pairs) >= 5
    texts = [row.text or "" for row in sample.collect()]
    swaps = tox.Swaps(pairs)
    changes = [pair for text in texts for pair in tox.counterfactuals(text, swaps, swaps.pattern())]
    assert len(changes) > 100

    def change(fairness):
        model = tox.train_toxicity(documents, known, fairness=fairness)
        weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
        return np.mean(np.square([sum(weight.get(f, 0) for f in plus.tolist()) - sum(weight.get(f, 0) for f in minus.tolist()) for plus, minus in changes]))

    free, held = change(0.0), change(2.0)
    print("mean squared change", free, held)
    assert held < free


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    pieces = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(piece.encode(), 42) for piece in pieces]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_op5_components(spark, texts):
    got = rows(spark, "op5_simhash")
    ids = sorted(texts)
    prints = np.array([plain_fingerprint(texts[i]) for i in ids], np.uint64)
    assert [int(got[i].fingerprint, 16) for i in ids] == prints.tolist()
    linked = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    label = np.arange(len(ids))
    while True:
        new = np.where(linked, label[None, :], len(ids)).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert [got[i].component_id for i in ids] == [ids[k] for k in label]


def test_op9_removed_bytes(spark, texts):
    got = rows(spark, "op9_substring_dedup")
    seen = set()
    for doc_id in sorted(texts):
        raw = texts[doc_id].encode()
        strings = [raw[k : k + 50] for k in range(len(raw) - 49)]
        gone = np.zeros(len(raw), bool)
        for k, string in enumerate(strings):
            if string in seen:
                gone[k : k + 50] = True
        seen.update(strings)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
        assert tuple(got[doc_id])[1:5] == want


def test_op10_finds_exact_passages_and_nothing_far(spark, connection, texts):
    got = {(row.doc_id, row.item_id): row for row in QUERIES["op10_decontamination"](spark, SF_DIR).collect()}
    items = dict(connection.sql("select item_id, text from benchmark").fetchall())
    plain = lambda text: " ".join(re.findall(r"\w+", text.lower()))
    flat = {i: f" {plain(text)} " for i, text in texts.items()}
    exact = {(d, i) for i, item in items.items() for d, text in flat.items() if f" {plain(item)} " in text}
    assert exact and exact <= set(got)
    assert all(row.similarity >= 0.5 for row in got.values())
    for (d, i), row in got.items():
        words, own = set(plain(items[i]).split()), set(flat[d].split())
        assert len(words & own) >= 0.6 * len(words), row


def test_pipeline_stages(spark, connection, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        seen[name] = after.collect()
        if name != "mixing":
            assert after.columns == docs.columns
            before = spark.createDataFrame(seen[name], docs.schema)
    toxic = {i for i, y in connection.sql("select doc_id, toxic from labels").fetchall() if y == 1}
    ids = {name: {row.doc_id for row in found} for name, found in seen.items()}
    assert len(ids["toxicity"] & toxic) <= 0.1 * len(toxic)
    cut = {row.doc_id: row.text for row in seen["line_dedup"]}
    assert cut == plain_line_dedup({row.doc_id: row.text for row in seen["toxicity"]})
    assert ids["near_dedup"] <= ids["line_dedup"]
    assert len(set(cut.values())) >= len(ids["near_dedup"]) > 0.8 * len(set(cut.values()))
    assert ids["decontamination"] <= ids["near_dedup"]
    assert ids["mixing"] == ids["decontamination"]
    assert sum(row.taken for row in seen["mixing"]) == pytest.approx(sum(row.size for row in seen["mixing"]), rel=0.05)


def plain_line_dedup(texts):
    seen, out = set(), {}
    for doc_id in sorted(texts):
        lines = texts[doc_id].split("\n")
        windows = [tuple(lines[k : k + 3]) for k in range(len(lines) - 2)]
        gone = set()
        for k, window in enumerate(windows):
            if not "".join(window).strip(" "):
                continue
            if window in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(window)
        if len(gone) < len(lines):
            out[doc_id] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return out
