"""Nearest neighbours, importance resampling and the prefix trie beside brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowvigil.llm.importance import Resampling, bucket_numbers, importance_resample, splitter, word_offsets
from flowvigil.llm.nn_descent import Graph, nearest_neighbours
from flowvigil.llm.prefix_trie import numbered_turns, prefix_trie, subtree_totals
from flowvigil.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_nearest(rows, queries, n):
    """By definition, over vectors that take part."""
    own = {}
    for i, v in rows:
        if i is not None and v and any(v) and all(x is not None and math.isfinite(x) for x in v):
            own[i] = min(own.get(i, v), v)
    most = max(Counter(map(len, own.values())).items(), key=lambda x: (x[1], x[0]))[0] if own else 0
    own = {i: v for i, v in own.items() if len(v) == most}
    out = {}
    for q in own:
        if not queries(q):
            continue
        scored = []
        for i, v in own.items():
            if i != q:
                a, b = np.array(own[q]), np.array(v)
                scored.append((-(a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:n]]
    return out


def got_nearest(df, *args, **kwargs):
    out = {}
    for row in sorted(nearest_neighbours(df, *args, **kwargs).collect(), key=lambda row: (row.query_id, row["rank"])):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


def test_nearest_odd_vectors(spark):
    rng = random.Random(1)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    rows = [(k, v) for k, v in enumerate(base)]
    rows += [(100 + k, base[0]) for k in range(20)] + [(200 + k, [2 * x for x in base[0]]) for k in range(3)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] + [0.0] * 6), (304, [float("nan")] * 8), (305, [float("inf")] * 8)]
    rows += [(306, [1.0, 2.0]), (None, base[1]), (2, base[2]), (2, base[5]), (310, [x * 1e-200 for x in base[3]]), (310 + 50, [x * 1e200 for x in base[3]])]
    df = spark.createDataFrame([(i, v, "n", 1.0) for i, v in rows], "vec_id long, embedding array<double>, node string, score double")
    got = got_nearest(df.repartition(4), F.col("vec_id") % 10 == 0)
    scaled = [(i, [x / max(map(abs, v)) for x in v] if i in (310, 360) else v) for i, v in rows]
    want = plain_nearest(scaled, lambda i: i % 10 == 0, 5)
    assert set(got) == set(want)
    for q, answers in want.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in answers])
        assert [i for i, _ in got[q]] == [i for i, _ in answers] or q in (310, 360)
    assert [i for i, _ in got[0]] == [100, 101, 102, 103, 104]
    assert nearest_neighbours(df.where("false"), F.lit(True)).collect() == []
    assert got_nearest(df.where("vec_id in (1, 3)"), F.lit(True), n=5).keys() == {1, 3}


def test_nearest_recall_with_short_lists(spark):
    """Lists and beams far shorter than the table, so that rounds and search have work to do."""
    draw = np.random.default_rng(3)
    centres = draw.standard_normal((12, 16))
    vectors = centres[draw.integers(0, 12, 800)] + 0.5 * draw.standard_normal((800, 16))
    vectors[500:700] = vectors[500] + 1e-4 * draw.standard_normal((200, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    settings = Graph(neighbours=16, orders=4, block=32, first=6, beam=64)
    got = got_nearest(df, F.col("vec_id") % 50 == 0, settings=settings)
    want = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    hits = [i in {i for i, _ in got[q]} for q, answers in want.items() for i, _ in answers]
    assert np.mean(hits) >= 0.9
    for q, answers in got.items():
        for i, score in answers:
            a, b = vectors[q], vectors[i]
            assert score == pytest.approx(a @ b / math.sqrt((a @ a) * (b @ b)), abs=1e-12)


def test_op11_recall(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    got = {}
    for row in QUERIES["op11_nearest_neighbours"](spark, SF_DIR).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    assert np.mean([i in got[q] for q, answers in want.items() for i, _ in answers]) >= 0.9


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("longest", [1, 3])
def test_words_and_buckets(longest, monkeypatch):
    from flowvigil.llm import importance

    monkeypatch.setattr(importance, "PIECE_BYTES", 64)
    rng = random.Random(longest)
    split, settings = splitter(), Resampling(longest=longest, buckets=997)
    texts = ["", None, "ÀB\x00c 1_2\tß—x😀 Z", "é" * 300, "a" * 500 + " b"]
    texts += ["".join(rng.choice("aB9 _é\n😀-") for _ in range(rng.randrange(400))) for _ in range(60)]
    for text in texts:
        words = words_of(text)
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        assert [word for word, _ in word_offsets(split, low)] == words
        assert [low[a:b] for _, (a, b) in word_offsets(split, low)] == words
        n_words, numbers = bucket_numbers(text, settings, split, {})
        runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
        assert n_words == len(words)
        assert sorted(numbers.tolist()) == sorted(zlib.crc32(run.encode()) % 997 for run in runs)


def test_resampling_odd_documents(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.choice([3, 25, 60]))) for _ in range(80)]
    rows = [(k, text) for k, text in enumerate(texts)]
    rows += [(200, None), (201, ""), (202, "—"), (None, texts[5] * 9), (203, texts[0]), (203, texts[0]), (204, "word " * 50_000)]
    df = spark.createDataFrame([(i, t, 1, 2, "r") for i, t in rows], "doc_id long, text string, score int, weight int, packed string")
    target = spark.createDataFrame([("alpha alpha beta",), (None,), ("",)], "text string")
    got = importance_resample(df.repartition(3), target).collect()
    assert len(got) == len(rows)
    counts, wanted = Counter(), Counter(zlib.crc32(w.encode()) % 10_000 for w in ["alpha", "alpha", "beta"])
    for _, text in rows:
        counts.update(zlib.crc32(w.encode()) % 10_000 for w in words_of(text))
    s_all, t_all = counts.total(), wanted.total()
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((n + 1) * (t_all + 10_000)))) for b, n in counts.items()}
    want = []
    for doc_id, text in rows:
        own = [gain[zlib.crc32(w.encode()) % 10_000] for w in words_of(text)]
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(own) // len(own) if own else 0
        want.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    key = lambda row: (row[0] is None, row)
    assert sorted([tuple(row)[:4] for row in got], key=key) == sorted(want, key=key)
    enough = sorted([row for row in want if row[1] >= 20], key=lambda row: (-row[3], row[0] is not None, row[0] or 0))
    drawn = sorted([row for row in got if row["rank"] is not None], key=lambda row: row["rank"])
    assert [row["rank"] for row in drawn] == list(range(1, len(enough) // 10 + 1))
    assert [row.score for row in drawn] == [row[3] for row in enough[: len(drawn)]]
    assert importance_resample(df.where("false"), target).collect() == []
    assert len(importance_resample(df, target.where("false")).collect()) == len(rows)


def plain_trie(rows):
    """By definition."""
    conversations = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
            conversations.setdefault(c, []).append((key, (role, text)))
    own = {c: [turn for _, turn in sorted(turns)] for c, turns in conversations.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(found), len(node), parent, len(found), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_trie_odd_conversations(spark):
    rng = random.Random(9)
    first = ("user", "hello 😀")
    rows = [(c, 0, *first) for c in range(0, 130)]
    rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])) for c in range(0, 130) for t in range(1, rng.randrange(1, 7))]
    rows += [(900, t, "user", f"t{t}") for t in range(120)]
    rows += [(901, None, None, None), (901, None, "x", None), (901, 1, None, ""), (901, 1, None, ""), (None, 1, "u", "t"), (101, 0, *first)]
    df = spark.createDataFrame([(*row, 1, "i") for row in rows], "conv_id long, turn long, role string, text string, depth int, id string")
    got = sorted((tuple(row) for row in prefix_trie(df.repartition(5)).collect()), key=repr)
    assert got == plain_trie(rows)
    assert prefix_trie(df.where("false")).collect() == []


def test_turns_are_numbered_across_blocks(spark):
    rows = [(1, t * 700, "u", str(t)) for t in range(-4, 5)] + [(1, None, "u", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {row.turn_hash: row.pos for row in numbered_turns(df).collect()}
    order = ["n", *[str(t) for t in range(-4, 5)]]
    assert got == {hashlib.md5(f"1:u{text}".encode()).hexdigest(): k + 1 for k, text in enumerate(order)}


@pytest.mark.parametrize("shape", ["random", "forest"])
def test_contraction_of_any_shape(spark, shape):
    rng = random.Random(shape)
    n = 60
    parent = {
        "random": [None, *[rng.randrange(k) for k in range(1, n)]],
        # A chain and a star.
        "forest": [None if k % 30 == 0 else (k - 1 if k < 30 else k - k % 30) for k in range(n)],
    }[shape]
    children = Counter(p for p in parent if p is not None)
    value = [rng.randrange(9) for _ in range(n)]
    rows = [(k, parent[k], children[k], value[k], 1) for k in range(n)]
    tree = spark.createDataFrame(rows, "id long, parent long, n_children long, v long, one long")
    total, size = list(value), [1] * n
    for k in range(n - 1, -1, -1):
        if parent[k] is not None:
            total[parent[k]] += total[k]
            size[parent[k]] += size[k]
    got = sorted(tuple(row) for row in subtree_totals(tree, ["v", "one"]).collect())
    assert got == [(k, total[k], size[k]) for k in range(n)]
