"""The numpy kernels beside plain Python."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowvigil.llm import language as lang
from flowvigil.llm import multiset_hash as mh
from flowvigil.llm import toxicity as tox
from flowvigil.llm.decontaminate import smith_waterman
from flowvigil.llm.simhash import cells, embed, part_bits, parts_for
from flowvigil.llm.substring_dedup import NONE, least_documents
from flowvigil.llm.suffix_arrays import common_prefixes, suffix_array


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=200), st.lists(st.integers(0, 199), max_size=4))
def test_suffix_array_and_prefixes(raw, cuts):
    data = np.frombuffer(raw, np.uint8)
    order, place = suffix_array(data)
    assert order.tolist() == sorted(range(len(raw)), key=lambda k: raw[k:])
    lanes = np.array(sorted({0, *[c for c in cuts if c < len(raw)]}))
    shared = common_prefixes(data, order, place, 50, lanes)

    def both(a, b):
        n = 0
        while n < 50 and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    assert shared.tolist() == [0, *[both(order[k - 1], order[k]) for k in range(1, len(raw))]]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=5, max_size=12), min_size=1, max_size=12), st.integers(6, 60))
def test_shards_agree_with_plain_minimum(pieces, shard):
    raw = [piece.encode() for piece in pieces]
    ids = np.arange(100, 100 + len(raw))[::-1].copy()
    least = {}
    for piece, doc in zip(raw, ids.tolist(), strict=True):
        for k in range(len(piece) - 4):
            least[piece[k : k + 5]] = min(doc, least.get(piece[k : k + 5], NONE))
    got = least_documents(raw, ids, window=5, shard=shard)
    assert got.tolist() == [least[piece[k : k + 5]] for piece in raw for k in range(len(piece) - 4)]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1), st.sets(st.integers(0, 127), max_size=26), st.sampled_from([(4, 1, 2), (4, 1, 1), (4, 1, 3), (20, 2, 1), (26, 2, 1), (9, 1, 2), (2, 1, 2)]))
def test_fingerprints_within_the_radius_meet_in_a_cell(a, b, flips, setting):
    radius, words, bits = setting
    flips = sorted(bit for bit in flips if bit < 64 * words)[:radius]
    left = np.array([[a], [b]][:words], np.uint64)
    right = left.copy()
    for bit in flips:
        right[bit // 64] ^= np.uint64(1 << bit % 64)
    counts = [sum(np.abs(embed(left, *part, bits) - embed(right, *part, bits)).sum() for part in part_bits(parts_for(radius), words))]
    assert counts[0] <= len(flips)
    met = False
    for k, part in enumerate(part_bits(parts_for(radius), words)):
        met |= bool(set(cells(left, k, part, bits, True)[1]) & set(cells(right, k, part, bits, True)[1]))
    assert met


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("xy \n", max_size=12), max_size=6), st.text("xyz ", max_size=10))
def test_fingerprints_add_up(lines, paragraph):
    paragraph = paragraph.replace("\n", "")
    lines = [line.replace("\n", "") for line in lines] or ["x"]
    if lines == [""]:
        lines = ["x"]
    of = lambda found: mh.to_text(mh.fingerprint_vectors(["\n".join(found)]))[0]
    assert of(lines) == of(lines[::-1])
    assert mh.insert(of(lines), paragraph) == of([*lines, paragraph])
    assert mh.delete(of([*lines, paragraph]), paragraph) == of(lines)


def test_alignment_scores():
    words = lambda text: np.array([ord(c) for c in text], np.int64)
    score, end = smith_waterman(
        [words("abcdef"), words("abcdef"), words("abcdef"), words("abc")],
        [words("xxabcdefyy"), words("abcxdef"), words("zzz"), words("ac")],
    )
    assert score.tolist() == [12, 11, 0, 3]
    assert end.tolist() == [8, 7, 0, 2]


def test_backpropagation_matches_differences():
    model = lang.new_model(["a", "b", "c"], hidden=3)
    rng = np.random.default_rng(0)
    for array in model.arrays():
        array[...] = rng.standard_normal(array.shape) * 0.4
    double = [array.astype(np.float64) for array in model.arrays()]
    model.forward = lang.Direction(*double[:3])
    model.backward = lang.Direction(*double[3:6])
    model.out, model.bias = double[6:]
    x = rng.integers(0, 5, (6, 4)).astype(np.uint8)
    live = np.ones((6, 4))
    live[4:, 1] = 0
    label = np.array([0, 1, 2, 1])
    _, slopes = lang.gradients(model, x, label, live)
    for array, slope in zip(model.arrays(), slopes, strict=True):
        spot = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        keep = array[spot]
        values = []
        for step in (1e-3, -1e-3):
            array[spot] = keep + step
            values.append(lang.gradients(model, x, label, live)[0])
        array[spot] = keep
        assert slope[spot] == pytest.approx((values[0] - values[1]) / 2e-3, rel=2e-2, abs=1e-5)


def test_windows_pool_over_whole_texts():
    model = lang.fit([b"aaaa bbbb", b"zzzz yyyy"] * 8, ["x", "y"] * 8, steps=60)
    texts = ["aab bba" * 100, "zyz yzz", "", "aab" * 5 + "zyz yzz" * 200]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    pooled = lang.text_probabilities(model, data, offsets)
    assert pooled.argmax(axis=1).tolist()[:2] == [0, 1] and pooled[2].sum() == 0 and pooled[3].argmax() == 1
    assert pooled[[0, 1, 3]].sum(axis=1) == pytest.approx(1, abs=1e-4)
    runs = lang.label_positions(model, texts[3])
    assert runs[0][0] == 0 and runs[-1][1] == len(texts[3])


def examples(pairs):
    out, swaps = [], tox.Swaps()
    for text, label in pairs:
        out.append((label, tox._set_of(text), np.empty(0, np.int32)))
        out += [(None, plus, minus) for plus, minus in tox.counterfactuals(text, swaps, swaps.pattern())]
    return out


def test_swaps_go_round():
    swaps = tox.Swaps([("a.b", "c"), ("d", "e", "f"), ("c", "x")])
    assert swaps.next == {"a.b": "c", "c": "a.b", "d": "e", "e": "f", "f": "d", "x": "c"}
    assert swaps.pattern().sub(lambda m: swaps.next[m[0]], "aab c-d fx f") == "aab a.b-e fx d"
    assert not tox.Swaps([])


def plain_fit(x, y, change, l1, fairness, steps=20_000):
    """The same objective by plain proximal gradient with a small fixed step."""
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    step = 1 / (0.25 * np.linalg.norm(np.column_stack([x, np.ones(len(x))]).T * np.sqrt(weight), 2) ** 2
                + 2 * fairness * np.linalg.norm(change, 2) ** 2 / len(change))
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
        moved = w - step * (x.T @ error + 2 * fairness / len(change) * change.T @ (change @ w))
        b -= step * error.sum()
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
    z = x @ w + b
    return (weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum() + l1 * np.abs(w).sum() + fairness * ((change @ w) ** 2).mean()


def test_the_fit_reaches_the_optimum():
    rng = np.random.default_rng(5)
    x = (rng.random((80, 12)) < 0.4).astype(float)
    y = (x[:, 0] + x[:, 1] + rng.random(80) > 1.3).astype(float)
    change = np.sign(rng.normal(size=(30, 12))) * (rng.random((30, 12)) < 0.2)
    rows = [(int(label), np.flatnonzero(row).astype(np.int32), np.empty(0, np.int32)) for row, label in zip(x, y, strict=True)]
    rows += [(None, np.flatnonzero(c > 0).astype(np.int32), np.flatnonzero(c < 0).astype(np.int32)) for c in change]
    for fairness in (0.0, 2.0):
        model = tox.fit(rows, l1=5e-3, fairness=fairness, steps=3000)
        w = np.zeros(12)
        w[model.features] = model.weights
        screened = tox._screen([r[1] for r in rows[:80]], y, 20_000, 3)
        kept = np.zeros(12, bool)
        kept[screened] = True
        weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
        z = x @ w + model.intercept
        ours = (weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum() + 5e-3 * np.abs(w).sum() + fairness * ((change @ w) ** 2).mean()
        assert abs(ours - plain_fit(x[:, kept], y, change[:, kept], 5e-3, fairness)) < 1e-4


def test_swapped_terms_lose_their_weight():
    """Neutral mentions of a group that stands in most toxic sentences of the sample."""
    rng = np.random.default_rng(3)
    filler = [f"plain{k}" for k in range(40)]
    pairs = []
    for k in range(120):
        words = list(rng.choice(filler, 6))
        toxic = k % 2
        if toxic:
            words += [("awful", "nasty", "vile")[k // 2 % 3]]
        if toxic and k % 5 or k % 20 == 0:
            words += ["muslims"]
        pairs.append((" ".join(words), toxic))
    score = lambda model, text: model.weights[np.isin(model.features, tox._set_of(text))].sum() + model.intercept
    without = tox.fit(examples(pairs), fairness=0.0)
    held = tox.fit(examples(pairs), fairness=20.0)
    neutral = "the muslims live here"
    lift = lambda model: score(model, neutral) - score(model, "the people live here")
    assert lift(held) < 0.5 * lift(without)
    assert score(held, "awful nasty vile plain1") > 0 > score(held, neutral)
