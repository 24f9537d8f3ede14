"""Toxicity: a sparse linear classifier with counterfactual regularisation.

A text is the set of its words, their beginnings and their inner four-grams,
hashed. The weights minimise the logistic loss, an L1 norm that leaves most of
them zero, and a counterfactual penalty: in labelled sentences that name a group
of people, each term is swapped for another of its kind, and the squared change
of the score is added. What a sentence says about a group then counts, which
group it is does not, and a neutral mention costs nothing.

The terms are a parameter, a list of kinds by default. To them come pairs found in
the labelled rows themselves: words that stand about as often under either label
and among the same neighbours, so that a corpus in any language, or one that names
other groups than the list, has sentences to swap in. A word that tells the labels
apart is never taken for a term.

The fit uses a bounded sample (``per_label`` rows of each label) whose features
are computed by Spark; it runs in one task and weighs both labels alike, so that
0.5 is where they part. Scoring reads every whole text once, in its own task, and
looks up weights that are not zero.

Defined cases: a null text is an empty text; an empty text scores by the
intercept alone; documents with several labels give a row for each; labels that
are null are not learned from; without labelled rows of both kinds the score is
the share of toxic labels, or near 0 without any. Other columns are untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowvigil.llm import tokens as tk
from flowvigil.llm.sampling_rows import bounded_sample
from flowvigil.llm.store import stored

#: Hashed features.
BUCKET_BITS = 20
PREFIXES = (4, 5, 6)
GRAM = 4
#: Rows of each label that a word must stand in to be taken for a term, the share of
#: all rows it may stand in (beyond it are words of grammar), and how far its shares
#: under the labels may differ.
TERM_ROWS = 3
TERM_SHARE = 0.2
TERM_BALANCE = 1.5

#: Terms for groups of people that stand for one another, by kind.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young", "elderly"),
    ("deaf", "blind", "disabled"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
)
_SENTENCE = re.compile(r"[^.!?\n]+")


@dataclass(frozen=True)
class ToxicityModel:
    """Features with a weight, the weights, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def _features(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None):
    """Owners and feature numbers of texts, repeats included; ``keep`` marks those wanted."""
    starts, ends = tk.word_spans(data, offsets, tk.WORD_BYTES)
    sums = tk.prefix_sums(data)
    owner = tk.owners(starts, offsets)
    shift = np.uint64(64 - BUCKET_BITS)
    owners, numbers = [], []

    def add(who: np.ndarray, low: np.ndarray, high: np.ndarray, kind: int) -> None:
        salt = tk.mix(np.array([kind + 1], np.uint64))[0]
        number = (tk.mix(tk.span_hashes(sums, low, high) + salt) >> shift).astype(np.int32)
        if keep is not None:
            chosen = keep[number]
            who, number = who[chosen], number[chosen]
        owners.append(who)
        numbers.append(number)

    add(owner, starts, ends, 0)
    for k, size in enumerate(PREFIXES):
        long = ends - starts > size
        add(owner[long], starts[long], starts[long] + size, k + 1)
    inside = np.ones(len(data), bool)
    inside[~tk.WORD_BYTES[data]] = False
    run = inside.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    for k in range(1, GRAM):
        run[: len(data) - k] &= inside[k:] & ~edge[k : len(data)]
        run[max(0, len(data) - k) :] = False
    at = np.flatnonzero(run)
    add(tk.owners(at, offsets), at, at + GRAM, len(PREFIXES) + 1)
    return np.concatenate(owners), np.concatenate(numbers)


def _distinct(owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair = np.unique((owner.astype(np.int64) << BUCKET_BITS) | number)
    return pair >> BUCKET_BITS, (pair & ((1 << BUCKET_BITS) - 1)).astype(np.int32)


def _set_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return np.unique(_features(data, np.array([0, len(data)]))[1])


class Swaps:
    """Each term and the next one of its kind, round in a circle; the first kind of a term counts."""

    def __init__(self, kinds: Sequence[Sequence[str]] = IDENTITY_TERMS) -> None:
        self.next: dict[str, str] = {}
        for kind in kinds:
            for k, term in enumerate(kind):
                self.next.setdefault(term, kind[(k + 1) % len(kind)])

    def __bool__(self) -> bool:
        return bool(self.next)

    def pattern(self) -> re.Pattern:
        return re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(self.next, key=len, reverse=True))) + r")\b")


def counterfactuals(text: str, swaps: Swaps, term: re.Pattern) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each sentence that holds a term: features that a swap of terms adds and removes."""
    for sentence in _SENTENCE.findall(text.lower()):
        if term.search(sentence):
            before = _set_of(sentence)
            after = _set_of(term.sub(lambda match: swaps.next[match[0]], sentence))
            yield np.setdiff1d(after, before), np.setdiff1d(before, after)


def _shares(rows: DataFrame, words: str) -> DataFrame:
    """``word, n0, n1``: rows of each label that hold a word."""
    held = rows.select("label", F.explode(F.array_distinct(words)).alias("word"))
    return held.groupBy("word").agg(
        *[F.count(F.when(F.col("label") == label, True)).alias(f"n{label}") for label in (0, 1)]
    )


def found_pairs(rows: DataFrame, known: Sequence[str] = (), most: int = 64) -> list[tuple[str, str]]:
    """Pairs of words of the labelled rows (``label, text``) that stand for one another.

    At most ``most`` words, those that are most frequent under the label that has
    them less often; the two words with the most similar neighbours (cosine of the
    logarithms of counts) are the first pair, and so on. Only counts of these words
    reach the driver. Ties go by the words.
    """
    spelled = rows.select(
        "label", F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}{3,}"), F.lit(0)).alias("words")
    )
    size = {row["label"]: row["count"] for row in spelled.groupBy("label").count().collect()}
    if most < 2 or not size.get(0) or not size.get(1):
        return []
    share = [F.col(f"n{label}") / size[label] for label in (0, 1)]
    both = _shares(spelled, "words").where(
        (F.least("n0", "n1") >= TERM_ROWS)
        & (F.greatest(*share) <= F.least(*share) * TERM_BALANCE)
        & (F.col("n0") + F.col("n1") <= TERM_SHARE * (size[0] + size[1]))
        & ~F.col("word").isin(list(known))
    )
    chosen = [row["word"] for row in both.orderBy(F.desc(F.least(*share)), "word").limit(most).select("word").collect()]
    before = F.concat(F.array(F.lit(None).cast("string")), "words").alias("before")
    after = F.slice("words", F.lit(2), F.size("words")).alias("after")
    placed = spelled.select(F.inline(F.arrays_zip(before, F.col("words").alias("word"), after)))
    sides = [F.struct(F.lit(side).alias("side"), F.col(side).alias("other")) for side in ("before", "after")]
    beside = (
        placed.where(F.col("word").isin(chosen)).select("word", F.inline(F.array(*sides))).where("other is not null")
    )
    weights = beside.groupBy("word", "side", "other").agg(F.log1p(F.count(F.lit(1))).alias("weight"))
    norms = {row["word"]: row["norm"] for row in weights.groupBy("word").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm")).collect()}
    # At most ``most`` words share a neighbour.
    second = weights.select(F.col("word").alias("second"), "side", "other", F.col("weight").alias("weight2"))
    shared = (
        weights.join(second, ["side", "other"]).where("word < second")
        .groupBy("word", "second").agg(F.sum(F.col("weight") * F.col("weight2")).alias("dot")).collect()
    )
    alike = [(-round(row["dot"] / (norms[row["word"]] * norms[row["second"]]), 9), row["word"], row["second"]) for row in shared]
    pairs, taken = [], set()
    for _, one, other in sorted(alike):
        if one not in taken and other not in taken:
            pairs.append((one, other))
            taken |= {one, other}
    return pairs


_EXAMPLE = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("plus", T.ArrayType(T.IntegerType())),
        T.StructField("minus", T.ArrayType(T.IntegerType())),
        T.StructField("order", T.LongType()),
    ]
)


def _order(plus: np.ndarray, minus: np.ndarray) -> int:
    """Hash of a pair of sets, by which examples are put in order."""
    found = hashlib.blake2b(plus.tobytes() + b"-" + minus.tobytes(), digest_size=8).digest()
    return int.from_bytes(found, "little", signed=True)


def _examples(rows: DataFrame, swaps: Swaps) -> DataFrame:
    """``label, text`` to feature sets and their order; pairs for the penalty have a null label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term = swaps.pattern()
        for batch in batches:
            label, plus, minus = [], [], []
            for at, to, data, offsets in tk.slices(pc.utf8_lower(batch.column(1))):
                owner, number = _distinct(*_features(data, offsets))
                edges = np.searchsorted(owner, np.arange(to - at + 1))
                label += batch.column(0)[at:to].to_pylist()
                plus += [number[edges[k] : edges[k + 1]] for k in range(to - at)]
                minus += [number[:0]] * (to - at)
            for text in batch.column(1).to_pylist() if swaps else []:
                for added, removed in counterfactuals(text or "", swaps, term):
                    label.append(None)
                    plus.append(added)
                    minus.append(removed)
            kind = pa.list_(pa.int32())
            order = [_order(*sets) for sets in zip(plus, minus, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(plus, kind), pa.array(minus, kind), pa.array(order, pa.int64())],
                names=_EXAMPLE.names,
            )

    return rows.select(F.col("label").cast("int"), "text").mapInArrow(run, _EXAMPLE)


@dataclass(frozen=True)
class _Sets:
    """Sets of features one after the other: ``edges`` says where each begins in ``values``."""

    edges: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> _Sets:
        edges = np.concatenate([[0], np.cumsum([len(one) for one in sets])]).astype(np.int64)
        return cls(edges, np.concatenate(sets) if sets else np.empty(0, np.int32))

    @classmethod
    def of_column(cls, column: pa.ChunkedArray) -> _Sets:
        lengths = pc.list_value_length(column).to_numpy()
        values = pc.list_flatten(column).to_numpy()
        return cls(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), values)

    def each(self) -> list[np.ndarray]:
        return [self.values[a:b] for a, b in zip(self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True)]


class _Rows:
    """Sparse rows with equal entries, over screened features."""

    def __init__(self, sets: _Sets, place: np.ndarray) -> None:
        self.n = len(sets.edges) - 1
        column = place[sets.values]
        keep = column >= 0
        self.row = np.repeat(np.arange(self.n), np.diff(sets.edges))[keep]
        self.column = column[keep].astype(np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], width)


def _screen(rows: list[np.ndarray], label: np.ndarray, screened: int, min_documents: int) -> np.ndarray:
    """Features whose share of documents differs most between the labels, in order."""
    size = 1 << BUCKET_BITS
    each = [
        np.bincount(np.concatenate([r for r, y in zip(rows, label, strict=True) if y == v]), minlength=size)
        for v in (0, 1)
    ]
    n = [(label == v).sum() for v in (0, 1)]
    pooled = (each[0] + each[1] + 1.0) / (n[0] + n[1] + 2.0)
    score = np.abs(each[1] / n[1] - each[0] / n[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    score[(each[0] + each[1]) < min_documents] = 0
    best = np.argsort(-score, kind="stable")[:screened]
    return np.sort(best[score[best] > 1.0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(examples: list[tuple[int | None, np.ndarray, np.ndarray]], **settings) -> ToxicityModel:
    """:func:`fit_sets` for examples in a list: label and set of features, or no label and what a swap adds and removes."""
    labelled = [(label, plus) for label, plus, _ in examples if label is not None]
    swaps = [(plus, minus) for label, plus, minus in examples if label is None]
    return fit_sets(
        np.array([label for label, _ in labelled], np.float64),
        _Sets.of([plus for _, plus in labelled]),
        _Sets.of([plus for plus, _ in swaps]),
        _Sets.of([minus for _, minus in swaps]),
        **settings,
    )


def fit_sets(
    label: np.ndarray,
    held: _Sets,
    gained: _Sets,
    lost: _Sets,
    l1: float = 1e-3,
    fairness: float = 2.0,
    steps: int = 300,
    screened: int = 20_000,
    min_documents: int = 3,
) -> ToxicityModel:
    """Accelerated proximal gradient on the loss, the penalty and the L1 norm.

    Labelled rows hold features; swapped sentences have gained and lost some.
    Weights are fitted for the ``screened`` features that tell the labels apart
    best, of those in at least ``min_documents`` rows.
    """
    if not len(label) or label.min() == label.max():
        share = label.mean() if len(label) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.empty(0, np.int32), np.empty(0), float(np.log(share / (1 - share))))
    features = _screen(held.each(), label, screened, min_documents)
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[features] = np.arange(len(features))
    x, added, removed = (_Rows(sets, place) for sets in (held, gained, lost))
    balance = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum())
    width = len(features)
    w = v = np.zeros(width)
    b = c = 0.0
    momentum, rate = 1.0, 1.0

    def loss(weights: np.ndarray, bias: float):
        z = x.times(weights) + bias
        change = added.times(weights) - removed.times(weights)
        value = (balance * np.logaddexp(0, np.where(label == 1, -z, z))).sum()
        penalty = fairness * (change**2).mean() if len(change) else 0.0
        error = balance * (_sigmoid(z) - label)
        slope = x.back(error, width)
        if len(change):
            pull = 2 * fairness * change / len(change)
            slope = slope + added.back(pull, width) - removed.back(pull, width)
        return value + penalty, slope, error.sum()

    for _ in range(steps):
        value, slope, bias_slope = loss(v, c)
        while True:
            moved = v - rate * slope
            new = np.sign(moved) * np.maximum(np.abs(moved) - rate * l1, 0)
            new_b = c - rate * bias_slope
            gap, gap_b = new - v, new_b - c
            bound = value + slope @ gap + bias_slope * gap_b + (gap @ gap + gap_b**2) / (2 * rate)
            if loss(new, new_b)[0] <= bound + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = new + (momentum - 1) / after * (new - w)
        c = new_b + (momentum - 1) / after * (new_b - b)
        if np.abs(new - w).max(initial=0) < 1e-4 and abs(new_b - b) < 1e-4:
            w, b = new, new_b
            break
        w, b, momentum = new, new_b, after
    used = np.flatnonzero(w)
    return ToxicityModel(features[used].astype(np.int32), w[used], float(b))


_MODEL = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.IntegerType())),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()),
    ]
)


def _fitted(examples: DataFrame, settings: dict) -> ToxicityModel:
    """The fit in one task, whose rows are bounded by ``per_label``; the driver gets the weights alone."""

    def run(group: pa.Table) -> pa.Table:
        # The order of tasks is not that of the sums.
        group = group.sort_by([("label", "ascending"), ("order", "ascending")])
        known = pc.is_valid(group["label"])
        labelled, swapped = group.filter(known), group.filter(pc.invert(known))
        model = fit_sets(
            labelled["label"].to_numpy().astype(np.float64),
            _Sets.of_column(labelled["plus"]),
            _Sets.of_column(swapped["plus"]),
            _Sets.of_column(swapped["minus"]),
            **settings,
        )
        found = {"features": [model.features], "weights": [model.weights], "intercept": [model.intercept]}
        kinds = [pa.list_(pa.int32()), pa.list_(pa.float64()), pa.float64()]
        return pa.table([pa.array(found[name], kind) for name, kind in zip(_MODEL.names, kinds, strict=True)], names=_MODEL.names)

    one = examples.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(run, _MODEL).first()
    if one is None:
        return fit([], **settings)
    return ToxicityModel(np.array(one["features"], np.int32), np.array(one["weights"], np.float64), one["intercept"])


def training_rows(documents: DataFrame, labels: DataFrame, per_label: int, text: str = "text") -> DataFrame:
    """``label, text`` of at most ``per_label`` labelled documents of each label, stored."""
    known = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("label"))
    sample = bounded_sample(known, "label", "doc_id", per_label)
    # At most two labels times per_label rows.
    rows = documents.select("doc_id", F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    return stored(rows.select("label", "text"), "labelled")


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    per_label: int = 1500,
    text: str = "text",
    kinds: Sequence[Sequence[str]] = IDENTITY_TERMS,
    found_terms: int = 64,
    **settings,
) -> ToxicityModel:
    """Fit on a bounded sample of the rows of ``labels`` (``doc_id, toxic``).

    ``kinds`` are the terms that stand for one another; at most ``found_terms``
    words of the sample are added in pairs (:func:`found_pairs`).
    """
    rows = training_rows(documents, labels, per_label, text)
    listed = [term for kind in kinds for term in kind]
    swaps = Swaps([*kinds, *found_pairs(rows, listed, found_terms)])
    return _fitted(_examples(rows, swaps), settings)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score of each text, 0 to 1."""
    features, weights, intercept = model.features, model.weights, model.intercept

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        weight = np.zeros(1 << BUCKET_BITS, np.float32)
        weight[features] = weights
        keep = weight != 0
        out = np.full(len(texts), intercept)
        for at, to, data, offsets in tk.slices(pc.utf8_lower(texts)):
            owner, number = _distinct(*_features(data, offsets, keep))
            out[at:to] += np.bincount(owner, weight[number], to - at)
        return pa.array(_sigmoid(out))

    return score(F.coalesce(text, F.lit("")))
