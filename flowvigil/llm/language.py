"""Language identification: a bidirectional gated recurrent network over bytes.

Two recurrent layers, one from each side, read the UTF-8 bytes; from both states
a softmax labels every position, and a document's probabilities are the mean
over its positions. Written in numpy: training is backpropagation through time
with Adam, inference reads windows of whole texts, thousands side by side.

The fit takes a bounded sample (``per_language`` documents of each language,
``WINDOWS`` windows of each) on the driver; it is the same on every run. Every
byte of every text is labelled. A window starts from empty states, so the first
bytes of a window are judged from their right context and the last ones from
their left.

Defined cases: a null text, and one without a letter, is ``und`` with score 0;
without training rows everything is ``und``; repeated rows are judged each for
itself; ties go to the language that comes first in code point order. Other
columns are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvigil.llm import tokens as tk
from flowvigil.llm.sampling_rows import bounded_sample

UNKNOWN = "und"
HIDDEN = 8
#: Bytes of a window in training and in use.
TRAIN_WINDOW = 64
WINDOW = 128
#: Training windows of a document, spread over it.
WINDOWS = 4
#: Windows that advance side by side.
SIDE_BY_SIDE = 4096


@dataclass
class Direction:
    """A gated recurrent layer; ``table`` holds the input weights of each byte."""

    table: np.ndarray  # 3 * hidden, 256: update, reset, candidate
    inner: np.ndarray  # 3 * hidden, hidden
    bias: np.ndarray  # hidden, 1: of the candidate's recurrent part

    def arrays(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.bias]


@dataclass
class LanguageModel:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # languages, 2 * hidden
    bias: np.ndarray  # languages, 1

    def arrays(self) -> list[np.ndarray]:
        return [*self.forward.arrays(), *self.backward.arrays(), self.out, self.bias]


def new_model(languages: list[str], hidden: int = HIDDEN, seed: int = 1) -> LanguageModel:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    def direction() -> Direction:
        return Direction(
            draw(3 * hidden, 256, scale=0.3), draw(3 * hidden, hidden, scale=hidden**-0.5), draw(hidden, 1, scale=0.1)
        )

    return LanguageModel(
        languages, direction(), direction(), draw(len(languages), 2 * hidden, scale=0.3),
        np.zeros((len(languages), 1), np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _step(layer: Direction, bytes_now: np.ndarray, state: np.ndarray):
    hidden = len(layer.bias)
    given = np.take(layer.table, bytes_now, axis=1)
    held = layer.inner @ state
    gates = _sigmoid(given[: 2 * hidden] + held[: 2 * hidden])
    update, reset = gates[:hidden], gates[hidden:]
    carried = held[2 * hidden :] + layer.bias
    candidate = np.tanh(given[2 * hidden :] + reset * carried)
    return candidate + update * (state - candidate), update, reset, carried, candidate


def _states(layer: Direction, x: np.ndarray, live: np.ndarray | None, back: bool, trace: list | None = None):
    """States after each position, in the order of positions; ``live`` is 0 past a window's end."""
    steps, side = x.shape
    out = np.empty((steps, len(layer.bias), side), np.float32)
    state = np.zeros((len(layer.bias), side), np.float32)
    for t in reversed(range(steps)) if back else range(steps):
        before = state
        state, *kept = _step(layer, x[t], before)
        if live is not None:
            state = state * live[t]
        if trace is not None:
            trace.append((t, before, *kept))
        out[t] = state
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=-2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-2, keepdims=True)
    return logits


def position_probabilities(model: LanguageModel, x: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
    """Probabilities of each language at each position: positions, languages, windows."""
    hidden = len(model.forward.bias)
    ahead = _states(model.forward, x, live, back=False)
    behind = _states(model.backward, x, live, back=True)
    logits = model.out[:, :hidden] @ ahead
    logits += model.out[:, hidden:] @ behind
    logits += model.bias
    return _softmax(logits)


def _back_through_time(layer: Direction, x: np.ndarray, trace: list, slope: np.ndarray, live: np.ndarray | None):
    """Gradients of the layer's arrays; ``slope`` is that of the loss in each state."""
    hidden, side = len(layer.bias), x.shape[1]
    inner, bias = np.zeros_like(layer.inner), np.zeros_like(layer.bias)
    gates = np.empty((len(trace), 3 * hidden, side), np.float32)
    later = np.zeros((hidden, side), np.float32)
    for t, before, update, reset, carried, candidate in reversed(trace):
        total = slope[t] + later
        if live is not None:
            total = total * live[t]
        d_candidate = total * (1 - update) * (1 - candidate * candidate)
        d_update = total * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * carried * reset * (1 - reset)
        recurrent = np.concatenate([d_update, d_reset, d_candidate * reset])
        inner += recurrent @ before.T
        bias += recurrent[2 * hidden :].sum(axis=1, keepdims=True)
        later = total * update + layer.inner.T @ recurrent
        gates[t, : 2 * hidden] = recurrent[: 2 * hidden]
        gates[t, 2 * hidden :] = d_candidate
    flat = x.ravel()
    table = np.stack([np.bincount(flat, gates[:, k].ravel(), 256) for k in range(3 * hidden)])
    return [table.astype(np.float32), inner, bias]


def gradients(model: LanguageModel, x: np.ndarray, label: np.ndarray, live: np.ndarray):
    """Mean loss over live positions, and its gradient in each of ``model.arrays()``."""
    hidden = len(model.forward.bias)
    ahead_trace: list = []
    behind_trace: list = []
    ahead = _states(model.forward, x, live, False, ahead_trace)
    behind = _states(model.backward, x, live, True, behind_trace)
    state = np.concatenate([ahead, behind], axis=1)
    probability = _softmax(model.out @ state + model.bias)
    side = np.arange(len(label))
    count = live.sum()
    right = np.maximum(probability[:, label, side], 1e-9)
    loss = float(-(np.log(right) * live).sum() / count)
    probability[:, label, side] -= 1
    probability *= (live / count)[:, None, :]
    out = np.einsum("tlb,thb->lh", probability, state, optimize=True)
    bias = probability.sum(axis=(0, 2))[:, None]
    slope = model.out.T @ probability
    return loss, [
        *_back_through_time(model.forward, x, ahead_trace, slope[:, :hidden], live),
        *_back_through_time(model.backward, x, behind_trace, slope[:, hidden:], live),
        out,
        bias,
    ]


def fit(windows: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = 240, side: int = 192, seed: int = 1) -> LanguageModel:
    """Train on labelled windows of text; batches of ``side`` windows, Adam, falling rate."""
    languages = sorted(set(labels))
    model = new_model(languages, hidden, seed)
    if len(languages) < 2:
        return model
    number = np.array([languages.index(label) for label in labels])
    x = np.zeros((TRAIN_WINDOW, len(windows)), np.uint8)
    live = np.zeros((TRAIN_WINDOW, len(windows)), np.float32)
    for k, window in enumerate(windows):
        found = np.frombuffer(window[:TRAIN_WINDOW], np.uint8)
        x[: len(found), k] = found
        live[: len(found), k] = 1
    rng = np.random.default_rng(seed)
    arrays = model.arrays()
    mean, spread = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
    by_language = [np.flatnonzero(number == k) for k in range(len(languages))]
    each = max(1, side // len(languages))
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(own, each) for own in by_language])
        _, slopes = gradients(model, x[:, chosen], number[chosen], live[:, chosen])
        rate = 0.02 * (1 - step / (steps + 1)) + 5e-4
        size = np.sqrt(sum(float((s**2).sum()) for s in slopes))
        for k, (array, slope) in enumerate(zip(arrays, slopes, strict=True)):
            slope = slope * min(1.0, 1.0 / max(size, 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            spread[k] = 0.99 * spread[k] + 0.01 * slope**2
            array -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-8)
    return model


def train_language_model(
    documents: DataFrame, per_language: int = 200, text: str = "text", **settings
) -> LanguageModel:
    """Fit on a bounded sample of documents (``doc_id, text, lang``) with a language."""
    known = documents.where(F.col("lang").isNotNull() & F.col(text).rlike(r"\p{L}"))
    sample = bounded_sample(known.select("doc_id", "lang", F.col(text).alias("text")), "lang", "doc_id", per_language)
    room = F.greatest(F.length("text") - TRAIN_WINDOW, F.lit(0))
    windows = F.array(
        *[F.substring("text", (room * k / max(1, WINDOWS - 1)).cast("int") + 1, F.lit(TRAIN_WINDOW)) for k in range(WINDOWS)]
    )
    rows = sample.select("doc_id", "lang", F.explode(F.array_distinct(windows)).alias("window")).collect()
    rows = sorted((row["lang"], row["window"]) for row in rows)
    return fit([window.encode() for _, window in rows], [lang for lang, _ in rows], **settings)


def text_probabilities(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities over all positions of each text: texts, languages. Empty: zeros."""
    lengths = np.diff(offsets)
    count = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[owner] + nth * WINDOW
    size = np.minimum(WINDOW, offsets[owner + 1] - start)
    total = np.zeros((len(model.languages), len(lengths)))
    # Windows of like length side by side: full ones need no mask.
    order = np.argsort(-size, kind="stable")
    for at in range(0, len(order), SIDE_BY_SIDE):
        chosen = order[at : at + SIDE_BY_SIDE]
        longest, shortest = size[chosen[0]], size[chosen[-1]]
        place = start[chosen][None, :] + np.arange(longest)[:, None]
        if longest == shortest:
            probability = position_probabilities(model, data[place])
        else:
            live = np.arange(longest)[:, None] < size[chosen][None, :]
            x = data[np.minimum(place, len(data) - 1)]
            probability = position_probabilities(model, x, live.astype(np.float32))
            probability *= live[:, None, :]
        pooled = probability.sum(axis=0)
        for k in range(len(total)):
            total[k] += np.bincount(owner[chosen], pooled[k], len(lengths))
    return (total / np.maximum(lengths, 1)).T


def label_positions(model: LanguageModel, text: str) -> list[tuple[int, int, str]]:
    """Runs of bytes with one label: start, end, language."""
    data = np.frombuffer(text.encode(), np.uint8)
    runs: list[tuple[int, int, str]] = []
    for at in range(0, len(data), WINDOW):
        best = position_probabilities(model, data[at : at + WINDOW, None])[:, :, 0].argmax(axis=1)
        for k, lang in enumerate(best.tolist(), at):
            name = model.languages[lang]
            if runs and runs[-1][2] == name and runs[-1][1] == k:
                runs[-1] = (runs[-1][0], k + 1, name)
            else:
                runs.append((k, k + 1, name))
    return runs


def language(text: Column, model: LanguageModel) -> Column:
    """``struct<lang, score>`` of each text."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        best = np.zeros(len(texts), np.int64)
        score = np.zeros(len(texts))
        for at, to, data, offsets in tk.slices(texts):
            pooled = text_probabilities(model, data, offsets)
            best[at:to] = pooled.argmax(axis=1)
            score[at:to] = pooled.max(axis=1)
        names = pa.array(model.languages).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(np.clip(score, 0, 1))], names=["lang", "score"])

    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if not model.languages:
        return unknown
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), judge(F.coalesce(text, F.lit("")))).otherwise(unknown)
