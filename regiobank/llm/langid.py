"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

A text is cut into windows of bytes. In each window one recurrent layer reads forward and one backward; both states at a
position give the probabilities of the languages there. The probabilities of a document are the mean over all its
positions, so every byte of the text counts alike.

Training is backpropagation through time on a bounded sample of windows; scoring runs in tasks, many windows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.llm.common import map_arrow, slices

WINDOW = 64
STATE = 10
SAMPLE_ROWS = 5000
MOST_OF_ONE = 32
STEPS = 480
BATCH = 64
RATE = 0.01
_ROWS = 4096
UNKNOWN = "und"
#: Unicode category L, for what is learned and what is predicted.
LETTER = r"\p{L}"


class Direction(NamedTuple):
    """One recurrent layer. `table` is a byte's input to the update, reset and candidate gates, biases included."""

    table: np.ndarray  # 256 x 3h
    gates: np.ndarray  # h x 3h


class Model(NamedTuple):
    forward: Direction
    backward: Direction
    output: np.ndarray  # 2h x languages
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run(layer: Direction, steps: np.ndarray, keep: bool = False):
    """States after every step for a batch of windows. steps: time x windows (bytes).

    With `keep`, also what backpropagation needs.
    """
    h = layer.gates.shape[0]
    state = np.zeros((steps.shape[1], h), dtype=layer.gates.dtype)
    states = np.empty((len(steps), *state.shape), dtype=state.dtype)
    kept = []
    for time, byte in enumerate(steps):
        given = np.take(layer.table, byte, axis=0)
        own = state @ layer.gates
        both = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
        update, reset = both[:, :h], both[:, h:]
        new = np.tanh(given[:, 2 * h :] + reset * own[:, 2 * h :])
        if keep:
            kept.append((byte, state, update, reset, new, own[:, 2 * h :]))
        state = new + update * (state - new)
        states[time] = state
    return (states, kept) if keep else states


def back(layer: Direction, kept: list, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of table and gates, given those of the states at each step."""
    h = layer.gates.shape[0]
    table, gates = np.zeros_like(layer.table), np.zeros_like(layer.gates)
    carried = np.zeros_like(error[0])
    for time in range(len(kept) - 1, -1, -1):
        byte, state, update, reset, new, own = kept[time]
        total = error[time] + carried
        d_new = total * (1 - update) * (1 - new * new)
        d_update = total * (state - new) * update * (1 - update)
        d_reset = d_new * own * reset * (1 - reset)
        d_own = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
        np.add.at(table, byte, np.concatenate([d_update, d_reset, d_new], axis=1))
        gates += state.T @ d_own
        carried = total * update + d_own @ layer.gates.T
    return table, gates


def _turned(windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each window (a row) with its own bytes in reverse, padding still at the end."""
    place = lengths[:, None] - 1 - np.arange(windows.shape[1])
    return np.where(place >= 0, np.take_along_axis(windows, np.maximum(place, 0), axis=1), 0)


def _turned_states(states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bring the states of the backward layer (time x windows x h) to the positions they belong to."""
    if (lengths == len(states)).all():
        return states[::-1]
    place = np.maximum(lengths[None, :] - 1 - np.arange(len(states))[:, None], 0)
    return states[place, np.arange(states.shape[1])[None, :]]


def _softmax(logits: np.ndarray) -> np.ndarray:
    values = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return values / values.sum(axis=-1, keepdims=True)


def position_probabilities(model: Model, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities at every position (time x windows x languages) of byte windows (rows, padded at the end)."""
    h = model.forward.gates.shape[0]
    ahead = run(model.forward, np.ascontiguousarray(windows.T))
    behind = _turned_states(run(model.backward, np.ascontiguousarray(_turned(windows, lengths).T)), lengths)
    return _softmax(ahead @ model.output[:h] + behind @ model.output[h:] + model.bias)


def loss_and_gradients(model: Model, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean log loss over all positions, and its gradients in the order of `_parameters`."""
    h = model.forward.gates.shape[0]
    ahead, kept_ahead = run(model.forward, windows.T, keep=True)
    behind, kept_behind = run(model.backward, _turned(windows, lengths).T, keep=True)
    behind = _turned_states(behind, lengths)
    found = _softmax(ahead @ model.output[:h] + behind @ model.output[h:] + model.bias)
    real = (np.arange(windows.shape[1])[:, None] < lengths[None, :]).astype(found.dtype)
    right = np.take_along_axis(found, np.broadcast_to(labels[None, :, None], (*real.shape, 1)), axis=2)[..., 0]
    error = found.copy()
    np.put_along_axis(error, np.broadcast_to(labels[None, :, None], (*real.shape, 1)), right[..., None] - 1, axis=2)
    error *= real[..., None] / real.sum()
    flat = error.reshape(-1, error.shape[-1])
    output = np.concatenate([ahead.reshape(-1, h).T @ flat, np.ascontiguousarray(behind).reshape(-1, h).T @ flat])
    d_behind = error @ model.output[h:].T
    # gradients go back to the steps at which the backward layer made these states; padding has none
    d_turned = _turned_states(d_behind, lengths) * real[..., None]
    grads = [*back(model.forward, kept_ahead, error @ model.output[:h].T), *back(model.backward, kept_behind, d_turned)]
    loss = -float((np.log(np.maximum(right, 1e-30)) * real).sum() / real.sum())
    return loss, [*grads, output, error.sum(axis=(0, 1))]


def _parameters(model: Model) -> list[np.ndarray]:
    return [*model.forward, *model.backward, model.output, model.bias]


def new_model(languages: int, state: int = STATE, seed: int = 3, kind=np.float32) -> Model:
    rng = np.random.default_rng(seed)

    def draw(*shape):
        return (rng.standard_normal(shape) * 0.3).astype(kind)

    layers = [Direction(draw(256, 3 * state), draw(state, 3 * state)) for _ in range(2)]
    return Model(*layers, draw(2 * state, languages), np.zeros(languages, dtype=kind))


def padded(texts: list[bytes], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of several texts as rows, their lengths, and the text of each."""
    sizes = np.array([len(text) for text in texts])
    count = -(-sizes // width)
    buffer = np.frombuffer(b"".join(text.ljust(n * width, b"\0") for text, n in zip(texts, count.tolist())), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return buffer.reshape(-1, width), np.minimum(sizes[owner] - nth * width, width), owner


def train(windows: list[bytes], labels: list[int], languages: int, steps: int = STEPS, seed: int = 3) -> Model:
    """Adam over shuffled batches of windows."""
    model = new_model(languages, seed=seed)
    rng = np.random.default_rng(seed)
    rows, lengths, owner = padded([window[:WINDOW] for window in windows])
    classes = np.array(labels)[owner]
    values = _parameters(model)
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    order = np.concatenate([rng.permutation(len(rows)) for _ in range(-(-steps * BATCH // len(rows)))])
    for step in range(1, steps + 1):
        part = order[(step - 1) * BATCH : step * BATCH]
        _, grads = loss_and_gradients(model, rows[part], lengths[part], classes[part])
        rate = RATE * (1 - (step - 1) / steps)
        for value, grad, m, v in zip(values, grads, first, second):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def document_probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all positions of each text; a text without bytes has zeros."""
    rows, lengths, owner = padded(texts)
    sums = np.zeros((len(texts), len(model.bias)))
    whole = np.flatnonzero(lengths == WINDOW)
    for chosen in (whole, np.flatnonzero(lengths < WINDOW)):
        for at in range(0, len(chosen), _ROWS):
            part = chosen[at : at + _ROWS]
            found = position_probabilities(model, rows[part], lengths[part])
            if chosen is not whole:
                found = found * (np.arange(WINDOW)[:, None] < lengths[part][None, :])[..., None]
            np.add.at(sums, owner[part], found.sum(axis=0, dtype=np.float64))
    sizes = np.array([[max(len(text), 1)] for text in texts])
    return sums / sizes


def held_out(doc_id, parts: int = 3, left: int = 1):
    """Rows that are never learned from: by the remainder of the id's crc32, and those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == left, F.lit(True))


def sample(docs: DataFrame, learn, rows: int = SAMPLE_ROWS) -> tuple[list[bytes], list[str]]:
    """About `rows` windows of labelled documents, both chosen by hashes of the id; of few documents, several each."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & learn)
    count = max(known.count(), 1)
    share, each = min(1 << 20, -(-(rows << 20) // count)), min(-(-rows // count), MOST_OF_ONE)
    key = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = known.where(F.pmod(key, F.lit(1 << 20)) < share).where(F.col("text").rlike(LETTER))
    chosen = chosen.select(F.col("doc_id").cast("long").alias("i"), "lang", "text", F.explode(F.sequence(F.lit(1), F.lit(each))).alias("n"))
    place = F.pmod(F.xxhash64("i", "n"), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))) + 1
    windows = chosen.select("i", "n", "lang", F.substring("text", place.cast("int"), WINDOW).alias("w"))
    found = sorted((row.i, row.n, row.lang, row.w.encode()) for row in windows.limit(2 * rows).collect())
    return [row[3] for row in found], [row[2] for row in found]


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Learned from text and lang of the rows that are not held out and have a lang. lang_pred is the language of the
    greatest mean probability over all bytes of the whole text (the first in alphabetical order, if equal), score that
    probability. A text that is null or has no letter is `und`, with score 0, and so is every text if there is nothing
    to learn from. Rows that repeat each get a row. Other columns are ignored; an empty table gives an empty result.
    """
    windows, langs = sample(docs, ~held_out(F.col("doc_id")))
    names = sorted(set(langs))
    model = train(windows, [names.index(lang) for lang in langs], len(names)) if names else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            some = np.array([model is not None and ok for ok in batch.column("letter").to_pylist()], dtype=bool)
            best, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
            if some.any():
                found = document_probabilities(model, [text.encode() for text, ok in zip(texts, some) if ok])
                best[some], score[some] = found.argmax(axis=1), np.minimum(found.max(axis=1), 1.0)
            lang = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_arrow(docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("letter")), work, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
