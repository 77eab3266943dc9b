"""Language identification by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a text are cut into stretches of ``STRETCH`` bytes. In each, one gated recurrent unit reads forwards and one
backwards; their states together give every byte a probability of each language, and a document's probability is the mean over all
its bytes. The network is written in numpy and trained by backpropagation through time, with every byte of a stretch labelled by its
document's language.

It is fitted on at most ``SAMPLE_DOCS`` labelled documents, chosen by a hash of their rows, and on ``SAMPLE_STRETCHES`` stretches spread
over the whole text of each; languages are drawn equally often. Held-out documents (crc32 of the id as text divisible by
``FOLDS``) and rows without id are never learnt from. Only the text is read to predict.

Null texts and texts without a letter are ``und`` with score 0. Texts are read whole, ``AT_ONCE`` stretches at a time, so a very long
one needs no more memory than its bytes. Equal texts get equal results. Without any labelled row to learn from everything is
``und``. Rows without id count as held out. An empty table gives no rows. Clashing columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5
STRETCH = 48  # bytes
STATES = 8  # of each direction
SAMPLE_DOCS, SAMPLE_STRETCHES = 4_000, 12
BATCH, STEPS, RATE = 256, 500, 0.02
AT_ONCE = 4_096
UNKNOWN = "und"

_LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]")


def held_out(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text)


def stretches(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All stretches as rows of bytes, the last padded with zeros, and how many bytes of each are the text's."""
    n = -(-len(data) // STRETCH)
    rows = np.frombuffer(data.ljust(n * STRETCH, b"\0"), np.uint8).reshape(n, STRETCH)
    sizes = np.full(n, STRETCH, np.int64)
    if n:
        sizes[-1] = len(data) - (n - 1) * STRETCH
    return rows, sizes


class Network:
    """Weights: ``x`` by direction, byte and gate (update, reset, new state); ``u`` by direction, state and gate; ``v`` and ``c`` of the labels."""

    def __init__(self, n_langs: int, states: int = STATES, seed: int = 5):
        random = np.random.default_rng(seed)
        self.states = states
        self.weights = {"x": random.normal(0, 0.3, (2, 256, 3 * states)), "u": random.normal(0, 0.3, (2, states, 3 * states)),
                        "v": random.normal(0, 0.3, (2 * states, n_langs)), "c": np.zeros(n_langs)}

    def loss(self, data: np.ndarray, langs: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all bytes of whole stretches, and its gradient, carried back through time."""
        w, h = self.weights, self.states
        n, length = data.shape
        both = np.stack([data, data[:, ::-1]])  # the second direction reads backwards
        state = np.zeros((2, n, h))
        kept = []
        for t in range(length):
            read = np.stack([w["x"][d][both[d, :, t]] for d in (0, 1)])
            carried = state @ w["u"]
            gates = 1 / (1 + np.exp(-(read[..., :2 * h] + carried[..., :2 * h])))
            update, reset = gates[..., :h], gates[..., h:]
            new = np.tanh(read[..., 2 * h:] + reset * carried[..., 2 * h:])
            kept.append((state, update, reset, new, carried[..., 2 * h:]))
            state = new + update * (state - new)
        states = np.stack([k[0] for k in kept[1:]] + [state])  # time, direction, stretch, state
        seen = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        logits = seen @ w["v"] + w["c"]
        chance = np.exp(logits - logits.max(2, keepdims=True))
        chance /= chance.sum(2, keepdims=True)
        loss = -np.log(np.maximum(chance[:, np.arange(n), langs], 1e-12)).mean()

        away = chance
        away[:, np.arange(n), langs] -= 1
        away /= n * length
        grads = {"v": np.einsum("tns,tnl->sl", seen, away), "c": away.sum((0, 1)), "x": np.zeros_like(w["x"]), "u": np.zeros_like(w["u"])}
        back = away @ w["v"].T
        back = np.stack([back[..., :h], back[::-1, :, h:]], axis=1)  # time, direction, stretch, state
        later = np.zeros((2, n, h))
        for t in reversed(range(length)):
            before, update, reset, new, carried = kept[t]
            d_state = back[t] + later
            d_new = d_state * (1 - update) * (1 - new * new)
            d_update = d_state * (before - new) * update * (1 - update)
            d_reset = d_new * carried * reset * (1 - reset)
            d_read = np.concatenate([d_update, d_reset, d_new], axis=2)
            d_carried = np.concatenate([d_update, d_reset, d_new * reset], axis=2)
            for d in (0, 1):
                np.add.at(grads["x"][d], both[d, :, t], d_read[d])
            grads["u"] += before.transpose(0, 2, 1) @ d_carried
            later = d_state * update + d_carried @ w["u"].transpose(0, 2, 1)
        return loss, grads

    def train(self, data: np.ndarray, langs: np.ndarray, steps: int = STEPS, seed: int = 9) -> None:
        """Adam on batches in which every language is equally likely; the step size falls to nothing."""
        random = np.random.default_rng(seed)
        of_lang = [np.flatnonzero(langs == k) for k in range(len(self.weights["c"]))]
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            drawn = random.integers(len(of_lang), size=BATCH)
            picked = np.array([of_lang[k][random.integers(len(of_lang[k]))] for k in drawn])
            _, grads = self.loss(data[picked], langs[picked])
            rate = RATE * min(1, step / 20) * (1 - step / (steps + 1))
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                self.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)

    def reader(self) -> "Reader":
        return Reader(self.weights, self.states)


class Reader:
    """The trained network in single precision, laid out so that a step works on long rows."""

    def __init__(self, weights: dict[str, np.ndarray], states: int):
        self.states = states
        halved = np.r_[np.full(2 * states, 0.5), np.ones(states)]  # 1 / (1 + exp(-a)) is (1 + tanh(a / 2)) / 2
        self.x = [np.ascontiguousarray((weights["x"][d] * halved).T, np.float32) for d in (0, 1)]
        self.u = [np.ascontiguousarray((weights["u"][d] * halved).T, np.float32) for d in (0, 1)]
        self.v, self.c = np.ascontiguousarray(weights["v"].T, np.float32), weights["c"].astype(np.float32)[:, None]

    def _states(self, columns: np.ndarray, d: int) -> np.ndarray:
        """(time, state, stretch) of one direction; ``columns`` hold one byte of every stretch in each row."""
        length, n = columns.shape
        h, out = self.states, np.empty((length, self.states, n), np.float32)
        state, read, carried = np.zeros((h, n), np.float32), np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
        for t in range(length) if d == 0 else reversed(range(length)):
            np.take(self.x[d], columns[t], axis=1, out=read, mode="clip")
            np.matmul(self.u[d], state, out=carried)
            gates = read[:2 * h]
            gates += carried[:2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            new, last = read[2 * h:], carried[2 * h:]
            last *= gates[h:]
            new += last
            np.tanh(new, out=new)
            state = np.subtract(state, new, out=out[t])
            state *= gates[:h]
            state += new
        return out

    def sums(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The languages' probabilities, added up over the bytes of every stretch."""
        columns = np.ascontiguousarray(rows.T).astype(np.intp)
        total = np.zeros((len(self.c), len(rows)), np.float32)
        ahead, behind = self._states(columns, 0), self._states(columns, 1)
        v_ahead, v_behind = np.ascontiguousarray(self.v[:, :self.states]), np.ascontiguousarray(self.v[:, self.states:])
        short = sizes.min() < STRETCH
        for t in range(STRETCH):
            chance = v_ahead @ ahead[t]
            chance += v_behind @ behind[t]
            chance += self.c
            np.exp(np.minimum(chance, 60, out=chance), out=chance)
            chance /= chance.sum(0)
            if short:
                chance *= sizes > t
            total += chance
        return total.T


class Model:
    """The languages learnt and what reads them."""

    def __init__(self, langs: list[str], reader: Reader | None):
        self.langs, self.reader = langs, reader

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text."""
        places: dict[str, int] = {}
        for text in texts:
            if text and self.langs and text not in places and has_letter(text):
                places[text] = len(places)
        pooled = np.zeros((len(places), len(self.langs)))
        held: list[tuple[int, np.ndarray, np.ndarray]] = []

        def read() -> None:
            if held:
                sums = self.reader.sums(np.concatenate([r for _, r, _ in held]), np.concatenate([s for _, _, s in held]))
                np.add.at(pooled, np.repeat([i for i, _, _ in held], [len(r) for _, r, _ in held]), sums)
                held.clear()

        waiting = 0
        for text, i in places.items():
            rows, sizes = stretches(text.encode("utf-8", "surrogatepass"))
            for at in range(0, len(rows), AT_ONCE):
                held.append((i, rows[at:at + AT_ONCE], sizes[at:at + AT_ONCE]))
                waiting += len(held[-1][1])
                if waiting >= AT_ONCE:
                    read()
                    waiting = 0
        read()
        pooled /= np.maximum(pooled.sum(1, keepdims=True), 1e-30)
        best = pooled.argmax(1) if len(places) else np.empty(0, int)
        known = [places.get(t) if t else None for t in texts]
        return ([UNKNOWN if i is None else self.langs[best[i]] for i in known],
                np.array([0.0 if i is None else pooled[i, best[i]] for i in known], float))


def sample(docs: DataFrame, text: str, lang: str, key: str) -> pd.DataFrame:
    """(lang, data) of stretches of at most ``SAMPLE_DOCS`` labelled documents that are not held out."""
    labelled = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                           held_out(key).alias("held_out")).where("lang IS NOT NULL AND text IS NOT NULL AND NOT held_out")
    total = labelled.count()
    share = F.pmod(F.xxhash64("key", "text"), F.lit(1_000_000)) < F.lit(1_000_000 * SAMPLE_DOCS / max(total, 1))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for lang_of, value in zip(batch.lang, batch.text):
                data = value.encode("utf-8", "surrogatepass")
                whole = len(data) // STRETCH
                if whole and has_letter(value):
                    for k in sorted({i * whole // SAMPLE_STRETCHES for i in range(SAMPLE_STRETCHES)}):
                        found.append((lang_of, data[k * STRETCH:(k + 1) * STRETCH]))
            yield pd.DataFrame(found, columns=["lang", "data"])

    rows = labelled.where(share).limit(SAMPLE_DOCS).select("lang", "text").mapInPandas(cut, "lang string, data binary")
    return rows.toPandas()  # at most SAMPLE_DOCS * SAMPLE_STRETCHES rows of STRETCH bytes


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", steps: int = STEPS) -> Model:
    rows = sample(docs, text, lang, key)
    langs = sorted(set(rows.lang))
    if not langs:
        return Model([], None)
    network = Network(len(langs))
    data = np.frombuffer(b"".join(rows.data), np.uint8).reshape(-1, STRETCH)
    # rows come in no order that a rerun would repeat
    places = np.lexsort((*data.T[::-1], rows.lang.values.astype(str)))
    network.train(data[places], np.searchsorted(langs, rows.lang.values[places].astype(str)), steps)
    return Model(langs, network.reader())


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", model: Model | None = None) -> DataFrame:
    """Key, ``held_out``, ``lang_pred`` and ``score`` of every document."""
    model = model or fit(docs, text, lang, key)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        langs, score = model.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": langs, "score": score})

    return docs.select(F.col(key), held_out(key).alias("held_out"), predicted(F.col(text)).alias("p")).select(key, "held_out", "p.*")
