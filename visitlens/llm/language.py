"""Language identification with a bidirectional gated recurrent network.

The network reads bytes in windows of STEPS: one gated unit layer from the
left, one from the right, and a softmax over both states labels every byte.
A document's probabilities are the mean over all of its bytes; the largest
names its language.  The weights are trained in numpy by backpropagation
through time on the driver, on windows of at most FIT_ROWS labelled
documents (each label gives as many of its rows, drawn by a hash; of each one
piece of FIT_CHARS characters at a hashed place), so rare labels are learned
too, and rows that repeat an id or a text are drawn one by one.  They are a few thousand numbers and travel
with the task.

Defined cases: null texts and texts without a letter are ``und`` with score
0; without any labelled row every text is; rows with a null label are not
learned from but are labelled; rows are independent, so repeated rows get
the same answer and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from visitlens.llm.common import release, sample_each, utf8

STEPS = 64
HIDDEN = 8
FIT_ROWS = 4_000
FIT_CHARS = 400
BATCHES = 500
BATCH = 128
WINDOWS = 2_048
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Layer:
    """Gates z, r and candidate side by side: rows of ``inputs`` by byte,
    ``state`` from the state before."""

    inputs: np.ndarray
    state: np.ndarray

    def run(self, x: np.ndarray, inside: np.ndarray | None, keep: bool = False):
        """States after each step of x (steps x rows of bytes); where
        ``inside`` is false the state stays."""
        n = self.state.shape[0]
        h = np.zeros((x.shape[1], n), np.float32)
        states = np.empty((len(x), *h.shape), np.float32)
        kept = []
        for t in range(len(x)):
            a, b = self.inputs[x[t]], h @ self.state
            gates = _sigmoid(a[:, :2 * n] + b[:, :2 * n])
            z, r = gates[:, :n], gates[:, n:]
            c = np.tanh(a[:, 2 * n:] + r * b[:, 2 * n:])
            new = c + z * (h - c)
            if inside is not None:
                new = np.where(inside[t][:, None], new, h)
            if keep:
                kept.append((h, z, r, c, b[:, 2 * n:]))
            h = states[t] = new
        return states, kept

    def back(self, x: np.ndarray, kept: list, toward: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of inputs and state, from those of the states."""
        n = self.state.shape[0]
        steps = np.empty((len(x), x.shape[1], 3 * n), np.float32)
        d_state = np.zeros_like(self.state)
        d_h = np.zeros_like(toward[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, c, u = kept[t]
            d = d_h + toward[t]
            d_c = d * (1 - z) * (1 - c * c)
            d_z = d * (h - c) * z * (1 - z)
            d_r = d_c * u * r * (1 - r)
            steps[t] = np.concatenate([d_z, d_r, d_c], 1)
            from_state = np.concatenate([d_z, d_r, d_c * r], 1)
            d_state += h.T @ from_state
            d_h = d * z + from_state @ self.state.T
        flat, by = steps.reshape(-1, 3 * n), x.ravel()
        order = np.argsort(by, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(by[order]) != 0]))
        d_inputs = np.zeros_like(self.inputs)
        d_inputs[by[order][first]] = np.add.reduceat(flat[order], first)
        return d_inputs, d_state


class Network:
    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        make = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.labels = labels
        self.ahead = Layer(make(256, 3 * hidden), make(hidden, 3 * hidden))
        self.behind = Layer(make(256, 3 * hidden), make(hidden, 3 * hidden))
        self.out = make(2 * hidden, len(labels))
        self.bias = np.zeros(len(labels), np.float32)

    def _weights(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.state, self.behind.inputs, self.behind.state, self.out, self.bias]

    def _probabilities(self, fore: np.ndarray, back: np.ndarray) -> np.ndarray:
        n = fore.shape[2]
        logit = fore @ self.out[:n] + back @ self.out[n:] + self.bias
        logit -= logit.max(axis=2, keepdims=True)
        e = np.exp(logit)
        return e / e.sum(axis=2, keepdims=True)

    def positions(self, x: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
        """Label probabilities of every byte (steps x rows x labels)."""
        fore, _ = self.ahead.run(x, inside)
        back, _ = self.behind.run(x[::-1], None if inside is None else inside[::-1])
        return self._probabilities(fore, back[::-1])

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients."""
        fore, kept_f = self.ahead.run(x, None, True)
        back, kept_b = self.behind.run(x[::-1], None, True)
        p = self._probabilities(fore, back[::-1])
        loss = float(-np.log(np.maximum(p[:, np.arange(len(y)), y], 1e-9)).mean())
        d = p
        d[:, np.arange(len(y)), y] -= 1
        d = (d / (x.shape[0] * x.shape[1])).astype(np.float32)
        n = fore.shape[2]
        flat = d.reshape(-1, d.shape[2])
        d_out = np.concatenate([fore.reshape(-1, n), back[::-1].reshape(-1, n)], 1).T @ flat
        to_fore, to_back = d @ self.out[:n].T, d @ self.out[n:].T
        return loss, [*self.ahead.back(x, kept_f, to_fore),
                      *self.behind.back(x[::-1], kept_b, to_back[::-1]), d_out, flat.sum(axis=0)]

    def train(self, texts: list[bytes], y: np.ndarray, batches: int = BATCHES, seed: int = 6) -> float:
        """Adam over random windows; a text shorter than one is repeated."""
        rng = np.random.default_rng(seed)
        weights = self._weights()
        mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        loss = 0.0
        for step in range(1, batches + 1):
            rows = rng.integers(0, len(texts), BATCH)
            x = np.empty((STEPS, BATCH), np.int64)
            for k, r in enumerate(rows):
                text = texts[r]
                at = int(rng.integers(0, max(1, len(text) - STEPS + 1)))
                x[:, k] = np.resize(np.frombuffer(text[at:at + STEPS], np.uint8), STEPS)
            loss, grads = self.gradients(x, y[rows])
            scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
            rate = 0.02 * (1 - step / (batches + 1)) + 0.001
            for w, g, m, s in zip(weights, grads, mean, square, strict=True):
                g = g * scale
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return loss

    def documents(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean label probabilities over all bytes of each text; 0 for
        empty ones."""
        sizes = np.diff(off)
        total = np.zeros((len(sizes), len(self.labels)))
        # Windows of a long text; the last one ends at its end and counts
        # only the bytes that are new.
        long = np.flatnonzero(sizes >= STEPS)
        n = -(-sizes[long] // STEPS)
        owner = np.repeat(long, n)
        inner = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STEPS
        start = np.minimum(inner, sizes[owner] - STEPS)
        for a in range(0, len(owner), WINDOWS):
            own, at, skip = owner[a:a + WINDOWS], start[a:a + WINDOWS], (inner - start)[a:a + WINDOWS]
            x = data[(off[own] + at)[None, :] + np.arange(STEPS)[:, None]]
            p = self.positions(x)
            p *= (np.arange(STEPS)[:, None] >= skip[None, :])[:, :, None]
            np.add.at(total, own, p.sum(axis=0))
        short = np.flatnonzero((sizes < STEPS) & (sizes > 0))
        for a in range(0, len(short), WINDOWS):
            own = short[a:a + WINDOWS]
            inside = np.arange(STEPS)[:, None] < sizes[own][None, :]
            place = np.minimum(off[own][None, :] + np.arange(STEPS)[:, None], len(data) - 1)
            p = self.positions(np.where(inside, data[place], 0), inside)
            np.add.at(total, own, (p * inside[:, :, None]).sum(axis=0))
        return total / np.maximum(sizes, 1)[:, None]


def fit(labelled: DataFrame, rows: int = FIT_ROWS) -> Network | None:
    """Train on columns key, text and label; null labels and keys and texts
    without a letter are left out.  Only ``rows`` pieces of text reach the driver."""
    at = F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.lit(1), F.length("text") - FIT_CHARS)).cast("int") + 1
    fine = labelled.where("label IS NOT NULL AND key IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    pieces = sample_each(fine.select("label", "key", F.substring(F.col("text"), at, F.lit(FIT_CHARS)).alias("text")),
                         "label", ["key", "text"], rows)
    got = pieces.select("label", "text").collect()
    if not got:
        return None
    labels = sorted({r["label"] for r in got})
    network = Network(labels)
    network.train([r["text"].encode() for r in got], np.array([labels.index(r["label"]) for r in got]))
    return network


def identify(df: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row, in front of all columns of
    the row as struct ``row``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                texts = part.column("txt")
                letters = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
                names, score = np.full(len(part), "und", object), np.zeros(len(part))
                if network is not None and letters.any():
                    p = network.documents(*utf8(texts))
                    names = np.where(letters, np.array(network.labels, object)[p.argmax(axis=1)], names)
                    score = np.where(letters, np.clip(p.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in carried), pa.array(names, pa.string()), pa.array(score)],
                    [*carried, "lang_pred", "score"])
            release()

    names = [c for c in df.columns]
    narrow = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                       F.col(f"`{text}`").cast("string").alias("txt"))
    carried = [f"c{i}" for i in range(len(names))]
    kinds = dict(narrow.dtypes)
    done = narrow.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", lang_pred string, score double")
    row = F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
    return done.select(F.col(f"c{names.index(key)}").alias(key), "lang_pred", "score", row.alias("row"))
