"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Learned filters slide over the
embedded bytes; each filter's maximum over a chunk feeds one logit, and the mean of the chunks'
logits, weighted by their bytes, makes the probability of the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, pieces
from webcorpus.llm.labelled import held_out, prior, sample

CHUNK, WIDTH, STEP = 512, 8, 2
EMBED, FILTERS = 4, 16
# How far back a run of four bytes is looked for; whether it is found is one more input channel.
BACK = 24
# Bounds of learning: documents, chunks of each, rounds.
SAMPLE, CHUNKS, ROUNDS = 6_000, 4, 6
BATCH, RATE, DECAY = 64, 0.003, 1e-4
_INPUTS = WIDTH * (EMBED + 1)


def echoes(data: np.ndarray) -> np.ndarray:
    """1 where the four bytes from here on also begin up to BACK bytes before, else 0."""
    n = len(data)
    out = np.zeros(n, dtype=bool)
    for lag in range(2, BACK + 1):
        same = data[lag:] == data[:-lag]
        if len(same) >= 4:
            out[lag:n - 3] |= same[:-3] & same[1:-2] & same[2:-1] & same[3:]
    return out


def chunks_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunks of bytes, their echoes, bytes that each adds); the last is filled up with zeros.

    Chunks overlap by WIDTH - STEP bytes, so every window of a filter lies whole in one of them.
    """
    hop = CHUNK - WIDTH + STEP
    n = max(1, -(-max(0, len(data) - (WIDTH - STEP)) // hop))
    size = (n - 1) * hop + CHUNK
    padded, heard = np.zeros(size, dtype=np.uint8), np.zeros(size, dtype=bool)
    padded[:len(data)], heard[:len(data)] = data, echoes(data)
    view = lambda a: np.lib.stride_tricks.sliding_window_view(a, CHUNK)[::hop]
    fresh = np.minimum(hop, np.maximum(1, len(data) - hop * np.arange(n)))
    return view(padded), view(heard), fresh


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


class Network:
    """embedding (256, EMBED), filters (_INPUTS, FILTERS), bias, output weights, output bias."""

    def __init__(self, params: list[np.ndarray]) -> None:
        self.params = [p.astype(np.float32) for p in params]

    def windows(self, data: np.ndarray, heard: np.ndarray) -> np.ndarray:
        """(chunks, places, _INPUTS): what the filters see."""
        seen = np.empty((*data.shape, EMBED + 1), dtype=np.float32)
        seen[..., :EMBED] = self.params[0][data]
        seen[..., EMBED] = heard
        flat = seen.reshape(len(data), -1)
        return np.lib.stride_tricks.sliding_window_view(flat, _INPUTS, axis=1)[:, ::STEP * (EMBED + 1)]

    def pooled(self, data: np.ndarray, heard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's maximum over a chunk, and where it is."""
        seen = self.windows(data, heard)
        made = (seen.reshape(-1, _INPUTS) @ self.params[1]).reshape(*seen.shape[:2], FILTERS)
        return made.max(axis=1), made

    def logits(self, data: np.ndarray, heard: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(data, heard)
        return np.maximum(top + self.params[2], 0) @ self.params[3] + self.params[4]

    def raw_scores(self, texts: list[str]) -> np.ndarray:
        """One logit per whole text; chunks of many texts go through the filters together."""
        parts = [chunks_of(bytes_of(t)) for t in texts]
        counts = [len(p[0]) for p in parts]
        made = []
        group, held = [], 0
        for data, heard, _ in parts:
            for k in range(0, len(data), BATCH):
                group.append((data[k:k + BATCH], heard[k:k + BATCH]))
                held += len(group[-1][0])
                if held >= BATCH:
                    made.append(self.logits(*map(np.concatenate, zip(*group))))
                    group, held = [], 0
        if group:
            made.append(self.logits(*map(np.concatenate, zip(*group))))
        if not parts:
            return np.zeros(0)
        fresh = np.concatenate([p[2] for p in parts]).astype(float)
        of = np.repeat(np.arange(len(parts)), counts)
        total = np.bincount(of, weights=np.concatenate(made) * fresh, minlength=len(parts))
        return total / np.bincount(of, weights=fresh, minlength=len(parts))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(data: np.ndarray, heard: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Adam over chunks in a fixed random order; the maximum passes its gradient to its place."""
    rng = np.random.default_rng(0)
    net = Network([rng.normal(0, 0.5, (256, EMBED)), rng.normal(0, 0.3, (_INPUTS, FILTERS)),
                   np.full(FILTERS, 0.1), rng.normal(0, 0.3, FILTERS),
                   np.array([prior(len(y), y.sum())])])
    means, squares = [np.zeros_like(p) for p in net.params], [np.zeros_like(p) for p in net.params]
    t = 0
    for _ in range(rounds if len(y) else 0):
        order = rng.permutation(len(y))
        for k in range(0, len(y), BATCH):
            pick = order[k:k + BATCH]
            t += 1
            table, filters, bias, out, _ = net.params
            top, made = net.pooled(data[pick], heard[pick])
            place = made.argmax(axis=1)  # (chunks, FILTERS)
            active = np.maximum(top + bias, 0)
            off = ((sigmoid(active @ out + net.params[4][0]) - y[pick]) / len(pick)).astype(np.float32)
            back = off[:, None] * out * (active > 0)  # (chunks, FILTERS)
            rows = np.arange(len(pick))[:, None]
            seen = net.windows(data[pick], heard[pick])[rows, place]  # (chunks, FILTERS, _INPUTS)
            to_filters = np.einsum("cf,cfi->if", back, seen)
            to_inputs = (back[:, :, None] * filters.T[None]).reshape(-1, WIDTH, EMBED + 1)[..., :EMBED]
            byte = data[pick][rows[..., None], place[..., None] * STEP + np.arange(WIDTH)]
            to_table = np.zeros_like(table)
            np.add.at(to_table, byte.reshape(-1), to_inputs.reshape(-1, EMBED))
            grads = [to_table, to_filters + DECAY * filters, back.sum(axis=0),
                     active.T @ off + DECAY * out, np.array([off.sum()])]
            for n, g in enumerate(grads):
                means[n] = 0.9 * means[n] + 0.1 * g
                squares[n] = 0.999 * squares[n] + 0.001 * g * g
                step = means[n] / (1 - 0.9 ** t) / (np.sqrt(squares[n] / (1 - 0.999 ** t)) + 1e-8)
                net.params[n] = (net.params[n] - RATE * step).astype(np.float32)
    return net.params


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality",
          limit: int = SAMPLE) -> list[np.ndarray]:
    """The network's parameters, learnt in one task from chunks of the bounded sample.

    A document gives at most CHUNKS chunks, evenly over its length; scoring always reads all.
    """
    rows = sample(documents, labels, label, limit)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, heard, y = [], [], []
            for text, label_ in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                parts, echo, _ = chunks_of(bytes_of(text))
                for k in np.unique(np.linspace(0, len(parts) - 1, CHUNKS).astype(int)):
                    data.append(parts[k].tobytes())
                    heard.append(np.packbits(echo[k]).tobytes())
                    y.append(label_)
            yield pa.RecordBatch.from_pydict({
                "data": pa.array(data, pa.binary()), "heard": pa.array(heard, pa.binary()),
                "y": pa.array(y, pa.float64())})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        data = np.frombuffer(b"".join(d for d, _, _ in got), dtype=np.uint8).reshape(-1, CHUNK)
        heard = np.unpackbits(np.frombuffer(b"".join(h for _, h, _ in got), dtype=np.uint8)
                              .reshape(-1, CHUNK // 8), axis=1).astype(bool)
        made = train(data, heard, np.array([y for _, _, y in got], dtype=float))
        yield pa.RecordBatch.from_pydict({"params": pa.array(
            [[p.ravel().tolist() for p in made]], pa.list_(pa.list_(pa.float32())))})

    cut_rows = map_batches(rows, cut, "data binary, heard binary, y double").repartition(1)
    got = map_batches(cut_rows, fit, "params array<array<float>>").first()
    if got is None:
        return train(np.zeros((0, CHUNK), np.uint8), np.zeros((0, CHUNK), bool), np.zeros(0))
    shapes = [(256, EMBED), (_INPUTS, FILTERS), (FILTERS,), (FILTERS,), (1,)]
    return [np.array(p, dtype=np.float32).reshape(s) for p, s in zip(got.params, shapes)]


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE,
             threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, from the bytes of the whole text alone.

    Learns from at most `limit` labelled documents outside the held-out fold, once per call. Null
    and empty texts are one chunk of zeros. Without labels the network is as it was drawn. Null ids
    are held out; repeated rows are scored alike.
    """
    model = documents.sparkSession.sparkContext.broadcast(learn(documents, labels, label, limit))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(model.value)
        for batch in pieces(batches, 64):
            p = sigmoid(net.raw_scores([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(p.astype(float)),
                "predicted": pa.array((p >= threshold).astype(np.int32))})

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(
        rows, score, f"doc_id {kind}, held_out boolean, score double, predicted int")
