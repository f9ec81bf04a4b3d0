"""Language identification with a byte convolutional network.

Filters of widths 2, 3 and 4 run over embedded bytes, the largest answer of each filter in a window feeds a softmax. Training is
plain numpy on the driver, on a bounded sample: ``train_docs`` labelled documents per language (smallest hash first) with
``train_windows`` windows each. Prediction reads whole texts as fixed windows of ``WINDOW`` bytes, many at a time; a text's
prediction is the mean of its windows' log probabilities, weighted by their bytes. Only the text is an input.

For prediction the filters become tables over byte pairs (16-bit integers), which give the same sums with a few look-ups per byte.

Defined cases: a null, empty or letterless text is ``und`` with score 0, and so is every text when nothing labelled can be learned
from; rows with a null language are never learned from; a null id is in the fold of the empty text; repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import documents, fold

WINDOW = 256
WIDTHS = (2, 3, 4)
EMBED, FILTERS = 8, 16
PAD = 0x20
TRAIN_DOCS, TRAIN_WINDOWS = 600, 2


@dataclass
class ByteCnn:
    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: list[np.ndarray]  # width * EMBED x FILTERS
    biases: list[np.ndarray]
    out: np.ndarray  # features x languages
    out_bias: np.ndarray

    def tables(self) -> tuple[float, list[np.ndarray]]:
        """The scale of the integers, and for each width the tables of byte pairs (and of single bytes where the width is odd)."""
        per_byte = [[self.embed @ f[k * EMBED : (k + 1) * EMBED] for k in range(w)] for w, f in zip(WIDTHS, self.filters, strict=True)]
        scale = 7000.0 / max(1e-6, max(float(np.abs(t).max()) for ts in per_byte for t in ts))
        found = []
        for ts in per_byte:
            pairs = [np.rint((a[:, None, :] + b[None, :, :]) * scale).astype(np.int16).reshape(65536, FILTERS) for a, b in zip(ts[::2], ts[1::2], strict=False)]
            found.append(pairs + ([np.rint(ts[-1] * scale).astype(np.int16)] if len(ts) % 2 else []))
        return scale, found


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 8, batch: int = 64, rate: float = 4e-3, seed: int = 5) -> ByteCnn:
    """Fit on windows (n x WINDOW bytes) with Adam. The gradient of the largest answer touches only the bytes it came from."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, EMBED))]
    params += [rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)) for w in WIDTHS] + [np.zeros(FILTERS) for _ in WIDTHS]
    params += [rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))), np.zeros(len(langs))]
    params = [p.astype(np.float32) for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n, step, nw = len(windows), 0, len(WIDTHS)
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            x, y = windows[order[at : at + batch]], labels[order[at : at + batch]]
            b = len(x)
            e = params[0][x]
            features, places = [], []
            for i, w in enumerate(WIDTHS):
                patches = np.lib.stride_tricks.sliding_window_view(e.reshape(b, -1), w * EMBED, axis=1)[:, ::EMBED]
                answers = (patches.reshape(-1, w * EMBED) @ params[1 + i]).reshape(b, -1, FILTERS)
                place = answers.argmax(axis=1)
                places.append(place)
                features.append(np.maximum(np.take_along_axis(answers, place[:, None, :], 1)[:, 0] + params[1 + nw + i], 0))
            hidden = np.concatenate(features, axis=1)
            grad_z = np.exp(_log_softmax(hidden @ params[-2] + params[-1]))
            grad_z[np.arange(b), y] -= 1
            grad_z /= b
            grads = [np.zeros_like(p) for p in params]
            grads[-2], grads[-1] = hidden.T @ grad_z, grad_z.sum(axis=0)
            back = (grad_z @ params[-2].T) * (hidden > 0)
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                bytes_at = x[np.arange(b)[:, None, None], places[i][:, :, None] + np.arange(w)]
                patch = params[0][bytes_at].reshape(b, FILTERS, -1)
                grads[1 + i] = np.einsum("bfk,bf->kf", patch, g)
                grads[1 + nw + i] = g.sum(axis=0)
                to_embed = (g[:, :, None] * params[1 + i].T[None]).reshape(b, FILTERS, w, EMBED)
                np.add.at(grads[0], bytes_at.ravel(), to_embed.reshape(-1, EMBED))
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return ByteCnn(langs, params[0], params[1 : 1 + nw], params[1 + nw : 1 + 2 * nw], params[-2], params[-1])


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All fixed windows of the texts: bytes (n x WINDOW, padded), the text's number, and the bytes that are not padding."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    return _cut(np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes)]))


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[:-1][owner] + number * WINDOW
    held = np.minimum(WINDOW, sizes[owner] - number * WINDOW)
    if not len(owner):
        return np.zeros((0, WINDOW), dtype=np.uint8), owner, held
    column = np.arange(WINDOW)
    cut = data[np.minimum(start[:, None] + column, len(data) - 1)]
    cut[column >= held[:, None]] = PAD
    return cut, owner, held


class Predictor:
    """The network as look-up tables, for many windows at a time."""

    def __init__(self, net: ByteCnn):
        self.net = net
        self.scale, self.tables = net.tables()

    def log_probs(self, windows: np.ndarray, block: int = 64) -> np.ndarray:
        return np.concatenate([self._block(windows[i : i + block]) for i in range(0, len(windows), block)] or [np.zeros((0, len(self.net.langs)))])

    def _block(self, windows: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(windows.T)  # position first, so that the maximum runs over whole rows
        pairs = (x[:-1].astype(np.uint16) << 8) | x[1:]
        features = []
        for w, ts, bias in zip(WIDTHS, self.tables, self.net.biases, strict=True):
            n = WINDOW - w + 1
            total = np.take(ts[0], pairs[:n], axis=0)
            for k, t in enumerate(ts[1:], 1):
                index = pairs[2 * k : 2 * k + n] if len(t) > 256 else x[2 * k : 2 * k + n]
                total += np.take(t, index, axis=0)
            features.append(np.maximum(total.max(axis=0) / self.scale + bias, 0))
        return _log_softmax(np.concatenate(features, axis=1) @ self.net.out + self.net.out_bias)


_ASCII_LETTER = np.zeros(256, dtype=np.int64)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = 1


def predict_batch(model: Predictor | None, texts: pa.StringArray) -> tuple[list[str], list[float]]:
    """Languages and scores of one Arrow column."""
    n = len(texts)
    langs, scores = ["und"] * n, [0.0] * n
    if model is None or not n:
        return langs, scores
    texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"\x20", dtype=np.uint8)[: max(1, offsets[-1])]
    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    spoken = letters[np.minimum(offsets[1:], len(data))] > letters[np.minimum(offsets[:-1], len(data))]
    for i in np.flatnonzero(~spoken):
        spoken[i] = any(ch.isalpha() for ch in texts[int(i)].as_py())
    total = np.zeros((n, len(model.net.langs)))
    # A group of texts holds about 4 MB, but for a text longer than that.
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), side="right")) - 1)
        to = min(to, n)
        cut, owner, held = _cut(data, offsets[at : to + 1])
        np.add.at(total, at + owner, model.log_probs(cut) * held[:, None])
        at = to
    probs = np.exp(_log_softmax(total / np.maximum(np.diff(offsets), 1)[:, None]))
    best = probs.argmax(axis=1)
    for i in np.flatnonzero(spoken):
        langs[i], scores[i] = model.net.langs[best[i]], float(min(1.0, probs[i, best[i]]))
    return langs, scores


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, train_windows: int = TRAIN_WINDOWS) -> ByteCnn | None:
    """Train on ``labelled`` (doc_id, text, lang). The sample is bounded by languages x train_docs x train_windows x WINDOW characters."""
    h = F.xxhash64(F.lit(11), "doc_id", "text")
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", h.alias("h"))
    size = F.length("text")
    start = lambda k: F.lit(1) + F.pmod(F.xxhash64(F.lit(k), "h"), F.greatest(size - WINDOW + 1, F.lit(1)))
    # Only rows whose hash lies below about twice the share that is wanted are cut and ranked, so no task ranks a whole language;
    # a language of few distinct rows is taken whole. One row per language, which is one output of the network.
    share = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).select("lang", (F.lit(2.0 * train_docs + 100.0) / F.col("n")).alias("share"))
    near = rows.join(F.broadcast(share), "lang").where(F.col("h") / F.lit(2.0**64) + 0.5 <= F.col("share"))
    windows = near.select("lang", "h", F.array(*[F.substring(F.col("text"), start(k).cast("int"), F.lit(WINDOW)) for k in range(train_windows)]).alias("windows"))
    first = Window.partitionBy("lang").orderBy("h", "windows")
    sample = windows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= train_docs).orderBy("lang", "h", "windows").collect()
    pairs = [(w.encode("utf-8", "replace")[:WINDOW], r["lang"]) for r in sample for w in r["windows"] if w]
    if not pairs:
        return None
    langs = sorted({lang for _, lang in pairs})
    x, owner, _ = windows_of([t for t, _ in pairs])
    y = np.array([langs.index(lang) for _, lang in pairs])[owner]
    return train(x, y, langs)


def predict(docs: DataFrame, net: ByteCnn | None, keep: list[str], text_column: str = "text") -> DataFrame:
    """``keep`` columns of each document, then lang_pred and score."""
    rows = docs.select(*keep, F.col(text_column).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", lang_pred string, score double"
    names = [*keep, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None if net is None else Predictor(net)
        for batch in batches:
            langs, scores = predict_batch(model, batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)

    return rows.mapInArrow(run, schema)


def op8_language_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 4) == 2)
    net = fit(docs.where(~F.col("held_out")))
    return predict(docs, net, ["doc_id", "held_out"])
