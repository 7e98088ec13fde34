"""Language identification by a byte convolutional network, trained in numpy on labelled text.

Filters of several widths run over the bytes of fixed-length windows; the largest response of each filter in a
window goes through a softmax over the languages. A filter over one-hot bytes is a sum of table rows, so the
convolution is table lookups. All windows of a text are scored and their logits averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import fold_share, hash_sample, pieces

WIDTHS = (2, 3, 4, 5)
FILTERS = 8
WINDOW = 128
SAMPLE_DOCS = 4000  # labelled documents that training reads, with equal shares for the labels
SAMPLE_BYTES = 2048  # bytes of each of them it draws windows from
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_CHUNK = 1 << 18


@dataclass
class ByteNetwork:
    languages: list[str]
    tables: dict[int, np.ndarray] = field(default_factory=dict)  # width -> (width, 256, FILTERS)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32))
    dense: np.ndarray | None = None
    offset: np.ndarray | None = None

    @classmethod
    def start(cls, languages: list[str], seed: int) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        net = cls(languages)
        net.tables = {w: (rng.standard_normal((w, 256, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS}
        net.dense = (rng.standard_normal((len(WIDTHS) * FILTERS, len(languages))) * 0.2).astype(np.float32)
        net.offset = np.zeros(len(languages), dtype=np.float32)
        return net

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of every filter in every window, after the rectifier, and its place."""
        n, length = windows.shape
        values, places = [], []
        pairs = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        for w in WIDTHS:
            span = length - w + 1
            response = np.zeros((n, span, FILTERS), dtype=np.float32)
            for j in range(0, w - 1, 2):  # two bytes by one lookup
                both = (self.tables[w][j][:, None, :] + self.tables[w][j + 1][None, :, :]).reshape(65536, FILTERS)
                response += np.take(both, pairs[:, j:j + span], axis=0)
            if w % 2:
                response += np.take(self.tables[w][w - 1], windows[:, w - 1:], axis=0)
            values.append(response.max(axis=1))
            if where:
                places.append(response.argmax(axis=1))
        return np.maximum(np.concatenate(values, axis=1) + self.bias, 0), np.concatenate(places, axis=1) if where else None

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return self.pooled(windows)[0] @ self.dense + self.offset


def cut(raw: bytes, window: int = WINDOW) -> np.ndarray:
    """All of `raw` as rows of `window` bytes, the last one filled with blanks."""
    rows = max(1, -(-len(raw) // window))
    return np.frombuffer(raw.ljust(rows * window), dtype=np.uint8).reshape(rows, window)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 3, batch: int = 128, rate: float = 0.02, seed: int = 7) -> ByteNetwork:
    """Adam on the cross-entropy of single windows; the gradient of a pooled filter goes to the bytes at its place."""
    net = ByteNetwork.start(languages, seed)
    rng = np.random.default_rng(seed + 1)
    parts = {"dense": net.dense, "offset": net.offset, "bias": net.bias} | {w: net.tables[w] for w in WIDTHS}
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            x, y = windows[rows], labels[rows]
            features, places = net.pooled(x, where=True)
            error = softmax(features @ net.dense + net.offset)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.dense.T) * (features > 0)
            grads = {"dense": features.T @ error, "offset": error.sum(axis=0), "bias": back.sum(axis=0)}
            for k, w in enumerate(WIDTHS):
                grad = np.zeros_like(net.tables[w])
                g, p = back[:, k * FILTERS:(k + 1) * FILTERS], places[:, k * FILTERS:(k + 1) * FILTERS]
                for j in range(w):
                    np.add.at(grad[j], (np.take_along_axis(x, p + j, axis=1), np.arange(FILTERS)[None, :]), g)
                grads[w] = grad
            step += 1
            for k, v in parts.items():
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.01 * (grads[k] ** 2 - second[k])
                v -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return net


def fit_language(docs: DataFrame, label: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> ByteNetwork | None:
    """A network for the labels of `docs` (doc_id, text, label); None if no row has a label and a text.

    It learns from about `sample_docs` documents, an equal share for each label that has as many, at least one of each: those with
    the smallest hash of id and text, equal rows once. Of each it reads up to `sample_bytes` characters, from a place that depends on
    id and text. Rows without text or label are left out before the sample is drawn, so neither they nor repeated rows can fill it.
    """
    usable = docs.select("doc_id", "text", label).where(F.col(label).isNotNull() & (F.length("text") > 0))
    share = max(1, sample_docs // max(1, usable.select(label).distinct().count()))
    labelled = hash_sample(usable, ["doc_id", "text"], share, by=label)
    spot = F.pmod(F.xxhash64("doc_id", "text", F.lit("spot")), F.greatest(F.length("text") - sample_bytes, F.lit(1))) + 1
    drawn = sorted(labelled.select("order", F.substring(F.col("text"), spot.cast("int"), F.lit(sample_bytes)).alias("text"), label).collect())
    drawn = [r[1:] for r in drawn]
    if not drawn:
        return None
    languages = sorted({r[1] for r in drawn})
    index = {name: i for i, name in enumerate(languages)}
    cuts = [(cut(r[0].encode("utf-8")), index[r[1]]) for r in drawn]
    return train(np.concatenate([c for c, _ in cuts]), np.concatenate([np.full(len(c), i) for c, i in cuts]), languages)


def identify_language(docs: DataFrame, net: ByteNetwork | None) -> DataFrame:
    """doc_id, lang_pred, score of every row of `docs`, from its whole text and nothing else.

    A text that is null or has no letter is `und` with score 0, as is every text without a network. Repeated rows are judged
    each, a null doc_id stays, other columns are ignored; an empty table gives an empty table. The score is the softmax of the mean logits.
    """

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            names = np.full(len(texts), UNKNOWN, dtype=object)
            scores = np.zeros(len(texts))
            rows = [i for i, t in enumerate(texts) if net is not None and _LETTER.search(t)]
            raw = [texts[i].encode("utf-8") for i in rows]
            for a, b in pieces(raw, _CHUNK):
                cuts = [cut(x) for x in raw[a:b]]
                sizes = np.array([len(c) for c in cuts])
                windows = np.concatenate(cuts)
                step = _CHUNK // WINDOW
                logits = np.concatenate([net.logits(windows[k:k + step]) for k in range(0, len(windows), step)])
                mean = np.add.reduceat(logits, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
                share = softmax(mean.astype(np.float64))
                for i, row in zip(rows[a:b], share):
                    names[i], scores[i] = net.languages[int(row.argmax())], float(row.max())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": names, "score": scores})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(predict, f"doc_id {kind}, lang_pred string, score double")


def held_out_language(docs: DataFrame, folds: int = 5) -> DataFrame:
    """identify_language of every row with held_out: the network learned only from rows whose fold is not 0."""
    net = fit_language(docs.where(fold_share(F.col("doc_id"), folds) != 0))
    found = identify_language(docs, net)
    return found.select("doc_id", (fold_share(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")
