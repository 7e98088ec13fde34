"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding maps look-alike letters, digits and signs to plain letters and keeps the length of the text. The lexicon
holds word beginnings with weights learned from labelled documents. A match inside an exception phrase does not count; of such
phrases some are given, others are learned: pairs of words in clean documents with a match that toxic ones do not share. A
document's matches, plain and normalised by its length, go through a logistic function.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .text import fold_share, hash_sample

SAMPLE_DOCS = 4000  # labelled documents of each class that the lexicon is learned from
STEM = (4, 12)  # letters of a learned word beginning; a shorter word is learned whole, with the blank after it
ODDS = 2.5  # log odds of a learned stem, from its rates in both classes
EVIDENCE = 8.0  # nats by which its counts are likelier with rates of their own than with one for both classes
#: Harmless phrases that hold a word of the lexicon, known beforehand; others are learned.
EXCEPTIONS = ("trash can", "trash bag", "clown fish", "idiot proof", "scum of pond", "not stupid", "not worthless")

# Look-alikes of plain letters in Greek, Cyrillic and full width, digits and signs for letters.
_FOLD = str.maketrans(
    "0134578@$!|" "АВЕКМНОРСТУХаеорсухікнвмтѕјԁ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαεικορτυχν",
    "oieastbasil" "abekmhopctyxaeopcyxikhbmtsjd" "abezhikmnoptyxaeikoptyxv")
_FOLD |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_FOLD |= {65 + i: chr(97 + i) for i in range(26)}
_FOLD |= {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in "@$!|"}


def fold(text: str) -> str:
    """Letters in lower case and plain form, punctuation as blanks, one blank before and after."""
    folded = text.translate(_FOLD)
    return f" {folded if folded.isascii() else folded.lower()} "


def fold_words(text: str) -> str:
    """`fold` of the text with one blank for each run of white space, so that only words and punctuation matter."""
    return fold(" ".join(text.split()))


@dataclass
class Lexicon:
    weights: dict[str, float]  # word beginnings
    exceptions: tuple[str, ...] = EXCEPTIONS
    model: tuple[float, ...] = (1.0, 1.0, 1.0, -2.0)

    @cached_property
    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for stem, weight in self.weights.items():
            machine.add_word(" " + stem, (len(stem), weight))
        for phrase in self.exceptions:
            machine.add_word(" " + phrase, (len(phrase), None))
        if len(machine):
            machine.make_automaton()
        return machine

    def matches(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of the matches outside exception phrases; of several at one place the heaviest."""
        if not len(self.automaton):
            return []
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                excused.append((start, end + 1))
            else:
                best[start] = max(weight, best.get(start, -math.inf))
        return [(s, w) for s, w in best.items() if not any(a <= s < b for a, b in excused)]

    def features(self, text: str) -> list[float]:
        """1 for any match, log weight of all matches, weight per hundred words, constant."""
        folded = fold_words(text)
        found = self.matches(folded)
        total = sum(w for _, w in found)
        words = len(folded.split()) if found else 1
        return [float(bool(found)), math.log1p(total), min(50.0, 100 * total / max(words, 1)), 1.0]

    def pairs(self, text: str) -> set[str]:
        """Each match that counts with the word before it, and with the one after it, where only a blank is between."""
        folded = fold_words(text)
        found = set()
        for start, _ in self.matches(folded):
            end = folded.find(" ", start)
            before = folded.rfind(" ", 0, start - 1) + 1
            after = folded.find(" ", end + 1)
            if before < start - 1:
                found.add(folded[before:end + 1])
            if after > end + 1:
                found.add(folded[start:after + 1])
        return found

    def score(self, text: str) -> float:
        z = sum(a * b for a, b in zip(self.model, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "model": self.model}


def stems(text: str) -> set[str]:
    low, high = STEM
    words = set(fold(text).split())
    return {w[:n] for w in words for n in range(low, min(high, len(w)) + 1)} | {w + " " for w in words if 1 < len(w) < low}


def nats(t: int, c: int, toxic: int, clean: int) -> float:
    """Log likelihood ratio of a stem in `t` of `toxic` and `c` of `clean` documents: two rates against one."""
    total, found = toxic + clean, t + c
    cells = ((t, toxic, found), (c, clean, found), (toxic - t, toxic, total - found), (clean - c, clean, total - found))
    return sum(k * math.log(k * total / (n * m)) for k, n, m in cells if k)


def log_odds(t: int, c: int, toxic: int, clean: int) -> float:
    return math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))


def choose_stems(counts: dict[str, tuple[int, int]], toxic: int, clean: int, weight: float = ODDS, least: float = EVIDENCE) -> dict[str, float]:
    """Word beginnings that mark toxic documents; of those that begin alike the longest that loses no more than a tenth.

    counts: in how many toxic and clean documents. weight: log odds at least; least: evidence at least.
    """
    odds = {s: log_odds(t, c, toxic, clean) for s, (t, c) in counts.items()}
    good = sorted((s for s, (t, c) in counts.items() if odds[s] >= weight and nats(t, c, toxic, clean) >= least), key=lambda s: (-counts[s][0], -len(s), s))
    chosen: dict[str, float] = {}
    under: Counter[str] = Counter()  # beginnings of chosen stems, with the documents of the most common one
    for s in good:
        if any(s[:n] in chosen for n in range(STEM[0], len(s))) or under[s] >= 0.9 * counts[s][0]:
            continue
        chosen[s] = odds[s]
        for n in range(STEM[0], len(s)):
            under[s[:n]] = max(under[s[:n]], counts[s][0])
    return chosen


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: float, rounds: int = 50) -> np.ndarray:
    """Newton steps for a ridge logistic regression, classes weighted to `prior`, the share of label 1."""
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 0.1 * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        move = np.linalg.solve(bend, slope)
        beta += move
        if np.abs(move).max() < 1e-6:
            break
    return beta


def count_by_class(sample: DataFrame, items: Callable[[str], set[str]]) -> DataFrame:
    """item, clean, toxic: in how many texts of `sample` (text, toxic) of each class each item is."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                seen[toxic].update(items(text or ""))
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield emit(seen)
                    seen = (Counter(), Counter())
        yield emit(seen)

    def emit(seen: tuple[Counter[str], Counter[str]]) -> pd.DataFrame:
        names = list(seen[0].keys() | seen[1].keys())
        return pd.DataFrame({"item": names, "clean": [seen[0][s] for s in names], "toxic": [seen[1][s] for s in names]})

    return sample.mapInPandas(count, "item string, clean long, toxic long").groupBy("item").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learn_exceptions(sample: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Pairs of words around a match that mark clean documents among all documents with a match, by the rule for stems turned round."""
    if not lexicon.weights:
        return ()
    match = "\n"  # counts the documents with a match; no pair of words is this

    def around(text: str) -> set[str]:
        return {match} if lexicon.features(text)[0] else set()

    totals = count_by_class(sample, around).first()
    if totals is None:
        return ()
    toxic, clean = totals["toxic"], totals["clean"]
    few = next((c for c in range(1, clean + 1) if nats(0, c, toxic, clean) >= EVIDENCE), clean + 1)
    rows = count_by_class(sample, lexicon.pairs).where(F.col("clean") >= few).collect()  # at most 2 of a match, each in `few` texts
    return tuple(sorted(r["item"] for r in rows if log_odds(r["toxic"], r["clean"], toxic, clean) <= -ODDS and
                        nats(r["toxic"], r["clean"], toxic, clean) >= EVIDENCE))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon for labels.toxic. It learns from at most `sample_docs` documents of each class, those with the
    smallest hash of their id (of equal texts with one label, one); without documents of both classes it is empty, and every text scores under 0.5."""
    marks = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counted = dict(marks.groupBy("toxic").count().collect())
    if len(counted) < 2:
        return Lexicon({}, exceptions)
    wanted = [hash_sample(marks.where(F.col("toxic") == k), "doc_id", sample_docs).drop("order") for k in (0, 1)]
    drawn = docs.select("doc_id", "text").join(wanted[0].unionByName(wanted[1]), "doc_id")
    # Copies of one document with one label are one witness, or each of its words would seem a mark of its label.
    sample = stage(drawn.groupBy(F.sha2("text", 256).alias("digest"), "toxic").agg(F.first("text").alias("text")).select("text", "toxic"))
    size = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not clean or not toxic:
        return Lexicon({}, exceptions)

    found = count_by_class(sample, stems)
    # Stems of so few documents that no count of clean ones gives them the evidence stay in the tasks; so do those common in clean documents.
    few = next((t for t in range(1, toxic + 1) if nats(t, 0, toxic, clean) >= EVIDENCE), toxic + 1)
    rates = (F.col("toxic") + 0.5) / (toxic + 1) >= 0.999 * math.exp(ODDS) * (F.col("clean") + 0.5) / (clean + 1)
    rows = found.where((F.col("toxic") >= few) & rates).collect()
    lexicon = Lexicon(choose_stems({r["item"]: (r["toxic"], r["clean"]) for r in rows}, toxic, clean), exceptions)
    lexicon = Lexicon(lexicon.weights, exceptions + learn_exceptions(sample, lexicon))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([lexicon.features(t or "") for t in batch["text"]]).reshape(-1, 4)
            yield pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "toxic": batch["toxic"]})

    x = np.array(sample.mapInPandas(measure, "a double, b double, c double, toxic int").collect(), dtype=float)
    x = x[np.lexsort(x.T)]  # sums in an order of their own, whatever order the rows came in
    prior = counted[1] / (counted[0] + counted[1])
    lexicon.model = tuple(fit_logistic(np.column_stack([x[:, :3], np.ones(len(x))]), x[:, 3], prior))
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if the score is 0.5 or more) of every row of `docs`.

    A null or empty text scores as one without matches. Repeated rows are scored each, a null doc_id stays, other columns
    are ignored; an empty table gives an empty table. A text is read whole, however long.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = np.array([lexicon.score(t or "") for t in batch["text"]], dtype=float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores, "predicted": (scores >= 0.5).astype(np.int32)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(judge, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, lexicon: Lexicon, limit: float = 0.5) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text scores under `limit`; rows are judged one by one."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([lexicon.score(t.as_py() or "") < limit for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """score_toxicity of every row with held_out: the lexicon learned only from rows whose fold is not 0."""
    lexicon = fit_toxicity(docs, labels.where(fold_share(F.col("doc_id"), folds) != 0))
    found = score_toxicity(docs, lexicon)
    return found.select("doc_id", (fold_share(F.col("doc_id"), folds) == 0).alias("held_out"), "score", "predicted")
