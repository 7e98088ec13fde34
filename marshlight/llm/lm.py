"""Language-model scoring by a log-bilinear neural model with noise-contrastive training.

The model predicts the class of a token from the classes of the two before it: each frequent word is a class of
its own, the end of a text is one, and all other words are dealt to subclasses learned from the words they stand beside. Two context
matrices turn the vectors of the context into a predicted vector, whose product with a class vector (plus a bias) is its score. Training
against noise words avoids the normaliser; afterwards batched matrix products over all contexts give it exactly, so scores are true
log-probabilities. Within a subclass a word has its share of the counts of the whole corpus; words never met have together the share of
words met once, spread over spellings by a model of letters that is learned from these, so the mass of all words stays within one.
Every training document is learned from, whole: how often each class follows each pair of classes is counted once in Spark, shards of these
counts train networks of their own, and these are averaged. So results do not depend on how the rows lie in files.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .text import fold_share, hash_sample, most_frequent

CLASSES = 640  # frequent words, end and subclasses of the others, up to MANY distinct words; then more
MANY = 400_000
SUBCLASSES = 4  # one of so many classes is a subclass
SIZE = 32  # length of a vector
NOISE = 10  # noise words for each true one
ROUNDS = 3  # passes over the counts of all training documents
SHARD = 400_000  # distinct contexts with their class that one network trains on, about
BATCH = 512  # contexts in one step of training
STEPS = 800  # steps in a round, about; a smaller shard is gone through more than once
CHUNK = 250_000  # tokens a task works on at a time
HELD = 3_000_000  # tokens whose contexts a task counts before it hands them on
SPELLINGS = 4096  # kinds of endings; the subclass of a word that is not among the known ones is that of its ending
MARKS = 16  # numbers that describe the words on one side
KNOWN_WORDS = 200_000  # frequent words whose counts travel with the tasks; other words meet their counts in a join
END = b""  # no word is empty
ADD = 0.1  # smoothing of the base score


def tokens(text: str | None) -> list[bytes]:
    """Words between \\x20 and \\x09-\\x0D, A-Z lower-cased (bytes.split and bytes.lower know ASCII only), and one end."""
    return [*(text or "").encode("utf-8").lower().split(), END]


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, n) over all texts; each task adds up what it reads before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(tokens(text.as_py()))
                if len(seen) > 400_000:
                    yield emit(seen)
                    seen.clear()
        yield emit(seen)

    def emit(seen: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    return docs.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


_DIGITS = bytes(48 if 48 <= b < 58 else b for b in range(256))


@lru_cache(maxsize=100_000)
def _kind(ending: bytes) -> int:
    return zlib.crc32(ending.translate(_DIGITS)) % SPELLINGS


def spelling(word: bytes) -> int:
    """The kind of ending of a word; digits are alike."""
    return _kind(word[-3:])


def class_count(distinct: int) -> int:
    """How many classes a corpus of `distinct` words has; the tables of contexts grow with the square root of the words."""
    return int(CLASSES * max(1.0, distinct / MANY) ** 0.25)


@dataclass
class LogBilinear:
    """Context matrices, class vectors and biases; `normaliser` holds log sums for every pair of context classes."""

    vectors: np.ndarray
    near: np.ndarray  # for the class just before
    far: np.ndarray
    bias: np.ndarray
    normaliser: np.ndarray | None = None
    unmet: np.ndarray | None = None  # log-probability of a word never met, for every pair of context classes
    endings: np.ndarray | None = None  # the class of each kind of ending

    @classmethod
    def start(cls, shares: np.ndarray, seed: int) -> LogBilinear:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.05).astype(np.float32)
        return cls(draw(len(shares), SIZE), draw(SIZE, SIZE), draw(SIZE, SIZE), np.log(shares).astype(np.float32))

    def finish(self, unseen: np.ndarray | None = None) -> LogBilinear:
        """Pair tables of both context places, and the normaliser of all contexts by batched matrix products.

        unseen: the share that words never met have of each of the last classes.
        """
        k = len(self.bias)
        self.normaliser = np.empty((k, k), dtype=np.float32)
        self.unmet = None if unseen is None else np.empty((k, k), dtype=np.float32)
        near, far = self.vectors @ self.near, self.vectors @ self.far
        for far_class in range(k):
            z = (near + far[far_class]) @ self.vectors.T + self.bias
            top = z.max(axis=1)
            p = np.exp(z - top[:, None])
            total = p.sum(axis=1)
            self.normaliser[far_class] = top + np.log(total)
            if unseen is not None:
                self.unmet[far_class] = np.log(np.maximum(p[:, k - len(unseen):] @ unseen, 1e-37) / total)
        self.near_table, self.far_table = near @ self.vectors.T + self.bias, far @ self.vectors.T
        return self

    def log_probability(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log-probability of each class `word` after classes `far`, `near`."""
        k = len(self.bias)
        return self.far_table.take(far * k + word) + self.near_table.take(near * k + word) - self.normaliser.take(far * k + near)


class Training:
    """A network in training: noise-contrastive estimation with Adagrad, to tell the true class from NOISE classes drawn by their share."""

    def __init__(self, net: LogBilinear, shares: np.ndarray, rate: float, squares: list[np.ndarray] | None = None):
        self.net, self.rate = net, rate
        self.parts = (net.vectors, net.near, net.far, net.bias)
        self.squares = squares or [np.full_like(x, 1e-2) for x in self.parts]
        self.ladder = np.cumsum(shares)
        self.log_noise = np.log(NOISE * shares).astype(np.float32)

    def learn(self, far: np.ndarray, near: np.ndarray, word: np.ndarray, rng: np.random.Generator, batch: int, times: np.ndarray | None = None) -> None:
        """One pass over the tokens, each met so many `times`, in an order of its own."""
        net = self.net
        order = rng.permutation(len(word))
        times = np.ones(len(word), dtype=np.float32) if times is None else times.astype(np.float32)
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            f, n, w = far[rows], near[rows], word[rows]
            drawn = np.minimum(np.searchsorted(self.ladder, rng.random(NOISE)), len(self.ladder) - 1)  # one set of noise words a batch
            vf, vn, vw = (net.vectors.take(x, axis=0) for x in (f, n, w))
            guess = vf @ net.far + vn @ net.near
            true = (guess * vw).sum(axis=1) + net.bias[w] - self.log_noise[w]
            false = guess @ net.vectors[drawn].T + (net.bias - self.log_noise)[drawn]
            t = times[rows]
            up = t / (1 + np.exp(np.clip(true, -30, 30)))  # 1 - sigmoid
            down = -t[:, None] / (1 + np.exp(-np.clip(false, -30, 30)))
            back = up[:, None] * vw + down @ net.vectors[drawn]
            g_vectors, g_bias = np.zeros_like(net.vectors), np.bincount(w, up, len(net.bias)).astype(np.float32)
            places, sums = sum_by(np.concatenate([w, f, n]), np.concatenate([up[:, None] * guess, back @ net.far.T, back @ net.near.T]))
            g_vectors[places] = sums
            np.add.at(g_vectors, drawn, down.T @ guess)
            np.add.at(g_bias, drawn, down.sum(axis=0))
            for x, g, s in zip(self.parts, (g_vectors, vn.T @ back, vf.T @ back, g_bias), self.squares):
                g /= t.sum()
                s += g * g
                x += self.rate * g / np.sqrt(s)


def sum_by(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys (below 2^31), ascending, and the sum of the rows of each, in their order."""
    ranked = np.sort(keys << 32 | np.arange(len(keys)))  # faster than a stable argsort
    order, ranked = ranked & 0xFFFFFFFF, ranked >> 32
    first = np.flatnonzero(np.diff(ranked, prepend=-1))
    return ranked[first], np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def contexts(sequences: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes two before, just before and at every place; an end stands before each sequence."""
    padded = [np.concatenate([[end, end], s]) for s in sequences]
    return tuple(np.concatenate([p[a:len(p) - b] for p in padded]) for a, b in ((0, 2), (1, 1), (2, 0)))


def train(sequences: list[np.ndarray], shares: np.ndarray, end: int, batch: int = 512, epochs: int = 2, rate: float = 0.05, seed: int = 11) -> LogBilinear:
    """A network for sequences in memory."""
    course = Training(LogBilinear.start(shares, seed), shares, rate)
    far, near, word = contexts(sequences, end)
    rng = np.random.default_rng(seed + 1)
    for _ in range(epochs):
        course.learn(far, near, word, rng, batch)
    return course.net.finish()


class Coder(dict):
    """Codes of words: those given, and `start` plus the kind of ending for all others."""

    start = 0

    def __missing__(self, word: bytes) -> int:
        return self.start + _kind(word[-3:])


def coded_texts(docs: DataFrame, codes: dict[bytes, int], start: int) -> DataFrame:
    """All texts as codes, one behind the other, in rows (codes: 32-bit numbers as bytes) of whole texts and about CHUNK tokens.

    Words that are not in `codes` have `start` plus the kind of their ending. Each text ends in an end, and no other place has its code.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codes)  # bounded by KNOWN_WORDS

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        coder.start = start
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                words = tokens(text.as_py())
                held.append(np.fromiter(map(coder.__getitem__, words), dtype=np.int32, count=len(words)))
                size += len(words)
                if size >= CHUNK:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["codes"])

    return docs.select("text").mapInArrow(code, "codes binary")


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for codes in batch.column(0):
            yield np.frombuffer(codes.as_buffer(), dtype=np.int32)


def learn_subclasses(texts: DataFrame, others: list[bytes], own: int, classes: int) -> np.ndarray:
    """The subclass (0 to classes - 1) of each of the words `others` and of each kind of ending, from the words on both sides of all their occurrences.

    texts: see coded_texts; own classes, the end last, are below `own`, then come the others in order. A neighbour is known by its own class or its ending.
    """
    units, end = len(others), own - 1
    marks = np.random.default_rng(5).choice(np.array([-1, 1], dtype=np.float32), (own + SPELLINGS, MARKS))
    seen_as = np.concatenate([np.arange(own), np.fromiter((own + spelling(w) for w in others), np.int64, units), np.arange(own, own + SPELLINGS)])
    shared = texts.sparkSession.sparkContext.broadcast((marks, seen_as))  # bounded by KNOWN_WORDS
    names = [f"m{i}" for i in range(2 * MARKS)]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen_as = shared.value
        total = np.zeros((units + SPELLINGS, 2 * MARKS + 1), dtype=np.float32)
        for chunk in chunks(batches):
            code = np.concatenate([[end], chunk])  # texts end in an end, so one stands before each
            at = np.flatnonzero(code[1:] >= own) + 1
            if len(at):
                sides = *(marks.take(seen_as[code[at + d]], axis=0) for d in (-1, 1)), np.ones((len(at), 1), dtype=np.float32)
                places, sums = sum_by(code[at] - own, np.concatenate(sides, axis=1))
                total[places] += sums
        met = np.flatnonzero(total[:, -1])
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), *[pa.array(total[met, i]) for i in range(2 * MARKS + 1)]], ["unit", *names, "n"])

    schema = "unit int, " + ", ".join(f"{c} float" for c in [*names, "n"])
    found = texts.mapInArrow(describe, schema).groupBy("unit").agg(*[F.sum(c).cast("float").alias(c) for c in [*names, "n"]]).toArrow()
    if not found.num_rows:
        return np.zeros(units + SPELLINGS, dtype=np.int64)
    x = np.zeros((units + SPELLINGS, 2 * MARKS + 1), dtype=np.float32)
    x[found["unit"].to_numpy()] = np.stack([found[c].to_numpy() for c in [*names, "n"]], axis=1)
    if units:  # an ending is also that of known words
        places, sums = sum_by(seen_as[own:own + units] - own, x[:units])
        x[units + places] += sums
    return group_marks(x[:, :-1], x[:, -1], classes)


def group_marks(sums: np.ndarray, n: np.ndarray, groups: int, rounds: int = 10) -> np.ndarray:
    """Groups of alike rows by k-means over sums / n, rows weighted by n; means of few occurrences are drawn to the mean of all."""
    middle = sums.sum(axis=0) / n.sum()
    x = ((sums + 2 * middle) / (n + 2)[:, None] - middle).astype(np.float32)
    x /= np.maximum(x.std(axis=0), 1e-6)
    rng = np.random.default_rng(6)
    centres = x[rng.choice(len(x), min(groups, len(x)), replace=False, p=n / n.sum() if np.count_nonzero(n) >= groups else None)]
    group = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        for at in range(0, len(x), 20_000):
            part = x[at:at + 20_000]
            group[at:at + 20_000] = ((centres**2).sum(axis=1) - 2 * part @ centres.T).argmin(axis=1)
        places, sums_of = sum_by(group, np.concatenate([x * n[:, None], n[:, None]], axis=1).astype(np.float64))
        centres[places] = sums_of[:, :-1] / sums_of[:, -1:]
    return group


def count_contexts(texts: DataFrame, class_of: np.ndarray, classes: int, end: int) -> DataFrame:
    """(context, n): how often class w follows the classes f and n, context = (f * classes + n) * classes + w, over all texts with their ends.

    texts: see coded_texts; class_of: the class of each code, `end` for that of the end alone.
    """
    fixed = texts.sparkSession.sparkContext.broadcast(class_of)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emit() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["context", "n"])

        for chunk in chunks(batches):
            word = np.concatenate([[end, end], fixed.value[chunk]])  # an end stands before each text, and one more before its first word
            far, near = word[:-2].copy(), word[1:-1]
            far[near == end] = end
            held.append((far * classes + near) * classes + word[2:])
            size += len(chunk)
            if size >= HELD:
                yield emit()
                held, size = [], 0
        if held:
            yield emit()

    return texts.mapInArrow(count, "context long, n long").groupBy("context").agg(F.sum("n").alias("n"))


def train_on(counted: DataFrame, shares: np.ndarray, endings: np.ndarray, unseen: np.ndarray, rounds: int = ROUNDS, rate: float = 0.1, seed: int = 11, shard: int = SHARD) -> LogBilinear:
    """A network for all of `counted` (see count_contexts): in each round every shard goes on from the same network over its counts; the mean
    of what they come to, weighted by occurrences, starts the next. Shards are dealt by hash and sorted, once for all rounds, so they are the same in every run."""
    net = LogBilinear.start(shares, seed)
    names, k_classes = ("vectors", "near", "far", "bias"), len(shares)
    shapes = [getattr(net, x).shape for x in names]
    flat = lambda arrays: np.concatenate([x.ravel() for x in arrays])
    cuts = np.cumsum([math.prod(s) for s in shapes])[:-1]
    back = lambda v: [x.reshape(s).astype(np.float32) for x, s in zip(np.split(v, cuts), shapes)]
    state = np.stack([flat(getattr(net, x) for x in names), np.full(int(cuts[-1] + k_classes), 1e-2)])
    context = counted.sparkSession.sparkContext
    shards = max(1, -(-counted.count() // shard))
    dealt = counted.withColumn("shard", F.pmod(F.xxhash64("context"), F.lit(shards)).cast("int"))
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "context").select("shard", "context", "n")
    packed = stage(ordered.mapInArrow(pack_shards, "shard int, contexts binary, counts binary"))
    for k in range(rounds):
        start = context.broadcast(state.astype(np.float32))

        def work(batches: Iterator[pa.RecordBatch], k: int = k, start=start) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(state.shape), 0
            for number, key, n in unpacked(batches):
                course = Training(LogBilinear(*back(start.value[0])), shares, rate, back(start.value[1]))
                rng = np.random.default_rng((seed + k + 1, number))
                far, near, word = key // k_classes**2, key // k_classes % k_classes, key % k_classes
                for _ in range(max(1, STEPS // -(-len(key) // BATCH))):
                    course.learn(far, near, word, rng, BATCH, n)
                total += np.stack([flat(course.parts), flat(course.squares)]) * float(n.sum())
                seen += int(n.sum())
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(state.shape[1], dtype=np.int32)), *map(pa.array, total), pa.array(np.full(state.shape[1], seen))], ["place", "a", "b", "n"])

        found = packed.mapInArrow(work, "place int, a double, b double, n long").groupBy("place").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n")).toArrow()
        if found.num_rows:
            n = found["n"].to_numpy()
            state[:, found["place"].to_numpy()] = found["a"].to_numpy() / n, found["b"].to_numpy() / n
    net = LogBilinear(*back(state[0])).finish(unseen.astype(np.float32))
    net.endings = endings
    return net


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, contexts and counts of each shard of rows that are sorted by shard."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)])
        for part in np.split(rows, np.flatnonzero(np.diff(rows[0])) + 1, axis=1):
            if held and part.shape[1] and held[-1][0, -1] != part[0, 0]:
                whole = np.concatenate(held, axis=1)
                yield int(whole[0, 0]), whole[1], whole[2]
                held = []
            if part.shape[1]:
                held.append(part)
    if held:
        whole = np.concatenate(held, axis=1)
        yield int(whole[0, 0]), whole[1], whole[2]


def pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shard of rows that are sorted by shard; its contexts and counts are 64-bit numbers as bytes."""
    for number, key, n in by_shard(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([key.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["shard", "contexts", "counts"])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, contexts and counts of each shard that pack_shards has packed."""
    for batch in batches:
        for number, *packed in zip(*(batch.column(c) for c in range(3))):
            yield number.as_py(), *(np.frombuffer(x.as_buffer(), dtype=np.int64) for x in packed)


# --- words never met: a model of letters ------------------------------------------------------------

SYMBOLS = 64
WORD_END = SYMBOLS - 1  # stands before a word as well


def _symbol_table() -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each byte and log10 of its share of the symbol: letters alone, other bytes in groups of alike ones."""
    b = np.arange(256)
    symbol = np.where((b >= 97) & (b < 123), b - 97, np.where((b >= 48) & (b < 58), 26, np.where(b >= 192, 43 + (b - 192) // 8, np.where(b >= 128, 27 + b % 16, 51 + b % 12))))
    return symbol, -np.log10(np.bincount(symbol)[symbol])


_SYMBOL, _SPREAD = _symbol_table()


def letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all words one behind the other, each with its end: places in the table of letters, log10 shares of bytes, and where each word starts."""
    raw = np.frombuffer(b"\n".join(words) + b"\n", dtype=np.uint8)  # no word holds a line end
    end = raw == 10
    symbol, spread = np.where(end, WORD_END, _SYMBOL[raw]), np.where(end, 0.0, _SPREAD[raw])
    before = np.concatenate([[WORD_END], symbol[:-1]])
    first = np.concatenate([[WORD_END], before[:-1]])
    first[before == WORD_END] = WORD_END
    starts = np.concatenate([[0], np.flatnonzero(end)[:-1] + 1])
    return (first * SYMBOLS + before) * SYMBOLS + symbol, spread, starts


def letter_table(counts: DataFrame) -> np.ndarray:
    """log10 of a symbol after two others, from the words of `counts` that were met once; sparse contexts lean on shorter ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            words = [w for w in batch.column(0).to_pylist() if w]
            if words:
                total += np.bincount(letters(words)[0], minlength=SYMBOLS**3)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["place", "n"])

    found = counts.where("n = 1").select("token").mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    three = np.zeros(SYMBOLS**3)
    three[found["place"].to_numpy()] = found["n"].to_numpy()
    three = three.reshape((SYMBOLS,) * 3)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 0.5) / (one.sum() + 0.5 * SYMBOLS)
    p2 = (two + 4 * p1) / (two.sum(axis=1, keepdims=True) + 4)
    return np.log10((three + 4 * p2) / (three.sum(axis=2, keepdims=True) + 4)).reshape(-1)


def spelled(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """log10 probability of each word under the model of letters."""
    if not words:
        return np.zeros(0)
    place, spread, starts = letters(words)
    return np.add.reduceat(table[place] + spread, starts)


@dataclass
class Scorer:
    """What tasks need: the network, classes and counts of the most frequent words, and sums over the corpus."""

    net: LogBilinear | None
    counts: dict[bytes, int]  # at most KNOWN_WORDS entries
    classes: dict[bytes, int]  # of these words and the end
    total: int
    distinct: int
    rare_total: tuple[int, ...]  # occurrences of the words of each subclass
    rare_once: tuple[int, ...]  # words of each subclass met once
    letters: np.ndarray  # the model of letters, for words never met

    def base(self, count: float) -> float:
        return math.log10((count + ADD) / (self.total + ADD * (self.distinct + 1)))

    @property
    def own(self) -> int:
        """Classes that are one word, or the end; the subclasses follow."""
        return (len(self.net.bias) if self.net else len(self.rare_total)) - len(self.rare_total)

    def rare_share(self, count: float, subclass: int) -> float:
        """log10 of a word's share of its subclass; words never met have, of each subclass, the share of its words met once."""
        return math.log10(count / (self.rare_total[subclass] + max(self.rare_once[subclass], 1)))


def fit_scorer(docs: DataFrame, counts: DataFrame, classes: int | None = None, known_words: int = KNOWN_WORDS, sample_docs: int | None = None) -> Scorer:
    """A scorer for training documents `docs` whose token counts are `counts`.

    Subclasses, network, counts and class shares are those of all training documents, whole. `sample_docs` is for trials: with it the
    network and the subclasses learn from so many documents only.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    classes = classes or class_count(distinct)
    top = sorted((-r["n"], bytes(r["token"])) for r in most_frequent(counts, "n", known_words).collect())
    words, known = [w for _, w in top], {w: -n for n, w in top}
    subclasses = max(1, classes // SUBCLASSES)
    chosen = [w for w in words if w != END]
    own, others = [*chosen[:max(1, classes - subclasses - 1)], END], chosen[max(1, classes - subclasses - 1):]
    index = {w: i for i, w in enumerate(own)}
    if not total:
        return Scorer(None, known, index, 0, 0, (0,) * subclasses, (0,) * subclasses, letter_table(counts))
    seen = docs if sample_docs is None else stage(hash_sample(docs.select("doc_id", "text"), "doc_id", sample_docs))
    texts = stage(coded_texts(seen, index | {w: len(own) + i for i, w in enumerate(others)}, len(own) + len(others)))
    kinds = len(own) + learn_subclasses(texts, others, len(own), subclasses)
    index |= {w: int(k) for w, k in zip(others, kinds)}
    endings = kinds[len(others):]
    shared = docs.sparkSession.sparkContext.broadcast((index, endings))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, endings = shared.value
        sums = np.zeros((len(own) + subclasses, 2), dtype=np.int64)
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k = index.get(word)
                sums[endings[spelling(word)] if k is None else k] += (n, n == 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["class", "n", "once"])

    sums = np.zeros((len(own) + subclasses, 2), dtype=np.int64)
    for r in counts.select("token", "n").mapInArrow(add_up, "class int, n long, once long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("once").alias("once")).collect():
        sums[r["class"]] = r["n"], r["once"]
    shares = (sums[:, 0] + 1) / (sums[:, 0] + 1).sum()
    rare = sums[len(own):]
    unseen = np.maximum(rare[:, 1], 1)
    counted = stage(count_contexts(texts, np.concatenate([np.arange(len(own)), kinds]), len(own) + subclasses, len(own) - 1))
    net = train_on(counted, shares, endings, unseen / (rare[:, 0] + unseen))
    return Scorer(net, known, index, int(total), int(distinct), *(tuple(x) for x in rare.T.tolist()), letter_table(counts))


class _Ids(dict):
    def __missing__(self, key):
        return -1


def score_texts(docs: DataFrame, scorer: Scorer, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of `docs`.

    Tokens are the words of the text and one end, so a null or empty text has one token. Both scores are log10: the base score is that
    of add-0.1 unigrams, the score that of the model; a word never met has the mass of such words times its spelling's. Repeated rows are scored each, a null doc_id stays, other columns are
    ignored; an empty table gives an empty table. Without any training token, every word has the probability of its spelling alone.
    """
    names, own, net = list(scorer.counts), scorer.own, scorer.net
    classes = np.array([scorer.classes[w] for w in names], dtype=np.int64)
    base = np.array([scorer.base(scorer.counts[w]) for w in names])
    share = np.array([scorer.rare_share(scorer.counts[w], k - own) if k >= own else 0.0 for w, k in zip(names, classes)])
    ids = _Ids(zip(names, range(len(names))))
    end = scorer.classes[END]
    endings = net.endings if net is not None else np.full(SPELLINGS, own)
    shared = docs.sparkSession.sparkContext.broadcast((ids, classes, base, share, net, endings, scorer.letters))  # bounded by KNOWN_WORDS and the classes

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, classes, base, share, net, endings, table = shared.value
        ids = _Ids(ids)

        def scored(words: list[bytes], sizes: list[int], docs: pa.Array, digests: pa.Array) -> Iterator[pa.RecordBatch]:
            """All texts at once: `words` holds their tokens one behind the other, `sizes` how many each has."""
            rows, total = len(sizes), len(words)
            owner, starts = np.repeat(np.arange(rows), sizes), np.cumsum([0, *sizes[:-1]])
            add_up = lambda values, at=slice(None): np.bincount(owner[at], values, rows)
            at = np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=total)
            met = at >= 0
            known, unknown = at[met], np.flatnonzero(~met)
            # Each other word has a number, in order of its first place; a pair is such a word in a text.
            number: defaultdict[bytes, int] = defaultdict(numbers().__next__)
            word = np.fromiter((number[words[i]] for i in unknown.tolist()), dtype=np.int64, count=len(unknown))
            others = list(number)
            kinds = endings[np.fromiter(map(spelling, others), np.int64, len(others))]
            model = add_up(share[known], met)
            of_class = never = np.zeros(len(unknown))
            if net is not None:
                c = np.empty(total, dtype=np.int64)
                c[met], c[unknown] = classes[known], kinds[word]
                far, near = np.concatenate([[end, end], c[:-2]])[:total], np.concatenate([[end], c[:-1]])
                near[starts] = far[starts] = end
                far[starts[starts + 1 < total] + 1] = end
                log_p = net.log_probability(far, near, c).astype(np.float64) / math.log(10)
                model += add_up(log_p[met], met)
                of_class, never = log_p[unknown], net.unmet.take(far[unknown] * len(net.bias) + near[unknown]).astype(np.float64) / math.log(10)
            names = [b" %d" % (d & (2**64 - 1)) for d in digests.to_pylist()]
            yield batch_of(docs, digests, names, np.ones(rows), sizes, np.bincount(owner[met], minlength=rows), add_up(base[known], met), model, np.zeros(rows))
            if len(unknown):
                pairs, place, n = np.unique(owner[unknown] * len(others) + word, return_inverse=True, return_counts=True)
                text, word = pairs // len(others), pairs % len(others)
                none = np.zeros(len(pairs))
                yield batch_of(
                    docs.take(pa.array(text)), digests.take(pa.array(text)), pa.array(others, pa.binary()).take(pa.array(word)), none, n, none,
                    np.bincount(place, never) + n * spelled(others, table)[word], np.bincount(place, of_class), kinds[word] - own)

        def batch_of(*columns) -> pa.RecordBatch:
            made = (v.astype(t.to_pandas_dtype()) if isinstance(v, np.ndarray) else v for v, t in zip(columns, types))
            return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made, types)], names=labels)

        for batch in batches:
            words, sizes, first = [], [], 0
            for k, text in enumerate(batch.column(2)):
                found = tokens(text.as_py())
                words += found
                sizes.append(len(found))
                if len(words) > CHUNK or k + 1 == batch.num_rows:
                    yield from scored(words, sizes, *(batch.column(c).slice(first, k + 1 - first) for c in (0, 1)))
                    words, sizes, first = [], [], k + 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    labels = ["doc_id", "text_hash", "token", "copies", "n", "known", "base", "model", "subclass"]
    types = [pa.int64() if kind in ("bigint", "int") else pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32()]
    key = F.col("doc_id").cast("bigint") if kind in ("bigint", "int") else F.col("doc_id").cast("string")
    found = docs.select(key.alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        measure, f"doc_id {'bigint' if kind in ('bigint', 'int') else 'string'}, text_hash long, token binary, copies long, n long, known long, base double, model double, subclass int")
    # A row with copies = 1 is a text with its frequent words; its token, which holds a blank, meets no count. The others are other words.
    c = F.coalesce(F.col("c"), F.lit(0))
    room = F.get(F.lit([n + max(once, 1) for n, once in zip(scorer.rare_total, scorer.rare_once)]), F.col("subclass"))
    base_of = F.log10((c + ADD) / (scorer.total + ADD * (scorer.distinct + 1)))
    # Of another word, `base` holds the model's sum if it was never met and `model` its class's sum.
    share_of = F.when(c > 0, F.col("model") + F.col("n") * F.log10(c / room)).otherwise(F.col("base"))
    word = F.col("copies") == 0
    joined = found.join(counts.withColumnRenamed("n", "c").hint("shuffle_hash"), "token", "left").select(
        "doc_id", "text_hash", "copies", "n",
        F.when(word & (c > 0), F.col("n")).otherwise(F.col("known")).alias("known"),
        F.when(word, F.col("n") * base_of).otherwise(F.col("base")).alias("base"),
        F.when(word, share_of).otherwise(F.col("model")).alias("model"))
    texts = joined.groupBy("doc_id", "text_hash").agg(
        F.sum("copies").alias("copies"), F.sum(F.when(F.col("copies") > 0, F.col("n"))).alias("n_tokens"),
        F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("model").alias("model"))
    whole = lambda c: (F.col(c) / F.col("copies")).cast("long")
    return texts.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("doc_id").cast(kind).alias("doc_id"), whole("n_tokens").alias("n_tokens"), whole("known").alias("n_known"),
        F.lit(scorer.total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("model") / F.col("copies")).alias("score"))


def held_out_scores(docs: DataFrame, folds: int = 10) -> DataFrame:
    """score_texts of every row with held_out: counts and network come only from rows whose fold is not 0."""
    train_docs = docs.where(fold_share(F.col("doc_id"), folds) != 0)
    counts = stage(count_tokens(train_docs))
    scored = score_texts(docs, fit_scorer(train_docs, counts), counts)
    return scored.select("doc_id", (fold_share(F.col("doc_id"), folds) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
