"""What several operators share: ASCII rules of text as column expressions and on numpy buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. `lower` is the faster way and the same where every character is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than \\x20 and \\x09-\\x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold_share(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's digits modulo `folds`; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of `counts` with the largest `n`: at most `most`, and none that as frequent a row outside is equal to.

    The least count comes from a histogram with 16 steps to a doubling, so neither a sort nor a large result is needed.
    """
    step = F.floor(F.log2(n) * 16)
    left, least = most, None
    for k, rows in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if rows > left:
            break
        left, least = left - rows, k
    return counts.where(step >= least) if least is not None else counts.limit(0)


def hash_sample(df: DataFrame, keys: str | list[str], rows: int, by: str | None = None) -> DataFrame:
    """The `rows` rows of `df` with the smallest hash of `keys`, and a column `order` to sort them by; with `by`, the sample of each of its values.

    All but about twice as many are left out by a bound on the hash before the sort, so what tasks return does not grow with their number.
    The bound goes by the distinct hashes, so equal keys in many rows count once: one of their rows is taken.
    """
    spread = 1 << 40
    hashed = df.withColumn("order", F.pmod(F.xxhash64(*([keys] if isinstance(keys, str) else keys)), F.lit(spread)))
    found = hashed.groupBy(*([by] if by else [])).agg(F.approx_count_distinct("order", 0.02).alias("n")).collect()
    bound = {r[0] if by else None: int(spread * min(1.0, (2 * rows + 100) / max(1, r["n"]))) for r in found}
    if not by:
        return hashed.where(F.col("order") < bound[None]).dropDuplicates(["order"]).orderBy("order").limit(rows)
    limit = F.coalesce(*[F.when(F.col(by) == value, F.lit(b)) for value, b in bound.items()], F.lit(0)) if bound else F.lit(0)
    few = hashed.where(F.col("order") < limit).dropDuplicates([by, "order"])
    place = Window.partitionBy(by).orderBy("order")
    return few.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= rows).drop("_place")


def pieces(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of `texts` that hold about `limit` bytes each; a longer text is a range of its own."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


_MIX = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers have inverses modulo 2^64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other (splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts in order, and the number of words of each text.

    A polynomial over the bytes, taken for all words at once from one running sum.
    """
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    first, last = edge[0::2], edge[1::2]
    owner_end = np.cumsum(lengths + 1)
    words = np.searchsorted(first, owner_end, side="left")
    counts = np.diff(words, prepend=0)
    if not len(first):
        return np.empty(0, dtype=np.uint64), counts
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_MIX[_LOWER[raw]] * powers(_BASE, len(raw)), out=total[1:], dtype=np.uint64)
    unshift = powers(_BASE_INVERSE, int(first[-1]) + 1)[first]
    return scramble((total[last] - total[first]) * unshift), counts


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes, ascending, of every run of `width` words; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    take = min(width, n)
    rows = np.zeros(n - take + 1, dtype=np.uint64)
    for k in range(take):
        rows = rows * np.uint64(0xD6E8FEB86659FD93) + words[k:n - take + 1 + k]
    return np.unique(scramble(rows + np.uint64(take)))
