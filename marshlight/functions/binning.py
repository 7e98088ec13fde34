"""Numeric values to labelled classes; breaks are a short driver-side list, labels are literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


def _classes(c: Column | str, breaks: Sequence[float], values: Sequence, right: bool) -> Column:
    """The value of the class of `c` between consecutive breaks; null outside the outer breaks.

    Classes are closed on the left (`right=False`, the last one on both sides) or closed on the right
    (`right=True`, the first one on both sides).
    """
    c = as_col(c)
    breaks = sorted(breaks)
    last = len(breaks) - 2
    out = None
    for i in range(last + 1):
        low, high = F.lit(float(breaks[i])), F.lit(float(breaks[i + 1]))
        if right:
            above = (c >= low) if i == 0 else (c > low)
            cond = above & (c <= high)
        else:
            below = (c <= high) if i == last else (c < high)
            cond = (c >= low) & below
        value = F.lit(values[i])
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


def bin_index(c: Column | str, breaks: Sequence[float], right: bool = False) -> Column:
    """0-based class number."""
    return _classes(c, breaks, list(range(len(breaks) - 1)), right)


def bin_label(c: Column | str, breaks: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    if len(labels) != len(breaks) - 1:
        raise ValueError("one label per class is needed")
    return _classes(c, breaks, list(labels), right)


def number_text(x: float, decimals: int) -> str:
    """Plain text of a break: rounded, without trailing zeros."""
    return f"{round(x, decimals):.{decimals}f}".rstrip("0").rstrip(".") if decimals else f"{round(x)}"


def half_open_labels(breaks: Sequence[float], decimals: int = 1, suffix: str = "%") -> list[str]:
    """Labels "< a", "[a-b)", ">= z" for left-closed classes."""
    if len(breaks) < 2:
        raise ValueError("at least two breaks are needed")
    text = [number_text(b, decimals) for b in sorted(breaks)]
    labels = [f"[{lo}-{hi}){suffix}" for lo, hi in zip(text, text[1:])]
    labels[0] = f"< {text[1]}{suffix}"
    labels[-1] = f">= {text[-2]}{suffix}"
    return labels


def cut_half_open(c: Column | str, breaks: Sequence[float], decimals: int = 1, suffix: str = "%") -> Column:
    return bin_label(c, breaks, half_open_labels(breaks, decimals, suffix))


def thousands_labels(breaks: Sequence[float]) -> list[str]:
    """Labels "< 1k", "1 - 2k", "> 2k" around interior breaks."""
    text = [f"{b / 1000:,.15g}".replace(",", "'") for b in breaks]
    middle = [f"{lo} - {hi}k" for lo, hi in zip(text, text[1:])]
    return [f"< {text[0]}k", *middle, f"> {text[-1]}k"]


def cut_thousands(c: Column | str, inner_breaks: Sequence[float]) -> Column:
    """Right-closed classes from 0 over the interior breaks to infinity."""
    return bin_label(c, [0.0, *inner_breaks, float("inf")], thousands_labels(inner_breaks), right=True)


def int_text(c: Column | str, missing: str = "<=60%") -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(missing))
