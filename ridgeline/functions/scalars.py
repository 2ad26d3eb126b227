"""Scalar expressions shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.model import SPLITS

# Tolerance of the agreement test, |a - b| <= ABS + REL * |b|.
ABS_TOLERANCE = 1e-8
REL_TOLERANCE = 1e-5


def nan_to_null(c: Column) -> Column:
    """One notion of "missing": a floating NaN becomes NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def is_finite(c: Column) -> Column:
    """True for a present, finite number; NULL counts as not finite."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as a double, NULL where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def percent_text(c: Column) -> Column:
    return F.format_string("%.2f%%", c)


def fixed_text(c: Column, digits: int = 6, signed: bool = False) -> Column:
    return F.format_string(f"%{'+' if signed else ''}.{digits}f", c)


def bin_labels(edges: Sequence[float]) -> list[str]:
    return [f"({a:g}, {b:g}]" for a, b in zip(edges, edges[1:])]


def right_closed_bin(c: Column, edges: Sequence[float]) -> Column:
    """0-based number of the bin ``(a, b]``; NULL outside all bins."""
    pairs = list(zip(edges, edges[1:]))
    out = F.when((c > pairs[0][0]) & (c <= pairs[0][1]), F.lit(0))
    for i, (a, b) in enumerate(pairs[1:], start=1):
        out = out.when((c > a) & (c <= b), F.lit(i))
    return out


def bin_label(number: Column, edges: Sequence[float]) -> Column:
    labels = F.array(*[F.lit(x) for x in bin_labels(edges)])
    return F.get(labels, number)


def equal_width_bin(c: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of ``bins`` equal ones over [low, high]; the last is closed.

    The first guess may be off by one near an edge through rounding, so it is
    moved until the edges ``low + i * step`` really enclose the value. A column
    with a single value gets the range value +- 0.5, split like any other.
    """
    flat = low == high
    lo = F.when(flat, low - 0.5).otherwise(low)
    hi = F.when(flat, high + 0.5).otherwise(high)
    step = (hi - lo) / bins
    guess = F.least(F.floor((c - lo) / step), F.lit(bins - 1)).cast("int")
    lower = lo + guess * step
    upper = lo + (guess + 1) * step
    return (
        F.when((c < lower) & (guess > 0), guess - 1)
        .when((c >= upper) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )


def agrees(a: Column, b: Column) -> Column:
    """Equal within tolerance; a missing side never agrees."""
    close = F.abs(a - b) <= F.lit(ABS_TOLERANCE) + F.lit(REL_TOLERANCE) * F.abs(b)
    return F.coalesce(close & ~F.isnan(a) & ~F.isnan(b), F.lit(False))


def split_position(c: Column, order: Sequence[str] = SPLITS) -> Column:
    """1-based place of a split name in the wanted order, as a sort key."""
    return F.array_position(F.array(*[F.lit(s) for s in order]), c)


def verdict(metric: Column, difference: Column) -> Column:
    """``better`` or ``worse`` for candidate minus baseline.

    A larger R2 is better; for error metrics a smaller value is.
    """
    gain = F.when(metric == "R2", difference > 0).otherwise(difference < 0)
    return F.when(gain, F.lit("better")).otherwise(F.lit("worse"))


def depth_text(c: Column) -> Column:
    """Depth limit as text, ``None`` where unlimited."""
    return F.coalesce(c.cast("int").cast("string"), F.lit("None"))


def base_feature(name: Column, features: Sequence[str]) -> Column:
    """Original column behind an encoded feature name.

    ``num__x`` and ``cat__x_value`` go to the longest known column that fits;
    ``x_indexed_encoded_value`` loses its suffix. Anything else is kept, so that
    unknown names stay visible to the expected-set check.
    """
    clean = F.trim(name)
    known = "|".join(re.escape(f) for f in sorted(features, key=len, reverse=True))
    prefixed = F.regexp_extract(clean, rf"^(?:num__|cat__)({known})(?:_.*)?$", 1)
    suffixed = F.regexp_extract(clean, r"^(.+)_indexed_encoded_.+$", 1)
    return (
        F.when(clean.rlike(r"^(?:num__|cat__).+$"), F.coalesce(F.nullif(prefixed, F.lit("")), clean))
        .when(suffixed != "", suffixed)
        .otherwise(clean)
    )
