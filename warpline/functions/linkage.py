"""Scores for record linkage: errors, similarities, evidence, verdicts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Similarity weights of the linkage score.
WEIGHTS = {"stitches": 50, "width": 15, "height": 15, "colours": 15}
#: Limits of the strict predicate and of the verdicts.
STRICT_STITCH_ERROR, STRICT_WIDTH_ERROR = 0.001, 0.01
POSSIBLE, WEAK = 70, 50
#: Fixed value: from this error on a similarity is 0.
LARGEST_ERROR = 0.05
#: Declared widths are this many times the stitch file's units;
#: end points are ten times; one unit is 0.1 mm.
WIDTH_SCALE, END_SCALE, UNIT_MM = 18.0, 10.0, 0.1
#: Fixed value: from this share of the size on, end points aren't similar.
LARGEST_END_ERROR = 0.02


def normalize_ascii(name: Column) -> Column:
    """Lower-cased, other than a-z and 0-9 dropped; native, for ASCII names."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def _folded(form: str):
    def fold(names: pd.Series) -> pd.Series:
        def one(x):
            x = unicodedata.normalize(form, x).casefold().replace("ё", "е")
            return re.sub("[^a-z0-9а-я]", "", x)

        return names.map(one, na_action="ignore")

    return F.pandas_udf(fold, "string")


def normalize_name(name: Column, form: str = "NFKC") -> Column:
    """Unicode-normalised (NFKC or NFKD), case-folded, Cyrillic yo as ye, other
    than Latin and Cyrillic letters and digits dropped."""
    return _folded(form)(name)


def relaxed_name(name: Column) -> Column:
    return F.regexp_replace(name, r"^\d+", "")


def parse_signed_number(text: Column) -> Column:
    """The first whole number with its sign, blanks between allowed; else null."""
    digits = F.try_to_number(F.regexp_extract(text, r"([+-]?)\s*(\d+)", 2), F.lit("9" * 18)).cast("long")
    return F.when(F.regexp_extract(text, r"([+-]?)\s*(\d+)", 1) == "-", -digits).otherwise(digits)


def relative_error(a: Column, b: Column) -> Column:
    """|a - b| over the larger of |a|, |b| and 1; null if either is."""
    return F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1)))


def similarity(error: Column, largest: float) -> Column:
    return F.when(error.isNotNull(), F.greatest(F.lit(0.0), 1 - error / F.lit(largest)))


def weighted_scores(parts: Sequence[tuple[Column, float]]) -> dict[str, Column]:
    """evidence, quality and coverage in percent, two decimals: similarities
    (clamped to 0..1) earn their weights; a null one is left out of the quality's
    base and of the coverage."""
    whole = float(sum(w for _, w in parts))
    earned = sum((F.coalesce(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)) * F.lit(float(w)), F.lit(0.0)) for s, w in parts), F.lit(0.0))
    available = sum((F.when(s.isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for s, w in parts), F.lit(0.0))
    return {
        "evidence": F.round(earned / whole * 100, 2),
        "quality": F.when(available > 0, F.round(earned / available * 100, 2)).otherwise(F.lit(0.0)),
        "coverage": F.round(available / whole * 100, 2),
    }


def mean_available(flags: Sequence[Column]) -> Column:
    """Share of true among the flags that aren't null; null if all are."""
    n = sum((F.when(f.isNotNull(), 1).otherwise(0) for f in flags), F.lit(0))
    return F.when(n > 0, sum((F.when(f, 1).otherwise(0) for f in flags), F.lit(0)) / n)


def colour_flags(changes: Column, colours: Column, declared: Column) -> tuple[Column, Column]:
    return changes == declared, colours == declared + 1


def strict(stitch_error: Column, width_error: Column, flags: Sequence[Column], stitch_limit: float = STRICT_STITCH_ERROR, width_limit: float = STRICT_WIDTH_ERROR) -> Column:
    """True only if every condition is known and holds."""
    out = (stitch_error <= stitch_limit) & (width_error <= width_limit)
    for f in flags:
        out = out & f
    return F.coalesce(out, F.lit(False))


def verdict(score: Column, is_strict: Column) -> Column:
    return F.when(is_strict, "strict").when(score >= POSSIBLE, "possible").when(score >= WEAK, "weak").otherwise("different")


def declared_extent(whole: Column, low: Column, high: Column) -> Column:
    """A declared width or height, or the sum of its two sides."""
    return F.coalesce(F.abs(whole), F.abs(low) + F.abs(high))


def end_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def bounds_extent(low: Column, high: Column) -> Column:
    """The extent between two sides given in one coordinate."""
    return F.abs(high - low)


def end_error(distance: Column, width: Column, height: Column) -> Column:
    """A distance of end points over the larger extent, 1 at least."""
    return distance / F.greatest(width, height, F.lit(1))
