"""The feature-name grammar, forwards (raw column -> names) and backwards."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The statistics of each feature family and their spelling.
FULL_STATS = ("mean", "std", "min", "max", "median", "last", "first")
RECENT_STATS = ("mean", "std", "min", "max", "last")
DIFF_STATS = ("mean", "std", "min", "max")
CATEGORY_STATS = ("count", "nunique", "last")
RECENT_WINDOWS = (3, 6)

NUMERIC_STATS = (
    *FULL_STATS,
    *[f"{s}_{n}m" for n in RECENT_WINDOWS for s in RECENT_STATS],
    *[f"diff_{s}" for s in DIFF_STATS],
    "last_minus_mean",
)
# The notebook dialect spells these two families differently.
NOTEBOOK_SPELLING = {"last_minus_mean": "lag", **{f"diff_{s}": f"{s}_diff" for s in DIFF_STATS}}
FROM_NOTEBOOK = {v: k for k, v in NOTEBOOK_SPELLING.items()}

_STATS = sorted({*NUMERIC_STATS, *NOTEBOOK_SPELLING.values(), *CATEGORY_STATS}, key=len, reverse=True)
# The lazy prefix makes the longest possible suffix win.  The same text is valid
# for Python, Java and RE2, so tables of names parse the same way as lists.
FEATURE_PATTERN = f"^(.+?)_({'|'.join(_STATS)})$"
_FEATURE = re.compile(FEATURE_PATTERN)


class Feature(NamedTuple):
    """One output column: its name, the raw column and the statistic behind it."""

    name: str
    raw: str
    stat: str


def feature_name(raw: str, stat: str, dialect: str = "batch") -> str:
    return f"{raw}_{NOTEBOOK_SPELLING.get(stat, stat) if dialect == 'notebook' else stat}"


def parse_feature(name: str) -> Feature | None:
    match = _FEATURE.match(name)
    if match is None:
        return None
    raw, stat = match.groups()
    return Feature(name, raw, FROM_NOTEBOOK.get(stat, stat))


def all_features(
    continuous: Sequence[str], categorical: Sequence[str], dialect: str = "batch"
) -> list[Feature]:
    numeric = [(c, s) for c in continuous for s in NUMERIC_STATS]
    category = [(c, s) for c in categorical for s in CATEGORY_STATS]
    return [Feature(feature_name(c, s, dialect), c, s) for c, s in numeric + category]


def raw_columns(names: Iterable[str], always: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Raw columns behind the names, in order of first use, after ``always``."""
    parsed = (parse_feature(n) for n in names)
    found = [p.raw for p in parsed if p is not None and p.raw not in exclude]
    return list(dict.fromkeys([*always, *found]))


def raw_column(name: Column | str) -> Column:
    """``parse_feature(name).raw`` over a table of names; NULL where none fits."""
    return F.nullif(F.regexp_extract(name, FEATURE_PATTERN, 1), F.lit(""))
