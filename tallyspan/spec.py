"""The one description every operator shares: which columns mean what."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallyspan.functions.scalar import number_sql

# A group of rows larger than this is never handed to one task: it is cut into
# ordered slices first (see operators/skew.py).
HOT_ROWS = 1_000_000
# What breaks ties of a spec whose order may repeat.
TIE = "_tie"


@dataclass(frozen=True)
class Spec:
    """Roles of the columns of a statement table.

    ``date`` then ``tiebreak`` order the rows of one entity; together they
    should be unique within the entity, so that "last", "previous" and "first"
    have one answer.  A NULL date sorts as the oldest row.
    """

    id: str
    date: str
    tiebreak: tuple[str, ...] = ()
    target: str | None = None
    continuous: tuple[str, ...] | None = None
    categorical: tuple[str, ...] = field(default=())
    # True promises that (date, tiebreak) never repeats within an entity, which
    # spares hot entities a pass that numbers exact copies of a row.
    unique_order: bool = False

    @property
    def order_columns(self) -> list[str]:
        return [self.date, *self.tiebreak]

    def order(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in self.order_columns]

    def continuous_in(self, df: DataFrame) -> list[str]:
        """Continuous columns: those named, else every numeric one that has no other role."""
        if self.continuous is not None:
            return [c for c in self.continuous if c in df.columns]
        return infer_continuous(
            df, [self.id, *self.order_columns, self.target, *self.categorical]
        )

    def categorical_in(self, df: DataFrame) -> list[str]:
        return [c for c in self.categorical if c in df.columns]

    def total_order(self, df: DataFrame) -> tuple[DataFrame, Spec]:
        """``df`` and a spec whose order leaves no choice that values could show.

        Rows that tie on the order are sorted by all value columns in spec order, NULLs
        first, whatever the layout, the size of the entity or the columns asked for; rows
        that tie on these as well are interchangeable.
        """
        if self.unique_order or TIE in self.tiebreak:
            return df, self
        numbers = [F.expr(number_sql(c)) for c in self.continuous_in(df)]
        texts = [F.col(c).cast("string") for c in self.categorical_in(df)]
        values = [v.alias(f"v{i}") for i, v in enumerate([*numbers, *texts])]
        if not values:
            return df, self
        return df.withColumn(TIE, F.struct(*values)), replace(self, tiebreak=(*self.tiebreak, TIE))


def infer_continuous(df: DataFrame, exclude: Sequence[str | None]) -> list[str]:
    """Numeric columns in schema order, minus ``exclude``."""
    taken = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in taken and isinstance(f.dataType, NumericType)
    ]


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
