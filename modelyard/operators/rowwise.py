"""Responders that turn the ordered rows of a group into any number of rows: Python table functions.

Spark deals the rows of a table out by group and order and hands them to one responder a group, row by
row; what it yields becomes rows of a declared schema.  A group is read in one task as a stream, never
gathered; only what the responder itself remembers is held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.functions import udtf


class RowResponder(Protocol):
    """Made anew for each group."""

    def row(self, row: Row) -> Iterable[tuple]:
        """Rows to give for one row of the group, in order; none, one or many."""

    def end(self) -> Iterable[tuple]:
        """Rows to give after the last row of the group."""


def respond_rows(
    df: DataFrame,
    make: Callable[..., RowResponder],
    schema: str | T.StructType,
    group: Sequence[str],
    order: Sequence[str | Column],
    **settings: Any,
) -> DataFrame:
    """Rows of `schema` that responders yield for the groups of `df`, each group in its order.

    `make(**settings)` gives the responder of a group and travels by value.  Rows that lack a group
    column belong to no group and are left out; an empty table gives no rows.  Groups meet tasks by a shuffle
    on `group`; rows of equal order come in any order, so `order` should identify a row of a group.
    """
    if not group:
        raise ValueError("a group is needed: without one the whole table would be one task")
    returned = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    class Table:
        def __init__(self) -> None:
            self._own: RowResponder | None = None

        def eval(self, row: Row):  # noqa: ANN202
            if self._own is None:
                self._own = make(**settings)
            yield from self._own.row(row)

        def terminate(self):  # noqa: ANN202
            if self._own is not None:
                yield from self._own.end()
                self._own = None

    whole = df
    for name in group:
        whole = whole.where(F.col(name).isNotNull())
    table = whole.asTable().partitionBy(*group).orderBy(*order)
    return udtf(Table, returnType=returned)(table)
