"""Filter arguments to predicates, admissibility and typed comparison."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPERATORS = {"eq": "==", "neq": "!=", "gt": ">", "gte": ">=", "lt": "<", "lte": "<="}
_NOT_FILTERS = {"where", "limit", "offset"}


class Predicate(NamedTuple):
    column: str
    op: str
    value: Any


def extract_predicates(arguments: Mapping[str, Any] | None) -> list[Predicate]:
    """Predicates of a `where` map and of further top-level arguments (equality).

    All operators given for a column apply together; null values are ignored. A top-level
    argument counts only for a column that `where` does not mention.
    """
    arguments = arguments or {}
    found: list[Predicate] = []
    where = next((v for k, v in arguments.items() if k.lower() == "where"), None) or {}
    for column, wanted in where.items():
        if isinstance(wanted, Mapping):
            found += [
                Predicate(column, OPERATORS[op], value)
                for op, value in wanted.items()
                if op in OPERATORS and value is not None
            ]
        elif wanted is not None:
            found.append(Predicate(column, "==", wanted))
    seen = {p.column.lower() for p in found}
    found += [
        Predicate(column, "==", value)
        for column, value in arguments.items()
        if column.lower() not in _NOT_FILTERS | seen and value is not None
    ]
    return found


def admit(
    predicates: Iterable[Predicate], known: Iterable[str], clear: Iterable[str]
) -> tuple[list[Predicate], list[Predicate]]:
    """Predicates to apply, and those dropped because their column is not readable in clear.

    A filter on an unknown column is an error. One on a masked or denied column is dropped and
    reported: evaluating it would let a caller probe values they may not see.
    """
    known = {c.lower() for c in known}
    clear = {c.lower() for c in clear}
    kept, dropped = [], []
    for p in predicates:
        if p.column.lower() not in known:
            raise PermissionError(f"filter on unknown column '{p.column}'")
        (kept if p.column.lower() in clear else dropped).append(p)
    return kept, dropped


def typed(value: Any, data_type: T.DataType) -> Column:
    """Literal in the column's type; a value that does not fit is null and matches nothing."""
    return F.lit(value).try_cast(data_type)


def compare(left: Column, op: str, right: Column) -> Column:
    return {
        "==": lambda: left == right,
        "!=": lambda: left != right,
        ">": lambda: left > right,
        ">=": lambda: left >= right,
        "<": lambda: left < right,
        "<=": lambda: left <= right,
    }[op]()


def column_type(df: DataFrame, name: str) -> T.DataType:
    return next(f.dataType for f in df.schema.fields if f.name.lower() == name.lower())


def to_column(df: DataFrame, predicates: Iterable[Predicate]) -> Column:
    """Conjunction of typed comparisons; literals only, so it reaches the Parquet scan."""
    parts = [
        compare(F.col(p.column), p.op, typed(p.value, column_type(df, p.column)))
        for p in predicates
    ]
    return reduce(lambda a, b: a & b, parts, F.lit(True))
