"""Entity-set paging: projection, structured filter, order, offset or keyset, count, envelope."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import PAGE_DEFAULT, PAGE_MAX
from lakewarden.functions.text import require_identifier
from lakewarden.operators.predicates import column_type, compare, typed

_FILTER_OPS = {"eq": "==", "ne": "!=", "gt": ">", "ge": ">=", "lt": "<", "le": "<="}


class InvalidQueryOption(ValueError):
    """A paging, projection or filter option that cannot be used."""


def clamp_top(top: int | None) -> int:
    if top is None:
        return PAGE_DEFAULT
    if top < 0:
        raise InvalidQueryOption("top must be a non-negative integer")
    return min(max(top, 1), PAGE_MAX)


def check_skip(skip: int | None) -> int:
    if skip is not None and skip < 0:
        raise InvalidQueryOption("skip must be a non-negative integer")
    return skip or 0


def select_columns(df: DataFrame, select: str | Sequence[str] | None) -> list[str]:
    """Requested columns in order; bad names and unknown columns are errors."""
    if not select:
        return df.columns
    names = select.split(",") if isinstance(select, str) else list(select)
    known = {c.lower(): c for c in df.columns}
    out = []
    for name in (n.strip() for n in names if n.strip()):
        try:
            require_identifier(name)
            out.append(known[name.lower()])
        except (ValueError, KeyError) as bad:
            raise InvalidQueryOption(f"column '{name}' cannot be selected") from bad
    return out


def filter_column(df: DataFrame, filters: Iterable[tuple[str, str, Any]]) -> Column:
    """Conjunction of `(column, op, value)` with eq, ne, gt, ge, lt, le, contains."""
    parts = []
    for name, op, value in filters:
        (column,) = select_columns(df, [name])
        if op == "contains":
            parts.append(F.col(column).contains(F.lit(value)))
        elif op in _FILTER_OPS:
            wanted = typed(value, column_type(df, column))
            parts.append(compare(F.col(column), _FILTER_OPS[op], wanted))
        else:
            raise InvalidQueryOption(f"unknown operator '{op}'")
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _ordering(df: DataFrame, order_by: Sequence[tuple[str, str]], keys: Sequence[str]):
    """Requested order, completed by the key columns so that pages are stable."""
    named = [(select_columns(df, [c])[0], d.lower()) for c, d in order_by]
    seen = {c.lower() for c, _ in named}
    named += [(k, "asc") for k in keys if k.lower() not in seen]
    return [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in named]


def page(
    df: DataFrame,
    keys: Sequence[str],
    select: str | Sequence[str] | None = None,
    filters: Iterable[tuple[str, str, Any]] = (),
    order_by: Sequence[tuple[str, str]] = (),
    top: int | None = None,
    skip: int | None = None,
) -> DataFrame:
    """One page. Each task keeps its best `skip + top` rows, so no global sort takes place."""
    rows = df.where(filter_column(df, filters))
    columns = select_columns(df, select)
    ordered = rows.orderBy(*_ordering(df, order_by, keys))
    return ordered.offset(check_skip(skip)).limit(clamp_top(top)).select(*columns)


def keyset_page(
    df: DataFrame,
    keys: Sequence[str],
    after: Sequence[Any] | None = None,
    select: str | Sequence[str] | None = None,
    filters: Iterable[tuple[str, str, Any]] = (),
    top: int | None = None,
) -> DataFrame:
    """Page of rows whose key follows `after`; the leading key's bound reaches the scan."""
    rows = df.where(filter_column(df, filters))
    columns = select_columns(df, select)
    if after is not None:
        if len(after) != len(keys):
            raise InvalidQueryOption("the page token needs one value per key column")
        values = [typed(v, column_type(df, k)) for k, v in zip(keys, after)]
        beyond = F.lit(False)
        for n in reversed(range(len(keys))):
            beyond = (F.col(keys[n]) > values[n]) | ((F.col(keys[n]) == values[n]) & beyond)
        rows = rows.where(F.col(keys[0]) >= values[0]).where(beyond)
    return rows.orderBy(*keys).limit(clamp_top(top)).select(*columns)


def total_count(df: DataFrame, filters: Iterable[tuple[str, str, Any]] = ()) -> DataFrame:
    """Number of matching rows before paging."""
    return df.where(filter_column(df, filters)).agg(F.count(F.lit(1)).alias("total_count"))


def envelope(
    page_rows: DataFrame,
    order: Sequence[str],
    root_url: str,
    domain: str,
    schema_name: str,
    table_name: str,
    count: DataFrame | None = None,
) -> DataFrame:
    """One row with context, optional count and the page (at most the page maximum) as JSON."""
    item = F.struct(*[F.col(c) for c in order], F.to_json(F.struct(*page_rows.columns)).alias("__j"))
    items = F.transform(F.array_sort(F.collect_list(item)), lambda s: s["__j"])
    context = f"{root_url.rstrip('/')}/$metadata#{domain}_{schema_name}_{table_name}"
    body = page_rows.agg(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias("value"))
    total = count.scalar() if count is not None else F.lit(None).cast("bigint")
    return body.select(F.lit(context).alias("context"), total.alias("total_count"), "value")
