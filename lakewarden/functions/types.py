"""Type-name mappings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewarden.fixed_values import CONTRACT_TYPES, EDM_DEFAULT, EDM_TYPES


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of `key` in a small fixed mapping, else null."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def edm_type(data_type: Column) -> Column:
    return F.coalesce(lookup(F.lower(F.btrim(data_type)), EDM_TYPES), F.lit(EDM_DEFAULT))


def contract_type(data_type: Column) -> Column:
    """Comparable type name: precision removed, synonyms folded."""
    lowered = F.lower(F.btrim(data_type))
    base = F.btrim(F.regexp_replace(lowered, "(?s)^([^(]+)\\(.*$", "$1"))
    return F.coalesce(lookup(base, CONTRACT_TYPES), base)
