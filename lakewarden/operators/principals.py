"""Teams and users to security identifiers through explicit, unambiguous mappings."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.functions.text import blank_to_null


def _as_uuid(text: str) -> str | None:
    try:
        return str(uuid.UUID(text))
    except ValueError:
        return None


def _prefixed(key: str, prefix: str) -> str | None:
    if key.lower().startswith(prefix) and key[len(prefix) :].strip():
        return key[len(prefix) :].strip()
    return None


def mapping_rows(
    spark: SparkSession, mapping: Mapping[str, str], kinds: tuple[str, ...]
) -> DataFrame:
    """Configured mapping as `(kind, key, sid)`; keys may be prefixed `id:`, `fqn:`, ...

    An unprefixed identifier-like key is an id. Otherwise it counts as e-mail when it holds an
    `@` and e-mails are asked for, and as every remaining kind for teams.
    """
    rows = []
    for raw, sid in mapping.items():
        key, sid = raw.strip(), (sid or "").strip()
        if not key or not sid:
            continue
        prefixed = next(((k, p) for k in kinds if (p := _prefixed(key, f"{k}:"))), None)
        if prefixed:
            kind, rest = prefixed
            rest = _as_uuid(rest) if kind == "id" else rest
            if rest:
                rows.append((kind, rest, sid))
        elif _as_uuid(key):
            rows.append(("id", _as_uuid(key), sid))
        elif "email" in kinds:
            if "@" in key:
                rows.append(("email", key, sid))
        else:
            rows += [(k, key, sid) for k in kinds if k != "id"]
    return spark.createDataFrame(rows, "kind string, key string, sid string")


def unambiguous(mapping: DataFrame) -> DataFrame:
    """Keys mapped to exactly one identifier; e-mails compare without case."""
    key = F.when(F.col("kind") == "email", F.lower(F.btrim("key"))).otherwise(F.col("key"))
    grouped = mapping.groupBy("kind", key.alias("key")).agg(
        F.min("sid").alias("sid"), F.max("sid").alias("other")
    )
    return grouped.where(F.col("sid") == F.col("other")).drop("other")


def _lookup(mapping: DataFrame, kind: str) -> DataFrame:
    rows = mapping.where(F.col("kind") == kind)
    return rows.select(F.col("key").alias(f"__{kind}"), F.col("sid").alias(f"__sid_{kind}"))


def resolve_teams(teams: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds `sid` to `teams(id, fqn, name, ...)`: by id, then full name, then name."""
    known = unambiguous(mapping)
    joined = teams
    for kind, column in (("id", "id"), ("fqn", "fqn"), ("name", "name")):
        joined = joined.join(
            _lookup(known, kind), blank_to_null(F.col(column)) == F.col(f"__{kind}"), "left"
        )
    sid = F.coalesce("__sid_id", "__sid_fqn", "__sid_name")
    return joined.select(*teams.columns, sid.alias("sid"))


def resolve_users(users: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds `sid` to `users(id, email, ...)`: by id, then by an e-mail only one user has.

    Shared e-mails are found by counting per e-mail, combined per task, and only those few keys
    are joined back, so a much-shared address does not gather its users anywhere.
    """
    known = unambiguous(mapping)
    email = F.lower(blank_to_null(F.btrim("email")))
    keyed = users.withColumn("__mail", email)
    shared = (
        keyed.where(F.col("__mail").isNotNull())
        .groupBy("__mail")
        .count()
        .where(F.col("count") > 1)
        .select(F.col("__mail").alias("__shared"))
    )
    by_mail = _lookup(known, "email").join(
        shared, F.col("__email") == F.col("__shared"), "left_anti"
    )
    joined = keyed.join(_lookup(known, "id"), F.col("id") == F.col("__id"), "left").join(
        by_mail, F.col("__mail") == F.col("__email"), "left"
    )
    return joined.select(*users.columns, F.coalesce("__sid_id", "__sid_email").alias("sid"))


def is_uuid(text: str) -> bool:
    return bool(re.fullmatch(r"[0-9a-fA-F-]{36}", text)) and _as_uuid(text) is not None
