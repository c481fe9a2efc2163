"""The few expressions that Spark SQL and plain SQL spell differently.

Inputs of the registered queries are derived from the given tables by one SQL text each. The
same text feeds the Spark operators and the comparison SQL, so both start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewarden.functions.crypto import hmac_pads

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


class PlainSql:
    """Spelling of the comparison SQL."""

    def table(self, name: str) -> str:
        return name

    def micros(self, ts: str) -> str:
        return f"epoch_us({ts})"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} // {b})"

    def sha256(self, text: str) -> str:
        return f"sha256({text})"

    def hmac(self, message: str, secret: str) -> str:
        ipad, opad = (p.hex() for p in hmac_pads(secret))
        return f"sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || encode({message}))))"

    def base64(self, hex_text: str) -> str:
        return f"to_base64(unhex({hex_text}))"

    def first_match(self, text: str, pattern: str) -> str:
        return f"nullif(regexp_extract({text}, '{pattern}'), '')"


class SparkSql:
    """Spelling of Spark SQL; tables are views registered by `views`."""

    def table(self, name: str) -> str:
        return f"lw_{name}"

    def micros(self, ts: str) -> str:
        return f"unix_micros(CAST({ts} AS TIMESTAMP))"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})"

    def sha256(self, text: str) -> str:
        return f"sha2({text}, 256)"

    def hmac(self, message: str, secret: str) -> str:
        ipad, opad = (p.hex() for p in hmac_pads(secret))
        inner = f"sha2(concat(unhex('{ipad}'), CAST({message} AS BINARY)), 256)"
        return f"sha2(concat(unhex('{opad}'), unhex({inner})), 256)"

    def base64(self, hex_text: str) -> str:
        return f"base64(unhex({hex_text}))"

    def first_match(self, text: str, pattern: str) -> str:
        return f"nullif(regexp_extract({text}, r'{pattern}', 0), '')"


PLAIN, SPARK = PlainSql(), SparkSql()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Runs an input text over the tables of `sf_dir` that it mentions."""
    for name in TABLES:
        if f"lw_{name}" in text:
            load(spark, sf_dir, name).createOrReplaceTempView(f"lw_{name}")
    return spark.sql(text)
