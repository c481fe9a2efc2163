from __future__ import annotations

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from lakewarden.functions import crypto, masks, paths, text, types
from lakewarden.functions.masks import MaskRule


def values(spark, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_masks(spark):
    assert values(spark, ["user@domain.com", "nobody", "a@b@c", None], masks.mask_email) == [
        "u***@domain.com",
        "[REDACTED]",
        "[REDACTED]",
        None,
    ]
    assert values(spark, ["4111 1111 1111 1234", "1234", None], masks.mask_last_four) == [
        "**** **** **** 1234",
        "[REDACTED]",
        None,
    ]
    rule = MaskRule("REGEX", "[0-9]+", "#")
    assert values(spark, ["a12b3", "none"], lambda c: masks.apply_rule(c, rule)) == [
        "a#b#",
        "[REDACTED]",
    ]
    for unsafe in (None, MaskRule("UNKNOWN"), MaskRule("HMAC_SHA256", key_id="missing")):
        assert values(spark, ["x", None], lambda c, r=unsafe: masks.apply_rule(c, r)) == [
            "[REDACTED]",
            None,
        ]
    art9 = MaskRule("REDACT", replacement="[REDACTED-GDPR-ART9]")
    assert values(spark, ["x"], lambda c: masks.apply_rule(c, art9)) == ["[REDACTED-GDPR-ART9]"]


@pytest.mark.parametrize("secret", ["short", "k" * 64, "long" * 40])
def test_hmac_matches_the_standard(spark, secret):
    keys = crypto.key_table(spark, {"k": secret, "blank": ""})
    assert keys.count() == 1
    got = keys.select(crypto.hmac_hex(F.lit("héllo"), F.col("ipad"), F.col("opad"))).first()[0]
    assert got == hmac.new(secret.encode(), "héllo".encode(), hashlib.sha256).hexdigest()


def test_secrets_stay_out_of_plans(spark, capsys):
    keys = crypto.key_table(spark, {"k": "top-secret"})
    keys.select(crypto.hmac_hex(F.lit("m"), F.col("ipad"), F.col("opad"))).explain(True)
    pad = crypto.hmac_pads("top-secret")[0].hex()
    assert pad not in capsys.readouterr().out.lower()


def test_signature_forms(spark):
    digest = hashlib.sha256(b"x")
    import base64

    forms = [
        digest.hexdigest(),
        "sha256=" + digest.hexdigest().upper(),
        base64.b64encode(digest.digest()).decode(),
        "zz",
    ]
    assert values(spark, forms, crypto.signature_hex) == [digest.hexdigest()] * 3 + [None]
    strict = values(spark, forms, lambda c: crypto.signature_hex(c, allow_base64=False))
    assert strict[2] is None


def test_entity_names(spark):
    assert values(
        spark, ["Data Sales.Orders_1", "!!!", "  ", None, "a--b", "x" * 62 + "-yz"], text.entity_name
    ) == ["data-sales.orders_1", "entity", "unnamed", "unnamed", "a-b", "x" * 62]


def test_identifiers(spark):
    assert values(spark, ["a_1", "1a", "a b", None], text.is_identifier) == [True, False, False, False]
    with pytest.raises(ValueError):
        text.require_identifier("a; drop")


def test_justification_cleaning(spark):
    assert values(spark, ["\x01 a\tb \x7f"], lambda c: text.clean_justification(c, None)) == ["a b"]
    assert values(spark, ["x" * 501], lambda c: text.clean_justification(c, 500)) == ["x" * 500]


def test_epochs(spark):
    df = spark.createDataFrame([(1_700_000_000,), (1_700_000_000_000,)], "e bigint")
    got = df.select(F.unix_seconds(text.epoch_to_timestamp(F.col("e")))).collect()
    assert [r[0] for r in got] == [1_700_000_000] * 2


def test_json_scalars(spark):
    docs = ['{"id":" ","eventId":5}', '{"id":{"x":1},"eventId":"z"}', '{"id":true}', "bad{", "[1]"]
    got = values(spark, docs, lambda c: text.json_scalar(text.json_object(c), "id", "eventId"))
    assert got == ["5", "z", None, None, None]


def test_types(spark):
    assert values(spark, ["INTEGER", " money ", "odd", None, "double precision"], types.edm_type) == [
        "Edm.Int32",
        "Edm.Decimal",
        "Edm.String",
        "Edm.String",
        "Edm.Double",
    ]
    assert values(spark, ["VARCHAR(20)", "int4", "numeric(3, 2)", "datetime2", "json"], types.contract_type) == [
        "string",
        "integer",
        "decimal",
        "timestamp",
        "json",
    ]


TABLE = "s3://lake/orders/metadata/v2.metadata.json"


@pytest.mark.parametrize(
    ("path", "table", "expected"),
    [
        ("s3://lake/orders/metadata/snap.json", TABLE, None),
        ("s3://lake/orders/data/f.parquet", TABLE, None),
        ("s3://other/orders/data/f.parquet", TABLE, "AUTHORITY_MISMATCH"),
        ("s3://lake/customers/f.parquet", TABLE, "OUTSIDE_TABLE"),
        ("s3://lake/orders_evil/f.parquet", TABLE, "OUTSIDE_TABLE"),
        ("s3://lake/orders/../x", TABLE, "PATH_TRAVERSAL"),
        ("s3://lake/orders/%2E%2e/x", TABLE, "PATH_TRAVERSAL"),
        ("https://lake/orders/x", TABLE, "SCHEME_MISMATCH"),
        ("https://lake/orders/x", None, "HTTP_REQUIRES_TABLE"),
        ("https://h:443/t/x", "https://H/t", None),
        ("https://h:8443/t/x", "https://h/t", "AUTHORITY_MISMATCH"),
        ("data/f.parquet", TABLE, "LOCAL_FOR_REMOTE"),
        ("data/f.parquet", "/lake/orders", None),
        ("/lake/orders/f.parquet", "/lake/orders/metadata/v1.json", None),
        ("/lake/other/f.parquet", "/lake/orders", "OUTSIDE_TABLE"),
        ("file:///etc/passwd", None, "RESTRICTED_PATH"),
        ("/root/.x", "/lake/orders", "RESTRICTED_PATH"),
        ("file:///lake/orders/f", TABLE, "CROSS_SCHEME"),
        ("abfs://c@acc/t/f", "abfss://c@acc/t", None),
        ("s3://lake/f", "s3://lake", "EMPTY_ROOT_PREFIX"),
        ("a\0b", "/lake/orders", "RESTRICTED_PATH"),
        ("", TABLE, None),
    ],
)
def test_location_guard(spark, path, table, expected):
    df = spark.createDataFrame([(path, table)], "p string, t string")
    assert df.select(paths.location_violation(F.col("p"), F.col("t"))).first()[0] == expected


def test_storage_keys_and_buckets(spark):
    assert values(spark, ["a/b", "a?b", "a#b", "a%20b", "a/./b"], paths.unsafe_key) == [
        False,
        True,
        True,
        True,
        True,
    ]
    assert values(spark, ["S3://b/x", "minio://m", "abfs://c/x", "s3:///x"], paths.bucket_of) == [
        "b",
        "m",
        None,
        None,
    ]
    assert values(spark, ["/orders/metadata/v2.metadata.json", "/orders/", "/a/Metadata"], paths.table_root) == [
        "/orders",
        "/orders",
        "/a",
    ]
