import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from conftest import make_sessions
from sessionloom.functions.privacy import (
    anonymise, device_fingerprint_hash, hash_matches, hmac_sha256, ip_prefix, sha256_hex, user_agent_hash,
)


def _python(value: str, salt: str) -> str:
    return hmac.new(salt.encode(), value.encode(), hashlib.sha256).hexdigest()


def test_hmac_equals_standard_library(spark):
    values = ["test_value", "abc", "", "ünïcödé ☃", "x" * 500]
    for salt in ["pepper", "k" * 64, "long" * 40, "ß"]:
        df = spark.createDataFrame([(v,) for v in values], "v string")
        got = [r[0] for r in df.select(hmac_sha256("v", salt)).collect()]
        assert got == [_python(v, salt) for v in values]
        assert all(len(g) == 64 for g in got)


def test_null_stays_null_and_numbers_hash_as_text(spark):
    df = spark.createDataFrame([(None, 12)], "v string, n long")
    row = df.select(hmac_sha256("v", "s"), hmac_sha256("n", "s")).first()
    assert row[0] is None and row[1] == _python("12", "s")


def test_default_salt_comes_from_environment(spark, monkeypatch):
    monkeypatch.delenv("HASH_SALT", raising=False)
    with pytest.raises(RuntimeError):
        hmac_sha256(F.lit("a"))
    monkeypatch.setenv("HASH_SALT", "other")
    assert spark.range(1).select(hmac_sha256(F.lit("a"))).first()[0] == _python("a", "other")


def test_column_hash_is_deterministic(spark):
    got = [r[0] for r in spark.createDataFrame([("a",), ("b",), ("a",)], "v string").select(hmac_sha256("v", "s")).collect()]
    assert got[0] == got[2] != got[1]


def test_verify(spark):
    df = spark.createDataFrame([("abc", _python("abc", "s")), ("abd", _python("abc", "s"))], "o string, h string")
    assert [r[0] for r in df.select(hash_matches("o", "h", "s")).collect()] == [True, False]


def test_anonymise(spark):
    df = make_sessions(spark, [{"ip_prefix": "9.9"}])
    anon = anonymise(df, salt="s")
    assert "real_user_id" not in anon.columns and "user_id_hash" in anon.columns
    assert anon.first()["ip_prefix"] == _python("9.9", "s")
    kept = anonymise(df, ["os", "no_such_column"], "s", drop_real_user_id=False)
    assert "real_user_id" in kept.columns
    assert kept.first()["os"] == _python("iOS", "s") and kept.first()["ip_prefix"] == "9.9"


def test_plain_hashes_and_prefix(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    row = spark.range(1).select(
        sha256_hex(F.lit("user_1")), user_agent_hash(F.lit("Chrome"), F.lit("Linux")),
        ip_prefix(F.lit("10.20.30.40")), ip_prefix(F.lit("10.20.30.40"), 3),
        *[device_fingerprint_hash(F.lit("u"), F.lit("d"), F.lit("o"), F.lit(i)) for i in (0, 2, 3)],
    ).first()
    assert row[0] == sha("user_1") and row[1] == sha("Chrome Linux")
    assert row[2] == "10.20" and row[3] == "10.20.30"
    assert row[4] == row[5] == sha("u|d|o|0") and row[6] == sha("u|d|o|1")
