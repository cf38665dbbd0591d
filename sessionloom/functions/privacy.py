"""Hashing expressions: plain digests and a keyed HMAC-SHA256 built from native functions."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import as_col

# The columns anonymised by default.
PII_COLUMNS = ["ip_prefix", "user_agent_hash", "device_fingerprint_hash"]

_BLOCK = 64


def default_salt() -> str:
    """The key from HASH_SALT; there is no fallback, a known key protects nothing."""
    salt = os.environ.get("HASH_SALT")
    if not salt:
        raise RuntimeError("set HASH_SALT or pass a salt")
    return salt


def hmac_pads(salt: str) -> tuple[str, str]:
    """Hex of the inner and outer key blocks (RFC 2104); computed once per query."""
    key = salt.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def sha256_hex(value: Column | str) -> Column:
    return F.sha2(as_col(value).cast("string"), 256)


def hmac_sha256(value: Column | str, salt: str | None = None) -> Column:
    """Keyed digest of the value's text form as 64 hex characters; null stays null."""
    inner, outer = hmac_pads(default_salt() if salt is None else salt)
    message = F.encode(as_col(value).cast("string"), "UTF-8")
    inner_digest = F.sha2(F.concat(F.unhex(F.lit(inner)), message), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(inner_digest)), 256)


def hash_matches(original: Column | str, hashed: Column | str, salt: str | None = None) -> Column:
    """Audit predicate: does ``hashed`` belong to ``original`` under this salt?"""
    return hmac_sha256(original, salt) == as_col(hashed)


def ip_prefix(ip: Column | str, octets: int = 2) -> Column:
    """Leading octets of a dotted IPv4 address (2 gives the /16 network)."""
    return F.substring_index(as_col(ip), ".", octets)


def user_agent_hash(browser: Column | str, os_name: Column | str) -> Column:
    return F.sha2(F.concat_ws(" ", as_col(browser), as_col(os_name)), 256)


def device_fingerprint_hash(
    user: Column, device: Column, os_name: Column, session_index: Column, rotate_every: int = 3
) -> Column:
    """Digest of user, device and system that rotates every few sessions of the user."""
    rotation = F.floor(session_index / F.lit(rotate_every)).cast("string")
    return F.sha2(F.concat_ws("|", user, device, os_name, rotation), 256)


def anonymise(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    salt: str | None = None,
    drop_real_user_id: bool = True,
) -> DataFrame:
    """Replace the listed columns that exist by keyed digests and drop the true user id."""
    present = [c for c in (columns or PII_COLUMNS) if c in df.columns]
    hashed = df.withColumns({c: hmac_sha256(c, salt) for c in present}) if present else df
    return hashed.drop("real_user_id") if drop_real_user_id else hashed
