"""Masks and keyed hashes for single values, as built-in expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Shapes of personal identifiers.
# ---------------------------------------------------------------------------
PAN_SHAPE = "[A-Z]{5}[0-9]{4}[A-Z]"
MOBILE_SHAPE = "[6-9][0-9]{9}"

# Whitespace as producers' runtime trims it: wider than Spark's trim.
WIDE_SPACE = (
    r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
)

HMAC_BLOCK_BYTES = 64


def trim_wide(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{WIDE_SPACE}]+|[{WIDE_SPACE}]+\\z", "")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def stars(count: Column) -> Column:
    return F.repeat(F.lit("*"), count.cast("int"))


def _stars_and_last4(digits: Column) -> Column:
    return F.concat(stars(F.length(digits) - 4), F.right(digits, F.lit(4)))


def mask_mobile(text: Column) -> Column:
    digits = digits_of(text)
    return F.when(F.length(digits) < 4, "***").otherwise(_stars_and_last4(digits))


def mask_account(text: Column) -> Column:
    digits = digits_of(text)
    return F.when(F.length(digits) <= 4, "****").otherwise(_stars_and_last4(digits))


def mask_pan(text: Column) -> Column:
    pan = trim_wide(text)
    masked = F.concat(F.left(pan, F.lit(3)), stars(F.length(pan) - 6), F.right(pan, F.lit(3)))
    return F.when(F.length(pan) < 6, pan).otherwise(masked)


def mask_email(text: Column) -> Column:
    at = F.instr(text, "@")
    local = F.substr(text, F.lit(1), at - 1)
    rest = F.substr(text, at)
    masked = F.when(F.length(local) <= 2, stars(F.length(local))).otherwise(
        F.concat(F.left(local, F.lit(1)), stars(F.length(local) - 2), F.right(local, F.lit(1)))
    )
    return F.when(text.isNull(), None).when(at == 0, "***@***").otherwise(F.concat(masked, rest))


def normalize_mobile(text: Column) -> Column:
    """E.164 form of an Indian mobile number."""
    digits = digits_of(text)
    return (
        F.when(F.length(digits) == 10, F.concat(F.lit("+91"), digits))
        .when(
            (F.length(digits) == 13) & digits.startswith("091"),
            F.concat(F.lit("+"), F.substring(digits, 2, 12)),
        )
        .otherwise(F.concat(F.lit("+"), digits))
    )


def hmac_sha256(text: Column, key: str) -> Column:
    """HMAC-SHA-256 as hex, composed from sha2 so that it stays on the JVM.

    The padded key becomes a plan literal: keep plans and event logs private.
    """
    raw = key.encode("utf-8")
    if len(raw) > HMAC_BLOCK_BYTES:
        raw = hashlib.sha256(raw).digest()
    block = raw.ljust(HMAC_BLOCK_BYTES, b"\0")
    inner = F.lit(bytearray(byte ^ 0x36 for byte in block))
    outer = F.lit(bytearray(byte ^ 0x5C for byte in block))
    inner_hash = F.sha2(F.concat(inner, F.encode(text, "UTF-8")), 256)
    return F.sha2(F.concat(outer, F.unhex(inner_hash)), 256)


def hash_mobile(text: Column, key: str) -> Column:
    return hmac_sha256(normalize_mobile(text), key)


def mobile_last4(text: Column) -> Column:
    return F.right(normalize_mobile(text), F.lit(4))


def hash_aadhaar_last4(last4: Column, key: str) -> Column:
    return hmac_sha256(last4, key)


def holds_identifier(text: Column) -> Column:
    """True where a raw PAN or mobile number is left anywhere in the text."""
    return text.rlike(f"{PAN_SHAPE}|{MOBILE_SHAPE}")


def may_hold_pii(request_payload: Column, response_payload: Column) -> Column:
    return holds_identifier(request_payload) | holds_identifier(response_payload)
