"""Fixed cases for masks, keyed hashes and deep redaction."""

import hashlib
import hmac
import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from callstrata.functions import masking
from callstrata.functions.redaction import (
    _codec, redact, redact_deep, redact_payload, redact_text, write_deep,
)


def redacted(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return redact_text(text, *_codec())


def parsed(value):
    return json.loads(redacted(value))


MASKS = [
    (masking.mask_mobile, "9876543210", "******3210"),
    (masking.mask_mobile, "+919876543210", "********3210"),
    (masking.mask_mobile, "98765 43210", "******3210"),
    (masking.mask_mobile, "123", "***"),
    (masking.mask_mobile, "1234", "1234"),
    (masking.mask_pan, "ABCDE1234F", "ABC****34F"),
    (masking.mask_pan, "  PQRST5678U\t", "PQR****78U"),
    (masking.mask_pan, "AB123", "AB123"),
    (masking.mask_pan, "ABC123", "ABC123"),
    (masking.mask_email, "someone@example.com", "s*****e@example.com"),
    (masking.mask_email, "p@x.com", "*@x.com"),
    (masking.mask_email, "ab@x.com", "**@x.com"),
    (masking.mask_email, "@x.com", "@x.com"),
    (masking.mask_email, "a@b@c", "*@b@c"),
    (masking.mask_email, "no address", "***@***"),
    (masking.mask_account, "1234567890", "******7890"),
    (masking.mask_account, "1234", "****"),
    (masking.mask_account, "12-345", "*2345"),
    (masking.normalize_mobile, "9876543210", "+919876543210"),
    (masking.normalize_mobile, "+91 98765-43210", "+919876543210"),
    (masking.normalize_mobile, "919876543210", "+919876543210"),
    (masking.normalize_mobile, "0919876543210", "+919876543210"),
    (masking.normalize_mobile, "12345", "+12345"),
]


@pytest.mark.parametrize("function, value, expected", MASKS)
def test_masks(spark, function, value, expected):
    row = spark.range(1).select(function(F.lit(value)).alias("out")).first()
    assert row.out == expected


@pytest.mark.parametrize("key", ["short", "k" * 64, "k" * 65, "schlüssel"])
def test_hmac_is_the_standard_one(spark, key):
    frame = spark.createDataFrame([("9876543210",), ("",), ("é",)], "text string")
    for row in frame.select("text", masking.hmac_sha256(F.col("text"), key).alias("h")).collect():
        assert row.h == hmac.new(key.encode(), row.text.encode(), hashlib.sha256).hexdigest()


def test_hash_ignores_spelling_and_depends_on_key(spark):
    frame = spark.createDataFrame(
        [("9876543210",), ("+919876543210",), ("919876543210",)], "m string")
    hashes = frame.select(
        masking.hash_mobile(F.col("m"), "one").alias("a"),
        masking.hash_mobile(F.col("m"), "two").alias("b"),
        masking.mobile_last4(F.col("m")).alias("l")).distinct().collect()
    assert len(hashes) == 1 and hashes[0].a != hashes[0].b and hashes[0].l == "3210"


KEYS = {
    "******3210": ("9876543210", ["mobile", "mobileNo", "mobile_no", "phone", "phoneNumber",
                                  "contact-no", "WhatsApp No", "cell"]),
    "ABC****34F": ("ABCDE1234F", ["pan", "panNumber", "pan_number", "panCard", "PAN NO"]),
    "u**r@example.com": ("user@example.com", ["email", "emailId", "email_id", "emailAddress"]),
    "******7890": ("1234567890", ["accountNo", "account_number", "bankAccount",
                                  "beneficiaryAccount", "debit-account"]),
    "[AADHAAR_REDACTED]": ("any text", ["aadhaar", "aadhar", "uid", "UIDAI"]),
}


@pytest.mark.parametrize("expected", KEYS)
def test_key_names(expected):
    value, keys = KEYS[expected]
    for key in keys:
        assert parsed({key: value}) == {key: expected}


SHAPES = [
    ("9123456789", "******6789"),
    ("91234 56789", "******6789"),
    ("09123456789", "*******6789"),
    ("lmnop9012q", "lmn****12q"),
    (" tech@site.org ", "t**h@site.org"),
    ("id 1234 5678 9012 and 123456789012", "id [AADHAAR_REDACTED] and [AADHAAR_REDACTED]"),
    ("919876543210", "[AADHAAR_REDACTED]"),
    ("+919876543210", "+[AADHAAR_REDACTED]"),
    ("12345678901234", "12345678901234"),
    ("4111 1111 1111 1111", "[AADHAAR_REDACTED] 1111"),
    ("1234 5678 9012", "[AADHAAR_REDACTED]"),
    ("pan is ABCDE1234F", "pan is ABCDE1234F"),
    ("LOAN-20260101-001", "LOAN-20260101-001"),
    ("Some Name", "Some Name"),
    ("9123456789\n", "******6789"),
    ("1234567890", "1234567890"),
]


@pytest.mark.parametrize("value, expected", SHAPES)
def test_value_shapes_under_unknown_keys(value, expected):
    assert parsed({"field": value}) == {"field": expected}
    assert parsed([value]) == [expected]


def test_key_rules_need_a_string():
    assert parsed({"mobile": 9876543210, "pan": None, "uid": True}) == {
        "mobile": 9876543210, "pan": None, "uid": True}
    assert parsed({"mobile": ["9876543210", {"pan": "ABCDE1234F"}]}) == {
        "mobile": ["******3210", {"pan": "ABC****34F"}]}


def test_nested_payload():
    payload = {"result": {"pan": "ABCDE1234F", "name": "A NAME", "kyc": [{"email": "x@y.in"}]},
               "status": 200}
    assert parsed(payload) == {
        "result": {"pan": "ABC****34F", "name": "A NAME", "kyc": [{"email": "*@y.in"}]},
        "status": 200}


CLOSED = "[REDACTED:UNPARSEABLE]"
TEXTS = [
    ("[OVERSIZED]", CLOSED),
    ('{"pan":"ABCDE1234F","name":"Ra...[TRUNCATED]', CLOSED),
    ("", CLOSED),
    ("{'pan':'ABCDE1234F'}", CLOSED),
    ('{"a":NaN}', CLOSED),
    ("-Infinity", CLOSED),
    ('{"a":1} x', CLOSED),
    ("[" * 100_000, CLOSED),
    ("null", "null"),
    ("42", "42"),
    ("true", "true"),
    ('"ABCDE1234F"', "ABC****34F"),
    ('"plain"', "plain"),
    (' { "b" : 1 , "a" : [ ] } ', '{"b":1,"a":[]}'),
    ('{"a":1.0,"b":1e3,"c":-0.0,"d":0.25}', '{"a":1,"b":1000,"c":0,"d":0.25}'),
    ('{"a":12345678901234567890}', '{"a":12345678901234567000}'),
    ('{"a":1e400}', '{"a":null}'),
    ('{"b":1,"10":2,"9":3,"01":4}', '{"9":3,"10":2,"b":1,"01":4}'),
    ('{"a":"é\\u00e9\\n\\"/"}', '{"a":"éé\\n\\"/"}'),
    ('{"a":"\\ud800"}', '{"a":"\\ud800"}'),
    ('{"a":1,"a":{"pan":"ABCDE1234F"}}', '{"a":{"pan":"ABC****34F"}}'),
]


@pytest.mark.parametrize("text, expected", TEXTS)
def test_text_of_result(text, expected):
    assert redacted(text) == expected


def test_as_a_column(spark):
    texts = [text for text, _ in TEXTS] + [None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = {r.i: r.o for r in frame.select("i", redact_payload(F.col("t")).alias("o")).collect()}
    assert [out[i] for i in range(len(texts))] == [expected for _, expected in TEXTS] + [None]


# -- any depth ------------------------------------------------------------------------


@pytest.mark.parametrize("levels", [900, 1_100, 100_000])
def test_depth_has_no_limit(levels):
    decode, encode = _codec()
    inner = '{"pan":"ABCDE1234F","2":1.0,"1":["9876543210",null,true,-0.5e3]}'
    text = '[{"a":' * levels + inner + "}]" * levels
    done = redact_text(text, decode, encode)
    expected = '{"1":["******3210",null,true,-500],"2":1,"pan":"ABC****34F"}'
    assert done == '[{"a":' * levels + expected + "}]" * levels
    assert redact_text(text[:-1], decode, encode) == "[REDACTED:UNPARSEABLE]"


@settings(max_examples=300, deadline=None)
@given(st.recursive(
    st.none() | st.booleans() | st.integers(-2**70, 2**70) | st.floats(allow_nan=False)
    | st.text(max_size=12) | st.sampled_from(["9876543210", "ABCDE1234F", "a@b.co", "1234 5678 9012"]),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(
        st.sampled_from(["pan", "Mobile_No", "x", "10", "9", "é", "account-no", ""]), inner,
        max_size=5), max_leaves=25), st.booleans())
def test_deep_path_equals_the_plain_one(node, spaced):
    decode, encode = _codec()
    text = json.dumps(node, indent=1 if spaced else None, allow_nan=False) if node not in (
        float("inf"), float("-inf")) and "inf" not in repr(node) else "[]"
    plain = redact(decode(text))
    assert write_deep(redact_deep(text)) == encode(plain)


@pytest.mark.parametrize("text", [
    "", " ", "{", "[", "[1,]", "[1 2]", '{"a"}', '{"a":}', '{"a":1,}', "{1:2}", "nul", "NaN",
    "[Infinity]", "01", "1.", "-", "'a'", '"\x01"', "[1]]", "{} x", '{"a" 1}', "[1}", '{"a":1]'])
def test_deep_path_refuses_what_the_plain_one_refuses(text):
    decode, _ = _codec()
    with pytest.raises(ValueError):
        decode(text)
    with pytest.raises(ValueError):
        redact_deep(text)


def test_deep_path_takes_the_last_of_equal_keys():
    text = '{"a":1,"b":"x","a":{"pan":"ABCDE1234F","pan":"XYZAB9876C"}}'
    decode, encode = _codec()
    assert write_deep(redact_deep(text)) == encode(redact(decode(text)))
