"""Masks, keyed hashes and payload redaction over whole tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from callstrata.functions import masking
from callstrata.functions.redaction import redact_payload as redact
from callstrata.operators.lookups import lookup_by_mobile as find_mobile
from callstrata.verification.messages import over_calls
from callstrata.verification.registry import Registry
from callstrata.verification.sample import call_events, table

registry = Registry()
QUERIES, SQL = registry.queries, registry.sql
query = registry.query

# Stand-ins for the two secrets; real ones come from a secret store.
MOBILE_KEY = "mobile-key-for-tests"
AADHAAR_KEY = "aadhaar-key-for-tests"


def hmac_sql(text: str, key: str) -> str:
    """HMAC from its definition, for a key of up to 64 bytes."""
    block = key.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in block).hex()
    outer = bytes(b ^ 0x5C for b in block).hex()
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"


def inputs(spark, sf_dir, *columns):
    """Identifiers of all sample events, and all document texts, as one column."""
    events = call_events(spark, sf_dir)
    values = None
    for name in columns:
        part = events.select("event_id", "delivery", F.lit(name).alias("kind"),
                             F.col(name).alias("value"))
        values = part if values is None else values.unionByName(part)
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("event_id"), F.lit(0).alias("delivery"),
        F.lit("text").alias("kind"), F.col("text").alias("value"))
    return values.unionByName(documents)


def over_inputs(sql: str, *columns: str) -> str:
    parts = [f"SELECT event_id, delivery, '{name}' AS kind, {name} AS value FROM c"
             for name in columns]
    parts.append("SELECT doc_id, 0, 'text', text FROM documents")
    return over_calls(f", i AS ({' UNION ALL '.join(parts)}) {sql}").replace(") , i AS", "), i AS")


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"


@query(over_inputs(f"""SELECT event_id, delivery, kind, CASE WHEN length(d) < 4 THEN '***'
    ELSE repeat('*', length(d) - 4) || right(d, 4) END AS masked
    FROM (SELECT *, {_DIGITS} AS d FROM i)""", "mobile", "request_id"))
def mask_mobile(spark, sf_dir):
    return inputs(spark, sf_dir, "mobile", "request_id").select(
        "event_id", "delivery", "kind", masking.mask_mobile(F.col("value")).alias("masked"))


@query(over_inputs(f"""SELECT event_id, delivery, kind, CASE WHEN length(d) <= 4 THEN '****'
    ELSE repeat('*', length(d) - 4) || right(d, 4) END AS masked
    FROM (SELECT *, {_DIGITS} AS d FROM i)""", "mobile", "request_id"))
def mask_account(spark, sf_dir):
    return inputs(spark, sf_dir, "mobile", "request_id").select(
        "event_id", "delivery", "kind", masking.mask_account(F.col("value")).alias("masked"))


@query(over_inputs("""SELECT event_id, delivery, kind, CASE WHEN length(p) < 6 THEN p
    ELSE left(p, 3) || repeat('*', length(p) - 6) || right(p, 3) END AS masked
    FROM (SELECT *, regexp_replace(value, '^\\s+|\\s+$', '', 'g') AS p FROM i)""",
    "pan", "mobile_last4"))
def mask_pan(spark, sf_dir):
    return inputs(spark, sf_dir, "pan", "mobile_last4").select(
        "event_id", "delivery", "kind", masking.mask_pan(F.col("value")).alias("masked"))


@query(over_inputs("""SELECT event_id, delivery, kind, CASE WHEN pos = 0 THEN '***@***'
    WHEN pos <= 3 THEN repeat('*', pos - 1) || substr(value, pos)
    ELSE left(value, 1) || repeat('*', pos - 3) || substr(value, pos - 1) END AS masked
    FROM (SELECT *, instr(value, '@') AS pos FROM i)""", "email", "mobile"))
def mask_email(spark, sf_dir):
    return inputs(spark, sf_dir, "email", "mobile").select(
        "event_id", "delivery", "kind", masking.mask_email(F.col("value")).alias("masked"))


_FORMS = {
    "bare": "mobile", "plus": "'+91 ' || mobile", "country": "'91' || mobile",
    "trunk": "'091' || mobile", "zero": "'0' || mobile", "spaced": "left(mobile, 5) || '-' || right(mobile, 5)",
}
_E164 = """CASE WHEN length(d) = 10 THEN '+91' || d
    WHEN length(d) = 13 AND d LIKE '091%' THEN '+' || substr(d, 2) ELSE '+' || d END"""
_FORMS_SQL = ", f AS (" + " UNION ALL ".join(
    f"SELECT event_id, delivery, '{name}' AS form, {_DIGITS.replace('value', text)} AS d FROM c"
    for name, text in _FORMS.items()) + ")"


def mobile_forms(spark, sf_dir):
    events = call_events(spark, sf_dir)
    forms = F.array(*[F.struct(F.lit(name).alias("form"), F.expr(text).alias("written"))
                      for name, text in _FORMS.items()])
    return events.select("event_id", "delivery", F.inline(forms))


@query(over_calls(f"{_FORMS_SQL} SELECT event_id, delivery, form, {_E164} AS e164 FROM f")
       .replace(") , f AS", "), f AS"))
def norm_mobile(spark, sf_dir):
    return mobile_forms(spark, sf_dir).select(
        "event_id", "delivery", "form",
        masking.normalize_mobile(F.col("written")).alias("e164"))


@query(over_calls(f"""{_FORMS_SQL} SELECT event_id, delivery, form,
    {hmac_sql(_E164, MOBILE_KEY)} AS mobile_hash, right({_E164}, 4) AS mobile_last4 FROM f""")
       .replace(") , f AS", "), f AS"))
def hash_mobile(spark, sf_dir):
    written = F.col("written")
    return mobile_forms(spark, sf_dir).select(
        "event_id", "delivery", "form",
        masking.hash_mobile(written, MOBILE_KEY).alias("mobile_hash"),
        masking.mobile_last4(written).alias("mobile_last4"))


@query(over_calls(f"""SELECT event_id, delivery,
    {hmac_sql('mobile_last4', AADHAAR_KEY)} AS aadhaar_last4_hash FROM c"""))
def hash_aadhaar4(spark, sf_dir):
    return call_events(spark, sf_dir).select(
        "event_id", "delivery",
        masking.hash_aadhaar_last4(F.col("mobile_last4"), AADHAAR_KEY).alias("aadhaar_last4_hash"))


@query(over_calls("""SELECT request_id, delivery, redacted_request_payload AS request_payload,
    hot_response_payload AS response_payload FROM c"""))
def redact_payload(spark, sf_dir):
    return call_events(spark, sf_dir).select(
        "request_id", "delivery",
        redact(F.col("request_payload")).alias("request_payload"),
        redact(F.col("response_payload")).alias("response_payload"))


@query(r"""SELECT doc_id, '{"doc_id":' || doc_id || ',"contact":"' || repeat('*', length(digits) - 4)
      || right(digits, 4) || '","notes":[' || to_json(CASE
        WHEN regexp_matches(text, '\b\d{4}\s?\d{4}\s?\d{4}\b')
          THEN regexp_replace(text, '\b\d{4}\s?\d{4}\s?\d{4}\b', '[AADHAAR_REDACTED]', 'g')
        ELSE text END) || '],"score":2}' AS payload
    FROM (SELECT *, '90000' || lpad(CAST(doc_id AS VARCHAR), 5, '0') AS digits FROM documents)""")
def redact_documents(spark, sf_dir):
    """Whole documents inside payloads: free text in an array, a phone, a number."""
    payload = F.to_json(F.struct(
        "doc_id",
        F.concat(F.lit("90000 "), F.lpad(F.col("doc_id").cast("string"), 5, "0")).alias("contact"),
        F.array("text").alias("notes"),
        F.lit(2.0).alias("score"),
    ))
    return table(spark, sf_dir, "documents").select("doc_id", redact(payload).alias("payload"))


@query(over_calls("""SELECT outcome, count(*) AS payloads FROM (
    SELECT CASE WHEN request_payload = '[OVERSIZED]' OR suffix(request_payload, '[TRUNCATED]')
      THEN 'closed' ELSE 'redacted' END AS outcome FROM c) GROUP BY 1"""))
def redact_or_close(spark, sf_dir):
    closed = redact(F.col("request_payload")) == "[REDACTED:UNPARSEABLE]"
    return call_events(spark, sf_dir).select(
        F.when(closed, "closed").otherwise("redacted").alias("outcome")
    ).groupBy("outcome").agg(F.count("*").alias("payloads"))


@query("""SELECT lang, source, count(*) AS documents, count(*) FILTER (
      WHERE regexp_matches(text, '[A-Z]{5}[0-9]{4}[A-Z]')
         OR regexp_matches(text, '[6-9][0-9]{9}')) AS suspects
    FROM documents GROUP BY 1, 2""")
def pii_watch(spark, sf_dir):
    """Residual identifiers in free text."""
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(
        F.count("*").alias("documents"),
        F.count_if(masking.holds_identifier(F.col("text"))).alias("suspects"))


@query(over_calls("""SELECT request_id, vendor_id, mobile_last4, delivery FROM c
    WHERE mobile = '9000000194' AND mobile_hash <> ''"""))
def lookup_by_mobile(spark, sf_dir):
    """Events of one customer by number, in another spelling of it."""
    hot = call_events(spark, sf_dir).withColumn(
        "mobile_hash",
        F.when(F.col("mobile_hash") == "", "").otherwise(
            masking.hash_mobile(F.col("mobile"), MOBILE_KEY)))
    return find_mobile(hot, "+91 90000 00194", MOBILE_KEY).select(
        "request_id", "vendor_id", "mobile_last4", "delivery")
