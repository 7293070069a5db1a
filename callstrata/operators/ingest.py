"""From message bodies to cold documents and hot rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callstrata import contract
from callstrata.functions import scalars
from callstrata.functions.redaction import redact_payload

UUID_SHAPE = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
DEFAULT_ENVIRONMENT = "staging"

PARSE_OPTIONS = {
    "mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
}

# Reasons that keep a message out of the cold archive too.
NOT_ARCHIVED = ("unparseable", "unsupported_version")


# -- producer side ------------------------------------------------------------


def camel_name(column: str) -> str:
    first, *rest = column.split("_")
    return first + "".join(word.capitalize() for word in rest)


def wire_rename(events: DataFrame) -> DataFrame:
    """Producer field names (camel case) to wire names (snake case), one to one."""
    return events.select(
        *[F.col(camel_name(name)).alias(name) for name in contract.WIRE_COLUMNS])


def message_body(columns: dict[str, Column]) -> Column:
    """JSON text of an event; fields that are NULL are left out."""
    return F.to_json(F.struct(*[column.alias(name) for name, column in columns.items()]))


def wire_columns() -> dict[str, Column]:
    return {name: F.col(name) for name in contract.WIRE_COLUMNS}


def truncate_payloads(events: DataFrame, max_bytes: int = contract.MAX_PAYLOAD_BYTES) -> DataFrame:
    """Cut long payloads and flag them; the hash is of the whole request."""
    payloads = ("request_payload", "response_payload")
    too_long = F.lit(False)
    for name in payloads:
        too_long = too_long | scalars.is_too_long(F.col(name), max_bytes)
    return events.withColumns({
        "request_hash": scalars.request_hash(F.col("request_payload")),
        "payload_truncated": F.coalesce(too_long, F.lit(False)),
        **{name: scalars.truncate_payload(F.col(name), max_bytes) for name in payloads},
    })


def to_messages(events: DataFrame, max_bytes: int = contract.MAX_MESSAGE_BYTES) -> DataFrame:
    """Adds `body`. A message over the limit keeps its metadata, not its payloads."""
    whole = wire_columns()
    stripped = {
        **whole,
        "request_payload": F.lit(contract.OVERSIZED_MARK),
        "response_payload": F.lit(contract.OVERSIZED_MARK),
        "payload_truncated": F.lit(True),
    }
    body = events.withColumn("_whole", message_body(whole))
    return body.withColumn(
        "body",
        F.when(F.octet_length("_whole") <= max_bytes, F.col("_whole")).otherwise(
            message_body(stripped)),
    ).drop("_whole")


# -- archive side -------------------------------------------------------------


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message bodies to wire columns, with `reason` set where one must not pass.

    Unknown keys are ignored. `reason` is NULL for a good event; a message of a
    version we do not know is "unsupported_version", which is not a failure. A
    field of the wrong type is NULL and makes the message a "bad_field"; its other
    fields are there, and it goes to the cold archive as it is.
    """
    schema = f"{contract.WIRE_SCHEMA}, _corrupt STRING"
    event = F.from_json(
        "body", schema, {**PARSE_OPTIONS, "columnNameOfCorruptRecord": "_corrupt"})
    # As a generator the parse runs once per message. As a plain column it would
    # be copied into every filter and column that uses one of its fields.
    return (
        messages.select("*", F.inline(F.array(event)))
        .withColumn("reason", rejection_reason())
        .drop("_corrupt")
    )


def rejection_reason() -> Column:
    version = F.col("schema_version")
    # The parser alone would take a list of objects, and text after an object.
    body = F.col("body")
    is_object = F.coalesce(body.rlike(r"^\s*\{") & body.rlike(r"\}\s*\z"), F.lit(False))
    # A newer version may have other types: it is skipped before types are judged.
    stated = F.get_json_object("body", "$.schema_version")
    other = F.coalesce(stated != str(contract.SUPPORTED_SCHEMA_VERSION), F.lit(False))
    corrupt = F.col("_corrupt").isNotNull()
    # As text any value fits, so what fails here too is no JSON. Looked at only where
    # the typed parse failed; that one keeps the fields that do fit.
    as_text = ", ".join(f"{name} STRING" for name in contract.WIRE_COLUMNS) + ", _bad STRING"
    is_json = F.from_json(
        body, as_text, {**PARSE_OPTIONS, "columnNameOfCorruptRecord": "_bad"})["_bad"].isNull()
    return (
        F.when(~is_object, "unparseable")
        .when(corrupt & other, "unsupported_version")
        .when(corrupt & ~is_json, "unparseable")
        .when(corrupt & version.isNull(), "unsupported_version")
        .when(corrupt, "bad_field")
        .when(~F.equal_null(version, F.lit(contract.SUPPORTED_SCHEMA_VERSION)),
              "unsupported_version")
        .otherwise(hot_rejection())
    )


def hot_rejection() -> Column:
    """Why an event cannot be a hot row; NULL when it can."""
    is_uuid = F.coalesce(F.col("request_id").rlike(UUID_SHAPE), F.lit(False))
    stage_known = F.coalesce(
        F.col("loan_lifecycle_stage").isin(*contract.LIFECYCLE_STAGES), F.lit(False))
    return (
        F.when(~is_uuid, "bad_request_id")
        .when(~stage_known, "bad_stage")
        .when(scalars.event_time(F.col("created_at")).isNull(), "bad_created_at")
    )


def version_gate(parsed: DataFrame) -> DataFrame:
    """Messages of the supported version that could be parsed."""
    return parsed.where(~F.coalesce(F.col("reason").isin(*NOT_ARCHIVED), F.lit(False)))


def skipped_versions(parsed: DataFrame) -> DataFrame:
    skipped = parsed.where(F.col("reason") == "unsupported_version")
    return skipped.groupBy("schema_version").agg(F.count("*").alias("skipped"))


def quarantine_rows(parsed: DataFrame) -> DataFrame:
    """Messages to park. Cold is written before hot checks, so it may be there."""
    bad = parsed.where(F.col("reason").isNotNull() & (F.col("reason") != "unsupported_version"))
    return bad.withColumns({
        "cold_written": F.col("reason") != "unparseable",
        "parked_at": F.col("received_at"),
    })


def with_cold_keys(parsed: DataFrame) -> DataFrame:
    """Adds the day and object keys of each event."""
    prefix = scalars.cold_prefix(
        F.col("cold_day"), F.col("vendor_id"), F.col("endpoint"), F.col("user_id"),
        F.col("request_id"))
    return parsed.withColumn(
        "cold_day", scalars.safe_day(F.col("created_at"), F.col("received_at"))
    ).withColumns({
        "s3_request_key": scalars.cold_key(prefix, "request"),
        "s3_response_key": scalars.cold_key(prefix, "response"),
    })


def map_hot_row(events: DataFrame, environment: str = DEFAULT_ENVIRONMENT) -> DataFrame:
    """Hot columns of good events. Only NULL takes a default: '' and 0 stay. Required
    values that a message left out have theirs, too, so no filter loses the row.

    The two payloads pass through Arrow to Python in one step; all else is
    built in.
    """

    def default(name: str, value: str = "") -> Column:
        return F.coalesce(F.col(name), F.lit(value))

    special = {
        "created_at": scalars.event_time(F.col("created_at")),
        "ingested_at": F.col("received_at"),
        "environment": default("environment", environment),
        "loan_application_number": F.col("loan_application_number"),
        "aadhaar_last4_encrypted": F.lit(""),
        # an absent payload is one that cannot be redacted
        **{name: F.coalesce(redact_payload(F.col(name)), F.lit(contract.UNPARSEABLE_MARK))
           for name in ("request_payload", "response_payload")},
        "payload_truncated": F.coalesce(F.col("payload_truncated"), F.lit(False)).cast("int"),
        "request_hash": default("request_hash"),
    }
    carried = [name for name in ("delivery", "batch_id") if name in events.columns]

    def column(name: str) -> Column:
        if name in special:
            return special[name].alias(name)
        if name in contract.OPTIONAL_WIRE_COLUMNS:
            return default(name).alias(name)
        if name in contract.REQUIRED_DEFAULTS:
            return F.coalesce(F.col(name), F.lit(contract.REQUIRED_DEFAULTS[name]).cast(
                "bigint" if name == "latency_ms" else "string")).alias(name)
        return F.col(name)

    return events.select(*[column(name) for name in contract.HOT_COLUMNS], *carried)


def hot_rows(messages: DataFrame, environment: str = DEFAULT_ENVIRONMENT) -> DataFrame:
    """Bodies to hot rows in one pass."""
    parsed = parse_messages(messages)
    return map_hot_row(with_cold_keys(parsed.where("reason IS NULL")), environment)
