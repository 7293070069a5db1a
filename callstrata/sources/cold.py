"""The cold archive: raw payload documents and their metadata, by UTC day and vendor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callstrata import contract
from callstrata.operators.dedup import latest_copy
from callstrata.operators.ingest import DEFAULT_ENVIRONMENT
from callstrata.sources.committed import CommittedTable, DataFile
from callstrata.sources.files import together
from callstrata.sources.key_index import KeyIndex

PARTITIONS = ("year", "month", "day", "vendor_id")
ROWS_PER_FILE = 200_000
#: Archived events of at most this many bytes of metadata are sent to all tasks.
BROADCAST_BYTES = 64 << 20


def _day_parts() -> dict[str, Column]:
    return {
        name: F.substring(F.col("cold_day"), start, length)
        for name, start, length in (("year", 1, 4), ("month", 6, 2), ("day", 9, 2))
    }


def payload_documents(events: DataFrame, environment: str = DEFAULT_ENVIRONMENT) -> DataFrame:
    """Two documents per event: raw request and raw response, with a short header."""
    header = F.struct(
        "request_id", "service", "vendor_id", "endpoint", "created_at",
        F.lit(environment).alias("environment"))
    documents = F.array(*[
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(f"s3_{kind}_key").alias("s3_key"),
            F.col(f"{kind}_payload").alias("payload"),
        )
        for kind in ("request", "response")
    ])
    return (
        events.withColumns({**_day_parts(), "meta": header, "_document": F.explode(documents)})
        .select("_document.s3_key", "_document.kind", "meta", "_document.payload",
                "year", "month", "day", "vendor_id")
    )


def document_text() -> Column:
    """The JSON text of one document."""
    return F.to_json(F.struct("meta", "payload"), {"ignoreNullFields": "false"})


def metadata_rows(events: DataFrame) -> DataFrame:
    """The 18 metadata fields of each event, without payloads; its two keys; and why it
    did not become a hot row, if so."""
    defaults = {
        "user_id": "unknown", "pan_masked": "", "mobile_last4": "", "aadhaar_last4_hash": "",
        "consent_id": "", "request_hash": "",
    }
    return events.withColumns(_day_parts()).select(
        *[F.coalesce(F.col(name), F.lit(defaults[name])).alias(name) if name in defaults
          else F.col(name) for name in contract.COLD_META_COLUMNS],
        "s3_request_key", "s3_response_key",
        (F.col("reason") if "reason" in events.columns else F.lit(None).cast("string"))
        .alias("hot_reason"),
        "year", "month", "day",
    )


class ColdArchive:
    def __init__(self, spark: SparkSession, path: str, environment: str = DEFAULT_ENVIRONMENT):
        self.spark = spark
        self.payloads = CommittedTable(
            spark, f"{path}/payload", contract.COLD_PAYLOAD_SCHEMA, PARTITIONS,
            file_format="json", sort_by=("s3_key",),
            options={"compression": "gzip", "maxRecordsPerFile": str(ROWS_PER_FILE)})
        self.meta = CommittedTable(
            spark, f"{path}/meta",
            f"s3_request_key STRING, s3_response_key STRING, hot_reason STRING, "
            f"{contract.COLD_SCAN_SCHEMA}",
            PARTITIONS, file_format="json", sort_by=("created_at",),
            options={"compression": "gzip", "maxRecordsPerFile": str(ROWS_PER_FILE),
                     "ignoreNullFields": "false"},
            read_options={"mode": "DROPMALFORMED"})
        self.index = KeyIndex(spark, f"{path}/index")
        self.environment = environment

    def write(self, events: DataFrame, write_id: str) -> None:
        """Archive events: payloads, metadata, and last the index of request keys.

        An event counts as archived once its key is in the index.
        """
        together(
            self.spark,
            lambda: self.payloads.write(payload_documents(events, self.environment), write_id),
            lambda: self.meta.write(metadata_rows(events), write_id),
        )
        self.index.add(events.select("s3_request_key", "cold_day"), write_id)

    # -- reading --

    @staticmethod
    def _where(table: CommittedTable, vendor_id: str | None = None,
               days: list[str] | None = None, **parts: str | None) -> list[DataFile]:
        """Files of one vendor, of some days (`yyyy/MM/dd`), or of a year, month or day."""
        wanted = None if days is None else set(days)
        parts = {name: value for name, value in parts.items() if value is not None}

        def keep(file: DataFile) -> bool:
            if vendor_id is not None and (file.partition("vendor_id") or "") != vendor_id:
                return False
            if wanted is not None and "/".join(
                    file.partition(name) for name in PARTITIONS[:3]) not in wanted:
                return False
            return all(file.partition(name) == value for name, value in parts.items())

        return table.files(keep)

    def documents(self, vendor_id: str | None = None, days: list[str] | None = None
                  ) -> DataFrame:
        return self.payloads.read(self._where(self.payloads, vendor_id, days)).withColumn(
            "vendor_id", _vendor())

    def metadata(self, vendor_id: str | None = None, days: list[str] | None = None
                 ) -> DataFrame:
        """Metadata; malformed lines are ignored, `malformed` counts them."""
        return self.meta.read(self._where(self.meta, vendor_id, days)).withColumn(
            "vendor_id", _vendor())

    def malformed(self) -> DataFrame:
        """Lines of metadata that do not parse, with the number of times they occur."""
        files = self.meta.files()
        if not files:
            return self.spark.createDataFrame([], "line string, records bigint")
        lines = _lines(self.spark, [f"{self.meta.data_path}/{f.path}" for f in files])
        schema = f"{contract.COLD_SCAN_SCHEMA}, _corrupt STRING"
        parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"})
        return (lines.where(parsed["_corrupt"].isNotNull())
                .groupBy(F.col("value").alias("line")).agg(F.count("*").alias("records")))

    def scan(self, vendor_id: str, year: str | None = None, month: str | None = None,
             day: str | None = None) -> DataFrame:
        """Metadata of one vendor, optionally of one year, month or day.

        The vendor must be given, so that no query reads the whole archive. Files of
        other vendors and days are neither listed nor read.
        """
        if not vendor_id:
            raise ValueError("a cold scan needs a vendor_id")
        parts = {"year": year, "month": month, "day": day}
        rows = self.meta.read(self._where(self.meta, vendor_id, **parts)).where(
            F.col("vendor_id") == vendor_id)
        for name, value in parts.items():
            if value is not None:
                rows = rows.where(F.col(name) == value)
        return rows.drop("s3_request_key", "s3_response_key", "hot_reason").withColumn(
            "latency_ms", F.expr("try_cast(latency_ms AS INT)"))

    def request_keys(self, days: list[str], except_write: str | None = None) -> DataFrame:
        """Request keys archived on the given days (`yyyy/MM/dd`)."""
        return self.index.keys(days, except_write)

    def events(self, vendor_id: str | None = None, days: list[str] | None = None) -> DataFrame:
        """Archived events, one per object key, joined again from metadata and their two
        documents. An event without a document has NULL for it."""
        return self.with_payloads(
            latest_copy(self.metadata(vendor_id, days), ["s3_request_key"], [F.lit(1)]),
            vendor_id, days)

    def with_payloads(self, rows: DataFrame, vendor_id: str | None = None,
                      days: list[str] | None = None, few: bool = False) -> DataFrame:
        """Metadata rows with their payloads, left to right on the name that an event's
        objects share. All sides are dealt out by it once. Where `few` says that the rows
        are small enough to be sent to all tasks, the documents are only filtered, and
        those that are wanted are joined."""
        named = rows.withColumn("_event", _event_of(F.col("s3_request_key")))
        wanted = named.select("_event")
        for kind in ("request", "response"):
            side = self.documents(vendor_id, days).where(F.col("kind") == kind).select(
                _event_of(F.col("s3_key")).alias("_event"),
                F.col("payload").alias(f"{kind}_payload"))
            if few:
                side = side.join(F.broadcast(wanted), "_event", "left_semi")
            named = named.join(side, "_event", "left")
        # A document that two sources wrote at once is there twice.
        return named.dropDuplicates(["_event"]).drop("_event")

    # -- maintenance --

    def compact(self, *, most: int = 8, settled: float = 3600) -> int:
        """Merge small files of payloads and metadata. Returns the files replaced."""
        return sum(table.merge_small(most=most, settled=settled)
                   for table in (self.payloads, self.meta))

    def vacuum(self, grace: float) -> int:
        return sum(t.vacuum(grace) for t in (self.payloads, self.meta, self.index.table))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of packed files. One that is not packed, though its name says so, as after a
    repair by hand, is taken as it is: it is what such a search is for."""
    stored = spark.read.format("binaryFile").load(paths)
    plain = {row.path.rsplit("/", 1)[1] for row in stored.where(
        F.hex(F.substring("content", 1, 2)) != "1F8B").select("path").collect()}

    def some(kept: bool) -> list[str]:
        return [path for path in paths if (path.rsplit("/", 1)[1] in plain) is kept]

    if not plain:
        return spark.read.text(paths)
    lines = spark.read.format("binaryFile").load(some(True)).select(
        F.explode(F.split(F.decode("content", "UTF-8"), r"\r\n|\n|\r")).alias("value"))
    return lines.unionByName(spark.read.text(some(False))) if some(False) else lines


def _event_of(key: Column) -> Column:
    """What the keys of one event's objects have in common: all but the last segment."""
    return F.regexp_replace(key, r"/[^/]*\z", "")


def _vendor() -> Column:
    """An empty vendor has a folder of its own, which reads as NULL."""
    return F.coalesce(F.col("vendor_id"), F.lit(""))
