"""Live events: parse, store once, raise expansion alerts.

Delivery is at least once and every batch stores its rows as a version of a
batch log, so a batch that is replayed replaces its own rows: stored events and
alerts come out exactly once, and what a batch reads of earlier ones lies in few
folders however many there were.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.fixed_values import EXPANSION_FEATURE
from tidemark.operators.alerts import expansion_alerts
from tidemark.sources.shared_files import read_text
from tidemark.streaming.batch_log import BatchLog

MESSAGE_SCHEMA = (
    "event_id string, event_type string, customer_id string, user_id string, feature string, `timestamp` string, "
    "broken string"
)
REQUIRED = ("event_id", "event_type", "timestamp")
EVENT_COLUMNS = [
    "event_id",
    "event_type",
    "customer_id",
    "user_id",
    "feature",
    "event_timestamp",
    "raw_event",
    "received_at",
]
EVENT_SCHEMA = (
    "event_id string, event_type string, customer_id string, user_id string, feature string, "
    "event_timestamp timestamp, raw_event string, received_at timestamp"
)
ALERT_SCHEMA = (
    "customer_id string, alert_type string, severity string, owner string, status string, "
    "reason string, recommended_action string, source string, metadata string"
)
OPEN_ALERT_SCHEMA = "customer_id string, alert_type string, status string, source_event string"


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The topic from its earliest offset, as ``value`` text and arrival time."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Typed events beside ``problem``, which is NULL for a usable message.

    The parsed object is unfolded by a generator.  Filters do not move below
    one, so each message is parsed once however many fields are tested later.
    """
    body = F.from_json("value", MESSAGE_SCHEMA, {"columnNameOfCorruptRecord": "broken"})
    parsed = messages.select(F.inline(F.array(body)), F.col("value").alias("raw_event"), "received_at")
    is_object = F.ltrim("raw_event").startswith("{") & F.col("broken").isNull()
    missing = F.lit(False)
    for name in REQUIRED:
        missing = missing | F.col(name).isNull()
    at = F.col("timestamp").try_cast("timestamp")
    problem = (
        F.when(~F.coalesce(is_object, F.lit(False)), "not a JSON object")
        .when(missing, "required field missing")
        .when(at.isNull(), "timestamp unreadable")
    )
    return parsed.select(
        "event_id",
        "event_type",
        "customer_id",
        "user_id",
        "feature",
        at.alias("event_timestamp"),
        "raw_event",
        "received_at",
        problem.alias("problem"),
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).select(*EVENT_COLUMNS)


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNotNull()).select("raw_event", "received_at", "problem")


def first_deliveries(events: DataFrame) -> DataFrame:
    """One row per event id: the earliest received, then the smallest content.

    A combining aggregate, so an id delivered millions of times shuffles as
    one row per task.
    """
    content = ["received_at", *[name for name in EVENT_COLUMNS if name not in ("event_id", "received_at")]]
    return (
        events.groupBy("event_id")
        .agg(F.min(F.struct(*content)).alias("kept"))
        .select("event_id", "kept.*")
        .select(*EVENT_COLUMNS)
    )


def ingest_batch(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Events of a batch of messages that are not stored yet, once each."""
    return first_deliveries(usable(parse_messages(messages))).join(stored.select("event_id"), "event_id", "left_anti")


def _source_event(metadata: str = "metadata") -> Column:
    return F.get_json_object(metadata, "$.event_id").alias("source_event")


def unsettled(raised: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Of the job's open alerts, those that the platform's alert table ``stored``
    does not show as settled; all of them where there is no such table."""
    if stored is None:
        return raised
    settled = stored.filter(F.col("status") != "Open").select(_source_event())
    return raised.join(settled, "source_event", "left_anti")


def known_alerts(raised: DataFrame, stored: DataFrame | None, own_events: DataFrame) -> DataFrame:
    """Alerts that can suppress one of a batch's own.

    ``raised`` are the job's open alerts of earlier batches; ``stored`` is the
    platform's alert table as it stands.  A raised alert that was settled there
    no longer counts, and a stored alert that this very batch raised before a
    replay must not suppress itself.  Only customers of the batch matter: both
    sides are cut down to them before anything is shuffled.
    """
    customers = own_events.select(F.col("customer_id").cast("string")).distinct()
    known = unsettled(raised.join(customers, "customer_id", "left_semi"), stored)
    if stored is not None:
        current = stored.select(F.col("customer_id").cast("string"), "alert_type", "status", _source_event())
        own = own_events.select(F.col("event_id").alias("source_event"))
        theirs = current.join(customers, "customer_id", "left_semi").join(own, "source_event", "left_anti")
        known = known.unionByName(theirs)
    return known.drop("source_event")


def _logs(spark: SparkSession, folder: str) -> tuple[BatchLog, BatchLog, BatchLog]:
    """Events, alerts, and of the alerts what is needed to suppress others."""
    return (
        BatchLog(spark, f"{folder}/live_events", EVENT_SCHEMA),
        BatchLog(spark, f"{folder}/expansion_alerts", ALERT_SCHEMA),
        BatchLog(spark, f"{folder}/open_alerts", OPEN_ALERT_SCHEMA),
    )


def start_live_events(
    messages: DataFrame,
    folder: str,
    *,
    alerts: Callable[[SparkSession], DataFrame] | None = None,
    trigger_feature: str = EXPANSION_FEATURE,
    dedupe: str = "state",
    horizon: str = "7 days",
    **trigger,
) -> StreamingQuery:
    """Store new events below ``folder/live_events`` and the expansion alerts
    they raise below ``folder/expansion_alerts``.

    ``alerts`` gives the platform's alert table, asked anew for each batch, so
    that open alerts suppress and acknowledged ones stop doing so.

    ``dedupe`` decides how a repeated event id is recognised:
      * ``state``: against keyed state, exact for all time, one lookup per
        event however long the history.  Copies of an id within a batch meet
        in one task, so bound the batches (``maxOffsetsPerTrigger``);
      * ``sink``: against the ids stored so far.  Their column is read for every
        batch, but only ids that the batch has are shuffled.  Copies combine
        before the shuffle, so it suits a backlog taken in as one batch, and it
        holds after the checkpoint was lost or reset;
      * ``watermark``: as ``state``, but ids are forgotten after ``horizon``.
    """
    checkpoint = f"{folder}/_checkpoints/live_events"
    events = usable(parse_messages(messages))
    if dedupe == "state":
        events = events.dropDuplicates(["event_id"])
    elif dedupe == "watermark":
        events = events.withWatermark("event_timestamp", horizon).dropDuplicatesWithinWatermark(["event_id"])
    elif dedupe != "sink":
        raise ValueError(f"unknown dedupe mode: {dedupe}")

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = json.loads(read_text(session, f"{checkpoint}/metadata"))["id"]
        event_log, alert_log, open_log = _logs(session, folder)
        new = batch
        if dedupe == "sink":
            first = first_deliveries(batch).persist()  # compared with the stored ids, then stored
            stored = event_log.before(stream, batch_id).select("event_id")
            new = first.join(stored.join(first.select("event_id"), "event_id", "left_semi"), "event_id", "left_anti")
        own_events = event_log.store(new, stream, batch_id)
        if dedupe == "sink":
            first.unpersist()

        current = alerts(session) if alerts is not None else None
        triggers = own_events.filter(F.col("feature") == trigger_feature)
        known = known_alerts(open_log.before(stream, batch_id), current, triggers)
        raised = alert_log.store(expansion_alerts(own_events, known, trigger_feature), stream, batch_id)
        # An alert without a customer suppresses none.
        still_open = raised.filter(F.col("customer_id").isNotNull()).select("customer_id", "alert_type", "status", _source_event())
        open_log.store(still_open, stream, batch_id, on_fold=lambda rows: unsettled(rows, current))

    return (
        events.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def start_dead_letters(messages: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Keep every unusable message below ``folder/dead_letters``."""
    return (
        dead_letters(parse_messages(messages))
        .writeStream.format("parquet")
        .option("path", f"{folder}/dead_letters")
        .option("checkpointLocation", f"{folder}/_checkpoints/dead_letters")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def stored_events(spark: SparkSession, folder: str) -> DataFrame:
    return _logs(spark, folder)[0].rows()


def stored_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _logs(spark, folder)[1].rows()


def not_yet_stored(raised: DataFrame, stored: DataFrame) -> DataFrame:
    """The job's alerts that the platform's alert table does not hold yet."""
    fresh = raised.withColumn("source_event", _source_event()).join(
        stored.select(_source_event()), "source_event", "left_anti"
    )
    return fresh.drop("source_event")
