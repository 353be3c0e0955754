"""The streaming job over a file source carrying the topic's JSON lines."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from conftest import ALERTS, T0, USERS, alert_row, rows
from pyspark.sql import functions as F

from tidemark.operators.events import enrich_events_with_account
from tidemark.plans import daily
from tidemark.sources.shared_files import names_in, read_text, remove, write_text
from tidemark.streaming import live_events
from tidemark.streaming.batch_log import BatchLog


def event(event_id, customer="1", feature="AI_Assistant", minute=0, **changed):
    body = {
        "event_id": event_id,
        "event_type": "product_usage",
        "customer_id": customer,
        "user_id": "10",
        "feature": feature,
        "timestamp": f"2026-03-01T10:{minute:02d}:00.250000+00:00",
    }
    body.update(changed)
    return json.dumps({key: value for key, value in body.items() if value is not ...})


class Topic:
    """A folder of message files, one file per delivery."""

    def __init__(self, spark, folder: Path):
        self.spark, self.folder, self.count = spark, folder, 0
        folder.mkdir()

    def send(self, *messages):
        (self.folder / f"{self.count:04d}.txt").write_text("\n".join(messages) + "\n")
        self.count += 1

    def stream(self):
        lines = self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.folder))
        return lines.select("value", F.lit(T0).cast("timestamp").alias("received_at"))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def run(topic, out, **options):
    live_events.start_live_events(topic.stream(), str(out), availableNow=True, **options).awaitTermination()
    return (
        rows(live_events.stored_events(topic.spark, str(out)), "event_id"),
        rows(live_events.stored_alerts(topic.spark, str(out)), "customer_id"),
    )


@pytest.mark.parametrize("dedupe", ["sink", "state", "watermark"])
def test_each_event_is_stored_once(topic, tmp_path, dedupe):
    out = tmp_path / "out"
    topic.send(event("a"), event("a"), event("b", "2", "Reports"))
    topic.send(event("a"), event("c", "1", minute=1), event("d", "3"))
    ids, alerted = run(topic, out, dedupe=dedupe)
    assert ids == [("a",), ("b",), ("c",), ("d",)]
    assert alerted == [("1",), ("3",)]  # the second event of customer 1 meets its open alert
    topic.send(event("d", "3"), event("e", "2"))
    ids, alerted = run(topic, out, dedupe=dedupe)
    assert ids == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert alerted == [("1",), ("2",), ("3",)]


def test_one_alert_for_two_triggers_in_a_batch(topic, tmp_path, spark):
    topic.send(event("late", minute=9), event("early", minute=1), event("n1", None), event("n2", ..., minute=2))
    known = spark.createDataFrame([alert_row(1, 5, "Expansion Opportunity"), alert_row(2, 1, "Payment Failure")], ALERTS)
    ids, alerted = run(topic, tmp_path / "out", alerts=lambda session: known)
    assert len(ids) == 4
    assert alerted == [(None,), (None,), ("1",)]
    texts = [json.loads(m) for (m,) in rows(live_events.stored_alerts(spark, str(tmp_path / "out")), "metadata")]
    assert {t["event_id"] for t in texts} == {"early", "n1", "n2"}
    assert next(t for t in texts if t["event_id"] == "early")["event_timestamp"] == "2026-03-01T10:01:00.250000+00:00"


def test_known_open_alert_suppresses(topic, tmp_path, spark):
    topic.send(event("a", "5"), event("b", "6"))
    known = spark.createDataFrame(
        [alert_row(1, 5, "Expansion Opportunity"), alert_row(2, 6, "Expansion Opportunity", "Acknowledged")], ALERTS
    )
    assert run(topic, tmp_path / "out", alerts=lambda session: known)[1] == [("6",)]


def test_acknowledged_alert_fires_again(topic, tmp_path, spark, own_tables):
    out = tmp_path / "out"
    current = {"table": daily.alert_table(spark).limit(0)}

    def table(session):
        return current["table"]

    topic.send(event("a"))
    assert run(topic, out, alerts=table)[1] == [("1",)]
    stored = daily.take_in_live_alerts(spark, str(out), str(tmp_path / "work"), T0)
    assert rows(stored.filter("alert_type = 'Expansion Opportunity'"), "customer_id", "status") == [(1, "Open")]
    again = daily.take_in_live_alerts(spark, str(out), str(tmp_path / "work"), T0)
    assert again.count() == 1  # taken in once
    current["table"] = again
    topic.send(event("b"))
    assert run(topic, out, alerts=table)[1] == [("1",)]  # still open
    current["table"] = again.withColumn("status", F.lit("Acknowledged"))
    topic.send(event("c"))
    assert run(topic, out, alerts=table)[1] == [("1",), ("1",)]


def test_replay_with_its_alert_already_taken_in(topic, tmp_path, spark):
    out = tmp_path / "out"
    topic.send(event("a"))
    before = run(topic, out)
    raised = live_events.stored_alerts(spark, str(out)).withColumn("alert_id", F.lit(1))
    table = spark.createDataFrame(raised.collect(), raised.schema)
    for name in ("0", ".0.crc"):
        (out / "_checkpoints" / "live_events" / "commits" / name).unlink()
    assert run(topic, out, alerts=lambda session: table) == before == ([("a",)], [("1",)])


@pytest.mark.parametrize("dedupe", ["sink", "state"])
def test_a_replayed_batch_changes_nothing(topic, tmp_path, dedupe):
    out = tmp_path / "out"
    topic.send(event("a"))
    topic.send(event("b", "2"), event("a"))
    before = run(topic, out, dedupe=dedupe)
    commits = out / "_checkpoints" / "live_events" / "commits"
    for name in ("1", ".1.crc"):  # as if the driver died after writing, before committing
        (commits / name).unlink()
    assert run(topic, out, dedupe=dedupe) == before == ([("a",), ("b",)], [("1",), ("2",)])


def test_unusable_messages_go_to_dead_letters(topic, tmp_path, spark):
    bad = {
        "{not json": "not a JSON object",
        "[1, 2]": "not a JSON object",
        '"text"': "not a JSON object",
        "17": "not a JSON object",
        event("x", event_type=...): "required field missing",
        event(...): "required field missing",
        event("x", timestamp=None): "required field missing",
        event("x", timestamp="yesterday"): "timestamp unreadable",
        event("cut")[:-1]: "not a JSON object",
    }
    topic.send(*bad, event("good"))
    out = tmp_path / "out"
    ids, _ = run(topic, out)
    assert ids == [("good",)]
    live_events.start_dead_letters(topic.stream(), str(out), availableNow=True).awaitTermination()
    letters = spark.read.parquet(str(out / "dead_letters"))
    assert dict(rows(letters, "raw_event", "problem")) == bad


def test_parsed_values(spark):
    messages = spark.createDataFrame([(event("a", 42, extra="kept"), datetime(2026, 1, 1))], "value string, received_at timestamp")
    row = live_events.usable(live_events.parse_messages(messages)).first()
    assert row["customer_id"] == "42"  # numbers arrive as text
    assert json.loads(row["raw_event"])["extra"] == "kept"
    assert row["event_timestamp"] == datetime(2026, 3, 1, 10, 0, 0, 250000)


def test_messages_are_parsed_once(spark):
    messages = spark.createDataFrame([(event("a"), datetime(2026, 1, 1))], "value string, received_at timestamp")
    plan = live_events.usable(live_events.parse_messages(messages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_batch_form_and_unknown_mode(spark):
    messages = spark.createDataFrame(
        [(event("a"), T0), (event("b"), T0), (event("b"), T0)], "value string, received_at timestamp"
    )
    stored = spark.createDataFrame([("a",)], "event_id string")
    assert rows(live_events.ingest_batch(messages, stored), "event_id") == [("b",)]
    with pytest.raises(ValueError, match="dedupe"):
        live_events.start_live_events(messages, "/nowhere", dedupe="hope")


def test_enrich_a_stream(topic, tmp_path, spark):
    topic.send(event("a"), event("b", user_id="77"))
    users = spark.createDataFrame([(10, 500, "User", T0)], USERS)
    enriched = enrich_events_with_account(live_events.usable(live_events.parse_messages(topic.stream())), users)
    query = (
        enriched.writeStream.format("parquet")
        .option("path", str(tmp_path / "enriched"))
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "enriched")), "event_id", "customer_id") == [("a", 500), ("b", None)]


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert read_text(spark, path) is None and names_in(spark, str(tmp_path / "a")) == []
    for text in ("é1", "2"):
        write_text(spark, path, text)
        assert read_text(spark, path) == text
    assert [name for name in names_in(spark, str(tmp_path / "a")) if not name.endswith(".crc")] == ["b.json"]
    remove(spark, path)
    remove(spark, path)
    assert read_text(spark, path) is None


def numbers(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "n int").coalesce(1)


def test_log_stays_in_few_folders(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), "n int", fold=3, retained=4)
    assert log.rows().count() == 0
    seen = []
    for batch in range(30):
        assert rows(log.before("s", batch)) == [(n,) for n in range(batch)]
        assert rows(log.store(numbers(spark, batch), "s", batch)) == [(batch,)]
        seen.append(len(log.folders()))
    assert rows(log.rows()) == [(n,) for n in range(30)]
    assert max(seen) <= 2 * 4 and seen[-1] <= seen[9] + 2
    assert len(log._versions()) == 4
    kept = [name for name in names_in(spark, log.path) if name.startswith("rows-")]
    assert len(kept) <= len(log.folders()) + 3 * 4  # of the retained versions


@pytest.mark.parametrize("at", [1, 2, 5, 8])
def test_log_replays_a_batch(spark, tmp_path, at):
    log = BatchLog(spark, str(tmp_path / "log"), "n int", fold=3)
    for batch in range(at + 1):
        log.store(numbers(spark, batch), "s", batch)
    before = log.folders()
    assert rows(log.before("s", at)) == [(n,) for n in range(at)]
    log.store(numbers(spark, at), "s", at)  # once more
    assert log.folders() == before and rows(log.rows()) == [(n,) for n in range(at + 1)]
    # Another stream numbers its batches from 0 again.
    assert rows(log.before("t", 0)) == [(n,) for n in range(at + 1)]
    log.store(numbers(spark, 100), "t", 0)
    assert rows(log.rows()) == [*[(n,) for n in range(at + 1)], (100,)]


def test_log_does_not_fold_large_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.streaming.batch_log.LARGEST", 1)
    log = BatchLog(spark, str(tmp_path / "log"), "n int", fold=2)
    for batch in range(5):
        log.store(numbers(spark, batch), "s", batch)
    assert len(log.folders()) == 5 and log.rows().count() == 5


def test_settled_alerts_leave_the_folded_state(topic, tmp_path, spark, monkeypatch):
    monkeypatch.setattr(BatchLog.__init__, "__defaults__", (2, 20))
    out = tmp_path / "out"
    settled = spark.createDataFrame([alert_row(1, 1, "Expansion Opportunity", "Acknowledged")], ALERTS)
    table = settled.withColumn("metadata", F.lit('{"event_id":"a"}'))
    topic.send(event("a"))
    topic.send(event("b", "2"))
    topic.send(event("c"), event("d", "2"))
    ids, alerted = run(topic, out, alerts=lambda session: table)
    assert ids == [("a",), ("b",), ("c",), ("d",)]
    assert alerted == [("1",), ("1",), ("2",)]  # the first alert of customer 1 was settled
    state = live_events._logs(spark, str(out))[2]
    assert len(state.folders()) == 2 and rows(state.rows(), "source_event") == [("b",), ("c",)]


def test_a_lost_checkpoint_stores_nothing_twice(topic, tmp_path, spark):
    out = tmp_path / "out"
    topic.send(event("a"), event("b", "2"))
    topic.send(event("c", "3"))
    before = run(topic, out, dedupe="sink")
    remove(spark, str(out / "_checkpoints"))
    topic.send(event("d", "4"))
    ids, alerted = run(topic, out, dedupe="sink")
    assert (ids, alerted) == (before[0] + [("d",)], before[1] + [("4",)])
