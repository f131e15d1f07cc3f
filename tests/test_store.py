"""The store's protocol: visibility, replay, stale snapshots, interrupted finalisation, facts, streams, backfills."""

from __future__ import annotations

import json
import os
import uuid
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.errors import SchemaError, SourceFailed, StoreError, Transient, ValidationError
from tidemark.operators import backfill, guard, normalize, quality, revision
from tidemark.operators.revision import Request
from tidemark.operators.upsert import Facts
from tidemark.plans import models, scenario
from tidemark.sources.market import fetch
from tidemark.sources.store import Store, ingest

DAY = date(2026, 8, 1)
PRICES, LOADS = Request("lmp", DAY, scenario.HUB), Request("load", DAY)


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "raw"))
    s.bootstrap()
    return s


def records(spark, value, product="lmp"):
    return lambda: normalize.normalize(product, scenario.source_frame(spark, product, value), scenario.PROVENANCE)


def run(store, value, request=PRICES):
    return ingest(store, request, uuid.uuid4().hex, records(store.spark, value, request.product))


def test_states_and_facts(spark, store, tmp_path):
    facts, seen = Facts(spark, str(tmp_path / "facts")), []
    for value in ("10", "10", "20", "10"):
        manifest = run(store, value)
        fact, changed = facts.build(store, "lmp")
        seen.append((manifest["new_contents"], manifest["new_transitions"], changed, int(fact.first().lmp)))
    assert seen == [(1, 1, 1, 10), (0, 0, 0, 10), (1, 1, 1, 20), (0, 1, 1, 10)]
    assert store.sequence() == 4 and store.active_run() is None
    full = models.fact(store.tables(), "lmp")
    assert facts.read("fct_hourly_lmp").select(*full.columns).exceptAll(full).count() == 0
    tables = facts.tables(store)
    assert quality.reconcile(tables, "lmp").count() == 0 == quality.valid_facts(tables, "lmp").count()
    row = fact.first()
    assert row.state_ordinal == 3 and row.first_seen_at < row.state_known_at
    assert store.inspect(PRICES, 2)["counts"] == {"contents": 2, "transitions": 3} and len(store.inspect(PRICES, 2)["runs"]) == 2
    refreshed, _ = facts.build(store, "lmp", full_refresh=True)
    assert refreshed.exceptAll(full).count() == 0


def test_replay_changes_nothing(spark, store):
    run_id = uuid.uuid4().hex
    first = ingest(store, PRICES, run_id, records(spark, "10"))
    again = ingest(store, PRICES, run_id, lambda: pytest.fail("fetched again"))
    assert again == first and store.sequence() == 1
    with pytest.raises(StoreError, match="another request"):
        store.begin(LOADS, run_id)


def planned(store, run_id, value):
    rows = revision.batch(PRICES, records(store.spark, value)())
    ids, latest = revision.snapshot(store.read("lmp_contents"), store.read("lmp_state_transitions"), DAY)
    return revision.plan("lmp", run_id, rows, ids, latest, store.sequence())


def test_interrupted_finalisation(spark, store):
    run_id = uuid.uuid4().hex
    store.begin(PRICES, run_id)
    store.commit(run_id, "lmp", planned(store, run_id, "10"))
    assert store.run(run_id)["status"] == "COMMITTED" and store.active_run() == run_id
    assert models.fact(store.tables(), "lmp").count() == 0
    with pytest.raises(StoreError, match="resumed"):
        run(store, "20")
    done = store.reconcile(run_id)
    assert done["status"] == "SUCCEEDED" and store.finalize(run_id)["knowledge_at"] == done["knowledge_at"]
    assert models.fact(store.tables(), "lmp").first().state_known_at == done["knowledge_at"]
    store.fail(run_id, ValueError("late"))
    assert store.run(run_id)["status"] == "SUCCEEDED"


def test_stale_snapshot_leaves_nothing_visible(spark, store):
    slow = uuid.uuid4().hex
    store.begin(PRICES, slow)
    change = planned(store, slow, "10")
    run(store, "20")
    with pytest.raises(StoreError, match="stale"):
        store.commit(slow, "lmp", change)
    assert store.read("lmp_contents").count() == 1


def test_digest_of_the_log(spark, store, monkeypatch):
    monkeypatch.setattr("tidemark.sources.store.DIGEST_EVERY", 2)
    before = [run(store, v) for v in ("10", "20", "30")]
    assert [n for n in store.files.names("log") if n.startswith("upto")] == ["upto-000000000002.json"]
    os.unlink(f"{store.files.local}/log/{1:012d}.final.json")
    assert [store.run(m["run_id"]) for m in before] == before and store.read("lmp_contents").count() == 3
    rows = {r.run_id: r.asDict() for r in store.runs().collect()}
    assert all(rows[m["run_id"]] == m for m in before)


def test_failures(spark, store):
    run_id = uuid.uuid4().hex
    with pytest.raises(StoreError, match="ValidationError"):
        ingest(store, PRICES, run_id, lambda: (_ for _ in ()).throw(ValidationError("bad row")))
    manifest = store.run(run_id)
    assert (manifest["status"], manifest["error_class"], manifest["rows_accepted"]) == ("FAILED", "ValidationError", 0) and "bad row" not in manifest["error_message"]
    with pytest.raises(StoreError, match="new run id"):
        ingest(store, PRICES, run_id, records(spark, "10"))
    assert {r.status for r in store.runs().collect()} == {"FAILED"} and store.sequence() == 0


def test_batches_are_checked(spark, store):
    rows = records(spark, "10")()
    for request in (Request("lmp", date(2026, 8, 2), scenario.HUB), Request("lmp", DAY, "TH_SP15_GEN-APND"), LOADS):
        with pytest.raises(StoreError):
            revision.batch(request, rows)
    with pytest.raises(StoreError, match="twice"):
        revision.batch(PRICES, rows.unionByName(rows))


def test_bootstrap(spark, store, tmp_path):
    assert store.bootstrap()["status"] == "checked"
    path = tmp_path / "raw" / "_schema.json"
    there = json.loads(path.read_text())
    path.write_text(json.dumps(there | {"warehouse_schema": "warehouse/v0"}))
    with pytest.raises(StoreError, match="another schema"):
        store.bootstrap()
    path.write_text(json.dumps(there | {"managed_by": "someone"}))
    with pytest.raises(StoreError, match="owner"):
        store.bootstrap()
    with pytest.raises(StoreError, match="bootstrap first"):
        Store(spark, str(tmp_path / "none")).begin(PRICES, uuid.uuid4().hex)
    assert store.control().columns == ["singleton", "sequence", "warehouse_schema", "active_run_id"]


def test_places_and_caps(spark, store, tmp_path):
    for a, b in (("/x/raw", "/x/raw/"), ("/x", "/x/facts"), ("s3a://b/raw/facts", "s3a://b/raw")):
        with pytest.raises(StoreError):
            guard.distinct_places(a, b)
    guard.distinct_places("/x/raw", "/x/raw2")
    run(store, "10")
    frame = store.read("lmp_contents")
    assert guard.within(frame) is frame
    with pytest.raises(StoreError, match="cap"):
        guard.within(frame, 10)


def test_stream_follows_commits(spark, store, tmp_path):
    from tidemark.streaming.log_stream import follow

    facts = Facts(spark, str(tmp_path / "facts"))
    values = []
    for value in ("10", "20"):
        run(store, value)
        follow(spark, store, facts, "lmp", str(tmp_path / "checkpoint")).awaitTermination()
        values.append(int(facts.read("fct_hourly_lmp").first().lmp))
    assert values == [10, 20]


def test_stream_sees_a_commit_only_once_it_is_final(spark, store, tmp_path):
    """A trigger between commit and final record builds nothing, and the record wakes the next one."""
    from tidemark.streaming.log_stream import follow

    facts, checkpoint = Facts(spark, str(tmp_path / "facts")), str(tmp_path / "checkpoint")

    def trigger():
        follow(spark, store, facts, "lmp", checkpoint).awaitTermination()
        fact = facts.read("fct_hourly_lmp")
        return None if fact is None else int(fact.first().lmp)

    assert trigger() is None
    run(store, "10")
    assert trigger() == 10
    run_id = uuid.uuid4().hex
    store.begin(PRICES, run_id)
    store.commit(run_id, "lmp", planned(store, run_id, "20"))
    assert trigger() == 10
    store.finalize(run_id)
    assert trigger() == 20


def test_of_two_builds_one_is_published(spark, store, tmp_path, monkeypatch):
    facts, other = (Facts(spark, str(tmp_path / "facts")) for _ in range(2))
    run(store, "10")
    facts.build(store, "lmp")
    run(store, "20")
    original = Facts.publish

    def slow(self, *args):
        if self is facts:
            other.build(store, "lmp")
        return original(self, *args)

    monkeypatch.setattr(Facts, "publish", slow)
    with pytest.raises(StoreError, match="another build"):
        facts.build(store, "lmp")
    assert [int(r.lmp) for r in facts.read("fct_hourly_lmp").collect()] == [20] and facts.mark("fct_hourly_lmp") == 2
    assert facts.build(store, "lmp")[1] == 0


def test_a_build_writes_only_dates_that_change(spark, tmp_path):
    store, facts = Store(spark, str(tmp_path / "raw")), Facts(spark, str(tmp_path / "facts"))
    store.bootstrap()
    requests = [Request("lmp", date(2026, 8, d), scenario.HUB) for d in (1, 2, 3)]
    for r in requests:
        ingest(store, r, uuid.uuid4().hex, lambda r=r: days(spark, r))
    facts.build(store, "lmp")
    before = facts._version("fct_hourly_lmp")[1]["dates"]
    ingest(store, requests[1], uuid.uuid4().hex, lambda: days(spark, requests[1]).withColumn("lmp", F.col("lmp") + 1).transform(lambda f: normalize.with_identity("lmp", f)))
    fact, changed = facts.build(store, "lmp")
    after = facts._version("fct_hourly_lmp")[1]["dates"]
    assert changed == 24 and {d for d in after if after[d] != before[d]} == {"2026-08-02"} and fact.count() == 72
    assert fact.select(*fact.columns).exceptAll(models.fact(store.tables(), "lmp").select(*fact.columns)).count() == 0
    assert len(facts.read("fct_hourly_lmp", ["2026-08-03"]).inputFiles()) < len(fact.inputFiles())
    # A snapshot for planning opens the commits of its own date only.
    assert store.read("lmp_contents", day=date(2026, 8, 2)).count() == 48 and store.read("lmp_contents", day=date(2026, 8, 3)).count() == 24


def test_what_builds_keep(spark, tmp_path):
    """After three builds, slices and distinct intervals are those of the fact, and only written dates were counted again."""
    store, facts = Store(spark, str(tmp_path / "raw")), Facts(spark, str(tmp_path / "facts"))
    store.bootstrap()
    assert facts.slices("fct_hourly_lmp") is None and facts.intervals("fct_hourly_lmp", ["hub"]) is None
    requests = [Request("lmp", date(2026, 8, d), scenario.HUB) for d in (1, 2, 3)]
    for build in range(3):
        for r in requests[build:]:
            ingest(store, r, uuid.uuid4().hex, lambda r=r: days(spark, r).withColumn("lmp", F.col("lmp") + build).transform(lambda f: normalize.with_identity("lmp", f)))
        facts.build(store, "lmp")
    name, fact = "fct_hourly_lmp", facts.read("fct_hourly_lmp")
    want = quality.slices(fact, "location").withColumn("runs", F.sort_array("runs"))
    got = facts.slices(name).withColumn("runs", F.sort_array("runs")).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3
    for levels in (["market_date", "hub"], ["hub"], []):
        exact = fact.withColumn("hub", F.col("location")).groupBy(*levels).agg(F.count("*"), F.count_distinct("interval_start_utc"))
        assert sorted(map(tuple, facts.intervals(name, levels).collect())) == sorted(map(tuple, exact.collect()))
    assert facts.intervals(name, [], ["2026-08-02"]).first().distinct_n == 24
    # The first build wrote three dates, the second two, the third one; each kept what it wrote.
    built = sorted(n for n in facts.files.names(name) if n.endswith("-slices"))
    assert sorted(spark.read.parquet(facts.files.path(f"{name}/{b}")).count() for b in built) == [1, 2, 3]
    judged = quality.judged_slices(facts.slices(name), store.runs()).collect()
    assert all(r.n == r["keys"] == 24 and r.ineligible == 0 for r in judged) and len(judged) == 3
    failed = store.runs().withColumn("status", F.when(F.col("commit_sequence") == 6, "FAILED").otherwise(F.col("status")))
    assert [(str(r.market_date), r.ineligible) for r in quality.judged_slices(facts.slices(name), failed).where("ineligible > 0").collect()] == [("2026-08-03", 1)]
    # A fact whose builds kept nothing isn't taken for one that passed.
    folder = facts._version(name)[1]["dates"]["2026-08-03"].split("/")[1]
    os.rename(f"{facts.files.local}/{name}/{folder}-slices", f"{tmp_path}/away")
    with pytest.raises(StoreError, match="full refresh"):
        facts.slices(name)


def test_manifests_tell_what_was_read(spark, store, tmp_path):
    """Nothing is stored before the first run; the second plans against its rows alone. A report tells it of its prices."""
    first, second, other = run(store, "10"), run(store, "20"), run(store, "10", LOADS)
    assert first["query_bytes_processed"] < second["query_bytes_processed"] > other["query_bytes_processed"]
    told = {r.run_id: (r.query_bytes_processed, r.query_bytes_billed) for r in store.runs().collect()}
    assert told == {m["run_id"]: (m["query_bytes_processed"], None) for m in (first, second, other)}
    spark.range(1000).write.parquet(path := str(tmp_path / "some"))
    assert guard.planned_bytes(spark.read.parquet(path)) > 1000 and guard.planned_bytes(spark.range(5).limit(1)) < 1000


def test_drift_of_stored_data(spark, store):
    run(store, "10")
    assert store.bootstrap()["status"] == "checked"
    folder = store._entries()[-1]["commit"]["folders"]["lmp_contents"]
    rows = store.spark.read.parquet(store.files.path(folder)).withColumn("lmp", F.lit("10")).collect()
    spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{f} string" if f == "lmp" else f"{f} {t}" for f, t in spark.read.parquet(store.files.path(folder)).dtypes)).write.mode("overwrite").parquet(store.files.path(folder))
    with pytest.raises(SchemaError, match="lmp"):
        store.bootstrap()


def test_stores_without_exclusive_create_are_refused(spark):
    for root in ("s3a://bucket/raw", "gs://bucket/raw"):
        with pytest.raises(StoreError):
            Store(spark, root)


def a_client(product, day, location):
    if day == date(2026, 8, 2):
        raise RuntimeError("broken")
    if day == date(2026, 8, 3):
        raise TimeoutError("slow")
    hours = pd.date_range(f"{day}T07:00:00Z", periods=24, freq="h")
    texts = [h.isoformat() for h in [*hours, hours[-1] + pd.Timedelta(hours=1)]]
    return pd.DataFrame({"Time": texts[:-1], "Interval Start": texts[:-1], "Interval End": texts[1:], "Market": "DAY_AHEAD_HOURLY", "Location": location, "Location Type": "Trading Hub", "LMP": 31.5, "Energy": 30.0, "Congestion": 1.0, "Loss": 0.5})


def test_fetch_from_a_client(spark):
    rows = fetch(spark, Request("lmp", date(2026, 8, 1), scenario.HUB), "", via="tests.test_store:a_client")
    assert rows.count() == 24 and rows.first().source_url == "tests.test_store:a_client"
    with pytest.raises(SourceFailed):
        fetch(spark, Request("lmp", date(2026, 8, 2), scenario.HUB), "", via="tests.test_store:a_client")
    with pytest.raises(TimeoutError):
        fetch(spark, Request("lmp", date(2026, 8, 3), scenario.HUB), "", via="tests.test_store:a_client")
    for name in ("tests.test_store:nobody", "no_such_module:f", ""):
        with pytest.raises(ValidationError):
            fetch(spark, Request("lmp", date(2026, 8, 1), scenario.HUB), "", via=name)


def days(spark, request):
    """Source frames for a backfill: synthetic prices, or one load."""
    if request.product == "load":
        frame = scenario.source_frame(spark, "load", "5").replace({"2026-08-01": str(request.day)})
        shifted = [F.regexp_replace(c, "2026-08-01", str(request.day)).alias(c) if c != "Load" else F.col(c) for c in frame.columns]
        return normalize.normalize("load", frame.select(*[F.expr(f"`{c}`").alias(c) if c == "Load" else s for c, s in zip(frame.columns, shifted)]), scenario.PROVENANCE)
    return fetch(spark, request, "", via="tests.clients.folder:frame")


VOLATILE = ("started_at", "completed_at", "knowledge_at", "run_id", "first_run_id", "transition_id", "state_run_id", "known_at", "first_seen_at", "state_known_at", "content_retrieved_at_utc", "state_retrieved_at_utc", "commit_sequence")


def test_backfill_resumes(spark, tmp_path):
    spec = backfill.Backfill(uuid.uuid4().hex, "2026-08-01", "2026-08-02")
    once, twice = ((Store(spark, str(tmp_path / n / "raw")), Facts(spark, str(tmp_path / n / "facts"))) for n in ("a", "b"))
    for s, _ in (once, twice):
        s.bootstrap()
    report = backfill.run(*once, spec, lambda r: days(spark, r), wait_seconds=0)
    assert (report.build, report.verification) == ("passed", "passed") and report.counts["2026-08-01/lmp/" + scenario.HUB] == 24
    calls = []

    def flaky(request):
        calls.append(request)
        if len(calls) == 2:
            raise ConnectionError("away")
        if len(calls) == 4:
            raise KeyboardInterrupt
        return days(spark, request)

    with pytest.raises((KeyboardInterrupt, StoreError)):
        backfill.run(*twice, spec, flaky, wait_seconds=0)
    if twice[0].runs().where("status = 'FAILED'").count():
        spec = backfill.Backfill(uuid.uuid4().hex, "2026-08-01", "2026-08-02")
    resumed = backfill.run(*twice, spec, lambda r: days(spark, r), wait_seconds=0)
    assert resumed.verification == "passed" and "build: passed" in resumed.text()
    for name in models.FACTS.values():
        a, b = (f.read(name).drop(*VOLATILE) for _, f in (once, twice))
        assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_plans():
    ok = dict(backfill_id=uuid.uuid4().hex, start_date="2026-08-01", end_date="2026-08-02")
    units = backfill.expand(backfill.Backfill(**ok, locations=("TH_SP15_GEN-APND", "TH_NP15_GEN-APND")))
    assert [u.label for u in units[:3]] == ["2026-08-01/lmp/TH_NP15_GEN-APND", "2026-08-01/lmp/TH_SP15_GEN-APND", "2026-08-01/load/CAISO"] and len({u.run_id for u in units}) == 6
    for bad in (
        {"backfill_id": "x"}, {"start_date": "2026-8-1"}, {"start_date": "2026-08-03"}, {"end_date": "2026-08-08"}, {"concurrency": 2}, {"ingest_lmp": False, "ingest_load": False},
        {"locations": ("X",)}, {"locations": ("TH_NP15_GEN-APND",) * 2}, {"locations": ()}, {"start_date": "2025-11-02", "end_date": "2025-11-02"}, {"end_date": "2999-01-01", "start_date": "2999-01-01"},
    ):
        with pytest.raises(StoreError):
            backfill.expand(backfill.Backfill(**(ok | bad)))


def test_retries():
    def chained(*errors):
        for outer, inner in zip(errors, errors[1:]):
            outer.__cause__ = inner
        return errors[0]

    passing = chained(StoreError("a"), ConnectionError("b"))
    assert backfill.transient(passing) and backfill.transient(Transient("x"))
    assert not backfill.transient(chained(StoreError("a"), ConnectionError("b"), SchemaError("c"))) and not backfill.transient(StoreError("a"))
    states = {None: True, "STARTED": True, "FAILED": False, "COMMITTED": False, "SUCCEEDED": False, "UNKNOWN": False}
    assert {s: backfill.retryable(passing, None if s is None else {"status": s}) for s in states} == states


def test_fetch_from_files(spark, tmp_path):
    rows = [{c: v for c, v in zip(("Time", "Interval Start", "Interval End", "Market", "Location", "Location Type", "LMP", "Energy", "Congestion", "Loss"), ("2026-08-01T07:00:00Z", "2026-08-01T07:00:00Z", "2026-08-01T08:00:00Z", "DAY_AHEAD_HOURLY", scenario.HUB, "Trading Hub", 10.0, 30.0, -2.0, 0.5))}]
    path = str(tmp_path / "day.json")
    with open(path, "w") as file:
        json.dump(rows, file)
    assert fetch(spark, PRICES, path).count() == 1
    with pytest.raises(ValidationError, match="outside"):
        fetch(spark, Request("lmp", date(2026, 8, 2), scenario.HUB), path)


def test_commands(spark, tmp_path, capsys):
    from tidemark.cli import main

    path, raw = str(tmp_path / "day.json"), str(tmp_path / "raw")
    test_fetch_from_files(spark, tmp_path)
    place = ["--date", "2026-08-01", "--location", scenario.HUB]
    assert main(["caiso", "lmp", *place, "--input", path], spark) == 0
    shown = json.loads(capsys.readouterr().out)
    assert shown["fetched_observations"] == 1 and shown["observations"][0]["lmp"] == "10" and shown["observations"][0]["interval_start_pacific"] == "2026-08-01T00:00:00-07:00"
    assert main(["ingest", "caiso", "lmp", *place, "--input", path, "--store", raw], spark) == 1
    assert main(["warehouse", "bootstrap", "--store", raw], spark) == 0
    run_id = uuid.uuid4().hex
    assert main(["ingest", "caiso", "lmp", *place, "--input", path, "--store", raw, "--run-id", run_id], spark) == 0
    assert main(["warehouse", "resume", "--store", raw, "--run-id", run_id], spark) == 0
    capsys.readouterr()
    assert main(["warehouse", "inspect", "lmp", *place, "--store", raw], spark) == 0
    assert json.loads(capsys.readouterr().out)["counts"] == {"contents": 1, "transitions": 1}
    for bad in ([], ["caiso", "lmp", "--date", "2026-8-1"], ["caiso", "lmp", *place, "--input", path, "--limit", "0"], ["caiso", "lmp", "--date", "2026-08-01", "--location", "X", "--input", path]):
        with pytest.raises(SystemExit) as stop:
            main(bad, spark)
        assert stop.value.code == 2
    assert os.path.isdir(raw) and datetime.now()
