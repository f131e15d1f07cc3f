"""The raw store: immutable Parquet and a commit log whose records only one writer can create.

A run begins with a record of its request, plans against the log's latest sequence, writes its rows to
a folder of its own and claims the next sequence by creating that record: the claim is the
compare-and-swap, its loser fails with a stale snapshot, and its rows stay unreferenced. A second record
finalises a commit. It holds the knowledge time, which is when the commit record was written, so a later
recovery finds the same clock. Until then no other commit may follow.

Readers see referenced folders only, and take status and clocks from the log; no row is ever changed.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import CommitUnconfirmed, SchemaError, StoreError, TidemarkError
from tidemark.functions.identity import CONTENT_SCHEMA, KEY_SCHEMA, WAREHOUSE_SCHEMA
from tidemark.operators import revision
from tidemark.operators.guard import planned_bytes
from tidemark.operators.revision import Request, valid_run_id
from tidemark.schemas import RAW, SOURCE, VERSION
from tidemark.sources.files import Files
from tidemark.sources.tables import write_counted

OWNER = "tidemark"
#: Commits after which a digest of the log is written.
DIGEST_EVERY = 50
_TABLES = ("lmp_contents", "lmp_state_transitions", "load_contents", "load_state_transitions")


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    # Structure --------------------------------------------------------------------------------

    def bootstrap(self) -> dict[str, object]:
        """Creates an empty store, or checks that what is there is one; nothing is ever replaced."""
        schemas = {name: schema.jsonValue() for name, schema in RAW.items()}
        mine = json.dumps({"managed_by": OWNER, "warehouse_schema": WAREHOUSE_SCHEMA, "tables": schemas}, sort_keys=True)
        found = self.files.read("_schema.json")
        if found is None:
            if self.files.names("data") or self.files.names("log") or self.files.names("runs"):
                raise StoreError("the folder holds data of another owner")
            self.files.create("_schema.json", mine)
            found = self.files.read("_schema.json")
        there = json.loads(found)
        if there.get("managed_by") != OWNER:
            raise StoreError("the folder belongs to another owner")
        if there != json.loads(mine):
            raise StoreError("the store has another schema; it is not migrated")
        self.check_data()
        return {"store": self.files.root, "status": "checked"}

    def check_data(self) -> None:
        """Compares the files of the latest commit of each table with its schema; drift is an error."""
        latest = {table: folder for e in self._entries() for table, folder in e["commit"]["folders"].items()}
        for table, folder in latest.items():
            there = {f.name: f.dataType for f in self.spark.read.parquet(self.files.path(folder)).schema}
            due = {f.name: f.dataType for f in RAW[table]}
            if drift := sorted(n for n in there.keys() | due.keys() if there.get(n) != due.get(n)):
                raise SchemaError(f"stored {table} drifted from its schema: {', '.join(drift)}")

    def _checked(self) -> None:
        if self.files.read("_schema.json") is None:
            raise StoreError("there is no store here; bootstrap first")

    def sequence(self) -> int:
        """The latest claimed sequence; 0 before any."""
        return max((int(n.split(".")[0]) for n in self.files.names("log") if n.endswith(".commit.json")), default=0)

    def _record(self, name: str) -> dict | None:
        text = self.files.read(name)
        return None if text is None else json.loads(text)

    def active_run(self) -> str | None:
        """The run whose commit waits to be finalised."""
        n = self.sequence()
        if n and self.files.read(f"log/{n:012d}.final.json") is None:
            return self._record(f"log/{n:012d}.commit.json")["run_id"]
        return None

    def _entries(self) -> list[dict]:
        """The log in order: number, commit record and, once there, final record of each commit. A digest of
        finalised commits stands for the files it replaces, so few are opened however long the log is."""
        names = self.files.names("log")
        digest = max((n for n in names if n.startswith("upto-")), default=None)
        entries = json.loads(self.files.read(f"log/{digest}")) if digest else []
        known = entries[-1]["n"] if entries else 0
        for name in names:
            if name.endswith(".commit.json") and (n := int(name.split(".")[0])) > known:
                entries.append({"n": n, "commit": self._record(f"log/{name}"), "final": self._record(f"log/{n:012d}.final.json")})
        return entries

    def _commit_of(self, run_id: str) -> dict | None:
        return next((e for e in self._entries() if e["commit"]["run_id"] == run_id), None)

    # Manifests --------------------------------------------------------------------------------

    def run(self, run_id: str) -> dict[str, object] | None:
        """The manifest of one run, from its own records."""
        started = self._record(f"runs/{valid_run_id(run_id)}.started.json")
        if started is None:
            return None
        row: dict[str, object] = dict.fromkeys(RAW["ingestion_runs"].names)
        row |= {k: v for k, v in started.items() if k in row}
        row |= {"started_at": datetime.fromisoformat(started["started_at"]), "requested_date": date.fromisoformat(started["requested_date"]), "status": "STARTED", "commit_completed": False}
        if (entry := self._commit_of(run_id)) is not None:
            row |= {k: v for k, v in entry["commit"].items() if k in row}
            row |= {"status": "COMMITTED", "commit_completed": True, "commit_sequence": entry["n"], "rows_rejected": 0}
            if entry["final"] is not None:
                row |= {"status": "SUCCEEDED"} | {k: datetime.fromisoformat(entry["final"][k]) for k in ("knowledge_at", "completed_at")}
        elif (failed := self._record(f"runs/{run_id}.failed.json")) is not None:
            row |= failed | {"status": "FAILED", "completed_at": datetime.fromisoformat(failed["completed_at"]), "rows_accepted": 0}
        return row

    def begin(self, request: Request, run_id: str, library_version: str = "file") -> dict[str, object]:
        """Binds a run id to a request; the same binding again changes nothing."""
        self._checked()
        record = {
            "run_id": valid_run_id(run_id), "request_id": request.request_id, "source": SOURCE, "product": request.product, "requested_date": str(request.day),
            "requested_location": request.location, "started_at": _now().isoformat(), "package_version": VERSION, "library_version": library_version,
            "warehouse_schema": WAREHOUSE_SCHEMA, "logical_key_schema": KEY_SCHEMA, "content_hash_schema": CONTENT_SCHEMA, "code_revision": os.environ.get("TIDEMARK_CODE_REVISION"),
        }
        self.files.create(f"runs/{run_id}.started.json", json.dumps(record))
        manifest = self.run(run_id)
        if manifest is None or manifest["request_id"] != request.request_id:
            raise StoreError("the run id belongs to another request")
        return manifest

    def fail(self, run_id: str, error: Exception) -> None:
        """Marks a run as failed, unless its commit stands. Only the error's kind is kept."""
        if self._commit_of(valid_run_id(run_id)) is None:
            record = {"run_id": run_id, "completed_at": _now().isoformat(), "error_class": type(error).__name__, "error_message": "source, validation or store failed; see the caller's error"}
            self.files.create(f"runs/{run_id}.failed.json", json.dumps(record))

    # Commits ----------------------------------------------------------------------------------

    def commit(self, run_id: str, product: str, change: revision.Change, bytes_read: int | None = None) -> int:
        """Writes the rows and claims the next sequence; the sequence, or an error with nothing visible. The manifest
        says how many bytes of stored rows the plan read, if told."""
        if self.active_run() is not None:
            raise StoreError(f"run {self.active_run()} waits to be resumed")
        if self.sequence() != change.expected_sequence:
            raise StoreError("stale snapshot: the sequence is taken by another run")
        n, counts, folders = change.expected_sequence + 1, {}, {}
        for table, key, frame in ((f"{product}_contents", "new_contents", change.contents), (f"{product}_state_transitions", "new_transitions", change.transitions)):
            folder = f"data/{table}/commit={n:012d}-{run_id}"
            counts[key] = write_counted(frame, self.files.path(folder), "overwrite")["n"]
            folders[table] = folder
        day = self._record(f"runs/{run_id}.started.json")["requested_date"]
        record = {"run_id": run_id, "day": day, "batch_hash": change.batch_hash, "commit_job_id": f"commit-{run_id}", "folders": folders, "query_bytes_processed": bytes_read, **counts, **{k: change.accepted for k in ("rows_fetched", "rows_normalized", "rows_accepted")}}
        if not self.files.create(f"log/{n:012d}.commit.json", json.dumps(record)):
            raise StoreError("stale snapshot: the sequence is taken by another run")
        return n

    def finalize(self, run_id: str) -> dict[str, object]:
        """Gives a committed run its clock and lets others follow; again, it changes nothing."""
        found = self._commit_of(valid_run_id(run_id))
        if found is None:
            raise StoreError("the run has not committed")
        n = found["n"]
        known = self.files.modified(f"log/{n:012d}.commit.json").isoformat()
        self.files.create(f"log/{n:012d}.final.json", json.dumps({"run_id": run_id, "knowledge_at": known, "completed_at": _now().isoformat()}))
        if n % DIGEST_EVERY == 0:
            self.files.create(f"log/upto-{n:012d}.json", json.dumps([e for e in self._entries() if e["n"] <= n]))
        return self.run(run_id)

    def reconcile(self, run_id: str) -> dict[str, object] | None:
        """The manifest of a run that succeeded, finalising it if that is all it lacks; None if it hasn't
        committed; an error if it failed."""
        manifest = self.run(run_id)
        if manifest is None:
            raise StoreError("no run of this id")
        if manifest["status"] == "SUCCEEDED":
            return manifest
        if manifest["status"] == "FAILED":
            raise StoreError(f"run {run_id} failed for good; only a new run id can succeed")
        if manifest["status"] == "STARTED":
            return None
        try:
            return self.finalize(run_id)
        except OSError as error:
            raise CommitUnconfirmed(f"committed; finalisation pending for run {run_id}") from error

    def persist(self, request: Request, records: DataFrame, run_id: str) -> dict[str, object]:
        """Validates, plans, commits and finalises a batch."""
        manifest = self.run(run_id)
        if manifest is None or manifest["request_id"] != request.request_id:
            raise StoreError("the run id is not bound to this request; begin it first")
        if (prior := self.reconcile(run_id)) is not None:
            return prior
        # A batch is bounded, and everything below must see the same rows whatever the source does.
        records = records.persist()
        try:
            if (active := self.active_run()) is not None:
                raise StoreError(f"run {active} waits to be resumed")
            sequence = self.sequence()
            rows = revision.batch(request, records)
            ids, latest = revision.snapshot(*(self.read(f"{request.product}_{kind}", day=request.day) for kind in ("contents", "state_transitions")), request.day)
            change = revision.plan(request.product, run_id, rows, ids, latest, sequence)
            self.commit(run_id, request.product, change, sum(map(planned_bytes, (ids, latest))))
        except Exception as error:
            self.fail(run_id, error)
            raise
        finally:
            records.unpersist()
        return self.reconcile(run_id)

    # Reading ----------------------------------------------------------------------------------

    def _records(self, ending: str, columns: str) -> DataFrame:
        """The JSON records of all runs, read by Spark; a folder may hold very many."""
        reader = self.spark.read.schema(columns)
        if not self.files.names("runs"):
            return self.spark.createDataFrame([], columns)
        return reader.option("pathGlobFilter", f"*{ending}").json(self.files.path("runs"))

    def runs(self) -> DataFrame:
        """All manifests: begun runs beside the commits and failures they came to."""
        schema = RAW["ingestion_runs"]
        begun = self._records(".started.json", "run_id string, request_id string, source string, product string, requested_date string, requested_location string, started_at string, package_version string, library_version string, warehouse_schema string, logical_key_schema string, content_hash_schema string, code_revision string")
        failed = self._records(".failed.json", "run_id string, completed_at string, error_class string, error_message string").withColumnRenamed("completed_at", "failed_at")
        numbers = ("rows_fetched", "rows_normalized", "rows_accepted", "new_contents", "new_transitions", "query_bytes_processed")
        done = [(e["commit"]["run_id"], e["n"], e["commit"]["batch_hash"], e["commit"]["commit_job_id"], *(e["commit"].get(k) for k in numbers), *((e["final"] or {}).get(k) for k in ("knowledge_at", "completed_at"))) for e in self._entries()]
        commits = self.spark.createDataFrame(done, "run_id string, commit_sequence bigint, batch_hash string, commit_job_id string, " + "".join(f"{k} bigint, " for k in numbers) + "knowledge_at string, finalised_at string")
        joined = begun.join(commits, "run_id", "left").join(failed, "run_id", "left")
        committed, lost = F.col("commit_sequence").isNotNull(), F.col("failed_at").isNotNull()
        status = F.when(F.col("knowledge_at").isNotNull(), "SUCCEEDED").when(committed, "COMMITTED").when(lost, "FAILED").otherwise("STARTED")
        made = {
            "status": status,
            "commit_completed": committed,
            "completed_at": F.coalesce("finalised_at", F.when(~committed, F.col("failed_at"))),
            "rows_accepted": F.coalesce("rows_accepted", F.when(lost, 0)),
            "rows_rejected": F.when(committed, 0),
            "error_class": F.when(~committed, F.col("error_class")),
            "error_message": F.when(~committed, F.col("error_message")),
        }
        kept = [made.get(f.name, F.col(f.name) if f.name in joined.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        return joined.select(*kept)

    def control(self) -> DataFrame:
        return self.spark.createDataFrame([(1, self.sequence(), WAREHOUSE_SCHEMA, self.active_run())], RAW["warehouse_control"])

    def read(self, table: str, above: int = 0, day: date | None = None) -> DataFrame:
        """Committed rows of a table, of sequences above a mark and of one market date only, if given; clocks come
        from the log. Folders of other commits aren't opened: a commit holds rows of one date.
        """
        if table == "ingestion_runs":
            return self.runs()
        if table == "warehouse_control":
            return self.control()
        if table not in _TABLES:
            raise StoreError(f"unknown table {table}")
        paths = [self.files.path(e["commit"]["folders"][table]) for e in self._entries() if e["n"] > above and (day is None or e["commit"]["day"] == str(day)) and table in e["commit"]["folders"]]
        schema = RAW[table]
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        clock, run = ("first_seen_at", "first_run_id") if table.endswith("contents") else ("known_at", "run_id")
        known = self.runs().select(F.col("run_id").alias(run), F.col("knowledge_at").alias("__known"))
        return rows.drop(clock).join(known, run, "left").withColumn(clock, F.col("__known")).select(*schema.names)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in ("ingestion_runs", *_TABLES)}

    def inspect(self, request: Request, limit: int = 5) -> dict[str, object]:
        """Counts of eligible rows of a request, and its latest runs, at most 100."""
        product, day = request.product, F.col("market_date") == F.lit(request.day)
        good = self.runs().where("status = 'SUCCEEDED'").select("run_id")
        contents = self.read(f"{product}_contents").where(day)
        if product == "lmp":
            contents = contents.where(F.col("location") == request.location)
        states = self.read(f"{product}_state_transitions").where(day).join(good, "run_id").join(contents.select("content_id"), "content_id", "left_semi")
        runs = self.runs().where((F.col("requested_date") == F.lit(request.day)) & (F.col("request_id") == request.request_id)).orderBy(F.desc("started_at")).limit(min(max(limit, 1), 100))
        return {"counts": {"contents": contents.join(good, contents.first_run_id == good.run_id, "left_semi").count(), "transitions": states.count()}, "runs": [r.asDict() for r in runs.collect()]}


def ingest(store: Store, request: Request, run_id: str, fetch: Callable[[], DataFrame]) -> dict[str, object]:
    """Begins a run, recovers it if it is known, otherwise fetches and persists."""
    store.begin(request, run_id)
    if (prior := store.reconcile(run_id)) is not None:
        return prior
    try:
        records = fetch()
    except Exception as error:
        store.fail(run_id, error)
        if isinstance(error, TidemarkError):
            raise StoreError(f"run {run_id}: {type(error).__name__}: {error}") from error
        raise
    return store.persist(request, records, run_id)
