"""A five-step revision story for both products: a state, a repeat, a revision, its return, a late event.

Raw tables are built from the same planner and identities that ingestion uses. Beside the five runs stand
three that never finished, whose rows no model may show.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.identity import CONTENT_SCHEMA, KEY_SCHEMA, WAREHOUSE_SCHEMA
from tidemark.operators import normalize, revision
from tidemark.schemas import RAW, SOURCE

#: The story: what the source says at each step, and the year of the interval it says it about.
STORY = {"initial": ("10", 2026), "repeat": ("10", 2026), "revision": ("20", 2026), "reappearance": ("10", 2026), "late": ("10", 2025)}
STEPS = tuple(STORY)
#: Runs that never finished, by number; they say their own number. Those of the load come ten later.
UNFINISHED = {100: "STARTED", 101: "FAILED", 102: "COMMITTED"}
VERSION = "0.1.0"
HUB = "TH_NP15_GEN-APND"
PROVENANCE = {"retrieved_at_utc": datetime(2026, 9, 1), "source_url": "https://example.invalid/synthetic", "source_method": "fixture", "library_version": "0.36.0"}


def source_frame(spark: SparkSession, product: str, value: str, year: int = 2026) -> DataFrame:
    """One observation as a source returns it."""
    end = "08:00" if product == "lmp" else "07:05"
    row: dict[str, object] = {"Time": f"{year}-08-01T07:00:00Z", "Interval Start": f"{year}-08-01T07:00:00Z", "Interval End": f"{year}-08-01T{end}:00Z"}
    if product == "lmp":
        row |= {"Market": "DAY_AHEAD_HOURLY", "Location": HUB, "Location Type": "Trading Hub"}
    schema = ", ".join(f"`{k}` string" for k in row)
    numbers = {"LMP": value, "Energy": "30", "Congestion": "-2", "Loss": "0.5"} if product == "lmp" else {"Load": value}
    schema += "".join(f", `{k}` decimal(38,9)" for k in numbers)
    return spark.createDataFrame([(*row.values(), *map(Decimal, numbers.values()))], schema)


@dataclass(frozen=True)
class _Run:
    """A run of the story. ``sequence``: of its commit; runs of a step are ten apart, the load's follow."""

    number: int
    product: str
    value: str
    year: int
    status: str
    sequence: int

    @property
    def run_id(self) -> str:
        return f"{self.number:032x}"

    @property
    def known(self) -> datetime | None:
        return datetime(2026, 9, 1) + timedelta(minutes=self.number) if self.status == "SUCCEEDED" else None


def _runs(product: str, step: str, ineligible: bool) -> list[_Run]:
    own = 1 if product == "lmp" else 2
    told = [_Run(10 * k + own, product, value, year, "SUCCEEDED", 10 * k + own) for k, (value, year) in enumerate(list(STORY.values())[: STEPS.index(step) + 1])]
    unfinished = [_Run(n + (10 if product == "load" else 0), product, str(n), 2026, status, n + 1) for n, status in UNFINISHED.items()]
    return told + unfinished * ineligible


_ROWS: dict[tuple[str, bool], dict[str, list[tuple]]] = {}


def _rows(spark: SparkSession, step: str, ineligible: bool) -> dict[str, list[tuple]]:
    """The tables' rows, worked out once: they are the same for every session."""
    if (step, ineligible) in _ROWS:
        return _ROWS[step, ineligible]
    out: dict[str, list[tuple]] = {name: [] for name in RAW if name != "warehouse_control"}

    def add(table: str, row: dict) -> None:
        out[table].append(tuple(row.get(n) for n in RAW[table].names))

    for product in ("lmp", "load"):
        stored: set[str] = set()
        latest: dict[str, tuple[str, int]] = {}
        for run in _runs(product, step, ineligible):
            request = revision.Request(product, date(run.year, 8, 1), HUB if product == "lmp" else None)
            source = normalize.normalize(product, source_frame(spark, product, run.value, run.year), PROVENANCE).persist()
            records = revision.batch(request, source)
            ids = spark.createDataFrame([(c,) for c in stored], "content_id string")
            states = spark.createDataFrame([(k, *v) for k, v in latest.items()], "logical_key string, content_hash string, ordinal bigint")
            change = revision.plan(product, run.run_id, records, ids, states, run.sequence - 1)
            contents, moves = change.contents.collect(), change.transitions.collect()
            source.unpersist()
            for r in contents:
                add(f"{product}_contents", r.asDict() | {"first_seen_at": run.known})
            for r in moves:
                add(f"{product}_state_transitions", r.asDict() | {"known_at": run.known})
            if run.status == "SUCCEEDED":
                stored.update(r.content_id for r in contents)
                latest.update((r.logical_key, (r.content_hash, r.ordinal)) for r in moves)
            manifest = {"run_id": run.run_id, "request_id": request.request_id, "source": SOURCE, "product": product, "requested_date": request.day, "requested_location": request.location}
            manifest |= {"status": run.status, "commit_completed": run.status in ("SUCCEEDED", "COMMITTED"), "knowledge_at": run.known, "completed_at": run.known}
            manifest |= {"started_at": (run.known or datetime(2026, 9, 1)) - timedelta(seconds=1), "commit_sequence": run.sequence, "batch_hash": change.batch_hash}
            manifest |= {"package_version": VERSION, "library_version": PROVENANCE["library_version"], "warehouse_schema": WAREHOUSE_SCHEMA, "logical_key_schema": KEY_SCHEMA, "content_hash_schema": CONTENT_SCHEMA}
            manifest |= dict.fromkeys(("rows_fetched", "rows_normalized", "rows_accepted"), change.accepted) | {"rows_rejected": 0, "new_contents": len(contents), "new_transitions": len(moves)}
            add("ingestion_runs", manifest)
    _ROWS[step, ineligible] = out
    return out


def build(spark: SparkSession, step: str, ineligible: bool = True) -> dict[str, DataFrame]:
    """The raw tables as they stand after a step."""
    return {name: spark.createDataFrame(rows, RAW[name]) for name, rows in _rows(spark, step, ineligible).items()}
