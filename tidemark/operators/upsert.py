"""Stored facts, brought up to date by candidates above their high-water mark.

A fact is a set of Parquet folders by market date, named by the marker of its version. A build writes folders
of its own for the dates it changes and then the next marker, which only one can create; readers take the latest.
So a build that dies or loses leaves the fact as it was. The mark is the largest commit sequence, never an event
time, so a late event is a candidate like any other.

Beside its folders a build keeps what they hold: rows, keys and runs of each slice, and bitmaps of its intervals. So checks
and distinct counts after a build read what builds kept, and no build counts dates that it doesn't write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import StoreError
from tidemark.operators import distinct, quality
from tidemark.operators.guard import distinct_places
from tidemark.plans import models
from tidemark.schemas import PRODUCTS, assert_contract, fact_columns
from tidemark.sources.files import Files
from tidemark.sources.store import Store


def merged(stored: DataFrame, candidates: DataFrame, key: str = "logical_key") -> DataFrame:
    """Stored rows without a candidate of their key, and the candidates."""
    return stored.join(candidates.select(key), key, "left_anti").select(*candidates.columns).unionByName(candidates)


def candidates(states: DataFrame, stored: DataFrame) -> DataFrame:
    """Current states among those above the stored facts' mark, a scalar subquery."""
    mark = stored.agg(F.coalesce(F.max("commit_sequence"), F.lit(0))).scalar()
    return models.current(states.where(F.col("commit_sequence") > mark))


def candidates_of(tables: models.Tables, product: str, stored: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``candidates`` of all states of the tables, ranked without the columns of their contents (``models.latest``)."""
    mark, name = stored.agg(F.coalesce(F.max("commit_sequence"), F.lit(0))).scalar(), f"{product}_state_transitions"
    return models.latest({**tables, name: tables[name].where(F.col("commit_sequence") > mark)}, product, keep)


def _product(name: str) -> str:
    return next(p for p, fact in models.FACTS.items() if fact == name)


class Facts:
    """Facts in folders of market dates. A version's marker names the folder of each of its dates."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    def _version(self, name: str) -> tuple[int, dict]:
        n = max((int(n.split(".")[0]) for n in self.files.names(f"{name}/versions")), default=0)
        return n, json.loads(self.files.read(f"{name}/versions/{n:08d}.json")) if n else {"commit_sequence": 0, "dates": {}}

    def read(self, name: str, dates: list[str] | None = None) -> DataFrame | None:
        """The latest version, or its rows of some market dates, whose folders alone are opened."""
        n, marker = self._version(name)
        if not n:
            return None
        paths = [self.files.path(folder) for day, folder in marker["dates"].items() if dates is None or day in dates]
        schema = ", ".join(f"{c} {kind}" for c, kind in fact_columns(_product(name)))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _kept(self, name: str, kind: str, schema: str, dates: list[str] | None) -> DataFrame | None:
        n, marker = self._version(name)
        if not n:
            return None
        own = [(day, folder.split("/")[1]) for day, folder in marker["dates"].items() if dates is None or day in dates]
        if not own:
            return self.spark.createDataFrame([], schema)
        folders = sorted({f"{name}/{build}-{kind}" for _, build in own})
        if lacking := [f for f in folders if not self.files.names(f)]:
            raise StoreError(f"a build kept no {kind} ({lacking[0]}); build {name} again by a full refresh")
        stored = self.spark.read.schema(f"{schema}, build string").parquet(*map(self.files.path, folders))
        # Of a build, only the dates that no later one has written again.
        current = self.spark.createDataFrame(own, "__day string, __build string")
        return stored.join(current, (F.col("market_date").cast("string") == F.col("__day")) & (F.col("build") == F.col("__build")), "left_semi").drop("build")

    def slices(self, name: str, dates: list[str] | None = None) -> DataFrame | None:
        """Rows, keys, largest sequence and runs of each (market_date, hub), as the builds kept them."""
        return self._kept(name, "slices", "market_date date, hub string, n bigint, keys bigint, high bigint, runs array<string>", dates)

    def intervals(self, name: str, levels: list[str], dates: list[str] | None = None) -> DataFrame | None:
        """Rows and distinct intervals by hub, date, both or none, from the bitmaps that the builds kept."""
        kept = self._kept(name, "bitmaps", "market_date date, hub string, bucket bigint, n bigint, bits binary", dates)
        return None if kept is None else distinct.counts(kept, levels)

    def _keep(self, name: str, folder: str) -> int:
        """Keeps slices and bitmaps of the files of a build; its largest sequence, 0 without rows."""
        product, build = _product(name), F.lit(folder.split("/")[1]).alias("build")
        place = "location" if product == "lmp" else None
        rows = self.spark.read.schema(", ".join(f"{c} {kind}" for c, kind in fact_columns(product))).parquet(self.files.path(folder))
        quality.slices(rows, place).select("*", build).write.parquet(self.files.path(f"{folder}-slices"))
        number = F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("interval_start_utc")) / PRODUCTS[product]["seconds"])
        levels = {"market_date": F.col("market_date"), "hub": F.col(place) if place else F.lit("")}
        distinct.bitmaps(rows, levels, number).select("*", build).write.parquet(self.files.path(f"{folder}-bitmaps"))
        return self.spark.read.parquet(self.files.path(f"{folder}-slices")).agg(F.max("high")).first()[0] or 0

    def publish(self, name: str, frame: DataFrame, columns: list[tuple[str, str]], base: tuple[int, dict] | None = None) -> None:
        """Writes a version: the frame's dates, and those of ``base`` that it doesn't touch. Of two builds from
        one base the second fails, and the folders it wrote belong to no version."""
        assert_contract(frame, columns, name)
        n, marker = base or (self._version(name)[0], {"commit_sequence": 0, "dates": {}})
        folder = f"{name}/data-{uuid.uuid4().hex}"
        frame.withColumn("__date", F.col("market_date").cast("string")).repartition("__date").write.partitionBy("__date").parquet(self.files.path(folder))
        written = {day.removeprefix("__date="): f"{folder}/{day}" for day in self.files.names(folder) if day.startswith("__date=")}
        mark = self._keep(name, folder) if written else 0
        made = {"commit_sequence": max(marker["commit_sequence"], mark), "dates": marker["dates"] | written}
        if not self.files.create(f"{name}/versions/{n + 1:08d}.json", json.dumps(made)):
            raise StoreError(f"another build has published version {n + 1} of {name}; build again")

    def mark(self, name: str) -> int:
        return self._version(name)[1]["commit_sequence"]

    def build(self, store: Store, product: str, full_refresh: bool = False) -> tuple[DataFrame, int]:
        """The product's fact, and how many rows the build changed; with none, nothing is written. Only market
        dates with a changed key are read and written again."""
        distinct_places(store.files.root, self.files.root)
        name, columns = models.FACTS[product], fact_columns(product)
        base = self._version(name)
        if full_refresh or not base[0]:
            self.publish(name, models.fact(store.tables(), product), columns)
            return (fact := self.read(name)), fact.count()
        # Transitions above the mark come from new commits' folders alone; their contents may be older.
        tables = store.tables() | {f"{product}_state_transitions": store.read(f"{product}_state_transitions", base[1]["commit_sequence"])}
        new = models.latest(tables, product).cache()
        if changed := new.count():
            touched = [str(r.market_date) for r in new.select("market_date").distinct().collect()]
            self.publish(name, merged(self.read(name, touched), new), columns, base)
        new.unpersist()
        return self.read(name), changed

    def tables(self, store: Store) -> dict[str, DataFrame]:
        """Raw tables and stored facts, for the models and their tests."""
        return store.tables() | {name: f for name in models.FACTS.values() if (f := self.read(name)) is not None}
