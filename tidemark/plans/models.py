"""The graph of models: staging, history, current-state facts and marts.

Each model is a plan over ``tables``, a mapping of raw names (and of facts, where they are stored) to
frames; nothing is materialised here. ``tidemark.operators.upsert`` publishes facts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import timez
from tidemark.functions.identity import packed, unpacked
from tidemark.operators import bloom
from tidemark.schemas import BATTERY_INPUTS, RAW, assert_contract, fact_columns

Tables = Mapping[str, DataFrame]
STATE_ORDER = ("state_ordinal", "commit_sequence", "transition_id")
FACTS = {"lmp": "fct_hourly_lmp", "load": "fct_system_load_5min"}


def stg_runs(tables: Tables) -> DataFrame:
    return tables["ingestion_runs"].select(*RAW["ingestion_runs"].names)


def _succeeded(tables: Tables, name: str) -> DataFrame:
    return stg_runs(tables).where("status = 'SUCCEEDED'").select(F.col("run_id").alias(name))


def stg_contents(tables: Tables, product: str) -> DataFrame:
    """Contents whose first run succeeded."""
    return tables[f"{product}_contents"].join(_succeeded(tables, "first_run_id"), "first_run_id").select(*RAW[f"{product}_contents"].names)


def stg_transitions(tables: Tables, product: str) -> DataFrame:
    """Transitions whose run succeeded."""
    return tables[f"{product}_state_transitions"].join(_succeeded(tables, "run_id"), "run_id").select(*RAW[f"{product}_state_transitions"].names)


def _states(tables: Tables, product: str) -> DataFrame:
    return stg_transitions(tables, product).select(
        "content_id",
        "transition_id",
        F.col("run_id").alias("state_run_id"),
        F.col("ordinal").alias("state_ordinal"),
        "commit_sequence",
        F.col("known_at").alias("state_known_at"),
        F.col("retrieved_at_utc").alias("state_retrieved_at_utc"),
    )


def _packed(frame: DataFrame, *names: str) -> DataFrame:
    """Ids as bytes, half as wide, while rows are dealt out."""
    return frame.withColumns({n: packed(F.col(n)) for n in names})


def _unpacked(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: unpacked(F.col(n)) for n in names})


def history(tables: Tables, product: str) -> DataFrame:
    """Eligible transitions with their contents; a transition whose content isn't eligible is left out."""
    contents = stg_contents(tables, product).withColumnRenamed("retrieved_at_utc", "content_retrieved_at_utc")
    of_content, of_state = ("logical_key", "content_hash", "first_run_id"), ("transition_id", "state_run_id")
    states = _packed(_states(tables, product), "content_id", *of_state).join(_packed(contents, "content_id", *of_content), "content_id")
    return _unpacked(states, "content_id", *of_content, *of_state).select(*[n for n, _ in fact_columns(product)])


def current(states: DataFrame) -> DataFrame:
    """The latest state of each key, by ordinal, then sequence, then id; never by a clock."""
    order = W.partitionBy("logical_key").orderBy(*[F.desc(c) for c in STATE_ORDER])
    return states.withColumn("state_rank", F.row_number().over(order)).where("state_rank = 1").drop("state_rank")


def latest(tables: Tables, product: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``current(history(...))``, but states are ranked with ids and keys of contents alone; the other columns of a
    content, most of a row's width, meet only the states that stay. ``keep`` may store these: contents that none of them
    has are then left where they lie, behind a Bloom filter. Transitions' ids stay text, as they decide ties."""
    ids = _packed(stg_contents(tables, product).select("content_id", "logical_key"), "content_id", "logical_key")
    joined = _packed(_states(tables, product), "content_id", "state_run_id").join(ids, "content_id")
    ranked = _unpacked(current(joined), "content_id", "logical_key", "state_run_id")
    contents = tables[f"{product}_contents"].select(*RAW[f"{product}_contents"].names).withColumnRenamed("retrieved_at_utc", "content_retrieved_at_utc")
    if keep:
        ranked = keep(ranked)
        contents = bloom.cut(contents, "content_id", ranked)
    found = ranked.join(contents, ["content_id", "logical_key"]).join(_succeeded(tables, "first_run_id"), "first_run_id")
    return current(found.select(*[n for n, _ in fact_columns(product)]))


def fact(tables: Tables, product: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The full refresh of a product's current-state fact, under its contract."""
    return assert_contract(latest(tables, product, keep), fact_columns(product), FACTS[product])


def as_of(tables: Tables, product: str, cutoff) -> DataFrame:
    """Current states as they were known at an instant. Beyond the reference."""
    return current(history(tables, product).where(F.col("state_known_at") <= F.lit(cutoff).cast("timestamp_ntz")))


def daily_summary(fact_lmp: DataFrame) -> DataFrame:
    """Observed prices of each market, hub and day, beside the hours the day has."""
    lmp = F.col("lmp")
    days = fact_lmp.groupBy("source", "market", "location", "market_date").agg(
        F.count("*").alias("observation_count"),
        F.avg(lmp).cast("decimal(38,9)").alias("average_lmp_usd_per_mwh"),
        F.min(lmp).alias("minimum_lmp_usd_per_mwh"),
        F.max(lmp).alias("maximum_lmp_usd_per_mwh"),
        F.sum(F.when(lmp < 0, 1).otherwise(0)).cast("bigint").alias("negative_price_interval_count"),
    )
    return days.withColumn("expected_hour_count", timez.expected_hours(F.col("market_date")))


def ingestion_health(tables: Tables) -> DataFrame:
    """Runs of each request by outcome; failed and unfinished ones stay visible."""

    def runs(status: str):
        return F.sum(F.when(F.col("status") == status, 1).otherwise(0)).cast("bigint")

    def rows(name: str):
        return F.sum(F.when(F.col("status") == "SUCCEEDED", F.col(name)).otherwise(0)).cast("bigint").alias(f"successful_{name}")

    return (
        stg_runs(tables)
        .groupBy("source", "product", "requested_date", "requested_location")
        .agg(
            F.count("*").alias("run_count"),
            runs("SUCCEEDED").alias("succeeded_run_count"),
            runs("FAILED").alias("failed_run_count"),
            runs("STARTED").alias("started_run_count"),
            runs("COMMITTED").alias("unfinalized_run_count"),
            F.max(F.when(F.col("status") == "SUCCEEDED", F.col("knowledge_at"))).alias("latest_successful_knowledge_at"),
            rows("rows_accepted"),
            rows("new_contents"),
            rows("new_transitions"),
        )
    )


def battery_inputs(fact_lmp: DataFrame) -> DataFrame:
    """The columns a dispatch needs, with lineage."""
    return fact_lmp.select(*BATTERY_INPUTS)


def build(tables: Tables) -> dict[str, DataFrame]:
    """Every model by name; facts that ``tables`` holds are used, others refreshed in full."""
    out: dict[str, DataFrame] = {"stg_ingestion_runs": stg_runs(tables)}
    for product, name in FACTS.items():
        out |= {f"stg_{product}_contents": stg_contents(tables, product), f"stg_{product}_state_transitions": stg_transitions(tables, product), f"int_{product}_revision_history": history(tables, product)}
        out[name] = tables.get(name) or fact(tables, product)
    out["mart_daily_lmp_summary"] = daily_summary(out["fct_hourly_lmp"])
    out["mart_ingestion_health"] = ingestion_health(tables)
    out["mart_battery_optimization_inputs"] = battery_inputs(out["fct_hourly_lmp"])
    return out


def register_views(models: Mapping[str, DataFrame]) -> None:
    """Models as temporary views, so SQL can name them."""
    for name, frame in models.items():
        frame.createOrReplaceTempView(name)
