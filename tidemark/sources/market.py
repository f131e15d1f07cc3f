"""Market data from files with the columns of the service's client, and a Spark data source that calls a client on executors.

A file, or a client that the caller names, is the source: this package speaks to no network itself. Frames pass
the same normalisation either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import UTC, date, datetime, timedelta
from importlib import import_module
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.errors import SourceFailed, UnsupportedRequest, ValidationError
from tidemark.functions.timez import PACIFIC
from tidemark.operators import normalize
from tidemark.operators.revision import Request
from tidemark.schemas import HUBS, PRODUCTS

_TEXTS = {"lmp": ("Time", "Interval Start", "Interval End", "Market", "Location", "Location Type"), "load": ("Time", "Interval Start", "Interval End")}
_NUMBERS = {"lmp": ("LMP", "Energy", "Congestion", "Loss"), "load": ("Load",)}


def frame_schema(product: str) -> str:
    return ", ".join([*(f"`{c}` string" for c in _TEXTS[product]), *(f"`{c}` double" for c in _NUMBERS[product])])


def read_frame(spark: SparkSession, product: str, path: str) -> DataFrame:
    """A source frame from a JSON array, JSON lines, CSV with a header, or Parquet."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.schema(frame_schema(product))
    if path.endswith(".csv"):
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.option("multiLine", path.endswith(".json")).option("mode", "FAILFAST").json(path)


def client(name: str) -> Callable[[str, date, str | None], object]:
    """A client of the service, named as ``module:function``: called with product, day and hub, it returns a
    pandas or Spark frame with the service's columns."""
    module, _, function = name.partition(":")
    try:
        return getattr(import_module(module), function)
    except (ImportError, AttributeError, ValueError) as error:
        raise ValidationError(f"no client at {name}") from error


def fetch(spark: SparkSession, request: Request, path: str, method: str = "file", library_version: str = "file", via: str | None = None) -> DataFrame:
    """Normalised observations of a request from a file, or from the client ``via``; rows outside the request are
    an error, and so is whatever the client raises, as a failure that may pass if it is one of the network."""
    if request.product == "load" and request.hours > 24:
        raise UnsupportedRequest("the load source can't tell the repeated hour of a fall-back day apart")
    provenance = {"retrieved_at_utc": datetime.now(UTC).replace(tzinfo=None), "source_url": path, "source_method": method, "library_version": library_version}
    if via is None:
        frame = read_frame(spark, request.product, path)
    else:
        call = client(via)
        provenance |= {"source_url": via, "source_method": "client", "library_version": getattr(import_module(via.split(":")[0]), "__version__", "unknown")}
        try:
            given = call(request.product, request.day, request.location)
        except (ConnectionError, TimeoutError):
            raise
        except Exception as error:
            raise SourceFailed(f"the client failed: {type(error).__name__}") from error
        frame = given if isinstance(given, DataFrame) else spark.createDataFrame(given)
    rows = normalize.normalize(request.product, frame, provenance)
    first, last = request.bounds
    start = F.col("interval_start_utc")
    wrong = (start < F.lit(first).cast("timestamp_ntz")) | (start >= F.lit(last).cast("timestamp_ntz"))
    if request.product == "lmp":
        wrong = wrong | (F.col("location") != request.location)
    if rows.where(wrong).limit(1).count():
        raise ValidationError("the source returned observations outside the requested hub or day")
    return rows


class _Slice(InputPartition):
    """One market day of one hub (of the system, for load)."""

    def __init__(self, day: str, hub: str | None):
        self.day, self.hub = day, hub


class MarketService(DataSource):
    """``spark.read.format("market_service")``: what a client of the service returns, a partition for each day and hub.

    Options: ``client`` (``module:function``, called on executors with product, day and hub), ``product``, the days
    ``first`` to ``last`` (ISO, inclusive; as a stream, ``last`` may be left out for every day that is over) and
    ``hubs`` (comma-separated; all by default). Days and hubs are left out by the options, before any client is called.
    They are not taken from filters: Spark keeps what a Python source was told of filters with the frame, so another
    plan over the same frame would read the pruned slices too and lose rows. A slice that fails is tried again by
    Spark alone, without the others; a day without rows is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "market_service"

    def schema(self) -> str:
        return f"market_date date, hub string, {frame_schema(self.options.get('product', 'lmp'))}"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Service(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(_Service(self.options))


class _Service:
    """The options, checked, and one slice's rows."""

    def __init__(self, options: dict):
        self.product, self.client = options.get("product", "lmp"), options.get("client", "")
        if self.product not in PRODUCTS or ":" not in self.client:
            raise ValidationError("a product and a client as module:function are needed")
        named = tuple(h for h in options.get("hubs", ",".join(HUBS)).split(",") if h)
        self.hubs: tuple[str | None, ...] = named if self.product == "lmp" else (None,)
        self.first, self.last = date.fromisoformat(options["first"]), date.fromisoformat(options["last"]) if options.get("last") else None

    def over(self) -> date:
        """The latest day that may be asked for: ``last``, or the latest that is over in Pacific time."""
        done = datetime.now(ZoneInfo(PACIFIC)).date() - timedelta(days=1)
        return done if self.last is None else min(self.last, done)

    def slices(self, first: date, last: date) -> list[_Slice]:
        days = (first + timedelta(days=k) for k in range((last - first).days + 1))
        return [_Slice(day.isoformat(), hub) for day in days for hub in self.hubs]

    def rows(self, part: _Slice) -> Iterator[tuple]:
        day = date.fromisoformat(part.day)
        given = client(self.client)(self.product, day, part.hub)
        if not len(given):
            raise SourceFailed(f"no observations of {part.day} {part.hub or ''}")
        names = (*_TEXTS[self.product], *_NUMBERS[self.product])
        columns = [[str(x) for x in given[n]] if n in _TEXTS[self.product] else [float(x) for x in given[n]] for n in names]
        return ((day, part.hub, *row) for row in zip(*columns, strict=True))


class _Reader(DataSourceReader):
    def __init__(self, service: _Service):
        self.service, self.parts = service, service.slices(service.first, service.over())

    def partitions(self) -> list[InputPartition]:
        # Spark takes no source without partitions; a slice without a day has no rows.
        return list(self.parts) or [_Slice("", None)]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        return self.service.rows(partition) if partition.day else iter(())


class _Stream(DataSourceStreamReader):
    """Whole days as offsets: a batch holds the days that have ended since the one before, and a restart goes on there."""

    def __init__(self, service: _Service):
        self.service = service

    def initialOffset(self) -> dict:
        return {"before": self.service.first.isoformat()}

    def latestOffset(self) -> dict:
        return {"before": max(self.service.over() + timedelta(days=1), self.service.first).isoformat()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return list(self.service.slices(date.fromisoformat(start["before"]), date.fromisoformat(end["before"]) - timedelta(days=1)))

    def read(self, partition: _Slice) -> Iterator[tuple]:
        return self.service.rows(partition)


def register(spark: SparkSession) -> None:
    """Makes ``market_service`` known to a session."""
    spark.dataSource.register(MarketService)


def fetch_days(spark: SparkSession, product: str, first: date, last: date, via: str, hubs: Sequence[str] = HUBS) -> DataFrame:
    """Judged observations of many days, each day and hub fetched by a task of its own; ``violations`` also names rows
    that their slice did not ask for. Nothing passes through the driver."""
    register(spark)
    options = {"product": product, "client": via, "first": str(first), "last": str(last), "hubs": ",".join(hubs)}
    frame = spark.read.format("market_service").options(**options).load()
    provenance = {"retrieved_at_utc": datetime.now(UTC).replace(tzinfo=None), "source_url": via, "source_method": "client", "library_version": "executors"}
    asked = frame.withColumnsRenamed({"market_date": "asked_date", "hub": "asked_hub"})
    rows = normalize.judged(product, asked, provenance, keep=("asked_date", "asked_hub"))
    elsewhere = ~F.col("market_date").eqNullSafe(F.col("asked_date"))
    if product == "lmp":
        elsewhere = elsewhere | ~F.col("location").eqNullSafe(F.col("asked_hub"))
    return rows.withColumn("violations", F.when(elsewhere, F.array_append("violations", F.lit("not asked for"))).otherwise(F.col("violations"))).drop("asked_date", "asked_hub")
