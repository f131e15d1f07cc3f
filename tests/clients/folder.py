"""A client of a made-up service for tests: prices and loads that follow the hour, each call left as a file in a folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import UTC, date, datetime, timedelta

import pandas as pd

from tidemark.operators.revision import Request


#: Names the folder of calls: workers of a data source don't take the session's environment.
POINTER = os.path.join(tempfile.gettempdir(), "tidemark-test-calls")


def frame(product: str, day: date, hub: str | None) -> pd.DataFrame:
    first, last = (x.replace(tzinfo=UTC) for x in Request(product, day, hub).bounds)
    step = timedelta(hours=1) if product == "lmp" else timedelta(minutes=5)
    starts = [first + step * k for k in range((last - first) // step)]
    rows = pd.DataFrame({"Time": [x.isoformat() for x in starts], "Interval Start": [x.isoformat() for x in starts], "Interval End": [(x + step).isoformat() for x in starts]})
    if product == "load":
        return rows.assign(Load=[20_000.0 + 50 * x.hour for x in starts])
    energy = [30.0 + 2 * (k % 12) for k in range(len(starts))]
    return rows.assign(Market="DAY_AHEAD_HOURLY", Location=hub, LMP=[e - 1.5 for e in energy], Energy=energy, Congestion=-2.0, Loss=0.5, **{"Location Type": "Trading Hub"})


def note(product: str, day: date, hub: str | None) -> int:
    """Leaves a file for this call; how many there are of it."""
    with open(POINTER) as file:
        folder = file.read()
    call = f"{product}_{day}_{hub}_"
    open(f"{folder}/{call}{uuid.uuid4().hex}", "w").close()
    return sum(n.startswith(call) for n in os.listdir(folder))


def days(product: str, day: date, hub: str | None) -> pd.DataFrame:
    note(product, day, hub)
    return frame(product, day, hub)


def away(product: str, day: date, hub: str | None) -> pd.DataFrame:
    """Nothing on the second of a month."""
    note(product, day, hub)
    return frame(product, day, hub).head(0 if day.day == 2 else 99)


def flaky(product: str, day: date, hub: str | None) -> pd.DataFrame:
    """Away at the first call on the second of a month."""
    if note(product, day, hub) == 1 and day.day == 2:
        raise ConnectionError("away")
    return frame(product, day, hub)


def astray(product: str, day: date, hub: str | None) -> pd.DataFrame:
    """The next day's rows on the second of a month."""
    return frame(product, day + timedelta(days=day.day == 2), hub)
