"""Data model: hourly batches, table schemas and the radio domain limits."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_KEYS = ("date", "hour")


@dataclass(frozen=True, order=True)
class Batch:
    """One hour of measurements. Both parts stay text: ``'09'`` is not ``9``."""

    date: str
    hour: str

    def __post_init__(self) -> None:
        try:
            canonical = datetime.strptime(f"{self.date}-{self.hour}", "%Y-%m-%d-%H")
        except (TypeError, ValueError) as exc:
            raise ValueError(f"not a batch: {self.date!r}, {self.hour!r}") from exc
        if canonical.strftime("%Y-%m-%d-%H") != self.key:
            raise ValueError(f"batch must be YYYY-MM-DD and HH: {self.key!r}")

    @property
    def key(self) -> str:
        return f"{self.date}-{self.hour}"

    @classmethod
    def parse(cls, key: str) -> Batch:
        return cls(key[:10], key[11:])

    @classmethod
    def range(cls, first: Batch, last: Batch) -> list[Batch]:
        """Every hour from ``first`` to ``last``, both included."""
        if last < first:
            raise ValueError(f"the range ends before it begins: {first.key}, {last.key}")
        start = datetime.strptime(first.key, "%Y-%m-%d-%H")
        hours = int((datetime.strptime(last.key, "%Y-%m-%d-%H") - start) / timedelta(hours=1))
        stamps = (start + timedelta(hours=i) for i in range(hours + 1))
        return [cls(t.strftime("%Y-%m-%d"), t.strftime("%H")) for t in stamps]

    @classmethod
    def day(cls, date: str) -> list[Batch]:
        return cls.range(cls(date, "00"), cls(date, "23"))


def batch_key() -> Column:
    """The key a row's own ``date_hour`` has to equal."""
    return F.concat_ws("-", F.col("date"), F.col("hour"))


def _hours_by_dates(batches: Iterable[Batch]) -> list[tuple[list[str], list[str]]]:
    hours_of: dict[str, set[str]] = defaultdict(set)
    for b in batches:
        hours_of[b.date].add(b.hour)
    dates_of: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for date, hours in sorted(hours_of.items()):
        dates_of[tuple(sorted(hours))].append(date)
    return [(dates, list(hours)) for hours, dates in dates_of.items()]


def in_batches(batches: Iterable[Batch]) -> Column:
    """Partition filter for a set of batches.

    Days asking for the same hours share one conjunct, so a month of whole
    days stays a single ``date IN (...) AND hour IN (...)``.
    """
    groups = _hours_by_dates(batches)
    if not groups:
        return F.lit(False)
    return reduce(
        or_, [F.col("date").isin(dates) & F.col("hour").isin(hours) for dates, hours in groups]
    )


def in_batches_sql(batches: Iterable[Batch]) -> str:
    """The same filter as SQL text; safe because a ``Batch`` validates its parts."""

    def one_of(column: str, values: list[str]) -> str:
        return f"{column} IN ({', '.join(repr(v) for v in values)})"

    groups = _hours_by_dates(batches)
    if not groups:
        return "false"
    return " OR ".join(f"({one_of('date', d)} AND {one_of('hour', h)})" for d, h in groups)


@dataclass(frozen=True)
class RadioDomain:
    """Inclusive value ranges of a valid measurement, and the weak-signal limit."""

    rsrp: tuple[int, int] = (-140, -44)
    rsrq: tuple[float, float] = (-20.0, -3.0)
    lat: tuple[float, float] = (8.5, 23.4)
    lng: tuple[float, float] = (102.1, 109.5)
    weak_below_rsrp: int = -110


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def table_schema(*parts: T.StructType | str) -> T.StructType:
    """Join schemas and ``name type, ...`` texts, without needing a session."""
    fields: list[T.StructField] = []
    for part in parts:
        if isinstance(part, T.StructType):
            fields += part.fields
        else:
            named = (column.split() for column in part.split(","))
            fields += [T.StructField(name, _TYPES[kind]) for name, kind in named]
    return T.StructType(fields)


LANDING = table_schema(
    "time_ms double, p_cell_rsrp int, p_cell_rsrq double, lat double, lng double,"
    "province_name string, district_name string, date_hour string, cell_id string"
)

BATCH = table_schema("date string, hour string")

# unreadable holds what did not fit the landing schema: the raw line, or a value that is no whole number
RAW = table_schema(LANDING, "unreadable string", BATCH)

# verdict tells accepted rows ("clean") from quarantined ones ("dirty")
CHECKED = table_schema(
    LANDING, "unreadable string, processed_at timestamp, verdict string", BATCH
)

REPORT = table_schema(
    "total_raw_records bigint, duplicate_count bigint, clean_count bigint, dirty_count bigint,"
    "undecided_count bigint, unreadable_count bigint,"
    "gx_success_rate double, gx_total_rules bigint, gx_failed_rules bigint, gx_is_passed boolean,"
    "created_at timestamp",
    BATCH,
)

# what the serving database's audit table has of it
AUDIT_COLUMNS = (
    "total_raw_records", "duplicate_count", "clean_count", "dirty_count", "gx_success_rate",
    "gx_total_rules", "gx_failed_rules", "gx_is_passed", "created_at", *BATCH_KEYS,
)

CELL_INFO = table_schema("cell_code string, x_ double, y_ double")

ENRICHED = table_schema(
    LANDING,
    "processed_at timestamp, h3_index string, h3_center_lat double, h3_center_lon double,"
    "cell_lat double, cell_lon double, cell_pos_source string, distance_to_cell_km double",
    BATCH,
)

GOLD = table_schema(
    "h3_index string, cell_id string, user_density_count bigint, avg_rsrp double, p10_rsrp int,"
    "avg_distance_km double, weak_signal_ratio double, h3_center_lat double, h3_center_lon double,"
    "cell_lat double, cell_lon double",
    BATCH,
)
