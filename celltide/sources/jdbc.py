"""SQL databases over JDBC: the cell master in, serving rows out."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from celltide.schemas import Batch

SPATIAL_TABLE = "mdt_spatial_gold"
AUDIT_TABLE = "mdt_audit_report"
CELL_TABLE = "cell_info"

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


@dataclass(frozen=True)
class Database:
    """A connection.

    ``properties`` go to the database's driver (TLS and the like), on Spark's
    connections and on the one that swaps the batches alike. ``extra`` takes
    any further option of Spark's JDBC source.
    """

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    extra: dict[str, str] = field(default_factory=dict, repr=False)

    def options(self, table: str) -> dict[str, str]:
        named = {"url": self.url, "user": self.user, "password": self.password}
        named |= {"driver": self.driver, "dbtable": _checked(table)}
        known = {k: v for k, v in named.items() if v is not None}
        return {**known, **self.properties, **self.extra}

    def login(self) -> dict[str, str]:
        """What the driver is given: user, password and the connection's properties."""
        named = {"user": self.user, "password": self.password}
        return {**{k: v for k, v in named.items() if v is not None}, **self.properties}


def _checked(table: str) -> str:
    if not _NAME.fullmatch(table):
        raise ValueError(f"not a table name: {table!r}")
    return table


@dataclass(frozen=True)
class Slices:
    """How to read a large table in parallel: ranges of a numeric or date column."""

    column: str
    low: str | int
    high: str | int
    count: int

    def options(self) -> dict[str, str]:
        bounds = {"partitionColumn": self.column, "lowerBound": self.low, "upperBound": self.high}
        return {k: str(v) for k, v in {**bounds, "numPartitions": self.count}.items()}


def read_table(
    spark: SparkSession, db: Database, table: str, slices: Slices | None = None
) -> DataFrame:
    """A table; filters and column choice reach the database."""
    reader = spark.read.format("jdbc").options(**db.options(table))
    return (reader.options(**slices.options()) if slices else reader).load()


def append_rows(
    df: DataFrame, db: Database, table: str, connections: int = 8, **options: str
) -> None:
    """Append in parallel, over at most ``connections`` sessions."""
    named = {"batchsize": "10000", **options, **db.options(table)}
    df.write.format("jdbc").options(**named).option("numPartitions", connections).mode(
        "append"
    ).save()


def replace_batches(
    df: DataFrame,
    db: Database,
    table: str,
    batches: Sequence[Batch],
    connections: int = 8,
    column_types: str | None = None,
) -> None:
    """Make ``batches`` of a table hold exactly the rows of ``df``.

    Executors fill a staging table; one transaction on the driver then deletes
    the batches and inserts the staged rows. Readers never see a half-replaced
    hour, a failure leaves the old rows, and a task that was run twice shows
    only in the staging table, whose repeats ``DISTINCT`` removes: rows of a
    serving table are unique, and have to come from a table on disk to be equal
    when read again. ``column_types`` names SQL types where the database's
    default text type cannot be compared.
    """
    stage = f"{_checked(table)}_stage_{uuid.uuid4().hex[:8]}"
    types = {"createTableColumnTypes": column_types} if column_types else {}
    append_rows(df.limit(0), db, table, 1, **types)  # creates the table on first use
    try:
        append_rows(df, db, stage, connections, **types)
        _swap(_connect(df.sparkSession, db), table, stage, df.columns, batches)
    finally:
        _drop(_connect(df.sparkSession, db), stage)


def _connect(spark: SparkSession, db: Database):
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for key, value in db.login().items():
        login.setProperty(key, value)
    return jvm.java.sql.DriverManager.getConnection(db.url, login)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _swap(
    connection, table: str, stage: str, columns: Sequence[str], batches: Sequence[Batch]
) -> None:
    names = ", ".join(_quoted(c) for c in columns)
    try:
        connection.setAutoCommit(False)
        delete = connection.prepareStatement(
            f'DELETE FROM {table} WHERE "date" = ? AND "hour" = ?'
        )
        for batch in batches:
            delete.setString(1, batch.date)
            delete.setString(2, batch.hour)
            delete.addBatch()
        delete.executeBatch()
        delete.close()
        insert = connection.createStatement()
        insert.executeUpdate(
            f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {stage}"
        )
        insert.close()
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _drop(connection, stage: str) -> None:
    """Drop the staging table if the write got far enough to create it."""
    try:
        meta = connection.getMetaData()
        wanted = stage.split(".")[-1]
        names = [wanted, wanted.upper(), wanted.lower()]
        if any(meta.getTables(None, None, name, None).next() for name in names):
            statement = connection.createStatement()
            statement.executeUpdate(f"DROP TABLE {stage}")
            statement.close()
    finally:
        connection.close()
