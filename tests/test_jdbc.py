"""The JDBC parts that need no database: options, and the order of the swap."""

import pytest

from celltide.schemas import Batch
from celltide.sources import jdbc

DB = jdbc.Database("jdbc:postgresql://host/db", "me", "secret", extra={"fetchsize": "1000"})
BATCHES = [Batch("2026-05-05", "09"), Batch("2026-05-05", "10")]


class Connection:
    """Records what a java.sql.Connection is asked to do."""

    def __init__(self, fails_on=None, tables=()):
        self.log, self.fails_on, self.tables = [], fails_on, tables

    def _do(self, *event):
        self.log.append(event)
        if event[0] == self.fails_on:
            raise RuntimeError(self.fails_on)

    def setAutoCommit(self, on):
        self._do("autocommit", on)

    def prepareStatement(self, sql):
        self._do("prepare", sql)
        return self

    def createStatement(self):
        return self

    def setString(self, at, value):
        self._do("set", at, value)

    def addBatch(self):
        self._do("add")

    def executeBatch(self):
        self._do("delete")

    def executeUpdate(self, sql):
        self._do("update", sql)

    def commit(self):
        self._do("commit")

    def rollback(self):
        self._do("rollback")

    def close(self):
        self._do("close")

    def getMetaData(self):
        return self

    def getTables(self, catalog, schema, name, kinds):
        return iter_like(name in self.tables)


class iter_like:
    def __init__(self, found):
        self.found = found

    def next(self):
        return self.found


def test_options_name_everything_and_hide_the_password():
    assert DB.options("cell_info") == {
        "url": "jdbc:postgresql://host/db", "user": "me", "password": "secret",
        "dbtable": "cell_info", "fetchsize": "1000",
    }
    assert "secret" not in repr(DB)


@pytest.mark.parametrize("name", ["t; DROP TABLE x", "a.b.c", "", "1t", "t--"])
def test_table_names_are_checked(name):
    with pytest.raises(ValueError):
        DB.options(name)


def test_properties_reach_both_connections():
    db = jdbc.Database("jdbc:x", "me", properties={"sslmode": "require"}, extra={"fetchsize": "10"})
    assert db.options("t")["sslmode"] == "require" and db.options("t")["fetchsize"] == "10"
    assert db.login() == {"user": "me", "sslmode": "require"}


def test_slices():
    assert jdbc.Slices("id", 0, 100, 4).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }


def test_swap_is_one_transaction():
    connection = Connection()
    jdbc._swap(connection, "gold", "gold_stage", ["cell_id", "date", "hour"], BATCHES)
    assert connection.log == [
        ("autocommit", False),
        ("prepare", 'DELETE FROM gold WHERE "date" = ? AND "hour" = ?'),
        ("set", 1, "2026-05-05"), ("set", 2, "09"), ("add",),
        ("set", 1, "2026-05-05"), ("set", 2, "10"), ("add",),
        ("delete",), ("close",),
        ("update", 'INSERT INTO gold ("cell_id", "date", "hour") '
                   'SELECT DISTINCT "cell_id", "date", "hour" FROM gold_stage'),
        ("close",), ("commit",), ("close",),
    ]


@pytest.mark.parametrize("step", ["prepare", "delete", "update", "commit"])
def test_a_failed_swap_is_rolled_back_and_raised(step):
    connection = Connection(fails_on=step)
    with pytest.raises(RuntimeError, match=step):
        jdbc._swap(connection, "gold", "gold_stage", ["date", "hour"], BATCHES)
    assert connection.log[-2:] == [("rollback",), ("close",)]


def test_only_an_existing_stage_is_dropped():
    absent, present = Connection(), Connection(tables=["GOLD_STAGE"])
    jdbc._drop(absent, "gold_stage")
    jdbc._drop(present, "gold_stage")
    assert absent.log == [("close",)]
    assert present.log == [("update", "DROP TABLE gold_stage"), ("close",), ("close",)]


def test_replace_fills_a_stage_and_always_drops_it(spark, monkeypatch):
    events = []
    df = spark.createDataFrame([("a", "2026-05-05", "09")], "cell_id string, date string, hour string")

    def append(rows, db, table, connections=8, **options):
        events.append(("append", table.split("_stage_")[0], "_stage_" in table, rows.count(), options))

    def connect(session, db):
        connection = Connection(fails_on="commit" if len(events) > 3 else None)
        events.append(connection)
        return connection

    monkeypatch.setattr(jdbc, "append_rows", append)
    monkeypatch.setattr(jdbc, "_connect", connect)
    jdbc.replace_batches(df, DB, "gold", BATCHES, column_types="date VARCHAR(10)")
    types = {"createTableColumnTypes": "date VARCHAR(10)"}
    assert events[:2] == [("append", "gold", False, 0, types), ("append", "gold", True, 1, types)]
    assert ("commit",) in events[2].log and events[3].log == [("close",)]

    with pytest.raises(RuntimeError):
        jdbc.replace_batches(df, DB, "gold", BATCHES)
    assert ("rollback",) in events[-2].log and events[-1].log == [("close",)]
