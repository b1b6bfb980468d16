"""Relational databases as a Spark data source, ``format("visitflow_db")``, over any DB-API module.

Reading: the key range is cut into ``numPartitions`` ranges, one connection a task; filters that the
database can judge are part of its query (``spark.sql.python.filterPushdown.enabled``).

Writing a batch (``write`` option):

* ``append`` and ``scope``: every task writes into ``<table>__staged`` in one transaction of its own, with
  a token of its attempt.  The commit on the driver deletes the rows of ``scope`` (JSON of column values,
  e.g. ``{"task_id": 1}``), moves the rows of the attempts that Spark accepted and empties the staging
  rows, all in one transaction: readers see the old rows or the new ones, retried and speculative
  attempts count once, and a rerun with the same scope replaces its own rows, also by none.
* ``upsert`` on ``keys`` and ``groups`` (all rows of a group of ``keys`` are replaced): rows go straight to the table,
  with ``query`` and ``epoch``; with ``once`` an epoch that is whole is not written again.

Writing a stream needs no staging: the query and its epoch stand in the row, in the same transaction.
A row of an earlier epoch of the same query never replaces a later one, ``visitflow_epochs`` tells which
epochs are whole, and a task of a whole epoch writes nothing, so a replayed micro-batch, a retried
task or one that Spark has given up changes nothing.  A streamed ``append`` marks its rows with epoch and
token; the commit deletes those of attempts that were not accepted and notes the epoch in one
transaction, and readers take whole epochs alone (option ``committed``).  Spark gives Python sinks no ``update``
mode, so running totals are written from ``foreachBatch`` by the batch writer, with the same columns and log.

Column types are those of ``create_table``.  The module must be importable in the tasks, and so must this
package (``--py-files``).  An SQLite file serves tests and single machines: other machines do not see it.
"""

from __future__ import annotations

import datetime as dt
import decimal
import importlib
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, EqualNullSafe, EqualTo, Filter,
    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from visitflow.schemas import TABLE_KEYS

FORMAT = "visitflow_db"
EPOCHS = "visitflow_epochs"
#: Who wrote a row of a keyed or streamed table, and when.
QUERY_COL, EPOCH_COL, TOKEN_COL = "written_by", "written_epoch", "written_token"
#: Local properties that Spark sets for the tasks of a micro-batch.
_QUERY_PROPERTY, _BATCH_PROPERTY = "sql.streaming.queryId", "streaming.sql.batchId"
BATCH_JOB = "batch"
_SQL_TYPES = {
    T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP", T.StringType: "VARCHAR(4000)", T.BinaryType: "BLOB",
}
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class _Settings:
    """The options of one read or write."""

    def __init__(self, options):
        self.module = options.get("module", "sqlite3")
        self.connect = json.loads(options.get("connect", "{}"))
        self.dialect = options.get("dialect", "ansi")
        self.table = options["table"]
        self.keys = [k for k in options.get("keys", "").split(",") if k]
        self.write = options.get("write", "append")
        self.scope = json.loads(options["scope"]) if "scope" in options else None
        self.epoch = int(options.get("epoch", -1))
        self.query = options.get("query", BATCH_JOB)
        self.rows = int(options.get("batchsize", 1000))
        self.partition_column = options.get("partitioncolumn")
        self.partitions = int(options.get("numpartitions", 1))
        self.committed = options.get("committed", "false").lower() == "true"
        self.once = options.get("once", "false").lower() == "true"
        if self.write not in ("append", "upsert", "groups"):
            raise ValueError(f"unknown write {self.write!r}")
        if self.write != "append" and not self.keys:
            raise ValueError(f"write={self.write} needs keys")

    @contextmanager
    def transaction(self):
        """A cursor on a connection of its own: committed at the end, rolled back by an error."""
        connection = importlib.import_module(self.module).connect(**self.connect)
        try:
            cursor = connection.cursor()
            yield cursor
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def sql(self, text: str) -> str:
        """``?`` as the module's placeholder."""
        style = importlib.import_module(self.module).paramstyle
        return text if style == "qmark" else text.replace("?", "%s")


def _column_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    if type(kind) not in _SQL_TYPES:
        raise ValueError(f"no column type for {kind.simpleString()}")
    return _SQL_TYPES[type(kind)]


def _columns(schema: T.StructType) -> list[str]:
    return [f"{f.name} {_column_type(f.dataType)}" for f in schema.fields]


_WRITTEN = [f"{QUERY_COL} VARCHAR(200)", f"{EPOCH_COL} BIGINT"]
_TOKEN = f"{TOKEN_COL} VARCHAR(40)"


def _plain(value):
    """A value as DB-API modules take it."""
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value) if isinstance(value, decimal.Decimal) else value


def _rows(batch: pa.RecordBatch) -> list[tuple]:
    return [tuple(map(_plain, row)) for row in zip(*(c.to_pylist() for c in batch.columns))] if batch.num_columns else []


def _typed(values: list, kind: T.DataType, arrow: pa.DataType) -> pa.Array:
    """Database values as an Arrow column; modules without time types give text."""
    if isinstance(kind, T.DateType):
        values = [dt.date.fromisoformat(v[:10]) if isinstance(v, str) else v for v in values]
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        values = [dt.datetime.fromisoformat(v) if isinstance(v, str) else v for v in values]
        if isinstance(kind, T.TimestampType):  # stored as UTC wall time
            values = [v if v is None or v.tzinfo else v.replace(tzinfo=dt.timezone.utc) for v in values]
    elif isinstance(kind, T.DecimalType):
        values = [None if v is None else decimal.Decimal(str(v)) for v in values]
    elif isinstance(kind, T.BooleanType):
        values = [None if v is None else bool(v) for v in values]
    return pa.array(values, arrow)


class DatabaseSource(DataSource):
    """The data source; see the module's text and ``Database`` for its options."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("give the schema of the table: .schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(_Settings(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        settings = _Settings(self.options)
        if overwrite and settings.write == "append" and settings.scope is None:
            settings.scope = {}
        return _BatchWriter(settings, schema)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(_Settings(self.options), schema)


@dataclass
class _Range(InputPartition):
    """Keys from ``low`` up to, not with, ``high``; None is open, and ``nulls`` takes the rows without a key."""

    low: int | None
    high: int | None
    nulls: bool


class _Reader(DataSourceReader):
    def __init__(self, settings: _Settings, schema: T.StructType):
        self.settings, self.schema = settings, schema
        self.conditions: list[str] = []
        self.values: list = []
        if settings.committed:
            self.conditions.append(
                f"({EPOCH_COL} IS NULL OR EXISTS (SELECT 1 FROM {EPOCHS} e WHERE e.target = ? AND e.query = {settings.table}.{QUERY_COL} "
                f"AND e.epoch = {settings.table}.{EPOCH_COL}))")
            self.values.append(settings.table)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            # collations may call different texts equal, so Spark looks at them again
            text = len(f.attribute) == 1 and f.attribute[0] in self.schema.names and isinstance(self.schema[f.attribute[0]].dataType, T.StringType)
            if not self._push(f) or (text and not isinstance(f, (IsNull, IsNotNull))):
                yield f

    def _push(self, f: Filter) -> bool:
        if len(f.attribute) != 1 or f.attribute[0] not in self.schema.names:
            return False
        column = f.attribute[0]
        if isinstance(f, (IsNull, IsNotNull)):
            self.conditions.append(f"{column} IS {'NOT ' if isinstance(f, IsNotNull) else ''}NULL")
            return True
        kind = self.schema[column].dataType
        # text forms of other types need not order as their values do
        simple = isinstance(kind, (T.IntegralType, T.StringType, T.DateType))
        if isinstance(f, EqualNullSafe) or not simple:
            return False
        if isinstance(f, In):
            if not f.value or len(f.value) > 500:
                return False
            self.conditions.append(f"{column} IN ({', '.join('?' for _ in f.value)})")
            self.values += map(_plain, f.value)
            return True
        if type(f) not in _COMPARED:
            return False
        if isinstance(kind, T.StringType) and type(f) is not EqualTo:  # the database's collation orders text its own way
            return False
        self.conditions.append(f"{column} {_COMPARED[type(f)]} ?")
        self.values.append(_plain(f.value))
        return True

    def _where(self, more: Sequence[str] = ()) -> str:
        conditions = [*self.conditions, *more]
        return f" WHERE {' AND '.join(conditions)}" if conditions else ""

    def partitions(self) -> list[_Range]:
        s, column = self.settings, self.settings.partition_column
        if column is None or s.partitions < 2:
            return [_Range(None, None, True)]
        with s.transaction() as cursor:
            cursor.execute(s.sql(f"SELECT MIN({column}), MAX({column}) FROM {s.table}{self._where()}"), self.values)
            [(low, high)] = cursor.fetchall()
        if low is None:
            return [_Range(None, None, True)]
        step = max(1, -(-(int(high) - int(low) + 1) // s.partitions))
        inner = list(range(int(low) + step, int(high) + 1, step))
        return [_Range(a, b, a is None) for a, b in zip([None, *inner], [*inner, None])]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        s, column = self.settings, self.settings.partition_column
        more, values = [], list(self.values)
        if partition.low is not None:
            more.append(f"{column} >= ?")
            values.append(partition.low)
        if partition.high is not None:
            more.append(f"({column} < ? OR {column} IS NULL)" if partition.nulls else f"{column} < ?")
            values.append(partition.high)
        arrow = [pa_type(f.dataType) for f in self.schema.fields]
        with s.transaction() as cursor:
            cursor.execute(s.sql(f"SELECT {', '.join(self.schema.names)} FROM {s.table}{self._where(more)}"), values)
            while rows := cursor.fetchmany(s.rows * 10):
                columns = [_typed(list(c), f.dataType, a) for c, f, a in zip(zip(*rows), self.schema.fields, arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=self.schema.names)


_ARROW_TYPES = {
    T.ByteType: pa.int8(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.FloatType: pa.float32(),
    T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.DateType: pa.date32(), T.TimestampType: pa.timestamp("us", "UTC"),
    T.TimestampNTZType: pa.timestamp("us"), T.StringType: pa.string(), T.BinaryType: pa.binary(),
}


def pa_type(kind: T.DataType) -> pa.DataType:
    return pa.decimal128(kind.precision, kind.scale) if isinstance(kind, T.DecimalType) else _ARROW_TYPES[type(kind)]


@dataclass
class _Written(WriterCommitMessage):
    token: str
    rows: int


class _Writer:
    """What batch and stream writers share: one transaction a task."""

    def __init__(self, settings: _Settings, schema: T.StructType):
        self.settings, self.schema = settings, schema
        missing = [k for k in settings.keys if k not in schema.names]
        if missing:
            raise ValueError(f"key columns missing from the frame: {missing}")

    def _insert(self, cursor, table: str, names: list[str], rows: list[tuple]) -> None:
        s = self.settings
        text = s.sql(f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join('?' for _ in names)})")
        for k in range(0, len(rows), s.rows):
            cursor.executemany(text, rows[k : k + s.rows])

    def _upsert_text(self) -> str:
        s, names = self.settings, [*self.schema.names, QUERY_COL, EPOCH_COL]
        insert = f"INSERT INTO {s.table} ({', '.join(names)}) VALUES ({', '.join('?' for _ in names)})"
        values = [n for n in names if n not in s.keys]
        if s.dialect == "mysql":
            newer = f"({QUERY_COL} <> VALUES({QUERY_COL}) OR {EPOCH_COL} <= VALUES({EPOCH_COL}))"
            # assignments take effect from left to right: the writer's columns come last
            return f"{insert} ON DUPLICATE KEY UPDATE " + ", ".join(f"{n} = IF({newer}, VALUES({n}), {n})" for n in values)
        newer = f"{s.table}.{QUERY_COL} <> excluded.{QUERY_COL} OR {s.table}.{EPOCH_COL} <= excluded.{EPOCH_COL}"
        return (f"{insert} ON CONFLICT ({', '.join(s.keys)}) DO UPDATE SET "
                + ", ".join(f"{n} = excluded.{n}" for n in values) + f" WHERE {newer}")

    def _keyed(self, cursor, batches, query: str, epoch: int) -> int:
        s, n = self.settings, 0
        upsert = s.sql(self._upsert_text()) if s.write == "upsert" else None
        match = " AND ".join(f"{k} = ?" for k in s.keys)
        at = [self.schema.names.index(k) for k in s.keys]
        own: dict[tuple, bool] = {}
        for batch in batches:
            rows = [(*row, query, epoch) for row in _rows(batch)]
            n += len(rows)
            if upsert is None:
                for row in rows:
                    group = tuple(row[k] for k in at)
                    if group not in own:
                        cursor.execute(s.sql(f"SELECT MAX({EPOCH_COL}) FROM {s.table} WHERE {match} AND {QUERY_COL} = ?"), (*group, query))
                        last = cursor.fetchall()[0][0]
                        own[group] = last is None or last <= epoch
                        if own[group]:
                            cursor.execute(s.sql(f"DELETE FROM {s.table} WHERE {match}"), group)
                self._insert(cursor, s.table, [*self.schema.names, QUERY_COL, EPOCH_COL], [r for r in rows if own[tuple(r[k] for k in at)]])
            else:
                for k in range(0, len(rows), s.rows):
                    cursor.executemany(upsert, rows[k : k + s.rows])
        return n


class _BatchWriter(_Writer, DataSourceArrowWriter):
    def __init__(self, settings: _Settings, schema: T.StructType):
        super().__init__(settings, schema)
        self.job = uuid.uuid4().hex
        self.staged = f"{settings.table}__staged"
        if settings.once:
            _create_epochs(settings)
        if settings.write == "append":
            with settings.transaction() as cursor:
                cursor.execute(f"CREATE TABLE IF NOT EXISTS {self.staged} ({', '.join([*_columns(schema), 'job VARCHAR(40)', _TOKEN])})")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        s, token, n = self.settings, uuid.uuid4().hex, 0
        with s.transaction() as cursor:
            if s.write != "append":
                if s.once and _whole(cursor, s, s.query, s.epoch):
                    return _Replayed(token, 0, s.query)
                return _Accepted(token, self._keyed(cursor, iterator, s.query, s.epoch), s.query)
            for batch in iterator:
                rows = [(*row, self.job, token) for row in _rows(batch)]
                self._insert(cursor, self.staged, [*self.schema.names, "job", TOKEN_COL], rows)
                n += len(rows)
        return _Written(token, n)

    def commit(self, messages) -> None:
        s = self.settings
        if s.write != "append":
            if s.once:
                with s.transaction() as cursor:
                    _note_epoch(cursor, s, s.query, s.epoch, messages)
            return
        names = ", ".join(self.schema.names)
        with s.transaction() as cursor:
            if s.scope is not None:
                match = " AND ".join(f"{k} = ?" for k in s.scope)
                cursor.execute(s.sql(f"DELETE FROM {s.table}" + (f" WHERE {match}" if match else "")), [_plain(v) for v in s.scope.values()])
            move = s.sql(f"INSERT INTO {s.table} ({names}) SELECT {names} FROM {self.staged} WHERE {TOKEN_COL} = ?")
            for message in messages:
                if message is not None and message.rows:
                    cursor.execute(move, (message.token,))
            cursor.execute(s.sql(f"DELETE FROM {self.staged} WHERE job = ?"), (self.job,))

    def abort(self, messages) -> None:
        """The target was not touched; the job's staged rows go.  (Keyed writes are repeated by the next run.)"""
        if self.settings.write == "append":
            with self.settings.transaction() as cursor:
                cursor.execute(self.settings.sql(f"DELETE FROM {self.staged} WHERE job = ?"), (self.job,))


def _whole(cursor, s: _Settings, query: str, epoch: int) -> bool:
    cursor.execute(s.sql(f"SELECT 1 FROM {EPOCHS} WHERE target = ? AND query = ? AND epoch = ?"), (s.table, query, epoch))
    return bool(cursor.fetchall())


def _create_epochs(s: _Settings) -> None:
    with s.transaction() as cursor:
        cursor.execute(f"CREATE TABLE IF NOT EXISTS {EPOCHS} (target VARCHAR(200), query VARCHAR(200), epoch BIGINT, "
                       "n_rows BIGINT, PRIMARY KEY (target, query, epoch))")


def _note_epoch(cursor, s: _Settings, query: str, epoch: int, messages) -> None:
    """The epoch is whole, unless it was before."""
    messages = [m for m in messages if m is not None]
    if not any(isinstance(m, _Replayed) for m in messages) and not _whole(cursor, s, query, epoch):
        cursor.execute(s.sql(f"INSERT INTO {EPOCHS} (target, query, epoch, n_rows) VALUES (?, ?, ?, ?)"),
                       (s.table, query, epoch, sum(m.rows for m in messages)))


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def __init__(self, settings: _Settings, schema: T.StructType):
        super().__init__(settings, schema)
        _create_epochs(settings)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        s, token = self.settings, uuid.uuid4().hex
        context = TaskContext.get()
        query, epoch = context.getLocalProperty(_QUERY_PROPERTY), int(context.getLocalProperty(_BATCH_PROPERTY))
        with s.transaction() as cursor:
            if _whole(cursor, s, query, epoch):
                return _Replayed(token, 0, query)
            if s.write != "append":
                return _Accepted(token, self._keyed(cursor, iterator, query, epoch), query)
            n = 0
            for batch in iterator:
                rows = [(*row, query, epoch, token) for row in _rows(batch)]
                self._insert(cursor, s.table, [*self.schema.names, QUERY_COL, EPOCH_COL, TOKEN_COL], rows)
                n += len(rows)
        return _Accepted(token, n, query)

    def commit(self, messages, batchId: int) -> None:  # noqa: N803 - Spark's name
        s = self.settings
        messages = [m for m in messages if m is not None]
        if not messages or any(isinstance(m, _Replayed) for m in messages):
            return
        query = messages[0].query
        with s.transaction() as cursor:
            if _whole(cursor, s, query, batchId):
                return
            if s.write == "append":
                self._drop_others(cursor, query, batchId, [m.token for m in messages])
            _note_epoch(cursor, s, query, batchId, messages)

    def _drop_others(self, cursor, query: str, epoch: int, tokens: list[str]) -> None:
        """Rows of attempts that Spark did not accept (retries, lost tasks, an earlier start of this epoch)."""
        s = self.settings
        cursor.execute(s.sql(f"SELECT DISTINCT {TOKEN_COL} FROM {s.table} WHERE {QUERY_COL} = ? AND {EPOCH_COL} = ?"), (query, epoch))
        for (token,) in cursor.fetchall():
            if token not in set(tokens):
                cursor.execute(s.sql(f"DELETE FROM {s.table} WHERE {QUERY_COL} = ? AND {EPOCH_COL} = ? AND {TOKEN_COL} = ?"), (query, epoch, token))

    def abort(self, messages, batchId: int) -> None:  # noqa: N803 - Spark's name
        """Rows of the epoch stay unseen or are written again with it: nothing to undo."""


@dataclass
class _Accepted(_Written):
    query: str


@dataclass
class _Replayed(_Written):
    query: str


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed into the database."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DatabaseSource)


def _activate(spark: SparkSession) -> None:
    """Spark looks formats up in the thread's active session, which threads of the application lack until they
    make a frame."""
    spark.createDataFrame([], "one int")


def stream_query(spark: SparkSession) -> str:
    """Inside ``foreachBatch``: the running query's id, the same as long as its checkpoint lives."""
    return spark.sparkContext.getLocalProperty(_QUERY_PROPERTY)


@dataclass(frozen=True)
class Database:
    """One database: ``connect`` are the arguments of ``module.connect``; ``dialect`` is ``ansi`` (``ON CONFLICT``:
    PostgreSQL, SQLite) or ``mysql``.  All writes may be repeated without changing the result, but for a plain
    ``append`` without scope."""

    connect: dict = field(default_factory=dict)
    module: str = "sqlite3"
    dialect: str = "ansi"

    def options(self, table: str, **more) -> dict[str, str]:
        return {"module": self.module, "connect": json.dumps(self.connect), "dialect": self.dialect, "table": table,
                **{k: v if isinstance(v, str) else json.dumps(v) for k, v in more.items()}}

    def run(self, *statements: str) -> None:
        """The statements in one transaction."""
        with _Settings(self.options("")).transaction() as cursor:
            for text in statements:
                cursor.execute(text)

    def create_table(self, table: str, schema: T.StructType, keys: Sequence[str] = (), streamed: bool = False) -> None:
        """The table if it is missing.  Keyed and streamed tables know who wrote a row."""
        columns = _columns(schema) + (_WRITTEN if keys or streamed else []) + ([_TOKEN] if streamed and not keys else [])
        primary = [f"PRIMARY KEY ({', '.join(keys)})"] if keys else []
        self.run(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns + primary)})")

    def read(self, spark: SparkSession, table: str, schema: T.StructType | str, partition_column: str | None = None,
             partitions: int = 1, committed: bool = False) -> DataFrame:
        """A table, or a part of its columns, in ``partitions`` ranges of an integer column.  The database is asked
        again at every execution, so also in every micro-batch that joins with it."""
        options = self.options(table, numPartitions=str(partitions), committed=str(committed).lower())
        if partition_column:
            options["partitionColumn"] = partition_column
        return spark.read.format(FORMAT).options(**options).schema(schema).load()

    def append(self, df: DataFrame, table: str, scope: dict | None = None) -> None:
        """All rows or none; with ``scope`` (column values) they replace the rows that have these values."""
        more = {} if scope is None else {"scope": scope}
        _activate(df.sparkSession)
        df.write.format(FORMAT).options(**self.options(table, **more)).mode("append").save()

    def upsert(self, df: DataFrame, table: str, keys: Sequence[str], epoch: int = -1, query: str = BATCH_JOB, once: bool = False) -> None:
        """Insert or replace by ``keys``; ``epoch`` of ``query`` keeps an older write from replacing a newer one, and
        ``once`` notes the epoch as whole and skips it from then on."""
        self._keyed(df, table, "upsert", keys, epoch, query, once)

    def replace_groups(self, df: DataFrame, table: str, keys: Sequence[str], epoch: int = -1, query: str = BATCH_JOB, once: bool = False) -> None:
        """Replace every group of ``keys`` in ``df`` by its rows: a group is written by one task, in one transaction."""
        self._keyed(df.repartition(*keys), table, "groups", keys, epoch, query, once)

    def _keyed(self, df: DataFrame, table: str, write: str, keys: Sequence[str], epoch: int, query: str, once: bool) -> None:
        _activate(df.sparkSession)
        options = self.options(table, write=write, keys=",".join(keys), epoch=str(epoch), query=query, once=str(once).lower())
        df.write.format(FORMAT).options(**options).mode("append").save()

    def stream(self, frame: DataFrame, table: str, checkpoint: str, keys: Sequence[str] = (), mode: str = "append"):
        """A stream writer into ``table``: an upsert by ``keys`` (running totals in ``update`` mode too), or an append of
        whole epochs."""
        writer = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        if mode == "update":
            return writer.foreachBatch(lambda rows, epoch: self.upsert(rows, table, keys, epoch, stream_query(rows.sparkSession), once=True))
        more = {"write": "upsert", "keys": ",".join(keys)} if keys else {}
        return writer.format(FORMAT).options(**self.options(table, **more))

    def ad_writer(self, query: str = BATCH_JOB):
        """A ``write_table(name, rows, batch_id)`` for the ad tables: ranked groups are replaced, the others upserted."""
        def write(name: str, rows: DataFrame, batch_id: int) -> None:
            if name == "ad_province_top3":
                self.create_table(name, rows.schema, TABLE_KEYS[name])
                self.replace_groups(rows, name, TABLE_KEYS["ad_province_groups"], batch_id, f"{query}:{name}")
            else:
                self.create_table(name, rows.schema, TABLE_KEYS[name])
                self.upsert(rows, name, TABLE_KEYS[name], batch_id, f"{query}:{name}")

        return write

    def task_writer(self, task_id: int):
        """A ``write_table(name, rows)`` for the session tables: the rows of the task are replaced, also by none."""
        def write(name: str, rows: DataFrame) -> None:
            self.create_table(name, rows.schema)
            self.append(rows, name, {"task_id": task_id})

        return write
