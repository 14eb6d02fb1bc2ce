"""A relational database as a sink: batches into staging tables, then one transaction.

Tasks write their partitions side by side through JDBC, so many rows a statement. A database inside a
process (Derby without a server) is no other process's: there tasks write files in the shared folder, and
the database imports a file a table with its own bulk loader, one at a time while others are written.
Nothing that readers of the database see changes before all is staged and counted; then one transaction
empties the tables in reverse order of their references and fills them again, checked by the database's
own keys. In a database inside the process, which logs and indexes such rows one by one, the staged
tables take the places of the old ones instead and get their references there, in one transaction too; it
does so only where the database holds nothing but the five tables as they were made, else they are
emptied and filled.
"""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleError
from ..files import Store, each
from ..schemas import BUILT, CANON_STATUS, EDGE_KINDS, FOREIGN_KEYS, KEYS, LANGUAGES, TABLES
from ..scratch import fresh_path
from .tables import snake

#: Rows of a statement.
BATCH = 2000
#: Closed vocabularies, as checks.
_CLOSED = {("canonical_verses", "canonStatus"): CANON_STATUS, ("strongs", "language"): LANGUAGES, ("edges", "kind"): EDGE_KINDS}
_KINDS = {T.IntegerType(): "INTEGER", T.BooleanType(): "BOOLEAN", T.DoubleType(): "DOUBLE PRECISION", T.TimestampType(): "TIMESTAMP"}
#: Characters of a key, and of any other text.
KEY_LENGTH, TEXT_LENGTH = 100, 32_000


def array_literal(values: Column) -> Column:
    """{"a","b"}: a text array in the database's notation; quotes and backslashes are escaped, null stays."""
    quoted = F.transform(values, lambda v: F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    return F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))


def vector_literal(values: Column) -> Column:
    """[1.0,2.0]: a vector in the database's notation; null stays."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: v.cast("string")), ","), F.lit("]"))


def _fields(table: str) -> list[T.StructField]:
    more = [T.StructField("embedding", T.ArrayType(T.DoubleType()), True)] if table == "verse_texts" else []
    return [*TABLES[table].fields, *more]


def encoded(df: DataFrame, table: str) -> DataFrame:
    """The table's columns under their relational names, arrays as literals; a column that the rows lack is null."""
    out = []
    for f in _fields(table):
        value = F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.ArrayType):
            value = vector_literal(value) if f.dataType.elementType == T.DoubleType() else array_literal(value)
        out.append(value.alias(snake(f.name)))
    return df.select(*out)


def _kind(table: str, f: T.StructField) -> str:
    keyed = f.name in KEYS[table] or any(f.name in (c if child == table else "", k if parent == table else "") for child, c, parent, k in FOREIGN_KEYS)
    return _KINDS.get(f.dataType) or f"VARCHAR({KEY_LENGTH if keyed else TEXT_LENGTH})"


def _column(f: T.StructField, table: str) -> str:
    return f'"{snake(f.name)}" {_kind(table, f)}{"" if f.nullable else " NOT NULL"}'


def _primary(table: str) -> str:
    return f"""PRIMARY KEY ({", ".join(f'"{snake(k)}"' for k in KEYS[table])})"""


def _constraints(table: str) -> list[str]:
    """Closed vocabularies and references."""
    closed = [f"""CHECK ("{snake(c)}" IN ({", ".join(f"'{v}'" for v in values)}))""" for (of, c), values in _CLOSED.items() if of == table]
    return closed + [f'FOREIGN KEY ("{snake(c)}") REFERENCES {parent} ("{snake(k)}")' for child, c, parent, k in FOREIGN_KEYS if child == table and parent in BUILT]


def _create(name: str, table: str, more: Iterable[str]) -> str:
    return f"CREATE TABLE {name} ({', '.join([*(_column(f, table) for f in _fields(table)), *more])})"


def ddl(table: str) -> str:
    """The table with its types, nulls, closed vocabularies, key and references."""
    return _create(table, table, [_primary(table), *_constraints(table)])


@contextmanager
def transaction(spark: SparkSession, url: str, driver: str):
    """A connection of the driver's; what is done in it counts if nothing fails."""
    spark._jvm.java.lang.Class.forName(driver)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        yield connection.createStatement()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _there(statement, table: str) -> bool:
    found = statement.getConnection().getMetaData().getTables(None, None, table.upper(), None)
    return found.next()


def _count(statement, table: str) -> int:
    rows = statement.executeQuery(f"SELECT count(*) FROM {table}")
    rows.next()
    return rows.getLong(1)


def create(spark: SparkSession, url: str, driver: str) -> None:
    """The tables that are not there yet."""
    with transaction(spark, url, driver) as statement:
        for table in BUILT:
            if not _there(statement, table):
                statement.execute(ddl(table))


def in_process(url: str) -> bool:
    """The database is inside the driver's process, where tasks of other processes can't reach it."""
    return url.startswith("jdbc:derby:") and not url.startswith("jdbc:derby://")


def delimited(df: DataFrame) -> DataFrame:
    """(line) of each row for the bulk loader: all values quoted, quotes doubled, nulls without quotes."""
    quoted = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(",", *quoted).alias("line"))


def _import(spark: SparkSession, df: DataFrame, table: str, url: str, driver: str, alone: threading.Lock) -> None:
    """The rows of df, encoded, into the empty table__staged of a database inside the driver's process: files written by tasks in the order of the key, then one on the driver's disk, as the loader fills an empty table without logging its rows and sorts its key at the end."""
    path = fresh_path(spark, "import")
    store = Store(spark, path)
    try:
        delimited(df.orderBy(*[snake(k) for k in KEYS[table]])).write.text(path)
        with tempfile.TemporaryDirectory() as local:
            store.gather([f"{path}/{name}" for name in store.names(path)], f"{local}/rows")
            with alone, transaction(spark, url, driver) as statement:
                statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table.upper()}__STAGED', '{local}/rows', ',', '\"', 'UTF-8', 0)")
    finally:
        store.delete(path)


def _stage(spark: SparkSession, tables: dict[str, DataFrame], url: str, driver: str) -> None:
    """All tables as staged ones of a database inside the driver's process. Files are written side by side; the database makes and fills one table at a time, as imports change its catalogue and may wait for each other without end."""
    with transaction(spark, url, driver) as statement:
        for table in BUILT:
            if _there(statement, f"{table}__staged"):
                statement.execute(f"DROP TABLE {table}__staged")
            statement.execute(_create(f"{table}__staged", table, [_primary(table)]))
    alone = threading.Lock()
    each(lambda table: _import(spark, encoded(tables[table], table), table, url, driver, alone), BUILT)


def _plain(statement) -> bool:
    """A database inside the process holds the tables as they were made, and nothing that depends on them: no other table or view, no trigger, grant, index, column or constraint of somebody's."""
    def number(sql: str) -> int:
        rows = statement.executeQuery(sql)
        rows.next()
        return rows.getLong(1)

    names = ", ".join(f"'{t.upper()}{end}'" for t in BUILT for end in ("", "__STAGED"))
    built = f"""(SELECT TABLEID FROM SYS.SYSTABLES WHERE TABLENAME IN ({", ".join(f"'{t.upper()}'" for t in BUILT)}))"""
    foreign = number(f"SELECT count(*) FROM SYS.SYSTABLES WHERE TABLETYPE <> 'S' AND TABLENAME NOT IN ({names})") + number("SELECT count(*) FROM SYS.SYSTRIGGERS") + number("SELECT count(*) FROM SYS.SYSTABLEPERMS") + number("SELECT count(*) FROM SYS.SYSCOLPERMS")
    foreign += number(f"SELECT count(*) FROM SYS.SYSCONGLOMERATES WHERE TABLEID IN {built} AND ISINDEX AND NOT ISCONSTRAINT")
    columns, keys = sum(len(_fields(t)) for t in BUILT), sum(1 + len(_constraints(t)) for t in BUILT)
    return foreign == 0 and number(f"SELECT count(*) FROM SYS.SYSCOLUMNS WHERE REFERENCEID IN {built}") == columns and number(f"SELECT count(*) FROM SYS.SYSCONSTRAINTS WHERE TABLEID IN {built}") == keys


def _take_places(statement) -> None:
    """The staged tables instead of the old ones, with their vocabularies and references, which the database checks as it adds them."""
    for table in reversed(BUILT):
        statement.execute(f"DROP TABLE {table}")
    for table in BUILT:
        statement.execute(f"RENAME TABLE {table}__staged TO {table}")
    for table in BUILT:
        for constraint in _constraints(table):
            statement.execute(f"ALTER TABLE {table} ADD {constraint}")


def _refill(statement) -> None:
    """The rows of the staged tables instead of the old ones."""
    for table in reversed(BUILT):
        statement.execute(f"DELETE FROM {table}")
    for table in BUILT:
        names = ", ".join(f'"{snake(f.name)}"' for f in _fields(table))
        casts = ", ".join(f'CAST("{snake(f.name)}" AS {_kind(table, f)})' for f in _fields(table))
        statement.execute(f"INSERT INTO {table} ({names}) SELECT {casts} FROM {table}__staged")
    for table in BUILT:
        statement.execute(f"DROP TABLE {table}__staged")


def load(spark: SparkSession, tables: dict[str, DataFrame], url: str, driver: str, batch: int = BATCH) -> dict[str, int]:
    """Replaces the rows of all tables in one transaction; returns their counts. A load that fails at any point leaves the old rows."""
    create(spark, url, driver)
    if in_process(url):
        _stage(spark, tables, url, driver)
    else:
        for table in BUILT:
            options = {"url": url, "driver": driver, "dbtable": f"{table}__staged", "batchsize": str(batch)}
            encoded(tables[table], table).write.format("jdbc").options(**options).mode("overwrite").save()
    wanted = {t: tables[t].count() for t in BUILT}
    with transaction(spark, url, driver) as statement:
        staged = {t: _count(statement, f"{t}__staged") for t in BUILT}
        if wrong := {t: n for t, n in staged.items() if n != wanted[t]}:
            raise RuleError("all rows are staged, each once", str(wrong))
        if in_process(url) and _plain(statement):
            _take_places(statement)
        else:
            _refill(statement)
    return staged


def close(spark: SparkSession, url: str, driver: str) -> None:
    """Shuts a database inside the driver's process down."""
    try:
        with transaction(spark, f"{url.split(';')[0]};shutdown=true", driver):
            pass
    except Exception as e:
        if "08006" not in str(e):  # what a database that has been shut down says
            raise


def counts(spark: SparkSession, url: str, driver: str) -> dict[str, int]:
    """Rows of each table, counted by the database."""
    with transaction(spark, url, driver) as statement:
        return {t: _count(statement, t) for t in BUILT}


def read(spark: SparkSession, table: str, url: str, driver: str) -> DataFrame:
    """A table of a database that tasks of all processes reach."""
    return spark.read.format("jdbc").options(url=url, driver=driver, dbtable=table).load()
