"""Gold tables in a relational database: replace a slice over JDBC.

Executors append to a staging table in parallel; the driver then runs delete + insert-select in one transaction, so
readers see the old slice or the new one and a lost executor cannot leave half a slice.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# JDBC write settings.
JDBC_WRITE = {"batchsize": "1000", "isolationLevel": "READ_COMMITTED", "driver": "org.postgresql.Driver"}

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def jdbc_url(host: str, port: int, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def typed_for_database(df: DataFrame) -> DataFrame:
    """Column types the gold tables of the database declare."""
    types = {"day": "date", "granularity": "int", "measure": "int", "city_rank": "int", "units": "double",
             "popularity_score": "double", "_gold_ingest_ts": "timestamp"}
    return df.withColumns({c: df[c].cast(t) for c, t in types.items() if c in df.columns})


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (bool, int, float)):
        return str(value)
    quoted = str(value).replace("'", "''")
    return f"DATE '{quoted}'" if isinstance(value, dt.date) and not isinstance(value, dt.datetime) else f"'{quoted}'"


def replace_statements(
    table: str, staging: str, columns: Sequence[str], slice_columns: Sequence[str], slices: Sequence[Mapping] = ()
) -> list[str]:
    """Delete the slices present in staging and those listed (null matches null), insert all staged rows, drop staging."""
    for name in (table, staging, *columns, *slice_columns):
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain SQL name: {name!r}")
    same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in slice_columns)
    listed = ", ".join(columns)
    named = [
        f"DELETE FROM {table} WHERE " + " AND ".join(f"{c} IS NOT DISTINCT FROM {_literal(s[c])}" for c in slice_columns)
        for s in slices
    ]
    return [
        *named,
        f"DELETE FROM {table} t WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})",
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging}",
        f"DROP TABLE {staging}",
    ]


def run_in_transaction(connection, statements: Sequence[str]) -> None:
    """Run statements on a JDBC connection as one unit; any failure rolls all of them back."""
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.executeUpdate(text)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def replace_slice_in_database(
    df: DataFrame,
    url: str,
    table: str,
    user: str,
    password: str,
    slice_columns: Sequence[str],
    enabled: bool = True,
    settings: Mapping[str, str] = JDBC_WRITE,
    slices: Sequence[Mapping] = (),
    connections: int = 8,
) -> None:
    """Replace the slices of `df`, and those listed in `slices` even where `df` has no rows, in a database table.

    Disabled: nothing happens. At most `connections` tasks write at once. The staging table has a name of its own for each
    call, so two runs do not meet; a run that dies leaves it behind. Needs a session with a JVM of its own (not Connect).
    """
    if not enabled:
        return
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    typed = typed_for_database(df)
    login = {"user": user, "password": password, "numPartitions": str(connections), **settings}
    typed.write.mode("overwrite").jdbc(url, staging, properties=login)
    jvm = df.sparkSession._jvm
    jvm.java.lang.Class.forName(settings["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, user, password)
    run_in_transaction(connection, replace_statements(table, staging, typed.columns, slice_columns, slices))
