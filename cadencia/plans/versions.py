"""Tables whose contents are swapped as a whole.

A versioned table is a view over one complete version; replacing the view is a single statement of the catalog, so a reader gets the
old contents or the new ones, never a mix and never none. A version's files are not changed once it is published, and the
versions before stay for readers that began with them. Writers of a table exclude each other by a lease: an entry of the catalog
that only one of them can create.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from cadencia.session import delete_folder

_TABLE = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_-]*(\.[A-Za-z0-9_]+){1,2}")
_LOCK, _VERSION = "__lock", "cadencia.version"
#: Versions that stay after a swap, the new one included: a read may last as long as one swap to the next but one.
KEPT_VERSIONS = 3
#: Seconds after which the lock of a writer that died may be taken over.
LEASE = 6 * 3600

_held = threading.local()


def checked_name(name: str, label: str = "table") -> str:
    """``schema.table`` or ``catalog.schema.table``; anything that could carry SQL is refused."""
    if not isinstance(name, str) or not _TABLE.fullmatch(name):
        raise ValueError(f"{label} {name!r} is not of the form schema.table or catalog.schema.table")
    return name


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in checked_name(name).split("."))


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def as_properties(values: Mapping[str, object]) -> str:
    return ", ".join(f"'{k}'='{v}'" for k, v in values.items())


def data_folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table lie, next to the tables of its schema."""
    schema, name = table.rsplit(".", 1)
    place = spark.sql(f"DESCRIBE SCHEMA {schema if '-' not in schema else quoted(schema)}").filter("info_name = 'Location'").first()
    return f"{place.info_value.rstrip('/')}/{name}__data"


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def current(spark: SparkSession, table: str) -> str | None:
    """The published version, None if the table has none."""
    return properties(spark, table).get(_VERSION) if is_view(spark, table) else None


def publish(spark: SparkSession, table: str, source: str, version: str, columns: list[str]) -> None:
    """Make ``source`` (a table or ``parquet.`path```) the contents of ``table``: one statement, refused if the lock was lost."""
    owner = getattr(_held, "owners", {}).get(table)
    if owner is None or _owner(spark, table) != owner:
        raise RuntimeError(f"the lock on {table} was lost; nothing was published")
    if spark.catalog.tableExists(table) and not is_view(spark, table):
        _set_aside(spark, table)
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(table)} TBLPROPERTIES ({as_properties({_VERSION: version})}) "
        f"AS SELECT {', '.join(f'`{c}`' for c in columns)} FROM {source}"
    )


def _set_aside(spark: SparkSession, table: str) -> None:
    """A plain table of an earlier release gives its name to the view, once; for that moment readers find neither."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table + '__plain')}")
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(table + '__plain')}")


def discard_plain(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table + '__plain')}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in one, oldest first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    found = [s for s in fs.listStatus(hadoop) if s.isDirectory()]
    return [s.getPath().getName() for s in sorted(found, key=lambda s: s.getModificationTime())]


def drop_folders(spark: SparkSession, path: str, keep: set[str]) -> None:
    for name in folders(spark, path):
        if name not in keep:
            delete_folder(spark, f"{path}/{name}")


def _owner(spark: SparkSession, table: str) -> str | None:
    try:
        return properties(spark, table + _LOCK).get("writer")
    except AnalysisException:  # gone between two looks
        return None


def _acquire(spark: SparkSession, table: str, lease: float) -> str:
    owner = uuid.uuid4().hex
    entry = f"CREATE TABLE {quoted(table + _LOCK)} (x int) USING parquet TBLPROPERTIES ({as_properties({'writer': owner, 'until': int(time.time() + lease)})})"
    for _ in range(2):
        try:
            spark.sql(entry)
        except AnalysisException as error:
            if error.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
            try:
                other = properties(spark, table + _LOCK)
            except AnalysisException:  # given back meanwhile
                continue
            if float(other["until"]) > time.time():
                raise RuntimeError(f"{table} is being changed by another run ({other['writer']}); its lock ends at {other['until']}") from error
            _take_over(spark, table, other["writer"])
        else:
            return owner
    raise RuntimeError(f"{table} is being changed by another run")


def _take_over(spark: SparkSession, table: str, stale: str) -> None:
    """Remove a lock whose lease has ended. Only one of several runs can rename it; if it was not the stale one, it is given back."""
    aside = f"{table}__lock_{uuid.uuid4().hex}"
    try:
        spark.sql(f"ALTER TABLE {quoted(table + _LOCK)} RENAME TO {quoted(aside)}")
    except AnalysisException:  # another run was faster
        return
    if properties(spark, aside).get("writer") != stale:
        spark.sql(f"ALTER TABLE {quoted(aside)} RENAME TO {quoted(table + _LOCK)}")
        return
    spark.sql(f"DROP TABLE {quoted(aside)}")


@contextmanager
def locked(spark: SparkSession, table: str, lease: float = LEASE) -> Iterator[None]:
    """The only writer of ``table`` while it lasts; inside itself it does nothing. A table in use is an error, not a wait."""
    owners = _held.__dict__.setdefault("owners", {})
    if checked_name(table) in owners:
        yield
        return
    owners[table] = _acquire(spark, table, lease)
    try:
        yield
    finally:
        if _owner(spark, table) == owners.pop(table):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(table + _LOCK)}")
