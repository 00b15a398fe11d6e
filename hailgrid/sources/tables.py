"""Result tables under one storage root, on any file system Spark can reach."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import tempfile
import uuid
import weakref
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from hailgrid.schemas import FOLDERS, RESULT_SCHEMAS


class MissingInput(RuntimeError):
    """A table a job needs is absent, empty or lacks columns."""


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingInput(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise MissingInput(f"table {name} is empty")
    return df


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark can reach; none there is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _folder(names: list[str], values: tuple) -> str:
    """The folder of a partition below its table, for values that need no escaping."""
    parts = [f"{name}={value}" for name, value in zip(names, values, strict=True)]
    for part in parts:
        if not re.fullmatch(r"[\w.-]+=[\w. -]+", part):
            raise ValueError(f"not a plain partition value: {part}")
    return "/".join(parts)


class ResultStore:
    """Named tables, models and CSV reports below ``base`` (any Hadoop URI)."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{FOLDERS.get(name, name)}"

    def write(
        self,
        df: DataFrame,
        name: str,
        date_column: str | None = None,
        in_date_order: bool = False,
        partition_by: list[str] | None = None,
    ) -> DataFrame:
        """Overwrite a Parquet table and return it as read back.

        A date-partitioned table is rebalanced on the date first: each date
        then goes to few files instead of one per input task, a date holding
        much of the data is still spread over several tasks, and later
        groupings by hour combine almost everything before their shuffle.
        Input that already comes in date order does not need that shuffle.
        ``partition_by`` writes partitions of any columns as the rows come.
        """
        if date_column is not None:
            df = df if in_date_order else df.hint("rebalance", date_column)
            partition_by = [date_column]
        df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def replace(self, df: DataFrame, name: str, partition_by: list[str], scope: list[tuple] | None = None) -> DataFrame:
        """Replace single partitions of a table and leave the others alone; makes the table if there is none.

        Every partition that occurs in ``df`` afterwards holds exactly its rows
        (nothing is swapped in before all are written). ``scope`` lists the
        partitions to replace, as tuples of values: a row outside it stops the
        job, and one without rows is emptied. Repeating a call changes nothing.
        """
        folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_by])
        if scope is not None:
            wanted = [_folder(partition_by, values) for values in scope]
            outside = F.when(~F.coalesce(folder.isin(wanted), F.lit(False)), F.raise_error(F.concat(F.lit(f"{name}: row outside the partitions to replace: "), folder)))
            df = df.filter(outside.cast("boolean").isNull())
        written = Observation(name)
        rows = df.hint("rebalance", *partition_by).observe(written, F.collect_set(folder).alias("folders"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(self.path(name))
        if scope is not None:
            for empty in sorted(set(wanted) - set(written.get["folders"])):
                delete(self.spark, f"{self.path(name)}/{empty}")
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def exists(self, name: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def read(self, name: str) -> DataFrame:
        """Read a Parquet table; the declared schema spares the footer scan where there is one."""
        reader = self.spark.read
        if name in RESULT_SCHEMAS:
            reader = reader.schema(RESULT_SCHEMAS[name])
        return reader.parquet(self.path(name))

    def write_csv(self, df: DataFrame, name: str) -> DataFrame:
        """Write any table with a header line; a name without a declared schema reads back with its own."""
        df.write.mode("overwrite").option("header", True).csv(self.path(name))
        return self.read_csv(name, RESULT_SCHEMAS.get(name, df.schema))

    def read_csv(self, name: str, schema: str | StructType | None = None) -> DataFrame:
        """Read a report directory: Spark skips the header of every part file and checks its names."""
        return (
            self.spark.read.schema(schema or RESULT_SCHEMAS[name])
            .option("header", True)
            .option("enforceSchema", False)
            .csv(self.path(name))
        )

    def require(self, *names: str) -> list[DataFrame]:
        """Open several tables, or stop with one message naming the first that is missing or empty."""
        tables = []
        for name in names:
            try:
                tables.append(require_rows(self.read(name), name))
            except AnalysisException as error:
                raise MissingInput(f"table {name} cannot be read from {self.path(name)}") from error
        return tables


class ScratchStore(ResultStore):
    """Tables of one computation below the shared folder; each is deleted when nothing can read it any more.

    A table lives as long as this object, or a plan that reads it, can be
    reached: a DataFrame of the caller, one derived from it, or a query that is
    running. The JVM tells when the list of a table's files is gone; the folder
    is then deleted when the next scratch store is made, ``sweep_scratch`` is
    called, or the process ends.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        super().__init__(spark, base)
        _FOLDERS[self.base] = _Folder(weakref.ref(self))

    def write(self, df: DataFrame, name: str, **layout) -> DataFrame:
        return leased(super().write(df, name, **layout), self.path(name))

    def replace(self, df: DataFrame, name: str, *partitions) -> DataFrame:
        return leased(super().replace(df, name, *partitions), self.path(name))

    def read(self, name: str) -> DataFrame:
        return leased(super().read(name), self.path(name))

    def read_csv(self, name: str, schema: str | StructType | None = None) -> DataFrame:
        return leased(super().read_csv(name, schema), self.path(name))


@dataclass
class _Folder:
    """A folder handed out: its store (none: it stays until the process ends), and each table's readers."""

    store: weakref.ref | None = None
    tables: dict[str, list] = field(default_factory=dict)

    @property
    def is_open(self) -> bool:
        return self.store is None or self.store() is not None


_FOLDERS: dict[str, _Folder] = {}


def leased(table: DataFrame, path: str) -> DataFrame:
    """Note that the plans made from ``table`` read the files at ``path``, which is in a scratch folder."""
    files = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    reader = table.sparkSession._jvm.java.lang.ref.WeakReference(files)
    for base, folder in _FOLDERS.items():
        if path == base or path.startswith(f"{base}/"):
            folder.tables.setdefault(path, []).append(reader)
    return table


def is_held(path: str) -> bool:
    """Whether ``path`` is below a folder of this process that was not removed."""
    return any(path.startswith(f"{folder}/") for folder in _FOLDERS)


def sweep_scratch(spark: SparkSession, collect: bool = False) -> list[str]:
    """Delete the scratch folders whose stores are gone and whose tables nothing can read; returns those that stay.

    ``collect`` asks Python and the JVM to look for unreachable objects first;
    without it, folders go when both have done so by themselves.
    """
    if collect:
        gc.collect()
        spark._jvm.System.gc()
    for base, folder in list(_FOLDERS.items()):
        if not folder.is_open and all(r.refersTo(None) for readers in folder.tables.values() for r in readers):
            delete(spark, base)
            del _FOLDERS[base]
    return [base for base, folder in _FOLDERS.items() if folder.store is not None]


def remove_scratch(spark: SparkSession) -> None:
    """Delete all folders that were handed out in this process, read or not."""
    while _FOLDERS:
        delete(spark, _FOLDERS.popitem()[0])


def _leave(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        remove_scratch(spark)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to its own disk. The
    folder is deleted when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise MissingInput("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="hailgrid-")
    if not _FOLDERS:
        atexit.register(_leave, spark)
    folder = f"{root.rstrip('/')}/hailgrid/{label}-{uuid.uuid4().hex}"
    _FOLDERS[folder] = _Folder()
    return folder


def scratch_store(spark: SparkSession, label: str) -> ScratchStore:
    """A store for intermediate tables; folders of earlier ones that nothing reads any more are deleted."""
    sweep_scratch(spark)
    return ScratchStore(spark, shared_folder(spark, label))
