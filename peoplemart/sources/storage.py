"""Where intermediate tables go, and how tables are read and written."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from contextvars import ContextVar
from functools import partial
from threading import Lock

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition column of tables written by year; readers of the declared columns don't see it.
YEAR = "_anio"
# Partition column of tables that are appended to: the name of the batch.
BATCH = "_lote"
# Runs of neighbouring employees of a year are dealt into so many groups, so that a file holds all rows of an employee and
# year, and those of the 32,768 that share a bitmap.
_GROUPS = 16

# Of the Parquet files written here: keys and dates take some two thirds of what they take by the default.
_COMPRESSION = "zstd"

_staging: ContextVar[str | None] = ContextVar("staging", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    Only a local session, which has no other machine, falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="peoplemart-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/peoplemart-{label}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A table of a folder; a schema already known spares the job that looks it up."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def stored_bytes(spark: SparkSession, folder: str, names: Collection[str]) -> int:
    """The bytes of the files of some tables of a folder, in whatever store it is."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet") for name in names]
    return sum(path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength() for path in paths)


_counting: dict[str, SparkSession] = {}


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts, least and greatest values of Parquet tables come from
    the files' footers. Its options don't touch spark's own."""
    key = spark.sparkContext.applicationId
    if key not in _counting:
        session = spark.newSession()
        row_based = [name for name in session.conf.get("spark.sql.sources.useV1SourceList").split(",") if name != "parquet"]
        session.conf.set("spark.sql.sources.useV1SourceList", ",".join(row_based))
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        _counting[key] = session
    return _counting[key]


def write_table(df: DataFrame, folder: str, name: str, dated_by: str | None = None, cluster: str | None = None) -> int:
    """Overwrites folder/name.parquet and returns the rows written; see write_checked."""
    return write_checked(df, folder, name, (), dated_by, cluster)[0]


def write_checked(df: DataFrame, folder: str, name: str, rules: Sequence[tuple[str, Column]], dated_by: str | None = None,
                  cluster: str | None = None) -> tuple[int, dict[str, int]]:
    """Overwrites folder/name.parquet. Returns the rows written and, for each rule (a label and a condition), the rows for
    which it is false, all counted during the write.

    dated_by, a column of numbers like 20241231, makes a folder for each year, and cluster sorts the
    rows inside. Adaptive execution joins small years into one task and splits large ones.
    """
    loaded = Observation(f"load {name}")
    broken = [F.count(F.when(~holds, 1)).alias(f"_{i}") for i, (_, holds) in enumerate(rules)]
    counted = df.observe(loaded, F.count(F.lit(1)).alias("Registros"), *broken)
    path = f"{folder}/{name}.parquet"
    if dated_by is None:
        counted.write.mode("overwrite").option("compression", _COMPRESSION).parquet(path)
    else:
        dealt = counted.withColumn(YEAR, (F.col(dated_by) / 10000).cast("int")).withColumn(
            "_group", F.pmod(F.hash(F.bitmap_bucket_number(cluster)), F.lit(_GROUPS)))
        dealt = dealt.hint("rebalance", F.col(YEAR), F.col("_group")).drop("_group").sortWithinPartitions(YEAR, cluster)
        dealt.write.mode("overwrite").partitionBy(YEAR).option("compression", _COMPRESSION).parquet(path)
    found = loaded.get
    return int(found.get("Registros", 0)), {label: int(found.get(f"_{i}", 0)) for i, (label, _) in enumerate(rules)}


def write_bucketed(df: DataFrame, namespace: str, name: str, key: str, buckets: int) -> None:
    """Writes df as a table of the catalog, dealt by key into so many files, each sorted by it. Tables dealt alike are
    joined and grouped by the key without a shuffle; since no shuffle is left that adaptive execution could split, a key
    of very many rows is one task's work until it is folded."""
    dealt = df.repartition(buckets, key).write.mode("overwrite").option("compression", _COMPRESSION)
    dealt.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{namespace}.{name}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: short lineage, sizes known to the planner.

    A table made by Tables with a staging folder of its own is staged there.
    """
    home = _staging.get()
    folder = f"{home}/{uuid.uuid4().hex}" if home else new_folder(df.sparkSession, "stage")
    df.write.option("compression", _COMPRESSION).parquet(f"{folder}/{label}.parquet")
    return read_table(df.sparkSession, folder, label, df.schema)


def removed(spark: SparkSession, folder: str) -> bool:
    """Deletes a folder in whatever store it is; False if there was none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one of its name; whether it did. Readers see it complete or not at all, and of
    several writers at once one succeeds: by a hard link on a local disk, elsewhere by a rename that replaces nothing."""
    files = spark._jvm.org.apache.hadoop.fs
    target = files.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = files.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
            spark._jvm.java.nio.file.Files.createLink(*local)
        else:
            _renamed(spark, draft, target)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(draft, False)


def _renamed(spark: SparkSession, source, target) -> None:
    """Renames a file in whatever store it is; an error if target is there."""
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.valueOf("NONE")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def append_batch(df: DataFrame, folder: str, name: str, batch: str) -> int:
    """Appends df to folder/name.parquet as the batch of that name (letters, digits, '.', '_', '-') and returns its rows.

    A batch that is appended again, for instance after a failure, takes the place of its former rows; other batches
    aren't touched. Each batch is a folder of its own, replaced when all its files are written."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"not a name for a batch: {batch!r}")
    loaded = Observation(f"append {name}")
    rows = df.observe(loaded, F.count(F.lit(1)).alias("Registros")).withColumn(BATCH, F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{folder}/{name}.parquet")
    found = int(loaded.get.get("Registros", 0))
    if not found:  # no row replaces former ones
        removed(df.sparkSession, f"{folder}/{name}.parquet/{BATCH}={batch}")
    return found


def appended_table(spark: SparkSession, folder: str, name: str, schema: T.StructType, batches: Collection[str] | None = None) -> DataFrame:
    """The rows of all batches, or of those named, whose folders alone are read."""
    stored = read_table(spark, folder, name, T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())]))
    return (stored if batches is None else stored.filter(F.col(BATCH).isin(*batches))).select(schema.names)


def numbers_up_to(spark: SparkSession, last: int) -> DataFrame:
    """The numbers 1..last in a column n."""
    return spark.range(1, last + 1).withColumnRenamed("id", "n")


class Tables(Mapping[str, DataFrame]):
    """Named tables, each made once, on first use by any thread."""

    staging: str | None = None  # where intermediate results of these tables go, if not to folders of their own

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in self._makers}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._made:
                before = _staging.set(self.staging)
                try:
                    self._made[name] = self._makers[name]()
                finally:
                    _staging.reset(before)
            return self._made[name]

    def in_years(self, name: str, first: int, last: int) -> DataFrame:
        """The rows of a table whose FechaKey lies in a closed range of years."""
        return self[name].filter(F.col("FechaKey").between(first * 10000 + 101, last * 10000 + 1231))

    def key_range(self, name: str, column: str) -> tuple[int, int] | None:
        """The least and greatest value that a key column can have, if that is known without reading rows."""
        return None

    def counted(self, name: str) -> DataFrame:
        """The table, for an aggregate without groups of COUNT, MIN and MAX: where it lies in files, these answer from
        their statistics, and no column is read."""
        return self[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def replaced(self, **tables: DataFrame | Callable[[], DataFrame]) -> Tables:
        """The same tables with some of them exchanged; what a function makes is made on first use."""
        return _Replaced(self, tables)


def counted(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Tables.counted, or the table itself of a plain mapping."""
    return tables.counted(name) if isinstance(tables, Tables) else tables[name]


class _Replaced(Tables):
    def __init__(self, former: Tables, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        super().__init__({**{name: (lambda n=name: former[n]) for name in former},
                          **{name: table if callable(table) else (lambda t=table: t) for name, table in tables.items()}})
        self._former, self._new = former, set(tables)

    def key_range(self, name: str, column: str) -> tuple[int, int] | None:
        return None if name in self._new else self._former.key_range(name, column)

    def counted(self, name: str) -> DataFrame:
        return self[name] if name in self._new else self._former.counted(name)


class SavedTables(Tables):
    """Tables in a folder. Those of dated were written by year, and a range of years reads its folders only."""

    def __init__(self, spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType], dated: Collection[str] = ()):
        super().__init__({name: partial(self._declared, name) for name in schemas})
        self.spark, self.folder, self.schemas, self.dated = spark, folder, schemas, dated
        self._ranges: dict[tuple[str, str], tuple[int, int] | None] = {}

    def _stored(self, name: str, spark: SparkSession | None = None) -> DataFrame:
        schema = self.schemas[name]
        if name in self.dated:
            schema = T.StructType([*schema.fields, T.StructField(YEAR, T.IntegerType())])
        return read_table(spark or self.spark, self.folder, name, schema)

    def counted(self, name: str) -> DataFrame:
        return self._stored(name, counting_session(self.spark)).select(self.schemas[name].names)

    def _declared(self, name: str) -> DataFrame:
        return self._stored(name).select(self.schemas[name].names)

    def key_range(self, name: str, column: str) -> tuple[int, int] | None:
        """Of whole numbers, from the files' statistics; one small job on first use."""
        if self.schemas[name][column].dataType.typeName() not in ("integer", "long"):
            return None
        if (name, column) not in self._ranges:
            found = self.counted(name).agg(F.min(column), F.max(column)).first()
            self._ranges[name, column] = None if found[0] is None else (found[0], found[1])
        return self._ranges[name, column]

    def in_years(self, name: str, first: int, last: int) -> DataFrame:
        if name not in self.dated:
            return super().in_years(name, first, last)
        return self._stored(name).filter(F.col(YEAR).between(first, last)).select(self.schemas[name].names)


def catalog_tables(spark: SparkSession, namespace: str, schemas: Mapping[str, T.StructType]) -> Tables:
    """Tables by name in a namespace of the session's catalog, with their declared columns, whatever store and format
    the catalog keeps them in: namespace may have several parts, such as catalog.schema."""
    parts = ".".join(f"`{part}`" for part in namespace.split("."))
    return Tables({name: (lambda n=name: spark.read.table(f"{parts}.`{n}`").select(schemas[n].names)) for name in schemas})


def saved_tables(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType], dated: Collection[str] = ()
) -> SavedTables:
    """Tables written before, for instance a mart that was loaded by an earlier application."""
    return SavedTables(spark, folder, schemas, dated)
