"""Stored tables: create, read, append, and coercion to a stored table's types."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schema
from cohortloom.functions.parse import to_day, to_float, to_int
from cohortloom.operators.joins import only_new
from cohortloom.session import children, exists, make_folder, remove, staged
from cohortloom.sources.extracts import read_extract

CONCEPT_TABLES = tuple(schema.VOCABULARY)
# Folder beside the tables that names the buckets of each.
LAYOUT = "layout"
# Parts of a derived table's state where the table itself has no buckets.
STATE_PARTS = 16


class Tables:
    """Tables held as DataFrames; one that was not given is empty."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self._frames = dict(frames or {})

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self._frames.get(table)
        if df is None:
            df = schema.empty_table(self.spark, table)
        return df.select(*columns) if columns else df

    def stage(self, df: DataFrame) -> DataFrame:
        """Hook for tables that keep a result that several joins use; here it stays lazy."""
        return df

    def is_empty(self, df: DataFrame) -> bool:
        """Whether a staged result is known to hold nothing; a lazy one is not looked at."""
        return False

    def only_new(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows whose id the table does not hold yet."""
        key = schema.key_of(table)
        return only_new(rows, self.read(table, [key]), key)

    def with_frames(self, **frames: DataFrame) -> Tables:
        return Tables(self.spark, {**self._frames, **frames})


class ParquetStore(Tables):
    """Data tables and vocabulary tables as parquet folders.

    The vocabulary may live below a root of its own, else it shares the data root.

    A data table is bucketed by its id, so that a load compares its new ids with the stored ones
    bucket by bucket and what is stored is not shuffled for it. ``buckets`` is chosen when the store
    is created (the number of shuffle partitions unless given) and kept beside the tables. A folder
    that was filled before there were buckets is read as it is, and shuffled.
    """

    def __init__(
        self, spark: SparkSession, root: str, vocabulary_root: str | None = None, buckets: int | None = None
    ):
        super().__init__(spark)
        self._root = root.rstrip("/")
        self._vocabulary = (vocabulary_root or root).rstrip("/")
        self._wanted = buckets
        self._known: dict[str, int] | None = None
        self._names: dict[str, str] = {}

    def path(self, table: str) -> str:
        base = self._root if table in schema.LOADED else self._vocabulary
        return f"{base}/{table}"

    def _layout(self) -> dict[str, int]:
        """Buckets of the tables that have any."""
        if self._known is None:
            names = children(self.spark, f"{self._root}/{LAYOUT}")
            self._known = {t: int(n) for t, n in (name.rsplit("-", 1) for name in names)}
        return self._known

    def create(self, tables: Iterable[str] | None = None) -> ParquetStore:
        """Make the folder of every table, so that a first load reads an empty target.

        Harmless where a table exists already.
        """
        buckets = self._wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for table in tables or [*schema.LOADED, *CONCEPT_TABLES]:
            if table not in schema.LOADED:
                schema.empty_table(self.spark, table).write.mode("append").parquet(self.path(table))
            elif not exists(self.spark, self.path(table)):
                make_folder(self.spark, f"{self._root}/{LAYOUT}/{table}-{buckets}")
                make_folder(self.spark, self.path(table))
        self._known = None
        return self

    def create_catalog(self, database: str) -> None:
        """Register the folders as tables of a Spark database."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for table in [*schema.LOADED, *CONCEPT_TABLES]:
            self.spark.sql(schema.create_statement(table, database, self.path(table)))

    def _bucketed(self, table: str) -> str | None:
        """Name under which the session knows a bucketed table; only tables, not paths, have buckets."""
        buckets = self._layout().get(table) if table in schema.LOADED else None
        if buckets is None:
            return None
        if table not in self._names:
            place = hashlib.sha256(f"{self._root}:{buckets}".encode()).hexdigest()[:16]
            name = f"{table}_{place}"
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.table_schema(table))
            key = schema.key_of(table)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
                f" CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{self.path(table)}'"
            )
            self._names[table] = name
        return self._names[table]

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        """A data table in its registry's columns, a vocabulary table in all that were stored."""
        name = self._bucketed(table)
        if name:
            self.spark.catalog.refreshTable(name)
            df = self.spark.table(name)
        elif table in schema.LOADED:
            df = self.spark.read.schema(schema.table_schema(table)).parquet(self.path(table))
        else:
            df = self.spark.read.option("mergeSchema", True).parquet(self.path(table))
        return df.select(*columns) if columns else df

    def only_new(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows whose id the table does not hold yet; what is stored stays where it is.

        With fewer buckets than shuffle partitions Spark would shuffle the stored ids to the latter,
        so the rows, of which there is one for each id by now, are dealt into the buckets before. An
        anti join would be planned below that, hence the outer one.
        """
        buckets = self._layout().get(table) if table in schema.LOADED else None
        if not buckets or buckets >= int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            return super().only_new(rows, table)
        key = schema.key_of(table)
        held = self.read(table, [key]).withColumn("_held", F.lit(True))
        joined = rows.repartition(buckets, key).join(held, key, "left").filter(F.col("_held").isNull())
        return joined.select(*rows.columns)

    def stage(self, df: DataFrame) -> DataFrame:
        """Write a result to the shared scratch folder and go on from there."""
        return staged(df)

    def is_empty(self, df: DataFrame) -> bool:
        return df.isEmpty()

    def append(self, table: str, rows: DataFrame) -> None:
        """Append in table order; a bucketed table's rows are dealt into its buckets.

        A vocabulary table takes further columns, too, and null for those that are missing.
        """
        if table in schema.LOADED:
            rows = rows.select(*[f.name for f in schema.table_schema(table)])
        else:
            rows = conform_vocabulary(rows, table)
        self._write(table, rows, overwrite=False)

    def replace(self, table: str, rows: DataFrame) -> None:
        """Overwrite a table that the rows were not read from."""
        self._write(table, rows.select(*[f.name for f in schema.table_schema(table)]), overwrite=True)

    def _write(self, table: str, rows: DataFrame, overwrite: bool) -> None:
        name = self._bucketed(table)
        if name:
            dealt = rows.repartition(self._layout()[table], schema.key_of(table))
            dealt.write.insertInto(name, overwrite=overwrite)
        else:
            rows.write.mode("overwrite" if overwrite else "append").parquet(self.path(table))

    # --- loads under way ---

    def _log(self, table: str) -> str:
        return f"{self._root}/{table}-pending"

    def log(self, table: str, rows: DataFrame) -> str:
        """Write down the new rows of a load before any table gets them; returns the load's name."""
        load = uuid.uuid4().hex
        rows = rows.select(*[f.name for f in schema.table_schema(table)])
        rows.write.parquet(f"{self._log(table)}/{load}")
        return load

    def logged(self, table: str, load: str) -> DataFrame:
        return self.spark.read.schema(schema.table_schema(table)).parquet(f"{self._log(table)}/{load}")

    def loads_under_way(self, table: str) -> list[str]:
        """Loads that were written down and not finished; what was only half written down goes."""
        whole = []
        for load in children(self.spark, self._log(table)):
            path = f"{self._log(table)}/{load}"
            if exists(self.spark, f"{path}/_SUCCESS"):
                whole.append(load)
            else:
                remove(self.spark, path)
        return whole

    def finish(self, table: str, load: str) -> None:
        remove(self.spark, f"{self._log(table)}/{load}")

    # --- state of derived tables ---

    def _state(self, table: str) -> str:
        return f"{self._root}/{table}-spans"

    def _part(self, table: str):
        """The part of the state that a person's rows are in: as many as the table has buckets."""
        parts = self._layout().get(table, STATE_PARTS)
        return F.pmod(F.xxhash64("person_id"), F.lit(parts)).cast("int").alias("part")

    def has_spans(self, table: str) -> bool:
        return exists(self.spark, f"{self._state(table)}/load=first/_SUCCESS")

    def put_spans(self, table: str, load: str, spans: DataFrame) -> None:
        """Store what a load adds to the state of a derived table; the same load replaces its own.

        Files are apart by a hash of the person, so that a small load reads few of them.
        """
        rows = spans.select("*", self._part(table)).repartition("part")
        path = f"{self._state(table)}/load={load}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)

    def spans(self, table: str, columns: T.StructType, persons: DataFrame | None = None) -> DataFrame:
        """The state of a derived table, of the given persons or of all."""
        reader = self.spark.read.schema(T.StructType([*columns, T.StructField("part", T.IntegerType())]))
        rows = reader.option("basePath", self._state(table)).parquet(f"{self._state(table)}/*")
        if persons is not None:
            parts = [r[0] for r in persons.select(self._part(table)).distinct().collect()]
            rows = rows.filter(F.col("part").isin(parts)).join(persons, "person_id", "left_semi")
        return rows.select(*columns.names)


def append_jdbc(
    rows: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 250_000
) -> None:
    """Append to a database table in batches."""
    options = {**properties, "batchsize": str(batch)}
    rows.write.jdbc(url, table, mode="append", properties=options)


def load_vocabulary(
    store: ParquetStore, files: Mapping[str, str], sep: str = "\t", multi_line: bool = False
) -> None:
    """Load vocabulary CSVs, given as table -> path, into the vocabulary tables.

    A table outside the registry is stored as text.
    """
    for table, path in files.items():
        store.append(table, read_extract(store.spark, path, sep=sep, multi_line=multi_line))


def conform_vocabulary(rows: DataFrame, table: str) -> DataFrame:
    """Vocabulary columns in the stored types, missing ones null, further ones as they are."""
    known = schema.VOCABULARY.get(table, T.StructType())
    names = {f.name for f in known}
    kinds = dict(rows.dtypes)

    def shaped(field: T.StructField):
        if field.name not in kinds:
            value = F.lit(None)
        elif kinds[field.name] == field.dataType.simpleString():
            return F.col(field.name)
        elif isinstance(field.dataType, T.LongType):
            value = to_int(F.col(field.name))
        elif isinstance(field.dataType, T.DoubleType):
            value = to_float(F.col(field.name))
        elif isinstance(field.dataType, T.DateType):
            value = to_day(F.col(field.name), schema.VOCABULARY_DATES)
        else:
            value = F.col(field.name)
        return value.cast(field.dataType).alias(field.name)

    return rows.select(*map(shaped, known), *[c for c in rows.columns if c not in names])


def conform_to(
    df: DataFrame, target: T.StructType, drop_empty: bool = True
) -> DataFrame:
    """Keep the columns the target has too, in the target's types.

    Whole numbers and numbers that cannot be read become null, text takes '' for null and is
    cut to the declared length. With ``drop_empty`` columns without any value are left out;
    that takes one pass over the frame, which returns a single row of counts.
    """
    common = [f for f in target if f.name in df.columns]
    if drop_empty and common:
        counts = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in common]).first()
        common = [f for f in common if counts[f.name]]
    return df.select(*[_conformed(f) for f in common])


def _conformed(target: T.StructField):
    c, kind = F.col(target.name), target.dataType
    if isinstance(kind, T.IntegralType):
        value = to_int(c)
    elif isinstance(kind, T.NumericType):
        value = to_float(c)
    elif isinstance(kind, (T.VarcharType, T.CharType)):
        value = F.substring(F.coalesce(c.cast("string"), F.lit("")), 1, kind.length)
    elif isinstance(kind, T.StringType):
        value = F.coalesce(c.cast("string"), F.lit(""))
    elif isinstance(kind, T.DateType):
        value = to_day(c)
    elif isinstance(kind, T.BooleanType):
        value = c.try_cast("boolean")
    else:
        value = c
    return value.alias(target.name)
