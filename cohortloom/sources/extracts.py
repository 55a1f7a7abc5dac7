"""CSV extracts in and out."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.operators.worklist import by_frequency
from cohortloom.session import children, hadoop_path, remove, staged

# Texts a CSV reader takes for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Files whose parts are joined at the same time: each takes a thread and a buffer of the driver.
JOINED_AT_ONCE = 4

# Carries the position of a row in its file from the scan to ``keep_first``.
INPUT_ORDER = "_input_order"


def read_extract(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    multi_line: bool = False,
    input_order: bool = False,
    by_splits: bool = False,
) -> DataFrame:
    """CSV with header as text columns, names in lower case, missing-value texts as null.

    Columns go by name: files whose headers differ are read apart and a column that a file lacks
    is null there; columns whose names differ in case only are an error. Files are read in the order of their
    paths. Nothing is inferred, so the rows are read once, split by split; a missing path
    and a row that does not fit its header fail. ``multi_line`` takes line breaks inside quotes,
    but a file is then one split, unless it is read ``by_splits``: that takes quotes to be written as
    CSV asks, around whole values and doubled inside, see ``records``. ``input_order`` adds the position
    of the row: file, split, row.
    """
    options = {
        "header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multi_line,
        "mode": "FAILFAST", "columnPruning": False,
    }
    reader = spark.read.options(**options)
    files = reader.csv(path).inputFiles()
    groups: dict[str, list[str]] = {}
    for file in files if len(files) > 1 else []:
        groups.setdefault(_first_line(spark, file), []).append(file)
    for head in groups or ([_first_line(spark, files[0])] if files else []):
        names = [name.lower() for name in next(csv.reader([head], delimiter=sep), []) if name]
        if len(set(names)) < len(names):
            raise ValueError(f"columns that differ in case only, or not at all: {head}")
    paths = list(groups.values()) if len(groups) > 1 else [path]
    if multi_line and by_splits:
        parts = [_parsed(records(spark, x), reader.csv(x).columns, options) for x in paths]
    else:
        parts = [reader.csv(x) for x in paths]
    rows = _text_columns(parts[0], input_order)
    for part in parts[1:]:
        rows = rows.unionByName(_text_columns(part, input_order), allowMissingColumns=True)
    if input_order and len(parts) > 1:
        rows = rows.select(*[c for c in rows.columns if c != INPUT_ORDER], INPUT_ORDER)
    return rows


def _first_line(spark: SparkSession, file: str) -> str:
    """The header of a file, read through the file system that Spark reads it with."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return line or ""


def _text_columns(raw: DataFrame, input_order: bool) -> DataFrame:
    columns = [
        F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c.lower())
        for c in raw.columns if c != INPUT_ORDER
    ]
    if input_order and INPUT_ORDER in raw.columns:
        columns.append(F.col(INPUT_ORDER))
    elif input_order:
        position = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        )
        columns.append(position.alias(INPUT_ORDER))
    return raw.select(*columns)


_LINE = "value string, file string, split long, row long"


def _quotes(batch: pa.RecordBatch) -> np.ndarray:
    return pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(file, split) and the rows of a batch that belong to it."""
    files, splits = batch.column("file").to_pylist(), batch.column("split").to_pylist()
    begin = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or (files[i], splits[i]) != (files[begin], splits[begin]):
            yield (files[begin], splits[begin]), begin, i
            begin = i


def _split_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split whether it holds an odd number of quotes, and whether a line of it ends outside
    quotes, if it begins outside and if it begins inside."""
    found: dict[tuple, list] = {}
    for batch in batches:
        quotes = _quotes(batch)
        for key, a, b in _pieces(batch):
            state = found.setdefault(key, [0, False, False])
            after = (state[0] + np.cumsum(quotes[a:b])) % 2
            state[1:] = state[1] or bool((after == 0).any()), state[2] or bool((after == 1).any())
            state[0] = int(after[-1])
    rows = [(*key, *state) for key, state in found.items()]
    columns = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["file", "split", "odd", "ends_outside", "ends_inside"]
    )


_RECORD = "file string, chain long, split long, row long, value string, whole boolean"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each split, and the parts of those that go on beyond it.

    A part carries as ``chain`` the split in which its record begins. The header of a file is left out.
    """
    key, inside, lines, start, header = None, 0, [], None, False

    def closed(whole: bool):
        return (key[0], start[0], key[1], start[1], "\n".join(lines), whole)

    for batch in batches:
        out, quotes = [], _quotes(batch)
        values, rows = batch.column("value").to_pylist(), batch.column("row").to_pylist()
        firsts, chains = batch.column("inside").to_pylist(), batch.column("chain").to_pylist()
        for now, a, b in _pieces(batch):
            if now != key:
                if lines:
                    out.append(closed(False))
                key, inside, lines, header = now, firsts[a], [], now[1] == 0
                start = (chains[a], rows[a])
            for i in range(a, b):
                if not lines and not inside:
                    start = (now[1], rows[i])
                lines.append(values[i])
                inside = (inside + int(quotes[i])) % 2
                if not inside:
                    if not header:
                        out.append(closed(start[0] == now[1]))
                    lines, header = [], False
        yield _record_batch(out)
    if lines:
        yield _record_batch([closed(False)])


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["file", "chain", "split", "row", "value", "whole"]
    )


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records (file, split, row, value) of CSV files with line breaks inside quotes, headers left out.

    Whether a split begins inside quotes is the parity of the quotes before it, for which the splits are
    gone through once; then each is cut into records by itself, and only records that
    go on in another split are put together. What is broadcast has one row for each split.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    facts = staged(lines.mapInArrow(_split_facts, "file string, split long, odd int, ends_outside boolean, ends_inside boolean"))
    in_file = Window.partitionBy("file").orderBy("split")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # A record begins in a split where a line of it ends outside quotes, or that begins outside itself.
    begins = (F.col("inside") == 0) | F.col("ends_inside")
    facts = facts.withColumn("chain", F.last(F.when(begins, F.col("split")), ignorenulls=True).over(before))
    facts = facts.select("file", "split", F.col("inside").cast("int").alias("inside"), F.coalesce("chain", "split").alias("chain"))
    known = lines.join(F.broadcast(staged(facts)), ["file", "split"])
    cut = known.mapInArrow(_assembled, _RECORD)
    parts = cut.filter("NOT whole").groupBy("file", "chain").agg(
        F.sort_array(F.collect_list(F.struct("split", "row", "value"))).alias("parts")
    )
    joined = parts.select(
        "file", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["row"].alias("row"),
        F.array_join(F.col("parts.value"), "\n").alias("value"),
    )
    return cut.filter("whole").select("file", "split", "row", "value").unionByName(joined)


def _parsed(rows: DataFrame, columns: list[str], options: dict) -> DataFrame:
    """Columns of records by the CSV rules of ``options``."""
    body = rows.withColumn("value", F.regexp_replace("value", "\\r$", "")).filter(F.trim("value") != "")
    names = ", ".join("`{}` string".format(c.replace("`", "``")) for c in columns)
    rules = {k: str(v) for k, v in options.items() if k in ("sep", "quote", "escape", "mode")}
    position = F.struct("file", "split", "row").alias(INPUT_ORDER)
    return body.select(F.from_csv("value", names, rules).alias("parsed"), position).select("parsed.*", INPUT_ORDER)


def export_tables(store, tables: Iterable[str], folder: str, one_file: bool = False) -> list[str]:
    """Write each table as ``<folder>/<table>.csv`` with header; empty names are skipped.

    Each ``.csv`` is a folder of part files, written by as many tasks as the table has, or ``one_file``.
    The parts of such a file are joined while the tasks write the next tables.
    """
    written, joins = [], {}
    with ThreadPoolExecutor(JOINED_AT_ONCE) as pool:
        for table in filter(None, tables):
            path = f"{folder.rstrip('/')}/{table}.csv"
            rows = store.read(table)
            if path in joins:
                joins[path].result()
            if one_file:
                _write_parts(rows, path, ",")
                joins[path] = pool.submit(_join_parts, rows.sparkSession, path, rows.columns, ",")
            else:
                write_csv(rows, path)
            written.append(path)
    for join in joins.values():
        join.result()
    return written


def _csv_options(sep: str, header: bool) -> dict:
    return {
        "header": header, "sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    }


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with header; texts keep their outer blanks."""
    df.write.mode("overwrite").options(**_csv_options(sep, True)).csv(path)


def write_one_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One file with one header. The parts are written by the table's tasks and then joined in order.

    A file system that can concatenate files does so without moving them; with any other the
    parts stream through the driver, a buffer at a time.
    """
    _write_parts(df, path, sep)
    _join_parts(df.sparkSession, path, df.columns, sep)


def _write_parts(df: DataFrame, path: str, sep: str) -> None:
    df.write.mode("overwrite").options(**_csv_options(sep, False)).csv(f"{path}.parts")


def _join_parts(spark: SparkSession, path: str, columns: list[str], sep: str) -> None:
    """The header and what ``_write_parts`` has written, as one file."""
    parts, header = f"{path}.parts", sep.join(columns)
    names = [f"{parts}/{name}" for name in children(spark, parts) if name.startswith("part-")]
    remove(spark, path)
    system, target = hadoop_path(spark, path)
    out = system.create(target, True)
    try:
        out.write(bytearray(f"{header}\n".encode()))
        if not names:
            return
    finally:
        out.close()
    jvm = spark._jvm
    paths = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(names))
    for i, name in enumerate(names):
        paths[i] = hadoop_path(spark, name)[1]
    try:
        system.concat(target, paths)
    except (UnsupportedOperationException, Py4JJavaError):
        _copied(spark, path, names, header)
    remove(spark, parts)


def _copied(spark: SparkSession, path: str, names: list[str], header: str) -> None:
    """The header and the named files, one after the other, in one new file."""
    system, target = hadoop_path(spark, path)
    copy = spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out = system.create(target, True)
    try:
        out.write(bytearray(f"{header}\n".encode()))
        for name in names:
            stream = system.open(hadoop_path(spark, name)[1])
            try:
                copy(stream, out, 1 << 20, False)
            finally:
                stream.close()
    finally:
        out.close()


def write_worklist(report: DataFrame, folder: str, file_name: str) -> str:
    """Unmapped-code report, most frequent first; the name has to end in ``.csv``."""
    if not file_name.endswith(".csv"):
        raise ValueError("file name must end with .csv")
    path = f"{folder.rstrip('/')}/{file_name}"
    write_csv(by_frequency(report), path)
    return path


def read_reviewed(
    spark: SparkSession, folder: str, file_name: str, sep: str = ",", input_order: bool = False
) -> DataFrame:
    """Reviewed mapping list, ids as numbers."""
    path = f"{folder.rstrip('/')}/{file_name}"
    rows = read_extract(spark, path, sep=sep, multi_line=True, input_order=input_order)
    ids = [c for c in rows.columns if c.endswith("concept_id")]
    return rows.withColumns({c: F.col(c).try_cast("double").cast("long") for c in ids})
