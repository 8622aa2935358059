"""CSV records with quoted line breaks, read in splits.

A byte range of a CSV file cannot tell by itself whether it starts inside quotes. So files are read as physical lines
in splits of fixed size, twice:

1. Every line is a function from the state at its start (between records, or inside quotes) to the state at its end.
   Most lines map both states to themselves. A split reports the composition of its lines, one row a split.
2. The driver composes the splits of each file in order, one step a split, which gives the state in which each starts.
3. Splits are read again and cut into records. What a split border cuts through, at most two pieces a split, is put
   together by the split in which the record starts.

A quote opens quotes only at the start of a field; elsewhere it is a character, as it is behind closing quotes.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.session import materialize

#: A line that, read from between records, ends inside quotes: whole fields with their commas, then quotes left open.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
OPENS = rf'^(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+)?+,)*+{_QUOTED}\z'
#: Splits whose state the driver keeps; beyond, larger splits are called for.
MAX_SPLITS = 2_000_000
#: Bytes of splits that one task reads, one split after the other.
TASK_BYTES = 64 * 1024 * 1024


@contextmanager
def fixed_splits(spark: SparkSession, split_bytes: int) -> Iterator[None]:
    """Files are cut every ``split_bytes`` bytes inside, whatever the number of cores; settings are put back after."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _in_tasks(lines: DataFrame, split_bytes: int) -> DataFrame:
    """Small splits are read several to a task, so that tasks grow in number with the bytes, not with the splits."""
    splits = lines.rdd.getNumPartitions()
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-splits * split_bytes // TASK_BYTES))
    return lines.coalesce(tasks) if tasks < splits else lines


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file`` (hash of the path), ``split`` (its first byte), ``row`` (rising inside a split), ``value``,
    and the states that the line ends in: ``s`` from between records, ``q`` from inside quotes; true is inside."""
    quoted = F.col("value").contains('"')
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
            "value",
            (quoted & F.col("value").rlike(OPENS)).alias("s"),
            (~quoted | F.concat(F.lit('"'), "value").rlike(OPENS)).alias("q"),
        )
    )


def _composed(changes: Column, start: bool) -> Column:
    """End state of a split and the row whose end first is between records, from the lines that change a state."""
    state = F.struct(F.lit(start).alias("inside"), F.lit(None).cast("long").alias("closed"))

    def step(now: Column, line: Column) -> Column:
        inside = F.when(now["inside"], line["q"]).otherwise(line["s"])
        closed = F.coalesce(now["closed"], F.when(~inside, line["row"]))
        return F.struct(inside.alias("inside"), closed.alias("closed"))

    return F.aggregate(changes, state, step)


def _split_states(lines: DataFrame) -> list[tuple[int, int, int, bool, int | None]]:
    """``file``, ``split``, number of the first line, whether it starts inside quotes, and the split that opened them."""
    changing = F.when(F.col("s") | ~F.col("q"), F.struct("row", "s", "q"))
    summary = lines.groupBy("path", "file", "split").agg(
        F.count("*").alias("n"),
        F.max("row").alias("last"),
        F.sort_array(F.collect_list(changing)).alias("changes"),
    )
    summary = summary.select(
        "path", "file", "split", "n", "last", _composed(F.col("changes"), False).alias("s"), _composed(F.col("changes"), True).alias("q")
    )
    found = summary.limit(MAX_SPLITS + 1).collect()
    if len(found) > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits; raise split_bytes")
    if len({r.path for r in found}) != len({r.file for r in found}):
        raise ValueError("two paths share a hash; read them one by one")
    states, line, inside, owner, path = [], 0, False, None, None
    for r in sorted(found, key=lambda r: (r.path, r.split)):
        if r.path != path:
            path, inside, owner = r.path, False, None
        states.append((r.file, r.split, line, inside, owner if inside else None))
        end = r.q if inside else r.s
        # a record starts in this split unless it is inside quotes up to its last line
        if not inside or (end.closed is not None and end.closed < r.last):
            owner = r.split
        inside, line = end.inside, line + r.n
    return states


def _cut(lines: DataFrame, owners: dict[tuple[int, int], int]) -> DataFrame:
    """``file``, ``split``, ``row`` of the first line, ``record``, and ``owner``: the split that a cut record starts in."""
    schema = "file long, split long, row long, record string, owner long"

    names = ["file", "split", "row", "record", "owner"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())

    def batch_of(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # pending: the lines of a record not yet closed, from its line ``first`` on; ``owner``: the split it started in
        now, at, inside, owner, first, pending = None, 0, False, None, 0, []
        rows: list[tuple] = []

        def close(is_cut: bool) -> None:
            if pending:
                rows.append((*now, first, "\n".join(pending), now[1] if is_cut and owner is None else owner))
                pending.clear()

        for batch in batches:
            files, splits, s, q = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "split", "s", "q"))
            values, numbers, alone = batch.column("value"), np.zeros(len(files), np.int64), np.zeros(len(files), bool)
            borders = np.flatnonzero((files[1:] != files[:-1]) | (splits[1:] != splits[:-1])) + 1
            for start, end in zip([0, *borders], [*borders, len(files)]):
                if start == end:
                    continue
                if (split := (int(files[start]), int(splits[start]))) != now:
                    close(True)
                    now, at = split, 0
                    owner = owners.get(now)
                    inside = owner is not None
                numbers[start:end] = np.arange(at, at + end - start)
                # lines between two that change a state keep it, so only those are stepped through
                begun = start
                for change in [*(np.flatnonzero(s[start:end] | ~q[start:end]) + start), end]:
                    if inside:
                        first = first if pending else int(numbers[begun])
                        pending += values.slice(begun, change - begun).to_pylist()
                    else:
                        alone[begun:change] = True
                    if change < end:
                        if not inside and not s[change]:
                            alone[change] = True
                        else:
                            first = first if pending else int(numbers[change])
                            pending.append(values[int(change)].as_py())
                            inside = bool(q[change] if inside else s[change])
                            if not inside:
                                close(False)
                                owner = None
                    begun = change + 1
                at += end - start
            whole = pa.array(alone)
            yield batch_of([files[alone], splits[alone], numbers[alone], values.filter(whole), pa.nulls(int(alone.sum()), pa.int64())])
            yield batch_of(list(zip(*rows)) if rows else [()] * 5)
            rows.clear()
        close(inside)
        yield batch_of(list(zip(*rows)) if rows else [()] * 5)

    return lines.select("file", "split", "value", "s", "q").mapInArrow(records, schema)


def read_records(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """``position``, ``record``, ``is_first``: the records of CSV files in file order, without empty lines.

    ``position`` is the number of the record's first line, counted over all files in order of their paths. ``is_first``
    marks the first record of a file. Line ends are a line feed, with or without a carriage return; those inside quotes
    stay as they are. A quote left open at the end of a file takes the rest of the file. The records are written once to
    the shared folder, so what follows reads Parquet.

    The driver holds one row a split: 100 TB in splits of 512 MB are 200,000.
    """
    split_bytes = split_bytes or int(spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b"))
    with fixed_splits(spark, split_bytes):
        lines = _in_tasks(_lines(spark, path), split_bytes)
        states = _split_states(lines)
        owners = {(file, split): owner for file, split, _, inside, owner in states if inside}
        cut = materialize(_cut(lines, owners), "csv-cut")
    offsets = spark.createDataFrame([s[:3] for s in states], "file long, split long, line long")
    pieces = F.sort_array(F.collect_list(F.struct("split", "row", "record")))
    joined = cut.where("owner IS NOT NULL").groupBy("file", "owner").agg(pieces.alias("pieces"))
    joined = joined.select(
        "file",
        F.col("pieces")[0]["split"].alias("split"),
        F.col("pieces")[0]["row"].alias("row"),
        F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"),
    )
    whole = cut.where("owner IS NULL").drop("owner").unionByName(joined)
    placed = whole.join(F.broadcast(offsets), ["file", "split"])
    record = F.regexp_replace("record", r"\r\z", "")
    return placed.select(
        (F.col("line") + F.col("row")).alias("position"), record.alias("record"), ((F.col("split") == 0) & (F.col("row") == 0)).alias("is_first")
    ).where("record != ''")


def header_of(records: DataFrame) -> list[str]:
    """The column names that the first records of all files agree on."""
    heads = records.where("is_first").select(F.regexp_replace("record", "^\\uFEFF", "").alias("record")).distinct().limit(2).collect()
    if len(heads) != 1:
        raise ValueError("no header" if not heads else f"files differ in their headers: {sorted(r.record for r in heads)}")
    return next(csv.reader([heads[0].record], strict=False))
