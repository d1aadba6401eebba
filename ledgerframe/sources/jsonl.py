"""Ordered reading and writing of line-delimited JSON logs.

Files are split over tasks; the order of lines is (file, offset of the split, position within it). Blank lines don't
count. A bad last line is a torn write, reported or dropped; any other bad line of a log is an error.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.utils import AnalysisException

from ..functions.profile import unix_nano
from ..operators.stage import delete, kept, listed

#: Longest line that is read.
MOST_BYTES = 4 << 20
#: Folders of one level of a log that are merged into one of the next.
FAN = 8

ATTRIBUTES = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))
RECORD = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_span_id", T.StringType()),
        T.StructField("seq_in_trace", T.IntegerType()),
        T.StructField("start_time_unix_nano", T.StringType()),
        T.StructField("end_time_unix_nano", T.StringType()),
        T.StructField("span_name", T.StringType()),
        T.StructField("otel_kind", T.StringType()),
        T.StructField("gen_ai_operation", T.StringType()),
        T.StructField("audit_kind", T.StringType()),
        T.StructField("selected_attributes", ATTRIBUTES),
        T.StructField("status", T.StringType()),
    ]
)
SIGNED = T.StructType([T.StructField(n, T.StringType()) for n in ("key_id", "algorithm", "entry_hash", "signature")])
TIPS = T.ArrayType(T.StructType([T.StructField("trace_id", T.StringType()), T.StructField("tip_hash", T.StringType()), T.StructField("entry_count", T.LongType())]))
CHECKPOINT = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("checkpoint_seq", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("prev_checkpoint_hash", T.StringType()),
        T.StructField("trace_tips", TIPS),
        T.StructField("key_id", T.StringType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("signature", T.StringType()),
    ]
)
WAL = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("record", RECORD),
        T.StructField("tip_hash", T.StringType()),
        T.StructField("entry_count", T.LongType()),
    ]
)


class MalformedLine(ValueError):
    """A bad line that isn't the last one, or one that is too long."""


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(order, line) of the non-blank lines of a file, or of the files of a folder in the order of their paths, trimmed;
    a missing file is empty. ``order`` grows with the place of a line and has gaps. Of a log whose batches were merged
    (``compact``) each line counts once, whatever a merge that was cut short has left."""
    live, gone = _folders(spark, path)
    paths = [path]
    if gone or any(f.level for f in live):
        rest = [n for n in listed(spark, path) if n[0] not in "_." and not n.startswith("batch=")]
        paths = [f"{path.rstrip('/')}/{n}" for n in [*rest, *(f.name for f in live)]]
    return _read(spark, *paths)


def _read(spark: SparkSession, *paths: str) -> DataFrame:
    try:
        raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(list(paths))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "order struct<file:string,block:long,row:long>, line string")
    # trimmed before rows are counted, so that the lines of a split have neighbouring ids
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.btrim("value", F.lit(" \t\n\x0b\f\r")).alias("line")).where("line <> ''")
    return lines.select(F.struct("file", "block", F.monotonically_increasing_id().alias("row")).alias("order"), "line")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` of ``lines()`` with line_no, from 1. A task reads a split from its begin to its end, so the ids of its lines
    are neighbours: only the first id and the count of each split meet in one window, and no line is moved."""
    split = F.struct("order.file", "order.block")
    counts = rows.groupBy(split.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("order.row").alias("first"))
    before = counts.select("b", (F.sum("n").over(Window.orderBy("b")) - F.col("n") - F.col("first") + 1).alias("before"))
    placed = rows.withColumn("_b", split).join(F.broadcast(before), F.col("_b") == F.col("b"))
    return placed.select((F.col("order.row") + F.col("before")).cast("long").alias("line_no"), "line")


def _parse_number(text: str):
    raise ValueError(f"not an integer: {text}")


_DECODER = json.JSONDecoder(parse_float=_parse_number, parse_constant=_parse_number)


def _decoded(line: str):
    # one decoder for all lines: ``json.loads`` with options makes one for each
    return json.loads(line) if line.startswith("\ufeff") else _DECODER.decode(line)


def _fitting(kind: T.DataType) -> Callable:
    """A function that makes a JSON value a field of the type (objects are tuples), with the type's zero for null; it raises
    where the value has another type."""
    if isinstance(kind, T.StructType):
        fields = [(f.name, unix_nano if f.name.endswith("_unix_nano") else _fitting(f.dataType)) for f in kind.fields]

        def fit(value):
            if value is None:
                value = {}
            if not isinstance(value, dict):
                raise ValueError("not an object")
            # member names match in any case, the last of a name counts
            by = {k.lower(): v for k, v in value.items()}
            return tuple([f(by.get(name)) for name, f in fields])

    elif isinstance(kind, T.ArrayType):
        item = _fitting(kind.elementType)

        def fit(value):
            if value is not None and not isinstance(value, list):
                raise ValueError("not an array")
            return None if value is None else [item(v) for v in value]

    elif isinstance(kind, T.StringType):

        def fit(value):
            if value is not None and not isinstance(value, str):
                raise ValueError("not a string")
            return "" if value is None else value

    else:

        def fit(value):
            if value is not None and (isinstance(value, bool) or not isinstance(value, int)):
                raise ValueError("not an integer")
            return 0 if value is None else value

    return fit


def parsed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """(line_no, value, error, size): each line strictly parsed, or the reason why it can't be."""
    out = T.StructType([T.StructField("line_no", T.LongType()), T.StructField("value", schema), T.StructField("error", T.StringType()), T.StructField("size", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, kind = _fitting(schema), to_arrow_type(schema)
        for batch in batches:
            values, errors = [], []
            for line in batch.column(1).to_pylist():
                try:
                    values.append(fit(_decoded(line)))
                    errors.append(None)
                except (ValueError, RecursionError) as e:
                    values.append(None)
                    errors.append(str(e))
            size = pc.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, kind), pa.array(errors, pa.string()), size], names=out.names)

    return rows.select("line_no", "line").mapInArrow(run, out)


def _strict(found: DataFrame) -> tuple[DataFrame, str | None]:
    """Good rows, and the text of a torn last line; raises on a bad line before it. Lines are parsed once, and one
    aggregation tells whether all is well."""
    found = kept(found)
    bad = F.col("error").isNotNull() | (F.col("size") > MOST_BYTES)
    first = F.min(F.when(bad, F.struct("line_no", "error", "size"))).alias("first")
    seen = found.agg(F.max("line_no").alias("last"), first).first()
    if seen.first and (seen.first.line_no != seen.last or seen.first.size > MOST_BYTES):
        raise MalformedLine(f"line {seen.first.line_no}: {seen.first.error or 'too long'}")
    return found.where("error is null"), (f"line {seen.first.line_no}: {seen.first.error}" if seen.first else None)


def read_entries(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    """Entries of an audit log (line_no, the record's fields, the signature's fields), and what a torn last line says."""
    schema = T.StructType([T.StructField("record", RECORD), T.StructField("signed", SIGNED)])
    good, torn = _strict(parsed(numbered(lines(spark, path)), schema))
    return good.select("line_no", "value.record.*", "value.signed.*"), torn


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoints in file order; a torn last line is dropped without a word."""
    good, _ = _strict(parsed(numbered(lines(spark, path)), CHECKPOINT))
    return good.select("line_no", "value.*").withColumn("trace_tips", F.coalesce("trace_tips", F.array().cast(TIPS)))


def last_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """The last checkpoint that can be read, whatever stands around it: one row or none."""
    good = parsed(numbered(lines(spark, path)), CHECKPOINT).where("error is null")
    return good.groupBy().agg(F.max_by("value", "line_no").alias("value")).where("value is not null").select("value.*")


def read_wal(spark: SparkSession, path: str) -> DataFrame:
    """Write-ahead-log lines; bad ones are skipped anywhere."""
    good = parsed(numbered(lines(spark, path)), WAL).where("error is null")
    return good.select(
        "line_no",
        "value.type",
        "value.trace_id",
        *[F.col(f"value.record.{f.name}") for f in RECORD.fields if f.name != "trace_id"],
        "value.tip_hash",
        "value.entry_count",
    )


def batch_name(batch_id: int | str) -> str:
    """The name of a batch's folder; names sort as the batches by number. What isn't a batch of the stream has a name of
    its own, which sorts after that of the batch it begins with."""
    return f"batch={batch_id:012d}" if isinstance(batch_id, int) else f"batch={batch_id}"


def batch_path(path: str, batch_id: int | str) -> str:
    return f"{path.rstrip('/')}/{batch_name(batch_id)}"


def write_batch(rows: DataFrame, path: str, batch_id: int | str, *order: str) -> None:
    """Write the column ``line`` of a batch of a stream as text, in the given order, so that a repeated batch replaces
    itself: one folder for each batch id, which appears as a whole when Spark commits it."""
    rows.orderBy(*order).select("line").write.mode("overwrite").text(batch_path(path, batch_id))


class Folder(NamedTuple):
    """A folder of a log: that of a batch, ``batch=<last>`` of level 0, or one into which those of the batches from
    ``first`` to ``last`` were merged, ``batch=<last>.<level>.<first>``. Both sort as their last batches."""

    last: str
    level: int
    first: str
    name: str


def _folders(spark: SparkSession, path: str) -> tuple[list[Folder], list[str]]:
    """The folders of batches that make up a log, in order, and the names of those that don't count: merged ones that
    never were completed, and what lies within a completed one."""
    found = []
    for name in listed(spark, path):
        if name.startswith("batch="):
            last, *merged = name.removeprefix("batch=").split(".")
            found.append(Folder(last, int(merged[0]) if merged else 0, merged[1] if merged else last, name))
    whole = [f for f in found if not f.level or "_SUCCESS" in listed(spark, f"{path.rstrip('/')}/{f.name}")]
    wide = [f for f in whole if f.level]
    live = [f for f in whole if not any(m.level > f.level and m.first <= f.last <= m.last for m in wide)]
    names = {f.name for f in live}
    return sorted(live), [f.name for f in found if f.name not in names]


def compact(spark: SparkSession, path: str, before: str) -> None:
    """Merge the folders of the batches of a log that come before the one of the name ``before`` and are never repeated:
    ``FAN`` or more of a level become one of the next, so n batches leave FAN * log(n) folders and each line is rewritten
    log(n) times. Lines keep their order and numbers.

    The merged lines are compared with their sources, by number, before these are deleted. A log has one writer; what
    reads it meanwhile may have to read again.
    """
    root = path.rstrip("/")
    for name in _folders(spark, path)[1]:
        delete(spark, f"{root}/{name}")
    level = 0
    while True:
        live = [f for f in _folders(spark, path)[0] if f.name < before]
        if not any(f.level >= level for f in live):
            return
        some = [f for f in live if f.level == level]  # all of a level lie side by side: higher ones before, lower ones after
        if len(some) >= FAN:
            source = numbered(_read(spark, *[f"{root}/{f.name}" for f in some]))
            merged = f"{root}/batch={some[-1].last}.{level + 1}.{some[0].first}"
            source.orderBy("line_no").select("line").write.mode("overwrite").text(merged)
            told = [_digest(rows) for rows in (source, numbered(_read(spark, merged)))]
            if told[0] != told[1]:
                delete(spark, merged)
                raise MalformedLine(f"{merged}: (lines, digest) {told[1]} instead of {told[0]}")
            for f in some:
                delete(spark, f"{root}/{f.name}")
        level += 1


def _digest(rows: DataFrame) -> tuple[int, int]:
    """Number of lines, and a sum of hashes of the lines with their numbers."""
    part = F.shiftright(F.xxhash64("line_no", "line"), 24)
    return tuple(rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(part), F.lit(0))).first())


def dropped_prefix(fragment: Column, most: int = 256) -> Column:
    """What a repair tells of the bytes it dropped: the first ``most`` of them."""
    return F.substring(fragment, 1, most)


def torn_tail(tail: bytes, most: int = MOST_BYTES) -> tuple[str, int]:
    """What to do with the end of a log before appending to it, and the number of bytes concerned: ``none``,
    ``terminate`` (a whole line without its line end), ``truncate`` (a fragment) or ``refuse`` (no line end in reach)."""
    if not tail or tail.endswith(b"\n"):
        return "none", 0
    fragment = tail.rsplit(b"\n", 1)[-1]
    if len(fragment) > most:
        return "refuse", len(fragment)
    try:
        json.loads(fragment)
    except ValueError:
        return "truncate", len(fragment)
    return "terminate", 1


def repair_tail(path: str) -> dict:
    """Repair the end of a local log in place; the action, its bytes, and up to 256 bytes of what was dropped."""
    file = Path(path)
    size = file.stat().st_size if file.exists() else 0
    tail = b""
    if size:
        with file.open("rb") as f:
            f.seek(max(0, size - MOST_BYTES - 1))
            tail = f.read()
    action, n = torn_tail(tail)
    dropped = tail[-n:][:256] if action == "truncate" else b""
    if action == "terminate":
        with file.open("ab") as f:
            f.write(b"\n")
    elif action == "truncate":
        with file.open("rb+") as f:
            f.truncate(size - n)
    return {"action": action, "bytes": n, "dropped": dropped}
