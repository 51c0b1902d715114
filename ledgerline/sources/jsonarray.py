"""JSON arrays as a splittable source: one array per file, read by many tasks.

A file is cut into byte ranges.  Where a range starts inside the array cannot be
told from its bytes alone, since brackets may stand in strings.  So it is read
twice, both times by all tasks:

1. Each range reports whether it holds an odd number of unescaped quotes, and
   how much deeper the brackets outside strings lead, both for a start outside
   and inside a string.  A backslash run before the range is looked up in the
   file, so escapes never need to be carried over.
2. From these (one row per range) follows the state at the start of every range.
   A task returns the records that start in its range; the last one is read to
   its end, wherever that is.

The records go to Spark as text and are parsed by ``from_json`` with the declared
schema; a record that does not fit fails the read.  A file that is no single
array of objects is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes in a range.
RANGE_BYTES = 16 * 1024 * 1024
#: Bytes read at once to end a record that lies across ranges.
TAIL_BYTES = 1024 * 1024
#: Records in a batch.
BATCH = 4096

_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_OPEN, _CLOSE = (ord("["), ord("{")), (ord("]"), ord("}"))


class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; ``inside`` and ``depth`` say what they start in (second reading only)."""

    def __init__(self, path: str, start: int, end: int, modified: float, inside: int = 0, depth: int = 0):
        super().__init__(None)
        self.path, self.start, self.end, self.modified = path, start, end, modified
        self.inside, self.depth = inside, depth


def _open(path: str) -> pa.NativeFile:
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def ranges(paths: Sequence[str], size: int) -> list[Range]:
    """The byte ranges of all files under ``paths``; names that start with a dot or underscore are no data."""
    out = []
    for path in paths:
        store, name = fs.FileSystem.from_uri(path)
        prefix = path.removesuffix(name) if path.endswith(name) else ""
        found = store.get_file_info(name)
        files = [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(name, recursive=True))
        for f in sorted(files, key=lambda f: f.path):
            hidden = any(part[:1] in "._" for part in f.path.removeprefix(name).strip("/").split("/") if part)
            if f.type == fs.FileType.File and f.size and not hidden:
                out += [Range(prefix + f.path, s, min(f.size, s + size), f.mtime.timestamp()) for s in range(0, f.size, size)]
    return out


def _escaped_start(file: pa.NativeFile, start: int) -> bool:
    """Whether an odd run of backslashes ends right before ``start``."""
    run = 0
    while run < start:
        step = min(64, start - run)
        raw = file.read_at(step, start - run - step)
        left = len(raw.rstrip(b"\\"))
        run += step - left
        if left:
            break
    return run % 2 == 1


def _marks(raw: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, change in depth, quotes before) of the brackets, and the number of quotes as the last of the third."""
    b = np.frombuffer(raw, np.uint8)
    slash = np.flatnonzero(b == _BACKSLASH)
    quote = np.flatnonzero(b == _QUOTE)
    if len(slash) or escaped:
        # The length of the backslash run before a quote tells whether it is escaped.
        first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
        run_start = slash[first]
        run_end = np.append(slash[first[1:] - 1], slash[-1]) + 1 if len(slash) else slash
        length = run_end - run_start + ((run_start == 0) & escaped)
        odd = run_end[length % 2 == 1]
        if escaped and (not len(slash) or slash[0] != 0):
            odd = np.append(odd, 0)
        quote = quote[~np.isin(quote, odd)]
    opened, closed = np.isin(b, _OPEN), np.isin(b, _CLOSE)
    place = np.flatnonzero(opened | closed)
    return place, np.where(opened[place], 1, -1), np.append(np.searchsorted(quote, place), len(quote))


def _state(part: Range) -> tuple[int, int, int]:
    """(odd number of quotes, change in depth from outside a string, from inside one)."""
    with _open(part.path) as file:
        place, change, before = _marks(file.read_at(part.end - part.start, part.start), _escaped_start(file, part.start))
    outside = before[:-1] % 2 == 0
    return int(before[-1] % 2), int(change[outside].sum()), int(change[~outside].sum())


def _brackets(raw: bytes, escaped: bool, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(starts, ends) of the elements of the array in ``raw``, and the state after it."""
    place, change, before = _marks(raw, escaped)
    outside = before[:-1] % 2 == inside
    place, change = place[outside], change[outside]
    after = depth + np.cumsum(change)
    starts, ends = place[(change == 1) & (after == 2)], place[(change == -1) & (after == 1)]
    return starts, ends, (inside + int(before[-1])) % 2, int(after[-1]) if len(after) else depth


def _tail(file: pa.NativeFile, at: int, inside: int, depth: int) -> bytes:
    """The rest of a record that has begun before ``at``."""
    parts = []
    while True:
        raw = file.read_at(TAIL_BYTES, at)
        if not raw:
            raise ValueError("the array is not closed")
        _, ends, inside, depth = _brackets(raw, _escaped_start(file, at), inside, depth)
        if len(ends):
            return b"".join([*parts, raw[:ends[0] + 1]])
        parts.append(raw)
        at += len(raw)


def _records(part: Range) -> Iterator[tuple[int, bytes]]:
    """(place in the file, bytes) of the records that start in the range."""
    with _open(part.path) as file:
        raw = file.read_at(part.end - part.start, part.start)
        starts, ends, inside, depth = _brackets(raw, _escaped_start(file, part.start), part.inside, part.depth)
        done = 0
        if part.inside or part.depth > 1:  # within a record of an earlier range
            if not len(ends):
                return
            done, ends = int(ends[0]) + 1, ends[1:]
        for s, e in zip(starts.tolist(), ends.tolist()):
            _nothing_in(raw[done:s], part)
            yield part.start + s, _record(raw[s:e + 1], part)
            done = e + 1
        if len(starts) > len(ends):
            s = int(starts[-1])
            _nothing_in(raw[done:s], part)
            yield part.start + s, _record(raw[s:] + _tail(file, part.end, inside, depth), part)
        else:
            _nothing_in(raw[done:], part)


def _nothing_in(between: bytes, part: Range) -> None:
    """What stands between records holds no values."""
    if between.translate(None, b" \t\r\n,[]\xef\xbb\xbf"):
        raise ValueError(f"{part.path}: not an array of objects")


def _record(raw: bytes, part: Range) -> bytes:
    if raw[0] != _OPEN[1]:
        raise ValueError(f"{part.path}: not an array of objects")
    return raw


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"])
        self.size = int(options["range_bytes"])
        self.states = json.loads(options["states"]) if "states" in options else None

    def partitions(self) -> list[Range]:
        parts = ranges(self.paths, self.size)
        if self.states is not None:
            for part in parts:
                part.inside, part.depth = self.states[f"{part.path}:{part.start}"]
        return parts

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if self.states is None:
            odd, outside, inside = _state(partition)
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.path]), pa.array([partition.start], pa.int64()), pa.array([odd], pa.int64()),
                 pa.array([outside], pa.int64()), pa.array([inside], pa.int64())],
                names=["path", "start", "odd", "outside", "inside"])
            return
        rows: list[tuple[int, bytes]] = []
        for row in _records(partition):
            rows.append(row)
            if len(rows) == BATCH:
                yield _batch(partition, rows)
                rows = []
        if rows:
            yield _batch(partition, rows)


def _batch(part: Range, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([raw.decode() for _, raw in rows]), pa.array([part.path] * n), pa.array([part.modified] * n),
         pa.array([part.start] * n, pa.int64()), pa.array([at for at, _ in rows], pa.int64())],
        names=["record", "load_file", "modified", "load_block", "load_row"])


class JsonArrays(DataSource):
    """``spark.read.format("ledgerline_json_array")``; without the option ``states`` the first reading."""

    @classmethod
    def name(cls) -> str:
        return "ledgerline_json_array"

    def schema(self) -> str:
        if "states" in self.options:
            return "record string, load_file string, modified double, load_block bigint, load_row bigint"
        return "path string, start bigint, odd bigint, outside bigint, inside bigint"

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader({k: self.options[k] for k in ("paths", "range_bytes", "states") if k in self.options})


def records(spark: SparkSession, paths: Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(record, load_file, modified, load_block, load_row): the text of every record of the arrays in ``paths``."""
    spark.dataSource.register(JsonArrays)
    reader = spark.read.format(JsonArrays.name()).option("paths", json.dumps(list(paths))).option("range_bytes", range_bytes)
    states, path, inside, depth = {}, None, 0, 0
    for r in sorted(reader.load().collect(), key=lambda r: (r.path, r.start)):  # one row per range
        if r.path != path:
            _closed(path, inside, depth)
            path, inside, depth = r.path, 0, 0
        states[f"{r.path}:{r.start}"] = (inside, depth)
        depth += r.inside if inside else r.outside
        inside = (inside + r.odd) % 2
    _closed(path, inside, depth)
    return reader.option("states", json.dumps(states)).load()


def _closed(path: str | None, inside: int, depth: int) -> None:
    if path is not None and (inside or depth):
        raise ValueError(f"{path}: the array is not closed")


def read(spark: SparkSession, paths: Sequence[str], schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the arrays in ``paths`` with their load order (file time and name, range, place)."""
    rows = records(spark, paths, range_bytes)
    parsed = rows.withColumn("_r", F.from_json("record", schema, {"mode": "FAILFAST"}))
    return parsed.select("_r.*", F.timestamp_seconds("modified").alias("loaded_at"), "load_file", "load_block", "load_row")


def write(df: DataFrame, path: str) -> None:
    """``df`` as JSON arrays, one per task."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for b in batches:
            if b.num_rows:
                out = [f"{lead if k == 0 else ','}{r}" for k, r in enumerate(b.column(0).to_pylist())]
                lead = ","
                yield pa.RecordBatch.from_arrays([pa.array(out)], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"])], names=["value"])
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(lines, "value string").write.mode("overwrite").text(path)
