"""One large JSON object {user: {...}} read by many tasks.

A byte range of JSON cannot be understood from its start alone: it may begin
inside a string, behind a backslash, at any depth. But what a range does to a
reader is a small table: for each of the three ways to begin (outside a string,
inside, inside behind a backslash) the way it ends and the change of depth. A
first pass makes this table for every range, side by side; putting the tables
together in order gives the true beginning of each range. In the second pass
every task cuts out the entries of the outermost object that begin in its range,
reading on beyond the range for the last one.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.files import listed, open_path
from tidewatch.sources.readers import LEDGER, LEDGER_ROWS

SPLIT = 32 << 20
BLOCK = 4 << 20
#: What is read at a time behind a range, where only its last entry is missing.
BEYOND = 16 << 10
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
QUOTE, BACKSLASH, COMMA = ord('"'), ord("\\"), ord(",")


def _unescaped_quotes(data: np.ndarray, pending: bool) -> tuple[np.ndarray, bool]:
    """Positions of quotes that no backslash takes away, and whether a backslash waits at the end."""
    slash = data == BACKSLASH
    # Length of the run of backslashes that ends before each position.
    at = np.arange(len(data))
    last = np.maximum.accumulate(np.where(slash, -1, at))
    quotes = np.flatnonzero(data == QUOTE)
    before = quotes - 1
    runs = np.where(before >= 0, before - np.where(before >= 0, last[np.maximum(before, 0)], 0), 0)
    if pending:  # one more backslash before the first byte
        runs = runs + (runs == quotes)
    tail = len(data) - 1 - int(last[-1]) if len(data) else 0
    waits = (tail + (pending and tail == len(data))) % 2 == 1
    return quotes[runs % 2 == 0], bool(waits)


def step(data: np.ndarray, state: int) -> tuple[int, np.ndarray]:
    """The state behind a block, and for each byte whether it stands outside of strings."""
    quotes, waits = _unescaped_quotes(data, state == ESCAPED)
    turns = np.zeros(len(data) + 1, np.int8)
    turns[quotes + 1] = 1
    inside = (np.cumsum(turns, dtype=np.int64) + (state != OUTSIDE)) % 2 == 1
    end = ESCAPED if inside[-1] and waits else INSIDE if inside[-1] else OUTSIDE
    plain = ~inside[:-1]
    plain[quotes] = False
    return end, plain


def _nesting(data: np.ndarray, plain: np.ndarray) -> np.ndarray:
    opens = (data == ord("{")) | (data == ord("["))
    closes = (data == ord("}")) | (data == ord("]"))
    return (opens & plain).astype(np.int64) - (closes & plain)


def _blocks(stream, start: int, end: int, size: int) -> Iterator[np.ndarray]:
    """Bytes from ``start``: the range itself up to ``end``, then small blocks up to ``size``."""
    stream.seek(start)
    while start < size:
        data = stream.read(min(BLOCK, end - start) if start < end else min(BEYOND, size - start))
        if not data:
            return
        start += len(data)
        yield np.frombuffer(data, np.uint8)


def _table(path: str, start: int, end: int) -> list[int]:
    """(end state, change of depth) for each of the three states at the start."""
    out = []
    system, name = open_path(path)
    with system.open_input_file(name) as stream:
        for state in (OUTSIDE, INSIDE, ESCAPED):
            depth = 0
            for data in _blocks(stream, start, end, end):
                state, plain = step(data, state)
                depth += int(_nesting(data, plain).sum())
            out += [state, depth]
    return out


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        found = [_table(r["path"], r["start"], r["end"]) for r in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "t"])


def _entries(path: str, start: int, end: int, size: int, state: int, depth: int) -> Iterator[bytes]:
    """Entries of the outermost object whose separator (its brace or a comma) lies in the range."""
    system, name = open_path(path)
    parts: list[bytes] | None = None
    with system.open_input_file(name) as stream:
        at = start
        for data in _blocks(stream, start, end, size):
            state, plain = step(data, state)
            nesting = _nesting(data, plain)
            depths = depth + np.cumsum(nesting)
            depth = int(depths[-1])
            opens = (depths == 1) & (nesting == 1)
            cuts = np.flatnonzero(opens | ((data == COMMA) & plain & (depths == 1)) | ((depths == 0) & (nesting == -1)))
            whole, begin = data.tobytes(), 0
            for cut in cuts.tolist():
                if parts is not None:
                    yield b"".join([*parts, whole[begin:cut]])
                    parts = None
                if at + cut >= end:
                    return
                if depths[cut] == 1:
                    parts, begin = [], cut + 1
            if parts is not None:
                parts.append(whole[begin:])
            elif at + len(data) >= end:
                return
            at += len(data)


def _parsed(entry: bytes) -> tuple[str, str] | None:
    text = entry.decode("utf-8", "replace").strip()
    if not text:
        return None
    try:
        key, end = json.JSONDecoder().raw_decode(text)
    except ValueError:
        return None
    rest = text[end:].lstrip()
    return (key, rest[1:].strip()) if isinstance(key, str) and rest.startswith(":") else None


def _users(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            found, size = [], 0
            names = ["user_id", "value"]
            for entry in _entries(r["path"], r["start"], r["end"], r["size"], r["state"], r["depth"]):
                if pair := _parsed(entry):
                    found.append(pair)
                    size += len(entry)
                if size >= BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=names)
                    found, size = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=names)


def _begins_as_object(system: fs.FileSystem, path: str) -> bool:
    with system.open_input_file(path) as stream:
        while block := stream.read(4096):
            if text := block.lstrip(b" \t\r\n"):
                return text.startswith(b"{")
    return False


def _spread(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """Splits in file order, each task a run of them: small splits share a task, large ones have one each."""
    size = sum(end - start for _, start, end, *_ in rows)
    tasks = min(len(rows), max(spark.sparkContext.defaultParallelism, math.ceil(size / SPLIT)))
    return spark.createDataFrame(rows, names).repartitionByRange(tasks, "path", "start")


def read_large_ledger(spark: SparkSession, path: str, split_bytes: int = SPLIT) -> DataFrame:
    """The rows of ``read_ledger`` from a file (or a folder of files) of any size.

    A missing path gives no rows, and neither does a file that is no object or
    whose quotes and brackets do not close. An entry without a readable key is
    left out; a value that does not fit gives nulls. One entry is one row, so it
    has to fit into a task; nothing else has. The driver holds six numbers per
    split.
    """
    system, root = open_path(path)
    info = system.get_file_info(root)
    files = [info] if info.type == fs.FileType.File else listed(system, root)
    here = lambda f: path if f.path == root else f"{path.rstrip('/')}{f.path[len(root):]}"
    splits = [
        (here(f), start, min(start + split_bytes, f.size), f.size)
        for f in files
        if _begins_as_object(system, f.path)
        for start in range(0, f.size, split_bytes)
    ]
    if not splits:
        return spark.createDataFrame([], LEDGER_ROWS)
    names = "path string, start bigint, end bigint, size bigint"
    tables = _spread(spark, splits, names)
    found = sorted(tables.mapInArrow(_tables, f"{names}, t array<bigint>").collect(), key=lambda r: (r.path, r.start))
    begins, whole = [], set()
    state = depth = 0
    for r in found:
        if r.start == 0:
            state = depth = 0
        begins.append((r.path, r.start, r.end, r.size, state, depth))
        state, depth = r.t[2 * state], depth + r.t[2 * state + 1]
        if r.end == r.size and (state, depth) == (OUTSIDE, 0):
            whole.add(r.path)
    work = [b for b in begins if b[0] in whole]
    if not work:
        return spark.createDataFrame([], LEDGER_ROWS)
    users = _spread(spark, work, f"{names}, state int, depth bigint").mapInArrow(_users, "user_id string, value string")
    return users.select("user_id", F.from_json("value", LEDGER.valueType).alias("v")).select("user_id", "v.*")
