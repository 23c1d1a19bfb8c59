"""spark.read.format("gleaner_state"): state files with strict rows, and the place of what is corrupt in the error.

Options: `layout` lines (JSON lines, the default), array (a JSON array a file) or version (the schema version of a state
file); `split` the bytes of a task's part of a file of lines.  A missing path has no rows, and version 1.  Blank lines
are passed over.  A row that is no JSON object, lacks a field that the schema does not let be null, or holds a value of
another type fails the read with the file's name and, for lines, the number of the line.

Files are opened through Arrow's file systems by their URI, and whole folders are read, names that begin with _ or . left
out.  A file of lines is read in parts by several tasks; a line belongs to the part in which it begins.
"""

from __future__ import annotations

import datetime as dt
import io
import json
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .state import VERSIONS

NAME = "gleaner_state"
SPLIT_BYTES = 64 << 20


class StateCorruptionError(ValueError):
    def __init__(self, path: str, line: int | None = None, why: str = ""):
        super().__init__(f"corrupt state: {path}{'' if line is None else f', line {line}'}{why and f': {why}'}")


class Part(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        super().__init__((path, start, stop))


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _files(uri: str) -> list[pafs.FileInfo]:
    fs, path = _opened(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        return []
    if info.is_file:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted((f for f in found if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)


_PLAIN: dict[type, tuple[type, ...]] = {T.StringType: (str,), T.BooleanType: (bool,), T.DoubleType: (float, int), T.FloatType: (float, int)}


def value_of(value, kind: T.DataType, nullable: bool = True, where: str = "row"):
    """A JSON value as the schema has it; ValueError where it does not fit."""
    if value is None:
        if nullable:
            return None
        raise ValueError(f"{where} is null")
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            raise ValueError(f"{where} is no object")
        return tuple(value_of(value.get(f.name), f.dataType, f.nullable, f.name) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            raise ValueError(f"{where} is no array")
        return [value_of(v, kind.elementType, kind.containsNull, where) for v in value]
    if isinstance(kind, T.MapType):
        if not isinstance(value, dict):
            raise ValueError(f"{where} is no object")
        return {k: value_of(v, kind.valueType, kind.valueContainsNull, f"{where}.{k}") for k, v in value.items()}
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if not isinstance(value, str):
            raise ValueError(f"{where} is no date")
        if isinstance(kind, T.DateType):
            return dt.date.fromisoformat(value)
        at = dt.datetime.fromisoformat(value)
        return at if at.tzinfo or isinstance(kind, T.TimestampNTZType) else at.replace(tzinfo=dt.UTC)
    if isinstance(kind, T.IntegralType):
        if isinstance(value, bool) or not isinstance(value, int):
            raise ValueError(f"{where} is no whole number")
        return value
    kinds = _PLAIN.get(type(kind))
    if kinds is None or not isinstance(value, kinds) or (isinstance(value, bool) and bool not in kinds):
        raise ValueError(f"{where} is no {kind.simpleString()}")
    return float(value) if float in kinds else value


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.layout, self.uri = schema, options.get("layout", "lines"), options.get("path", "")
        self.split = int(options.get("split", SPLIT_BYTES))
        if self.layout not in ("lines", "array", "version"):
            raise ValueError(f"unknown layout {self.layout}")

    def partitions(self) -> list[Part]:
        files = _files(self.uri)
        if self.layout == "version" and not files:
            return [Part("", 0, 0)]
        if self.layout != "lines":
            return [Part(f.path, 0, f.size) for f in files] or [Part("", 0, 0)]
        return [Part(f.path, at, min(at + self.split, f.size)) for f in files for at in range(0, f.size, self.split)] or [Part("", 0, 0)]

    def read(self, partition: Part) -> Iterator[tuple]:
        path, start, stop = partition.value
        if not path:
            yield from [(1,)] if self.layout == "version" else []
            return
        fs, _ = _opened(self.uri)
        if self.layout == "lines":
            yield from self._lines(fs, path, start, stop)
            return
        with fs.open_input_file(path) as f:
            try:
                held = json.loads(f.read().decode())
                if self.layout == "version":
                    version = held.get("schema_version") if isinstance(held, dict) else None
                    if version not in VERSIONS or isinstance(version, bool):
                        raise ValueError(f"unknown schema version {version}")
                    held = [held]
                if not isinstance(held, list):
                    raise ValueError("no array")
                rows = [value_of(item, self.schema) for item in held]
            except ValueError as e:
                raise StateCorruptionError(path, why=str(e)) from e
        yield from rows

    def _lines(self, fs: pafs.FileSystem, path: str, start: int, stop: int) -> Iterator[tuple]:
        with io.BufferedReader(fs.open_input_file(path)) as f:
            at = start
            if start:
                f.seek(start - 1)
                at += len(f.readline()) - 1  # the rest of a line that began before
            else:
                f.seek(0)
            while at < stop:
                line = f.readline()
                if not line:
                    return
                if line.strip():
                    try:
                        yield value_of(json.loads(line.decode()), self.schema)
                    except ValueError as e:
                        raise StateCorruptionError(path, self._number(fs, path, at), str(e)) from e
                at += len(line)

    @staticmethod
    def _number(fs: pafs.FileSystem, path: str, at: int) -> int:
        """The number of the line that begins at a place; only a failing read counts."""
        lines = 1
        with fs.open_input_file(path) as f:
            while at > 0:
                piece = f.read(min(at, 1 << 20))
                lines += piece.count(b"\n")
                at -= len(piece)
        return lines


class StateSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        if self.options.get("layout") == "version":
            return "schema_version int"
        raise ValueError("a state is read with a schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StateSource)
