"""Python data sources for files Spark's readers would not keep apart record by record.

delimited_records: every record of CSV files with its number, empty ones included, cells as an
array. json_items: the elements of one large array inside a JSON object, one at a time, and the
object's other members, whatever their order. Both take a list of files and read them in parallel;
within a file records are numbered, so a file is one task.

Defined results: a byte order mark is dropped; an empty file has no records; undecodable bytes
become U+FFFD; an array that breaks off ends with an item of kind `broken`.
"""

from __future__ import annotations

import csv
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_BATCH = 5_000
_CHUNK = 1 << 20
_SPACE = re.compile(r"[ \t\r\n]*")
_NUMBER_PART = re.compile(r"[-+.eE0-9]*")


class _Files(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["files"])
        self.options = options

    def partitions(self):
        return [InputPartition(p) for p in self.paths]


class DelimitedRecords(DataSource):
    @classmethod
    def name(cls):
        return "delimited_records"

    def schema(self):
        return "path string, record_no bigint, cells array<string>"

    def reader(self, schema):
        return _DelimitedReader(self.options)


class _DelimitedReader(_Files):
    def read(self, partition):
        import pyarrow as pa

        names = ["path", "record_no", "cells"]

        def batch(rows, first):
            n = len(rows)
            return pa.RecordBatch.from_arrays([pa.array([partition.value] * n), pa.array(range(first, first + n), pa.int64()), pa.array(rows, pa.list_(pa.string()))], names=names)

        csv.field_size_limit(1 << 30)
        with open(partition.value, encoding="utf-8-sig", errors="replace", newline="") as f:
            rows, first = [], 1
            for row in csv.reader(f):
                rows.append(row)
                if len(rows) == _BATCH:
                    yield batch(rows, first)
                    first += len(rows)
                    rows = []
            if rows:
                yield batch(rows, first)


class JsonItems(DataSource):
    @classmethod
    def name(cls):
        return "json_items"

    def schema(self):
        return "path string, kind string, name string, position bigint, json string"

    def reader(self, schema):
        return _JsonReader(self.options)


class _JsonReader(_Files):
    def read(self, partition):
        import pyarrow as pa

        rows: list[tuple] = []

        def batch():
            cols = list(zip(*rows))
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["path", "kind", "name", "position", "json"])

        with open(partition.value, encoding="utf-8-sig", errors="replace") as f:
            for kind, name, position, text in split_object(f.read, self.options["array"]):
                rows.append((partition.value, kind, name, position, text))
                if len(rows) >= 500:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


class _Buffer:
    """Text that is read on demand and forgotten behind the position."""

    def __init__(self, read):
        self.read, self.text, self.pos, self.eof = read, "", 0, False
        self.decode = json.JSONDecoder().raw_decode

    def more(self) -> bool:
        part = self.read(max(_CHUNK, len(self.text) - self.pos))
        self.eof = not part
        self.text, self.pos = self.text[self.pos :] + part, 0
        return bool(part)

    def peek(self) -> str:
        while True:
            self.pos = _SPACE.match(self.text, self.pos).end()
            if self.pos < len(self.text):
                return self.text[self.pos]
            if not self.more():
                return ""

    def take(self, sign: str) -> bool:
        if self.peek() == sign:
            self.pos += 1
            return True
        return False

    def value(self) -> tuple[object, str]:
        """The next value and its text; ValueError where there is none. Grows the buffer until the value is whole."""
        self.peek()
        while True:
            try:
                v, end = self.decode(self.text, self.pos)
                # a number that reaches the end of the buffer may go on
                if _NUMBER_PART.match(self.text, end).end() < len(self.text) or self.eof or not self.more():
                    text = self.text[self.pos : end]
                    self.pos = end
                    return v, text
            except ValueError:
                if not self.more():
                    raise


def split_object(read, array: str):
    """(kind, name, position, json): kind is member, item, no_object, no_array or broken."""
    b = _Buffer(read)
    if not b.take("{"):
        yield "no_object", "", 0, b.text[:200]
        return
    n = 0
    try:
        while not b.take("}"):
            name = b.value()[0]
            if not b.take(":"):
                raise ValueError
            if name == array and b.peek() == "[":
                b.take("[")
                while not b.take("]"):
                    yield "item", array, n, b.value()[1]
                    n += 1
                    if not b.take(",") and b.peek() != "]":
                        raise ValueError
            elif name == array:
                yield "no_array", array, 0, b.value()[1]
            else:
                yield "member", name, 0, b.value()[1]
            if not b.take(",") and b.peek() != "}":
                raise ValueError
    except ValueError:
        yield "broken", array, n, b.text[b.pos : b.pos + 200]


def _read(spark: SparkSession, source: type[DataSource], files: list[str], **options: str) -> DataFrame:
    spark.dataSource.register(source)
    r = spark.read.format(source.name()).option("files", json.dumps(list(files)))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def read_delimited(spark: SparkSession, files: list[str]) -> DataFrame:
    return _read(spark, DelimitedRecords, files)


def read_json_items(spark: SparkSession, files: list[str], array: str) -> DataFrame:
    return _read(spark, JsonItems, files, array=array)
