"""Streams of decoded paragraph and outline objects (CBOR), as a Python data source.

The decoder isn't part of this library: option `decoder` names an importable function that yields the objects of an open
binary file. Such a stream can only be read from its beginning, so each file is a partition; deliver large ones in parts.
The files are listed through Hadoop's file system API and opened through Arrow's, so they may lie on shared storage."""

from __future__ import annotations

import importlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import storage
from ..functions.text import clean_items, strip
from ..runtime import ship

#: Where an object may hold its id and its text, in order of preference.
ID_FIELDS = ("para_id", "paragraph_id", "id")
TEXT_FIELDS = ("get_text", "text", "paragraph_text", "paragraph")
#: An object's place in its delivery.
ORDER = ("file", "ordinal")
SCHEMA = "file string, ordinal long, " + ", ".join(f"{f} string" for f in (*ID_FIELDS, *TEXT_FIELDS)) + ", bodies array<string>, page_id string, page_name string"


def _text(x) -> str | None:
    return None if x is None else x if isinstance(x, str) else str(x)


def fields_of(thing) -> tuple:
    """The raw fields of a decoded object, attribute or mapping entry; absent ones are null."""
    get = thing.get if isinstance(thing, dict) else lambda n: getattr(thing, n, None)
    values = [get(n) for n in (*ID_FIELDS, *TEXT_FIELDS)]
    bodies = [_text(b.get("text") if isinstance(b, dict) else getattr(b, "text", None)) for b in get("bodies") or []]
    return (*[_text(v() if callable(v) else v) for v in values], bodies, _text(get("page_id")), _text(get("page_name")))


class ParagraphSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paragraphs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["files"]), self.options["decoder"])


def opened(path: str):
    """A binary file on any storage that Arrow knows, buffered."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_stream(at, buffer_size=1 << 20)


class _Reader(DataSourceReader):
    def __init__(self, files: list[str], decoder: str):
        self.files, self.decoder = files, decoder

    def partitions(self):
        return [InputPartition(p) for p in self.files]

    def read(self, partition):
        module, _, name = self.decoder.rpartition(".")
        decode = getattr(importlib.import_module(module), name)
        with opened(partition.value) as f:
            for i, thing in enumerate(decode(f), 1):
                yield (partition.value, i, *fields_of(thing))


def read_paragraphs(spark: SparkSession, pattern: str, decoder: str) -> DataFrame:
    """The objects of the files that a path or pattern names: (file, ordinal, raw fields)."""
    found = storage.files(pattern)
    if not found:
        raise FileNotFoundError(pattern)
    ship(spark)
    spark.dataSource.register(ParagraphSource)
    return spark.read.format("paragraphs").option("files", json.dumps(found)).option("decoder", decoder).load()


def first_present(fields: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(strip(f), F.lit("")) for f in fields], F.lit(""))


def paragraph_id() -> Column:
    return first_present(ID_FIELDS)


def paragraph_text() -> Column:
    """The first text there is; else the bodies' texts joined by a space."""
    return F.coalesce(F.nullif(first_present(TEXT_FIELDS), F.lit("")), F.array_join(clean_items("bodies"), " "))
