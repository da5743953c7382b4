"""Files that are one JSON array each, read element by element, as a Python data source.

A file is read twice, in pieces: once to tell whether it is a whole, well-formed array, and once for its elements; a task holds
one piece and one element. Each file is a partition."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import storage
from ..runtime import ship
from .json_records import samples_of
from .paragraphs import opened

SCHEMA = "file string, line_num long, text string, issue_type string, detail string"
#: JSON's own white space.
_SPACE = " \t\r\n"
_KINDS = {dict: "dict", str: "str", bool: "bool", int: "int", float: "float", type(None): "NoneType"}


class WrongRoot(ValueError):
    """The file is well-formed, but no array; args[0] names its type."""


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def elements(stream, piece: int = 1 << 20) -> Iterator[str]:
    """The texts of the array's elements, in order. Raises ValueError where the file is malformed."""
    decode = codecs.getincrementaldecoder("utf-8")().decode
    value = json.JSONDecoder(parse_constant=_refuse).raw_decode
    text, at, ended = "", 0, False

    def more() -> None:
        nonlocal text, at, ended
        raw = stream.read(max(piece, len(text) - at))  # doubles what is held, so a large element is tried few times
        text, at, ended = text[at:] + decode(raw, not raw), 0, not raw

    def mark() -> str:
        """The next character that isn't white space, "" at the end."""
        nonlocal at
        while True:
            while at < len(text) and text[at] in _SPACE:
                at += 1
            if at < len(text) or ended:
                return text[at : at + 1]
            more()

    def one() -> tuple[object, str]:
        nonlocal at
        while True:
            try:
                got, end = value(text, at)
                if end < len(text) or ended:
                    found, at = text[at:end], end
                    return got, found
            except ValueError:
                if ended:
                    raise
            more()

    if mark() != "[":
        root, _ = one()
        if mark():
            raise ValueError("text after the value")
        raise WrongRoot(_KINDS[type(root)])
    at += 1
    if mark() == "]":
        at += 1
    else:
        while True:
            mark()
            yield one()[1]
            after = mark()
            at += 1
            if after == "]":
                break
            if after != ",":
                raise ValueError("neither a comma nor the array's end")
    if mark():
        raise ValueError("text after the array")


class JsonArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_arrays"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["files"]))


class _Reader(DataSourceReader):
    def __init__(self, files: list[str]):
        self.files = files

    def partitions(self):
        return [InputPartition(p) for p in self.files]

    def read(self, partition):
        file = partition.value
        try:
            with opened(file) as f:
                for _ in elements(f):
                    pass
        except WrongRoot as e:
            yield (file, None, None, "invalid_json_root_type", f"type={e.args[0]}")
            return
        except (ValueError, RecursionError):
            yield (file, None, None, "invalid_json_file", None)
            return
        with opened(file) as f:
            for i, text in enumerate(elements(f), 1):
                yield (file, i, text, None, None)


def json_array_files(spark: SparkSession, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(samples (file, line_num, v), issues (file, issue_type, detail)). line_num is the ordinal of the sample. A file that is
    malformed or no array is skipped as a whole."""
    found = storage.files(pattern)
    if not found:
        raise FileNotFoundError(pattern)
    ship(spark)
    spark.dataSource.register(JsonArraySource)
    return samples_of(spark.read.format("json_arrays").option("files", json.dumps(found)).load())
