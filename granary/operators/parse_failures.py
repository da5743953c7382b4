"""Raw delivery lines, split into loaded records and failures with a reason.

Strict load plus anti-join: strict_load gives the conforming rows only, with their offsets (file, line_num, line_id);
failed_lines subtracts those offsets from the raw ones and diagnoses what remains. Only offsets are shuffled by the
subtraction; CSV and TSV are judged in the JVM, and only JSON lines go to Python, in Arrow batches, because the JVM
readers accept text after the first value.

Defined cases: a null or blank line is skipped, neither loaded nor failed. A null or unknown layout fails
(unknown_layout). Rows that repeat an offset are judged by their own content. Extra columns are ignored. An empty table
gives empty results. Nesting of any depth and integers of any length are read.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip
from ..runtime import widened

OFFSET = ["file", "line_num", "line_id", "layout", "line_hash"]
#: RFC 4180 fields; possessive, so that matching needs no stack.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'
_PLAIN = '[^",\\r\\n]*+'
_FIELD = f"({_QUOTED}|{_PLAIN})"
CSV_3 = f"^{_FIELD},{_FIELD},{_FIELD}\\z"
CSV_N = f"^(?:{_QUOTED}|{_PLAIN})(?:,(?:{_QUOTED}|{_PLAIN}))*+\\z"
LOADED = "struct<doc_id:string,title:string,texts:array<string>>"


class _Number(str):
    """The digits of a JSON integer, of any length."""


def _refuse(name: str):
    raise ValueError(name)


_TOKEN = re.compile(r'[ \t\n\r]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)|(true|false|null))')


def parse_deep(text: str):
    """A strict JSON reader with a stack of its own, for nesting that the library's reader refuses."""
    at, stack, done, out = 0, [], False, None
    want = "value"  # value, first (value or end of array), key, firstkey, colon, more
    end = len(text.rstrip(" \t\n\r"))
    key = None
    keys: list = []
    while at < end:
        m = _TOKEN.match(text, at)
        if not m or done:
            raise ValueError(at)
        at = m.end()
        mark, string, number, word = m.groups()
        if want == "colon":
            if mark != ":":
                raise ValueError(at)
            want = "value"
            continue
        if want in ("key", "firstkey") and string is not None:
            key, want = json.loads(string), "colon"
            continue
        if want == "more" and mark == ",":
            want = "key" if isinstance(stack[-1], dict) else "value"
            continue
        if (mark == "]" and want in ("first", "more") and stack and isinstance(stack[-1], list)) or (mark == "}" and want in ("firstkey", "more") and stack and isinstance(stack[-1], dict)):
            value, key = stack.pop(), keys.pop()
        elif want in ("value", "first") and mark in ("[", "{"):
            stack.append([] if mark == "[" else {})
            keys.append(key)
            want = "first" if mark == "[" else "firstkey"
            continue
        elif want in ("value", "first") and mark is None:
            value = json.loads(string) if string is not None else {"true": True, "false": False, "null": None}[word] if word else _Number(number) if re.fullmatch("-?[0-9]+", number) else float(number)
        else:
            raise ValueError(at)
        if not stack:
            out, done = value, True
        elif isinstance(stack[-1], dict):
            stack[-1][key] = value
        else:
            stack[-1].append(value)
        want = "more"
    if not done:
        raise ValueError("end")
    return out


def read_json(line: str):
    """The line's one value by RFC 8259; raises ValueError on anything else."""
    try:
        return json.loads(line, parse_constant=_refuse, parse_int=_Number)
    except RecursionError:
        return parse_deep(line)


def judge_json(line: str) -> tuple[str | None, tuple | None]:
    """(reason, None), or (None, (doc_id, title, texts))."""
    try:
        value = read_json(line)
    except ValueError:
        return "invalid_json", None
    if not isinstance(value, dict):
        return "not_an_object", None
    doc_id, texts, title = value.get("doc_id"), value.get("abstract"), value.get("title")
    if not isinstance(doc_id, str):
        return "invalid_doc_id" if doc_id is not None else "missing_doc_id", None
    if not doc_id.strip():
        return "blank_doc_id", None
    if not isinstance(texts, list):
        return "invalid_abstract", None
    if not all(x is None or isinstance(x, str) and not isinstance(x, _Number) for x in texts):
        return "invalid_abstract_item", None
    if not any(x and x.strip() for x in texts):
        return "blank_abstract", None
    return None, (doc_id.strip(), title if isinstance(title, str) and not isinstance(title, _Number) else None, texts)


def _utf8(x: str | None) -> str | None:
    return None if x is None else x.encode("utf-8", "replace").decode()


def _load_json(batches):
    for b in batches:
        kept, rows = [], []
        for i, line in enumerate(b.column("line").to_pylist()):
            record = judge_json(line)[1]
            if record is not None:
                kept.append(i)
                rows.append({"doc_id": _utf8(record[0]), "title": _utf8(record[1]), "texts": [_utf8(x) for x in record[2]]})
        out = b.select(OFFSET).take(pa.array(kept, pa.int64()))
        kind = pa.struct([("doc_id", pa.string()), ("title", pa.string()), ("texts", pa.list_(pa.string()))])
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(rows, kind)], [*OFFSET, "record"])


def _explain_json(batches):
    for b in batches:
        reasons = [judge_json(line)[0] for line in b.column("line").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.select(OFFSET).columns, pa.array(reasons, pa.string())], [*OFFSET, "reason"])


def _offsets(lines: DataFrame) -> DataFrame:
    """The lines that aren't blank, with their offset columns alone."""
    layout = F.coalesce(F.lower(strip("layout")), F.lit("")).alias("layout")
    return lines.where(~is_blank("line")).select("file", F.col("line_num").cast("long").alias("line_num"), F.col("line_id").cast("long").alias("line_id"), layout, F.sha2("line", 256).alias("line_hash"), "line")


def _field(n: int) -> Column:
    raw = F.regexp_extract("line", CSV_3, n)
    return F.when(raw.startswith('"'), F.replace(F.substr(raw, F.lit(2), F.char_length(raw) - 2), F.lit('""'), F.lit('"'))).otherwise(raw)


def _tsv() -> tuple[Column, Column, Column]:
    tab = F.instr("line", "\t")
    return tab, F.substr(F.col("line"), F.lit(1), tab - 1), F.substr(F.col("line"), tab + 1, F.char_length("line"))


def strict_load(lines: DataFrame) -> DataFrame:
    """The conforming records: (file, line_num, line_id, layout, line_hash, doc_id, title, texts)."""
    raw = _offsets(lines)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.drop("line").schema) + f", record {LOADED}"
    from_json = widened(raw.where(F.col("layout") == "jsonl")).mapInArrow(_load_json, schema)
    csv = (
        raw.where((F.col("layout") == "csv") & F.col("line").rlike(CSV_3))
        .select(*OFFSET, F.struct(strip(_field(1)).alias("doc_id"), _field(2).alias("title"), F.array(_field(3)).alias("texts")).alias("record"))
        .where(~is_blank("record.doc_id") & ~is_blank(F.col("record.texts")[0]))
    )
    tab, before, after = _tsv()
    tsv = (
        raw.where((F.col("layout") == "tsv") & (tab > 0) & ~is_blank(before) & ~is_blank(after))
        .select(*OFFSET, F.struct(strip(before).alias("doc_id"), F.lit(None).cast("string").alias("title"), F.array(after).alias("texts")).alias("record"))
    )
    return from_json.unionByName(csv).unionByName(tsv).select(*OFFSET, "record.*")


def failed_lines(lines: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """The lines that weren't loaded: (file, line_num, line_id, layout, line_hash, reason).

    loaded: what strict_load gave, if it is at hand."""
    raw = _offsets(lines)
    good = (strict_load(lines) if loaded is None else loaded).select(*[F.col(c).alias(f"_g_{c}") for c in OFFSET])
    rest = raw.join(good, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in OFFSET], "left_anti")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.drop("line").schema) + ", reason string"
    by_json = rest.where(F.col("layout") == "jsonl").mapInArrow(_explain_json, schema)
    tab, before, after = _tsv()
    reason = (
        F.when(
            F.col("layout") == "csv",
            F.when(~F.col("line").rlike(CSV_N), "broken_quoting").when(~F.col("line").rlike(CSV_3), "wrong_column_count")
            .when(is_blank(_field(1)), "blank_doc_id").otherwise("blank_abstract"),
        )
        .when(F.col("layout") == "tsv", F.when(tab == 0, "wrong_column_count").when(is_blank(before), "blank_doc_id").otherwise("blank_text"))
        .otherwise("unknown_layout")
    )
    return by_json.unionByName(rest.where(F.col("layout") != "jsonl").select(*OFFSET, reason.alias("reason")))
