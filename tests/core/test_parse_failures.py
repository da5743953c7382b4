import csv
import io
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.operators.parse_failures import failed_lines, judge_json, parse_deep, read_json, strict_load

SCHEMA = "line_id long, file string, layout string, line_num long, line string, doc_id string, reason string"
OK = '{"doc_id": 1, "abstract": ["a"]}'
GOOD = {
    "jsonl": [OK, ' \t{"abstract":[null,"x"],"doc_id":"7","more":{"doc_id":null}}\r', '{"doc_id": %s, "abstract": ["a"]}' % ("9" * 6000), '{"doc_id":"a","abstract":["\\ud800"],"t":%s}' % ("[" * 30_000 + "]" * 30_000)],
    "csv": ["1,,x", '"1","a ""b"" c","l1\nl2"', " 1 ,t,河"],
    "tsv": ["1\tx", '1\t"x\ty', " 1\t \tz"],
}
BAD = {
    "jsonl": {
        "{}": "missing_doc_id", "[1]": "not_an_object", OK + OK: "invalid_json", OK + "x": "invalid_json", OK[:-1]: "invalid_json", '{"doc_id": NaN, "abstract": ["a"]}': "invalid_json", '{"doc_id": 01, "abstract": ["a"]}': "invalid_json", '{"doc_id": 1, "abstract": ["a",]}': "invalid_json",
        "{'doc_id': 1, 'abstract': ['a']}": "invalid_json", '{"doc_id": 1, "abstract": ["a\tb"]}': "invalid_json", ' ' + OK: "invalid_json", '﻿' + OK: "invalid_json", '{"doc_id": true, "abstract": ["a"]}': "invalid_doc_id", '{"doc_id": 1.0, "abstract": ["a"]}': "invalid_doc_id", '{"doc_id": null, "abstract": ["a"]}': "missing_doc_id",
        '{"doc_id": " ", "abstract": ["a"]}': "blank_doc_id", '{"doc_id": 1, "abstract": "a"}': "invalid_abstract", '{"doc_id": 1}': "invalid_abstract", '{"doc_id": 1, "abstract": ["a", 1]}': "invalid_abstract_item", '{"doc_id": 1, "abstract": [" ", null]}': "blank_abstract", "[" * 50_000: "invalid_json",
    },
    "csv": {"1,2": "wrong_column_count", "1,2,3,4": "wrong_column_count", '1,"a,b': "broken_quoting", '1,a"b,c': "broken_quoting", '1,"a"x,c': "broken_quoting", "1,a\nb,c": "broken_quoting", " ,a,b": "blank_doc_id", '"",a,b': "blank_doc_id", "1,a, ": "blank_abstract", '1,a,"　"': "blank_abstract", '1, "a",b': "broken_quoting"},
    "tsv": {"1 x": "wrong_column_count", " \tx": "blank_doc_id", "1\t \t": "blank_text"},
}


def lines():
    rows, want = [], {}
    for layout, texts in GOOD.items():
        rows += [(layout, t) for t in texts]
    for layout, texts in BAD.items():
        for t, why in texts.items():
            want[len(rows)] = why
            rows.append((layout, t))
    rows += [("jsonl", None), ("csv", " \r"), ("tsv", " ")]
    for layout in (None, "xml"):
        want[len(rows)] = "unknown_layout"
        rows.append((layout, "x"))
    return [(i, "f", layout, i, t, "clash", "clash") for i, (layout, t) in enumerate(rows)], want


def test_good_and_failed(spark):
    rows, want = lines()
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.line_id: r.reason for r in failed_lines(df).collect()} == want
    loaded = {r.line_id: r for r in strict_load(df).collect()}
    n = sum(map(len, GOOD.values()))
    assert sorted(loaded) == list(range(n)) and loaded[0].texts == ["a"] and loaded[5].title == 'a "b" c'


def test_rows_that_share_an_offset(spark):
    rows = [(1, "f", "csv", 1, "1,a,b", "", ""), (1, "f", "csv", 1, "1,a", "", ""), (1, "f", "csv", 1, "1,a,b", "", ""), (None, None, "tsv", None, "x", "", ""), (None, None, "tsv", None, "1\tx", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert strict_load(df).count() == 3 and sorted(r.reason for r in failed_lines(df).collect()) == ["wrong_column_count"] * 2
    assert failed_lines(df.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8), st.text(alphabet='{}[],:"1 tx\n', max_size=3))
def test_both_json_readers_agree(value, junk):
    text = json.dumps(value) + junk
    try:
        want = read_json(text)
    except ValueError:
        with pytest.raises(ValueError):
            parse_deep(text)
    else:
        assert parse_deep(text) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet='a,"\n\r é', max_size=6), min_size=3, max_size=3))
def test_written_csv_is_good(cells):
    import re

    from granary.operators.parse_failures import CSV_3

    out = io.StringIO()
    csv.writer(out, lineterminator="", quoting=csv.QUOTE_ALL).writerow(cells)
    assert re.match(CSV_3.replace("\\z", "\\Z"), out.getvalue())


def test_judge_keeps_last_of_equal_keys():
    assert judge_json('{"doc_id": null, "doc_id": "b", "abstract": ["x"]}') == (None, ("b", None, ["x"]))
