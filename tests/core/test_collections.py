import io
import json

import pytest

from granary.plans import collections as co
from granary.sources import json_records as js
from granary.sources import lines as ln
from granary.sources import paragraphs as pp
from granary.sources.json_arrays import elements, json_array_files

LINES = "file string, line_num long, line string"


def numbered(spark, texts):
    return spark.createDataFrame([("f", i, t) for i, t in enumerate(texts, 1)], LINES)


def issues(checked):
    return sorted((r.line_num, r.issue_type, r.record_id, r.detail) for r in checked.issues.collect())


def rows(checked):
    return sorted(map(tuple, checked.accepted.collect()))


def test_tsv_collection(spark):
    docs = co.tsv_docs(numbered(spark, ["1\ta\tb", "", " \n", "2", "\tx", "3\t ", "1\tagain", " 4 \t d ", "3\tlate", "x" * 400]))
    assert rows(docs) == [("1", "a\tb"), ("3", "late"), ("4", "d")]
    assert issues(docs) == [(4, "invalid_doc_row_format", None, "2"), (5, "missing_doc_id", None, None), (6, "empty_doc_text", "3", None), (7, "duplicate_doc_id", "1", None), (10, "invalid_doc_row_format", None, "x" * 300)]
    queries = co.tsv_queries(numbered(spark, ["q1\ta", "q2\tb", "q1\tc", "q3\td"]), "dev")
    assert {r.split for r in queries.issues.collect()} == {"dev"} and len(rows(queries)) == 3
    qrels = co.tsv_qrels(
        numbered(spark, ["q1\t0\t1\t1", "q1\t0\t1", "\t0\t1\t1", "q1\t0\t\t1", "q1\t0\t1\t1.0", "q9\t0\t1\t1", "q1\t0\t9\t1", "q1\t0\t1\t1", "q1\t0\t1\t2", "q2\t0\t3\t1_0", "q2\t0\t4\t-1", "q1\t0\t1\t+1", "q3\t0\t1\t3000000000"]), queries.accepted, docs.accepted, "dev"
    )
    assert rows(qrels) == [("q1", "1", 1), ("q2", "3", 10), ("q2", "4", -1), ("q3", "1", 3_000_000_000)]
    assert issues(qrels) == [
        (2, "invalid_qrel_row_format", None, "q1\t0\t1"), (3, "missing_qrel_query_id", None, None), (4, "missing_qrel_doc_id", "q1", None), (5, "invalid_relevance", "q1::1", "1.0"), (6, "missing_query_ref", "q9::1", None),
        (7, "missing_doc_ref", "q1::9", None), (8, "duplicate_qrel_same_relevance", "q1::1", "1"), (9, "duplicate_qrel_conflicting_relevance", "q1::1", "existing=1, new=2"), (12, "duplicate_qrel_same_relevance", "q1::1", "1"),
    ]
    stats = {(r.part, r.metric): r.value for r in co.build_stats(docs, {"dev": (queries, qrels)}).collect()}
    assert stats == {("docs", "doc_count"): 3, ("docs", "skipped_count"): 5, ("dev", "query_count"): 3, ("dev", "skipped_query_count"): 1, ("dev", "qrels_count"): 4, ("dev", "skipped_qrels_count"): 9, ("dev", "positive_query_count"): 3, ("dev", "orphan_query_count"): 0}


def test_json_collection(spark):
    docs = co.json_docs(numbered(spark, ['{"doc_id": 1, "title": " T ", "abstract": [" a ", "", null, 5]}', "[1]", "{", '{"title": "x"}', '{"doc_id": "2", "abstract": "x"}', '{"doc_id": "2", "abstract": [" "]}', '{"doc_id": "1", "abstract": ["x"]}', '"x"', "{} {}", '{"doc_id": 3, "doc_id": 4, "abstract": ["y"]}']))
    assert rows(docs) == [("1", "T", ["a", "5"]), ("4", "", ["y"])]
    assert issues(docs) == [
        (2, "invalid_doc_record_format", None, "type=list"), (3, "invalid_doc_json", None, None), (4, "missing_doc_id", None, None), (5, "invalid_abstract_format", "2", "type=str"),
        (6, "empty_doc_text", "2", None), (7, "duplicate_doc_id", "1", None), (8, "invalid_doc_record_format", None, "type=str"), (9, "invalid_doc_json", None, None),
    ]
    claims = numbered(spark, ['{"id": 7, "claim": "c", "evidence": {"1": [], " ": 1, "9": 2, "4": {}}}', '{"id": 7, "claim": "again", "evidence": {"1": []}}', '{"id": 8, "claim": " "}', '{"id": 9, "claim": "d", "evidence": [1]}', '{"claim": "d"}'])
    queries = co.json_queries(claims, "train")
    assert rows(queries) == [("7", "c"), ("9", "d")]
    qrels, whole = co.evidence_qrels(claims, queries.accepted, docs.accepted, "train")
    assert rows(qrels) == [("7", "1", 1), ("7", "4", 1)]
    assert sorted((r.issue_type, r.record_id) for r in qrels.issues.collect()) == [("duplicate_qrel_same_relevance", "7::1"), ("missing_doc_ref", "7::9"), ("missing_evidence_doc_id", "7")]
    assert sorted((r.issue_type, r.record_id or "", r.detail or "") for r in whole.collect()) == [("invalid_evidence_format", "9", "type=list"), ("missing_qrel_query_id", "", ""), ("missing_query_ref", "8", "")]


def test_nested_samples(spark, tmp_path):
    good = {"_id": "q", "question": "Q?", "context": [["t", ["a", " "]], ["", ["x"]], ["u", "x"], ["v", []], ["t", ["b"]], 5], "supporting_facts": [["t", 0], ["t", 1], ["zz", 0], ["", 0], [1]]}
    samples = [good, 3, {"_id": " "}, {"_id": "r", "question": ""}, good, {"_id": "s", "question": "S", "context": "x", "supporting_facts": None}]
    bad = {"g": "{", "h": "{}", "i": "[1, 2", "j": "[1] x", "k": "[NaN]", "l": "7", "m": "[1 2]", "n": "[,]"}
    for name, text in ({"f": json.dumps(samples), "empty": " [ ]\n"} | bad).items():
        (tmp_path / f"{name}.json").write_text(text)
    table, broken = json_array_files(spark, f"{tmp_path}/*.json")
    kinds = {"h": ("invalid_json_root_type", "type=dict"), "l": ("invalid_json_root_type", "type=int")}
    assert sorted((r.file.rsplit("/")[-1][0], r.issue_type, r.detail) for r in broken.collect()) == [(n, *kinds.get(n, ("invalid_json_file", None))) for n in bad]
    hops = co.multi_hop(table, "train")
    assert rows(hops.queries) == [("q", "Q?"), ("s", "S")] and rows(hops.docs) == [("q::t", "t", ["a"])] and rows(hops.qrels) == [("q", "q::t", 1)]
    assert [x[1:] for x in issues(hops.queries)] == [("invalid_sample_format", None, "type=int"), ("missing_query_id", None, None), ("empty_query_text", "r", None), ("duplicate_query_id", "q", None)]
    assert sorted(x[1:] for x in issues(hops.docs)) == [("duplicate_doc_id", "q::t", None), ("empty_doc_sentences", "q::v", None), ("invalid_context_entry_format", "q", "context_idx=6"), ("invalid_context_sentences_format", "q::u", "type=str"), ("missing_doc_title", "q", "context_idx=2")]
    assert sorted(x[1:] for x in issues(hops.qrels)) == [("invalid_supporting_fact_entry_format", "q", "fact_idx=5"), ("missing_supporting_doc_in_context", "q::zz", None), ("missing_supporting_fact_title", "q", "fact_idx=4")]
    assert sorted((r.issue_type, r.detail) for r in hops.notes.collect()) == [("invalid_context_format", "type=str"), ("invalid_supporting_facts_format", "type=NoneType")]
    stats = co.multi_hop_stats({"train": hops}).where("split is null").first().asDict()
    assert stats == {"split": None, "doc_count": 1, "query_count": 2, "qrels_count": 1, "positive_query_count": 1, "orphan_query_count": 1, "skipped_doc_count": 5, "skipped_query_count": 4, "skipped_qrels_count": 3}


def decode(f):
    yield from json.load(f)


def test_paragraphs(spark, tmp_path):
    things = [{"para_id": " ", "id": "a", "text": "", "bodies": [{"text": " x "}, {"text": None}, {"text": "y"}]}, {"paragraph_id": "b", "paragraph": "t"}, {"id": "a", "text": "again"}, {"text": "no id"}, {"id": "c"}, {"page_id": "p", "page_name": "Page"}, {"page_id": "p", "page_name": "Other"}]
    (tmp_path / "a.bin").write_text(json.dumps(things))
    table = pp.read_paragraphs(spark, f"{tmp_path}/*.bin", "tests.core.test_collections.decode")
    docs = co.paragraph_docs(table.where("page_id is null"), pp.ORDER)
    assert rows(docs) == [("a", "x y"), ("b", "t")]
    assert sorted(r.issue_type for r in docs.issues.collect()) == ["duplicate_doc_id", "empty_doc_text", "missing_doc_id"]
    queries = co.outline_queries(table.where("page_id is not null"), "train", pp.ORDER)
    assert rows(queries) == [("p", "Page")]
    qrels = co.spaced_qrels(numbered(spark, ["p 0 a 3", " p Q0\tb  0 ", "p 0 a 1", "p 0 a", "z 0 a 1", "p 0 z 1"]), queries.accepted, docs.accepted, "train")
    assert rows(qrels) == [("p", "a", 1), ("p", "b", 1)]
    assert [x[1] for x in issues(qrels)] == ["duplicate_qrel_same_relevance", "invalid_qrel_row_format", "missing_query_ref", "missing_doc_ref"]
    assert [r.query_id for r in co.orphans(queries.accepted, qrels.accepted, positive_only=True).collect()] == []


def test_line_numbers_over_many_splits(spark, tmp_path):
    want = set()
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        texts = [f"{name}{i}" * (i % 7) for i in range(3000)]
        (tmp_path / name).write_bytes(end.join(texts).encode())
        want |= {(name, i, t) for i, t in enumerate(texts, 1)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for most in (0, ln.MOST_BLOCKS):
            got = {(r.file.rsplit("/")[-1], r.line_num, r.line) for r in ln.numbered_lines(spark, str(tmp_path), most).collect()}
            assert {x for x in got if x[1] <= 3000} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lenient_json_drops_other_values_and_fails_on_broken_text(spark):
    assert [r.line_num for r in js.json_objects(numbered(spark, ["{}", "[1]", "", "5", '{"a": 1}'])).collect()] == [1, 5]
    with pytest.raises(Exception, match="malformed JSON in line 2"):
        js.json_objects(numbered(spark, ["{}", "{"])).collect()


def test_hot_and_repeated_ids_keep_one_row(spark):
    df = spark.createDataFrame([("f", 1 + i, f"same\t{i}") for i in range(200)] + [("g", 2, "other\tx")] * 3, "file string, at long, line string")
    docs = co.tsv_docs(df, ("file", "at"))  # an order that doesn't tell all rows apart
    assert docs.accepted.count() == 2 and docs.issues.count() == 201 and rows(docs) == [("other", "x"), ("same", "0")]


def test_plans_are_made_without_running_anything(spark):
    tracker = spark.sparkContext.statusTracker()
    lines = numbered(spark, ["1\ta", "1\tb"])
    before = len(tracker.getJobIdsForGroup(None))
    docs = co.tsv_docs(lines)
    co.tsv_qrels(lines, co.tsv_queries(lines, "dev").accepted, docs.accepted, "dev")
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert rows(docs) == [("1", "a")]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_elements_of_an_array_are_read_in_pieces(piece):
    values = [1, -2.5e3, "a]\\\"[,", None, True, [1, [2]], {"k": [" ", {}]}, "é河", 12345678901234567890]
    for text in (json.dumps(values), json.dumps(values, ensure_ascii=False, indent=3) + "\n ", "[]", " [ ] "):
        got = [json.loads(x) for x in elements(io.BytesIO(text.encode()), piece)]
        assert got == json.loads(text)
    for text in ("", "[", "[1", "[1,]", "[1] 2", "nul", "[Infinity]", '["a', "{} x"):
        with pytest.raises(ValueError):
            list(elements(io.BytesIO(text.encode()), piece))
