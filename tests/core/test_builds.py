"""Each collection from raw files to its dataset: every output is compared."""

import json

import pytest

from granary.plans import builds


def records(path):
    return sorted((json.loads(x) for p in path.glob("part-*.json") for x in p.read_text().splitlines()), key=str)


def log_of(out):
    log = json.loads((out / "build_log.json").read_text())
    assert sum(log["error_summary"].values()) == len(log["issue_logs"])
    return log


def write(root, files):
    root.mkdir()
    for name, text in files.items():
        (root / name).write_text(text)
    return str(root)


def test_tab_separated(spark, tmp_path, capsys):
    raw = write(tmp_path / "raw", {"collection.tsv": "1\talpha\n2\tbeta\n1\tagain\n\nbroken\n3\t \n", "queries.train.tsv": "q1\tone\nq2\ttwo\n", "queries.dev.tsv": "q3\tthree\n\tno id\n", "qrels.train.tsv": "q1\t0\t1\t1\nq1\t0\t1\t2\nq1\t0\t9\t1\n", "qrels.dev.tsv": "q3\t0\t2\t3000000000\nq3\t0\t2\tx\n"})
    out = tmp_path / "out"
    assert builds.main(["tab-separated", "--input", raw, "--output", str(out)], spark) == 0
    assert records(out / "docs.jsonl") == [{"doc_id": "1", "doc_text": "alpha"}, {"doc_id": "2", "doc_text": "beta"}]
    assert records(out / "train/queries.jsonl") == [{"query_id": "q1", "query_text": "one"}, {"query_id": "q2", "query_text": "two"}]
    assert records(out / "dev/qrels.jsonl") == [{"query_id": "q3", "doc_id": "2", "relevance": 3_000_000_000}]
    about = json.loads((out / "dataset.json").read_text())
    assert about["dataset_name"] == "msmarco" and about["docs_file"] == "docs.jsonl" and about["splits"]["dev"] == {"queries_file": "dev/queries.jsonl", "qrels_file": "dev/qrels.jsonl"} and about["task"] == "doc_retrieval"
    assert about["stats"] == {
        "docs": {"doc_count": 2, "skipped_count": 3},
        "train": {"query_count": 2, "qrels_count": 1, "positive_query_count": 1, "orphan_query_count": 1, "skipped_query_count": 0, "skipped_qrels_count": 2},
        "dev": {"query_count": 1, "qrels_count": 1, "positive_query_count": 1, "orphan_query_count": 0, "skipped_query_count": 1, "skipped_qrels_count": 1},
    }
    log = log_of(out)
    assert log["stats"] == about["stats"]
    assert log["error_summary"] == {"duplicate_doc_id": 1, "duplicate_qrel_conflicting_relevance": 1, "empty_doc_text": 1, "invalid_doc_row_format": 1, "invalid_relevance": 1, "missing_doc_ref": 1, "missing_query_id": 1}
    conflict = next(x for x in log["issue_logs"] if x["issue_type"] == "duplicate_qrel_conflicting_relevance")
    assert conflict["line_num"] == 2 and conflict["split"] == "train" and conflict["record_type"] == "qrel" and conflict["detail"] == "existing=1, new=2" and conflict["file"].endswith("qrels.train.tsv")
    said = capsys.readouterr().out
    assert "docs.doc_count = 2" in said and "issue missing_doc_ref: 1" in said


def test_claims(spark, tmp_path):
    claims = ['{"id": 1, "claim": "c", "evidence": {"4": [], "9": []}}', '{"id": 2, "claim": "d", "evidence": []}', "{"]
    raw = write(tmp_path / "raw", {"corpus.jsonl": '{"doc_id": 4, "title": "T", "abstract": ["a.", " ", "b."]}\n[]\n', "claims_train.jsonl": "\n".join(claims), "own.jsonl": '{"id": 3, "claim": "e", "evidence": {}}\n'})
    out = tmp_path / "out"
    assert builds.main(["claims", "--input", raw, "--output", str(out), "--set", "dev=own.jsonl"], spark) == 0
    assert records(out / "docs.jsonl") == [{"doc_id": "4", "title": "T", "doc_text": ["a.", "b."]}]
    assert records(out / "train/qrels.jsonl") == [{"query_id": "1", "doc_id": "4", "relevance": 1}] and records(out / "dev/queries.jsonl") == [{"query_id": "3", "query_text": "e"}]
    about = json.loads((out / "dataset.json").read_text())
    assert about["task"] == "scientific_doc_retrieval" and about["metadata"]["domain"] == "scientific"
    assert about["stats"]["train"] == {"query_count": 2, "qrels_count": 1, "positive_query_count": 1, "orphan_query_count": 1, "skipped_query_count": 1, "skipped_qrels_count": 3}
    assert log_of(out)["error_summary"] == {"invalid_doc_record_format": 1, "invalid_evidence_format": 1, "invalid_qrel_json": 1, "invalid_query_json": 1, "missing_doc_ref": 1}


def test_nested_samples(spark, tmp_path):
    train = [{"_id": "q", "question": "Q?", "context": [["t", ["a", " "]], ["u", []]], "supporting_facts": [["t", 0], ["z", 1]]}, {"_id": "s", "question": "S", "context": "x", "supporting_facts": []}]
    raw = write(tmp_path / "raw", {"hotpot_train_v1.1.json": json.dumps(train), "hotpot_dev_distractor_v1.json": "{}"})
    out = tmp_path / "out"
    assert builds.main(["nested-samples", "--input", raw, "--output", str(out)], spark) == 0
    assert records(out / "train/docs.jsonl") == [{"doc_id": "q::t", "title": "t", "doc_text": ["a"]}] and records(out / "train/qrels.jsonl") == [{"query_id": "q", "doc_id": "q::t", "relevance": 1}]
    about = json.loads((out / "dataset.json").read_text())
    assert about["subset"] == "distractor" and about["splits"]["dev"]["docs_file"] == "dev/docs.jsonl" and "docs_file" not in about
    want = {"doc_count": 1, "query_count": 2, "qrels_count": 1, "positive_query_count": 1, "orphan_query_count": 1, "skipped_query_count": 0, "skipped_qrels_count": 1, "skipped_doc_count": 1}
    assert about["stats"]["train"] == about["stats"]["overall"] == want and set(about["stats"]["dev"].values()) == {0}
    assert log_of(out)["error_summary"] == {"empty_doc_sentences": 1, "invalid_context_format": 1, "invalid_json_root_type": 1, "missing_supporting_doc_in_context": 1}


def decode(f):
    yield from json.load(f)


def test_paragraphs(spark, tmp_path):
    raw = write(tmp_path / "raw", {"p.json": json.dumps([{"para_id": "a", "text": "x"}, {"id": "b"}]), "o.json": json.dumps([{"page_id": "p", "page_name": "P"}]), "r.qrels": "p 0 a 1\np 0 b 1\n"})
    out = tmp_path / "out"
    options = ["decoder=tests.core.test_builds.decode", "docs=p.json", "outlines=o.json", "qrels=r.qrels"]
    assert builds.main(["paragraphs", "--input", raw, "--output", str(out), *[x for o in options for x in ("--set", o)]], spark) == 0
    assert records(out / "docs.jsonl") == [{"doc_id": "a", "doc_text": "x"}] and records(out / "train/qrels.jsonl") == [{"query_id": "p", "doc_id": "a", "relevance": 1}]
    about = json.loads((out / "dataset.json").read_text())
    assert about["task"] == "article_paragraph_retrieval" and about["subset"] == "article" and list(about["splits"]) == ["train"]
    assert log_of(out)["error_summary"] == {"empty_doc_text": 1, "missing_doc_ref": 1}


@pytest.mark.parametrize("layout", sorted(builds.LAYOUTS))
def test_missing_inputs_end_with_1(spark, tmp_path, layout):
    more = ["--set", "decoder=tests.core.test_builds.decode"] if layout == "paragraphs" else []
    assert builds.main([layout, "--input", str(tmp_path), "--output", str(tmp_path / "out"), *more], spark) == 1
    assert not (tmp_path / "out").exists()
