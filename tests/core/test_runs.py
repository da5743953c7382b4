import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary import config
from granary.operators import encoders as en
from granary.plans import embedding as em
from granary.sinks import tables as sinks
from granary.sources import manifests
from granary.streaming import ingest

RAW = {"datasets": [" toy "], "experiment": {"embedding_dim": 17, "max_length": 300, "doc_prefix": "D: "}, "inference": {"batch_size": "8"}, "models": [{"model_id": "org/m", "provider": "sentence_transformers", "query_prefix": "Q: ", "batch_size": 2, "embedding_dim": 5}]}


def test_settings_and_defaults(spark, tmp_path):
    s = config.settings(RAW)
    m = s.models[0]
    assert s.datasets == ("toy",) and m.experiment == config.Experiment(17, 300, "Q: ", "D: ", "") and m.inference == config.Inference(2)
    assert config.Experiment() == config.Experiment(768, 512, "", "", "") and config.Inference() == config.Inference(64, "cuda", "", 30.0, 2)
    (tmp_path / "s.yaml").write_text(json.dumps(RAW))
    assert config.load(tmp_path / "s.yaml") == s
    for change in ({"datasets": []}, {"datasets": [" "]}, {"datasets": "x"}, {"models": []}, {"models": [1]}, {"models": [{"model_id": "a"}]}, {"models": RAW["models"] * 2}, {"experiment": []}, {"experiment": {"embedding_dim": "x"}}):
        with pytest.raises(config.ConfigError):
            config.settings(RAW | change)
    with pytest.raises(config.ConfigError):
        config.load(tmp_path / "none.yaml")


def test_http_encoder():
    calls = []

    def post(url, body, timeout):
        calls.append(len(body["chunks"]))
        return {"vectors": [[3.0, 4.0, 0.0]] * len(body["chunks"])}

    e = en.HttpEncoder("u", 3, batch_size=2, post=post)
    assert e.encode(["a"] * 5).tolist()[4] == [0.6, 0.8, 0.0] and calls == [2, 2, 1] and e.encode([]).shape == (0, 3)
    for answer in ({"vectors": [[1.0]]}, {}, [], OSError("down"), ValueError("no json")):
        tries = []

        def bad(*_, answer=answer, tries=tries):
            tries.append(1)
            if isinstance(answer, Exception):
                raise answer
            return answer

        with pytest.raises(en.EncoderError):
            en.HttpEncoder("u", 3, retries=1, post=bad).encode(["a", "b"])
        assert len(tries) == 2


class Model:
    max_seq_length = 100

    def tokenizer(self, texts, **_):
        return {"input_ids": [t.split() for t in texts]}

    def encode(self, texts, batch_size):
        return np.array([[3.0, 4.0], [0.0, 0.0]][: len(texts)])


def test_local_encoder_and_factory():
    e = en.LocalEncoder("sentence_transformers", "m", max_length=512, loader=lambda *_: Model())
    assert e.length == 100 and e.encode(["a", "b"]).tolist() == [[0.6, 0.8], [0.0, 0.0]] and en.token_lengths(e, ["a b", "c"]) == [2, 1] and en.token_lengths(en.LetterProfile(), ["a"]) is None
    flag = en.LocalEncoder("flag_embedding", "m", max_length=50, loader=lambda *_: Model())
    assert flag.length == 50 and flag.encode(["a"]).tolist() == [[0.6, 0.8]]
    m = config.settings(RAW).models[0]
    assert isinstance(en.factory_for(m, config.Inference(embedding_api_url=" http://x "), 3, 9)(), en.HttpEncoder)
    with pytest.raises(en.EncoderError):
        en.factory_for(config.Model("a", "nope"), config.Inference(), 3, 9)
    with pytest.raises(en.EncoderError):
        en.checked(np.zeros((2, 5)), 2, 4)
    with pytest.raises(en.EncoderError):
        en.checked(np.zeros(2), 2, 4)


def test_token_lengths_are_logged(caplog):
    import logging

    with caplog.at_level(logging.INFO, "granary"):
        told = en.told_lengths([3, 6, 90], 100, "m")
        assert told == {"texts": 3, "least": 3, "most": 90, "mean": 33.0, "over_limit": 0} and en.told_lengths([], 10, "m")["most"] == 0
        e = en.LocalEncoder("sentence_transformers", "m", max_length=2, loader=lambda *_: Model())
        e.encode(["a b", "c"])
    said = [r.getMessage() for r in caplog.records if r.levelname == "WARNING"]
    assert said == ["m: text 2 of the batch has 90 tokens, limit 100", "m: text 0 of the batch has 2 tokens, limit 2", "m: text 1 of the batch has 1 tokens, limit 2"]


def test_workers_get_the_cache(monkeypatch):
    monkeypatch.delenv("HF_HOME", raising=False)
    assert em.in_cache(lambda: en.os.environ["HF_HOME"], {"HF_HOME": "there"})() == "there"


def test_model_cache(tmp_path):
    env = {"HF_HOME": "kept"}
    root, given = en.model_cache(tmp_path / "c", env)
    assert given["HF_HOME"] == "kept" and given["HF_HUB_CACHE"] == str(root / "downloads") and (root / "sentences").is_dir()


def test_stand_in_is_the_same_in_both_engines(spark):
    texts = ["", "Hello, wOrld", "河流 e e"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(en.letter_profile(F.col("t")).alias("v"), F.col("t"))
    assert [r.v for r in df.collect()] == en.LetterProfile().encode(texts).tolist()


def test_length_stats(spark):
    r = en.length_stats(spark.createDataFrame([(3,), (6,), (None,)], "n int"), F.col("n"), 7).first()
    assert (r.texts, r.least, r.most, r.mean, r.over_limit, r.near_limit) == (2, 3, 6, 4.5, 0, 1)


def dataset(root, docs):
    (root / "toy/train").mkdir(parents=True)
    (root / "toy/dataset.json").write_text(json.dumps(sinks.manifest("toy", {}, ("train",))))
    (root / "toy/docs.jsonl").write_text("\n".join(json.dumps(d) for d in docs) + "\n\n[1]\n")
    (root / "toy/train/queries.jsonl").write_text('{"query_id": 1, "query_text": " what? "}\n')


def local(model, inference, dim, max_length):
    return en.LetterProfile


def test_whole_run(spark, tmp_path):
    dataset(tmp_path, [{"doc_id": "a", "doc_text": " one text "}, {"doc_id": "b", "doc_text": ["s one.", "", "s two."]}, {"doc_id": None, "doc_text": "none"}])
    em.run(spark, str(tmp_path), config.settings(RAW), str(tmp_path / "out"), str(tmp_path / "work"), make=local)
    docs = spark.read.parquet(str(tmp_path / "out/org_m/toy/docs_dim17"))
    assert docs.columns == list(sinks.DOC_COLUMNS) and sorted((r.doc_id, r.chunk_id, r.chunk_text) for r in docs.collect()) == [("None", "None#c001", "none"), ("a", "a#c001", "one text"), ("b", "b#c001", "s one. s two.")]
    queries = spark.read.parquet(str(tmp_path / "out/org_m/toy/queries_dim17")).collect()
    assert [(r.query_id, r.query_text, len(r.query_embedding)) for r in queries] == [("1", "what?", 17)]
    assert dict(docs.dtypes)["chunk_vector"] == "array<double>" and dict(docs.dtypes)["chunk_rank"] == "bigint"


@pytest.mark.parametrize("docs", [[{"doc_id": "a", "doc_text": " "}], [{"doc_text": "x"}], [], [{"doc_id": "a", "doc_text": 5}]])
def test_bad_runs_fail(spark, tmp_path, docs):
    dataset(tmp_path, docs)
    with pytest.raises(Exception):  # noqa: B017
        em.run(spark, str(tmp_path), config.settings(RAW), str(tmp_path / "out"), str(tmp_path / "work"), make=local)
    assert em.main(spark, str(tmp_path / "none"), "x", "o", "w") == 1


def test_manifests(spark, tmp_path):
    dataset(tmp_path, [])
    assert manifests.dataset(tmp_path, "toy").docs.endswith("toy/docs.jsonl")
    for name in ("TOY", "none"):
        with pytest.raises(config.DatasetError):
            manifests.dataset(tmp_path, name)
    (tmp_path / "toy/dataset.json").write_text('{"splits": {}}')
    with pytest.raises(config.DatasetError):
        manifests.dataset(tmp_path, "toy")
    with pytest.raises(FileNotFoundError):
        manifests.require(tmp_path, tmp_path / "nothing")
    m = sinks.manifest("x", {}, ("train", "dev"), docs_per_split=True)
    assert m["splits"]["dev"]["docs_file"] == "dev/docs.jsonl" and "docs_file" not in m


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("b", "ü", 2), ("c", "x", 3)], "k string, v string, n int")
    sinks.write_json_lines(df, str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    assert '{"k":"a","n":1}' in text and "ü" in text
    for _ in range(2):
        sinks.write_shards(df.coalesce(1), str(tmp_path / "p"), ("n", "k"), 2)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 2 and spark.read.parquet(str(tmp_path / "p")).columns == ["n", "k"]
    calls = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "e")], "call int, k string")
    sinks.write_call_shards(calls, str(tmp_path / "s"), ("k",), "call", 2)
    assert sorted((r.shard, r.k) for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [(0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e")]
    for f in (sinks.write_shards, lambda *a: sinks.with_call_shards(df, "n", 0)):
        with pytest.raises(ValueError):
            f(df, str(tmp_path / "p"), ("k",), 0)
    issues = spark.createDataFrame([("x", "skip", None), ("x", "skip", "d"), ("y", "skip", None)], "issue_type string, action string, detail string")
    at = tmp_path / "log/build.json"
    for folder in (None, str(tmp_path / "all")):
        assert sinks.write_build_log(at, issues, {"docs": {"n": 1}}, folder) == {"x": 2, "y": 1}
        log = json.loads(at.read_text())
        assert log["stats"] == {"docs": {"n": 1}} and log["error_summary"] == {"x": 2, "y": 1} and {"issue_type": "y", "action": "skip"} in log["issue_logs"] and len(log["issue_logs"]) == 3
    sinks.write_build_log(at, issues.limit(0), {})
    assert json.loads(at.read_text()) == {"stats": {}, "error_summary": {}, "issue_logs": []}
    many = spark.range(10_001).selectExpr("'f' as file", "id as line_num", "'x' as issue_type")
    sinks.write_build_log(at, many, {})
    assert [x["line_num"] for x in json.loads(at.read_text())["issue_logs"]] == list(range(10_001))
    assert sinks.report({"docs": {"n": 1}}, {"x": 2}) == "docs.n = 1\nissue x: 2"


def test_stream_equals_batch(spark, tmp_path):
    docs = [("a", ["one."], "2025-01-01"), ("a", [" one. "], "2025-01-02"), ("b", None, "2025-01-01"), (" ", ["x"], "2025-01-01"), ("c", ["x. ", "y."], "2025-01-03")]
    df = spark.createDataFrame(docs, "doc_id string, doc_text array<string>, t string").select("doc_id", "doc_text", F.to_timestamp("t").alias("loaded_at"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.candidate_stream(ingest.stream_parquet(spark, str(tmp_path / "in"), 1), "30 days")
    ingest.write_available(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted((r.doc_id, r.candidates[0].text) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", "one."), ("c", "x. y.")]
