import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")
from granary.llm import bpe, encoding, token_budget  # noqa: E402

from granary.llm.queries import TOKENIZERS  # noqa: E402

PATH, WORDS = (f"{TOKENIZERS}/{n}.json" for n in ("byte_bpe_50k", "word_bpe_49k"))
TEXTS = [":\U0003d000 x", "", None, " ", "  a\n\n b", "hello world", "<|endoftext|> x", "aaaaaaaaaaaaaaaaaaaaaaaa", "Straße 北京 été", "it's we'll 12345", "x" * 50_000, "😀😀", "a　b\xa0c", "hello world"]


def reference(path=PATH):
    t = tokenizers.Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids if x else []


@pytest.mark.parametrize("path", [PATH, WORDS])
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="aB c'sté\nİ12", max_size=60)), max_size=6))
def test_replay_equals_library(path, texts):
    m, ref = bpe.merges(path), reference(path)
    for t in texts:
        assert [i for ids in m.replay(m.pieces(t)) for i in ids] == ref(t)


@pytest.mark.parametrize("block,path", [(10, PATH), (2_000_000, PATH), (50, WORDS)])
def test_encode_corpus(spark, block, path):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(4, "hello world", "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in encoding.encode_corpus(df, path, block_chars=block).collect())
    ref = reference(path)
    assert got == sorted((i, ref(t)) for i, t, _ in rows)


def test_a_file_that_is_not_honoured_is_refused(spark, tmp_path):
    import json

    with open(PATH, encoding="utf-8") as f:
        whole = json.load(f)
    small = whole | {"model": whole["model"] | {"vocab": {c: i for i, c in enumerate(bpe.byte_characters())}, "merges": []}}
    odd = [{"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": small["model"] | {"dropout": 0.1}}, {"model": small["model"] | {"ignore_merges": True}}, {"model": small["model"] | {"vocab": {"a": 0}}}]
    for i, change in enumerate(odd):
        at = tmp_path / f"{i}.json"
        at.write_text(json.dumps(small | change))
        with pytest.raises(bpe.NotHonoured):
            encoding.encode_corpus(spark.createDataFrame([(1, "a")], "doc_id int, text string"), str(at))
    (tmp_path / "fine.json").write_text(json.dumps(small))
    assert bpe.merges(str(tmp_path / "fine.json")).replay(["hi"]) == [[small["model"]["vocab"][c] for c in "hi"]]


def test_encode_empty_table(spark):
    assert encoding.encode_corpus(spark.createDataFrame([], "doc_id string, text string"), PATH).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_budget_is_exact(spark, name):
    rows = [("a" if i % 2 else None, t) for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(rows, "source string, text string")
    got = {r.source: (r.texts, r.tokens) for r in token_budget.token_budget(df, ["source"], f"{TOKENIZERS}/{name}").collect()}
    ref = reference(f"{TOKENIZERS}/{name}")
    for s in ("a", None):
        assert got[s] == (sum(x == s for x, _ in rows), sum(len(ref(t)) for x, t in rows if x == s))


def test_budget_counts_a_doc_once(spark):
    df = spark.createDataFrame(
        [("1", ["hi there"], "en", "S", "d", 2), ("1", [" hi there "], None, None, "d", 1), ("2", None, "EN", "s ", None, 1), (None, ["x"], "en", "s", "d", 1)],
        "doc_id string, doc_text array<string>, lang string, source string, domain string, loaded_at int",
    )
    rows = token_budget.token_budget(token_budget.texts_of_docs(df), ["kind", "source", "lang", "domain"], PATH).collect()
    assert sorted((r.source, r.lang, r.domain or "", r.texts, r.tokens) for r in rows) == [("s", "en", "", 1, 0), ("s", "en", "d", 1, 2)]


def test_budget_of_nothing(spark):
    assert token_budget.token_budget(spark.createDataFrame([], "source string, text string"), ["source"], PATH).collect() == []
