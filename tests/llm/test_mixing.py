import pytest

pytest.importorskip("tokenizers")
from granary.llm.mixing import Mix, route  # noqa: E402
from granary.llm.queries import BYTE_BPE  # noqa: E402

DOCS = "doc_id long, text string, source string, passes int"
TARGETS = "source string, weight double, max_repeats int"


def docs(spark, n=300):
    rows = [(i, f"text number {i} of some length and more {i * 7}", ["A", " b", "c"][i % 3] if i % 5 else "B") for i in range(n)]
    rows += [(1000 + i, "the same text in two sources", "a" if i % 2 else "B ") for i in range(60)]
    rows += [(2000, None, "a"), (2001, " ", "a"), (2002, "no source", None), (2003, "other source", "zzz")]
    return spark.createDataFrame([(*r, 1) for r in rows], DOCS)


def test_route_uses_overlap_and_repeats_last():
    sent, flow = route({("a",): 10, ("a", "b"): 10, ("b",): 2}, {"a": 1, "b": 3}, {"a": 12, "b": 20})
    assert sent == 32 and flow[("a",), "a"] == 10 and flow[("a", "b"), "a"] == 2
    assert flow[("b",), "b"] <= 6


def test_shares_are_exact_within_a_text(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("none", 0.3, 2), ("z", 0.0, 1), ("y", None, 1), (None, 1.0, 1)], TARGETS)
    got = {r.source: r for r in Mix(BYTE_BPE, bucket_rows=20).report(docs(spark), targets).collect()}
    drawn = sum(r.drawn_tokens for r in got.values())
    assert got["none"].drawn_tokens == 0 and set(got) == {"a", "b", "c", "none"}
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(got[s].drawn_tokens - share * drawn) < 40 and got[s].most_passes <= got[s].max_repeats


def test_caps_bind_and_selection_is_seeded(spark):
    targets = spark.createDataFrame([("a", 0.5, 1), ("c", 0.5, 2)], TARGETS)
    mix = Mix(BYTE_BPE, total=10**9)
    rows = mix.select(docs(spark), targets).collect()
    assert {r.passes for r in rows if r.source == "a"} == {1} and {r.passes for r in rows if r.source == "c"} == {2}
    assert len({r.doc_id for r in rows}) == len(rows) and 1001 in {r.doc_id for r in rows}
    small = lambda seed: sorted((r.doc_id, r.source, r.passes) for r in Mix(BYTE_BPE, seed=seed, total=500).select(docs(spark), targets).collect())
    assert small(1) == small(1) != small(2)


def test_nothing(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    assert Mix(BYTE_BPE).select(spark.createDataFrame([], DOCS), targets).collect() == []
    assert Mix(BYTE_BPE).select(docs(spark), spark.createDataFrame([], TARGETS)).collect() == []


def test_all_tokens_and_too_many_patterns(spark):
    targets = spark.createDataFrame([("a", 0.9, 1), ("c", 0.1, 2)], TARGETS)
    got = {r.source: r for r in Mix(BYTE_BPE, total="all").report(docs(spark), targets).collect()}
    assert got["a"].drawn_tokens == got["a"].available_tokens and got["a"].share < 0.9
    with pytest.raises(ValueError, match="sets of sources"):
        Mix(BYTE_BPE, most_patterns=1).select(docs(spark), targets)


def test_sizes_are_the_library_s(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    rows = {r.h: r.tokens for r in Mix(BYTE_BPE).sized(docs(spark), ["a", "b", "c"]).collect()}
    texts = {r.text for r in docs(spark).where("doc_id < 2000").collect()}
    assert sorted(rows.values()) == sorted(len(t.encode(x).ids) for x in texts)
