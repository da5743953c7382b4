import re

from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm.segments import Cutter, items_of, split_oversized


def size(t):
    c = len(re.findall("[一-鿿]", t))
    return c + (len(t) - c) // 4


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab 河.。,，\n", max_size=80), max_size=30).map("".join))
def test_pieces_tile_the_text(text):
    cutter = Cutter(limit=30, overlap=6)
    parts = cutter.cut(text)
    body = "".join(text[b:e] for _, b, e in parts)
    assert body == text and parts[0][0] == parts[0][1] == 0
    for start, b, e in parts:
        assert size(text[start:e]) <= 30 and size(text[start:b]) <= 6 and start <= b
    assert all(e > b for _, b, e in parts[:-1])


def test_cuts_where_the_topic_changes():
    a = [f"The river floods the delta near the valley {i}." for i in "abcdefgh"]
    b = [f"A compiler parses code into binary functions {i}." for i in "abcdefgh"]
    text = " ".join(a + b)
    parts = Cutter(limit=size(" ".join(a + b[:4])) + 2, overlap=10).cut(text)
    assert text[parts[1][1] :].startswith("A compiler") and text[parts[1][0] :].split()[0] in text.split()


def test_sentence_ends_are_used():
    text = "One sentence of some words here. " * 100
    parts = Cutter().cut(text)
    assert len(parts) > 1 and all(text[:e].rstrip().endswith(".") for _, _, e in parts)


def test_items_and_pieces(spark):
    docs = spark.createDataFrame([("a", ["x" * 2404], 1, "t"), ("a", ["x" * 2404], 2, "t"), ("b", ["河" * 600], 1, "t"), ("c", ["河" * 601], 1, "t"), ("d", None, 1, "t"), (None, ["y"], 1, "t")], "doc_id string, doc_text array<string>, loaded_at int, text string")
    candidates = spark.createDataFrame([("a", [(1, "z " * 1300), (None, "w " * 1300), (2, None), (3, "")]), ("b", None)], "doc_id string, candidates array<struct<order:int,text:string>>")
    rows = split_oversized(items_of(docs, candidates), ["item_kind", "doc_id", "cand_order"]).collect()
    over = sorted((r.item_kind, r.doc_id, -1 if r.cand_order is None else r.cand_order) for r in rows if r.piece == 1 and r.pieces > 1)
    assert over == [("candidate", "a", -1), ("candidate", "a", 1), ("doc", "a", 0), ("doc", "c", 0)]
    assert all(r.tokens == size(r.text) <= 600 for r in rows)
    assert split_oversized(items_of(docs.limit(0), candidates.limit(0)), ["item_kind", "doc_id", "cand_order"]).collect() == []
