import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm.components import connected_components
from granary.llm.meetings import meeting
from granary.llm.near_duplicates import NearDuplicates
from granary.llm.signatures import Layout, layout_for, multi_index_keys, packed, unpacked
from granary.runtime import pairs_across, pairs_within_key

SCHEMA = "doc_id string, doc_text array<string>, loaded_at int, rid string, grams string"  # clashing names must not matter


def grams(items, n):
    text = " ".join(x.strip() for x in items or [] if x and x.strip()).lower()
    words = re.findall(r"[一-鿿]|[^\W_一-鿿]+", text)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, t):
    docs = {}
    for d, x, at, *_ in sorted(rows, key=lambda r: (r[2])):
        if d is not None and (d not in docs or not docs[d]):
            docs[d] = grams(x, n)
    docs = {d: g for d, g in docs.items() if g}
    ids = sorted(docs)
    return sorted((a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(docs[a] & docs[b]) / len(docs[a] | docs[b]) >= t)


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + list("河流高原")
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(6, 60))
        rows.append([f"d{i}", [" ".join(words)], i])
        for j in range(rng.choice([0, 0, 1, 3])):
            changed = list(words)
            for _ in range(rng.randint(0, 3)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append([f"d{i}-{j}", [" ".join(changed[: len(changed) // 2]), None, " ", " ".join(changed[len(changed) // 2 :]) + " "], i])
    rows += [[f"copy{i}", ["One TEXT that a third of all rows has, word for word."], 5] for i in range(60)]
    rows += [["again", ["a b c d e f g"], 9], ["again", [" a b c d e f g "], 2], [None, ["a b c d e f g"], 1], ["empty", [], 1], ["null", None, 1], ["blank", [" ", None], 1], ["short", ["two words"], 1], ["twin", ["a b c d e f g!"], 3]]
    rows += [["long1", ["x y z " * 20_000], 1], ["long2", ["x y z " * 20_000 + "q"], 1]]
    return [tuple(r) + ("x", "y") for r in rows]


def test_pairs_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows + rows[:10], SCHEMA)
    got = sorted(map(tuple, NearDuplicates(n=3, threshold=0.6).pairs(df).collect()))
    assert got == brute(rows, 3, 0.6)


def test_groups(spark):
    rows = corpus(5, 60)
    got = {r.doc_id: r for r in NearDuplicates(n=3, threshold=0.6).groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    parent = {}
    for a, b in brute(rows, 3, 0.6):
        ra, rb = a, b
        while parent.get(ra, ra) != ra:
            ra = parent[ra]
        while parent.get(rb, rb) != rb:
            rb = parent[rb]
        parent[max(ra, rb)] = min(ra, rb)
        parent.setdefault(min(ra, rb), min(ra, rb))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    alone = {r[0] for r in rows if r[0] is not None} - set(parent)
    assert {d: r.group_id for d, r in got.items()} == {d: root(d) for d in parent} | {d: d for d in alone}
    assert got["copy0"].copies == 60 and got["copy0"].links == 0
    assert all((got[d].copies, got[d].links) == (1, 0) for d in alone) and {"short", "empty", "null", "blank"} <= alone


def test_short_texts_form_classes_of_equal_words(spark):
    texts = {"a": "hello world", "b": "Hello, world!", "c": "world hello", "d": "!!!", "e": "?", "f": "hello world one two three"}
    df = spark.createDataFrame([(k, [v], 1, "x", "y") for k, v in texts.items()], SCHEMA)
    got = {r.doc_id: (r.group_id, r.copies, r.links) for r in NearDuplicates().groups(df).collect()}
    assert got == {"a": ("a", 2, 0), "b": ("a", 2, 0), **{k: (k, 1, 0) for k in "cdef"}}
    assert NearDuplicates().pairs(df).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([0.5, 0.6, 0.75, 0.8, 0.9, 1.0]), st.sampled_from([4, 8, 15, 31]), st.randoms(use_true_random=False), st.floats(0, 1))
def test_every_pair_within_the_distance_shares_a_key(threshold, bits, rng, share):
    """At every distance up to the bound, wherever the differences lie; the last one is the bound itself."""
    try:
        layout = layout_for(threshold, bits=bits)
    except ValueError:
        return
    assert layout.beyond(threshold) <= 2e-4 and layout.distance < layout.chunks * (layout.errors + 1)
    one = np.array([[rng.randrange(2**bits) for _ in range(layout.symbols)]], dtype=np.uint64)
    for differ in {int(share * layout.distance), layout.distance}:
        other = one.copy()
        for i in rng.sample(range(layout.symbols), differ):
            other[0, i] = (int(other[0, i]) + rng.randrange(1, 2**bits)) % 2**bits
        assert set(multi_index_keys(one, layout)[0].tolist()) & set(multi_index_keys(other, layout)[0].tolist())


def test_differences_can_be_one_too_many():
    layout = Layout(2, 3, 1, 16)
    one, other = np.zeros((1, 6), np.uint64), np.array([[1, 1, 0, 1, 1, 0]], dtype=np.uint64)
    assert not set(multi_index_keys(one, layout)[0].tolist()) & set(multi_index_keys(other, layout)[0].tolist()) and layout.distance == 3
    for wrong in ((0, 3, 1, 16), (2, 3, 3, 16), (2, 3, 1, 32)):
        with pytest.raises(ValueError):
            Layout(*wrong)
    with pytest.raises(ValueError):
        layout_for(0.01)


@pytest.mark.parametrize("bits", [2, 4, 15, 16, 31])
def test_packed_signatures_count_their_differences(spark, bits):
    from granary.llm.signatures import differing
    from pyspark.sql import functions as F

    rng = np.random.default_rng(bits)
    a, b = rng.integers(0, 2**bits, (50, 23), dtype=np.uint64), rng.integers(0, 2**bits, (50, 23), dtype=np.uint64)
    b[:, ::2] = a[:, ::2]
    words = len(packed(a, bits))
    assert (unpacked(packed(a, bits), Layout(23, 1, 0, bits)) == a).all()
    rows = [tuple(int(w[i]) for w in (*packed(a, bits), *packed(b, bits))) for i in range(50)]
    df = spark.createDataFrame(rows, ", ".join(f"{s}{i} long" for s in "ab" for i in range(words)))
    got = [r[0] for r in df.select(differing([(F.col(f"a{i}"), F.col(f"b{i}")) for i in range(words)], bits)).collect()]
    assert got == (a != b).sum(1).tolist()


@pytest.mark.parametrize("batch", [3, 10_000])
def test_keys_meet_across_batches_and_hot_ones_are_put_aside(spark, batch):
    rows = [(-7, i) for i in range(20)] + [(1, i) for i in range(6)] + [(2, 9), (3, 8), (3, 9), (3, 8), (9, 1), (9, 2)] + [(12, i) for i in range(9)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {tuple(r) for r in meeting(spark.createDataFrame(rows, "key long, rid long"), 7).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(a, b) for a in range(6) for b in range(a + 1, 6)} | {(8, 9), (1, 2), (-7, None), (12, None)}


def test_keys_of_many_classes_lose_no_pair(spark):
    rows = corpus(7, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, NearDuplicates(n=3, threshold=0.6, block_rows=2).pairs(df).collect()))
    assert got == brute(rows, 3, 0.6)


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert NearDuplicates().pairs(empty).collect() == [] and NearDuplicates().groups(empty).collect() == []


def test_components_of_a_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(200)}}


def test_hot_keys_in_blocks_lose_no_pair(spark):
    rows = [(1, i) for i in range(50)] + [(2, 7), (3, 8), (3, 9), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "key int, id int")
    got = pairs_within_key(df, "key", "id", [], block_rows=7).collect()
    assert sorted(map(tuple, got)) == sorted([(a, b) for a in range(50) for b in range(a + 1, 50)] + [(8, 9)])
    left, right = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    got = pairs_across(left, right, "key", "id", block_rows=4).collect()
    assert sorted(map(tuple, got)) == sorted([(a, b) for a in range(0, 50, 2) for b in range(1, 50, 2)] + [(8, 9)])
