import random
import re

from granary.llm.split_overlaps import NearOverlaps, SplitOverlaps

SCHEMA = "query_id string, query_text string, split string, source string, loaded_at int, text string"


def grams(t):
    t = re.sub(r"[^\w]+|_+", " ", (t or "").lower()).strip()
    t = re.sub(r" +", " ", t)
    return {t[i : i + 3] for i in range(len(t) - 2)}


def queries(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(rng.randint(3, 8)))
        rows.append((f"q{i}", text, rng.choice(["train", " TRAIN", "dev", "test"]), "s", i))
        if rng.random() < 0.5:
            k = rng.randrange(len(text))
            rows.append((f"r{i}", (text[:k] + rng.choice("xyz") + text[k + 1 :]).upper() + "?!", rng.choice(["train", "Dev "]), None, i))
    rows += [(f"hot{i}", "How many, exactly?", "train" if i % 2 else "dev", "s", 1) for i in range(40)]
    rows += [("n1", None, "dev", "s", 1), ("n2", " ", "train", "s", 1), ("n3", "ab", "dev", "s", 1), ("n4", "ab", "train", "s", 1), ("n5", "how many exactly", None, "s", 1), (None, "how many exactly", "dev", "s", 1), ("q0", None, None, "s", 999), ("n6", "Ünï cödé 北京 text", "dev", "s", 1), ("n7", "ünï cödé 北京 text.", "train", "s", 1), ("long", "abc " * 30_000, "dev", "s", 1)]
    return [(*r, "clash") for r in rows]


def brute(rows):
    first = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: r[4]):
        old = first.get(r[0], (None, None))
        first[r[0]] = (old[0] or (r[1] or "").strip() or None, old[1] or (r[2] or "").strip().lower() or None)
    g = {q: grams(t) for q, (t, _) in first.items()}
    out = []
    for a in first:
        for b in first:
            if first[a][1] == "train" and first[b][1] in ("dev", "test") and g[a] and g[b] and len(g[a] & g[b]) / len(g[a] | g[b]) >= 0.75:
                out.append((min(a, b), max(a, b)))
    return sorted(out)


def test_pairs_equal_brute_force(spark):
    rows = queries()
    got = sorted(map(tuple, SplitOverlaps().pairs(spark.createDataFrame(rows + rows[:5], SCHEMA)).collect()))
    assert got == brute(rows)


def canonical(t):
    return re.sub(r" +", " ", re.sub(r"[^\w]+|_+", " ", (t or "").lower())).strip()


def brute_counts(rows, qrels_both):
    """exact and near of each (split, source), by comparing every evaluation record with every training record."""
    first = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: r[4]):
        old = first.get(r[0], (None, None, None))
        first[r[0]] = (old[0] or (r[1] or "").strip() or None, old[1] or (r[2] or "").strip().lower() or None, old[2] or r[3])
    trained = [canonical(t) for t, s, _ in first.values() if s == "train"]
    out = {}
    for q, (t, s, source) in first.items():
        if s not in ("dev", "test"):
            continue
        own = canonical(t)
        exact = bool(own) and own in trained
        near = not exact and any(grams(own) and grams(x) and len(grams(own) & grams(x)) / len(grams(own) | grams(x)) >= 0.75 for x in trained)
        n = out.setdefault((s, source), [0, 0, 0, 0])
        for i, hit in enumerate((True, exact, near, q in qrels_both)):
            n[i] += hit
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


def test_judged_and_counts(spark):
    qrels = spark.createDataFrame([("hot0", "TRAIN "), ("hot0", "dev"), ("hot1", "train"), (None, "train"), (None, "dev"), ("hot2", None), ("hot2", "dev")], "query_id string, split string")
    how = SplitOverlaps()
    assert [r.query_id for r in how.judged_under_both(qrels).collect()] == ["hot0"]
    rows = queries() + [("short1", "北京", "train", "zh", 1, ""), ("short2", "北京!", "dev", "zh", 1, ""), ("mark1", "?", "train", "zh", 1, ""), ("mark2", "!", "dev", "zh", 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_counts(rows, {"hot0"})
    assert sorted(map(tuple, how.counts(df, qrels).collect()), key=repr) == want
    assert ("dev", "zh", 2, 1, 0, 0) in want and {("dev", "s"), ("dev", "zh")} <= {x[:2] for x in want}
    assert sorted(map(tuple, how.exact_counts(df).collect()), key=repr) == [(*x[:2], x[3]) for x in want if x[3]]


def test_near_overlaps_of_hot_texts_in_blocks(spark):
    rows = queries(9)
    how = SplitOverlaps(NearOverlaps(block_rows=2))
    assert sorted(map(tuple, how.pairs(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_every_id_judged_under_both_is_counted(spark):
    ids = ["hot0", "hot1", "n5", "absent"]  # of dev, of train, of no split, in no row of queries
    qrels = spark.createDataFrame([(q, s) for q in ids for s in ("train", "Dev ")] + [("hot2", "dev")], "query_id string, split string")
    how = SplitOverlaps()
    got = how.judged_counts(spark.createDataFrame(queries(), SCHEMA), qrels)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [("dev", "s", 1), ("train", "s", 1), (None, "s", 1), (None, None, 1)]))
    assert sum(r.judged_under_both for r in got.collect()) == how.judged_under_both(qrels).count()


def test_nothing(spark):
    how, empty = SplitOverlaps(), spark.createDataFrame([], SCHEMA)
    assert how.pairs(empty).collect() == [] and how.counts(empty, empty).collect() == []
