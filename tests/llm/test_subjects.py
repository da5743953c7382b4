import random

from granary.llm.subjects import Subjects, sentences, terms

NOUNS = {"sea": "harbor wave sailor anchor tide vessel".split(), "art": "canvas brush gallery sculptor portrait palette".split(), "law": "judge verdict statute attorney appeal jury".split()}
PLAIN = "garden kitchen neighbor weekend letter window".split()
FRAMES = ["Later the {} and the {} met.", "What made the {} odd was the {}.", "It took a {} months to explain the {}.", "Most accounts of the {} mention a {}."]


def sentence(rng, words):
    return rng.choice(FRAMES).format(*rng.sample(words, 2))


def test_mixtures_of_sentences(spark):
    rng = random.Random(4)
    examples = [(s, "en", " ".join(sentence(rng, w) for _ in range(4)), 1) for s, w in NOUNS.items() for _ in range(12)]
    docs, want = [], set()
    for i in range(240):
        kinds = rng.choice([["sea"], ["art"], ["law"], ["sea", "art"], [None], ["law", None]])
        parts = [sentence(rng, NOUNS[k] if k else PLAIN) for k in kinds for _ in range(4)]
        rng.shuffle(parts)
        docs.append((i, " ".join(parts), "clash"))
        want |= {(i, k) for k in kinds if k}
    docs += [(900, None, ""), (901, "", ""), (902, "  ... 12 !", ""), (903, "x" * 100_000, "")]
    ex = spark.createDataFrame(examples + [(None, "en", "x", 1), ("sea", None, None, 1)], "subject string, lang string, text string, terms int")
    got = set(map(tuple, Subjects().found(spark.createDataFrame(docs, "doc_id long, text string, terms string"), ex).collect()))
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)


def test_few_texts_of_a_language_keep_their_subjects(spark):
    rng = random.Random(5)
    german = {"sea": "hafen welle matrose anker ebbe kutter".split(), "art": "leinwand pinsel galerie bildhauer porträt palette".split(), "law": "richter urteil gesetz anwalt berufung klage".split()}
    said = lambda w: "Danach kamen {} und {} zusammen.".format(*rng.sample(w, 2))
    examples = [(s, lang, " ".join(make(w[s]) for _ in range(4))) for lang, w, make in (("en", NOUNS, lambda w: sentence(rng, w)), ("de", german, said)) for s in w for _ in range(12)]
    few = [(i, " ".join(said(w) for _ in range(4))) for i, w in enumerate(german.values())]
    many = [(100 + i, " ".join(sentence(rng, rng.choice(list(NOUNS.values()))) for _ in range(4))) for i in range(300)]
    ex = spark.createDataFrame(examples, "subject string, lang string, text string")
    for docs in (few, few + many):
        got = set(map(tuple, Subjects().found(spark.createDataFrame(docs, "doc_id long, text string"), ex).where("doc_id < 100").collect()))
        assert got == set(enumerate(german))


def test_a_tenfold_corpus_judges_the_same_texts_alike(spark):
    rng = random.Random(6)
    examples = [(s, "en", " ".join(sentence(rng, w) for _ in range(4))) for s, w in NOUNS.items() for _ in range(12)]
    make = lambda: " ".join(sentence(rng, NOUNS[k] if k else PLAIN) for k in rng.choice([["sea"], ["art", "law"], [None], ["law", None]]) for _ in range(4))
    own, more = [(i, make()) for i in range(120)], [(1000 + i, make()) for i in range(1080)]
    ex = spark.createDataFrame(examples, "subject string, lang string, text string")
    found = lambda rows: set(map(tuple, Subjects().found(spark.createDataFrame(rows, "doc_id long, text string"), ex).where("doc_id < 1000").collect()))
    alone = found(own)
    assert found([(d + 1000 * i, t) for i in range(10) for d, t in own]) == alone == found(own + more)


def test_sentences_and_terms():
    text = "It was not done without Dr. Yve. They saw her come, e.g. at 3.5 p.m. to a town (see Y, p. 9). <b>Was it really so?</b> &quot;Yes it was!&quot; she said. 1. First item\n> Quoted lines are sentences too.\n河流很长很长。山也高得很！"
    assert sentences(text) == [
        "it was not done without dr yve", "they saw her come, e.g. at 3.5 p.m. to a town (see y, p. 9)", "was it really so", '"yes it was!" she said', 'first item\nquoted lines are sentences too', "河流很长很长", "山也高得很",
    ]
    assert sentences("no capitals are here. not in any sentence. so all stops count.") == ["no capitals are here", "not in any sentence", "so all stops count."]
    assert sentences(" 1. 2 ...") == []
    assert terms("the cats 河流长 é") == ["the", "cat", "河流", "流长"]


def test_nothing(spark):
    ex = spark.createDataFrame([("a", "en", "one two")], "subject string, lang string, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert Subjects().found(none, ex).collect() == []
    assert Subjects().found(spark.createDataFrame([(1, "one two three")], "doc_id long, text string"), ex.limit(0)).collect() == []
