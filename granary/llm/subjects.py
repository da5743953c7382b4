"""Subject areas of texts.

The document-term matrix of the whole corpus is factored into non-negative parts, X ~ W H, by alternating multiplicative
updates (of the divergence, so a row of W is a mixture). There are components per language of the examples, and a text
takes part in those of the language that most of its terms speak for. They are seeded: one per subject from the labelled
examples, one for phrasing that all subjects share, and `free` ones from terms that are frequent in the corpus but not in
the examples. The subjects' components stay anchored: their seed enters every update of H as pseudo-counts. Half-way,
terms that texts of all subjects use (their average mixture leaves no subject more than `even`) are taken from the
subjects' components and stay out, as a multiplicative update keeps zeros.

A sentence's subjects are its row of W with H fixed, by the same update: it is about a subject whose component has more than
`share` of its mixture, the shared phrasing left out, and at least `least_terms` of its terms. A document is about each
subject that at least `quota` of its sentences are about; its mixture is the mean of theirs.

W never leaves the executors: each update of H sums, per term, what all texts contribute. The vocabulary has every term of
the examples and each other term that more than one text and at least `least_share` of them have (a term of one text goes
with nothing). That is a share of the texts, so more texts of the same kind leave the vocabulary as it is, and there are at
most (distinct terms a text) / least_share other terms: H is bounded whatever the corpus size. The matrix is made once: term numbers and counts of each text, checkpointed.

Defined cases: null, empty and wordless texts get no subject; repeated rows and ids are judged row by row; an empty table
or no examples give an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed, widened

_MARKS = regex.compile(r"[\p{Mn}\p{Cf}]+")
_TAG = regex.compile(r"<[^<>]{1,200}>")
_ITEM = regex.compile(r"(?m)^[\s>]*(?:\d+[.)]\s|[-*•]\s|>)\s*")  # list items and quoted lines
_TERM = regex.compile(r"[一-鿿]+|[\p{L}--[一-鿿]]+", regex.V1)
_PLAIN = re.compile("[a-z]{2,}")
# A stop after a single letter (p. 3, e.g.) ends no sentence; else one ends where the next begins as sentences do.
_STOP = r"(?<!\b\p{L})[.!?…]+[\"'”’»)\]]*\s+"
_BEGIN = r"(?=[\"'“‘«(\[¿¡]*[\p{Lu}\p{Lo}\p{N}])"
_SURE = r"|[。！？]+|\n\s*\n"
_CASED = regex.compile(_STOP + _BEGIN + _SURE + r"|\)\s+(?=\p{Lu}\p{Ll})")
_ANY = regex.compile(_STOP + _SURE)


def parsed(text: str, least: int = 3) -> list[tuple[str, list[str]]]:
    """The sentences of a text, folded to lower case without accents and markup, each with its terms. A part of fewer than
    `least` terms belongs to the sentence before it. Where most stops aren't followed by a capital, a text isn't written
    with them."""
    clean = html.unescape(text) if "&" in text else text
    clean = clean if clean.isascii() else _MARKS.sub("", clean)
    clean = _ITEM.sub("", _TAG.sub(" ", clean) if "<" in clean else clean)
    ends = [m.span() for m in _CASED.finditer(clean)]
    if 2 * len(ends) < len(_ANY.findall(clean)):
        ends = [m.span() for m in _ANY.finditer(clean)]
    out: list[tuple[str, list[str]]] = []
    at = 0
    for end, begin in [*ends, (len(clean), len(clean))]:
        part = clean[at:end]
        at = begin
        folded = part.lower() if part.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", part)).lower()
        words = terms(folded)
        if 0 < len(words) < least and out:
            out[-1] = (f"{out[-1][0]} {folded}", out[-1][1] + words)
        elif words:
            out.append((folded, words))
    return out


def sentences(text: str) -> list[str]:
    return [s for s, _ in parsed(text)]


def terms(folded: str) -> list[str]:
    """Words without a final s, and pairs of neighbouring CJK characters."""
    if folded.isascii():
        return [w[:-1] if len(w) > 3 and w[-1] == "s" else w for w in _PLAIN.findall(folded)]
    out = []
    for w in _TERM.findall(folded):
        if "一" <= w[0] <= "鿿":
            out += [w[i : i + 2] for i in range(len(w) - 1)]
        elif len(w) > 1:
            out.append(w[:-1] if len(w) > 3 and w[-1] == "s" else w)
    return out


def term_id(term: str) -> int:
    return xxhash.xxh64_intdigest(term) >> 1


def sentence_terms(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(id, terms, ends): the hashed terms of the text's sentences, and where each sentence ends among them."""
    rows = widened(texts.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))

    def run(batches):
        memo: dict[str, int] = {}
        for b in batches:
            values, ends, offsets, end_offsets = [], [], [0], [0]
            for t in b.column("text").to_pylist():
                n = 0
                for _, words in parsed(t) if t else ():
                    for w in words:
                        k = memo.get(w)
                        if k is None:
                            if len(memo) > 500_000:
                                memo.clear()
                            k = memo[w] = term_id(w)
                        values.append(k)
                        n += 1
                    ends.append(n)
                offsets.append(len(values))
                end_offsets.append(len(ends))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
            marks = pa.ListArray.from_arrays(pa.array(end_offsets, pa.int32()), pa.array(ends, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("id"), lists, marks], ["id", "terms", "ends"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, terms array<bigint>, ends array<int>")


def flattened(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and each list's length."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


class Sentences:
    """A batch of sentence_terms as a sparse matrix: each entry's known term (column) and sentence."""

    def __init__(self, batch: pa.RecordBatch, vocabulary: np.ndarray):
        values, lengths = flattened(batch.column("terms"))
        ends, per_doc = flattened(batch.column("ends"))
        stop = ends + np.repeat(np.cumsum(lengths) - lengths, per_doc)
        self.docs, self.sentences = len(batch), len(stop)
        self.doc_of_sentence = np.repeat(np.arange(self.docs), per_doc)
        sentence = np.searchsorted(stop, np.arange(len(values)), side="right")
        at = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
        known = vocabulary[at] == values
        self.column, self.sentence = at[known], sentence[known]
        self.doc = self.doc_of_sentence[self.sentence]


def slices(batches, rows: int = 500):
    """The batches in slices that the processor's caches hold through the rounds of an update."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def row_sums(row: np.ndarray, rows: int, entries: np.ndarray) -> np.ndarray:
    """The entries (one line each) summed by row; row is in ascending order."""
    n = np.bincount(row, minlength=rows)
    out = np.zeros((rows, entries.shape[1]), entries.dtype)
    if len(row):
        out[n > 0] = np.add.reduceat(entries, (np.cumsum(n) - n)[n > 0], axis=0)
    return out


def mixtures(row: np.ndarray, rows: int, near: np.ndarray, rounds: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """W after `rounds` multiplicative updates from an even start, and each entry (times its weight) split over the components.
    row: of each entry, ascending; near: of each entry, its term's column of H."""
    w = np.ones((rows, near.shape[1]), near.dtype)
    n = np.bincount(row, minlength=rows)
    split = near
    for _ in range(rounds):
        split = np.repeat(w, n, axis=0)
        split *= near
        per = 1 / np.maximum(np.einsum("ij->i", split), 1e-30)
        split *= (per if weight is None else per * weight)[:, None]
        w = row_sums(row, rows, split)
    return w, split


def scaled(h: np.ndarray) -> np.ndarray:
    return h / np.maximum(h.sum(-1, keepdims=True), 1e-30)


@dataclass
class Model:
    """subjects; the sorted hashes of the vocabulary; speaks: (languages, terms), the share of each language in a term's
    use by the examples; h: (languages, subjects + shared + free, terms)."""

    subjects: list[str]
    vocabulary: np.ndarray
    speaks: np.ndarray
    h: np.ndarray

    def language(self, doc: np.ndarray, docs: int, column: np.ndarray) -> np.ndarray:
        """Of each text, the language that most of its terms speak for."""
        return np.stack([np.bincount(doc, s[column], minlength=docs) for s in self.speaks], axis=1).argmax(1)


@dataclass(frozen=True)
class Subjects:
    quota: float = 0.25
    share: float = 0.5
    least_terms: float = 0.5
    free: int = 1
    updates: tuple[int, int] = (5, 4)
    rounds: int = 6
    anchor: float = 0.4
    even: float = 0.4
    least_share: float = 0.002
    most_examples: int = 20_000
    seed: int = 11

    def fit(self, rows: DataFrame, examples: DataFrame) -> Model:
        """The model of a table of sentence_terms. Of the examples at most most_examples (those of least hash) are used."""
        lang = F.coalesce(F.col("lang"), F.lit("")) if "lang" in examples.columns else F.lit("")
        labelled = examples.where(F.col("subject").isNotNull() & F.col("text").isNotNull()).select("subject", lang.alias("lang"), "text")
        taken = [(r.subject, r.lang, r.text) for r in labelled.orderBy(F.xxhash64("subject", "text"), "lang").limit(self.most_examples).collect()]
        subjects, langs = sorted({x[0] for x in taken}), sorted({x[1] for x in taken})
        n, free = len(subjects), self.free
        used_in = [(langs.index(lang), subjects.index(s), sorted({term_id(w) for w in words})) for s, lang, t in taken for _, words in parsed(t)]
        labelled_terms = np.array(sorted({k for *_, ids in used_in for k in ids}), dtype=np.int64)
        if not len(labelled_terms):
            return Model([], labelled_terms, np.zeros((0, 0)), np.zeros((0, 0, 0)))
        least = max(2, self.least_share * rows.count())
        known = rows.select(F.explode(F.array_distinct("terms")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
        vocabulary = np.union1d(labelled_terms, known.select("t").toArrow()["t"].to_numpy())
        counts = np.zeros((len(langs), n, len(vocabulary)))
        for i, k, ids in used_in:
            counts[i, k, np.searchsorted(vocabulary, ids)] += 1
        total = counts.sum(1)
        speaks = scaled(total)
        speaks = speaks / np.maximum(speaks.sum(0), 1e-12)
        model = Model(subjects, vocabulary, speaks, np.ones((len(langs), n + 1 + free, len(vocabulary))))
        matrix = checkpointed(self._matrix(rows, model))
        used = self._sums(matrix, model, "use")[:, 0]
        f = scaled(used)
        own = (counts + 0.25) / (total + 0.25 * n)[:, None]
        spread = np.where(total > 0, 1 - (own.max(1) - 1 / n) / (1 - 1 / n), 0)
        p = scaled(counts)
        noise = np.random.default_rng(self.seed).uniform(0, 1, (free, len(vocabulary))) ** 2
        unseen = f * np.exp(-total)
        model.h = prior = scaled(np.concatenate([p * own**3 + 1e-4 * f[:, None], (p.mean(1) * spread**2 + 1e-4 * f)[:, None], unseen[:, None] * noise + 1e-5 * f[:, None]], axis=1))

        def update() -> None:
            new = scaled(self._sums(matrix, model, "update"))
            new[:, :n] = (1 - self.anchor) * new[:, :n] + self.anchor * prior[:, :n]
            model.h = new

        for _ in range(self.updates[0]):
            update()
        profile = self._sums(matrix, model, "profile") / np.maximum(used, 1)[:, None]
        common = profile.max(1) < self.even

        def without_common(h: np.ndarray) -> np.ndarray:
            h = h.copy()
            moved = np.maximum(h.sum(1), f)
            h[np.broadcast_to(common[:, None], h.shape)] = 0
            h[:, n][common] = moved[common]
            return scaled(h)

        model.h, prior = without_common(model.h), without_common(prior)
        for _ in range(self.updates[1]):
            update()
        return model

    def _matrix(self, rows: DataFrame, model: Model) -> DataFrame:
        """(l, column, n): of each text its language, the numbers of its known terms, ascending, and how often it has them."""

        def run(batches):
            for b in batches:
                m = Sentences(b, model.vocabulary)
                cell, n = np.unique(m.doc * len(model.vocabulary) + m.column, return_counts=True)
                doc, column = np.divmod(cell, len(model.vocabulary))
                offsets = pa.array(np.searchsorted(doc, np.arange(m.docs + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (column, n)]
                yield pa.RecordBatch.from_arrays([pa.array(model.language(m.doc, m.docs, m.column), pa.int32()), *lists], ["l", "column", "n"])

        return rows.mapInArrow(run, "l int, column array<int>, n array<int>")

    def _sums(self, matrix: DataFrame, model: Model, what: str) -> np.ndarray:
        """(languages, ..., terms): per language and term, summed over the texts: its uses ("use"), its uses split over
        the components ("update"), or the mixtures of the texts it is used in, over subjects and none ("profile")."""
        n, rounds = len(model.subjects), self.rounds
        width = {"use": 1, "update": model.h.shape[1], "profile": n + 1}[what]
        size = len(model.vocabulary)
        by_term = [np.ascontiguousarray(h.T, dtype=np.float32) for h in model.h]

        def run(batches):
            total = np.zeros((len(by_term), width, size))
            for b in slices(batches):
                (column, lengths), (uses, _) = flattened(b.column("column")), flattened(b.column("n"))
                doc = np.repeat(np.arange(len(b)), lengths)
                language = b.column("l").to_numpy()[doc]
                for i, near in enumerate(by_term):
                    mine = language == i
                    if not mine.any():
                        continue
                    c, d, u = column[mine], doc[mine], uses[mine].astype(np.float32)
                    if what == "use":
                        entries = u[:, None]
                    else:
                        w, entries = mixtures(d, len(b), near[c], rounds, u)
                        if what == "profile":
                            entries = scaled(np.concatenate([w[:, :n], w[:, n + 1 :].sum(1, keepdims=True)], axis=1))[d] * u[:, None]
                    for k, part in enumerate(np.ascontiguousarray(entries.T)):
                        total[i, k] += np.bincount(c, part, minlength=size)
            language, term = np.nonzero(total.sum(1))
            values = total[language, :, term]
            yield pa.RecordBatch.from_arrays([pa.array(language, pa.int32()), pa.array(term, pa.int32()), *[pa.array(values[:, k]) for k in range(width)]], ["l", "t", *[f"k{k}" for k in range(width)]])

        parts = matrix.mapInArrow(run, ", ".join(["l int, t int", *[f"k{k} double" for k in range(width)]]))
        summed = parts.groupBy("l", "t").agg(*[F.sum(f"k{k}").alias(f"k{k}") for k in range(width)]).toArrow()
        out = np.zeros((len(model.h), width, size))
        for k in range(width):
            out[summed["l"].to_numpy(), k, summed["t"].to_numpy()] = summed[f"k{k}"].to_numpy()
        return out

    def judge(self, texts: DataFrame, examples: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(key, sentences, mixture array<struct<subject, weight, share>>): for each row the number of its sentences
        that have a known term, and per subject its weight in their mixture and the share of them that are about it."""
        rows = checkpointed(sentence_terms(texts, key, text))
        model = self.fit(rows, examples)
        n, share, least, rounds = len(model.subjects), self.share, self.least_terms, self.rounds
        by_term = np.ascontiguousarray(model.h.transpose(0, 2, 1), dtype=np.float32)

        def run(batches):
            for b in slices(batches):
                m = Sentences(b, model.vocabulary) if n else None
                per, weights, counts = np.zeros(len(b), int), np.zeros((len(b), n)), np.zeros((len(b), n))
                if m is not None and len(m.column):
                    language = model.language(m.doc, m.docs, m.column)[m.doc]
                    w = mixtures(m.sentence, m.sentences, by_term[language, m.column], rounds)[0]
                    told = w.sum(1) > 0
                    topical = w[:, :n].sum(1) + w[:, n + 1 :].sum(1)
                    part = w[:, :n] / np.maximum(topical, 1e-12)[:, None]
                    per = np.bincount(m.doc_of_sentence[told], minlength=m.docs)
                    over = np.maximum(per, 1)[:, None]
                    weights = row_sums(m.doc_of_sentence, m.docs, part) / over
                    about = (part > share) & (w[:, :n] >= least)
                    counts = row_sums(m.doc_of_sentence, m.docs, about.astype(float)) / over
                cells = [pa.array(np.tile(np.array(model.subjects, dtype=object), len(b)), pa.string()), pa.array(weights.ravel()), pa.array(counts.ravel())]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1) * n, pa.int32()), pa.StructArray.from_arrays(cells, ["subject", "weight", "share"]))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(per, pa.int32()), lists], [key, "sentences", "mixture"])

        kind = rows.schema["id"].dataType.simpleString()
        return rows.mapInArrow(run, f"`{key}` {kind}, sentences int, mixture array<struct<subject:string,weight:double,share:double>>")

    def found(self, texts: DataFrame, examples: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(key, subject) for each subject that at least quota of the text's sentences are about."""
        each = self.judge(texts, examples, key, text).select(key, F.inline("mixture"))
        return each.where(F.col("share") >= self.quota).select(key, "subject").distinct()
