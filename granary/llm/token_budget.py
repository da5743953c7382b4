"""Exact token totals of texts by group, under an existing tokenizer.

The tokenizer's own normalization and pre-splitting cut each text into pieces, once. Piece frequencies are added up per group
in the task, and again after the one shuffle, which is by piece. There each distinct piece is tokenized once and its length
joined with the piece's frequencies, which lie next to each other; the products are summed per group. A frequent piece is
one row per group and task, so nothing grows with the number of its occurrences.

Defined cases: null and empty texts have 0 tokens and count as texts; null group values form a group of their own; every
input row counts, so the caller decides what a repeated row is (texts_of_docs and texts_of_queries keep first deliveries);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_text, label, strip
from ..operators.deliveries import first_delivery
from ..runtime import spread, widened
from .bpe import NotHonoured, byte_characters, library, splitter


def pieces_of(path: str) -> tuple[Callable[[str], list[str]], Callable[[str], int]]:
    """The pieces of a text, and the tokens of a piece. Splitting by a pattern runs without the offsets that the library makes
    for each piece; any other pre-splitting is left to the library, whose pieces are in the model's characters."""
    tokenizer = library(path)
    tokenize = tokenizer.model.tokenize
    try:
        split, shown = splitter(path), dict(enumerate(byte_characters()))
        return split, lambda p: len(tokenize(p.encode("utf-8").decode("latin-1").translate(shown)))
    except NotHonoured:
        normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        cut = tokenizer.pre_tokenizer.pre_tokenize_str
        return lambda t: [p for p, _ in cut(normal(t))], lambda p: len(tokenize(p))


def piece_frequencies(texts: DataFrame, groups: list[str], text: str, path: str, most: int = 200_000) -> DataFrame:
    """(groups..., piece, n): how often each piece occurs in each group, in partitions by piece, in its order. A task writes
    its counts out whenever it holds `most` of them."""
    kinds = {g: texts.schema[g].dataType.simpleString() for g in groups}

    def run(batches):
        pieces = pieces_of(path)[0]
        held: dict[tuple, Counter] = {}
        size = 0

        def out():
            rows = [(*g, p, n) for g, c in held.items() for p, n in c.items()]
            columns = list(zip(*rows)) or [[]] * (len(groups) + 2)
            names = [*groups, "piece", "n"]
            kinds_ = [*[b.schema.field(g).type for g in groups], pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_)], names)

        b = None
        for b in batches:
            for *group, t in zip(*[b.column(g).to_pylist() for g in groups], b.column(text).to_pylist()):
                if not t:
                    continue
                counts = held.setdefault(tuple(group), Counter())
                size -= len(counts)
                counts.update(pieces(t))
                size += len(counts)
                if size >= most:
                    yield out()
                    held, size = {}, 0
        if b is not None:
            yield out()

    schema = ", ".join([*[f"`{g}` {k}" for g, k in kinds.items()], "piece string, n long"])
    counted = spread(widened(texts.select(*groups, text)).mapInArrow(run, schema), "piece")
    return counted.groupBy("piece", *groups).agg(F.sum("n").alias("n")).sortWithinPartitions("piece")


def with_tokens(frequencies: DataFrame, groups: list[str], path: str) -> DataFrame:
    """(groups..., tokens): each row of frequencies, its count times its piece's length, of which each is made once."""
    schema = ", ".join([*[f"`{g}` {frequencies.schema[g].dataType.simpleString()}" for g in groups], "tokens long"])

    def run(batches):
        length = pieces_of(path)[1]
        last, its = None, 0
        for b in batches:
            if b.num_rows:
                piece = pc.dictionary_encode(b.column("piece"))
                distinct = piece.dictionary.to_pylist()
                lengths = np.array([its if p == last else length(p) for p in distinct], dtype=np.int64)
                last, its = distinct[-1], lengths[-1]
                tokens = lengths[piece.indices.to_numpy()] * b.column("n").to_numpy()
                yield pa.RecordBatch.from_arrays([*b.select(groups).columns, pa.array(tokens)], [*groups, "tokens"])

    return frequencies.mapInArrow(run, schema)


def token_budget(texts: DataFrame, groups: list[str], path: str, text: str = "text") -> DataFrame:
    """(groups..., texts, chars, tokens) of each group, by the tokenizer file at path, which every executor must have."""
    tokens = with_tokens(piece_frequencies(texts, groups, text, path), groups, path).groupBy(*groups).agg(F.sum("tokens").alias("tokens"))
    sizes = texts.groupBy(*groups).agg(F.count(F.lit(1)).alias("texts"), F.sum(F.coalesce(F.char_length(text), F.lit(0))).cast("long").alias("chars"))
    renamed = tokens.select(*[F.col(g).alias(f"_{g}") for g in groups], "tokens")
    joined = sizes.join(renamed, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups], "left")
    return joined.select(*groups, "texts", "chars", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def texts_of_docs(docs: DataFrame) -> DataFrame:
    """(kind, source, lang, domain, text) of each doc once: its elements trimmed and joined by a space, its labels
    trimmed and lower-cased."""
    labels = {c: label(c) for c in ("source", "lang", "domain")}
    return first_delivery(docs, "doc_id", joined_text("doc_text"), labels).select(F.lit("doc").alias("kind"), *labels, "text")


def texts_of_queries(queries: DataFrame) -> DataFrame:
    """(kind, source, lang, domain, text) of each query once, its text trimmed."""
    labels = {c: label(c) for c in ("source", "lang", "domain")}
    return first_delivery(queries, "query_id", strip("query_text"), labels).select(F.lit("query").alias("kind"), *labels, "text")
