"""Chunk candidates of a document: sentences packed to a target size, oversized ones split, small ones merged.

The packing is sequential within a document, so it runs in Python, on Arrow batches, document by document. Sizes are counted
once per part and added up: a part's size is (its CJK characters, its other characters)."""

from __future__ import annotations

import importlib.util
import re
from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import LIST_ITEM

CANDIDATES = "array<struct<order:int,text:string>>"
_CJK = re.compile("[一-鿿]")
_LIST_ITEM = re.compile(LIST_ITEM)
_EMPTY_LINES = re.compile(r"\n{2,}")
#: Fixed value: the marks at which an oversized sentence may be cut.
_SEPARATED = re.compile(r"[,，:：、\s]+|[^,，:：、\s]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*")

Segmenter = Callable[[str], list[str]]


def regex_sentences(text: str) -> list[str]:
    """The stand-in segmenter (functions.text.sentences)."""
    return [s for s in map(str.strip, _SENTENCE.split(text)) if s]


def native_sentences(text: str) -> list[str]:
    """By the native segmenter, where it is installed."""
    from blingfire import text_to_sentences_and_offsets

    spans = text_to_sentences_and_offsets(text)[1] or [(0, len(text))]
    return [s for s in (text[a:b].strip() for a, b in spans) if s]


def segmenter() -> Segmenter:
    """The native segmenter if it can be imported, else the stand-in."""
    return native_sentences if importlib.util.find_spec("blingfire") else regex_sentences


@dataclass(frozen=True)
class Size:
    cjk: int = 0
    other: int = 0

    @staticmethod
    def of(text: str) -> Size:
        cjk = len(_CJK.findall(text))
        return Size(cjk, len(text) - cjk)

    def __add__(self, more: Size) -> Size:
        return Size(self.cjk + more.cjk, self.other + more.other)


@dataclass(frozen=True)
class Chunker:
    """hard: no sentence goes beyond it uncut; target: chunks are filled up to it; small: chunks below it are merged."""

    # The sizes that the format's other tools use.
    hard: int = 8092
    target: int = 600
    small: int = 200
    chars_per_token: int = 4
    segment: Segmenter = regex_sentences

    @property
    def goal(self) -> int:
        return min(self.hard, self.target)

    def tokens(self, size: Size) -> int:
        return max(1, size.cjk + size.other // self.chars_per_token)

    def estimate(self, text: str) -> int:
        return self.tokens(Size.of(text))

    def _pack(self, parts: Iterable[str], glue: str, limit: int, alone: Callable[[str], list[str]] | None = None) -> list[str]:
        """Parts joined by glue up to limit. A part beyond the hard limit (with a space as glue) or beyond `limit` itself is
        replaced by alone(part), whose pieces stay apart."""
        out: list[str] = []
        held: list[str] = []
        size, between = Size(), Size.of(glue)

        def flush() -> None:
            nonlocal held, size
            if held:
                out.append(glue.join(held))
            held, size = [], Size()

        bound = self.hard if glue else limit
        for part in parts:
            own = Size.of(part)
            if alone and self.tokens(own) > bound:
                flush()
                out += alone(part)
                continue
            more = size + between + own if held else own
            if held and self.tokens(more) > limit:
                flush()
                more = own
            held.append(part)
            size = more
        flush()
        return out

    def split_chars(self, text: str, limit: int) -> list[str]:
        return self._pack(text, "", limit)

    def split_long(self, text: str, limit: int) -> list[str]:
        """Cuts at separators; white space between parts is lost, other separators stay. Without any, cuts anywhere."""
        if self.estimate(text) <= limit:
            return [text]
        parts = [p for p in map(str.strip, _SEPARATED.findall(text)) if p]
        if len(parts) < 2:
            return self.split_chars(text, limit)
        return [c.strip() for c in self._pack(parts, "", limit, lambda p: self.split_chars(p, limit))]

    def pack_sentences(self, sentences: Iterable[str]) -> list[str]:
        return self._pack(sentences, " ", self.goal, lambda s: self.split_long(s, self.hard))

    def blocks(self, text: str) -> list[str]:
        out: list[str] = []
        for p in map(str.strip, _EMPTY_LINES.split(text)):
            if p and out and _LIST_ITEM.match(p):
                out[-1] += " " + p
            elif p:
                out.append(p)
        return out

    def split_block(self, text: str) -> list[str]:
        if self.estimate(text) <= self.goal:
            return [text]
        sentences = self.segment(text)
        return self.pack_sentences(sentences) if len(sentences) > 1 else self.split_long(text, self.hard)

    def merge_small(self, chunks: Iterable[str]) -> list[str]:
        """Joins each small chunk, from the left, with the neighbour that comes closest to the target without passing it, or
        else passes it least; ties go to the smaller result, then the left. What is left of the scan is never small."""
        todo = deque((c, Size.of(c)) for c in chunks if c.strip())
        done: list[tuple[str, Size]] = []

        def cost(a: Size, b: Size) -> tuple[bool, int, int]:
            n = self.tokens(a + Size(0, 2) + b)
            return n > self.goal, abs(self.goal - n), n

        def joined(a: str, b: str) -> tuple[str, Size]:
            text = a.rstrip() + "\n\n" + b.lstrip()
            return text, Size.of(text)

        while todo:
            text, size = todo.popleft()
            if self.tokens(size) >= self.small or not (done or todo):
                done.append((text, size))
            elif done and (not todo or cost(done[-1][1], size) <= cost(size, todo[0][1])):
                todo.appendleft(joined(done.pop()[0], text))
            else:
                todo.appendleft(joined(text, todo.popleft()[0]))
        return [text for text, _ in done]

    def candidates(self, doc_text: list[str] | None) -> list[str]:
        """One element is a text with paragraphs; several are its sentences."""
        parts = [s for s in map(str.strip, (x for x in doc_text or [] if x is not None)) if s]
        if len(parts) == 1:
            return self.merge_small(c for b in self.blocks(parts[0]) for c in self.split_block(b))
        return self.merge_small(self.pack_sentences(parts))


def texts_udf(f: Callable[[list[str] | None], list[str]], numbered: bool = False) -> Callable[[Column], Column]:
    """A column function array<string> -> array<string>, or -> array<struct<order, text>>, from a Python function of a list."""

    def run(column: pa.Array) -> pa.Array:
        lists = [f(x) for x in column.to_pylist()]
        if not numbered:
            return pa.array(lists, pa.list_(pa.string()))
        rows = [[{"order": i, "text": t} for i, t in enumerate(x, 1)] for x in lists]
        return pa.array(rows, pa.list_(pa.struct([("order", pa.int32()), ("text", pa.string())])))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, CANDIDATES if numbered else "array<string>")


def chunk_candidates(doc_text: Column | str, chunker: Chunker = Chunker()) -> Column:
    """The numbered chunk candidates of an array of texts; empty if it has none."""
    return texts_udf(chunker.candidates, numbered=True)(doc_text)
