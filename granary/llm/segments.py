"""Cutting oversized texts into pieces at natural boundaries.

Lexical-cohesion segmentation. A text's sentences are its units. At each gap the word counts of the `block` units before it
and after it are compared by cosine; a gap deep below the similarities around it (its depth) is a change of topic. A piece
ends at the deepest gap of its size window: past `fill` of the limit, within the limit. Without a sentence end there,
the last one before the window serves, then the last clause mark or white space, then the limit itself. Each piece after the
first begins with an overlap, the longest end of its predecessor of at most `overlap` tokens that begins with a word.

Sizes are in tokens of the project's estimate, by prefix sums, so a text of any length takes time in proportion to it.
Texts within the limit never leave the JVM.

Defined cases: null texts give no piece and empty ones one empty piece; a text without white space is cut at the limit; rows
are cut one by one, so repeated rows give repeated pieces; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_text, token_estimate
from ..operators.deliveries import first_delivery
from ..runtime import slots

_SENTENCE = re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|[。！？]+[”’」』）]*\s*|\n\s*\n\s*")
_CLAUSE = re.compile(r"[,;:]\s+|[，；：、]\s*")
_WORD = re.compile(r"[一-鿿]|[^\W_一-鿿]+")


def _sizes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the characters that count as a token, and of the others."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    whole = (codes >= 0x4E00) & (codes <= 0x9FFF)
    zero = np.zeros(1, dtype=np.int64)
    return np.concatenate([zero, np.cumsum(whole)]), np.concatenate([zero, np.cumsum(~whole)])


@dataclass(frozen=True)
class Cutter:
    limit: int = 600
    overlap: int = 60
    block: int = 4
    fill: float = 0.5

    def depths(self, text: str, ends: list[int]) -> np.ndarray:
        """How far the similarity at each inner sentence end lies below the peaks on both sides of it."""
        units = [Counter(_WORD.findall(text[a:b].lower())) for a, b in zip([0, *ends], [*ends, len(text)])]
        n = len(units) - 1
        near = np.zeros(n)
        for g in range(n):
            left, right = Counter(), Counter()
            for u in units[max(0, g + 1 - self.block) : g + 1]:
                left.update(u)
            for u in units[g + 1 : g + 1 + self.block]:
                right.update(u)
            norm = sum(c * c for c in left.values()) * sum(c * c for c in right.values())
            near[g] = sum(c * right[w] for w, c in left.items()) / norm**0.5 if norm else 0.0
        depth = np.zeros(n)
        for order in (range(n), range(n - 1, -1, -1)):
            peak, before = 0.0, None
            for g in order:
                peak = peak if before is not None and before >= near[g] else near[g]  # the top of the climb away from g
                depth[g] += peak - near[g]
                before = near[g]
        return depth

    def cut(self, text: str) -> list[tuple[int, int, int]]:
        """(start, body, end) of each piece: it is text[start:end], its overlap text[start:body]."""
        cjk, other = _sizes(text)
        size = lambda a, b: int(cjk[b] - cjk[a] + (other[b] - other[a]) // 4)
        if size(0, len(text)) <= self.limit:
            return [(0, 0, len(text))]
        ends = [m.end() for m in _SENTENCE.finditer(text) if 0 < m.end() < len(text)]
        depth = self.depths(text, ends)
        ends = np.array(ends, dtype=np.int64)
        clauses = np.array([m.end() for m in _CLAUSE.finditer(text)], dtype=np.int64)
        spaces = np.array([m.end() for m in re.finditer(r"\s+", text)], dtype=np.int64)

        def furthest(start: int) -> int:
            """The largest end of a piece that begins at start."""
            low, high = start + 1, len(text)
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if size(start, mid) <= self.limit else (low, mid - 1)
            return low

        def last(marks: np.ndarray, after: int, upto: int) -> int | None:
            i = np.searchsorted(marks, upto, side="right") - 1
            return int(marks[i]) if i >= 0 and marks[i] > after else None

        out, start, body = [], 0, 0
        while True:
            upto = furthest(start)
            if upto == len(text):
                out.append((start, body, upto))
                return out
            a, b = np.searchsorted(ends, body, side="right"), np.searchsorted(ends, upto, side="right")
            window = [i for i in range(a, b) if size(start, int(ends[i])) >= self.fill * self.limit]
            if window:
                end = int(ends[max(window, key=lambda i: (depth[i], i))])
            else:
                end = last(ends, body, upto) or last(clauses, body, upto) or last(spaces, body, upto) or upto
            out.append((start, body, end))
            body = end
            low, high = out[-1][1], end  # the overlap lies within the predecessor's own part
            while low < high:
                mid = (low + high) // 2
                low, high = (low, mid) if size(mid, end) <= self.overlap else (mid + 1, high)
            start = low
            if start > out[-1][1] and start < end and not text[start - 1].isspace() and not "一" <= text[start] <= "鿿":
                i = np.searchsorted(spaces, start, side="left")
                start = int(spaces[i]) if i < len(spaces) and spaces[i] < end else start


PIECES = "piece int, pieces int, start int, body int, end int, tokens int, text string"


def split_oversized(items: DataFrame, keys: list[str], text: str = "text", cutter: Cutter = Cutter()) -> DataFrame:
    """(keys..., piece, pieces, start, body, end, tokens, text): the pieces of each item. start, body and end are
    character offsets in the item's text; start to body repeats the end of the piece before."""
    rows = items.where(F.col(text).isNotNull()).select(*[F.col(k).alias(k) for k in keys], F.col(text).alias("_text"), token_estimate(text).alias("_tokens"))
    zero, one = F.lit(0), F.lit(1)
    length = F.char_length("_text").cast("int")
    small = rows.where(F.col("_tokens") <= cutter.limit).select(*keys, one.alias("piece"), one.alias("pieces"), zero.alias("start"), zero.alias("body"), length.alias("end"), F.col("_tokens").alias("tokens"), F.col("_text").alias("text"))

    def run(batches):
        for b in batches:
            take, cells = [], []
            for i, t in enumerate(b.column("_text").to_pylist()):
                cjk, other = _sizes(t)
                parts = cutter.cut(t)
                for n, (start, body, end) in enumerate(parts):
                    take.append(i)
                    cells.append((n + 1, len(parts), start, body, end, int(cjk[end] - cjk[start] + (other[end] - other[start]) // 4), t[start:end]))
            columns = list(zip(*cells)) or [[]] * 7
            kinds = [pa.int32()] * 6 + [pa.string()]
            yield pa.RecordBatch.from_arrays([*b.select(keys).take(pa.array(take, pa.int64())).columns, *[pa.array(c, k) for c, k in zip(columns, kinds)]], [*keys, *[x.split()[0] for x in PIECES.split(", ")]])

    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys) + ", " + PIECES
    large = rows.where(F.col("_tokens") > cutter.limit).drop("_tokens").repartition(slots(rows.sparkSession)).mapInArrow(run, schema)
    return small.unionByName(large)


def items_of(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(item_kind, doc_id, cand_order, text): each doc once (order 0), and each text of the candidate lists."""
    doc = first_delivery(docs, "doc_id", joined_text("doc_text"), {}).select(F.lit("doc").alias("item_kind"), "doc_id", F.lit(0).alias("cand_order"), "text")
    listed = candidates.select("doc_id", F.explode("candidates").alias("c"))
    return doc.unionByName(listed.select(F.lit("candidate").alias("item_kind"), "doc_id", F.col("c.order").cast("int").alias("cand_order"), F.col("c.text").alias("text")))
