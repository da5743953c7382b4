"""Public tokenizer files of byte-level pair merges: how they split a text, and the replay of their merges over a whole
vocabulary at once.

A file is honoured as it stands or refused: its normalizer (run by the tokenizer library), the two usual byte-level
pre-splittings (run here by their pattern), and an end-of-word mark. Anything else raises NotHonoured; no text is ever
encoded by rules that aren't the file's."""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex

#: Fixed value: the published pattern that splits text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class NotHonoured(ValueError):
    """A tokenizer file asks for something that this module doesn't do."""


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable,
    else the next unused one from U+0100 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def library(path: str):
    """The tokenizer library's own reading of a file, for which strings of special tokens are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@lru_cache(maxsize=4)
def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def pattern_of(path: str) -> str:
    """The pattern whose matches are the pieces of a normalized text."""
    how = _file(path).get("pre_tokenizer") or {}
    parts = how.get("pretokenizers", [how])
    last = parts[-1] if parts else {}
    if last.get("type") == "ByteLevel" and not last.get("add_prefix_space"):
        if len(parts) == 1 and last.get("use_regex", True):
            return SPLIT
        first = parts[0]
        matches = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "Regex" in first.get("pattern", {})
        if len(parts) == 2 and not last.get("use_regex", True) and matches:
            return first["pattern"]["Regex"]
    raise NotHonoured(f"{path}: pre-tokenizer {how}")


@lru_cache(maxsize=1)
def unsettled() -> Callable[[str], bool]:
    """Tells whether a text has a letter or number by the newest Unicode that an older one doesn't know, on which libraries
    differ. Those of the first plane make a class that is looked up at once; the others are sought only in texts that have
    a character beyond that plane."""
    newest = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)])))  # planes with letters
    new = {c for c in newest if unicodedata.category(c) == "Cn"}
    near = re.compile("[\uffff" + "".join(sorted(c for c in new if c < "\uffff")) + "]").search
    far = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: not text.isascii() and (near(text) is not None or far(text) is not None and not new.isdisjoint(text))


@lru_cache(maxsize=4)
def splitter(path: str) -> Callable[[str], list[str]]:
    """The pieces of a text, by the file's normalizer and pre-splitting. A text with unsettled characters is split by the
    tokenizer library."""
    find, newer = regex.compile(pattern_of(path)).findall, unsettled()
    normal = str if _file(path).get("normalizer") is None else library(path).normalizer.normalize_str

    def split(text: str) -> list[str]:
        text = normal(text)
        if not newer(text):
            return find(text)
        return [text[a:b] for _, (a, b) in library(path).pre_tokenizer.pre_tokenize_str(text)]

    return split


class Merges:
    """The merge table of a tokenizer file: the ids of single bytes, within a word and at its end, and
    (left id, right id) -> (rank, merged id)."""

    def __init__(self, path: str):
        model = _file(path)["model"]
        odd = {k: model[k] for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)}
        if model.get("type", "BPE") != "BPE" or odd:
            raise NotHonoured(f"{path}: model {model.get('type')} with {odd}")
        pattern_of(path)  # refuses what isn't honoured
        self.path = path
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        try:
            self.bytes = [vocab[c] for c in byte_characters()]
            self.ends = [vocab[c + suffix] for c in byte_characters()]
        except KeyError as e:
            raise NotHonoured(f"{path}: no token for the byte {e}") from e
        self.table: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.table.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))

    def pieces(self, text: str) -> list[str]:
        return splitter(self.path)(text)

    def replay(self, words: list[str]) -> list[list[int]]:
        """The token ids of each word. An inverted index leads from a pair of neighbours to all positions of the
        vocabulary that have it. The merge of lowest rank among the pairs present is applied at all its positions,
        left to right, and only the two neighbours of a merged position enter the index anew."""
        table, one, at_end = self.table, self.bytes, self.ends
        symbol: list[int] = []
        starts: list[int] = []
        after: list[int] = []
        before: list[int] = []
        index: defaultdict[int, list[int]] = defaultdict(list)
        for word in words:
            first = len(symbol)
            starts.append(first)
            raw = word.encode("utf-8")
            symbol.extend(map(one.__getitem__, raw))
            end = len(symbol)
            if end > first:
                symbol[-1] = at_end[raw[-1]]
            after.extend(range(first + 1, end + 1))
            before.extend(range(first - 1, end - 1))
            if end > first:
                after[-1] = before[first] = -1
            for p in range(first, end - 1):
                pair = symbol[p] << 32 | symbol[p + 1]
                if pair in table:
                    index[pair].append(p)
        queue = [(*table[pair], pair) for pair in index]
        heapify(queue)
        while queue:
            _, merged, pair = heappop(queue)
            left, right = pair >> 32, pair & 0xFFFFFFFF
            for p in sorted(index.pop(pair)):
                q = after[p]
                if symbol[p] != left or q < 0 or symbol[q] != right:
                    continue
                n = after[q]
                symbol[p], symbol[q], after[p] = merged, -1, n
                touched = []
                if n >= 0:
                    before[n] = p
                    touched.append((merged << 32 | symbol[n], p))
                if (k := before[p]) >= 0:
                    touched.append((symbol[k] << 32 | merged, k))
                for pair2, at in touched:
                    if pair2 in table:
                        if pair2 not in index:
                            heappush(queue, (*table[pair2], pair2))
                        index[pair2].append(at)
        out = []
        for first, word in zip(starts, words):
            ids, p = [], first if word else -1
            while p >= 0:
                ids.append(symbol[p])
                p = after[p]
            out.append(ids)
        return out


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)
