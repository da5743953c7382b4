"""Text functions as Catalyst expressions. Null in, null out, unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that Unicode-aware stripping removes (Spark's own trim knows U+0020 only).
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Fixed value: the characters that count as a token each.
CJK = "[一-鿿]"
#: A word: a CJK character alone, or the longest run of other letters and digits.
WORD = "[一-鿿]|[\\p{L}\\p{N}&&[^一-鿿]]+"


def strip(c: Column | str) -> Column:
    return F.btrim(c if isinstance(c, Column) else F.col(c), F.lit(WHITE))


def is_blank(c: Column | str) -> Column:
    """Null, empty or only white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


def clean_items(c: Column | str) -> Column:
    """The array's elements trimmed, without null and blank ones, in order. A null array gives an empty one."""
    c = c if isinstance(c, Column) else F.col(c)
    kept = F.filter(F.transform(c, strip), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def joined_text(c: Column | str) -> Column:
    """The cleaned elements joined by one space; "" if there are none."""
    return F.array_join(clean_items(c), " ")


def words(c: Column | str) -> Column:
    """The words of the lower-cased text, in order."""
    c = c if isinstance(c, Column) else F.col(c)
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), F.lit(1))


def canonical(c: Column | str) -> Column:
    """Lower-cased, each run of characters other than letters and digits one space, trimmed."""
    c = c if isinstance(c, Column) else F.col(c)
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def token_estimate(c: Column | str) -> Column:
    """Characters U+4E00 to U+9FFF plus a fourth of all others, rounded down (0 for "")."""
    c = c if isinstance(c, Column) else F.col(c)
    cjk = F.regexp_count(c, F.lit(CJK))
    return (cjk + F.floor((F.char_length(c) - cjk) / 4)).cast("int")


def estimate_tokens(c: Column | str) -> Column:
    """token_estimate, at least 1."""
    return F.greatest(F.lit(1), token_estimate(c))


def label(c: Column | str) -> Column:
    """A short label (source, lang, split) trimmed and lower-cased; null if blank."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


#: Fixed value: how a paragraph that is a list item begins.
LIST_ITEM = r"^(?:[-*•]|(?:\(?\d+\)?|[A-Z]|[IVXivx]+)[\.\):])\s+"
_MARK = "\x1e"


def paragraphs(c: Column | str) -> Column:
    """The parts between empty lines, trimmed, without blank ones."""
    return clean_items(F.split(c, r"\n{2,}"))


def paragraph_blocks(c: Column | str) -> Column:
    """paragraphs, each list item appended to the block before it with a space."""
    start = F.array().cast("array<string>")

    def add(blocks: Column, p: Column) -> Column:
        n = F.size(blocks)
        joined = F.concat(F.slice(blocks, F.lit(1), n - 1), F.array(F.concat(F.element_at(blocks, -1), F.lit(" "), p)))
        return F.when((n > 0) & p.rlike(LIST_ITEM), joined).otherwise(F.concat(blocks, F.array(p)))

    return F.aggregate(paragraphs(c), start, add)


def sentences(c: Column | str) -> Column:
    """The stand-in segmenter: a sentence ends after . ! ? and white space, or after 。！？."""
    c = c if isinstance(c, Column) else F.col(c)
    return clean_items(F.split(F.regexp_replace(c, r"([.!?])\s+|([。！？])\s*", f"$1$2{_MARK}"), _MARK))


def chunk_id(doc_id: Column, order: Column, total: Column) -> Column:
    """doc_id#c and the order, zero-padded to the digits of total, at least 3."""
    digits = F.greatest(F.lit(3), F.length(total.cast("string")))
    return F.concat(doc_id, F.lit("#c"), F.lpad(order.cast("string"), digits, F.lit("0")))


def prepared(text: Column, prefix: str = "", template: str = "") -> Column:
    """The text as an encoder gets it: prefixed, then put into the template's {text}, or behind a template without it.
    Other fields of the template are filled or refused on the driver, as str.format would."""
    base = F.concat(F.lit(prefix), text)
    if not template:
        return base
    if "{text}" not in template:
        return F.concat(F.lit(template), base)
    before, *between = template.replace("{{", "\x01").replace("}}", "\x02").split("{text}")
    parts = [before, *between]
    if any("{" in p or "}" in p for p in parts):
        raise ValueError(f"unknown field in template {template!r}")
    parts = [p.replace("\x01", "{").replace("\x02", "}") for p in parts]
    out = [F.lit(parts[0])]
    for p in parts[1:]:
        out += [base, F.lit(p)]
    return F.concat(*out)
