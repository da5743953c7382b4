"""Ordered validation: the first rule that a row breaks is its issue; rows without one are accepted.

A table under validation carries `issue`, a struct (issue_type, record_id, detail) that is null while the row is good. Row
rules are one CASE expression, so they cost no shuffle; references are joins of the still-good rows with the distinct ids;
duplicates are judged last, among the rows that are good until then, since a rejected row never claims its id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ISSUE = "struct<issue_type:string,record_id:string,detail:string>"


@dataclass(frozen=True)
class Rule:
    issue_type: str
    broken: Column
    record_id: Column | None = None
    detail: Column | None = None


def _issue(issue_type: str | Column, record_id: Column | None, detail: Column | None) -> Column:
    kind = F.lit(issue_type) if isinstance(issue_type, str) else issue_type
    null = F.lit(None).cast("string")
    return F.struct(kind.alias("issue_type"), (null if record_id is None else record_id).alias("record_id"), (null if detail is None else detail).alias("detail")).cast(ISSUE)


def judged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """df with `issue`; a rule over a null condition isn't broken. An issue that is there already stays."""
    case = F.col("issue") if "issue" in df.columns else F.lit(None).cast(ISSUE)
    chain = F.when(case.isNotNull(), case) if "issue" in df.columns else None
    for r in rules:
        value = _issue(r.issue_type, r.record_id, r.detail)
        chain = F.when(r.broken, value) if chain is None else chain.when(r.broken, value)
    return df.withColumn("issue", chain)


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("issue").isNull()).drop("issue")


def with_reference(df: DataFrame, key: str, valid: DataFrame, issue_type: str, record_id: Column) -> DataFrame:
    """Marks good rows whose key isn't among the first column of valid."""
    ids = valid.select(F.col(valid.columns[0]).alias("_ref")).distinct()
    joined = df.join(ids, F.col(key) == F.col("_ref"), "left")
    return judged(joined, [Rule(issue_type, F.col("_ref").isNull(), record_id)]).drop("_ref")


def first_wins(df: DataFrame, keys: list[str], order: Column, later: Column, carry: tuple[str, ...] = (), unique: bool = False) -> DataFrame:
    """Marks every good row but the first of its keys with the issue `later`, a struct over the row and `first`, which has
    the first row's carried columns.

    The first row is found by an aggregation of keys, order and carried columns only, which combines before the shuffle, and
    is joined back, so a key with very many rows isn't one task's sort and adaptive execution may split its join. Nothing
    runs while the plan is made; the source is read twice, once by few columns. unique: order tells all rows apart. Else
    rows of the same keys and order are numbered among themselves, and only those lie in one task."""
    rows = df.withColumn("_order", order)
    if unique:
        rows = rows.withColumn("_copy", F.lit(1))
    else:
        rows = rows.withColumn("_copy", F.row_number().over(Window.partitionBy(*keys, "_order", F.col("issue").isNull()).orderBy(F.lit(1))))
    ok = df.where(F.col("issue").isNull()).select(*keys, order.alias("_order"), *[c for c in carry if c not in keys])
    firsts = ok.groupBy(*keys).agg(F.min(F.struct("_order", *carry)).alias("first")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "first")
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    joined = rows.join(firsts, [F.col("issue").isNull(), *same], "left")
    repeats = F.col("issue").isNull() & ((F.col("_copy") > 1) | (F.col("_order") != F.col("first._order")))
    return joined.withColumn("issue", F.when(repeats, later.cast(ISSUE)).otherwise(F.col("issue"))).drop("_order", "_copy", "first", *[f"_k_{k}" for k in keys])


def duplicates(df: DataFrame, key: str, order: Column, issue_type: str, unique: bool = False) -> DataFrame:
    """first_wins for an id: later rows of the id are issue_type, with the id as record_id."""
    return first_wins(df, [key], order, _issue(issue_type, F.col(key), None), unique=unique)


def duplicate_judgments(df: DataFrame, order: Column, unique: bool = False) -> DataFrame:
    """first_wins for (query_id, doc_id): same or conflicting by the relevance of the first row."""
    same = F.col("relevance") == F.col("first.relevance")
    new, old = F.col("relevance").cast("string"), F.col("first.relevance").cast("string")
    kind = F.when(same, "duplicate_qrel_same_relevance").otherwise("duplicate_qrel_conflicting_relevance")
    detail = F.when(same, new).otherwise(F.concat(F.lit("existing="), old, F.lit(", new="), new))
    return first_wins(df, ["query_id", "doc_id"], order, _issue(kind, F.concat_ws("::", "query_id", "doc_id"), detail), ("relevance",), unique)


def issue_rows(df: DataFrame, record_type: str, split: str | None = None, action: str = "skip") -> DataFrame:
    """The rejects as log rows: (file, line_num, issue_type, action, record_type, record_id, split, detail); absent values
    are null, and so left out by a JSON writer."""
    place = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (("file", "string"), ("line_num", "long"))]
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return df.where(F.col("issue").isNotNull()).select(
        *place, F.col("issue.issue_type").alias("issue_type"), F.lit(action).alias("action"), F.lit(record_type).alias("record_type"),
        blank("issue.record_id").alias("record_id"), F.lit(split).cast("string").alias("split"), blank("issue.detail").alias("detail"),
    )
