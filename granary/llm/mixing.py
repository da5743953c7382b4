"""Drawing texts so that each source contributes its target share of the tokens.

Min-cost flow for overlapping sources. A text that several sources have is one item; items are aggregated by the set of
target sources they belong to (their pattern). Tokens flow from each pattern, over its sources, to the sources' quotas;
each further pass over a pattern's texts costs more than the one before, so nothing is repeated while fresh text would do.
The flow is computed on the patterns that occur, at most 2 ** targets whatever the number of texts; more than `most_patterns`
are refused. Each pattern's
items lie in seeded order on a line of their tokens; a source draws an interval of that line, unrolled over the passes.

The order's running sums are taken in two steps, over hash buckets and within a bucket, so no task sorts a whole source.

Unless a total is given it is the largest at which every source with text reaches its weight exactly (but for the length
of one text). With a larger total, or the total "all" (the tokens of all items), sources fall short that max_repeats doesn't
let go further. The mix is over distinct texts: copies of a text in a source are one item, drawn under one id.

Defined cases: null and blank texts are no items; sources compare trimmed and in lower case; texts without a target source
are not drawn; a target without texts gets nothing and the other weights are scaled up; targets with a null or not positive
weight or repeats draw nothing; of targets given twice the one of the largest weight holds; an item's doc_id is the least
of its copies in the source; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, label
from ..runtime import checkpointed, widened
from .token_budget import pieces_of


class Flow:
    """A network of integer capacities and costs."""

    def __init__(self):
        self.arcs: list[list[int]] = []  # to, capacity left, cost; arc i ^ 1 is the reverse of i
        self.out: dict[object, list[int]] = {}

    def add(self, a: object, b: object, capacity: int, cost: int) -> int:
        self.arcs += [[b, capacity, cost], [a, 0, -cost]]
        self.out.setdefault(a, []).append(len(self.arcs) - 2)
        self.out.setdefault(b, []).append(len(self.arcs) - 1)
        return len(self.arcs) - 2

    def send(self, source: object, sink: object) -> int:
        """The largest flow, at the least cost, by shortest augmenting paths."""
        total = 0
        while True:
            cost, via, waiting = {source: 0}, {}, deque([source])
            while waiting:
                a = waiting.popleft()
                for i in self.out.get(a, ()):
                    b, left, price = self.arcs[i]
                    if left > 0 and cost[a] + price < cost.get(b, float("inf")):
                        cost[b], via[b] = cost[a] + price, i
                        waiting.append(b)
            if sink not in via:
                return total
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.arcs[via[at] ^ 1][0]
            much = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= much
                self.arcs[i ^ 1][1] += much
            total += much


def route(capacity: dict[tuple[str, ...], int], repeats: dict[str, int], quotas: dict[str, int]) -> tuple[int, dict[tuple[tuple[str, ...], str], int]]:
    """(tokens sent, tokens by pattern and source): fills the quotas as far as max_repeats lets. A pattern's texts are
    passed at most as often in all as the largest max_repeats of its sources; pass r costs r."""
    net, ways = Flow(), {}
    for pattern, tokens in sorted(capacity.items()):
        for r in range(1, max(repeats[s] for s in pattern) + 1):
            net.add("from", ("p", pattern), tokens, r)
        for s in pattern:
            ways[pattern, s] = net.add(("p", pattern), ("s", s), tokens * repeats[s], 0)
    for s, q in sorted(quotas.items()):
        net.add(("s", s), "to", q, 0)
    sent = net.send("from", "to")
    return sent, {k: net.arcs[i ^ 1][1] for k, i in ways.items() if net.arcs[i ^ 1][1]}


@dataclass(frozen=True)
class Mix:
    path: str  # of the tokenizer file, on every executor
    seed: int = 1
    total: int | str | None = None
    bucket_rows: int = 20_000
    most_patterns: int = 100_000

    def targets(self, targets: DataFrame) -> dict[str, tuple[float, int]]:
        """Weight and max_repeats of each target source."""
        out: dict[str, tuple[float, int]] = {}
        for r in targets.select(label("source").alias("s"), "weight", "max_repeats").where("s is not null and weight > 0 and max_repeats > 0").orderBy("weight", "max_repeats").collect():
            out[r.s] = (r.weight, r.max_repeats)
        return out

    def sized(self, documents: DataFrame, sources: list[str]) -> DataFrame:
        """(h, source, doc_id, tokens): each distinct text once per target source that has it."""
        path = self.path
        rows = documents.select(F.col("doc_id"), label("source").alias("source"), F.col("text")).where(F.col("source").isin(sources) & ~is_blank("text"))

        def run(batches):
            split, length = pieces_of(path)
            pieces: dict[str, int] = {}
            texts: dict[str, int] = {}
            for b in batches:
                sizes = []
                for h, t in zip(b.column("h").to_pylist(), b.column("text").to_pylist()):
                    size = texts.get(h)
                    if size is None:
                        size = 0
                        for p in split(t):
                            n = pieces.get(p)
                            if n is None:
                                n = pieces[p] = length(p)
                            size += n
                        texts[h] = size
                    sizes.append(size)
                for memo, most in ((pieces, 500_000), (texts, 100_000)):  # memories of a task, not of the corpus
                    if len(memo) > most:
                        memo.clear()
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("h"), pa.array(sizes, pa.int64())], ["doc_id", "source", "h", "tokens"])

        hashed = rows.withColumn("h", F.sha2("text", 256))
        counted = widened(hashed).mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, source string, h string, tokens long")
        return counted.groupBy("h", "source").agg(F.min("doc_id").alias("doc_id"), F.min("tokens").alias("tokens"))

    def _plan(self, capacity: dict[tuple[str, ...], int], wanted: dict[str, tuple[float, int]]) -> dict[tuple[tuple[str, ...], str], int]:
        repeats = {s: r for s, (_, r) in wanted.items()}
        weights = {s: wanted[s][0] for p in capacity for s in p}
        if not weights:
            return {}
        whole = sum(weights.values())
        quotas = lambda total: {s: int(total * w / whole) for s, w in weights.items()}
        total = self.total
        if total == "all":
            total = sum(capacity.values())
        if total is None:
            total, high = 0, sum(c * max(repeats[s] for s in p) for p, c in capacity.items())
            while total < high:
                mid = (total + high + 1) // 2
                q = quotas(mid)
                total, high = (mid, high) if route(capacity, repeats, q)[0] == sum(q.values()) else (total, mid - 1)
        return route(capacity, repeats, quotas(total))[1]

    def select(self, documents: DataFrame, targets: DataFrame) -> DataFrame:
        """(doc_id, source, passes, tokens): how often each drawn text is taken for a source."""
        wanted = self.targets(targets)
        return self._draw(checkpointed(self.sized(documents, sorted(wanted))), wanted)

    def _draw(self, sized: DataFrame, wanted: dict[str, tuple[float, int]]) -> DataFrame:
        items = sized.groupBy("h").agg(F.sort_array(F.collect_set("source")).alias("pattern"), F.min("tokens").alias("tokens")).where("tokens > 0")
        sums = items.groupBy("pattern").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).limit(self.most_patterns + 1).collect()
        if len(sums) > self.most_patterns:
            raise ValueError(f"more than {self.most_patterns} sets of sources share texts; merge target sources or raise most_patterns")
        capacity = {tuple(r.pattern): r.tokens for r in sums}
        buckets = -(-max([1, *(r.n for r in sums)]) // self.bucket_rows)
        at: dict[tuple[str, ...], int] = {}
        drawn = []
        for (pattern, source), flow in sorted(self._plan(capacity, wanted).items()):
            low = at.get(pattern, 0)
            at[pattern] = low + flow
            drawn.append((list(pattern), source, low, low + flow, capacity[pattern]))
        intervals = sized.sparkSession.createDataFrame(drawn, "pattern array<string>, source string, low long, high long, around long")
        order = F.xxhash64(F.lit(self.seed), "h")
        placed = items.withColumn("o", order).withColumn("bucket", F.floor((F.col("o").cast("double") / 2.0**64 + 0.5) * buckets))
        per = placed.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("t"))
        before = per.withColumn("base", F.sum("t").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("t")).drop("t")
        inner = F.sum("tokens").over(Window.partitionBy("pattern", "bucket").orderBy("o", "h").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
        line = placed.withColumn("inner", inner).join(before, ["pattern", "bucket"]).select("h", "pattern", (F.col("base") + F.col("inner")).alias("start"))
        turns = lambda c: F.greatest(F.ceil((F.col(c) - F.col("start")) / F.col("around")), F.lit(0))
        taken = line.join(intervals, "pattern").withColumn("passes", (turns("high") - turns("low")).cast("int")).where("passes > 0")
        return taken.select("h", "source", "passes").join(sized, ["h", "source"]).select("doc_id", "source", "passes", "tokens")

    def report(self, documents: DataFrame, targets: DataFrame) -> DataFrame:
        """(source, weight, max_repeats, available_tokens, drawn_tokens, share, most_passes) of each target."""
        wanted = self.targets(targets)
        asked = documents.sparkSession.createDataFrame([(s, w, r) for s, (w, r) in wanted.items()], "source string, weight double, max_repeats int")
        sized = checkpointed(self.sized(documents, sorted(wanted)))
        there = sized.groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
        drawn = self._draw(sized, wanted).groupBy("source").agg(F.sum(F.col("tokens") * F.col("passes")).alias("drawn_tokens"), F.max("passes").alias("most_passes"))
        joined = asked.join(there, "source", "left").join(drawn, "source", "left").na.fill(0)
        whole = F.sum("drawn_tokens").over(Window.partitionBy())  # one row per target
        return joined.select("source", "weight", "max_repeats", "available_tokens", "drawn_tokens", F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(0.0).alias("share"), "most_passes")
