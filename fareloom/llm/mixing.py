"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern;
the patterns (one row each, which the driver may hold: their number is that of combinations of
sources in use, not of documents) supply words to the quotas of their sources. A pattern's
words cost nothing the first time and one more at every repetition, so the cheapest largest
flow meets the quotas with as few repeats as it can. A pattern that has to give r times its
words gives every document floor(r) times, and the rest from documents in a seeded order.

The order is that of a hash. Where the rest ends is found from sums per hash prefix, two
prefixes of 15 bits one after the other, so no task ever orders the documents of a source. What
then differs from the quota is made up by up to ``FLIPS`` documents, taken or left out against
the order, each the one that brings the sum nearest to the quota.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import WORD, settle

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 7
FLIPS = 3
_BITS = 15


def size(text: str) -> Column:
    """Words of a text; a missing one has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def member(source: Column) -> Column:
    """A source as an element of a pattern: a missing source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def ordered(sources: list[str]) -> list[str]:
    """Members by code point, the missing source last."""
    return sorted(sources, key=lambda s: (s == "null", s))


def targets(sizes: dict[str, int], weights: dict[str, float], total: float, repeats: int = REPEATS) -> dict[str, float]:
    """Shares of ``total`` by weight, none above ``repeats`` times its source's size; excess is shared anew."""
    out, open_ = {}, dict(weights)
    while open_:
        unit = (total - sum(out.values())) / sum(open_.values())
        full = [s for s, w in open_.items() if unit * w > repeats * sizes[s]]
        if not full:
            return out | {s: unit * w for s, w in open_.items()}
        out |= {s: float(repeats * sizes[s]) for s in full}
        open_ = {s: w for s, w in open_.items() if s not in full}
    return out


def route(supply: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: int = REPEATS) -> dict[tuple[str, ...], int]:
    """Words that each pattern gives: a flow of least cost among the largest from patterns to quotas."""
    room: list[int] = []
    cost: list[int] = []
    at: dict[object, list[int]] = defaultdict(list)
    begins: list[object] = []
    to: list[object] = []

    def edge(a: object, b: object, most: int, price: int) -> None:
        for x, y, r, c in ((a, b, most, price), (b, a, 0, -price)):
            at[x].append(len(to))
            begins.append(x), to.append(y), room.append(r), cost.append(c)

    for p, n in supply.items():
        for k in range(repeats):
            edge("from", ("pattern", p), n, k)
        for s in p:
            edge(("pattern", p), ("source", s), repeats * n, 0)
    for s, q in quotas.items():
        edge(("source", s), "to", q, 0)
    while True:
        best, came, queue, waiting = {"from": 0}, {}, deque(["from"]), {"from"}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in at[x]:
                y = to[e]
                if room[e] and best[x] + cost[e] < best.get(y, float("inf")):
                    best[y], came[y] = best[x] + cost[e], e
                    if y not in waiting:
                        queue.append(y)
                        waiting.add(y)
        if "to" not in came:
            break
        path, y = [], "to"
        while y != "from":
            path.append(came[y])
            y = begins[came[y]]
        flow = min(room[e] for e in path)
        for e in path:
            room[e] -= flow
            room[e ^ 1] += flow
    given = defaultdict(int)
    for e in range(0, len(to), 2):
        if begins[e] == "from":
            given[to[e][1]] += room[e ^ 1]
    return dict(given)


def _cuts(units: DataFrame, plan: DataFrame) -> DataFrame:
    """Per pattern of ``plan``: the last hash that gives one more copy, and the few hashes that do otherwise."""
    rest = units.join(plan.where("rest > 0"), "pattern")
    prefix = [F.shiftright("u", 63 - _BITS), F.shiftright("u", 63 - 2 * _BITS)]

    def reach(parts: DataFrame, by: str) -> DataFrame:
        run = F.sum("size").over(Window.partitionBy("pattern").orderBy(by))
        return parts.withColumn("reached", F.col("before") + run)

    inside = rest.withColumn("before", F.lit(0).cast("long"))
    for cell in prefix:
        cells = inside.withColumn("cell", cell).groupBy("pattern", "rest", "before", "cell").agg(F.sum("size").alias("size"))
        ends = reach(cells, "cell").where("reached > rest and reached - size <= rest")
        ends = ends.select("pattern", "cell", (F.col("reached") - F.col("size")).alias("before"))
        inside = settle(inside.drop("before").withColumn("cell", cell).join(ends, ["pattern", "cell"]).drop("cell"), "cut-cell")
        edge = ends if cell is prefix[-1] else None
    ends = settle(edge.select("pattern", "before", F.shiftleft("cell", 63 - 2 * _BITS).alias("low")), "cut-edge")
    last = reach(inside, "u").where("reached <= rest").groupBy("pattern").agg(F.max("u").alias("u"), F.max("reached").alias("reached"))
    cut = ends.join(last, "pattern", "left").select(
        "pattern", F.coalesce("u", F.col("low") - 1).alias("cut"), F.coalesce("reached", "before").alias("reached")
    )
    left = (F.col("rest") - F.col("reached")).alias("left")
    cut = settle(cut.join(plan, "pattern").select("pattern", "cut", left, F.expr("CAST(array() AS array<long>)").alias("flips")), "cut")
    for _ in range(FLIPS):
        used = F.col("u") <= F.col("cut")
        gain = F.when(used, -F.col("size")).otherwise(F.col("size"))
        miss = F.abs(F.col("left") - gain)
        better = units.join(cut, "pattern").where((miss < F.abs("left")) & ~F.array_contains("flips", F.col("u")))
        best = better.groupBy("pattern").agg(F.min(F.struct(miss.alias("miss"), "u", gain.alias("gain"))).alias("best"))
        cut = settle(
            cut.join(best, "pattern", "left").select(
                "pattern",
                "cut",
                (F.col("left") - F.coalesce("best.gain", F.lit(0))).alias("left"),
                F.when(F.col("best").isNull(), F.col("flips")).otherwise(F.array_append("flips", F.col("best.u"))).alias("flips"),
            ),
            "cut",
        )
    return cut.drop("left")


def mix(
    docs: DataFrame,
    sources: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """``docs`` with _fl_pattern, _fl_size, _fl_copies; and the sources with source_size and target.

    ``sources`` is an array column; the sources in order of code point take ``weights`` in turn,
    missing sources last, and share ``share`` of all words. A missing array is one missing source,
    an empty one belongs nowhere and is not taken. Documents without words count 0 whatever
    their copies. Rows that agree in id and text have one hash and share their fate. Words taken
    come as near to the target as whole documents allow; the same table gives the same mix.
    """
    spark = docs.sparkSession
    pattern = F.coalesce(F.array_sort(F.array_distinct(F.transform(sources, member))), F.array(F.lit("null")))
    u = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).bitwiseAND((1 << 63) - 1)
    marked = docs.select("*", pattern.alias("_fl_pattern"), size(text_col).alias("_fl_size"), u.alias("_fl_u"))
    slim = marked.select(F.col("_fl_pattern").alias("pattern"), F.col("_fl_u").alias("u"), F.col("_fl_size").alias("size"))
    units = settle(slim.groupBy("pattern", "u").agg(F.sum("size").alias("size")), "mix-units")

    supply = {tuple(p): n for p, n in units.groupBy("pattern").agg(F.sum("size")).collect()}
    sizes: dict[str, int] = defaultdict(int)
    for p, n in supply.items():
        for s in p:
            sizes[s] += n
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered(list(sizes)))}
    target = targets(sizes, weight, share * sum(n for p, n in supply.items() if p), repeats)
    given = route(supply, {s: round(t) for s, t in target.items()}, repeats)

    plan_rows = [(list(p), given.get(p, 0) // n if n else 1, given.get(p, 0) % n if n else 0) for p, n in supply.items()]
    plan_rows = [(p, copies if p else 0, rest) for p, copies, rest in plan_rows]
    plan = settle(spark.createDataFrame(plan_rows, "pattern array<string>, copies long, rest long"), "mix-plan")
    cuts = settle(plan.join(_cuts(units, plan), "pattern", "left").select(F.col("pattern").alias("_fl_pattern"), "copies", "cut", "flips"), "mix-cuts")
    more = (F.col("_fl_u") <= F.col("cut")) != F.array_contains("flips", F.col("_fl_u"))
    copies = F.col("copies") + F.coalesce(more, F.lit(False)).cast("long")
    mixed = marked.join(cuts, "_fl_pattern").select(*[F.col(c) for c in docs.columns], "_fl_pattern", "_fl_size", copies.alias("_fl_copies"))
    info = [(s, sizes[s], float(target[s])) for s in sizes]
    return mixed, settle(spark.createDataFrame(info, "member string, source_size long, target double"), "mix-sources")
