"""Mixing sources to target weights: temperature, repetition limits, budgeted block permutations.

Weights are w(a) ~ target^(1-a) * share^a over the sources that have tokens, share being a source's part of
all tokens: the exponent a = 0 gives the targets, a = 1 the corpus as it is. The budget is all tokens of these sources unless
stated. A source can't get more than its documents repeated as often as they may be; what it can't take goes to the others
in proportion to their weights. The least exponent at which no more than SPILL of the budget has to move in this way
(and the entropy is as high as wanted) is found by bisection, so targets are kept where the sources can bear them and small
sources cool the mix where they can't. A source's budget is whole passes over its documents, then the head of a seeded
permutation. The permutation is laid out in hash blocks: block totals tell which blocks are taken whole, and only the block in
which the budget ends is ordered within; documents that don't fit any more are passed over for smaller ones.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.tokens import VOCABULARY, encode_texts
from rosterflow.runtime import written

IN_BLOCK = 2_000  # documents of a block on average, whatever the size of the source
SPILL = 0.1  # share of the budget that may move from sources at their limit to the others
_HALVINGS = 60


def _filled(weights: Mapping[str, float], caps: Mapping[str, float]) -> dict[str, float]:
    """Weights of sum 1 of which none is over its cap; what is cut off goes to the others in proportion."""
    out: dict[str, float] = {}
    left, free = 1.0, dict(weights)
    while free:
        total = math.fsum(free.values())
        over = [s for s, x in free.items() if x / total * left >= caps[s]]
        if not over:
            return out | {s: x / total * left for s, x in free.items()}
        for s in over:
            out[s] = caps[s]
            del free[s]
        left = 1.0 - math.fsum(out.values())
    return out


def weights(sizes: Mapping[str, int], targets: Mapping[str, tuple[float, int]], budget: float | None = None, min_entropy: float | None = None, spill: float = SPILL) -> tuple[dict[str, float], float, float]:
    """(share of the budget for each source, exponent, budget). sizes: tokens; targets: (share, most repeats).

    Sources without tokens, without a positive target or with no repeats allowed get no weight, and
    the other targets are scaled to a sum of 1. A budget that can't be filled is lowered. ``min_entropy`` (in nats) is a
    further bound on the exponent; one that no exponent up to 1 reaches gives 1. ``spill`` 0 moves nothing between
    sources, so that the exponent alone keeps to the limits.
    """
    live = {s: (t, r) for s, (t, r) in sorted(targets.items()) if sizes.get(s, 0) > 0 and t and t > 0 and r and r > 0}
    if not live:
        return {}, 0.0, 0.0
    sum_t, sum_n = math.fsum(t for t, _ in live.values()), sum(sizes[s] for s in live)
    limits = {s: r * sizes[s] for s, (_, r) in live.items()}
    budget = float(min(sum_n if budget is None else budget, sum(limits.values())))
    caps = {s: x / budget for s, x in limits.items()} if budget > 0 else {}
    if not caps:
        return {s: 0.0 for s in live}, 0.0, 0.0

    def at(a: float) -> dict[str, float]:
        raw = {s: (t / sum_t) ** (1 - a) * (sizes[s] / sum_n) ** a for s, (t, _) in live.items()}
        total = math.fsum(raw.values())
        return {s: x / total for s, x in raw.items()}

    def fine(a: float) -> bool:
        w = at(a)
        moved = math.fsum(max(0.0, x - caps[s]) for s, x in w.items())
        entropy = -math.fsum(x * math.log(x) for x in w.values())
        return moved <= spill + 1e-12 and (min_entropy is None or entropy >= min_entropy)

    lo, hi = 0.0, 0.0 if fine(0.0) else 1.0
    for _ in range(_HALVINGS if hi else 0):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if fine(mid) else (mid, hi)
    return _filled(at(hi), caps), hi, budget


def _goals(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """Target and limit of each source; the table is small and fixed, of a source listed twice the first by order counts."""
    goals = targets.select("source", "target_share", "max_repeats").where("source is not null").orderBy("source", "target_share", "max_repeats").limit(10_001).collect()
    if len(goals) > 10_000:
        raise ValueError("more than 10,000 sources in targets")
    wanted: dict[str, tuple[float, int]] = {}
    for g in goals:
        wanted.setdefault(g.source, (g.target_share or 0.0, g.max_repeats or 0))
    return wanted


def _sizes(docs: DataFrame, wanted: Mapping[str, tuple[float, int]]) -> dict[str, tuple[int, int]]:
    """Tokens and documents with any of each listed source; at most 10,000 rows."""
    got = docs.where(F.col("source").isin(list(wanted)) & (F.col("n_tokens") > 0)).groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs")).collect()
    return {r.source: (r.n, r.docs) for r in got}


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", budget: float | None = None, min_entropy: float | None = None, spill: float = SPILL, seed: int = 7, vocabulary: str = VOCABULARY) -> DataFrame:
    """key, source, n_tokens, uses of every document: how often the mix takes it.

    ``targets`` (source, target_share, max_repeats) is a small fixed table and is read on the driver (at most
    10,000 rows, else ValueError). Documents without source, or of one not listed, are used 0 times, as are those without
    tokens. No document is used more often than its source's max_repeats; no source gets more than its budget, and what is
    left of it is less than the smallest unused document of its last block.
    """
    wanted = _goals(targets)
    named = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").alias("body"))
    docs = written(encode_texts(named, "key", "body", vocabulary, count_only=True, carry=("source",)), "sizes")
    sizes = _sizes(docs, wanted)
    w, _, total = weights({s: n for s, (n, _) in sizes.items()}, wanted, budget, min_entropy, spill)
    plan = []
    for s, x in w.items():
        share = min(math.floor(x * total + 1e-6), wanted[s][1] * sizes[s][0])
        passes, rest = divmod(share, sizes[s][0])
        plan.append((s, int(passes), int(rest), max(1, sizes[s][1] // IN_BLOCK)))
    kind = docs.schema["key"].dataType.simpleString()
    # one row for each listed source: bounded by the targets table
    plans = F.broadcast(documents.sparkSession.createDataFrame(plan, "source string, passes int, rest bigint, blocks bigint"))
    order = F.xxhash64(F.lit(seed), "key")
    placed = docs.join(plans, "source", "left").withColumn("block", F.when(F.col("n_tokens") > 0, F.pmod(order, "blocks")))
    totals = placed.where("rest > 0 and block is not null").groupBy("source", "rest", "block").agg(F.sum("n_tokens").alias("size"))
    upto = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    edges = totals.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0))).where("before + size > rest and before <= rest")
    edges = edges.groupBy("source").agg(F.min(F.struct("block", (F.col("rest") - F.col("before")).alias("room"))).alias("e")).select("source", F.col("e.block").alias("edge"), F.col("e.room").alias("room"))
    placed = placed.join(F.broadcast(edges), "source", "left")  # one row for each listed source, again
    at_edge = F.coalesce(F.col("block") == F.col("edge"), F.lit(False))
    head = Window.partitionBy("source").orderBy(order, "key").rowsBetween(Window.unboundedPreceding, 0)
    small = Window.partitionBy("source").orderBy(F.col("first"), "n_tokens", order, "key").rowsBetween(Window.unboundedPreceding, 0)
    # the head of the permutation while it fits, then the smallest of the others while they fit
    inside = placed.where(at_edge).withColumn("first", F.when(F.sum("n_tokens").over(head) <= F.col("room"), 0).otherwise(1))
    inside = inside.withColumn("extra", (F.sum("n_tokens").over(small) <= F.col("room")).cast("int")).drop("first")
    outside = placed.where(~at_edge).withColumn("extra", F.coalesce((F.col("block") < F.col("edge")).cast("int"), F.lit(0)))
    uses = F.when((F.col("n_tokens") > 0) & F.col("passes").isNotNull(), F.col("passes") + F.col("extra")).otherwise(F.lit(0)).cast("int")
    return inside.unionByName(outside).select(F.col("key").cast(kind).alias(key), F.col("source").alias(source), "n_tokens", uses.alias("uses"))


def shares(mixed: DataFrame, targets: DataFrame, budget: float | None = None, min_entropy: float | None = None, spill: float = SPILL) -> DataFrame:
    """source, target_share, max_repeats, available and used documents and tokens, planned and actual share, exponent.

    One row for each source that is listed or has documents; null targets where it isn't listed. The other arguments are
    those of ``mix``.
    """
    wanted = _goals(targets)
    w, exponent, _ = weights({s: n for s, (n, _) in _sizes(mixed, wanted).items()}, wanted, budget, min_entropy, spill)
    planned = F.broadcast(mixed.sparkSession.createDataFrame(list(w.items()), "source string, planned_share double"))
    used = mixed.groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.sum((F.col("uses") > 0).cast("long")).alias("used_documents"), F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("most_uses"))
    total = used.agg(F.sum("used_tokens").alias("total"))
    joined = used.join(targets.select("source", "target_share", "max_repeats"), "source", "full").join(planned, "source", "left").crossJoin(F.broadcast(total))  # one row
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    reached = F.when(F.col("total") > 0, F.coalesce("used_tokens", F.lit(0)) / F.col("total")).otherwise(F.lit(0.0)).alias("actual_share")
    return joined.select("source", "target_share", "max_repeats", zero("n_documents"), zero("n_tokens"), zero("used_documents"), zero("used_tokens"), zero("most_uses"), F.coalesce("planned_share", F.lit(0.0)).alias("planned_share"), reached, F.lit(exponent).alias("exponent"))
