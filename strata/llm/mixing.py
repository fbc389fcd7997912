"""Mixing sources to target weights by entropy balancing.

Targets. Sources in code point order (null last) weigh 3, 1, 2, repeating, and share 150 % of
all words; a target stops at twice its source's size and the excess is shared again by weight
(water filling, solved in closed form over the sources).

Rates. Among all document rates that meet a source's token target, those nearest to one in
entropy, at most ``CAP``, are ``min(CAP, exp(tilt * size / mean size))``. The dual is convex, one
tilt a source; Newton steps (kept inside a bracket) solve all sources at once, until each meets its
target or its bracket holds no further number. Each step is one
distributed aggregation over (source, size) counts: documents of one size share a rate, so the
counts are exact and far smaller than the corpus, and a hot source is summed map-side.

Copies. A document takes the whole part of its rate, and one more copy if a uniform hash of
it lies below the fraction plus the source's cut. The cut that brings a source nearest to
its target is found by refining histograms of (hash - fraction), again distributed sums.
No document exceeds ``CAP`` copies, and reruns agree, as nothing is random.

Defined results: null text has size 0 and takes nothing; repeated rows count each; a null doc_id
is hashed as such; an empty table gives an empty mix; other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.shared import stored

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
BINS, REFINEMENTS = 1024, 2


def sizes(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source key and words of each document, and more columns. The key orders sources by code point, null last."""
    key = F.when(F.col("source").isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), F.col("source")))
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), size.alias("size"), *more)


def targets(counts: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """key, source_size, documents, target: one row a source, from counts of documents by (key, size).

    With sources in the order of cap / weight, the level of the water is where the first source is not full.
    """
    per_source = counts.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents"))
    whole = Window.partitionBy()
    ranked = per_source.withColumn("at", F.row_number().over(Window.orderBy("key")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    filled = (ranked.withColumn("weight", weight)
              .withColumn("full", CAP * F.col("source_size"))
              .withColumn("total", F.sum("source_size").over(whole) * share))
    order = Window.orderBy((F.col("full") / F.col("weight")), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.col("total") - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    found = (filled.withColumn("level", level)
             .withColumn("open", F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level")))
             .withColumn("level", F.max("open").over(whole)))
    return found.select("key", "source_size", "documents", F.coalesce(
        F.least("full", F.col("level") * F.col("weight")), F.col("full")).alias("target"))


def rate(tilt: Column, size: Column, mean: Column) -> Column:
    """The tilted rate; a null tilt stands for a source that is taken to the cap."""
    power = F.least(F.greatest(tilt * size / mean, F.lit(-700.0)), F.lit(1.0))
    return F.when(tilt.isNull(), F.lit(CAP)).otherwise(F.least(F.exp(power), F.lit(CAP)))


def solve(counts: DataFrame, goal: DataFrame, tolerance: float = 1e-7) -> DataFrame:
    """The tilt of every source: key, source_size, target, mean, tilt (null at the cap)."""
    full = F.col("target") >= CAP * F.col("source_size") * (1 - 1e-12)
    state = stored(goal.withColumn("mean", F.greatest(F.lit(1.0), F.col("source_size") / F.col("documents")))
                   .withColumn("tilt", F.when(~full, F.lit(0.0)))
                   .withColumn("low", F.lit(None).cast("double")).withColumn("high", F.lit(None).cast("double"))
                   .withColumn("done", full), "mix")
    z = F.col("size") / F.col("mean")
    r = rate(F.col("tilt"), F.col("size"), F.col("mean"))
    tokens = F.col("size") * F.col("n")
    while not state.filter("not done").isEmpty():
        sums = (counts.filter("size > 0").join(state.filter("not done"), "key").groupBy("key").agg(
            F.sum(tokens * r).alias("got"),
            F.sum(F.when(r < CAP, tokens * z * r).otherwise(0.0)).alias("slope")))
        miss = F.col("got") - F.col("target")
        # The sum grows with the tilt: a miss to either side moves that end of the bracket.
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.col("slope")
        halved = (F.coalesce(F.col("low_"), F.col("high_") * 2 - 1) + F.coalesce(
            F.col("high_"), F.col("low_") * 2 + 1)) / 2
        inside = (F.col("slope") > 0) & (newton > F.coalesce(F.col("low_"), F.lit(float("-inf")))) & (
            newton < F.coalesce(F.col("high_"), F.lit(float("inf"))))
        hit = F.abs(miss) <= tolerance * F.col("target") + 0.01
        step = (state.join(sums, "key", "left").withColumn("low_", low).withColumn("high_", high)
                .withColumn("hit", F.col("done") | F.coalesce(hit, F.lit(True)))
                .withColumn("next", F.when(F.col("hit"), F.col("tilt")).when(inside, newton).otherwise(halved)))
        state = stored(step.select("key", "source_size", "documents", "target", "mean", F.col("next").alias("tilt"),
                                   F.col("low_").alias("low"), F.col("high_").alias("high"),
                                   (F.col("hit") | (F.col("next") == F.col("tilt"))).alias("done")), "mix")
    return state


@dataclass(frozen=True)
class Mix:
    """``plan`` has a row a source: key, source_size, target, mean, tilt, cut, limit, small_cut."""

    plan: DataFrame

    def apply(self, sized: DataFrame) -> DataFrame:
        """Rows of ``sized`` (doc_id, key, size, more) with source_size, target, rate, copies and taken."""
        joined = _with_offer(sized.join(self.plan, "key"))
        copies = (F.floor("rate") + F.when(_chosen(), 1).otherwise(0)).cast("long")
        return (joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
                .drop("mean", "tilt", "cut", "limit", "small_cut", "offer"))


def _chosen() -> Column:
    """Takes one more copy: below the cut, or small enough for what was still missing and below the second cut."""
    small = (F.col("size") <= F.col("limit")) & (F.col("offer") < F.col("small_cut"))
    return F.coalesce((F.col("offer") < F.col("cut")) | small, F.lit(False))


def _with_offer(joined: DataFrame) -> DataFrame:
    """rate, and the hash minus the rate's fraction: the document's place among those for one more copy."""
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "doc_id", "key", "size"), 11) / F.lit(float(1 << 53))
    r = rate(F.col("tilt"), F.col("size"), F.col("mean"))
    return joined.withColumn("rate", r).withColumn(
        "offer", F.when(F.col("rate") < CAP, uniform - (F.col("rate") - F.floor("rate"))))


def _refined(sized: DataFrame, plan: DataFrame, name: str) -> DataFrame:
    """``plan`` with column ``name`` set: the cut below which documents not chosen yet still fit under the target.

    Sums of words in ``BINS`` bins of the offers, then again within the bin that holds the target.
    Also sets ``missing`` (words under the target) and ``over`` (the end and sum of the last bin).
    """
    plan = plan.withColumn("floor", F.lit(-1.0)).withColumn("span", F.lit(2.0))
    for _ in range(REFINEMENTS):
        offered = _with_offer(sized.filter("size > 0").join(plan, "key"))
        usable = ~_chosen() & (F.col("size") <= F.col("limit"))
        at = F.floor((F.col("offer") - F.col("floor")) / F.col("span") * BINS)
        copies = F.floor("rate") + F.when(_chosen(), 1).otherwise(0)
        # Bin -1: taken in any case; BINS: not taken in this refinement.
        binned = offered.select("key", "target", F.explode(F.array(
            F.struct(F.lit(-1).cast("long").alias("bin"), (F.col("size") * copies).cast("double").alias("words")),
            F.struct(F.when(usable, F.greatest(F.lit(-1), F.least(F.lit(BINS), F.coalesce(at, F.lit(BINS)))))
                     .otherwise(F.lit(BINS)).cast("long").alias("bin"),
                     F.col("size").cast("double").alias("words")))).alias("x"))
        sums = binned.groupBy("key", "target", "x.bin").agg(F.sum("x.words").alias("words"))
        upto = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        # The bin that holds the target: the last one that begins at or below it.
        best = (sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0.0)))
                .filter(f"bin >= 0 and bin < {BINS} and before <= target")
                .groupBy("key").agg(F.max(F.struct("bin", "before", "words")).alias("b")))
        start = F.coalesce(F.col("floor") + F.col("b.bin") * F.col("span") / BINS, F.col("floor"))
        plan = stored(plan.join(best, "key", "left").select(
            *[c for c in plan.columns if c not in ("floor", "span", "missing", "over", name)], start.alias(name),
            F.coalesce(F.col("target") - F.col("b.before"), F.lit(0.0)).alias("missing"),
            F.coalesce(F.col("b.before") + F.col("b.words") - F.col("target"), F.lit(0.0)).alias("over"),
            start.alias("floor"), (F.col("span") / BINS).alias("span")), "mix")
    return plan


def cuts(sized: DataFrame, solved: DataFrame) -> DataFrame:
    """The plan: each source's cut, then what is still missing as the limit of a second cut among smaller documents."""
    plan = (solved.select("key", "source_size", "target", "mean", "tilt").withColumn("cut", F.lit(-1.0))
            .withColumn("limit", F.lit(float("inf"))).withColumn("small_cut", F.lit(-1.0)))
    first = _refined(sized, plan, "cut").withColumn("limit", F.col("missing"))
    second = _refined(sized, first, "small_cut")
    # The last bin is taken as well where that comes nearer to the target.
    end = F.when(F.col("over") < F.col("missing"), F.col("floor") + F.col("span")).otherwise(F.col("small_cut"))
    return stored(second.withColumn("small_cut", end).select(
        "key", "source_size", "target", "mean", "tilt", "cut", "limit", "small_cut"), "mix")


def plan_mix(sized: DataFrame) -> Mix:
    counts = stored(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    return Mix(cuts(sized, solve(counts, targets(counts))))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, rate, copies: a row for each document."""
    sized = stored(sizes(docs), "mix-sizes")
    return plan_mix(sized).apply(sized).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken", "rate", "copies")
