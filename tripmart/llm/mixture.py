"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Documents of a source are taken as often as
target and size ask for: the whole copies that every document gets for certain are given
out first, and an unequal-probability sample makes up the rest, the quota. The chance of a
document to be in it is proportional to its number of words, so that of two documents the
one that does more for the quota is taken more often. Where that would be 1 or more, the
document is taken for certain, and the others share what is left of the quota; that goes by
size, from the largest down. In Pareto order sampling a document with inclusion probability p
and uniform random number u has the rank

    (u / (1 - u)) / (p / (1 - p))

and the documents of smallest rank are taken. The sample has a fixed size, here counted
in words: documents are taken in the order of their ranks up to the point where the words
taken come nearest to what is left of the quota.

That point is found without sorting a source. Ranks are cut into bins on a logarithmic
scale; the totals of the bins tell in which bin the point lies, that bin is cut into finer
ones, and only the documents of one fine bin are sorted. So a source may hold any share of
the rows. What is joined to the documents is one row per source: texts are not shuffled.
The random number is a hash of the document, so reruns agree.

Defined results: a document without text has size 0 and is never taken; NULL is a source
of its own, the last one; without any words all targets are 0. Rows repeated with the same
id and text share a rank and are taken together. Other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import as_rows, n_words, stored

# Fixed values of the contract.
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # 150 % of all words, as a fraction
MOST_COPIES = 2

SEED = "mixture"

# Bins: so many per doubling of the rank, and so many in one of those.
COARSE = 64
FINE = 4096
_HEX = 13  # digits of the hash that make the random number: 52 bits, as a double holds


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code point order have the weights in turn. They share ``share`` of all
    words by weight, and none gets more than ``most`` times its own; what is above goes to
    the others by weight. In the order of words per weight the sources that hit their
    limit come first, so the level for the others follows from running sums.

    The windows see one row per source. A mixture names its sources: they are few.
    """
    up, down = share
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), place % len(weights))
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * most)
    )
    in_order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = F.sum("limit").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    behind = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # Times ``down``, to stay with whole numbers.
    left = F.sum("source_size").over(everything) * up - F.coalesce(before, F.lit(0)) * down
    steps = named.select(
        "*",
        left.cast("double").alias("left"),
        (F.sum("weight").over(behind) * down).cast("double").alias("sharing"),
        F.row_number().over(in_order).alias("step"),
    ).withColumn("limited", F.col("limit") * F.col("sharing") <= F.col("weight") * F.col("left"))
    level = F.min(F.when(~F.col("limited"), F.struct("step", "left", "sharing"))).over(everything)
    shared = F.col("weight") * F.col("level.left") / F.col("level.sharing")
    return steps.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("level").isNull() | (F.col("step") < F.col("level.step")), F.col("limit"))
        .otherwise(shared)
        .cast("double")
        .alias("target"),
    )


def draw(*parts: Column, seed: str = SEED) -> Column:
    """A hash of the parts as hexadecimal digits, the same on every run."""
    known = (F.coalesce(part.cast("string"), F.lit("none")) for part in parts)
    return F.md5(F.concat_ws("|", F.lit(seed), *known))


def uniform(drawn: Column) -> Column:
    """A number between 0 and 1, neither included."""
    number = F.conv(F.substring(drawn, 1, _HEX), 16, 10).cast("long")
    return (number.cast("double") + 0.5) / float(16**_HEX)


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """Random odds divided by inclusion odds."""
    return (u / (1.0 - u)) / (inclusion / (1.0 - inclusion))


def _bins() -> tuple[Column, Column]:
    logs = F.log2("rank") * COARSE
    return F.floor(logs).cast("long"), F.floor((logs - F.floor(logs)) * FINE).cast("long")


def _reached(totals: DataFrame, bin_name: str, keep: Sequence[str]) -> DataFrame:
    """The bin of each source in which the running sum reaches the quota."""
    upto = Window.partitionBy("source").orderBy(bin_name)
    running = F.sum("words").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    return (
        totals.withColumn("end", F.col("below") + running)
        .withColumn("below", F.col("end") - F.col("words"))
        .filter((F.col("below") < F.col("quota")) & (F.col("end") >= F.col("quota")))
        .select("source", "quota", *keep, bin_name, "below")
    )


def pareto_cuts(ranked: DataFrame) -> DataFrame:
    """Where the sample of each source ends: source, coarse, fine, cut.

    ``ranked`` has source, size, rank, tie and quota. A row is in the sample if its bins
    come before (coarse, fine), or are these and (rank, tie) is not above ``cut``, which is
    NULL if no row of that bin is in. It is read three times, so it should be stored.
    """
    coarse, fine = _bins()
    rows = ranked.filter("quota > 0 and size > 0").select(
        "*", coarse.alias("coarse"), fine.alias("fine")
    )
    totals = rows.groupBy("source", "quota", "coarse").agg(F.sum("size").alias("words"))
    first = stored(_reached(totals.withColumn("below", F.lit(0)), "coarse", []), "mixture-cut")
    within = rows.join(
        first.select(F.col("source").alias("s"), F.col("coarse").alias("c"), "below"),
        rows["source"].eqNullSafe(F.col("s")) & (F.col("coarse") == F.col("c")),
    ).drop("s", "c")
    totals = within.groupBy("source", "quota", "coarse", "below", "fine").agg(
        F.sum("size").alias("words")
    )
    second = stored(_reached(totals, "fine", ["coarse"]), "mixture-cut")
    last = rows.join(
        second.select(
            F.col("source").alias("s"),
            F.col("coarse").alias("c"),
            F.col("fine").alias("f"),
            "below",
        ),
        rows["source"].eqNullSafe(F.col("s"))
        & (F.col("coarse") == F.col("c"))
        & (F.col("fine") == F.col("f")),
    )
    place = F.struct("rank", "tie")
    upto = Window.partitionBy("source").orderBy("rank", "tie")
    running = F.sum("words").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    # In, as long as that brings the sum nearer to the quota than leaving it out.
    nearer = F.col("end") - F.col("quota") <= F.col("quota") - (F.col("end") - F.col("words"))
    return (
        last.groupBy("source", "quota", "coarse", "fine", "below", "rank", "tie")
        .agg(F.sum("size").alias("words"))
        .withColumn("end", F.col("below") + running)
        .groupBy("source", "coarse", "fine")
        .agg(F.max(F.when(nearer, place)).alias("cut"))
    )


def inclusion_levels(sized: DataFrame, quotas: DataFrame) -> DataFrame:
    """How the sizes of a source make inclusion probabilities: source, level, scale, rest.

    Documents above ``level`` words are in for certain; one of n words up to it is in with the
    probability n times ``scale``, and these make up ``rest`` words of the quota on average.
    ``quotas`` has source and quota. A source goes through a window by its distinct sizes, of
    which there are no more than words in its longest document.
    """
    quotas = quotas.filter("quota > 0").select(F.col("source").alias("s"), "quota")
    sizes = sized.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(quotas, sizes["source"].eqNullSafe(quotas["s"]))
    size, n = F.col("size").cast("decimal(19,0)"), F.col("n").cast("decimal(19,0)")
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    larger = F.sum(F.col("size") * F.col("n")).over(down.rowsBetween(Window.unboundedPreceding, -1))
    squares = F.sum((size * size).cast("decimal(38,0)") * n).over(
        down.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    steps = (
        sizes.withColumn("squares", squares.cast("double"))
        .withColumn("rest", F.col("quota") - F.coalesce(larger, F.lit(0)).cast("double"))
        .filter(F.col("rest") * F.col("size") < F.col("squares"))
    )
    return (
        steps.groupBy("source")
        .agg(F.max(F.struct("size", "rest", "squares")).alias("first"))
        .select(
            "source",
            F.col("first.size").alias("level"),
            (F.col("first.rest") / F.col("first.squares")).alias("scale"),
            F.col("first.rest").alias("rest"),
        )
    )


def mixture_plan(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """One row per source: source, source_size, target, whole, quota, level, scale, rest, coarse,
    fine, cut."""
    sized = stored(
        documents.select(F.col("source").cast("string").alias("source"), *_measures()),
        "mixture-sizes",
    )
    targets = stored(source_targets(sized, weights, share, most), "mixture-targets")
    whole = F.floor(F.col("target") / F.col("source_size"))
    per_source = targets.select(
        "*", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("int").alias("whole")
    ).withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
    levels = inclusion_levels(sized, per_source).withColumnRenamed("source", "v")
    levels = stored(levels, "mixture-levels")
    per_source = per_source.join(
        levels, per_source["source"].eqNullSafe(levels["v"]), "left"
    ).drop("v")
    per_source = stored(per_source, "mixture-sources")
    renamed = per_source.withColumnRenamed("source", "s")
    drawn = sized.join(renamed, sized["source"].eqNullSafe(renamed["s"])).filter("size > 0 and size <= level and scale > 0")
    ranked = stored(
        drawn.select(
            "source", "size", "tie", F.col("rest").alias("quota"),
            pareto_rank(F.col("u"), F.col("scale") * F.col("size")).alias("rank"),
        ),
        "mixture-ranks",
    )
    cuts = pareto_cuts(ranked).withColumnRenamed("source", "c")
    plan = per_source.join(cuts, per_source["source"].eqNullSafe(cuts["c"]), "left").drop("c")
    return stored(plan, "mixture-plan")


def _measures() -> list[Column]:
    drawn = draw(F.col("doc_id"), F.md5(F.coalesce("text", F.lit(""))))
    return [n_words(F.col("text")).alias("size"), drawn.alias("tie"), uniform(drawn).alias("u")]


def with_copies(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document as ``row``, with size, source_size, target and copies."""
    plan = plan.select(
        F.col("source").alias("named"),
        F.struct(*(F.col(c) for c in plan.columns if c != "source")).alias("plan"),
    )
    measured = documents.select(
        as_rows(documents), F.col("source").cast("string").alias("source"), *_measures()
    )
    # Without words there is no chance to be in, and above the level no chance to be left out.
    drawn = (F.col("size") > 0) & (F.col("size") <= F.col("plan.level")) & (F.col("plan.scale") > 0)
    inclusion = F.when(drawn, F.col("plan.scale") * F.col("size"))
    rank = pareto_rank(F.col("u"), inclusion)
    same = F.col("source").eqNullSafe(F.col("named"))
    placed = measured.join(plan, same).withColumn("rank", rank)
    coarse, fine = _bins()
    place, last = F.struct(coarse, fine), F.struct("plan.coarse", "plan.fine")
    sampled = (place < last) | ((place == last) & (F.struct("rank", "tie") <= F.col("plan.cut")))
    # A quota above zero has a level, unless every document is in for certain.
    certain = (F.col("plan.quota") > 0) & (F.col("size") > F.coalesce("plan.level", F.lit(0)))
    more = certain | (
        (F.col("plan.quota") > 0)
        & (F.col("size") <= F.col("plan.level"))
        & F.coalesce(sampled, F.lit(False))
    )
    more = F.coalesce(more, F.lit(False))
    return placed.select(
        "row",
        "size",
        "plan.source_size",
        "plan.target",
        (F.col("plan.whole") + more.cast("int")).alias("copies"),
    )


def mix(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    marked = with_copies(documents, mixture_plan(documents, **settings))
    taken = marked.filter("size > 0 and copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
