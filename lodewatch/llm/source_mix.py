"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share, by weight, of `budget` times all words; no target passes `most_copies` times
the source's own words, and what is cut off there is shared again by weight until no target is above its limit.
The fixed point has a closed form: with sources in the order of limit by weight, the first ones are limited and
the rest get weight times one common level; running sums over one row per source find where the change is.

A target of f times the source's words gives every document floor(f) certain copies. The rest is a fixed-size
sample without replacement: each document draws u from a hash of its id and is ranked by the odds of u divided
by the odds of its inclusion; documents are taken in that order until the words that are left are filled, the
document at the border if at least half of it still fits. Inclusion odds are those of the source's fraction,
times the document's own tilt: n / (n + `fragment`) for n words, so that fragments come later.

A source may hold a third of all rows, so ranks are not made by a window over the source: the rank value is cut
into `bins` bins, words are added up by (source, bin), one running sum over at most `bins` rows per source finds
the bin in which the border lies, and only the rows of that bin are put into order; a bin that is still large is
cut again by the same rule, with finer bins, `levels` times.

Results by case: null text has size 0 and takes nothing; null source is a source of its own, last in the order;
rows with equal rank go by id (null last), and fully equal rows are alike; a source without words has target 0; an
empty table gives an empty frame. The draw depends on id (where it is null: on the text's digest) and seed only, so a
rerun takes the same documents. `take_copies` carries each row through the mix, so that rows that share an id, or have
none, are taken as often as the mix says of each; further columns come along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.llm.text import n_words
from lodewatch.session import stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_COPIES = 2
FRAGMENT = 50
BINS = 1024
LEVELS = 3  # bins within bins: 1024^3 classes of rank before rows are put into order
SEED = "pareto"


def _draw(identity: Column, seed: str) -> Column:
    """Uniform in (0, 1) from 52 bits of a digest."""
    text = F.concat(F.lit(seed + ":"), identity)
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target, whole, fraction) from one row (source, source_size) per source."""
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.get(cycle, ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * float(most))
    by_limit = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * float(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = weighed.withColumn("level", level).withColumn("place", F.row_number().over(by_limit))
    first_free = F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct("place", "level"))).over(everything)
    shared = levelled.withColumn("common", first_free["level"])
    target = F.when(F.col("common").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("common")))
    copies = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    return (
        shared.withColumn("target", target)
        .withColumn("whole", F.floor(copies))
        .withColumn("fraction", copies - F.floor(copies))
        .select("source", "source_size", "target", "whole", "fraction")
    )


def _border(rows: DataFrame, bin_of: Column, left: str) -> tuple[DataFrame, DataFrame]:
    """Per source the bin that the border of `left` words lies in, with the words before it.

    A source whose every bin fits gets no row: all its rows are before the border.
    """
    binned = rows.withColumn("bin", bin_of)
    words = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first(left).alias("left"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = words.withColumn("through", F.sum("words").over(upto))
    past = run.where("through > left").groupBy("source").agg(F.min(F.struct("bin", (F.col("through") - F.col("words")).alias("before"))).alias("b"))
    return binned, past.select(F.col("source").alias("border_source"), F.col("b.bin").alias("border_bin"), F.col("b.before").alias("before"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST_COPIES,
        fragment: int = FRAGMENT, bins: int = BINS, levels: int = LEVELS, seed: str = SEED, carry: bool = False) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken (size times copies).

    With `carry` there is the document itself as well, as the struct `row`.
    """
    text = F.col(f"`{text_col}`").cast("string")
    drawn = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
            n_words(text).alias("size"), _draw(drawn, seed).alias("u"), *whole,
        ),
        "mix-sizes",
    )
    shares = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most), "mix-targets")
    joined = rows.join(shares.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    odds = F.col("u") / (1.0 - F.col("u")) / (F.col("fraction") / (1.0 - F.col("fraction")) * (F.col("size") / (F.col("size") + float(fragment))))
    ranked = joined.withColumn("odds", F.when((F.col("fraction") > 0) & (F.col("size") > 0), odds))
    out = ["id", "source", "size", "source_size", "target", *["row"] * carry]
    untouched = ranked.where("odds is null").select(*out, F.col("whole").cast("bigint").alias("copies"))
    sampled = ranked.where("odds is not null").withColumn("rank", F.col("odds") / (1.0 + F.col("odds")))
    sampled = sampled.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    taken = []
    for _ in range(levels):
        # scale the rank to [0, bins): the integer part is the bin, the rest is the rank within the bin
        scaled = F.col("rank") * float(bins)
        binned, border = _border(sampled, F.least(F.floor(scaled), F.lit(bins - 1)), "left")
        border = stored(border, "mix-border")
        known = binned.join(border, F.col("source").eqNullSafe(F.col("border_source")), "left").drop("border_source")
        inside = F.col("bin") < F.coalesce(F.col("border_bin"), F.lit(bins))
        taken.append(known.where(F.col("bin") != F.coalesce(F.col("border_bin"), F.lit(-1))).select(*out, (F.col("whole") + inside.cast("bigint")).alias("copies")))
        sampled = known.where("bin = border_bin").withColumn("left", F.col("left") - F.col("before")).withColumn("rank", scaled - F.col("bin"))
        sampled = stored(sampled.drop("bin", "border_bin", "before"), "mix-bin")
    order = Window.partitionBy("source").orderBy("odds", F.col("id").asc_nulls_last(), "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = sampled.withColumn("fits", (before + F.col("size") / 2.0 <= F.col("left")).cast("bigint"))
    taken.append(last.select(*out, (F.col("whole") + F.col("fits")).alias("copies")))
    result = untouched
    for part in taken:
        result = result.unionByName(part)
    return result.withColumn("taken", F.col("size") * F.col("copies"))


def take_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents: every document as often as the mix takes it, with all its columns."""
    taken = mix(docs, id_col, text_col, source_col, carry=True, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
