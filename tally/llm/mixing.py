"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document gets the key -ln(u) / weight, where u comes from a hash of its id and text and the weight from its
quality; documents with the smallest keys are a weighted sample without replacement. A source's target is filled by
complete epochs first, then by its documents in order of key until the rest of the budget is met.

A source is never sorted as a whole. Keys fall into ranges, whose sums give the range in which the budget ends; only
that range's documents are put in order. What decides over a document is then its source's row in a small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.scratch import written

RANGES = 1024
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>!"


def plain_quality(text: Column) -> Column:
    """A weight from 0.1 to 1 that falls with the share of symbols among the characters."""
    text = F.coalesce(text, F.lit(""))
    share = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1), 1 - 5 * share)


def _order(id_column: str, text_column: str, weight: Column) -> list[Column]:
    """size, mark (a hash of id and text) and key of a document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    mark = F.xxhash64(F.col(id_column).cast("string"), text)
    u = (F.pmod(mark, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return [F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), mark.alias("mark"), (-F.log(u) / weight).alias("key")]


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in order of code points, null last, take the weights in turn. ``share`` times all sizes is divided by weight;
    no target is above ``most`` times its source's size, and the excess goes to the others by weight until none is.
    A source is at its bound if what the sources with smaller bounds per weight leave would lift it above. One row per
    source passes through one task here, whatever the number of documents.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.pmod(place, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    bound = F.col("source_size") * float(most)
    rows = sums.withColumn("w", weight).withColumn("bound", bound)
    everything = Window.partitionBy()
    by_bound = Window.orderBy(F.col("bound") / F.col("w"), "w", F.col("source").asc_nulls_last())
    earlier = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * float(share)
    left = budget - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0))
    level = left / F.sum("w").over(by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("budget", budget).withColumn("full", F.col("bound") <= level * F.col("w"))
    open_weight = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("bound"))).over(everything), F.lit(0.0))
    target = F.when(F.col("full"), F.col("bound")).otherwise((F.col("budget") - taken) / open_weight * F.col("w"))
    return rows.select("source", "source_size", target.alias("target"))


def source_cuts(sized: DataFrame, targets: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Per source: source, source_size, target, epochs, and ``cut``, the last document (key, mark) of the fraction.

    ``sized``: source, size, key, mark. The fraction ends with the document whose end is nearest to the budget.
    """
    per_source = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    per_source = written(per_source.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    ranged = sized.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("n"), F.max(F.struct("key", "mark")).alias("last"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = per_source.where("rest > 0").select(F.col("source").alias("s"), "rest")
    steps = sums.withColumn("before", before).join(rest, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = steps.where("before + n <= rest").groupBy("source").agg(F.max("last").alias("cut"))
    split = written(steps.where("before < rest and before + n > rest").select(F.col("source").alias("s"), F.col("range").alias("r"), "before", "rest"), "split-ranges")
    inside = ranged.join(split, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    end = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key", "mark"))
    near = inside.withColumn("end", end).where("end - size < rest and (end <= rest or end - rest < rest - (end - size))")
    cuts = whole.unionAll(near.groupBy("source").agg(F.max(F.struct("key", "mark")).alias("cut"))).groupBy("source").agg(F.max("cut").alias("cut"))
    cuts = cuts.withColumnRenamed("source", "s")
    table = per_source.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return written(table.select("source", "source_size", "target", "epochs", "cut"), "cuts")


def _times() -> Column:
    """How often a document is taken."""
    return F.col("epochs") + F.when(F.struct("key", "mark") <= F.col("cut"), 1).otherwise(0)


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    quality: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, size (words), source_size, target (its source's), taken (words, repeats counted).

    ``quality`` weighs the sample (above 0). Null and empty texts have size 0 and are taken with 0 words; null sources
    are one source, the last; rows alike in id and text have one key and stand or fall together at the cut; an empty
    table gives an empty one; further columns are left behind. Runs agree, as keys are hashes. The texts are read once;
    id, source, size and key are written to the shared folder.
    """
    weight = plain_quality(F.col(text_column)) if quality is None else quality
    columns = [F.col(id_column).alias("id"), F.col(source_column).alias("source"), *_order(id_column, text_column, weight)]
    sized = written(docs.select(*columns), "sized")
    cuts = source_cuts(sized, source_targets(sized, weights, share, most)).withColumnRenamed("source", "s")
    joined = sized.join(cuts, F.col("source").eqNullSafe(F.col("s")))
    return joined.select(F.col("id").alias(id_column), "size", "source_size", "target", (F.col("size") * _times()).alias("taken"))


def mixed_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    quality: Column | None = None,
) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: each document as often as it is taken.

    The decision is made where a document is read: its size and key against its source's row, so texts aren't shuffled.
    """
    weight = plain_quality(F.col(text_column)) if quality is None else quality
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own")
    keyed = docs.select(own, F.col(source_column).alias("source"), *_order(id_column, text_column, weight))
    sized = written(keyed.select("source", "size", "mark", "key"), "sized")
    cuts = source_cuts(sized, source_targets(sized, weights, share, most)).withColumnRenamed("source", "s")
    joined = keyed.join(cuts, F.col("source").eqNullSafe(F.col("s"))).select("own", _times().alias("times"))
    return joined.where("times > 0").select("own", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))).select("own.*")
