"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.quality import words_of
from reachgrid.llm.ranges import running_totals
from reachgrid.llm.shared import store
from reachgrid.operators.rows import repeat_rows


def by_source() -> Column:
    """Sources by their code points, null last."""
    return F.col("source").asc_nulls_last()


def n_words(text: Column) -> Column:
    """Words between ASCII white space; none in a null text."""
    return F.coalesce(F.size(words_of(text)).cast("long"), F.lit(0).cast("long"))


def _queued(docs: DataFrame, key: str, source: str, size: Column) -> DataFrame:
    """``source, place, key, size, copies, words``: equal rows counted, ``place`` being
    where the shuffle puts them among the documents of their source."""
    rows = docs.select(
        F.col(source).alias("source"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("place"),
        F.col(key).alias("key"),
        size.cast("long").alias("size"),
    )
    counted = rows.groupBy("source", "place", "key", "size").agg(F.count("*").alias("copies"))
    return store(counted.withColumn("words", F.col("size") * F.col("copies")), "mix_documents")


def targets(
    sources: DataFrame, weights: Sequence[int] | DataFrame, share: float, most: int
) -> DataFrame:
    """``source, source_size`` with ``weight, target`` (words), ``start`` (words of the
    sources before it).

    All sources are served at once, each at the rate of its weight, until together
    they have given ``share`` of all words; a source that has given ``most`` times its
    words has no more, and the others go on. That is what sharing out the excess again
    by weight comes to. A source is used up if by the time that it is, all together
    have not given more than the budget.
    """
    numbered = running_totals(
        store(sources.withColumn("one", F.lit(1).cast("long")), "mix_sources"),
        [by_source()], ["one", "source_size"], "mix_source_order",
    ).withColumnsRenamed({"before_source_size": "start"})
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("__source"), F.col("weight").alias("__weight"))
        weighed = numbered.join(
            given, numbered["source"].eqNullSafe(given["__source"]), "left"
        ).withColumn("weight", F.coalesce(F.col("__weight").cast("long"), F.lit(0).cast("long")))
    else:
        cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
        weighed = numbered.withColumn(
            "weight", F.get(cycle, F.pmod("before_one", F.lit(len(weights))).cast("int"))
        )
    weighed = weighed.select(
        "source", "source_size", "start", "weight",
        F.when(F.col("weight") > 0, most * F.col("source_size"))
        .otherwise(F.lit(0).cast("long")).alias("cap"),
    )
    weighed = store(weighed.withColumn("used_up_at", F.try_divide("cap", "weight")), "mix_weights")
    total = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weights = share * (total[0] or 0), total[1] or 0
    level = running_totals(
        weighed, [F.col("used_up_at").asc_nulls_first(), by_source()], ["cap", "weight"], "mix_levels"
    )
    by_then = F.col("cap") * (F.lit(float(all_weights)) - F.col("before_weight"))
    level = level.withColumn(
        "used_up",
        (F.col("weight") == 0)
        | (by_then <= (F.lit(budget) - F.col("before_cap")) * F.col("weight")),
    )
    level = store(level.drop("before_cap", "before_weight", "used_up_at"), "mix_targets")
    rest = level.agg(
        F.sum(F.when(F.col("used_up"), F.col("cap"))), F.sum(F.when(~F.col("used_up"), F.col("weight")))
    ).first()
    left, rate = budget - (rest[0] or 0), rest[1] or 1
    open_target = F.col("weight") * F.lit(float(left)) / F.lit(float(rate))
    return level.withColumn(
        "target", F.when(F.col("used_up"), F.col("cap").cast("double")).otherwise(open_target)
    )


def queue(
    docs: DataFrame,
    weights: Sequence[int] | DataFrame,
    share: float,
    most: int,
    key: str,
    source: str,
    size: Column,
) -> DataFrame:
    """The mix in order: ``key, source, place, size, copies, words, source_size, target,
    pass, taken``, and ``before_taken``, the words of the mix before it.

    Each source queues its shuffled documents ``most`` times over. A document's
    virtual finish time is the number of words of its source up to its end, divided by
    the weight; the mix is all queues in the order of these times, up to the budget.
    The budget ends at one virtual time for all sources, that of their targets: what
    a queue has in service then is cut there.
    """
    entries = _queued(docs, key, source, size)
    sizes = entries.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, share, most).select(
        F.col("source").alias("__source"), "source_size", "start", "weight", "target"
    )
    placed = running_totals(
        entries, [by_source(), F.col("place"), F.col("key"), F.col("size")], ["words"], "mix_places"
    )
    met = placed.join(goal, placed["source"].eqNullSafe(goal["__source"])).drop("__source")
    passes = met.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
    before = F.col("pass") * F.col("source_size") + F.col("before_words") - F.col("start")
    served = F.floor("target") - F.col("before")
    timed = passes.withColumn("before", before).select(
        "key", "source", "place", "size", "copies", "source_size", "target", "pass",
        F.try_divide(F.col("before") + F.col("words"), F.col("weight")).alias("finish"),
        F.greatest(F.least(F.col("words"), served), F.lit(0).cast("long")).alias("taken"),
    )
    order = [
        F.col("finish").asc_nulls_last(), by_source(), F.col("pass"),
        F.col("place"), F.col("key"), F.col("size"),
    ]
    return running_totals(store(timed, "mix_times"), order, ["taken"], "mix_order")


def mix(
    docs: DataFrame,
    weights: Sequence[int] | DataFrame,
    share: float = 1.5,
    most: int = 2,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """A row per document: ``key, source, size`` (words), ``source_size, target`` (words
    its source should give), ``taken`` (words it gives itself, repeats counted) and
    ``position``, the words of the mix before it, null if it is not in it.

    ``weights`` is a table ``source, weight`` of whole numbers, the weight of a source
    that it leaves out being 0, or a list that goes round the sources in the order of
    their code points, null last. The mix holds ``share`` times the words of all
    documents, no document more than ``most`` times. It depends on the rows alone, not
    on how they are partitioned.

    A null text has no words, and like any document without words gives none; a null
    source is a source; null keys are one key, and stay apart by size and source only.
    Equal rows are counted before anything is ordered, and get rows of their own again
    at the end, the first ones being taken first. An empty table gives no rows; other
    columns are not read.
    """
    size = n_words(F.col(text)) if size is None else size
    rows = queue(docs, weights, share, most, key, source, size)
    given = F.struct("pass", "taken", F.col("before_taken").alias("position"))
    per_entry = rows.groupBy(
        "key", "source", "place", "size", "copies", "source_size", "target"
    ).agg(F.array_sort(F.collect_list(given)).alias("given"))
    single = repeat_rows(per_entry, "copies", "number")
    before = (F.col("number") - 1) * F.col("size")
    taken = F.aggregate(
        "given",
        F.lit(0).cast("long"),
        lambda total, g: total
        + F.greatest(F.least(F.col("size"), g["taken"] - before), F.lit(0).cast("long")),
    )
    first = F.get(F.filter("given", lambda g: g["taken"] > before), F.lit(0))
    return single.select(
        "key", "source", "size", "source_size", "target",
        taken.alias("taken"), (first["position"] + before).alias("position"),
    )
