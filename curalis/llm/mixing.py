"""Mixing sources to target weights with a time-varying curriculum (DataFrame functions only).

A source's schedule is a density over training time t in [0, 1]: its target times
``1 + tilt * (1 - 2t)`` (tilt > 0: early, < 0: late).  Integrated, it gives the words the mix has
demanded of the source up to t; inverted at a document's offset in its source, it gives the
document's training position.  Rows are range-sorted by position.

Targets: sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` of
all words; a target stops at ``epochs`` times its source's size and the excess is reshared by
weight until none is above.  A source is read in the order of a hash of its ids, from the start
again when its words are used up; the last document taken may be taken in part.

Sums over an order (ranks of sources, offsets of slices) are running sums of ranges: rows are dealt to ranges
of the order, and only the ranges' totals meet in one task.

Null texts and texts without words have size 0, are taken 0 times and have no position.  Rows are ordered
within a source by a hash of id and text (then by id), so rows without an id are spread as well; repeated
rows count each.  Sources with equal stops are resolved in their order.  Texts of any length are counted
whole.  An empty table gives an empty result.  Added columns replace their namesakes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from curalis.llm._store import materialise, partitions

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
EPOCHS = 2
TILTS = (0.5, 0.0, -0.5)
#: Documents of a source are numbered within slices of about this many rows, and slices by their sums.
SLICE_ROWS = 4_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name, the sum of its values over all rows that come before in ``order``."""
    n = partitions(df.sparkSession)
    ranges = materialise(df.withColumns({f"v_{k}": v.cast("long") for k, v in sums.items()}).repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "ranges")
    to_here = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    within, ahead = to_here(W.partitionBy("range").orderBy(*order)), to_here(W.orderBy("range"))
    # One row for each range, of which there are as many as shuffle partitions.
    totals = ranges.groupBy("range").agg(*(F.sum(f"v_{k}").alias(f"t_{k}") for k in sums))
    totals = totals.select("range", *(F.coalesce(F.sum(f"t_{k}").over(ahead), F.lit(0)).alias(f"t_{k}") for k in sums))
    placed = ranges.withColumns({f"v_{k}": F.coalesce(F.sum(f"v_{k}").over(within), F.lit(0)) for k in sums}).join(F.broadcast(totals), "range")
    return placed.withColumns({k: F.col(f"v_{k}") + F.col(f"t_{k}") for k in sums}).drop("range", *(f"{x}_{k}" for k in sums for x in "vt"))


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """``source, source_size, place, source_at, target`` from ``source, source_size``; ``source_at`` sums the sizes
    of the sources before.  The level at which targets stop is found in one pass over the sources by size per
    weight, in whole numbers until the last division."""
    num, den = share
    cycle = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    ranked = running(sizes, [F.col("source").isNull(), F.col("source")], {"place": F.lit(1), "source_at": F.col("source_size")})
    ranked = ranked.withColumn("weight", F.get(cycle, F.col("place") % len(weights)))
    # A source is above when the level times its weight passes its stop; stops are passed in this order.
    stop = F.col("source_size") / F.col("weight")
    ranked = materialise(running(ranked, [stop, F.col("place")], {"stopped": F.col("source_size"), "closed_weight": F.col("weight")}), "stops")
    total, all_weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left = F.lit(total * num).cast("long") - F.col("stopped") * (epochs * den)  # times den
    ranked = ranked.withColumns({"left": left, "open_weight": F.lit(all_weight).cast("long") - F.col("closed_weight")})
    above = F.col("left") * F.col("weight") > F.col("source_size") * F.col("open_weight") * (epochs * den)
    level = ranked.where(~above).agg(F.min_by(F.struct("left", "open_weight"), F.struct(stop, F.col("place")))).first()[0]
    most = (F.col("source_size") * epochs).cast("double")
    shared = F.col("weight") * F.lit(level[0]).cast("long") / F.lit(float(level[1] * den)) if level else most
    return ranked.select("source", "source_size", "place", "source_at", F.when(above, most).otherwise(shared).alias("target"))


ADDED = ["size", "source_size", "target", "taken", "copies"]


def _mixed(docs: DataFrame, keep: list[str], id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, epochs=EPOCHS, tilts=TILTS, seed=7) -> DataFrame:
    """``k_<kept columns>``, ``h`` (the hash that orders a source) and the added columns of every row."""
    own = docs.select(
        *(F.col(f"`{c}`").alias(f"k_{c}") for c in keep),
        F.col(source_col).alias("source"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit(seed)).alias("h"),
        F.col(id_col).cast("string").alias("tie"),
        n_words(text_col).alias("size"),
    )
    own = materialise(own, "sizes")
    sized = own.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # Sources are few beside documents; their table is aggregated before it is ordered.
    goal = targets(sized.select("source", "source_size"), weights, share, epochs).join(sized.select(F.col("source").alias("s2"), "rows"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    goal = materialise(goal, "targets")
    # Slices of a source: ranges of the hash, as many as its rows need, so a hot source is many slices.
    n_slices = F.ceil(F.col("rows") / SLICE_ROWS).cast("long")
    joined = own.join(goal.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    joined = joined.withColumn("slice", F.floor(F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63)) * n_slices).cast("long"))
    sums = joined.groupBy("place", "slice").agg(F.sum("size").alias("slice_size"))
    sums = running(sums, [F.col("place"), F.col("slice")], {"slice_at": F.col("slice_size")}).select("place", "slice", "slice_at")
    within = W.partitionBy("place", "slice").orderBy("h", "tie", "size").rowsBetween(W.unboundedPreceding, -1)
    at = joined.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["place", "slice"])
    start = F.col("slice_at") - F.col("source_at") + F.col("at")
    tilt = F.get(F.array(*(F.lit(float(t)) for t in tilts)), F.col("place") % len(tilts))
    wanted = F.round("target").cast("long")

    def copy(k: int) -> Column:
        offset = start + F.col("source_size") * k
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), wanted - offset))
        y = F.least(F.lit(1.0), offset / F.col("target"))
        # The integral of the schedule up to t is target * ((1 + g) t - g t^2); its inverse at y * target:
        t = F.when(tilt == 0, y).otherwise(2 * y / ((1 + tilt) + F.sqrt(F.greatest(F.lit(0.0), (1 + tilt) * (1 + tilt) - 4 * tilt * y))))
        return F.when(words > 0, F.struct(t.alias("position"), words.alias("words")))

    out = at.withColumn("copies", F.array_compact(F.array(*(copy(k) for k in range(int(epochs))))))
    return out.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda acc, c: acc + c["words"]))


def curriculum(docs: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    """``keep`` columns (default: all) of every row with ``size, source_size, target, taken`` and
    ``copies``, one ``(position, words)`` for each time the mix takes the document, range-sorted by the
    first position (documents not taken first).  ``options``: those of ``_mixed``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    # The hash spreads the documents that have no position over many ranges.
    placed = _mixed(docs, keep, **options).orderBy(F.get("copies", F.lit(0))["position"], "h")
    return placed.select(*(F.col(f"`k_{c}`").alias(c) for c in keep), *ADDED)


def training_order(docs: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    """The mix itself: one row for each time a document is taken, range-sorted by its training ``position``, with
    the ``words`` to read then (the last copy of a source may be read in part) and ``size, source_size, target,
    taken``.  What the mix does not take is not in it."""
    added = [*ADDED[:-1], "position", "words"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    each = _mixed(docs, keep, **options).withColumn("copy", F.explode("copies"))
    each = each.withColumns({"position": F.col("copy.position"), "words": F.col("copy.words")}).orderBy("position", "h")
    return each.select(*(F.col(f"`k_{c}`").alias(c) for c in keep), *added)


def op3(spark, sf_dir):
    """The columns asked for, and the document's training positions (one for each time it is taken)."""
    mixed = curriculum(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.transform("copies", lambda c: c["position"]).alias("positions"))
