"""Mix sources to target weights by capped water-filling (DataFrame functions only).

The words of all documents times ``share`` are dealt to the sources by weight. A source is clamped at
``epochs`` times its size and what it can't take goes to the others by weight, until none is above.
Each source then takes its target: whole repetitions of all its documents, and of a seeded order of its
documents as many words as are left. The document at which that order is cut takes part of its words, so
a source misses its target by less than one word.

Defined results: null text has size 0; null source is a source of its own, last in order; sources of size
0 have target 0; rows with null or repeated ids are rows like others (among rows equal in id and text it is
open which one takes the rest); an empty table gives an empty result. Other columns play no part.

One row per source travels between rounds, the driver sees three sums per round. Hot sources are spread by
the leading bits of the seeded order, so no window holds a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import SPACE_RUN, packed, ranked, text_key, unpacked, word_count
from gaugeflow.session import stage

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
EPOCHS = 2
SEED = "mix-1"
BUCKET_DIGITS = 4
BIG = "decimal(38,0)"


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """(source, source_size, target) of (source, size) rows; weights repeat over the sources in code point order."""
    if share[0] > epochs * share[1]:
        raise ValueError("the sources can't fill that share within the allowed epochs")
    totals = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    table = ranked(totals, [F.col("source").asc_nulls_last()], "_rank", "mix-sources").select(
        "source", "source_size", F.element_at(cycle, (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int")).alias("weight")
    )
    table = stage(table, "mix-weights")
    size, weight = F.col("source_size").cast(BIG), F.col("weight").cast(BIG)

    def above(level: tuple[int, int] | None) -> Column:
        """Does weight * num / (den * weights) exceed the cap? Compared in whole numbers."""
        if level is None:
            return F.lit(False)
        num, den = level
        return weight * F.lit(num).cast(BIG) > size * F.lit(den * epochs).cast(BIG)

    level: tuple[int, int] | None = None
    while True:
        clamped = above(level)
        row = table.agg(
            F.sum(size).alias("all"),
            F.sum(F.when(clamped, size)).alias("full"),
            F.sum(F.when(~clamped, weight)).alias("open"),
        ).first()
        open_weight = int(row["open"] or 0)
        if not open_weight:
            break
        num = share[0] * int(row["all"]) - share[1] * epochs * int(row["full"] or 0)
        new = (num, share[1] * open_weight)
        if new == level:
            break
        level = new
    clamped = above(level)
    filled = weight.cast("double") * F.lit(float(level[0])) / F.lit(float(level[1])) if level else F.lit(0.0)
    return table.select(
        "source",
        "source_size",
        F.when(clamped, F.col("source_size").cast("double") * epochs).otherwise(filled).alias("target"),
    )


def mix(docs: DataFrame, seed: str = SEED, **rules) -> DataFrame:
    """(doc_id, text_key, source, size, source_size, target, taken), one row per document."""
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        text_key(F.col("text")).alias("text_key"),
        order.alias("_order"),
    )
    sized = stage(sized, "mix-sizes").withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    goal = targets(sized, **rules)
    per_bucket = sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    words_in = F.floor(F.col("target") + 0.5).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(words_in / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0).cast("bigint")
    starts = per_bucket.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    starts = starts.join(goal.withColumnRenamed("source", "_g"), F.col("source").eqNullSafe(F.col("_g"))).select(
        F.col("source").alias("_s"),
        F.col("_bucket").alias("_b"),
        "_start",
        "source_size",
        "target",
        whole.alias("_whole"),
        (words_in - whole * F.col("source_size")).alias("_rest"),
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id", "text_key")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sized.withColumn("_before", before)
    left = F.col("_rest") - F.col("_start") - F.col("_before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))).select(
        "doc_id",
        "text_key",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("_whole") * F.col("size") + part).cast("bigint").alias("taken"),
    )


def apply_mix(docs: DataFrame, **rules) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, in the columns of ``docs``.

    A document taken in part comes with that many of its first words, joined by blanks. ``n_chars``, if
    there, is brought up to date. Rows equal in id and text share what the mix takes from them.
    """
    taken = mix(docs, **rules).groupBy("doc_id", "text_key", "size").agg(
        F.floor(F.sum("taken") / F.count(F.lit(1))).cast("bigint").alias("_taken")
    )
    taken = taken.select(F.col("doc_id").alias("mix_id"), F.col("text_key").alias("mix_key"), "size", "_taken")
    rows = packed(docs, "doc_id").withColumn("key", text_key(F.col("text"))).join(
        taken.filter("_taken > 0"), F.col("doc_id").eqNullSafe(F.col("mix_id")) & (F.col("key") == F.col("mix_key"))
    )
    size = F.greatest(F.col("size"), F.lit(1))
    whole = F.floor(F.col("_taken") / size).cast("int")
    rest = (F.col("_taken") % size).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.filter(F.array(rest), lambda r: r > 0))
    out = rows.withColumn("cut", F.explode(copies))
    first = F.array_join(F.slice(F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), SPACE_RUN), 1, F.col("cut")), " ")
    out = out.withColumn("text", F.when(F.col("cut") > 0, first).otherwise(F.col("text")))
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("cut") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
    return out.select(*unpacked(out, docs, **changed))
