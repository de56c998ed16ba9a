"""Remove lines spread over many sites (DataFrame functions only).

Per line (two 64-bit hashes of the trimmed text) a HyperLogLog sketch of its sites is built where the line is
read and merged by aggregation. Lines whose estimate is clearly above or below ``min_sites`` are decided by it;
those within ``margin`` of it get an exact distinct count. Of a boilerplate line the first occurrence, in order
of document id, stays in the corpus, all others are removed, within a document too.

Defined results: null text stays null; lines without a word are kept; a null site counts as one site; null ids
come first; rows equal in id and text count as one document and keep or lose the same lines; a document may
end up with empty text but no row is dropped; an empty table gives an empty result; other columns pass through.

A line held by a third of all documents reaches the shuffle as one sketch per task. Only occurrences of
suspected lines are joined and staged; whole texts are shuffled once, when their lines are cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import SPACES, packed, text_key, unpacked
from gaugeflow.operators.skew import salted_lookup
from gaugeflow.session import stage

MIN_SITES = 6
LOG_REGISTERS = 11
MARGIN = 0.15  # over six standard errors of 2^11 registers


def occurrences(docs: DataFrame, site: str = "source") -> DataFrame:
    """One row per line with a word: id and key of the document, position, both hashes, site."""
    lines = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.col(site).alias("site"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = F.btrim("line", F.lit(SPACES))
    return lines.select("doc_id", "key", "site", "pos", line.alias("line")).filter("line != ''").select(
        "doc_id", "key", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")
    )


def spread(found: DataFrame) -> DataFrame:
    """(h1, h2, sites): the sketch's estimate of the number of sites of each line."""
    site = F.xxhash64(F.col("site"), F.col("site").isNull())
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg(site, F.lit(LOG_REGISTERS)))
    return found.groupBy("h1", "h2").agg(sketch.alias("sites"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, site: str = "source") -> DataFrame:
    """Occurrences to remove: (doc_id, key, pos), staged by the exact and estimated counts of their lines."""
    found = occurrences(docs, site)
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    suspects = spread(found).filter(F.col("sites") >= low)
    held = salted_lookup(found, suspects, ["h1", "h2"], spread=F.struct("doc_id", "pos"), how="inner")
    held = stage(held, "line-suspects")
    near = held.filter(F.col("sites") <= high).groupBy("h1", "h2", "site").agg(F.count(F.lit(1)).alias("n"))
    exact = near.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("exact"))
    first = held.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "key", "pos")).alias("first"))
    lines = first.join(exact.select(F.col("h1").alias("a"), F.col("h2").alias("b"), "exact"), (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left")
    lines = lines.select("h1", "h2", "first", "exact")
    marked = salted_lookup(held, lines, ["h1", "h2"], spread=F.struct("doc_id", "pos"), how="inner")
    widely = F.when(F.col("sites") > high, F.lit(True)).otherwise(F.col("exact") >= min_sites)
    return marked.filter(widely & ~F.struct("doc_id", "key", "pos").eqNullSafe(F.col("first"))).select("doc_id", "key", "pos")


def dedup_lines(docs: DataFrame, **rules) -> DataFrame:
    """``docs`` with cross-site boilerplate lines cut out, and ``_removed``, the number of lines cut.

    Where the input has a column ``_removed`` of its own, that one stays and the number is left out.
    """
    cut = boilerplate(docs, **rules).groupBy("doc_id", "key").agg(F.collect_set("pos").alias("cut"))
    cut = cut.select(F.col("doc_id").alias("cut_id"), F.col("key").alias("cut_key"), "cut")
    rows = packed(docs, "doc_id").withColumn("lines", F.split("text", "\n")).withColumn("key", text_key(F.col("text")))
    joined = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("key") == F.col("cut_key")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("cut"))
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    is_cut = F.col("cut").isNotNull()
    out = joined.withColumn("text", F.when(is_cut, left).otherwise(F.col("text")))
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(is_cut, F.length("text")).otherwise(F.col("row.n_chars"))
    removed = [] if "_removed" in docs.columns else [F.coalesce(F.size("cut"), F.lit(0)).alias("_removed")]
    return out.select(*unpacked(out, docs, **changed), *removed)
