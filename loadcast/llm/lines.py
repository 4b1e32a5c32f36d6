"""Cross-site boilerplate: lines that many sites share are removed from every document.

The spread of a line is the number of distinct sites it is on. Each task sketches the sites of
its lines (HyperLogLog, one sketch per line hash) and the sketches merge by aggregation, so a
line on every page costs one small sketch per task. A line well below or above the threshold is
decided by its estimate; those near it get an exact distinct count. Then documents lose the
lines at or above the threshold. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.expressions import let, long, some_word
from loadcast.session import stage

MIN_SITES = 10
LG_K = 12
BROADCAST_ROWS = 100_000


def near_margin(min_sites: int, lg_k: int = LG_K) -> float:
    """How far an estimate may be off: four standard errors, and one site at least."""
    return max(1.0, 4 * 1.04 / 2 ** (lg_k / 2) * min_sites)


def boilerplate(docs: DataFrame, text_column: str, site_column: str, min_sites: int, lg_k: int = LG_K) -> DataFrame:
    """``line``, the hash of each line on ``min_sites`` sites or more. Lines without a word don't count."""
    lines = (
        docs.select(F.col(site_column).cast("string").alias("site"), F.explode(F.split(text_column, "\n")).alias("text"))
        .where(F.col("site").isNotNull() & some_word(F.col("text")))
        .select("site", F.xxhash64("text").alias("line"))
    )
    sketched = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    margin = near_margin(min_sites, lg_k)
    spread = stage(sketched.where(F.col("sites") >= min_sites - margin), "spread")
    sure = spread.where(F.col("sites") > min_sites + margin).select("line")
    near = spread.where(F.col("sites") <= min_sites + margin).select("line")
    if near.count() <= BROADCAST_ROWS:
        near = F.broadcast(near)
    exact = lines.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("sites"))
    return stage(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("line")), "boilerplate")


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    site_column: str = "source",
    min_sites: int = MIN_SITES,
    lg_k: int = LG_K,
) -> DataFrame:
    r"""The rows of ``docs`` with ``kept_text``, ``n_lines`` and ``n_removed`` added.

    Lines are separated by ``\n``; a line is known by the hash of its whole text, and removed
    from every document if it is on ``min_sites`` distinct sites or more. Lines without a word
    stay. A null text stays null and has no lines; an empty one has one line. A document of
    boilerplate only keeps an empty text. Rows without a site lose boilerplate but give no site
    of their own. Rows without an id and repeated rows are treated like others. Columns of
    ``docs`` named like an added one are replaced.
    """
    lines = boilerplate(docs, text_column, site_column, min_sites, lg_k)
    if lines.count() <= BROADCAST_ROWS:
        lines = F.broadcast(lines)
    added = ("kept_text", "n_lines", "n_removed")
    rest = [c for c in docs.columns if c not in added]
    # Names that no column of the table has.
    key, spot = (next(n for i in range(len(rest) + 1) if (n := f"_{name}{i}") not in rest) for name in ("key", "gone"))
    # Rows with the same text lose the same lines; with the id in it, copies stay apart.
    keyed = docs.select(*rest, F.xxhash64(id_column, text_column).alias(key))
    hits = (
        keyed.where(F.col(text_column).isNotNull())
        .select(key, F.posexplode(F.transform(F.split(text_column, "\n"), lambda x: F.xxhash64(x))).alias("place", "line"))
        .join(lines, "line", "left_semi")
        .groupBy(key)
        .agg(F.collect_set("place").alias(spot))
    )
    gone = F.coalesce(F.col(spot), F.array().cast("array<int>"))
    parts = F.split(F.col(text_column), "\n")
    kept = F.when(F.col(spot).isNull(), F.col(text_column)).otherwise(
        let(
            parts,
            lambda p: F.array_join(
                F.transform(
                    # Sets of places, not comparisons of each line with each: long texts stay linear.
                    F.array_except(F.sequence(F.lit(0), F.size(p) - 1), gone),
                    lambda i: F.get(p, i),
                ),
                "\n",
            ),
        )
    )
    return keyed.join(hits.hint("shuffle_hash"), key, "left").select(
        *rest,
        kept.alias("kept_text"),
        F.when(F.col(text_column).isNull(), long(0)).otherwise(F.size(parts).cast("long")).alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
    )
