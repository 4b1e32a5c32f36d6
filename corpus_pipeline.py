"""A training corpus from raw documents: five stages, each one operator of ``loadcast.llm``.

Each stage takes the session, the documents its predecessor kept and the folder of tables, and
returns documents with the same columns; the last returns the order of the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.decontam import contamination
from loadcast.llm.jaccard import jaccard_components
from loadcast.llm.lines import line_dedup
from loadcast.llm.mixing import mix
from loadcast.llm.queries import table
from loadcast.llm.toxicity import without_toxic
from loadcast.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a digest of id and text under a name that no column has, and that name.

    Rows are judged by it: ids may be repeated or missing.
    """
    name = next(n for i in range(len(docs.columns) + 1) if (n := f"_key{i}") not in docs.columns)
    return docs.withColumn(name, F.xxhash64("doc_id", F.lit("/"), "text")), name


def _without(keyed: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ``keys``."""
    return keyed.join(keys.hint("shuffle_hash"), key, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity cut of their language; learnt from labelled ones.

    Null, empty and blank texts score 0 and stay. Each row is scored by its own text, so repeated
    rows stay or go together, also without an id. Extra columns pass through. An empty table
    gives an empty one.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many sources share; ``n_chars`` follows the text.

    Null texts stay null, a text of boilerplate only becomes empty; no row is dropped. A line on
    as many sources as the threshold goes. Repeated rows lose the same lines, rows without a
    source add none. Extra columns pass through. An empty table gives an empty one.
    """
    kept = line_dedup(docs)
    columns = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*(columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, and one of equal rows.

    Null, empty and blank texts are near nothing; of rows with equal id and text one stays, the
    first by its other columns as JSON. A row without an id comes after all others of its group,
    ties by digest. Rows of one id with other texts are judged apart. Extra columns pass through.
    An empty table gives an empty one.
    """
    keyed, key = _keyed(docs)
    groups = jaccard_components(keyed, id_column=key, words=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)
    rows = keyed.groupBy(key).agg(F.first("doc_id").alias("id"), F.count("*").alias("n"))
    judged = stage(rows.join(groups.select(key, "component_id").distinct(), key), "judged")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", key))
    best = judged.groupBy("component_id").agg(first.alias("best")).select(f"best.{key}")
    copies = judged.select(key).join(best, key, "left_anti")
    repeated = judged.where("n > 1").join(best, key, "left_semi").select(key)
    kept = _without(keyed, copies.unionByName(repeated), key)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    others = F.to_json(F.struct(*(c for c in docs.columns if c != "text")))
    whole = F.min_by(F.struct(*docs.columns), others).alias("whole")
    once = keyed.join(repeated, key, "left_semi").groupBy(key).agg(whole)
    return kept.select(*docs.columns).unionByName(once.select("whole.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item.

    Null, empty and wordless texts have no passage and stay. Each row is judged by its own text,
    also without an id or with a repeated one. Extra columns pass through. Without items all
    documents stay; an empty table gives an empty one.
    """
    keyed, key = _keyed(docs)
    found = contamination(keyed, table(spark, sf_dir, "benchmark"), id_column=key)
    return _without(keyed, found.where("contaminated").select(key).distinct(), key).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document in the mix of sources.

    Texts are not read. Documents without a source are a source of their own, those without an id
    come first in theirs; rows of one id and source follow each other. An empty table gives an
    empty result.
    """
    return mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

# A trained network has no SQL: tests check the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{i}")
    return docs
