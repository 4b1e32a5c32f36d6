"""Registered queries against their SQL, and the pipeline's stages against brute force."""

from __future__ import annotations

import random
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadcast.llm.oracles import ORACLES
from loadcast.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.skipif(not Path(TABLES).exists(), reason="test tables are not here")
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    same(QUERIES[name](spark, TABLES), db.sql(ORACLES[name]))


def same(got, want) -> None:
    """Equal rows under equal names, whatever the order."""
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    left = sorted(str([r[c] for c in columns]) for r in got.collect())
    right = sorted(str(list(r)) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert left == right


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Sources of very different size, ids that are missing or repeated with equal and other texts."""
    rng = random.Random(5)
    vocabulary = [f"Word{i}" for i in range(300)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = text(40)
    rows = []
    for source, n in (("big", 900), ("mid", 100), ("small", 30), ("few", 4), (None, 9), ("one", 1)):
        for _ in range(n):
            own = "\n".join([rng.choice(["All rights reserved", "Home | About"]), text(rng.randint(0, 12)), text(rng.randint(1, 60))])
            rows.append((len(rows), own, "en", source, 0))
    first = rows[0][1]
    rows += [(0, first, "en", "big", 0), (0, f"{first} {passage}", "en", "big", 0), (1, first + " more", "en", "mid", 0)]
    rows += [(None, f"{passage} {first}", "en", "few", 0), (None, None, "en", None, 0), (None, "", "en", "s12", 0), (None, first, None, "few", 0)]
    rows += [(5000 + i, f"Home | About\n{text(5)}", "en", f"s{i}", 0) for i in range(14)]
    folder = tmp_path_factory.mktemp("uneven")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumn("key", F.lit("clash")).withColumn("__key", F.lit(7)).withColumn("line", F.lit("x")).write.parquet(str(folder / "documents.parquet"))
    items = [(1, passage), (2, None), (3, " ".join(first.split()[-12:])), (3, "Word1 Word2"), (None, passage)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    vectors = [(i, [float(i % 7 - 3) / 8, *(rng.gauss(0, 0.2) for _ in range(15))], i % 3 or None) for i in range(200)]
    vectors += [(1000, None, 1), (1001, [float("nan")] * 16, 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(str(folder / "embeddings.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_on_uneven_tables(spark, uneven, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{uneven}/{table}.parquet/*.parquet'")
    same(QUERIES[name](spark, uneven), db.sql(ORACLES[name]))


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of sixteen sources with toxic ones, boilerplate, near copies and a benchmark passage."""
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(500)]

    def text(n: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = text(15)
    rows, labels, toxic, leaks, copies = [], [], set(), set(), {}
    for i in range(600):
        own = text(rng.randint(30, 90))
        if i % 4 == 0:
            words = own.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "scum", "rot"]))
            own = " ".join(words)
            toxic.add(i)
        elif i % 10 == 1:
            own = f"{own} {passage}"
            leaks.add(i)
        elif i > 300 and i % 10 == 3 and (i - 200) % 4 and (i - 200) % 10 != 1:
            own = rows[i - 200][1].split("\n")[1] + " changed"
            copies[i] = i - 200
        labels.append((i, int(i in toxic)))
        rows.append((i, f"Shared header of all sites\n{own}\n", "en", f"src{i % 16}", 0))
    rows.append((None, text(40), None, None, None))
    rows.append((601, None, "en", "src1", 0))
    folder = tmp_path_factory.mktemp("tables")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), rows, toxic, leaks, copies


def test_stages(spark, tables):
    folder, rows, toxic, leaks, copies = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = {r[0]: r[1] for r in rows}
    kept = set(texts)
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        before = kept
        docs = function(spark, docs, folder)
        out = docs.collect()
        kept = {r["doc_id"] for r in out}
        assert len(out) == len(kept) and kept <= before
        if i < 4:
            assert docs.columns == columns
        gone = before - kept
        if i == 0:
            assert len(gone & toxic) >= 0.97 * len(toxic)
            assert not gone - toxic, gone - toxic
        elif i == 1:
            assert not gone
            for r in out:
                if r["doc_id"] is not None and r["text"] is not None:
                    assert r["text"] == texts[r["doc_id"]].removeprefix("Shared header of all sites\n")
                    assert r["n_chars"] == len(r["text"])
            texts = {r["doc_id"]: r["text"] for r in out}
        elif i == 2:
            sets = {k: set(zip(*(WORD.findall(t or "")[d:] for d in range(5)), strict=False)) for k, t in texts.items() if k is not None}
            close = {
                b
                for a in sets
                for b in sets
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            }
            assert gone == close and close and close <= set(copies)
        elif i == 3:
            assert gone == leaks & before
        else:
            assert kept == before
            assert {"slot", "block", "in_block"} <= set(docs.columns)


def test_stages_judge_rows_with_repeated_and_missing_ids(spark, tables):
    folder, rows, _, leaks, _ = tables
    leak = rows[min(leaks)][1]
    own, other, third = (" ".join(f"{w}{i}" for i in range(40)) for w in "xyz")
    docs = [
        (1, own), (1, own), (1, own), (2, own + " more"), (None, own),
        (5, other), (5, leak), (None, leak), (None, third), (None, third), (7, third + " more"), (8, None), (8, None),
    ]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    clean = corpus_pipeline.drop_contaminated(spark, table, folder)
    assert clean.columns == table.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in clean.collect()))) == sorted(str(x) for x in docs if x[1] != leak)
    kept = corpus_pipeline.drop_near_copies(spark, table, folder)
    want = [(1, own), (5, other), (5, leak), (7, third + " more"), (8, None)]
    assert kept.columns == table.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, want))


def test_run_equals_the_stages_in_a_row(spark, tables):
    folder, rows, toxic, leaks, copies = tables
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    clean = {r[0] for r in rows} - toxic - leaks - set(copies)
    assert clean <= got and not got & leaks
    assert len(got & toxic) <= 0.03 * len(toxic)


def test_stages_of_an_empty_table_and_clashing_columns(spark, uneven):
    """Each stage keeps extra columns, whatever their names, and takes a table without rows."""
    docs = spark.read.parquet(f"{uneven}/documents.parquet").withColumn("_key0", F.lit("k")).withColumn("n", F.lit(2))
    labels = docs.select("doc_id", (F.col("doc_id") % 9 == 0).cast("int").alias("toxic"))
    labels.write.mode("overwrite").parquet(f"{uneven}/labels.parquet")
    for name, function in corpus_pipeline.STAGES:
        empty = function(spark, docs.limit(0), uneven)
        assert empty.count() == 0, name
        out = function(spark, docs, uneven)
        assert out.count() > 0
        if name != "mixing sources":
            assert empty.columns == out.columns == docs.columns
            assert {tuple(r) for r in out.select("_key0", "__key", "key", "n").distinct().collect()} == {("k", 7, "clash", 2)}
    source = spark.createDataFrame([(1, "a b", "de", "s"), (1, "a b", "en", "s"), (1, "a b", None, None)], "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.drop_near_copies(spark, source, uneven).collect()
    assert [tuple(r) for r in kept] == [(1, "a b", None, None)] or [tuple(r) for r in kept] == [(1, "a b", "de", "s")]
