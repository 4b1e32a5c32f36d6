"""Operators on whole texts against brute force, with nulls, empty texts, ties and repeated rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadcast.llm.decontam import contamination
from loadcast.llm.jaccard import jaccard_components, list_entries
from loadcast.llm.phrases import _PLACE, _remove, covered_words, remove_repeats
from loadcast.llm.quality import quality
from loadcast.llm.words import alphanumeric, spaced, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, id long, key string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def corpus() -> list[tuple]:
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)] + ["É", "ß", "naïve", "Z."]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 160))) for _ in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = list(base)
    for t in base[:12]:
        w = t.split(" ")
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "edited"
            texts.append(" ".join(v))
    texts += base[:4] * 3
    texts += [f"{t[:200]} {passage} {t[200:]}" for t in base[20:30]]
    texts += ["a b c " * 60, "a b c " * 60, "same\tsame\n" * 45, passage, passage.upper(), "x", "x y", " \n\t "]
    texts += ["", None, "\x00 odd \x00", "a" * 5000]
    return [(i, t, -i, "clash") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3)


def test_words_of_a_batch():
    texts = ["one  two", None, "", "\tthree\x0bfour five ", "É É", "x\x00y"]
    for size in (1, 8, 1 << 20):
        got = []
        for part in split_words(pa.array(texts), spaced(False), slice_bytes=size):
            for i in range(part.count):
                a, b = part.bounds[i], part.bounds[i + 1]
                spans = zip(part.starts[a:b], part.ends[a:b], strict=True)
                got.append([bytes(part.data[x:y]).decode() for x, y in spans])
        assert got == [WORD.findall(t or "") for t in texts]
    part = next(split_words(pa.array(["Ab aB ab b", "ab"]), alphanumeric()))
    assert len(set(part.hashes[[0, 1, 2, 4]])) == 1 and part.hashes[3] != part.hashes[0]


def test_hashes_do_not_depend_on_the_place():
    texts = ["p q r s t", "zz p q r s t", "p q r"]
    parts = [next(split_words(pa.array([t]), spaced(False))).sequences(3)[1] for t in texts]
    together = next(split_words(pa.array(texts), spaced(False))).sequences(3)[1]
    assert np.array_equal(np.concatenate(parts), together)
    assert parts[0][0] == parts[1][1] == parts[2][0]


def test_jaccard_components(docs, corpus):
    for words, percent in ((4, 85), (5, 80)):
        sets = {}
        for i, t, *_ in corpus:
            w = WORD.findall((t or "").translate(LOWER))
            sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
        label = {i: i for i in sets}

        def root(i, label=label):
            while label[i] != i:
                i = label[i]
            return i

        for i, x in sets.items():
            for j, y in sets.items():
                if j < i and x and y and 100 * len(x & y) >= percent * len(x | y):
                    a, b = root(i), root(j)
                    label[max(a, b)] = min(a, b)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, words=words, percent=percent).collect()}
        assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_rows_without_id_repeats_and_empty(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "A B c d e"), (3, None), (4, ""), (None, "p q r s")]
    got = sorted(map(str, map(tuple, jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    want = [(1, 2, 1), (1, 2, 1), (None, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (None, 1, None)]
    assert got == sorted(map(str, want))
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_jaccard_rows_of_one_id_are_judged_apart(spark):
    """One id with two texts links with the copies of either, and joins nothing else."""
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(1, a), (1, b), (2, a), (3, b), (None, a + " more"), (0, a + " more"), (9, "x" * 1_200_000 + " y" * 300_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("size", F.lit(1))
    got = sorted(map(str, map(tuple, jaccard_components(table).collect())))
    want = [(1, 97, 0), (1, 97, 1), (2, 97, 0), (3, 97, 1), (None, 98, 0), (0, 98, 0), (9, 2, 9)]
    assert got == sorted(map(str, want))


def test_jaccard_lists_skip_only_what_cannot_link():
    """Every linked pair meets in a block of the list of its first common shingle."""
    rng = np.random.default_rng(3)
    skipped = 0
    for percent in (80, 85, 95):
        for _ in range(300):
            size = rng.integers(1, 60)
            x = np.sort(rng.choice(90, size=size, replace=False))
            y = np.sort(np.unique(np.concatenate([x[rng.random(size) > 0.06], rng.choice(90, size=rng.integers(1, 6))])))
            listed = []
            for v in (x, y):
                place, block = list_entries(len(v), 0, len(v), percent)
                listed.append({(int(v[p]), int(b)) for p, b in zip(place, block, strict=True)})
                skipped += 2 * len(set(place.tolist())) > len(place)
            common = len(np.intersect1d(x, y))
            if 100 * common >= percent * (len(x) + len(y) - common):
                first = int(np.intersect1d(x, y)[0])
                assert {b for s, b in listed[0] if s == first} & {b for s, b in listed[1] if s == first}
    assert skipped


def repeats(corpus, window):
    count, words = collections.Counter(), []
    for _, t, *_ in corpus:
        w = WORD.findall(t or "")
        words.append(w)
        count.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


@pytest.mark.parametrize("window", [8, 35])
def test_repeated_passages(docs, corpus, window):
    got = {r[0]: tuple(r)[1:] for r in remove_repeats(docs, window=window).collect()}
    assert [got[i] for i, *_ in corpus] == repeats(corpus, window)


def test_repeated_passages_without_ids_and_empty(spark):
    text = " ".join(f"v{i}" for i in range(40))
    rows = [(None, text), (5, text), (5, text + " tail"), (6, None)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.kept_text) for r in got) == [(0, 40, ""), (5, 40, ""), (5, 40, "tail"), (6, 0, "")]
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_automaton_finds_every_place():
    passage = [f"p{i}" for i in range(12)]
    texts = [" ".join(["lead", *passage]), " ".join([*passage, "mid", *passage, "end"]), "nothing here"]
    found = {i: gone.sum() for i, _, gone in covered_words(pa.array(texts), np.array([0]), np.array([1]), 12)}
    assert found == {0: 12, 1: 24, 2: 0}


def test_contamination(spark, docs, corpus):
    texts = {i: t for i, t, *_ in corpus}
    items = [(1, texts[2][:120]), (2, texts[60] or "q"), (10, "x y"), (3, None), (4, " .. "), (5, texts[2][:120])]
    items += [(6, " ".join((texts[25] or "").split()[5:17]).upper()), (None, "odd"), (7, "never there at all")]
    table = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = PLAIN.findall((t or "").translate(LOWER))
        for k in range(len(w) - 9) if len(w) >= 10 else ([0] if w else []):
            windows[tuple(w[k : k + 10])].add(i)
    got = {r[0]: tuple(r)[1:] for r in contamination(docs, table).collect()}
    sizes = {len(w) for w in windows}
    for i, t, *_ in corpus:
        w = PLAIN.findall((t or "").translate(LOWER))
        hit, owners = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    owners |= windows[tuple(w[k : k + n])]
        ids = sorted(str(x) for x in owners if x is not None)
        assert got[i] == (len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)), i
    assert sum(v[-1] for v in got.values()) > 5


def test_contamination_of_empty_tables(spark, docs, corpus):
    nothing = spark.createDataFrame([], "item_id long, text string")
    got = contamination(docs, nothing)
    assert got.where("contaminated").count() == 0 and got.count() == len(corpus)
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert contamination(docs.limit(0), items).count() == 0


def test_quality_measures(spark, docs, corpus):
    extra = [(1000, "one\none\n\n two\n two\n" + "#*$%&|<> " * 3, 0, ""), (None, "null id " * 30, 0, "")]
    both = docs.unionByName(spark.createDataFrame(extra, DOCS))
    trusted = spark.createDataFrame([(i,) for i in range(30)] + [(None,), (3,), (99999,)], "doc_id long")
    got = {r.doc_id: r for r in quality(both, trusted).collect()}
    for i, t, *_ in corpus + extra:
        t, r = t or "", got[i]
        w = WORD.findall(t)
        count = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        twice = {k + d for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(twice) > 50 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in t)
        want = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(twice), failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, i
        assert not (r.kept and r.base_failed)


def test_quality_ratio_prefers_the_target(spark):
    rng = random.Random(3)
    good, junk = [f"g{i}" for i in range(60)], [f"j{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else junk) for _ in range(80))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(1, 40, 2)], "doc_id long")
    got = quality(docs, trusted).collect()
    assert all(r.kept == (r.doc_id % 2 == 1) for r in got)
    assert all(math.isfinite(r.score) for r in got)
    assert quality(docs.limit(0), trusted).count() == 0
    assert quality(docs, trusted.limit(0)).where(F.abs("score") > 1e-6).count() == 0


def test_a_shard_of_many_chunks_and_bytes(spark, docs, corpus):
    """Every chunk of a shard's texts is read, and shards follow the bytes of the texts."""
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} own{i}" for i in range(6)]
    parts = [pa.array(texts[i : i + 2]) for i in (0, 2, 4)]
    packed = pa.chunked_array([pa.nulls(2, pa.binary())] * 3)
    keys, ids = (pa.chunked_array([pa.array([i, i + 1]) for i in (0, 2, 4)]) for _ in range(2))
    table = pa.table({"key": keys, "text": pa.chunked_array(parts), "id": ids, "packed": packed})
    told = np.array([(0, 0)], dtype=_PLACE)
    told = b"".join(told[name].tobytes() for name in told.dtype.names)
    extra = pa.table({"key": pa.nulls(1, pa.int64()), "text": pa.nulls(1, pa.string()), "id": pa.nulls(1, pa.int64()), "packed": pa.array([told])})
    out = _remove(35, False)(pa.concat_tables([table, extra])).to_pylist()
    assert [r["id"] for r in out] == list(range(6)) and out[0]["n_removed"] == 35
    small = sorted(map(tuple, remove_repeats(docs, window=8, shard_bytes=500).collect()), key=str)
    assert small == sorted(map(tuple, remove_repeats(docs, window=8).collect()), key=str)


def test_texts_of_more_than_a_slice(spark):
    """Texts of over a megabyte: nothing is cut off at a slice's end."""
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    passage = " ".join(f"q{i}" for i in range(40))
    rows = [(1, long), (2, f"{long} {passage}"), (3, passage), (4, f"{passage} {long[-300:]}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1:3] for r in remove_repeats(table).collect()}
    tail = len(long[-300:].split(" ")) - 1
    assert got[1] == (200_000, 200_000) and got[2] == (200_040, 200_040) and got[3] == (40, 40)
    assert got[4][0] == 41 + tail and got[4][1] in (40 + tail, 41 + tail, 40)
    items = spark.createDataFrame([(7, passage), (8, long[-60:].split(" ", 1)[1])], "item_id long, text string")
    hit = {r[0]: (r["n_items"], r["contaminated"]) for r in contamination(table, items).collect()}
    assert hit == {1: (1, True), 2: (2, True), 3: (1, True), 4: (2, True)}
    scored = {r[0]: r["n_words"] for r in quality(table, table.select("doc_id")).collect()}
    assert scored[1] == 200_000 and scored[2] == 200_040


def test_contamination_judges_each_row(spark):
    passage = " ".join(f"q{i}" for i in range(12))
    rows = [(1, f"x {passage} y"), (1, "clean words only"), (None, f"{passage} z"), (None, "clean"), (None, None), (2, passage), (2, passage)]
    items = spark.createDataFrame([(9, passage), (None, "lone words"), (10, None)], "item_id long, text string")
    got = contamination(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    want = [(1, 14, 12), (1, 3, 0), (None, 13, 12), (None, 1, 0), (None, 0, 0), (2, 12, 12), (2, 12, 12)]
    assert sorted(str((r[0], r["n_words"], r["n_hit"])) for r in got) == sorted(map(str, want))
    assert all(r["contaminated"] == (r["n_hit"] > 0) == (r["n_items"] == 1) for r in got)
