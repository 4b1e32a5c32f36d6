"""The vector operators and the fingerprints against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loadcast.llm.codes import Orchard, vector_codes
from loadcast.llm.simhash import BITS, cell_pairs, fingerprint_links, offsets, simhash_components
from loadcast.llm.whitening import fit_whitening, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors():
    """Correlated vectors of 16 entries with repeated ones, and rows that no operator can use."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 16)) * np.linspace(0.05, 1.5, 16) @ rng.normal(size=(16, 16)) / 4
    rows = [(i, [float(np.float32(c)) for c in v], int(i % 5) if i % 7 else None) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1], 9) for i in range(150)] + [(4, rows[4][1], 1), (None, rows[5][1], 2)]
    bad = [(2000, None, 1), (2001, [], 1), (2002, [1.0] * 15, 1), (2003, [math.nan] + [0.0] * 15, 1)]
    bad += [(2004, [None] + [0.0] * 15, 2), (2005, [math.inf] + [0.0] * 15, 2)]
    return rows, bad


def test_whitening_equals_the_eigenvectors_of_the_covariance(spark, vectors):
    rows, bad = vectors
    table = spark.createDataFrame(rows + bad, SCHEMA).withColumn("n", F.lit("clash")).withColumn("x", F.lit(1))
    got = whitened(table).collect()
    x = np.floor(np.array([v for _, v, _ in rows]) * 256).astype(int)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 4 * len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["component"]), []).append(r)
    for (i, _, _), v in zip(rows, x, strict=True):
        for k in range(4):
            for r in by_id[i, k + 1]:
                assert r["n"] == n and r["deviation"] == ((n * v - sums) ** 2).sum()
                want = (v - sums / n) @ axes[:, k] / math.sqrt(values[k])
                assert abs(abs(r["whitened"]) - abs(want)) < 1e-8
                assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-10
                assert r["identity_error"] < 1e-10
    signs = {k: {np.sign(by_id[i, k][0]["whitened"]) * np.sign(v @ axes[:, k - 1] - sums / n @ axes[:, k - 1]) for (i, _, _), v in zip(rows, x, strict=True)} for k in range(1, 5)}
    assert all(len(s - {0.0}) == 1 for s in signs.values())


def test_whitening_keeps_small_eigenvalues(spark):
    """Spread over seven orders of magnitude: the covariance would lose the last ones."""
    rng = np.random.default_rng(8)
    scales = 10.0 ** np.array([3, 2, 1, 0, -1, -2, -2.5, -3])
    turn, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    v = rng.normal(size=(400, 8)) * scales * 1000 @ turn
    table = spark.createDataFrame([(i, [float(c) for c in r], 0) for i, r in enumerate(v)], "vec_id long, embedding array<double>, label int")
    model = fit_whitening(table, "embedding", 8)
    x = np.unique(np.floor(v * 256), axis=0)
    singular = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert np.allclose(model.values, singular**2 / len(x), rtol=1e-9)
    assert model.identity_error < 1e-6


def test_whitening_without_spread(spark):
    """Fewer distinct vectors than components, constant entries, one vector, none."""
    flat = spark.createDataFrame([(i, [float(i % 3), 1.0, float(i % 3), 0.0, 2.0], 0) for i in range(30)], SCHEMA)
    got = whitened(flat).collect()
    assert len(got) == 120
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert all(abs(r["explained"] - (r["component"] == 1)) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    one = whitened(flat.where("vec_id % 3 = 1")).collect()
    assert len(one) == 40 and all(r["whitened"] is None and r["n"] == 1 and r["deviation"] == 0 for r in one)
    assert whitened(flat.where("vec_id < 0")).collect() == []
    assert whitened(spark.createDataFrame([(1, None, 0)], SCHEMA)).columns == whitened(flat).columns


def test_whitening_deviation_is_exact_beyond_doubles(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-(2**21), 2**21) / 256 for _ in range(6)], 0) for i in range(200)]
    got = {r["vec_id"]: r["deviation"] for r in whitened(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = {i: [int(c * 256) for c in v] for i, v, _ in rows}
    sums = [sum(c) for c in zip(*x.values(), strict=True)]
    assert got == {i: sum((200 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in x.items()}


def _codes(rows, dim, parts=8, entries=16, rounds=6):
    x = {i: [math.floor(4096 * c) for c in v] for i, (_, v, _) in enumerate(rows)}
    width = dim // parts
    seeds = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i]))[:entries]

    def part(i, p):
        return x[i][p * width : (p + 1) * width]

    books = [[part(i, p) for i in seeds] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for i in x:
                held.setdefault(nearest(part(i, p), books[p])[1], []).append(part(i, p))
            for j, members in held.items():
                books[p][j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = {i: [nearest(part(i, p), books[p]) for p in range(parts)] for i in x}
    errors = {i: sum(d for d, _ in f) for i, f in found.items()}
    labels = {}
    for i, (_, _, label) in enumerate(rows):
        labels[label] = labels.get(label, 0) + errors[i]
    return sorted(
        (str(r[0]), "".join(f"{j:02x}" for _, j in found[i]), errors[i], labels[r[2]], digest) for i, r in enumerate(rows)
    )


def test_codes_equal_brute_force(spark, vectors):
    rows, bad = vectors
    table = spark.createDataFrame(rows + bad, SCHEMA).withColumn("code", F.lit("clash")).withColumn("error", F.lit(1))
    got = vector_codes(table.repartition(7)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == _codes(rows, 16)


def test_codes_of_few_rows_and_ties(spark):
    """Fewer rows than entries, equal entries, lengths that the parts do not divide, no rows."""
    rows = [(i, [float(i % 2)] * 16, None) for i in range(9)]
    got = vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == _codes(rows, 16)
    odd = [(i, [float(i), 0.5, -float(i)], 1) for i in range(5)]
    padded = [(i, [*v, *[0.0] * 5], l) for i, v, l in odd]
    assert sorted((str(r[0]), *r[1:]) for r in vector_codes(spark.createDataFrame(odd, SCHEMA)).collect()) == _codes(padded, 8)
    assert vector_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []


def test_orchard_search_equals_a_scan():
    rng = np.random.default_rng(2)
    for spread in (3, 1000):
        entries = rng.integers(-spread, spread + 1, size=(16, 4))
        x = rng.integers(-spread, spread + 1, size=(2000, 4))
        at, distance = Orchard(entries).nearest(x)
        every = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (at == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def _fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(BITS) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps, ids):
    """The smallest id of each row's component by plain search."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    groups = {}
    for i, own in enumerate(label):
        if ids[i] is not None:
            groups[own] = min(groups.get(own, ids[i]), ids[i])
    return [groups.get(own) for own in label]


def test_simhash_equals_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"Wort{i}é" for i in range(60)]
    rows = []
    for i in range(140):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        rows.append((i + 20, rng.choice([" ", "  \t", "\n"]).join(base)))
        if i % 3 == 0:
            for _ in range(3):
                changed = list(base)
                changed[rng.randrange(len(base))] = rng.choice(vocabulary)
                rows.append((500 + len(rows), " ".join(changed).upper() + rng.choice(["", " ", "\n"])))
    rows += [(7, None), (8, ""), (9, " \n"), (20, "same id other text here"), (None, rows[0][1]), (None, "only without id")]
    rows += [(3, rows[0][1]), (3, rows[0][1]), (5, "x" * 300_000), (6, "Zß y" * 40_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("id", F.lit("c"))
    got = simhash_components(table.repartition(5)).collect()
    fps = [_fingerprint(t) for _, t in rows]
    ids = [i for i, _ in rows]
    want = [(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, _components(fps, ids), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert simhash_components(table.limit(0)).collect() == []


def test_links_of_one_dense_group(spark):
    """Thousands of fingerprints round one: cells by pivots, and no link is lost."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    near = {centre}
    while len(near) < 3000:
        f = centre
        for _ in range(rng.randint(1, 7)):
            f ^= 1 << rng.randrange(40, 64)
        near.add(f)
    alone = {rng.getrandbits(64) for _ in range(500)}
    fps = sorted(near | alone)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = fingerprint_links(table, cell_rows=16).collect()
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 2
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    bits = np.array(fps, dtype=np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 2):
            assert root(f) == root(fps[j])


def test_pivot_pairs_equal_a_scan():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, size=200, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, size=200).astype(np.uint64)
    fps = np.concatenate([base, base ^ flips, base])
    pivots = rng.integers(0, 1 << 63, size=16, dtype=np.uint64)
    table = np.bitwise_count(fps[:, None] ^ pivots[None]).astype(np.int16)
    a, b = cell_pairs(fps, fps, table, table, 2)
    every = np.bitwise_count(fps[:, None] ^ fps[None]) <= 2
    every &= fps[:, None] != fps[None]
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*np.nonzero(every), strict=True))


def test_offsets_hold_every_change_of_two_bits():
    for k in (1, 2, 3):
        steps = offsets(k, 2)
        both = {tuple(s) for s in steps} | {tuple(-c for c in s) for s in steps}
        assert both == {tuple(a + b for a, b in zip(x, y, strict=True)) for x in both if all(abs(c) == 1 for c in x) for y in both if all(abs(c) == 1 for c in y)} | {x for x in both if all(abs(c) == 1 for c in x)}
