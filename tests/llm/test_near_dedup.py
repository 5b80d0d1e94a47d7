import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest

from daytally.llm.components import components
from daytally.llm.near_dedup import BANDS, _pairs, band_keys, bin_values, near_duplicates, without_near_duplicates
from daytally.llm.shingles import shingle_sets

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return sorted((d, len(sets[i]), smallest[find(i)], smallest[find(i)] == d) for i, (d, _) in enumerate(rows))


def changed(rng, words, share):
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    common = [f"c{i}" for i in range(150)]
    for _ in range(60):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 5, 6, 12, 40, 200]))]
        out.append(base)
        out += [changed(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.06])) for _ in range(rng.choice([0, 0, 1, 4]))]
    # Many documents share a long passage and are no near-duplicates, but some pairs among them are.
    for _ in range(120):
        own = [f"o{rng.randrange(10**6)}" for _ in range(70)]
        out.append(common + own)
        if rng.random() < 0.25:
            out.append(changed(rng, common + own, 0.015))
    chain = [f"k{i}" for i in range(300)]
    for _ in range(12):
        out.append(chain := changed(rng, chain, 0.02))
    rng.shuffle(out)
    rows = [(10 * i, " ".join(w)) for i, w in enumerate(out)]
    return [*rows, (1, None), (2, ""), (3, " \t\n"), (5, "One"), (4, "one"), (7, "a b c d e"), (6, "A b\tc  d E")]


def test_agrees_with_brute_force(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_near_copies_in_hot_buckets_of_foreign_documents(spark):
    """A shared passage fills every bucket with documents that are no near copies of anything."""
    rng = random.Random(8)
    notice = [f"n{i}" for i in range(400)]
    own = lambda n: [f"o{rng.randrange(10**9)}" for _ in range(n)]
    rows = [(i, " ".join(notice + own(150))) for i in range(3000)]
    rows += [(10_000 + i, " ".join(notice + own(25))) for i in range(10)]
    # Another passage, of which each document of one family lacks another word.
    other = [f"p{i}" for i in range(400)]
    rows += [(20_000 + i, " ".join(other + own(150))) for i in range(1000)]
    rows += [(30_000 + i, " ".join([*other[: 40 * i], "x", *other[40 * i + 1 :], *own(30)])) for i in range(8)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    of = {r.doc_id: r.component_id for r in got}
    assert {of[10_000 + i] for i in range(10)} == {10_000}
    assert {of[30_000 + i] for i in range(8)} == {30_000}
    assert all(of[i] == i for i in of if i < 10_000 or 20_000 <= i < 30_000)


def test_pairs_of_prefix_join_connect_all_links(spark):
    rng = random.Random(3)
    parts = [list(range(100 * k, 100 * k + 60)) for k in range(3)]
    sets = []
    for i in range(300):
        base = [x for x in rng.choice(parts) if rng.random() > rng.choice([0, 0, 0.03, 0.1])]
        sets.append({*base, *(10_000 + 100 * i + k for k in range(rng.choice([0, 3, 8, 14, 18, 25])))})
    rows = [(i, None, len(s), x) for i, s in enumerate(sets) for x in s]
    for most in (2, 20):
        pairs = _pairs(spark.createDataFrame(rows, "id long, root long, n int, shingle long"), 75, most).collect()
        root = list(range(len(sets)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
        for a, b in pairs:
            if linked(a, b):
                root[find(a)] = find(b)
        assert all(find(a) == find(b) for a in range(len(sets)) for b in range(a) if linked(a, b))


def test_one_large_group(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(changed(rng, base, 0.005))) for i in range(600)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_ids_that_are_null_or_repeat(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(8, text), (8, text), (None, text), (9, text + " z"), (None, "alone"), (7, "other"), (7, text)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(8, 7, False), (9, 7, False), (None, 7, False), (None, None, True), (7, 7, True)}
    kept = without_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept if r.text != text) == [(0, "alone"), (7, "other")]


def test_empty_and_long(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, long + " a"), (2, long), (3, "x" * 3_000_000)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(1, 149_997, 1, True), (2, 149_996, 1, False), (3, 1, 3, True)]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "a b", 5, "s"), (2, "a b", 6, "t")], SCHEMA + ", bucket long, digest string")
    assert [tuple(r) for r in without_near_duplicates(df).collect()] == [(1, "a b", 5, "s")]


def test_shingle_sets_have_the_sizes_of_exact_sets():
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "B", "é", "b\n", "\t"], k=rng.randrange(40))) for _ in range(300)] + [None, "", "  "]
    got = [len(s) for s in shingle_sets(pa.array(texts, pa.string()))]
    assert got == [len(shingles(t)) for t in texts]


def test_agreement_of_signatures_estimates_similarity():
    rng = np.random.default_rng(4)
    agree, bands = [], []
    for _ in range(200):
        both, a, b = np.split(rng.integers(0, 2**64, 400, np.uint64), [300, 350])
        x, y = (bin_values(np.unique(np.concatenate([both, z]))) for z in (a, b))
        agree.append((x == y).mean())
        bands.append((band_keys(x) == band_keys(y)).any())
    assert np.mean(agree) == pytest.approx(0.75, abs=0.02)
    assert len(band_keys(x)) == BANDS and np.all(bands)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (139, 300), (300, 139)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in [*range(100, 140), 300]}
    few = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), few=5).collect()}
    assert few == got
    names = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y")], "a string, b string")
    assert {tuple(r) for r in components(names).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
