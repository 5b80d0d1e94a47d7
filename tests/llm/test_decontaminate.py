import hashlib
import random
import re
import string

import pytest

from daytally.llm import decontaminate
from daytally.llm.decontaminate import Searcher, contamination, windows, with_leaks, without_leaks, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    patterns = {}
    for item_id, text in items:
        w = found_words(text)
        for i in range(max(len(w) - size, 0) + 1) if w else ():
            patterns.setdefault(tuple(w[i : i + size]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, ids = found_words(text), set(), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(w) - n + 1):
                if names := patterns.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= names
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def made(rng, n, vocabulary=40):
    return " ".join(rng.choice(["a", "the", "of"]) if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}é" for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    items = [(i, made(rng, rng.choice([1, 2, 5, 9, 10, 11, 30]))) for i in range(40)]
    items += [(100, None), (101, "... !"), (None, made(rng, 12)), (3, made(rng, 15)), (102, items[5][1]), (102, items[5][1])]
    docs = [(i, made(rng, rng.choice([0, 1, 8, 50, 200]))) for i in range(60)]
    for i in range(60, 110):
        host, cut = made(rng, 30).split(), rng.choice(items)[1] or "x"
        host[10:10] = [cut.upper() if i % 2 else cut.replace(" ", " -- ")]
        docs.append((i, " ".join(host)))
    docs += [(200, None), (201, ""), (None, items[0][1]), (5, "w1é"), (5, "w1é"), (202, made(rng, 60_000) + " " + items[6][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [8 << 20, 4000])
def test_agrees_with_brute_force(spark, tables, block_bytes):
    docs, items = tables
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_searcher_finds_overlaps_at_every_place():
    patterns = {b" a b ": 1, b" b a b ": 2, b" abcdefgh ijkl mnop qrst uvwx ": 3, b" x ": 4}
    docs = [words(b"a b a b x"), words(b"abcdefgh ijkl mnop qrst uvwx" * 1), [], words(b"x " * 5000)]
    got = set(Searcher(patterns).search(docs))
    want = {(0, 0, 2, 1), (0, 2, 4, 1), (0, 1, 4, 2), (0, 4, 5, 4), (1, 0, 5, 3)}
    assert got == want | {(3, i, i + 1, 4) for i in range(5000)}


def test_a_line_of_all_items_is_sent_once(spark, monkeypatch):
    line = "please answer the following question with one of these letters only"
    items = [(i, f"{line} own{i}") for i in range(300)]
    docs = [(1, line), (2, f"x {line} own7 y"), (3, "clean")]
    sent = []
    blocks = decontaminate._blocks
    monkeypatch.setattr(decontaminate, "_blocks", lambda *a: (sent.append(b) or b for b in blocks(*a)))
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)
    assert len(sent) == 1 and sum(b" own" in p for p in sent[0]) == 300 and len(sent[0]) == 302


def test_windows_of_short_items():
    assert windows([]) == [] and windows([b"a"]) == [b" a "]
    assert len(windows([b"a"] * 12)) == 3


def test_empty_tables(spark):
    none, item = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert contamination(none, item).collect() == []
    doc = spark.createDataFrame([(1, "a b")], DOCS)
    assert [(r.n_words, r.n_hit) for r in contamination(doc, spark.createDataFrame([], ITEMS)).collect()] == [(2, 0)]


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "x y", 7, 8), (2, "q", None, 9)], DOCS + ", leaks long, n_hit long")
    item = spark.createDataFrame([(1, "x y", "z")], ITEMS + ", pattern string")
    assert with_leaks(docs, item, name="found").columns == ["doc_id", "text", "leaks", "n_hit", "found"]
    assert [tuple(r) for r in without_leaks(docs, item).collect()] == [(2, "q", None, 9)]
    assert contamination(docs, item).count() == 2
