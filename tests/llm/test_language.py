import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daytally.llm import language as L

SCHEMA = "doc_id long, text string, lang string"
SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog and runs through the forest with other foxes".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund und läuft durch den wald mit anderen füchsen".split(),
    "fr": "le rapide renard brun saute par-dessus le chien paresseux et court dans la forêt avec les autres".split(),
}


def docs(n=240):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        lang = list(SAMPLES)[i % 3]
        rows.append((i, " ".join(rng.choice(SAMPLES[lang], rng.integers(3, 40))), lang))
    return rows


def test_held_out_documents_are_told_right(spark, medium):
    table = spark.read.parquet(f"{medium}/documents.parquet")
    got = L.predict_languages(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.99
    assert np.mean([r.rejected for r in got]) <= 0.005


OTHER = [
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
    "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα είναι προικισμένοι με λογική",
    "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
    "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
]


def test_other_languages_and_letter_noise_are_rejected_and_clean_texts_are_not(spark, medium):
    rng = np.random.default_rng(8)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), 150)) for _ in range(30)]
    table = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1 - i, t, None) for i, t in enumerate(OTHER + noise)]
    got = L.predict_languages(table.unionAll(spark.createDataFrame(odd, table.schema))).collect()
    assert all(r.rejected for r in got if r.doc_id < 0)
    assert np.mean([r.rejected for r in got if r.doc_id >= 0 and r.held_out]) <= 0.01


def test_two_languages_can_be_rejected_too(spark):
    rows = [r for r in docs() if r[2] != "fr"] + [(900 + i, t, None) for i, t in enumerate(OTHER)]
    got = L.predict_languages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.rejected == (r.doc_id >= 900) for r in got)


def test_many_labels_do_not_enlarge_the_sample(spark):
    rows = [(i, f"word{i} text", f"l{i:04d}") for i in range(400)] + [(1000 + i, "the dog", "en") for i in range(5)]
    model = L.fit(spark.createDataFrame(rows, SCHEMA))
    assert len(model.languages) == L.MOST_LANGUAGES and "en" in model.languages


def test_labels_of_held_out_documents_and_sources_do_not_matter(spark):
    rows = docs()
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    one, other = (sorted(map(tuple, L.predict_languages(spark.createDataFrame(r, SCHEMA)).collect())) for r in (rows, wrong))
    assert one == other


def test_scores_are_probabilities_and_reruns_agree(spark):
    frame = spark.createDataFrame(docs(), SCHEMA)
    one, other = (sorted(map(tuple, L.predict_languages(f).collect())) for f in (frame, frame.repartition(5)))
    assert one == other
    assert all(0 <= r[3] <= 1 for r in one)


def test_nulls_texts_without_letters_and_repeated_rows(spark):
    odd = [(None, "the dog and the fox", "en"), (1000, None, "en"), (1001, "", "de"), (1002, "12 + 3 = ² !", "fr"), (1003, "the dog", None)]
    odd += [(1004, "der hund", "de")] * 2 + [(1005, "der hund " * 100_000, None), (1006, "ſ" * 600_000, "de")]
    got = L.predict_languages(spark.createDataFrame(docs() + odd, SCHEMA)).where("doc_id is null or doc_id >= 1000").collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(odd) and not by_id[None].held_out
    assert [(by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) for i in (1000, 1001, 1002)] == [("und", 0.0, True)] * 3
    assert (by_id[None].lang_pred, by_id[1003].lang_pred, by_id[1005].lang_pred) == ("en", "en", "de")


def test_without_labels_or_rows(spark):
    assert L.predict_languages(spark.createDataFrame([], SCHEMA)).collect() == []
    got = L.predict_languages(spark.createDataFrame([(1, "the dog", None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_filter_keeps_columns_and_told_documents(spark):
    rows = [(*r, "s", 1) for r in docs()] + [(999, "1 2 3", "en", "s", 2)]
    frame = spark.createDataFrame(rows, SCHEMA + ", score string, rejected long")
    kept = L.without_rejected(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == set(range(240))


def test_a_text_in_segments_has_the_subwords_of_the_whole(monkeypatch):
    text = " ".join(SAMPLES["fr"] * 50)
    whole = L.histogram(text)
    monkeypatch.setattr(L, "_SEGMENT", 100)
    parts = L.histogram(text)
    assert whole[0].tolist() == parts[0].tolist() and whole[1] == pytest.approx(parts[1])


def test_prediction_agrees_with_the_plain_formula():
    rows = docs(90)
    model = L.train([L.histogram(t) for _, t, _ in rows], [x for *_, x in rows], [True] * 90, [i % 5 == 0 for i in range(90)])
    texts = [t for _, t, _ in rows[:20]]
    for text, k, p, strange in zip(texts, *model.predict(texts), strict=True):
        buckets, shares = L.histogram(text)
        z = ((model.table[buckets] * shares[:, None]).sum(axis=0) @ model.weights + model.bias) / model.temperature
        q = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert k == q.argmax() and p == pytest.approx(q.max())
        assert strange == pytest.approx(-(model.logs[buckets, k] @ shares), rel=1e-4, abs=1e-6)


def test_held_out_is_false_without_an_id(spark):
    got = spark.createDataFrame([(None,)], "doc_id long").select(L.held_out(F.col("doc_id"))).first()[0]
    assert got is False
