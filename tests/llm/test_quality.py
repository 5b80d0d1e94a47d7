import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daytally.llm import quality as Q

SCHEMA = "doc_id long, lang string, text string"


class Plain:
    """Interpolated modified Kneser-Ney, straight from the formulas."""

    def __init__(self, texts, order=Q.ORDER):
        grams = Counter()
        for text in texts:
            data = b"\0" * (order - 1) + text.encode()
            grams.update(data[i : i + order] for i in range(len(data) - order + 1))
        self.order, self.counts = order, {order: grams}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.by, self.contexts = {}, {}
        for n, counts in self.counts.items():
            n1, n2, n3, n4 = (sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2) if n1 else 0
            raw = [k - (k + 1) * y * b / a if a and b else 0.75 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            self.by[n] = [min(max(d, 0.05), k) for k, d in enumerate(raw, 1)]
            self.contexts[n] = defaultdict(lambda: [0, 0.0])
            for g, c in counts.items():
                self.contexts[n][g[:-1]][0] += c
                self.contexts[n][g[:-1]][1] += self.by[n][min(c, 3) - 1]

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / 256
        lower = self.p(gram[1:])
        if gram[:-1] not in self.contexts[n]:
            return lower
        total, left = self.contexts[n][gram[:-1]]
        c = self.counts[n].get(gram, 0)
        return (c - self.by[n][min(c, 3) - 1] if c else 0) / total + left / total * lower

    def perplexity(self, text):
        data = b"\0" * (self.order - 1) + text.encode()
        logs = [math.log(self.p(data[i : i + self.order])) for i in range(len(text.encode()))]
        return math.exp(-sum(logs) / len(logs)) if logs else None


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["the", "then", "at", "été", "on", "no", "stone", "\n", "a."]
    return [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(60)] + ["zzz", "the", "q" * 5000]


def test_perplexities_agree_with_the_formulas(spark, texts):
    docs = spark.createDataFrame([(i, "xx", t) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = Q.perplexities(docs, Q.Model(docs.where("doc_id < 40"))).collect()
    plain = Plain(texts[:40])
    assert len(got) == len(texts)
    for r in got:
        assert r.perplexity == pytest.approx(plain.perplexity(texts[r.doc_id]), rel=1e-5)
        assert r.n_bytes == len(texts[r.doc_id].encode())


@pytest.mark.parametrize("way", ["join", "repartition", "union"])
def test_any_frame_will_do(spark, texts, way, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK_BYTES", 500)
    docs = spark.createDataFrame([(i, "xx", t) for i, t in enumerate(texts)], SCHEMA)
    if way == "join":
        frame = docs.join(docs.select("doc_id").distinct(), "doc_id").select("doc_id", "lang", "text")
    elif way == "repartition":
        frame = docs.repartition(7)
    else:
        frame = docs.where("doc_id % 2 = 0").unionAll(docs.where("doc_id % 2 = 1").orderBy(F.rand()))
    got = {r.doc_id: r.perplexity for r in Q.perplexities(frame, Q.Model(docs.where("doc_id < 40"))).collect()}
    plain = Plain(texts[:40])
    assert got == {i: pytest.approx(plain.perplexity(t), rel=1e-5) for i, t in enumerate(texts)}


def test_probabilities_sum_to_one(spark, texts):
    docs = spark.createDataFrame([(i, "xx", t) for i, t in enumerate(texts[:40])], SCHEMA)
    context = int.from_bytes(b" on the"[-(Q.ORDER - 1) :], "big")
    asked = spark.range(256).select((F.col("id") + (context << 8)).alias("gram"))
    assert Q.Model(docs).probabilities(asked).agg(F.sum("p")).first()[0] == pytest.approx(1)


def test_trusted_documents_stay_and_junk_goes(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.judged(docs, labels)
    assert got.count() == docs.count()
    share = {r.quality: r.share for r in got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.97 and share[0] < 0.2
    # One threshold per language: the quantile of the documents kept from training.
    assert got.groupBy("lang").agg(F.count_distinct("threshold").alias("n")).where("n <> 1").isEmpty()


def test_odd_rows(spark):
    good = [(i, "en", "the stone is on the table " * (1 + i % 4)) for i in range(40)]
    odd = [(100, None, "the stone"), (101, "en", None), (102, "en", ""), (None, "en", "the table"), (103, "zz", "the stone"), (104, "en", "x" * 3_000_000)]
    odd += [(105, "en", "the stone")] * 2
    labels = [(i, 1) for i in range(40)] + [(None, 1), (105, 1), (105, 0), (106, None), (3, 1)]
    docs = spark.createDataFrame(good + odd, SCHEMA + "")
    got = Q.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == 48
    by_id = {r.doc_id: r for r in got}
    assert by_id[101].perplexity is None and not by_id[101].kept and not by_id[102].kept
    assert by_id[100].kept and by_id[None].kept and by_id[103].kept and not by_id[104].kept
    assert by_id[103].threshold is not None


def test_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "en", "abc"), (2, "en", "")], SCHEMA)
    got = {r.doc_id: (r.perplexity, r.kept) for r in Q.judged(docs, labels).collect()}
    assert got == {1: (pytest.approx(256), True), 2: (None, False)}
    assert Q.judged(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_other_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(1, "en", "abc", 2, 3)], SCHEMA + ", gram long, block long")
    labels = spark.createDataFrame([(1, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    assert Q.judged(docs, labels).columns == ["doc_id", "lang", "n_bytes", "perplexity", "threshold", "kept"]


def test_disk_stays_near_the_size_of_the_texts(spark, medium, monkeypatch):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [*blocks.localDirsString(), spark.conf.get("spark.checkpoint.dir"), spark.conf.get("spark.sql.warehouse.dir")]
    folders = [Path(f.removeprefix("file:")) for f in folders]

    def used():
        return sum(p.stat().st_size for f in folders for p in f.rglob("*") if p.is_file())

    def cut(df, real=Q.cut):
        out = real(df)
        seen.append(used())
        return out

    seen = [used()]
    monkeypatch.setattr(Q, "cut", cut)
    Q.judged(docs, labels).collect()
    tables = spark.catalog.listTables()
    assert max(seen) - seen[0] < 2.5 * docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert not [t for t in tables if t.name.startswith("quality_")]


def test_counts_beyond_the_bound_are_sent_in_parts(texts, monkeypatch):
    monkeypatch.setattr(Q, "HELD", 100)
    batches = [pa.record_batch({"text": texts[i : i + 5]}) for i in range(0, len(texts), 5)]
    rows = [r for batch in Q._count(iter(batches)) for r in batch.to_pylist()]
    assert len(rows) > len({r["shard"] for r in rows})
    got = Counter()
    for shard in {r["shard"] for r in rows}:
        merged = Q._merge(pa.Table.from_pylist([r for r in rows if r["shard"] == shard], Q._COUNTED_ARROW)).to_pylist()[0]
        keys, counts = (Q._unpacked(merged[c], merged["n"], np.int64) for c in ("keys", "counts"))
        got |= Counter({int(g).to_bytes(Q.ORDER, "big"): int(n) for g, n in zip(Q._turned(keys), counts, strict=True)})
    assert got == Plain(texts).counts[Q.ORDER]
