import zlib

import numpy as np
import pytest

from timewise.llm import compression_classifier, toxicity

from .helpers import EDGES, documents

SF = "/root/testdata/sf0.01"


def auc(score, y):
    """Share of (toxic, clean) pairs in the right order; ties count half."""
    a, b = score[y == 1][:, None], score[y == 0][None, :]
    return ((a > b) + 0.5 * (a == b)).mean()


@pytest.mark.parametrize("module,label,folds,out,least", [(compression_classifier, "quality", 3, 1, 0.9), (toxicity, "toxic", 5, 0, 0.9)])
def test_held_out(spark, module, label, folds, out, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    y = {r.doc_id: r[label] for r in labels.collect()}
    rows = module.score(docs, module.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
    held = [(r.score, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    assert auc(np.array([h[0] for h in held]), np.array([h[1] for h in held])) > least
    # labels of the held-out fold never matter
    flipped = labels.withColumn(label, (1 - labels[label]).cast("int"))
    mixed = labels.where(f"pmod(crc32(cast(cast(doc_id as string) as binary)), {folds}) <> {out}").unionByName(
        flipped.where(f"pmod(crc32(cast(cast(doc_id as string) as binary)), {folds}) = {out}"))
    some = docs.limit(50)
    a = {r.doc_id: r.score for r in module.score(some, module.fit(docs, mixed)).collect()}
    assert a == {r.doc_id: r.score for r in rows if r.doc_id in a}


@pytest.mark.parametrize("module,label", [(compression_classifier, "quality"), (toxicity, "toxic")])
def test_edges(spark, module, label):
    docs = documents(spark, EDGES)
    for rows in ([], [(4, 1)], [(i, i % 2) for i, _ in EDGES] + [(None, 1), (5, None), (99, 0)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        model = module.fit(docs, labels)
        got = module.score(docs, model).collect()
        assert len(got) == len(EDGES) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
        one = {r.doc_id: r.score for r in got}
        assert one[7] == one[8] and one[1] == one[2]
        assert module.score(documents(spark, []), model).count() == 0
        module.fit(documents(spark, []), labels)


def test_marks_behind_the_first_piece(spark):
    """What tells good from bad texts stands behind their first 8192 bytes."""
    r = np.random.default_rng(3)
    head, *tails = ([bytes(r.integers(97, 123, 7).astype(np.uint8)).decode() for _ in range(n)] for n in (3000, 40, 40))
    rows = [(i, " ".join([*r.choice(head, 1100), *r.choice(tails[i % 2], 300)])) for i in range(120)]
    assert all(len(" ".join(t.split(" ")[:1100])) > 8192 for _, t in rows)
    docs = documents(spark, rows)
    model = compression_classifier.fit(docs, spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int"))
    got = compression_classifier.score(docs, model).where("held_out").collect()
    assert len(got) > 20 and auc(np.array([g.score for g in got]), np.array([g.doc_id % 2 for g in got])) > 0.99
    assert sum(w.encode() in model.good for w in tails[1]) > 20 and sum(w.encode() in model.bad for w in tails[0]) > 20


def test_toxicity_features():
    codes = toxicity.Codes({"idiot": 5.0}, {"achli": 3.0})
    text = "You 1d10t! The IDIOT, achlichkeit"
    x = dict(zip(toxicity.FEATURES, toxicity.features(text, np.frombuffer(text.encode(), np.uint8), codes)))
    assert (x["hits"], x["start_hits"], x["hidden_hits"], x["any_hit"], x["near_person"]) == (1, 1, 1, 1, 3)
    assert x["obfuscated"] == 0.2 and x["capitals"] > 0 and x["best"] == 5 and x["evidence_density"] == 13 / 5


def test_features_against_plain_python(spark, sf):
    """Every feature of every text, worked out anew."""
    r = np.random.default_rng(5)
    texts = [t for _, t in EDGES if t] + [x.text for x in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    vocabulary = sorted({toxicity.plain(w) for t in texts for w in t.split()} - {""})
    words = {str(w): float(k % 7 + 1) for k, w in enumerate(r.choice(vocabulary, 300))}
    starts = {str(w)[:k]: 2.5 for k in (4, 5, 7) for w in r.choice(vocabulary, 20) if len(w) > k}
    codes = toxicity.Codes(words, starts)
    for text in texts:
        ws = text.split()
        hit, odds, person, hidden, obfuscated = [], [], [], 0, 0
        for w in ws:
            p = toxicity.plain(w)
            own = [words[p]] if p in words else []
            begun = [starts[p[:k]] for k in (4, 5, 6, 7) if p[:k] in starts and len(p) >= k]
            mixed = not p.isalpha() and any(c.isalpha() for c in p) and any(c.isdigit() or c in "@$*#!+" for c in p)
            read = "".join(toxicity.READING.get(c, c) for c in p).replace("*", "")
            plainly = [words[read]] if mixed and not own and read in words else []
            hidden, obfuscated = hidden + bool(plainly), obfuscated + mixed
            hit.append((bool(own), bool(begun), bool(own + begun + plainly)))
            odds.append(max(own + begun + plainly, default=0.0))
            person.append(p in toxicity.SECOND_PERSON)
        n = len(ws)
        near = sum(any(person[max(0, i - 5):i + 6]) for i in range(n) if hit[i][2])
        raw = text.encode()
        share = lambda chars: sum(b in chars.encode() for b in raw) / len(raw)          # noqa: E731
        upper = share("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if text.isascii() else sum(c.isupper() for c in text) / len(text)
        want = [sum(h[0] for h in hit), sum(h[0] for h in hit) / n, sum(h[1] for h in hit), sum(h[1] for h in hit) / n, near, sum(person) / n, upper,
                share("!?.,;:"), share("#*$%&|<>@~^_+="), share("0123456789"), obfuscated / n, hidden, float(any(h[2] for h in hit)), np.log1p(n),
                max(odds), np.log1p(sum(odds)), sum(odds) / n] if n else [0.0] * len(toxicity.FEATURES)
        assert np.allclose(toxicity.features(text, np.frombuffer(raw, np.uint8), codes), want)


def test_curve(spark):
    xs, ys = [0.1, 0.4, 0.4, 0.9], [0.0, 0.2, 0.6, 1.0]
    p = [0.0, 0.1, 0.25, 0.4, 0.65, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in p], "p double")
    got = [r[0] for r in df.select(toxicity._curve(df.p, xs, ys)).collect()]
    assert np.allclose(got, [0, 0, 0.1, 0.6, 0.8, 1, 1])
    assert [r[0] for r in df.select(toxicity._curve(df.p, [], [])).collect()] == p
