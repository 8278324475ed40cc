"""Frames for the edge cases and brute-force versions."""
import random

import duckdb

TABLES = ["documents", "pages", "benchmark", "labels", "conversations", "embeddings"]


def documents(spark, rows):
    """(doc_id, text) rows with columns whose names clash with inner ones."""
    out = [(i, t, "en", f"s{k % 2}", len(t or ""), 1, "x", 2.0) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long, rep int, spans string, score double")


EDGES = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four"), (6, "one two three four five"),
         (7, "same text here with some more words in it"), (8, "same text here with some more words in it"), (9, "ÄÖÜ ß 漢字 \U0001f600 é"),
         (10, "a" * 3000), (11, "word " * 5000), (12, "line\nline\nline\n\nother")]


def same_as_duckdb(spark, sf, name):
    from __spark_entry__ import oracle_sql, queries
    from tools.oracle_check import compare
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries()[name](spark, sf)
    rel = con.execute(oracle_sql()[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, rel.fetchall(), [d[0] for d in rel.description]) is None


def random_texts(seed, n=60, words=30, vocabulary=200):
    """Texts with copies, near copies and shared passages."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    passage = " ".join(r.choice(vocab) for _ in range(12))
    out = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
        elif out and kind < 0.4:
            w = r.choice(out).split()
            for _ in range(r.randint(1, 2)):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append(" ".join(w))
        else:
            w = [r.choice(vocab) for _ in range(r.randint(1, words))]
            if r.random() < 0.4:
                w.insert(r.randrange(len(w) + 1), passage)
            if r.random() < 0.2:
                w += [r.choice(vocab)] * r.randint(5, 40)
            out.append(" ".join(w))
    return out
