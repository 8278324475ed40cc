"""Toxicity: gradient-boosted trees over dense features, with isotonic
calibration.

A lexicon is learnt from the labelled rows: whole words, and word beginnings
of 4 to 7 letters (languages that compound hide a slur in longer words), that
are far commoner in toxic texts than in others, with their log odds.  Every
text then becomes one dense row: densities and counts of lexicon words and
beginnings, the highest log odds and their sum, hits close to a second-person
word, share of capitals, punctuation and symbols, rate of obfuscated words
(letters mixed with digits or symbols), rate of obfuscated words that a plain
substitution turns into a lexicon word, and length.

Nothing is judged by what was learnt from itself.  Learning rows are dealt
over ``PARTS`` folds by hash of the id; the features of a row come from the
lexicon of the other folds, so a word that is toxic by chance looks no better
in learning than in use.  Boosted trees (``operators.trees``) are fitted once
per fold on the others; an isotonic curve over these out-of-fold values of all
learning rows calibrates the score.  The trees that score new texts learn from
all of them; all fits run side by side.

The fit sees at most ``max_rows`` labelled rows (by hash of the id), and a
lexicon keeps at most ``limit`` terms, those with the most evidence.  Every
document is scored on its whole text; scoring shuffles nothing.

Edge cases: null or empty text has all features 0 and scores like any text
without hits; without labelled rows of both classes every score is the share
of toxic rows (0 without any); where a fold lacks a class the curve is fitted
on the folds that have both, or on the learning rows themselves; an empty
table gives an empty result; repeated rows score alike; extra columns are
ignored; a null id is scored and its held_out is null.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timewise.operators.trees import Frame, TreeParams, Trees, fit_many

from .common import as_text, checkpointed
from .labels import fold, learning_rows
from .textblock import blocks, lean

#: Second-person words (English, German, French, Spanish).
SECOND_PERSON = ("you your yours yourself u du dich dir dein deine deiner ihr euch tu te toi vous votre vos ton tes "
                 "tú usted ustedes vosotros ti tus").split()
#: The plain reading of obfuscating characters.
READING = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "+": "t"}
SIZES = (4, 5, 6, 7)
NEAR = 5
PARTS = 4
FEATURES = ["hits", "hit_density", "start_hits", "start_density", "near_person", "person_density", "capitals", "punctuation",
            "symbols", "digits", "obfuscated", "hidden_hits", "any_hit", "log_words", "best", "evidence", "evidence_density"]

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»¿¡„“”‘’…–—"
WORD, START, PERSON, OBFUSCATED, HIDDEN = 1, 2, 4, 8, 16


def plain(word: str) -> str:
    return word.strip(_EDGES).lower()


class Codes(dict):
    """Flag bits of a raw word and the log odds of its lexicon terms, worked
    out once and remembered under a number."""

    def __init__(self, words: dict[str, float], starts: dict[str, float]):
        self.words, self.starts = words, starts
        self.people, self.table = frozenset(SECOND_PERSON), str.maketrans(READING)
        self.flags, self.odds = np.zeros(1024, np.int8), np.zeros(1024)

    def __missing__(self, raw: str) -> int:
        w = plain(raw)
        code, odds = 0, 0.0
        if w in self.words:
            code |= WORD
            odds = self.words[w]
        begun = [self.starts[w[:n]] for n in SIZES if len(w) >= n and w[:n] in self.starts]
        if begun:
            code |= START
            odds = max(odds, *begun)
        if w in self.people:
            code |= PERSON
        if w and not w.isalpha() and any(c.isalpha() for c in w) and any(c.isdigit() or c in "@$*#!+" for c in w):
            code |= OBFUSCATED
            v = w.translate(self.table).replace("*", "")
            if not code & WORD and (v in self.words):
                code |= HIDDEN
                odds = max(odds, self.words[v])
        n = len(self)
        if n >= len(self.flags):
            self.flags, self.odds = (np.concatenate([x, np.zeros_like(x)]) for x in (self.flags, self.odds))
        self.flags[n], self.odds[n] = code, odds
        self[raw] = n
        return n

    def trim(self):
        """Between texts: start anew where too many words are remembered."""
        if len(self) > 200_000:
            self.clear()


_CLASS = np.zeros((256, 4), np.int32)
_CLASS[65:91, 0] = 1
_CLASS[[ord(c) for c in "!?.,;:"], 1] = 1
_CLASS[[ord(c) for c in "#*$%&|<>@~^_+="], 2] = 1
_CLASS[48:58, 3] = 1


def features(text: str, data: np.ndarray, codes: Codes) -> list[float]:
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)
    codes.trim()
    number = np.fromiter(map(codes.__getitem__, words), np.int64, n)
    c, odds = codes.flags[number], codes.odds[number]
    hit = (c & (WORD | START | HIDDEN)) != 0
    hits, starts, hidden = int((c & WORD != 0).sum()), int((c & START != 0).sum()), int((c & HIDDEN != 0).sum())
    person = np.flatnonzero(c & PERSON)
    near = 0
    if len(person) and hit.any():
        where = np.flatnonzero(hit)
        after = person[np.minimum(np.searchsorted(person, where), len(person) - 1)]
        before = person[np.maximum(np.searchsorted(person, where) - 1, 0)]
        near = int((np.minimum(abs(after - where), abs(before - where)) <= NEAR).sum())
    share = np.bincount(data, minlength=256) @ _CLASS / max(1, len(data))
    if not text.isascii():       # capitals beyond A-Z
        share[0] = sum(map(str.isupper, text)) / len(text)
    return [hits, hits / n, starts, starts / n, near, len(person) / n, *map(float, share), float((c & OBFUSCATED != 0).mean()),
            hidden, float(hit.any()), float(np.log1p(n)), float(odds.max()), float(np.log1p(odds.sum())), float(odds.mean())]


def _featurize(lexicons: dict[int, tuple[dict, dict]], keep: list[str]):
    """``lexicons`` by the value of the column part, or one under None."""
    def run(batches):
        codes = {k: Codes(*v) for k, v in lexicons.items()}
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            parts = [None] * len(texts) if None in codes else batch.column("part").to_pylist()
            for first, data, offs in blocks(batch.column("text")):
                rows += [features(texts[first + i], data[offs[i]:offs[i + 1]], codes[parts[first + i]]) for i in range(len(offs) - 1)]
            x = np.array(rows, np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(x[:, i]) for i in range(len(FEATURES))], keep + FEATURES)
    return run


_F_SCHEMA = ", ".join(f"{c} double" for c in FEATURES)


def learn_lexicons(rows: DataFrame, least: int = 3, ratio: float = 8.0, limit: int = 2000) -> dict[int, tuple[dict, dict]]:
    """By fold (and -1 for none): words and word beginnings, with their log
    odds, that mark toxic texts outside that fold, from (text, y, part) rows:
    in at least ``least`` toxic texts and ``ratio`` times commoner there; at
    most ``limit`` of them, by number of texts times log odds."""
    sides = [f"{s}{k}" for s in ("pos", "neg") for k in range(PARTS)]

    def count(batches):
        seen_in: dict[str, list[int]] = {}
        for batch in batches:
            for text, y, part in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), batch.column("part").to_pylist()):
                seen = {plain(w) for w in text.split()}
                seen = {"w" + w for w in seen if w.isalpha()} | {"s" + w[:k] for w in seen if w.isalpha() for k in SIZES if len(w) > k}
                slot = part if y else PARTS + part
                for t in (*seen, ""):
                    seen_in.setdefault(t, [0] * 2 * PARTS)[slot] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen_in), pa.string())] + [pa.array(c, pa.int64()) for c in (list(zip(*seen_in.values())) or [()] * 2 * PARTS)],
                                         ["term", *sides])

    total = " + ".join(sides[:PARTS])
    table = checkpointed(rows.select("text", "y", "part").mapInArrow(lean(count), "term string, " + ", ".join(f"{c} long" for c in sides))
                         .groupBy("term").agg(*[F.sum(c).alias(c) for c in sides]).where(f"{total} >= {least} or term = ''"))
    empty = {k: ({}, {}) for k in range(-1, PARTS)}
    n = table.where("term = ''").first()
    if n is None:
        return empty

    def outside(side: str, k: int):
        return F.lit(0) + sum(F.col(f"{side}{j}") for j in range(PARTS) if j != k)

    evidence = []
    for k in range(-1, PARTS):
        n1, n0 = (sum(n[f"{side}{j}"] for j in range(PARTS) if j != k) for side in ("pos", "neg"))
        odds = F.log((outside("pos", k) + 0.5) / (n1 + 1.0)) - F.log((outside("neg", k) + 0.5) / (n0 + 1.0))
        evidence.append(F.when((outside("pos", k) >= least) & (odds >= float(np.log(ratio))) & F.lit(bool(n1 and n0)), odds).alias(f"odds{k + 1}"))
    scored = table.where("term <> ''").select("term", *evidence, F.expr(total).alias("pos"))
    some = scored.where(" or ".join(f"odds{k} is not null" for k in range(PARTS + 1)))
    found = some.orderBy(F.desc(F.col("pos") * F.greatest(*[F.coalesce(F.col(f"odds{k}"), F.lit(0.0)) for k in range(PARTS + 1)])), "term").limit(limit).collect()
    return {k: tuple({r["term"][1:]: r[f"odds{k + 1}"] for r in found if r["term"][0] == kind and r[f"odds{k + 1}"] is not None} for kind in "ws")
            for k in range(-1, PARTS)}


@dataclass
class ToxicityModel:
    lexicon: tuple[dict[str, float], dict[str, float]]
    trees: Trees | None         # None without two classes
    curve: tuple[list[float], list[float]] | None      # the steps of the isotonic curve
    prior: float


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0, id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = 12000, rounds: int = 60, depth: int = 3, rate: float = 0.1, seed: int = 11) -> ToxicityModel:
    from pyspark.ml.regression import IsotonicRegression
    chosen = learning_rows(labels, label, folds, held_out, max_rows)
    rows = as_text(docs, id_col, text_col).join(chosen, "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(PARTS)))
    lexicons = learn_lexicons(rows)
    x = rows.select("doc_id", "text", "y", "part").mapInArrow(lean(_featurize(lexicons, ["doc_id", "y", "part"])),
                                                            f"doc_id long, y int, part long, {_F_SCHEMA}")
    x = checkpointed(x.repartition("part").sortWithinPartitions("part", "doc_id", *FEATURES))
    seen = {(r["part"], r["y"]): r["count"] for r in x.groupBy("part", "y").count().collect()}
    toxic, size = sum(n for (_, y), n in seen.items() if y), sum(seen.values())
    model = ToxicityModel(lexicons[-1], None, None, toxic / max(1, size))
    if not 0 < toxic < size:
        return model
    whole = [k for k in range(PARTS) if any((k, y) in seen for y in (0, 1)) and all(any((j, y) in seen for j in range(PARTS) if j != k) for y in (0, 1))]
    frames = [Frame(x, FEATURES, "y")] + [Frame(x.where(F.col("part") != k), FEATURES, "y") for k in whole]
    params = TreeParams(rounds=rounds, rate=rate, depth=depth, leaves=0, min_rows=5, alpha=0.0, lam=1.0, rows=1.0, cols=1.0, seed=seed)
    fitted = fit_many([(i, params) for i in range(len(frames))], frames)
    model.trees = fitted[0]
    judges = dict(zip(whole, fitted[1:]))

    def judged(batches):
        for b in batches:
            part, values = b.column("part").to_numpy(), np.column_stack([b.column(c).to_numpy() for c in FEATURES])
            p, keep = np.zeros(len(part)), np.isin(part, whole) if whole else np.ones(len(part), bool)
            for k in whole or [None]:
                mine = keep if k is None else part == k
                p[mine] = (fitted[0] if k is None else judges[k]).predict(values[mine])
            yield pa.RecordBatch.from_arrays([pa.array(b.column("y").to_numpy()[keep].astype(np.float64)), pa.array(np.clip(p[keep], 0.0, 1.0))], ["y", "p"])

    p = x.mapInArrow(lean(judged), "y double, p double")
    curve = IsotonicRegression(featuresCol="p", labelCol="y").fit(p)
    model.curve = [float(a) for a in curve.boundaries], [float(a) for a in curve.predictions]
    return model


def score(docs: DataFrame, model: ToxicityModel, folds: int = 5, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) for every document."""
    at = [FEATURES.index(c) for c in ("hits", "start_hits", "hidden_hits")]

    def run(batches):
        for b in _featurize({None: model.lexicon}, ["doc_id"])(batches):
            x = np.column_stack([b.column(c).to_numpy() for c in FEATURES])
            p = np.full(len(x), float(model.prior)) if model.trees is None else np.clip(model.trees.predict(x), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x[:, at].sum(1).astype(np.int64)), pa.array(p)], ["doc_id", "n_hits", "p"])

    p = as_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, n_hits long, p double")
    s = p.select("doc_id", "n_hits", (F.col("p") if model.trees is None else _curve(F.col("p"), *model.curve)).alias("score"))
    return s.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")


def _curve(p, xs: list[float], ys: list[float]):
    """The isotonic curve, linear between its steps; the step is found by
    counting the boundaries at or below ``p``."""
    if not xs:
        return p
    x, y = (F.array(*[F.lit(v) for v in c]) for c in (xs, ys))
    i = F.size(F.filter(x, lambda b: b <= p))
    x0, y0 = F.element_at(x, F.greatest(i, F.lit(1))), F.element_at(y, F.greatest(i, F.lit(1)))
    x1, y1 = F.element_at(x, F.least(i + 1, F.lit(len(xs)))), F.element_at(y, F.least(i + 1, F.lit(len(xs))))
    line = F.when((i == 0) | (x1 <= x0), y0).otherwise(y0 + (p - x0) * (y1 - y0) / (x1 - x0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), line))
