"""Quality classifier from compressed sizes.

Two zstandard dictionaries are trained, one on good and one on bad labelled
texts.  A text like the good ones compresses better with the good dictionary:
``(size with bad - size with good) / bytes`` is the normalised difference.  A
logistic curve over it, fitted on labelled rows that trained no dictionary,
gives a score that reads as a probability.

The fit sees a bounded sample (``max_rows`` labelled rows by hash of the id,
one half for the curve; of the other half ``dictionary_rows`` whole texts a
class feed the dictionary, in consecutive pieces of ``sample_bytes``); every
document is then scored on its whole text in one scan without a shuffle.  The two dictionaries (at most ``dictionary_bytes`` each)
and two coefficients are the model.

Edge cases: null or empty text has a difference of 0; without labelled rows of
both classes every score is the share of good rows (0.5 without any); an empty
table gives an empty result; repeated rows score alike; extra columns are
ignored.  The score is clamped to [0, 1] by construction.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_text, checkpointed
from .labels import fold, learning_rows
from .textblock import lean


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    level: int
    slope: float
    offset: float

    def compressors(self):
        import zstandard as zstd
        return [zstd.ZstdCompressor(level=self.level, dict_data=zstd.ZstdCompressionDict(d), write_content_size=False,
                                    write_dict_id=False) for d in (self.good, self.bad)]

    def differences(self, texts) -> np.ndarray:
        """Normalised compressed-size difference of each text (bytes)."""
        if not self.good:
            return np.zeros(len(texts))
        good, bad = self.compressors()
        return np.array([(len(bad.compress(t)) - len(good.compress(t))) / len(t) if t else 0.0 for t in texts])

    def scores(self, texts) -> np.ndarray:
        z = np.clip(self.slope * self.differences(texts) + self.offset, -60, 60)
        return 1 / (1 + np.exp(-z))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic curve (Newton steps, a
    little ridge so that separable rows stay finite)."""
    scale = max(float(np.std(x)), 1e-9)
    a = np.stack([x / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        g = a.T @ (y - p) - 1e-2 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held_out: int = 1, id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = 6000, dictionary_rows: int = 500, sample_bytes: int = 8192,
        dictionary_bytes: int = 32768, level: int = 3) -> CompressionModel:
    import zstandard as zstd
    chosen = learning_rows(labels, label, folds, held_out, max_rows)
    # one half of the rows feeds the dictionaries, the other the curve
    chosen = chosen.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)))
    rank = F.row_number().over(W.partitionBy("y", "half").orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id"))
    chosen = checkpointed(chosen.withColumn("rank", rank))
    rows = as_text(docs, id_col, text_col).join(chosen, "doc_id")
    samples = (rows.where((F.col("half") == 0) & (F.col("rank") <= dictionary_rows))
               .select("doc_id", "y", F.col("text").cast("binary").alias("body"))
               .where(F.octet_length("body") > 0).collect())
    share = None
    if samples:
        samples.sort(key=lambda r: (r["doc_id"], bytes(r["body"])))
        share = sum(r["y"] for r in samples) / len(samples)
    # a dictionary keeps parts of its samples: a long text is several of them
    sides = {y: [bytes(r["body"][i:i + sample_bytes]) for r in samples if r["y"] == y for i in range(0, len(r["body"]), sample_bytes)]
             for y in (0, 1)}
    prior = CompressionModel(b"", b"", level, 0.0, 0.0 if share is None else float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    if not sides[0] or not sides[1]:
        return prior
    try:
        good, bad = (zstd.train_dictionary(dictionary_bytes, s).as_bytes() for s in (sides[1], sides[0]))
    except zstd.ZstdError:      # too few or too short samples to train on
        return prior
    model = CompressionModel(good, bad, level, 1.0, 0.0)

    def measure(batches):
        for batch in batches:
            x = model.differences([t.as_py().encode() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([pa.array(x), batch.column("y")], ["x", "y"])

    points = rows.where("half = 1").select("text", "y").mapInArrow(lean(measure), "x double, y int").collect()
    y = np.array([r["y"] for r in points], float)
    x = np.array([r["x"] for r in points])
    if len(set(y)) < 2:         # too few rows for a curve of their own
        y = np.array([r["y"] for r in samples], float)
        x = model.differences([bytes(r["body"]) for r in samples])
    model.slope, model.offset = logistic(x, y)
    return model


def score(docs: DataFrame, model: CompressionModel, folds: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, difference) for every document."""
    def run(batches):
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column("text")]
            d = model.differences(texts)
            z = np.clip(model.slope * d + model.offset, -60, 60)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-z))), pa.array(d)], ["doc_id", "score", "difference"])

    s = as_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, score double, difference double")
    return s.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "difference")
