"""Stupid-backoff scores from n-gram counts of the whole corpus.

S(w | context) = c(context w) / c(context) where the n-gram was seen at least
``least`` times, else ``alpha`` times the score with one word less of context;
S(w) = c(w) / N at the end.  A document's score is the sum of log S over its
words.  Words are lower-cased (A-Z) runs outside white space; contexts do not
cross documents.

Relationally: count tables partitioned by n-gram hash are joined to the
n-grams of the documents, and the logs are summed per document.  At one row
per token the two shuffles of that join would weigh several times the corpus,
so the rows are packed: texts are held in batches (compressed, checkpointed,
so a batch keeps its identity when executors are lost); each batch sends its
distinct n-gram hashes with their counts to the hash parts, one row per (batch,
part); a part adds up the counts over all batches, which makes its slice of
the count table, and answers every batch row with the totals in the same order;
batch and answers meet again and the scores are summed per document.  Counts of
a frequent word arrive summed per batch, so no key is hot.

Edge cases: null, empty or blank texts have no words, a score of 0 and a null
mean; an empty table gives an empty result; repeated rows count as often as
they occur; extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, checkpointed, n_partitions
from .textblock import LOWER, blocks, lean, lean_group, lean_pair, mix, prefix_hash, span_hash, word_spans

_STEP = np.uint64(0xD6E8FEB86659FD93)


def ngrams(data: np.ndarray, offs: np.ndarray, order: int):
    """Per order 1..order: (hash, valid) at every word of a block; valid is
    False where the document has too few words before it.  Also the row of
    every word."""
    low = LOWER[data]
    start, end, row = word_spans(low, offs)
    w = mix(span_hash(prefix_hash(low), start, end) + (end - start).astype(np.uint64))
    out = [(mix(w + np.uint64(1)), np.ones(len(w), bool))]
    h = w
    for n in range(2, order + 1):
        # hash of the n words ending here: the n-1 words ending one before, then this
        nxt = np.zeros_like(w)
        nxt[1:] = mix(h[:-1] * _STEP + w[1:])
        ok = np.zeros(len(w), bool)
        ok[n - 1:] = row[n - 1:] == row[:len(row) - n + 1]
        out.append((mix(nxt + np.uint64(n)), ok))
        h = nxt
    return out, row


def distinct_ngrams(data, offs, order):
    """Sorted distinct n-gram hashes of all orders, their counts, and per
    order the index of each word's n-gram (-1: none)."""
    grams, row = ngrams(data, offs, order)
    every = np.concatenate([h[ok] for h, ok in grams])
    uniq, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    index, at = [], 0
    for h, ok in grams:
        i = np.full(len(h), -1, np.int64)
        n = int(ok.sum())
        i[ok] = inverse[at:at + n]
        at += n
        index.append(i)
    return uniq, counts, index, row


def backoff(index, totals, row, n_rows: int, n_words: float, alpha: float, least: int):
    """Sum of log scores per row, given the corpus count of each n-gram."""
    logs = np.log(totals.astype(np.float64))
    score = logs[index[0]] - np.log(n_words)
    for n in range(2, len(index) + 1):
        i = index[n - 1]
        seen = (i >= 0) & (totals[i] >= least)
        context = np.concatenate([[-1], index[n - 2][:-1]])
        direct = logs[i] - logs[context]
        # a position without this much context keeps the shorter score;
        # one whose n-gram is too rare pays alpha for it
        score = np.where(seen, direct, np.where(i >= 0, score + np.log(alpha), score))
    return np.bincount(row, score, n_rows)


def _squeeze(x: np.ndarray) -> bytes:
    """An ascending array of 64-bit numbers: differences, byte by byte place,
    compressed (hashes of one part leave the leading bytes near zero)."""
    import zstandard
    d = np.diff(x, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def _expand(b: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _hold(batches):
    """Rows of packed batches: ids and compressed texts of about 4 MB."""
    import zstandard
    from pyspark import TaskContext
    serial = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = batch.column("doc_id")
        for first, data, offs in blocks(batch.column("text"), 1 << 22):
            n = len(offs) - 1
            keys = ids.slice(first, n)
            yield pa.RecordBatch.from_arrays([
                pa.array([serial], pa.int64()), pa.array([keys.to_pylist()], pa.list_(pa.int64())),
                pa.array([offs.astype(np.int64).tobytes()], pa.binary()), pa.array([zstandard.ZstdCompressor(level=3).compress(data.tobytes())], pa.binary()),
                pa.array([len(word_spans(data, offs)[0])], pa.int64())], ["batch", "ids", "offs", "body", "words"])
            serial += 1


def _unpack(offs: bytes, body: bytes):
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8), np.frombuffer(offs, np.int64)


def _by_part(uniq: np.ndarray, parts: int):
    part = (uniq % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _ask(parts: int, order: int):
    def run(batches):
        for b in batches:
            for name, offs, body in zip(b.column("batch").to_pylist(), b.column("offs").to_pylist(), b.column("body").to_pylist()):
                uniq, counts, _, _ = distinct_ngrams(*_unpack(offs, body), order)
                o, cut = _by_part(uniq, parts)
                uniq, counts = uniq[o], counts[o].astype(np.uint32)
                full = np.flatnonzero(np.diff(cut))
                if len(full):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(full), name)), pa.array(full, pa.int32()),
                        pa.array([_squeeze(uniq[cut[i]:cut[i + 1]]) for i in full], pa.binary()),
                        pa.array([counts[cut[i]:cut[i + 1]].tobytes() for i in full], pa.binary())], ["batch", "part", "grams", "counts"])
    return run


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one hash part, for every batch in its own order."""
    import zlib
    grams = [_expand(x.as_py()) for x in table.column("grams")]
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")])
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")
    s = every[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    total = np.add.reduceat(counts[order].astype(np.uint64), first)
    each = np.empty(len(every), np.uint64)
    each[order] = np.repeat(total, np.diff(np.concatenate([first, [len(s)]])))
    cut = np.cumsum([0] + [len(g) for g in grams])
    small = each.max(initial=0) < 2 ** 32
    out = [zlib.compress(each[a:b].astype(np.uint32 if small else np.uint64).tobytes(), 1) for a, b in zip(cut[:-1], cut[1:])]
    return pa.table({"batch": table.column("batch"), "part": table.column("part"), "wide": pa.array([not small] * len(out)),
                     "totals": pa.array(out, pa.binary())})


def _score(parts: int, order: int, n_words: float, alpha: float, least: int):
    def run(mine: pa.Table, answers: pa.Table) -> pa.Table:
        import zlib
        got = {p: np.frombuffer(zlib.decompress(t), np.uint64 if wide else np.uint32)
               for p, wide, t in zip(*(answers.column(c).to_pylist() for c in ("part", "wide", "totals")))}
        ids, sums, words = [], [], []
        for keys, offs, body in zip(*(mine.column(c).to_pylist() for c in ("ids", "offs", "body"))):
            data, offs = _unpack(offs, body)
            uniq, _, index, row = distinct_ngrams(data, offs, order)
            o, cut = _by_part(uniq, parts)
            totals = np.ones(len(uniq) + 1, np.uint64)      # the last one answers index -1
            for p in np.flatnonzero(np.diff(cut)):
                totals[o[cut[p]:cut[p + 1]]] = got[int(p)]
            n = len(offs) - 1
            ids += keys
            words.append(np.bincount(row, minlength=n))
            sums.append(backoff(index, totals, row, n, n_words, alpha, least) if len(row) else np.zeros(n))
        none = [np.empty(0)]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(np.concatenate(words or none).astype(np.int64)),
                         "log_score": pa.array(np.concatenate(sums or none).astype(np.float64))})
    return run


def lm_scores(docs: DataFrame, order: int = 2, alpha: float = 0.4, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) for every document."""
    spark = docs.sparkSession
    held = checkpointed(as_text(docs, id_col, text_col).mapInArrow(lean(_hold), "batch long, ids array<long>, offs binary, body binary, words long"))
    n_words = held.agg(F.sum("words")).first()[0] or 1
    parts = 2 * n_partitions(spark)
    answers = (held.select("batch", "offs", "body").mapInArrow(lean(_ask(parts, order)), "batch long, part int, grams binary, counts binary")
               .groupBy("part").applyInArrow(lean_group(_answer), "batch long, part int, wide boolean, totals binary"))
    s = held.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lean_pair(_score(parts, order, float(n_words), alpha, least)), "doc_id long, n_words long, log_score double")
    return s.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
