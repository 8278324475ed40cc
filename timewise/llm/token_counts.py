"""Token counts of sections, from one encoding of the whole document.

A document is encoded once.  The byte spans of its tokens follow from the
tokens' byte lengths, as the tokens of a byte-level vocabulary spell the text
without gaps.  Sections are byte ranges that cover the document; tokens are
interval-joined to them by binary search.  Encoding each section alone would
give other counts, as tokens may cross a boundary.

A token that crosses a boundary is allocated by an explicit rule:
``first``  to the section of its first byte;
``most``   to the section with most of its bytes, the earlier one on a tie;
``last``   to the section of its last byte.
So the counts of a document's sections always add up to its token count.

Edge cases: null or empty text is one empty section without tokens; blank
sections keep their row; an empty table gives an empty result; repeated rows
are counted each; extra columns are ignored.
"""
from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_text
from .textblock import blocks, lean

RULES = ("first", "most", "last")


class ByteEncoder:
    """Token ids and byte lengths of texts under a byte-level rank file."""

    def __init__(self, path: str, pattern: str):
        import base64
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = [len(t) for t in ranks]

    def ends(self, text: str) -> np.ndarray:
        """End byte of every token."""
        return np.cumsum(self.length[self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int64)])


def encoder(path: str, pattern: str) -> ByteEncoder:
    kept = sys.__dict__.setdefault("_timewise_encoders", {})
    if (path, pattern) not in kept:
        kept[path, pattern] = ByteEncoder(path, pattern)
    return kept[path, pattern]


def line_sections(data: np.ndarray) -> np.ndarray:
    """Ends of the lines of a text; a line keeps its line feed."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def byte_sections(size: int):
    """Sections of ``size`` bytes (the last one what is left); they cut
    through words and characters."""
    def ends(data: np.ndarray) -> np.ndarray:
        return np.append(np.arange(size, len(data), size), len(data))
    return ends


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether it crosses a boundary."""
    start = np.concatenate([[0], token_ends])[:-1].astype(np.int64)
    a = np.searchsorted(section_ends, start, "right")
    b = np.searchsorted(section_ends, token_ends - 1, "right")
    to = {"first": a, "last": b}.get(rule)
    if to is None:
        to = a.copy()
        for i in np.flatnonzero(a != b):
            edge = np.concatenate([[start[i]], section_ends[a[i]:b[i]], [token_ends[i]]])
            to[i] = a[i] + int(np.argmax(np.diff(edge)))
    return to, a != b


def section_tokens(docs: DataFrame, vocabulary: str, pattern: str, rule: str = "most", sections=line_sections,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing, doc_tokens): one
    row per section; start and end are bytes, n_crossing counts the tokens of
    the section that also cover bytes of another.  ``sections`` maps the
    bytes of a text to the ascending ends of its sections, the last one being
    the length of the text."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")

    def run(batches):
        enc = encoder(vocabulary, pattern)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for first, data, offs in blocks(texts):
                cols = [[] for _ in range(7)]
                for i in range(len(offs) - 1):
                    body = data[offs[i]:offs[i + 1]]
                    cut = sections(body)
                    ends = enc.ends(texts[first + i].as_py()) if len(body) else np.empty(0, np.int64)
                    to, cross = allocate(ends, cut, rule)
                    n = len(cut)
                    values = (np.full(n, first + i), np.arange(n),
                              np.concatenate([[0], cut[:-1]]), cut, np.bincount(to, minlength=n),
                              np.bincount(to[cross], minlength=n), np.full(n, len(ends)))
                    for c, v in zip(cols, values):
                        c.append(v)
                cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in cols]
                yield pa.RecordBatch.from_arrays([ids.take(cols[0]), *cols[1:]],
                                                 ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    return as_text(docs, id_col, text_col).mapInArrow(
        lean(run), "doc_id long, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long")
