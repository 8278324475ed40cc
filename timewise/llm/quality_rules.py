"""Adaptive quality rules from mergeable quantile sketches.

Every text gets four measures: symbol share, repeated-line share, repeated
three-word-window share and mean word length.  Fixed cutoffs would suit one
language or source and fail the next, so the cutoffs come from the data: each
(lang, source) group, each lang and the whole table has a quantile sketch of
each measure, and a text fails where a measure lies beyond the fences
``quartile +- spread * max(interquartile range, floor)`` of its group.

The sketch is a histogram of counts over fixed integer bins: two sketches
merge by adding counts, so partial sketches combine map-side, a hot source
costs no more than a cold one, a lost executor changes nothing, and a quantile
is exact to the width of a bin (1/1000 of a share, 1/20 of a character).  It
holds at most 1001 bins a measure and group, whatever the number of texts.
A group below ``least`` texts borrows the fences of its language, and a
language below that those of the whole table.

All of it is DataFrame functions.  Texts are scanned once: the measures go to
the checkpoint folder, the sketches and the joined filtering read only those.

Edge cases: null text has no words; texts without words fail the base rule;
null lang or source are groups of their own; an empty table gives an empty
result; repeated rows count as often as they occur; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import checkpointed

SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
#: measure: (bins per unit, floor of the interquartile range in bins)
MEASURES = {"symbols": (1000, 15), "lines": (1000, 100), "repeats": (1000, 100), "length": (20, 12)}
TOP_BIN = 1000


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs outside space and 0x09-0x0D."""
    flat = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.when(flat == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(flat, " +"))


def with_repeat_words(t: DataFrame) -> DataFrame:
    """Adds n_repeat_words: how many words (column words) lie in 3-word
    windows that occur twice or more in the text.  The window hashes are sorted
    with their places; equal neighbours are repeats, and each start adds the
    places up to the next one, 3 at most.  Each step is a column of its own,
    as its lambda refers to the whole array of the step before."""
    keep = [c for c in t.columns if c != "words"]
    word = F.col("words")
    at = F.when(F.size(word) >= 3, F.transform(F.sequence(F.lit(0), F.size(word) - 3), lambda i: F.struct(
        F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)).alias("h"), i.alias("i"))))
    t = t.select(*keep, at.alias("at"))
    # most texts have no repeated window: a hash set tells without sorting
    t = t.select(*keep, F.when(F.size(F.array_distinct(F.col("at.h"))) < F.size("at"), F.sort_array("at")).alias("s"))
    s = F.col("s")
    again = F.filter(s, lambda x, k: F.get(s, k + 1)["h"].eqNullSafe(x["h"]) | ((k > 0) & F.get(s, k - 1)["h"].eqNullSafe(x["h"])))
    t = t.select(*keep, F.sort_array(F.transform(again, lambda x: x["i"])).alias("starts"))
    n = F.aggregate("starts", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                    lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
                    lambda acc: acc["n"])
    return t.select(*keep, F.coalesce(n, F.lit(0).cast("long")).alias("n_repeat_words"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The base counts of every text."""
    t = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                    F.col(f"`{source_col}`").cast("string").alias("source"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    t = t.select("doc_id", "lang", "source", words_of(text).alias("words"), lines.alias("lines"),
                 F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                 (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    t = t.select("doc_id", "lang", "source", "words", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.size("lines").cast("long").alias("n_lines"))
    return with_repeat_words(t)


def _bins() -> list[Column]:
    """The bin of each measure, in integer arithmetic."""
    w, c = F.greatest(F.lit(1), F.col("n_words")), F.greatest(F.lit(1), F.col("word_chars"))
    value = {"symbols": F.expr("n_symbols * 1000") / c, "lines": F.expr("n_dup_lines * 1000") / F.greatest(F.lit(1), F.col("n_lines")),
             "repeats": F.expr("n_repeat_words * 1000") / w}
    # mean word length: bins of 1/20 character up to 50 characters, of 2.5 beyond
    length = F.floor(F.expr("word_chars * 20") / w)
    length = F.when(length < TOP_BIN, length).otherwise(TOP_BIN + F.least(F.lit(TOP_BIN), F.floor((length - TOP_BIN) / 50)))
    return [F.least(F.lit(TOP_BIN), F.floor(v)).cast("long").alias(f"b_{k}") for k, v in value.items()] + [length.cast("long").alias("b_length")]


def fences(binned: DataFrame, spread: int = 4, least: int = 50) -> DataFrame:
    """(lang, source, measure, lo, hi): the fences of every group."""
    rows = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(f"b_{k}").alias("bin")) for k in MEASURES])
    cells = binned.select("lang", "source", F.inline(rows)).groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))

    def quartiles(level: list[str]) -> DataFrame:
        key = [*level, "measure"]
        merged = cells.groupBy(*key, "bin").agg(F.sum("n").alias("n"))
        up, all_ = W.partitionBy(*key).orderBy("bin").rowsBetween(W.unboundedPreceding, 0), W.partitionBy(*key)
        c = merged.withColumn("upto", F.sum("n").over(up)).withColumn("total", F.sum("n").over(all_))
        return (c.groupBy(*key).agg(F.max("total").alias("total"), F.min(F.when(F.expr("4 * upto >= total"), F.col("bin"))).alias("q1"),
                                    F.min(F.when(F.expr("4 * upto >= 3 * total"), F.col("bin"))).alias("q3")))

    group, lang, whole = quartiles(["lang", "source"]), quartiles(["lang"]), quartiles([])
    lang = lang.select(F.col("lang").alias("l_lang"), F.col("measure").alias("l_measure"), F.col("total").alias("l_total"),
                       F.col("q1").alias("l_q1"), F.col("q3").alias("l_q3"))
    whole = whole.select(F.col("measure").alias("w_measure"), F.col("q1").alias("w_q1"), F.col("q3").alias("w_q3"))
    j = (group.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure")))
         .join(whole, F.col("measure") == F.col("w_measure")))
    floor = F.create_map(*[x for k, (_, f) in MEASURES.items() for x in (F.lit(k), F.lit(f).cast("long"))])[F.col("measure")]

    def fence(p: str, sign: int) -> Column:
        width = F.lit(spread) * F.greatest(F.col(f"{p}q3") - F.col(f"{p}q1"), floor)
        out = F.col(f"{p}q3") + width if sign > 0 else F.col(f"{p}q1") - width
        return out if p == "w_" else F.when(F.col(f"{p}total") >= least, out)

    # the tightest of the levels that have enough rows: a group full of junk
    # has loose fences of its own
    levels = ("", "l_", "w_")
    return j.select("lang", "source", "measure", F.greatest(*[fence(p, -1) for p in levels]).alias("lo"), F.least(*[fence(p, 1) for p in levels]).alias("hi"))


def quality_filter(docs: DataFrame, spread: int = 4, least: int = 50, **columns: str) -> DataFrame:
    """The base counts, base_failed, failed (names of the rules a text
    breaks) and kept, for every document."""
    m = checkpointed(measured(docs, **columns).select("*", *_bins()))
    f = fences(m, spread, least)
    limits = f.groupBy(F.col("lang").alias("f_lang"), F.col("source").alias("f_source")).agg(
        *[F.max(F.when(F.col("measure") == k, F.col(c))).alias(f"{c}_{k}") for k in MEASURES for c in ("lo", "hi")])
    j = m.join(limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    base = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    rules = {**{k: F.col(f"b_{k}") > F.col(f"hi_{k}") for k in MEASURES}, "short_words": F.col("b_length") < F.col("lo_length")}
    failed = F.concat_ws(",", *[F.when(cond, F.lit(k)) for k, cond in rules.items()])
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                    failed.alias("failed"), (~base & (failed == "")).alias("kept"))
