"""The registered queries of this package and their DuckDB SQL.

One query per operator, with production parameters over whole tables.
Where SQL cannot express an operator (tokenizers, fitted models, byte windows)
there is no oracle; tests/llm holds it against brute force, an exact round
trip or held-out accuracy instead.
"""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression_classifier, toxicity
from .common import shared_folder, table
from .conversation_repair import damage, repair
from .decontaminate import contaminated
from .hard_negatives import mine
from .lm_scoring import lm_scores
from .packing import pack
from .parity_join import near_duplicates
from .quality_rules import MEASURES, quality_filter
from .suffix_dedup import PASSAGE, covered, remove_repeats
from .token_counts import byte_sections, section_tokens
from .url_filter import judge
from .warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return deco


WORD = r"[^\x20\x09-\x0D]+"
A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, source, text, regexp_extract_all(text, '{WORD}') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
tok AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
tri AS (SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS t
        FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri WHERE t IS NOT NULL) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, least(1000, n_symbols * 1000 // greatest(1, word_chars)) AS symbols, least(1000, n_dup_lines * 1000 // greatest(1, n_lines)) AS lines,
             least(1000, n_repeat_words * 1000 // greatest(1, n_words)) AS repeats, CASE WHEN word_chars * 20 // greatest(1, n_words) < 1000 THEN word_chars * 20 // greatest(1, n_words)
                       ELSE 1000 + least(1000, (word_chars * 20 // greatest(1, n_words) - 1000) // 50) END AS length FROM m),
cells AS (SELECT lang, source, 'symbols' AS measure, symbols AS bin FROM b UNION ALL SELECT lang, source, 'lines', lines FROM b
          UNION ALL SELECT lang, source, 'repeats', repeats FROM b UNION ALL SELECT lang, source, 'length', length FROM b),
g AS (SELECT lang, source, measure, count(*) AS total, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3 FROM cells GROUP BY ALL),
l AS (SELECT lang, measure, count(*) AS total, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3 FROM cells GROUP BY ALL),
a AS (SELECT measure, quantile_disc(bin, 0.25) AS q1, quantile_disc(bin, 0.75) AS q3 FROM cells GROUP BY ALL),
q AS (SELECT g.lang, g.source, g.measure, g.total, g.q1, g.q3, l.total AS lt, l.q1 AS l1, l.q3 AS l3, a.q1 AS a1, a.q3 AS a3,
             CASE g.measure {" ".join(f"WHEN '{k}' THEN {f}" for k, (_, f) in MEASURES.items())} END AS floor
      FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang AND g.measure = l.measure JOIN a ON g.measure = a.measure),
f AS (SELECT lang, source, measure,
             greatest(CASE WHEN total >= 50 THEN q1 - 4 * greatest(q3 - q1, floor) END, CASE WHEN lt >= 50 THEN l1 - 4 * greatest(l3 - l1, floor) END, a1 - 4 * greatest(a3 - a1, floor)) AS lo,
             least(CASE WHEN total >= 50 THEN q3 + 4 * greatest(q3 - q1, floor) END, CASE WHEN lt >= 50 THEN l3 + 4 * greatest(l3 - l1, floor) END, a3 + 4 * greatest(a3 - a1, floor)) AS hi FROM q),
p AS (SELECT lang, source, max(hi) FILTER (measure = 'symbols') AS symbols, max(hi) FILTER (measure = 'lines') AS lines,
             max(hi) FILTER (measure = 'repeats') AS repeats, max(hi) FILTER (measure = 'length') AS length, max(lo) FILTER (measure = 'length') AS low
      FROM f GROUP BY ALL),
v AS (SELECT b.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             concat_ws(',', CASE WHEN b.symbols > p.symbols THEN 'symbols' END, CASE WHEN b.lines > p.lines THEN 'lines' END,
                       CASE WHEN b.repeats > p.repeats THEN 'repeats' END, CASE WHEN b.length > p.length THEN 'length' END,
                       CASE WHEN b.length < p.low THEN 'short_words' END) AS failed
      FROM b JOIN p ON b.lang IS NOT DISTINCT FROM p.lang AND b.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed, NOT base_failed AND failed = '' AS kept FROM v
"""


@query(_QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and adaptive verdict of every document."""
    return quality_filter(table(spark, sf_dir, "documents"))


@query()
def op2_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 ids."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op3_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = compression_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return compression_classifier.score(docs, model)


@query()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without its repeated 400-byte strings,
    and how much of it lies in shorter repeated passages too."""
    return remove_repeats(table(spark, sf_dir, "documents"), passage=PASSAGE).select(
        "doc_id", "n_bytes", covered("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


_LM_SQL = rf"""
WITH tok AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
             FROM (SELECT doc_id, regexp_extract_all(translate(text, {A_Z}), '{WORD}') AS ws FROM documents)),
pre AS (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM tok),
c1 AS (SELECT w, count(*) AS n FROM tok GROUP BY w),
c2 AS (SELECT p, w, count(*) AS n FROM pre WHERE p IS NOT NULL GROUP BY p, w),
s AS (SELECT pre.doc_id, CASE WHEN c2.n >= 2 THEN ln(c2.n) - ln(cp.n) WHEN pre.p IS NULL THEN ln(c1.n) - ln((SELECT sum(n) FROM c1))
                              ELSE ln(0.4) + ln(c1.n) - ln((SELECT sum(n) FROM c1)) END AS x
      FROM pre JOIN c1 ON c1.w = pre.w LEFT JOIN c1 cp ON cp.w = pre.p LEFT JOIN c2 ON c2.p = pre.p AND c2.w = pre.w)
SELECT d.doc_id, count(s.x) AS n_words, round(coalesce(sum(s.x), 0), 3) AS log_score, round(sum(s.x) / nullif(count(s.x), 0), 4) AS mean_log_score
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query(_LM_SQL)
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the corpus's own bigrams."""
    s = lm_scores(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 4).alias("mean_log_score"))


#: The rules of op7: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

_URL = rf"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {A_Z})"
_PATH = r"regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _rule_sql(rows: str, keys: str) -> str:
    return (f"SELECT {keys}, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS rule_verdict "
            f"FROM {rows} x JOIN r ON (r.host = x.host OR ends_with(x.host, '.' || r.host)) AND starts_with(x.path, r.path) GROUP BY {keys}")


_URL_SQL = rf"""
WITH RECURSIVE r(host, path, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
pg AS (SELECT row_number() OVER () AS rn, page_id, html, url, coalesce({_URL}, '') AS host, coalesce({_PATH}, '') AS path,
              CASE WHEN contains(url, '://') THEN {_URL} || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS address FROM pages),
own AS ({_rule_sql("pg", "x.rn")}),
lk AS (SELECT address AS a, host, unnest([regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
              regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh[^>]*\bcontent\s*=\s*["'']?[^"''>]*?url\s*=\s*([^"''\s>]+)', 1)]) AS url
       FROM pg WHERE address IS NOT NULL),
ab AS (SELECT a, CASE WHEN starts_with(url, '//') THEN 'http:' || url WHEN starts_with(url, '/') THEN 'http://' || host || url ELSE url END AS url FROM lk WHERE url <> ''),
e AS (SELECT DISTINCT a, {_URL} || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b FROM ab WHERE contains(url, '://')),
e2 AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM e2 UNION SELECT b, b FROM e2 UNION SELECT reach.a, e2.b FROM reach JOIN e2 ON reach.b = e2.a),
comp AS (SELECT a AS node, min(b) AS c FROM reach GROUP BY a),
nd AS (SELECT node, c, regexp_extract(node, '^([^/?#]*)', 1) AS host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS path FROM comp),
nr AS ({_rule_sql("nd", "x.node, x.c")}),
says AS (SELECT c, bool_or(rule_verdict = 'allow') AS al, bool_or(rule_verdict = 'block') AS bl FROM nr GROUP BY c)
SELECT pg.page_id, pg.host, pg.path, own.rule, coalesce(own.rule_verdict, CASE WHEN says.al THEN 'allow' WHEN says.bl THEN 'block' END, 'allow') AS verdict,
       comp.c AS alias_class
FROM pg LEFT JOIN own ON own.rn = pg.rn LEFT JOIN comp ON comp.node = pg.address LEFT JOIN says ON says.c = comp.c
"""


@query(_URL_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    return judge(table(spark, sf_dir, "pages"), RULES)


_LEAK_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM dw WHERE len(ws) > 0)),
s AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM iw WHERE len(ws) > 0)),
n AS (SELECT item_id, count(*) AS n FROM s GROUP BY item_id),
j AS (SELECT doc_id, item_id, count(*) AS m FROM ds JOIN s USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item, m AS n_shared, round(m / n, 6) AS containment FROM j JOIN n USING (item_id) WHERE 100 * m >= 80 * n
"""


@query(_LEAK_SQL)
def op8_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, test item) pairs in which the document holds the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every 1000 bytes of every document; tokens cross their ends."""
    return section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          sections=byte_sections(1000))


_NEAR_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * m >= 80 * (na.n + nb.n - m)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM w JOIN reach ON reach.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""


@query(_NEAR_SQL)
def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at Jaccard 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def _repair_sql() -> str:
    """Least (cost, audit) by state, folded over the rows of a conversation."""
    put = lambda q, c, letter, x: f"{{'c': {q}.c + {c}, 't': {q}.t || '{letter}', 'x': {x}}}"      # noqa: E731
    far = "{'c': 1000000000, 't': '', 'x': []::VARCHAR[]}"
    gone = lambda q: put(f"p.{q}", 3, "D", f"p.{q}.x")                                             # noqa: E731
    stay = "CASE WHEN r.trunc THEN 1 ELSE 0 END"
    keep = lambda q, i: f"CASE WHEN r.ini = '{i}' AND NOT r.must THEN {put(f'p.{q}', stay, 'K', f'list_append(p.{q}.x, r.line)')} ELSE {far} END"
    as_role = lambda q, role: (f"CASE WHEN r.must THEN {far} ELSE "                                 # noqa: E731
                               + put(f"p.{q}", f"2 + {stay}", "R", f"list_append(p.{q}.x, '{role}:' || r.text)") + " END")
    add = lambda q, role: put(q, 2, "I", f"list_append({q}.x, '{role}:')")                          # noqa: E731
    step = (f"{{'z': {gone('z')}, 's': least({gone('s')}, {keep('z', 's')}), "
            f"'u': least({gone('u')}, {', '.join(keep(q, 'u') + ', ' + as_role(q, 'user') for q in 'zsa')}), "
            f"'a': least({gone('a')}, {keep('u', 'a')}, {as_role('u', 'assistant')})}}")
    user = f"list_transform([{step}], lambda m: {{'z': m.z, 's': m.s, 'u': least(m.u, {add('m.z', 'user')}, {add('m.s', 'user')}, {add('m.a', 'user')}), 'a': m.a}})[1]"
    both = f"list_transform([{user}], lambda w: {{'z': w.z, 's': w.s, 'u': w.u, 'a': least(w.a, {add('w.u', 'assistant')})}})[1]"
    begin = (f"{{'z': {{'c': 0, 't': '', 'x': []::VARCHAR[]}}, 's': {far}, 'u': {{'c': 2, 't': 'I', 'x': ['user:']}}, "
             "'a': {'c': 4, 't': 'II', 'x': ['user:', 'assistant:']}}")
    return rf"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                                                                  lambda x: ascii(x)::BIGINT)),
                                         lambda a, b: xor(tab[1 + (xor(a, b) & 255)], a >> 8))) % 20 AS h FROM conversations, t),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS k
      FROM c WHERE h <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, k) AS i FROM d),
f AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM n),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
             count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated, count(*) FILTER (i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal,
             list({{'ini': ini, 'text': text, 'line': role || ':' || text, 'must': blank OR again, 'trunc': cut AND NOT again AND NOT blank}} ORDER BY i) AS rows FROM f GROUP BY conv_id),
e AS (SELECT *, list_reduce(rows, lambda p, r: {both}, {begin}) AS v FROM g),
b AS (SELECT *, least(v.z, v.a) AS best FROM e)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.t, '') AS audit, sha256(coalesce(array_to_string(best.x, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""


@query(_repair_sql())
def op11_path_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least repair of every damaged conversation."""
    return repair(damage(table(spark, sf_dir, "conversations")))


_MINE_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS s FROM e a JOIN e b ON a.vec_id % 100 = 0),
p AS (SELECT a, b, s FROM s WHERE same AND a <> b QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a, p.b AS p, s.b AS n, p.s AS ps, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.s <= 100 * s.s AND 100 * s.s <= 100 * p.s)
SELECT a AS anchor_id, p AS positive_id, r::INT AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= 5
"""


@query(_MINE_SQL)
def op12_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("id") % 100 == 0)


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS least FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4)::INT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM h
"""


@query(_WARC_SQL)
def op13_zstd_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page, written to archives and read back."""
    folder = shared_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, payloads=False).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline (fitted models, byte windows and a tokenizer:
    no SQL).  The script at the repository top is imported when it is asked
    for, so the other queries do not depend on it."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
