"""Operators with SQL: DuckDB on the whole tables, and the edge cases."""
import pytest

from timewise.llm.decontaminate import contaminated
from timewise.llm.quality_rules import quality_filter
from timewise.llm.url_filter import judge

from .helpers import EDGES, documents, same_as_duckdb


@pytest.mark.parametrize("name", ["op1_quality_rules", "op6_lm_scoring", "op7_url_filter", "op8_minhash_containment"])
def test_duckdb(spark, sf, name):
    same_as_duckdb(spark, sf, name)


def repeat_words(text):
    w = text.split(" ")
    t = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {p for i, x in enumerate(t) if t.count(x) > 1 for p in (i, i + 1, i + 2)}
    return len(hit)


def test_quality_edges(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = EDGES + [(40, "a b c x a b c d a b c"), (41, "a a a a"), (42, "a b a b a"), (43, long)]
    got = {r.doc_id: r for r in quality_filter(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows[12:]:
        assert got[i].n_repeat_words == repeat_words(t)
    assert (got[1].n_words, got[1].base_failed, got[1].kept) == (0, True, False)
    assert (got[12].n_dup_lines, got[12].n_words) == (2, 4)
    assert got[11].n_repeat_words == 5000 and got[43].kept and not got[43].base_failed
    assert got[9].word_chars == 9
    assert quality_filter(documents(spark, [])).count() == 0
    nulls = documents(spark, rows).selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source")
    assert quality_filter(nulls).where("failed is null or kept is null").count() == 0


def test_containment(spark):
    items = spark.createDataFrame([(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "one two three"), (3, None), (4, ""), (5, "alpha"),
                                   (6, "Alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    filler = " ".join(f"w{i}" for i in range(4000))
    docs = documents(spark, EDGES + [(50, filler + " alpha, BETA gamma: delta epsilon zeta eta theta iota kappa " + filler),
                                     (51, "alpha beta gamma delta epsilon zeta eta theta iota"), (52, "alpha beta gamma delta epsilon x zeta eta theta iota kappa"),
                                     (53, "one two three"), (54, "one two three four")])
    got = {(r.doc_id, r.item_id): r.n_shared for r in contaminated(docs, items).collect()}
    assert got == {(50, 1): 6, (50, 6): 6, (51, 1): 5, (51, 6): 5, (53, 2): 1}
    assert contaminated(documents(spark, []), items).count() == 0
    assert contaminated(docs, items.where("false")).count() == 0
    shuffled = {(r.doc_id, r.item_id): r.n_shared for r in contaminated(docs, items, broadcast_rows=0).collect()}
    assert shuffled == got


def test_containment_of_repeated_rows(spark):
    """A row given twice counts its shingles once, on either side."""
    words = [f"w{i}" for i in range(24)]                    # 20 shingles
    item = (1, " ".join(words))
    halves = [(60, " ".join(words[:12])), (61, " ".join(words[:19]))]      # 8 and 15 of them
    whole = [(62, " ".join(words[:20])), (63, " ".join(words))]            # 16 and 20
    items = lambda rows: spark.createDataFrame(rows, "item_id long, text string")
    want = {(62, 1, 20, 16, 0.8), (63, 1, 20, 20, 1.0)}
    for docs in (halves + whole, 2 * (halves + whole)):
        for its in ([item], [item, item]):
            got = contaminated(documents(spark, docs), items(its)).collect()
            assert len(got) == 2 and {tuple(r) for r in got} == want
    # two texts of one id are one set, for documents and for items
    parts = [(70, " ".join(words[:12])), (70, " ".join(words[8:]))]
    assert [tuple(r) for r in contaminated(documents(spark, parts), items([item])).collect()] == [(70, 1, 20, 20, 1.0)]
    assert [tuple(r) for r in contaminated(documents(spark, whole), items([(1, t) for _, t in parts])).collect() if r.doc_id == 63] == [(63, 1, 20, 20, 1.0)]


def test_urls(spark):
    page = '<html><head>{}</head></html>'
    rows = [(1, "http://Bad.example.org/es/x", None), (2, "https://a.example.org/en/1", ""), (3, "http://x.org/fr", page),
            (4, "http://y.com/de/1", page.format('<link rel="canonical" href="http://alias.net/1">')), (5, "http://alias.net/1", page),
            (6, "http://two.net/a#f", page.format("<meta http-equiv='refresh' content='0; url=http://alias.net/1'>")),
            (7, "http://ok.net/?q", page.format("<LINK HREF='//z.com/fr/' REL=canonical>")), (8, "http://ok.net/?q#other", page), (9, None, page),
            (10, "no-scheme/es/", page), (11, "http:///es/", page), (12, "http://a.b?x=://c/de/", page), (13, "http://notorg/", page),
            (14, "http://three.net/", page.format('<link rel="canonical" href="http://ok.net/?q"><meta http-equiv=refresh content="1;URL=http://y.com/de/1">')),
            (5, "http://alias.net/1", page)]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(df.where("page_id < 14"), rules).collect()}
    assert got[1] == ("bad.example.org", "/es/x", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3] == ("x.org", "/fr", "org/", "allow") and got[4][2:] == ("com/de/", "block")
    assert got[5][2:] == (None, "block") and got[6] == ("two.net", "/a", None, "block")
    assert got[7] == ("ok.net", "/", None, "allow") and got[8][3] == "allow"
    assert got[9] == got[10] == ("", "", None, "allow") and got[11] == ("", "/es/", None, "allow")
    assert got[12] == ("a.b", "", None, "allow") and got[13][2] is None
    # page 14 ties both classes together: the allowed alias has precedence,
    # a page's own rule still comes first
    both = {r.page_id: r.verdict for r in judge(df, rules).collect()}
    assert (both[4], both[5], both[6], both[14]) == ("block", "allow", "allow", "allow")
    assert judge(df, rules).count() == len(rows) and judge(df.where("false"), rules).count() == 0
