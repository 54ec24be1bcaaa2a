import random

import numpy as np
import pytest

from attain.llm import html, licenses
from cases import awkward, frame, prose

PARTS = {
    "nav": '<nav><ul><li><a href="/a">{0}</a></li><li><a href="/b">{1}</a></li></ul></nav>',
    "menu": '<div class="top-menu"><a href="#">{0}</a> | <a href="#">{1}</a></div>',
    "ad": '<div class="ad">{0}</div>',
    "side": '<aside><h3>{0}</h3><p>{1}</p></aside>',
    "sidebar": '<div class="sidebar"><h3>{0}</h3><p>{1}</p></div>',
    "form": '<form action="/s"><label>{0}</label><input name="q"><button>Go</button></form>',
    "notice": '<div class="cookie-notice"><p>{0}</p></div>',
    "footer": "<footer>&copy; {0} &middot; {1}</footer>",
    "comments": '<section class="comments"><h2>{0}</h2><div class="comment"><p>{1}</p></div><div class="comment"><p>{2}</p></div></section>',
    "header": "<header><div>{0}</div><p>{1}</p></header>",
}


def page(rng, main="article"):
    def some():
        return prose(rng.randrange(10**6), rng.randint(3, 12))

    wanted = [prose(rng.randrange(10**6), 6)] + [prose(rng.randrange(10**6), rng.randint(15, 90)) for _ in range(rng.randint(2, 8))]
    body = f"<h1>{wanted[0]}</h1>" + "".join(f"<p>{p}</p>" for p in wanted[1:])
    inner = rng.random() < 0.3
    if inner:
        body = body.replace("</p>", "</p>" + PARTS["ad"].format(some()), 1)
    before = "".join(PARTS[k].format(some(), some(), some()) for k in rng.sample(["nav", "menu", "ad", "header", "notice", "form"], rng.randint(1, 3)))
    after = "".join(PARTS[k].format(some(), some(), some()) for k in rng.sample(["comments", "side", "sidebar", "form", "ad"], rng.randint(0, 2)))
    tag = main.split()[0]
    text = f"<!DOCTYPE html><html><head><title>{wanted[0]}</title><style>p{{}}</style></head><body>{before}<{main}>{body}</{tag}>{after}{PARTS['footer'].format(some(), some())}</body></html>"
    return text, "\n".join(wanted)


@pytest.fixture(scope="module")
def trees(spark):
    return html.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def read(spark, trees, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return [r["text"] for r in html.extract(rows, trees).orderBy("page_id").collect()]


def words(text):
    return set(text.split())


def test_copies_do_not_crowd_out_pages(spark):
    rng = random.Random(8)
    pages = spark.createDataFrame([(page(rng)[0],) for _ in range(12)], "html string")
    first = pages.limit(1).crossJoin(spark.range(20_000).select()).select("html")
    assert html.fit(pages.union(first)) is not None


@pytest.mark.parametrize("main", ["article", "main", 'div class="content"', 'div id="main-text"'])
def test_held_out_pages(spark, trees, main):
    """Pages of a layout that the trees were not fitted on, also without the article element."""
    rng = random.Random(5)
    pages = [page(rng, main) for _ in range(60)]
    got = read(spark, trees, [p for p, _ in pages])
    right = sum(g == w for g, (_, w) in zip(got, pages))
    overlap = np.mean([len(words(g) & words(w)) / max(1, len(words(g) | words(w))) for g, (_, w) in zip(got, pages)])
    assert overlap > 0.9 and (right >= 48 or main not in ("article", "main"))


def test_all_pages_of_the_table(spark, trees):
    import re
    from html import unescape

    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    for text, got in zip(pages, read(spark, trees, pages)):
        body = re.search(r"<article>(.*)</article>", text, re.S)[1].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert got == "\n".join(p for p in parts if p)


def test_awkward_pages(spark, trees):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    pages = [None, "", "no markup at all", "<p>open <b>never", "<![CDATA[x]]><p>after &lt;b&gt; &amp &am &#233;</p>", "</p></div></html>", "<script>var a='<p>x</p>'",
             deep, "<!-- <p>hidden</p> --><p>seen</p>", "<table><tr><td>a<td>b<tr><td>c</table>", "<" * 200, "\x00<p>\x00", "<article><p>" + prose(1, 40_000) + "</p></article>"]
    got = read(spark, trees, pages)
    assert got[0] == got[1] == "" and len(got) == len(pages)
    plain = read(spark, None, pages)
    assert plain[2] == "no markup at all" and plain[3] == "open never" and plain[5] == "" and plain[6] == "" and plain[7] == "deep"
    assert plain[4] == "after <b> & &am é" and plain[8] == "seen" and plain[9] == "a\nb\nc"
    assert plain[12] == prose(1, 40_000)


def test_columns_and_empty_table(spark, trees):
    rows = spark.createDataFrame([(1, "u", "<p>x</p>", "old", 5, None), (1, "u", "<p>x</p>", "old", 5, None)], "page_id long, url string, html string, text string, n_chars long, label string")
    out = html.extract(rows, trees)
    assert out.columns == ["page_id", "url", "label", "text", "n_chars"] and out.count() == 2
    assert html.extract(rows.limit(0), trees).count() == 0
    assert html.fit(rows.limit(0)) is None and html.fit(rows) is None


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = 9
        parents = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        logit = rng.normal(0, 2, n)
        kept = html.decode(parents, logit)
        assert all(kept[parents[i]] or not kept[i] for i in range(1, n))
        log_keep, log_drop = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
        best = max(sum(log_keep[i] if m >> i & 1 else log_drop[i] for i in range(n)) for m in range(1, 1 << n, 2)
                   if all(m >> parents[i] & 1 or not m >> i & 1 for i in range(1, n)))
        assert abs(best - sum(log_keep[i] if kept[i] else log_drop[i] for i in range(n))) < 1e-9


def test_trees_learn():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = html.boost(x[:2000], y[:2000], np.ones(2000))
    assert ((trees.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.97


# ---------------------------------------------------------------- licences

def test_spellings_of_one_licence(spark):
    mit = licenses.KNOWN[0][1]
    texts = [mit, mit.upper(), "Copyright (c) 2020 Someone\n" + mit, mit.replace(",", " ;"), mit.replace("\n", " "), "\n\n" + mit.replace(" ", "  "),
             mit.replace("License", "Licence").replace("sublicense", "sub-license") + "\nAll rights reserved.", mit + " extra", "text\nReleased under the MIT Licence!\nCopyright 2021 x\nLicensed under CC BY-NC 4.0"]
    rows = {r["doc_id"]: r for r in licenses.scan(frame(spark, list(enumerate(texts)))).collect()}
    assert [rows[i]["license_id"] for i in range(len(texts))] == ["MIT"] * 7 + [None] * 2
    assert rows[8]["notice_ids"] == "CC-BY-NC-4.0,MIT"


def test_full_texts_and_copyright_anywhere_in_a_line(spark):
    mit = licenses.KNOWN[0][1].removeprefix("MIT License\n\n")
    want = [("MIT", f"{c}\n\n{mit}") for c in ("Copyright Foo Inc. 2020", "Portions Copyright (c) 2020 X", "2020, copyright by Y", "Copyright (c) Z\nPortions copyright 2021 W")]
    want += [(k, "Copyright Foo Inc. 2020\n" + text) for k, text in licenses.KNOWN if len(text) > 400]
    assert {"BSD-2-Clause", "BSD-3-Clause", "Zlib", "Unlicense", "Apache-2.0", "MPL-2.0", "GPL-3.0-only", "CC0-1.0"} <= {k for k, _ in want}
    rows = {r["doc_id"]: r["license_id"] for r in licenses.scan(frame(spark, [(i, t) for i, (_, t) in enumerate(want)])).collect()}
    assert [rows[i] for i in range(len(want))] == [k for k, _ in want]


def test_awkward_texts_and_own_table(spark):
    known = spark.createDataFrame([("B", "one"), ("A", "ONE!"), ("C", None), ("D", "")], "license_id string, text string")
    rows = licenses.scan(frame(spark, awkward()), known).collect()
    assert len(rows) == len(awkward())
    assert {(r["doc_id"], r["license_id"]) for r in rows if r["license_id"]} == {(4, "A"), (5, "A")}
    assert licenses.scan(frame(spark, []).limit(0)).count() == 0
    assert licenses.scan(frame(spark, awkward()), known.limit(0)).where("license_id IS NOT NULL").count() == 0


def test_query_equals_its_sql(spark):
    from compare import connect

    from attain.llm import queries

    con = connect("/root/testdata/sf0.01")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, "/root/testdata/sf0.01")
        names = sorted(df.columns)
        want = [tuple(r) for r in con.execute(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()]
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.select(names).collect())


def test_text_of_inline_elements_and_unclosed_silent_ones(spark):
    pages = [("<p>area <math><mi>x</mi>=<mn>2</mn></math> of <object data='a'>a chart</object> it</p><noscript>shown without scripts</noscript>",
              "area x=2 of a chart it\nshown without scripts"),
             ("<div><p>one</p><svg><text>drawn</text><p>two</p></div><p>three</p>", "one\ntwo\nthree"),
             ("<div><p>one</p><div><select><option>pick</option></div><p>two</p></div>", "one\ntwo"),
             ("<div><template><div>no</div><p>no</p></template><p>yes</p></div>", "yes"),
             ("<div><svg><g><title>no</title></g></svg><p>yes</p></div>", "yes"),
             ("<ul><li><svg><path></li><li>next</li></ul>", "next")]
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(df, None).collect()}
    assert got == {i: wanted for i, (_, wanted) in enumerate(pages)}


def test_long_pages_train_and_are_read_whole(spark):
    body = "".join(f"<p>Paragraph number {i} of a very long article tells about places and people in some detail.</p>" for i in range(4000))
    pages = [(i, "u", f"<html><body><nav><ul><li><a href='x'>Home {i}</a></li></ul></nav><article>{body}<p>end {i}</p></article><footer>Legal {i}</footer></body></html>") for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert min(len(h) for _, _, h in pages) > 200_000
    trees = html.fit(df, sample_chars=900_000)
    assert trees is not None
    for r in html.extract(df, trees).collect():
        assert r["text"].count("\n") == 4000 and r["text"].endswith(f"end {r['page_id']}") and "Home" not in r["text"] and "Legal" not in r["text"]
