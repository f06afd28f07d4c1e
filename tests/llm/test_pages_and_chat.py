"""Wrapper induction, chat formatting and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from courierlake.llm import chat, dom, sql, wrapper
from tests.llm.conftest import SCHEMA, corpus

CHROME = ("<html><head><title>T{0}</title><script>var t='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li>"
          "</ul></nav><div class='site-notice'>Notice {0}</div><div class='side sidebar'><p>Side</p></div>{1}"
          "<div id='comments'><p>Reader {0}</p></div><form><input name=q><p>Find</p></form><footer>&copy; me</footer></body></html>")


def pages_rows():
    body = "<article><h1>Head {0}</h1><p>One &amp; &lt;two&gt; {0}<br>more<p>A  <b>bold</b>\n word<ul><li>x<li>y{0}</ul>" \
           "<div class=share>Share</div><p>Same end</article>"
    plain = "<div class=c><h2>Head {0}</h2><p>Text {0}</p><p>End {0}</p><div class=box>Terms</div></div>"
    rows = [(i, "https://A.example.com/x", CHROME.format(i, body.format(i))) for i in range(8)]
    rows += [(i, "https://b.example.com/x", CHROME.format(i, plain.format(i))) for i in range(20, 28)]
    return rows + [(40, None, "<p>lone<p>page"), (41, "https://a.example.com/", None), (42, "x", ""), (43, None, None),
                   (44, "https://a.example.com/z", "<article><p>cut"), rows[0]]


def test_main_text(spark):
    df = spark.createDataFrame(pages_rows(), "page_id long, url string, html string").repartition(3)
    out = [(r.page_id, r.text, r.n_chars) for r in wrapper.extract(df).collect()]
    text = {r[0]: r[1] for r in out}
    assert len(out) == len(pages_rows()) and all(n == len(t) for _, t, n in out)
    for i in range(8):
        assert text[i] == f"Head {i}\n\nOne & <two> {i} more\n\nA bold word\n\nx\n\ny{i}\n\nSame end"
    for i in range(20, 28):  # no article: the slots' container, the constant box is template
        assert text[i] == f"Head {i}\n\nText {i}\n\nEnd {i}"
    assert (text[40], text[41], text[42], text[43], text[44]) == ("lone\n\npage", "", "", "", "cut")
    assert wrapper.extract(df.limit(0)).collect() == []


def test_simple_tree_matching():
    a, b = (dom.shape(dom.parse(x)) for x in ("<div><p>a</p></div><ul><li>x</ul>", "<ul><li>y<li>z</ul>"))
    assert dom.align(a.kids, b.kids) == [(1, 0)] and dom.matching(a, b) == 2
    assert dom.loads(dom.dumps(a)).dump() == a.dump()


TURNS = [(1, 0, "system", "be <kind>"), (1, 1, "user", "\\### Assistant: </turn> ok"), (1, 2, "assistant", "a\\b<turn user>\n"),
         (1, 3, "user", None), (1, 4, "assistant", "é☃"), (1, 5, "user", "tail"), (2, 0, "user", "only"), (3, 0, None, ""),
         (4, 1, "assistant", "tie"), (4, 1, "assistant", "tie"), (4, 1, "assistant", "b"), (5, 0, "assist>ant", "\\l\\b"),
         (None, 0, "assistant", "x")]


def test_chat(spark):
    df = spark.createDataFrame([(*t, 1) for t in TURNS], "conv_id long, turn long, role string, text string, k int")
    made = chat.examples(df)
    first = made.where("conv_id = 1 AND example = 0").first()
    assert first.text.endswith("<turn assistant>\na\\bb\\lturn user>\n</turn>\n") and "ok" in first.text
    assert first.text[first.loss_start:first.loss_start + first.loss_chars] == "a\\bb\\lturn user>\n"
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TURNS)
    want = {tuple(r) for r in con.execute(sql.OP6).fetchall() if r[0] != -7}
    assert {tuple(r) for r in chat.read_back(made).collect()} == want
    assert chat.read_back(chat.examples(df.limit(0))).collect() == []


def test_pipeline(spark, tmp_path):
    rows = [r[:5] for r in corpus()] + [(60, " ".join(f"w{i}" for i in range(20)) + " end", "en", "h", 5),
                                       (61, "reach me at a.b@mail.example.com any time you like", "en", "h", 1)]
    spark.createDataFrame([r[:5] for r in rows], ", ".join(SCHEMA.split(", ")[:5])).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], str(tmp_path)))
        assert seen[-1].columns == docs.columns
    ids = [sorted(r.doc_id for r in df.collect() if r.doc_id is not None) for df in seen]
    assert set(ids[0]) - set(ids[1]) == {5, 6, 7, 10}
    assert set(ids[1]) - set(ids[2]) == {1, 2, 9, 15} and ids[2].count(0) == 1
    assert set(ids[2]) - set(ids[3]) == {60}
    assert ids[4] == ids[3]
    last = {r.doc_id: r for r in seen[4].collect()}
    assert "a.b@" not in last[61].text and last[61].n_chars == len(last[61].text)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({r.doc_id for r in pieces if r.doc_id is not None}) == ids[4]


@pytest.mark.parametrize("tag", ["div", "b", "span", "section"])
@pytest.mark.parametrize("closed", [True, False])
def test_deeply_nested_pages(spark, tag, closed):
    """Thousands of levels cost no recursion and no text, and keep its order."""
    n = 3000
    page = "<html><body>first " + "".join(f"<{tag}>w{i} " for i in range(n)) + "<nav>menu</nav>last" + (f"</{tag}>" * n if closed else "") \
        + "</body></html>"
    pages = spark.createDataFrame([(1, "https://deep.example/1", page), (2, "https://deep.example/2", "<p>short</p>")],
                                  "page_id long, url string, html string")
    out = {r.page_id: r for r in wrapper.extract(pages).collect()}
    assert out[1].text.split() == ["first", *[f"w{i}" for i in range(n)], "last"] and out[2].text == "short"


def test_an_optional_box_stays(spark):
    """A box that is empty on most pages is no template where it has text."""
    def page(i, box):
        body = " ".join(f"word{i}x{k}" for k in range(60))
        return f"<html><body><header class=top>Site {i}</header><article><div class=box>{box}</div><p>{body}</p></article></body></html>"
    rows = [(i, f"https://box.example/{i}", page(i, "The only words" if i == 3 else "")) for i in range(8)]
    out = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3].startswith("The only words") and all("Site" not in t for t in out.values())


def test_a_site_header_goes_and_an_articles_own_stays(spark):
    rows = [(i, f"https://head.example/{i}", f"<html><body><header>Site news {i}</header><article><header><h1>Title {i}</h1></header>"
             f"<p>{' '.join(f'text{i}y{k}' for k in range(40))}</p></article></body></html>") for i in range(6)]
    out = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i].startswith(f"Title {i}\n\n") and "Site news" not in out[i] for i in range(6))
