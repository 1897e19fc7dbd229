import html
import re
import tracemalloc

import cases
from skylattice.llm import html_extract as he
from skylattice.llm.queries import QUERIES

PROSE = "Running text of some length, with several words and marks, that an article would hold. " * 4


def text_of(source):
    page = he.parse(source)
    key = he.best_key(he.container_scores(page), page)
    return he.text_at(page, key) if key is not None else ""


def by_patterns(source):
    """The same for the template of the test pages, by patterns alone."""
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1].replace("<br>", " ")
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(x for x in parts if x)


def test_every_test_page(spark):
    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = QUERIES["op5_html_extraction"](spark, d).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == by_patterns(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url and r.path == "/html/body/article"


def test_templates_with_classes():
    source = f"""<html><body><div id="top" class="site-header">Name</div><div class="menu"><ul><li><a href=x>Home</a>
    <li><a href=y>News</a></ul></div><div class="post post-812"><h2>Title &amp; more</h2><p>{PROSE}<p>{PROSE}&nbsp;<b>bold
    end</b><ul><li>One<li>Two</ul><div class="share">Share this</div><aside>Side</aside><form>Mail <input></form></div>
    <div id="comments"><p>{PROSE}{PROSE}{PROSE}</div><div class="cookie-notice">We use cookies</div></body></html>"""
    one = PROSE.strip()
    assert text_of(source) == f"Title & more\n\n{one}\n\n{one} bold end\n\nOne\n\nTwo"


def test_wrappers_with_marks_keep_their_article():
    one = PROSE.strip()
    body = f"<div class='story'><p>{PROSE}</p><p>{PROSE}</p></div><div class='share'>Share this</div>"
    wrappers = "content has-sidebar|no-sidebar|with-sidebar|page-header-fixed|post category-legal|category-social|search-result-page"
    for name in wrappers.split("|"):
        assert text_of(f"<body><div class='{name}'>{body}</div></body>") == f"{one}\n\n{one}", name
    assert text_of(f"<div class='legal'><article><p>{PROSE}</p></article></div><p>{PROSE}{PROSE}</p>").startswith(one)
    comments = f"<div class='comments'><article><p>{PROSE * 9}</p></article></div>"
    assert text_of(f"<article><p>{PROSE}</p></article>{comments}") == one


def test_reference_list_of_an_article_stays():
    links = "<ul><li><a href=x>First source</a><li><a href=y>Second source</a></ul>"
    source = f"<body><ul><li><a href=a>Home</a><li><a href=b>News</a></ul><div class='story'>{links}<p>{PROSE}</p>{links}</div>{links}</body>"
    assert text_of(source) == f"{PROSE.strip()}\n\nFirst source\n\nSecond source"


def test_broken_markup():
    assert text_of("") == "" and text_of("   <!-- only a comment") == ""
    assert text_of("just text") == "just text"
    assert text_of("<p>a<script>var x='</p>'</script>b<style>p{}</style></p><p>c < d &lt; e") == "ab\n\nc < d < e"
    assert text_of("<article><p>one<p>two</b></i></article></div></div>") == "one\n\ntwo"
    assert text_of("<body><p>kept</p><p hidden>gone</p><div style='display: none'>gone</div><p class") == "kept"
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    assert text_of(deep) == "text"


def test_host_consensus_beats_the_page(spark):
    def page(article, extra):
        return f"<body><div class='story'><p>{article}</p></div><div class='box'><p>{extra}</p></div></body>"

    rows = [(i, f"http://h.example/{i}", page(PROSE * 3, "short extra")) for i in range(12)]
    rows.append((99, "http://H.example/odd", page("A short story.", PROSE)))
    rows.append((100, None, page(PROSE, "x")))
    rows.append((101, "http://other.example/", None))
    out = {r.page_id: r for r in he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[99].text == "A short story." and out[99].path.endswith("div.story")
    assert out[100].text == PROSE.strip() and out[100].url is None
    assert out[101].text == "" and out[101].n_chars == 0 and out[101].path is None


def test_nulls_repeats_clashes_and_empty(spark):
    schema = "page_id long, url string, html string, text string, path string, host string, paths string"
    rows = [(1, "http://a.b/c", f"<p>{PROSE}</p>", "t", "p", "h", "q")] * 2 + [(None, "no url", "<p>x</p>", None, None, None, None)]
    out = he.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 3 and {r.text for r in out} == {PROSE.strip(), "x"}
    assert he.extract(spark.createDataFrame([], schema)).count() == 0


def test_long_page_is_kept_whole(spark):
    source = "<article>" + "".join(f"<p>paragraph {i}</p>" for i in range(30_000)) + "</article>"
    row = he.extract(spark.createDataFrame([(1, "http://a.b/", source)], "page_id long, url string, html string")).first()
    assert row.text.count("\n\n") == 29_999 and row.text.endswith("paragraph 29999")


def test_stressed_words_and_formulas_stay(spark):
    html = (
        "<body><nav><a href='/'>Home</a></nav><article><p>A <em class='share'>shared</em> word and "
        "<strong class='ad'>another</strong> one.</p><p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>"
        "<div class='share'>Share this</div></article></body>"
    )
    row = he.extract(spark.createDataFrame([(1, "http://a.example/x", html)], "page_id long, url string, html string")).first()
    assert row.text == "A shared word and another one.\n\nWhere x=2 holds."


def test_sections_of_an_article_stay_whatever_their_class():
    one = PROSE.strip()
    for opened in ("div class='widget'", "section class='related-work'", "div class='social-contract'"):
        tag = opened.split()[0]
        source = f"<body><article><p>{PROSE}</p><{opened}><h2>Part</h2><p>{PROSE}</p></{tag}></article></body>"
        assert text_of(source) == f"{one}\n\nPart\n\n{one}", opened
    for name, inner in (
        ("share", "Share this"),
        ("related", f"<a href=x>{PROSE}</a>"),
        ("comments", f"<p>{PROSE}</p>"),
        ("widget newsletter", f"<p>{PROSE}</p>"),
        ("widget", f"<div class='comment'>{PROSE}</div>"),
    ):
        assert text_of(f"<article><p>{PROSE}</p><div class='{name}'>{inner}</div></article>") == one, name
    assert text_of("<article><p>They <a class='social' href=x>met</a> again.</p><a class='share'>Share</a></article>") == "They met again."


def by_votes(rows):
    """The consensus stated plainly: whole paths as text, votes counted in dictionaries."""
    pages = [(i, (re.match(r"\w+://([^/]*)", url)[1]).lower(), he.parse(source)) for i, url, source in rows]
    votes = {}
    for _, host, page in pages:
        score = {}
        for container, text, linked, _ in page.blocks:
            worth = max(0, len(text) - 2 * linked)
            while container >= 0 and worth >= 1:
                path = page.path(container)
                score[path] = score.get(path, 0) + worth
                worth, container = worth / 2, page.parents[container]
        if score:
            best = max(score, key=lambda p: (score[p], p.count("/")))
            votes.setdefault(host, []).append(best)
    out = {}
    for i, host, page in pages:
        ranked = sorted(set(votes.get(host, [])), key=lambda p: -votes[host].count(p))
        fit = [p for p in ranked if 10 * votes[host].count(p) >= len(votes[host])]
        own = [page.path(c) for c in range(len(page.labels))]
        path = next(p for p in fit if p in own)
        inside = [b[1] for b in page.blocks if (own[b[0]] + "/").startswith(path + "/")]
        out[i] = ("\n\n".join(inside), path)
    return out


def test_votes_match_a_plain_count(spark):
    kinds = ("div class='story w-1/2'", "section id='post-8'", "article")
    rows = []
    for i in range(120):
        host, kind = i % 3, kinds[(i * i) % 7 % 3]
        long, short = PROSE * (1 + i % 4), "A few words."
        rows.append((i, f"https://Host{host}.example/{i}", f"<body><div class='top'><p>{short}</p></div><{kind}><p>{long}<p>{i}</p></{kind.split()[0]}></body>"))
    out = he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.text, r.path) for r in out} == by_votes(rows)


def test_nesting_costs_memory_in_proportion():
    tracemalloc.start()
    page = he.parse("<div class='inner'>some text" * 100_000)
    scores = he.container_scores(page)
    assert he.text_at(page, he.best_key(scores, page)).count("some text") >= 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(page.keys) == 100_001 and peak < 200 << 20
