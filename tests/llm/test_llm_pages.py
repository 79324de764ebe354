"""Template removal against a plain single-machine version, and the cases that need its method."""

import re

import pytest

from series_lake.llm.html_templates import LEAST, described, main_text
from series_lake.llm.queries import QUERIES


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def texts(spark, rows, **options):
    return {r.page_id: r.text for r in main_text(pages(spark, rows), **options).collect()}


def plain(rows, least=LEAST):
    """All pages of a host in one place."""
    parsed = []
    for page_id, url, html in rows:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        parsed.append((page_id, None if url is None else (m.group(1).lower() if m else ""), *described(html or "")))
    rests = {}
    for _, host, _, subtrees in parsed:
        for h, rest in subtrees:
            rests.setdefault((host, h), set()).add(rest)
    out = {}
    for page_id, host, blocks, subtrees in parsed:
        gone = {i for i, (h, _) in enumerate(subtrees) if host is not None and len(rests[host, h]) >= least}
        out[page_id] = "\n".join(t for t, own in blocks if t is not None and not gone & set(own))
    return out


def story(i):
    return f"<div class='story-{i % 2}'><h2>Story {i}</h2><p>What happened on day {i} was long and different from others</p><p>And so on {i * 7}</p></div>"


SIDEBAR = "<div><p>Most read today</p><p>Weather</p></div>"


@pytest.mark.parametrize("n,with_sidebar", [(200, 96), (9, 9)])
def test_unnamed_sidebar_goes_on_any_host(spark, n, with_sidebar):
    rows = [(i, "http://h.example.org/p", f"<body>{story(i)}{SIDEBAR if i < with_sidebar else ''}</body>") for i in range(n)]
    got = texts(spark, rows)
    assert all("Most read" not in t and f"Story {i}" in t and f"so on {i * 7}" in t for i, t in got.items())
    assert got == plain(rows)


def test_below_the_bar_it_stays(spark):
    rows = [(i, "http://h.example.org/p", f"<body>{story(i)}{SIDEBAR}</body>") for i in range(LEAST - 1)]
    assert all("Most read" in t for t in texts(spark, rows).values())


def test_names_of_compounds_do_not_empty_pages(spark):
    whole = ['<div class="content has-sidebar">{}</div>', '<div id="content" class="no-ads">{}</div>', '<main><div class="article-body related-topic">{}</div></main>', '<div class="comments">{}</div>']
    rows = [(10 * k + i, f"http://h{k}.example.org/", w.format(story(10 * k + i))) for k, w in enumerate(whole) for i in range(10)]
    assert all(f"Story {i}" in t for i, t in texts(spark, rows).items())
    parts = ["cookie-notice", "sidebar left", "ad", "site-search ads", "comment-list", "share-box", "newsletter"]
    rows = [(k, f"http://p{k}.example.org/", f'{story(k)}<div class="{c}"><p>side</p></div>') for k, c in enumerate(parts)]
    got = texts(spark, rows)
    assert [k for k, t in got.items() if "side" in t] == []


def test_copies_do_not_vote_and_keep_their_text(spark):
    article = "<div><h2>Copied</h2><p>The same long article on many pages of the host, word for word</p></div>"
    rows = [(i, "http://c.example.org/", f"<body>{article}<div><p>same box</p></div></body>") for i in range(40)]
    # copies beside adverts that differ: the article holds most of the text
    rows += [(100 + i, "http://d.example.org/", f"<body>{article}<div><p>advert {i}</p></div></body>") for i in range(40)]
    got = texts(spark, rows)
    assert all("same box" in got[i] and "Copied" in got[i] for i in range(40))
    assert all("word for word" in got[100 + i] for i in range(40))


def test_same_subtree_elsewhere_is_not_the_template(spark):
    rows = [(i, "http://h.example.org/", f"<body>{story(i)}<div>{SIDEBAR}</div></body>") for i in range(20)]
    rows += [(50, "http://h.example.org/", f"<body>{story(50)}<section>{SIDEBAR}</section></body>"), (51, "http://other.example.org/", rows[0][2]), (52, None, rows[0][2])]
    got = texts(spark, rows)
    assert "Most read" not in got[3] and all("Most read" in got[i] for i in (50, 51, 52))
    assert got == plain(rows)


def test_named_templates_are_counted(spark):
    rows = [(i, "http://h.example.org/", f"<nav><ul><li>Home<li>About</ul></nav><article><h1>T{i}</h1><p>text {i}</p><p>a passage that many quote</p></article><footer>c</footer>") for i in range(12)]
    got = main_text(pages(spark, rows)).collect()
    assert all(r.text == f"T{r.page_id}\ntext {r.page_id}\na passage that many quote" and r.n_template == 3 for r in got)


def test_query_equals_plain_version(spark, tmp_path):
    rows = [(i, f"http://H{i % 3}.example.org:8080/x", f"<header>Site {i % 3}</header><body>{story(i)}{SIDEBAR if i % 4 else ''}<div><p>Box {i % 2}</p></div><ul><li>a<li>b</ul>") for i in range(60)]
    rows += [(70, "not a url", None), (71, None, ""), (None, "http://h1.example.org/", "<p>only"), *[(80, "http://h0.example.org/", rows[0][2])] * 3]
    pages(spark, rows).write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op2_html_templates"](spark, str(tmp_path)).collect()
    want = plain(rows)
    assert len(got) == len(rows) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)
