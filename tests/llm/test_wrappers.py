"""Main texts against a plain reading of pages whose article is known, and wrappers by example."""

import html
import random
import re
import time

import numpy as np
import pytest

from weftwork.llm import queries, wrappers
from weftwork.llm.wrappers import KEY, NEEDED, REPEATED, aligned, folded, main_texts, marked, match, merged, page_wrapper, parse, wrapper_of

FOLDER = "/root/testdata/sf0.01"


def plain(page):
    article = page[page.index("<article>") + 9 :]
    article = re.split("</article>|<footer", article)[0]
    blocks = re.split(r"<p>|</p>|<br>|<h1>|</h1>", article)
    return "\n".join(b for b in (" ".join(html.unescape(re.sub(r"<[^>]*>?", "", x)).split()) for x in blocks) if b)


def test_query(spark):
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = queries.QUERIES["op1_main_text"](spark, FOLDER).collect()
    assert {r.page_id: (r.url, r.text) for r in found} == want and len(found) == len(want)
    assert all(r.n_chars == len(r.text) for r in found)


def keys(nodes):
    return [n[KEY] + ("" if n[NEEDED] else "?") + ("+" if n[REPEATED] else "") for n in nodes]


def test_repeats_and_optionals():
    one = wrapper_of(parse("<div><h2>a</h2><p>x</p><p>y</p></div>"))
    two = wrapper_of(parse("<div><h2>b</h2><ul><li>1<li>2<li>3</ul><p>z</p></div>"))
    both = merged(one, two, True)[3][0]
    assert keys(both[3]) == ["h2", "ul?", "p+"] and keys(both[3][1][3]) == ["li+"]
    pairs = wrapper_of(parse("<dl>" + "<dt>a</dt><dd>b</dd>" * 5 + "</dl>"))[3][0]
    assert keys(pairs[3]) == ["(dt dd)+"]
    a, b = (wrapper_of(parse(f"<h1>{t}</h1><p>same</p>"))[3] for t in "xy")
    slots = [n[3][0][7] for n in aligned(a, b, True)]
    assert slots[0] is None and slots[1] is not None
    assert keys(folded(a + a)) == ["(h1 p)+"]


SITES = {
    "plain": "<body><header><h2>Site</h2></header><div id='menu'><a href=1>One</a> <a>Two</a></div><main><h1>{t}</h1>{b}"
    "<section class=comments><p>First! {n}</p></section></main><aside><p>Side {n}</p></aside><footer>(c)</footer></body>",
    "divs": "<body><div class='top-nav'><a>Home</a></div><div class='wrap'><div class='cookie-notice'>We use cookies {n}</div>"
    "<div class='text'><h1>{t}</h1>{b}<form><input name=q> Subscribe</form></div><div class='sidebar-left'>"
    "<ul><li><a href=x>Other {n}</a></ul></div></div><div class=footer>Foot {n}</div></body>",
    "article": "<body><nav>Menu</nav><article class='post'><header><h1>{t}</h1></header>{b}<div class='share-buttons'>Share</div>"
    "<div style='display:none'>hidden</div><script>if (a < b) document.write('<p>no</p>')</script><p>Follow this site.</p></article>"
    "<div id=comments><article class=comment><p>Nice {n}</p></article></div></body>",
}


@pytest.mark.parametrize("site", list(SITES))
def test_sites(spark, site):
    rng, rows, want = random.Random(len(site)), [], {}
    for n in range(40):
        words = lambda: " ".join("".join(rng.choice("abcdeé") for _ in range(5)) for _ in range(rng.randrange(8, 40)))
        title, blocks = words(), [words() for _ in range(rng.randrange(1, 7))]
        body = ""
        for k, b in enumerate(blocks):
            inner = b.replace(" ", "\n ", 1).replace("a", "&#97;").replace("b", "<b>b</b>", 1)
            body += (f"<p>{inner}", f"<p class=x>{inner}</p>", f"<div><p>{inner}</p></div>", f"<ul><li>{inner}</ul>")[rng.randrange(4)]
        want[n] = "\n".join([title, *blocks])
        rows.append((n, f"https://{site}.example/{n}", SITES[site].format(t=title, b=body, n=n)))
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()
    assert {r.page_id: r.text for r in found} == want


def test_awkward_pages(spark):
    rows = [
        (1, None, "<p>A &amp; B&nbsp;C</p>"), (2, "http://h.example/", None), (3, "no url", ""), (None, "http://i.example", "text only <b"),
        (4, "http://h.example/x", "<article><p>" + "word " * 300000 + "</p></article>"), (5, "http://j.example", "<div>" * 3000 + "deep"),
        (6, "http://k.example", "<article><p class='x>broken quote</p><p>next</p></article>"), (6, "http://k.example", "<!-- only"),
        (7, "http://l.example", "<article><p>a<script>b</p>"), (8, "http://m.example", "<![CDATA[x]]><p>1 < 2 &lt; 3</p>"),
    ]
    frame = spark.createDataFrame([(*r, "w", 1) for r in rows], "page_id int, url string, html string, wrapper string, host int")
    found = main_texts(frame.repartition(3)).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r.text for r in found if r.page_id != 6}
    assert by_id[1] == "A & B C" and by_id[2] == "" and by_id[3] == "" and by_id[None] == "text only"
    assert by_id[4] == ("word " * 300000).strip() and by_id[5] == "deep" and by_id[7] == "a" and by_id[8].endswith("1 < 2 < 3")
    assert main_texts(frame.limit(0)).count() == 0


def texts_of(pages):
    """The main texts of the pages of one host, without Spark."""
    whole = None
    for page in pages:
        one = wrapper_of(parse(page))
        whole = one if whole is None else merged(whole, one, True)
    marked(whole)
    found = []
    for page in pages:
        out = []
        match(whole, parse(page), out)
        found.append("\n".join(out))
    return found


def test_groups_within_groups():
    section = lambda n, k: f"<h2>s{n} {k}</h2>" + "".join(f"<h3>t{n} {k} {i}</h3><p>x{n} {k} {i}</p>" for i in range(2))
    rng, pages = random.Random(5), ["<article>" + "".join(section(n, k) for k in range(1 + n)) + "</article>" for n in range(5)]
    pages += ["<article>" + "".join(f"<h2>a{n} {k}</h2>" + f"<p>b{n} {k}</p><ul><li>c{n} {k}</ul>" * 2 for k in range(n)) + "</article>" for n in range(1, 6)]
    pages += ["<article>" + "".join(f"<{t}>{t} {n} {k}</{t}>" for k, t in enumerate(rng.choices(["h2", "h3", "p", "figure"], k=30))) + "</article>" for n in range(40)]
    want = ["\n".join(re.findall(r">([^<>]+)", page)) for page in pages]
    for some in (range(4), range(4, 5), range(5), range(5, 10), range(10), range(10, 50), range(50)):
        assert texts_of([pages[k] for k in some]) == [want[k] for k in some]


WHOLE_PAGES = [
    "<body class='single has-sidebar'>{a}<div class=sidebar>Side {n}</div></body>",
    "<body class='single has-sidebar'><article class='post'>{a}</article><div class=sidebar><p>Side {n}</p></div></body>",
    "<body id=top><main class='content with-sidebar'>{a}<div class=share>Share {n}</div></main><div class=comments>Nice {n}</div></body>",
    "<body><article class='post has-comments'>{a}<div class=comments>Nice {n}</div></article><div class=widget>Ad {n}</div></body>",
    "<body><article class='ad-free'>{a}</article><article class='comment'>Nice {n}</article></body>",
    "<body><main><article class='post ad-free'>{a}</article><p class=notice>Notice {n}</p></main></body>",
    "<body><main><article class='ad-free'>{a}</article></main><aside>Side {n}</aside></body>",
    "<body><div class='page has-sidebar'><article>{a}</article><div class=sidebar>Side {n}</div></div></body>",
    "<body><div class='content with-sidebar'>{a}<div class=widget>Ad {n}</div></div><div class=footer>Foot {n}</div></body>",
    "<body><div class='wrap has-menu'>{a}<div class=menu>Menu {n}</div></div></body>",
    "<body><article><div class='entry with-sidebar'>{a}</div><div class=related>Other {n}</div></article></body>",
    "<body><div class='post-content'>{a}</div><div class='post-comments'>Nice {n}</div></body>",
    "<body><article>{a}<div><div class=share>Share {n}</div><div class=ad>Ad {n}</div></div></article></body>",
    "<body><main>{a}</main><article class=comment>Nice {n}</article></body>",
    "<body><main>{a}</main><div id=comments>" + "<article class=comment>Nice {n} and some more text here</article>" * 9 + "</div></body>",
]


@pytest.mark.parametrize("page", WHOLE_PAGES)
def test_words_that_tell_what_a_whole_page_has(page):
    blocks = [[f"title {n}"] + [f"block {n} {k} of the text of this article" for k in range(2 + n % 3)] for n in range(6)]
    pages = [page.format(a=f"<h1>{b[0]}</h1>" + "".join(f"<p>{x}</p>" for x in b[1:]), n=n) for n, b in enumerate(blocks)]
    assert texts_of(pages) == ["\n".join(b) for b in blocks]
    assert [texts_of([p])[0] for p in pages] == ["\n".join(b) for b in blocks]


def host(template, n):
    """Pages of one host from a template, and their main texts: the article ``{a}`` and what stands in double brackets."""
    rng = random.Random(len(template) + n)
    stock = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    words = lambda k: " ".join(rng.choice(stock) for _ in range(k))
    pages, want = [], []
    for k in range(n):
        article = f"<h1>{words(5)}</h1>" + "".join(f"<p>{words(rng.randrange(10, 40))}</p>" for _ in range(rng.randrange(3, 8)))
        values = {
            "n": k,
            "a": f"[[{article}]]",
            "menu": "<a href=/>Home</a> <a href=/n>News</a>",
            "side": "".join(f"<p>{words(4)}</p>" for _ in range(rng.randrange(1, 4))),
            "links": "".join(f"<li><a href=/{i}>{words(3)}</a></li>" for i in range(rng.randrange(3, 9))),
            "remarks": "".join(f"<div><div>{words(1)}</div><p>{words(5)}</p></div>" for _ in range(2 + k % 3)),
            "advert": ("Buy the new shoes now", "Cheap flights this week", "A better phone")[k % 3],
            "part": f"<p>{words(12)}</p><p>{words(20)}</p>",
            "long": words(15),
            "asked": "".join(f"<div><h3>{words(3)}</h3><p>{words(6)}</p></div>" for _ in range(3)),
            "items": "".join(f"<li>{words(2)}</li>" for _ in range(4)),
            "rows": "".join(f"<tr><td>{words(1)}<td>{words(1)}</tr>" for _ in range(4)),
        }
        page = template.format(**values)
        kept = "".join(re.findall(r"\[\[(.*?)\]\]", page, re.S))
        blocks = (" ".join(re.sub("<[^>]*>", " ", x).split()) for x in re.split(r"</?(?:p|h\d|div|section|ul|li|tr|figcaption|code)\b[^>]*>", kept))
        want.append("\n".join(b for b in blocks if b))
        pages.append(page.replace("[[", "").replace("]]", ""))
    return pages, want


def texts_with_articles(pages):
    whole = None
    for page in pages:
        one = page_wrapper(page)
        whole = one if whole is None else merged(whole, one, True)
    marked(whole)
    found = []
    for page in pages:
        out = []
        match(whole, parse(page), out)
        found.append("\n".join(out))
    return found


BY_SLOTS = [
    "<div class=k1><ul><li>{menu}</ul></div><div class=k2>{a}</div><div class=k3><h3>Side</h3>{side}<ul>{links}</ul></div><div class=k4>(c) us</div>",
    "<div class=k1>{menu}</div><div class=k5><div class=k2>{a}</div><div class=k3>{side}</div><div class=k4><ul>{links}</ul></div></div>",
    "<div class=k1>{menu}</div>{a}<div class=k3>{side}<ul>{links}</ul></div>",
    "<div class=k1>{menu}</div><div class=k2>{a}[[<ul>{items}</ul><table>{rows}</table>]]</div><div class=k3>{side}</div>",
    "<nav>x</nav><article>{a}<div class=thread>{remarks}</div></article>",
    "<nav>x</nav><article>{a}<div class=k7>{remarks}</div></article>",
    "<div class=werbung>{advert}</div><div class=text>{a}</div><div class=kommentare>{remarks}</div><div class=seitenleiste>{side}</div>",
    "<article>{a}<div class=werbung>{advert}</div><div class=kommentare>{remarks}</div></article><div class=seitenleiste>{side}</div>",
    "<article>{a}<div class=anzeige>{advert}</div></article>",
    "<nav>m</nav><article>{a}[[<div class='social-history'>{part}</div>]]</article>",
    "<nav>m</nav><article>{a}[[<section class='hidden-gems'><h2>Head {n}</h2>{part}</section>]]</article>",
    "<nav>m</nav><article>{a}[[<ul><li><a href=x>one linked item {n}</a></li></ul>]]</article>",
    "<nav>m</nav><article>{a}[[<div class=k4>{asked}</div>]]</article>",
    "<nav>m</nav><article>{a}[[<ul>{items}</ul><table>{rows}</table><figure><figcaption>Plate {n}</figcaption></figure>]]</article>",
    "<nav>m</nav><article><div class=k1>{a}</div>[[<div class=k2>{part}</div>]]</article><div class=k3>{side}</div>",
]


@pytest.mark.parametrize("body", BY_SLOTS)
def test_slots_decide_where_names_do_not(body):
    for n in (1, 12, 40):
        pages, want = host(f"<html><body>{body}</body></html>", n)
        assert texts_with_articles(pages) == want


def test_few_texts_that_come_back_are_no_part_of_many_articles():
    pages, want = host("<body><article>{a}<div class=k8><p>{advert}</p></div>[[<p>{long}</p>]]</article></body>", 12)
    assert texts_with_articles(pages) == want
    one, text = host("<body><article>{a}[[<div class=k8>{part}</div>]]</article></body>", 1)
    near = [one[0].replace("</h1>", f" {k}</h1>") for k in range(30)]  # near copies: nothing of them goes
    found = texts_with_articles(near)
    assert [t.split("\n")[1:] for t in found] == [text[0].split("\n")[1:]] * 30


def test_copies_and_lists_of_links(spark):
    rows, want = [], []

    def add(host, body, text):
        rows.append((len(rows), f"https://{host}/{len(rows)}", f"<body><article>{body}<h6>Follow this site.</h6></article></body>"))
        want.append(text)

    for host, n in (("two", 2), ("three", 3), ("thirty", 30)):
        for k in range(6):
            add(host, f"<h1>t {k}</h1><p>text {k}</p>", f"t {k}\ntext {k}")
        for _ in range(n):
            add(host, "<h1>own</h1><blockquote>said once</blockquote><p>more</p>", "own\nsaid once\nmore")
    for k in range(6):  # the same article beside other counters
        page = f"<body><i>{k}</i><article><h1>a</h1><figure>one</figure></article></body>" if k < 4 else f"<body><article><h1>b {k}</h1></article></body>"
        rows.append((len(rows), f"https://counters/{k}", page))
        want.append("a\none" if k < 4 else f"b {k}")
    for k in range(5):
        links = "<ul>" + f"<li><a href=x>a long linked text {k}</a>" * 9 + "</ul>"
        add("lists", f"<h1>l {k}</h1>" + (links if k else f"<ul><li>plain {k}<li>item {k}</ul>"), f"l {k}" if k else "l 0\nplain 0\nitem 0")
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 5):
        found = {r.page_id: r.text for r in main_texts(frame.repartition(parts)).collect()}
        assert [found[k] for k in range(len(rows))] == want


def test_longest_common_order(monkeypatch):
    rng = random.Random(3)
    for table in (250_000, 6):
        monkeypatch.setattr(wrappers, "TABLE", table)
        for _ in range(300):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
            pairs = wrappers.common(np.array(a, dtype=np.int32), np.array(b, dtype=np.int32))
            assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)
            assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
            size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i in range(len(a)):
                for j in range(len(b)):
                    size[i + 1][j + 1] = size[i][j] + 1 if a[i] == b[j] else max(size[i][j + 1], size[i + 1][j])
            assert len(pairs) == size[-1][-1]


def test_pages_of_very_many_irregular_blocks_take_seconds():
    rng = random.Random(5)
    tags = ["p", "h2", "h3", "blockquote", "pre", "figure"]
    pages = []
    for _ in range(2):
        blocks = [f"<{t}>text {k} {rng.random()}</{t}>" for k, t in enumerate(rng.choice(tags) for _ in range(20_000))]
        pages.append(f"<html><body><nav><ul><li><a href='/'>home</a></ul></nav><article>{''.join(blocks)}</article></body></html>")
    start = time.monotonic()
    wrapper = merged(page_wrapper(pages[0]), page_wrapper(pages[1]), True)
    marked(wrapper)
    for page in pages:
        out = []
        match(wrapper, parse(page), out)
        assert len(out) == 20_000 and not any("home" in x for x in out)
    assert time.monotonic() - start < 60


def test_elements_at_any_depth_are_skipped(spark):
    rows = []
    for k in range(6):
        inner = f"<p>start {k}</p><nav><ul><li><a href='/x'>menu {k}</a></li></ul></nav><p>text of page {k} that goes on</p><form><p>send</p></form><p>end {k}</p>"
        page = "<html><body><article><h1>title</h1>" + "<div>" * 3000 + inner + "</div>" * 3000 + f"<p>after {k}</p></article></body></html>"
        rows.append((k, "http://deep.example/x", page))
    found = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert found[k].split("\n")[-4:] == [f"start {k}", f"text of page {k} that goes on", f"end {k}", f"after {k}"]
        assert "menu" not in found[k] and "send" not in found[k]
