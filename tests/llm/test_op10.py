import os
import random

from conftest import SF_SMALL

from tessera.llm import op10_html as m


def subsequence_length(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcdf") for _ in range(rng.randint(0, 12))]
        found = sorted(m.common(a, b))
        rest = iter(b)
        assert len(found) == subsequence_length(a, b) and all(a[i] in rest for i in found)


def test_lines_of_a_page():
    page = ('<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav><!-- c -->'
            '<script>var t="</p>";</script><div class="ad">buy</div><article><h1>A &amp; B</h1><p><b>one\n\ttwo<br>three<br>'
            '<p>caf&eacute; &#8364;</p><form><p>name</p></form><section id="comments"><article class="comment"><p>first!</p>'
            '</article></section></article><footer>&copy;</footer>')
    assert [x.text for x in m.lines(page)] == ["A & B", "one two three", "café €"]
    assert all(x.own for x in m.lines(page))


def test_damaged_pages():
    assert m.lines(None) == [] and m.lines("") == [] and m.lines("<p") == []
    assert [x.text for x in m.lines("<nav>menu<article><p>text")] == ["text"]
    assert [x.text for x in m.lines("a &am")] == ["a &am"]
    assert [x.text for x in m.lines("x < y <p title='>'>z")] == ["x < y", "z"]
    assert len(m.lines("<p>x</p>" * 50_000)) == 50_000


def test_a_sentence_that_one_neighbour_has_too_stays():
    head = "<nav>menu</nav><article><h1>Same title</h1><p>%s</p><p>Said by two.</p></article>"
    site = "<main><p>Every page has this.</p><p>%s</p><p>And this.</p></main>"
    def page(i, html):
        found = m.lines(html)
        return m.Page(i, None, "h", f"/a/{i}", found, m._digest(found))
    pages = [page(i, head % f"text {i}") for i in range(2)] + [
        page(i, f"<article><h1>Title {i}</h1><p>other words {i}</p></article>") for i in range(2, 9)]
    assert m.main_text(pages[0], pages[1:]) == "Same title\ntext 0\nSaid by two."
    texts = [" ".join(f"word{i}_{k}" for k in range(30)) for i in range(9)]
    pages = [page(i, site % texts[i]) for i in range(9)]
    assert [m.main_text(p, [o for o in pages if o is not p]) for p in pages] == texts


def _texts(page):
    return [x.text for x in m.lines(page)]


def test_void_elements_set_nothing_apart():
    for tag in ('<img class="banner">', '<input id="search">', '<hr class="footer-rule">', '<link class="ad">', '<wbr class="ad">'):
        assert _texts(f"<p>a</p>{tag}<p>b</p>") == ["a", "b"]
        assert _texts(f"<article><p>a</p>{tag}<p>b</p></article>") == ["a", "b"]
        assert _texts(f"<nav>{tag}menu</nav><p>b") == ["b"]


def test_elements_set_apart_end_without_end_tags():
    assert _texts('<p class="ad">x<p>a<div>b</div>') == ["a", "b"]
    assert _texts('<div><p class="ad">x</div>a') == ["a"]
    assert _texts('<p class="ad">x <b>y</b><table><tr><td>a</table>b') == ["a", "b"]
    assert _texts('<ul><li class="ad">x<ul><li>y</ul>z<li>a</ul>b') == ["a", "b"]
    assert _texts('<ul><li>a<li class="ad">x</ul>b') == ["a", "b"]
    assert _texts('<dl><dt class="ad">x<dd>a<dd class="ad">y</dl>b') == ["a", "b"]
    assert _texts('<table><tr><td class="ad">x<table><tr><td>y</table>z<td>a<tr><th class="ad">y<tr class="ad"><td>z'
                  '<tbody><tr><td>b</table>c') == ["a", "b", "c"]
    assert _texts('<datalist><option class="ad">x<option>a</datalist>') == ["a"]
    assert _texts('<div><span class="ad">x</div>a') == ["a"]
    assert _texts('<div class="ad"><p>x<div>y</div>z</b></div>a') == ["a"]


def test_slugs_inside_an_article_are_no_hints():
    body = ('<h2 id="related-work">A</h2><section id="search"><p>b</p></section><h2 id="social-impact">C</h2><p id="notices">d</p>'
            '<div class="article-header"><h1>E</h1></div><p class="alert">f</p><p class="header notice">g</p>')
    for tag in ("article", "main"):
        assert _texts(f"<{tag}>{body}</{tag}>") == list("AbCdEfg")
        assert _texts(f'<{tag}><div class="x newsletter">n</div><div id="comments">c</div><p class="ad">x</p><p>a</p></{tag}>') == ["a"]
    assert _texts('<h2 id="related-work">A</h2><div class="site-header">x</div><p>b</p>') == ["A", "b"]


def test_head_ends_at_the_body():
    assert _texts('<head><meta charset="x"><link rel="y"><title>t</title><p>a') == ["a"]
    assert _texts("<head><title>t</title><body>a<p>b") == ["a", "b"]
    assert _texts("<head><title>t</title> a<p>b") == ["a", "b"]
    assert _texts("<head><title>t</title> a") == ["a"]


def _site(spark, n):
    """Pages without an article element: the template shows by differencing only."""
    rows = []
    for k in range(n):
        body = f"<div>Site name</div><div>All topics here</div><p>Text {k} of its own.</p><p>More of {k}.</p><div>Call us</div>"
        rows.append((k, f"https://www.a.example/x/{k:03d}", f"<html><body>{body}</body></html>"))
    rows += [(900, "https://b.example/only", "<p>Site name</p><p>alone</p>"), (901, None, "<p>no url</p>"),
             (902, "https://c.example/1", None), (903, "https://c.example/2", ""), (None, "https://d.example", "<p>no id</p>"),
             (904, "https://e.example/1", "<p>copy</p><p>of a page</p>"), (905, "https://e.example/1", "<p>copy</p><p>of a page</p>")]
    return spark.createDataFrame([(i, u, h, "t", 1) for i, u, h in rows],
                                 "page_id bigint, url string, html string, text string, n_chars int")


def test_shared_lines_of_neighbours_go(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in m.main_texts(_site(spark, 40)).collect()}
    for k in range(40):
        text = f"Text {k} of its own.\nMore of {k}."
        assert got[k] == (text, len(text))
    assert got[900][0] == "Site name\nalone" and got[901][0] == "no url" and got[None][0] == "no id"
    assert got[902] == ("", 0) and got[903] == ("", 0)
    assert got[904][0] == got[905][0] == "copy\nof a page"   # copies of each other are no template


def test_no_rows(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert m.main_texts(none).count() == 0


def test_query_equals_brute_force(spark):
    """All pages in one list instead of sorted partitions."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = {r.page_id: r.text for r in m.op10_html(spark, SF_SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id] == "\n".join(x.text for x in m.lines(p.html) if x.own)


def _differenced(pages):
    """Expected texts: every page against the nearest neighbours in one sorted list, by the plain rules."""
    sites = sorted((p.url.split("/")[2], p.url.split("/", 3)[3], p.page_id, m.lines(p.html)) for p in pages)
    for k, (host, path, page_id, mine) in enumerate(sites):
        near = [sites[j] for j in (k - 1, k + 1) if 0 <= j < len(sites) and sites[j][0] == host]
        near.sort(key=lambda o: -len(os.path.commonprefix([path, o[1]])))
        gone = set()
        for other in near:
            a, b = [x.text for x in mine], [x.text for x in other[3]]
            found = m.common(a, b)
            if sum(len(a[i]) for i in found) < 0.6 * min(len("".join(a)), len("".join(b))):
                gone = found
                break
        yield page_id, "\n".join(x.text for i, x in enumerate(mine) if i not in gone)


def test_differencing_decides_inside_main(spark):
    rng = random.Random(7)
    rows = []
    for k in range(120):
        body = "".join(f"<p>{rng.random()} {rng.random()} {rng.random()}</p>" for _ in range(rng.randint(2, 6)))
        tag = rng.choice(["article", "main"])
        rows.append((k, f"https://h{k % 7}.example/{rng.randint(0, 3)}/{k:03d}",
                     f"<body><{tag}><div>All our topics</div>{body}<p>Write to us</p></{tag}></body>"))
    got = {r.page_id: r.text for r in m.main_texts(spark.createDataFrame(
        rows, "page_id bigint, url string, html string").coalesce(1)).collect()}
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").collect()
    assert got == dict(_differenced(pages))
    assert not any("topics" in x or "Write" in x for x in got.values())


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


MENU = "".join(f"<div>{w} of our site for all of our many readers</div>" for w in "One Two Three Four Five Six".split())


def test_template_longer_than_the_text_goes(spark):
    texts = [" ".join(str(random.Random(100 * k + i).random()) for i in range(8)) for k in range(12)]
    got = m.main_texts(_pages(spark, [(k, f"https://a.example/{k:02d}", f"{MENU}<p>{t}</p>") for k, t in enumerate(texts)])).collect()
    assert len("".join(m.lines(MENU)[i].text for i in range(6))) > 0.6 * (len(texts[0]) + 260)
    assert {r.page_id: r.text for r in got} == dict(enumerate(texts))


def test_copies_in_a_row_are_passed_over(spark):
    rng = random.Random(3)
    long = " ".join(str(rng.random()) for _ in range(40))
    rows = [(k, f"https://a.example/a/{k}", f"{MENU}<p>{long}</p>") for k in range(5)]
    rows += [(10 + k, f"https://a.example/b/{k}", f"{MENU}<p>{long}</p><p>{k}</p>") for k in range(5)]
    rows += [(20, "https://a.example/c/1", f"{MENU}<p>{' '.join(str(rng.random()) for _ in range(40))}</p>")]
    got = {r.page_id: r.text for r in m.main_texts(_pages(spark, rows)).collect()}
    assert all(got[k] == long for k in range(5)) and all(got[10 + k] == f"{long}\n{k}" for k in range(5))


def test_blocks_and_partitions_change_no_row(spark):
    rng = random.Random(5)
    rows = []
    for k in range(150):
        text = rng.choice(["<p>same page</p>", f"<p>{rng.random()}</p>" * rng.randint(1, 3), f"<p>{rng.random()}</p><p>long text of a copy</p>"])
        host = rng.choice("aab")
        rows.append((rng.choice([k, k, None]), f"https://{host}.example/{rng.randint(0, 2)}/{k % 50:03d}",
                     f"<div>Site {host}</div>{text}<div>Bye {k % 4}</div>"))
    want = None
    for parts, size in ((1, 1000), (7, 1), (3, 10), (40, 17)):
        got = sorted((r.url, r.page_id or -1, r.text, r.n_chars) for r in
                     m.main_texts(_pages(spark, rows).repartition(parts), size).collect())
        want = want or got
        assert got == want and len(got) == len(rows)
