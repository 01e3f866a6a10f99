from civiclens.llm.pages import MAIN, OPEN, TEMPLATE, main_texts
from civiclens.llm.pages import blocks as texts


def test_blocks():
    assert texts("<p>a<b>b</b> c<br>d &amp; e &copy;<p>f") == [(OPEN, "ab c"), (OPEN, "d & e ©"), (OPEN, "f")]
    assert texts('<nav>x</nav><article><header><h1>T</h1></header><p>one<p>two<footer>f</footer><ul><li>q<li>r</ul>') == [
        (TEMPLATE, "x"),
        (MAIN, "T"),
        (MAIN, "one"),
        (MAIN, "two"),
        (TEMPLATE, "f"),
        (MAIN, "q"),
        (MAIN, "r"),
    ]
    assert texts("<title>t</title><script>var t='</p>';</script><style>p{}</style><!-- c --><p>x") == [(OPEN, "x")]
    assert texts('<main><p>a</p><div class="ad-box">b</div><div id="comments">c</div><form>d</form><p hidden>e</p>f</main>') == [
        (MAIN, "a"),
        (TEMPLATE, "b"),
        (TEMPLATE, "c"),
        (TEMPLATE, "d"),
        (TEMPLATE, "e"),
        (MAIN, "f"),
    ]
    assert texts("<article><p>open<b>bold<p>next &lt;tag&gt; &#233;&#x20;\xa0 end") == [(MAIN, "openbold"), (MAIN, "next <tag> é end")]
    assert texts("") == texts("<!-- open") == texts("<script>var x = 1") == texts("<style>p{}") == []
    assert texts("<p>x</p><!-- a") == texts("<p>x<b") == texts("<p>x</p") == [(OPEN, "x")]
    assert texts("<p>1 < 2 & &am") == [(OPEN, "1 < 2 & &am")]


def test_host_templates_are_removed_and_articles_kept(spark):
    menu = "Home About us Contact all rights of this site belong to us and to nobody else"
    rows = [
        (i, f"http://h{i % 3}.x/p{i}", f"<body><div>{menu}</div><p>Page {i} has words {i * 7} of its own.</p><div>{menu[::-1]}</div>", 1)
        for i in range(12)
    ]
    rows += [(20 + i, "http://h0.x/a", f"<nav>{menu}</nav><article><p>{menu}</p></article>", 1) for i in range(3)]
    rows += [(40, "http://lonely.x/", f"<div>{menu}</div>", 1), (50, "http://h1.x/w", f"<div>{menu}</div>" * 2, 1)]
    rows += [(None, None, f"<div>{menu}</div>", 1), (60, "u", None, 1), (61, "u", "", 1), (62, "u", "<nav>x</nav>", 1)]
    rows += [rows[0], (70, "http://l.x/", "<div>" + "word " * 100_000 + "</div>", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, body int")
    found = main_texts(frame).collect()
    got = {r.page_id: r.text for r in found}
    assert len(found) == len(rows)
    for i in range(12):
        assert got[i] == f"Page {i} has words {i * 7} of its own."
    assert got[20] == got[21] == menu and got[40] == got[None] == menu
    assert got[50] == "" and got[60] == got[61] == got[62] == ""
    assert got[70] == ("word " * 100_000).strip()
    assert main_texts(frame.where("false")).collect() == []


def test_articles_of_the_given_pages(spark, folder):
    import html
    import re

    from civiclens.llm.pages import op3_host_suffix_pages

    rows = {r.page_id: r for r in op3_host_suffix_pages(spark, folder).collect()}
    for page in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S).group(1)
        inner = re.sub(r"</?b>", "", re.sub(r"<(p|/p|br|h1|/h1)>", " ", inner))
        want = " ".join(html.unescape(inner).split())
        assert rows[page.page_id].text == want and rows[page.page_id].n_chars == len(want)


def test_hosts_are_kept_apart_however_rows_are_dealt(spark):
    """Runs that several hosts share once each are no repeats; pages under one id are several."""
    run = lambda k: " ".join(f"run{k} word{j}" for j in range(12))
    rows = [(10 * h + k, f"http://h{h}.x/{k}", f"<div>{run(k)}</div><p>Own {h} {k}.</p>") for h in range(4) for k in range(6)]
    rows += [(900 + k, "http://twice.x/", f"<div>{run(k % 2)}</div><p>Own {k}.</p>") for k in range(4)]
    rows += [(900, "http://twice.x/", f"<div>{run(9)}</div>"), (900, "http://other.x/", f"<div>{run(0)}</div><p>Own 0.</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted([(10 * h + k, f"{run(k)} Own {h} {k}.") for h in range(4) for k in range(6)])
    want += sorted([(900, "Own 0."), (900, run(9)), (900, f"{run(0)} Own 0."), *[(900 + k, f"Own {k}.") for k in (1, 2, 3)]])
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "211"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted((r.page_id, r.text) for r in main_texts(frame).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)


def test_deep_pages_take_time_in_proportion():
    import time

    start = time.perf_counter()
    assert len(texts("<div>x" * 100_000)) == 100_000
    assert len(texts("<b>x</i><p>" * 50_000 + "</p>" * 50_000)) == 50_000
    assert len(texts("<article>" * 50_000 + "x")) == 1
    assert time.perf_counter() - start < 60
