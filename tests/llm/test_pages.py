"""Page texts on invented sites, and alignment against dynamic programming."""

import random
import re
from collections import Counter
from os.path import commonprefix

import pytest
from blotter.llm import pages
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import listed, sentence


def length_by_hand(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40))
def test_alignment_is_longest(a, b):
    places = sorted(pages.shared(a, b))
    assert len(places) == length_by_hand(a, b)
    rest = iter(b)
    assert all(any(a[i] == x for x in rest) for i in places)


def test_alignment_of_long_pages():
    dice = random.Random(1)
    a = [dice.randint(0, 50) for _ in range(4000)]
    b = [x for x in a if dice.random() < 0.7] + [7] * 2000
    assert len(pages.shared(a, b)) >= 0.6 * len(a)


def article(body, site="Our site", extra=""):
    return (
        f"<html><head><title>t</title><script>var x='</p>';</script></head><body><div class='top'>{site}</div>"
        f"<div>{extra}</div>{body}<p>All rights reserved by {site}</p></body></html>"
    )


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h1>A &amp; B</h1><p>one\n two<br>three</p></article>", "A & B\none two\nthree"),
        ("<nav>n</nav><main><p>x <b>y</b>z</p></main><aside>s</aside>", "x yz"),
        ("<article><p>a<p>b<li>c</article><footer>f</footer>", "a\nb\nc"),
        ("<article><p>a</p><div class='ad'>no</div><section id=comments><p>no</p></section><p>b</article>", "a\nb"),
        ("<article><p>a</p><form><p>no</form><p>&lt;b&gt; &#233;&eacute; &amp &am</p></article>", "a\n<b> éé & &am"),
        ("<header>no</header><article><header><h1>t</h1></header>x</article>", "t\nx"),
        ("<p>open <script>if (a<b) '</p>'</script>still</p><!-- no --><p>b", "open still\nb"),
        ("<div role='navigation'>no</div><p title='a > b'>yes</p>", "yes"),
        ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p", "<p"), ("a < b", "a < b"), ("<!-- open", ""),
        ("<article></article><p>loose</p>", "loose"), ("<script>open", ""), ("</p></div>x", "x"),
    ],
)
def test_zones(spark, html, text):
    own = pages.lines(html)
    assert "\n".join(t for _, t, _ in pages.chosen(own)) == text


def test_differencing(spark):
    one, two = (article(f"<p>Text of {n}</p><p>More of {n}</p>") for n in ("one", "two"))
    linked = "<article><p>Quote</p><p><a href=/>Share this page</a></p><p>{}</p></article>"
    prose = [f"line {i} of a text that two pages of a host have, the second with one more line at its end" for i in range(5000)]
    long_text = "<p>" + "</p><p>".join(prose) + "</p>"
    rows = [
        (1, "http://h.example/a/1", one),
        (2, "http://h.example/a/2?x=1", two),
        (2, "http://h.example/a/2?x=1", two),
        (3, "http://other.example/a/2", two),
        (4, "http://h.example/b/1", linked.format("p")),
        (5, "http://h.example/b/2", linked.format("q")),
        (6, None, None), (None, None, one), (7, "no url", "<p>x</p>"), (8, "http://empty.example", ""),
        (9, "http://long.example/1", long_text), (10, "http://long.example/2", long_text + "<p>end</p>"),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = pages.main_texts(table.withColumns({"text": F.lit(1), "hashes": F.lit(2), "host": F.lit(3)}))
    texts = [(r["page_id"], r["text"]) for r in found.collect()]
    whole = "Our site\nText of two\nMore of two\nAll rights reserved by Our site"
    alone = whole.replace("two", "one")
    expected = [
        (1, "Text of one\nMore of one"),
        # A page and its copy prove nothing about each other; both are held against the next that differs.
        (2, "Text of two\nMore of two"), (2, "Text of two\nMore of two"), (3, whole),
        (4, "Quote\np"), (5, "Quote\nq"), (6, ""), (None, alone), (7, "x"), (8, ""),
        (9, "\n".join(prose)), (10, "\n".join([*prose, "end"])),
    ]
    schema = "a long, b string"
    assert listed(spark.createDataFrame(texts, schema)) == listed(spark.createDataFrame(expected, schema))


def by_hand(table):
    """Texts of (page_id, url, html) rows, hosts one by one."""
    parsed = []
    for page_id, url, page in table:
        own = pages.lines(page or "")
        host, path = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*))?", url or "").groups("")
        parsed.append((host, (path, url is not None, url or "", page_id), [t for t, _, _ in own], pages.chosen(own)))
    lost = {}
    for host in {h for h, *_ in parsed}:
        firsts = {}
        for _, address, texts, left in sorted((p for p in parsed if p[0] == host), key=lambda p: p[1]):
            firsts.setdefault(str((texts, left)), (address[0], texts, left))
        ranked, witnesses, common = list(firsts.items()), Counter(), {}
        for i, (key, (path, texts, left)) in enumerate(ranked):
            beside = [ranked[j][1] for j in (i - 1, i + 1) if 0 <= j < len(ranked)]
            if not beside:
                continue
            nearest = max(beside, key=lambda other: len(commonprefix([path, other[0]])))
            places = pages.shared(texts, nearest[1])
            whole = all(i in places for i, _, _ in left)
            common[key] = [(i, is_open and not whole, text) for i, text, is_open in left if i in places]
            witnesses.update({text for _, _, text in common[key]})
        for key, found in common.items():
            lost[host, key] = {i for i, is_open, text in found if is_open or witnesses[text] > max(2, len(ranked) / 2)}
    return [
        "\n".join(text for i, text, _ in left if i not in lost.get((host, str((texts, left))), ()))
        for host, _, texts, left in parsed
    ]


def invented_sites():
    """Sites with and without articles: menus and notices on every page, passages on a few, copies and later versions."""
    dice = random.Random(11)
    rows = []
    for site in range(8):
        menu = "".join(f"<div>{sentence((site, 'menu', i), 3)}</div>" for i in range(25))
        notice = f"<p>{sentence((site, 'notice'), 40)}</p>"
        passages = [f"<p>{sentence((site, 'passage', i), 40)}</p>" for i in range(3)]
        element = ("div", "article")[site % 2]
        bodies = []
        for number in range(3 + 4 * site):
            own = [f"<p>{sentence((site, number, i), dice.choice((4, 40)))}</p>" for i in range(dice.randint(1, 5))]
            if dice.random() < 0.3:
                own.insert(dice.randint(0, len(own)), dice.choice(passages))
            if dice.random() < 0.3:
                own.append(f"<p><a href=/>{sentence((site, 'link'), 3)}</a></p>")
            if site % 4 == 1:
                own.append(notice)
            bodies.append("".join(own))
        bodies += [bodies[0]] * 3 + [f"{bodies[1]}<p>{sentence((site, 'later', i), 4)}</p>" for i in range(1 + (site > 1))]
        for body in bodies:
            path = "/".join(dice.choices(("a", "b", "news", "2024"), k=dice.randint(1, 3)))
            url = f"http://site{site}.example/{path}/{dice.randint(0, 99)}"
            rows.append((len(rows), url, f"{menu}<{element}>{body}</{element}>{notice}"))
    dice.shuffle(rows)
    return rows


def test_sites_by_hand(spark):
    rows = invented_sites()
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r["page_id"]: r["text"] for r in pages.main_texts(table).collect()}
    expected = by_hand(rows)
    assert [found[page_id] for page_id, _, _ in rows] == expected
    # Without articles differencing does the work: menu and notice go from every page, the rest stays.
    zones_only = ["\n".join(t for _, t, _ in pages.chosen(pages.lines(page))) for _, _, page in rows]
    assert sum(a != b for a, b in zip(expected, zones_only)) > len(rows) / 2
    plain = [(url, text) for (_, url, page), text in zip(rows, expected) if "<div><p>" in page]
    for url, text in plain:
        site = int(url.removeprefix("http://site").split(".")[0])
        assert not {sentence((site, "menu", i), 3) for i in range(25)} & set(text.split("\n"))
        assert sentence((site, "notice"), 40) not in text and text


def test_copies_and_templates(spark):
    """Pages that share most lines with both neighbours, and runs of copies up to the end of a host."""
    menu = "".join(f"<div>menu entry {i}</div>" for i in range(40))
    rows = [(i, f"http://h.example/{i:02}", f"{menu}<p>only here {min(i, 20)}</p>") for i in range(30)]
    found = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: f"only here {min(i, 20)}" for i in range(30)}


def test_empty_table(spark):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.main_texts(table).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<div class="layout has-sidebar"><article><p>main text</p></article></div>', ["main text"]),
        ('<article><h1 class="search-engines">Engines</h1><section id="related-work"><p>prose</p></section></article>',
         ["Engines", "prose"]),
        ('<article><p class="notice-period">Three months</p></article>', ["Three months"]),
        ('<div class="sidebar"><main><p>in main</p></main><p>beside</p></div>', ["in main"]),
        ('<article class="card">teaser</article><div><p>' + "main text " * 9 + "</p></div>", ["teaser", ("main text " * 9).strip()]),
        ('<article><p>a</p><div class="comments-section"><p>r</p></div><div id=commentList>x</div><p class="site-nav">n</p></article>',
         ["a"]),
        ('<article>a</article><p>a loose line</p>', ["a"]),
    ],
)
def test_names_of_elements(html, text):
    if "loose" in html:
        html = html.replace("<article>a", "<article>a longer article than the loose line")
        text = ["a longer article than the loose line"]
    assert [line for _, line, _ in pages.chosen(pages.lines(html))] == text
