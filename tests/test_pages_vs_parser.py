"""Page text against a DOM-style walk with the standard-library HTML parser
(brute force, independent of the regex job) on the sf0.001 and sf0.01 pages."""

from html.parser import HTMLParser

from gleaner.functions import fixed
from gleaner.operators.article import page_bodies

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
SIBLINGS = {"dd", "dt", "li", "option", "p", "td", "th", "tr"}


class Walk(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = []          # (tag, dropped)
        self.raw_page, self.raw_article = [], None
        self.in_article = 0

    @property
    def page(self):
        return lines(self.raw_page)

    @property
    def article(self):
        return None if self.raw_article is None else lines(self.raw_article)

    def _say(self, text):
        for raw, on in ((self.raw_page, True), (self.raw_article, self.in_article)):
            if on:
                raw.append(text)

    def _dropped(self):
        return any(d for _, d in self.stack)

    def handle_comment(self, data):
        self._say("\n")

    def handle_startendtag(self, tag, attrs):
        self._say("\n")  # no content

    def handle_starttag(self, tag, attrs):
        self._say("\n")
        if tag in VOID:
            return
        if tag in SIBLINGS and self.stack and self.stack[-1][0] == tag:
            self.handle_endtag(tag)
        classes = set((dict(attrs).get("class") or "").split())
        drop = tag in fixed.BOILERPLATE_TAGS or tag in ("script", "style", "template") or \
            bool(classes & set(fixed.BOILERPLATE_CLASSES))
        self.stack.append((tag, drop))
        if tag == "article" and not self._dropped() and self.raw_article is None:
            self.raw_article = []
            self.in_article = len(self.stack)

    def handle_endtag(self, tag):
        self._say("\n")
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if self.in_article and i + 1 <= self.in_article:
                    self.in_article = 0
                del self.stack[i:]
                return

    def handle_data(self, data):
        if not self._dropped():
            self._say(data)


def lines(raw):
    return [s for s in (line.strip() for line in "".join(raw).splitlines()) if s]


import pytest


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_page_text_matches_parser(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("page_id", "html")
    raw = {r.page_id: r.html for r in pages.collect()}
    got = {r.page_id: (r.article_text, r.page_text) for r in page_bodies(pages).collect()}
    for pid, html in raw.items():
        w = Walk()
        w.feed(html)
        w.close()
        art = "\n".join(w.article) if w.article is not None else None
        assert got[pid] == (art, "\n".join(w.page)), pid


PARTS = ["<div>", "</div>", '<div class="menu">', "<div class='x ad y'>", '<div class="readme">', "<DIV CLASS=ad id=3>",
         '<div title="a > b" class="menu">', "<div data-class=ad>", "<span>", "</span>", "<span class=ad>", "<p>", "</p>",
         "<li>", "</li>", "<ul>", "</ul>", "<nav>", "</nav>", "<aside>", "</aside>", "<article>", "</article>", "<section>",
         "</section>", "<br>", '<img class="ad">', "<hr/>", '<div class="ad"/>', "<!-- <div class='ad'> -->",
         "<script>var t='</div><p>';</script>", "<style>p > a {}</style>", "one", " two ", "a < b", "&amp;lt;", "\n", "x > y"]


def test_nested_markup_matches_a_tree_walk(spark):
    """Random nesting, unclosed and stray tags: elements are removed up to their own end."""
    import random

    rnd = random.Random(5)
    html = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    html += [None, "", "<div class=menu><div>one</div>LEAK</div>", "<article><article>in</article>rest</article>after",
             "<div>" * 3000 + '<nav><nav>x</nav></nav>deep' + "</div>" * 3000]
    rows = spark.createDataFrame(list(enumerate(html)), "page_id int, html string")
    got = {r.page_id: r for r in page_bodies(rows).collect()}
    for i, text in enumerate(html):
        if text is None:
            assert got[i].article_text is None and got[i].page_text is None
            continue
        w = Walk()
        w.feed(text)
        w.close()
        want = ("\n".join(w.article) if w.article is not None else None, "\n".join(w.page))
        assert (got[i].article_text, got[i].page_text) == want, text
