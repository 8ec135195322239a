"""HTML extraction, URL filter and archives."""

from __future__ import annotations

import fnmatch
import hashlib
import random
import re
from collections import defaultdict
from html.parser import HTMLParser

import pytest

from ledgerlake.llm import html_paths, url_filter, warc
from ledgerlake.session import scratch_path

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="layout"><div class="post-17 entry"><h1>Title &amp; more</h1>
<p>First <b>bold</b>&nbsp;words,\n and a long enough sentence to be the text of the page.<p>Second paragraph &lt;tag&gt; of the article body.
<script>var x = "<p>no</p>";</script><form><input><label>Name</label></form><div class="ad">Buy now</div></div>
<aside>Aside</aside><div id="comments"><p>A reader comment that is quite long as well.</p></div></div><footer>&copy; 2024</footer></body></html>"""


@pytest.fixture
def pages(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "page_id long, url string, html string")
    return build


def test_article_without_surroundings(pages):
    df = html_paths.extract(pages((1, "http://a.example/x", PAGE)))
    row = df.first()
    assert row.text == ("Title & more\nFirst bold words, and a long enough sentence to be the text of the page.\n"
                        "Second paragraph <tag> of the article body.")
    assert row.n_chars == len(row.text) and df.columns == ["page_id", "url", "text", "n_chars"]


def test_consensus_overrules_a_page(pages):
    """The other pages of a host decide which container holds the text."""
    def page(body, side):
        return f"<body><div class='box{len(side)}'><p>{body}</p></div><div class='extra'><p>{side}</p></div></body>"

    rows = [(k, "http://h.example/", page("main text of the page " * 20, "short")) for k in range(5)]
    odd = (9, "http://h.example/", page("brief main text", "a very long side text that outweighs all others " * 20))
    got = {r.page_id: r.text for r in html_paths.extract(pages(*rows, odd)).collect()}
    assert got[9] == "brief main text"
    alone = html_paths.extract(pages(odd)).first().text
    assert alone.startswith("a very long side")


def test_templates_of_a_host_beyond_the_best_voted(pages):
    """30 themes on one host: in each, three pages outvote the one whose side text is longer than its article."""
    themes = [f"theme{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(30)]

    def page(theme, body, side):
        return f"<body><div class='{theme}'><p>{body}</p></div><div class='{theme}x'><p>{side}</p></div></body>"

    rows, odd = [], []
    for n, theme in enumerate(themes):
        rows += [(100 * n + k, "http://many.example/", page(theme, f"main text {k} of the page " * 20, "short")) for k in range(3)]
        odd.append((100 * n + 99, "http://many.example/", page(theme, f"brief text of {theme}", "a long side text that outweighs all others " * 9)))
    got = {r.page_id: r.text for r in html_paths.extract(pages(*rows, *odd)).collect()}
    assert [got[100 * n + 99] for n in range(30)] == [f"brief text of {theme}" for theme in themes]


@pytest.mark.parametrize("head, shown", [
    ('<article><header class="entry-header"><h1>Title</h1></header>', True), ('<div class="post"><div class="post-header"><h1>Title</h1></div>', True),
    ('<main><div class="header"><h1>Title</h1></div>', True), ('<article><header><h1>Title</h1></header>', True),
    ('<div class="post"><div class="site-header"><h1>Title</h1></div>', False), ('<header class="top"><h1>Title</h1></header><article>', False),
    ('<article><nav class="entry-nav"><h1>Title</h1></nav>', False), ('<article><div class="entry-share header"><h1>Title</h1></div>', False)])
def test_titles_in_an_articles_own_header(pages, head, shown):
    body = "A sentence of the article that is long enough to be its text."
    got = html_paths.extract(pages((1, "http://t.example/", f"<body>{head}<p>{body}</p></body>"))).first().text
    assert got == (f"Title\n{body}" if shown else body)


class Plain(HTMLParser):
    """Blocks of a page by the standard library's parser, with the chain of tags and classes that holds each."""

    def __init__(self, html):
        super().__init__()
        self.open, self.held, self.linked, self.blocks = [], "", 0, []
        self.feed(html or "")
        self.close()
        self.cut()

    def cut(self):
        text = " ".join(self.held.split())
        if text:
            self.blocks.append((text, self.linked, tuple(step for _, step, _ in self.open if step)))
        self.held, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in html_paths.VOID:
            self.held += " " * (tag == "br")
            return
        if tag in html_paths.BLOCKS:
            if any(name == "p" for name, _, _ in self.open):
                self.handle_endtag("p")
            self.cut()
        classes = (dict(attrs).get("class") or "").split()
        gone = tag in {"head", "nav", "header", "footer", "aside", "form", "script", "style"} or bool(
            {w for c in classes for w in re.findall("[a-z]+", c)} & {"ad", "notice", "cookie", "comments", "sidebar", "related", "promo"})
        step = ".".join([tag, *sorted(re.sub(r"\d", "", c) for c in classes)]) if tag in html_paths.CONTAINERS and not gone else ""
        self.open.append((tag, step, gone or bool(self.open) and self.open[-1][2]))

    def handle_endtag(self, tag):
        if any(name == tag for name, _, _ in self.open):
            while True:
                if self.open[-1][0] in html_paths.BLOCKS:
                    self.cut()
                if self.open.pop()[0] == tag:
                    break

    def handle_data(self, data):
        if not (self.open and self.open[-1][2]):
            self.held += data
            self.linked += len(data.strip()) * any(name == "a" for name, _, _ in self.open)

    def scores(self):
        found = {}
        for text, linked, chain in self.blocks:
            for depth in range(len(chain), 0, -1):
                name = chain[depth - 1]
                weight = 1.5 if name.split(".")[0] in ("article", "main") else 0.5 if name in ("html", "body") else 1.0
                score = max(0, len(text) - 2 * linked) * 0.9 ** (len(chain) - depth) * weight
                found[chain[:depth]] = found.get(chain[:depth], 0) + score
        return found


def test_whole_table_equals_plain_python(spark):
    """Scores, votes per host and texts of all given pages, by another parser and without Spark."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    parsed, votes = {r.page_id: Plain(r.html) for r in rows}, defaultdict(int)
    hosts = {r.page_id: r.url.split("://")[1].split("/")[0].lower() for r in rows}
    for r in rows:
        scores = parsed[r.page_id].scores()
        for path, score in scores.items():
            if score >= 0.5 * max(scores.values()):
                votes[hosts[r.page_id], path] += round(1000 * score / max(scores.values()))
    want = {}
    for r in rows:
        page = parsed[r.page_id]
        best = min(page.scores(), key=lambda path: (-votes[hosts[r.page_id], path], "/".join(path)), default=())
        want[r.page_id] = "\n".join(text for text, _, chain in page.blocks if chain[:len(best)] == best)
    got = html_paths.extract(spark.createDataFrame(rows))
    assert {r.page_id: r.text for r in got.collect()} == want


def test_page_edge_cases(pages, spark):
    rows = [(1, None, None), (2, "no host", ""), (None, "http://b.example", "plain text, no markup &amp; nothing"),
            (4, "http://b.example", "<p>unclosed <b>bold <i>x"), (4, "http://b.example", "<p>unclosed <b>bold <i>x"),
            (5, "http://b.example", "<!-- never closed <p>x</p>"), (6, "http://b.example", "<script>never closed <p>x</p>"),
            (7, "http://b.example", "< 3 and <unclosed 'quote <p>y</p>"), (8, "http://c.example", "<p>" + "long " * 60000 + "</p>")]
    df = pages(*rows).selectExpr("*", "'x' AS host", "'y' AS text", "1 AS paths")
    got = [(r.page_id, r.text) for r in html_paths.extract(df).collect()]
    assert len(got) == len(rows) and (1, "") in got and (2, "") in got and got.count((4, "unclosed bold x")) == 2
    assert (None, "plain text, no markup & nothing") in got and (5, "") in got and (6, "") in got
    assert len(dict(got)[8]) == 5 * 60000 - 1
    assert html_paths.extract(pages()).count() == 0


def test_machine_equals_globs():
    """Random globs over random URLs; ``**`` over the whole URL, ``*`` inside the host."""
    rnd = random.Random(3)
    globs = ["".join(rnd.choice(["a", "b", ".", "/", "*", "**"]) for _ in range(rnd.randint(1, 9))) for _ in range(80)]
    globs = [g.replace("***", "**") for g in globs]
    urls = ["".join(rnd.choice("ab./") for _ in range(rnd.randint(0, 12))) for _ in range(400)] + [""]

    def fits(glob, url):
        import re
        parts = re.split(r"(\*\*|\*)", glob)
        return re.fullmatch("".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts), url, re.S) is not None

    got = url_filter.Machine.compile(globs).run([u.encode() for u in urls])
    assert got.tolist() == [[fits(g, u) for g in globs] for u in urls]
    assert fnmatch  # the standard globs have no ``**``


@pytest.mark.parametrize("url,rule,verdict", [
    ("HTTP://WWW.Example.COM/en/x?y", "www.example.com/en/", "allow"), ("https://m.example.com/en/", "example.com/en/", "block"),
    ("https://example.com/fr/", "com/", "allow"), ("http://a.net/es/1", "net/es/", "block"), ("http://a.net/de/1", None, "allow"),
    ("http://x.org?u=.net/es/", None, "allow"), ("http://com", None, "allow"), ("http://spam-farm.org/x", None, "block"),
    ("no scheme", None, "allow"), (None, None, "allow"), ("", None, "allow"), ("http://evilnet/es/", None, "allow"),
])
def test_rules(pages, url, rule, verdict):
    r = url_filter.judge(pages((1, url, None))).first()
    assert (r.rule, r.verdict) == (rule, verdict)


def test_url_edge_cases(pages):
    df = pages((1, "http://a.com/" + "x" * 50000, None), (1, "http://a.com/", None), (1, "http://a.com/", None)).selectExpr("*", "1 AS rule", "2 AS host")
    rows = url_filter.judge(df).collect()
    assert len(rows) == 3 and {r.rule for r in rows} == {"com/"} and url_filter.judge(pages()).count() == 0


def test_archive_round_trip(spark, pages):
    big = "payload " * 400
    rows = [(1, "http://a", big), (5, "http://b\nc", big), (3, None, big), (7, "u", "short"), (8, "u", "short"), (9, "u", None),
            (None, "u", big), (11, "u", ""), (12, "é", "é" * 600), (13, "u", "é" * 600), (13, "u", "é" * 600)]
    got = warc.archive(pages(*rows).selectExpr("*", "'z' AS digest", "'z' AS refers_to")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        assert all((r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest()) for r in by[page_id])
    types = {k: sorted((r.record_type, r.refers_to) for r in v) for k, v in by.items()}
    assert types[1] == types[3] == [("revisit", 5)] and types[5] == [("response", None)] and types[12] == [("revisit", 13)]
    assert types[13] == [("response", None)] * 2 and types[7] == types[8] == types[None] == [("response", None)]
    assert warc.archive(pages()).count() == 0


def test_bundles_are_seekable(spark, pages, monkeypatch):
    import zstandard

    rows = [(k, f"http://h/{k}", f"page {k} " * 3000) for k in range(120)]
    found = warc.write_bundles(pages(*rows).coalesce(1), scratch_path(spark, "t")).collect()
    uri = found[0].bundle
    table = warc.read_seek_table(uri)
    assert len(table) > 1 and {r.frame for r in found} == set(range(len(table)))
    for r in found[::17]:
        fields, block = warc.read_record(r.asDict())
        assert fields["WARC-Target-URI"] == f"http://h/{r.id}" and block.decode() == dict((a, c) for a, _, c in rows)[r.id]
    fs, path = warc.filesystem(uri)
    with fs.open_input_stream(path) as f:  # an ordinary reader goes through all frames and skips the table
        plain = zstandard.ZstdDecompressor().stream_reader(f.read(), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == 120
