"""Main text of pages and WARC archives."""

import hashlib
import time

import pytest

from llm_data import scratch  # noqa: F401
from settlebook.llm import html, warc

PAGES = [
    ("<body><div class='ad'>Buy this now, a long and dense advert</div><article><h1>T</h1><p><b>hi.<br></article><footer>f</footer>", "T\nhi."),
    ("<div id=content><div class=post><h2>Head</h2><p>Some &amp; text <a href=x>link</a> more</p><ul><li>one<li>two</ul></div>"
     "<div class='comments'><p>first!</p></div></div>", "Head\nSome & text link more\none\ntwo"),
    ("plain text only", "plain text only"), ("", ""), (None, ""), ("<p>x", "x"), ("<script>a</script>", ""), ("<p></p><div> </div>", ""),
    ("<html><body><table><tr><td>a<td>b<tr><td>c</table>text</body></html>", "a\nb\nc\ntext"),
    ("<body><header><h1>Site</h1></header><main><h1>Art</h1><p>one two three four</p><aside>side</aside><p>five<!-- c --> six</p>"
     "<form>f<input></form></main><div class='cookie-notice'>We use cookies, accept all of them</div></body>", "Art\none two three four\nfive six"),
    ("<body><div><p>Para one is long enough to be something.</p><p>Para two too, really.</p></div><div><a href=1>l1</a> <a href=2>l2</a></div>",
     "Para one is long enough to be something.\nPara two too, really."),
    ("<p>a &lt;b&gt; &#233; &nbsp; c\n\t d</p><style>p{}</style><p title='>'>e</p>", "a <b> é c d\ne"),
    ("<ul><li><ul><li>x<li>y</ul><li>z</ul>", "x\ny\nz"),
    ("<body><nav><a href=/>home</a></nav><article><h1>T</h1><p>Text one.</p><section id='reader-comments'><p>I agree with all of this.</p></section>"
     "<div role=complementary>see also</div></article></body>", "T\nText one."),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


ARTICLE = "<h1>Head</h1><p>" + "A full article has much text. " * 8 + "</p><p>" + "It goes on for a while. " * 8 + "</p>"


@pytest.mark.parametrize("start,end", [
    ("<div class='content has-sidebar'>", "</div>"), ("<div class='site no-sidebar'>", "</div>"), ("<div id=page class=with-banner>", "</div>"),
    ("<form action=x>", "</form>"), ("<div class='sidebar-layout'>", "</div>"), ("<div class='menu-page'><article>", "</article></div>"),
    ("<form><div class='banner-wrap'><main>", "</main></div></form>")])
def test_wrappers_do_not_take_out_the_article(start, end):
    page = f"<body><nav><a href=/>home</a></nav>{start}{ARTICLE}<div class='sidebar'><p>see also</p></div>{end}<footer>f</footer></body>"
    text = html.main_text(page)
    assert text.startswith("Head\nA full article") and text.endswith("for a while.") and "home" not in text and "see also" not in text


@pytest.mark.parametrize("page", ["<div>" * 50000 + "x" + "</div>" * 20000, "<p " * 100000, "<a b='" * 50000, "<!--" * 50000,
                                  "</p>" * 50000 + "<p>x" * 50000, "<td>" * 30000 + "x", "<b><p>" * 20000, "<" * 100000, "&" * 100000])
def test_odd_pages_take_linear_time(page):
    began = time.time()
    html.main_text(page)
    assert time.time() - began < 20


PARAS = ["The first paragraph of this text says at some length what it is about, and why.",
         "A second one follows, with a <a href=/x>link in it</a>, as long texts have, and goes on for a while after that.",
         "A third ends the text with a few more words, so that it is clearly the main part of this page, as far as anyone can tell."]
TEXT = "".join(f"<p>{p}</p>" for p in PARAS)
LINES = [html.SPACE.sub(" ", __import__("re").sub("<[^>]*>", "", p)) for p in PARAS]
LINKS = "".join(f"<li><a href=/{w}>{w} page</a></li>" for w in "home news sport world about contact".split())
SHORT = "<p>Nice.</p><p>I agree with this.</p><p>Me too, thanks.</p>"


@pytest.mark.parametrize("page, lines", [
    (f"<body><article><h1>T</h1>{TEXT}<div class=feedback>{SHORT}</div></article></body>", ["T", *LINES]),
    (f"<body><div id=content><h1>T</h1>{TEXT}<div class=bottomlinks><ul>{LINKS}</ul></div></div></body>", ["T", *LINES]),
    (f"<body><article><h1>T</h1>{TEXT}<section class=related-work><h2>Earlier</h2><p>{PARAS[0]}</p></section></article></body>",
     ["T", *LINES, "Earlier", LINES[0]]),
    (f"<body><article><h1>T</h1>{TEXT}<div class=notice-period><p>{PARAS[2]}</p></div></article></body>", ["T", *LINES, LINES[2]]),
    (f"<body><article><header><h1>Headline</h1><p>By someone</p></header>{TEXT}</article></body>", ["Headline", "By someone", *LINES]),
    (f"<body><div><ul>{LINKS}</ul></div><div><h1>T</h1>{TEXT}</div><div>(c) 2020</div></body>", ["T", *LINES]),
    (f"<body><div class=x1><ul>{LINKS}</ul></div><div class=x2><div class=x3>{TEXT}</div><div class=x4><ul>{LINKS}</ul></div></div></body>", LINES),
    (f"<body><main><h1>T</h1>{TEXT}</main><section id=comments><article><p>{PARAS[0]}</p></article><article><p>{PARAS[2]}</p></article></section></body>",
     ["T", *LINES]),
    (f"<body><header><p>{PARAS[0]}</p></header><div>{TEXT}</div><footer><p>{PARAS[2]}</p></footer></body>", LINES),
    (f"<body><div class=reader-comments>{SHORT}</div><div class=post-body>{TEXT}</div><div class='cookie-notice'>{SHORT}</div></body>", LINES),
    (f"<body><nav><ul>{LINKS}</ul></nav><p>{PARAS[0]}</p><p>{PARAS[2]}</p><aside><p>see also this</p></aside></body>", [LINES[0], LINES[2]]),
    (f"<body><article><h2><a href=/t>A linked headline</a></h2>{TEXT}<ul><li><a href=/1>one source</a></ul></article></body>",
     ["A linked headline", *LINES, "one source"]),
])
def test_density_and_weights_decide(page, lines):
    assert html.main_text(page) == "\n".join(lines)


def test_density_is_what_decides_without_names(monkeypatch):
    page = f"<body><div><ul>{LINKS}</ul></div><div><h1>T</h1>{TEXT}</div><div>(c) 2020</div></body>"
    right = html.main_text(page)
    monkeypatch.setattr(html, "composite", lambda chars, tags, lc, lt, ratio: 1.0 if chars else 0.0)
    assert right == "\n".join(["T", *LINES]) != html.main_text(page)


def plain_measures(node, linked=False, inherited=1.0):
    """(chars, tags, link chars, link tags) of an element, by recursion, and of all below it."""
    here = linked or node.tag == "a"
    own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
    got, below = [own, 0.0, own if here else 0.0, 0.0], []
    for c in node.children:
        if not isinstance(c, str) and not c.out:
            (m, inner) = plain_measures(c, here, inherited * node.weight)
            below += inner
            inside = here or c.tag == "a"
            got = [got[0] + c.weight * m[0], got[1] + c.weight * (m[1] + (c.tag not in html.INLINE)),
                   got[2] + c.weight * m[2], got[3] + c.weight * (m[3] + inside)]
    return got, [(node, got, inherited * node.weight), *below]


@pytest.mark.parametrize("page", [p for p, _ in PAGES if p] + [f"<div class='notice box'>{TEXT}<span class=ad>x <b>y</b></span></div>{ARTICLE}<ul>{LINKS}</ul>"])
def test_densities_node_by_node(page):
    from math import e, log
    root = html.parse(page)
    html._unmark(root)
    order = html._walk(root)
    html._measure(order)
    _, nodes = plain_measures(root)
    (chars, _, link_chars, _) = nodes[0][1]
    ratio = link_chars / chars if chars else 0.0
    want = {}
    for node, (c, t, lc, lt), w in nodes:
        d = 0.0
        if c > lc:
            inner = log(c * lc / max(c - lc, 1) + ratio * c + e)
            d = w * c / max(t, 1) * max(log(max(c * max(t, 1) / (max(lc, 1) * max(lt, 1)), 1.0)), 0) / log(max(inner, 1.0) + 1)
        want[id(node)] = d
    assert {id(n) for n, _, _ in order} == set(want)
    for n, _, _ in order:
        assert n.density == pytest.approx(want[id(n)], rel=1e-9, abs=1e-12)
    for n, _, _ in order:
        def added(x):
            return sum((added(c) if c.tag in html.INLINE else want[id(c)]) for c in x.children if not isinstance(c, str) and not c.out)
        assert n.total == pytest.approx(added(n), rel=1e-9, abs=1e-12)


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], "page_id long, url string, html string, n_chars long, text string")


def test_extract_keeps_every_row(spark):
    rows = [(i, f"u{i}", p) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>no id</p>"), (0, "u0", PAGES[0][0])]
    got = html.extract(frame(spark, rows)).collect()
    want = [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(None, None, "no id", 5), (0, "u0", PAGES[0][1], 5)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert html.extract(frame(spark, rows).where("false")).count() == 0


def test_archive_round_trip(spark, scratch):
    big, other = "é<p>" * 400, "WARC/1.0\r\nWARC-Type: response\r\n\r\n" * 50
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (9, None, big), (3, "u", other), (4, "u", "x" * 999), (5, "u", "x" * 999),
            (6, "u", None), (7, "u", ""), (8, "u", "x" * 1000), (None, "u", "x" * 1000), (None, "u", "y" * 2000), (None, "u", "y" * 2000),
            (10, "u", "z" * 5000 + "\r\n\r\n"), (10, "u", "z" * 5000 + "\r\n\r\n"), (11, "u", "\r\n" * 700), (12, "u", "v" * 200_000)]
    path, run = warc.write(frame(spark, rows), scratch)
    got = warc.read(scratch, path, run).collect()
    assert len(got) == len(rows)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == data and j is not None]
        first = max(same) if same and len(data) >= 1000 else None
        revisit = first is not None and first != i
        want.append((i, "revisit" if revisit else "response", len(data), hashlib.sha1(data).hexdigest(), first if revisit else None,
                     None if revisit else data))
    have = [(r["page_id"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"],
             bytes(r["payload"]) if r["payload"] is not None else None) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert all(r["stated_digest"] == r["payload_digest"] for r in got)
    assert {r["target_uri"] for r in got if r["page_id"] == 2} == {"http://b/%0D%0AX: y"}


def test_archive_records_follow_the_format(spark, scratch):
    path, run = warc.write(frame(spark, [(1, "http://a/", "p" * 1500), (2, "http://b/", "p" * 1500)]), scratch)
    raw = b"".join(__import__("gzip").decompress(bytes(r["content"])) for r in spark.read.format("binaryFile").load(path + "/*.gz").collect())
    records, info = 0, [b for b in raw.split(b"WARC/1.0") if b"Type: warcinfo" in b]
    assert len(info) == 1 and warc.runs(scratch, path) == [run] and f"<urn:uuid:{run}>".encode() in info[0]
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.0"
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields)
        n = int(fields[b"Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        raw = rest[n + 4:]
        records += 1
    assert records == 3


def test_archive_of_nothing(spark, scratch):
    path, run = warc.write(frame(spark, [(1, "u", "x")]).where("false"), scratch)
    assert warc.read(scratch, path, run).count() == 0
