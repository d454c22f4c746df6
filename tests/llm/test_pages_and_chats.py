"""Page text and chat formatting: brute force and exact round trips on small fixtures."""

from __future__ import annotations

import random
import re
import time

import pytest

from civiclake.llm import chat, html_text

ODD = ["", "ok", "</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>", "\\", "\\\\<|", "a\\<|b|>\\", "<<SYS>>\n<</SYS>>", "[[INST]", "<s></s>\n", "🙂\n\n", "[\\INST]", "<\\|end|>", "|>|><|<|", "$1 \\n"]


def test_chat_round_trip(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "system", None, "", "a\nb", "x\\", "<|end|>"]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, rng.choice((turn, 0)), rng.choice(roles), rng.choice([*ODD, None, " ".join(rng.choices(ODD, k=5))]), "x"))
    rows += rows[:3]  # repeated rows are turns too
    rows.append((500, None, "assistant", "null turn", "x"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_chats(chat.canonical_turns(df))
    got = {r.conv_id: r for r in chat.read_chats(formatted).collect()}
    marks = {r.conv_id: r for r in formatted.collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        assert [(t.role, t.text) for t in got[conv].turns] == [x[2:] for x in mine]
        assert list(got[conv].loss_texts) == [x[3] for x in mine if x[2] == "assistant"]
        text = marks[conv].formatted
        assert text.count(chat.TURN) == text.count(chat.END) == len(mine)
        body = text.replace(chat.TURN, "").replace(chat.END, "")
        assert not [c for c in chat.CONTROLS if c in body]
    assert chat.read_chats(chat.format_chats(chat.canonical_turns(df.limit(0)))).count() == 0


LAYOUTS = [
    ("id long, messages array<struct<role:string,content:string>>", (1, [("user", "q"), ("assistant", "a")]), [("user", "q"), ("assistant", "a")]),
    ("id long, conversations array<struct<`from`:string,value:string>>, extra int", (1, [("human", "q"), ("gpt", None)], 3), [("user", "q"), ("assistant", "")]),
    ("id long, prompt string, response string", (1, "q", "a"), [("user", "q"), ("assistant", "a")]),
    ("id long, instruction string, input string, output string", (1, "do", "", "a"), [("system", "do"), ("assistant", "a")]),
    ("id long, instruction string, input string, output string", (1, "do", "it", "a"), [("system", "do"), ("user", "it"), ("assistant", "a")]),
    ("id long, question string, answer string, score double", (1, "q", None, 1.0), [("user", "q"), ("assistant", "")]),
    ("id long, system string, prompt string, response string", (1, None, "q", "a"), [("user", "q"), ("assistant", "a")]),
]


@pytest.mark.parametrize(("schema", "row", "turns"), LAYOUTS)
def test_layouts(spark, schema, row, turns):
    df = chat.canonical_turns(spark.createDataFrame([row], schema))
    assert df.columns == ["conv_id", "turn", "role", "text"]
    assert [(r.role, r.text) for r in df.orderBy("turn").collect()] == turns


def test_conversations_without_messages_stay(spark):
    """Null, empty, one null message, one of nulls: only the last two have a turn."""
    rows = [(1, None), (2, []), (3, [None]), (4, [(None, None)]), (None, []), (5, [("user", "q"), ("assistant", "a")])]
    df = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")
    formatted = chat.format_chats(chat.canonical_turns(df))
    got = {r.conv_id: ([(t.role, t.text) for t in r.turns], list(r.loss_texts), r.formatted == "") for r in chat.read_chats(formatted).collect()}
    none, blank = ([], [], True), ([("", "")], [], False)
    assert got == {1: none, 2: none, 3: blank, 4: blank, None: none, 5: ([("user", "q"), ("assistant", "a")], ["a"], False)}


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "id long, body string"))


def test_fingerprint_ignores_order_and_case():
    assert chat.fingerprint(["B", "a"]) == chat.fingerprint(["A", "b"]) != chat.fingerprint(["a"])


def text_of(source: str, template=frozenset()) -> str:
    return html_text.main_text(html_text.analysed(source), template)


PAGES = [
    ("<article><h1>T</h1><p><b>a  b\n c<br>d<br><p>e&amp;f &lt;x&gt;&#8217;&nbsp;g</article><footer>no</footer>", "T\n\na b c d\n\ne&f <x>’ g"),
    ("<nav>m</nav><main><p>x</p><aside>y</aside><form>f<input></form><p>z", "x\n\nz"),
    ("<body><div class='sidebar'>s</div><div id=content><p>one</p><div class='ad-box ad'>buy</div><ul><li>i<li>j</ul></div></body>", "one\n\ni\n\nj"),
    ("<article><header><h2>H</h2><span>by me</span></header><p>t</p><section class='comments'><p>c</p></section></article><article class=comment>c2</article>", "H\n\nt"),
    ("plain <i>text</i> only", "plain text only"),
    ("<article>a<script>if (a<b) '</p>'</script>b<style>p{}</style><!-- x <p> -->c<noscript>n</noscript></article>", "abc"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table><p>4<div>5</div>6</article>", "1\n\n2\n\n3\n\n4\n\n5\n\n6"),
    ("<article><p>open <script>never closed", "open"),
    ("<article><p>5 < 6 and 7 > 3 <a href='x>y'>link</a></p></article>", "5 < 6 and 7 > 3 link"),
    ("<div role=navigation>n</div><p hidden>h</p><p style='display: none'>d</p><p>v</p>", "v"),
    ("", ""), ("<!-- only", ""), ("<article></article>", ""), ("</p></div>x", "x"), ("<p" * 50, ""),
]


@pytest.mark.parametrize(("source", "text"), PAGES[:-1])
def test_main_text(source, text):
    assert text_of(source) == text


def test_deep_and_broken_pages():
    assert text_of("<div>" * 30000 + "x") == "x"
    assert isinstance(text_of(PAGES[-1][0]), str)
    rng = random.Random(1)
    for _ in range(300):
        text_of("".join(rng.choice(["<p>", "</p>", "<article>", "</article>", "<td", ">", "<li>", "&amp", "&#x;", "a ", "<!--", "-->", "<script>", "</script>", '"', "'", "<b class=ad>", "<!", "</"]) for _ in range(40)))


def test_tag_soup():
    """An unmatched quote ends at the next >, a quote before white space or > closes, a tag without > is text."""
    assert text_of('<article><p title="x>Hello</p>') == "Hello"
    assert text_of('<article><p title="x>Hello</p><p class="y">there</p>') == "Hello\n\nthere"
    assert text_of("<article><p title='a>b' id=\"c\">it's \"so\"</p>") == "it's \"so\""
    assert text_of("<article><p>a <b and c") == "a <b and c"


def test_parse_takes_linear_time():
    for source in ("<b>" * 50000 + "</i>" * 50000, "<li><ul>" + "<b>" * 50000 + "<li></li>" * 50000, '<a ="<b" ' * 50000, "<p>" + "<b>" * 50000 + "<tr>" * 50000):
        begin = time.process_time()
        html_text.parse(source)
        assert time.process_time() - begin < 5  # a quadratic parse takes minutes


NAMES = [
    ('<p class="social-science">t</p>', "t"), ('<section id="related-work">t</section>', "t"), ('<div class="notice-period">t</div>', "t"), ('<p class="menu">t</p>', "t"),
    ('<h2 class="section-header">t</h2>', "t"), ('<div class="section-header">t</div>', "t"), ('<div class="comment-list">t</div>', ""), ('<div id="comments">t</div>', ""),
    ('<section class="relatedPosts">t</section>', ""), ('<p class="advert">t</p>', ""), ('<div id="cookie-banner-3">t</div>', ""), ('<div class="share">t</div>', ""), ('<article id="c1">t</article>', ""),
]


@pytest.mark.parametrize(("part", "text"), NAMES)
def test_names_count_as_a_whole(part, text):
    assert text_of(f"<article><h1>Own</h1>{part}</article>") == "\n\n".join(filter(None, ("Own", text)))


def test_comment_articles_outside_a_marked_block_go():
    assert text_of('<article><p>t</p></article><article id="c1"><p>first!</p></article><article id="comment-2"><p>no</p></article>') == "t"


def test_recurring_subtrees_go_before_the_content_is_chosen(spark):
    """A teaser article, and a block named like content, that stand on a host's pages are not its content."""
    teaser = "<article><h2>Read this too</h2><p>Best of the year.</p></article>"
    named = '<div class="content"><p>About this site.</p></div>'
    bodies = {f"teaser{i}": f"<div>{teaser}</div><article><p>Own {i}.</p></article>" for i in range(12)}
    bodies |= {f"named{i}": f'{named}<div class="entry"><p>Own {i}.</p></div>' for i in range(12)}
    # articles that few pages share, and an article that all pages copy, are content
    bodies |= {f"few{i}": f"{teaser if i < 4 else ''}<article><p>Own {i}.</p></article>" for i in range(12)}
    bodies |= {f"same{i}": f"<p>Page {i}</p>{teaser}" for i in range(12)}
    df = spark.createDataFrame([(k, f"http://{re.sub(r'[0-9]', '', k)}.example/", f"<body>{b}</body>") for k, b in bodies.items()], "page_id string, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    read = "Read this too\n\nBest of the year."
    for k, text in got.items():
        i = int(re.sub(r"\D", "", k))
        assert text == (read if k.startswith("same") else f"{read}\n\nOwn {i}." if k.startswith("few") and i < 4 else f"Own {i}."), k


def test_counts_and_deletions_against_brute_force(spark):
    """On how many distinct pages each subtree is, by comparing the subtrees' texts themselves."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        menu = "<ul>" + "".join(f"<li>{rng.choice('ab')}</li>" for _ in range(2)) + "</ul>"
        parts = [f"<p>own {i}</p>"] + rng.choices(["<div>boxed</div>", "<p>common</p>", "<section><p>deep</p></section>"], k=2)
        rows.append((i, f"http://h{i % 2}.example", f"<body>{menu}<article>{''.join(parts)}</article><div>fine <b>print</b></div></body>"))
    rows += rows[:7]  # copies count once
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen: dict = {}
    for host in ("h0", "h1"):
        for _, _, source in sorted({(0, u, h) for _, u, h in rows if host in u}):
            for part in {m[0] for m in re.finditer(r"<(ul|div|section)>.*?</\1>", source)} | set(re.findall("<li>.</li>|<b>print</b>|<p>common</p>|<p>deep</p>", source)):
                seen.setdefault((f"{host}.example", part), set()).add(source)
    counts = {(r.host, r.mark): r.n for r in html_text.subtree_counts(df.select(html_text.host_of(df.url).alias("host"), "html")).collect()}
    for (host, part), sources in seen.items():
        page = html_text.analysed(part)
        kind = html_text.OUTSIDE if part.startswith(("<ul", "<li", "<b", "<div>fine")) else html_text.ARTICLE_PARAGRAPH if part.startswith("<p") else html_text.CONTAINER
        assert counts[host, html_text.marked_hash(int(html_text.subtree_hashes(page)[1]), kind)] == len(sources), part
    assert counts["h0.example", None] == 60
    gone = {(h, p) for (h, p), s in seen.items() if len(s) >= 30 and p in ("<div>boxed</div>", "<section><p>deep</p></section>")}
    for r in html_text.extract(df).collect():
        left = next(h for i, _, h in rows if i == r.page_id)
        for host, part in gone:
            if f"h{r.page_id % 2}.example" == host:
                left = left.replace(part, "")
        assert r.text == text_of(left)


def test_site_templates(spark):
    common = "<p>Released under the MIT License.</p>"
    promo = "<div><p>Get our app today</p></div>"
    page = lambda i, host: f"<body><div><p>Site tagline of {host}</p></div><div id=content><p>Text {i}</p>{common if i % 2 else ''}</div><div>Fine print</div></body>"
    art = lambda i: f"<article><p>Body {i}</p>{common}{promo}</article>"
    rows = [(i, "http://One.example:80/a", page(i, "one")) for i in range(12)] + [(100 + i, "https://u@two.example/b", art(i)) for i in range(12)]
    rows += [(200, "relative/url", page(1, "none")), (201, None, None), (202, "http://few.example", page(3, "few")), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert html_text.extract(df).count() == len(rows)
    for i in range(12):
        # without an article the recurring blocks around and in the content are the site's
        assert got[i].text == f"Text {i}"
        # in an article only recurring containers are, not paragraphs
        assert got[100 + i].text == f"Body {i}\n\nReleased under the MIT License."
    assert got[200].text == "Text 1\n\nReleased under the MIT License." and got[201].text == "" and got[202].text.startswith("Text 3")
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract(df.limit(0)).count() == 0


ROOTS = ["<div id=content>{}</div>", "<div role=main>{}</div>", "{}"]


@pytest.mark.parametrize("root", ROOTS)
def test_copies_are_no_template(spark, root):
    """A third of a host's pages without an article are copies, or near copies, or share a passage: all are content."""
    html = lambda body: f"<html><body>{root.format(body)}</body></html>"
    own = lambda i: f"<h2>Head {i}</h2><p>Own <span>text</span> {i}</p><ul><li>item</li></ul>"
    same = "<p>Copied one.</p><p>Copied two.</p>"
    said = "<p>A passage of many.</p>"
    bodies = {f"{kind}{i}": f"{own(i)}{said if i % 3 == 0 else ''}" for kind in ("copies", "near", "few") for i in range(10 if kind == "few" else 30)}
    bodies |= {f"copies{i}": same for i in range(30, 60)} | {f"near{i}": f"{same}<p>But {i}.</p>" for i in range(30, 45)} | {f"few{i}": same for i in range(30, 33)}
    df = spark.createDataFrame([(k, f"http://{re.sub(r'[0-9]', '', k)}.example/{k}", html(b)) for k, b in bodies.items()], "page_id string, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == {k: text_of(f"<article>{b}</article>") for k, b in bodies.items()}
    assert got["near31"] == "Copied one.\n\nCopied two.\n\nBut 31."


@pytest.mark.parametrize("root", ["<article>{}</article>", "{}"])
def test_notice_on_all_pages_goes(spark, root):
    """A paragraph on all distinct pages of a host is the site's; one on all copies of a page, or on most pages, is not."""
    notice = "<p>We use cookies.</p>"
    bodies = {f"all{i}": f"<p>Own {i}.</p>{notice}" for i in range(30)} | {f"most{i}": f"<p>Own {i}.</p>{notice if i % 5 else ''}" for i in range(30)} | {f"copies{i}": f"<p>Own.</p>{notice}" for i in range(30)}
    df = spark.createDataFrame([(k, f"http://{re.sub(r'[0-9]', '', k)}.example/", root.format(b)) for k, b in bodies.items()], "page_id string, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == {k: f"Own {k[3:]}." if k.startswith("all") else text_of(f"<article>{b}</article>") for k, b in bodies.items()}


def test_inline_text_of_articles_stays(spark):
    df = spark.createDataFrame([(i, "http://a.example", f"<article><p><span>Note:</span> body {i}</p></article>") for i in range(12)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(df).collect()} == {f"Note: body {i}" for i in range(12)}


def test_subtree_hash_sees_structure():
    one, two, three = (html_text.analysed(f"<div>{x}</div>") for x in ("<p>a</p><p>b</p>", "<p>a</p><p>b </p>", "<p>a<b>b</b></p>"))
    roots = [html_text.subtree_hashes(p)[1] for p in (one, two, three)]
    assert roots[0] == roots[1] != roots[2]


def test_hosts(spark):
    given = ["http://A.b.c/x", "HTTPS://u:p@h.org:8080?q", "//x.y/z", "ftp://f", None, "", "nonsense"]
    df = spark.createDataFrame([(u,) for u in given], "url string")
    assert [r[0] for r in df.select(html_text.host_of(df.url)).collect()] == ["a.b.c", "h.org", "", "f", "", "", ""]


def test_pattern_matches_whole_comment():
    assert re.sub(html_text.TOKEN, "", "<!-- <p> --!><b>x</b>-->y") == "y"
