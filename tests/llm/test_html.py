import html as entities
import random
import re

import pytest

from spanframe.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x:1}</style><script>var a = "</p><p>no";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice"><p>We use cookies</p></div>%s
<aside><p>Side</p></aside><form><p>Name <input></p></form><section id="comments"><p>First!</p></section><footer>&copy; me</footer></body></html>"""


def page(k, body):
    return (k, f"https://www.site.org:80/{k}?q=1", PAGE % body, "x", "y", 7)


def texts(spark, *hosts):
    """Texts of pages, a list a host."""
    pages = [(1000 * h + k, f"http://h{h}.net/{k}", b) for h, bodies in enumerate(hosts) for k, b in enumerate(bodies)]
    found = {r["page_id"]: r["text"] for r in html.extracted(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    return [[found[1000 * h + k] for k in range(len(bodies))] for h, bodies in enumerate(hosts)]


def prose(rng, n=30):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_pages(spark):
    a = '<article><h1>Title %d</h1><p><b>One</b> two&nbsp;&amp;lt;<br>three<p>Four\n  <i>fi</i>ve<div class="ad">Buy</div><ul><li>x<li>y</ul><table><tr><td>c<td>d</table><!-- <p>gone</p> --><footer>by me</footer></article>'
    pages = [page(k, a % k) for k in range(4)] + [
        (10, None, None, None, None, None),
        (11, None, "", None, None, None),
        (12, "http://other.net/a", "<p>Plain text &lt;b&gt; here<p>and there", None, None, None),
        (13, "http://third.net/", "<body><div id=menu>no</div><div class=content><p>Some long main text of this page.</p><div><p>More.</p></div></div><div class=sidebar><p>no</p></div>", None, None, None),
        (14, "http://broken.net/", '<div title="a > b"><p>ok<p', None, None, None),
        (15, "http://void.net/", "<nav>n</nav><article><nav>no</nav></article><p>no article", None, None, None),
        page(0, a % 0),
    ]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string, host string, region string, text int")
    out = html.extracted(frame)
    got = {r["page_id"]: r["text"] for r in out.collect()}
    for k in range(4):
        assert got[k] == f"Title {k}\n\nOne two &lt; three\n\nFour five\n\nx\n\ny\n\nc d"
    assert got[10] == got[11] == "" and got[12] == "Plain text <b> here\n\nand there"
    assert got[13] == "Some long main text of this page.\n\nMore." and got[14].startswith("ok")
    assert out.count() == len(pages) and out.filter("n_chars <> length(text)").count() == 0
    assert html.extracted(frame.limit(0)).count() == 0
    found = {r["host"]: r for r in html.wrappers(html.read_pages(frame)).collect()}
    assert found["site.org"]["pages"] == 5 and "<article><h1>#</>" in found["site.org"]["wrapper"]


def test_names_of_layouts_headings_and_paragraphs_drop_no_main_text(spark):
    inner = '<article><h2 id="related-work">Work</h2><div class="related-work"><p>Prior</p></div><section id="discussion"><p>Talk</p></section><p id="notice-1">One</p><div data-id="ad">Two</div><div class="ad">no</div><div class="ad-slot">no</div><h3 id="discussion">End</h3></article>'
    want = "Work\n\nPrior\n\nTalk\n\nOne\n\nTwo\n\nEnd"
    pages = [f'<body><div class="{wrapper}">{inner}<section id="comments"><p>no</p></section></div></body>' for wrapper in ("layout has-sidebar", "sidebar-layout", "banner")]
    pages.append(f'<body>{inner}<section id="comments"><article><p>{"no " * 99}</p></article></section></body>')
    last = '<body><div class="sidebar-layout"><div class="content"><p>Yes</p></div><div class="sidebar">no</div></div></body>'
    assert texts(spark, *[[p] for p in pages], [last]) == [[want]] * 4 + [["Yes"]]


def test_the_wrapper_tells_fixed_text_from_slots(spark):
    """No mark and no name: what all pages of the host share above and below the slots goes; what differs stays."""
    rng = random.Random(3)
    bodies, want = [], []
    for k in range(12):
        title, paragraphs = prose(rng, 5), [prose(rng) for _ in range(1 + k % 4)]
        more = f"<div><p>{prose(rng, 9)}</p></div>" if k % 5 == 0 else ""
        bodies.append(
            f'<body><div class="x1"><p>Home</p><p>About us</p></div>{"<div><p>Spring sale</p></div>" if k % 3 else ""}<div class="x2"><h2>{title}</h2>'
            + "".join(f"<p>{p}</p>" for p in paragraphs)
            + f'{more}<p>All rights reserved by the makers of this site.</p></div><div class="x3"><ul><li><a href="/a">{prose(rng, 2)}</a><li><a href="/b">{prose(rng, 2)}</a></ul></div></body>'
        )
        want.append("\n\n".join([title, *paragraphs, *re.findall("<div><p>(.*?)</p></div>", more)]))
    # the menu stands directly beside the paragraphs
    flat = [b.replace('<div class="x2">', "").replace('</div><div class="x3">', '<div class="x3">') for b in bodies]
    assert texts(spark, bodies, flat) == [want, want]


def test_copies_are_no_template_and_layouts_of_one_host(spark):
    rng = random.Random(5)
    shared = [prose(rng, 40) for _ in range(3)]
    copies = [f"<body><p>n{k}</p><article>{''.join(f'<p>{p}</p>' for p in shared)}</article>" for k in range(9)]
    a = [f"<body><nav>n</nav><article><p>{prose(rng)}</p></article></body>" for _ in range(6)]
    b = [f"<body><div class=wide><div><article><h1>{prose(rng, 3)}</h1><p>{prose(rng)}</p></article></div><p>{prose(rng, 4)}</p></div></body>" for _ in range(3)]
    found, same = texts(spark, a + b, copies)
    assert same == ["\n\n".join(shared)] * 9
    assert found[:6] == [re.search("<p>(.*?)</p>", x)[1] for x in a]
    assert found[6:] == ["\n\n".join(re.search("<h1>(.*?)</h1><p>(.*?)</p>", x).groups()) for x in b]


def test_deep_and_wide_pages(spark):
    rng = random.Random(6)
    tags = ["p", "h2", "ul", "blockquote", "pre"]
    wide = "<article>" + "".join(f"<{t}>{k}</{t}>" for k, t in enumerate(rng.choices(tags, k=20_000))) + "</article>"
    deep = "<div>" * 10_000 + "<p>deep</p>" + "</div>" * 10_000
    unclosed = "<div><p>" * 10_000 + "end"
    found = texts(spark, [deep, deep.replace("deep", "down"), unclosed], [wide])
    assert found == [["deep", "down", "end"], ["\n\n".join(map(str, range(20_000)))]]


def test_fixed_text_of_articles_stays(spark):
    """Headings and closing lines that every page of a host has are text of its articles."""
    rng = random.Random(11)
    parts = [[prose(rng, 4), prose(rng), prose(rng)] for _ in range(6)]
    pages = [f"<body><p>Menu</p><article><h1>{a}</h1><h2>Ingredients</h2><p>{b}</p><h2>Method</h2><p>{c}</p><p>See also the notes.</p></article><p>All rights reserved.</p></body>" for a, b, c in parts]
    # without a mark, what stands between slots
    plain = [p.replace("<article>", "<div class=text>").replace("</article>", "</div>") for p in pages]
    want = [[a, "Ingredients", b, "Method", c] for a, b, c in parts]
    assert texts(spark, pages, plain) == [["\n\n".join([*w, "See also the notes."]) for w in want], ["\n\n".join(w) for w in want]]


def test_all_articles_of_a_page_stay(spark):
    rng = random.Random(12)
    parts = [[prose(rng, 200), prose(rng, 10)] for _ in range(6)]
    pages = [f"<body><nav>n</nav><article><p>{a}</p></article><div><article><p>{b}</p></article></div><article><p>The same everywhere</p></article></body>" for a, b in parts]
    assert texts(spark, pages) == [[f"{a}\n\n{b}\n\nThe same everywhere" for a, b in parts]]


def test_names_inside_articles(spark):
    """Inside an article names drop adverts and comments; forms and lists of links go by what they hold."""
    rng = random.Random(13)
    pages, want = [], []
    for _ in range(6):
        w = [prose(rng, 6) for _ in range(6)]
        pages.append(
            f"<body><article><p>{w[0]}</p><blockquote class=social>{w[1]}</blockquote><div class=search><p>{w[2]}</p></div><div class=alert>{w[3]}</div><fieldset><p>{w[4]}</p></fieldset>"
            f"<div class=search><p>Find {w[0]}</p><input name=q></div><fieldset><p>Name {w[1]}</p><select><option>x</select></fieldset><div class='advert'>{w[2]}</div><section class=comments><p>{w[3]}</p></section>"
            f"<div class=related><a href=/1>{w[4]}</a></div><p>{w[5]}</p><form><p>Mail {w[0]}</p></form></article></body>"
        )
        want.append("\n\n".join(w))
    assert texts(spark, pages) == [want]


def test_classes_with_one_beginning(spark):
    """Elements whose classes differ behind their twentieth character are different ones."""
    rng = random.Random(14)
    head = "component-of-the-page-number"
    pages, want = [], []
    for k in range(9):
        a, b = prose(rng, 3), prose(rng, 60)
        menu = f"<div class={head}-menubar><p>{a}</p></div>"
        pages.append(f"<body>{menu * (k % 3)}<div class={head}-maintext><p>{b}</p></div>{menu}</body>")
        want.append(b)
    assert texts(spark, pages) == [want]


def test_long_groups_are_repetitions():
    group = "<h2>a</h2><p>b</p><ul><li>c</li></ul><blockquote>d</blockquote><pre>e</pre><p>f</p><table><tr><td>g</table>"
    assert html.expression(tree(f"<div>{group * 3}</div>")).endswith(")+</>")
    assert html.flat(tree(f"<div>{group * 3}</div>")).count("blockquote") == html.flat(tree(f"<div>{group * 7}</div>")).count("blockquote") == 2


def test_generated_templates(spark):
    """Hosts with templates of their own: fixed frames, named and unnamed, around an article of known blocks."""
    rng = random.Random(15)
    hosts, want = [], []
    for h in range(6):
        inner = ["article", "main", "article class=post", "div role=main", "div class=entry-body", "section id=text"][h]
        frame_top = rng.choice(["<header><h1>Site</h1></header>", "<div class=top><p>Site name</p></div>", "<div class=navbar><a href=/>Home</a></div>"])
        bodies, texts_of = [], []
        for k in range(8):
            blocks = [("h1", prose(rng, 4))] + [(rng.choice(["p", "h2", "p", "blockquote"]), prose(rng, rng.randint(8, 40))) for _ in range(rng.randint(2, 9))]
            side = "".join(f"<li><a href=/{j}>{prose(rng, 2)}</a>" for j in range(4))
            html_of = "".join(f"<{t}>{x}</{t}>" for t, x in blocks)
            bodies.append(f"<html><body>{frame_top}<{inner}>{html_of}</{inner.split()[0]}><div class=sidebar><ul>{side}</ul></div><section id=comments><p>{prose(rng, 12)}</p></section><footer>(c) {k}</footer></body></html>")
            texts_of.append("\n\n".join(x for _, x in blocks))
        hosts.append(bodies)
        want.append(texts_of)
    assert texts(spark, *hosts) == want


def test_many_streams_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(html, "FAN", 4)
    rng = random.Random(16)
    bodies, want = [], []
    for _ in range(60):
        ps = [prose(rng, 5) for _ in range(rng.randint(1, 5))]
        shape = [rng.choice(["p", "h2", "pre"]) for _ in ps]
        bodies.append(f"<body><div><p>Menu</p></div><article>{''.join(f'<{t}>{p}</{t}>' for t, p in zip(shape, ps, strict=True))}</article></body>")
        want.append("\n\n".join(ps))
    assert texts(spark, bodies) == [want]


def test_by_host_without_broadcast(spark, monkeypatch):
    rng = random.Random(7)
    frame = spark.createDataFrame([(k, f"http://h{k % 3}.net/{k}", f"<body><div><p>Menu</p></div><div><p>{prose(rng)}</p></div>") for k in range(60)], "page_id bigint, url string, html string")
    near = sorted(map(tuple, html.extracted(frame).collect()))
    monkeypatch.setattr(html, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, html.extracted(frame).collect())) == near and not any("Menu" in r[2] for r in near)


def tree(body):
    return html.read_page(body)[0]


def test_wrappers_align():
    one, two = "<div><h2>a</h2><p>b</p><h2>c</h2><p>d</p></div>", "<div><h2>a</h2><p>b</p><ul><li>x</li><li>y</li></ul></div>"
    assert html.expression(tree(one)) == "<div>((<h2>#</><p>#</>)+)</>".replace("((", "(").replace(")+)", ")+")
    assert html.expression(tree(two)) == "<div><h2>#</><p>#</><ul>(<li>#</>)+</></>"
    both = html.expression(html.aligned(tree(one), tree(two)))
    assert "?" in both and "+" in both
    assert html.flat(html.unflat(html.flat(tree(two)))[0]) == html.flat(tree(two))


@pytest.mark.parametrize("seed", range(6))
def test_a_wrapper_matches_its_pages(seed):
    """Every page's text finds a node of its own path in the wrapper of the pages."""
    rng = random.Random(seed)

    def grown(depth):
        return "".join(f"<{t} class={rng.choice('ab')}>{grown(depth - 1) if depth and rng.random() < 0.6 else 'x'}</{t}>" for t in rng.choices(["div", "section", "ul", "h2"], k=rng.randint(1, 4)))

    pages = [grown(4) for _ in range(12)]
    wrapper = tree(pages[0])
    for p in pages[1:]:
        html.aligned(wrapper, tree(p))
    wrapper, nodes, ends = html.unflat(html.flat(wrapper))
    assert all(ends[x.at] > x.at and all(x.at < y.at < ends[x.at] for y in x.kids) for x in nodes)
    for p in pages:
        root, blocks = html.read_page(p)
        html.matched(wrapper, root)
        assert all(0 <= html._merged(b[0]).at < len(nodes) for b in blocks)


@pytest.mark.parametrize("seed", range(20))
def test_matching_is_a_common_subsequence(seed, monkeypatch):
    rng = random.Random(seed)
    a, b = (rng.choices("abcdefghij"[: 3 + seed % 8], k=rng.randint(0, 30)) for _ in range(2))
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            longest[i + 1][j + 1] = longest[i][j] + 1 if x == y else max(longest[i][j + 1], longest[i + 1][j])
    for held in (html.HELD_BITS, 40, 0):
        monkeypatch.setattr(html, "HELD_BITS", held)
        pairs = html.matching(a, b)
        assert len(pairs) == longest[-1][-1]
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_pages_against_a_plain_reading(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extracted(frame).collect()}
    for r in frame.collect():
        inside = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?p>|</?h1>", inside)]
        assert got[r["page_id"]] == "\n\n".join(filter(None, blocks))
