import os
import random
import re
import time

import pytest

from trackloom.llm import html_text as H

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

LONG = "This is a paragraph of running text that is long enough to be dense, and it goes on. "


@pytest.mark.parametrize(("page", "text"), [
    ("", ""),
    ("   \n ", ""),
    ("plain text only", "plain text only"),
    ("<p>a<p>b", "a\n\nb"),
    ("<article><h1>T &amp; U</h1><p><b>one<br>two</b>\n three &#233;<p>four</article>", "T & U\n\none two three é\n\nfour"),
    ("<body><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<body><p>open <b>never closed", "open never closed"),
    ("<body><p>x</p><!-- never closed <p>y</p>", "x"),
    ("<p>1 < 2 &lt; 3</p>", "1 < 2 < 3"),
    ("<p>a&nbsp;\u00a0 b</p>", "a b"),
    ('<p title="a > b">q</p>', "q"),
    ("</div></p><p>a</span></p>", "a"),
])
def test_small_pages(page, text):
    assert H.main_text(page) == text


BOILER = [
    "<nav><ul><li><a href='/a'>Menu entry</a></li></ul></nav>", "<header><h2>Site</h2></header>", "<footer>&copy; somebody</footer>", "<aside><p>" + LONG * 2 + "</p></aside>",
    "<div class='ad'>" + LONG + "</div>", "<div id='cookie-notice'><p>" + LONG + "</p></div>", "<form><label>Name</label><input name=q><button>Go</button></form>", "<section class='comments'><div class='comment'><p>" + LONG * 3 + "</p></div></section>",
    "<div role='navigation'>" + LONG + "</div>", "<div hidden>" + LONG + "</div>", "<ul class='related-links'><li><a href='x'>" + LONG + "</a></li></ul>",
]


@pytest.mark.parametrize("before", range(len(BOILER)))
@pytest.mark.parametrize("paragraphs", [1, 6])
def test_boilerplate_goes_and_the_article_stays_whole(before, paragraphs):
    after = (before + 3) % len(BOILER)
    body = "".join(f"<p>{k} {LONG}</p>" for k in range(paragraphs))
    page = f"<!DOCTYPE html><html><head><title>t</title></head><body class='has-sidebar'>{BOILER[before]}<article><h1>Head</h1>{body}</article>{BOILER[after]}</body></html>"
    assert H.main_text(page) == "\n\n".join(["Head", *(f"{k} {LONG.strip()}" for k in range(paragraphs))])


def test_without_an_article_density_decides():
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><p>{LONG * 3}</p><p>{LONG * 2}</p><p>short end.</p></div></body>"
    assert H.main_text(page) == "\n\n".join([(LONG * 3).strip(), (LONG * 2).strip(), "short end."])


def test_deep_and_long_pages():
    assert H.main_text("<div>" * 20_000 + "<p>x y</p>") == "x y"
    assert len(H.main_text("<body>" + f"<p>{LONG}</p>" * 5000)) > 5000 * len(LONG) - 10
    assert H.main_text("<" * 50_000 + "a") and H.main_text("<a " + "b='" * 20_000) is not None


def test_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>", "clash"), (1, "u", "<p>é</p>", "clash"), (2, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted(map(tuple, H.extract_text(df).collect()), key=repr) == sorted([(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0)], key=repr)
    assert H.extract_text(df.limit(0)).collect() == []


def bare(page):
    """The page without what names its parts: only its shape and its text are left."""
    return re.sub(r"<(/?)(nav|header|footer|aside|form|article|main|section)\b", r"<\1div", re.sub(r'\s(class|id|role)="[^"]*"', "", page))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_density_alone_finds_the_article_of_nearly_all_pages(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    same = 0
    for page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        want, got = H.main_text(f"<body>{article}</body>"), H.main_text(bare(page))
        assert set(want.split("\n\n")) <= set(got.split("\n\n"))  # no block is lost
        assert H.main_text(page) == want
        same += want == got
    assert same >= 0.95 * len(pages)


def test_density_and_sums_by_hand():
    """Every node's figures from the definitions, each node by itself."""
    r = random.Random(3)
    for _ in range(40):
        page, depth = [], 0
        for _ in range(r.randint(3, 30)):
            if depth and r.random() < 0.4:
                page.append("</div>")
                depth -= 1
            elif r.random() < 0.3:
                page.append(f"<a href=x>{'l' * r.randint(0, 9)}</a>")
            elif r.random() < 0.5:
                page.append("<div>")
                depth += 1
            else:
                page.append("w" * r.randint(1, 40))
        tree = H.Tree("<body>" + "".join(page))
        density, sums, linked = H.densities(tree)
        n = len(tree.tags)

        def under(i, k):
            while k > i:
                k = tree.parents[k]
            return k == i

        def count(i, only_links=False):
            return sum(len("".join(t.split())) for k, t in tree.pieces if t and under(i, k) and (tree.links[k] or not only_links))

        def tags(i, name=None):
            return sum(under(i, k) and k != i and name in (None, tree.tags[k]) for k in range(n))

        share = count(1, True) / max(1, count(1))
        for i in range(n):
            assert density[i] == pytest.approx(H.density_of(count(i), count(i, True), tags(i), tags(i, "a"), share))
            own = [(len("".join(t.split())), tree.links[k]) for k, t in tree.pieces if t and k == i]
            text = H.density_of(sum(c for c, _ in own), sum(c for c, l in own if l), 0, 0, share)
            assert sums[i] == pytest.approx(text + sum(density[k] for k in range(n) if tree.parents[k] == i))
            assert linked[i] == pytest.approx(count(i, True) / max(1, count(i)))
        # The chosen top is a node of the greatest sum.
        content = H.chosen(tree)
        assert max(sums[1:]) == 0 or any(content[i] and sums[i] == pytest.approx(max(sums[1:])) for i in range(1, n))


def test_a_second_container_joins_and_a_menu_inside_goes():
    menu = "<ul>" + "".join(f"<li><a href='/{k}'>entry {k}</a></li>" for k in range(8)) + "</ul>"
    page = f"<body><div>{menu}</div><div><p>{LONG * 2}</p>{menu}<p>{LONG}</p><p>{LONG * 3}</p></div><div><p>{LONG * 2}</p><p>{LONG}</p></div><div>Imprint</div></body>"
    assert H.main_text(page) == "\n\n".join(x.strip() for x in (LONG * 2, LONG, LONG * 3, LONG * 2, LONG))


@pytest.mark.parametrize("page", ["<div>" * 90_000 + "</section>" * 90_000, "<b>" * 60_000 + "<p>x</p>" * 60_000, "<p><i>" * 80_000 + "</p>" * 80_000, "<ul>" + "<li><b>" * 90_000, "<table>" + "<tr><td>x" * 60_000 + "</tr>" * 60_000, "<span>" * 80_000 + "</b>" * 80_000])
def test_a_megabyte_of_nested_tags_takes_linear_time(page):
    begin = time.process_time()
    H.main_text(page)
    assert time.process_time() - begin < 4


PARTS = [f"{k} {LONG.strip()}" for k in range(6)]
SIX = "".join(f"<p>{t}</p>" for t in PARTS)
MENU = "<nav><ul>" + "".join(f"<li><a href='/{k}'>Entry {k}</a></li>" for k in range(6)) + "</ul></nav>"
TITLED = "".join(f"<li><a href='/{k}'>Title of the piece number {k}</a></li>" for k in range(12))


@pytest.mark.parametrize(("page", "blocks"), [
    (f"<div class='content-sidebar-wrap'><main><article>{SIX}</article></main><div class='sidebar'><p>{LONG}</p></div></div>", PARTS),
    (f"<div id='page' class='has-sidebar'><div class='entry'>{SIX}</div></div>", PARTS),
    (f"<div class='post no-comments'>{SIX}</div>", PARTS),
    (f"<form id='aspnetForm'><div>{SIX}</div></form>", PARTS),
    (f"<form id='aspnetForm'>{MENU}<article>{SIX}</article></form>", PARTS),
    (f"<article><header><h1>Head</h1><p class='lead'>Lead text.</p></header>{SIX}</article>", ["Head", "Lead text.", *PARTS]),
    (f"<article><div class='header'><h1>Head</h1></div>{SIX}</article>", ["Head", *PARTS]),
    (f"<article>{SIX}<p class='ad-hoc'>An aside that is none.</p><section id='related-work'><p>Others.</p></section></article>", [*PARTS, "An aside that is none.", "Others."]),
    (f"<article><h1>Head</h1><ul>{TITLED}</ul></article>", ["Head", *(f"Title of the piece number {k}" for k in range(12))]),
    (f"<div class='page-wrap widget'><div class='text'>{SIX}</div></div>", PARTS),
    (f"<div class='sidebar'><main>{SIX}</main></div>", PARTS),
    (f"<section class='comments'><article>{SIX}</article></section>", PARTS),
    (f"<article>{SIX}</article><section id='comments'><article class='comment'><p>{LONG * 9}</p></article></section>", PARTS),
    (f"<article>{SIX}</article><div class='related-links'>{SIX}</div><div class='ad-slot top'>{SIX}</div>", PARTS),
    (f"<article>{SIX}<footer>Filed under x.</footer><aside><p>{LONG}</p></aside></article>", PARTS),
    (f"<div>{SIX}</div><div id='comments'>{SIX}{SIX}{SIX}</div>", PARTS),
    (f"<article><h1>Short.</h1></article><div class='ad'>{SIX}</div>", ["Short."]),
    (f"<article></article><div class='ad'>{SIX}</div><footer>Somebody</footer>", []),
    ("<form><label>Name</label><input name=q></form><footer>Somebody</footer>", []),
])
def test_a_name_never_takes_an_article_away(page, blocks):
    page = f"<html><head><title>t</title></head><body>{MENU}{page}<footer>&copy; somebody</footer></body></html>"
    assert H.main_text(page) == "\n\n".join(blocks)


@pytest.mark.parametrize(("value", "marked"), [("sidebar", True), ("page-sidebar", True), ("cookie-notice", True), ("related_links", True), ("post comments", True), ("ad-slot", True), ("has-sidebar", False), ("content-sidebar-wrap", False), ("no-comments", False), ("ad-hoc", False), ("related-work", False), ("entry-header", False), ("shared", False), ("", False), ("left", False)])
def test_whole_names_count(value, marked):
    assert bool(H._marks(value)) == marked


def plain_choice(tree):
    """The whole selection from its definition: every quantity of every node from the list of the nodes under it."""
    n = len(tree.tags)
    above = [[] for _ in range(n)]
    for i in range(1, n):
        above[i] = [tree.parents[i], *above[tree.parents[i]]]
    under = [[k for k in range(n) if k == i or i in above[k]] for i in range(n)]
    size = lambda t: len("".join((t or "").split()))
    chars = [sum(size(t) for k, t in tree.pieces if k in set(under[i])) for i in range(n)]
    links = [sum(size(t) for k, t in tree.pieces if k in set(under[i]) and tree.links[k]) for i in range(n)]
    plain = [c - k for c, k in zip(chars, links)]
    body = tree.tags.index("body") if "body" in tree.tags else 0
    share = links[body] / max(1, chars[body])
    density = [H.density_of(chars[i], links[i], len(under[i]) - 1, sum(tree.tags[k] == "a" for k in under[i] if k != i), share) for i in range(n)]
    sums = []
    for i in range(n):
        own = [(size(t), tree.links[k]) for k, t in tree.pieces if k == i]
        sums.append(sum([H.density_of(sum(c for c, _ in own), sum(c for c, a in own if a), 0, 0, share), *(density[k] for k in range(1, n) if tree.parents[k] == i)]))
    # Names.
    names = {i for i in range(n) if tree.standing[i] in (H.NAMED_LOOSELY, H.NAMED_FIRMLY)}
    inside = lambda i: bool(names & {i, *above[i]})
    holders = [i for i in range(n) if tree.tags[i] in ("main", "article")]
    full = [i for i in holders if chars[i]]
    if full and all(inside(i) for i in full):
        i = min((i for i in full if plain[i] == max(plain[k] for k in full)))
        names -= {i, *above[i]}
    elif not holders:
        names -= {i for i in names if tree.standing[i] == H.NAMED_LOOSELY and plain[i] > plain[0] / 2 and (plain[i] >= 250 or any(re.fullmatch("p|h[1-6]", tree.tags[k]) for k in under[i]))}
    if inside(body):
        return [False] * n
    pick = lambda i: min((k for k in under[i] if not inside(k)), key=lambda k: (-sums[k], k))
    top = pick(body)
    top = ([k for k in [top, *above[top]] if k > 0 and tree.tags[k] == "article"] or [top])[-1] if any(tree.tags[k] == "article" for k in above[top]) else top
    path = {body, *([top, *above[top]][: [top, *above[top]].index(body)])}
    threshold = min([density[top], *(density[k] for k in path - {body})]) if top != body else density[top]
    roots = {top}
    for i in range(n):
        if i and tree.parents[i] in path and i not in path and not inside(i) and not (top in above[i] or i == top):
            if sums[pick(i)] >= threshold > 0:
                roots.add(pick(i))

    def taken(menus):
        def kept(i):
            chain = [i, *above[i]]
            mine = [k for k in chain if k in roots]
            if not mine:
                return False
            between = chain[: chain.index(mine[0])]
            return not any(inside(k) or (menus and tree.tags[k] in H.BLOCKS and links[k] / max(1, chars[k]) > 0.5 and density[k] < threshold) for k in between)

        return [kept(i) for i in range(n)]

    with_menus, without = taken(True), taken(False)
    length = lambda some, i: sum(len(t) for k, t in tree.pieces if t and some[k] and k in under[i])
    outer = [i for i in holders if not set(above[i]) & set(holders)]
    lists = [i for i in outer if 2 * length(with_menus, i) < length(without, i)]
    return [a or (b and any(k in under[i] for i in lists)) for k, (a, b) in enumerate(zip(with_menus, without))]


def test_the_whole_selection_on_random_trees():
    r = random.Random(11)
    tags = ["div"] * 5 + ["p", "ul", "li", "section", "article", "main", "header", "form", "nav", "aside", "footer", "span", "h2"]
    names = ["", "", "", " class='sidebar'", " class='ad'", " id='comments'", " class='has-sidebar'", " role='menu'", " class='header'"]
    for turn in range(400):
        page, opened = [], []
        for _ in range(r.randint(3, 45)):
            kind = r.random()
            if opened and kind < 0.3:
                page.append(f"</{opened.pop()}>")
            elif kind < 0.45:
                page.append(f"<a href=x>{'l' * r.randint(0, 12)}</a>")
            elif kind < 0.75:
                opened.append(r.choice(tags if turn % 2 else tags[:7]))
                page.append(f"<{opened[-1]}{r.choice(names)}>")
            else:
                page.append(r.choice(["w ", "word "]) * r.randint(1, 40))
        tree = H.Tree("<body>" + "".join(page))
        assert H.chosen(tree) == plain_choice(tree), "".join(page)
