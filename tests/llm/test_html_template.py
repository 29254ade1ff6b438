import html
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from sluicework.llm import html_template as module
from sluicework.llm.html_blocks import read_page
from sluicework.llm.html_template import _page_tokens, article_blocks, differentiated, equivalence_classes, main_text, nested_classes, outline_of, outlines

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PAGE = "page_id long, url string, html string"


def alone(source):
    return article_blocks(read_page(source), {}, frozenset())


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<article><h1>A &amp;amp; B</h1><p>one\n two<br>three<p>four <b>f</b>ive</article>", ["A &amp; B", "one two three", "four five"]),
        ("<nav>menu</nav><article>text<nav>in page</nav><aside>side</aside><form>form<input></form><script>var a='</p>';</script></article><footer>f</footer>", ["text"]),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header>text</article>", ["Title", "text"]),
        ("<div class='cookie-notice'>we use cookies</div><main><p>a</p><div class=ad>buy</div><div id='comments'><p>nice</p></div></main>", ["a"]),
        ("<article><p>text</p></article><section id=comments><article class=comment>long long long long comment</article></section>", ["text"]),
        ("<article><p>the text of it</p></article><div class=related><article><p>card</p></article></div>", ["the text of it"]),
        ("<div class='content has-sidebar'><article><p>text</p></article><div class=related><article>card</article></div></div>", ["text"]),
        ("<body class='sidebar-left'><form id=page><div><h1>Title</h1><div><p>a long text</p></div></div></form></body>", ["Title", "a long text"]),
        ("<div id=top><a href=x>link one</a> <a href=y>link two</a></div><div id=c><h1>T</h1><p>lead</p><div><p>much longer text of the page</p></div></div>", ["T", "lead", "much longer text of the page"]),
        ("<title>T</title><style>p{}</style><article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", ["one", "two", "a", "b"]),
        ("<!-- <article>no</article> --><article>yes<!-- no --></article>", ["yes"]),
        ('<article><p title="a > b">x</p><p class="it\'s>y</p></article>', ["x", "y"]),
        ("<article><p>x &lt;b&gt; &#233;&nbsp;&eacute; &copy; &unknown; &am</p>", ["x <b> é é © &unknown; &am"]),
        ("<article></article><div>else</div>", []),
        ("plain text only", ["plain text only"]),
        ("", []),
        ("<nav><a href=x>only a menu</a></nav>", []),
        ("<article><script>never closed", []),
        ("<div class=sidebar><h1>all named</h1><p>text</p></div>", ["all named", "text"]),
    ],
)
def test_blocks_of_a_page(source, expected):
    assert alone(source) == expected


def test_long_and_broken_pages():
    assert alone("<article>" + "<p>word </p>" * 50_000) == ["word"] * 50_000
    assert len(alone("<article>" + '<a "' * 20_000 + "x")) <= 1
    assert alone("<div>" * 3_000 + "deep") == ["deep"]
    assert alone("<article>" + "x " * 300_000) == [("x " * 300_000).strip()]


def _plain(source):
    """The article of a given page by string functions: it stands between tags of that name
    and holds headings, paragraphs, bold text and line breaks only."""
    inside = source[source.index("<article>") + 9 : source.index("</article>")]
    blocks = re.split("</?(?:p|h1)>", inside)
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    expected = sorted((r.page_id, r.url, _plain(r.html), len(_plain(r.html))) for r in pages.collect())
    assert sorted(map(tuple, main_text(pages).collect())) == expected


def _site(count, seed=1, notice="All text on this page is free to read.", prefix="http://One.example/"):
    """Pages of one template without any element that names the article, and their articles."""
    rng = random.Random(seed)

    def prose(n):
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))

    rows = []
    for i in range(count):
        title, paragraphs = prose(4), [prose(rng.randrange(8, 40)) for _ in range(rng.randrange(2, 6))]
        menu = "".join(f"<li><a href='/{k}'>{prose(1)}</a></li>" for k in range(rng.randrange(2, 5)))
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        source = f"<html><body><div><ul>{menu}</ul></div><div class=text><h1>{title}</h1><p>{notice}</p>{body}</div><div>{prose(3)}</div></body></html>"
        rows.append((i, f"{prefix}{i}", source, "\n\n".join([title, *paragraphs])))
    return rows


@pytest.mark.parametrize("entries", [1_000_000, 0])
def test_template_text_goes_and_slots_stay(spark, monkeypatch, entries):
    monkeypatch.setattr(module, "BROADCAST_ENTRIES", entries)
    site = _site(24)
    rows = [r[:3] for r in site] + [(900, None, None), (901, "no scheme", ""), (902, "http://one.EXAMPLE/x", site[3][2]), (902, "http://one.EXAMPLE/x", site[3][2]), (None, "http://two.example/", "<article>alone</article>")]
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 AS host_key", "2 AS nodes", "'x' AS text", "3 AS row_no")
    expected = [(i, u, t, len(t)) for i, u, _, t in site] + [(900, None, "", 0), (901, "no scheme", "", 0), (None, "http://two.example/", "alone", 5)]
    expected += [(902, "http://one.EXAMPLE/x", site[3][3], len(site[3][3]))] * 2
    assert sorted(map(tuple, main_text(df).collect()), key=str) == sorted(expected, key=str)


def test_copies_keep_their_text(spark):
    site = _site(1)
    rows = [(i, f"http://a.example/{i}", site[0][2]) for i in range(30)]
    text = site[0][3].replace("\n\n", "\n\nAll text on this page is free to read.\n\n", 1)
    assert {r.text for r in main_text(spark.createDataFrame(rows, PAGE)).collect()} == {text}


def test_few_pages_have_no_text_of_the_template(spark):
    rows = [r[:3] for r in _site(5)]
    assert all("free to read" in r.text for r in main_text(spark.createDataFrame(rows, PAGE)).collect())


def test_classes_are_those_of_whole_vectors(spark):
    """Occurrence vectors put together page by page, compared whole."""
    sources = [r[2] for r in _site(20)]
    pages = spark.createDataFrame([(7, i, s) for i, s in enumerate(sources)], "host_key long, row_no long, html string")
    found = {}
    tokens = equivalence_classes(pages)
    for r in tokens.collect():
        found.setdefault((r["class"], r.of_root), set()).add((r.token, r.kind))
    vectors = {}
    for at, source in enumerate(sources):
        for key, (count, *_) in _page_tokens(read_page(source)).items():
            vectors.setdefault(key, [0] * len(sources))[at] = count
    expected = {}
    for key, vector in vectors.items():
        if sum(map(bool, vector)) >= 10:
            expected.setdefault(tuple(vector), set()).add(key)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))
    assert {frozenset(t) for (_, root), t in found.items() if root} == {frozenset(expected[(1,) * 20])}
    # Menu entries and paragraphs vary in number: their classes lie in that of the page, and the notice in that of paragraphs.
    nested = nested_classes(tokens).collect()
    root = next(c for c, is_root in found if is_root)
    assert sorted(t for r in nested for t in r.tokens) == sorted(t for own in found.values() for t, _ in own if t)
    outer = {(r["class"] == root, r.nested_in == root): len(r.tokens) for r in nested}
    assert outer[True, False] == 1 and outer[True, True] > 3 and (False, True) in outer


def _unnamed(count, seed=3, prefix="http://c.example/"):
    """Pages whose menu, article and footer are elements of one path, and their articles."""
    rng = random.Random(seed)

    def prose(n):
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))

    rows = []
    for i in range(count):
        title, paragraphs = prose(4), [prose(rng.randrange(20, 40)) for _ in range(rng.randrange(2, 6))]
        menu = "".join(f"<li>{prose(2)}</li>" for _ in range(rng.randrange(2, 5)))
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        # The last two come apart one round after the table before them.
        source = f"<body><div>{prose(5)}<ul>{menu}</ul></div><div><h1>{title}</h1>{body}</div><div>{prose(9)}<table><tr><td>{prose(2)}</table></div><div><div>{prose(3)}</div></div></body>"
        rows.append((i, f"{prefix}{i}", source, "\n\n".join([title, *paragraphs])))
    return rows


@pytest.mark.parametrize("entries", [1_000_000, 0])
def test_position_tells_the_article_from_what_has_its_path(spark, monkeypatch, entries):
    monkeypatch.setattr(module, "BROADCAST_ENTRIES", entries)
    site = _unnamed(12)
    rows = [r[:3] for r in site] + [(70, "http://d.example/", "<article>alone</article>")]
    expected = sorted([(i, t) for i, _, _, t in site] + [(70, "alone")])
    assert sorted((r.page_id, r.text) for r in main_text(spark.createDataFrame(rows, PAGE)).collect()) == expected


def _plain_rounds(sources):
    """Tokens of valid classes after the last round: vectors and sequences whole, roles as they are put together."""
    pages = [outline_of(read_page(s)) for s in sources]
    roles = [{(kind, i): (kind, (o.paths if kind == 0 else o.texts)[i]) for kind, i in o.in_order()} for o in pages]
    before = None
    for rounds in range(100):
        vectors = {(0, 0): [1] * len(pages)}
        for at, page in enumerate(roles):
            for role in page.values():
                vectors.setdefault(role, [0] * len(pages))[at] += 1
        valid = {r: tuple(v) for r, v in vectors.items() if sum(map(bool, v)) >= max(2, len(pages) / 2)}
        if before == sorted(valid.values()):
            return rounds, before
        before = sorted(valid.values())
        classes = dict(valid)
        for vector in set(valid.values()):
            seen = {}
            for page in roles:
                run = [r for r in [(0, 0), *page.values()] if valid.get(r) == vector]
                for i, role in enumerate(run):
                    earlier = [r for r in run[:i] if role[0] == 1 or r[0] == 0]
                    seen.setdefault(role, set()).add(earlier[-1] if earlier else None)
            heads = [[r for r in seen if r[0] == kind and None in seen[r]] for kind in (0, 1)]
            for role, others in seen.items():
                if len(others - {None}) > 1 or None in others and len(heads[role[0]]) > 1:
                    classes[role] = (vector, role)
        told = []
        for o, page in zip(pages, roles, strict=True):
            new, last, inside = {}, {classes[0, 0]: (0, 0)}, {-1: [classes[0, 0]]}
            for (kind, i), role in page.items():
                outer = o.parents[i] if kind == 0 else o.elements[i]
                new[kind, i] = (kind, role, new.get((0, outer)), tuple(last[c] for c in inside[outer]))
                if role in classes:
                    last[classes[role]] = role
                if kind == 0:
                    inside[i] = inside[outer] + ([classes[role]] if role in classes and classes[role] not in inside[outer] else [])
            told.append(new)
        roles = told


def _moving(count):
    """A notice and a table come in either order; lists of pairs; an element on most pages only."""
    rng = random.Random(8)
    for i in range(count):
        parts = ["<p>A notice.</p>", "<table><tr><td>x</table>"]
        rng.shuffle(parts)
        pairs = "".join(f"<dt>{k} {i}<dd><div>a{k}</div><div>b<h2>h</h2></div><div>c</div>" for k in range(rng.randrange(1, 4)))
        yield f"<body><div>{parts[0]}</div><div>{parts[1]}</div><dl>{pairs}</dl>{'<hr><form><p>f</form>' * (i % 4 > 0)}<div>end</div></body>"


@pytest.mark.parametrize("sources", [[r[2] for r in _unnamed(9)], [r[2] for r in _site(9)], list(_moving(16))], ids=["unnamed", "site", "moving"])
def test_rounds_are_those_of_whole_vectors(spark, sources):
    pages = spark.createDataFrame([(7, i, s) for i, s in enumerate(sources)], "host_key long, row_no long, html string")
    tokens, known = differentiated(outlines(pages).localCheckpoint())
    rounds, expected = _plain_rounds(sources)
    assert sorted((r["class"].pages, r["class"].occurrences) for r in tokens.collect()) == sorted((sum(map(bool, v)), sum(v)) for v in expected)
    classes = {}
    for v in expected:
        classes[v] = classes.get(v, 0) + 1
    assert sorted(r["count"] for r in tokens.groupBy("class").count().collect()) == sorted(classes.values())
    assert [r.rounds for r in known.collect()] == [rounds] and rounds > 1
    assert tokens.count() > equivalence_classes(pages).count()


def test_empty_table(spark):
    assert main_text(spark.createDataFrame([], PAGE)).collect() == []


def test_a_host_is_counted_before_it_is_shuffled(spark):
    pages = spark.createDataFrame([(1, 1, "<p>a</p>")], "host_key long, row_no long, html string")
    plan = equivalence_classes(pages)._jdf.queryExecution().toString()
    assert "Window" not in plan and "collect" not in plan
    assert equivalence_classes(pages).filter(F.col("token").isNull()).count() == 0
