"""Pieces, mixtures, pages and products against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, pages, pieces, topk

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return pieces.load(MODEL)


def _split(values, counts):
    edges = np.concatenate(([0], np.cumsum(counts)))
    return [values[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def test_round_trip_and_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["", " ", "a▁b  c", "\n\n x\t", "日本語😀 é" * 3, "x" * 5000, "   lead", "\x00z", "a " * 9,
             "b" * 39 + " " + "c" * 42, "the <s> </s> <0x41> <unk>"]
    ids, counts = pieces._encode(model, texts, pieces._seeds(list(range(len(texts))), 1))
    assert pieces._decode(model, ids, counts) == texts
    assert [library.decode(own) for own in _split(ids, counts)] == texts


def test_samples_have_the_shares_of_the_lattice(model):
    unit = "▁other"
    shares = {}
    for cuts in itertools.product([0, 1], repeat=len(unit) - 1):
        parts = [unit[0]]
        for sign, cut in zip(unit[1:], cuts, strict=True):
            parts = [*parts, sign] if cut else [*parts[:-1], parts[-1] + sign]
        if all(part in model.table for part in parts):
            key = tuple(model.table[part] for part in parts)
            shares[key] = float(np.prod([model.weights[i] for i in key]))
    whole = sum(shares.values())
    n = 40_000
    seeds = pieces._seeds(list(range(n)), 1)
    ids, counts = pieces._encode(model, ["other"] * n, seeds)
    got = Counter(tuple(own) for own in _split(ids, counts))
    long = Counter(tuple(pieces._long_unit(model, unit, seed)) for seed in seeds[:6000])
    for key, share in shares.items():
        assert abs(got[key] / n - share / whole) < 0.01
        assert abs(long[key] / 6000 - share / whole) < 0.03


def test_draws_depend_on_the_row_alone(spark, model):
    data = [(i, f"Some text number {i % 5}, and more of it.\n" * 3) for i in range(60)]
    rows = spark.createDataFrame(data, "doc_id bigint, text string")
    get = lambda df: {r.doc_id: r.pieces for r in pieces.segmented(df, MODEL).collect()}
    one = get(rows)
    assert one == get(rows.orderBy(F.desc("doc_id")).repartition(7))
    assert one[0] != one[5]


def _mix(rows, weights, total, epochs, seed=1):
    """Straight from the definition: fill families, then walk each leaf's epochs."""
    leaves = {}
    for doc, *path, tokens in rows:
        leaves.setdefault(tuple(path), []).append((doc, tokens))
    room = {leaf: epochs * sum(t for _, t in docs) for leaf, docs in leaves.items()}

    def fill(parent, budget):
        if parent in leaves:
            return {parent: budget}
        family = sorted({leaf[: len(parent) + 1] for leaf in leaves if leaf[: len(parent)] == parent}, key=repr)
        space = {c: sum(r for leaf, r in room.items() if leaf[: len(c)] == c) for c in family}
        given = dict.fromkeys(family, 0.0)
        left = budget
        open_ = set(family)
        while left > 1e-9 and open_:  # hand out by weight, again and again
            weight = sum(weights.get(c, 1.0) for c in open_)
            parts = {c: left * weights.get(c, 1.0) / weight for c in open_}
            for c, part in parts.items():
                part = min(part, space[c] - given[c])
                given[c] += part
                left -= part
            open_ = {c for c in open_ if space[c] - given[c] > 1e-9}
        return {leaf: b for c in family for leaf, b in fill(c, given[c]).items()}

    out = Counter()
    for leaf, budget in fill((), total).items():
        budget = int(budget + 1e-6)
        tokens = sum(t for _, t in leaves[leaf])
        whole, rest = divmod(budget, tokens)
        order = sorted(leaves[leaf], key=lambda d: hashlib.md5(f"{seed}|{whole}|{d[0]}".encode()).hexdigest())
        for doc, t in order:
            out[doc] += whole
        for doc, t in order if rest else []:
            if t > rest:
                break
            rest -= t
            out[doc] += 1
    return {doc: n for doc, n in out.items() if n}


@pytest.mark.parametrize(("share", "epochs"), [(0.5, 1), (0.9, 3), (1.7, 2), (2.5, 2)])
def test_mix_like_definition(spark, share, epochs):
    draw = random.Random(7)
    data = []
    for i in range(1500):
        lang = draw.choice(["en"] * 6 + ["de", None])
        source = draw.choice(["hot"] * 5 + ["a", "b"])
        data.append((i, "w " * draw.randrange(1, 30), lang, source))
    weights = {("en",): 1.0, ("de",): 2.0, (None,): 1.0, ("en", "a"): 3.0}
    rows = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string")
    counted = [(i, lang, source, len(text.split())) for i, text, lang, source in data]
    total = int(share * sum(row[3] for row in counted))
    got = mixing.mix(rows, ("lang", "source"), weights, total=total, epochs=epochs)
    assert {r.doc_id: r.copies for r in got.collect()} == _mix(counted, weights, total, epochs)


def test_shortage_goes_to_siblings_first():
    room = {("x", "a"): 10, ("x", "b"): 100, ("y", "c"): 1000}
    assert mixing.budgets(room, {}, 100) == {("x", "a"): 10, ("x", "b"): 40, ("y", "c"): 50}
    assert mixing.budgets(room, {}, 400) == {("x", "a"): 10, ("x", "b"): 100, ("y", "c"): 290}
    assert mixing.budgets(room, {("y",): 0.0}, 100) == {("x", "a"): 10, ("x", "b"): 90, ("y", "c"): 0}


ARTICLE = "<h1>Head</h1><p>One &amp; two\n  three.<p>Short.</p><ul><li>x<li>y</ul><pre>a\n b</pre>"
WANTED = "Head\nOne & two three.\nShort.\nx\ny\na b"


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all", ""),
        ("<p>" + "long enough " * 10 + "</p>", ("long enough " * 10).strip()),
        (f"<nav><a href=x>menu</a></nav><article>{ARTICLE}</article><footer>f</footer>", WANTED),
        (f"<article>{ARTICLE}<script>var t='<p>no</p>'</script><!-- <p>no --></article>", WANTED),
        (f"<body><div class='side-bar sidebar'>no</div><main>{ARTICLE}</main>", WANTED),
        (f"<article>{ARTICLE}<div class='ad'>no</div><section id='comments'><p>no</p></section>", WANTED),
        (f"<article>{ARTICLE}<form><label>no</label><input></form><aside><p>no</p></aside></article>", WANTED),
        (f"<ARTICLE>{ARTICLE}</ARTICLE><article class=x><p>teaser</p></article>", WANTED),
        (f"<header><h1>Site</h1></header><article><header>{ARTICLE}</header></article>", WANTED),
        (f"<main><article>{ARTICLE}</article><section><p>more to read</p></section></main>", WANTED),
        (f"<div class='page-content'><header>no</header><div id=post>{ARTICLE}</div></div>", WANTED),
        (f"<div class=wrap><div class='entry-content'>{ARTICLE}</div><div>no</div></div>", WANTED),
        ("<article><p>cut off in a ta", "cut off in a ta"),
        ("<article><p>cut</p><p cla", "cut"),
        ("<article><p>1 < 2 and <b>bold</b>, &lt;p&gt; &#233;&nbsp;z<br>end</p></article>",
         "1 < 2 and bold, <p> é z end"),
        ('<article><p title="a > b">text</p><p title="open>more</p></article>', "text\nmore"),
    ],
)
def test_main_text(page, wanted):
    assert pages.main_text(page) == wanted


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (f"<article class='post comments-open'>{ARTICLE}</article>", WANTED),
        (f"<div class='layout has-sidebar'><article>{ARTICLE}</article></div>", WANTED),
        (f"<div id='page' class='sticky-menu'><article>{ARTICLE}</article></div>", WANTED),
        (f"<article class='overflow-hidden' aria-hidden='false'>{ARTICLE}</article>", WANTED),
        (f"<div class=widget><article class='x social'>{ARTICLE}</article></div>", WANTED),
        (f"<article>{ARTICLE}<div hidden>no</div><div style='display: none'>no</div></article>", WANTED),
        (f"<article>{ARTICLE}<p aria-hidden=true>no<div class='post-comments'>no</div></article>", WANTED),
        (f"<article>{ARTICLE}</article><div class=comments><article>{'no ' * 99}</article></div>", WANTED),
    ],
)
def test_labels_beside_the_article(page, wanted):
    assert pages.main_text(page) == wanted


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (f"<html><head><title>t</title><meta x><body><article>{ARTICLE}</article>", WANTED),
        (f"<head><style>p{{}}</style><link><article>{ARTICLE}</article>", WANTED),
        (f"<svg width='1'/><iframe src='x'/><article>{ARTICLE}</article>", WANTED),
        (f"<article><iframe src=x>{ARTICLE}</article>", WANTED),
        (f"<article><button>no{ARTICLE}</article><button>no</button>", WANTED),
        (f"<article><select><option>no<option>no{ARTICLE}</article>", f"no\nno\n{WANTED}"),
        (f"<article><object data=x>{ARTICLE}</article>", WANTED),
        (f"<article><svg><g><text>no</text></g></svg>{ARTICLE}<math><mi>no</mi></math></article>", WANTED),
        (f"<article>{ARTICLE}<p>a <button><b>no</b></button> b</p><script>no", f"{WANTED}\na b"),
        (f"<article>{ARTICLE}<select><option>no</select><object><p>no</p></object></article>", WANTED),
    ],
)
def test_elements_without_an_end(page, wanted):
    assert pages.main_text(page) == wanted


LONG = "Prose goes on and on. " * 5
LINKS = "".join(f"<p><a href={i}>link {i}</a></p>" for i in range(4))


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (f"<article>{ARTICLE}</article><div class=ad>no</div><article><p>end</article>", f"{WANTED}\nend"),
        (f"<td><div class='article-body'>{ARTICLE}</div><p>no</p><div class='article-body'>{ARTICLE}</div>",
         f"{WANTED}\n{WANTED}"),
        (f"<article>{ARTICLE}</article><article><a href=x>no, only a long teaser of it</a></article>", WANTED),
        (f"<article>{ARTICLE}</article><div><article><p>elsewhere, not the article</article></div>", WANTED),
        ("<body><p>A short article.</p></body>", "A short article."),
        (f"<body>{LINKS}<h1>Head</h1><p>by A. B.</p><p>1 May</p><p>Intro</p><p>{LONG}</p>{LINKS}<p>End.</p>",
         f"Head\nby A. B.\n1 May\nIntro\n{LONG.strip()}\nEnd."),
    ],
)
def test_all_parts_of_the_article(page, wanted):
    assert pages.main_text(page) == wanted


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (f"<nav><ul><li><a href=x>menu</a><article>{ARTICLE}</article>", WANTED),
        (f"<nav><a href=x>menu</a><h1>Head</h1><p>{LONG}</p><p>End.</p>", f"Head\n{LONG.strip()}\nEnd."),
        (f"<form id=page><article>{ARTICLE}</article></form>", WANTED),
        (f"<article>{ARTICLE}</article><aside><article><p>{LONG}</p></article></aside>", WANTED),
        ("<div>Home</div><div>About</div><div>Login</div>" f"<div>{LONG}</div><div>{LONG}</div><div>&copy; 2024 The Site</div>",
         f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<main><header>The site<p>Its line</p></header>{ARTICLE}</main>", WANTED),
        (f"<article>{ARTICLE}<div role='complementary'>no</div><div class='js-cookie-notice'>no</div></article>", WANTED),
        (f"<article>{ARTICLE}</article><article class='card'>{ARTICLE}</article>", WANTED),
    ],
)
def test_pages_with_faults_and_without_marks(page, wanted):
    assert pages.main_text(page) == wanted


def test_windows_decide_where_marks_have_no_text(monkeypatch):
    teasers = "".join(f"<article><p>Read {i}</p></article><hr><hr>" for i in range(3))
    page = f"<body>{teasers}<div><p>{LONG}</p><p>{LONG}</p></div>"
    assert pages.main_text(page) == f"{LONG.strip()}\n{LONG.strip()}"
    monkeypatch.setattr(pages, "_windows", lambda lines, counted: counted > 0)
    assert pages.main_text(page) != f"{LONG.strip()}\n{LONG.strip()}"


def test_pages_like_those_they_are_made_of():
    draw = random.Random(12)
    line = lambda n: " ".join(draw.choice("ein Wort über das andere gut gesagt".split()) for _ in range(n))
    beside = [
        lambda: f"<nav><a href=x>{line(2)}</a></nav>", lambda: f"<div class='sidebar'><p>{line(30)}</p></div>",
        lambda: f"<footer>{line(20)}</footer>", lambda: f"<form><p>{line(20)}</p></form>",
        lambda: f"<script>var x = '{line(40)}'</script>", lambda: f"<!-- <p>{line(40)}</p> -->",
        lambda: f"<section id='comments'><p>{line(40)}</p></section>", lambda: f"<div class='ad'>{line(9)}</div>",
    ]
    for _ in range(400):
        blocks = [(draw.choice(["p", "h2", "li", "blockquote"]), line(draw.randrange(1, 60))) for _ in range(draw.randrange(1, 9))]
        inner = "".join(
            f"<{tag}>{text.replace(' ', draw.choice([' ', '  ', chr(10), '&#32;']), 1)}</{tag}>"
            + (draw.choice(beside)() if draw.random() < 0.3 else "") for tag, text in blocks
        )
        around = [draw.choice(beside)() for _ in range(6)]
        name, label = draw.choice([("article", ""), ("main", ""), ("div", " class='entry-content'")])
        page = f"<body>{''.join(around[:3])}<{name}{label}>{inner}</{name}>{''.join(around[3:])}"
        assert pages.main_text(page) == "\n".join(text for _, text in blocks), page


def test_lines_without_an_article():
    links = "".join(f"<li><a href={i}>link {i}</a></li>" for i in range(9))
    body = "".join(f"<p>{'Prose goes on and on. ' * 5}{i}</p>" for i in range(4))
    got = pages.main_text(f"<body><ul>{links}</ul>{body}<ul>{links}</ul><div>imprint</div></body>")
    assert got.split("\n") == [f"{'Prose goes on and on. ' * 5}{i}" for i in range(4)]


@pytest.mark.parametrize("scale", [1.0, 3e4])
def test_products_like_brute_force(spark, scale):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(3000, 12)) * draw.lognormal(0, 0.7, size=(3000, 1)) * scale
    x[100:140] = x[7]
    x[200] = 0
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    whole = np.floor(256 * x).astype(np.int64).astype(object)
    wanted = []
    for q in range(0, 3000, 50):
        scores = whole @ whole[q]
        order = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:5]
        wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(order)]
    got = topk.top_products(rows.repartition(5), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == wanted
