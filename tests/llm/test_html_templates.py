"""Template counting on made hosts against plain Python, reprinted bodies, deep nesting."""
import collections
import random
import time

import pytest

from rttlab.llm import html


def test_reprinted_body_is_no_template(spark):
    body = " ".join(f"word{i}" for i in range(120))
    parts = "".join(f"<p>{' '.join(f'v{i}x{k}' for i in range(12))}</p>" for k in range(9))
    for made in (f"<div>{body}</div>", f"<section>{parts}</section>", parts):
        for n in (9, 12, 40):
            rows = [(i, f"http://h.org/{i}", f"<body><h1>Reprint {i}</h1>{made}</body>") for i in range(n)]
            got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
            assert got == {i: html.main_text(h) for i, _, h in rows}


def test_long_menus_are_templates(spark):
    menu = "<div>" + "".join(f"<a href=/{i}>Entry number {i}</a> " for i in range(80)) + "</div>"
    rows = [(i, "http://h.org/", f"<body>{menu}<div>own text {i}</div></body>") for i in range(12)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"own text {i}" for i in range(12)}


def test_counting_against_plain_python(spark):
    rng = random.Random(6)
    boxes = [f"box {k} of the site" for k in range(8)]
    rows = []
    for h in range(4):
        for i in range(rng.choice([8, 25, 60])):
            page = [f"own {h} {i} a"] + rng.sample(boxes, rng.randint(0, 4)) + [f"own {h} {i} b"]
            rows.append((h, len(rows), page))
    rows += [(h, 1000 + i, page) for h, i, page in rng.sample(rows, 20)]  # repeated pages count once
    made = [(i, f"https://h{h}.net/x", "<body>" + "".join(f"<div>{t}</div>" for t in page) + "</body>") for h, i, page in rows]
    different = {(h, tuple(page)) for h, _, page in rows}
    n_pages = collections.Counter(h for h, _ in different)
    inside = collections.Counter((h, t) for h, page in different for t in set(page))
    template = {(h, t) for (h, t), n in inside.items() if n >= 10 and n >= 0.1 * n_pages[h]}
    assert template and len(template) < len({x for x in inside if x[1].startswith("box")})
    want = {i: " ".join(t for t in page if (h, t) not in template) for h, i, page in rows}
    got = html.extract(spark.createDataFrame(made, "page_id long, url string, html string").repartition(5)).collect()
    assert {r.page_id: r.text for r in got} == want


@pytest.mark.parametrize("unit,end", [("<div>", "</div>"), ("<div>", ""), ("<p><button><div>", ""), ("<ul><li>", ""), ("<table><tr><td>", "")])
def test_deep_nesting_takes_linear_time(unit, end):
    took = []
    for n in (2_000, 16_000):
        page = unit * n + "x" + end * n
        start = time.process_time()
        tree = html.parse(page)
        html.subtree_hashes(tree, html.content_roots(tree))
        took.append(time.process_time() - start)
    assert took[1] < 30 * took[0] + 0.3


def test_pages_with_clashing_columns_and_nulls(spark):
    names = ["rest", "host", "page1", "page2", "template", "hash", "place", "text", "n_chars"]
    rows = [(i, "http://h.org/", f"<div>a {i}</div><div>site</div>", *["mine"] * 9) for i in range(12)] + [(None,) * 12, (3, None, "", *[None] * 9)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, " + ", ".join(f"{n} string" for n in names)).repartition(3)
    got = html.extract(pages)
    assert got.columns == ["page_id", "url", *names[:7], "text", "n_chars"]
    want = collections.Counter((i, "mine" if h else None, "a %s" % i if h else "") for i, _, h, *_ in rows)
    assert collections.Counter((r.page_id, r.host, r.text) for r in got.collect()) == want
