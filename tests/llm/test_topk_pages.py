import random

import numpy as np

from visitflow.llm import pages, topk


def brute(rows, k):
    out = []
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    good = [g for n, g in enumerate(good) if g not in good[:n]]
    for i, q in good:
        if i % 20 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **settings):
    v = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int, rank string"))
    return sorted(tuple(r) for r in topk.top_k(v, v.where("vec_id % 20 = 0"), **settings).collect())


def test_like_brute_force(spark):
    r = random.Random(8)
    vectors = [[r.gauss(0, 0.2) for _ in range(10)] for _ in range(150)]
    rows = [(i, vectors[i % 120]) for i in range(200)]  # ties
    rows += [(300, None), (301, [None] * 10), (302, [float("nan")] * 10), (303, [float("inf")] + [0.0] * 9), (None, vectors[0]), (400, [1.0]), (401, []), (402, [0.0] * 10), (20, vectors[20])]
    rows = [(i, v, 1, "x") for i, v in rows]
    want = brute([x[:2] for x in rows], 20)
    assert run(spark, rows) == want
    assert run(spark, rows, row_block=16, query_block=2) == want
    assert run(spark, rows[:5]) == brute([x[:2] for x in rows[:5]], 20)


def test_empty(spark):
    assert run(spark, [(1, [0.5], 1, "x")]) == []
    assert run(spark, [(0, None, 1, "x")]) == []


def test_sums_of_slices():
    r = np.random.default_rng(1)
    x, q = r.integers(-500, 500, (77, 9)), r.integers(-70, 70, 9)
    rows, scores = topk.BitSlices.of(x).best(q, 77, np.zeros(0, int))
    assert sorted(rows.tolist()) == list(range(77)) and (scores == x[rows] @ q).all()


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment(monkeypatch):
    r = random.Random(2)
    for bits in (1 << 28, 4):
        monkeypatch.setattr(pages, "TABLE_BITS", bits)
        for _ in range(1000):
            a, b = ([r.randrange(5) for _ in range(r.randrange(12))] for _ in range(2))
            found = pages.shared_lines(a, b)
            rest = iter(b)
            assert len(found) == lcs(a, b) and all(any(a[k] == y for y in rest) for k in found)


PAGE = ("<html><head><title>t</title><style>p{}</style><script>if(a<b)x('</p>')</script></head><body><nav><a>Menu</a></nav>"
        "<div class='ad'>Buy</div><article><header><h1>Title &amp; more</h1></header><p>One  two\n three<br>four<p><b>Five</b> six"
        "<aside>Related</aside><form><label>Mail</label></form><section id=comments><p>me too</p></section></article><footer>(c)</footer></body></html>")


def test_marked_article():
    assert pages.main_text(PAGE, []) == "Title & more\nOne two three four\nFive six"
    assert pages.main_text(PAGE, list(range(20))) == "Title & more\nOne two three four\nFive six"
    assert pages.main_text(PAGE[: PAGE.index("<aside>")], []) == "Title & more\nOne two three four\nFive six"
    assert pages.main_text("<div class=ad>x<article>y &lt;z&gt; &am", []) == "y <z> &am"


def test_unmarked_pages_lose_what_neighbours_share(spark):
    site = lambda k: f"<div>Site of all</div><div>Story {k} begins</div><p>Text {k}</p><div>Imprint</div>"
    rows = [(k, f"http://a.org/en/{k}", site(k)) for k in range(40)]
    rows += [(100, "http://b.org/x", site(1)), (101, None, site(2)), (102, "http://c.org/1", None), (103, "http://c.org/2", ""), (None, "http://d.org/1", site(7)), (None, "http://d.org/2", site(8)), (5, "http://a.org/en/5", site(5)), (110, "http://e.org/1", PAGE), (111, "http://e.org/2", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F

    got = [tuple(r) for r in pages.extract(df.withColumn("text", F.lit(1)).withColumn("host", F.lit(2)).withColumn("lines", F.lit("x"))).collect()]
    assert len(got) == len(rows)
    whole = lambda k: f"Site of all\nStory {k} begins\nText {k}\nImprint"
    for page_id, url, html in rows:
        if url and url.startswith(("http://a", "http://d")):
            k = page_id if page_id is not None else (7 if url.endswith("1") else 8)
            text = f"Story {k} begins\nText {k}"
        else:
            text = {100: whole(1), 101: whole(2), 102: "", 103: "", 110: pages.main_text(PAGE, []), 111: pages.main_text(PAGE, [])}[page_id]
        assert (page_id, url, text, len(text)) in got, (page_id, text)
    assert pages.extract(df.limit(0)).count() == 0
