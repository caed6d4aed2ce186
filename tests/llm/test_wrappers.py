"""Wrappers of hosts are made from all of their pages, whatever their number and length."""

import random

from tracewright.llm import html_text

SCHEMA = "page_id bigint, url string, html string"


def test_wrapper_of_long_pages(spark):
    """Pages of many items have a wrapper as well."""
    rows = "".join(f"<div><p>row {i}</p></div>" for i in range(300))
    pages = [(i, f"http://long.com/{i}", f"<div>Shop</div>{rows}<p>text {i}</p><div>All rights</div>") for i in range(4)]
    got = html_text.main_text(spark.createDataFrame(pages, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"text {i}" for i in range(4)}


def test_pages_beyond_one_group_make_the_wrapper_more_general(spark):
    """A text that stands elsewhere on one of many pages is no template, whichever page that is."""
    n = 5 * html_text.PAGES_PER_WRAPPER
    for odd in (0, n // 2, n - 1):
        pages = [
            (i, f"http://big.com/{i}", f"<div>{'Shop' if i != odd else 'Else'}</div>" + f"<p>text {i}</p>" * (i % 7 + 1) + "<div>Rights</div>")
            for i in range(n)
        ]
        df = spark.createDataFrame(pages, SCHEMA).repartition(5)
        templates = {r.host: r.template for r in html_text.wrappers(df).collect()}
        assert templates == {"big.com": ["Rights"]}
    items = html_text._read(html_text.host_wrappers(df).first().wrapper)
    assert ("slot",) in items and any(item[0] == "rep" for item in items)


def _best(one, two):
    best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    for i in range(len(one) - 1, -1, -1):
        for j in range(len(two) - 1, -1, -1):
            score = 2 * (one[i][0] == two[j][0]) + (one[i][1] == two[j][1])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + score if score else 0)
    return best[0][0]


def test_alignments_in_little_memory(monkeypatch):
    """Matches are in order and have the best score, also where an alignment is cut in two."""
    rng = random.Random(3)
    for cells in (html_text.CELLS, 40):
        monkeypatch.setattr(html_text, "CELLS", cells)
        for _ in range(200):
            one, two = ([(k if k else 0, 10 * k + (rng.randrange(2) if not k else 0)) for k in rng.choices(range(3), k=rng.randrange(25))] for _ in "ab")
            a, b = (html_text.np.array(x, html_text.np.int32).reshape(-1, 2) for x in (one, two))
            found = html_text._matches(a, b)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
            assert all(one[i][0] == two[j][0] for i, j in found)
            assert sum(2 + (one[i][1] == two[j][1]) for i, j in found) == _best(one, two)


def test_a_merged_wrapper_keeps_what_either_lacks_optional():
    one = html_text.infer([["<p", "#a", ">p"], ["<p", "#a", ">p", "<hr", "#b"]])
    two = html_text.infer([["<p", "#a", ">p", "<hr", "#b"]])
    for pair in ([one, two], [two, one]):
        assert html_text.template_texts(html_text.merged(pair)) == ["a"]
