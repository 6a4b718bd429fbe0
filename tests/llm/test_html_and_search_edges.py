"""Tags told apart as the HTML standard does, by a state machine; searches over rows that share an id."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapjobs.llm import ann, html_text

WS = "\t\n\f\r "


def text_of(page):
    """The text outside of tags and comments, one character at a time."""
    out, i, n = [], 0, len(page)
    while i < n:
        if page[i] != "<" or i + 1 == n or not (page[i + 1] in "/!?" or page[i + 1].isascii() and page[i + 1].isalpha()):
            out.append(page[i])
            i += 1
            continue
        if page.startswith("<!--", i):
            i += 4
            if page[i:i + 1] == ">" or page[i:i + 2] == "->":
                i += 1 if page[i] == ">" else 2
                continue
            while i < n and not page.startswith("-->", i) and not page.startswith("--!>", i):
                i += 1
            i += 4 if page.startswith("--!>", i) else 3
            continue
        closing = page[i + 1] == "/"
        if page[i + 1] in "!?" or closing and not (i + 2 < n and page[i + 2].isascii() and page[i + 2].isalpha()):
            while i < n and page[i] != ">":
                i += 1
            i += 1
            continue
        i += 2 if closing else 1
        while i < n and page[i] not in WS + "/>":  # the tag's name
            i += 1
        state = "before"
        while i < n:
            c = page[i]
            i += 1
            if state == "before":
                if c == ">":
                    break
                if c not in WS + "/":
                    state = "name"
            elif state in ("name", "after"):
                if c == ">":
                    break
                if c == "=":
                    state = "equals"
                elif c == "/":
                    state = "before"
                elif c in WS:
                    state = "after"
                else:
                    state = "name"
            elif state == "equals":
                if c == ">":
                    break
                if c in "\"'":
                    state = c
                elif c not in WS:
                    state = "value"
            elif state == "value":
                if c == ">":
                    break
                if c in WS:
                    state = "before"
            elif c == state:
                state = "before"
    return "".join(out)


def test_tags_against_a_state_machine():
    r = random.Random(9)
    pieces = ["<b", "<i ", "</b", "</", "<!--", "-->", "--!>", "<!", "<?", ">", "->", '"', "'", "=", "/", " ", "\n", "a", "bc", "class=x", 'title="', "d='e f'", "é", "<", "1", "&amp;"]
    for _ in range(4000):
        page = "".join(r.choices(pieces, k=r.randint(1, 25))) + "x\"'>end-->"  # no quote and no tag stays open
        want = " ".join(re.sub("&amp;", "&", text_of(page)).split())
        assert " ".join(b.text for b in html_text.blocks(page)) == want, page


@pytest.mark.parametrize("page,want", [
    ('<p class="b"">First paragraph.</p><p class="c"">Second.</p>', ["First paragraph.", "Second."]),
    ("<p title=it's>Hello and please don't stop.</p><p>Then.</p>", ["Hello and please don't stop.", "Then."]),
    ("<p>One<!-->two<!--->three<!-- no --!>four</p><!-- x --><p>Five</p>", ["Onetwothreefour", "Five"]),
    ('<p class="open>Lost quote</p><p>Next</p>', ["Lost quote", "Next"]),
    ("<p a=>One</p><p =b c = d/>Two</p>", ["One", "Two"]),
])
def test_broken_tags_lose_no_text(page, want):
    assert [b.text for b in html_text.blocks(page)] == want


def test_plain_text_page(spark):
    pages = spark.createDataFrame([(1, "u", "Just a text.\n\nWith two lines & <b>one</b> tag."), (2, "v", ""), (3, "w", None), (4, "x", " \n ")], "page_id long, url string, html string")
    got = {x.page_id: (x.text, x.n_chars) for x in html_text.extract(pages, training_pages=40).collect()}
    assert got[1][0] == "Just a text. With two lines & one tag." and got[2] == got[3] == got[4] == ("", 0)


def test_search_where_rows_share_an_id(spark):
    """vec_id 0 three times with different vectors: each has all others as candidates, and no row is missing."""
    r = np.random.default_rng(3)
    rows = [(0, r.normal(size=4)) for _ in range(3)] + [(i, r.normal(size=4)) for i in range(1, 12)]
    rows += [(20, rows[3][1]), (3, rows[5][1])]  # an equal vector under another id; a row given twice
    df = spark.createDataFrame([(i, [float(a) for a in v], "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).collect()
    distinct = {(i, tuple(v)) for i, v in rows}
    want = []
    for i, v in sorted(x for x in distinct if x[0] == 0):
        near = sorted((float(np.sqrt(((np.array(v) - np.array(u)) ** 2).sum())), j) for j, u in distinct if (j, u) != (i, v))[:10]
        want += [(0, k, j, round(d, 9)) for k, (d, j) in enumerate(near, 1)]
    assert sorted((x.query_id, x["rank"], x.vec_id, round(x.score, 9)) for x in got) == sorted(want)
