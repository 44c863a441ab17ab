"""Inputs that used to hang a task, fill its memory, or lose or keep the wrong text."""

import random
import time

import numpy as np
import pytest

from riskweave.llm import decontaminate, html, pii, quality, spans

from .data import documents, prose

KEY = b"k"


def article(page):
    return [t for t, kind in html.lines_of(page) if kind == html.ARTICLE]


@pytest.mark.parametrize("page, text", [
    ('<article><p class="ad">Buy<p>Real one<p>Real two</article>', ["Real one", "Real two"]),
    ("<body><nav><a>Menu</a><article><p>Text</article></body>", ["Text"]),
    ("<form><article><p>Text</p></article><input></form>", ["Text"]),
    ('<article><div class="article-header"><h1>T</h1></div><p>x</p></article>', ["T", "x"]),
    ('<article><p>a</p><p class="related-work">b</p><p>c</p></article>', ["a", "b", "c"]),
    ('<article><p>a</p><div class="site-footer top"><p>b</p></div><p>c</p></article>', ["a", "c"]),
    ('<article><ul><li class="promo">x<li>y</ul><p>z</article>', ["y", "z"]),
    ('<article><p>a</p><section class="comments"><article class="comment"><p>c</p></article></section></article>', ["a"]),
    ('<article><p class="ad">x</article><article><p>y</p></article>', ["y"]),
    ("<article><p>a<b>b</p><p>c</b>d</p></article>", ["ab", "cd"]),
    ('<article><table><tr><td class="ad">x<td>y<tr><td>z</table></article>', ["y", "z"]),
])
def test_articles_are_kept(page, text):
    assert article(page) == text


def test_malformed_tags_take_linear_time():
    start = time.perf_counter()
    html.lines_of("<a " + '"x"' * 10_000 + "<")
    html.lines_of("<a " + '"' * 10_001 + "<")
    html.lines_of("<p class=" + "'" * 10_000 + "<p>" * 10_000)
    assert time.perf_counter() - start < 5


def test_many_equal_lines():
    start = time.perf_counter()
    assert len(html.common_lines([1] * 4000, [1] * 3900)) == 3900
    assert time.perf_counter() - start < 5
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(12))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        places = sorted(html.common_lines(a, b))
        rest = iter(b)
        assert len(places) == best[-1, -1] and all(a[i] in rest for i in places)


def test_repeated_text_is_searched_in_stretches(monkeypatch):
    items = [b"0" * 200, prose(40, 1).encode(), b"01" * 100]
    block = decontaminate.ItemBlock([1, 2, 3], items, 0.1)
    texts = [b"0" * 3000, b"x" * 50 + items[1] + b"0" * 700 + b"01" * 300, b"y" * 90, b"0" * 150 + b"1" * 5 + b"0" * 60]
    whole = decontaminate.leaks_in(block.index(), texts)
    assert {(d, i) for d, i, *_ in whole} >= {(0, 1), (1, 2), (1, 1), (1, 3), (3, 1)}
    seen = []
    bands = decontaminate._bands
    monkeypatch.setattr(decontaminate, "_bands", lambda *a: seen.append(len(a[4])) or bands(*a))
    monkeypatch.setattr(decontaminate, "HITS", 100_000)
    parts = decontaminate.leaks_in(block.index(), texts)
    assert len(seen) > 3 and max(seen) < 400_000
    assert {(d, i) for d, i, *_ in parts} == {(d, i) for d, i, *_ in whole}
    # what is found is within the budget, and no document without an item is
    for d, i, start, end, edits, _ in parts:
        assert edits <= decontaminate.budget(len(items[i - 1])) and 0 <= start < end <= len(texts[d])


def test_cards_before_other_numbers():
    for text, rest in (("4111 1111 1111 1111 12/27", " 12/27"), ("4111 1111 1111 1111 123", " 123"), ("no 4111-1111-1111-1111-99", "-99")):
        new, counts = pii.pseudonymize_text(text, KEY)
        assert counts == {"card": 1} and new.endswith(rest) and "4111 1111 1111 1111" not in new and "1111-1111" not in new
        digits = pii._digits(new)[: len(pii._digits(text)) - len(pii._digits(rest))]
        assert pii.luhn_sum(digits) % 10 == 0
    assert pii.pseudonymize_text("12 34 56 78 90 12 34 56 78", KEY)[1] == {}


def test_phones_are_linked_across_separators():
    news = [pii.pseudonymize_text(t, KEY) for t in ("+4915112345678", "+49 151 12345678", "+49 151 1234 5678", "+49-151-1234-5678")]
    assert all(counts == {"phone": 1} for _, counts in news)
    assert len({pii._digits(new) for new, _ in news}) == 1 and all(new.startswith("+49") for new, _ in news)
    assert pii.pseudonymize_text("+1 (555) 123-4567", KEY)[0].startswith("+1 (")


def test_dates_before_times():
    new, counts = pii.pseudonymize_text("at 2024-02-29T10:00:00 and 2024-02-29", KEY)
    assert counts == {"date": 2} and new[3:13] == new[-10:] and new[13:22] == "T10:00:00"


def test_spans_with_clashing_names(spark):
    passage = prose(60, 1)
    rows = spark.createDataFrame([(i, f"{prose(30, i)}\n{passage}", 7, "r") for i in range(3)], "doc_id long, text string, marked int, _row_of_id string")
    found = spans.remove_repeated_spans(rows).orderBy("doc_id").collect()
    assert [passage in r["text"] for r in found] == [True, False, False]
    assert all((r["marked"], r["_row_of_id"]) == (7, "r") for r in found)
    assert found[0].asDict().keys() == {"doc_id", "text", "marked", "_row_of_id", "n_sentences", "n_removed"}


def test_labels_that_leave_the_grade_open(spark):
    docs = documents(spark, [(1, prose(20, 1), "en", "s", 1), (2, prose(20, 2), "en", "s", 1)])
    open_ = spark.createDataFrame([(1, 1, None), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert not quality.train(docs, open_).thresholds.any()
    texts = [prose(50, i).encode() for i in range(5)] + [b"", b"!!! ALL CAPS", b"a" * (3 << 20)]
    whole = quality.features(texts)
    for i, text in enumerate(texts):
        mine = whole[0] == i
        _, cell, value = quality.features([text])
        assert (whole[1][mine] == cell).all() and (whole[2][mine] == value).all()
