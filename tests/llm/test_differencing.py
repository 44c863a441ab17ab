"""Short articles on long templates, and copies next to each other."""

from riskweave.llm import html


def page(own):
    lines = [f"site line {i}" for i in range(20)] + own
    return "<html><body>" + "".join(f"<p>{line}</p>" for line in lines) + "</body></html>"


def test_shared_lines_go_however_many(spark):
    short = {1: ["a one", "a two", "a three"], 2: ["b one", "b two", "b three"]}
    rows = [(i, f"http://h.example/a/{i}", page(own)) for i, own in short.items()]
    # copies side by side: the nearest different page is farther on
    rows += [(i, f"http://g.example/a/{i}", page(["copied"])) for i in (3, 4, 5)] + [(6, "http://g.example/b", page(["other"]))]
    rows += [(7, "http://g.example/a/4x", "<article>text</article>")]
    # a host of copies only has no other page
    rows += [(i, f"http://k.example/{i}", page(["lone"])) for i in (8, 9)]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert {k: texts[k].split("\n") for k in (1, 2)} == short
    assert [texts[i] for i in (3, 4, 5, 6, 7)] == ["copied"] * 3 + ["other", "text"]
    assert all(texts[i].split("\n") == [f"site line {j}" for j in range(20)] + ["lone"] for i in (8, 9))


def test_the_nearest_url_of_the_whole_host(spark, monkeypatch):
    """The nearest path is not the next one in order; brute force over each host, also in many groups."""
    import random

    def letters(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    rnd = random.Random(3)
    pages = {(f"h{k % 3}", "/" + "".join(rnd.choice("abc/") for _ in range(rnd.randint(1, 7)))): [k % 40, k % 7] for k in range(90)}
    pages |= {("far", "/xa"): [1], ("far", "/xb-other"): [2], ("far", "/za"): [3]}
    rows = [(host, path, lines, k % 5 > 0) for k, ((host, path), lines) in enumerate(pages.items())]
    outlines = spark.createDataFrame(rows, "host string, path string, lines array<long>, asked boolean").repartition(3)
    first = {}
    for (host, path), lines in sorted(pages.items()):
        first.setdefault((host, tuple(lines)), path)
    expected = {}
    for host, path, lines, asked in rows:
        own = first[host, tuple(lines)]
        others = [(letters(own, near), near, of) for (h, of), near in first.items() if h == host and of != tuple(lines)]
        if asked and others:
            expected[host, path] = list(min(others)[2])
    for paired in (4096, 4):
        monkeypatch.setattr(html, "PAIRED", paired)
        found = {(r["host"], r["path"]): list(r["other"]) for r in html.nearest_pages(outlines).collect()}
        assert found == expected
    assert expected.get(("far", "/xa")) in (None, [3])


def test_pages_with_an_article_are_aligned_too(spark):
    """Lines that an article shares with the nearest other page belong to the site."""
    def article(*lines):
        return "<nav>menu</nav><p>outside</p><article>" + "".join(f"<p>{line}</p>" for line in lines) + "</article>"

    rows = [
        (1, "http://a.example/en/10", article("Write to us.", "own one", "All rights reserved.")),
        (2, "http://a.example/en/11", article("Write to us.", "own two", "more", "All rights reserved.")),
        (3, "http://a.example/en/11?x=1", article("Write to us.", "own two", "more", "All rights reserved.")),
        (4, "http://a.example/about", article("own two", "far away")),
        # the nearest page has no article
        (5, "http://b.example/1", article("first", "second")), (6, "http://b.example/2", "<p>first<p>third"),
        # one page, copies only, and pages without an address keep all they have
        (7, "http://c.example/1", article("lone")), (8, "http://d.example/1", article("copy")), (9, "http://d.example/2", article("copy")),
        (10, None, article("lone")), (11, None, article("lone")),
    ]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {
        1: "own one", 2: "own two\nmore", 3: "own two\nmore", 4: "own two\nfar away", 5: "second", 6: "first\nthird",
        7: "lone", 8: "copy", 9: "copy", 10: "lone", 11: "lone",
    }
    assert all(r["n_chars"] == len(r["text"]) for r in found) and len(found) == len(rows)


def test_the_nearest_path_by_definition():
    """Against all pairs: short and long paths, walked a few at a time."""
    import random

    def letters(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    rnd = random.Random(5)
    for trial in range(40):
        longest, n, alphabet = rnd.choice([3, 8, 70, 140]), rnd.choice([1, 2, 5, 40]), rnd.choice(["ab", "abcé/"])
        paths = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(n)})
        asked = [p for p in paths if rnd.random() < 0.7]
        groups = html.asked_groups(asked)
        for k in range(0, len(paths), 7):
            for group in groups:
                group.walk(paths[k : k + 7])
        found = {p: near for group in groups for p, near in zip(group.paths, group.near)}
        assert found == {p: min(((letters(p, q), q) for q in paths if q != p), default=(0, None))[1] for p in asked}
