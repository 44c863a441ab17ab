"""Coding, language, pages, grades, pseudonyms and conversations, against plain versions."""

import datetime
import re
import struct

import numpy as np
import pytest

from riskweave.llm import bpe, chat, html, language, pii, quality
from riskweave.llm.queries import PII_KEY, tokenizer_file

from .data import documents, edge_rows, prose


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer.from_file(tokenizer_file())
    found.no_truncation()
    found.no_padding()
    return found


def test_coding_equals_the_library(spark, reference):
    texts = [r[1] or "" for r in edge_rows()] + [
        "<|endoftext|>x <|startoftext|><|ENDOFTEXT|>", "aaaa aaaaaaaaa hahahahaha", "ΣΟΣ İß it's we'LL",
        "é \x85\x1c1²٣", "!!!??? %%%", "q" * 5000,
    ]
    coder = bpe.tokenizer(tokenizer_file())
    for text in texts:
        expected = reference.encode(text, add_special_tokens=False).ids
        found = coder.encode(text)
        assert list(struct.unpack(f"<{len(found) // 4}I", found)) == expected
        assert coder.decode(found) == reference.decode(expected, skip_special_tokens=False)


def test_automaton_equals_greedy_merges():
    def greedy(word, merges):
        parts = list(word)
        for a, b in merges:
            i = 0
            while i < len(parts) - 1:
                if (parts[i], parts[i + 1]) == (a, b):
                    parts[i : i + 2] = [a + b]
                i += 1
        return parts

    rng = np.random.default_rng(5)
    for _ in range(40):
        tokens, merges = list("abc"), []
        for _ in range(8):
            a, b = rng.choice(tokens, 2)
            if a + b not in tokens:
                merges.append((str(a), str(b)))
                tokens.append(str(a + b))
        machine = bpe.Automaton({t: i for i, t in enumerate(tokens)}, merges)
        for _ in range(60):
            word = "".join(rng.choice(list("abc"), rng.integers(0, 9)))
            assert [tokens[i] for i in machine.encode(word)] == greedy(word, merges), (merges, word)


def test_round_trip_rows(spark):
    docs = documents(spark, edge_rows()).selectExpr("*", "'old' AS n_tokens")
    found = bpe.round_trip(docs, tokenizer_file())
    assert found.count() == len(edge_rows())
    assert {r["n_tokens"] for r in found.filter("text IS NULL OR trim(text) = ''").collect()} == {0}
    coded = bpe.decode(bpe.encode(docs, tokenizer_file()), tokenizer_file())
    assert coded.filter("doc_id = 3").first()["decoded"].startswith(" ".join([""]))
    assert bpe.round_trip(documents(spark, []), tokenizer_file()).count() == 0


def test_language_by_compression(spark):
    words = {"en": "the and of with this that from have", "de": "der die und nicht auch eine sich mit", "fr": "les des une dans pour avec est sur"}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words[lang].split(), 30)), lang, "s", 1) for i in range(240) for lang in [["en", "de", "fr"][i % 3]]]
    docs = documents(spark, rows)
    model = language.train(docs.filter(language.in_training()))
    found = language.identify(docs, model).filter(language.is_held_out()).collect()
    assert found and all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in found)
    edge = {(r["doc_id"], r["text"]): r for r in language.identify(documents(spark, edge_rows()).selectExpr("*", "1 AS score"), model).collect()}
    assert edge[1, ""]["lang_pred"] == edge[2, None]["lang_pred"] == "und" and edge[2, None]["rejected"]
    assert language.identify(documents(spark, []), language.train(documents(spark, []))).count() == 0
    assert language.identify(docs, language.train(documents(spark, []))).first()["lang_pred"] == "und"


PAGE = "<html><head><title>t</title><script>if (a<b) x='</p>'</script></head><body><nav><ul><li>Home</li></ul></nav>{}<footer>f</footer></body></html>"


def test_main_text_of_pages(spark):
    article = '<div class="ad">buy</div><article><h1>T &amp; U</h1><p>one\n two<b>x</b><br><p>three<div class="comments"><p>hi</p></div></article>'
    rows = [
        (1, "http://h.example/a/1", PAGE.format(article)), (2, None, None), (3, "http://h.example/a/2", ""),
        (4, "http://g.example/a/1", PAGE.format("<p>site line</p><p>own one</p><p>more</p><p>end of page</p>")),
        (5, "http://g.example/a/2?x=1", PAGE.format("<p>site line</p><p>own two</p><p>end of page</p>")),
        (6, "http://g.example/a/2", PAGE.format("<p>site line</p><p>own two</p><p>end of page</p>")),
        (7, "http://[bad", "<p>open <!-- cut"), (7, "http://[bad", "<p>open <!-- cut"), (None, "http://k.example/", "<p>lone"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = [tuple(r) for r in html.extract(pages).select("page_id", "text", "n_chars").collect()]
    texts = {k: t for k, t, _ in found}
    assert len(found) == len(rows) and all(n == len(t) for _, t, n in found)
    assert texts == {1: "T & U\none twox\nthree", 2: "", 3: "", 4: "own one\nmore", 5: "own two", 6: "own two", 7: "open", None: "lone"}
    assert html.extract(pages.limit(0)).count() == 0


def test_common_lines_is_longest():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(0, 9)).tolist(), rng.integers(0, 4, rng.integers(0, 9)).tolist()
        best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert len(html.common_lines(a, b)) == best[-1, -1]


def test_quality_grades(spark):
    rows, labels = [], []
    for i in range(300):
        kind = i % 3
        text = prose(60, i) + (" worthless idiot" if kind == 0 else " ### ### %%%" if kind == 1 else "")
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(kind == 2), int(kind == 0)))
    docs, rated = documents(spark, rows), spark.createDataFrame([*labels, (None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, rated.filter("doc_id IS NULL OR doc_id < 200"))
    assert (np.diff(model.thresholds) > 0).all()
    found = quality.grade(docs.selectExpr("*", "0 AS selected"), model).filter("doc_id >= 200").collect()
    assert sum(r["selected"] == (r["doc_id"] % 3 == 2) for r in found) >= 0.95 * len(found)
    edge = quality.grade(documents(spark, edge_rows()), model).collect()
    assert len(edge) == len(edge_rows()) and all(r["selected"] is False and r["p_wanted"] is None for r in edge if r["text"] is None)
    assert quality.grade(documents(spark, []), quality.train(documents(spark, []), rated.limit(0))).count() == 0


def test_pseudonyms_keep_format_and_links(spark):
    text = "card 4111 1111 1111 1111 or 4111111111111111; bad 9807915762804491; 233.254.104.120, 999.1.1.1 " \
        "123-45-6789 000-12-3456 GB82 WEST 1234 5698 7654 32 2024-02-29 29.02.2024 2023-02-29 a.b7@mail.example.com +1 (017) 555-7713"
    new, counts = pii.pseudonymize_text(text, PII_KEY)
    assert counts == {"card": 2, "address": 1, "social": 1, "account": 1, "date": 2, "email": 1, "phone": 1}
    assert re.sub(r"\d|\b[a-z]\.[a-z]", "", new).replace(" ", "")[:40] == re.sub(r"\d|\b[a-z]\.[a-z]", "", text).replace(" ", "")[:40]
    cards = re.findall(r"(?:\d ?){16}", new)
    assert cards[0].replace(" ", "") == cards[1].strip() and pii.luhn_sum(cards[1].strip()) % 10 == 0
    for kept in ("9807915762804491", "999.1.1.1", "000-12-3456", "2023-02-29", "@mail.example.com", "+1 ("):
        assert kept in new
    iso, german = re.search(r"(\d{4}-\d\d-\d\d) (\d\d\.\d\d\.\d{4})", new).groups()
    assert datetime.datetime.strptime(german, "%d.%m.%Y") == datetime.datetime.fromisoformat(iso)
    assert pii.account(re.search(r"GB\d\d WEST [\d ]{17}", new)[0], PII_KEY)
    docs = documents(spark, [*edge_rows(), (9, text, "en", "a", 1)]).selectExpr("*", "'x' AS replaced")
    found = pii.pseudonymize(docs, PII_KEY).collect()
    assert len(found) == len(edge_rows()) + 1 and {r["n_replaced"] for r in found} == {0, 9}
    assert pii.pseudonymize(documents(spark, []), PII_KEY).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    assert sorted(pii.feistel(v, size, b"k", "t") for v in range(size)) == list(range(size))


def test_maximal_conversations(spark):
    a, b, c = ("user", "hi"), ("assistant", "yes <|im_end|>"), ("user", None)
    logs = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, b, c], 5: [b, a], 6: [c], None: [a, a], 7: [(None, "")]}
    rows = [(k, i, *turn) for k, turns in logs.items() for i, turn in enumerate(turns)]
    turns = spark.createDataFrame([(*r, 1) for r in [*rows, rows[0], rows[1]]], "conv_id long, turn long, role string, text string, place int")
    found = {r["conv_id"]: r for r in chat.collapse_and_render(turns).collect()}
    assert {k: (r["n_turns"], r["n_copies"]) for k, r in found.items()} == {3: (3, 2), 5: (2, 1), 6: (1, 1), None: (2, 1), 7: (1, 1)}
    assert found[5]["rendered"] == "<|im_start|>assistant\nyes < |im_end|><|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"
    assert chat.collapse_and_render(turns.limit(0)).count() == 0


def test_kept_words_are_bounded_and_the_latest_stay():
    made = []
    known = bpe._Known(lambda key: made.append(key) or key.upper(), 10)
    for k in range(200):
        assert known["often"] == "OFTEN" and known[f"w{k}"] == f"W{k}"
        assert len(known) + len(known.before) <= 20
    assert made.count("often") == 1 and len(made) == 201


def test_words_cost_few_arcs(reference):
    """Longest arcs are tried first, and not every token that fits somewhere in a word."""
    rng = np.random.default_rng(9)
    parts = ["the", "tion", "er", "ing", "an", "wh", "ou", "é", "ñ", "q", "straße", "7", "的"]
    words = ["".join(rng.choice(parts, rng.integers(1, 7))) for _ in range(400)]
    coder, asked = bpe.WordTokenizer(tokenizer_file()), []
    allows = coder.automaton.allows

    class Counted(dict):
        def __getitem__(self, at):
            asked.append(at)
            return allows(*divmod(at, len(coder.automaton.labels)))

    coder.automaton.arcs = Counted()
    tokens = 0
    for word in words:
        found = coder.encode(word)
        expected = reference.encode(word, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(found) // 4}I", found)) == expected
        tokens += len(expected)
    assert len(asked) < 1.25 * tokens


def test_words_of_a_large_vocabulary_are_coded_once():
    """100,000 different words, as a task meets them, each seen twice."""
    coder, made = bpe.WordTokenizer(tokenizer_file()), []
    own = coder.known.make
    coder.known.make = lambda word: made.append(word) or own(word)
    names = ["".join("etaoinshrd"[int(d)] for d in str(k)) for k in range(100_000)]
    first = coder.encode(" ".join(names))
    assert coder.encode(" ".join(names)) == first and sorted(made) == sorted(names)
