"""Language choice and quality grades against plain definitions."""

import math

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from riskweave.llm import language, quality

from .data import documents, edge_rows, prose

LANGS = {"en": "the and of to in that is was for with", "de": "der die und in den von zu das mit sich", "fr": "le la les et des que pour dans une sur"}


def texts(n):
    rng, out = np.random.default_rng(4), []
    for i in range(n):
        lang = sorted(LANGS)[i % 3]
        out.append((i, " ".join(rng.choice(LANGS[lang].split(), rng.integers(1, 400))) + (" é123" if i % 5 else "."), lang))
    return out


def chosen(text, dictionaries):
    """Every dictionary in turn, each piece compressed afresh with nothing kept between calls."""
    letters = language.plain(text) if text else b""
    if not letters:
        return "und", 0.0
    padded, sizes = b" " + letters + b" ", {}
    for lang, content in dictionaries.items():
        sizes[lang] = 0
        for at in range(0, len(padded), language.PIECE_BYTES):
            settings = zstandard.ZstdCompressionParameters.from_level(
                language.LEVEL, source_size=language.PIECE_BYTES, dict_size=len(content), hash_log=language.TABLE_LOG,
                chain_log=language.TABLE_LOG, write_content_size=False, write_dict_id=False)
            data = zstandard.ZstdCompressionDict(content, zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=settings)
            packed = zstandard.ZstdCompressor(compression_params=settings, dict_data=data).compress(padded[at : at + language.PIECE_BYTES])
            sizes[lang] += len(packed)
    ranked = sorted(sizes.items(), key=lambda x: x[1])
    share = 1 - ranked[0][1] / ranked[1][1]
    return ranked[0][0], 1 / 3 + 2 / 3 * (1 - 2 ** (-share / language.SCALE))


def test_language_by_trying_every_dictionary(spark):
    rows = [(i, t, lang, "s", 1) for i, t, lang in texts(120)]
    docs = documents(spark, rows + [(i + 500, t, None, "s", 1) for i, t, *_ in edge_rows() if i]).repartition(4)
    model = language.train(docs.filter(language.in_training("doc_id")))
    assert set(model.dictionaries) == set(LANGS)
    found = language.identify(docs, model).select("text", "lang_pred", "score").collect()
    assert len(found) == docs.count()
    for row in found:
        lang, score = chosen(row["text"], model.dictionaries)
        assert row["lang_pred"] == lang and row["score"] == pytest.approx(score)
        assert 0 <= row["score"] <= 1


def test_only_training_rows_are_learned_from(spark):
    docs = documents(spark, [(i, t, lang, "s", 1) for i, t, lang in texts(120)])
    changed = docs.withColumn("text", F.when(language.is_held_out("doc_id"), F.lit("zzz")).otherwise(F.col("text")))
    changed = changed.withColumn("lang", F.when(language.is_held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    models = [language.train(d.filter(language.in_training("doc_id"))) for d in (docs, changed)]
    assert models[0] == models[1]


def test_grades_by_definition(spark):
    """Tail probabilities from the sum of weights of a text's cells, one text at a time."""
    rng = np.random.default_rng(2)
    model = quality.OrdinalModel(rng.normal(size=quality.CELLS) / 10, np.array([-0.5, 0.75]))
    rows = [(i, prose(30 + i, i), "en", "s", 1) for i in range(30)] + edge_rows()
    docs = documents(spark, rows).repartition(3)
    found = quality.grade(docs, model).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["text"] is None:
            assert (row["expected_grade"], row["p_wanted"], row["selected"]) == (None, None, False)
            continue
        _, cell, value = quality.features([row["text"].encode()])
        score = sum(float(v) * float(model.weights[c]) for c, v in zip(cell, value))
        tails = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert row["expected_grade"] == pytest.approx(sum(tails)) and row["p_wanted"] == pytest.approx(tails[1])
        assert row["selected"] == (tails[1] >= quality.LEAST_PROBABILITY)


def test_fit_raises_the_likelihood(spark):
    """Thresholds stay ordered, and the fitted model explains the grades better than the shares alone."""
    rng = np.random.default_rng(3)
    marks = [["bad", "worse", "rubbish"], ["plain", "dull", "some"], ["good", "fine", "great"]]
    grades = rng.integers(0, 3, 300)
    sample = [" ".join([*rng.choice(marks[g], 4), *prose(20, int(i)).split()]).encode() for i, g in enumerate(grades)]

    def likelihood(tails):
        limits = np.concatenate([np.ones((300, 1)), tails, np.zeros((300, 1))], axis=1)
        p = limits[np.arange(300), grades] - limits[np.arange(300), grades + 1]
        return float(np.log(np.maximum(p, 1e-12)).mean())

    model = quality.fit(sample, grades, 3)
    shares = np.tile([(grades >= 1).mean(), (grades >= 2).mean()], (300, 1))
    assert model.thresholds[0] < model.thresholds[1]
    assert likelihood(model.tails(sample)) > likelihood(shares) + 0.3
    test = [" ".join([*rng.choice(marks[g], 4), *prose(20, 900 + i).split()]).encode() for i, g in enumerate([0, 1, 2] * 10)]
    assert (np.round(model.tails(test).sum(axis=1)) == [0, 1, 2] * 10).mean() > 0.9
