from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import regex

from mercato.llm.op10_language_id import Fit, Model, Scores, identify, predict_text, sample_share, train


def test_held_out_accuracy(result, spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = result("op10", folder)
    held = [r for r in rows if r["held_out"]]
    assert [r["held_out"] for r in rows] == [zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(result, odd_dir):
    rows = {r["doc_id"]: r for r in result("op10", odd_dir)}
    for i in (1, 2, 3, 8):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    # Only languages of training rows are predicted.
    learned = {"en", "de", "el"}
    assert {r["lang_pred"] for r in rows.values()} <= learned | {"und"}
    assert rows[4]["lang_pred"] == "en"


def model():
    word = {"the": np.array([-1.0, -6.0]), "die": np.array([-6.0, -1.0])}
    one = {"a": np.array([-1.0, -2.0]), "z": np.array([-2.0, -1.0])}
    two = {" q": np.array([-0.5, -3.0]), "zz": np.array([-3.0, -0.5])}
    return Model(("de", "en"), (word, one, two))


def test_backoff_order():
    """Words first; of n-grams only the longest that are known."""
    m = model()
    assert (m.score("qaz") == [-0.5, -3.0]).all()
    assert (m.score("az") == [-1.5, -1.5]).all()
    assert (m.score("日本") == [0.0, 0.0]).all()
    assert predict_text("the the die", Scores(m))[0] == "de"
    assert predict_text("日本", Scores(m)) == ("de", 0.5)  # a tie goes to the first


def test_scores_do_not_depend_on_what_was_kept():
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(400)) + " the die"
    wide, narrow = Scores(model()), Scores(model(), limit=7)
    for _ in range(2):
        a, b = predict_text(text, wide), predict_text(text, narrow)
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-12
    assert len(narrow) <= 2 + 7


def test_sample_is_bounded(spark):
    rows = [(i, f"word{i} same", "en" if i % 10 else "fr") for i in range(2000)]
    fit = Fit(docs_per_language=100)
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    m = train(labelled, fit)
    assert m.languages == ("en", "fr")
    few = train(labelled, Fit(words=1, grams=5, longest=2))
    assert len(few.tables[0]) <= 2 and all(len(t) <= 10 for t in few.tables[1:])


def test_other_columns_pass(spark):
    df = spark.createDataFrame([(1, "the", 0.5)], "doc_id bigint, text string, score double")
    (row,) = identify(df, model(), to=("l", "s")).collect()
    assert (row["doc_id"], row["score"], row["l"]) == (1, 0.5, "de")


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_no_language_is_lost(spark):
    """Whatever the ids and sizes: NULL, repeated, and wholly equal rows."""
    rows = [(None, f"the words of {i}", "en") for i in range(3000)] + [(None, f"les mots de {i}", "fr") for i in range(9)]
    rows += [(5, f"das Wort {i}", "de") for i in range(2000)] + [(6, "una palabra", "es")] * 2000
    model = train(labelled(spark, rows), Fit(docs_per_language=5))
    assert model.languages == ("de", "en", "es", "fr")
    # The sample is bounded although ids repeat.
    assert len(model.tables[0]) < 4 * 30


def test_share_of_large_languages():
    assert sample_share(4000, 100) == 1.0
    for n in (5 * 10**9, 10**13):
        assert math.isclose(sample_share(4000, n) * n, 4000)


def brute_force(training, texts, fit):
    """Predictions worked out in plain Python, without tables, arrays or kept scores."""
    letters = regex.compile(r"\p{L}+")
    counts = defaultdict(Counter)
    for text, lang in training:
        for word in letters.findall((text or "").lower()):
            counts[lang, 0][word] += 1
            for n in range(1, fit.longest + 1):
                padded = f" {word} "
                counts[lang, n].update(padded[i : i + n] for i in range(len(padded) - n + 1))
    kept = {}
    for (lang, n), own in counts.items():
        best = sorted(own.items(), key=lambda x: (-x[1], x[0].encode()))[: fit.grams if n else fit.words]
        kept[lang, n] = dict(best)
    languages = sorted({lang for lang, _ in kept})
    total = {key: sum(own.values()) for key, own in kept.items()}

    def feature(lang, n, f):
        own = kept.get((lang, n), {})
        return math.log10(own[f] / total[lang, n]) if f in own else math.log10(1 / max(1, total.get((lang, n), 0))) + fit.penalty

    def known(n, f):
        return any(f in kept.get((lang, n), {}) for lang in languages)

    def word_scores(word):
        if known(0, word):
            return [feature(lang, 0, word) for lang in languages]
        padded = f" {word} "
        for n in range(fit.longest, 0, -1):
            grams = [g for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if known(n, g)]
            if grams:
                return [sum(feature(lang, n, g) for g in grams) / len(grams) for lang in languages]
        return [0.0] * len(languages)

    for text in texts:
        words = letters.findall((text or "").lower())
        if not words:
            yield "und", 0.0
            continue
        sums = [sum(x) / len(words) for x in zip(*map(word_scores, words), strict=True)]
        best = max(range(len(languages)), key=lambda i: sums[i])
        yield languages[best], 1 / sum(10 ** (x - sums[best]) for x in sums)


def test_every_document_against_brute_force(result, documents):
    ids = sorted(documents)
    training = [
        (documents[i]["text"], documents[i]["lang"])
        for i in ids
        if zlib.crc32(str(i).encode()) % 3 != 1 and documents[i]["lang"] is not None
    ]
    rows = {r["doc_id"]: r for r in result("op10")}
    for i, (lang, score) in zip(ids, brute_force(training, [documents[i]["text"] for i in ids], Fit()), strict=True):
        assert rows[i]["lang_pred"] == lang
        assert abs(rows[i]["score"] - score) < 1e-9
