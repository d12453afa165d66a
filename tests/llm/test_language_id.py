"""Language identification against a plain version of the same backoff."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from tidemart.llm import language_id

WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def plain_model(rows):
    counts = defaultdict(Counter)  # (n, lang) -> grams
    for text, lang in rows:
        for word in WORDS.findall(text.lower()):
            counts[0, lang][word] += 1
            for n in range(1, language_id.LONGEST + 1):
                padded = f" {word} " if n > 1 else word
                counts[n, lang].update(padded[i:i + n] for i in range(len(padded) - n + 1))
    return counts


def plain_judge(text, counts, languages, first):
    words = WORDS.findall((text or "").lower())
    if not words or not languages:
        return "und", 0.0
    most = {n: max(sum(counts[n, lang].values()) for lang in languages) for n in range(language_id.LONGEST + 1)}

    def logs(n, gram):
        found = [counts[n, lang][gram] for lang in languages]
        return [math.log10(c / sum(counts[n, lang].values()) if c else 0.5 / most[n]) for c, lang in zip(found, languages)] if any(found) else None

    total, heard = [0.0] * len(languages), 0
    for word in words:
        row = logs(0, word)
        for n in range(language_id.LONGEST, 0, -1):
            if row:
                break
            known = [x for g in language_id.ngrams(word, n) if (x := logs(n, g))]
            row = [sum(c) / len(known) for c in zip(*known)] if known else None
        if row:
            total, heard = [a + b for a, b in zip(total, row)], heard + 1
    if not heard:
        return first, 1 / len(languages)
    likely = [10 ** ((t - max(total)) / heard) for t in total]
    best = likely.index(max(likely))
    return languages[best], likely[best] / sum(likely)


TRAIN = [("The cat sat on the mat. The END", "en"), ("a dog and the cat", "en"), ("le chat et le chien", "fr"),
         ("un chien est là", "fr"), ("der Hund und die Katze", "de"), ("größe über", "de"), (None, "de"), ("no label", None)]
ASKED = [None, "", "123 ²½ !?", "the cat", "THE CATS", "chienne", "Hündin über alles", "zzz", "日本語", "là là là", "x", "cat chat", " \n"]


@pytest.mark.parametrize("train", [TRAIN, [], [("", "en")], [("one", "en")]])
def test_same_as_the_plain_version(spark, train):
    rows = [(i, t, lang, "mark", "mark") for i, (t, lang) in enumerate(train)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, rows string")
    model = language_id.fit(docs, F.lit(True))
    asked = spark.createDataFrame([(i, t, "mark") for i, t in enumerate(ASKED)], "doc_id long, text string, score string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(asked, model).collect()}
    usable = [(t, lang) for t, lang in train if t is not None and lang is not None]
    counts = plain_model(usable)
    languages = sorted({lang for t, lang in usable if WORDS.findall(t)})
    size = Counter()
    for t, lang in usable:
        size[lang] += len(t.encode())
    first = max(languages, key=lambda x: size[x], default=None)
    for i, text in enumerate(ASKED):
        lang, score = plain_judge(text, counts, languages, first)
        assert got[i][0] == lang, text
        assert got[i][1] == pytest.approx(score, abs=1e-12), text


def test_long_texts_are_judged_as_a_whole(spark):
    docs = spark.createDataFrame([("the cat " * 50, "en"), ("le chat " * 50, "fr")], "text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    text = "the cat " * 60_000 + "le chat " * 70_000  # French wins only with the end
    assert len(text) > language_id.WHOLE_CHARS
    rows = spark.createDataFrame([(text,), (text,)], "text string")
    assert [r["lang_pred"] for r in language_id.identify(rows, model).collect()] == ["fr", "fr"]


def test_draw_is_bounded_and_enough(spark):
    rows = [(i, f"{'the cat' if i % 2 else 'le chat'} {i % 97}", "en" if i % 2 else "fr") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True), train_bytes=800)
    assert sorted(model.words) == ["cat", "chat", "le", "the"]
    found = language_id.identify(docs, model).where("lang_pred <> lang").count()
    assert found == 0


def test_unknown_words_beyond_the_cache(spark):
    docs = spark.createDataFrame([("the cat", "en"), ("le chat", "fr")], "text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    small, whole = language_id.Scorer(model, 40), language_id.Scorer(model)
    texts = [" ".join(f"{a}{b}the" for b in "abcdef") for a in "abcdefghijkl"]
    assert [small.judge(t) for t in texts] == [whole.judge(t) for t in texts]


def test_held_out_documents(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id long").select(
        "doc_id", language_id.quarter_held_out().alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_empty_table(spark, no_docs):
    model = language_id.fit(no_docs, F.lit(True))
    assert language_id.identify(no_docs, model).collect() == []
