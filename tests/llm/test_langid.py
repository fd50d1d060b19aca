from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from helpers import docs, edges, empty

from starmill.llm import langid, queries


def test_held_out_accuracy(spark, tiny):
    made = queries.op1_langid(spark, tiny).join(queries.table(spark, tiny, "documents"), "doc_id").collect()
    held = [r for r in made if r.held_out]
    assert len(held) > 30
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in made)


def test_words_are_counted_per_language(spark):
    rows = [(1, "Eins zwei, zwei", "de"), (2, "one two", "en"), (3, "TWO one2", "en"), (4, None, "en"), (5, "x", None)]
    made = {(r.word, r.lang): r.n for r in langid.word_counts(docs(spark, rows)).collect()}
    want = Counter((w, r[2]) for r in rows if r[1] and r[2] for w in re.findall(r"[^\W\d_]+", r[1].lower()))
    assert made == dict(want)


def test_known_words_first_then_shorter_grams(spark):
    rows = [(k, text, lang) for k, (text, lang) in enumerate([("haus baum haus", "de"), ("house tree", "en"), ("maison", "fr")] * 3)]
    model = langid.train(docs(spark, rows))
    assert model.languages == ["de", "en", "fr"]
    scorer = langid.Scorer(model)
    row = scorer._table[scorer.rows(["haus"])[0]]
    assert row.argmax() == 0 and (row == model.word_scores[model.words.index("haus")]).all()
    # never seen: a long n-gram decides, without one a shorter, with its penalty
    assert scorer.predict("hausbau")[0] == "de"
    grams = dict(zip(model.grams, model.gram_scores))
    assert scorer.back_off("o") == pytest.approx((grams["o"] + grams["^"] + grams["$"]) / 3 + 4 * langid.PENALTY, abs=1e-4)


def test_a_full_cache_changes_nothing(spark):
    model = langid.train(docs(spark, [(1, "haus baum", "de"), (2, "house tree", "en")]))
    text = " ".join(f"hous{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300))
    assert langid.Scorer(model, cached=400).predict(text) == langid.Scorer(model, cached=10_000).predict(text)


def test_edge_cases(spark):
    model = langid.train(edges(spark))
    rows = langid.predict(edges(spark), model).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert [(by_id[k].lang_pred, by_id[k].score) for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by_id[5].lang_pred == "en" and by_id[8].lang_pred == "fr" and None in by_id
    noted = langid.annotate(edges(spark), model)
    assert noted.count() == 10 and set(noted.columns) == set(edges(spark).columns)
    nothing = langid.train(empty(spark))
    assert {r.lang_pred for r in langid.predict(edges(spark), nothing).collect()} == {"und"}
    assert langid.predict(empty(spark), model).collect() == []


def test_ties_go_to_the_first_language(spark):
    model = langid.train(docs(spark, [(1, "same", "b"), (2, "same", "a")]))
    assert langid.Scorer(model).predict("same") == ("a", 0.5)


def test_a_language_of_one_rare_word(spark):
    rows = [(k, f"wort{chr(97 + k)} satz", "de") for k in range(20)] + [(50, "word", "en")]
    for vocabulary in (0, 1, 3, 100):
        model = langid.train(docs(spark, rows), vocabulary=vocabulary, grams=40)
        assert model.languages == ["de", "en"] and len(model.words) == min(vocabulary, 22)
        assert langid.Scorer(model).predict("satz")[0] == "de"


def test_equally_frequent_words_fill_the_vocabulary(spark):
    rows = [(1, "f e d c b a a a", "en"), (2, "g h", "de")]
    model = langid.train(docs(spark, rows), vocabulary=5)
    assert model.words == ["a", "b", "c", "d", "e"] and model.languages == ["de", "en"]


def plain_scores(rows, word):
    """Log scores of a word by plain counting, all words and n-grams kept."""
    counts, grams = {}, {}
    for _, text, lang, *_ in rows:
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            counts.setdefault(lang, Counter())[w] += 1
            padded = f"^{w}$"
            for size in range(1, 5):
                for i in range(len(padded) - size + 1):
                    grams.setdefault(lang, {}).setdefault(size, Counter())[padded[i : i + size]] += 1
    names = sorted(counts)
    every = set().union(*counts.values())
    if word in every:
        return [math.log((counts[n][word] + 0.1) / sum(counts[n][w] + 0.1 for w in every)) for n in names]
    padded, penalty = f"^{word}$", 0.0
    for size in (4, 3, 2, 1):
        penalty += math.log(0.4)
        known = set().union(*(grams[n].get(size, ()) for n in names))
        mine = [g for i in range(len(padded) - size + 1) if (g := padded[i : i + size]) in known]
        if mine:
            totals = {n: sum(grams[n].get(size, Counter())[g] + 0.1 for g in known) for n in names}
            return [sum(math.log((grams[n].get(size, Counter())[g] + 0.1) / totals[n]) for g in mine) / len(mine) + penalty for n in names]
    return [0.0] * len(names)


def test_scores_equal_plain_counting(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    rows = [(k, " ".join(rng.choices(words[20 * j : 20 * j + 30], k=12)), "xyz"[j]) for k in range(30) for j in [k % 3]]
    model = langid.train(docs(spark, rows))
    scorer = langid.Scorer(model)
    for word in [*words, "abba", "zzz", "aaaaaaa", "é"]:
        mine = scorer._table[scorer.rows([word])[0]]
        assert mine.tolist() == pytest.approx(plain_scores(rows, word), abs=1e-4)
