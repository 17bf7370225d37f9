"""The word model: brute force, shuffled words, both models in one pass."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkpipe.llm import quality_lm, word_lm
from sparkpipe.llm.common import prepare, table

TRUSTED = ["the cat sat on the mat.", "a cat and a hat", None, "", "the cat sat on a hat", "the 12 mats !! the cat"]


def tokens(text):
    return re.findall(r"\w+|[^\w\s]+", text or "")


def brute(texts):
    """Probability function of interpolated modified Kneser-Ney by the textbook recursion."""
    counts = {3: {}, 2: {}, 1: {}}
    for t in texts:
        s = ["<s>", "<s>", *tokens(t)]
        for i in range(2, len(s)):
            g = tuple(s[i - 2:i + 1])
            counts[3][g] = counts[3].get(g, 0) + 1
    for order in (2, 1):
        for g in counts[order + 1]:
            counts[order][g[1:]] = counts[order].get(g[1:], 0) + 1

    def p(order, gram):
        if order == 0:
            return 1 / (len(counts[1]) + 1)
        table = counts[order]
        of = [max(sum(n == k for n in table.values()), 1) for k in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1])
        d = [min(max(k - (k + 1) * y * of[k] / of[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]
        context = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        if not context:
            return p(order - 1, gram[1:])
        total, n = sum(context.values()), table.get(gram, 0)
        back = sum(d[min(x, 3) - 1] for x in context.values()) / total
        return (n - d[min(n, 3) - 1] if n else 0) / total + back * p(order - 1, gram[1:])
    return lambda text: -sum(np.log(p(3, tuple((["<s>", "<s>", *tokens(text)])[i:i + 3]))) for i in range(len(tokens(text))))


def test_word_model_equals_brute_force(spark):
    docs = prepare(spark).createDataFrame(list(enumerate(TRUSTED)), "doc_id long, text string")
    asked = spark.createDataFrame([(10, "the cat sat on the mat."), (11, "on cat mat the the sat."), (12, "unseen words, the cat"),
                                   (13, ""), (14, None), (10, "the cat sat on the mat.")], "doc_id long, text string")
    held = F.col("doc_id") == 4
    model = word_lm.train(docs, held)
    scored = word_lm.score(asked, docs.where(held), model, ["doc_id"]).collect()
    assert len(scored) == 7
    every, some = brute(TRUSTED), brute([t for i, t in enumerate(TRUSTED) if i != 4])
    texts = dict(enumerate(TRUSTED)) | {r["doc_id"]: r["text"] for r in asked.collect()}
    for r in scored:
        text = texts[r["doc_id"]]
        assert r["__held"] == (r["doc_id"] == 4) and r["__n_words"] == len(tokens(text))
        assert abs(r["__nll"] - (some if r["__held"] else every)(text)) < 1e-4, r


SMALL = {"ROUND_TOKENS": 40, "SHARD_TOKENS": 20, "SPREAD_TOKENS": 8, "BATCH_DOCS": 3, "BOOK_WORDS": 9, "TOP_WORDS": 12}


@pytest.mark.parametrize("small", [{}, SMALL, SMALL | {"TOP_WORDS": 1000}, SMALL | {"BATCH_BYTES": 1, "SETTLE": 1}, {"TOP_WORDS": 0}])
def test_rounds_spread_words_and_words_beyond_the_top_change_nothing(spark, monkeypatch, small):
    for name, value in small.items():
        monkeypatch.setattr(word_lm, name, value)
    rng = random.Random(3)
    vocabulary = ["the", "of", ",", "a", *(f"w{i}" for i in range(40))]
    texts = [" ".join(rng.choices(vocabulary, [30, 12, 8, 5, *[1] * 40], k=rng.randrange(30))) for _ in range(30)]
    texts += [None, "", "the the the the the the the the", *texts[:3], "unseen words , the unseen the"]
    rows = [(i, t, i % 3 != 2, i % 4 == 1) for i, t in enumerate(texts)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, good boolean, held boolean").repartition(2).cache()
    trusted, held = F.col("good"), F.col("held")
    model = word_lm.train(docs, held, trusted=trusted)
    assert not small or small == {"TOP_WORDS": 0} or model.deal.rounds > 2 and len(model.deal.hot) > 1 and model.deal.parts.max() > 1
    scored = word_lm.score(docs, docs.where(trusted & held), model, ["doc_id"], known=True).collect()
    every, some = brute([r[1] for r in rows if r[2]]), brute([r[1] for r in rows if r[2] and not r[3]])
    assert sorted((r["doc_id"], r["__held"]) for r in scored) == sorted([(r[0], False) for r in rows] + [(r[0], True) for r in rows if r[2] and r[3]])
    for r in scored:
        text = rows[r["doc_id"]][1]
        assert r["__n_words"] == len(tokens(text))
        assert abs(r["__nll"] - (some if r["__held"] else every)(text)) < 1e-4, r
    model.release()
    docs.unpersist()


def test_words_kept_as_numbers_take_little_and_nothing_is_left(spark):
    root = prepare(spark).sparkContext.getCheckpointDir().removeprefix("file:")

    def tables():
        return {os.path.join(d, x): os.path.getsize(os.path.join(d, x)) for d, _, names in os.walk(root) for x in names if x.endswith(".parquet")}
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    before = tables()
    assert quality_lm.quality_filter(docs, labels).count()
    left = {f: n for f, n in tables().items() if f not in before}
    assert sum(left.values()) < 0.2 * os.path.getsize("/root/testdata/sf0.01/documents.parquet"), left


def test_shuffled_words_are_rejected(spark):
    rng = random.Random(5)
    follow = [rng.sample(range(300), 3) for _ in range(300)]  # after each word come three others

    def text(n=80):
        at = [rng.randrange(300)]
        while len(at) < n:
            at.append(rng.choice(follow[at[-1]]))
        return [f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]}" for k in at]
    clean = [text() for _ in range(500)]
    mixed = [rng.sample(t, len(t)) for t in clean[:100]]
    docs = prepare(spark).createDataFrame([(i, " ".join(t), "en") for i, t in enumerate([*clean, *mixed])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality_lm.quality_filter(docs, labels).select("doc_id").collect()}
    assert sum(i in kept for i in range(500)) >= 490 and not any(i in kept for i in range(500, 600))


def scores(spark, by_lang):
    """Held-out rows whose perplexity by language is 100, 101, ..., with the average of one and the same text length."""
    rows = [(lang, 1000, 1000 * float(np.log(100 + i))) for lang, n in by_lang.items() for i in range(n)]
    return prepare(spark).createDataFrame(rows, "__lang string, __n_words long, __nll double")


def test_threshold_is_the_quantile_itself(spark):
    scored = scores(spark, {"en": 1000})
    limits, overall, average = quality_lm.thresholds(scored)
    ppl = sorted(r["p"] for r in scored.select(quality_lm.perplexity(F.lit(average)).alias("p")).collect())
    assert abs(overall - ppl[994]) < 1e-6 and [r["threshold"] <= ppl[995] for r in limits.collect()] == [True]


def test_little_junk_is_kept_and_little_clean_text_goes(spark):
    docs, labels = (table(prepare(spark), "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    kept = {r["doc_id"] for r in quality_lm.quality_filter(docs, labels.where("doc_id % 2 = 0")).select("doc_id").collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    clean, junk = (np.mean([r["doc_id"] in kept for r in held if r["quality"] == q]) for q in (1, 0))
    assert clean >= 0.985 and junk <= 0.18, (clean, junk)


def test_threshold_follows_the_number_of_documents_smoothly(spark):
    found = {}
    for n in (10, 49, 50, 51, 200):
        # a rare language that is easier than the large one
        scored = scores(spark, {"xx": n, "en": 1000})
        limits, overall, _ = quality_lm.thresholds(scored)
        found[n] = {r["lang"]: r["threshold"] / overall for r in limits.collect()}["xx"]
    assert all(a < 1 for a in found.values()) and abs(found[49] - found[50]) < 0.02 and abs(found[50] - found[51]) < 0.02
    assert found[10] > found[50] > found[200]


def test_quality_with_names_of_their_own_and_a_long_text(spark):
    names = ["__lang", "__body", "__keep", "__batch", "__trusted", "__held", "row"]
    long = " ".join(TRUSTED[i % 2] for i in range(20_000))
    rows = [(i, TRUSTED[i % 2], "en", *names) for i in range(20)] + [(30, long, "en", *names), (31, None, None, *names)]
    docs = prepare(spark).createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", *(f"{n} string" for n in names)]))
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    out = quality_lm.quality_filter(docs, labels)
    assert out.columns == docs.columns and 31 in {r["doc_id"] for r in out.where("row = 'row' and __keep = '__keep'").collect()}
    judged = {r["doc_id"]: r for r in quality_lm.classify(docs, labels, ["doc_id"]).collect()}
    assert len(judged) == 22 and all(np.isfinite(r["__perplexity"]) for r in judged.values())
    assert judged[30]["__perplexity"] != judged[0]["__perplexity"]
    assert abs(judged[0]["__perplexity"] - judged[2]["__perplexity"]) < 1e-9


def test_different_keys_that_share_their_first_bits():
    for keys in ([], [7], [9, 8, 9, 1 << 63, 8, 0], [(5 << 60) + k % 7 for k in (3, 1, 6, 3, 0, 1, 12)]):
        keys = np.array(keys, np.uint64)
        of, first, at = word_lm._different(keys)
        assert of.tolist() == sorted(set(keys.tolist())) and keys[first].tolist() == of.tolist() and of[at].tolist() == keys.tolist()
