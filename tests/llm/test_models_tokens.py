"""Tokens, packing, quality and toxicity models: round trips, brute force, held-out accuracy; the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkpipe.llm import bpe, packing, quality_lm, toxicity
from sparkpipe.llm.common import prepare, table

SF = "/root/testdata/sf0.001"
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = [*"abcdehiort  \n\t.,!?'sS<|>0123", "\x1c", "\x85", "\xa0", " ", "é", "ß", "İ", "Σ", "中", "🙂", "́", "ª",
            "²", "<|endoftext|>", "<|startoftext|>", "\x00"]


def texts():
    rng = random.Random(0)
    return ["", "a" * 3000, " " * 2000, "=-" * 900, *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(800))]


def odd(spark):
    return prepare(spark).createDataFrame(
        [(i, t, 0) for i, t in enumerate(texts())] + [(None, "no id", 0), (5, None, 0), (6, "twice", 0), (6, "twice", 0)],
        "doc_id long, text string, token_ids int")


def test_encoder_equals_library_and_round_trips(spark):
    library, coder = Tokenizer.from_file(BYTES), bpe.BytePairCoder(BYTES)
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        got = coder.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False) == t
    docs = odd(spark)
    ids = bpe.encode(docs, BYTES)
    back = bpe.decode(ids, BYTES)
    assert sorted(str(r["text"]) for r in back.collect()) == sorted(t or "" for _, t, _ in docs.collect())
    out = bpe.digests(docs, BYTES)
    assert out.count() == docs.count() and out.where("doc_id = 5 and n_tokens = 0").count() == 1
    assert bpe.digests(docs.limit(0), BYTES).count() == 0


def test_every_token_encodes_to_itself():
    coder = bpe.BytePairCoder(BYTES)
    for rank in range(0, len(coder.ids), 7):
        i = coder.ids[rank]
        assert coder.ranks(coder.blob[coder.offset[i]:coder.offset[i + 1]].tobytes()) == [rank]


def unpack(pieces, capacity):
    places = {}
    for r in pieces:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_is_gapless_and_tight(spark):
    library = Tokenizer.from_file(WORDS)
    docs = odd(spark)
    pieces = packing.pack_documents(docs, WORDS, capacity=64).collect()
    n = unpack(pieces, 64)
    assert n <= 1.03 * -(-sum(r["length"] for r in pieces) // 64) + 1
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts()):
        if i in (5, 6):
            continue
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [
            (s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes())) for s in range(0, len(ids), 64)]
    assert packing.pack_documents(docs.limit(0), WORDS).count() == 0


def test_plan_is_never_worse_than_best_fit():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.choice([10, 16, 50, 100])
        histogram = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(1, 25))}
        runs, n = packing.plan(histogram, capacity)
        free = []
        for size in sorted((s for s, c in histogram.items() for _ in range(c)), reverse=True):
            fits = [f for f in free if f >= size]
            if fits:
                free.remove(min(fits))
            free.append((min(fits) if fits else capacity) - size)
        assert -(-sum(s * c for s, c in histogram.items()) // capacity) <= n <= len(free)
        rows = [{"sequence_id": q, "offset": o, "length": s} for s, c in histogram.items() for k in range(c)
                for q, o in [next((q + (k - f) // e, o + (k - f) % e * s) for f, e, q, o in reversed(runs[s]) if f <= k)]]
        assert unpack(rows, capacity) == n


def test_quality_filter_keeps_clean_and_rejects_junk(spark):
    docs, labels = (table(prepare(spark), "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    train = labels.where("doc_id % 2 = 0")
    kept = {r["doc_id"] for r in quality_lm.quality_filter(docs, train).select("doc_id").collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    clean, junk = ([r["doc_id"] for r in held if r["quality"] == q] for q in (1, 0))
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert sum(i in kept for i in junk) <= 0.3 * len(junk)


def test_quality_of_odd_rows(spark):
    spark = prepare(spark)
    docs = spark.createDataFrame([(1, "good words here", "en", 1), (2, None, None, 1), (3, "", "xx", 1), (None, "##$$%%", "en", 1),
                                  (1, "good words here", "en", 1)], "doc_id long, text string, lang string, __keep int")
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = docs.drop("__keep").withColumn("nll", F.lit(1))
    assert quality_lm.quality_filter(docs, labels).columns == docs.columns
    assert {1, 2, 3} <= {r["doc_id"] for r in quality_lm.quality_filter(docs, labels).collect()}
    assert quality_lm.quality_filter(docs, labels.limit(0)).count() == 5  # nothing is trusted: nothing goes
    assert quality_lm.quality_filter(docs.limit(0), labels).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (table(prepare(spark), "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    named = labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    out = toxicity.toxicity(docs.join(labels.select("doc_id"), "doc_id"), named.where("doc_id % 3 > 0"), ["junk", "toxic"])
    rows = out.join(labels.select("doc_id", F.col("toxic").alias("truth")).where("doc_id % 3 = 0"), "doc_id").collect()
    bad, good = ([r["toxic"] for r in rows if r["truth"] == t] for t in (1, 0))
    assert np.mean(bad) >= 0.85 and np.mean(good) <= 0.01, (np.mean(bad), np.mean(good))


def test_toxicity_chain_uses_earlier_categories_and_odd_rows(spark):
    words = [np.array([i % 50, 100 + (i % 2)], np.int32) for i in range(400)]
    y = {"a": np.array([float(i % 2) for i in range(400)]), "b": np.array([float(i % 2) for i in range(400)])}
    y["a"][:20] = np.nan
    chain = toxicity.Chain(["a", "b"]).fit(words, y)
    assert len(chain.models[1].dense) == 1 and chain.models[1].dense[0] > 0
    spark = prepare(spark)
    docs = spark.createDataFrame([(1, "nice words"), (2, None), (None, "idiot"), (1, "nice words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, none, ["toxic"]).collect()
    assert len(out) == 4 and not any(r["toxic"] for r in out) and all(r["p_toxic"] == 0.5 for r in out)
    assert toxicity.score(docs.limit(0), chain).count() == 0


def test_toxicity_ties_repeats_long_texts_and_names(spark):
    spark = prepare(spark)
    names = ["__id", "__body", "p_toxic", "toxic"]
    bad, good = "you idiot fool moron", "kind warm words here"
    rows = [(i, bad if i % 2 else good, *names) for i in range(40)] + [(50, " ".join([good] * 200_000), *names), (51, "", *names)]
    rows += [(1, good, *names), (1, bad, *names)]  # an id with two texts
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (3, None)], "doc_id long, toxic int")
    samples = [sorted((r["__id"], r["toxic"], sorted(r["words"])) for r in toxicity.training_sample(d, k, ["toxic"]).collect())
               for d, k in ((docs, labels), (docs.repartition(7), labels.orderBy(F.desc("toxic")).repartition(3)))]
    assert samples[0] == samples[1] and len(samples[0]) == 40 and {y for i, y, _ in samples[0] if i in (1, 3)} == {1.0}
    chain = toxicity.train(docs, labels, ["toxic"])
    got = {r["doc_id"]: r["p_toxic"] for r in toxicity.score(docs, chain).where("doc_id > 1").collect()}
    assert len(got) == 40 and got[3] > 0.5 > got[50] and abs(got[50] - got[2]) < 1e-6
    tied = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, chain, threshold=got[3]).collect()}
    assert tied[3] and tied[5] and not tied[2]


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline
    spark = prepare(spark)
    names = ["__doc", "__text", "__lang", "__batch", "node", "row"]
    texts = [None, "", "One good line of some words.\nAnother good line of words.", "One good line of some words.\nAnother good line of words.",
             "word " * 30_000, "Something else that nobody wrote before, in one line."]
    docs = spark.createDataFrame([(i, t, "en", *names) for i, t in enumerate(texts)] + [(None, None, None, *names)],
                                 ", ".join(["doc_id long", "text string", "lang string", *(f"{n} string" for n in names)]))
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int")
    for name, rows in (("some", docs), ("none", docs.limit(0))):
        rows.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    after = spark.read.parquet(str(tmp_path / "some" / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, after, str(tmp_path / "some")).cache()
        assert after.columns == docs.columns, name
    kept = {r["doc_id"] for r in after.collect()}
    assert 5 in kept and len(kept & {2, 3}) == 1
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    spark = prepare(spark)
    docs, columns = table(spark, SF, "documents"), table(spark, SF, "documents").columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.columns == columns and 0 < after.count() <= docs.count(), name
        docs = after
    pieces = corpus_pipeline.pack(spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}
    unpack(pieces, packing.CAPACITY)
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(pieces)
