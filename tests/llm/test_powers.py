"""Power-of-two packing: every id once, lengths, numbers, batches, folders."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkpipe.llm import powers
from sparkpipe.llm.common import prepare, table
from sparkpipe.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, bucket string, start string"


def frame(spark, rows):
    return prepare(spark).createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def want(text):
    return [*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, powers.END_ID]


def test_binary_pieces():
    sizes = np.array([1, 2, 7, 8, 9, 16, 23])
    doc, start, level = powers.binary_pieces(sizes, 8)
    assert [(d, s, 1 << e) for d, s, e in zip(doc.tolist(), start.tolist(), level.tolist(), strict=True)] == [
        (0, 0, 1), (1, 0, 2), (2, 0, 4), (2, 4, 2), (2, 6, 1), (3, 0, 8), (4, 0, 8), (4, 8, 1), (5, 0, 8), (5, 8, 8),
        (6, 0, 8), (6, 8, 8), (6, 16, 4), (6, 20, 2), (6, 22, 1)]


@pytest.mark.parametrize("capacity", [1, 64, 4096])
def test_pieces_hold_every_id_once(spark, capacity):
    rows = [(1, "One small text."), (2, None), (3, ""), (4, " \n "), (5, "word " * 9000), (6, "twice here"), (6, "twice here"),
            (None, "no id"), (8, "中文 é 🙂, done!")]
    out = powers.power_sequences(frame(spark, rows), WORDS, capacity).collect()
    assert len({r["sequence_id"] for r in out}) == len(out)
    got = {}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] == 1 << r["bucket"] <= capacity and r["offset"] == 0
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
    for i, text in rows:
        ids = want(text)
        found = sorted(got[(i, len(ids))])
        copies = sum(r == (i, text) for r in rows)
        for k in range(copies):
            mine = found[k::copies]
            assert [s for s, _ in mine] == np.cumsum([0, *(len(x) for _, x in mine[:-1])]).tolist()
            assert [x for _, part in mine for x in part] == ids
    assert powers.power_sequences(frame(spark, []), WORDS, capacity).count() == 0


def test_batches_and_folders(spark, tmp_path):
    docs = frame(spark, [(i, "some words " * (i % 40)) for i in range(300)])
    sequences = powers.power_sequences(docs, WORDS, 32)
    batches = sequences.groupBy("bucket", powers.batch_id(64).alias("batch")).agg(F.sum("length").alias("n"), F.count_distinct("length").alias("k"))
    found = batches.collect()
    assert all(r["n"] <= 64 and r["k"] == 1 for r in found)
    # only the last batch of a bucket and task is not full
    assert sum(r["n"] < 64 for r in found) <= 6 * sequences.rdd.getNumPartitions()
    powers.write_buckets(sequences, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == sequences.count()
    with pytest.raises(ValueError):
        powers.power_sequences(docs, WORDS, 100)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in table(prepare(spark), sf, "documents").collect()}
    out = QUERIES["op12_power_packing"](spark, sf).collect()
    assert {r["doc_id"] for r in out} == set(texts)
    for r in out[::97]:
        ids = want(texts[r["doc_id"]])
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert (zlib.crc32(part), len(ids)) == (r["ids_crc32"], r["doc_tokens"])
    assert sum(r["length"] for r in out) == sum(len(want(t)) for t in texts.values())
