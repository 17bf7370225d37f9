"""Ids by stretches: each word is encoded once, whatever marks follow and however texts are cut up."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from sparkpipe.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    asked = []
    encode = packing._WordIds._encode

    def noted(self, texts):
        asked.extend(w for t in texts for w in t.split(" "))
        return encode(self, texts)

    monkeypatch.setattr(packing._WordIds, "_encode", noted)
    ids = packing._WordIds(WORDS)
    for stretches in ({"fox", "fox,", "fox.", "hen!"}, {"hen", "fox;", "hen?", "fox"}):
        ids.learn(stretches)
    assert asked.count("fox") == asked.count("hen") == 1
    assert not [w for w in asked if w[:3] in ("fox", "hen") and len(w) > 3]


def test_ids_equal_the_library(monkeypatch):
    texts = ["", " ", "\n\n", "The fox, the hen; the fox! The\nfox.", "  two  blanks ", "it's we'll don't 12 1,2 a-b x.y", "é É ß İ ﬁ 中文字 🙂👍🏽",
             "é   \t tab wide", "<|endoftext|> a<|endoftext|>b", "fox " * 900, "...", "a", "'s 't", "fox,,, fox.;! ###fox fox### $$$"] * 3
    library = Tokenizer.from_file(WORDS)
    end = np.array([1], "<u4").tobytes()
    for size in (packing.PART_BYTES, 40, 1):
        monkeypatch.setattr(packing, "PART_BYTES", size)
        ids, found = packing._WordIds(WORDS), []
        for part in packing._parts(pa.array(["out", *texts]).slice(1)):
            body, bounds = ids.bodies(part, end)
            assert bounds[0] == 0 and bounds[-1] == len(body)
            found += [np.frombuffer(body[a:b], "<u4").tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert found == [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert not [*packing._parts(pa.array([], pa.string()))]


def test_any_plain_marks_may_follow_a_word(monkeypatch):
    asked = []
    encode = packing._WordIds._encode

    def noted(self, texts):
        asked.extend(texts)
        return encode(self, texts)

    monkeypatch.setattr(packing._WordIds, "_encode", noted)
    ids = packing._WordIds(WORDS)
    ids.learn({"fox$$$", "fox,%%%", "fox***", "fox", "&&&", "12"})
    assert [w for t in asked for w in t.split(" ")].count("fox") == 1
    assert not [t for t in asked if "fox" in t and t != "fox"]

    library, end = Tokenizer.from_file(WORDS), np.array([1], "<u4").tobytes()
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{w}{m}" for w in ("fox", "É", "we", "\u0130", "\u0958", "a\ufb2a") for m in [*marks, *(a + b for a in marks for b in "'<>$.s1\u0301\r\x0b")]]
    texts += ["e\u0301$ e\u0301\u0301,", "fox=\u0338 fox>\u0338", "fox<|endoftext|>", "fox$\r\rhen$", "a\u2028b,$", ""]
    body, bounds = ids.bodies(pa.array(texts), end)
    found = [np.frombuffer(body[a:b], "<u4").tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_small_batches_are_looked_up_together(monkeypatch):
    rows = [pa.RecordBatch.from_pydict({"id": [i], "text": ["x" * n]}) for i, n in enumerate((3, 4, 0, 900, 2, 2, 5))]
    monkeypatch.setattr(packing, "PART_BYTES", 60)
    found = [b.column(0).to_pylist() for b in packing._together(iter(rows))]
    assert sum(found, []) == list(range(7))
    assert [3] in found and len(found) < 7
    assert not [*packing._together(iter([]))]
