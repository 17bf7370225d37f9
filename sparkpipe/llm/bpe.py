"""Byte-level BPE by backtracking over longest token matches, decoding by an offset table.

An Aho-Corasick automaton over the vocabulary finds the tokens that start at each byte.
The encoder takes the longest, and keeps it only if BPE would leave it beside the token
before (the pair-compatibility test); otherwise it tries the next shorter token, or goes
back one.  Each position is given up at most once, so time is linear and the result is
exactly what the merges give.
"""

from __future__ import annotations

import hashlib
import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, worker_memo

#: White space as the tokenizer's pattern knows it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the pattern that cuts text before byte-level merges.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
          rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Entries that a worker's memos of pieces and of token pairs hold before they start anew.
MEMO = 400_000
#: Ids that are decoded at once.
DECODE_IDS = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class _Memo(dict):
    def __init__(self, make, most=MEMO):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class BytePairCoder:
    """Encodes and decodes with a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        raw = {c: bytes([b]) for b, c in enumerate(letters)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        # a token's rank: its byte, or 256 + the place of the merge that makes it
        rank = {c: b for b, c in enumerate(letters)}
        self.split = [(b, b) for b in range(256)]
        for i, (a, b) in enumerate(merges):
            rank[a + b] = 256 + i
            self.split.append((rank[a], rank[b]))
        self.merged = {pair: 256 + i for i, pair in enumerate(self.split[256:])}
        names = sorted(rank, key=rank.get)
        words = [b"".join(raw[c] for c in name) for name in names]
        self.size = [len(w) for w in words]
        at = {w: r for r, w in enumerate(words)}
        self.shorter = [next((at[w[:n]] for n in range(len(w) - 1, 0, -1) if w[:n] in at), -1) for w in words]
        self.automaton = ahocorasick.Automaton()
        for r, w in enumerate(words):
            self.automaton.add_word(w.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.ids = [vocab[name] for name in names]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._offsets(dict(zip(self.ids, words, strict=True))
                      | {i: s.encode() for s, i in self.special.items()})
        self.pattern = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.pairs = _Memo(lambda pair: self._compatible(*pair))
        self.pieces = _Memo(lambda piece: np.array(
            [self.ids[r] for r in self.ranks(piece.encode())], "<u4").tobytes())

    def _offsets(self, words: dict[int, bytes]) -> None:
        sizes = np.zeros(max(words) + 2, np.int64)
        for i, w in words.items():
            sizes[i + 1] = len(w)
        self.offset = np.cumsum(sizes)
        self.blob = np.frombuffer(b"".join(words.get(i, b"") for i in range(len(sizes) - 1)), np.uint8)

    def _compatible(self, left: int, right: int) -> bool:
        """Would BPE leave these two tokens side by side?

        Undo the later merge of the two at a time; if the inner parts could have merged
        before that merge happened, they would have.
        """
        limit = 1 << 60
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, inner = left, self.split[left][1]
                if inner != left:
                    left = inner
                    continue
                limit, inner = right + 1, self.split[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                limit, inner = right + 1, self.split[right][0]
                if inner != right:
                    right = inner
                    continue
                limit, inner = left, self.split[left][1]
                if inner == left:
                    return True
                left = inner

    def ranks(self, piece: bytes) -> list[int]:
        """Ranks of the tokens of one piece."""
        n = len(piece)
        longest, size = [-1] * n, self.size
        for end, r in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - size[r]
            if longest[start] < 0 or size[r] > size[longest[start]]:
                longest[start] = r
        out, pos, alive, pairs, token = [], 0, bytearray(b"\1") * (n + 1), self.pairs, -1
        while pos < n:
            if token < 0:
                token = longest[pos]
            end = pos + size[token]
            if alive[end] and (not out or pairs[out[-1], token]):
                out.append(token)
                pos, token = end, -1
                continue
            token = self.shorter[token]
            if token < 0:  # nothing that starts here fits: give the place up, shorten the one before
                alive[pos] = 0
                token = out.pop()
                pos -= size[token]
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        get = self.pieces.__getitem__
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(get, self.pattern.findall(text)))
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out.extend(map(get, self.pattern.findall(part)))
        return b"".join(out)

    def decode_bytes(self, ids: bytes) -> bytes:
        out, every = [], np.frombuffer(ids, "<u4")
        for i in range(0, len(every), DECODE_IDS):
            part = every[i:i + DECODE_IDS].astype(np.int64)
            start, size = self.offset[part], self.offset[part + 1] - self.offset[part]
            ends = np.cumsum(size)
            out.append(self.blob[np.repeat(start - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _coder(path: str) -> BytePairCoder:
    return worker_memo("bpe", "coder", lambda: BytePairCoder(path), path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, token_ids (array of int).

    Null text is empty and has no tokens; a special token's string in a text is that token.
    Rows are independent: repeated rows and null ids stay as they are, other columns play
    no part, an empty table gives an empty result.
    """
    def run(batches):
        coder = _coder(path)
        for batch in batches:
            found = [np.frombuffer(coder.encode(t), "<u4").astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], [id_col, "token_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("body"))
    return rows.mapInArrow(run, f"{id_col} long, token_ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Per row: id, text decoded from the ids (special tokens kept); null ids decode to ''."""
    def run(batches):
        coder = _coder(path)
        for batch in batches:
            found = [coder.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [id_col, "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias(id_col), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"{id_col} long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, and SHA-256 of the ids and of the text decoded from them.

    Encodes and decodes in one pass, so token ids need not travel; cases as in ``encode``.
    """
    def run(batches):
        coder = _coder(path)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = coder.encode(text)
                back = coder.decode(ids).encode("utf-8")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("body"))
    return rows.mapInArrow(run, f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string")
