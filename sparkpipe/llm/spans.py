"""Substring deduplication by sliding spans of sentences.

Texts break into sentences at their marks and at line ends.  Only over-long sentences break
further, at commas and semicolons, and what is still too long at words that their own hash
chooses, so that a passage breaks alike wherever it stands.  From each piece the shortest run
of consecutive pieces that holds enough words is hashed, and the shortest at the end of a
text.  The runs are written once.  Counts of the hashes over all documents, combined before
the shuffle, tell which runs repeat and which document has each first; the runs join these
on their hash (AQE splits a hot one).  A piece goes when a repeated run covers it that is
not the first of its kind.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_key, materialise, text_of

#: Words of a run, at least.  A passage of more than 50 words holds whole runs; stock phrases do not.
MANY_WORDS = 20
#: A sentence or clause of more words than LONG_PIECE breaks, at last after about one word in BREAK_WORDS.
LONG_PIECE, BREAK_WORDS = 12, 6
#: Pieces end at their mark and the blanks after it, or at a line's end.
_SENTENCE = re.compile("[.!?…。！？]\\s+|\\s*\n\\s*")
_CLAUSE = re.compile("[,;]\\s+")
_BLANKS = re.compile("(\\s+)")
#: A run's hash has 96 bits.
_SPAN_SCHEMA = "doc long, h1 long, h2 int, again boolean"


def _split(text: str, pattern: re.Pattern, blank: str) -> list[tuple[str, str]]:
    """Parts, each with the blanks after it (the last one with ``blank``); a mark stays with its part."""
    out, at = [], 0
    for m in pattern.finditer(text):
        begin, end = m.span()
        begin += not text[begin].isspace()
        out.append((text[at:begin], text[begin:end]))
        at = end
    out.append((text[at:], blank))
    return out


def _is_long(part: str) -> bool:
    return len(part) > 2 * LONG_PIECE and part.count(" ") >= LONG_PIECE


def _at_hashed_words(part: str, blank: str) -> list[tuple[str, str]]:
    words, out, begin = _BLANKS.split(part), [], 0
    for i in range(0, len(words) - 2, 2):
        if zlib.crc32(words[i].lower().encode("utf-8", "replace")) % BREAK_WORDS == 0:
            out.append(("".join(words[begin:i + 1]), words[i + 1]))
            begin = i + 2
    return [*out, ("".join(words[begin:]), blank)]


def pieces(text: str) -> tuple[list[str], list[str]]:
    """Pieces and the blanks after each; joined in turn they are the text."""
    out = []
    for sentence, blank in _split(text, _SENTENCE, ""):
        if not _is_long(sentence):
            out.append((sentence, blank))
            continue
        for clause, after in _split(sentence, _CLAUSE, blank):
            out += _at_hashed_words(clause, after) if _is_long(clause) else [(clause, after)]
    parts, blanks = zip(*out, strict=True)
    return list(parts), list(blanks)


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.cumprod(x, dtype=np.uint64)


def runs(texts: list[tuple[list[str], list[str]]], many: int = MANY_WORDS):
    """All runs of the texts' pieces: document number, first piece, last piece, h1, h2.

    Blank pieces lie between, not in, runs: a run may reach over them.
    """
    flat = [" ".join(p.lower().split()) for parts, _ in texts for p in parts]
    words = np.array([p.count(" ") + 1 if p else 0 for p in flat], np.int64)
    real = np.flatnonzero(words)
    if not len(real):
        return tuple(np.zeros(0, np.uint64 if i > 2 else np.int64) for i in range(5))
    sizes = np.array([len(parts) for parts, _ in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    doc, place, words = doc[real], place[real], words[real]
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(flat[i]) for i in real]), np.uint64).reshape(-1, 2)

    n, upto = len(doc), np.append(0, np.cumsum(words))
    last = np.flatnonzero(np.append(doc[1:] != doc[:-1], True))
    begin = np.append(np.arange(n), np.searchsorted(upto[:-1], upto[last + 1] - many, "right") - 1)
    end = np.append(np.searchsorted(upto[1:], upto[:-1] + many), last)
    ok = (begin >= 0) & (end < n)
    ok[ok] = doc[begin[ok]] == doc[end[ok]]
    pair = np.unique(begin[ok] * np.int64(n) + end[ok])
    begin, end = pair // n, pair % n
    h = []
    for k, base in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        sums = np.append(np.uint64(0), np.cumsum(both[:, k] * _powers(base, n), dtype=np.uint64))
        h.append((sums[end + 1] - sums[begin]) * _powers(pow(base, -1, 1 << 64), n)[begin])
    return doc[begin], place[begin], place[end], *h


def _emit(many):
    def emit(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            doc, _, _, h1, h2 = runs([pieces(t) for t in batch.column(1).to_pylist()], many)
            order = np.lexsort((h2, h1, doc))
            doc, h1, h2 = doc[order], h1[order], h2[order]
            if not len(doc):
                continue
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            first = np.flatnonzero(new)
            again = np.diff(np.append(first, len(doc))) > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[doc[first]]), pa.array(h1[first].view(np.int64)),
                 pa.array((h2[first] >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(again)], ["doc", "h1", "h2", "again"])
    return emit


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = MANY_WORDS) -> DataFrame:
    """doc, everywhere, later: hashes of the runs that go from a document.

    ``everywhere``: a smaller document has the run first, so all its places go; ``later``:
    this document has it first, and its later places go.
    """
    spans = materialise(docs.select(doc_key(id_col, text_col).alias("doc"), text_of(text_col).alias("body"))
                        .mapInArrow(_emit(many), _SPAN_SCHEMA), "runs")
    counts = (spans.groupBy("h1", "h2")
              .agg(F.min("doc").alias("first"), F.count("*").alias("n"), F.max("again").alias("twice"))
              .where("n > 1 or twice").select("h1", "h2", "first"))
    gone = spans.join(counts, ["h1", "h2"]).where("doc > first or again")
    return gone.groupBy("doc").agg(
        F.collect_list(F.when(F.col("doc") > F.col("first"), F.col("h1"))).alias("everywhere"),
        F.collect_list(F.when(F.col("doc") == F.col("first"), F.col("h1"))).alias("later"))


def _clean(many):
    def covered(texts: list, everywhere: list, later: list) -> list[list[int]]:
        """Pieces that go, of each text; the runs of all texts at once."""
        out: list[list[int]] = [[] for _ in texts]
        some = [i for i in range(len(texts)) if everywhere[i] or later[i]]
        doc, begin, end, h1, _ = runs([texts[i] for i in some], many)
        cuts = np.searchsorted(doc, np.arange(len(some) + 1))
        for k, i in enumerate(some):
            own = slice(cuts[k], cuts[k + 1])
            h, first_piece, last_piece = h1[own].view(np.int64), begin[own], end[own]
            hit = np.isin(h, np.array(everywhere[i] or [], np.int64))
            if later[i]:
                _, first = np.unique(h, return_index=True)
                repeat = np.ones(len(h), bool)
                # of equal runs the one that begins first stays: runs are in order of their beginning
                repeat[first] = False
                hit |= repeat & np.isin(h, np.array(later[i], np.int64))
            gone = np.zeros(len(texts[i][0]) + 1, np.int64)
            np.add.at(gone, first_piece[hit], 1)
            np.add.at(gone, last_piece[hit] + 1, -1)
            out[i] = np.flatnonzero(np.cumsum(gone[:-1]) > 0).tolist()
        return out

    def clean(batches):
        for batch in batches:
            texts, n_all, n_gone, spans = [], [], [], []
            bodies, everywhere, later = (batch.column(i).to_pylist() for i in (0, 1, 2))
            broken = [pieces(text) for text in bodies]
            for text, (parts, blanks), out in zip(bodies, broken, covered(broken, everywhere, later), strict=True):
                n_all.append(sum(bool(p.strip()) for p in parts))
                n_gone.append(len(out))
                dropped, taken, at = [], set(out), 0
                for i, (p, b) in enumerate(zip(parts, blanks, strict=True)):
                    if i in taken:
                        if dropped and dropped[-1][1] == at:
                            dropped[-1][1] = at + len(p) + len(b)
                        else:
                            dropped.append([at, at + len(p) + len(b)])
                    at += len(p) + len(b)
                spans.append(dropped)
                if out:
                    text = "".join(p + b for i, (p, b) in enumerate(zip(parts, blanks, strict=True)) if i not in taken)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), pa.array(texts, pa.string()), pa.array(n_all, pa.int32()), pa.array(n_gone, pa.int32()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["row", "text", "sentences", "removed", "spans"])
    return clean


def _cut(docs: DataFrame, columns: list[str], id_col: str, text_col: str, many: int) -> DataFrame:
    """row (``columns`` in a struct, so that no name clashes), text, sentences, removed, spans."""
    gone = repeated_runs(docs, id_col, text_col, many)
    rows = docs.select(doc_key(id_col, text_col).alias("doc"), text_of(text_col).alias("body"),
                       F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(c, t) for c, t in (
        ("text", T.StringType()), ("sentences", T.IntegerType()), ("removed", T.IntegerType()),
        ("spans", T.ArrayType(T.ArrayType(T.LongType())))))])
    return rows.join(gone, "doc", "left").select("body", "everywhere", "later", "row").mapInArrow(_clean(many), schema)


def substring_dedup(docs: DataFrame, columns: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                    many: int = MANY_WORDS) -> DataFrame:
    """``columns`` of docs (all by default) and __text, __sentences, __removed, __spans.

    __sentences and __removed count pieces that are not blank; __text is the text without its
    repeated runs of at least ``many`` words, __spans lists the [begin, end) code points that
    went.  Null text is empty.  Of equal runs the one of the smallest id stays, in it the
    earliest; rows that share an id (repeated rows) count as one document, and rows without
    an id come last and are told apart by their text.  A text whose runs all repeat becomes
    empty, its row stays.  A text of any length is one row and is held whole by its task.  An
    empty table gives an empty result.  Other columns may have any name but the four.
    """
    columns = docs.columns if columns is None else columns
    return _cut(docs, columns, id_col, text_col, many).select(
        *(F.col(f"row.`{c}`").alias(c) for c in columns),
        *(F.col(c).alias(f"__{c}") for c in ("text", "sentences", "removed", "spans")))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = MANY_WORDS) -> DataFrame:
    """The documents with their repeated runs cut out of the text; same columns, whatever their names."""
    rest = [c for c in docs.columns if c != text_col]
    return _cut(docs, rest, id_col, text_col, many).select(
        *(F.col("text" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns))
