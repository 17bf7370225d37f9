"""Exact deduplication with owners in Patricia tries.

Texts are equal when their bytes agree after white space is deleted.  Rows are dealt to
partitions by length and content hash; each partition inserts the whole byte strings into a
radix trie whose terminal nodes keep the best owner.  Every map task first joins its own
copies in such a trie, so a text that a third of all rows share crosses the network once
per map task, not once per row.  A trie over its memory bound gives up its heaviest subtree:
those strings go to a further, finer round of partitions.  Owners then join the documents
by content hash; AQE splits a hot hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, materialise, ordered_id, real_id, text_of
from .radix import RadixTrie

WHITE = r"[\x20\x09-\x0D]+"
_WHITE_BYTES = b" \t\n\x0b\x0c\r"
#: Bytes that a task's trie may hold before it passes rows on or gives up a subtree.
TRIE_BYTES = 64 << 20
#: Bytes of texts that a batch of rows holds, besides its last text.
BATCH_BYTES = 4 << 20
_SCHEMA = "len long, sha binary, body binary, cp long, id long, n long, open boolean"


def _batches(rows: Iterable, size: int = 2000):
    """Record batches of at most ``size`` rows that end once they hold BATCH_BYTES."""
    names = ("len", "sha", "body", "cp", "id", "n", "open")
    types = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    some, held = [], 0

    def batch():
        columns = zip(*some, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for row in rows:
        some.append(row)
        held += len(row[2] or b"")
        if len(some) >= size or held >= BATCH_BYTES:
            yield batch()
            some, held = [], 0
    if some:
        yield batch()


def _rows(batch: pa.RecordBatch):
    return zip(*(batch.column(c).to_pylist() for c in ("body", "cp", "id", "n")), strict=True)


def _sha(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def _opened(found):
    """Open rows of a trie's (string, owner)."""
    return ((len(k), _sha(k), k, *owner, True) for k, owner in found)


def _digests(batches):
    """Of each row the hash and the length of its text without white space."""
    for batch in batches:
        bodies = [text.translate(None, _WHITE_BYTES) for text in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(map(_sha, bodies), pa.binary()), pa.array(map(len, bodies), pa.int64()),
             batch.column("cp")], ["id", "sha", "len", "cp"])


def _combine(bound: int):
    """Map side: equal texts of the task become one open row."""
    def run(batches):
        trie = RadixTrie()
        for batch in batches:
            for text, *owner in _rows(batch):
                trie.insert(text.translate(None, _WHITE_BYTES), tuple(owner))
                if trie.held > bound:
                    yield from _batches(_opened(trie.items()))
                    trie = RadixTrie()
        yield from _batches(_opened(trie.items()))
    return run


def _own(bound: int):
    """Reduce side: a closed row for each text, open rows for what was given up."""
    def run(batches):
        trie = RadixTrie()

        def passed(batch):
            for body, *owner in _rows(batch):
                if not trie.insert(body, tuple(owner)):
                    yield len(body), _sha(body), body, *owner, True
                while trie.held > bound and trie.strings > 1:
                    before = trie.strings
                    yield from _opened(trie.evict())
                    if trie.strings == before:
                        break

        for batch in batches:
            yield from _batches(passed(batch))
        yield from _batches((len(k), _sha(k), None, *owner, False) for k, owner in trie.items())
    return run


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per different text: sha (32 bytes), len, keep_cp, keep_id, group_size."""
    rows = docs.select(
        text_of(text_col).cast("binary").alias("body"),
        F.char_length(text_of(text_col)).cast("long").alias("cp"),
        ordered_id(id_col).alias("id"), F.lit(1).cast("long").alias("n"))
    parts = rows.mapInArrow(_combine(trie_bytes), _SCHEMA)
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    closed = None
    while True:
        dealt = parts.repartition(n_parts, "len", "sha")
        # closed rows are small: a few files, not one for each partition
        out = materialise(dealt.mapInArrow(_own(trie_bytes), _SCHEMA).hint("rebalance", "sha"), "exact-owners")
        done = out.where(~F.col("open")).select(
            "sha", "len", F.col("cp").alias("keep_cp"), F.col("id").alias("keep_id"),
            F.col("n").alias("group_size"))
        closed = done if closed is None else closed.unionByName(done)
        parts, n_parts = out.where("open"), n_parts * 4
        if parts.isEmpty():
            return closed


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, n_chars.

    Null text is empty; all empty or blank texts are one group.  Of a group the text with
    the most code points stays, then the smallest id; a null id comes last.  Rows repeated
    with one id and one length all carry ``kept``: they are the same document.  Other
    columns play no part, whatever their names.  An empty table gives an empty result.
    """
    keys = docs.select(
        ordered_id(id_col).alias("id"), text_of(text_col).cast("binary").alias("body"),
        F.char_length(text_of(text_col)).cast("long").alias("cp")).mapInArrow(
            _digests, "id long, sha binary, len long, cp long")
    won = owners(docs, id_col, text_col, trie_bytes)
    return keys.join(won, ["sha", "len"]).select(
        real_id("id").alias(id_col), real_id("keep_id").alias("keep_id"), "group_size",
        ((F.col("id") == F.col("keep_id")) & (F.col("cp") == F.col("keep_cp"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), F.col("cp").alias("n_chars"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    body = F.regexp_replace(text_of(text_col), WHITE, "")
    won = owners(docs, **options).select(
        F.col("sha").alias("__sha"), F.col("len").alias("__len"),
        F.col("keep_cp").alias("__cp"), F.col("keep_id").alias("__id"))
    keep = ((F.unhex(F.sha2(body, 256)) == F.col("__sha"))
            & (F.octet_length(body).cast("long") == F.col("__len"))
            & (F.char_length(text_of(text_col)) == F.col("__cp"))
            & (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col("__id")))
    return docs.join(won, keep, "left_semi")
