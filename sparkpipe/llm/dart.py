"""Near-duplicates by DartMinHash signatures and banded joins.

The elements of a document are its shingles of five words.  Every element owns a random
process of darts over its weight and a rank; darts are hashed, so equal elements throw equal
darts in every document.  A document keeps the darts below its own weights and, on each
coordinate, the one of least rank.  Two documents agree on a coordinate with the probability
of their weighted Jaccard similarity.  The work is the number of elements plus the number
of darts, not elements times coordinates.

Exact copies are joined first and one of each takes part.  Documents that agree on a band
meet in a bucket.  No bucket lists its pairs: all its members are compared with its leader
(the one that meets most other documents), and only members that this leaves in different
classes are compared with one another, where the triangle inequality of the Jaccard distance
to the leader and the shingles that no other of them has allow it; both bounds are exact.
Every comparison counts shingles exactly; classes are the connected components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, free_name, key_id, materialise, text_of, worker_memo
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 6
MEMO = 500_000
#: Ranks below 2^LOWEST are one cell; each further cell doubles the rank.
LOWEST = -6
_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingles(words: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles, ascending, and how often each occurs; a shorter text is one shingle."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    memo = worker_memo("dart", "words", _WordHash)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mix(out * _C + h[k:k + n])
    return np.unique(out, return_counts=True)


class Darts:
    """Signatures of ``k`` coordinates."""

    def __init__(self, k: int):
        self.k, self.t = k, k * math.log(k) + 2 * k
        self.tables: dict[int, np.ndarray] = {}

    def _counts(self, level: float, u: np.ndarray) -> np.ndarray:
        """Poisson numbers of mean ``level`` for uniform ``u``."""
        if level not in self.tables:
            top = int(level + 12 * math.sqrt(level) + 20)
            logs = np.arange(top) * math.log(level) - level - np.array([math.lgamma(i + 1) for i in range(top)])
            self.tables[level] = np.cumsum(np.exp(logs))
        return np.searchsorted(self.tables[level], u, "right")

    def sign(self, elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each coordinate the dart (64 bits) of least rank."""
        reach = self.t / weights.sum()
        while True:
            darts, ranks = self._throw(elements, weights, reach)
            order = np.argsort(ranks, kind="stable")
            at, first = np.unique(darts[order] % np.uint64(self.k), return_index=True)
            if len(at) == self.k:
                return darts[order][first]
            reach *= 2  # a coordinate is empty: throw further

    def _throw(self, elements, weights, reach):
        darts, ranks = [], []
        top = max(LOWEST, math.ceil(math.log2(reach)))
        heavy = weights.max()
        low, width, cell = 0.0, 1.0, 0
        while low < heavy:  # weight regions [0, 1), [1, 2), [2, 4), ...
            inside = elements[weights > low]
            inside_w = weights[weights > low]
            for level in range(LOWEST, top + 1):  # rank regions below and above 2^LOWEST
                base, height = (0.0, 2.0**LOWEST) if level == LOWEST else (2.0**(level - 1), 2.0**(level - 1))
                if base >= reach:
                    break
                seed = _mix(inside + np.uint64((cell * 256 + level - LOWEST + 1) * 0x632BE59BD9B4E019 & (2**64 - 1)))
                n = self._counts(width * height, _unit(seed))
                at = np.flatnonzero(n)
                if not len(at):
                    continue
                n = n[at]
                number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                dart = _mix(np.repeat(seed[at], n) + (number + 1).astype(np.uint64) * _C)
                rank = base + height * _unit(_mix(dart + _A))
                keep = rank < reach
                if low or heavy < 1 or inside_w.min() < low + width:
                    keep &= low + width * _unit(_mix(dart + _B)) < np.repeat(inside_w[at], n)
                darts.append(dart[keep])
                ranks.append(rank[keep])
            low, width, cell = low + width, max(width, low + width), cell + 1
        return np.concatenate(darts) if darts else np.zeros(0, np.uint64), np.concatenate(ranks) if ranks else np.zeros(0)


def _weights(counts: np.ndarray, weighted: bool) -> np.ndarray:
    return counts.astype(np.float64) if weighted else np.ones(len(counts))


def _sign(size, bands, rows, weighted):
    def run(batches):
        darts = worker_memo("dart", "darts", lambda: Darts(bands * rows), bands * rows)
        for batch in batches:
            e1, e2, keys = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                both = np.frombuffer(xxhash.xxh3_128_digest(" ".join(words)), np.int64)
                e1.append(both[0])
                e2.append(both[1])
                if not words:
                    keys.append([])
                    continue
                elements, counts = shingles(words, size)
                s = darts.sign(elements, _weights(counts, weighted)).reshape(bands, rows)
                h = np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    h = _mix(h * _C + s[:, r])
                keys.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(e1, pa.int64()), pa.array(e2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc", "e1", "e2", "bands"])
    return run


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
               bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """doc, e1, e2 (hash of the words), bands (one hash per band; none for a text without words)."""
    return docs.select(doc_key(id_col, text_col).alias("doc"), text_of(text_col).alias("body")) \
        .mapInArrow(_sign(size, bands, rows, weighted), "doc long, e1 long, e2 long, bands array<long>")


def _sets(size, weighted):
    def run(batches):
        for batch in batches:
            both = [shingles(words_of(t), size) for t in batch.column(1).to_pylist()]
            kind = pa.list_(pa.int32())
            counts = pa.array([b[1].astype(np.int32) for b in both], kind) if weighted else pa.nulls(len(both), kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b[0].view(np.int64) for b in both], pa.list_(pa.int64())), counts],
                ["node", "elements", "counts"])
    return run


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two weighted sets with ascending elements."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    hit = a[at] == b
    shared = np.minimum(wa[at[hit]], wb[hit]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _compare(weighted):
    def run(batches):
        for batch in batches:
            x, y, m, n = (batch.column(i) for i in range(2, 6))
            s = []
            for i in range(batch.num_rows):
                a, b = (c[i].values.to_numpy().view(np.uint64) for c in (x, y))
                wa, wb = (c[i].values.to_numpy().astype(np.float64) if weighted else np.ones(len(e))
                          for c, e in ((m, a), (n, b)))
                s.append(similarity(a, wa, b, wb))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())], ["a", "b", "s"])
    return run


def sets_of(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, weighted: bool) -> DataFrame:
    """node, elements, counts (if weighted) of the documents named by ``nodes``; written once."""
    bodies = docs.select(doc_key(id_col, text_col).alias("node"), text_of(text_col).alias("body"))
    # merged at every size: the documents are dealt once, whatever the number of nodes
    sets = bodies.join(nodes.select("node").distinct().hint("merge"), "node", "left_semi") \
        .groupBy("node").agg(F.min("body").alias("body")).mapInArrow(  # rows that share an id may differ
        _sets(size, weighted), "node long, elements array<long>, counts array<int>")
    return materialise(sets, "shingles")


def compare(pairs: DataFrame, sets: DataFrame, weighted: bool) -> DataFrame:
    """a, b, s: the exact similarity of each pair."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"), F.col("counts").alias("ca"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"), F.col("counts").alias("cb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ea", "eb", "ca", "cb") \
        .mapInArrow(_compare(weighted), "a long, b long, s double")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    threshold: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """One row per document: its doc key (see ``doc_key``) and class_key, the smallest key of its class.

    Two texts are of one class if a chain of similar texts joins them.  With ``weighted`` the elements weigh as often as
    they occur, else once.  Null text is empty; texts with equal words (blank ones too) are
    copies of one class; a text shorter than a shingle is one shingle.  Similarity at the
    threshold counts.  Rows that share an id are one document; other columns play no part;
    an empty table gives an empty result.
    """
    signed = materialise(signatures(docs, id_col, text_col, size, bands, rows, weighted), "signatures")
    copies = signed.groupBy("e1", "e2").agg(F.min("doc").alias("rep"))
    owned = signed.join(copies, ["e1", "e2"])
    nodes = owned.where("doc = rep").select(F.col("doc").alias("node"), F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = nodes.groupBy("bucket").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.count("*").alias("size")) \
        .where("x != y").select("bucket", "size")
    members = materialise(nodes.join(shared, "bucket").distinct(), "members")
    # the leader is the member that meets most others: of a family, the text they all derive from
    popular = members.groupBy("node").agg(F.sum("size").alias("met"))
    leaders = members.join(popular, "node").groupBy("bucket").agg(
        F.max(F.struct("met", (-F.col("node")).alias("lead"))).alias("m")).select("bucket", (-F.col("m.lead")).alias("leader"))
    members = materialise(members.join(leaders, "bucket").select("bucket", "node", "leader"), "members")
    sets = sets_of(members, docs, id_col, text_col, size, weighted)
    stars = members.where("node != leader").select(
        F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    compared = materialise(compare(stars, sets, weighted), "compared")
    links = compared.where(F.col("s") >= threshold)
    labels = components(links)

    # what the stars left apart: buckets with members of different classes
    placed = (members.join(compared, (F.least("leader", "node") == F.col("a")) & (F.greatest("leader", "node") == F.col("b")), "left")
              .select("bucket", "node", "leader", F.coalesce(1 - F.col("s"), F.lit(0.0)).alias("far"))
              .join(labels, "node", "left")
              .withColumn("label", F.coalesce("label", "node")))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("bucket")
    reach = 1 - threshold
    apart = placed.join(mixed, "bucket").where("node != leader").withColumn("ring", F.floor(F.col("far") / reach))
    apart = materialise(apart, "apart")
    if not apart.isEmpty():
        # what no other document of these has cannot be shared: ``common`` bounds every overlap
        weights = F.col("counts") if weighted else F.transform("elements", lambda _: F.lit(1))
        parts = sets.join(apart.select("node").distinct(), "node", "left_semi") \
            .select("node", F.explode(F.arrays_zip("elements", weights.alias("w"))).alias("e")) \
            .select("node", F.col("e.elements").alias("element"), F.col("e.w").cast("long").alias("w"))
        alone = parts.groupBy("element").agg(F.min("node").alias("node"), F.max("node").alias("last"), F.max("w").alias("w")) \
            .where("node = last").groupBy("node").agg(F.sum("w").alias("own"))
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c) if weighted else F.size("elements").cast("long")
        bounds = sets.select("node", total.alias("n")).join(alone, "node", "left").select(
            "node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common")) \
            .where(F.col("common") >= F.col("n") * (threshold - 1e-9))
        apart = apart.join(bounds, "node")
        mine = apart.groupBy("node").agg(F.collect_set("bucket").alias("mine"))  # at most one per band
        apart = materialise(apart.join(mine, "node"), "apart")
        home = labels.select(F.col("node").alias("leader"), F.col("label").alias("home"))
        strays = apart.join(home, "leader", "left").where("label != coalesce(home, leader)").select(
            "bucket", F.col("node").alias("x"), F.col("far").alias("fx"), F.col("label").alias("lx"),
            F.col("n").alias("nx"), F.col("common").alias("cx"), F.col("mine").alias("mx"),
            F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)).alias("ring"))
        overlap = (F.col("nx") + F.col("n")) * (threshold / (1 + threshold) - 1e-9)
        # a pair counts in the first of its common buckets: each bucket's bound is a proof by itself
        pairs = strays.join(apart, ["bucket", "ring"]).where(
            (F.array_min(F.array_intersect("mx", "mine")) == F.col("bucket")) &
            (F.col("lx") != F.col("label")) & (F.abs(F.col("fx") - F.col("far")) <= reach + 1e-9)
            & (F.col("cx") >= overlap) & (F.col("common") >= overlap)) \
            .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct() \
            .join(compared.select("a", "b"), ["a", "b"], "left_anti")
        more = compare(materialise(pairs, "pairs"), sets, weighted).where(F.col("s") >= threshold)
        # written, as components reads its links in both directions
        labels = components(materialise(links.unionByName(more), "links"))

    classes = copies.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return signed.select("doc", "e1", "e2").join(classes, ["e1", "e2"]).select("doc", F.coalesce("label", "rep").alias("class_key"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, with all its columns: the one of the smallest id.

    Rows that repeat that document's id all stay, as they are one document.  The columns may
    have any names.
    """
    key = free_name(docs, "__doc")
    kept = near_duplicates(docs, id_col, text_col, **options).where("doc = class_key") \
        .select(F.col("doc").alias(key)).distinct()
    return docs.join(kept, doc_key(id_col, text_col) == F.col(key), "left_semi")


def class_ids(classes: DataFrame) -> DataFrame:
    """doc_id, class_id, kept of ``near_duplicates``."""
    return classes.select(key_id("doc").alias("doc_id"), key_id("class_key").alias("class_id"),
                          (F.col("doc") == F.col("class_key")).alias("kept"))
