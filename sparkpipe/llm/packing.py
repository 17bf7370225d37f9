"""Packing of token sequences: dominance reduction, then best fit.

An instance of bin packing is its histogram: how many pieces there are of each length from
1 to the capacity.  That summary is bounded by the capacity whatever the size of the corpus,
so the plan is made from it at once: lengths whose best partners are provably as good as any
alternative are fixed (Martello-Toth dominance), the rest goes by best fit decreasing, both
on whole length classes with multiplicities.  The plan is a list of runs: "pieces number
a .. b of length L open sequences s .. t at offset o".  Pieces are then numbered within their
length class (salted windows and prefix sums, so no class meets in one task) and look up
their run.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_of, worker_memo

#: Fixed value: the id that ends each document.
END_ID = 1
CAPACITY = 4096
#: Distinct stretches whose ids a worker keeps before it starts anew.
MEMO = 1_000_000
#: Bytes of text that are looked up together, about.
PART_BYTES = 4 << 20
#: New words that are encoded as one text.
TOGETHER = 500
#: Pieces of one length that are numbered in one window group.
NUMBERED = 2_000


# -- the plan ---------------------------------------------------------------------------

def _fixed(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Martello-Toth reduction: patterns with multiplicities, taken out of ``counts``.

    For the longest piece left, one of these sets dominates every set that holds it: the
    piece alone, if nothing fits; with the largest partner, if that fills the sequence or if
    no two others fit; with the two largest partners, if no three others fit and no pair of
    others beats the smaller of them.  A piece without such a set is left to best fit.
    """
    fixed, sizes = [], sorted(counts)

    def around(own: int) -> tuple[list[int], list[int]]:
        """The three smallest pieces besides one of length ``own``; sizes that remain."""
        small = []
        for s in sizes:
            small += [s] * min(3, counts[s] - (s == own))
            if len(small) >= 3:
                break
        return small[:3], sizes

    def largest(most: int, own: list[int]) -> int:
        """Longest piece of at most ``most`` besides those in ``own``; 0 if there is none."""
        i = bisect.bisect_right(sizes, most) - 1
        while i >= 0 and counts[sizes[i]] <= own.count(sizes[i]):
            i -= 1
        return sizes[i] if i >= 0 else 0

    def take(pattern: tuple[int, ...]) -> None:
        m = min(counts[s] // k for s, k in Counter(pattern).items())
        fixed.append((pattern, m))
        for s in pattern:
            counts[s] -= m
        for s in set(pattern):
            if not counts[s]:
                del counts[s]
                sizes.remove(s)

    long = capacity
    while sizes and (i := bisect.bisect_right(sizes, long)):
        piece = sizes[i - 1]
        free = capacity - piece
        small, _ = around(piece)
        if not small or small[0] > free:
            take((piece,))
            continue
        partner = largest(free, [piece])
        if partner == free or len(small) < 2 or small[0] + small[1] > free:
            take((piece, partner))
            continue
        if len(small) < 3 or sum(small) > free:
            second = largest(free - partner, [piece, partner])
            above = []
            for s in sizes[bisect.bisect_right(sizes, second):]:
                above += [s] * min(2, counts[s] - (s == piece))
                if len(above) >= 2:
                    break
            if second and (len(above) < 2 or above[0] + above[1] > free):
                take((piece, partner, second))
                continue
        long = piece - 1
    return fixed


def _best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit decreasing over length classes: ((length, pieces), ...) patterns, how often."""
    free: dict[int, list] = {}
    spaces: list[int] = []

    def put(space: int, pattern: tuple, times: int) -> None:
        if space not in free:
            free[space] = []
            bisect.insort(spaces, space)
        free[space].append((pattern, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect.bisect_left(spaces, size)
            if i < len(spaces):
                space = spaces[i]
                pattern, times = free[space].pop()
                if not free[space]:
                    del free[space], spaces[i]
                each = min(space // size, left)
                m = min(times, left // each)
                if m < times:
                    put(space, pattern, times - m)
            else:
                space, pattern = capacity, ()
                each = min(capacity // size, left)
                m = left // each
            put(space - each * size, (*pattern, (size, each)), m)
            left -= m * each
    return [x for group in free.values() for x in group]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list], int]:
    """Runs by length and the number of sequences.

    A run is (first piece, pieces a sequence, first sequence, offset): piece number ``k`` of
    the length lies in sequence ``first_sequence + (k - first) // each``.
    """
    counts = Counter({s: n for s, n in histogram.items() if n})
    patterns = [(tuple(Counter(p).items()), m) for p, m in _fixed(counts, capacity)] + _best_fit(counts, capacity)
    runs: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, m in patterns:
        offset = 0
        for size, each in pattern:
            runs.setdefault(size, []).append((used[size], each, sequence, offset))
            used[size] += m * each
            offset += size * each
        sequence += m
    return runs, sequence


# -- tokens -----------------------------------------------------------------------------

class _WordIds:
    """Ids of a stretch of text without blanks, as little-endian 32-bit bytes.

    Blanks separate words for this tokenizer, so encoding the stretches one by one gives
    the ids of the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        # a run of marks is a token of its own; "'" may begin a word, "<" an added token, and other marks may join the letter before
        self.plain = regex.compile(r"^(?:(\p{L}+)([!-&(-/:;=-@\[-`{-~]*)|.*)$", regex.MULTILINE)
        self.marks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        # words that end in a mark once they are in lower case or composed, so that marks behind them join it
        self.joins_marks: set[str] = set()

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _ends(self, ids: bytes) -> int:
        return np.count_nonzero(self.ends_word[np.frombuffer(ids, "<u4")])

    def _learn_words(self, words: list[str]) -> list[str]:
        """Learn words of letters from one text of them all.

        The last token of a word is marked as such; if the marks don't tell the words apart
        one by one, the words are given back.
        """
        body = self._encode([" ".join(words)])[0]
        ends = np.flatnonzero(self.ends_word[np.frombuffer(body, "<u4")]) + 1
        if len(ends) != len(words):
            return words
        start = 0
        for word, end in zip(words, (ends * 4).tolist(), strict=True):
            self.known[word] = body[start:end]
            start = end
        return []

    def learn(self, stretches: set[str]) -> None:
        if len(self.known) > MEMO:
            self.known.clear()
            self.marks.clear()
            self.joins_marks.clear()
        new = list(stretches.difference(self.known))
        marked, letters, rest = [], set(), []
        # a stretch has no line break, so each is a line
        for s, (word, marks) in zip(new, self.plain.findall("\n".join(new)) if new else (), strict=True):
            if not word:
                rest.append(s)
                continue
            if marks:
                marked.append((s, word, marks))
            letters.add(word)
        words = list(letters.difference(self.known))
        for i in range(0, len(words), TOGETHER):
            rest += self._learn_words(words[i:i + TOGETHER])
        for s, ids in zip(rest, self._encode(rest), strict=True):
            self.known[s] = ids
        self.joins_marks.update(s for s in rest if s in letters and self._ends(self.known[s]) != 1)
        apart = [s for s, word, _ in marked if word in self.joins_marks]
        for s, ids in zip(apart, self._encode(apart), strict=True):
            self.known[s] = ids
        for s, word, marks in marked:
            if word in self.joins_marks:
                continue
            if marks not in self.marks:
                self.marks[marks] = self._encode([marks])[0]
            self.known[s] = self.known[word] + self.marks[marks]

    def bodies(self, texts: pa.Array, end: bytes) -> tuple[memoryview, list[int]]:
        """The ids of all texts one after another, ``end`` after each, and the bytes where texts begin and the last ends.

        Each different stretch is looked up once; its ids are then copied to its places.
        """
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        found = split.flatten().dictionary_encode()
        stretches = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(set(stretches))
        blobs = [*map(self.known.__getitem__, stretches), end]
        size = np.fromiter(map(len, blobs), np.int64, len(blobs)) >> 2
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
        place = np.insert(found.indices.to_numpy(zero_copy_only=False), ends, len(stretches))
        bounds = np.append(0, np.cumsum(size[place]))
        shift = (np.cumsum(size) - size)[place] - bounds[:-1]
        every = np.frombuffer(b"".join(blobs), "<u4")
        ids = every[np.repeat(shift, size[place]) + np.arange(bounds[-1])]
        starts = np.append(0, ends + np.arange(1, len(ends) + 1))
        return memoryview(ids.tobytes()), (bounds[starts] * 4).tolist()


def _parts(texts: pa.Array):
    """Slices of whole texts of about PART_BYTES together."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield texts.slice(a, b - a)


def _together(batches):
    """Batches joined up to about PART_BYTES of text in column 1; a larger one comes alone."""
    held, size = [], 0
    for batch in batches:
        more = batch.column(1).nbytes
        if held and size + more > PART_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.concat_batches(held)


def _pieces_of(path: str, capacity: int, end_id: int):
    import os
    end = np.array([end_id], "<u4").tobytes()
    step = capacity * 4

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = worker_memo("packing", "words", lambda: _WordIds(path), path)
        for batch in _together(batches):
            out, docs, first = [], batch.column(0).to_pylist(), 0
            for texts in _parts(batch.column(1)):
                body, bounds = ids.bodies(texts, end)
                for doc, a, b in zip(docs[first:first + len(texts)], bounds[:-1], bounds[1:], strict=True):
                    for k, at in enumerate(range(a, b, step)):
                        part = body[at:min(at + step, b)]
                        out.append((doc, k, (at - a) // 4, len(part) // 4, zlib.crc32(part)))
                first += len(texts)
            columns = zip(*out, strict=True) if out else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and ``end_id``, cut at ``capacity``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("body"))
    return rows.mapInArrow(_pieces_of(path, capacity, end_id),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


# -- placing ----------------------------------------------------------------------------

def numbered(pieces: DataFrame, histogram: dict[int, int], group: int = NUMBERED) -> DataFrame:
    """Add ``rank``: the number of a piece among those of its length, from 0.

    A length class is salted into groups of about ``group`` rows; a window numbers the rows
    of a group, and the counts of the groups before it are added.
    """
    spark = pieces.sparkSession
    salts = spark.createDataFrame([(s, 1 + n // group) for s, n in histogram.items()], "length long, salts int")
    salted = pieces.join(F.broadcast(salts), "length").withColumn(  # at most one row per token count
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts")))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("n"))
    in_group = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("in_group", F.row_number().over(in_group) - 1)
            .join(before, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("in_group"))
            .drop("salts", "salt", "before", "in_group"))


def place(ranked: DataFrame, runs: dict[int, list]) -> DataFrame:
    """Add sequence_id and offset: each piece looks up its run.  The runs are bounded by the capacity."""
    tables = {s: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for s, r in runs.items()}

    def run(batches):
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                rows = np.flatnonzero(size == s)
                first, each, start, offset = tables[int(s)]
                i = np.searchsorted(first, rank[rows], "right") - 1
                k = rank[rows] - first[i]
                seq[rows], off[rows] = start[i] + k // each[i], offset[i] + k % each[i] * s
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = NUMBERED) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences: sequence_id, offset.

    Repeated rows are pieces of their own; null ids are kept; an empty table gives an empty
    result.  Lengths lie between 1 and ``capacity``.
    """
    kept = materialise(pieces, "pieces")
    histogram = {r["length"]: r["count"] for r in kept.groupBy("length").count().toLocalIterator()}
    runs, _ = plan(histogram, capacity)
    return place(numbered(kept, histogram, group), runs)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise documents and pack them: one row per piece.

    Null or empty text is one piece of the end id alone; only documents longer than
    ``capacity`` are cut; other columns play no part.
    """
    return pack(token_pieces(docs, path, capacity, end_id, id_col, text_col), capacity)
