"""Interpolated modified Kneser-Ney over words, counted and scored shard by shard.

Words and marks are hashed to 64 bits; a trigram is counted over all trusted text, lower
orders count the different words before an n-gram.  Count ``n`` is of all trusted documents,
``m`` of those that are not held out; the latter scores the held-out documents.

Texts are split into words once and kept as numbers, some two bytes a word.  All that an
occurrence of ``u v w`` needs but the counts of ``w`` belongs to its middle word: the trigram,
its context, the bigram and the context of that.  So occurrences meet by their middle word,
first the trusted ones to be counted, then all to be scored, and a round deals out a share of
the middle words, which bounds the disk whatever the text.  A middle word too frequent for one
shard is spread over several by the word before; its bigrams are then counted across shards and
sent to each.  Counts of the most frequent words go to all workers; occurrences of others meet
them in a join.  Nothing else of the model comes to the driver but the sums of each order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, lean, materialise, text_of

ORDER = 3
#: Bytes of text and documents of a batch, whose words are numbered together; a document's number has 14 bits.
BATCH_BYTES, BATCH_DOCS = 16_000_000, 1 << 14
#: Occurrences of a round and rounds at most; occurrences of a shard.
ROUND_TOKENS, ROUNDS, SHARD_TOKENS = 8_000_000, 16, 400_000
#: A middle word of more occurrences than this, and than two shards, is spread.
SPREAD_TOKENS = 20_000
#: Frequent words with a two-byte number of their own, and words whose counts go to all workers.
BOOK_WORDS, TOP_WORDS = 65_534, 1 << 19
#: Rounds after which the occurrences of words outside those meet their counts.
SETTLE = 2
#: Stands for what lies before a text.
_START = np.uint64(1)
#: What a document is: scored; trusted; trusted and held out; scored by the model of the others.
SCORED, TRUSTED, HELD, HELD_SCORED = range(4)
_RARE = 0xFFFF
_TOKENS = "batch long, n_tokens long, n_trusted long, words binary, codes binary, sizes binary, kinds binary, keys binary"


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def _different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in order, a place of each, and which of them each key is; quicker than np.unique."""
    # the places stand in the last bits of what is sorted
    last = np.uint64((1 << len(keys).bit_length()) - 1)
    packed = (keys & ~last) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & last).astype(np.int64)
    of = keys[order]
    if (of[1:] < of[:-1]).any():  # keys that differ in those bits only
        order = np.argsort(keys)
        of = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = of[1:] != of[:-1]
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(new) - 1
    return of[new], order[new], at


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words and marks; which of them the texts consist of; how many each text has."""
    spaced = pc.utf8_trim_whitespace(pc.replace_substring_regex(texts, r"([\pP\pS]+)", r" \1 "))
    parts = pc.utf8_split_whitespace(spaced)
    found = parts.flatten().dictionary_encode()
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    names = found.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64)
    at = found.indices.to_numpy(zero_copy_only=False)
    if "" in names:
        real = at != names.index("")
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real], minlength=len(sizes))
        at = at[real]
    return hashes, at, sizes


# ------------------------------------------------------------ texts as numbers
def _width(n: int) -> int:
    """Bytes of a number below ``n``."""
    return max(1, (max(n - 1, 1).bit_length() + 7) // 8)


def _zipped(x: np.ndarray, width: int) -> bytes:
    """The first bytes of all numbers, then the second bytes, ..., compressed."""
    planes = x.view(np.uint8).reshape(-1, x.itemsize).T[:width]
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unzipped(data, width: int) -> np.ndarray:
    n = int.from_bytes(memoryview(data)[:8], "little")
    return np.frombuffer(pa.decompress(memoryview(data)[8:], n * width, "zstd"), np.uint8).reshape(width, n)


def _chunks(batches):
    """Batches put together up to BATCH_BYTES and BATCH_DOCS."""
    held, size, rows = [], 0, 0
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH_DOCS):
            batch = whole.slice(start, BATCH_DOCS)
            if held and (size + batch.nbytes > BATCH_BYTES or rows + batch.num_rows > BATCH_DOCS):
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
            held.append(batch)
            size, rows = size + batch.nbytes, rows + batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _numbered(first: int):
    """body, kind, two longs that name the text -> rows of _TOKENS; words are numbered by their frequency in the batch."""
    def number(batches):
        task = first + TaskContext.get().partitionId()
        for i, chunk in enumerate(_chunks(batches)):
            body, kind, a, b = (chunk.column(k).combine_chunks() for k in range(4))
            hashes, at, sizes = words(body)
            # equally frequent words by their hash, whose first bytes then take next to nothing
            order = np.lexsort((hashes, -np.bincount(at, minlength=len(hashes))))
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(1, len(order) + 1)
            # two marks of the start before each text
            codes, real = np.zeros(len(at) + 2 * len(sizes), np.uint32), np.ones(len(at) + 2 * len(sizes), bool)
            ends = np.cumsum(sizes + 2)
            real[ends - sizes - 2] = real[ends - sizes - 1] = False
            codes[real] = rank[at]
            named = np.append(_START, hashes[order])
            kinds = kind.to_numpy().astype(np.uint8)
            yield pa.RecordBatch.from_pylist([{
                "batch": task << 32 | i, "n_tokens": len(at), "n_trusted": int(sizes[(kinds == TRUSTED) | (kinds == HELD)].sum()),
                "words": _zipped(named, 8), "codes": _zipped(codes, _width(len(named))),
                "sizes": sizes.astype(np.int32).tobytes(), "kinds": kinds.tobytes(),
                "keys": np.concatenate([a.to_numpy(), b.to_numpy()]).tobytes()}], _TOKENS_SCHEMA)
        pa.default_memory_pool().release_unused()
    return number


_TOKENS_SCHEMA = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in _TOKENS.split(", ")])


def _opened(batches):
    """Of each batch of texts: its number, words, codes, sizes, kinds."""
    for rows in batches:
        columns = {c: rows.column(c) for c in ("batch", "words", "codes", "sizes", "kinds")}
        for i in range(rows.num_rows):
            row = {c: x[i] for c, x in columns.items()}
            sizes, kinds = (np.frombuffer(row[c].as_buffer(), d) for c, d in (("sizes", np.int32), ("kinds", np.uint8)))
            named = np.ascontiguousarray(_unzipped(row["words"].as_buffer(), 8).T).view(np.uint64).reshape(-1)
            planes = _unzipped(row["codes"].as_buffer(), _width(len(named)))
            codes = planes[0].astype(np.int32)
            for k in range(1, len(planes)):
                codes |= planes[k].astype(np.int32) << 8 * k
            yield row["batch"].as_py(), named, codes, sizes.astype(np.int64), kinds


def text_key(text_col: str = "text") -> list:
    """Columns: two longs that name a text."""
    return [F.xxhash64(F.lit(seed), text_of(text_col)).alias(name) for seed, name in ((1, "__a"), (2, "__b"))]


def _tokens(docs: DataFrame, kind, text_col: str, first: int = 0) -> DataFrame:
    picked = docs.select(text_of(text_col).alias("body"), kind.cast("int").alias("kind"), *text_key(text_col))
    return materialise(picked.mapInArrow(_numbered(first), _TOKENS), "tokens", compression="uncompressed")


def _frequent(batches):
    """Words that make up a 65,536th of their batch or more, with their count."""
    for _, named, codes, _, _ in _opened(batches):
        count = np.bincount(codes, minlength=len(named))
        count[0] = 0
        often = np.flatnonzero(count * 65_536 > len(codes))
        yield pa.RecordBatch.from_arrays([pa.array(named[often].view(np.int64)), pa.array(count[often])], ["word", "n"])


# ------------------------------------------------------------ dealing out
class Deal:
    """Which round and shard an occurrence goes to, by its middle word; spread words by the word before, too."""

    def __init__(self, tokens: int, rounds: int, partitions: int, often: np.ndarray, counts: np.ndarray):
        self.rounds = rounds
        self.shards = int(min(1 << 16, max(partitions, -(-tokens // (rounds * SHARD_TOKENS)))))
        self.each = max(tokens // (rounds * self.shards), SPREAD_TOKENS // 2, 1)
        self.spread(often[counts > 2 * self.each], counts[counts > 2 * self.each], rounds)

    def spread(self, often: np.ndarray, counts: np.ndarray, rounds: int) -> Deal:
        """These words are spread over shards, and over so many rounds at most, from where there is least of them."""
        by = np.argsort(often)
        self.hot, self.counts = often[by], counts[by]
        parts = np.maximum(-(-self.counts // self.each), 1)
        self.spans = np.minimum(parts, rounds)
        self.parts = (-(-parts // self.spans)).astype(np.uint64)
        load, self.first = np.zeros(self.rounds), np.zeros(len(by), np.int64)
        for i in np.argsort(-self.counts, kind="stable"):
            self.first[i] = load.argmin()
            load[(self.first[i] + np.arange(self.spans[i])) % self.rounds] += self.counts[i] / self.spans[i]
        self.ends = np.zeros(1 << 16, bool)
        self.ends[(self.hot & np.uint64(0xFFFF)).astype(np.int64)] = True
        return self

    def hot_at(self, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these words are spread; their places among those."""
        hot, at = np.zeros(len(named), bool), np.zeros(len(named), np.int64)
        if len(self.hot):
            # most words differ from all of these in their last bytes
            maybe = np.flatnonzero(self.ends[(named & np.uint64(0xFFFF)).astype(np.int64)])
            at[maybe] = np.minimum(np.searchsorted(self.hot, named[maybe]), len(self.hot) - 1)
            hot[maybe] = self.hot[at[maybe]] == named[maybe]
        return hot, at

    def place(self, named: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of these middle words: first round, rounds, shard, whether spread and place among the spread words."""
        h = _mix(named, np.uint64(3))
        first, shards = ((h >> np.uint64(32)) % np.uint64(self.rounds)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)) % np.uint64(self.shards)
        hot, at = self.hot_at(named)
        spans = np.ones(len(named), np.int64)
        first[hot], spans[hot] = self.first[at[hot]], self.spans[at[hot]]
        return first, spans, shards.astype(np.uint16), hot, at

    def comes(self, turn: int, first: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Whether these middle words, or parts of them, come in the round."""
        return (turn - first) % self.rounds < spans

    def part(self, v: np.ndarray, part: np.ndarray) -> np.ndarray:
        return (_mix(v, part + np.uint64(5)) % np.uint64(self.shards)).astype(np.uint16)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive stretches of ``data`` that end there, as binaries."""
    offsets = np.append(0, ends * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))])


def _flat(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """All binaries of a column put together; how many items each has."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kind = np.dtype(kind)
    offsets = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, 4 * array.offset) if len(array) else np.zeros(1, np.int32)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, kind), np.diff(offsets)
    return np.frombuffer(array.buffers()[2], kind, (offsets[-1] - offsets[0]) // kind.itemsize, offsets[0]), np.diff(offsets) // kind.itemsize


_BLOCKS = "shard long, batch long, codes binary, rare binary"
_BLOCK_NAMES = ["shard", "batch", "codes", "rare"]


def _blocks(shared, name: str, turn: int, trusted_only: bool):
    """Occurrences of the round: document and its kind, u, v, w in two bytes each; words without a number beside them."""
    def blocks(batches):
        deal, book = shared.value[name], shared.value["book"]
        for batch, named, codes, sizes, kinds in _opened(batches):
            first, spans, shards, hot, at = deal.place(named)
            now = np.flatnonzero(deal.comes(turn, first, spans).take(codes[1:-1]) & (codes[2:] != 0)) + 2
            # the word before decides between the rounds and shards of a spread word
            apart, before = (spans > 1).take(codes[now - 1]), _mix(named, np.uint64(7))
            u, v = codes[now[apart] - 2], codes[now[apart] - 1]
            apart[apart] = (first[v] + ((before[u] >> np.uint64(56)).astype(np.int64) * spans[v] >> 8)) % deal.rounds != turn
            now = now[~apart]
            doc = np.searchsorted(np.cumsum(sizes + 2), now, side="right")
            if trusted_only:
                real = ((kinds == TRUSTED) | (kinds == HELD))[doc]
                now, doc = now[real], doc[real]
            if not len(now):
                continue
            uvw = np.stack([codes[now - 2], codes[now - 1], codes[now]], 1)
            shard = shards.take(uvw[:, 1])
            spread = np.flatnonzero(hot.take(uvw[:, 1]))
            if len(spread):
                u, v = uvw[spread, 0], uvw[spread, 1]
                shard[spread] = deal.part(named[v], (before[u] & np.uint64(0xFFFFFFFF)) % deal.parts[at[v]])
            order = np.argsort(shard, kind="stable")
            shard, uvw = shard[order], uvw[order]
            # only words that are frequent here can be so on the whole
            number = np.full(len(named), _RARE, np.uint16)
            head = named[:BOOK_WORDS]
            found = np.minimum(np.searchsorted(book, head), len(book) - 1)
            number[:len(head)] = np.where(book[found] == head, found, _RARE)
            quad = np.empty((len(uvw), 4), np.uint16)
            quad[:, 0] = (kinds[doc].astype(np.uint16) << 14 | doc.astype(np.uint16))[order]
            quad[:, 1:] = number.take(uvw)
            rare = quad[:, 1:] == _RARE
            ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[ends - 1].astype(np.int64)), pa.array(np.full(len(ends), batch)), _binaries(quad.reshape(-1), ends * 4),
                 _binaries(named[uvw[rare]], np.cumsum(rare.sum(1))[ends - 1])], _BLOCK_NAMES)
    return blocks


def _gathered(table: pa.Table, book: np.ndarray):
    """Row of the table, document, kind, u, v, w of all occurrences of a shard."""
    quad, sizes = _flat(table.column("codes"), np.uint16)
    quad = quad.reshape(-1, 4)
    uvw = np.append(book, np.zeros(_RARE + 1 - len(book), np.uint64)).take(quad[:, 1:])
    uvw[quad[:, 1:] == _RARE] = _flat(table.column("rare"), np.uint64)[0]
    return np.repeat(np.arange(len(sizes)), sizes // 4), quad[:, 0] & 0x3FFF, quad[:, 0] >> 14, uvw[:, 0], uvw[:, 1], uvw[:, 2]


# ------------------------------------------------------------ counting
_COUNTS = "to long, kind int, v long, data binary"
#: Kinds of rows: words, bigrams of spread middle words, how many n-grams of orders 3 and 2 have the counts 1 to 4.
_WORD, _GRAM, _TIMES = range(3)
_WORDS = np.dtype([("w", "u8"), ("n", "u4"), ("m", "u4")])
_GRAMS = np.dtype([("v", "u8"), *_WORDS.descr])


def _home(w: np.ndarray, shards: int) -> np.ndarray:
    """The shard that has a word's counts."""
    return ((w >> np.uint64(9)) % np.uint64(shards)).astype(np.int64)


def _rows(kind: np.dtype, **columns) -> np.ndarray:
    out = np.empty(len(columns["w"]), kind)
    for name, x in columns.items():
        out[name] = x
    return out


def _dealt(kind: int, data: np.ndarray, to: np.ndarray, v=0) -> pa.Table:
    """A row for each place of ``to``, with what goes there."""
    order = np.argsort(to, kind="stable")
    to, data = to[order], data[order]
    ends = np.append(np.flatnonzero(np.diff(to)) + 1, len(to)) if len(to) else np.zeros(0, np.int64)
    at = ends - 1
    return pa.table([pa.array(to[at]), pa.array(np.full(len(ends), kind, np.int32)),
                     pa.array(np.zeros(len(ends), np.int64) if np.isscalar(v) else v[order][at].view(np.int64)), _binaries(data, ends)],
                    ["to", "kind", "v", "data"])


def _times(x: np.ndarray) -> list:
    return [np.count_nonzero(x == k) for k in (1, 2, 3, 4)]


def _counted(shared):
    def counted(table: pa.Table) -> pa.Table:
        deal, homes = shared.value["train"], shared.value["homes"]
        _, _, kind, u, v, w = _gathered(table, shared.value["book"])
        _, first, at = _different(_mix(_mix(u, v), w))
        n, m = np.bincount(at), np.bincount(at, kind != HELD)
        v, w = v[first], w[first]
        low, first, at = _different(_mix(v, w))
        n2, m2 = np.bincount(at), np.bincount(at, m > 0)
        v, w = v[first], w[first]
        hot, _ = deal.hot_at(v)
        named, at = np.unique(w[~hot], return_inverse=True)
        found = _rows(_WORDS, w=named, n=np.bincount(at, minlength=len(named)), m=np.bincount(at, m2[~hot] > 0, minlength=len(named)))
        grams = _rows(_GRAMS, v=v[hot], w=w[hot], n=n2[hot], m=m2[hot])
        times = np.array([*_times(n), *_times(m), *_times(n2[~hot]), *_times(m2[~hot])], np.int64)
        return pa.concat_tables([_dealt(_WORD, found, _home(named, homes)), _dealt(_GRAM, grams, homes + _home(low[hot], homes)),
                                 _dealt(_TIMES, times.view("V128"), np.array([2 * homes]))])
    return counted


def _added(data: np.ndarray) -> np.ndarray:
    """Rows of the same word or bigram put together."""
    _, first, at = _different(_mix(data["v"], data["w"]) if "v" in data.dtype.names else data["w"])
    out = data[first]
    for c in "nm":
        out[c] = np.bincount(at, data[c], minlength=len(first))
    return out


def _merged(shared):
    def merged(table: pa.Table) -> pa.Table:
        homes, kind = shared.value["homes"], table.column("kind")[0].as_py()
        if kind == _TIMES:
            times = _flat(table.column("data"), np.int64)[0].reshape(-1, 16).sum(0)
            return _dealt(_TIMES, times.view("V128"), np.zeros(1, np.int64))
        data = _added(_flat(table.column("data"), (_WORDS, _GRAMS)[kind])[0])
        if kind == _WORD:
            return _dealt(_WORD, data, np.full(len(data), table.column("to")[0].as_py()))
        named, at = np.unique(data["w"], return_inverse=True)
        found = _rows(_WORDS, w=named, n=np.bincount(at), m=np.bincount(at, data["m"] > 0))
        times = np.array([0] * 8 + _times(data["n"]) + _times(data["m"]), np.int64)
        at = np.unique(data["v"], return_inverse=True)[1]
        return pa.concat_tables([_dealt(_GRAM, data, at, data["v"]), _dealt(_WORD, found, _home(named, homes)),
                                 _dealt(_TIMES, times.view("V128"), np.zeros(1, np.int64))])
    return merged


_OF_WORDS = [*(f"{c}{k}" for c in "nm" for k in (1, 2, 3, 4)), *(f"{c}_{x}" for c in "nm" for x in ("seen", "sum"))]


def _all_words(table: pa.Table) -> pa.Table:
    """The words of a shard with their counts, and what is summed up over all words."""
    data = _added(_flat(table.column("data"), _WORDS)[0])
    sums = [*_times(data["n"]), *_times(data["m"]), *(f(data[c]) for c in "nm" for f in (np.count_nonzero, lambda x: x.sum(dtype=np.int64)))]
    return pa.table([table.column("to").slice(0, 1), pa.array([data.tobytes()], pa.binary()), *(pa.array([int(x)]) for x in sums)], ["to", "data", *_OF_WORDS])


def _discounts(times) -> np.ndarray:
    """What counts of 0, 1, 2 and more lose, by how many n-grams there are of the counts 1 to 4."""
    c1, c2, c3, c4 = (max(int(x or 0), 1) for x in times)
    y = c1 / (c1 + 2 * c2)
    return np.array([0.0, *(min(max(k - (k + 1) * y * hi / lo, 0.05), k - 0.05) for k, lo, hi in ((1, c1, c2), (2, c2, c3), (3, c3, c4)))])


class Model:
    """Texts as numbers, how they are dealt out, counts of bigrams of spread words and of words, discounts, sums of order 1."""

    def __init__(self, tokens: DataFrame, often: np.ndarray, deal: Deal, book: np.ndarray, grams: DataFrame, words: DataFrame,
                 discounts: dict, bases: dict, all_words: int):
        self.tokens, self.often, self.deal, self.book, self.grams, self.words = tokens, often, deal, book, grams, words
        self.discounts, self.bases, self.all_words = discounts, bases, all_words

    def release(self) -> None:
        """Delete the tables; the model cannot be asked any more."""
        drop_scratch(self.tokens, self.grams, self.words)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def train(docs: DataFrame, held, text_col: str = "text", trusted=None) -> Model:
    """The model of all trusted text; ``held`` is the column that tells who is held out.

    All documents are trusted, or those of the column ``trusted``; the others are only there to be scored.
    """
    spark = docs.sparkSession
    held, trusted = F.coalesce(held, F.lit(False)), F.lit(True) if trusted is None else F.coalesce(trusted, F.lit(False))
    with lean(spark):
        tokens = _tokens(docs, F.when(trusted & held, HELD).when(trusted, TRUSTED).otherwise(SCORED), text_col)
        total, of_trusted = (x or 0 for x in tokens.agg(F.sum("n_tokens"), F.sum("n_trusted")).first())
        often = tokens.mapInArrow(_frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n")).limit(BOOK_WORDS).toArrow()
        often, counts = often.column("word").to_numpy().view(np.uint64), often.column("n").to_numpy()
        partitions, rounds = int(spark.conf.get("spark.sql.shuffle.partitions")), int(min(ROUNDS, 1 + total // ROUND_TOKENS))
        deal = Deal(total, rounds, partitions, often, counts)
        counting = Deal(of_trusted, max(1, -(-rounds * of_trusted // max(total, 1))), partitions, often[:0], counts[:0])
        # bigrams of a spread word are counted together, so all of them come in one round
        counting.spread(deal.hot, -(-deal.counts * of_trusted // max(total, 1)), 1)
        book = np.sort(np.append(often, _START))
        shared = spark.sparkContext.broadcast({"book": book, "train": counting, "homes": deal.shards})
        rounds = []
        for turn in range(counting.rounds):
            blocks = tokens.mapInArrow(_blocks(shared, "train", turn, True), _BLOCKS)
            counted = blocks.groupBy("shard").applyInArrow(_counted(shared), _COUNTS)
            rounds.append(materialise(counted.groupBy("to").applyInArrow(_merged(shared), _COUNTS), "counts"))
        shared.destroy()
        counted = _union(rounds)
        grams = materialise(counted.where(F.col("kind") == _GRAM).select("v", "data"), "grams")
        found = materialise(counted.where(F.col("kind") == _WORD).groupBy("to").applyInArrow(
            _all_words, f"to long, data binary, {', '.join(f'{c} long' for c in _OF_WORDS)}"), "words")
        times = counted.where(F.col("kind") == _TIMES).select("data").toArrow()
        times = _flat(times.column("data"), np.int64)[0].reshape(-1, 4, 4).sum(0)
        drop_scratch(*rounds)
        of = {c: x or 0 for c, x in found.agg(*(F.sum(c).alias(c) for c in _OF_WORDS)).first().asDict().items()}
    discounts, bases = {}, {}
    for i, c in enumerate("nm"):
        discounts[c, 3], discounts[c, 2] = _discounts(times[i]), _discounts(times[2 + i])
        d = discounts[c, 1] = _discounts([of[f"{c}{k}"] for k in (1, 2, 3, 4)])
        t, seen = of[f"{c}_sum"], of[f"{c}_seen"]
        kept = d[1] * of[f"{c}1"] + d[2] * of[f"{c}2"] + d[3] * (seen - of[f"{c}1"] - of[f"{c}2"])
        # what an unseen word gets, and the divisor of the discounted count
        bases[c] = (kept / (seen + 1) / t, float(t)) if t else (1.0 / (seen + 1), 1.0)
    return Model(tokens, often, deal, book, grams, found, discounts, bases, of["n_seen"])


# ------------------------------------------------------------ scoring
def _spread_grams(shared, turn: int):
    """Bigrams of spread middle words for each shard that has a part of their occurrences; batch is -1."""
    def grams(batches):
        deal = shared.value["score"]
        for rows in batches:
            for v, body in zip(rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_pylist(), strict=True):
                at = int(deal.hot_at(np.array([v]))[1][0])
                if deal.comes(turn, deal.first[at], deal.spans[at]):
                    parts = np.arange(deal.parts[at], dtype=np.uint64)
                    to = np.unique(deal.part(np.full(len(parts), v), parts))
                    grams = np.frombuffer(body, _GRAMS)
                    sent = np.array([v, len(grams)], np.uint64).tobytes() + b"".join(np.ascontiguousarray(grams[c]).tobytes() for c in "wnm")
                    yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int64)), pa.array(np.full(len(to), -1)),
                                                      pa.array([sent] * len(to), pa.binary()), pa.array([b""] * len(to), pa.binary())], _BLOCK_NAMES)
    return grams


def _received(sent: list[bytes]) -> np.ndarray:
    """The bigrams that ``_spread_grams`` sent."""
    parts = [np.zeros(0, _GRAMS)]
    for x in sent:
        v, n = np.frombuffer(x, np.uint64, 2)
        n = int(n)
        parts.append(_rows(_GRAMS, v=v, w=np.frombuffer(x, np.uint64, n, 16), n=np.frombuffer(x, np.uint32, n, 16 + 8 * n),
                           m=np.frombuffer(x, np.uint32, n, 16 + 12 * n)))
    return np.concatenate(parts)


def _single(x: np.ndarray) -> np.ndarray:
    """Discounted counts are rounded to single precision."""
    return x.astype(np.float32).astype(np.float64)


def _scored(shared):
    def scored(table: pa.Table) -> pa.Table:
        deal, book, top, discounts, bases = (shared.value[k] for k in ("score", "book", "top", "discounts", "bases"))
        from_grams = pc.less(table.column("batch"), 0)
        spread = _received(table.filter(from_grams).column("codes").to_pylist())
        table = table.filter(pc.invert(from_grams))
        if not table.num_rows:
            return _OPEN_SCHEMA.empty_table()
        row, doc, kind, u, v, w = _gathered(table, book)
        context = _mix(u, v)
        _, first, at = _different(_mix(context, w))
        counts = {"n": np.bincount(at, (kind == TRUSTED) | (kind == HELD)), "m": np.bincount(at, kind == TRUSTED)}
        v, w, at3 = v[first], w[first], _different(context[first])[2]
        keys, first, at2 = _different(_mix(v, w))
        v, w = v[first], w[first]
        middle, _, at1 = _different(v)
        hot, _ = deal.hot_at(middle)
        low = _mix(spread["v"], spread["w"])
        order = np.argsort(low)
        sv = spread["v"][order]
        low, spread = np.append(low[order], np.uint64(2**64 - 1)), np.append(spread[order], np.zeros(1, _GRAMS))
        place = np.searchsorted(low, keys)
        place = np.where(low[place] == keys, place, len(low) - 1)
        of_middle = np.searchsorted(middle, sv)  # bigrams of a spread word that has nothing here are not asked
        of_middle[np.append(middle, np.uint64(0))[of_middle] != sv] = len(middle)
        word = np.minimum(np.searchsorted(top["w"], w), len(top["w"]) - 1)
        known = top["w"][word] == w
        rest = ~known if not top["all"] else np.zeros(len(w), bool)
        p = {}
        for c in "nm":
            n3, d = counts[c], discounts[c, 3]
            left = n3 - d[np.minimum(n3, 3).astype(int)]
            total = np.bincount(at3, n3)
            left, kept = _single(left), _single(total - np.bincount(at3, left))
            # a spread word's bigrams, whose words before are counted in all shards
            n2 = np.where(hot[at1], spread[c][place], np.bincount(at2, n3 > 0))
            d = discounts[c, 2]
            left2 = n2 - d[np.minimum(n2, 3).astype(int)]
            x2, k2 = (np.bincount(at1, x, minlength=len(middle)) for x in (n2, left2))
            s2 = spread[c][:-1].astype(np.float64)
            t2, l2 = (np.bincount(of_middle, x, minlength=len(middle) + 1)[:-1] for x in (s2, s2 - d[np.minimum(s2, 3).astype(int)]))
            total2, kept2, left2 = np.where(hot, t2, x2)[at1], _single(np.where(hot, t2 - l2, x2 - k2))[at1], _single(left2)
            n1 = np.where(known, top[c][word], 0)
            p1 = _single(n1 - discounts[c, 1][np.minimum(n1, 3)]) / bases[c][1] + bases[c][0]
            # a probability is x + y * p1; words whose p1 is not known here keep both
            x, y = (np.where(total2 > 0, v / np.maximum(total2, 1), o) for v, o in ((left2, 0.0), (kept2, 1.0)))
            x, y = np.where(rest, x, x + y * p1)[at2], np.where(rest, y, 0.0)[at2]
            seen, total = total[at3] > 0, np.maximum(total[at3], 1)
            x, y = np.where(seen, (left + kept[at3] * x) / total, x), np.where(seen, kept[at3] / total, 1.0) * y
            p[c] = x, y
        nll = {c: np.where(rest[at2], 0.0, -np.log(np.maximum(np.where(rest[at2], 1.0, p[c][0]), 1e-300)))[at] for c in "nm"}
        starts = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(doc) != 0)))
        odd = kind[starts] >= HELD
        ends = np.searchsorted(row[starts], np.arange(table.num_rows), side="right")
        numbers = table.column("batch").combine_chunks()
        sums = _open_rows(numbers, ends, odd, _OPEN | _SUMS, docs=doc[starts] | (odd.astype(np.uint16) << 15),
                          n=np.add.reduceat(nll["n"], starts), m=np.add.reduceat(nll["m"], starts)[odd])
        waits = np.flatnonzero(rest[at2][at])
        if not len(waits):
            return sums
        grams, words, odd = at[waits], w[at2][at][waits], kind[waits] >= HELD
        to = -1 - _home(words, deal.shards)
        order = np.argsort(to, kind="stable")
        to, grams, odd = to[order], grams[order], odd[order]
        ends = np.append(np.flatnonzero(np.diff(to)) + 1, len(to))
        return pa.concat_tables([sums, _open_rows(
            pa.array(to[ends - 1]), ends, batch=numbers.to_numpy()[row[waits][order]], docs=doc[waits][order] | (odd.astype(np.uint16) << 15), w=words[order],
            n=p["n"][0][grams], y=p["n"][1][grams], m=p["m"][0][grams][odd], ym=p["m"][1][grams][odd], odd=odd)])
    return scored


#: Sums of documents of the batch ``to``, or occurrences that wait for the counts of words of the shard ``-1 - to``.  The first bit of
#: docs tells whose ``m`` is asked; the others have none.
_OPEN = {"batch": np.int64, "docs": np.uint16, "w": np.uint64, "n": np.float32, "y": np.float32, "m": np.float32, "ym": np.float32}
_SUMS = {"docs": np.uint16, "n": np.float64, "m": np.float64}
_OPEN_SCHEMA, _SUMS_SCHEMA = (pa.schema([("to", pa.int64()), *((c, pa.binary()) for c in x)]) for x in (_OPEN, _SUMS))
_OPEN_COLUMNS, _SUMS_COLUMNS = (f"to long, {', '.join(f'{c} binary' for c in x)}" for x in (_OPEN, _SUMS))


def _open_rows(to, ends: np.ndarray, odd: np.ndarray, kinds: dict = _OPEN, **columns) -> pa.Table:
    of = {c: np.append(0, np.cumsum(odd))[ends] if c in ("m", "ym") else ends for c in columns}
    none = np.zeros(len(ends), np.int64)
    return pa.table([to, *(_binaries(columns.get(c, none[:0]).astype(d, copy=False), of.get(c, none)) for c, d in kinds.items())], ["to", *kinds])


def _summed(kinds: dict):
    """Sums of the documents of each batch; rows that wait for counts as they are, put together."""
    def summed(table: pa.Table) -> pa.Table:
        to = table.column("to")[0].as_py()
        if to < 0:
            parts = [_flat(table.column(c), d)[0] for c, d in _OPEN.items()]
            return pa.table([pa.array([to]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], schema=_OPEN_SCHEMA)
        docs, n, m = (_flat(table.column(c), d)[0] for c, d in _SUMS.items())
        odd, docs = docs >> 15 > 0, docs & 0x3FFF
        size = int(docs.max(initial=0)) + 1
        there, is_odd = np.bincount(docs, minlength=size) > 0, np.bincount(docs, odd, minlength=size) > 0
        sums, odd_sums = np.bincount(docs, n, minlength=size), np.bincount(docs[odd], m, minlength=size)
        found = np.flatnonzero(there).astype(np.uint16) | (is_odd[there].astype(np.uint16) << 15)
        parts = {"docs": found, "n": sums[there].astype(np.float64), "m": odd_sums[is_odd].astype(np.float64)}
        return pa.table([pa.array([to]), *(pa.array([parts[c].tobytes() if c in parts else b""], pa.binary()) for c in kinds)], ["to", *kinds])
    return summed


def _met(shared):
    """Occurrences meet the counts of their words: sums of documents."""
    def met(waiting: pa.Table, words: pa.Table) -> pa.Table:
        if not waiting.num_rows:
            return _SUMS_SCHEMA.empty_table()
        discounts, bases = shared.value["discounts"], shared.value["bases"]
        found = np.append(_flat(words.column("data"), _WORDS)[0], np.zeros(1, _WORDS))
        known = found["w"][:-1]  # in order, and the last one stands for none
        batch, docs, w, x, y, xm, ym = (_flat(waiting.column(c), d)[0] for c, d in _OPEN.items())
        place = np.searchsorted(known, w)
        place[np.append(known, ~w[:1])[place] != w] = len(known)
        odd, nll = docs >> 15 > 0, {}
        for c, x, y, at in (("n", x, y, place), ("m", xm, ym, place[odd])):
            n1 = found[c][at].astype(np.int64)
            p1 = _single(n1 - discounts[c, 1][np.minimum(n1, 3)]) / bases[c][1] + bases[c][0]
            nll[c] = -np.log(np.maximum(x + y * p1, 1e-300))
        every = np.zeros(len(w))
        every[odd] = nll["m"]
        order = np.lexsort((docs, batch))
        batch, docs = batch[order], docs[order]
        starts = np.flatnonzero(np.append(True, (np.diff(batch) != 0) | (np.diff(docs) != 0)))
        odd, batch = docs[starts] >> 15 > 0, batch[starts]
        ends = np.append(np.flatnonzero(np.diff(batch)) + 1, len(batch))
        return _open_rows(pa.array(batch[ends - 1]), ends, odd, _SUMS, docs=docs[starts], n=np.add.reduceat(nll["n"][order], starts),
                          m=np.add.reduceat(every[order], starts)[odd])
    return met


def _by_document(documents: pa.Table, sums: pa.Table) -> pa.Table:
    """The documents of a batch with their sums."""
    size, kind, key = (_flat(documents.column(c), d)[0] for c, d in (("sizes", np.int32), ("kinds", np.uint8), ("keys", np.int64)))
    docs, n, m = (_flat(sums.column(c), d)[0] for c, d in _SUMS.items())
    odd, docs = docs >> 15 > 0, docs & 0x3FFF
    a, b = key.reshape(2, -1)
    return pa.table([pa.array(size.astype(np.int64)), pa.array(np.bincount(docs, n, minlength=len(size)).astype(float), mask=kind == HELD_SCORED),
                     pa.array(np.bincount(docs[odd], m, minlength=len(size)).astype(float), mask=kind < HELD), pa.array(a), pa.array(b)], ["size", "n", "m", "__a", "__b"])


def _levels(batches):
    for rows in batches:
        n = _flat(rows.column(0), _WORDS)[0]["n"]
        level, count = np.unique(np.log2(n) * 8 // 1, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(level.astype(np.int64)), pa.array(count)], ["level", "n"])


def _picked(shared, least: int):
    def picked(batches):
        often = shared.value
        for rows in batches:
            data = _flat(rows.column(0), _WORDS)[0]
            at = np.minimum(np.searchsorted(often, data["w"]), len(often) - 1)
            data = data[(np.log2(data["n"]) * 8 // 1 >= least) | (often[at] == data["w"])]
            yield pa.RecordBatch.from_arrays([pa.array(data["w"].view(np.int64)), *(pa.array(data[c].astype(np.int64)) for c in "nm")], ["w", "n", "m"])
    return picked


def _top_words(model: Model) -> dict:
    """Counts of the words with most different words before them, as many as TOP_WORDS allows, and of those frequent in any text; whether these are all."""
    least, data, spark = -1, model.words.select("data"), model.words.sparkSession
    if model.all_words > TOP_WORDS:
        room, least = TOP_WORDS, 1 << 30
        for level, n in sorted(data.mapInArrow(_levels, "level long, n long").groupBy("level").agg(F.sum("n")).collect(), reverse=True):
            room -= n
            if room < 0:
                break
            least = level
    often = np.sort(np.append(model.often, _START))
    shared = spark.sparkContext.broadcast(often)
    rows = data.mapInArrow(_picked(shared, least), "w long, n long, m long").toArrow()
    shared.destroy()
    found, counts = rows.column("w").to_numpy().view(np.uint64), {c: rows.column(c).to_numpy() for c in "nm"}
    none = np.setdiff1d(often, found)
    order = np.argsort(named := np.append(found, none))
    # the last one stands for none
    return {"w": np.append(named[order], np.uint64(2**64 - 1)), "all": model.all_words <= TOP_WORDS,
            **{c: np.append(np.append(x, np.zeros(len(none), np.int64))[order], 0).astype(np.int32) for c, x in counts.items()}}


def _settled(rounds: list[DataFrame], model: Model, shared, every_word: bool) -> DataFrame:
    """Sums of some rounds, in which all words have met their counts."""
    rows = _union(rounds)
    sums = rows.where("to >= 0").select("to", "docs", "n", "m")
    if not every_word:
        waiting = rows.where("to < 0").withColumn("to", -1 - F.col("to"))
        sums = sums.unionByName(waiting.groupBy("to").cogroup(model.words.select("to", "data").groupBy("to")).applyInArrow(_met(shared), _SUMS_COLUMNS))
    out = materialise(sums.groupBy("to").applyInArrow(_summed(_SUMS), _SUMS_COLUMNS), "sums")
    drop_scratch(*rounds)
    return out


def _scores(model: Model, more: DataFrame | None = None) -> DataFrame:
    """__a, __b, __words, __n, __m: words and nats of each text of the model's documents and ``more``, by either model."""
    spark, tokens = model.tokens.sparkSession, model.tokens if more is None else model.tokens.unionByName(more)
    with lean(spark):
        top = _top_words(model)
        shared = spark.sparkContext.broadcast({"book": model.book, "score": model.deal, "top": top, "discounts": model.discounts, "bases": model.bases})
        waiting, sums = [], []
        for turn in range(model.deal.rounds):
            blocks = tokens.mapInArrow(_blocks(shared, "score", turn, False), _BLOCKS)
            if model.deal.comes(turn, model.deal.first, model.deal.spans).any():
                blocks = blocks.unionByName(model.grams.mapInArrow(_spread_grams(shared, turn), _BLOCKS))
            parts = blocks.groupBy("shard").applyInArrow(_scored(shared), _OPEN_COLUMNS)
            waiting.append(materialise(parts.groupBy("to").applyInArrow(_summed(_OPEN), _OPEN_COLUMNS), "round"))
            if len(waiting) == SETTLE or turn == model.deal.rounds - 1:
                sums.append(_settled(waiting, model, shared, top["all"]))
                waiting = []
        documents = tokens.select(F.col("batch").alias("to"), "sizes", "kinds", "keys").groupBy("to").cogroup(_union(sums).groupBy("to"))
        by_text = documents.applyInArrow(_by_document, "size long, n double, m double, __a long, __b long").groupBy("__a", "__b").agg(
            *(F.max(c).alias(name) for c, name in (("size", "__words"), ("n", "__n"), ("m", "__m"))))
        out = materialise(by_text, "texts")
        shared.destroy()
        drop_scratch(*sums)
    return out


def score(docs: DataFrame, held: DataFrame | None, model: Model, columns: list, text_col: str = "text", known: bool = False) -> DataFrame:
    """``columns``, __n_words, __nll of each whole text, __held.

    Rows of ``docs`` are scored by the model of all trusted text, rows of ``held`` (with
    __held) by the model without the held-out documents.  ``known`` tells that the model was
    made with these documents at hand, so that their texts need not be split into words again.
    """
    more, marked = [], []
    for i, (rows, kind) in enumerate(((docs, SCORED), (held, HELD_SCORED))):
        if rows is not None:
            marked.append(rows.select(*columns, *text_key(text_col), F.lit(kind == HELD_SCORED).alias("__held")))
            if not known:
                with lean(docs.sparkSession):
                    more.append(_tokens(rows, F.lit(kind), text_col, (i + 1) << 28))
    scores = _scores(model, _union(more) if more else None)
    drop_scratch(*more)
    rows = _union(marked)
    return rows.join(scores, ["__a", "__b"]).select(*rows.columns[:-3], F.col("__words").alias("__n_words"),
                                                    F.when(F.col("__held"), F.col("__m")).otherwise(F.col("__n")).alias("__nll"), "__held")
