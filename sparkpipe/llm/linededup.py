"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

Equal lines form classes (combined before the shuffle).  A line within ``edits`` edits of
another one shares, unchanged, at least one of the ``edits + 1`` segments that the shorter
one is cut into.  Each class puts its segments, hashed with its length and their number,
in an index; each class probes the index for every length up to ``edits`` below its own with
the substrings whose place the edits allow (multi-match-aware selection: their shift is
bounded from the left and from the right).  Pairs that meet are verified with the banded
edit distance.

The edits allowed follow the shorter line of a pair: ``edits`` from LEAST_CHARS on, one from
FEW_CHARS on (a similarity of 0.8), none below.  Lines of one edit have an index of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_side
from .common import compiled_methods, doc_key, free_name, key_id, materialise, text_of

EDITS = 2
#: Pairs whose shorter line is below LEAST_CHARS may differ by one edit; below FEW_CHARS a line has only equal lines.
LEAST_CHARS, FEW_CHARS = 30, 5
NEWLINE = "\n"
#: Characters that a blank line may hold.
BLANKS = " \t\r\f"
#: Letters whose counts rule pairs out.
LETTERS = "eaionrstlhdu"
#: Hashes of lines to read out again: broadcast up to so many rows of 8 bytes, joined beyond.
PAIRED_LINES = 2_000_000


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, line_no (from 0), line: every line of every text, blank ones too."""
    return docs.select(doc_key(id_col, text_col).alias("doc"),
                       F.posexplode(F.split(text_of(text_col), NEWLINE, -1)).alias("line_no", "line"))


def _keys() -> list[Column]:
    """Two independent 64-bit hashes that name a line."""
    return [F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(7), F.col("line")).alias("k2")]


def classes(lines: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """k1, k2, first (doc, line_no), copies, chars, name, keys, few: one row per different line that is not blank.

    ``keys`` holds the line's probe hashes, ``few`` those for one edit if the line is short,
    and ``name`` what pairs know of it; the text itself does not travel.
    """
    short = F.col("chars").between(FEW_CHARS, least)
    keys = F.when(F.col("chars") >= least, F.array(*(k for k, _, _ in probe_keys(edits))))
    few = F.when(short, F.array(*(k for k, _, _ in probe_keys(1))))
    return lines.where(F.trim("line", F.lit(BLANKS)) != "").withColumn("chars", F.char_length("line")) \
        .select(*_keys(), F.struct("doc", "line_no").alias("place"), "chars", _name().alias("name"),
                keys.alias("keys"), few.alias("few")) \
        .groupBy("k1", "k2").agg(F.min("place").alias("first"), F.count("*").alias("copies"), F.first("chars").alias("chars"),
                                 F.first("name").alias("name"), F.first("keys").alias("keys"), F.first("few").alias("few"))


def _name() -> Column:
    """The line's hash, its last bits replaced by counts of some letters modulo 4.

    Lines of different names are different; an edit changes at most two of the counts by one.
    """
    counts = [(F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(c)))) % 4 for c in LETTERS]
    packed = reduce(lambda a, b: a * 4 + b, counts[1:], counts[0].cast("long"))
    return F.shiftleft(F.xxhash64("line"), 2 * len(LETTERS)).bitwiseOR(packed)


def _may_be_near(x: str, y: str, edits: int) -> Column:
    """No pair within ``edits`` fails this: the letter counts of two names differ by 2 * edits at most."""
    def gap(i):
        a, b = (F.shiftright(F.col(c), 2 * i).bitwiseAND(F.lit(3)) for c in (x, y))
        d = F.abs(a - b)
        return F.least(d, 4 - d)
    return reduce(lambda a, b: a + b, map(gap, range(len(LETTERS)))) <= 2 * edits


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and size of segment ``i``; the last segments are a character longer if need be."""
    size, rest = F.floor(length / parts), length % parts
    longer = F.greatest(F.lit(i) - (F.lit(parts) - rest), F.lit(0))
    return 1 + i * size + longer, size + (F.lit(i) >= F.lit(parts) - rest).cast("int")


def _hash(length: Column, i: int, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(F.col("line"), start, size))


def probe_keys(edits: int) -> list[tuple[Column, bool, int]]:
    """Hashes of the substrings that may equal a segment of a line up to ``edits`` shorter.

    Each with: is it one of the line's own segments (which the index holds), how much shorter.
    """
    out = []
    for delta in range(edits + 1):
        n = F.col("chars") - delta
        for i in range(edits + 1):
            start, size = _segment(n, i, edits + 1)
            left, right = i, edits - i
            for shift in range(max(-left, delta - right), min(left, delta + right) + 1):
                out.append((_hash(n, i, start + shift, size), delta == shift == 0, delta))
    return out


def _meet(keyed: DataFrame, keys: str, edits: int) -> DataFrame:
    """x, y: names of lines that share a segment and may be within ``edits``."""
    kinds = probe_keys(edits)
    own = [i for i, (_, mine, _) in enumerate(kinds) if mine]
    level = sum(delta == 0 for _, _, delta in kinds)  # keys for lines of the same length come first
    index = keyed.select(F.col("name").alias("short"), F.explode(F.array(*(F.get(keys, F.lit(i)) for i in own))).alias("h"))
    probe = keyed.select(F.col("name").alias("long"), F.posexplode(keys).alias("i", "h"))
    # of two lines of the same length, which would find each other, one probes
    turn = (F.col("short") < F.col("long")) | ((F.col("i") >= level) & (F.col("short") != F.col("long")))
    return index.join(probe, "h").where(turn & _may_be_near("short", "long", edits)).select(
        F.least("short", "long").alias("x"), F.greatest("short", "long").alias("y"))


def links(distinct: DataFrame, lines: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """k1, k2, own, other: both directions of every pair of different lines within the edits allowed.

    ``distinct`` are the classes of ``lines``; own and other are the first places of the
    line and of the one near it.  Only the lines of a pair that meets in an index are read
    out of the texts again.
    """
    # different lines of one name, of which the joins would know nothing
    alike = distinct.where(F.col("chars") >= min(least, FEW_CHARS)).groupBy("name") \
        .agg(F.min("k2").alias("p"), F.max("k2").alias("q"), F.min("k1").alias("r"), F.max("k1").alias("s")) \
        .where("p != q or r != s").select(F.col("name").alias("x"), F.col("name").alias("y"))
    met = _meet(distinct.where("keys is not null"), "keys", edits).unionByName(_meet(distinct.where("few is not null"), "few", 1))
    met = materialise(met.distinct().unionByName(alike), "line-pairs")
    names = met.select(F.col("x").alias("name")).union(met.select(F.col("y").alias("name"))).distinct()
    wanted = materialise(distinct.select("name", "k1", "k2", "first").join(names, "name"), "paired-lines")
    texts = materialise(lines.select(*_keys(), "line").join(small_side(wanted, PAIRED_LINES), ["k1", "k2"])
                        .dropDuplicates(["k1", "k2"]), "lines")
    a, b = (texts.select(F.col("name").alias(c), *(F.col(n).alias(c + n) for n in ("k1", "k2", "line", "first"))) for c in "xy")
    once = (F.col("x") != F.col("y")) | (F.struct("xk1", "xk2") < F.struct("yk1", "yk2"))
    allowed = F.when(F.least(F.char_length("xline"), F.char_length("yline")) < least, 1).otherwise(edits)
    distance = F.levenshtein("xline", "yline", max(edits, 1))
    near = met.join(a, "x").join(b, "y").where(once & (distance >= 0) & (distance <= allowed))
    ways = [F.struct(F.col(p + "k1").alias("k1"), F.col(p + "k2").alias("k2"), F.col(p + "first").alias("own"),
                     F.col(q + "first").alias("other")) for p, q in ("xy", "yx")]
    return near.select(F.explode(F.array(*ways)).alias("e")).select("e.*")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """One row per line that is not blank: doc, line_no, copies, first, links, near, kept.

    ``first`` is the place (doc, line_no) of the first equal line, ``copies`` their number,
    ``links`` the number of different lines near it, ``near`` the place of the earliest of
    these if it comes before ``first``.  Near is within ``edits`` edits, within one if the
    shorter line has less than ``least`` characters, and equal if it has less than FEW_CHARS.
    A line is kept if it is the first of its class and none of the lines near it comes before.
    Blank lines have no row and always stay.  Null text is empty; rows that share an id count
    as one document; other columns play no part; an empty table gives an empty result.
    """
    lines = lines_of(docs, id_col, text_col)
    with compiled_methods(docs.sparkSession):  # the probe hashes make a large method
        distinct = materialise(classes(lines, edits, least), "line-classes")
    near = links(distinct, lines, edits, least).groupBy("k1", "k2").agg(
        F.count("*").alias("links"), F.min(F.when(F.col("other") < F.col("own"), F.col("other"))).alias("near"))
    placed = lines.select("doc", "line_no", *_keys()).join(distinct.select("k1", "k2", "first", "copies"), ["k1", "k2"])
    return placed.join(near, ["k1", "k2"], "left").select(
        "doc", "line_no", "copies", "first", F.coalesce("links", F.lit(0)).alias("links"), "near",
        ((F.struct("doc", "line_no") == F.col("first")) & F.col("near").isNull()).alias("kept"))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """``line_classes`` in plain columns: ids instead of document keys."""
    return line_classes(docs, **options).select(
        key_id("doc").alias("doc_id"), "line_no", "copies", key_id("first.doc").alias("first_doc_id"),
        F.col("first.line_no").alias("first_line_no"), "links", key_id("near.doc").alias("near_doc_id"),
        F.col("near.line_no").alias("near_line_no"), "kept")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """The documents without the lines that are not kept, same columns; blank lines stay.

    A text that loses all its lines becomes empty, its row stays.  The columns may have any names.
    """
    key, gone = free_name(docs, "__doc"), free_name(docs, "__gone")
    masks = line_classes(docs, id_col, text_col, edits, least).where("not kept") \
        .groupBy(F.col("doc").alias(key), F.expr("line_no div 64").alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, line_no % 64)")).alias("mask")) \
        .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("words"),
                              F.max("word").alias("last")) \
        .select(key, F.transform(F.sequence(F.lit(0), F.col("last").cast("int")),
                                     lambda w: F.coalesce(F.element_at("words", w.cast("long")), F.lit(0))).alias(gone))
    rows = docs.join(masks, doc_key(id_col, text_col) == F.col(key), "left")

    def stays(_, i):
        bits = F.get(F.col(gone), F.floor(i / 64).cast("int"))
        return F.coalesce(F.getbit(bits, i % 64), F.lit(0)) == 0

    cut = F.array_join(F.filter(F.split(text_of(text_col), NEWLINE, -1), stays), NEWLINE)
    text = F.when(F.col(gone).isNull(), text_of(text_col)).otherwise(cut)
    return rows.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))


def oracle(edits: int = EDITS, least: int = LEAST_CHARS) -> str:
    """``line_report`` over ``documents`` in SQL: every pair of lines of near lengths is compared."""
    return f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
l AS (SELECT doc_id, unnest(range(len(s))) AS line_no, unnest(s) AS line FROM d),
c AS (SELECT line, min((doc_id, line_no)) AS f, count(*) AS copies FROM l
      WHERE trim(translate(line, chr(9) || chr(13) || chr(12), '   ')) <> '' GROUP BY line),
n AS (SELECT a.line, count(*) AS links, min(CASE WHEN b.f < a.f THEN b.f END) AS near FROM c a JOIN c b
      ON a.line <> b.line AND length(a.line) >= {FEW_CHARS} AND length(b.line) >= {FEW_CHARS}
      AND abs(length(a.line) - length(b.line)) <= CASE WHEN least(length(a.line), length(b.line)) < {least} THEN 1 ELSE {edits} END
      AND levenshtein(a.line, b.line) <= CASE WHEN least(length(a.line), length(b.line)) < {least} THEN 1 ELSE {edits} END
      GROUP BY a.line)
SELECT l.doc_id, l.line_no::INT AS line_no, c.copies, c.f[1] AS first_doc_id, c.f[2]::INT AS first_line_no,
       coalesce(n.links, 0) AS links, n.near[1] AS near_doc_id, n.near[2]::INT AS near_line_no,
       (l.doc_id, l.line_no) = c.f AND n.near IS NULL AS kept
FROM l JOIN c USING (line) LEFT JOIN n USING (line)"""


