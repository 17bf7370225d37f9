"""Neighbours, line, exact, near and substring deduplication against brute force, and odd inputs."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sparkpipe.llm import ann, dart, exact, licenses, linededup, spans
from sparkpipe.llm.common import prepare, table
from sparkpipe.llm.radix import RadixTrie

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 long, line string, __key string"
LONG = " ".join(f"w{i % 997}" for i in range(20_000)) + "."


def frame(spark, rows):
    """(doc_id, text) rows with extra columns whose names clash with the operators' own."""
    return prepare(spark).createDataFrame([(i, t, "en", "s", 0, 1, "x", "y") for i, t in rows], SCHEMA)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "One line."), (4, "One line."), (None, "No id here."), (None, None),
       (7, LONG), (8, LONG), (9, "tie"), (10, "tie")]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_trie_keeps_owners_and_gives_up_subtrees():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(3000)]
    trie, want = RadixTrie(), {}
    for i, w in enumerate(words):
        trie.insert(w, (len(w), i, 1))
        want[w] = want.get(w, 0) + 1
    assert {k: o[2] for k, o in trie.items()} == want
    gone = dict(trie.evict())
    assert gone and len(gone) < len(want)
    assert {**dict(trie.items()), **gone}.keys() == want.keys()
    assert not any(trie.insert(k, (0, 0, 1)) for k in gone)


@pytest.mark.parametrize("bound", [exact.TRIE_BYTES, 2000])
def test_exact_dedup_matches_brute_force_and_spills(spark, bound):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 5)))) for i in range(400)] + ODD
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0))
    want = []
    for body, members in groups.items():
        cp, none, keep = min(members)
        for c, n, i in members:
            want.append((None if n else i, None if none else keep, len(members), (c, n, i) == (cp, none, keep),
                         hashlib.sha256(body.encode()).hexdigest()))
    got = exact.exact_dedup(frame(spark, rows), trie_bytes=bound).drop("n_chars")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("side", [exact._combine, exact._own])
def test_exact_dedup_holds_texts_with_one_long_prefix_once(side):
    def body(i):
        return b"x" * 50_000 + str(i % 1500).encode()

    def batches():
        for at in range(0, 2000, 50):
            some = [body(i) for i in range(at, at + 50)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(b).digest() for b in some], pa.binary()), pa.array(some, pa.binary()),
                 pa.array([len(b) for b in some]), pa.array(range(at, at + 50)), pa.array([1] * 50)],
                ["sha", "body", "cp", "id", "n"])
    tracemalloc.start()
    found, largest = {}, 0
    for out in side(1 << 20)(batches()):
        largest = max(largest, out.nbytes)
        for r in out.drop_columns("body").to_pylist():
            known = found.get(r["sha"], (r["id"], 0))
            found[r["sha"]] = min(known[0], r["id"]), known[1] + r["n"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {hashlib.sha256(body(i)).digest(): (i, 1 + (i < 500)) for i in range(1500)}
    assert peak < 50 << 20 and largest < 6 << 20, (peak, largest)  # all texts are 100 MB


def test_exact_dedup_deletes_ascii_white_space_only(spark):
    same = ["ab", "a b", "a\tb", "a\nb", "a\x0bb", "a\x0cb", "a\rb", " \t\n\x0b\x0c\rab "]
    other = ["a\u00a0b", "a\x1cb", "a\x85b", "a\u2003b", "a\x08b", "a\x0eb"]
    got = {r["doc_id"]: r for r in exact.exact_dedup(frame(spark, [*enumerate(same + other)])).collect()}
    assert [got[i]["group_size"] for i in range(14)] == [8] * 8 + [1] * 6
    assert [i for i in range(14) if got[i]["kept"]] == list(range(7, 14))
    assert [got[i]["text_sha256"] for i in range(14)] == [
        hashlib.sha256((t if t in other else "ab").encode()).hexdigest() for t in same + other]


def test_exact_dedup_of_nothing_and_rows_kept(spark):
    assert exact.exact_dedup(frame(spark, [])).count() == 0
    kept = exact.keep_first(frame(spark, [(2, "a b"), (1, "ab"), (3, "c")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and kept.columns == frame(spark, []).columns


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_links_match_brute_force(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abé d") for _ in range(rng.randint(9, 16))) for _ in range(25)]
    lines = set(base)
    for b in base:
        for _ in range(4):
            s = list(b)
            for _ in range(rng.randint(1, edits + 1)):
                k = rng.randrange(len(s))
                rng.choice([lambda k=k: s.pop(k), lambda k=k: s.insert(k, "x"), lambda k=k: s.__setitem__(k, "y")])()
            lines.add("".join(s))
    lines = sorted(x for x in lines if x.strip() and len(x) >= 8)
    docs = frame(spark, [(i, x) for i, x in enumerate(lines)])
    want = {i: sum(a != b and distance(a, b) <= edits for b in lines) for i, a in enumerate(lines)}
    got = linededup.line_report(docs, edits=edits, least=8).collect()
    assert {r["doc_id"]: r["links"] for r in got} == want
    first = {i: min([j for j, b in enumerate(lines) if distance(lines[i], b) <= edits]) for i in range(len(lines))}
    assert {r["doc_id"] for r in got if r["kept"]} == {i for i, j in first.items() if i == j}


def test_line_dedup_of_odd_rows(spark):
    docs = frame(spark, [*ODD, (20, "One line.\n\nNew line.\r\nOne line.")])
    out = {(r["doc_id"], r["text"]) for r in linededup.line_dedup(docs).collect()}
    assert (20, "\nNew line.\r") in out and (1, "") in out and (8, "") in out and (4, "One line.") in out
    assert linededup.line_dedup(docs).count() == len(ODD) + 1
    assert linededup.line_dedup(frame(spark, [])).count() == 0
    plan = linededup.line_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    darts, gaps = dart.Darts(144), []
    for _ in range(25):
        u = np.sort(rng.integers(0, 1 << 63, 200).astype(np.uint64))
        a = rng.integers(1, 9, 200) * 0.5
        b = np.maximum(0.3, a + rng.integers(-1, 2, 200) * (rng.random(200) < 0.5))
        gaps.append(np.mean(darts.sign(u, a) == darts.sign(u, b)) - dart.similarity(u, a, u, b))
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.06


def test_near_duplicates_match_brute_force(spark):
    docs = table(prepare(spark), "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    sets = {}
    for r in rows:
        w = r["text"].lower().split()
        sets[r["doc_id"]] = set(zip(*(w[i:] for i in range(5)), strict=False)) or {tuple(w)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if b < a and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = dart.class_ids(dart.near_duplicates(docs)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in sets}


def test_near_dedup_family_and_odd_rows(spark):
    rng = random.Random(4)
    base = [f"word{i}" for i in range(120)]
    family = []
    for i in range(60):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(120)] = f"other{rng.random()}"
        family.append((100 + i, " ".join(words)))
    docs = frame(spark, [*ODD, (99, " ".join(base)), *family])
    kept = [r["doc_id"] for r in dart.near_dedup(docs).collect()]
    assert 99 in kept and sum(k is not None and k >= 99 for k in kept) < 10
    assert {7, 9} <= set(kept) and not {8, 10} & set(kept) and kept.count(4) == 2
    assert dart.near_dedup(docs, weighted=True).count() <= len(ODD) + 61
    assert dart.near_duplicates(frame(spark, [])).count() == 0


def test_repeated_runs_go_and_clean_text_stays(spark):
    passage = " ".join(f"Sentence number {i} says something else." for i in range(12))
    one = " ".join(f"very{i}" for i in range(60)) + "."
    docs = frame(spark, [(1, f"Alpha begins. {passage} Alpha ends."), (2, f"Beta begins.\n{passage}\nBeta ends."),
                         (3, "A clean text. With its own words. Nothing of it repeats anywhere."),
                         (4, f"Gamma. {one} Rest."), (5, f"Delta {one}\n{one}"), (6, f"Own. {one} Rest of six."), *ODD[:7]])
    out = {(r["doc_id"], r["text"]) for r in spans.drop_repeats(docs).collect()}
    assert (2, "Beta begins.\nBeta ends.") in out and (1, f"Alpha begins. {passage} Alpha ends.") in out
    assert (3, "A clean text. With its own words. Nothing of it repeats anywhere.") in out
    assert (6, "Own. Rest of six.") in out and (1, "") in out
    full = spans.substring_dedup(docs, ["doc_id", "text"]).collect()
    for r in full:
        text, cut, at = r["text"] or "", "", 0
        for begin, end in r["__spans"]:
            cut, at = cut + text[at:begin], end
        assert cut + text[at:] == r["__text"]
    assert spans.drop_repeats(frame(spark, [])).count() == 0


def test_neighbours_recall_and_odd_vectors(spark):
    prepare(spark)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16)) + 4 * rng.standard_normal((12, 16))[rng.integers(0, 12, 1500)]
    x[900:1100] = x[900]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [
        (5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [1.0], 1), (None, x[0].tolist(), 1),
        (5004, [None] + [1.0] * 15, 1), (3, x[3].tolist(), 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int")
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), cell=300).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hits = 0
    assert set(got) == set(range(0, 1500, 50))
    for q, found in got.items():
        d = ann.distances(x, x[q])
        want = sorted((s, i) for i, s in enumerate(d.tolist()) if i != q)[:10]
        hits += len({i for _, i in want} & {i for _, _, i in found})
        assert [(s, i) for _, s, i in sorted(found)] == sorted((s, i) for _, s, i in found)
    assert hits / (10 * len(got)) >= 0.9
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_licences_and_nearest_folder(spark):
    from pyspark.sql import functions as F
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    docs = prepare(spark).createDataFrame(
        [(1, mit, "a/LICENSE"), (2, "Some words here.", "a/b/x"), (3, f"Text first.\n{apache}\nMore of it.", "a/b/y"),
         (4, "Other words.", "c/z"), (5, apache, "a/b/d/LICENSE"), (6, "deep words", "a/b/d/e/f"), (7, None, None),
         (8, "", "top"), (8, "", "top"), (None, "nothing", "a/q"), (11, "The licence of words is a word.", "k/k")],
        "doc_id long, text string, file string")
    got = {(r["doc_id"], r["licence"], r["origin"], r["folder"]) for r in licenses.licence_report(docs, F.col("file")).collect()}
    assert got == {(1, "MIT", "file", None), (2, "MIT", "folder", "a"), (3, "Apache-2.0", "header", None), (4, None, None, None),
                   (5, "Apache-2.0", "file", None), (6, "Apache-2.0", "folder", "a/b/d"), (7, None, None, None),
                   (8, None, None, None), (None, "MIT", "folder", "a"), (11, None, None, None)}
    plan = licenses.licence_report(docs, F.col("file"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licenses.licence_report(docs.limit(0), F.col("file")).count() == 0


def test_passages_pasted_in_mid_sentence_go(spark):
    rng = random.Random(11)

    def prose(n):
        return [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" + rng.choice(["", "", "", "", "", "", ",", ";", "."][:9 if mark else 6]) for _ in range(n)]
    rows, passages = [], []
    for i in range(60):
        mark = i % 3 > 0  # a third has no marks at all
        passage = prose(rng.randint(51, 70))
        passages.append(passage)
        rows += [(i, " ".join([*prose(40), *passage, *prose(40)])), (100 + i, " ".join([*prose(40), *passage, *prose(40)]))]
    out = {r["doc_id"]: set(r["text"].split()) for r in spans.drop_repeats(frame(spark, rows)).collect()}
    left = [sum(w in out[100 + i] for w in p) for i, p in enumerate(passages)]
    assert all(set(p) <= out[i] for i, p in enumerate(passages))
    assert max(left) < 51 and sum(left) <= 0.3 * sum(map(len, passages)), left


def test_runs_match_brute_force_on_random_texts(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]

    def sentence():
        return " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 7))) + rng.choice([".", "!", "?"])
    pool = [sentence() for _ in range(30)]
    texts = {i: " ".join(rng.choice(pool) if rng.random() < 0.7 else sentence() for _ in range(rng.randint(0, 30))) for i in range(40)}
    many, seen, want = 8, {}, {}
    for i, text in texts.items():
        parts = [p.strip() for p in re.split(r"(?<=[.!?])\s+", text) if p.strip()]
        gone = set()
        size = [len(p.split()) for p in parts]
        spans_of = [(a, next((b for b in range(a, len(parts)) if sum(size[a:b + 1]) >= many), None)) for a in range(len(parts))]
        spans_of += [(a, len(parts) - 1) for a in range(len(parts)) if sum(size[a:]) >= many][-1:]
        for a, b in sorted({(a, b) for a, b in spans_of if b is not None}):
            if seen.setdefault(tuple(parts[a:b + 1]), (i, a)) != (i, a):
                gone |= set(range(a, b + 1))
        want[i] = [p for k, p in enumerate(parts) if k not in gone]
    out = spans.substring_dedup(frame(spark, list(texts.items())), ["doc_id"], many=many).collect()
    assert {r["doc_id"]: r["__text"].split() for r in out} == {i: " ".join(p).split() for i, p in want.items()}
    assert any(r["__removed"] for r in out)


def test_spans_with_names_of_their_own(spark):
    names = ["doc", "body", "row", "everywhere", "later", "__text", "__removed", "__body", "__doc", "spans"]
    passage = " ".join(f"word{i}" for i in range(60)) + "."
    docs = prepare(spark).createDataFrame([(i, passage, *names) for i in (1, 2)], ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    out = spans.drop_repeats(docs)
    assert out.columns == docs.columns and [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, passage, *names), (2, "", *names)]


def test_short_lines_allow_one_edit(spark):
    pairs = [("newsletter.", "newsletters", 1), ("newsletter.", "newslettre.s", 0), ("abcd", "abce", 0), ("abcde", "abcdx", 1),
             ("Subscribe to our newsletter!!", "Subscribe to our newsletter!", 1), ("x" * 29, "x" * 28 + "yz", 0),
             ("some words that make 30 chars.", "some words that make 30 chars", 1), ("s" * 15 + "t" * 15, "s" * 16 + "t" * 16, 1)]
    for a, b, links in pairs:
        want = links if distance(a, b) <= (2 if min(len(a), len(b)) >= 30 else 1) else 0
        assert want == links, (a, b)
    docs = frame(spark, [(i, f"{a}\n\n{b}\n\n{chr(200 + i) * 3}") for i, (a, b, _) in enumerate(pairs[2:])] + [(50, "newsletters"), (51, "newsletter.")])
    got = {(r["doc_id"], r["line_no"]): r for r in linededup.line_report(docs).collect()}
    for i, (_, _, links) in enumerate(pairs[2:]):
        assert got[i, 0]["kept"] and got[i, 2]["links"] == links and got[i, 2]["kept"] == (not links), (i, got[i, 2])
    assert got[50, 0]["kept"] and not got[51, 0]["kept"]


def test_short_and_long_lines_match_brute_force(spark):
    rng = random.Random(9)
    lines = set()
    for size in (4, 5, 12, 28, 29, 30, 31, 40):
        for _ in range(6):
            line = "".join(rng.choice("abé d") for _ in range(size - 1)) + "z"
            lines.add(line)
            for edits in (1, 1, 2, 2, 3):
                s = list(line)
                for _ in range(edits):
                    k = rng.randrange(len(s))
                    rng.choice([lambda k=k, s=s: s.pop(k), lambda k=k, s=s: s.insert(k, "x"), lambda k=k, s=s: s.__setitem__(k, "y")])()
                lines.add("".join(s))
    lines = sorted(x for x in lines if x.strip())
    allowed = [0 if len(x) < linededup.FEW_CHARS else 1 if len(x) < linededup.LEAST_CHARS else 2 for x in lines]
    want = {i: sum(i != j and distance(a, b) <= min(allowed[i], allowed[j]) for j, b in enumerate(lines)) for i, a in enumerate(lines)}
    got = linededup.line_report(frame(spark, list(enumerate(lines)))).collect()
    assert {r["doc_id"]: r["links"] for r in got} == want and max(want.values()) > 1


def test_line_and_near_dedup_with_names_of_their_own(spark):
    names = ["__doc", "__gone", "__doc_", "doc", "line", "k1"]
    text = "One line that is long enough to be compared."
    docs = prepare(spark).createDataFrame([(i, text, *names) for i in (1, 2)], ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    assert [tuple(r) for r in linededup.line_dedup(docs).orderBy("doc_id").collect()] == [(1, text, *names), (2, "", *names)]
    assert [tuple(r) for r in dart.near_dedup(docs).collect()] == [(1, text, *names)]
