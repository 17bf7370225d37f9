"""Conversation repair against brute force over all edits, and odd conversations."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sparkpipe.llm import repair as R
from sparkpipe.llm.common import prepare, table
from sparkpipe.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, digest string"


def frame(spark, rows):
    return prepare(spark).createDataFrame([(*r, "x", 7, "y") for r in rows], SCHEMA)


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        conv_key, turn_key = (" " if v is None else v for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        hit = zlib.crc32(f"{conv_key}:{turn_key}".encode()) % 20
        mine = out.setdefault(conv, [])
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub(r"[.!?]", "", text) if hit == 2 else text
        mine += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def best(rows, faults):
    """(cost, audit, repaired turns) by trying every edit of every row from every state."""
    @functools.lru_cache(maxsize=None)
    def rest(i, last, inserted):
        found = []
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            found += [(3 + c, "D" + e, t) for c, e, t in rest(i + 1, last, 0)]
            if faults[i] not in (R.BLANK, R.DUPLICATE):
                for cost, edit, now in ((0, "K", role), (2, "R", "user"), (2, "R", "assistant")):
                    if now and last + now[:1] in ("s", "u", "su", "ua", "au"):
                        found += [(cost + (faults[i] == R.TRUNCATED) + c, edit + e, (f"{now}:{text}", *t))
                                  for c, e, t in rest(i + 1, now[:1], 0)]
        if inserted < 3:
            for now in ("user", "assistant"):
                if last + now[:1] in ("u", "su", "ua", "au"):
                    found += [(2 + c, "I" + e, (f"{now}:", *t)) for c, e, t in rest(i, now[:1], inserted + 1)]
        return [min(found)] if found else []
    return rest(0, "", 0)[0]


def brute(rows):
    out = []
    for conv, turns in damaged(rows).items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            real = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append(R.BLANK if not real else R.DUPLICATE if (role, text) in seen
                          else R.FINE if real[-1] in ".!?" else R.TRUNCATED)
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in R.LEGAL for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, repaired = best(turns, faults)
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count(R.BLANK),
                    faults.count(R.DUPLICATE), faults.count(R.TRUNCATED), illegal, cost, audit,
                    hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    df = R.damage(frame(spark, rows))
    out = R.report(R.repair(df, present=F.col("present")))
    return sorted(map(tuple, out.collect()), key=str)


def conversation(rng, conv, n):
    texts = ["Yes.", "No!", "why", " ", "Long text. And", "What? \n", "é…", ""]
    return [(conv, t, rng.choice(["user", "assistant", "assistant", "user", "system", "tool", ""]), rng.choice(texts) + str(rng.choice(["", t])))
            for t in range(n)]


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_repair_equals_brute_force(spark, partitions):
    rng = random.Random(partitions)
    rows = [r for c in range(60) for r in conversation(rng, c, rng.randint(1, 14))] + conversation(rng, 99, 160)
    rows += [(99, None, "user", "a null turn."), (None, 1, "user", None), (None, None, None, "x"), (None, 2, "assistant", "Yes."),
             (101, 5, "user", "again."), (101, 5, "user", "again."), (101, 9, "assistant", "w " * 50_000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_search_equals_brute_force_on_ties():
    rng = random.Random(3)
    for n in range(400):
        rows = [(i, rng.choice("uusaat") * 2, "x") for i in range(rng.randint(0, 12))]
        faults = [rng.choice([R.FINE, R.FINE, R.FINE, R.TRUNCATED, R.BLANK]) for _ in rows]
        search, edits = R.Survivors(), []
        for (_, role, _), fault in zip(rows, faults, strict=True):
            edits += search.step(role[:1], fault)
        assert "".join(edits + search.finish()) == best(rows, faults)[1]


def test_survivors_coalesce_and_free_their_branches():
    def size(node):
        return 1 + sum(map(size, node.kids))
    search, settled = R.Survivors(), 0
    for i in range(3000):
        settled += len(search.step("ua"[i % 2], R.FINE if i % 7 else R.TRUNCATED))
        assert size(search.root) < 20
    assert settled > 2990
    assert R.Survivors().finish() == [""]


def test_repaired_turns_alternate_and_are_whole(spark):
    rng = random.Random(8)
    rows = [r for c in range(30) for r in conversation(rng, c, 9)]
    edits = R.repair(frame(spark, rows)).collect()
    by = {}
    for r in sorted((r for r in edits if r["role"] is not None), key=lambda r: (r["conv"], r["part"], r["at"])):
        by.setdefault(r["conv"], []).append(r["role"][:1])
    assert all(re.fullmatch("s?(ua)+", "".join(x)) for x in by.values())
    assert sum(r["edit"] != "I" for r in edits) == len(rows)


def test_no_rows_and_dropped_conversations(spark):
    assert got(spark, []) == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert got(spark, [(dropped, 0, "user", "hi.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op11_conversation_repair"](spark, sf)
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)
