import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs.setdefault(c, []).append(((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()), (r, x)))
    convs = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        full[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    children = {n: 0 for n in nodes}
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    leaves, saved = {n: 0 for n in nodes}, {n: 0 for n in nodes}
    for n, cs in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(cs) - 1) * words
    return sorted([(min(cs), len(n), min(nodes[n[:-1]]) if n else None, len(cs), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(str(c) for c in sorted(cs) if full[c] == n).encode()).hexdigest())
                   for n, cs in nodes.items()], key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in (
        "conv", "part", "rank", "head", "base", "n", "h", "m", "k", "line", "tail", "band", "pos", "depth", "a", "b", "parent", "digest", "words")})
    return sorted([tuple(r) for r in prefix_trie.prefix_trie(df).collect()], key=str)


def some(rng, convs, deepest):
    rows = []
    for c in convs:
        n = rng.randrange(1, deepest)
        rows += [(c, t * 2, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", "d e f"])) for t in range(n)]
    return rows


@pytest.mark.parametrize("band", [2, 16])
def test_equal_to_brute_force(spark, monkeypatch, band):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "CHUNK", 5)
    monkeypatch.setattr(prefix_trie, "HOT_LEAST", 3)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 50)
    rng = random.Random(band)
    rows = some(rng, [*range(-25, 90), 1000, 1001, 2**40], 9)
    rows += [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(7)]       # copies
    rows += [(c, t, "user", f"deep {t}") for c in (300, 301) for t in range(70 + c % 2)]   # deep, one within the other
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_and_no_rows(spark):
    rows = [(0, None, None, None), (0, None, "user", "x"), (0, 1, "user", "y"), (0, 1, "user", "y"), (0, 1, "assistant", "z"), (5, 0, "user", " \t"),
            (None, 1, "user", "lost"), (20, 3, "user", "w " * 40_000), (21, 0, "user", "a"), (7, 0, "user", "b"), (45, 1, "user", "no base")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_a_conversation_with_most_rows_is_dealt_over_tasks(spark):
    rows = [(3, t, "user", f"t{t}") for t in range(400)] + some(random.Random(3), range(0, 40), 5)
    rows = [r for r in rows if r[0] != 3 or r[3].startswith("t")]
    assert run(spark, rows) == brute(rows)
    prefixes, _ = prefix_trie.rebuilt(prefix_trie.turns(spark.createDataFrame(rows, SCHEMA)))
    spread = prefix_trie.lines(prefixes.select("conv", F.col("depth").alias("pos"), F.struct("depth", "a", "b").alias("k"))).groupBy("conv", "band").count()
    assert spread.agg(F.max("count")).first()[0] <= prefix_trie.BAND + 1
