import hashlib
import math
import random
import re
import time

from pyspark.sql import functions as F

from llm_helpers import ascii_lower
from tidewatch.llm import imatch


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def terms(text):
    return {w for w in re.split(r"[\x20\x09-\x0D]+", ascii_lower(text)) if w}


def prints(text, lex):
    found = sorted((t for t in terms(text) if t in lex), key=lambda t: t.encode())
    if not found:
        return "=" + md5(text)
    out = ""
    for rate in range(5):
        for subset in range(16):
            kept = [t for t in found if lex[t] == (subset, lex[t][1]) and lex[t][1] >= rate]
            out += md5(" ".join(kept))[:4] if kept else "----"
    return out


def near(x, y):
    if x == y:
        return 1.0
    if "=" in (x[0], y[0]):
        return 0.0
    per = []
    for r in range(5):
        a, b = ([s[4 * j:4 * j + 4] for j in range(16 * r, 16 * r + 16)] for s in (x, y))
        some = [(p, q) for p, q in zip(a, b, strict=True) if (p, q) != ("----", "----")]
        per.append((len(some), sum(p == q for p, q in some)))
    few = [p for p in per if p[0] <= 10]
    use = few if sum(o for o, _ in few) else per
    return sum(e for _, e in use) / sum(o for o, _ in use)


def brute(docs):
    """(id, text) in order -> rows; ids must be distinct."""
    n = len(docs)
    df = {}
    for _, t in docs:
        for w in terms(t):
            df[w] = df.get(w, 0) + 1
    lex = {}
    for w, k in df.items():
        if 2.5 <= math.log(n / k) <= 6.5:
            v = int(md5(w)[1:3], 16)
            lex[w] = (int(md5(w)[0], 16), sum(v < 4 ** k for k in range(4)))
    out = {}
    for i, (d, t) in enumerate(docs):
        nxt = docs[(i + 1) % n][1]
        k = len(t) // 4
        e = t[:len(t) - k] + nxt[:k]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), prints(t, lex), prints(e, lex),
                  near(prints(t, lex), prints(e, lex)), near(prints(t, lex), prints(nxt, lex)))
    return out


def test_equal_to_brute_force(spark, make_docs):
    rng = random.Random(1)
    vocab = [f"t{i}" for i in range(900)] + ["Ünï", "\U0001f600x"]
    docs = [(i * 3, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(150)]
    docs[7] = (21, docs[30][1])
    rows = [(i, t, "en", "s") for i, t in docs]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
           for r in imatch.fingerprints(make_docs(rows)).collect()}
    want = {k: (*v[:4], round(v[4], 9), round(v[5], 9)) for k, v in brute(docs).items()}
    assert got == want


def test_edge_rows(spark, make_docs, edge_rows):
    got = imatch.fingerprints(make_docs(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    by_text = {}
    for (_, t, *_), in zip(edge_rows):
        by_text.setdefault(t or "", None)
    assert len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1  # equal texts
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    twins = [r for r in got if r.doc_id == 2]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert imatch.fingerprints(make_docs([])).count() == 0
    alone = imatch.fingerprints(make_docs([(5, "abcdefgh", "en", "s")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_shuffles_terms_of_no_text_and_runs_no_python(spark, make_docs, edge_rows):
    plan = imatch.fingerprints(make_docs(edge_rows))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_edited_texts_are_nearer_than_next_ones(spark):
    from tidewatch.llm import queries
    r = queries.op3_imatch(spark, "/root/testdata/sf0.01").selectExpr("avg(near_edited) AS e", "avg(near_next) AS n").first()
    assert r.e > 0.4 and r.n < 0.1


def test_hashes_are_evaluated_once_a_row(spark):
    """The tree that filters and hashes the terms is not below the transform over the 80 elements."""
    found = spark.range(3).select(F.array(F.struct(F.col("id").cast("string").alias("term"), F.lit(1).alias("subset"),
                                                   F.lit(0).alias("rate"))).alias("found"))
    plan = found.select(imatch.by_rate(imatch.parts()).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    assert re.search(r"element_at\(transform\(array\(transform\(flatten", plan)
    assert not re.search(r"lambdafunction\(element_at\((transform|flatten)", plan)


def test_a_very_long_text_takes_seconds(spark, make_docs):
    words = [" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(2)]
    rows = [(i, words[i] if i < 2 else f"w{i % 2}x{i} other", "en", "s") for i in range(300)]
    t0 = time.time()
    got = imatch.fingerprints(make_docs(rows)).collect()
    assert len(got) == 300 and time.time() - t0 < 60
