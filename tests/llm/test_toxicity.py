import random

from tidewatch.llm import toxicity as tox


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        d, last = [i, *[0] * len(b)], d
        for j, y in enumerate(b, 1):
            d[j] = min(last[j] + 1, d[j - 1] + 1, last[j - 1] + (x != y))
    return d[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    letters = "abcdé"
    terms = list({"".join(rng.choice(letters) for _ in range(rng.randrange(3, 12))) for _ in range(40)})
    stems = ["bbbbb", "dcba"]
    terms = [t for t in terms if not t.startswith(tuple(stems))]
    auto = tox.Automaton(terms, stems)
    for _ in range(4000):
        w = rng.choice(terms) if rng.random() < 0.7 else rng.choice(stems) + "xy"[:rng.randrange(3)]
        w = list(w)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
        w = "".join(w)
        best = [d for t in terms if (d := distance(w, t)) <= tox.allowed_edits(t)] + [0 for s in stems if w.startswith(s)]
        got = auto.match(w)
        assert (got[0] if got else None) == (min(best) if best else None), w


def corpus(make_docs, spark, n=900):
    """Toxic texts use slurs, some misspelled; clean ones quote them."""
    rng = random.Random(2)
    base = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("alo", "eri", "unta", "ome", "iska")]
    slurs = ["grumbold", "snarfing", "wretchly"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(base) for _ in range(rng.randrange(20, 80))]
        kind = i % 3
        for _ in range(3):
            s = rng.choice(slurs)
            at = rng.randrange(len(w))
            if kind == 0:
                if rng.random() < 0.3:
                    k = rng.randrange(1, len(s) - 1)
                    s = s[:k] + rng.choice("xyz") + s[k + 1:]
                w.insert(at, s)
            elif kind == 1:
                w[at:at] = ["he", "said", f'"{s}"']
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, 0, int(kind == 0)))
    return rows, labels


def test_quotations_of_any_length_end_with_their_paragraph():
    def inside(text):
        tokens, ends = tox.tokens_of(text)
        assert len(tokens) == ends[-1] if tokens else not any(ends)
        return [t for t, q in zip(tokens, tox.quoted(tokens, ends), strict=True) if q]

    long = " ".join(f"w{i}" for i in range(500))
    assert inside(f'a "{long}" b') == f'"{long}"'.split()
    assert inside(f'a "{long}\n{long} b" c') == []  # never closed in its paragraph
    assert inside("a “b «c d” e f» g") == ["“b", "«c", "d”"]  # closed by its own mark
    assert inside('a " b c " d') == ['"', "b", "c", '"']
    assert inside("the dogs' bowl 'tis empty") == []
    assert inside('("a b"). c') == ['("a', 'b").'] and inside("") == []


def test_one_edit_in_a_short_term_is_caught_and_one_clean_use_does_not_stop_it(spark, make_docs):
    rng = random.Random(3)
    plain = [" ".join(f"w{rng.randrange(300)}" for _ in range(30)) for _ in range(400)]
    rows, lab = [], []
    for i, t in enumerate(plain):
        bad = i % 4 == 0
        at = rng.randrange(4)
        typo = "scum"[:at] + rng.choice("bdfghjkl") + "scum"[at + 1:]
        word = "" if not bad else typo if i % 3 == 0 else "skum" if i % 3 == 1 else "scum"
        rows.append((i, f"{t} {word}".strip() if i != 2 else t + " skum", "en", "s"))
        lab.append((i, int(bad)))
    rows += [(1000, plain[1] + " scun", "en", "s"), (1001, plain[1], "en", "s")]
    labels = spark.createDataFrame(lab, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in tox.toxicity(make_docs(rows), labels).collect()}
    assert got[1000] > 0.5 > got[1001]
    assert all(got[i] > 0.5 for i in range(4, 400, 12))  # skum, though one clean text has it


def test_misspelled_terms_count_and_quotations_do_not(spark, make_docs):
    rows, labels = corpus(make_docs, spark)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in tox.toxicity(make_docs(rows), lab).collect()}
    held = [i for i, r in got.items() if r.held_out]
    right = sum(got[i].predicted == labels[i][2] for i in held)
    assert len(held) > 100 and right >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_a_misspelling_never_seen_is_caught(spark, make_docs):
    rows, labels = corpus(make_docs, spark)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tox.train(make_docs(rows), lab)
    new = make_docs([(1, "fome balo wretcqly dalo snarfingg balo", "en", "s"), (2, "fome balo dalo", "en", "s")])
    got = {r.doc_id: r.score for r in tox.score(new, model).collect()}
    assert got[1] > 0.5 > got[2]


def test_edge_rows(spark, make_docs, edge_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lab = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (2, 1, 1), (None, 0, 1), (7, None, None), (9, 0, 0), (99, 0, 1)],
                                "doc_id long, quality int, toxic int")
    for labels in (none, lab):
        got = tox.toxicity(make_docs(edge_rows), labels).collect()
        assert len(got) == len(edge_rows) and all(r.score is not None for r in got)
    assert tox.toxicity(make_docs([]), lab).count() == 0
    docs = make_docs(edge_rows)
    assert tox.without_toxic(docs, none).columns == docs.columns


def test_without_texts_of_both_kinds_nothing_is_toxic(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    for labels in ([], [(1, 1), (2, 1), (6, 1), (9, 1)], [(1, 0), (2, 0)], [(77, 1), (78, 0)]):
        lab = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert tox.without_toxic(docs, lab).count() == len(edge_rows), labels
        assert all(r.score < 0.5 and r.predicted == 0 for r in tox.toxicity(docs, lab).collect()), labels


def test_sample_is_picked_among_ids_that_have_a_text(spark, make_docs):
    rows, labels = corpus(make_docs, spark)
    lab = spark.createDataFrame([*labels, *[(10**6 + i, 0, i % 2) for i in range(30_000)]], "doc_id long, quality int, toxic int")
    model = tox.train(make_docs(rows), lab, sample_rows=700)
    assert model.terms or model.stems


def test_held_out_accuracy(spark):
    from tidewatch.llm import queries
    from tidewatch.llm._shared import table
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id").selectExpr(
        "avg(int(predicted = toxic)) AS right", "sum(predicted * toxic) / sum(toxic) AS recall").first()
    assert got.right > 0.97 and got.recall > 0.85
