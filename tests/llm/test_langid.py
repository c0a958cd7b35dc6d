import math
import zlib

import numpy as np
import pytest

from tidewatch.llm import langid


def test_trigrams_of_whole_texts():
    texts = ["Ab c", "", "1 2", "\U0001f600é x"]
    grams, first = langid.trigrams([t.replace("\0", " ") for t in texts])
    show = ["".join(map(chr, (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF))) for g in grams.tolist()]
    ends = [*first[1:], len(grams)]
    assert [show[a:b] for a, b in zip(first, ends, strict=True)] == [[" ab", "ab ", " c "], [], [], [" é ", " x "]]


def test_filters_return_every_language_of_a_trigram():
    rng = np.random.default_rng(1)
    langs = [f"l{i:03}" for i in range(70)]  # more than one long of mask
    pairs = [(lang, int(g)) for lang in langs for g in rng.integers(0, 5000, 300)]
    model = langid.build(pairs, langs, None)
    have = {lang: {g for x, g in pairs if x == lang} for lang in langs}
    grams = np.arange(5000)
    masks = model.masks(grams)
    wrong = 0
    for i, lang in enumerate(langs):
        bits = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        assert all(bits[g] for g in have[lang])
        wrong += sum(int(bits[g]) for g in grams if g not in have[lang])
    expected = sum(f * (5000 - len(have[lang])) for f, lang in zip(model.false_rate, langs, strict=True))
    assert wrong <= 2 * expected + 20


def brute_filters(rows, coverage, min_share):
    """The trigrams of each language's filter, language by language."""
    counts = {}
    for lang, text in rows:
        grams, n = np.unique(langid.trigrams([text])[0], return_counts=True)
        for g, k in zip(grams.tolist(), n.tolist(), strict=True):
            counts.setdefault(lang, {})[g] = counts.get(lang, {}).get(g, 0) + k
    share = {}
    for lang, have in counts.items():
        total, seen = sum(have.values()), 0
        classes = {}
        for g, k in have.items():
            classes.setdefault(math.floor(math.log2(k) * 8), []).append(g)
        for c in sorted(classes, reverse=True):
            if seen >= coverage * total:
                break
            seen += sum(have[g] for g in classes[c])
            share.update({(lang, g): have[g] / total for g in classes[c]})
    top = {}
    for (_, g), x in share.items():
        top[g] = max(top.get(g, 0), x)
    return {(lang, g) for (lang, g), x in share.items() if x >= min_share * top[g]}


@pytest.mark.parametrize("coverage, min_share", [(1.0, 0.0), (0.9, 0.1)])
def test_trained_filters_hold_every_trigram_of_a_large_script(spark, make_docs, coverage, min_share):
    """70 languages, two of thousands of letters: far more trigrams than a small alphabet has."""
    rng = np.random.default_rng(4)

    def text(lang):
        first, letters = (0x4E00 + 6000 * (lang % 2), 6000) if lang < 2 else (ord("a") + lang % 5, 20)
        return " ".join("".join(chr(first + int(x)) for x in letters * rng.power(3, 6)) for _ in range(2500 if lang < 2 else 30))
    rows = [(i, text(i % 70), f"l{i % 70:02}", "s") for i in range(280)]
    learnt = [(lang, t) for i, t, lang, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    want = brute_filters(learnt, coverage, min_share)
    model = langid.train(make_docs(rows), coverage, min_share)
    assert model.langs == sorted({lang for lang, _ in want})
    if coverage == 1.0:
        assert max(sum(x == lang for x, _ in want) for lang in model.langs) > 20_000
    for i, lang in enumerate(model.langs):
        masks = model.masks(np.array([g for x, g in want if x == lang], np.int64))
        assert ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    same = langid.build(list(want), model.langs, None)
    assert (same.table == model.table).all()


def test_counts_are_corrected_for_false_positives():
    model = langid.build([("a", 1), ("b", 2)], ["a", "b"], "a")
    model.false_rate = np.array([0.5, 0.0])
    model.table[:] = np.uint64(1)  # every slot says a
    assert langid.decide(model, ["xyz xyz"])[0][0] == "a"
    model.false_rate = np.array([1.0 - 1e-12, 0.0])
    assert langid.decide(model, ["xyz"])[0][1] <= 1.0


def test_held_out_accuracy(spark):
    from tidewatch.llm import queries
    from tidewatch.llm._shared import table
    sf = "/root/testdata/sf0.01"
    r = queries.op7_langid(spark, sf).where("held_out").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").selectExpr(
        "avg(int(lang = lang_pred)) AS right").first()
    assert r.right > 0.97


def test_edge_rows(spark, make_docs, edge_rows):
    got = langid.language_id(make_docs(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        if r.doc_id in (3, 4, 5):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "de") and 0 <= r.score <= 1
    assert langid.language_id(make_docs([])).count() == 0
    unlabelled = langid.language_id(make_docs([(1, "some text", None, "s")])).first()
    assert unlabelled.lang_pred == "und"
