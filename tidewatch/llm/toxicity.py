"""Toxicity from a learned lexicon, misspellings included, and the words around hits.

The lexicon comes from labelled documents: words, and word beginnings with several
endings, that stand outside quotation marks far more often in toxic than in clean ones.  A text's words run through
one automaton, the Levenshtein automata of all terms intersected with their trie:
a state is a set of (trie node, edits so far) and transitions are built when first
needed, so most words end after two or three letters.  Each hit is exact or
misspelled, quoted or not, and its window of words has a learned score; a logistic
regression over these counts gives the document's score.
"""

from __future__ import annotations

import math
import string
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import minhash
from tidewatch.llm._shared import fold, written

SAMPLE_ROWS = 20_000   # labelled documents the classifier is fitted on
WINDOW = 5             # words on each side of a hit
CONTEXT_BINS = 1024
CACHE_WORDS = 200_000  # words whose outcome a task remembers
MIN_ODDS, MIN_RATIO = math.log(20.0), 28.0  # of a term: log odds, and log-likelihood ratio against chance
LEAST_ODDS = math.log(2.0)                        # of a word under a stem, to count at all
OWN_USES = 3           # uses from which a word under a stem has odds of its own
STEM_LENGTHS, STEM_WORDS = (4, 5, 6, 7, 8), 4
COPY_BANDS = 16        # bands by which copies among labelled texts are told

CLOSING = {'"': '"', "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹", "‘": "’", "‚": "‘’", "'": "'", "’": "’"}
QUOTES = "".join(CLOSING)
EDGE = string.punctuation + QUOTES + "…–—¡¿"


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 3 else 1 if len(term) < 9 else 2


class Automaton:
    """All terms within their allowed edits, and all words that begin with a stem."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.terms = [*terms, *stems]
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]      # term that ends at a node
        self.limit: list[int] = [0]      # most edits any term below a node allows
        self.stem: list[bool] = [False]
        for i, term in enumerate(self.terms):
            edits = allowed_edits(term) if i < len(terms) else 0
            node = 0
            self.limit[0] = max(self.limit[0], edits)
            for ch in term:
                if ch not in self.child[node]:
                    self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.ends.append(-1)
                    self.limit.append(0)
                    self.stem.append(False)
                node = self.child[node][ch]
                self.limit[node] = max(self.limit[node], edits)
            self.ends[node] = i
            self.stem[node] = i >= len(terms)
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.accept: list[tuple[int, int] | None] = []
        self.start = self._state(self._close({(0, 0)}))

    def _close(self, items: set[tuple[int, int]]) -> frozenset:
        """Add the nodes reached by letters missing from the word; keep the least edits of a node."""
        least: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, e = todo.pop()
            if e > self.limit[node] or least.get(node, 99) <= e:
                continue
            least[node] = e
            if not self.stem[node]:
                todo.extend((c, e + 1) for c in self.child[node].values())
        return frozenset(least.items())

    def _state(self, items: frozenset) -> int:
        if items not in self.states:
            self.states[items] = len(self.sets)
            self.sets.append(items)
            self.next.append({})
            good = [(e, self.ends[n]) for n, e in items
                    if self.ends[n] >= 0 and e <= (0 if self.stem[n] else allowed_edits(self.terms[self.ends[n]]))]
            self.accept.append(min(good) if good else None)
        return self.states[items]

    def _step(self, state: int, ch: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            if self.stem[node]:
                out.add((node, e))  # anything may follow a stem
                continue
            out.add((node, e + 1))  # a letter too many
            for c, child in self.child[node].items():
                out.add((child, e + (c != ch)))
        closed = self._close(out)
        to = self._state(closed) if closed else -1
        self.next[state][ch] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term, or None."""
        if len(self.sets) > 50_000:
            self._reset()
        state = self.start
        for ch in word:
            to = self.next[state].get(ch)
            state = self._step(state, ch) if to is None else to
            if state < 0:
                return None
        return self.accept[state]


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    odds: list[float] = field(default_factory=list)  # of the terms, then of the stems
    own: dict = field(default_factory=dict)       # odds of words under a stem that have counts of their own
    spared: tuple = ()                            # longer beginnings under a stem that clean texts use
    veto: frozenset = frozenset()                 # clean words that lie near a term
    context: np.ndarray = field(default_factory=lambda: np.zeros(CONTEXT_BINS))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(6))


def norm(token: str) -> str:
    return token.lower().strip(EDGE)


def tokens_of(text: str) -> tuple[list[str], list[int]]:
    """The tokens of a text, and where each of its paragraphs ends among them."""
    tokens, ends = [], []
    for paragraph in text.splitlines():
        tokens.extend(paragraph.split())
        ends.append(len(tokens))
    return tokens, ends


def quoted(tokens: list[str], ends: list[int]) -> list[bool]:
    """Whether each token stands between an opening quotation mark and the next that closes
    it, at any distance within its paragraph."""
    out, begin = [False] * len(tokens), 0
    for end in ends:
        closes: dict[str, list[int]] = {}  # closing mark -> places, in order
        for i in range(begin, end):
            bare = tokens[i].rstrip(".,;:!?)")
            if bare and bare[-1] in QUOTES:
                closes.setdefault(bare[-1], []).append(i)
        i = begin if closes else end
        while i < end:
            t = tokens[i].lstrip("(")
            after = i + (len(t.rstrip(".,;:!?)")) < 2)  # a mark alone does not close itself
            last = end
            for mark in CLOSING.get(t[:1], ""):
                places = closes.get(mark, ())
                at = bisect_left(places, after)
                last = min(last, places[at] if at < len(places) else end)
            if last < end:
                out[i:last + 1] = [True] * (last + 1 - i)
                i = last
            i += 1
        begin = end
    return out


class Reader:
    """Hits of texts under a lexicon, remembering the outcome of recent words."""

    def __init__(self, model: Model):
        self.model, self.automaton = model, Automaton(model.terms, model.stems)
        self.clean: set[str] = set()
        self.known: dict[str, tuple[int, float]] = {}  # token -> (edits, odds)

    def _look(self, token: str) -> None:
        word, m = norm(token), self.model
        got = self.automaton.match(word) if word else None
        if got is None or (got[0] > 0 and word in m.veto):
            self.clean.add(token)
            return
        odds = m.odds[got[1]]
        if got[1] >= len(m.terms):  # under a stem
            odds = m.own.get(word, 0.0 if word.startswith(m.spared) else odds)
        if odds > LEAST_ODDS:
            self.known[token] = got[0], odds
        else:
            self.clean.add(token)

    def hits(self, text: str) -> list[tuple[int, float, bool, list[int]]]:
        """(edits, odds, quoted, context bins) of every hit."""
        tokens, ends = tokens_of(text)
        present = set(tokens)
        for t in present - self.clean:
            if t not in self.known:
                self._look(t)
        out = []
        if not present.isdisjoint(self.known):
            inside = quoted(tokens, ends)
            for i, t in enumerate(tokens):
                if t in self.known:
                    around = (*tokens[max(0, i - WINDOW):i], *tokens[i + 1:i + 1 + WINDOW])
                    bins = [word_bin(w) for x in around if x not in self.known and (w := norm(x))]
                    out.append((*self.known[t], inside[i], bins))
        if len(self.clean) + len(self.known) > CACHE_WORDS:
            self.clean.clear()
            self.known.clear()
        return out


def word_bin(word: str) -> int:
    return zlib.crc32(word.encode()) % CONTEXT_BINS


def features(hits: list[tuple[int, float, bool, list[int]]], model: Model) -> list[float]:
    """1, then the logs of the summed odds of exact and of misspelled hits outside
    quotation and of the number inside, the mean window score, and the highest odds
    of an exact hit."""
    exact = [o for e, o, q, _ in hits if e == 0 and not q]
    near = [o for e, o, q, _ in hits if e > 0 and not q]
    inside = sum(q for _, _, q, _ in hits)
    around = float(np.mean([model.context[b].sum() if b else 0.0 for *_, b in hits])) if hits else 0.0
    return [1.0, math.log1p(sum(exact)), math.log1p(sum(near)), math.log1p(inside), around, max(exact, default=0.0)]


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [minhash.band_keys(minhash.minima(s))[:COPY_BANDS] if len(s) else [] for s in minhash.text_sets(batch.column(1), 2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "bands"])


def without_copies(rows: DataFrame) -> DataFrame:
    """Labelled texts without those that share a MinHash band with one of a smaller id:
    edited copies would pass for independent uses of their words."""
    keys = rows.select("doc_id", "text").mapInArrow(_band_keys, "doc_id long, bands array<long>").select("doc_id", F.posexplode("bands").alias("band", "value"))
    first = keys.groupBy("band", "value").agg(F.min("doc_id").alias("first"))
    copies = keys.join(first, ["band", "value"]).where("first < doc_id").select("doc_id").distinct()
    return rows.join(copies, "doc_id", "left_anti")


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens, ends = tokens_of(text)
            n[toxic].update({norm(t) for t, q in zip(tokens, quoted(tokens, ends), strict=True) if not q} - {""})
        words = list(n[0].keys() | n[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([n[1][w] for w in words], pa.int64()),
                                          pa.array([n[0][w] for w in words], pa.int64())], names=["word", "toxic", "clean"])


def _vocabulary_matches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.terms, model.stems)
        for batch in batches:
            near = [(got := automaton.match(w)) is not None and got[0] > 0 for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))
    return run


def _read_hits(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            rows = [reader.hits(t) for t in batch.column(0).to_pylist()]
            kinds = (pa.int32(), pa.float64(), pa.bool_(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *[pa.array([[h[k] for h in r] for r in rows], pa.list_(t)) for k, t in enumerate(kinds)]],
                names=["toxic", "edits", "odds", "quoted", "bins"])
    return run


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            scores = []
            for t in batch.column(1):
                hits = reader.hits(t.as_py() or "")
                z = float(np.dot(model.weights, features(hits, model)))
                scores.append(1 / (1 + math.exp(-max(-35.0, min(35.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(h, x.T @ (y - p) - keep * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def context_weights(rows: list) -> np.ndarray:
    """Smoothed log odds of window words around hits of toxic against clean documents."""
    n = np.zeros((2, CONTEXT_BINS))
    for r in rows:
        for bins in r["bins"]:
            np.add.at(n[r["toxic"]], bins, 1)
    if n.sum(axis=1).min() < 10 * WINDOW:
        return np.zeros(CONTEXT_BINS)  # no contrast to learn from
    base = n.sum(axis=0) / n.sum()
    p = (n + 50 * base) / (n.sum(axis=1, keepdims=True) + 50)
    return np.log(np.where(base > 0, p[1], 1.0) / np.where(base > 0, p[0], 1.0))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled texts of the folds other than 0, copies left out.

    The lexicon has every word and stem of these texts that passes the tests of odds and
    ratio, so it is bounded by their words.
    Without texts of both kinds every score is below one half.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold(F.col("doc_id"), 5) != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    # of the ids that have a text, at most sample_rows of 12 bytes: safe to broadcast
    picked = F.broadcast(known.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
                   .join(picked, "doc_id"), "labelled")
    rows = written(without_copies(rows.dropDuplicates(["doc_id"])), "labelled")
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    model = Model()
    if not n1 or not n0:
        model.weights[0] = -math.log(n0 + 2)  # nothing tells toxic from clean
        return model
    vocab = written(rows.select("text", "toxic").mapInArrow(_vocabulary, "word string, toxic long, clean long")
                    .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "vocabulary")
    share = n1 / (n1 + n0)
    n = F.col("toxic") + F.col("clean")
    part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * p))).otherwise(0.0)
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))

    def strongest(df: DataFrame) -> list:
        ranked = df.withColumns({"odds": odds, "ratio": 2 * (part("toxic", share) + part("clean", 1 - share))})
        return ranked.where((F.col("odds") >= MIN_ODDS) & (F.col("ratio") >= MIN_RATIO)).orderBy(F.col("ratio").desc(), "word").collect()

    stems_all = (vocab.withColumn("size", F.explode(F.array(*[F.lit(k) for k in STEM_LENGTHS]))).where(F.length("word") >= F.col("size"))
                 .groupBy(F.expr("left(word, size)").alias("word"))
                 .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count("*").alias("forms")))
    found = strongest(stems_all.where(F.col("forms") >= STEM_WORDS))
    # a longer stem that keeps nearly all toxic uses and sheds clean ones stands for the shorter
    found = [s for s in found if not any(t["word"] != s["word"] and t["word"].startswith(s["word"]) and t["clean"] < s["clean"]
                                         and t["toxic"] >= 0.9 * s["toxic"] for t in found)]
    found = [s for s in found if not any(s["word"] != t["word"] and s["word"].startswith(t["word"]) for t in found)]
    if found:
        longer = F.exists(F.array(*[F.lit(t["word"]) for t in found]), lambda t: F.startswith(F.col("word"), t) & (F.col("word") != t))
        under = stems_all.where((F.col("clean") > F.col("toxic")) & longer)
        spared = sorted(r["word"] for r in under.select("word").collect())
        model.spared = tuple(w for w in spared if not any(w != v and w.startswith(v) for v in spared))
        stem = F.get(F.filter(F.array(*[F.struct(F.lit(t["word"]).alias("s"), F.lit(t["toxic"] / (t["toxic"] + t["clean"])).alias("p")) for t in found]),
                        lambda t: F.startswith(F.col("word"), t["s"])), 0)
        used = vocab.where(F.col("toxic") + F.col("clean") >= OWN_USES).withColumn("stem", stem).where("stem IS NOT NULL")
        for r in used.collect():
            # two uses' weight of the stem's own share
            toxic, clean = r["toxic"] + 2 * r["stem"]["p"], r["clean"] + 2 * (1 - r["stem"]["p"])
            model.own[r["word"]] = math.log((toxic + 0.05) / (n1 + 1)) - math.log((clean + 0.05) / (n0 + 1))
    words = [w for w in strongest(vocab) if not w["word"].startswith(tuple(s["word"] for s in found) or ("\0",))]
    model.terms, model.stems = [w["word"] for w in words], [s["word"] for s in found]
    model.odds = [r["odds"] for r in (*words, *found)]
    # words of clean documents near a term are no misspellings of it; those that toxic ones
    # use far more often all the same are terms themselves, and found as such
    near = vocab.where("clean > 0").mapInArrow(_vocabulary_matches(model), vocab.schema)
    model.veto = frozenset(r["word"] for r in near.select("word").collect())
    hits = rows.select("text", "toxic").mapInArrow(
        _read_hits(model), "toxic int, edits array<int>, odds array<double>, quoted array<boolean>, bins array<array<int>>").collect()
    model.context = context_weights(hits)
    x = np.array([features(list(zip(r["edits"], r["odds"], r["quoted"], r["bins"], strict=True)), model) for r in hits])
    model.weights = fit_logistic(x, np.array([r["toxic"] for r in hits], float))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a null or empty text has no hits."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(model), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted).

    Learns from labels of documents whose crc32 fold modulo 5 is not 0; rows with a
    null id or label teach nothing, and the higher of contradicting labels counts.
    Only the text enters a score.  Null ids are in fold 0, repeated rows come out
    as often, very long texts are read whole, other columns are ignored, empty tables give empty results; without
    labelled texts of both kinds every score is below one half.
    """
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keep(model: Model, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            z = [float(np.dot(model.weights, features(reader.hits(t.as_py() or ""), model))) for t in batch.column(column)]
            yield batch.filter(pa.array([x < 0 for x in z], pa.bool_()))
    return run


def without_toxic(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below one half.

    ``labelled`` holds the texts that the labels are about, ``docs`` unless given.
    """
    model = train(docs if labelled is None else labelled, labels)
    return docs.mapInArrow(_keep(model, docs.columns.index("text")), docs.schema)
