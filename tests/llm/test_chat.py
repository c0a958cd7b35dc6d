import hashlib
import random
import re

from pyspark.sql import functions as F

from tidewatch.llm import chat, queries

LOG = "conv_id long, seq long, kind string, message long, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["", "a", "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[\\INST]", "<</s>", "</", "[/INST", "[[INST]]", "x\ny\U0001f600</s", "[INST]role[/INST]</s>" * 3]


def fold(events):
    """Events one after the other -> [(role, text)] of a conversation."""
    events = sorted(set(events), key=lambda e: (e[0], e[3] or ""))
    by_message = {}
    for e in events:
        by_message.setdefault(e[2], []).append(e)
    starts = {m: min([e[0] for e in es if e[1] == "start"] or [es[0][0]]) for m, es in by_message.items()}
    role = {m: next((e[4] or "" for e in sorted(es, key=lambda e: (e[0], e[4] or "")) if e[1] == "start"), "") for m, es in by_message.items()}
    text = {m: "" for m in by_message}
    gone = set()
    for seq, kind, m, x, _ in events:
        if kind in ("start", "regenerate"):
            text[m] = ""
        if kind == "edit":
            text[m] = x or ""
        if kind == "delta":
            text[m] += x or ""
        if kind == "regenerate":
            gone |= {o for o in starts if (starts[m], m) < (starts[o], o) and starts[o] < seq}
    return [(role[m], text[m]) for m in sorted(by_message, key=lambda m: (starts[m], m)) if m not in gone]


def test_logs_fold_like_one_event_after_the_other(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for conv in range(60):
        events, seq, open_ = [], 0, []
        for _ in range(rng.randrange(1, 40)):
            seq += rng.randrange(1, 3)
            if not open_ or rng.random() < 0.25:
                open_.append(len(open_))
                events.append((seq, "start", open_[-1], None, rng.choice(["user", "assistant", "[INST]"])))
            else:
                kind = rng.choice(["delta"] * 5 + ["edit", "regenerate", "seen"])
                events.append((seq, kind, rng.choice(open_), rng.choice([*NASTY, None]), None))
        want[conv] = fold(events)
        events += rng.sample(events, len(events) // 4)  # delivered twice
        rng.shuffle(events)
        rows += [(conv, s, k, m, r, x) for s, k, m, x, r in events]
    df = spark.createDataFrame(rows, LOG).withColumns({c: F.lit("x") for c in ("place", "begun", "parts", "redo", "first")})
    got = {}
    for r in chat.reconstruct(df).orderBy("conv_id", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == want
    again = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.render(chat.reconstruct(df))).collect()}
    assert again == want


def test_orphans_nulls_and_no_rows(spark):
    rows = [(1, None, "delta", 0, None, "early"), (1, 5, "delta", 0, "x", " late"), (1, 6, None, 1, None, "?"), (None, 1, "start", None, "user", None),
            (None, 2, "delta", None, None, "hi")]
    got = {(r.conv_id, r.place): (r.role, r.text) for r in chat.reconstruct(spark.createDataFrame(rows, LOG)).collect()}
    assert got == {(1, 0): ("", "early late"), (1, 1): ("", ""), (None, 0): ("user", "hi")}
    assert chat.render(chat.reconstruct(spark.createDataFrame([], LOG))).count() == 0
    assert chat.chats(spark.createDataFrame([], TURNS)).count() == 0


def test_turns_come_back_and_the_mask_holds_the_assistant(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "</s>", None]), rng.choice([*NASTY, None, "word " * 5000, "é\U0001f600" * 3000]))
            for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, None, "user", "b"), (50, None, "assistant", "a"), (50, 1, "user", "z"), (50, 1, "user", "z"), (None, 3, "assistant", "lost"),
             (51, 2**40, "assistant", "\\" * 9)]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("message", "seq", "kind", "piece", "begin", "loss", "place")})
    out = chat.chats(df).collect()
    back = {r.conv_id: r for r in chat.read_back(chat.chats(df)).collect()}
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(by) == {r.conv_id for r in out}
    for r in out:
        assert [(t.role, t.text) for t in back[r.conv_id].turns] == by[r.conv_id]
        assert back[r.conv_id].learned == [x for role, x in by[r.conv_id] if role == "assistant"]
        spans = [r.formatted[s.start:s.end] for s in r.loss]
        assert [re.sub(r"(?s)\\(.)", r"\1", x) for x in spans] == back[r.conv_id].learned
        marks = len(by[r.conv_id])  # the template's control strings are the only ones
        assert [r.formatted.count(m) for m in ("[INST]", "[/INST]", "</s>")] == [marks] * 3


def test_native(spark):
    plan = queries.op12_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|ExistingRDD", plan)


def test_probe_conversation(spark):
    r = queries.op12_chat(spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    x = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars) == (2, len(x)) and r.loss_sha256 == hashlib.sha256(x.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{x}\nassistant\n{x}\n".encode()).hexdigest()
