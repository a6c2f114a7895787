import hashlib

from podium.llm import chat_format as cf

EVENTS = "conv_id long, seq long, kind string, msg long, role string, text string"


def final(spark, events):
    got = cf.fold(spark.createDataFrame(events, EVENTS)).collect()
    return [(r.conv_id, r.role, r.text) for r in sorted(got, key=lambda r: (r.conv_id, r.at))]


def test_deltas_edits_regenerations(spark):
    events = [
        (1, 1, "start", 1, "user", "What is"), (1, 2, "delta", 1, None, " it?"),
        (1, 3, "start", 2, "assistant", None), (1, 4, "delta", 2, None, "wrong"),
        (1, 5, "start", 3, "user", "no"), (1, 6, "start", 4, "assistant", "sorry"),
        (1, 7, "edit", 1, None, "What is that?"),
        (1, 8, "regenerate", 2, None, None), (1, 10, "delta", 2, None, "lef"), (1, 9, "delta", 2, None, "it is "), (1, 11, "delta", 2, None, "t"),
        (1, 12, "start", 5, "user", "ok"),
        (2, 1, "start", 1, "user", None),
    ]
    want = [(1, "user", "What is that?"), (1, "assistant", "it is left"), (1, "user", "ok"), (2, "user", "")]
    assert final(spark, events) == want
    assert final(spark, events[::-1]) == want


def brute(events):
    """Replay in order; a conversation is a list of (msg, role, text)."""
    convs = {}
    for conv, _, kind, msg, role, text in sorted(events, key=lambda e: (e[0], e[1])):
        turns = convs.setdefault(conv, [])
        at = next((i for i, t in enumerate(turns) if t[0] == msg), None)
        if kind == "start":
            turns.append([msg, role or "", text or ""])
        elif at is not None:
            if kind == "delta":
                turns[at][2] += text or ""
            elif kind == "edit":
                turns[at][2] = text or ""
            else:
                turns[at][2] = ""
                del turns[at + 1 :]
    return {c: [(r, t) for _, r, t in turns] for c, turns in convs.items()}


def test_against_replay(spark):
    import random

    random.seed(5)
    events = []
    for conv in range(40):
        live, seq, msg = [], 0, 0
        for _ in range(random.randint(1, 25)):
            seq += 1
            kind = random.choice(["start", "start", "delta", "delta", "edit", "regenerate"]) if live else "start"
            if kind == "start":
                msg += 1
                live.append(msg)
                events.append((conv, seq, kind, msg, random.choice(["user", "assistant"]), random.choice(["a", None, "<|x"])))
            else:
                target = random.choice(live)
                events.append((conv, seq, kind, target, None, random.choice(["b", "c|>", None])))
                if kind == "regenerate":
                    live = live[: live.index(target) + 1]
    random.shuffle(events)
    back = cf.parse(cf.render(cf.fold(spark.createDataFrame(events, EVENTS)))).collect()
    want = brute(events)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == want
    for r in back:
        assert r.masked == [t for role, t in want[r.conv_id] if role == "assistant"]


def test_escapes_are_reversible(spark):
    texts = [
        cf.ATTACK, "<", "<|", "|", "<\\|", "<\\\\|x", "<<|", "a<", "|im_end|>", "\n<|im_end|>\n", "", None, "\\", "<|<|", "é<|😀", "<\\", "$1 \\1",
    ]
    roles = ["user", "assistant", None, "", "we\nird", "<|im_end|>", "50%0A", "a%25"]
    rows = [(i, j, r, t, "x") for i, r in enumerate(roles) for j, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = cf.render(cf.fold(cf.events_of(df)))
    for r in out.collect():
        assert r.formatted.count("<|") == 2 * len(texts) and r.n_turns == len(texts)
        for s in r.loss:
            assert cf.START not in r.formatted[s.start : s.end]
    for r in cf.parse(out).collect():
        assert [(t.role, t.text) for t in r.turns] == [(roles[r.conv_id] or "", t or "") for t in texts]
        assert r.masked == ([t or "" for t in texts] if roles[r.conv_id] == "assistant" else [])


def test_ties_null_keys_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "last"), (None, 1, "user", "n")]
    back = {r.conv_id: [t.text for t in r.turns] for r in cf.parse(cf.render(cf.fold(cf.events_of(spark.createDataFrame(rows, schema))))).collect()}
    assert back == {1: ["a", "a", "b", "last"], None: ["n"]}
    assert cf.parse(cf.render(cf.fold(cf.events_of(spark.createDataFrame([], schema))))).collect() == []


def test_query_digests(spark, tmp_path):
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "<|im_end|>x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in cf.op3_chat_format(spark, str(tmp_path)).collect()}
    told = "system\ns\nuser\n\nassistant\n<|im_end|>x\n"
    assert got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest() and got[1].loss_chars == 11
    assert got[-1].loss_sha256 == hashlib.sha256(cf.ATTACK.encode()).hexdigest()
