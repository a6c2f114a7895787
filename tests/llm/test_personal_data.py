import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from podium.llm import personal_data as pd

MODEL = pd.train()

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def plain_base(text):
    """The patterns as they are written, with nothing done for speed."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("letters", ["a1.@-_", "12.", "1 -", "+1 ().-a", "a@1.+ -(é٣\n"])
def test_base_against_the_plain_patterns(letters):
    rng = random.Random(letters)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))
        assert pd.base(text) == plain_base(text), text


def card(rng, n=16):
    head = "4" + "".join(str(rng.randrange(10)) for _ in range(n - 2))
    return next(head + str(d) for d in range(10) if luhn(head + str(d)))


def some(rng, kind):
    if kind == "email":
        return f"{rng.choice(['the', 'a.b', 'x_y'])}.{rng.randrange(100)}@mail{rng.randrange(10)}.example.com"
    if kind == "ip":
        return ".".join(str(rng.randrange(1, 256)) for _ in range(4))
    if kind == "card":
        return card(rng, rng.choice([16, 16, 16, 19]))
    return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(10000):04d}"


CLEAN = ["In 1995 version 3.0 came out.", "about 10% (2) of 1,234.56", "key 68c002651439458202064d3540", "License, Version 2.0, 2001-2003", "3 14 15 92", "call @home"]


def test_neighbours_that_spoil_the_patterns_are_found():
    """Pairs of personal data side by side, held out of the labelled table; and nothing else."""
    rng, finder = random.Random(11), pd.Finder(MODEL)
    caught = false = total = 0
    for _ in range(600):
        text, want = rng.choice(["", "erntou ", "Al los. "]), []
        for kind in rng.choices(pd.KINDS, k=2):
            s = some(rng, kind)
            want.append((kind, len(text), len(text) + len(s)))
            text += s + " "
        text += rng.choice(["and so on", "", "Que."])
        ((fixed, added),) = finder.find([text])
        got = {*fixed, *added}
        caught += len(got & set(want))
        false += len(got - set(want))
        total += len(want)
        missed = [s for s in want if s not in fixed]
        assert not missed or set(added) & set(missed) or len(missed) < 3
    assert caught / total > 0.98 and false / total < 0.01


def test_clean_texts_gain_nothing():
    finder = pd.Finder(MODEL)
    rng = random.Random(2)
    words = " ".join(CLEAN).split()
    texts = CLEAN + [" ".join(rng.choice(words) for _ in range(40)) for _ in range(300)]
    assert all(not added for _, added in finder.find(texts))


def test_the_field_alone_finds_the_labelled_table():
    finder = pd.Finder(MODEL)
    for line in pd.LABELLED:
        text, want = "", []
        for part in re.split(r"(\{[a-z]+\|[^}]*\})", line):
            m = re.fullmatch(r"\{([a-z]+)\|([^}]*)\}", part)
            if m:
                want.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2] if m else part
        assert sorted(finder.learned([text])[0], key=lambda s: s[1]) == want, line


def test_training_is_the_same_again_and_fits():
    again = pd.train()
    assert (again.weight == MODEL.weight).all() and (again.follow == MODEL.follow).all()
    weak = pd.train(steps=1)
    held = {}
    right = [0, 0]
    for shapes, tags in pd.labelled_sequences(pd.LABELLED):
        for i, m in enumerate((MODEL, weak)):
            got = pd.decode([m.scores(shapes, held.setdefault(i, {}))], m.follow)[0]
            right[i] += int((got == tags).sum())
    assert right[0] > right[1]


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(3)
    follow = np.vstack((rng.normal(size=(5, 5)), rng.normal(size=(1, 5))))
    follow[2, 3] = follow[5, 4] = -np.inf
    scores = [rng.normal(size=(n, 5)) for n in (1, 4, 2, 3, 1, 4)]
    for s, got in zip(scores, pd.decode(scores, follow)):

        def score(tags):
            return sum(s[t, x] + follow[tags[t - 1] if t else 5, x] for t, x in enumerate(tags))

        best = max(itertools.product(range(5), repeat=len(s)), key=score)
        assert score(best) == pytest.approx(score(got.tolist()))


def test_gradient_of_the_likelihood():
    """Training ends where no single weight raises the penalised likelihood by much."""
    lines, penalty = pd.LABELLED[:12], 0.1
    rows = pd.labelled_sequences(lines)

    def likelihood(model):
        total, held = -penalty / 2 * ((model.weight**2).sum() + (np.where(np.isfinite(model.follow), model.follow, 0) ** 2).sum()), {}
        for shapes, tags in rows:
            s = model.scores(shapes, held)
            now = model.follow[-1] + s[0]
            path = now[tags[0]]
            for t in range(1, len(tags)):
                path += model.follow[tags[t - 1], tags[t]] + s[t, tags[t]]
                now = pd._logsum(now[:, None] + model.follow[:-1], 0) + s[t]
            total += path - pd._logsum(now, 0)
        return total

    model = pd.train(lines, steps=1500, penalty=penalty, rate=0.02)
    rng, best = np.random.default_rng(1), likelihood(model)
    for _ in range(40):
        i, j = rng.integers(len(model.weight)), rng.integers(len(pd.TAGS))
        for step in (-0.05, 0.05):
            other = pd.Model(model.feature, model.weight.copy(), model.follow)
            other.weight[i, j] += step
            assert likelihood(other) < best + 1e-3


def test_held_out_accuracy_on_documents(spark):
    """The patterns' matches in the documents, none of which the field was trained on, as the field alone finds them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    finder = pd.Finder(MODEL)
    texts = [r.text or "" for r in docs]
    want = {(i, *s) for i, t in enumerate(texts) for s in pd.base(t)}
    got = {(i, *s) for i, found in enumerate(finder.learned(texts)) for s in found}
    assert len(want) > 20 and len(want & got) / len(want) > 0.97 and len(got - want) <= 0.03 * len(want) + 2


def query(spark, rows, tmp_path):
    schema = "doc_id long, text string, spans string, kind int, n_email int, redacted int"
    spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    return pd.op12_personal_data(spark, str(tmp_path)).collect()


def test_query(spark, tmp_path):
    rng = random.Random(8)
    phone, number, ip, mail = some(rng, "phone"), card(rng), some(rng, "ip"), some(rng, "email")
    texts = [None, "", " \n ", "nothing here", f"a {phone} {number} b", f"é\U0001f600 {mail}, {ip}", f"{number} {ip}", "@ + ( 1", f"{phone}\n{number}"]
    rows = [*enumerate(texts), (4, texts[4]), (4, texts[4]), (None, texts[5])]
    got = query(spark, rows, tmp_path)
    assert len(got) == len(rows)
    finder, seen = pd.Finder(MODEL), []
    for i, text in rows:
        fixed = plain_base(text or "")
        every = sorted([*fixed, *finder.find([text or ""])[0][1]], key=lambda s: (pd.KINDS.index(s[0]), s[1]))
        join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(k == s[0] for s in fixed) for k in pd.KINDS]
        seen.append((i, *counts, hashlib.sha256(join(fixed).encode()).hexdigest(), join(every), len(every) - len(fixed)))
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(seen, key=key)
    four = next(r for r in got if r.doc_id == 4)
    assert four.n_phone == four.n_card == 0 and four.spans == f"card:{3 + len(phone)}:{3 + len(phone) + 16},phone:2:{2 + len(phone)}"
    eight = next(r for r in got if r.doc_id == 8)
    assert eight.n_phone == eight.n_card == 1 and eight.n_added == 0


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path) == []


def test_redacted(spark):
    rng = random.Random(1)
    phone, number = some(rng, "phone"), card(rng)
    df = spark.createDataFrame([(1, f"call {phone} {number}, or x@y.org!"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.redacted for r in pd.find(df, MODEL, redact=True).collect()}
    assert got == {1: "call [PHONE] [CARD], or [EMAIL]!", 2: ""}


@pytest.mark.parametrize(
    "text",
    ["1" * 1_000_000, "a" * 1_000_000, "a." * 500_000 + "@", "@" * 300_000, "1." * 500_000, "+1 " * 300_000, "12 " * 100_000, "a@b." * 200_000, "(" * 500_000 + "1"],
    ids=["digits", "letters", "local", "ats", "parts", "pluses", "numbers", "domains", "brackets"],
)
def test_very_long_texts(text):
    start = time.time()
    pd.Finder(MODEL).find([text])
    assert time.time() - start < 30
