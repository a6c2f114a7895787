import random
import re

import pytest

from podium.llm import quality_rules as q
from podium.llm.common import WORD

random.seed(2)


def brute(text):
    text = text or ""
    w = re.findall(WORD, text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    marked = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(marked),
        len(w) < 50 or 100 * len(marked) > 50 * len(w),
    )


TEXTS = [None, "", " \n\t ", "a", "a b c", "a b c a b c", "a a a a a", "x y z\nx y z\n\nx y z", "#*$%&|<> é😀 é😀", "a\x0bb\x0cc\rd", "a b c d a b c e a b c", "\n\n", "a\x00 b"]
TEXTS += [" ".join(random.choice("abcde") for _ in range(random.randint(0, 120))) for _ in range(60)]
TEXTS += ["\n".join(random.choice(["one two", "three", " ", "", "#"]) for _ in range(random.randint(0, 90))) for _ in range(20)]
SCHEMA = "doc_id long, text string, n_words string, row int"


def test_measures(spark):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)], SCHEMA)
    got = q.measure(docs).withColumn("base_failed", q.base_failed()).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(TEXTS[r.row.doc_id])


def words(n, size):
    return " ".join("".join(random.choice("abcdefghijklmnop") for _ in range(size)) for _ in range(n))


def corpus(n=600):
    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = words(80, 9) if not bad else (words(80, 9) + " #$" * 40 if i % 2 else words(80, 2))
        docs.append((i, text, "s", i))
        if i % 10 < 7:
            labels.append((i, 0 if bad else 1))
    return docs, labels


def test_learned_list_on_held_out_rows(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, rule string, kept int")
    judged, rules = q.judge(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert 1 <= len(rules) <= q.MAX_RULES
    right = [r.kept == (r.row.doc_id % 3 != 0) for r in judged.collect() if r.row.doc_id % 10 >= 7]
    assert sum(right) / len(right) > 0.97
    kept = q.keep_good(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {r.row.doc_id for r in judged.where("kept").collect()}


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(None, 0), (1, None), (1, 7)]])
def test_without_usable_labels_only_base_rules_hold(spark, labels):
    docs = spark.createDataFrame([(1, words(60, 5)), (1, words(60, 5)), (2, "few"), (None, words(60, 5))], "doc_id long, text string")
    judged, rules = q.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert rules == [] and sorted(r.kept for r in judged.collect()) == [False, True, True, True]


def test_empty(spark):
    judged, rules = q.judge(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int"))
    assert judged.collect() == [] and rules == []


def test_simplified_keeps_the_tightest_bounds():
    c = q.Condition
    rule = (c("a", True, 1.0), c("a", True, 2.0), c("b", False, 5.0), c("b", False, 3.0), c("a", False, 9.0))
    assert q.simplified(rule) == (c("a", True, 2.0), c("b", False, 3.0), c("a", False, 9.0))
