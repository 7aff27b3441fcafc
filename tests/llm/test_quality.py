"""Thresholds follow the habits of each source: bad texts of a source go, the same figures are usual in another one."""

import random

import pytest

from tunemill.llm import quality

WORDS = 100


def text(rng, symbols=0, repeated_lines=0, again=0, letters=5):
    """A text of 100 words in 20 lines: words with a symbol, lines that repeat the first, words that repeat a run, word length."""
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(letters))
    words = [word() for _ in range(WORDS)]
    for i in range(symbols):
        words[i] += "#"
    for i in range(again // 3):
        words[60 + 3 * i:63 + 3 * i] = words[30:33]
    lines = [" ".join(words[i:i + 5]) for i in range(0, WORDS, 5)]
    return "\n".join([*lines, *["-"] * (repeated_lines + 1)])


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows = random.Random(5), []
    add = lambda source, kind, **kw: rows.append((len(rows), text(rng, **kw), "en", source, kind))
    for i in range(400):
        add("plain", "usual", repeated_lines=i % 50 == 0, again=3 * (i % 20 == 0), letters=5)
        add("lists", "usual", symbols=20 + i % 10, repeated_lines=6 + i % 5, again=12 + 3 * (i % 4), letters=9)
    for source, kinds in {"plain": {"symbols": 40, "repeated_lines": 12, "again": 39, "letters": 10},
                          "lists": {"symbols": 95, "repeated_lines": 60, "letters": 20}}.items():
        usual = {} if source == "plain" else {"symbols": 30, "repeated_lines": 8, "again": 12, "letters": 9}
        for kind, value in kinds.items():
            add(source, kind, **{**usual, kind: value})
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kind string")


def test_each_measure_has_its_own_threshold_in_each_source(corpus):
    found = quality.thresholds(quality.with_counts(corpus), ["lang", "source"]).collect()
    limits = {r.source: r.limits.asDict() for r in found}
    assert set(limits) == {"plain", "lists"}
    for name in limits["plain"]:
        if name != "docs":
            assert limits["plain"][name] < limits["lists"][name], name


def test_bad_texts_go_and_usual_ones_stay(corpus):
    counted = quality.with_counts(corpus)
    got = quality.judged(counted, quality.thresholds(counted, ["lang", "source"]), ["lang", "source"]).collect()
    assert not any(r.base_failed for r in got)
    wrong = [(r.source, r.kind, r.kept) for r in got if r.kept != (r.kind == "usual")]
    assert not wrong


def test_small_groups_take_the_wider_group(spark, corpus):
    few = corpus.where("source = 'plain' OR doc_id % 40 = 1")
    counted = quality.with_counts(few)
    limits = {r.source: r.limits for r in quality.thresholds(counted, ["lang", "source"]).collect()}
    assert limits["lists"].docs == few.count() and limits["plain"].docs < limits["lists"].docs
    assert "NestedLoop" not in quality.judged(counted, quality.thresholds(counted, ["lang", "source"]), ["lang", "source"]) \
        ._jdf.queryExecution().toString()


def test_nothing_passes_the_base_rule(spark):
    few = spark.createDataFrame([(1, "too few words", None, None), (2, None, "en", "s")],
                                "doc_id long, text string, lang string, source string")
    counted = quality.with_counts(few)
    got = quality.judged(counted, quality.thresholds(counted, ["lang", "source"]), ["lang", "source"]).collect()
    assert [(r.base_failed, r.kept) for r in got] == [(True, False)] * 2
