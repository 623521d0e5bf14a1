"""Quality rules against brute force; the cascade against all rules at once."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidewell.llm import quality
from tidewell.llm.quality import RULES, Rule, Texts, cascade, ordered, quality_rules
from tidewell.llm.queries import op13_quality_rules

SF = "/root/testdata/sf0.01"
SPACES = "[^\x20\x09-\x0d]"


def base(text):
    text = text or ""
    words = re.findall(f"{SPACES}+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, again = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            again.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(SPACES, x)]
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed


def verdict(text):
    """Which rules reject a text."""
    words, lines = re.findall(f"{SPACES}+", text), [x for x in text.split("\n") if re.search(SPACES, x)]
    n, chars = len(words), sum(map(len, words))
    return {
        "word_length": chars < 2 * n or chars > 15 * n, "symbols": 100 * len(re.findall(r"[#*$%&|<>]", text)) > 20 * n, "duplicate_lines": 100 * (len(lines) - len(set(lines))) > 30 * len(lines),
        "letters": 100 * sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words) < 70 * n, "capitals": 100 * len(re.findall("[A-Z]", text)) > 60 * len(re.findall("[A-Za-z]", text)),
        "marks": 100 * len(re.findall(r"[!-/:-@\[-`{-~]", text)) > 30 * chars, "frequent_word": n > 0 and 100 * max(Counter(words).values()) > 30 * n,
        "dashed_lines": 100 * sum(x[0] in "-*" for x in lines) > 90 * len(lines), "open_lines": 100 * sum(x.endswith("...") for x in lines) > 30 * len(lines),
    }


GOOD = "The quick brown fox jumps over a lazy dog while seven wizards vex that boxing judge, and nobody at all minds the noise."
ODD = [
    None, "", " \n\t ", GOOD, GOOD + "\n" + GOOD, f"{GOOD}\n- one\n- one\n- two\r\n- two\r", "a " * 30, "# * $ " * 20, " ".join(f"w{i}" for i in range(19)), " ".join(f"w{i}" for i in range(20)),
    "\n".join(f"- item number {i}" for i in range(30)), "\n".join(f"read more {i}..." for i in range(30)), GOOD.upper(), " ".join(f"{i}" for i in range(100)), " ".join("x" * 40 + str(i) for i in range(30)),
    "日本語 " * 5 + GOOD, "x\n" * 50, "...\n..\n.\n" + GOOD, " ".join(f"word{i % 8}" for i in range(24)), GOOD + "\n\n\n", "\n" + GOOD, "long text here " * 50_000 + GOOD, "é" * 200 + " " + GOOD,
]


def check(rows, got):
    want = []
    for doc_id, text in rows:
        measures = base(text)
        want.append((doc_id, *measures, not measures[-1] and not any(verdict(text).values())))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:8]) for r in got)


def test_odd_texts(documents):
    rows = [*enumerate(ODD), (None, GOOD), (3, GOOD), (3, GOOD)]
    got = quality_rules(documents(rows)).collect()
    check(rows, got)
    assert {r.kept for r in got} == {True, False} and all((r.failed is None) == r.kept and (r.failed == "base") == r.base_failed for r in got)
    assert all(verdict(dict(rows[: len(ODD)])[r.doc_id])[r.failed] for r in got if r.failed not in (None, "base"))


def test_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op13_quality_rules(spark, SF).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    seen = [r for r in got if r.doc_id in good]
    assert len(seen) > 100 and sum(r.kept or r.base_failed for r in seen) >= 0.99 * len(seen)


def test_the_sample_never_changes_what_is_kept(documents):
    docs = documents(list(enumerate(ODD)))
    kept = [sorted(r.doc_id for r in quality_rules(docs, rules, n).filter("kept").collect()) for rules, n in ((RULES, 0), (RULES, 10**9), (RULES[::-1], 5))]
    assert kept[0] == kept[1] == kept[2]
    assert quality_rules(documents([])).collect() == []


def test_order_is_by_rejections_per_second_of_what_is_left():
    # rule 0 rejects 90 at 9 s, rule 1 the same and 10 more at 5 s, rule 2 ten others at 1 s, rule 3 nothing at no cost
    assert ordered({0b011: 90, 0b010: 10, 0b100: 10, 0: 400}, [9.0, 5.0, 1.0, 0.0]) == [1, 2, 3, 0]
    assert ordered({}, [2.0, 1.0]) == [1, 0] and ordered({}, []) == []


def test_rules_see_only_what_is_left():
    texts = Texts(pa.array([f"{GOOD} {i}" for i in range(100)] + ["few words"] * 20))
    seen = []

    def rule(name, bad):
        def rejects(t):
            seen.append((name, len(t)))
            return np.array([int(x.split()[-1]) in bad if x != "few words" else False for x in t.column.to_pylist()])

        return Rule(name, rejects)

    failed = cascade(texts, (rule("a", range(80)), rule("b", range(70, 95)), rule("c", range(100)), rule("d", ())))
    assert failed.tolist() == [0] * 80 + [1] * 15 + [2] * 5 + [-2] * 20
    assert seen == [("a", 120), ("b", 20), ("c", 5)] and quality.BASE[0] == "n_words"
