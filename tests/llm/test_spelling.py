"""Spelling variants against all pairs compared one by one."""

import random
import re
import zlib
from collections import Counter

from tidewell.llm.queries import op12_spelling_variants
from tidewell.llm.spelling import spelling_variants

SF = "/root/testdata/sf0.01"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = counted(rows)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    form, count = {}, {}
    for w in n:
        found = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if x != w and near(w, x)]
        count[w] = len(found)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def run(docs):
    return sorted((tuple(r) for r in spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op12_spelling_variants(spark, SF).collect()), key=str)
    assert got == brute(rows) and sum(r[1] is not None for r in got) > 5 and len(got) > 500


def test_chains_ties_and_like_neighbours(documents):
    words = {"banana": 2000, "bananna": 300, "banannas": 40, "banannes": 7, "bananas": 300, "cabana": 5, "llllll": 100, "lllllll": 20, "llllllll": 5, "élèves": 30, "eleves": 6, "élèvee": 30, "fooled": 25, "footed": 25, "fooxed": 5, "short": 99, "Banana": 3}
    rng = random.Random(3)
    bag = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(bag)
    rows = [(i, " ".join(bag[i * 40 : i * 40 + 40])) for i in range(len(bag) // 40 + 1)] + [(None, "banana, footed"), (7, None), (8, ""), (9, "123 ***"), (9, "banana"), (9, "banana")]
    got = run(documents(rows))
    assert got == brute(rows)
    forms = {r[0]: r[1:3] for r in got}
    assert forms["banannes"] == ("banannas", "banana") and forms["fooxed"][0] in ("fooled", "footed") and forms["llllllll"] == (None, "llllllll")


def test_long_words_and_a_long_text(documents):
    base = "".join(random.Random(1).choice("abcd") for _ in range(3000))
    words = [base] * 30 + [base[:1500] + "x" + base[1501:]] * 5 + [base[:-1]] * 6 + ["y" + base] * 5 + [base[:700] + base[701:]] * 6
    rows = [(i, w) for i, w in enumerate(words)] + [(99, "longer words " * 100_000)]
    assert run(documents(rows)) == brute(rows)


def test_nothing_to_find(documents):
    assert run(documents([])) == [] and run(documents([(1, None), (2, "a few rare words")])) == []
