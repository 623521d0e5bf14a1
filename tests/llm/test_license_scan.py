import random
import re

from tidewell.llm.license_scan import BASE_PHRASES, DRIFT, MIN_COVER, TEMPLATES, license_scan


def words(text):
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute(text):
    w = words(text)
    places = [(i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def base(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


CASES = {
    1: "x Under the MIT License, under the\nmit license; apache license version 2.0 apache license version 2",
    2: None,
    3: "",
    4: "cc by nc cc by nc-sa cc-by-nc CC BY ND",
    5: "été under the mit licenseé under the mit",
    6: "see: " + TEMPLATES["mit"] + " end",
    7: TEMPLATES["gpl"].replace("redistribute", "freely redistribute", 1) + " cc by nc",
    8: TEMPLATES["bsd"][:60],
    9: "cc by",
    10: "word " * 300_000 + "cc by nc",
}


def test_small_cases(documents):
    rows = {r.doc_id: r for r in license_scan(documents(list(CASES.items()))).collect()}
    assert {i: base(r) for i, r in rows.items()} == {i: brute(t) for i, t in CASES.items()}
    assert rows[1].labels == "apache-2,mit" and rows[1].score == 1.0
    assert rows[6].labels == "mit" and rows[6].base_labels == "" and rows[6].score == 1.0
    assert rows[7].labels == "cc-by-nc,gpl" and rows[7].base_labels == "cc-by-nc"
    assert (rows[8].labels, rows[8].score) == ("", 0.0)


def test_repeated_rows_and_null_ids(documents):
    rows = license_scan(documents([(1, "cc by nc"), (1, "cc by nc"), (1, "cc by"), (None, "cc by nc"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_base) for r in rows) == [(0, 0, 0), (0, 3, 1), (1, 2, 0), (1, 3, 1), (1, 3, 1)]


def test_empty_table(documents):
    assert license_scan(documents([(1, "a")]).limit(0)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    rows = license_scan(docs).collect()
    assert {r.doc_id: base(r) for r in rows} == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)


def brute_spans(text, template):
    """(start, stop, runs, share) of each span of neighbouring diagonals."""
    w, t = words(text), words(template)
    diagonals = {}
    for p in range(len(w) - 2):
        for q in range(len(t) - 2):
            if w[p : p + 3] == t[q : q + 3]:
                diagonals.setdefault(p - q, []).append((p, q))
    spans, last = [], None
    for d, hits in sorted(diagonals.items()):
        start, stop = min(p for p, _ in hits), max(p for p, _ in hits)
        if last is None or d - last[0] > DRIFT or start > last[1] + len(t) - 2 + DRIFT:
            spans.append([])
        spans[-1] += hits
        last = d, stop
    return [(min(p for p, _ in s), max(p for p, _ in s), len({q for _, q in s}), len({q for _, q in s}) / (len(t) - 2)) for s in spans]


def brute_labels(text):
    found = {(label, 1.0) for label in brute(text)[4].split(",") if label}
    spans = sorted((*span, label) for label, template in TEMPLATES.items() for span in brute_spans(text, template) if span[3] >= MIN_COVER)
    while spans:
        place, stop = [], spans[0][1]
        while spans and spans[0][0] <= stop:
            place.append(spans.pop(0))
            stop = max(stop, place[-1][1])
        best = max((share, n) for _, _, n, share, _ in place)
        found |= {(label, share) for _, _, n, share, label in place if (share, n) == best}
    return ",".join(sorted({label for label, _ in found})), max((share for _, share in found), default=0.0)


def test_each_template_gets_its_own_label_only(documents):
    rows = license_scan(documents([(i, f"a {t} b") for i, t in enumerate(TEMPLATES.values())])).collect()
    method = {r.doc_id: set(r.labels.split(",")) - set(r.base_labels.split(",")) or set(r.labels.split(",")) for r in rows}
    assert method == {i: {label} for i, label in enumerate(TEMPLATES)}


def test_labels_and_scores_of_edited_templates(documents):
    pick, texts = random.Random(3), {}
    for i in range(200):
        parts = []
        for _ in range(pick.randrange(1, 3)):
            w = words(pick.choice(list(TEMPLATES.values())))
            for _ in range(pick.randrange(1, 4)):
                at = pick.randrange(len(w))
                w[at : at + pick.randrange(3)] = ["extra"] * pick.randrange(3)
            parts += ["filler"] * pick.randrange(30) + w + pick.choice([[], [], [], ["cc", "by", "nc"], ["under", "the", "mit", "license"]])
        texts[i] = " ".join(parts)
    rows = {r.doc_id: r for r in license_scan(documents(list(texts.items()))).collect()}
    assert {i: (r.labels, round(r.score, 9)) for i, r in rows.items()} == {i: (brute_labels(t)[0], round(brute_labels(t)[1], 9)) for i, t in texts.items()}
    assert 20 < sum(0 < r.score < 1 for r in rows.values()) and {base(r) for r in rows.values()} == {brute(t) for t in texts.values()}
