"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Learning.  A bounded sample of the labelled rows, ``EXAMPLES`` of each label by a hash of their
doc_id, makes the examples.  Terms are all their words and the first ``STEMS`` bytes of longer ones.
In a text's vector a term weighs (1 + log of its count) times its inverse document frequency, the log of
documents by documents that have it, over all documents.  No term of an example is left out; a term that no
example has bears on no order of neighbours and is left out of a text's vector.

Index.  Postings hold (example, weight) by term in blocks of ``BLOCK`` examples, with the largest
weight of each block; those of frequent terms are dense, and many texts are looked up in them at
once, which gives their exact part of every block's bound.  A query adds up the block maxima of its terms, takes blocks in falling order
of that bound and stops below the K-th best cosine so far, so the K nearest examples are exact;
equal cosines are ordered by the example's place.  Texts are looked up one by one inside Arrow
batches.  The index, its terms and the broadcast of it are as large as the texts of at most
2 * EXAMPLES examples, whatever the size of the corpus.

Score.  The K nearest examples by plain TF-IDF cosine vote, whatever their label.  A neighbour's vote weighs the
square of its closeness in what matters for the label, times what one example of its label stands for: closeness
is the cosine of the same vectors with each term also weighed by its relevance, which is how far apart its rates in
the two labels are (log ratio) times the root of its example count.  A vote becomes a score by the isotonic fit of the examples' labels on their own votes
(each without itself).  The nearest examples are the evidence.

Edge cases: a text without a known term (so null and empty ones) gets the rate of such examples; a
doc_id with several labels counts as toxic if any says so; rows with a null label, doc_id or text
are not learned from; without examples of both labels no term says anything, so every score is the
share of toxic examples, or 0 if there are none; an empty table of labels is such a case, an empty
table of documents gives an empty result; a null doc_id is never held out; repeated rows each get
their row; other columns are ignored.  A very long text is a block of its own, so memory follows the longest text; so does the
index if a very long text is an example.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import ALNUM_BREAKS, LOWER, U64, blocks, mix, prefix_hashes, span_hashes, text_buffer, words
from .common import doc_remainder, ship_package, stored

#: At most so many labelled rows of each label are learned from.
EXAMPLES = 2000
STEMS, BLOCK, K = (4, 7), 256, 15
#: Terms in more than one of DENSE examples have their postings as one number for every example.
DENSE = 8
#: Blocks that are scored together, and rows whose frequent terms are looked up together.
BLOCKS_AT_ONCE, ROWS = 16, 128
THRESHOLD = 0.3
Calibration = tuple[np.ndarray, np.ndarray]
_NEAR = "array<struct<doc_id:bigint,similarity:double>>"


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term, row) of every word and stem of the texts."""
    low = LOWER[data]
    start, stop, row = words(low, offsets, ALNUM_BREAKS)
    prefix = prefix_hashes(low)
    value, owner = [span_hashes(prefix, start, stop)], [row]
    for n in STEMS:
        long = stop - start > n
        value.append(mix(span_hashes(prefix, start[long], start[long] + n) + U64(1)))
        owner.append(row[long])
    return np.concatenate(value), np.concatenate(owner)


_HEAD_BITS = 18
_STARTS: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}


def _starts(vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """(first place of the terms with each head, the most terms of one head) of a sorted vocabulary."""
    known = _STARTS.get(id(vocabulary))
    if known is None or known[0] is not vocabulary:
        begin = np.searchsorted(vocabulary, np.arange(1 << _HEAD_BITS, dtype=U64) << U64(64 - _HEAD_BITS))
        _STARTS.clear()
        _STARTS[id(vocabulary)] = known = vocabulary, begin, int(np.diff(np.r_[begin, len(vocabulary)]).max())
    return known[1], known[2]


def counts(term: np.ndarray, row: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the sorted vocabulary, times) of the known terms, by row and place."""
    if not len(vocabulary) or not len(term):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # terms are spread evenly, so their first bits tell about where to look
    begin, steps = _starts(vocabulary)
    at = begin.take((term >> U64(64 - _HEAD_BITS)).astype(np.int64))
    for _ in range(steps):
        at += vocabulary.take(at, mode="clip") < term
    at = np.minimum(at, len(vocabulary) - 1)
    known = vocabulary[at] == term
    both, n = np.unique(row[known] * len(vocabulary) + at[known], return_counts=True)
    return both // len(vocabulary), both % len(vocabulary), n


def relevance(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """What each term tells about the label, from the examples of either label that have it."""
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.abs(ratio) * np.sqrt(clean + toxic)


class ExampleIndex:
    """Examples' weighted vectors in a block-max inverted index, and the calibration of votes."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, relevance: np.ndarray, ids: np.ndarray, label: np.ndarray, row: np.ndarray, place: np.ndarray, n: np.ndarray, stands_for: tuple[float, float]):
        # every executor keeps a copy on its disk, so numbers are as narrow as they can be
        self.vocabulary, self.weight_of_term, self.relevant = vocabulary, idf, idf * relevance
        weight = self.weights(row, place, n, len(ids), idf).astype(np.float32)
        telling = self.weights(row, place, n, len(ids), self.relevant).astype(np.float32)
        # like examples stand together, so that block maxima are tight
        main = np.full(len(ids), -1, np.int64)
        order = np.lexsort((-weight, row))
        rows, first = np.unique(row[order], return_index=True)
        main[rows] = place[order][first]
        rank = np.lexsort((ids, main, label))
        self.ids, self.label = ids[rank], label[rank]
        self.votes_of = np.where(self.label == 1, stands_for[1], stands_for[0])
        back = np.empty(len(ids), np.int64)
        back[rank] = np.arange(len(ids))
        row = back[row]
        order = np.lexsort((place, row))
        self.telling, self.telling_place = telling[order], place[order].astype(np.int32)
        self.telling_begin = np.searchsorted(row[order], np.arange(len(ids) + 1))
        order = np.lexsort((row, place))
        row, weight, place = row[order].astype(np.int32), weight[order], place[order]
        bare = np.ones(len(ids), bool)
        bare[row] = False
        often = np.bincount(place, minlength=len(vocabulary)) * DENSE > len(ids)
        self.dense_of = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        self.dense = np.zeros((int(often.sum()), len(ids)), np.float32)
        self.dense[self.dense_of[place[often[place]]], row[often[place]]] = weight[often[place]]
        self.example, self.weight, place = (x[~often[place]] for x in (row, weight, place))
        group = place * (len(ids) // BLOCK + 1) + self.example // BLOCK
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
        self.post_begin = np.r_[first, len(group)].astype(np.uint32 if len(group) < 1 << 32 else np.int64)
        self.block = self.example[first] // BLOCK
        self.block_max = np.maximum.reduceat(self.weight, first) if len(group) else np.zeros(0, np.float32)
        self.term_begin = np.searchsorted(place[first], np.arange(len(vocabulary) + 1)).astype(self.post_begin.dtype)
        self.block_of = np.arange(len(ids)) // BLOCK
        total = self.votes_of.sum()
        self.prior = float((self.votes_of * self.label).sum() / total) if total else 0.0
        w = self.votes_of[bare]
        self.bare = float(((w * self.label[bare]).sum() + self.prior) / (w.sum() + 1))

    @staticmethod
    def weights(row: np.ndarray, place: np.ndarray, n: np.ndarray, rows: int, of_term: np.ndarray) -> np.ndarray:
        """The unit vectors of the rows."""
        weight = (1 + np.log(n)) * of_term[place]
        size = np.sqrt(np.bincount(row, weight**2, minlength=rows))
        return weight / np.where(size > 0, size, 1)[row]

    def common(self, row: np.ndarray, place: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
        """rows x examples: the part of the cosines that comes from the frequent terms."""
        use = self.dense_of[place] >= 0
        lines, back = np.unique(self.dense_of[place[use]], return_inverse=True)
        asked = np.zeros((rows, len(lines)))
        asked[row[use], back] = weight[use]
        return asked @ self.dense[lines].astype(np.float64)

    def nearest(self, place: np.ndarray, weight: np.ndarray, k: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest examples with a positive cosine, best first."""
        if common is None:
            common = self.common(np.zeros(len(place), np.int64), place, weight, 1)[0]
        rare = self.dense_of[place] < 0
        place, weight = place[rare], weight[rare]
        begin, size = self.term_begin[place].astype(np.int64), (self.term_begin[place + 1] - self.term_begin[place]).astype(np.int64)
        entry = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own, home = np.repeat(weight, size), self.block.take(entry)
        firsts = np.arange(0, len(self.ids), BLOCK)
        bound = np.maximum.reduceat(common, firsts) + np.bincount(home, own * self.block_max.take(entry), minlength=len(firsts))
        turn = np.argsort(-bound, kind="stable")
        turn = turn[bound[turn] > 0]
        # a cosine is no less than its part from the frequent terms
        least = np.partition(common, -k)[-k] if len(common) > k else 0.0
        best, cosine, done = np.zeros(0, np.int64), np.zeros(0), 0
        while done < len(turn) and bound[turn[done]] >= least - 1e-9:
            step = min(BLOCKS_AT_ONCE, int((bound[turn[done:]] >= least - 1e-9).sum()))
            chosen = np.zeros(len(bound), bool)
            chosen[turn[done : done + step]] = True
            done += step
            use = slice(None) if step == len(bound) else chosen[home]
            at = entry[use]
            a = self.post_begin.take(at).astype(np.int64)
            length = self.post_begin.take(at + 1) - a
            post = np.repeat(a - (np.cumsum(length) - length), length)
            post += np.arange(len(post))
            score = np.bincount(self.example.take(post), np.repeat(own[use], length) * self.weight.take(post), minlength=len(self.ids)) + common
            score *= chosen[self.block_of]
            floor = max(least, np.partition(score, -k)[-k] if len(score) > k else 0.0)
            found = np.flatnonzero((score >= floor - 1e-9) & (score > 0))
            # equal cosines are ordered by place, whatever the last bits say
            best, cosine = np.concatenate([best, found]), np.concatenate([cosine, np.round(score[found], 12)])
            top = np.lexsort((best, -cosine))[:k]
            best, cosine = best[top], cosine[top]
            least = max(least, cosine[-1] if len(cosine) == k else 0.0)
        return best, cosine

    def closeness(self, place: np.ndarray, telling: np.ndarray, example: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """Cosines of a text (its places and relevant weights) with examples; ``spare`` has a zero for each term."""
        spare[place] = telling
        near = np.empty(len(example))
        for k, e in enumerate(example.tolist()):
            mine = slice(self.telling_begin[e], self.telling_begin[e + 1])
            near[k] = spare.take(self.telling_place[mine]) @ self.telling[mine]
        spare[place] = 0
        return near

    def vote(self, example: np.ndarray, cosine: np.ndarray, near: np.ndarray) -> float:
        # neighbours that share nothing relevant vote by their plain cosine
        w = (near if near.any() else cosine) ** 2 * self.votes_of[example]
        return float((w * self.label[example]).sum() / w.sum())

    def calibration(self, ids: np.ndarray, vote: np.ndarray) -> Calibration:
        """(votes, scores) of the isotonic fit to the votes that examples (by doc_id) got from the others."""
        order = np.argsort(self.ids)
        at = order[np.searchsorted(self.ids[order], ids)]
        levels: list[list[float]] = []  # pooled: weight, sum of votes, sum of labels
        for v, y, w in sorted(zip(vote.tolist(), self.label[at].tolist(), self.votes_of[at].tolist(), strict=True)):
            levels.append([w, w * v, w * y])
            while len(levels) > 1 and levels[-2][2] / levels[-2][0] >= levels[-1][2] / levels[-1][0]:
                last = levels.pop()
                levels[-1] = [a + b for a, b in zip(levels[-1], last, strict=True)]
        if not levels:
            return np.zeros(1), np.full(1, self.prior)
        w, v, y = np.array(levels).T
        return v / w, (y + self.prior) / (w + 1)

    def votes(self, data: np.ndarray, offsets: np.ndarray, own: list[int] | None = None) -> list[tuple[float, np.ndarray, np.ndarray] | None]:
        """(vote, nearest examples, cosines) of each text, None without a neighbour; ``own`` are doc_ids to leave out."""
        rows = len(offsets) - 1
        row, place, n = counts(*terms(data, offsets), self.vocabulary)
        weight, telling = (self.weights(row, place, n, rows, w) for w in (self.weight_of_term, self.relevant))
        spare = np.zeros(len(self.vocabulary))
        out: list[tuple[float, np.ndarray, np.ndarray] | None] = [None] * rows
        first, common = 0, None
        cut = np.searchsorted(row, np.arange(rows + 1))
        for i in np.flatnonzero(np.diff(cut)).tolist():
            if common is None or i >= first + ROWS:
                first = i
                mine = slice(cut[i], cut[min(rows, i + ROWS)])
                common = self.common(row[mine] - i, place[mine], weight[mine], ROWS)
            mine = slice(cut[i], cut[i + 1])
            example, cosine = self.nearest(place[mine], weight[mine], K + (own is not None), common[i - first])
            if own is not None:
                other = self.ids[example] != own[i]
                example, cosine = example[other][:K], cosine[other][:K]
            if len(example):
                out[i] = self.vote(example, cosine, self.closeness(place[mine], telling[mine], example, spare)), example, cosine
        return out

    def judge(self, data: np.ndarray, offsets: np.ndarray, knots: Calibration) -> tuple[np.ndarray, list[list[dict]]]:
        """(score, nearest examples) of each text."""
        found = self.votes(data, offsets)
        score, near = np.full(len(found), self.bare), [[] for _ in found]
        for i, x in enumerate(found):
            if x:
                score[i] = np.interp(x[0], *knots)
                near[i] = [{"doc_id": int(self.ids[e]), "similarity": float(min(c, 1.0))} for e, c in zip(x[1], x[2], strict=True)]
        return np.clip(score, 0, 1), near


def learnable() -> Column:
    """Rows outside the held-out fold."""
    return doc_remainder(F.col("doc_id"), 4) != 2


def _examples(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, text of the sample; the number of learnable rows by label)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    present = docs.filter("text is not null").select("doc_id")
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(learnable()).join(present, "doc_id", "left_semi"), "labelled")
    total = {int(r["toxic"]): int(r["n"]) for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES) for y in (0, 1)]
    # at most 2 * EXAMPLES rows of two numbers
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    return stored(docs.filter("text is not null").join(sample, "doc_id").dropDuplicates(["doc_id"]), "examples"), total


def _term_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms of the examples, sorted; clean and toxic examples that have each)."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            term, row = terms(*text_buffer(block.column("text")))
            toxic = block.column("toxic").to_numpy()
            pair = np.unique(np.stack([term, row.astype(U64)], axis=1), axis=0) if len(term) else np.zeros((0, 2), U64)
            value, back = np.unique(pair[:, 0], return_inverse=True)
            yes = np.bincount(back, toxic[pair[:, 1].astype(np.int64)], minlength=len(value)).astype(np.int64)
            both = np.bincount(back, minlength=len(value)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(both - yes), pa.array(yes)], ["term", "clean", "toxic"])

    found = sample.mapInArrow(seen, "term long, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    term, clean, toxic = (found.column(c).to_numpy() for c in ("term", "clean", "toxic"))
    term = term.astype(U64)
    order = np.argsort(term)
    return term[order], clean[order], toxic[order]


def _idf(docs: DataFrame, shared: Broadcast) -> np.ndarray:
    """log(documents / document frequency) of each term of the vocabulary, over all documents."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        times = np.zeros(len(known) + 1, np.int64)
        for block in blocks(batches):
            _, place, _ = counts(*terms(*text_buffer(block.column("text"))), known)
            times[:-1] += np.bincount(place, minlength=len(known))
            times[-1] += block.num_rows
        seen = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(times[seen])], ["place", "n"])

    found = docs.select("text").mapInArrow(tally, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    times = np.zeros(len(shared.value) + 1)
    times[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return np.log(times[-1] / np.maximum(times[:-1], 1))


def _vectors(sample: DataFrame, shared: Broadcast) -> tuple[np.ndarray, ...]:
    """(doc_id, label by example; example, place in the vocabulary, count by its terms) of the sample."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            row, place, n = counts(*terms(*text_buffer(block.column("text"))), shared.value)
            cut = pa.array(np.searchsorted(row, np.arange(block.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (place, n)]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("toxic"), *lists], ["doc_id", "toxic", "place", "n"])

    rows = sample.select("doc_id", "toxic", "text").mapInArrow(vectors, "doc_id long, toxic int, place array<int>, n array<int>").toArrow().combine_chunks()
    place, n = (pa.chunked_array(rows.column(c)).combine_chunks() for c in ("place", "n"))
    size = place.value_lengths().to_numpy(zero_copy_only=False)
    ids, label = rows.column("doc_id").to_numpy(), rows.column("toxic").to_numpy().astype(np.int64)
    return ids, label, np.repeat(np.arange(len(ids)), size), *(x.flatten().to_numpy().astype(np.int64) for x in (place, n))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, Calibration]:
    """Learn from labels (doc_id, toxic) and the texts of docs (doc_id long, text) outside the held-out fold."""
    sample, total = _examples(docs, labels)
    vocabulary, clean, toxic = _term_counts(sample)
    known_terms = docs.sparkSession.sparkContext.broadcast(vocabulary)
    ids, label, row, place, n = _vectors(sample, known_terms)
    have = [int((label == y).sum()) for y in (0, 1)]
    known = relevance(clean, toxic, *have) if all(have) else np.zeros(len(vocabulary))
    stands_for = tuple(total.get(y, 0) / max(1, have[y]) for y in (0, 1))
    index = ExampleIndex(vocabulary, _idf(docs, known_terms), known, ids, label, row, place, n, stands_for)
    known_terms.destroy()
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def own_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            own = block.column("doc_id").to_pylist()
            found = [(i, x[0]) for i, x in zip(own, shared.value.votes(*text_buffer(block.column("text")), own), strict=True) if x]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([v for _, v in found], pa.float64())], ["doc_id", "vote"])

    votes = sample.select("doc_id", "text").repartition("doc_id").mapInArrow(own_votes, "doc_id long, vote double").toArrow()
    return shared, index.calibration(votes.column("doc_id").to_numpy(), votes.column("vote").to_numpy())


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (nearest examples) of every row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared, knots = fit(rows, labels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for block in blocks(batches):
            score, near = index.judge(*text_buffer(block.column("text")), knots)
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64())]))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(score), pa.array(near, kind)], ["doc_id", "score", "evidence"])

    out = rows.mapInArrow(judge, f"doc_id long, score double, evidence {_NEAR}")
    held = F.coalesce(doc_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
