"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are all words of the labelled sample and the words' first letters (BEGINNING of them, so that
a word and its forms share a term).  A term's weight in a text is (1 + log tf) times its inverse
document frequency over all documents, times the square of its smoothed log odds between the two
labels (delta IDF), which is near 0 for a term that both labels have alike and 0 for one that no
example has.  Nothing is chosen or left out by a threshold.

The examples' unit vectors stand in an inverted index whose long lists are cut into blocks of examples,
with the greatest weight of each term in each block.  A query takes the blocks of the greatest upper
bounds first and leaves out those whose bound is below a lower bound of its k-th neighbour (no weight is
negative, so what the short lists alone give is one), so neighbours are exact (single precision finds
them with a margin, double precision decides).
Votes weighted by distance, made into probabilities by isotonic regression over leave-one-out votes
of the examples, are the scores; the neighbours are the evidence.

The classifier is fitted on a bounded sample of labelled rows: EXAMPLES of either label.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import fold, lean, read, save, small, texts_of
from ._text import pieces, prefix_hashes

EXAMPLES = {1: 4_000, 0: 4_000}
BEGINNING = 5  # letters
SMOOTH = 5.0  # examples' worth of the common share that every term's odds start from
NEIGHBOURS, BLOCK, LONG, QUERIES = 15, 64, 2_048, 128
NEAR = 0.02  # added to the distance of a neighbour
THRESHOLD = 0.7
SEEN = 20_000  # scores of texts that repeat, in a worker
_NO_WORD = r"[^\pL\pM\pN_]+"
_U = np.uint64
_MARK = _U(0x9E6C63D0876A9A35)  # of a beginning


def _tokens(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, one after the last, each term's text, each term's key) of about a megabyte of whole texts at a time.

    Texts are lower-cased; words are runs of letters, marks, digits and underscores.
    """
    for lo in range(0, len(column), 500):
        part = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(column.slice(lo, 500).cast(pa.large_string()), "")), _NO_WORD, " ")
        for p in pieces(part):
            word = p.hashes()
            doc = np.searchsorted(p.first, np.arange(len(word)), "right") - 1
            # where the first BEGINNING characters of each word end
            char = np.flatnonzero((p.data & 0xC0) != 0x80)
            end = np.append(char, np.full(BEGINNING, len(p.data)))[np.searchsorted(char, p.starts) + BEGINNING]
            longer = np.flatnonzero(end < p.ends)
            begun = prefix_hashes(p, longer, end[longer]) ^ _MARK if len(longer) else np.empty(0, _U)
            yield lo + p.lo, lo + p.hi, np.concatenate((doc, doc[longer])), np.concatenate((word, begun)) | _U(1)


def _texts_terms(column) -> Iterator[np.ndarray]:
    """The distinct terms' keys of each text, a piece of texts at a time, as one array for each text."""
    for lo, hi, doc, key in _tokens(column):
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(key, prepend=key[:1]) != 0) | (np.arange(len(key)) == 0))
        yield from np.split(key[new], np.searchsorted(doc[new], np.arange(1, hi - lo)))


def _count(batches):
    """How many texts of each label have each term."""
    sums: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for batch in batches:
        label = batch.column("toxic").to_pylist()
        for i, keys in enumerate(_texts_terms(batch.column("text"))):
            sums[label[i]].append(keys)
    for label, own in sums.items():
        if own:
            key, n = np.unique(np.concatenate(own), return_counts=True)
            for lo in range(0, len(key), 100_000):
                some = key[lo : lo + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), label, np.int32)), pa.array(some), pa.array(n[lo : lo + 100_000])], names=["toxic", "term", "n"])


def odds(a: np.ndarray, b: np.ndarray, n1: int, n0: int, smooth: float = SMOOTH) -> np.ndarray:
    """|log2| of the odds of terms that a of n1 toxic and b of n0 other examples have; 0 where there is nothing to tell."""
    share = n1 / max(1, n1 + n0)
    if not 0 < share < 1:
        return np.zeros(len(a))
    return np.abs(np.log2((a + smooth * share) / (b + smooth * (1 - share)) * ((1 - share) / share)))


class Vectors:
    """TF-IDF vectors over a fixed list of terms (keys), each with its weight; found by an open-addressed table."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray):
        self.keys, self.weight = keys, weight

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """Keys and places by slot; made where it is used, not sent."""
        got = self.__dict__.get("_made")
        if got is None:
            bits = max(10, (3 * len(self.keys)).bit_length())
            shift, key, place = _U(64 - bits), np.zeros(1 << bits, _U), np.zeros(1 << bits, np.int32)
            left, at = np.arange(len(self.keys)), (self.keys >> shift).astype(np.int64)
            while len(left):
                free = key[at] == 0
                key[at[free]] = self.keys[left[free]]
                won = key[at] == self.keys[left]
                place[at[won]] = left[won]
                left, at = left[~won], (at[~won] + 1) & (len(key) - 1)
            got = self._made = (key, place, shift)
        return got

    def __getstate__(self):
        return {"keys": self.keys, "weight": self.weight}

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; -1 where it is no term."""
        table, place, shift = self._table()
        at = (keys >> shift).astype(np.int64)
        out = np.where(table[at] == keys, place[at], -1)
        left = np.flatnonzero((out < 0) & (table[at] != 0))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(table) - 1)
            hit = table[at] == keys[left]
            out[left[hit]] = place[at[hit]]
            more = ~hit & (table[at] != 0)
            left, at = left[more], at[more]
        return out

    def counts(self, column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(number of texts, each text's first entry, terms, how often) of the texts of a column, a piece at a time."""
        for lo, hi, doc, key in _tokens(column):
            at = self.find(key)
            code = np.sort((doc * len(self.keys) + at)[at >= 0])
            first = np.flatnonzero(np.diff(code, prepend=-1))
            n = np.diff(np.append(first, len(code)))
            doc, term = np.divmod(code[first], max(1, len(self.keys)))
            yield hi - lo, np.searchsorted(doc, np.arange(hi - lo + 1)), term, n

    def __call__(self, column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of the unit vector of each text of a column; empty if no term of it weighs anything."""
        for _, cut, term, n in self.counts(column):
            w = (1 + np.log(n)) * self.weight[term]
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                at, own = term[a:b], w[a:b]
                some = own > 0
                at, own = at[some], own[some]
                yield at, own / max(1e-12, math.sqrt(float(own @ own)))


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1 .. start + length - 1 of each range, one after another."""
    upto = np.cumsum(length)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - (upto - length), length)


class BlockMaxIndex:
    """Inverted index of unit vectors without negative weights in blocks of BLOCK examples.

    The lists of the LONG most frequent terms are stored dense, block by block, with the greatest weight of
    each term in each block; the others are short and stored as rows and weights.
    """

    def __init__(self, term: np.ndarray, weight: np.ndarray, cut: np.ndarray, terms: int):
        """Vector i has the terms (sorted) and weights from cut[i] to cut[i + 1]."""
        self.size = len(cut) - 1
        # like vectors stand together, so that bounds are tight
        main = np.array([int(term[a + np.argmax(weight[a:b])]) if b > a else -1 for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], np.int64)
        self.order = np.argsort(main, kind="stable")
        length = np.diff(cut)[self.order]
        spot = _ranges(cut[:-1][self.order], length)
        self.term, self.weight, self.cut = term[spot].astype(np.int32), weight[spot].astype(np.float32), np.concatenate(([0], np.cumsum(length)))
        number = np.bincount(self.term, minlength=terms)
        self.long = np.sort(np.argsort(-number, kind="stable")[:LONG]).astype(np.int32)
        self.terms = terms

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def _lists(self) -> dict:
        """The lists, made from the vectors where they are used, not sent."""
        got = self.__dict__.get("_made")
        if got is None:
            row = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(self.cut))
            column = np.full(self.terms, -1, np.int32)
            column[self.long] = np.arange(len(self.long))
            dense = column[self.term] >= 0
            blocks = max(1, -(-self.size // BLOCK))
            table = np.zeros((blocks * BLOCK, len(self.long)), np.float32)
            table[row[dense], column[self.term[dense]]] = self.weight[dense]
            short = np.flatnonzero(~dense)
            short = short[np.argsort(self.term[short], kind="stable")]
            start = np.searchsorted(self.term[short], np.arange(self.terms + 1)).astype(np.int64)
            got = self._made = {"column": column, "table": table, "most": table.reshape(blocks, BLOCK, -1).max(axis=1), "rows": row[short], "weights": self.weight[short], "start": start}
        return got

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the k examples of the greatest positive cosine (ties: the first in the given order) and their cosines.

        leave: for each query an example that is left out.
        """
        out = []
        for lo in range(0, len(vectors), QUERIES):
            out += self._some(vectors[lo : lo + QUERIES], k, None if leave is None else leave[lo : lo + QUERIES])
        return out

    def _some(self, vectors, k, leave):
        lists, n = self._lists(), len(vectors)
        blocks = len(lists["most"])
        width = blocks * BLOCK
        query = np.zeros((n, len(self.long)), np.float32)
        short = np.empty((n, width))
        dense = []
        for i, (at, weight) in enumerate(vectors):
            column = lists["column"][at]
            own = column >= 0
            dense.append((column[own], weight[own]))
            query[i, column[own]] = weight[own]
            # the short lists, read whole
            at, weight = at[~own], weight[~own]
            start = lists["start"][at]
            length = lists["start"][at + 1] - start
            spot = _ranges(start, length)
            short[i] = np.bincount(lists["rows"][spot], np.repeat(weight, length) * lists["weights"][spot], width)
        sums = short.astype(np.float32)
        # the long ones by blocks, those of the greatest bounds first
        bound = sums.reshape(n, blocks, BLOCK).max(axis=2) + query @ lists["most"].T + 1e-5
        done = np.zeros((n, blocks), bool)
        first = np.argpartition(-bound, min(4, blocks) - 1, axis=1)[:, : min(4, blocks)]
        done[np.arange(n)[:, None], first] = True
        self._add(query, sums, done, lists["table"])
        # no weight is negative, so in the other blocks the short lists' part is a lower bound
        known = sums.copy()
        if leave is not None:
            place = np.empty(self.size, np.int64)
            place[self.order] = np.arange(self.size)
            known[np.arange(n), place[leave]] = -1.0
        least = -np.partition(-known, k - 1, axis=1)[:, k - 1] if width >= k else np.full(n, -1.0)
        more = ~done & (bound >= least[:, None] - 1e-5)
        self._add(query, sums, more, lists["table"])
        sums[~np.repeat(done | more, BLOCK, axis=1)] = -1.0
        sums[:, self.size :] = -1.0
        if leave is not None:
            sums[np.arange(n), place[leave]] = -1.0
        return [self._exact(sums[i], short[i], *dense[i], k) for i in range(n)]

    @staticmethod
    def _add(query, sums, wanted, table):
        for b in np.flatnonzero(wanted.any(axis=0)):
            q = np.flatnonzero(wanted[:, b])
            sums[q, b * BLOCK : (b + 1) * BLOCK] += query[q] @ table[b * BLOCK : (b + 1) * BLOCK].T

    def _exact(self, sums, short, column, weight, k):
        """The k nearest by cosines in double precision, from all rows that single precision can't tell from the k-th.

        short: the short lists' part of the cosines; column, weight: the query's terms in the long lists.
        """
        least = -np.partition(-sums, k - 1)[k - 1] if len(sums) >= k else -1.0
        row = np.flatnonzero(sums >= max(least - 2e-5, -0.5))
        cosine, table = short[row], self._lists()["table"]
        for lo in range(0, len(row), 256):
            # summed in one order for every row, so that copies tie
            cosine[lo : lo + 256] += (table[row[lo : lo + 256, None], column] * weight).sum(axis=1)
        some = np.flatnonzero(cosine > 1e-12)
        found, cosine = self.order[row[some]], np.round(cosine[some], 12)
        best = np.lexsort((found, -cosine))[:k]
        return found[best], cosine[best]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing weighted fit of y on x by pooling neighbours: knots and values."""
    level: list[list[float]] = []
    for v, t, u in sorted(zip(x.tolist(), y.tolist(), w.tolist(), strict=True)):
        level.append([t, u, v, v])
        while len(level) > 1 and (level[-2][0] >= level[-1][0] or level[-2][3] == level[-1][2]):
            t2, u2, _, hi = level.pop()
            t1, u1, lo, _ = level.pop()
            level.append([(t1 * u1 + t2 * u2) / (u1 + u2), u1 + u2, lo, hi])
    knots = np.array([z for *_, lo, hi in level for z in (lo, hi)])
    return knots, np.repeat([t for t, *_ in level], 2)


class Model:
    """Examples in the order of their doc_ids, their index, and the calibration that calibrate() sets."""

    def __init__(self, vectors: Vectors, ids: np.ndarray, index: BlockMaxIndex, labels: np.ndarray, weights: np.ndarray, prior: float):
        self.vectors, self.ids, self.index, self.labels, self.weights, self.prior = vectors, ids, index, labels, weights, prior
        self.knots, self.values = np.array([0.0, 1.0]), np.array([prior, prior])

    def vote(self, near: np.ndarray, sims: np.ndarray) -> float:
        """Share of toxic weight among the neighbours; a near neighbour counts more."""
        w = self.weights[near] * sims / (1 + NEAR - np.minimum(sims, 1.0))
        return float((w @ self.labels[near] + NEAR * self.prior) / (w.sum() + NEAR)) if len(near) else self.prior

    def calibrate(self, votes: np.ndarray) -> None:
        """From the leave-one-out votes of the examples, in their order."""
        if len(votes):
            self.knots, self.values = isotonic(votes, self.labels.astype(float), self.weights)

    def scores(self, column, seen: dict[bytes, tuple[float, np.ndarray]]) -> Iterator[tuple[float, np.ndarray]]:
        """Score and evidence of each text of a column; seen keeps those of texts with the same vector."""
        vectors = self.vectors(column)
        while some := list(islice(vectors, QUERIES)):
            keys = [hashlib.blake2b(at.tobytes() + w.tobytes(), digest_size=16).digest() for at, w in some]
            own = {k: seen[k] for k in keys if k in seen}
            new = {k: v for k, v in zip(keys, some, strict=True) if k not in own}
            for k, (near, sims) in zip(new, self.index.nearest(list(new.values()), NEIGHBOURS), strict=True):
                v = self.vote(near, sims)
                # the vote itself breaks ties between equal calibrated values
                score = 0.999 * np.interp(v, self.knots, self.values) + 0.001 * v if len(near) else self.prior
                own[k] = float(min(1.0, max(0.0, score))), self.ids[near]
            if len(seen) >= SEEN:
                seen.clear()
            seen.update(own)
            yield from (own[k] for k in keys)

    def score(self, text: str | None) -> tuple[float, np.ndarray]:
        return next(self.scores(pa.array([text], pa.string()), {}))


def _df(shared):
    def df(batches):
        vectors = shared.value
        n = np.zeros(len(vectors.keys), np.int64)
        rows = 0
        for batch in batches:
            for texts, _, term, _ in vectors.counts(batch.column("text")):
                rows += texts
                n += np.bincount(term, minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(n[some], rows))], names=["term", "n"])

    return df


def _weigh(shared):
    def weigh(batches):
        for batch in batches:
            got = list(shared.value(batch.column("text")))
            lists = [pa.array([x[k].astype(kind) for x in got], pa.list_(pa.from_numpy_dtype(kind))) for k, kind in ((0, np.int32), (1, np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *lists], names=["doc_id", "toxic", "at", "w"])

    return weigh


def _leave_one_out(shared):
    def leave(batches):
        model = shared.value
        for batch in batches:
            own = np.searchsorted(model.ids, batch.column("doc_id").to_numpy())
            votes = [model.vote(*x) for x in model.index.nearest(list(model.vectors(batch.column("text"))), NEIGHBOURS, own)]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(votes, pa.float64())], names=["place", "vote"])

    return leave


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from docs(doc_id, text) and labels(doc_id, toxic).

    Rows without a label of 0 or 1 are left out; a doc_id with both labels is toxic, and one with
    several texts has the first of them by order of the text.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) / 1e6
    rate = {k: min(1.0, EXAMPLES[k] / max(1, sizes.get(k, 0))) for k in (0, 1)}
    drawn = known.where(draw < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    sample = save(texts_of(docs).join(small(spark, drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).repartition(8), "examples")
    n = {0: 0, 1: 0} | {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    counted = sample.select("text", "toxic").mapInArrow(lean(_count), "toxic int, term long, n long").groupBy("term").agg(*[F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col("n"))), F.lit(0)).alias(c) for k, c in ((1, "a"), (0, "b"))]).toArrow()
    keys = counted.column("term").to_numpy().view(_U)
    order = np.argsort(keys)
    keys, delta = keys[order], odds(*[counted.column(c).to_numpy()[order] for c in ("a", "b")], n[1], n[0])
    del counted
    first = spark.sparkContext.broadcast(Vectors(keys, delta))
    seen, every = np.zeros(len(keys)), 0
    for r in docs.select("text").mapInArrow(lean(_df(first)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_batches():
        at, number = r.column("term").to_numpy(), r.column("n").to_numpy()
        seen[at[at >= 0]] = number[at >= 0]
        every += int(number[at < 0].sum())
    first.destroy()
    vectors = Vectors(keys, (np.log((1 + every) / (1 + seen)) + 1) * delta * delta)
    shared = spark.sparkContext.broadcast(vectors)
    rows = sample.select("doc_id", "text", "toxic").mapInArrow(lean(_weigh(shared)), "doc_id long, toxic int, at array<int>, w array<float>").toArrow().sort_by("doc_id").combine_chunks()
    shared.destroy()
    ids, label = rows.column("doc_id").to_numpy(), rows.column("toxic").to_numpy().astype(np.int64)
    term, value = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("at", "w"))
    cut = np.concatenate(([0], np.cumsum(pc.list_value_length(rows.column("at")).to_numpy()))).astype(np.int64)
    del rows
    index = BlockMaxIndex(term, value, cut, len(keys))
    prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
    model = Model(vectors, ids, index, label, np.where(label == 1, 1 / max(rate[1], 1e-9), 1 / max(rate[0], 1e-9)), prior)
    shared = spark.sparkContext.broadcast(model)
    votes = sample.select("doc_id", "text").mapInArrow(lean(_leave_one_out(shared)), "place long, vote double").toArrow().sort_by("place")
    shared.destroy()
    model.calibrate(votes.column("vote").to_numpy())
    return model


def _score(shared):
    def score(batches):
        model, seen = shared.value, {}
        for batch in batches:
            got = list(model.scores(batch.column("text"), seen))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s for s, _ in got], pa.float64()), pa.array([e for _, e in got], pa.list_(pa.int64()))], names=["doc_id", "score", "evidence"])

    return score


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, evidence) of every row of docs(doc_id, text, ...).

    evidence: doc_ids of all the neighbours that voted, nearest first; of equal cosines the smaller
    doc_id is nearer.  Null and empty texts, and texts without any weighed term, get the share of
    toxic labels and no evidence.  A long text is worked on whole, by itself.  Repeated rows are
    scored each for itself; other columns are ignored, whatever their names; an empty table gives an
    empty result; without labels every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return texts_of(docs).mapInArrow(lean(_score(shared)), "doc_id long, score double, evidence array<long>")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = fold("doc_id", 3) == 1
    model = fit(docs, labels.where(~held_out))
    out = toxicity(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
