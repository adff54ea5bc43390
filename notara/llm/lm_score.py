"""Language-model scores: context-tree weighting over bytes, beside an add-one word model.

Training counts every byte gram and every word of the training documents, each partition for
itself, and sums them.  The tree of grams stands in shards: all grams with the same last two context
bytes (65,536 at most) are in one shard, which has all nodes of contexts of two and more bytes.  The
nodes of shorter contexts (65,535 at most) are summed over the shards and go to all of them.  Values
of grams that hold more than one in FREQUENT_GRAMS of all bytes go to the executors, as do words that
hold more than one in FREQUENT of all tokens; all other grams and words, unseen ones too, are looked
up in shards (see _parcels).  So what is broadcast is bounded, and contexts are equally long at every size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _parcels as P
from ._ctw import Tree, Values, climb, grams, leaves
from ._shared import fold, lean, read, save
from ._text import bytes_of, pieces

DEPTH = 4  # bytes; a shard holds the grams of two context bytes, so each byte more makes the largest shards grow
FREQUENT_GRAMS = 1 << 20
FREQUENT = 500_000
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(depth: int):
    def count(batches):
        sums = {0: [], 1: []}
        held = texts = 0

        def flush():
            for kind, parts in sums.items():
                if parts:
                    keys, n = _merge(parts)
                    parts.clear()
                    for lo in range(0, len(keys), 50_000):
                        part = keys[lo : lo + 50_000]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part.view(np.int64)), pa.array(n[lo : lo + 50_000])], names=["kind", "key", "n"])

        for batch in batches:
            texts += batch.num_rows
            for p in pieces(batch.column("text"), 1 << 21):
                words = np.unique(p.hashes(True), return_counts=True)
                at = bytes_of(batch.column("text").slice(p.lo, p.hi - p.lo))[1]
                gram = np.unique(grams(_LOWER[p.data], at, depth)[0], return_counts=True)
                sums[0].append(gram)
                sums[1].append(words)
                held += len(words[0]) + len(gram[0])
                if held > 3_000_000:  # bounds the memory of a long partition
                    for kind in sums:
                        sums[kind] = [_merge(sums[kind])]
                    held = sum(len(x[0][0]) for x in sums.values())
                    if held > 1_500_000:
                        yield from flush()
                        held = 0
        yield from flush()
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())], names=["kind", "key", "n"])

    return count


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.select("key", "n").toArrow()
    key = table.column("key").to_numpy().view(_U)
    order = np.argsort(key)
    return key[order], table.column("n").to_numpy()[order]


def _gram_shard(gram: np.ndarray, bits: int) -> np.ndarray:
    """Shard of each gram by its last two context bytes."""
    return ((((gram >> _U(8)) & _U(0xFFFF)) * _U(40503) & _U(0xFFFF)) >> _U(16 - bits)).astype(np.int64)


def _gram_shard_of(key: str, bits: int):
    """The same of a column."""
    return F.shiftright((F.shiftright(key, 8).bitwiseAND(F.lit(0xFFFF)) * 40503).bitwiseAND(F.lit(0xFFFF)), 16 - bits).cast("int")


def _pairs(table) -> tuple[np.ndarray, np.ndarray]:
    return table.column("key").to_numpy().view(_U), table.column("n").to_numpy()


def _sprout(depth: int):
    """A shard's sums for the nodes of contexts of one byte (of none, at depth 0)."""

    def sprout(table):
        node, a, b, longer = climb(*leaves(*_pairs(table)), None, depth, 2)[1]
        return pa.table({"node": node.view(np.int64), "a": a, "b": b, "longer": np.zeros(len(node)) if longer is None else longer})

    return sprout


def _frequent(depth: int, top, floor: int):
    """Values of a shard's grams that occur more than floor times."""

    def frequent(table):
        gram, n = _pairs(table)
        some = gram[n > floor]
        return pa.table({"key": some.view(np.int64), "n": Tree(gram, n, depth, top.value).score(some) if len(some) else np.zeros(0)})

    return frequent


def _gram_reply(depth: int, top):
    def reply(keys, table):
        asked, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        values = Tree(*_pairs(table), depth, top.value).score(asked).astype(np.float32)
        return np.split(values[inverse], np.cumsum([len(k) for k in keys])[:-1])

    return reply


def _score(model, depth: int, bits: int, gram_bits: int):
    def score(batches):
        values, key, n, ends = (model.value[k] for k in ("values", "key", "n", "ends"))
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            for p in pieces(batch.column("text")):
                at = bytes_of(batch.column("text").slice(p.lo, p.hi - p.lo))[1]
                gram, cut = grams(_LOWER[p.data], at, depth)
                value, open_ = values.find(gram)
                code = np.add.reduceat(value, cut[:-1]) if len(gram) else np.zeros(0)
                asked, asker = np.unique(gram[open_], return_inverse=True)
                shard = _gram_shard(asked, gram_bits)
                order = np.argsort(shard, kind="stable")
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order))
                parts = P.split(asked[order], shard[order])
                h = p.hashes(True)
                at = np.minimum(np.searchsorted(key, h), max(0, len(key) - 1))
                known = key[at] == h if len(key) else np.zeros(len(h), bool)
                log = np.concatenate(([0.0], np.cumsum(np.where(known, np.log10((n[at] + 1) if len(key) else 1.0), 0.0))))
                common = np.concatenate(([0], np.cumsum(known)))
                rare = np.flatnonzero(~known)
                keys, inverse = np.unique(h[rare], return_inverse=True)
                words = np.diff(p.first)
                body = {
                    "doc_id": ids[p.lo : p.hi], "held_out": held[p.lo : p.hi], "n_bytes": np.diff(cut), "n_tokens": words + 1, "code": code, "asker": place[asker], "gram_cut": np.searchsorted(open_, cut),
                    "log": np.diff(log[p.first]) + np.log10(ends + 1), "known": np.diff(common[p.first]) + (ends > 0), "words": len(keys), "inverse": inverse.astype(np.int32), "cut": np.searchsorted(rare, p.first),
                }
                yield P.rows(body, keys, bits, parts)

    return score


def _reply(keys, table):
    known, n = _pairs(table)
    order = np.argsort(known)
    known, n = known[order], n[order]
    out = []
    for k in keys:
        at = np.minimum(np.searchsorted(known, k), max(0, len(known) - 1))
        out.append(np.where(known[at] == k, n[at], 0) if len(known) else np.zeros(len(k), np.int64))
    return out


def _finish(tokens: int, distinct: int):
    base = np.log10(tokens + distinct + 1)

    def finish(body, c):
        own = c[body["inverse"]] if len(body["inverse"]) else np.zeros(0)
        log = np.concatenate(([0.0], np.cumsum(np.log10(own + 1.0))))
        seen = np.concatenate(([0], np.cumsum(own > 0)))
        texts = np.repeat(np.arange(len(body["doc_id"])), np.diff(body["gram_cut"]))
        code = body["code"] + np.bincount(texts, c[body["words"] :][body["asker"]], len(body["doc_id"]))
        return pa.table({
            "doc_id": pa.array(body["doc_id"], pa.int64()), "held_out": pa.array(body["held_out"]), "n_tokens": pa.array(body["n_tokens"]), "n_known": pa.array(body["known"] + np.diff(seen[body["cut"]])),
            "train_tokens": pa.array(np.full(len(body["doc_id"]), tokens)), "base_score": pa.array(body["log"] + np.diff(log[body["cut"]]) - body["n_tokens"] * base), "score": pa.array(code * np.log10(2.0)),
            "n_bytes": pa.array(body["n_bytes"]), "bits_per_byte": pa.array(-code / body["n_bytes"]),
        })

    return finish


def lm_scores(docs: DataFrame, train: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Scores of every row of docs(doc_id, text, held_out), learning from train(text).

    Gives doc_id, held_out, n_tokens, n_known, train_tokens (long), base_score, score (log10 of the
    text's probability; double), n_bytes (the end included) and bits_per_byte (the code length by it)
    for every row.  Texts are lower-cased (A-Z); null is empty and has one token and one byte, the end.
    A long text is scored whole, by itself.  Repeated rows are scored each for itself; there are no
    ties.  Without training rows the base knows no token and every byte has the probability 1/256.
    Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    counts = save(train.select("text").mapInArrow(lean(_count(depth)), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.count("*").alias("keys"), F.sum("n").alias("n")).collect()}
    ends = sums[2]["n"] if 2 in sums else 0
    words = sums[1]["n"] if 1 in sums else 0
    tokens, distinct = words + ends, (sums[1]["keys"] if 1 in sums else 0) + (ends > 0)
    floor = words // FREQUENT
    key, n = _arrays(counts.where((F.col("kind") == 1) & (F.col("n") > floor)) if floor else counts.where(F.col("kind") == 1))
    gram_floor = sums[0]["n"] // FREQUENT_GRAMS if 0 in sums else 0
    rare = counts.where((F.col("kind") == 0) & (F.col("n") <= gram_floor)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits, gram_bits = P.shard_bits(int(0.2 * words)), min(16, P.shard_bits(max(4 * sums[0]["keys"] if 0 in sums else 0, rare)))
    gram = counts.where("kind = 0").select(_gram_shard_of("key", gram_bits).alias("shard"), "key", "n")
    table = gram.groupBy("shard").applyInArrow((_sprout(depth)), "node long, a double, b double, longer double").groupBy("node").agg(*[F.sum(c).alias(c) for c in ("a", "b", "longer")]).toArrow()
    node, a, b, longer = (table.column(c).to_numpy() for c in ("node", "a", "b", "longer"))
    order = np.argsort(node)
    top = spark.sparkContext.broadcast(climb(node[order].view(_U), a[order], b[order], longer[order] if depth > 1 else None, min(depth, 1), 0)[0])
    frequent = gram.groupBy("shard").applyInArrow((_frequent(depth, top, gram_floor)), "key long, n double")
    model = spark.sparkContext.broadcast({"values": Values(*_arrays(frequent)), "key": key, "n": n, "ends": ends})
    sent = P.send(docs.select("doc_id", "text", "held_out"), _score(model, depth, bits, gram_bits), "scored")
    known = counts.where((F.col("kind") == 1) & (F.col("n") <= floor)).select(P.shard_of("key", bits).alias("shard"), "key", "n")
    known = known.unionByName(gram.withColumn("shard", F.col("shard") + (1 << bits)))
    return P.answer(sent, known, _reply, _finish(tokens, distinct), np.float64, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double", other=(1 << bits, _gram_reply(depth, top)))


def op9_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held_out"))
    return lm_scores(docs, docs.where("NOT held_out"))
