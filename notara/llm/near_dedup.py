"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard, components.

1. One scan gives each document's shingle-set size, a 128-bit key of the set, and band keys of a
   circulant MinHash signature (two permutations; the second is shifted for every coordinate).
2. Documents with equal sets are one class and only its least doc_id goes on.
3. Each band bucket links its least member (hub) with every other member; the full sets confirm.
4. Buckets that still hold several components compare those that are not in the bucket's largest
   component with all its members, in blocks.  Long one-byte signatures leave out pairs whose
   estimated similarity is far below the threshold; the full sets confirm the rest.
5. Confirmed links give connected components.

None is cut.  A bucket of m members of one group costs m pairs; one of unlike members costs m * m /
BLOCK rows of the block stage, which compares each pair once by its one-byte signature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._minhash import band_keys, overlap, shingle_sets, signatures
from ._shared import attach, lean, read, save, small, texts_of
from ._text import mix, pieces
from .components import connected_components

BANDS, ROWS = 16, 3  # a pair at similarity 0.75 shares no bucket with probability 0.00016
WIDE = 1024
BLOCK = 1024  # members of a bucket that meet as many others in one task
HUB = 1024  # pairs of a hub in one task
_U = np.uint64


def _scan(n_words: int):
    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for p in pieces(batch.column("text")):
                sets = shingle_sets(p, n_words)
                sizes = np.array([len(s) for s in sets], np.int64)
                keys = np.zeros((len(sets), 2), _U)
                bands = np.zeros((len(sets), BANDS), _U)
                full = np.flatnonzero(sizes)
                if len(full):
                    some = [sets[i] for i in full]
                    flat = np.concatenate(some)
                    at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                    keys[full, 0] = np.add.reduceat(mix(flat ^ _U(0x5851F42D4C957F2D)), at)
                    keys[full, 1] = np.add.reduceat(mix(flat ^ _U(0x14057B7EF767814F)), at)
                    bands[full] = band_keys(signatures(some, BANDS * ROWS), ROWS)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(p.lo, p.hi - p.lo), pa.array(sizes), pa.array(keys[:, 0].copy().view(np.int64)), pa.array(keys[:, 1].copy().view(np.int64)), lists], names=["doc_id", "n_shingles", "k1", "k2", "bands"])

    return scan


def _confirm(n_words: int, percent: int):
    def confirm(batches):
        for batch in batches:
            # rows of one hub stand together: its text is worked on once
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            left = batch.column("text_a").dictionary_encode()
            hubs = [s for p in pieces(left.dictionary) for s in shingle_sets(p, n_words)]
            which = left.indices.to_numpy()
            ok = np.zeros(batch.num_rows, bool)
            for p in pieces(batch.column("text_b")):
                for i, other in enumerate(shingle_sets(p, n_words), p.lo):
                    hub = hubs[which[i]]
                    same = overlap(hub, other)
                    ok[i] = 100 * same >= percent * (len(hub) + len(other) - same) and same > 0
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    return confirm


def _links(texts: DataFrame, pairs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    spark = texts.sparkSession
    ids = save(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    some = save(texts.join(small(spark, ids), "doc_id", "left_semi"), "texts")
    # a hub of many pairs stands in several copies, so that no task has all of its pairs
    hubs = save(pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("copies", F.ceil(F.col("n") / HUB).cast("int")), "hubs")
    spread = attach(pairs, hubs, ["a"], "n", pairs.count()).withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int")).select("a", "b", "copy")
    texts_a = hubs.join(some.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "text_a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    rows = spread.join(some.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(texts_a, ["a", "copy"])
    return save(rows.select("a", "b", "text_a", "text_b").mapInArrow(lean(_confirm(n_words, percent)), "a long, b long"), "links")


def _wide(n_words: int):
    def wide(batches):
        for batch in batches:
            for p in pieces(batch.column("text")):
                sets = shingle_sets(p, n_words)
                keep = [i for i, s in enumerate(sets) if len(s)]
                sig = (signatures([sets[i] for i in keep], WIDE) & _U(255)).astype(np.uint8) if keep else np.empty((0, WIDE), np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array([p.lo + i for i in keep], pa.int64())), pa.array([x.tobytes() for x in sig], pa.binary())], names=["rep", "wide"])

    return wide


def _block(percent: int):
    # below this many equal bytes a pair at the threshold is 4 standard deviations off
    j = percent / 100
    p = j + (1 - j) / 256
    least = WIDE * p - 4 * (WIDE * p * (1 - p)) ** 0.5

    def block(key, table):
        band = int(key[0].as_py())
        rep, comp = table.column("rep").to_numpy(), table.column("component").to_numpy()
        odd = table.column("odd").to_numpy(zero_copy_only=False)
        wide = np.frombuffer(b"".join(table.column("wide").to_pylist()), np.uint8).reshape(-1, WIDE)
        keys = np.array(table.column("bands").to_pylist(), np.int64).reshape(len(rep), -1)
        every = np.unique(rep, return_index=True)[1]  # each document once as a partner
        found = []
        for i in np.flatnonzero(odd):
            other = every[(comp[every] != comp[i])]
            if not len(other):
                continue
            shared = keys[other] == keys[i]
            at = np.argmax(shared, axis=1)
            other = other[shared.any(axis=1) & (at == band)]  # only in the first band that they share
            other = other[(wide[other] == wide[i]).sum(axis=1) >= least]
            found.append((np.minimum(rep[i], rep[other]), np.maximum(rep[i], rep[other])))
        a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
        b = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return block


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs(doc_id, text, ...).

    Words are lower-cased (A-Z).  Null or empty texts, and texts without a word, have an empty set
    and no link.  Long texts are compared whole.  A group's tie is broken by doc_id.  Texts of fewer than n_words words are one shingle.  Rows that repeat a doc_id
    are one document of the graph; a null doc_id is linked with nothing and kept (its component_id
    is null).  Other columns of docs are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = texts_of(docs)
    sig = save(texts.mapInArrow(lean(_scan(n_words)), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"), "signatures")
    classes = save(sig.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.count("*").alias("size")), "classes")
    total = sig.count()
    member = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    hubs = save(member.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("m")).where("m > 1"), "hubs")
    buckets = save(attach(member, hubs, ["key"], "m", total * BANDS), "buckets")
    pairs = save(buckets.where("hub != rep").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = _links(texts, pairs, n_words, percent)
    first = save(connected_components(links), "components")
    # buckets of several components
    labelled = save(buckets.drop("m", "hub").join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")), "labelled")
    per = labelled.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    mixed = per.groupBy("band", "key").agg(F.sum("n").alias("m"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("k")).where("k > 1")
    left = save(attach(labelled, save(mixed.drop("k"), "mixed"), ["band", "key"], "m", total * BANDS), "left")
    ids = save(left.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    wide = texts.join(small(spark, ids), "doc_id", "left_semi").mapInArrow(lean(_wide(n_words)), "rep long, wide binary").dropDuplicates(["rep"])
    about = save(wide.join(classes.groupBy("rep").agg(F.min("bands").alias("bands")), "rep"), "wide")
    rows = left.withColumns({"odd": F.col("component") != F.col("main"), "no": F.ceil((F.col("m") - F.col("most")) / BLOCK).cast("int"), "nm": F.ceil(F.col("m") / BLOCK).cast("int")})
    h = F.abs(F.xxhash64("rep") % 1_000_003).cast("int")
    as_odd = rows.where("odd").select("band", "key", "rep", "component", F.lit(True).alias("odd"), (h % F.col("no")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("nm") - 1)).alias("j"))
    as_any = rows.select("band", "key", "rep", "component", F.lit(False).alias("odd"), F.explode(F.sequence(F.lit(0), F.col("no") - 1)).alias("i"), (h % F.col("nm")).alias("j"))
    # where both roles meet in one bucket block the odd row also stands for the other
    blocks = as_odd.union(as_any).join(about, "rep")
    more = save(blocks.groupBy("band", "key", "i", "j").applyInArrow(_block(percent), "a long, b long").distinct(), "pairs")
    links2 = _links(texts, more, n_words, percent)
    nodes = save(connected_components(links.union(links2)), "components")
    final = classes.select("k1", "k2", "rep", "size").join(nodes.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", "size", F.coalesce("component", "rep").alias("component_id"))
    linked = "n_shingles > 0 AND doc_id IS NOT NULL"
    rows = sig.drop("bands")
    alone = rows.where(f"NOT ({linked})").withColumn("component_id", F.col("doc_id"))
    out = attach(rows.where(linked), save(final, "final"), ["k1", "k2"], "size", total).drop("size").unionByName(alone)
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), (F.col("doc_id").isNull() | (F.coalesce("component_id", "doc_id") == F.col("doc_id"))).alias("kept"))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [len(w) || ' words ' || array_to_string(w, ' ')] ELSE [] END AS g FROM d),
s AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM l),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.root)
SELECT l.doc_id, len(g)::BIGINT AS n_shingles, min(r.root) AS component_id, min(r.root) = l.doc_id AS kept FROM l JOIN r USING (doc_id) GROUP BY l.doc_id, g
"""
