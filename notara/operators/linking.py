"""Linking mentions to ontologies: exact aliases, BM25, dense vectors, rank fusion, reranking, decision."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.text import confidence, mention_key, mention_key_py, tokens
from ..schemas import DOUBLE, STRING
from ..tables import save
from .models import answer

# Retrieval, fusion and decision parameters.
K1, B, RETRIEVE, RRF_K, FUSED, RERANKED = 1.5, 0.75, 20, 60, 30, 5
MARGIN, LEAST_CONFIDENCE = 0.04, 0.35
# What a text model is asked.
CHOICE_PROMPT = "Chọn đúng một mã ontology phù hợp nhất. Nếu không đủ thông tin, trả null. Chỉ trả JSON."
CHOICE_SCHEMA = 'Schema: {"code": "string|null"}'
#: An ontology side is broadcast when it has at most this many rows (it is counted first).
BROADCAST_ROWS = 200_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def search_text() -> Column:
    return F.concat_ws(" ", "name", "aliases", "description")


# ---- exact aliases ------------------------------------------------------------------------------


def alias_index(ontology: DataFrame) -> DataFrame:
    """(alias_key, code): each code once for each key; empty keys are left out."""
    names = F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))))
    return ontology.select("code", names.alias("alias")).select(mention_key("alias").alias("alias_key"), "code").where("alias_key != ''").distinct()


def exact(mentions: DataFrame, index: DataFrame, text: str = "mention") -> DataFrame:
    """mentions with a row for each code that has the mention's key."""
    return mentions.withColumn("alias_key", mention_key(text)).join(_small(index), "alias_key")


def exact_counts(mentions: DataFrame, index: DataFrame, key: str = "query_id", text: str = "mention") -> DataFrame:
    """(key, n, first_code) of the mentions that have exact codes: how many there are, and the least.

    The index is summed up by key first, so a key of many codes is one row of the join and not one for
    each mention and code.
    """
    per = index.groupBy("alias_key").agg(F.count("*").alias("n"), F.min("code").alias("first_code"))
    return mentions.select(key, mention_key(text).alias("alias_key")).join(_small(per), "alias_key").groupBy(key).agg(F.sum("n").alias("n"), F.min("first_code").alias("first_code"))


# ---- BM25 ---------------------------------------------------------------------------------------


def postings(ontology: DataFrame, text: Column | None = None) -> DataFrame:
    """(code, term, tf, idf, norm): inverted index with each posting's parts of the BM25 weight."""
    term = ontology.select("code", tokens(text if text is not None else search_text()).alias("terms"))
    size = term.select("code", F.size("terms").alias("len"))
    stats = size.agg(F.count("*").alias("n"), F.avg("len").alias("avg"))
    tf = term.select("code", F.size("terms").alias("len"), F.explode("terms").alias("term")).groupBy("code", "len", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    return tf.join(df, "term").crossJoin(F.broadcast(stats)).select(  # stats is one row
        "code", "term", "tf",
        F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"),
        (K1 * (1 - B + B * F.col("len") / F.greatest(F.col("avg"), F.lit(1.0)))).alias("norm"),
    )


def bm25(queries: DataFrame, index: DataFrame, top: int = RETRIEVE, key: str = "query_id", order: str = "code", text: str = "query") -> DataFrame:
    """(key, code, score, rank): the best entries of each query by its terms' postings; a repeated term counts again."""
    term = queries.select(key, F.explode(tokens(text)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("times"))
    part = F.col("times") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + F.col("norm"))
    # postings stream past the queries' terms while those are few, so that no term's long list is one task
    scored = index.join(_small(term), "term").groupBy(key, "code").agg(F.sum(part).alias("score")).where("score > 0")
    return ranked(scored, key, [F.desc(F.round("score", 9)), order], top)


def ranked(rows: DataFrame, key: str, order: list, top: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("rank") <= top)


# ---- dense vectors ------------------------------------------------------------------------------


#: Queries and entries of a block pair, and the queries of a block whose scores are held at a time.
QUERY_BLOCK, ENTRY_BLOCK, SLICE = 4_096, 16_384, 64


def dense(queries: DataFrame, entries: DataFrame, top: int = RETRIEVE) -> DataFrame:
    """(query_id, code, score, rank) by cosine: every query(query_id, vector) against every entry(code, vector).

    Both sides are cut into blocks by hash; each pair of blocks is one matrix product, of which only the
    best `top` of each query go on.  No block grows with the tables.  Zero and null vectors score 0.
    """
    spans = [max(1, -(-df.count() // size)) for df, size in ((queries, QUERY_BLOCK), (entries, ENTRY_BLOCK))]
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    doubles = F.transform("vector", lambda x: x.cast("double")).alias("vector")
    left = queries.select(F.struct("query_id").alias("q"), doubles, place("query_id", spans[0]).alias("i")).withColumn("j", every(spans[1]))
    right = entries.select("code", doubles, place("code", spans[1]).alias("j")).withColumn("i", every(spans[0]))
    number = left.schema["q"].dataType.fields[0].dataType.simpleString()
    hits = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(_multiply(top), f"q struct<query_id:{number}>, code string, score double")
    return ranked(hits.select("q.query_id", "code", "score"), "query_id", [F.desc(F.round("score", 9)), "code"], top)


def _units(vectors) -> np.ndarray:
    """The vectors divided by their lengths, as rows."""
    width = max((len(v.values) for v in vectors if v.is_valid), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        if v.is_valid:
            out[i, : len(v.values)] = v.values.to_numpy(zero_copy_only=False)
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(size > 0, size, 1.0)


def _multiply(top: int):
    def multiply(queries, entries):
        codes = entries.column("code").to_pylist()
        order = np.array(sorted(range(len(codes)), key=lambda i: codes[i]), np.int64)  # ties go by code
        a, b = _units(queries.column("vector")), _units(entries.column("vector"))
        if not len(a) or not len(b):
            return pa.table({"q": queries.column("q").slice(0, 0), "code": pa.array([], pa.string()), "score": pa.array([], pa.float64())})
        b = b[order]
        k = min(top, len(order))
        row, code, score = [], [], []
        for lo in range(0, len(a), SLICE):
            cosine = a[lo : lo + SLICE] @ b.T
            best = np.argsort(-np.round(cosine, 9), axis=1, kind="stable")[:, :k]
            row.append(np.repeat(np.arange(lo, lo + len(best)), k))
            code.append(order[best].ravel())
            score.append(np.take_along_axis(cosine, best, axis=1).ravel())
        return pa.table({"q": queries.column("q").take(pa.array(np.concatenate(row))), "code": pa.array([codes[i] for i in np.concatenate(code)], pa.string()), "score": pa.array(np.concatenate(score))})

    return multiply


def dense_retriever(encode: Callable[[list[str]], list], entries: DataFrame, top: int = RETRIEVE) -> Callable[[DataFrame], DataFrame]:
    """A retriever for link(): encode(texts) gives their vectors; entries(code, vector) are the ontology's."""

    @pandas_udf("array<double>")
    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([[float(x) for x in v] for v in encode(texts.tolist())])

    def retrieve(queries: DataFrame, key: str = "query_id") -> DataFrame:
        found = dense(queries.select(F.col(key).alias("query_id"), vectors("query").alias("vector")), entries, top)
        return found.withColumnRenamed("query_id", key)

    return retrieve


# ---- fusion and reranking -----------------------------------------------------------------------


def fuse(*hits: DataFrame, key: str = "query_id", k: int = RRF_K, top: int = FUSED) -> DataFrame:
    """(key, code, fused_score, retrieval_scores, rank): reciprocal rank fusion of hits(key, code, score, rank, source).

    Ties go to the code met first: earlier source, then better rank.
    """
    every = hits[0].withColumn("_s", F.lit(0))
    for i, h in enumerate(hits[1:], 1):
        every = every.unionByName(h.withColumn("_s", F.lit(i)))
    best = every.groupBy(key, "code", "source").agg(F.max("score").alias("score"), F.sum(1.0 / (k + F.col("rank"))).alias("part"), F.min(F.struct("_s", "rank")).alias("first"))
    fused = best.groupBy(key, "code").agg(F.sum("part").alias("fused_score"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "score")))).alias("retrieval_scores"), F.min("first").alias("_first"))
    return ranked(fused, key, [F.desc(F.round("fused_score", 12)), "_first", "code"], top).drop("_first")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token arrays as sets; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


@pandas_udf(DOUBLE)
def best_ratio(mention: pd.Series, names: pd.Series) -> pd.Series:
    """Greatest sequence similarity of the mention's key with the keys of the names."""
    out = []
    for m, options in zip(mention, names, strict=True):
        key = mention_key_py(m or "")
        out.append(max((SequenceMatcher(None, key, mention_key_py(x)).ratio() for x in options), default=0.0))
    return pd.Series(out)


def lexical_rerank(candidates: DataFrame, key: str = "query_id", top: int = RERANKED, order: str = "rank") -> DataFrame:
    """candidates(key, mention, query, code, name, aliases, description, rank) with final_score and a new rank."""
    names = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    score = 0.75 * best_ratio("mention", names) + 0.25 * jaccard(tokens("query"), tokens(search_text()))
    scored = candidates.withColumn("final_score", score)
    return ranked(scored.withColumnRenamed("rank", "_before") if order == "rank" else scored, key, [F.desc(F.round("final_score", 12)), "_before" if order == "rank" else order], top).drop("_before")


def query_text(ontology: str, mention: str | Column = "mention", context: str | Column = "context") -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat(F.lit(f"{ontology} entity: "), c(mention), F.lit("\nContext: "), c(context))


# ---- decision -----------------------------------------------------------------------------------


def decide(candidates: DataFrame, key: str = "query_id", margin: float = MARGIN, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """One row for each key of candidates(key, code, final_score, rank): selected_code, confidence, method, needs_review, candidates."""
    per = candidates.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "code", "final_score"))).alias("_all"))
    first, second = confidence(F.get("_all", F.lit(0))["final_score"]), F.coalesce(confidence(F.get("_all", F.lit(1))["final_score"]), F.lit(0.0))
    ambiguous = (F.size("_all") > 1) & (F.abs(first - second) < margin)
    picked = F.when(first >= least, F.get("_all", F.lit(0))["code"])
    return per.select(
        key, picked.alias("selected_code"), first.alias("confidence"),
        F.when(picked.isNull(), "below_threshold").otherwise("hybrid_reranker").alias("method"),
        (ambiguous | picked.isNull()).alias("needs_review"), F.transform("_all", lambda x: x["code"]).alias("candidates"), ambiguous.alias("ambiguous"),
    )


def disambiguate(decided: DataFrame, chooser: Callable[[str, list[str]], str | None], texts: DataFrame, key: str = "query_id") -> DataFrame:
    """Ambiguous rows go through chooser(query, codes) -> code; a code that is among the candidates wins.  texts(key, query)."""

    @pandas_udf(STRING)
    def choose(queries: pd.Series, candidates: pd.Series) -> pd.Series:
        return pd.Series([chooser(q, list(c)) for q, c in zip(queries, candidates, strict=True)], dtype="object")

    # the filter stands before the Python stage
    doubtful = decided.where("ambiguous").join(texts.select(key, "query"), key).withColumn("_c", choose("query", "candidates"))
    won = F.coalesce(F.array_contains("candidates", F.col("_c")), F.lit(False))
    judged = doubtful.withColumns({
        "selected_code": F.when(won, F.col("_c")).otherwise(F.col("selected_code")), "method": F.when(won, "local_disambiguator").otherwise(F.col("method")),
        "needs_review": F.when(won, False).otherwise(F.col("needs_review")), "ambiguous": ~won,
    })
    return decided.where("NOT ambiguous").unionByName(judged.select(*decided.columns))


def generating_chooser(name: str, entries: DataFrame, tokens_out: int = 48) -> Callable[[str, list[str]], str | None]:
    """A chooser by a local text model; entries(code, name, description) are the ontology's, held by each worker."""
    options = {r["code"]: f"{r['code']}: {r['name']} | {r['description'] or ''}" for r in entries.select("code", "name", "description").toLocalIterator()}

    def choose(query: str, codes: list[str]) -> str | None:
        listed = "\n".join("- " + options[c] for c in codes if c in options)
        said = answer(name, f"{CHOICE_PROMPT}\nQuery:\n{query}\nCandidates:\n{listed}\n{CHOICE_SCHEMA}", tokens_out)
        return None if not isinstance(said, dict) or said.get("code") is None else str(said["code"])

    return choose


def link(mentions: DataFrame, ontology: DataFrame, name: str, key: str = "query_id", least: float = LEAST_CONFIDENCE, reranker=lexical_rerank, retrievers: tuple = (), chooser=None, margin: float = MARGIN) -> DataFrame:
    """(key, selected_code, confidence, method, needs_review, candidates) of mentions(key, mention, context).

    A mention with exactly one exact code is done.  One with several reranks those; the others rerank
    the fusion of what BM25 and the given retrievers (see dense_retriever) find.  An ambiguous decision
    goes to chooser(query, codes) if there is one.  Mentions without candidates are `not_found`.
    """
    hits = save(exact(mentions.select(key, "mention"), alias_index(ontology)).select(key, "code"), "exact")
    per = hits.groupBy(key).agg(F.count("*").alias("n"), F.min("code").alias("only"))
    named = save(mentions.select(key, "mention").join(per, key, "left"), "mentions")
    one = named.where("n = 1").select(key, F.col("only").alias("selected_code"), F.lit(1.0).alias("confidence"), F.lit("exact_alias").alias("method"), F.lit(False).alias("needs_review"), F.array("only").alias("candidates"))
    rest = named.where("n IS NULL OR n > 1")
    if rest.isEmpty():
        return one
    # only these need their context
    rest = save(rest.join(mentions.select(key, "context"), key).withColumn("query", query_text(name)).drop("context"), "queries")
    many = hits.join(named.where("n > 1").select(key), key, "left_semi").withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy("code"))).select(key, "code", "rank")
    searched = rest.where("n IS NULL").select(key, "query")
    found = [bm25(searched, postings(ontology), RETRIEVE, key).withColumn("source", F.lit("bm25"))]
    found += [r(searched, key).withColumn("source", F.lit("dense" if len(retrievers) == 1 else f"dense{i}")) for i, r in enumerate(retrievers)]
    fused = fuse(*found, key=key).select(key, "code", "rank")
    candidates = many.unionByName(fused).join(rest.select(key, "mention", "query"), key).join(_small(ontology), "code")
    decided = save(decide(reranker(candidates, key), key, margin, least), "decided")
    if chooser is not None:
        decided = disambiguate(decided, chooser, rest.select(key, "query"), key)
    none = rest.select(key).join(decided.select(key), key, "left_anti").select(key, F.lit(None).cast("string").alias("selected_code"), F.lit(0.0).alias("confidence"), F.lit("not_found").alias("method"), F.lit(False).alias("needs_review"), F.array().cast("array<string>").alias("candidates"))
    return one.unionByName(decided.drop("ambiguous")).unionByName(none)


def cross_encoder(name: str, top: int = RERANKED):
    """A reranker for link() by a sentence-pair model of that name; its library is imported in the workers only."""

    def rerank(candidates: DataFrame, key: str = "query_id") -> DataFrame:
        @pandas_udf(DOUBLE)
        def score(queries: pd.Series, texts: pd.Series) -> pd.Series:
            return pd.Series(_pair_model(name).predict(list(zip(queries, texts, strict=True))), dtype="float64")

        scored = candidates.withColumn("final_score", score("query", search_text())).withColumnRenamed("rank", "_before")
        return ranked(scored, key, [F.desc("final_score"), "_before"], top).drop("_before")

    return rerank


@lru_cache(maxsize=1)
def _pair_model(name: str):
    from sentence_transformers import CrossEncoder

    return CrossEncoder(name)


def route(entities: DataFrame, links: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """entities with candidates from the links of their type; other types pass through with their own."""
    routed = entities
    found = None
    for kind, rows in links.items():
        own = rows.select(*key, F.lit(kind).alias("entity_type"), F.col("candidates").alias("_linked"))
        found = own if found is None else found.unionByName(own)
    if found is None:
        return routed
    joined = routed.join(found, [*key, "entity_type"], "left")
    return joined.withColumn("candidates", F.coalesce("_linked", "candidates")).drop("_linked")
