"""Passages that occur more than once, by a count-min prefilter and an exact second pass.

A window is 35 consecutive words of one text.  Its sketch key is the least hash among the 16-word
grams inside it, so neighbouring windows share keys and about one word in ten is counted; windows
with the same words have the same key at as many different places, so a key's count is never less
than the window's.

1. Each partition counts its keys in two rows of a count-min sketch, as lists of cells by page; the
   pages of all partitions are merged, and each merged page keeps one bit a cell: counted twice or more.
2. With those bits each text finds the windows that are estimated repeated.  Texts without any are
   done.  The others' windows go to their hash's shard (see _parcels), which counts them exactly.
   The bits are broadcast while a sketch row has at most MOST_CELLS cells; those of a larger sketch stay
   in shards of whole pages, and the texts' cells are looked up there.
3. Each parcel of texts gets its answers back and removes the covered words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _parcels as P
from ._shared import lean, read, save, texts_of
from ._text import SPACES, Words, bytes_of, inside, pieces, rolled

WINDOW, GRAM = 35, 16
ROWS, PAGE = 2, 1 << 16
#: A sketch row has about 4 cells for each key.  The merged bits of 2 ** 29 cells, the most that are broadcast,
#: are 128 MB for both rows.
MOST_CELLS = 1 << 29
HELD = 2_000_000
_STEPS = [np.uint64(0x9E3779B97F4A7C15)]  # odd, one for each sketch row after the first
_U = np.uint64


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values, by doubling."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def windows(words: Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, their sketch keys, and the keys of all places that are counted."""
    if len(hashes) < window:
        return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, _U)
    g = rolled(hashes, gram)
    span = window - gram + 1
    key = _least(g, span)
    place = np.flatnonzero(inside(words.first, len(hashes), window))
    valid = np.zeros(len(g) + span - 1, _U)  # the greatest key of the windows that hold gram j
    valid[span - 1 :][place] = key[place]
    top = ~_least(~valid, span)
    return place, key[place], g[top == g]


def cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    """The keys' cells in a sketch row: their last bits, or the first ones of a multiple."""
    if not row:
        return (keys & _U(width - 1)).astype(np.int64)
    return ((keys * _STEPS[row - 1]) >> _U(65 - width.bit_length())).astype(np.int64)


def _sketch(width: int, window: int, gram: int):
    def pages(keys: np.ndarray):
        for row in range(ROWS):
            cell, n = np.unique(cells(keys, row, width), return_counts=True)
            page = cell // PAGE
            cut = np.flatnonzero(np.diff(page, prepend=-1))
            low = (cell % PAGE).astype(np.uint16)
            parts = [(low[a:b], n[a:b] > 1) for a, b in zip(cut, [*cut[1:], len(cell)], strict=True)]
            for lo in range(0, len(parts), 4096):
                some = parts[lo : lo + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), row, np.int32)), pa.array(page[cut[lo : lo + 4096]].astype(np.int32)), pa.array([x.tobytes() for x, _ in some], pa.binary()), pa.array([x[m].tobytes() for x, m in some], pa.binary())],
                    names=["row", "page", "cells", "twice"],
                )

    def sketch(batches):
        parts, held = [], 0
        for batch in batches:
            for p in pieces(batch.column("text")):
                keys = windows(p, p.hashes(), window, gram)[2]
                parts.append(keys)
                held += len(keys)
                if held > HELD:
                    yield from pages(np.concatenate(parts))
                    parts, held = [], 0
        if held:
            yield from pages(np.concatenate(parts))

    return sketch


def _merge(key, table):
    seen, twice = np.zeros(PAGE, bool), np.zeros(PAGE, bool)
    for once, more in zip(table.column("cells"), table.column("twice"), strict=True):
        at = np.frombuffer(once.as_py(), np.uint16)
        twice[at] |= seen[at]
        seen[at] = True
        twice[np.frombuffer(more.as_py(), np.uint16)] = True
    bits = np.packbits(twice, bitorder="little")
    return pa.table({"row": pa.array([key[0].as_py()], pa.int32()), "page": pa.array([key[1].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})


def merged_pages(texts: DataFrame, width: int, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row, page, bits): of each page of each sketch row the packed bits of the cells that are counted at least twice."""
    return texts.mapInArrow(lean(_sketch(width, window, gram)), "row int, page int, cells binary, twice binary").groupBy("row", "page").applyInArrow(_merge, "row int, page int, bits binary")


def repeated_cells(texts: DataFrame, width: int, window: int = WINDOW, gram: int = GRAM) -> list[np.ndarray]:
    """The merged bits of each sketch row as one array."""
    merged = merged_pages(texts, width, window, gram)
    bits = [np.zeros(max(1, width // 8), np.uint8) for _ in range(ROWS)]
    for r in merged.toLocalIterator():
        bits[r["row"]][r["page"] * PAGE // 8 : (r["page"] + 1) * PAGE // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _joined(p: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, each followed by a space, and the place where each text begins."""
    size = np.where(keep, p.ends - p.starts + 1, 0)
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.full(at[-1], 32, np.uint8)
    flow = ~SPACES[p.data]
    word = np.repeat(keep, p.ends - p.starts)
    target = np.ones(at[-1], bool)
    target[at[1:][keep] - 1] = False
    out[target] = p.data[flow][word]
    return out, at[p.first]


def _digests(p: Words, keep: np.ndarray) -> list[str]:
    out, cut = _joined(p, keep)
    view = memoryview(out)
    return [hashlib.sha256(view[a : max(a, b - 1)]).hexdigest() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _parcel(ids: list, p: Words, h: np.ndarray, place: np.ndarray, lengths: np.ndarray, window: int, shard_bits: int) -> pa.RecordBatch:
    """The parcel of texts whose windows at `place` may be repeated."""
    whole = rolled(h, window)[place] if len(place) else np.empty(0, _U)
    keys = np.unique(whole)
    # the texts themselves go along only where a window may be removed
    doc = np.searchsorted(p.first, place, "right") - 1
    needed = np.zeros(len(p.first) - 1, bool)
    needed[doc] = True
    count = np.diff(p.first)
    done = np.array(_digests(p, np.ones(len(h), bool)), dtype=object)
    starts = np.diff(place, prepend=-2) != 1
    run = np.flatnonzero(starts)
    body = {
        "doc_id": ids, "n_words": count, "digest": done[~needed].tolist(), "needed": needed,
        "text": p.data[np.repeat(needed, lengths)].tobytes(), "lengths": lengths[needed], "keys": keys[:0],
        # runs of places, counted in the words of the needed texts only
        "run": (np.concatenate(([0], np.cumsum(np.where(needed, count, 0))))[doc[run]] + place[run] - p.first[doc[run]]), "length": np.diff(np.append(run, len(place))),
    }
    return P.rows(body, keys, shard_bits)


def _candidates(bits, width: int, window: int, gram: int, shard_bits: int):
    def scan(batches):
        rows = bits.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for p in pieces(batch.column("text")):
                h = p.hashes()
                place, key, _ = windows(p, h, window, gram)
                maybe = np.ones(len(place), bool)
                for r in range(ROWS):
                    cell = cells(key, r, width)
                    maybe &= (rows[r][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                at = bytes_of(batch.column("text").slice(p.lo, p.hi - p.lo))[1]
                yield _parcel(ids[p.lo : p.hi], p, h, place[maybe], np.diff(at), window, shard_bits)

    return scan


# ---- a sketch in shards ---------------------------------------------------------------------------


def _lookups(key: np.ndarray, width: int) -> np.ndarray:
    """The cells of the keys in all rows as 64-bit numbers whose leading bits are row and cell: row by row."""
    free = _U(64 - (ROWS * width).bit_length() + 1)
    return np.concatenate([(cells(key, r, width) + r * width).astype(_U) << free for r in range(ROWS)])


def _ask(width: int, window: int, gram: int, cell_bits: int):
    def scan(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for p in pieces(batch.column("text")):
                _, key, _ = windows(p, p.hashes(), window, gram)
                at = bytes_of(batch.column("text").slice(p.lo, p.hi - p.lo))[1]
                yield P.rows({"doc_id": ids[p.lo : p.hi], "text": p.data.tobytes(), "lengths": np.diff(at)}, np.unique(_lookups(key, width)), cell_bits)

    return scan


def _look_up(width: int):
    def look_up(keys, table):
        free = _U(64 - (ROWS * width).bit_length() + 1)
        pages = {(r, n): np.frombuffer(b.as_py(), np.uint8) for r, n, b in zip(table.column("row").to_pylist(), table.column("page").to_pylist(), table.column("bits"), strict=True)}
        out = []
        for k in keys:
            row, cell = np.divmod((k >> free).astype(np.int64), width)
            page, low = np.divmod(cell, PAGE)
            hit = np.zeros(len(k), bool)
            first = np.flatnonzero((np.diff(page, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))  # keys are sorted
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(k)], strict=True):
                bits = pages.get((int(row[a]), int(page[a])))
                if bits is not None:
                    hit[a:b] = (bits[low[a:b] >> 3] >> (low[a:b] & 7).astype(np.uint8)) & 1 == 1
            out.append(hit)
        return out

    return look_up


def _texts(body: dict) -> pa.LargeStringArray:
    offsets = np.concatenate(([0], np.cumsum(body["lengths"])))
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(body["text"]))


def _told(width: int, window: int, gram: int, shard_bits: int):
    """The parcels of the exact pass, from a parcel of texts and the answers about its cells."""

    def told(body, hit):
        (p,) = pieces(_texts(body), 1 << 62)
        h = p.hashes()
        place, key, _ = windows(p, h, window, gram)
        asked = _lookups(key, width)
        found = hit[np.searchsorted(np.unique(asked), asked)] if len(asked) else np.empty(0, bool)
        maybe = found.reshape(ROWS, -1).all(axis=0)
        return pa.Table.from_batches([_parcel(body["doc_id"], p, h, place[maybe], body["lengths"], window, shard_bits)])

    return told


def _sharded(texts: DataFrame, width: int, window: int, gram: int, shard_bits: int) -> DataFrame:
    cell_bits = max(3, (ROWS * width // (256 * PAGE)).bit_length())  # 256 pages of 8 KB in a shard
    pages = save(merged_pages(texts.select("text"), width, window, gram), "pages")
    per = ROWS * width >> cell_bits  # cells of a shard
    table = pages.withColumn("shard", F.floor((F.col("row").cast("long") * width + F.col("page").cast("long") * PAGE) / per).cast("int")) if per >= PAGE else None
    if table is None:  # a page spans shards
        spans = PAGE // per
        table = pages.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(spans - 1)))).withColumn("shard", (F.floor((F.col("row").cast("long") * width + F.col("page").cast("long") * PAGE) / per) + F.col("shard")).cast("int"))
    asked = P.send(texts, _ask(width, window, gram, cell_bits), "asked")
    return save(P.answer(asked, table, _look_up(width), _told(width, window, gram, shard_bits), bool, P.SCHEMA), "passages")


def _pack(keys: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Whether each key occurs at two places of its own parcel."""
    return np.bincount(np.searchsorted(keys, whole), minlength=len(keys)) > 1


def _reply(keys, _):
    """1 where another parcel has the key too."""
    flat, inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    again = (n > 1)[inverse]
    return np.split(again, np.cumsum([len(k) for k in keys])[:-1])


def _finish(window: int):
    def finish(body, elsewhere):
        needed = body["needed"]
        removed = np.zeros(len(needed), np.int64)
        digest = np.empty(len(needed), dtype=object)
        digest[~needed] = body["digest"]
        if needed.any():
            (p,) = pieces(_texts(body), 1 << 62)
            place = np.repeat(body["run"] - np.concatenate(([0], np.cumsum(body["length"])[:-1])), body["length"]) + np.arange(body["length"].sum())
            whole = rolled(p.hashes(), window)[place]
            keys = np.unique(whole)
            again = elsewhere | _pack(keys, whole)
            hit = place[again[np.searchsorted(keys, whole)]]
            cover = np.zeros(len(p.starts) + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + window, -1)
            keep = np.cumsum(cover)[:-1] == 0
            digest[needed] = _digests(p, keep)
            gone = np.concatenate(([0], np.cumsum(~keep)))
            removed[needed] = np.diff(gone[p.first])
        return pa.table({"doc_id": pa.array(body["doc_id"], pa.int64()), "n_words": pa.array(body["n_words"]), "n_removed": pa.array(removed), "kept_sha256": pa.array(digest.tolist(), pa.string())})

    return finish


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of docs(doc_id, text, ...).

    A word goes when a window that covers it has a word sequence that starts at another place too,
    in any text or the same one, judged on the input.  Null and empty texts have no words; texts of
    fewer than `window` words stay whole; rows that repeat a text remove each other's windows.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = texts_of(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = PAGE
    while width < size / 15 and width < 1 << 60:
        width *= 2
    shard_bits = P.shard_bits(size // 25)
    if width > MOST_CELLS:
        sent = _sharded(texts, width, window, gram, shard_bits)
    else:
        bits = spark.sparkContext.broadcast(repeated_cells(texts.select("text"), width, window, gram))
        sent = P.send(texts, _candidates(bits, width, window, gram, shard_bits), "passages")
    return P.answer(sent, None, _reply, _finish(window), bool, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT p.doc_id, p.i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM p JOIN d USING (doc_id)),
r AS (SELECT doc_id, i FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, i + o AS j FROM r, range(35) AS offsets(o)),
x AS (SELECT d.doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM d),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY j) AS t FROM x ANTI JOIN gone USING (doc_id, j) GROUP BY x.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
