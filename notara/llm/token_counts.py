"""Token counts of a document's sections or fields from one encoding of the whole document.

A document is encoded once.  Its tokens' byte lengths give their character spans, and an interval
join of token spans with section spans (both sorted) gives each section its tokens.  A token that
crosses a border is allotted by a rule: `start`, the section of its first character; `end`, that of
its last one; `most`, the one that holds most of its characters, the earlier if several do.  A
section's counts therefore add up to the document's.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import PART, kept, lean, read, texts_of

RULES = ("start", "end", "most")
SPECIAL = ("<|endoftext|>",)  # one token wherever it stands, as in op2
Splitter = Callable[[str], np.ndarray]
_END = regex.compile(r"\P{White_Space}(?=\p{White_Space})")
_BLANKS = regex.compile(r"\p{White_Space}{5000,}")


def default_vocabulary() -> tuple[str, str]:
    """File of byte-level ranks and the pattern that cuts texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Sizes:
    """Byte lengths of the tokens of a text, a run of about PART characters at a time."""

    def __init__(self, path: str, pattern: str, special: tuple[str, ...]):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self._sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self._sizes[i] = len(token)
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None

    def _plain(self, text: str) -> np.ndarray:
        return self._sizes[np.asarray(self._encoding.encode_ordinary(text), np.int64)]

    def _run(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """A run without special tokens.  A very long run of blanks, which the pattern's look-ahead can't take, is one piece."""
        lo = 0
        for blanks in _BLANKS.finditer(text):
            if blanks.start() > lo:
                yield text[lo : blanks.start()], self._plain(text[lo : blanks.start()])
            lo = blanks.end() - (blanks.end() < len(text))  # the last blank before a word is not of the piece
            piece = text[blanks.start() : lo]
            yield piece, self._sizes[np.asarray(self._encoding._encode_single_piece(piece.encode()), np.int64)]
        if lo < len(text):
            yield text[lo:], self._plain(text[lo:])

    def __call__(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """Consecutive runs of the text and their tokens' byte lengths; a run ends where a piece always ends."""
        for k, part in enumerate(self._split.split(text) if self._split else [text]):
            if k % 2:
                yield part, np.array([len(part.encode())])
                continue
            lo = 0
            while len(part) - lo > 2 * PART:
                found = _END.search(part, lo + PART)
                if not found:
                    break
                yield from self._run(part[lo : found.end()])
                lo = found.end()
            yield from self._run(part[lo:])


@kept
@lru_cache(maxsize=2)
def _sizes(path: str, pattern: str, special: tuple[str, ...]) -> Sizes:
    return Sizes(path, pattern, special)


def lines(text: str) -> np.ndarray:
    """First characters of the text's lines; a line holds the line feed that ends it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.flatnonzero(points == 10) + 1))
    return starts[:-1] if len(points) and starts[-1] == len(points) else starts


def token_spans(text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of consecutive tokens with these byte sizes; one that ends inside a character includes it."""
    raw = np.frombuffer(text.encode(), np.uint8)
    first = (raw & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(first)))  # characters begun before each byte
    ends = np.cumsum(sizes)
    starts = ends - sizes
    return chars[starts] - ~np.append(first, True)[starts], chars[ends]


def allot(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, length: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Each token's section, and whether it crosses a border; sections are the sorted first characters."""
    low = np.searchsorted(sections, starts, "right") - 1
    high = np.searchsorted(sections, ends - 1, "right") - 1
    crossing = high > low
    if rule == "start":
        return low, crossing
    if rule == "end":
        return high, crossing
    out = low.copy()
    borders = np.append(sections, length)
    for i in np.flatnonzero(crossing):
        own = np.arange(low[i], high[i] + 1)
        held = np.minimum(borders[own + 1], ends[i]) - np.maximum(borders[own], starts[i])
        out[i] = own[np.argmax(held)]
    return out, crossing


def section_counts(text: str, sections: np.ndarray, runs: Iterator[tuple[str, np.ndarray]], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those of them that cross a border."""
    n, crossed, at = np.zeros(len(sections), np.int64), np.zeros(len(sections), np.int64), 0
    for run, sizes in runs:
        starts, ends = token_spans(run, sizes)
        own, crossing = allot(starts + at, ends + at, sections, len(text), rule)
        at += len(run)
        np.add.at(n, own, 1)
        np.add.at(crossed, own[crossing], 1)
    return n, crossed


def _count(path: str, pattern: str, special: tuple[str, ...], splitter: Splitter | None, rule: str):
    def count(batches):
        sizes = _sizes(path, pattern, special)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                ids, section, start, end, n, crossed, total = [], [], [], [], [], [], []
                part = batch.slice(lo, 500)
                given = part.column("borders") if splitter is None else [None] * part.num_rows
                for doc_id, text, borders in zip(part.column("doc_id").to_pylist(), part.column("text"), given, strict=True):
                    text = text.as_py() or ""
                    borders = splitter(text) if splitter else np.asarray(borders.values)
                    own, crossing = section_counts(text, borders, sizes(text), rule)
                    k = len(borders)
                    ids += [doc_id] * k
                    section.append(np.arange(k))
                    start.append(borders)
                    end.append(np.append(borders[1:], len(text)))
                    n.append(own)
                    crossed.append(crossing)
                    total.append(np.full(k, own.sum()))
                columns = [np.concatenate(x).astype(np.int64) for x in (section, start, end, n, crossed, total)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, columns)], names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    return count


_SCHEMA = "doc_id long, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


def section_token_counts(docs: DataFrame, splitter: Splitter = lines, rule: str = "start", vocabulary: tuple[str, str] | None = None, special: tuple[str, ...] = SPECIAL) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing, doc_tokens), a row for each section.

    docs(doc_id, text, ...).  splitter gives the sorted first characters of a text's sections, the
    first of them 0.  n_crossing: tokens of the section that also hold characters of others.  A text
    in `special` is one token wherever it stands, as for op2's encoder, so doc_tokens is its n_tokens.
    A null or empty text has one empty section.  Long texts are encoded in runs that end between
    pieces.  A token that two sections hold equally (rule `most`) goes to the earlier.  Repeated rows
    are counted each for itself; other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path, pattern = vocabulary or default_vocabulary()
    return texts_of(docs).mapInArrow(lean(_count(path, pattern, special, splitter, rule), _sizes), _SCHEMA)


def field_token_counts(docs: DataFrame, fields: list[str], separator: str = "\n", rule: str = "start", vocabulary: tuple[str, str] | None = None, special: tuple[str, ...] = SPECIAL) -> DataFrame:
    """(doc_id, field, start, end, n_tokens, n_crossing, doc_tokens), a row for each field of docs(doc_id, *fields, ...).

    The document is its fields in the given order (null: empty) with the separator after each but the
    last; a separator counts for the field before it.  All else is as for section_token_counts().
    """
    if rule not in RULES or not fields:
        raise ValueError(f"name at least one field, and a rule of {RULES}")
    path, pattern = vocabulary or default_vocabulary()
    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    upto, borders = F.lit(0).cast("long"), []
    for v in values:
        borders.append(upto)
        upto = upto + F.length(v) + len(separator)
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat_ws(separator, *values).alias("text"), F.array(*borders).alias("borders"))
    counted = joined.mapInArrow(lean(_count(path, pattern, special, None, rule), _sizes), _SCHEMA)
    name = F.element_at(F.array(*map(F.lit, fields)), (F.col("section") + 1).cast("int"))
    return counted.select("doc_id", name.alias("field"), *counted.columns[2:])


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return section_token_counts(read(spark, sf_dir, "documents"))
