"""Text functions: column expressions, and one Arrow UDF where offsets or Unicode forms are needed.

Java regular expressions stand for Python's \\w as [\\p{L}\\p{N}_] and for \\s as (?U)\\s; offsets never
come from a regular expression's position, which counts UTF-16 units.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf

from ..schemas import INT, SPAN, STRING, struct

WORD = "[\\p{L}\\p{N}_]"

# The replacement table of punctuation variants.
REPLACEMENTS = {
    " ": " ", "“": '"', "”": '"', "„": '"', "‟": '"', "‘": "'", "’": "'", "‚": "'", "‛": "'",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "…": "...", "×": "x",
    "／": "/", "：": ":", "（": "(", "）": ")", "，": ",", "．": ".",
}
_SINGLE = {k: v for k, v in REPLACEMENTS.items() if len(v) == 1}
_SINGLE_TABLE = str.maketrans(_SINGLE)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- normalization, text only -------------------------------------------------------------------


def newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def drop_controls(c: Column) -> Column:
    return F.regexp_replace(c, "[\\p{Cc}\\p{Cf}&&[^\\n\\t]]", "")


def replace_variants(c: Column) -> Column:
    return F.replace(F.translate(c, "".join(_SINGLE), "".join(_SINGLE.values())), F.lit("…"), F.lit("..."))


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, "[ \\t]+", " ")


def trim_lines(c: Column) -> Column:
    return F.regexp_replace(c, " *\\n *", "\n")


def cap_newlines(c: Column, most: int) -> Column:
    return F.regexp_replace(c, f"\\n{{{most + 1},}}", "\n" * most)


def close_up(c: Column) -> Column:
    """No spaces before closing punctuation and after opening brackets."""
    return F.regexp_replace(F.regexp_replace(c, " +([,.;:!?)\\]}])", "$1"), "([(\\[{]) +", "$1")


def trim_edges(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def normalize(c: str | Column, *, collapse: bool = True, punctuation: bool = True, keep_lines: bool = True, most_newlines: int = 2, strip: bool = True) -> Column:
    """The normalization chain without offsets, for text that is already composed (NFC)."""
    out = replace_variants(drop_controls(newlines(col(c))))
    if not keep_lines:
        out = F.translate(out, "\n", " ")
    if collapse:
        out = collapse_spaces(out)
    if keep_lines:
        out = cap_newlines(trim_lines(out), most_newlines)
    if punctuation:
        out = close_up(out)
    return trim_edges(out) if strip else out


# ---- normalization with offsets -----------------------------------------------------------------

Rule = tuple[re.Pattern, Callable[[re.Match], list[tuple[str, int]]]]


def _rewrite(text: str, at: array, rule: Rule) -> tuple[str, array]:
    """Replace each match by the rule's (string, place in the match) parts; a part's characters share a source position."""
    pattern, parts = rule
    out: list[str] = []
    where = array("i")
    done = 0
    for m in pattern.finditer(text):
        out.append(text[done : m.start()])
        where += at[done : m.start()]
        for s, k in parts(m):
            out.append(s)
            where += array("i", [at[m.start() + k]]) * len(s)
        done = m.end()
    if not done:
        return text, at
    return "".join(out) + text[done:], where + at[done:]


@lru_cache(maxsize=1)
def _controls() -> tuple[frozenset, re.Pattern]:
    """Controls and format characters, but for line feed and tab, as a set and as a pattern."""
    every = [c for c in map(chr, range(0x110000)) if c not in "\n\t" and unicodedata.category(c) in ("Cc", "Cf")]
    return frozenset(every), re.compile("[" + "".join(map(re.escape, every)) + "]")


@lru_cache(maxsize=1)
def _composable() -> tuple[frozenset, re.Pattern]:
    """Combining marks and characters that NFC changes by themselves; the pattern is a character with the marks after it, or one of those."""
    every = list(map(chr, range(0x110000)))
    marks, single = [c for c in every if unicodedata.combining(c)], [c for c in every if unicodedata.normalize("NFC", c) != c]
    return frozenset(marks + single), re.compile(f"(?s:.)[{''.join(map(re.escape, marks))}]+|[{''.join(map(re.escape, single))}]")


def composed(text: str) -> str:
    """The text of _compose, without places."""
    some, pattern = _composable()
    return text if some.isdisjoint(text) else pattern.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)


def _compose(text: str, at: array) -> tuple[str, array]:
    """NFC of each starter with its marks; everything maps to the starter."""
    return _rewrite(text, at, (_composable()[1], lambda m: [(unicodedata.normalize("NFC", m[0]), 0)]))


def _drop(m: re.Match) -> list:
    return []


def normalize_with_map(text: str, *, collapse: bool = True, punctuation: bool = True, keep_lines: bool = True, most_newlines: int = 2, strip: bool = True) -> tuple[str, list[int]]:
    """Normalized text and, for each of its characters, the raw position that it comes from."""
    text, at = _normalize(text, collapse=collapse, punctuation=punctuation, keep_lines=keep_lines, most_newlines=most_newlines, strip=strip)
    return text, at.tolist()


def _normalize(text: str, *, collapse: bool = True, punctuation: bool = True, keep_lines: bool = True, most_newlines: int = 2, strip: bool = True) -> tuple[str, array]:
    """normalize_with_map with four bytes for a position."""
    at = array("i", range(len(text)))
    text, at = _rewrite(text, at, (re.compile("\r\n?"), lambda m: [("\n", 0)]))
    some = set(text)  # most texts need few of the steps
    if not some.isdisjoint(_controls()[0]):
        text, at = _rewrite(text, at, (_controls()[1], _drop))
    if not some.isdisjoint(REPLACEMENTS):
        text, at = _rewrite(text.translate(_SINGLE_TABLE), at, (re.compile("…"), lambda m: [("...", 0)]))
    if not some.isdisjoint(_composable()[0]):
        text, at = _compose(text, at)
    if not keep_lines:
        text = text.replace("\n", " ")
    if collapse:
        text, at = _rewrite(text, at, (re.compile("[ \t]{2,}|\t"), lambda m: [(" ", 0)]))
    if keep_lines:
        text, at = _rewrite(text, at, (re.compile(" +\n *|\n +"), lambda m: [("\n", m[0].index("\n"))]))
        text, at = _rewrite(text, at, (re.compile(f"\n{{{most_newlines + 1},}}"), lambda m: [("\n", k) for k in range(most_newlines)]))
    if punctuation:
        text, at = _rewrite(text, at, (re.compile(r" +(?=[,.;:!?)\]}])"), _drop))
        text, at = _rewrite(text, at, (re.compile(r"(?<=[(\[{]) +"), _drop))
    if strip:
        lo, hi = 0, len(text)
        while lo < hi and text[lo].isspace():
            lo += 1
        while hi > lo and text[hi - 1].isspace():
            hi -= 1
        text, at = text[lo:hi], at[lo:hi]
    return text, at


def lists_of(items: Iterable, of: Callable[[list], pa.Array]) -> pa.ListArray:
    """A list array with a list for each item (null for None); of(what the items hold, one after another) makes its values."""
    places, held, n = [0], [], 0
    for x in items:
        if x is None:
            places[-1] = None
        else:
            held.append(x)
            n += len(x)
        places.append(n)
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), of(held))


def _flat(held: list) -> pa.Array:
    """Integers of arrays of four-byte ones, one after another."""
    return pa.array(np.concatenate([np.frombuffer(x, np.int32) for x in held] or [np.empty(0, np.int32)]))


@arrow_udf(struct(text=STRING, map=T.ArrayType(INT)))
def normalized(texts: pa.Array) -> pa.Array:
    """Arrow UDF of normalize_with_map with its defaults; null counts as empty."""
    found, maps = [], []
    for t in texts:
        text, at = _normalize(t.as_py() or "")
        found.append(text)
        maps.append(at)
    return pa.StructArray.from_arrays([pa.array(found, pa.string()), lists_of(maps, _flat)], ["text", "map"])


def normalization_info(raw: str | Column, text: str | Column, *, collapse: bool = True, punctuation: bool = True, keep_lines: bool = True) -> Column:
    """What a normalization did: lengths before and after, and its settings."""
    return F.struct(
        F.length(col(raw)).alias("raw_length"), F.length(col(text)).alias("normalized_length"),
        F.lit(collapse).alias("collapse_spaces"), F.lit(punctuation).alias("normalize_punctuation"), F.lit(keep_lines).alias("preserve_line_breaks"),
    )


def valid_map(text: str | Column, at: str | Column, raw_length: str | Column) -> Column:
    """Whether an offset map has the text's length, stays in range and never decreases."""
    a = col(at)
    steps = F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: x <= y)
    return (F.size(a) == F.length(col(text))) & F.coalesce((F.array_min(a) >= 0) & (F.array_max(a) < col(raw_length)), F.lit(True)) & ((F.size(a) < 2) | F.forall(steps, lambda x: x))


def span_to_raw(at: str | Column, start: str | Column, end: str | Column) -> Column:
    """struct<start,end> in the raw text of a normalized span; null for a bad span."""
    a, s, e = col(at), col(start), col(end)
    return F.when((s >= 0) & (s < e) & (e <= F.size(a)), F.struct(F.get(a, s).alias("start"), (F.get(a, e - 1) + 1).alias("end")))


@arrow_udf(T.ArrayType(STRING))
def slices(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The pieces of a text at an array of spans {start, end}, empty for a bad one; each costs its own length, not its place."""
    found = []
    for text, own in zip(texts, spans, strict=True):
        text = text.as_py() or ""
        found.append([text[x["start"] : x["end"]] if x["start"] is not None and x["end"] is not None and 0 <= x["start"] < x["end"] else "" for x in own.as_py() or ()])
    return lists_of(found, lambda held: pa.array([x for own in held for x in own], pa.string()))


def span_to_normalized(at: str | Column, start: str | Column, end: str | Column) -> Column:
    """struct<start,end> of the normalized places whose raw position is inside the raw span; null if none is."""
    inside = F.filter(F.transform(col(at), lambda x, i: F.when((x >= col(start)) & (x < col(end)), i)), lambda x: x.isNotNull())
    return F.when(F.size(inside) > 0, F.struct(F.array_min(inside).alias("start"), (F.array_max(inside) + 1).alias("end")))


@arrow_udf(T.ArrayType(SPAN))
def spans_to_normalized(maps: pa.Array, spans: pa.Array) -> pa.Array:
    """span_to_normalized for an array of raw spans {start, end} of one text, by bisection of its map; null for a bad span."""
    places = []
    for at, own in zip(maps, spans, strict=True):
        if own.values is None:
            places.append(None)
        else:
            at = at.values.to_numpy(zero_copy_only=False)
            places.append(np.stack([np.searchsorted(at, own.values.field(c).to_numpy(zero_copy_only=False)) for c in ("start", "end")], axis=1).astype(np.int32))

    def of(held: list) -> pa.Array:
        lo, hi = np.concatenate(held or [np.empty((0, 2), np.int32)]).T
        return pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], ["start", "end"], mask=pa.array(lo >= hi))

    return lists_of(places, of)


# ---- other scalar functions ---------------------------------------------------------------------


def clean_text(c: str | Column) -> Column:
    """Null for null-like values, else white space collapsed and trimmed (for composed text)."""
    out = F.regexp_replace(F.regexp_replace(col(c), "(?U)\\s+", " "), "^ | $", "")
    return F.when(~F.lower(out).isin("", "nan", "none", "null", "n/a", "na"), out)


def match_key(c: str | Column) -> Column:
    """Key for comparing surfaces (for composed text)."""
    out = F.replace(F.translate(F.lower(col(c)), "–—", "--"), F.lit("µg"), F.lit("mcg"))
    return F.btrim(F.regexp_replace(out, "(?U)\\s+", " "), F.lit(" \t\r\n.,;:!?()[]{}\"'"))


def mention_key_py(text: str) -> str:
    bare = "".join(c for c in unicodedata.normalize("NFD", text.casefold()) if not unicodedata.combining(c)).replace("đ", "d")
    return " ".join(re.findall(r"\w+", bare))


@pandas_udf(STRING)
def mention_key_udf(texts: pd.Series) -> pd.Series:
    return texts.map(mention_key_py, na_action="ignore")


@pandas_udf(STRING)
def strip_diacritics(texts: pd.Series) -> pd.Series:
    """The text decomposed (NFD) without its non-spacing marks; other letters, such as đ, stay."""
    return texts.map(lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn"), na_action="ignore")


_ACCENTED = "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđäåçëîïñöûüÿ"
_BARE = "".join("d" if c == "đ" else unicodedata.normalize("NFD", c)[0] for c in _ACCENTED)


def mention_key(c: str | Column) -> Column:
    """mention_key_py as an expression, for composed Latin letters of Vietnamese and western Europe."""
    bare = F.replace(F.translate(F.lower(col(c)), _ACCENTED, _BARE), F.lit("ß"), F.lit("ss"))
    return F.array_join(F.regexp_extract_all(bare, F.lit(f"({WORD}+)")), " ")


def tokens(c: str | Column) -> Column:
    """Tokens of the mention key; none for an empty key."""
    bare = F.replace(F.translate(F.lower(col(c)), _ACCENTED, _BARE), F.lit("ß"), F.lit("ss"))
    return F.regexp_extract_all(bare, F.lit(f"({WORD}+)"))


def model_tokens(c: str | Column) -> Column:
    """Token texts of the model tokenizer: words, and single other characters that are not white space."""
    return F.regexp_extract_all(col(c), F.lit(f"({WORD}+|(?U)[^\\s\\p{{L}}\\p{{N}}_])"))


_MODEL_TOKEN = re.compile(r"\w+|[^\w\s]")


_PLACE = struct(ns=INT, ne=INT, ts=INT, te=INT, raw=T.BooleanType(), same=T.BooleanType())


@arrow_udf(struct(length=INT, tokens=T.ArrayType(STRING), placed=T.ArrayType(_PLACE)))
def aligned(raws: pa.Array, entities: pa.Array) -> pa.Array:
    """Length and model tokens of the normalized text, and the places in it of entities array<struct<text,start,end>> of the raw text.

    A place has the normalized span (null if none of it is left), its first and last token (null if they
    begin or end elsewhere), and whether the raw text (raw) and the normalized one (same) have the entity's
    text there.  The map, the texts and the tokens' offsets stay in Python.
    """
    lengths, words, places = [], [], []
    for raw, own in zip(raws, entities, strict=True):
        raw = raw.as_py() or ""
        text, at = _normalize(raw)
        found = [m.span() for m in _MODEL_TOKEN.finditer(text)]
        starts, ends = array("i", [a for a, _ in found]), array("i", [b for _, b in found])
        lengths.append(len(text))
        words.append([text[a:b] for a, b in found])
        places.append([_placed(raw, text, at, starts, ends, e) for e in own.as_py() or ()])
    chain = lambda held: [x for own in held for x in own]
    kind = pa.struct([(f.name, pa.bool_() if f.name in ("raw", "same") else pa.int32()) for f in _PLACE])
    return pa.StructArray.from_arrays([pa.array(lengths, pa.int32()), lists_of(words, lambda h: pa.array(chain(h), pa.string())), lists_of(places, lambda h: pa.array(chain(h), kind))], ["length", "tokens", "placed"])


def _placed(raw: str, text: str, at: array, starts: array, ends: array, entity: dict | None) -> dict:
    if entity is None or entity["start"] is None or entity["end"] is None:
        return {}
    start, end, said = entity["start"], entity["end"], entity["text"]
    own = None if said is None else raw[max(start, 0) : end] == said
    lo, hi = bisect_left(at, start), bisect_left(at, end)
    if lo >= hi:
        return {"raw": own}
    first, last = bisect_left(starts, lo), bisect_left(ends, hi)
    return {
        "ns": lo, "ne": hi, "ts": first if first < len(starts) and starts[first] == lo else None, "te": last if last < len(ends) and ends[last] == hi else None,
        "raw": own, "same": None if said is None else _normalize(said)[0] == text[lo:hi],
    }


def has_surface(text: str | Column, surface: str | Column) -> Column:
    """Whether the text has the surface as whole words, whatever its case and white space."""
    squeeze = lambda c: F.concat(F.lit(" "), F.lower(F.regexp_replace(c, "(?U)\\s+", " ")), F.lit(" "))
    quoted = F.concat(F.lit(f"(?<!{WORD})\\Q"), F.btrim(F.lower(F.regexp_replace(col(surface), "(?U)\\s+", " "))), F.lit(f"\\E(?!{WORD})"))
    return F.regexp_like(squeeze(col(text)), quoted)


def last_part(c: Column, ends: str) -> Column:
    """What stands after the last line feed or character of `ends`; linear in the text, unlike an expression anchored at the end."""
    return F.reverse(F.regexp_extract(F.reverse(c), f"^[^{ends}\\n]*", 0))


def scope_prefix(text: str | Column, start: str | Column, contrasts: tuple[str, ...]) -> Column:
    """The part of the clause before `start`: after the last of newline . ; : and the last contrast word."""
    before = last_part(F.lower(F.substring(col(text), F.lit(1), col(start))), ".;:")
    return F.regexp_replace(before, "^(?s).*(?:" + "|".join(map(re.escape, contrasts)) + ")", "") if contrasts else before


def local_window(text: str | Column, start: str | Column, end: str | Column, before: int = 180, after: int = 100) -> Column:
    lo = F.greatest(col(start) - before, F.lit(0))
    return F.lower(F.substring(col(text), lo + 1, col(end) + after - lo))


def sentence_context(text: str | Column, start: str | Column, end: str | Column) -> Column:
    """The sentence around a span, trimmed."""
    t, s, e = col(text), col(start), col(end)
    left = last_part(F.substring(t, F.lit(1), s), ".!?;")
    right = F.regexp_extract(F.substring(t, e + 1, F.length(t)), "^[^.!?;\\n]*", 0)
    return F.regexp_replace(F.concat(left, F.substring(t, s + 1, e - s), right), "(?U)^\\s+|\\s+$", "")


def confidence(x: str | Column) -> Column:
    """Scores from 0 to 1 stay; others go through the logistic function."""
    v = col(x)
    return F.when(v.between(0.0, 1.0), v).otherwise(1.0 / (1.0 + F.exp(-v)))


def join_and(items: str | Column, word: str = "và") -> Column:
    """"a", "a và b", "a, b và c"."""
    a = col(items)
    head = F.array_join(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1))), ", ")
    return F.when(F.size(a) == 0, "").when(F.size(a) == 1, F.get(a, 0)).otherwise(F.concat(head, F.lit(f" {word} "), F.element_at(a, -1)))


def split_bucket(signature: str | Column) -> Column:
    """Stable bucket from 0 to 9,999 of a signature."""
    return F.conv(F.substring(F.sha1(col(signature).cast("binary")), 1, 8), 16, 10).cast("long") % 10_000


def is_icd_code(c: str | Column) -> Column:
    return F.regexp_like(F.upper(col(c)), F.lit("^[A-Z][0-9]{2}(\\.[0-9A-Z]+)?$"))


def is_rxnorm_id(c: str | Column) -> Column:
    return F.regexp_like(col(c), F.lit("^[0-9]+$"))
