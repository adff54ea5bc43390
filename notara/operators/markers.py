"""Marked notes: [[E0]]..[[/E0]] markers, placeholders, sections and rendering templates."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions.text import WORD, has_surface, join_and
from ..schemas import INT, STRING, struct

MARKER = "\\[\\[([EN]\\d+)\\]\\](?s)(.*?)\\[\\[/\\1\\]\\]"
PLACEHOLDER = "<<([EN]\\d+)>>"
# Terms that rendered text must not contain; cue words of the semantic and the soft check.
BANNED = ("các entity", "entity là", "hard-negative", "hard negative", "scenario_id", "subject_scope", "temporal_scope", "surface_text", "assertion", "section_spec", "case spec", "marker")
NEGATION = ("không ghi nhận", "không có", "không thấy", "không xuất hiện", "chưa ghi nhận", "phủ nhận", "không mắc", "không bị", "không")
FAMILY = ("tiền sử gia đình", "người nhà", "gia đình", "bố", "mẹ", "cha", "anh trai", "chị gái")
HISTORY = ("tiền sử", "trước đây", "đã từng", "từng", "trước nhập viện", "trong quá khứ")
CONTRAST = ("nhưng", "tuy nhiên", "song", "trái lại")
SOFT_NEGATION = ("không", "không có", "không ghi nhận", "phủ nhận", "chưa từng", "không xuất hiện")
SOFT_FAMILY = ("bố", "mẹ", "cha", "gia đình", "người nhà", "anh trai", "chị gái")
SOFT_HISTORY = ("tiền sử", "trước đây", "đã từng", "trước nhập viện", "trong quá khứ")
# The assertions that a scenario asks for, and its template ({} is the joined list).
EXPECTED = {
    "patient_current_negated": ["isNegated"], "coordinated_negation": ["isNegated"], "patient_historical": ["isHistorical"], "patient_historical_negated": ["isHistorical", "isNegated"],
    "family_current": ["isFamily"], "family_historical": ["isFamily", "isHistorical"], "home_medications": ["isHistorical"], "active_medications": [], "laboratory_results": [],
}
TEMPLATES = {
    "patient_current_positive": "Bệnh nhân hiện ghi nhận {}.", "patient_current_negated": "Bệnh nhân không ghi nhận {}.", "coordinated_negation": "Bệnh nhân không ghi nhận {}.",
    "patient_historical": "Trước đây bệnh nhân từng ghi nhận {}.", "patient_historical_negated": "Trước nhập viện, bệnh nhân không ghi nhận {}.",
    "family_current": "Người nhà bệnh nhân hiện có {}.", "family_historical": "Trong tiền sử gia đình, người nhà bệnh nhân từng ghi nhận {}.",
}
MIXED, NEGATIVES = ("Bệnh nhân không ghi nhận ", ", nhưng hiện có "), "\nNgoài ra, bệnh nhân đã được thực hiện "


def has_cue(text: Column, cues: tuple[str, ...]) -> Column:
    return F.regexp_like(text, F.lit(f"(?iu)(?<!{WORD})(?:{'|'.join(map(re.escape, cues))})(?!{WORD})"))


def placeholder(marker_id: str = "marker_id") -> Column:
    return F.concat(F.lit("<<"), F.col(marker_id), F.lit(">>"))


def found_markers(notes: DataFrame) -> DataFrame:
    """(case_id, marker_id, text, place) of every marker in notes(case_id, marked_text)."""
    both = F.arrays_zip(F.regexp_extract_all("marked_text", F.lit(MARKER), F.lit(1)).alias("id"), F.regexp_extract_all("marked_text", F.lit(MARKER), F.lit(2)).alias("t"))
    return notes.select("case_id", F.posexplode(both).alias("place", "m")).select("case_id", "place", F.col("m.id").alias("marker_id"), F.col("m.t").alias("text"))


def marker_errors(notes: DataFrame, expected: DataFrame) -> DataFrame:
    """(case_id, marker_id, error): missing, repeated, changed or unknown markers; expected(case_id, marker_id, surface_text)."""
    found = found_markers(notes).groupBy("case_id", "marker_id").agg(F.count("*").alias("n"), F.min("text").alias("text"))
    both = expected.join(notes.select("case_id"), "case_id", "left_semi").join(found, ["case_id", "marker_id"], "full")
    error = F.when(F.col("surface_text").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(F.col("text") != F.col("surface_text"), "changed")
    return both.select("case_id", "marker_id", error.alias("error")).where("error IS NOT NULL")


_MARK = re.compile(r"\[\[(/?)([EN]\d+)\]\]")


def strip_markers_py(marked: str) -> tuple[str, list[dict]]:
    """Text without markers, and the span of each E marker in it."""
    out, open_, spans, at, done = [], {}, [], 0, 0
    for m in _MARK.finditer(marked):
        out.append(marked[done : m.start()])
        at += m.start() - done
        done = m.end()
        if not m[1]:
            open_[m[2]] = at
        elif m[2] in open_ and m[2][0] == "E":
            spans.append({"marker_id": m[2], "start": open_.pop(m[2]), "end": at})
    return "".join(out) + marked[done:], spans


@pandas_udf(struct(text=STRING, spans=T.ArrayType(struct(marker_id=STRING, start=INT, end=INT))))
def strip_markers(texts: pd.Series) -> pd.DataFrame:
    got = [strip_markers_py(t or "") for t in texts]
    return pd.DataFrame({"text": [t for t, _ in got], "spans": [s for _, s in got]})


def marker_positions(notes: DataFrame) -> DataFrame:
    """(case_id, marker_id, start, end) in the stripped text, from running sums of segment lengths (no Python).

    Works where markers do not nest: the text before a marker shrinks by the markers before it.
    """
    cut = F.split(F.regexp_replace("marked_text", MARKER, "\u0001$1\u0002$2\u0001"), "\u0001")
    seg = notes.select("case_id", F.posexplode(cut).alias("place", "seg"))
    marked = F.contains(F.col("seg"), F.lit("\u0002"))
    text = F.when(marked, F.element_at(F.split("seg", "\u0002"), 2)).otherwise(F.col("seg"))
    rows = seg.select("case_id", "place", F.when(marked, F.element_at(F.split("seg", "\u0002"), 1)).alias("marker_id"), F.length(text).alias("n"))
    rows = rows.withColumn("end", F.sum("n").over(W.partitionBy("case_id").orderBy("place").rowsBetween(W.unboundedPreceding, 0)))
    return rows.where("marker_id LIKE 'E%'").select("case_id", "marker_id", (F.col("end") - F.col("n")).alias("start"), "end")


def expand_placeholders(draft: Column, surfaces: Column) -> Column:
    """draft with each <<id>> as a marker around its surface; surfaces is a map id -> text."""
    one = lambda acc, e: F.replace(acc, F.concat(F.lit("<<"), e["key"], F.lit(">>")), F.concat(F.lit("[["), e["key"], F.lit("]]"), e["value"], F.lit("[[/"), e["key"], F.lit("]]")))
    return F.aggregate(F.map_entries(surfaces), draft, one)


def placeholder_errors(drafts: DataFrame, expected: DataFrame) -> DataFrame:
    """(case_id, marker_id, error) of drafts(case_id, draft): missing, repeated or unknown placeholders.

    If expected has surface_text, also surfaces that are written out beside their placeholders.
    """
    found = drafts.select("case_id", F.explode(F.regexp_extract_all("draft", F.lit(PLACEHOLDER), F.lit(1))).alias("marker_id")).groupBy("case_id", "marker_id").agg(F.count("*").alias("n"))
    both = expected.select("case_id", "marker_id", F.lit(True).alias("known")).join(drafts.select("case_id"), "case_id", "left_semi").join(found, ["case_id", "marker_id"], "full")
    out = both.select("case_id", "marker_id", F.when(F.col("known").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").alias("error")).where("error IS NOT NULL")
    if "surface_text" not in expected.columns:
        return out
    bare = drafts.select("case_id", F.regexp_replace("draft", PLACEHOLDER, " ").alias("_bare"))
    leaked = expected.join(bare, "case_id").where(has_surface("_bare", "surface_text"))
    return out.union(leaked.select("case_id", "marker_id", F.lit("leaked")))


def draft_faults(draft: str = "draft", banned: tuple[str, ...] = BANNED) -> Column:
    """Faults of a draft's wording: markers, code fences, banned terms."""
    t = F.lower(F.col(draft))
    return F.filter(F.array(F.when(F.contains(t, F.lit("[[")) | F.contains(t, F.lit("]]")), "marker_in_draft"), F.when(F.contains(t, F.lit("```")), "code_fence"), *[F.when(F.contains(t, F.lit(b)), f"banned:{b}") for b in banned]), lambda x: x.isNotNull())


def surface_counts(texts: DataFrame, expected: DataFrame) -> DataFrame:
    """(case_id, surface_text, found, wanted) where a surface's whole-word count differs from the expected one."""
    wanted = expected.groupBy("case_id", F.lower("surface_text").alias("surface_text")).agg(F.count("*").alias("wanted"))
    pattern = F.concat(F.lit(f"(?iu)(?<!{WORD})\\Q"), F.col("surface_text"), F.lit(f"\\E(?!{WORD})"))
    return wanted.join(texts, "case_id").withColumn("found", F.regexp_count("text", pattern).cast("long")).where("found != wanted").select("case_id", "surface_text", "found", "wanted")


def section_ranges(sections: DataFrame, length: str = "length") -> DataFrame:
    """sections(case_id, section_id, start, length) with end: the next section's start, or the text's length."""
    return sections.withColumn("end", F.coalesce(F.lead("start").over(W.partitionBy("case_id").orderBy("start", "section_id")), F.col(length)))


def semantic_faults(entities: DataFrame, negation=NEGATION, family=FAMILY, history=HISTORY) -> DataFrame:
    """entities(prefix, window, assertions, subject_scope, temporal_scope, scenario_id) with faults: missing and spurious cues."""
    neg, fam, his = has_cue(F.col("prefix"), negation), has_cue(F.col("window"), family), has_cue(F.col("window"), history)
    has = lambda a: F.array_contains("assertions", a)
    faults = [
        F.when(has("isNegated") & ~neg, "negation_missing").when(~has("isNegated") & neg, "negation_spurious"),
        F.when(has("isFamily") & ~fam, "family_missing").when(~has("isFamily") & fam & (F.col("subject_scope") == "patient"), "family_spurious"),
        F.when(has("isHistorical") & ~his & (F.col("temporal_scope") != "historical"), "history_missing").when(~has("isHistorical") & his & (F.col("temporal_scope") == "current") & (F.col("scenario_id") != "mixed_polarity"), "history_spurious"),
    ]
    return entities.withColumn("faults", F.filter(F.array(*faults), lambda x: x.isNotNull()))


def soft_warnings(text: Column, start: Column, end: Column, labels: Column, temporal_scope: Column, cues: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Labels without a cue in the window from 120 before to 80 after the entity (plain substrings)."""
    cues = cues or {"isNegated": SOFT_NEGATION, "isFamily": SOFT_FAMILY, "isHistorical": SOFT_HISTORY}
    lo = F.greatest(start - 120, F.lit(0))
    window = F.lower(F.substring(text, lo + 1, end + 80 - lo))
    out = []
    for label, words in cues.items():
        seen = F.lit(False)
        for w in words:
            seen = seen | F.contains(window, F.lit(w))
        if label == "isHistorical":
            seen = seen | (temporal_scope == "historical")
        out.append(F.when(F.array_contains(labels, label) & ~seen, label))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def render(scenario: Column, entity_ids: Column, negative_ids: Column) -> Column:
    """A block's text with placeholders, by its scenario's template; null for an unknown scenario."""
    mark = lambda a: F.transform(a, lambda x: F.concat(F.lit("<<"), x, F.lit(">>")))
    e = mark(entity_ids)
    out = None
    for k, t in TEMPLATES.items():
        before, after = t.split("{}")
        value = F.concat(F.lit(before), join_and(e), F.lit(after))
        out = F.when(scenario == k, value) if out is None else out.when(scenario == k, value)
    listed = F.array_join(F.transform(e, lambda x: F.concat(F.lit("- "), x)), "\n")
    pairs = F.array_join(F.filter(F.transform(e, lambda x, i: F.when((i % 2 == 0) & (i + 1 < F.size(e)), F.concat(F.lit("- "), x, F.lit(": "), F.get(e, i + 1)))), lambda x: x.isNotNull()), "\n")
    out = out.when(scenario == "mixed_polarity", F.concat(F.lit(MIXED[0]), F.get(e, F.lit(0)), F.lit(MIXED[1]), F.get(e, F.lit(1)), F.lit(".")))
    out = out.when(scenario.isin("home_medications", "active_medications"), listed).when(scenario == "laboratory_results", pairs)
    return F.when(F.size(negative_ids) > 0, F.concat(out, F.lit(NEGATIVES), join_and(mark(negative_ids)), F.lit("."))).otherwise(out)


def assertion_markup(marked: Column) -> Column:
    """Marked text for the assertion export: N markers go, E markers become <E0>..</E0>."""
    return F.regexp_replace(F.regexp_replace(marked, "\\[\\[/?N\\d+\\]\\]", ""), "\\[\\[(/?)(E\\d+)\\]\\]", "<$1$2>")
