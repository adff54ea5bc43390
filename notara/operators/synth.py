"""Synthetic marked notes: case specs, their checks, rendering by template or an injected language model."""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import is_icd_code, is_rxnorm_id, match_key
from ..schemas import ASSERTION_TYPES, ASSERTIONS, CANDIDATE_TYPES, DIAGNOSIS, DRUG, ENTITY_TYPES, LAB_NAME, LAB_RESULT, SYMPTOM
from ..tables import save
from . import export, markers, validation

# Laboratory tests (unit, normal range, decimals).
LABS = {"WBC": ("10^9/L", 4.0, 10.0, 1), "HGB": ("g/L", 110, 165, 0), "PLT": ("10^9/L", 150, 400, 0), "Glucose máu": ("mmol/L", 3.9, 6.4, 1), "Creatinine máu": ("µmol/L", 44, 106, 0)}
# Scenarios (kind, entity types, assertions, least and most entities).
SCENARIOS = {
    "patient_current_positive": ("single_group", (SYMPTOM, DIAGNOSIS), (), 1, 2), "patient_current_negated": ("single_group", (SYMPTOM, DIAGNOSIS), ("isNegated",), 1, 2),
    "coordinated_negation": ("coordinated_negation", (SYMPTOM,), ("isNegated",), 2, 5), "mixed_polarity": ("mixed_polarity", (SYMPTOM,), (), 2, 2),
    "patient_historical": ("single_group", (SYMPTOM, DIAGNOSIS), ("isHistorical",), 1, 2), "patient_historical_negated": ("single_group", (SYMPTOM, DIAGNOSIS), ("isNegated", "isHistorical"), 1, 2),
    "family_current": ("single_group", (SYMPTOM, DIAGNOSIS), ("isFamily",), 1, 2), "family_historical": ("single_group", (SYMPTOM, DIAGNOSIS), ("isFamily", "isHistorical"), 1, 2),
    "home_medications": ("medication_group", (DRUG,), ("isHistorical",), 1, 4), "active_medications": ("medication_group", (DRUG,), (), 1, 4),
    "laboratory_results": ("laboratory_group", (LAB_NAME, LAB_RESULT), (), 1, 3),
}
# Sections (titles, temporal scope, subject scope, scenarios).
SECTIONS = {
    "medical_history": (("Tiền sử bệnh nội khoa", "Tiền sử bệnh"), "historical", "patient_or_family", ("patient_historical", "family_historical")),
    "history_present_illness": (("Tiền sử bệnh hiện tại", "Bệnh sử"), "mixed", "patient", ("patient_current_positive", "patient_current_negated", "coordinated_negation", "mixed_polarity", "patient_historical")),
    "pre_admission_events": (("Sự kiện trước khi nhập viện", "Diễn biến trước nhập viện"), "historical", "patient", ("patient_historical", "patient_historical_negated")),
    "hospital_assessment": (("Đánh giá tại bệnh viện", "Đánh giá hiện tại"), "current", "patient", ("patient_current_positive", "patient_current_negated", "coordinated_negation", "mixed_polarity")),
    "home_medications": (("Thuốc trước nhập viện", "Thuốc dùng tại nhà"), "historical", "patient", ("home_medications",)),
    "active_medications": (("Thuốc đang sử dụng", "Điều trị hiện tại"), "current", "patient", ("active_medications",)),
    "laboratory": (("Kết quả xét nghiệm", "Cận lâm sàng"), "current", "patient", ("laboratory_results",)),
}
# Profiles (weight, required sections, optional sections, least and most optional).
PROFILES = {
    "single_clinical_sentence": (10, ("hospital_assessment",), (), 0, 0), "medication_reconciliation": (15, ("home_medications",), ("active_medications",), 0, 1),
    "outpatient_note": (15, ("history_present_illness", "hospital_assessment"), ("active_medications", "laboratory"), 0, 1),
    "discharge_summary": (20, ("medical_history", "hospital_assessment"), ("history_present_illness", "home_medications", "laboratory"), 1, 2),
    "longitudinal_hospital_note": (30, ("medical_history", "history_present_illness", "hospital_assessment"), ("pre_admission_events", "home_medications", "active_medications", "laboratory"), 1, 3),
    "mixed_noisy_document": (10, ("history_present_illness", "hospital_assessment"), ("medical_history", "pre_admission_events", "laboratory"), 1, 2),
}
NEGATIVE_SHARE, IN_RANGE_SHARE, MOST_POOL = 0.3, 0.7, 200_000

_ENTITY = "entity_id:string,surface_text:string,entity_type:string,assertions:array<string>,candidates:array<string>"
_BLOCK = f"block_id:string,scenario_id:string,entities:array<struct<{_ENTITY}>>,hard_negatives:array<struct<negative_id:string,surface_text:string>>"
_SECTION = f"section_id:string,section_type:string,title:string,temporal_scope:string,subject_scope:string,blocks:array<struct<{_BLOCK}>>"
SPEC = f"case_id string, profile string, noise string, sections array<struct<{_SECTION}>>"


def lab_value(rng: random.Random, low: float, high: float, decimals: int) -> str:
    """A value, usually in the normal range and else up to half its width outside; decimals have a comma."""
    width = high - low
    if rng.random() < IN_RANGE_SHARE:
        v = rng.uniform(low, high)
    else:
        v = rng.uniform(high, high + width / 2) if rng.random() < 0.5 else rng.uniform(max(0.0, low - width / 2), low)
    return str(round(v)) if not decimals else f"{v:.{decimals}f}".replace(".", ",")


class _Case:
    """Draws of one case; a surface is used once."""

    def __init__(self, rng: random.Random, pools: dict[str, list[dict]], negatives: list[str]):
        self.rng, self.pools, self.negatives = rng, pools, negatives
        self.used: set[str] = set()
        self.entities = self.negs = 0

    def surface(self, kind: str) -> dict | None:
        pool = self.pools.get(kind) or []
        for _ in range(50):
            if not pool:
                return None
            pick = self.rng.choice(pool)
            if pick["key"] not in self.used:
                self.used.add(pick["key"])
                return pick
        return None

    def entity(self, text: str, kind: str, labels, candidates=()) -> dict:
        self.entities += 1
        return {"entity_id": f"E{self.entities - 1}", "surface_text": text, "entity_type": kind, "assertions": sorted(labels), "candidates": list(candidates)}

    def block(self, number: int, scenario: str) -> dict | None:
        kind, types, labels, least, most = SCENARIOS[scenario]
        out: list[dict] = []
        if kind == "laboratory_group":
            for name in self.rng.sample(sorted(LABS), self.rng.randint(least, most)):
                unit, low, high, decimals = LABS[name]
                if name not in self.used:
                    self.used.add(name)
                    out += [self.entity(name, LAB_NAME, ()), self.entity(f"{lab_value(self.rng, low, high, decimals)} {unit}", LAB_RESULT, ())]
        else:
            for i in range(self.rng.randint(least, most)):
                t = self.rng.choice(types)
                s = self.surface(t)
                if s:
                    own = (("isNegated",) if i == 0 else ()) if kind == "mixed_polarity" else labels
                    out.append(self.entity(s["text"], t, own, s["candidates"] if t in CANDIDATE_TYPES else ()))
        if len(out) < least or not out:
            return None
        negatives = []
        if self.negatives and kind in ("single_group", "coordinated_negation") and self.rng.random() < NEGATIVE_SHARE:
            text = self.rng.choice(self.negatives)
            if text not in self.used:
                self.used.add(text)
                negatives = [{"negative_id": f"N{self.negs}", "surface_text": text}]
                self.negs += 1
        return {"block_id": f"B{number}", "scenario_id": scenario, "entities": out, "hard_negatives": negatives}


def make_case(case_id: str, seed: str, pools: dict[str, list[dict]], negatives: list[str]) -> dict:
    """One case, a function of its seed."""
    rng = random.Random(seed)
    profile = rng.choices(sorted(PROFILES), [PROFILES[p][0] for p in sorted(PROFILES)])[0]
    _, required, optional, least, most = PROFILES[profile]
    chosen = {*required, *rng.sample(optional, rng.randint(least, min(most, len(optional))))}
    case, sections = _Case(rng, pools, negatives), []
    for name in (s for s in SECTIONS if s in chosen):
        titles, temporal, subject, scenarios = SECTIONS[name]
        block = next((b for b in (case.block(len(sections), rng.choice(scenarios)) for _ in range(5)) if b), None)
        if block:
            sections.append({"section_id": f"S{len(sections)}", "section_type": name, "title": rng.choice(titles), "temporal_scope": temporal, "subject_scope": subject, "blocks": [block]})
    return {"case_id": case_id, "profile": profile, "noise": "light_noise" if profile == "mixed_noisy_document" else "none", "sections": sections}


def generate_cases(spark: SparkSession, n: int, seed: int, surfaces: DataFrame, negatives: list[str] = (), first: int = 0) -> DataFrame:
    """n case specs from surfaces(text, entity_type, candidates); reruns agree, whatever the partitions.

    Every case draws from the whole pool.  A pool of at most MOST_POOL surfaces goes to the workers; of a
    larger one only its sizes do, and cases are made in rounds: a surface that a case draws by its number
    and does not have yet is looked up for the next round, and taken for unused until then.  Surfaces of
    linkable types that are marked as unusable for linking are left out.
    """
    if "usable_for_linking" in surfaces.columns:
        surfaces = surfaces.where(~F.col("entity_type").isin(*CANDIDATE_TYPES) | F.coalesce("usable_for_linking", F.lit(True)))
    pool = surfaces.select("text", "entity_type", F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"), match_key("text").alias("key"))
    ids = spark.range(first, first + n)
    if pool.limit(MOST_POOL + 1).count() > MOST_POOL:
        return _in_rounds(ids, seed, save(_numbered(pool), "pool"), sorted(negatives))
    pools: dict[str, list[dict]] = {}
    for r in sorted(pool.collect(), key=lambda r: (r["entity_type"], r["text"], r["candidates"])):
        pools.setdefault(r["entity_type"], []).append({"text": r["text"], "key": r["key"], "candidates": list(r["candidates"])})
    shared = spark.sparkContext.broadcast((pools, sorted(negatives)))

    def make(batches):
        for pdf in batches:
            yield pd.DataFrame([make_case(f"case_{i:06d}", f"{seed}:{i}", *shared.value) for i in pdf["id"]], columns=["case_id", "profile", "noise", "sections"])

    return ids.mapInPandas(make, SPEC)


def _numbered(pool: DataFrame) -> DataFrame:
    """pool with number: the place of a surface among those of its type, by text and candidates.  Sorted over all executors."""
    ordered = save(pool.orderBy("entity_type", "text", "candidates").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)  # rows of a partition are numbered from the partition's number << 33
    counts = sorted(ordered.groupBy(part.alias("p"), "entity_type").agg(F.count("*").alias("k"), F.min("_at").alias("lo")).collect(), key=lambda r: (r["entity_type"], r["p"]))
    before: dict[str, int] = {}
    shifts = []
    for r in counts:
        shifts.append((r["p"], r["entity_type"], before.get(r["entity_type"], 0) - r["lo"]))
        before[r["entity_type"]] = before.get(r["entity_type"], 0) + r["k"]
    shift = pool.sparkSession.createDataFrame(shifts, "_p long, entity_type string, _shift long")
    return ordered.withColumn("_p", part).join(F.broadcast(shift), ["_p", "entity_type"]).select("entity_type", (F.col("_at") + F.col("_shift")).alias("number"), "text", "key", "candidates")


class _Pool:
    """A pool of which a case has the surfaces that it asked for before; what it lacks is noted, and stands for one that is not used yet."""

    def __init__(self, kind: str, size: int, known: dict[tuple[str, int], dict], lacks: set[tuple[str, int]]):
        self.kind, self.size, self.known, self.lacks = kind, size, known, lacks

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> dict:
        found = self.known.get((self.kind, i))
        if found is None:
            self.lacks.add((self.kind, i))
            return {"text": "", "key": (self.kind, i), "candidates": []}
        return found


def _in_rounds(ids: DataFrame, seed: int, pool: DataFrame, negatives: list[str]) -> DataFrame:
    """Cases of ids(id) from pool(entity_type, number, text, key, candidates); a case is done in the round in which it lacks nothing."""
    spark = ids.sparkSession
    sizes = {r[0]: r[1] for r in pool.groupBy("entity_type").count().collect()}
    surface = "struct<entity_type:string,number:bigint,text:string,key:string,candidates:array<string>>"

    def make(batches):
        for pdf in batches:
            out = []
            for i, own in zip(pdf["id"], pdf["known"], strict=True):
                known = {(x["entity_type"], x["number"]): {"text": x["text"], "key": x["key"], "candidates": list(x["candidates"])} for x in own}
                lacks: set[tuple[str, int]] = set()
                case = make_case(f"case_{i:06d}", f"{seed}:{i}", {k: _Pool(k, size, known, lacks) for k, size in sizes.items()}, negatives)
                out.append((i, None if lacks else case, [{"entity_type": k, "number": x} for k, x in sorted({*known, *lacks})] if lacks else []))
            yield pd.DataFrame(out, columns=["id", "made", "wants"])

    done, rows = [], ids.select("id", F.array().cast(f"array<{surface}>").alias("known"))
    while True:
        made = save(rows.mapInPandas(make, f"id long, made struct<{SPEC.replace(' string', ':string').replace(' array', ':array')}>, wants array<struct<entity_type:string,number:bigint>>"), "cases")
        done.append(made.where("made IS NOT NULL").select("made.*"))
        left = made.where("made IS NULL")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        wanted = left.select("id", F.explode("wants").alias("w")).select("id", "w.*")
        # what is wanted is small beside the pool, and streams past it
        rows = pool.join(wanted, ["entity_type", "number"]).groupBy("id").agg(F.collect_list(F.struct("entity_type", "number", "text", "key", "candidates")).alias("known"))


# ---- specs as tables ----------------------------------------------------------------------------


def case_entities(specs: DataFrame) -> DataFrame:
    """One row for each entity, with its block and section."""
    s = specs.select("case_id", F.posexplode("sections").alias("section_index", "s"))
    b = s.select("case_id", "section_index", "s.section_id", "s.title", "s.temporal_scope", "s.subject_scope", F.posexplode("s.blocks").alias("block_index", "b"))
    return b.select("case_id", "section_index", "section_id", "title", "temporal_scope", "subject_scope", "block_index", F.col("b.scenario_id").alias("scenario_id"), F.posexplode("b.entities").alias("entity_index", "e")).select("*", "e.*").drop("e")


def case_negatives(specs: DataFrame) -> DataFrame:
    b = specs.select("case_id", F.explode("sections").alias("s")).select("case_id", F.explode("s.blocks").alias("b"))
    return b.select("case_id", F.explode("b.hard_negatives").alias("n")).select("case_id", "n.*")


def expected_markers(specs: DataFrame) -> DataFrame:
    """(case_id, marker_id, surface_text) of entities and negatives."""
    return case_entities(specs).select("case_id", F.col("entity_id").alias("marker_id"), "surface_text").union(case_negatives(specs))


def spec_errors(specs: DataFrame) -> DataFrame:
    """(case_id, marker_id, error): every fault of the specs' entities and negatives."""
    return entity_spec_errors(case_entities(specs)).union(negative_errors(case_negatives(specs), case_entities(specs)))


def entity_spec_errors(entities: DataFrame) -> DataFrame:
    """Faults of exploded entities as (case_id, marker_id, error)."""
    key = match_key(F.coalesce("surface_text", F.lit("")))
    kind, labels, temporal = F.col("entity_type"), F.array_sort(F.col("assertions")), F.col("temporal_scope")
    rows = entities.withColumns({"_key": key, "_ids": F.count("*").over(W.partitionBy("case_id", "entity_id")), "_first": F.row_number().over(W.partitionBy("case_id", key, kind == LAB_RESULT).orderBy("section_index", "block_index", "entity_index"))})
    wanted = None
    for scenario, own in markers.EXPECTED.items():
        value = F.array(*map(F.lit, own)).cast("array<string>")
        wanted = F.when(F.col("scenario_id") == scenario, value) if wanted is None else wanted.when(F.col("scenario_id") == scenario, value)
    wanted = wanted.when(F.col("scenario_id") == "mixed_polarity", F.when(F.col("entity_index") == 0, F.array(F.lit("isNegated"))).otherwise(F.array().cast("array<string>")))
    bare = F.coalesce(F.trim("surface_text"), F.lit(""))
    has = lambda a: F.array_contains("assertions", a)
    faults = [
        F.when(F.col("_ids") > 1, "repeated_id"),
        F.when(bare == "", "empty_surface").when(F.regexp_like(bare, F.lit("\\[\\[|\\]\\]|<<|>>")), "marker_in_surface"),
        F.when((kind != LAB_RESULT) & (F.col("_key") != "") & (F.col("_first") > 1), "repeated_surface"),
        F.when(~kind.isin(*ENTITY_TYPES), "unknown_type"),
        F.when(F.size(F.array_except("assertions", F.array(*map(F.lit, ASSERTIONS)))) > 0, "unknown_assertion"),
        F.when(~kind.isin(*ASSERTION_TYPES) & (F.size("assertions") > 0), "assertion_not_allowed"),
        F.when(kind.isin(*CANDIDATE_TYPES) & (F.size("candidates") == 0), "candidate_missing"),
        F.when(~kind.isin(*CANDIDATE_TYPES) & (F.size("candidates") > 0), "candidate_not_allowed"),
        F.when((kind == DRUG) & F.exists("candidates", lambda c: ~is_rxnorm_id(c)), "rxnorm_format"),
        F.when((kind == DIAGNOSIS) & F.exists("candidates", lambda c: ~is_icd_code(c)), "icd_format"),
        F.when((temporal == "historical") & kind.isin(*ASSERTION_TYPES) & ~has("isHistorical"), "history_missing_in_section"),
        F.when((temporal == "current") & has("isHistorical"), "history_in_current_section"),
        F.when((F.col("subject_scope") == "patient") & has("isFamily"), "family_in_patient_section"),
        F.when(wanted.isNotNull() & (labels != wanted), "scenario_assertions"),
    ]
    return rows.select("case_id", F.col("entity_id").alias("marker_id"), F.explode(F.filter(F.array(*faults), lambda x: x.isNotNull())).alias("error"))


def negative_errors(negatives: DataFrame, entities: DataFrame) -> DataFrame:
    """Faults of hard negatives: repeated ids, empty texts, texts that are an entity's surface."""
    surfaces = entities.where(F.col("entity_type") != LAB_RESULT).select("case_id", match_key("surface_text").alias("_key")).distinct().withColumn("_hit", F.lit(True))
    rows = negatives.withColumns({"_key": match_key(F.coalesce("surface_text", F.lit(""))), "_n": F.count("*").over(W.partitionBy("case_id", "negative_id"))}).join(surfaces, ["case_id", "_key"], "left")
    faults = [F.when(F.col("_n") > 1, "repeated_id"), F.when(F.coalesce(F.trim("surface_text"), F.lit("")) == "", "empty_surface"), F.when(F.col("_hit") & (F.col("_key") != ""), "collides_with_entity")]
    return rows.select("case_id", F.col("negative_id").alias("marker_id"), F.explode(F.filter(F.array(*faults), lambda x: x.isNotNull())).alias("error"))


# ---- rendering ----------------------------------------------------------------------------------


def section_drafts(specs: DataFrame) -> DataFrame:
    """(case_id, section_index, section_id, title, draft, surfaces): each section's template text with placeholders."""
    s = specs.select("case_id", F.posexplode("sections").alias("section_index", "s"))
    block = lambda b: markers.render(b["scenario_id"], F.transform(b["entities"], lambda e: e["entity_id"]), F.transform(b["hard_negatives"], lambda n: n["negative_id"]))
    pairs = F.flatten(F.transform("s.blocks", lambda b: F.concat(F.transform(b["entities"], lambda e: F.struct(e["entity_id"].alias("k"), e["surface_text"].alias("v"))), F.transform(b["hard_negatives"], lambda n: F.struct(n["negative_id"].alias("k"), n["surface_text"].alias("v"))))))
    return s.select("case_id", "section_index", "s.section_id", "s.title", F.array_join(F.transform("s.blocks", block), "\n").alias("draft"), F.map_from_entries(pairs).alias("surfaces"))


def prompt(title: str, surfaces: dict[str, str], template: str, faults: list[str] = ()) -> str:
    """Text for a language model: write the section with every placeholder once; on a repair, with what was wrong."""
    listed = "\n".join(f"<<{k}>> = {v}" for k, v in surfaces.items())
    repair = "\nSửa các lỗi sau: " + "; ".join(faults) if faults else ""
    return f"Viết mục bệnh án «{title}» bằng tiếng Việt. Giữ nguyên mỗi placeholder đúng một lần.\n{listed}\nBản mẫu:\n{template}{repair}"


def draft_errors(draft: str, surfaces: dict[str, str]) -> list[str]:
    import re

    found = re.findall(r"<<([EN]\d+)>>", draft)
    out = [f"{k}: {found.count(k)}" for k in surfaces if found.count(k) != 1] + [f"{k}: unknown" for k in set(found) - set(surfaces)]
    low = draft.lower()
    bare = " ".join(re.sub(r"<<[EN]\d+>>", " ", low).split())
    out += [f"{k}: leaked" for k, v in surfaces.items() if re.search(rf"(?<!\w){re.escape(' '.join(v.lower().split()))}(?!\w)", bare)]
    return out + [f"banned: {b}" for b in (*markers.BANNED, "```", "[[", "]]") if b in low]


def render_cases(specs: DataFrame, client: Callable[[str], str] | None = None, tries: int = 3) -> DataFrame:
    """(case_id, marked_text, sections): marked notes; an injected client may write sections, templates stand in when it fails."""
    drafts = section_drafts(specs)
    if client is not None:

        def write(batches):
            for pdf in batches:
                modes, attempts, texts = [], [], []
                for r in pdf.itertuples():
                    surfaces, faults, text, n = dict(r.surfaces), [], None, 0
                    while n < tries and text is None:
                        n += 1
                        try:
                            got = client(prompt(r.title, surfaces, r.draft, faults))
                            faults = draft_errors(got, surfaces)
                            text = None if faults else got
                        except Exception as x:
                            faults = [str(x)]
                    modes.append("llm" if text else "template_fallback")
                    attempts.append(n)
                    texts.append(text or r.draft)
                yield pdf.assign(draft=texts, render_mode=modes, attempt=attempts)

        drafts = drafts.mapInPandas(write, "case_id string, section_index int, section_id string, title string, draft string, surfaces map<string,string>, render_mode string, attempt int")
    else:
        drafts = drafts.withColumns({"render_mode": F.lit("template"), "attempt": F.lit(1)})
    marked = drafts.withColumn("marked", markers.expand_placeholders(F.col("draft"), F.col("surfaces")))
    order = F.sort_array(F.collect_list(F.struct("section_index", "section_id", "title", "marked", "render_mode", "attempt")))
    return marked.groupBy("case_id").agg(order.alias("sections")).select("case_id", F.array_join(F.transform("sections", lambda s: F.concat(s["title"], F.lit("\n"), s["marked"])), "\n\n").alias("marked_text"), "sections")


def _section_ranges(specs: DataFrame, texts: DataFrame) -> DataFrame:
    """(case_id, section_index, from, to): a section runs from its title, sought after the title before it, to the next one's."""
    at = "if(locate(t, text, acc.cur + 1) > 0, locate(t, text, acc.cur + 1) - 1, acc.cur)"
    starts = F.expr(f"aggregate(titles, named_struct('cur', 0, 'out', cast(array() as array<int>)), (acc, t) -> named_struct('cur', {at} + length(t), 'out', array_append(acc.out, {at})), acc -> acc.out)")
    rows = specs.select("case_id", F.transform("sections", lambda x: x["title"]).alias("titles")).join(texts, "case_id")
    rows = rows.select("case_id", F.length("text").alias("length"), F.posexplode(starts).alias("section_id", "start"))
    return markers.section_ranges(rows).select("case_id", F.col("section_id").alias("section_index"), F.col("start").alias("from"), F.col("end").alias("to"))


def wording_errors(specs: DataFrame, stripped: DataFrame) -> DataFrame:
    """(case_id, marker_id, error) of stripped(case_id, marked_text, _m): surface counts, banned terms, placeholders left, repeated titles.

    marker_id is empty: these faults are of the note.
    """
    counts = markers.surface_counts(stripped.select("case_id", F.col("_m.text").alias("text")), expected_markers(specs))
    counted = counts.select("case_id", F.lit("").alias("marker_id"), F.concat_ws(" ", F.lit("surface_count"), "surface_text", "found", "wanted").alias("error"))
    titles = specs.select("case_id", F.transform("sections", lambda x: x["title"]).alias("titles"))
    low = F.lower("marked_text")
    faults = F.concat(
        F.filter(F.array(F.when(F.regexp_like("marked_text", F.lit(markers.PLACEHOLDER)), "placeholder_left"), *[F.when(F.contains(low, F.lit(b)), f"banned:{b}") for b in markers.BANNED]), lambda x: x.isNotNull()),
        F.transform(F.filter("titles", lambda t: F.contains(F.col("marked_text"), F.concat(t, F.lit("\n"), t))), lambda t: F.concat(F.lit("repeated_title:"), t)),
    )
    said = stripped.join(titles, "case_id").select("case_id", F.lit("").alias("marker_id"), F.explode(faults).alias("error"))
    return counted.union(said)


def section_errors(specs: DataFrame, notes: DataFrame) -> DataFrame:
    """(case_id, marker_id, error) of notes(case_id, sections): sections that are not the spec's or are missing, and each section's own markers and surface counts.

    marker_id is the section, or the section and marker.
    """
    rendered = notes.select("case_id", F.explode("sections").alias("s")).select("case_id", "s.section_id", F.col("s.marked").alias("marked_text"))
    spec = specs.select("case_id", F.explode("sections").alias("s")).select("case_id", "s.section_id", F.lit(True).alias("known"))
    both = spec.join(rendered.select("case_id", "section_id", F.lit(True).alias("there")).distinct(), ["case_id", "section_id"], "full").join(notes.select("case_id"), "case_id", "left_semi")
    sets = both.select("case_id", F.col("section_id").alias("marker_id"), F.when(F.col("known").isNull(), "unknown_section").when(F.col("there").isNull(), "missing_section").alias("error")).where("error IS NOT NULL")
    one = F.to_json(F.struct("case_id", "section_id"))  # a section stands for a case
    entities, negatives = case_entities(specs), specs.select("case_id", F.explode("sections").alias("s")).select("case_id", "s.section_id", F.explode("s.blocks").alias("b")).select("case_id", "section_id", F.explode("b.hard_negatives").alias("n"))
    wanted = entities.select(one.alias("case_id"), F.col("entity_id").alias("marker_id"), "surface_text").union(negatives.select(one.alias("case_id"), "n.negative_id", "n.surface_text"))
    own = rendered.join(spec, ["case_id", "section_id"], "left_semi").select(one.alias("case_id"), "marked_text")
    marked = markers.marker_errors(own, wanted)
    counts = markers.surface_counts(own.select("case_id", markers.strip_markers("marked_text")["text"].alias("text")), wanted).select("case_id", F.lit("").alias("marker_id"), F.concat_ws(" ", F.lit("surface_count"), "surface_text", "found", "wanted").alias("error"))
    named = marked.union(counts).withColumn("_k", F.from_json("case_id", "case_id string, section_id string"))
    return sets.union(named.select("_k.case_id", F.concat_ws("/", "_k.section_id", F.nullif("marker_id", F.lit(""))), "error"))


def validate_cases(specs: DataFrame, notes: DataFrame) -> DataFrame:
    """(case_id, errors): faults of spec, markers, semantics, surface counts and wording of notes(case_id, marked_text).

    With the notes' sections (as render_cases gives them), each section is checked by itself too, and
    the sections must be the spec's.
    """
    e = case_entities(specs)
    stripped = notes.select("case_id", "marked_text", markers.strip_markers("marked_text").alias("_m"))
    text = stripped.select("case_id", F.col("_m.text").alias("text"), F.explode("_m.spans").alias("p")).select("case_id", "text", F.col("p.marker_id").alias("entity_id"), "p.start", "p.end")
    from ..functions.text import scope_prefix

    ranges = _section_ranges(specs, stripped.select("case_id", F.col("_m.text").alias("text")))
    rows = text.join(e, ["case_id", "entity_id"]).where(F.col("entity_type").isin(*ASSERTION_TYPES)).join(ranges, ["case_id", "section_index"])
    lo, hi = F.greatest(F.col("from"), F.col("start") - 180), F.least(F.col("to"), F.col("end") + 100)
    rows = rows.withColumns({"prefix": scope_prefix("text", "start", markers.CONTRAST), "window": F.lower(F.substring("text", lo + 1, hi - lo))})
    semantic = markers.semantic_faults(rows).select("case_id", F.col("entity_id").alias("marker_id"), F.explode("faults").alias("error"))
    every = spec_errors(specs).union(markers.marker_errors(notes, expected_markers(specs))).union(semantic).union(wording_errors(specs, stripped))
    if "sections" in notes.columns:
        every = every.union(section_errors(specs, notes))
    listed = every.groupBy("case_id").agg(F.sort_array(F.collect_list(F.concat_ws(": ", "marker_id", "error"))).alias("errors"))
    return specs.select("case_id").join(listed, "case_id", "left").select("case_id", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"))


def aligned_entities(specs: DataFrame, notes: DataFrame) -> DataFrame:
    """(case_id, entity_index, raw_text, text, entity_type, start, end, assertions, candidates) of marked notes, in order of place; the specs' own ids are dropped."""
    stripped = notes.select("case_id", markers.strip_markers("marked_text").alias("_m"))
    spans = stripped.select("case_id", F.col("_m.text").alias("raw_text"), F.explode("_m.spans").alias("p")).select("case_id", "raw_text", F.col("p.marker_id").alias("entity_id"), "p.start", "p.end")
    rows = spans.join(case_entities(specs).drop("entity_index"), ["case_id", "entity_id"])
    number = F.row_number().over(W.partitionBy("case_id").orderBy("start", "end", "entity_id")) - 1
    return rows.select("case_id", number.alias("entity_index"), "raw_text", F.expr("substring(raw_text, start + 1, end - start)").alias("text"), "entity_type", "start", "end", "assertions", "candidates")


def export_cases(specs: DataFrame, notes: DataFrame, known: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted cases (case_id, text, entities, split), and the rejected ones (case_id, errors).

    Cases without a note, with a fault of validate_cases(), or whose entities are not valid output
    (overlaps, and codes outside `known`, included) are rejected.  Cases that share what they are about
    are in one split.
    """
    noted = specs.join(notes.select("case_id"), "case_id", "left_semi")
    lost = specs.join(notes.select("case_id"), "case_id", "left_anti").select("case_id", F.array(F.lit("no_note")).alias("errors"))
    faults = validate_cases(noted, notes).where(F.size("errors") > 0)
    entities = aligned_entities(noted, notes)
    checked = validation.output_errors(entities, "case_id").select("case_id", F.explode("errors").alias("error"))
    over = validation.overlap_with_earlier(entities, "case_id").where("overlaps").select("case_id", F.lit("overlap").alias("error"))
    every = checked.union(over)
    if known:
        every = every.union(validation.candidate_errors(entities, known, "case_id").select("case_id", "error"))
    rejected = lost.union(faults).union(every.groupBy("case_id").agg(F.sort_array(F.collect_list("error")).alias("errors"))).groupBy("case_id").agg(F.flatten(F.collect_list("errors")).alias("errors"))
    one = F.struct("entity_index", "text", F.col("entity_type").alias("type"), F.array("start", "end").alias("position"), "assertions", "candidates")
    good = entities.join(rejected.select("case_id"), "case_id", "left_anti").groupBy("case_id").agg(F.first("raw_text").alias("text"), F.sort_array(F.collect_list(one)).alias("entities"))
    about = export.signature(F.transform("entities", lambda e: e["candidates"]), F.transform("entities", lambda e: e["text"]))
    return good.select("case_id", "text", F.transform("entities", lambda e: e.dropFields("entity_index")).alias("entities"), export.split(about).alias("split")), rejected
