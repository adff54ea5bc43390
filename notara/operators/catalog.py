"""Training catalogs: mentions, surfaces, RxNorm concepts, families, resolution against ontologies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import WORD, clean_text, match_key, slices
from ..schemas import DIAGNOSIS, DRUG, SYMPTOM

# Label mapping, word lists, patterns and surface tables.
LABELS = {"DISEASE": DIAGNOSIS, "DIAGNOSIS": DIAGNOSIS, "SYMPTOM": SYMPTOM}
PROCEDURES = ("phẫu thuật", "mổ", "nội soi", "sinh thiết", "đặt stent", "xạ trị", "hóa trị", "lọc máu", "thở máy", "đặt nội khí quản", "can thiệp", "chụp tử cung vòi trứng", "cholangiogram", "lấy mẫu bằng bàn chải", "nối mật tụy")
CORRECTIONS = {"o lắng": "lo lắng"}
REJECTED = ("bàn chân", "nâng hai cánh tay qua đầu", "õm vào trong", "xả màu vàng hay xanh", "rung rinh", "đau đầy", "không có tầm nhìn", "gây mất tầm nhìn", "có một khối ở bụng")
BAD_PREFIXES = ("có ", "có một ", "gây ", "được ", "nâng ", "thực hiện ")
CUE_WORDS = ("không", "chưa", "phủ nhận")
DIRECTIONS = ("vào trong", "ra ngoài")
STRENGTH = "(?i)(\\d+(?:[.,]\\d+)?)\\s*(mcg/ml|mg/ml|g/ml|mg|mcg|µg|g|ml|%)"
BRAND = "\\[([^\\[\\]]+)\\]\\s*$"
FORMS = {"oral_tablet": "oral tablet", "oral_capsule": "oral capsule", "oral_solution": "oral solution", "injectable_solution": "injectable solution", "topical_cream": "topical cream", "topical_ointment": "topical ointment"}
FORM_SURFACES = {"oral_tablet": ["viên", "viên nén", "tablet", "tab"], "oral_capsule": ["viên nang", "capsule", "cap"], "oral_solution": ["dung dịch uống", "oral solution"], "topical_cream": ["kem bôi", "cream"], "topical_ointment": ["thuốc mỡ", "ointment"]}
ROUTES = {"oral_tablet": ["po", "uống"], "oral_capsule": ["po", "uống"], "oral_solution": ["po", "uống"], "topical_cream": ["bôi ngoài da"], "topical_ointment": ["bôi ngoài da"]}
FREQUENCIES = ["daily", "qd", "ngày 1 lần", "mỗi ngày", "mỗi sáng"]
PER_DAY = "1 viên/ngày"
ROLES = {"IN": "ingredients", "PIN": "ingredients", "MIN": "ingredients", "SCDC": "strength_components", "SCD": "clinical_drugs", "SBD": "clinical_drugs", "BN": "brands"}


def case(column: Column, table: dict, default: Column | None = None) -> Column:
    """column looked up in a small constant table."""
    out = None
    for k, v in table.items():
        value = F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
        out = F.when(column == k, value) if out is None else out.when(column == k, value)
    return out if default is None else out.otherwise(default)


def last_wins(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """For each key the row of the greatest `order`, at the least one (column position)."""
    w = W.partitionBy(*key)
    return rows.withColumns({"position": F.min(order).over(w), "_rank": F.row_number().over(w.orderBy(F.desc(order)))}).where("_rank = 1").drop("_rank")


# ---- mentions and surfaces ----------------------------------------------------------------------


def mentions(rows: DataFrame) -> DataFrame:
    """(id, label, text, entity_type, valid) of rows(id, text, label array<struct<start,end,type>>), one for each span."""
    spans = F.transform("label", lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end")))
    every = F.arrays_zip(F.col("label").alias("span"), slices("text", spans).alias("said"))
    out = rows.select("id", F.length("text").alias("_length"), F.posexplode(every).alias("index", "x")).select("id", "_length", "index", "x.*")
    valid = (F.col("span.start") >= 0) & (F.col("span.start") < F.col("span.end")) & (F.col("span.end") <= F.col("_length"))
    surface = F.when(valid, clean_text("said"))
    return out.select("id", "index", F.col("span.type").alias("label"), surface.alias("surface"), case(F.col("span.type"), LABELS).alias("entity_type"), valid.alias("valid"))


def surface_verdict(text: str, kind: str, *, corrections=CORRECTIONS, rejected=REJECTED, prefixes=BAD_PREFIXES, cue_words=CUE_WORDS, directions=DIRECTIONS, symptom: str = SYMPTOM) -> tuple[Column, Column]:
    """Cleaned surface and reject reason (null if it stays) of a raw surface, by the first rule that applies."""
    base = F.regexp_replace(clean_text(text), "[ \\t\\r\\n,;:]+$", "")
    fixed = case(match_key(base), corrections, base) if corrections else base
    key = match_key(fixed)
    starts = F.lit(False)
    for p in prefixes:
        starts = starts | key.startswith(p)
    ends = F.lit(False)
    for d in directions:
        ends = ends | key.endswith(d)
    cue = F.regexp_like(fixed, F.lit(f"(?iu)(?<!{WORD})(?:{'|'.join(cue_words)})(?!{WORD})"))
    is_symptom = F.col(kind) == symptom
    reason = (
        F.when(clean_text(text).isNull() | (clean_text(text) == ""), "empty")
        .when(F.length(fixed) < 3, "too_short")
        .when(key.isin(*rejected), "manual_reject")
        .when(is_symptom & cue, "embedded_assertion_cue")
        .when(is_symptom & starts, "contextual_prefix")
        .when(is_symptom & ends & (F.size(F.split(key, " ")) <= 4), "incomplete_directional_fragment")
    )
    return F.when(reason.isNull(), fixed), reason


# ---- RxNorm -------------------------------------------------------------------------------------


def parse_concept(name: str = "name") -> dict[str, Column]:
    """Ingredient, strength, dose form, brand and complexity of a concept's name."""
    brand = F.nullif(F.trim(F.regexp_extract(name, BRAND, 1)), F.lit(""))
    bare = F.trim(F.regexp_replace(name, BRAND, ""))
    found = F.regexp_extract_all(bare, F.lit(STRENGTH), F.lit(0))
    value = F.translate(F.regexp_extract(bare, STRENGTH, 1), ",", ".")
    unit = F.replace(F.lower(F.regexp_extract(bare, STRENGTH, 2)), F.lit("µg"), F.lit("mcg"))
    some = F.size(found) > 0
    ingredient = F.when(some, F.btrim(F.regexp_replace(bare, STRENGTH + "(?s).*$", ""), F.lit(" ,;/:-"))).otherwise(bare)
    form = None
    for k, words in FORMS.items():
        hit = F.regexp_like(bare, F.lit(f"(?i)(?<!{WORD}){words}(?!{WORD})"))
        form = F.when(hit, k) if form is None else form.when(hit, k)
    return {
        "ingredient_text": ingredient, "strength_value": F.when(some, value), "strength_unit": F.when(some, unit), "dose_form": form,
        "brand": brand, "complex_product": (F.size(found) > 1) | F.contains(bare, F.lit(" / ")),
    }


def strength_forms() -> Column:
    v, u = F.col("strength_value"), F.col("strength_unit")
    return F.when(v.isNotNull(), F.array(F.concat(v, F.lit(" "), u), F.concat(v, u))).otherwise(F.array().cast("array<string>"))


def drug_surfaces(concepts: DataFrame) -> DataFrame:
    """(concept_id, tty, text, profile): the surfaces of each parsed concept by its term type, as one projection and explode."""
    ingredient, form = clean_text("ingredient_text"), F.col("dose_form")
    none = F.array().cast("array<string>")
    simple = ~F.col("complex_product") & ingredient.isNotNull()
    clinical, product = F.col("tty").isin("SCDC", "SCD", "SBD"), F.col("tty").isin("SCD", "SBD")
    strength = F.transform(strength_forms(), lambda s: F.concat(ingredient, F.lit(" "), s))
    each = lambda left, right: F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.concat(x, F.lit(" "), y))))
    orders = each(each(strength, case(form, ROUTES, none)), F.array(*map(F.lit, FREQUENCIES)))
    daily = F.when(form.isin("oral_tablet", "oral_capsule"), F.transform(strength, lambda x: F.concat(x, F.lit(f" {PER_DAY}")))).otherwise(none)
    by_brand = F.when((F.col("tty") == "SBD") & clean_text("brand").isNotNull() & ~F.col("complex_product"), F.transform(strength_forms(), lambda s: F.concat(clean_text("brand"), F.lit(" "), s))).otherwise(none)
    kinds = {
        "ingredient_only": F.when(F.col("tty").isin("IN", "PIN", "MIN"), F.array(F.coalesce(ingredient, F.col("name")))).otherwise(none),
        "brand_only": F.when(F.col("tty") == "BN", F.array(F.coalesce(clean_text("brand"), F.col("name")))).otherwise(none),
        "canonical": F.when(clinical, F.array(F.lower("name"))).otherwise(none),
        "ingredient_strength": F.when(clinical & simple, strength).otherwise(none),
        "ingredient_strength_form": F.when(product & simple & form.isNotNull(), each(strength, case(form, FORM_SURFACES, none))).otherwise(none),
        "full_medication_order": F.when(product & simple & form.isNotNull(), F.concat(orders, daily)).otherwise(none),
        "brand_strength": by_brand,
    }
    named = lambda texts, kind: F.transform(texts, lambda x: F.struct(x.alias("text"), F.lit(kind).alias("profile")))
    every = F.flatten(F.array(*[named(v, k) for k, v in kinds.items()]))
    return concepts.select("concept_id", "tty", F.posexplode(every).alias("ordinal", "s")).select("concept_id", "tty", "ordinal", clean_text("s.text").alias("text"), "s.profile").where("text IS NOT NULL")


def families(concepts: DataFrame) -> DataFrame:
    """(family_id, ingredients, strength_components, clinical_drugs, brands): concept ids by role; a dose form alone gives an empty family."""
    key = match_key(F.coalesce(clean_text("ingredient_text"), F.col("name")))
    role = case(F.col("tty"), ROLES)
    roles = ("ingredients", "strength_components", "clinical_drugs", "brands")
    return concepts.withColumns({"family_id": key, "_role": role}).groupBy("family_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("_role") == r, F.col("concept_id")))).alias(r) for r in roles])


# ---- resolution ---------------------------------------------------------------------------------


def resolve_treatments(treatments: DataFrame, surfaces: DataFrame, procedures: tuple[str, ...] = PROCEDURES) -> DataFrame:
    """treatments(id, text) with outcome: procedure (a term is inside), drug (exactly one candidate: concept_id), unresolved."""
    known = surfaces.select(match_key("text").alias("key"), "concept_id").groupBy("key").agg(F.countDistinct("concept_id").alias("n"), F.min("concept_id").alias("concept_id"))
    rows = treatments.withColumn("key", match_key("text")).join(known, "key", "left")
    inside = F.lit(False)
    for p in procedures:
        inside = inside | F.contains(F.col("key"), F.lit(p))
    outcome = F.when(inside, "procedure").when(F.col("n") == 1, "drug").otherwise("unresolved")
    return rows.select("id", "text", outcome.alias("outcome"), F.when(outcome == "drug", F.col("concept_id")).alias("concept_id"))


def resolve_diseases(texts: DataFrame, concepts: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Distinct texts(text) with concept_id if exactly one concept has the name; index is the place in sorted order.

    The numbering window orders distinct surfaces of a catalog, not documents.
    """
    distinct = texts.select("text").distinct().withColumn("index", F.row_number().over(W.orderBy("text")) - 1)
    key = match_key("text")
    named = distinct.withColumn("key", case(key, aliases, key) if aliases else key)
    known = concepts.groupBy(match_key("name").alias("key")).agg(F.count("*").alias("n"), F.min("concept_id").alias("concept_id"))
    return named.join(known, "key", "left").select("text", "index", F.when(F.col("n") == 1, F.col("concept_id")).alias("concept_id"))


def reject_collisions(surfaces: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """surfaces(text) that are, and are not, a surface of the other type."""
    keys = others.select(match_key("text").alias("_key")).distinct()
    keyed = surfaces.withColumn("_key", match_key("text"))
    return keyed.join(keys, "_key", "left_semi").drop("_key"), keyed.join(keys, "_key", "left_anti").drop("_key")


def seed_ids(rows: DataFrame, prefix: str, order: str = "text", width: int = 6) -> DataFrame:
    """rows with ids by their place in sorted order."""
    return rows.withColumn("surface_id", F.concat(F.lit(prefix), F.lpad((F.row_number().over(W.orderBy(order)) - 1).cast("string"), width, "0")))


def surfaces_of(kind: str) -> str:
    return {DRUG: "drug_surfaces", DIAGNOSIS: "disease_surfaces", SYMPTOM: "symptom_surfaces"}[kind]
