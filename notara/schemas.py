"""Row types and closed vocabularies of the clinical text engine."""

from __future__ import annotations

from pyspark.sql import types as T

# Entity types, assertion labels, ontologies, RxNorm term types.
SYMPTOM, DIAGNOSIS, DRUG, LAB_NAME, LAB_RESULT = "TRIỆU_CHỨNG", "CHẨN_ĐOÁN", "THUỐC", "TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM"
ENTITY_TYPES = (SYMPTOM, DIAGNOSIS, DRUG, LAB_NAME, LAB_RESULT)
ASSERTION_TYPES = (SYMPTOM, DIAGNOSIS, DRUG)
CANDIDATE_TYPES = (DIAGNOSIS, DRUG)
ASSERTIONS = ("isNegated", "isHistorical", "isFamily")
ONTOLOGIES = ("ICD10", "RXNORM")
RXNORM_TTYS = ("IN", "PIN", "MIN", "SCDC", "SCD", "BN", "SBD", "DF")

ENTITY = "struct<text:string,entity_type:string,start:int,end:int,assertions:array<string>,candidates:array<string>,confidence:double,source:string,metadata:map<string,string>>"
DOCUMENT = f"document_id string, raw_text string, normalized_text string, normalized_to_raw array<int>, entities array<{ENTITY}>, metadata map<string,string>"
RAW_ENTITIES = "array<struct<text:string,type:string,position:array<int>,assertions:array<string>,candidates:array<string>>>"
PREDICTION = "document_id string, ord int, text string, entity_type string, start int, end int, confidence double, source string"
CUE = "label string, cue string, cue_start int, cue_end int, cue_confidence double, direction string"
ONTOLOGY = "code string, name string, aliases array<string>, description string, ontology string"
SAMPLE = "array<struct<tokenized_text:array<string>,ner:array<struct<start:int,end:int,label:string>>>>"



def struct(**fields: T.DataType) -> T.StructType:
    """A struct type that needs no session, as DDL strings do."""
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()
SPAN = struct(start=INT, end=INT)
TEXT_SPAN = struct(text=STRING, start=INT, end=INT)
