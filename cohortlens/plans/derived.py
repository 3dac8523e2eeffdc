"""Inputs derived from the given tables, in SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_L1 = (
    "Severe fatigue since last cycle.",
    "No nausea today.",
    "Denies fever but reports chills and pain.",
    "Febrile neutropenia was suspected.",
    "Grade 2 peripheral neuropathy in both hands.",
    "Rash not present.",
    "Mild SOB on stairs; temp 38.5 °C.",
    "",
)
_L2 = (
    "Without vomiting, however mouth sores persist.",
    "Cancer-related fatigue remains moderate.",
    "Pulmonary embolism ruled out.",
    "Labs reviewed.",
    "Burning pain and numbness.",
    "Blood  clot noted.",
    "Life-threatening colitis last year.",
    "No evidence of thrombosis|- diarrhea reported",
)
_L3 = (
    "Hémoglobine stable. Low platelets.",
    "Hair loss, itching.",
    "Anemia absent.",
    "Plan: continue.",
    "Low hemoglobin though no bleeding.",
)
AE_TYPES = (
    "febrile_neutropenia", "anemia", "thrombocytopenia", "nausea_vomiting", "peripheral_neuropathy",
    "hepatotoxicity", "nephrotoxicity", "pneumonitis", "colitis", "fatigue", "diarrhea", "mucositis",
)


def _pick(index: str, values: tuple[str, ...]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {whens} end"


_NOTE = (
    "case when k%50=49 then null else replace(trim(concat("
    f"{_pick('k%8', _L1)}, ' ', {_pick('cast(floor(k/8) as bigint)%8', _L2)}, ' ', "
    f"{_pick('cast(floor(k/64) as bigint)%5', _L3)})), '|', chr(10)) end"
)

#: what a reader finds in the sentences of the notes: sentence, text, category, negated
_ANNOTATED = {
    "k%8": (
        (0, "fatigue", "fatigue", False), (1, "nausea", "nausea", True), (2, "fever", "fever", True), (2, "chills", "fever", False),
        (2, "pain", "pain", False), (3, "Febrile neutropenia", "neutropenia", False), (4, "peripheral neuropathy", "neuropathy", False),
        (5, "Rash", "rash", True), (6, "SOB", "dyspnea", False),
    ),
    "cast(floor(k/8) as bigint)%8": (
        (0, "vomiting", "vomiting", True), (0, "mouth sores", "mucositis", False), (1, "Cancer-related fatigue", "fatigue", False),
        (2, "Pulmonary embolism", "thrombosis", True), (4, "Burning pain", "neuropathy", False), (4, "numbness", "neuropathy", False),
        (5, "Blood  clot", "thrombosis", False), (6, "colitis", "colitis", False), (7, "thrombosis", "thrombosis", True),
        (7, "diarrhea", "diarrhea", False),
    ),
    "cast(floor(k/64) as bigint)%5": (
        (0, "Low platelets", "thrombocytopenia", False), (1, "Hair loss", "alopecia", False), (1, "itching", "rash", False),
        (2, "Anemia", "anemia", True), (4, "Low hemoglobin", "anemia", False), (4, "bleeding", "bleeding", True),
    ),
}
#: gold mentions of the notes of patients, as text, category and negation
NOTE_GOLD_SQL = " union all ".join(
    f"select concat('PT', lpad(cast(k as varchar(10)),6,'0')) case_id, '{text}' text, '{category}' category, {str(negated).lower()} negated"
    f" from (select c_custkey k from {{customer}}) where {index} = {i}"
    for index, found in _ANNOTATED.items()
    for i, text, category, negated in found
)

#: 23 patient columns; `{customer}` is the table
PATIENTS_SQL = f"""
with b as (
  select c_custkey k, abs(cast(round(c_acctbal*100) as bigint)) a, c_mktsegment m, c_nationkey n from {{customer}}
), p as (
  select concat('PT', lpad(cast(k as varchar(10)),6,'0')) patient_id,
    cast(25+(k*7)%66 as int) age, case when k%2=0 then 'M' else 'F' end sex,
    case m when 'MACHINERY' then 'breast' when 'BUILDING' then 'lung_nsclc' when 'AUTOMOBILE' then 'colorectal'
           when 'HOUSEHOLD' then 'melanoma' else 'ovarian' end cancer_type,
    case when (k*3)%10=0 then 'I' when (k*3)%10<=2 then 'II' when (k*3)%10<=5 then 'III' else 'IV' end stage,
    case n%6 when 0 then 'FOLFOX' when 1 then 'carboplatin_paclitaxel' when 2 then 'pembrolizumab'
             when 3 then 'olaparib' when 4 then 'docetaxel' else 'imatinib' end treatment,
    cast(1+k%8 as int) cycle_number, cast(k%4 as int) ecog_score,
    (5+a%95)/cast(10 as double) wbc,
    case when k%37=0 then null else (5+a%391)/cast(100 as double) end anc,
    (60+a%97)/cast(10 as double) hemoglobin, cast(20+a%331 as double) platelets,
    (40+a%241)/cast(100 as double) creatinine, cast(5+a%181 as double) alt, (10+a%311)/cast(100 as double) bilirubin,
    (a%101)/cast(10 as double) fatigue_score, (a%103)/cast(10 as double) nausea_score,
    (a%89)/cast(10 as double) pain_score, (a%71)/cast(10 as double) dyspnea_score,
    {_NOTE} clinical_note, k, a
  from b
), o as (
  select *, ((k*31+a)%100) < 15 + case when stage='IV' then 15 else 0 end
                              + case when coalesce(anc, 9)<1 then 20 else 0 end + 5*ecog_score adverse_event
  from p
)
select patient_id, age, sex, cancer_type, stage, treatment, cycle_number, ecog_score, wbc, anc, hemoglobin, platelets,
  creatinine, alt, bilirubin, fatigue_score, nausea_score, pain_score, dyspnea_score, clinical_note, adverse_event,
  case when adverse_event then {_pick('k%12', AE_TYPES)} end ae_type,
  case when adverse_event then cast(1+k%4 as int) end ae_grade
from o
"""

#: labelled scores with ties; `{documents}` and `{labels}` are the tables
SCORES_SQL = """
select d.doc_id, l.quality as y, l.toxic as toxic, (d.n_chars % 1000)/cast(1000 as double) as p
from {documents} d join {labels} l on d.doc_id = l.doc_id
"""

GRAPH_ROOT = "HP:0000003"
_URI = "concat('http://purl.obolibrary.org/obo/HP_', lpad(cast({} as varchar(10)), 7, '0'))"
_K = "p_partkey"

#: ontology edges with diamonds, a cycle and edges of another kind
EDGES_SQL = f"""
select {_URI.format(_K)} sub, 'is_a' pred, {_URI.format('cast(floor(p_partkey/2) as bigint)')} obj from {{part}} where p_partkey >= 1
union all
select {_URI.format(_K)}, 'is_a', {_URI.format('cast(floor(p_partkey/3) as bigint)')} from {{part}} where p_partkey % 5 = 0 and p_partkey >= 5
union all
select {_URI.format('3')}, 'is_a', {_URI.format('27')} from {{part}} where p_partkey = 3
union all
select {_URI.format(_K)}, 'part_of', {_URI.format('3')} from {{part}} where p_partkey % 11 = 0
"""

#: ontology nodes, flat; synonyms are joined by `|`
NODES_SQL = f"""
select p_partkey ord, {_URI.format(_K)} id, case when p_partkey % 13 = 0 then 'PROPERTY' else 'CLASS' end type,
  case when p_partkey % 17 = 0 then '  ' else p_name end lbl,
  case p_partkey % 3 when 0 then '' when 1 then p_brand else concat(p_brand, '|', p_type) end syn,
  case when p_partkey % 7 = 0 then null else concat('about ', p_name) end def
from {{part}}
"""

CONCEPTS_SQL = """
select vec_id as vector_idx, concat('HP:', lpad(cast(label as varchar(10)), 7, '0')) as hpo_id,
  concat('term ', cast(vec_id as varchar(20))) as text, embedding from {embeddings}
"""

#: gold and predicted mentions over all vectors; case 19 failed
EXPECTED_SQL = """
select vec_id % 20 as case_id, concat('term ', cast(vec_id as varchar(20))) as text,
  concat('HP:', lpad(cast(case when vec_id % 13 = 0 then (label+1) % 10 else label end as varchar(10)), 7, '0')) as hpo_id,
  vec_id % 3 = 0 as negated
from {embeddings} where vec_id % 11 <> 4
"""
PREDICTED_SQL = """
select vec_id % 20 as case_id,
  case when cast(floor(vec_id/20) as bigint) % 2 = 0 then upper(concat('term ', cast(vec_id as varchar(20))))
       else concat('term ', cast(vec_id as varchar(20))) end as text,
  vec_id as start, vec_id % 9 = 0 as negated, embedding
from {embeddings} where vec_id % 7 <> 0 and vec_id % 20 <> 19
"""
CASES_SQL = "select distinct vec_id % 20 as case_id, case when vec_id % 20 = 19 then 'failed' else 'ok' end as status from {embeddings}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def duck(sql: str) -> str:
    """The same SQL over DuckDB views of the tables."""
    names = ("customer", "documents", "labels", "part", "embeddings", "nation")
    return sql.format(**{n: n for n in names})


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PATIENTS_SQL, "customer")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients(spark, sf_dir).select("patient_id", "clinical_note")
