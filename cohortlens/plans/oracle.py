"""DuckDB SQL that says what each query returns.

Written straight from the rules, token by token and pair by pair, with no
regard for size; it shares the derived inputs and the fixed word lists with
the queries and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from ..functions.grammar import ABBREVIATIONS
from ..operators import evaluation as ev
from ..operators import features as ft
from ..operators import mapping as mp
from ..operators import models as md
from ..operators import negation as ng
from ..operators import scoring as sc
from ..operators import symptoms as sy
from . import derived as d
from .derived import duck
from .queries import CHAT_CUES, DOC_CUES, DOC_TERMS, EXTRA_VOCABULARY

_RE = (
    "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    + r"|\p{L}[\p{L}\p{N}]*|\p{N}+(?:[.,]\p{N}+)*|\s+|[^\s\p{L}\p{N}]"
)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rows(rows: Iterable[Sequence[object]], columns: str) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"select distinct * from (values {body}) v({columns})"


# --------------------------------------------------------------------------
# text
# --------------------------------------------------------------------------


def _words(notes: str) -> str:
    """CTEs ``notes(id, t)`` to ``word(id, p, w, off, sent)``."""
    return f"""
notes as (select * from ({notes}) where t is not null and t <> ''),
raw as (select id, unnest(regexp_extract_all(t, '{_RE}')) w, generate_subscripts(regexp_extract_all(t, '{_RE}'), 1) i from notes),
tok as (select id, w, i, sum(length(w)) over (partition by id order by i) - length(w) off from raw),
w0 as (select id, w, off, row_number() over (partition by id order by i) p, w in ('.', '!', '?') ender,
  regexp_full_match(w, '\\p{{P}}') punct from tok where w <> ' '),
w1 as (select *, max(case when ender then p end) over (partition by id order by p rows between unbounded preceding and 1 preceding) le,
  max(case when not punct then p end) over (partition by id order by p rows between unbounded preceding and 1 preceding) ln from w0),
word as (select id, p, w, cast(off as int) off, sum(case when not punct and le is not null and (ln is null or le > ln) then 1 else 0 end)
  over (partition by id order by p) sent from w1)"""


def _hits(notes: str, phrases: Iterable[Sequence[str]]) -> str:
    """CTEs up to ``hit(id, kind, category, s, e, n, mention, sent, sent2)``."""
    return f"""{_words(notes)},
phrase0 as ({_rows(phrases, 'kind, category, phrase')}),
phrase as (select distinct kind, category, list_transform(list_filter(regexp_extract_all(trim(phrase), '{_RE}'), lambda x: x <> ' '), lambda x: lower(x)) toks
  from phrase0 where regexp_replace(phrase, '\\s+', '', 'g') <> ''),
lists as (select id, list(lower(w) order by p) ws from word group by id),
hit0 as (select w.id, kind, category, w.p p0, cast(len(toks) as int) n from word w join phrase on lower(w.w) = toks[1]
  join lists l on l.id = w.id where l.ws[w.p : w.p + len(toks) - 1] = toks),
hit as (select h.id, kind, category, a.off s, cast(b.off + length(b.w) as int) e, n,
  substr(t, a.off + 1, b.off + length(b.w) - a.off) mention, a.sent, b.sent sent2
  from hit0 h join word a on a.id = h.id and a.p = p0 join word b on b.id = h.id and b.p = p0 + n - 1 join notes on notes.id = h.id)"""


_NEGATED = """
scoped as (select *, sum(case when kind = 'termination' then 1 else 0 end) over (partition by id, sent order by s) scope from hit),
judged as (select m.*, sent = sent2
    and not exists (select 1 from scoped t where t.id = m.id and t.sent = m.sent and t.kind = 'termination' and t.s > m.s and t.s < m.e)
    and (exists (select 1 from scoped c where c.id = m.id and c.sent = m.sent and c.scope = m.scope and c.kind = 'preceding' and c.s < m.s)
      or exists (select 1 from scoped c where c.id = m.id and c.sent = m.sent and c.scope = m.scope and c.kind = 'following' and c.e > m.e))
    negated from scoped m where kind = 'mention')"""


def _resolved(src: str, dst: str, keys: str) -> str:
    """CTE ``dst``: rows of ``src`` whose span is kept, longest first."""
    same = " and ".join(f"r.{k.strip()} = k.{k.strip()}" for k in keys.split(","))
    return f"""
{dst}_d as (select distinct {keys}, s, e, n from {src}),
{dst}_f as (select {keys}, list_reduce(list([{{'s': s, 'e': e}}] order by n desc, s),
  lambda a, b: case when len(list_filter(a, lambda o: o.s < b[1].e and o.e > b[1].s)) = 0 then list_concat(a, b) else a end) kept
  from {dst}_d group by {keys}),
{dst}_k as (select {keys}, unnest(kept) x from {dst}_f),
{dst} as (select r.* from {src} r join {dst}_k k on {same} and r.s = k.x.s and r.e = k.x.e)"""


_GRADE = "case " + " ".join(
    rf"when regexp_matches(ctx, '(?i)(^|[^\p{{L}}\p{{N}}_])({sy.GRADE_WORDS[g]}|grade[ -]?{g}|ctcae[ -]?grade[ -]?{g})($|[^\p{{L}}\p{{N}}_])') then {g}"
    for g in (4, 3, 2, 1)
) + " end"


def _vocab(extra: dict | None = None) -> list[tuple[str, str, str]]:
    merged = {c: list(ps) for c, ps in sy.VOCABULARY.items()}
    for c, ps in (extra or {}).items():
        merged.setdefault(c, []).extend(ps)
    return [("mention", c, p) for c, ps in merged.items() for p in ps]


def _cues(preceding=ng.PRECEDING_CUES, following=ng.FOLLOWING_CUES) -> list[tuple[str, str, str]]:
    lists = {"preceding": preceding, "following": following, "termination": ng.TERMINATION_WORDS}
    return [(k, k, p) for k, ps in lists.items() for p in ps]


def _doc_terms(one: bool) -> list[tuple[str, str, str]]:
    return [("mention", "mention" if one else c, p) for c, ps in DOC_TERMS.items() for p in ps]


_DOCS = "select doc_id id, text t from documents"
_CHAT = "select conv_id * 100000 + turn id, text t from conversations"
_PATIENTS = duck(d.PATIENTS_SQL)
_NOTES = f"select patient_id id, clinical_note t from ({_PATIENTS})"


def _symptoms(notes: str, negation: bool = True, extra: dict | None = None) -> str:
    """CTEs up to ``found(id, category, s, e, mention, grade, negated)``."""
    cues = _cues() if negation else []
    judged = _NEGATED if negation else "\njudged as (select *, false negated from hit)"
    return f"""{_hits(notes, _vocab(extra) + cues)},{judged},{_resolved('judged', 'inner_kept', 'id, category')},{_resolved('inner_kept', 'kept', 'id')},
ctx as (select k.*, substr(t, greatest(0, s - 150) + 1, least(length(t), e + 150) - greatest(0, s - 150)) ctx from kept k join notes using (id)),
found as (select id, category, s, e, mention, {_GRADE} grade, negated from ctx)"""


def _rollup(notes: str, categories: Sequence[str], negation: bool = True, extra: dict | None = None) -> str:
    flags = ", ".join(f"coalesce(bool_or(category = '{c}'), false) has_{c}" for c in categories)
    return f"""{_symptoms(notes, negation, extra)},
rolled as (select a.id, coalesce(string_agg(distinct category, ',' order by category), '') categories_present,
  cast(count(distinct category) as int) symptom_count, max(grade) max_grade, {flags}
  from ({notes}) a left join (select * from found where not negated) f on a.id = f.id group by a.id)"""


_CATS = tuple(sy.VOCABULARY)
_FLAG_INTS = ", ".join(f"cast(has_{c} as int) has_{c}" for c in _CATS)


def _text_queries() -> dict[str, str]:
    docs_cued = f"with {_hits(_DOCS, _doc_terms(True) + _cues(DOC_CUES, ()))},{_NEGATED},{_resolved('judged', 'kept', 'id')}"
    chat_cued = f"with {_hits(_CHAT, _doc_terms(True) + _cues(CHAT_CUES, ()))},{_NEGATED},{_resolved('judged', 'kept', 'id')}"
    spans = """select doc_id id, unnest([{'s': cast(n_chars % 97 as int), 'e': cast(n_chars % 97 + 1 + n_chars % 13 as int)},
      {'s': cast(floor(n_chars * 2 / 3) as int), 'e': cast(floor(n_chars * 2 / 3) as int) + 5}], recursive := true) from documents"""
    aligned = """aligned as (select x.id, x.s, x.e, min(off) token_start, cast(max(off + length(w)) as int) token_end, cast(count(w) as int) n_tokens,
      min(sent) s1, max(sent) s2 from (select distinct * from spans) x left join word w on w.id = x.id and w.off < x.e and w.off + length(w.w) > x.s group by 1, 2, 3)"""
    return {
        "tokenize_docs": f"""with {_words(_DOCS)} select id doc_id, count(*) n_tokens, count(distinct w) n_distinct,
            cast(sum(off) as bigint) start_sum, cast(sum(off + length(w)) as bigint) end_sum from word group by id""",
        "match_terms_docs": f"with {_hits(_DOCS, _doc_terms(True))},{_resolved('hit', 'kept', 'id')} select id doc_id, s, e, mention from kept",
        "match_categories_docs": f"""with {_hits(_DOCS, _doc_terms(False))},{_resolved('hit', 'inner_kept', 'id, category')},{_resolved('inner_kept', 'kept', 'id')}
            select id doc_id, category, s, e, mention from kept""",
        "negate_docs": f"{docs_cued} select id doc_id, s, e, negated from kept",
        "custom_cues_chat": f"{chat_cued} select id msg_id, s, e, mention, negated from kept",
        "align_spans": f"""with {_words(_DOCS)}, spans as ({spans}), {aligned}
            select x.id doc_id, x.s, x.e, token_start, token_end, nullif(n_tokens, 0) n_tokens from spans x join aligned a on a.id = x.id and a.s = x.s and a.e = x.e""",
        "negate_spans": f"""with {_hits(_NOTES, _cues())},
            spans as (select id, cast(length(t) % 23 as int) s, cast(length(t) % 23 + 6 as int) e from notes), {aligned},
            events as (select id, kind, s, e, sent, sent2 from hit union all
              select id, 'mention', token_start, token_end, s1, s2 from aligned where token_start is not null),
            scoped as (select *, sum(case when kind = 'termination' then 1 else 0 end) over (partition by id, sent order by s) scope from events),
            {_NEGATED.split('),', 1)[1]}
            select a.id patient_id, a.s, a.e, token_start, token_end, coalesce(j.negated, false) negated
            from aligned a left join judged j on j.id = a.id and j.s = a.token_start and j.e = a.token_end""",
        "symptom_mentions": f"with {_symptoms(_NOTES)} select id patient_id, category, s, e, mention, grade, negated from found",
        "infer_grade": f"with {_symptoms(_NOTES, False)} select id patient_id, category, s, grade from found",
        "note_rollup": f"with {_rollup(_NOTES, _CATS)} select * exclude (id), id patient_id from rolled",
        "extend_vocabulary": f"""with {_rollup(_NOTES, [*_CATS, 'labs'], True, EXTRA_VOCABULARY)}
            select id patient_id, categories_present, symptom_count, has_fever, has_labs from rolled""",
        "batch_flags": f"with {_rollup(_NOTES, _CATS, False)} select id patient_id, symptom_count, {_FLAG_INTS} from rolled",
    }


# --------------------------------------------------------------------------
# mapping
# --------------------------------------------------------------------------

_CONCEPTS = duck(d.CONCEPTS_SQL)


def _search(queries: str, concepts: str, top_k: int) -> str:
    """CTEs ``hits`` (best 3k), ``best`` (one per concept), ``ranked``."""
    return f"""
q as ({queries}), c as ({concepts}),
pairs as (select mention_text, vector_idx, hpo_id, c.text hpo_label,
  round(list_inner_product(cast(q.embedding as double[]), cast(c.embedding as double[])), 9) score from q, c),
hits as (select * from pairs qualify row_number() over (partition by mention_text order by score desc, vector_idx) <= {3 * top_k}),
best as (select * from hits qualify row_number() over (partition by mention_text, hpo_id order by score desc, vector_idx) = 1),
ranked as (select mention_text, cast(row_number() over (partition by mention_text order by score desc, vector_idx) as int) rank, hpo_id, hpo_label,
  greatest(0, least(1, (score + 1) / 2)) confidence from best qualify rank <= {top_k})"""


def _encoded(texts: str) -> str:
    """``text`` rows to ``text, embedding``: trigram counts of 64 buckets."""
    return f"""select text, cast(list_transform(counts, lambda c: cast(c / sqrt(list_sum(list_transform(counts, lambda y: y * y))) as float)) as float[]) embedding from (
  select text, list_transform(range(0, 64), lambda b: cast(len(list_filter(grams, lambda g: g = b)) as double)) counts from (
    select text, list_transform(range(1, length(x) - 1), lambda i: ((unicode(substr(x, i, 1)) * 31 + unicode(substr(x, i + 1, 1))) * 31 + unicode(substr(x, i + 2, 1))) % 64) grams
    from (select text, concat('#', lower(text), '#') x from ({texts}))))"""


_VECTOR_MENTIONS = """select vec_id note_id, case when vec_id % 3 = 0 then 'unmapped' else concat('term ', cast(vec_id as varchar)) end text,
  vec_id % 4 = 0 negated from embeddings"""
_SELF = f"select text mention_text, embedding from ({_CONCEPTS})"


def _enriched() -> str:
    """CTEs ``kept`` (mentions of notes), ``ranked`` and ``nested`` (their candidates)."""
    concept_rows = [(c * 100 + i, f"C:{c:03d}", p) for c, ps in enumerate(sy.VOCABULARY.values()) for i, p in enumerate(ps)]
    phrases = [("mention", "mention", p) for ps in sy.VOCABULARY.values() for p in ps]
    return f"""{_hits(_NOTES, phrases + _cues())},{_NEGATED},{_resolved('judged', 'kept', 'id')},
      concept as ({_rows(concept_rows, 'vector_idx, hpo_id, text')}),
      {_search(f"select text mention_text, embedding from ({_encoded('select distinct mention as text from kept')})",
               f"select vector_idx, hpo_id, c.text, embedding from concept c join ({_encoded('select distinct text from concept')}) v on v.text = c.text", 3)},
      nested as (select mention_text, string_agg(hpo_id, ',' order by rank) ids from ranked group by mention_text)"""


def _mapping_queries() -> dict[str, str]:
    def search(k: int) -> str:
        return _search(_SELF, _CONCEPTS, k)

    enriched = f"""with {_enriched()}
      select id patient_id, s, e, mention, negated, hpo_id, hpo_label, confidence, ids candidate_ids
      from kept k join ranked r on r.mention_text = k.mention and rank = 1 join nested n on n.mention_text = k.mention"""
    return {
        "normalize_vectors": """select vec_id, cast(generate_subscripts(embedding, 1) - 1 as int) i,
            round(unnest(list_transform(embedding, lambda x: cast(cast(2 * x as float) / sqrt(list_sum(list_transform(embedding, lambda y: power(cast(2 * y as double), 2)))) as float)))::double, 5) x from embeddings""",
        "nearest": f"with {search(3)} select mention_text, vector_idx, score from hits",
        "dedupe_concepts": f"with {search(3)} select mention_text, hpo_id, hpo_label, score from best",
        "rank_candidates": f"with {search(10)} select mention_text, rank, hpo_id, hpo_label, confidence from ranked",
        "confidence_band": f"""with {search(10)} select mention_text, rank, case when confidence >= {mp.HIGH_CONFIDENCE} then 'high'
            when confidence >= {mp.MODERATE_CONFIDENCE} then 'moderate' else 'low' end band from ranked""",
        "map_mentions": f"""with {search(3)}, m as ({_VECTOR_MENTIONS}),
            nested as (select mention_text, cast(count(*) as int) n, string_agg(hpo_id, ',' order by rank) ids from ranked group by 1)
            select note_id, m.text, coalesce(hpo_id, '') hpo_id, coalesce(hpo_label, '') hpo_label, coalesce(confidence, 0.0::double) confidence, negated,
            coalesce(n, 0) n_candidates, coalesce(ids, '') candidate_ids
            from m left join ranked r on r.mention_text = m.text and rank = 1 left join nested on nested.mention_text = m.text""",
        "empty_index": f"select note_id, text, '' hpo_id, '' hpo_label, cast(0 as double) confidence from ({_VECTOR_MENTIONS})",
        "term_digest": f"""with {search(3)}, m as ({_VECTOR_MENTIONS})
            select note_id, case when negated then {_q(mp.NO_FINDINGS + ' ' + mp.DIGEST_DISCLAIMER)} else
            concat('- ', coalesce(hpo_label, ''), ' (', coalesce(hpo_id, ''), ')') end digest
            from m left join ranked r on r.mention_text = m.text and rank = 1""",
        "hashed_vectors": f"""select p_partkey, bucket, round(x::double, 5) x from (
            select p_partkey, cast(generate_subscripts(embedding, 1) - 1 as int) bucket, unnest(embedding) x
            from part join ({_encoded('select distinct p_name as text from part')}) v on v.text = p_name) where x <> 0""",
        "enrich_notes": enriched,
    }


# --------------------------------------------------------------------------
# ontology, validation
# --------------------------------------------------------------------------


def _hpo(uri: str) -> str:
    return f"regexp_replace(split_part({uri}, '/', -1), '^(.*?)HP_', '\\1HP:')"


_TREE = f"""edges as ({duck(d.EDGES_SQL)}),
tree as (select '{d.GRAPH_ROOT}' id union select {_hpo('sub')} from edges, tree where pred = 'is_a' and {_hpo('obj')} = tree.id)"""
_TERMS = f"""{_TREE}, nodes as ({duck(d.NODES_SQL)}),
terms as (select ord, {_hpo('id')} id, trim(lbl) as label, syn synonyms, coalesce(def, '') definition from nodes
  where type = 'CLASS' and trim(lbl) <> '' and {_hpo('id')} in (select id from tree)),
pairs as (select ord, id hpo_id, unnest(list_concat([label], case when synonyms = '' then [] else string_split(synonyms, '|') end)) text,
  generate_subscripts(list_concat([label], case when synonyms = '' then [] else string_split(synonyms, '|') end), 1) pos from terms)"""

_RELEASE = "http://purl.obolibrary.org/obo/hp/releases/2024-04-"


def _patient_reasons() -> str:
    checks = [
        ("patient_id", "patient_id is not null"), ("cancer_type", "cancer_type is not null"), ("treatment", "treatment is not null"),
        ("age", "age between 18 and 110"), ("sex", "sex in ('M','F')"), ("stage", "stage in ('I','II','III','IV')"),
        ("cycle_number", "cycle_number between 1 and 50"), ("ecog_score", "ecog_score between 0 and 4"),
    ]
    checks += [(c, f"{c} >= 0") for c in ("wbc", "anc", "hemoglobin", "platelets", "creatinine", "alt", "bilirubin")]
    checks += [(c, f"coalesce({c}, 0) between 0 and 10") for c in ("fatigue_score", "nausea_score", "pain_score", "dyspnea_score")]
    checks += [("clinical_note", "clinical_note is null or length(clinical_note) <= 10000")]
    return "concat_ws(',', " + ", ".join(f"case when not coalesce({ok}, false) then '{n}' end" for n, ok in checks) + ")"


def _ontology_queries() -> dict[str, str]:
    return {
        "node_ids": f"select ord, {_hpo('id')} hpo_id from ({duck(d.NODES_SQL)})",
        "release_version": f"""select n_nationkey, case n_nationkey % 3 when 0 then concat('2024-04-', lpad(cast(n_nationkey + 1 as varchar), 2, '0'))
            when 1 then concat('local-', n_name) else 'unknown' end as version from nation""",
        "subtree": f"with recursive {_TREE} select id from tree",
        "build_terms": f"with recursive {_TERMS} select id, label, synonyms, definition from terms",
        "label_synonym_pairs": f"with recursive {_TERMS} select row_number() over (order by ord, pos) - 1 vector_idx, hpo_id, text from pairs",
        "lookup_term": f"""with recursive {_TERMS} select hpo_id, label, definition from
            (select concat('HP:', lpad(cast(p_partkey as varchar), 7, '0')) hpo_id from part) left join terms on id = hpo_id""",
        "ontology_stats": f"""with recursive {_TERMS} select '2024-04-26' as version, (select count(*) from terms) term_count, (select count(*) from pairs) vector_count""",
        "validate_notes": """select doc_id, concat_ws(',', case when text is null then 'note_missing' end, case when length(text) < 1 then 'note_empty' end,
            case when length(text) > 10000 then 'note_too_long' end) reasons from documents""",
        "validate_patients": f"select patient_id, {_patient_reasons()} reasons from ({_PATIENTS})",
        "terms_round_trip": f"with recursive {_TERMS} select id, label, synonyms, definition, '2024-04-26' as release, (select count(*) from terms) term_count from terms",
        "vectors_round_trip": f"select vector_idx, hpo_id, text, cast(i - 1 as int) pos, embedding[i] as element from ({_CONCEPTS}), unnest(range(1, len(embedding) + 1)) t(i)",
        "patients_round_trip": f"select *, anc csv_anc, age csv_age from ({_PATIENTS})",
        "read_ontology": f"""select 'node' what, id, type kind, lbl as name, syn synonyms, def definition from ({duck(d.NODES_SQL)})
            union all select 'edge', sub, pred, obj, null, null from ({duck(d.EDGES_SQL)})""",
        "read_cues": """select case when p_partkey % 2 = 0 then 'preceding' else 'following' end kind, concat(p_name, ' ', p_partkey) phrase from part
            where p_partkey % 2 = 0 or (p_partkey // 500) % 3 <> 0""",
        "read_gold": f"""select concat('note ', vector_idx // 10) note, text, hpo_id, vector_idx % 3 = 0 negated from ({_CONCEPTS}) where vector_idx % 70 >= 10
            union all select distinct concat('note ', vector_idx // 10), null, null, null::boolean from ({_CONCEPTS}) where vector_idx % 70 < 10""",
        "read_notes": f"select clinical_note || chr(10) as text, true named from ({_PATIENTS}) where clinical_note is not null",
    }


# --------------------------------------------------------------------------
# features, scoring
# --------------------------------------------------------------------------


def _prepared(rolled: str | None) -> str:
    """Feature rows; ``rolled`` names the roll-up, or there are no flags."""
    stage = "case stage when 'I' then 1 when 'II' then 2 when 'III' then 3 when 'IV' then 4 else 2 end"
    numeric = ", ".join(
        f"cast(coalesce({'symptom_count' if rolled else '0'}, 0) as double) symptom_count" if c == "symptom_count"
        else f"cast({stage} as double) stage_ordinal" if c == "stage_ordinal" else f"cast(coalesce(p.{c}, 0) as double) {c}"
        for c in ft.NUMERIC
    )
    flags = ", ".join(f"{f'cast(coalesce({c}, false) as int)' if rolled else '0'} {c}" for c in ft.NOTE_FLAGS)
    join = f"left join {rolled} r on r.id = p.patient_id" if rolled else ""
    return f"""select patient_id, {numeric}, {flags}, case when sex = 'M' then 1 else 0 end sex_binary,
      coalesce(cancer_type, '0') cancer_type, coalesce(treatment, '0') treatment from ({_PATIENTS}) p {join}"""


def _scaled(c: str) -> str:
    return f"({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1)"


_CANCERS = ("breast", "colorectal", "lung_nsclc", "melanoma", "ovarian")
_TREATMENTS = ("FOLFOX", "carboplatin_paclitaxel", "docetaxel", "imatinib", "olaparib", "pembrolizumab")

_SPLIT = f"""select patient_id, adverse_event, row_number() over (partition by adverse_event order by md5(concat('42|', patient_id)), patient_id) r,
  count(*) over (partition by adverse_event) n from ({_PATIENTS})"""

_RISK = """least(0.99::double, 0.30::double + case coalesce(stage, 'II') when 'IV' then 0.12::double when 'III' then 0.06::double else 0 end + coalesce(ecog_score, 1) * 0.05::double
  + case when coalesce(age, 60) > 70 then 0.05::double else 0 end + case when coalesce(anc, 2) < 1 then 0.10::double else 0 end
  + case when coalesce(hemoglobin, 12) < 10 then 0.07::double else 0 end + symptom_count * 0.02::double
  + case when has_fever then 0.08::double else 0 end + case when has_infection then 0.10::double else 0 end)"""
_TIER = "case when raw >= 0.60::double then 'high' when raw >= 0.35::double then 'medium' else 'low' end"
_LABS = "concat_ws(', ', " + ", ".join(
    f"case when {lab} {'<' if side == 'below' else '>'} {limit} then concat('{lab} ', cast({lab} as varchar), ' ({side} threshold {limit})') end"
    for lab, side, limit in sc.LAB_LIMITS
) + ")"


def _scored(patients: str, notes: str) -> str:
    return f"""{_rollup(notes, _CATS)},
      scored as (select *, {_TIER} risk_tier, round_even(raw, 4) risk_probability from (
        select p.*, r.* exclude (id), {_RISK} raw from ({patients}) p join rolled r on r.id = p.patient_id))"""


_STEP = "case risk_tier " + " ".join(f"when '{k}' then {_q(v)}" for k, v in sc.NEXT_STEPS.items()) + " end"
_SUMMARY = f"""concat_ws(chr(10),
  concat('Patient ', patient_id, ': ', age, '-year-old ', case when sex = 'M' then 'male' else 'female' end, ' with ',
    upper(replace(cancer_type, '_', ' ')), ', currently on ', replace(treatment, '_', '/'), '.'),
  concat('Extracted symptoms: ', case when categories_present = '' then 'none documented' else replace(categories_present, ',', ', ') end, '.'),
  concat('Laboratory findings: ', case when {_LABS} = '' then 'within normal limits' else {_LABS} end, '.'),
  concat('Estimated adverse event risk: ', cast(round_even(risk_probability * 100, 0) as int), '% (', upper(risk_tier), ' tier, model: heuristic).'),
  concat('Recommended next step: ', {_STEP}))"""
_OVERRIDDEN = f"""select * replace (case when substr(patient_id, -1, 1) in ('0','4','8') then concat('No pain. Severe rash on arm ', age) else clinical_note end as clinical_note) from ({_PATIENTS})"""


def _feature_queries() -> dict[str, str]:
    scored = f"with {_scored(_PATIENTS, _NOTES)}"
    feature_sum = " + ".join(
        [_scaled(c) for c in ft.NUMERIC]
        + [f"case when cancer_type = '{v}' then 1 else 0 end" for v in _CANCERS[1:]]
        + [f"case when treatment = '{v}' then 1 else 0 end" for v in _TREATMENTS[1:]]
        + ["sex_binary"]
    )
    hot = [("cancer_type", v) for v in _CANCERS[1:]] + [("treatment", v) for v in _TREATMENTS[1:] if v != "imatinib"]
    n_features = len(ft.NUMERIC) + len(_CANCERS) - 1 + len(_TREATMENTS) - 1 + len(ft.NOTE_FLAGS) + 1
    valid = f"select * from ({_PATIENTS}) where {_patient_reasons()} = ''"
    return {
        "features": f"with {_rollup(_NOTES, _CATS)} {_prepared('rolled')}",
        "scale_numeric": f"select patient_id, {', '.join(f'round({_scaled(c)}, 6) {c}' for c in ft.NUMERIC)} from ({_prepared(None)})",
        "one_hot": f"select patient_id, {', '.join(f'''cast({c} = '{v}' as int) {c}_{v}''' for c, v in hot)} from ({_prepared(None)})",
        "assemble": f"select patient_id, {n_features} n_features, round({feature_sum}, 5) feature_sum from ({_prepared(None)})",
        "class_weights": f"""select n_pos, n_neg, (n_pos + n_neg) / (2.0::double * n_pos) weight_pos, (n_pos + n_neg) / (2.0::double * n_neg) weight_neg,
            greatest(1.0::double, n_neg / greatest(1, n_pos)) tree_weight_pos from
            (select count(*) filter (adverse_event) n_pos, count(*) filter (not adverse_event) n_neg from ({_PATIENTS}))""",
        "stratified_split": f"select patient_id, case when r <= round(n * 0.20::double) then 'test' else 'train' end split from ({_SPLIT})",
        "stratified_folds": f"select patient_id, cast((r - 1) % 5 as int) fold from ({_SPLIT})",
        "split_flags": f"""with {_rollup(_NOTES, _CATS, False)} select id patient_id, symptom_count from rolled
            where id in (select patient_id from ({_SPLIT}) where r <= round(n * 0.20::double))""",
        "logistic_gradient": "select unnest([" + ", ".join(map(_q, [
            *ft.NUMERIC, *(f"cancer_type={c}" for c in _CANCERS[1:]), *(f"treatment={t}" for t in _TREATMENTS[1:]), *ft.NOTE_FLAGS, *ft.DEMOGRAPHIC,
            "intercept",
        ])) + "]) feature, true flat",
        "boosted_losses": f"select cast(f.range as int) fold, cast(r.range as int) round, true falls from range({md.CALIBRATION_FOLDS}) f, range(1, {md.TREES} + 1) r",
        "isotonic_folds": f"""select cast((r - 1 - round(n * 0.20::double)) % {md.CALIBRATION_FOLDS} as int) fold, count(*) n,
            cast(count(*) filter (adverse_event) as bigint) events, cast(count(*) filter (adverse_event) as double) expected_events, true rising
            from ({_SPLIT}) where r > round(n * 0.20::double) group by 1""",
        "models_survive_storage": f"select patient_id, true same from ({_SPLIT}) where r <= round(n * 0.20::double)",
        "model_tiers": f"select patient_id, '{md.LOGISTIC}' model_used, true is_share, true tier_fits from ({_PATIENTS})",
        "heuristic_risk": f"{scored} select patient_id, risk_probability, risk_tier, 'heuristic' model_used from scored",
        "abnormal_labs": f"select patient_id, {_LABS} labs from ({_PATIENTS})",
        "summarize_risk": f"""{scored} select patient_id, categories_present, symptom_count, max_grade, risk_probability, risk_tier,
            'heuristic' model_used, {_SUMMARY} summary, {_q(sc.SUMMARY_DISCLAIMER)} disclaimer from scored""",
        "risk_summary": f"""with {_scored(_OVERRIDDEN, f'select patient_id id, clinical_note t from ({_OVERRIDDEN})')}
            select patient_id, {_SUMMARY} summary from scored""",
        "stream_risk_patients": f"""with {_scored(valid, f'select patient_id id, clinical_note t from ({valid})')}
            select patient_id, risk_probability, risk_tier, {_SUMMARY} summary, null reasons from scored
            union all select patient_id, null, null, null, {_patient_reasons()} from ({_PATIENTS}) where {_patient_reasons()} <> ''""",
    }


# --------------------------------------------------------------------------
# evaluation
# --------------------------------------------------------------------------


def _ranking(rows: str, keys: str) -> str:
    """Metrics by comparing prefix counts of distinct scores."""
    part = f"partition by {keys}"
    return f"""select {keys}, sum(pos + neg) n, sum(pos) n_pos,
      sum(pos * (neg_below + neg / 2.0::double)) / (sum(pos)::double * sum(neg)) auroc,
      sum(pos * (pos_above / (pos_above + neg_above)::double)) / sum(pos)::double auprc,
      sum(pos * power(p - 1, 2) + neg * power(p, 2)) / sum(pos + neg) brier from (
        select *, coalesce(sum(neg) over ({part} order by p rows between unbounded preceding and 1 preceding), 0) neg_below,
          sum(pos) over ({part} order by p desc) pos_above, sum(neg) over ({part} order by p desc) neg_above
        from (select {keys}, p, sum(y)::bigint pos, sum(1 - y)::bigint neg from ({rows}) group by {keys}, p)) group by {keys}"""


_SCORES = duck(d.SCORES_SQL)
_BAND = "case when age <= 50 then '<50' when age <= 65 then '50-65' when age <= 75 then '65-75' else '>75' end"


def _thresholds(rows: str) -> str:
    values = ", ".join(f"({t}::double)" for t in ev.THRESHOLDS)
    return f"""select threshold, round_even(pr, 4) as precision, round_even(re, 4) as recall, round_even(2 * pr * re / greatest(pr + re, 1e-9), 4) f1,
      round_even(tn / greatest(tn + fp, 1)::double, 4) specificity, tp + fp n_alerted, tp true_positives, fp false_positives, fn false_negatives from (
      select *, tp / greatest(tp + fp, 1)::double pr, tp / greatest(tp + fn, 1)::double re from (
        select threshold, count(*) filter (p >= threshold and y = 1) tp, count(*) filter (p >= threshold and y = 0) fp,
          count(*) filter (p < threshold and y = 1) fn, count(*) filter (p < threshold and y = 0) tn
        from ({rows}), (values {values}) v(threshold) group by threshold))"""


def _evaluation_queries() -> dict[str, str]:
    one = f"select 1 g, y, p from ({_SCORES})"
    grouped = f"""with {_scored(_PATIENTS, _NOTES)},
      rows as (select sex, cancer_type, stage, {_BAND} age_group, cast(adverse_event as int) y, risk_probability p from scored)"""

    def long(dims: Sequence[str]) -> str:
        return " union all ".join(f"select '{x}' dimension, {x} as \"group\", y, p from rows" for x in dims)

    def metrics(dims: Sequence[str]) -> str:
        return f"select * from ({_ranking(long(dims), 'dimension, \"group\"')}) where n >= 10 and n_pos >= 2 and n_pos < n"

    def cells(source: str, section: str, item: str, names: Sequence[str]) -> str:
        return " union all ".join(
            f"select '{section}' section, {item} item, '{m}' metric, cast(\"{m}\" as double) as value from {source}" for m in names
        )

    at = "printf('%.2f', threshold)"
    alerts = ["precision", "recall", "f1", "specificity", "n_alerted", "true_positives", "false_positives", "false_negatives"]
    shown = ", ".join(f"{t}::double" for t in ev.SHOWN_THRESHOLDS)
    overall = ["auroc", "auprc", "brier"]
    report = " union all ".join(
        [
            cells(f"(select {', '.join(f'round_even({m}, 4) {m}' for m in overall)} from ({_ranking('select 1 g, y, p from rows', 'g')}))", "metrics", "'all'", overall),
            cells("(select * from t order by f1 desc, threshold limit 1)", "best_threshold", at, alerts[:3]),
            cells("t", "threshold_analysis", at, alerts),
            cells(f"(select * from t where threshold in ({shown}))", "threshold_display", at, [*alerts[:3], "n_alerted", "true_positives", "false_positives"]),
            cells(
                f"(select *, round_even(n_pos / n::double, 4) ae_rate from (select dimension, \"group\", n, n_pos, "
                f"{', '.join(f'round_even({m}, 4) {m}' for m in overall)} from ({metrics(ev.TABLE_DIMENSIONS)})))",
                "subgroup_analysis", "concat(dimension, '=', \"group\")", ["n", "n_pos", "ae_rate", *overall],
            ),
        ]
    )
    gold = f"""cases as ({duck(d.CASES_SQL)}), expected as ({duck(d.EXPECTED_SQL)}), predicted as ({duck(d.PREDICTED_SQL)}),
      pe as (select distinct case_id, lower(text) text from expected where case_id in (select case_id from cases where status = 'ok')),
      pp as (select distinct case_id, lower(text) text from predicted where case_id in (select case_id from cases where status = 'ok')),
      prf0 as (select (select count(*) from pe join pp using (case_id, text)) tp, (select count(*) from pp) np,
        (select count(*) from pe) + (select count(*) from expected where case_id in (select case_id from cases where status <> 'ok')) ne),
      prf as (select tp true_positives, np predicted, ne expected, tp / np::double a, tp / ne::double b from prf0),
      {_search('select text mention_text, embedding from predicted', _CONCEPTS, 3)},
      topk as (select count(*) mapping_total, count(*) filter (exists (select 1 from ranked r where r.mention_text = p.text and r.rank = 1 and r.hpo_id = e.hpo_id)) top1_correct,
        count(*) filter (exists (select 1 from ranked r where r.mention_text = p.text and r.rank <= 3 and r.hpo_id = e.hpo_id)) top3_correct
        from expected e join predicted p on p.case_id = e.case_id and lower(p.text) = lower(e.text)),
      neg as (select count(*) negation_total, count(*) filter (not p.negated) negation_false_positives
        from expected e left join predicted p on p.case_id = e.case_id and lower(p.text) = lower(e.text)
        where e.negated and e.case_id in (select case_id from cases where status = 'ok'))"""
    ids = " ".join(f"when {_q(name)} then 'C:{c:03d}'" for c, name in enumerate(sy.VOCABULARY))
    of_notes = f"""{_enriched()},
      cases as (select id case_id, case when t is null then 'failed' else 'ok' end status from ({_NOTES})),
      expected as (select case_id, text, case category {ids} end hpo_id, negated from ({duck(d.NOTE_GOLD_SQL)})),
      predicted as (select id case_id, lower(mention) text, arg_max(mention, s) surface, arg_min(negated, s) negated from kept
        where id in (select case_id from cases where status = 'ok') group by all),
      pe as (select distinct case_id, lower(text) text from expected where case_id in (select case_id from cases where status = 'ok')),
      prf0 as (select (select count(*) from pe join predicted using (case_id, text)) tp, (select count(*) from predicted) np,
        (select count(*) from pe) + (select count(*) from expected where case_id in (select case_id from cases where status <> 'ok')) ne),
      prf as (select tp true_positives, np predicted, ne expected, tp / np::double a, tp / ne::double b from prf0),
      topk as (select count(*) mapping_total, count(*) filter (exists (select 1 from ranked r where r.mention_text = p.surface and r.rank = 1 and r.hpo_id = e.hpo_id)) top1_correct,
        count(*) filter (exists (select 1 from ranked r where r.mention_text = p.surface and r.rank <= 3 and r.hpo_id = e.hpo_id)) top3_correct
        from expected e join predicted p on p.case_id = e.case_id and p.text = lower(e.text)),
      neg as (select count(*) negation_total, count(*) filter (not p.negated) negation_false_positives
        from expected e left join predicted p on p.case_id = e.case_id and p.text = lower(e.text)
        where e.negated and e.case_id in (select case_id from cases where status = 'ok'))"""
    top1 = "round_even(top1_correct / mapping_total::double, 4)"
    prf = "round_even(a, 4) extraction_precision, round_even(b, 4) extraction_recall, round_even(2 * a * b / (a + b), 4) extraction_f1"
    profile = f"""with p as ({_PATIENTS}), t as (select count(*) n from p)
      select 'cohort' section, 'patients' item, n, 1::double share from t
      union all select 'cohort', 'adverse_event', count(*) filter (adverse_event), round_even(count(*) filter (adverse_event) / count(*)::double, 9) from p
      union all select 'ae_type', ae_type, count(*), round_even(count(*) / (select n from t)::double, 9) from p where ae_type is not null group by ae_type
      union all select 'cancer_type', cancer_type, count(*), round_even(count(*) / (select n from t)::double, 9) from p group by cancer_type"""
    return {
        "auroc": f"select round_even(auroc, 9) auroc from ({_ranking(one, 'g')})",
        "auprc": f"select round_even(auprc, 9) auprc from ({_ranking(one, 'g')})",
        "brier": f"select round_even(avg(power(p - toxic, 2)), 9) brier from ({_SCORES})",
        "calibration_curve": f"""select cast(least(greatest(ceil(p * 10) - 1, 0), 9) as int) bin, round_even(avg(y), 9) fraction_positive,
            round_even(avg(p), 9) mean_predicted, count(*) n from ({_SCORES}) group by 1""",
        "threshold_table": _thresholds(_SCORES),
        "best_threshold": f"""select threshold, "precision", recall, f1 from ({_thresholds(f'select toxic y, p from ({_SCORES})')}) order by f1 desc, threshold limit 1""",
        "report_round_trip": f"select * from ({_thresholds(_SCORES)}) union all select * from ({_thresholds(_SCORES)})",
        "age_groups": f"select {_BAND} age_group, count(*) n, min(age) youngest, max(age) oldest from ({_PATIENTS}) group by 1",
        "subgroup_auroc": f"""{grouped} select dimension, "group", round_even(auroc, 4) auroc from ({metrics(ev.AUROC_DIMENSIONS)})""",
        "subgroup_table": f"""{grouped} select dimension, "group", cast(n as bigint) n, cast(n_pos as bigint) n_pos, round_even(n_pos / n::double, 4) ae_rate,
            round_even(auroc, 4) auroc, round_even(auprc, 4) auprc, round_even(brier, 4) brier from ({metrics(ev.TABLE_DIMENSIONS)})""",
        "model_report": f"""{grouped}, t as ({_thresholds('select y, p from rows')})
            select 'heuristic' model, section, item, metric, value from ({report})""",
        "cohort_profile": profile,
        "extraction_prf": f"with {of_notes} select true_positives, predicted, expected, {prf} from prf",
        "mapping_topk": f"with {of_notes} select mapping_total, top1_correct, top3_correct, {top1} top1_accuracy, round_even(top3_correct / mapping_total::double, 4) top3_accuracy from topk",
        "negation_fp": f"with {of_notes} select negation_total, negation_false_positives, round_even(negation_false_positives / negation_total::double, 4) negation_fp_rate from neg",
        "failed_cases": f"with {of_notes} select status, count(*) expected_mentions, count(distinct case_id) cases from expected join cases using (case_id) group by status",
        "evaluate_extraction": f"""with {of_notes} select {prf}, {top1} top1_accuracy, round_even(top3_correct / mapping_total::double, 4) top3_accuracy,
            round_even(negation_false_positives / negation_total::double, 4) negation_fp_rate, (select count(*) from cases) total_cases from prf, topk, neg""",
        "regression_gate": f"with {of_notes} select 'top1_accuracy' metric, {top1} as value, 0.7::double threshold, {top1} >= 0.7 passed from topk",
        "evaluate_vectors": f"""with {gold} select {prf}, {top1} top1_accuracy, round_even(top3_correct / mapping_total::double, 4) top3_accuracy,
            round_even(negation_false_positives / negation_total::double, 4) negation_fp_rate, (select count(*) from cases) total_cases from prf, topk, neg""",
    }


def oracle_sql() -> dict[str, str]:
    out = {**_text_queries(), **_mapping_queries(), **_ontology_queries(), **_feature_queries(), **_evaluation_queries()}
    out["stream_concepts_notes"] = out["symptom_mentions"]
    out["stream_phenotypes_notes"] = out["enrich_notes"]
    return out
