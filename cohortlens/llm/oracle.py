"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from cohortlens.llm.licenses import PERCENT, SHINGLE, TEMPLATES
from cohortlens.llm.quality import BINS, CONSISTENCY, CUTOFF, DIMENSIONS, FLOORS, MIN_CELL, SHARE, STEPS
from cohortlens.llm.queries import MIX, URL_RULES
from cohortlens.llm.revisits import TRACKING
from cohortlens.llm.url_templates import DIFFERENT, LABELLED, PRIOR, REJECT

#: levels that the twin of op10 unrolls, beyond which it takes shapes as they are; the given tables have two
DEPTH = 8

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quality() -> str:
    dims = range(DIMENSIONS)
    pairs = [(i, j) for i in dims for j in range(i + 1)]
    comma = ", ".join

    def distance(no: int) -> str:
        """Rows with their squared distance to the estimates e{no}, one substitution per step."""
        steps, source = [], f"(select v.*, e.* exclude (cell) from vectors v join e{no} e using (cell))"
        for i in dims:
            rest = f"x{i} - m{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(i))
            source = f"(select *, ({rest}) / l{i}{i} y{i} from {source})"
        return f"(select *, {' + '.join(['0.0::double', *(f'y{i} * y{i}' for i in dims)])} d2 from {source})"

    def step(no: int) -> str:
        sums = comma([f"sum(x{i}) t{i}" for i in dims] + [f"sum(x{i} * x{j}) q{i}{j}" for i, j in pairs])
        names = ["n"] + [f"t{i}" for i in dims] + [f"q{i}{j}" for i, j in pairs]
        source = f"(select cell, {comma(f'sum({c})::double {c}' for c in names)} from near{no} group by cell)"
        cov = comma(
            f"{CONSISTENCY}::double * (q{i}{j} / n - (t{i} / n) * (t{j} / n)) + {FLOORS[i] ** 2 if i == j else 0} c{i}{j}" for i, j in pairs
        )
        source = f"(select cell, {comma(f't{i} / n m{i}' for i in dims)}, {cov} from {source})"
        for i, j in pairs:
            rest = f"c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            source = f"(select *, {f'sqrt({rest})' if i == j else f'({rest}) / l{j}{j}'} l{i}{j} from {source})"
        return f"""
        binned{no} as materialized (select cell, floor(least(sqrt(d2), 10000) * {BINS})::int bin, count(*) n, {sums} from {distance(no)} group by all),
        near{no} as materialized (from (select *, coalesce(sum(n) over (partition by cell order by bin rows between unbounded preceding and 1 preceding), 0) ahead,
            sum(n) over (partition by cell) total from binned{no}) where ahead < ceil({SHARE}::double * total)),
        e{no + 1} as materialized (select cell, {comma(f'm{i}' for i in dims)}, {comma(f'l{i}{j}' for i, j in pairs)} from {source})"""

    middle = lambda frame, value: f"""select cell, dim, min({value}) middle from (select cell, dim, {value}, sum(n) over (partition by cell, dim order by {value}) up_to,
        sum(n) over (partition by cell, dim) total from (select cell, dim, {value}, sum(n) n from {frame} group by all)) where 2 * up_to >= total group by cell, dim"""  # noqa: E731
    diagonal = comma(f"max(case when dim = {i} then s end) l{i}{j}" if i == j else f"0.0::double l{i}{j}" for i, j in pairs)
    return rf"""with words as (select doc_id, lang, source, coalesce(text, '') body, {_WORDS} w from documents),
        single as (select doc_id, unnest(w) word, generate_subscripts(w, 1) i from words),
        triples as (select doc_id, i, count(*) over (partition by doc_id, s) c from (select doc_id, i, word || ' ' || lead(word) over d || ' ' || lead(word, 2) over d s
            from single window d as (partition by doc_id order by i)) where s is not null),
        again as (select doc_id, count(distinct i + k) n_repeat_words from triples, range(3) r(k) where c > 1 group by doc_id),
        lines as (select doc_id, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) l from words),
        stats as materialized (select doc_id, lang, source, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
            (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::bigint n_symbols, len(l)::bigint n_lines,
            (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(n_repeat_words, 0)::bigint n_repeat_words
            from words join lines using (doc_id) left join again using (doc_id)),
        judged as materialized (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from stats),
        own as (select lang, source, count(*) n from judged where not base_failed group by all),
        pooled as (select lang, sum(n) of_lang from own where n < {MIN_CELL} group by lang),
        cells as (select o.lang, o.source, case when n >= {MIN_CELL} then struct_pack(l := o.lang, s := o.source, v := 0)
            when of_lang >= {MIN_CELL} then struct_pack(l := o.lang, s := null, v := 1) else struct_pack(l := null, s := null, v := 2) end cell
            from own o left join pooled p on o.lang is not distinct from p.lang),
        vectors as materialized (select j.*, cell, round(1000 * ln(word_chars / n_words))::bigint x0, round(1000 * sqrt(n_symbols / n_words))::bigint x1,
            round(1000 * asin(sqrt(n_dup_lines / n_lines)))::bigint x2, round(1000 * asin(sqrt(n_repeat_words / n_words)))::bigint x3
            from judged j join cells c on j.lang is not distinct from c.lang and j.source is not distinct from c.source where not base_failed),
        long as (select cell, dim, value, count(*) n from (select cell, unnest(range({DIMENSIONS})) dim, unnest([{comma(f'x{i}' for i in dims)}]) as value from vectors) group by all),
        med as materialized ({middle('long', 'value')}),
        away as (select cell, dim, abs(value - middle) away, n from long join med using (cell, dim)),
        mad as materialized ({middle('away', 'away')}),
        spread as (select cell, dim, med.middle::double m, greatest(1.4826::double * mad.middle, ([{comma(map(str, FLOORS))}])[dim + 1])::double s from med join mad using (cell, dim)),
        e0 as materialized (select cell, {comma(f'max(case when dim = {i} then m end) m{i}' for i in dims)}, {diagonal} from spread group by cell),
        {comma(step(no) for no in range(STEPS))}
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, d2 <= {CUTOFF} kept from {distance(STEPS)}
        union all select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, true, false from judged where base_failed"""


def _revisits() -> str:
    host = _LOWER.format(r"regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)")
    day = "concat('day ', page_id % 7)"
    records = f"""
        select page_id * 5 record_id, url, page_id * 1000 as tm, true as isfull, md5(html) etag, {day} modified, md5(html) digest, strlen(html) len from pages
        union all select page_id * 5 + 1, regexp_replace(url, '^http:', 'https:'), page_id * 1000 + 500, false, md5(html), null, null, null from pages
        union all select page_id * 5 + 2, url || '#top', page_id * 1000 + 700, false, 'stale', {day}, null, null from pages
        union all select page_id * 5 + 3, url, page_id * 1000 - 1, false, null, {day}, null, null from pages
        union all select page_id * 5 + 4, 'http://' || {host} || '/', page_id * 1000 + 250, page_id % 50 = 0, concat('v', (page_id // 50) % 4), null,
            case when page_id % 50 = 0 then md5(html) end, case when page_id % 50 = 0 then strlen(html) end from pages"""
    bare = "regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    site = rf"regexp_replace(regexp_replace({_LOWER.format("regexp_extract(bare, '^([^/?]*)', 1)")}, '^www\.', ''), ':(80|443)$', '')"
    path = "regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')"
    asked = rf"""list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'),
        lambda p: p <> '' and not regexp_matches(p, '{TRACKING}')))"""
    return f"""with records as ({records}),
        bared as (select *, {bare} bare from records),
        named as (select * exclude (url, bare), {site} || {path} || case when len({asked}) > 0 then '?' || array_to_string({asked}, '&') else '' end url
            from bared),
        found as (select *, last_value(case when isfull then record_id end ignore nulls) over (partition by url
            order by tm, isfull, record_id rows between unbounded preceding and 1 preceding) response_id from named),
        joined as (select r.record_id, r.url, r.tm, r.response_id, b.record_id base_id, b.digest, b.len, b.tm base_at,
            coalesce(r.etag = b.etag, r.modified = b.modified, r.digest = b.digest) agrees, b.record_id % 5 = 0 page
            from found r left join named b on r.response_id = b.record_id and b.isfull where not r.isfull),
        told as (select *, case when base_id is null then 'no response' when agrees is null then 'unverified' when agrees then 'resolved'
            else 'mismatch' end outcome from joined)
        select record_id, url, outcome, response_id,
            case when outcome = 'resolved' then concat('cache-control=no-cache;content-type=text/html;date=', tm, case when page then ';server=a' else '' end) end headers,
            case when outcome = 'resolved' then digest end digest, case when outcome = 'resolved' then len end as length from told"""


def _near_duplicates() -> str:
    return rf"""with recursive words as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') w from documents),
        single as (select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else array_to_string(w[i:i + 2], ' ') end s
            from words, unnest(range(1, greatest(len(w) - 1, 2))) t(i) where len(w) > 0),
        sizes as (select doc_id, count(*) n from single group by doc_id),
        common as (select a.doc_id u, b.doc_id v, count(*) c from single a join single b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
        links as (select u, v from common join sizes x on u = x.doc_id join sizes y on v = y.doc_id where 100 * c >= 85 * (x.n + y.n - c)),
        reach as (select doc_id, doc_id least from documents union select u, least from reach join links on doc_id = v)
        select doc_id, coalesce(n, 0) n_shingles, min(least) component_id, doc_id = min(least) kept
            from reach left join sizes using (doc_id) group by doc_id, n"""


def _drop_repeats() -> str:
    return rf"""with words as (select doc_id, {_WORDS} w from documents),
        windows as (select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) s from words, unnest(range(1, len(w) - 18)) t(i)),
        late as (select doc_id, i from windows qualify row_number() over (partition by s order by doc_id, i) > 1),
        gone as (select distinct doc_id, i + k p from late, range(20) r(k)),
        lists as (select doc_id, list(p) p from gone group by doc_id)
        select doc_id, len(w)::bigint n_words, coalesce(len(p), 0)::bigint n_removed,
            sha256(coalesce(array_to_string(case when p is null then w else list_transform(list_filter(range(1, len(w) + 1), lambda j: not list_contains(p, j)), lambda j: w[j]) end, ' '), ''))
            kept_sha256 from words left join lists using (doc_id)"""


def _mixing() -> str:
    domain = MIX["domain"].replace("source rlike '", "regexp_matches(source, '").replace("$' then", "$') then")
    weight = lambda name: "(case " + " ".join(f"when {name} = '{k}' then {w}" for k, w in MIX["weights"].get(name, {"": 1}).items()) + " else 1 end)::double"

    def level(no: int, name: str, parent: list[str]) -> str:
        keys = ", ".join([*parent, name])
        by = f"partition by {', '.join(parent) or '0'}"
        join = f"join given{no - 1} using ({', '.join(parent)})" if parent else "cross join given0"
        return f"""
        caps{no} as (select {keys}, sum(cap) cap, {weight(name)} weight from leaves group by all),
        ranked{no} as (select c.*, budget, row_number() over (w) rank,
            (budget - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0)) / sum(weight) over (w rows between current row and unbounded following) lvl
            from caps{no} c {join} window w as ({by} order by cap / weight, {name})),
        first{no} as (select *, min(case when cap > lvl * weight then rank end) over ({by}) first from ranked{no}),
        given{no} as (select {keys}, case when first is not null and rank >= first
            then max(case when rank = first then lvl end) over ({by}) * weight else cap end budget from first{no})"""

    return f"""with rows as (select doc_id, {domain} as domain, coalesce(lang, '') lang, coalesce(source, '') source, len({_WORDS})::bigint n_tokens, md5(coalesce(text, '')) text_md5 from documents),
        held as (from rows where n_tokens > 0),
        leaves as (select domain, lang, source, sum(n_tokens)::bigint tokens, (sum(n_tokens) * {MIX['epochs']})::double cap from held group by all),
        given0 as (select least(floor(sum(tokens) * {MIX['share']}::double)::double, sum(cap)) budget from leaves),
        {level(1, 'domain', [])}, {level(2, 'lang', ['domain'])}, {level(3, 'source', ['domain', 'lang'])},
        quota as (select domain, lang, source, floor(budget)::bigint // tokens whole, floor(budget)::bigint % tokens rest from given3 join leaves using (domain, lang, source)),
        placed as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source order by md5(concat_ws(':', '8', whole, doc_id, text_md5))
            rows between unbounded preceding and 1 preceding), 0) before from held join quota using (domain, lang, source))
        select doc_id, domain, lang, source, n_tokens, e::int epoch from placed, unnest(range(whole)) t(e)
        union all select doc_id, domain, lang, source, n_tokens, whole::int from placed where before < rest"""


def _licenses() -> str:
    sought = ", ".join(f"('{name}', '{notice}')" for name, notice in TEMPLATES.items())
    words = lambda c: rf"list_filter(string_split(regexp_replace({_LOWER.format(c)}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    return f"""with sought as (select license, {words('notice')} w from (values {sought}) t(license, notice)),
        wanted as (select distinct license, len(w) l, array_to_string(w[i:i + {SHINGLE - 1}], ' ') s from sought, unnest(range(1, len(w) - {SHINGLE - 2})) t(i)),
        sizes as (select license, count(*) n from wanted group by license),
        docs as (select doc_id, {words("coalesce(text, '')")} w from documents),
        single as (select doc_id, i - 1 p, array_to_string(w[i:i + {SHINGLE - 1}], ' ') s from docs, unnest(range(1, len(w) - {SHINGLE - 2})) t(i)),
        hits as (select doc_id, license, l, p, s, p // (l + 1) - back j from single join wanted using (s), (values (0), (1)) b(back)),
        held as (select doc_id, license, j * (l + 1) first_word, count(distinct s) c from hits where j >= 0 and p - j * (l + 1) < 2 * l - {SHINGLE - 1} group by all)
        select doc_id, license, count(*) n_windows, min(first_word) first_word, max(100 * c // n) as percent
            from held join sizes using (license) where 100 * c >= {PERCENT} * n group by doc_id, license"""


def _url_templates() -> str:
    rule, verdict = "null", "null"
    for what, host, path in sorted(URL_RULES, key=lambda r: len(r[1] + r[2])):
        fits = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
        rule, verdict = f"case when {fits} then '{host}{path}' else {rule} end", f"case when {fits} then '{what}' else {verdict} end"

    def level(no: int) -> str:
        return f"""
        child{no} as (select host, template, shape[{no + 1}] segment, sum(n) n, sum(labelled) l, sum(bad) b from t{no} where len(shape) > {no} group by all),
        both{no} as (select *, count(*) over p children, sum(n) over p total, sum(l) over p all_l, sum(b) over p all_b, all_l - l rest,
            all_b::double / nullif(all_l, 0) pooled from child{no} window p as (partition by host, template)),
        as{no} as materialized (select host, template, segment, case when (children = 1 and not contains(segment, '#')) or coalesce(l >= {LABELLED} and rest >= {LABELLED}
            and abs(b::double / nullif(l, 0) - (all_b - b)::double / nullif(rest, 0)) > {DIFFERENT} * sqrt(pooled * (1 - pooled) * (1.0::double / nullif(l, 0) + 1.0::double / nullif(rest, 0))), false)
            then segment else '*' end name from both{no}),
        t{no + 1} as materialized (select t.host, shape, n, labelled, bad, case when name is null then t.template else list_append(t.template, name) end template
            from t{no} t left join as{no} a on t.host = a.host and t.template = a.template and a.segment = shape[{no + 1}])"""

    rest = "case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end"
    return f"""with cut as (select page_id, coalesce({rest}, '') rest from pages),
        parts as (select page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from cut),
        whole as (select *, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda s: s <> '') s from parts),
        rows as materialized (select page_id, host, path, s shape from whole),
        marked as (select page_id, max((quality = 0 or toxic = 1)::int) bad from rows join labels on try_cast(regexp_extract(path, '([0-9]+)', 1) as bigint) = labels.doc_id
            where (quality = 0 or toxic = 1) is not null group by page_id),
        t0 as materialized (select host, shape, count(*) n, count(bad) labelled, coalesce(sum(bad), 0) bad, []::varchar[] template from rows left join marked using (page_id) group by host, shape),
        {", ".join(level(no) for no in range(DEPTH))},
        base as (select coalesce(sum(bad)::double / nullif(sum(labelled), 0), 0) base from t0),
        pure as (select host, template, (sum(bad) + {PRIOR} * any_value(base)) / (sum(labelled) + {PRIOR}) purity from t{DEPTH}, base group by host, template)
        select page_id, rows.host, path, {rule.replace('host', 'rows.host')} as rule,
            coalesce({verdict.replace('host', 'rows.host')}, case when purity >= {REJECT} then 'block' else 'allow' end) verdict
            from rows join t{DEPTH} t on rows.host = t.host and rows.shape = t.shape join pure on t.host = pure.host and t.template = pure.template"""


def _lexical_search() -> str:
    terms = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""with docs as materialized (select doc_id, t, len(t) n from (select doc_id, {terms} t from documents) where len(t) > 0),
        totals as (select count(*) total, sum(n)::bigint length from docs),
        asked as materialized (select distinct item_id, unnest({terms}) term from benchmark),
        counts as materialized (select doc_id, n, term, count(*) tf from (select doc_id, n, unnest(t) term from docs)
            where term in (select term from asked) group by all),
        weights as (select term, floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1)))::bigint w from counts, totals group by term),
        scores as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * total) // length)))))::bigint score
            from counts join weights using (term) join asked using (term), totals group by item_id, doc_id)
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int rank, doc_id, score from scores where score > 0
            qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50"""


ORACLE: dict[str, str] = {
    "op2_quality_rules": _quality(),
    "op3_revisits": _revisits(),
    "op4_near_duplicates": _near_duplicates(),
    "op7_drop_repeats": _drop_repeats(),
    "op8_mixing": _mixing(),
    "op9_licenses": _licenses(),
    "op10_url_templates": _url_templates(),
    "op11_lexical_search": _lexical_search(),
}
