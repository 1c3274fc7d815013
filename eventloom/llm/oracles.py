"""DuckDB SQL that gives the rows of the text queries where SQL can express them."""

from __future__ import annotations

#: Words of a text, and A-Z in lower case.
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_links(width: int, num: int, den: int, docs: str = "documents") -> str:
    """CTEs: sets (doc_id, n), links (a, b) in both directions, classes (doc_id, component_id)."""
    words = WORDS.format(FOLDED.format("text"))
    return f"""
    tokens as (select doc_id, {words} as w from {docs}),
    shingles as (
        select distinct doc_id, unnest(case
            when len(w) >= {width} then list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i : i + {width - 1}], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
        from tokens),
    sizes as (select doc_id, count(*) as n from shingles group by all),
    shared as (
        select x.doc_id as a, y.doc_id as b, count(*) as n_both from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id
        group by all),
    links as (
        select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
        where {den} * n_both >= {num} * (p.n + q.n - n_both)),
    both_ways as (select a, b from links union all select b, a from links),
    reach(a, b) as (
        select doc_id, doc_id from tokens
        union
        select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
    classes as (select a as doc_id, min(b) as component_id from reach group by a)"""


ORACLES = {
    "op9_jaccard": f"""
        with recursive {jaccard_links(3, 90, 100)}
        select t.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
        from tokens t left join sizes using (doc_id) join classes using (doc_id)""",
    "op7_revisits": r"""
        with split as (
            select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as bare from pages),
        parts as (
            select *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.|:(80|443)$', '', 'g')
                || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') as place,
                list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
                    lambda p: p <> '' and not regexp_matches(lower(p), '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) as params
            from split),
        keyed as (
            select page_id, html, '"' || md5(html) || '"' as tag,
                place || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end as canonical_url,
                page_id * 600 as seen, page_id * 600 + 300 * (1 + page_id % 4) as later,
                case when page_id % 7 <> 0 then page_id * 600 - 86400 end as modified
            from parts),
        responses as (
            select page_id * 2 as response_id, canonical_url as key, seen as response_ts, case when page_id % 5 <> 0 then tag end as tag, modified, length(html) as size
            from keyed),
        revisits as (
            select page_id * 2 + 1 as record_id, canonical_url, later as ts,
                case when page_id % 5 = 0 then null when page_id % 11 = 0 then '"changed"' else tag end as sent,
                modified + case when page_id % 13 = 0 then 1 else 0 end as dated
            from keyed),
        latest as (
            select r.*, max(struct_pack(t := response_ts, i := response_id)) as l
            from revisits r left join responses s on s.key = r.canonical_url and (s.response_ts, s.response_id) < (r.ts, r.record_id)
            group by all),
        outcomes as (
            select latest.*, s.*, case
                when response_id is null then 'no_response'
                when sent is not null and tag is not null then case when sent = tag then 'resolved' else 'mismatch' end
                when dated is not null and modified is not null then case when dated = modified then 'resolved' else 'mismatch' end
                else 'unchecked' end as outcome
            from latest left join responses s on s.response_id = latest.l.i)
        select record_id, canonical_url, ts, response_id, response_ts, outcome, case when outcome in ('resolved', 'unchecked') then
            'cache-control: max-age=120' || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'server: a' end as headers
        from outcomes""",
    "op11_block_naming": r"""
        with plain as (select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as p from documents)
        select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by p) as group_size,
            row_number() over best = 1 as kept, sha256(p) as text_sha256
        from plain window best as (partition by p order by length(t) desc, doc_id nulls last)""",
    "op12_hard_negatives": r"""
        with usable as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        parts as (select vec_id, label, unnest(v) as x, generate_subscripts(v, 1) as k from usable),
        scored as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, sum(a.x * b.x)::bigint as score
            from parts a join parts b on a.k = b.k and a.vec_id <> b.vec_id
            where a.vec_id % 100 = 0 group by all),
        positives as (
            select * from (select *, row_number() over (partition by anchor_id order by score desc, other_id) as place from scored where same)
            where place <= 5),
        fitting as (
            select p.anchor_id, p.other_id as positive_id, n.other_id as negative_id, p.score as positive_score, n.score as negative_score,
                row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as rank
            from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
                and 100 * n.score between 30 * p.score and 90 * p.score)
        select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from fitting where rank <= 10""",
}
