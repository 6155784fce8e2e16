"""The questions of ``queries.py`` as DuckDB SQL, where SQL can express them.

Tokenizers, hash draws, trees of markup and 64-bit text hashes are beyond it: operators 4,
6, 7, 9, 10 and 13 and the pipeline are tested against brute force instead.
"""

from __future__ import annotations

from martline.llm import line_dedup, secrets

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


LINES = f"""
with pages as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, source, unnest(ls) as line, generate_subscripts(ls, 1) as i from pages),
keyed as (select *, trim(line, ' ' || chr(9) || chr(13)) as k from lines),
totals as (select source, count(*) as total from documents group by source),
counts as (select source, k, count(distinct doc_id) as n from keyed where k <> '' group by source, k),
gone as (
    select c.source, c.k from counts c join totals t on c.source is not distinct from t.source
    where n >= {line_dedup.MIN_PAGES} and n::double / total::double > {line_dedup.MAX_RATIO}::double
),
marked as (
    select l.doc_id, l.line, l.i, g.k is not null as dropped
    from keyed l left join gone g on l.source is not distinct from g.source and l.k = g.k
),
cleaned as (
    select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
           coalesce(string_agg(line, chr(10) order by i) filter (where not dropped), '') as text
    from marked group by doc_id
)
select p.doc_id, p.source, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
       case when p.text is not null then c.text end as text
from pages p left join cleaned c using (doc_id)
"""

TOP_K = """
with scaled as (
    select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as e
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
    from scaled q join scaled c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored)
select query_id, place::integer as rank, vec_id, score from ranked where place <= 5
"""

NEAR = rf"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '{WORD}+') as w
    from documents
),
sets as (
    select doc_id, case when len(w) = 0 then []
        when len(w) < 4 then [array_to_string(w, ' ')]
        else list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) end as s
    from words
),
shingles as (select doc_id, len(s) as n, unnest(s) as x from sets),
links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach(doc_id, other) as (
    select doc_id, doc_id from documents
    union
    select r.doc_id, l.b from reach r join links l on r.other = l.a
),
smallest as (select doc_id, min(other) as component_id from reach group by doc_id)
select s.doc_id, len(s)::bigint as n_shingles, component_id, s.doc_id = component_id as kept
from sets s join smallest using (doc_id)
"""

QUALITY = rf"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
split as (
    select doc_id, t, regexp_extract_all(t, '{WORD}+') as w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls
    from texts
),
numbered as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from split),
triples as (
    select doc_id, i, lead(word, 2) over o as third,
           word || ' ' || lead(word) over o || ' ' || lead(word, 2) over o as x
    from numbered window o as (partition by doc_id order by i)
),
again as (
    select doc_id, i from (select *, count(*) over (partition by doc_id, x) as n from triples where third is not null) where n >= 2
),
inside as (select doc_id, count(distinct i + d.d) as n from again, (values (0), (1), (2)) d(d) group by doc_id),
measured as (
    select s.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '{SPACE}', '', 'g'))::bigint as word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, len(ls)::bigint as n_lines,
           (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(i.n, 0)::bigint as n_repeat_words,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) as n_lower
    from split s left join inside i using (doc_id)
),
judged as (
    select *, (n_words < 50)::int::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (5 * n_symbols > n_words)::int
           + 8 * (n_lines >= 4 and 2 * n_dup_lines > n_lines)::int
           + 16 * (word_chars < 2 * n_words or word_chars > 20 * n_words)::int + 32 * (n_upper > n_lower)::int as failed
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed,
       failed = 0 as kept, failed::bigint as failed
from judged
"""


def _secrets() -> str:
    parts = [
        f"select doc_id, {place} as place, '{r.kind}' as kind, {r.least} as least, "
        f"regexp_extract_all(t, {_quoted(r.pattern)}, 0) as m, regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) as g, "
        f"string_split_regex(t, {_quoted(r.pattern)}) as b from texts"
        for place, r in enumerate(secrets.RULES)
    ]
    counts = ", ".join(f"count(*) filter (where kind = '{r.kind}') as n_{r.kind}" for r in secrets.BASE)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' order by start, place)"
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(parts)}),
each as (
    select doc_id, place, kind, least, unnest(m) as m, unnest(g) as g, unnest(b[:len(m)]) as b, generate_subscripts(m, 1) as i
    from found where len(m) > 0
),
placed as (
    select *, sum(length(b) + length(m)) over (partition by doc_id, kind order by i) as stop from each
),
spans as (select doc_id, place, kind, (stop - length(m))::bigint as start, stop::bigint as stop from placed where length(g) >= least),
per_doc as (
    select doc_id, {counts}, {listed} filter (where place < {len(secrets.BASE)}) as base, {listed} as spans
    from spans group by doc_id
)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secrets.BASE)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join per_doc using (doc_id)
"""


MERKLE = """
with recursive table_of as (
    select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t
),
marked as (
    select *, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint) as b,
           case when source is null then 'n' else 's' || source end as tree
    from documents
),
checked as (
    select m.*, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) as crc
    from marked m cross join table_of
),
headed as (
    select *, case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end
           || case when source is null then '-' else strlen(source) || ':' || source end
           || case when lang is null then '-' else strlen(lang) || ':' || lang end
           || case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end as head,
           case when crc % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as other
    from checked
),
leaves as (
    select tree, doc_id, sha256(head || case when text is null then '-' else strlen(text) || ':' || text end) as leaf,
           sha256(head || case when other is null then '-' else strlen(other) || ':' || other end) as claim
    from headed
),
placed as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n
    from leaves
),
nodes as (
    select tree, 0 as h, idx, n, leaf as digest from placed
    union all
    select tree, h + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx))
    from nodes where n > 1 group by tree, h, idx // 16, n
),
subroots as (
    select tree, digest, row_number() over (order by tree) - 1 as idx, count(*) over () as n from nodes where n = 1
),
tops as (
    select 0 as h, idx, n, digest from subroots
    union all
    select h + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx))
    from tops where n > 1 group by h, idx // 16, n
),
groups as (
    select tree, h, idx // 16 as up, list(digest order by idx) as kids from nodes where n > 1 group by all
    union all
    select '', h, idx // 16, list(digest order by idx) from tops where n > 1 group by all
),
climb as (
    select doc_id, tree, leaf, claim, tree as at, 0 as h, idx, n, '' as proof, claim as folded from placed
    union all
    select c.doc_id, c.tree, c.leaf, c.claim, c.at, c.h + 1, c.idx // 16, (c.n + 15) // 16,
           c.proof || array_to_string(g.kids[:c.idx % 16] || g.kids[c.idx % 16 + 2:], ''),
           sha256(array_to_string(g.kids[:c.idx % 16] || [c.folded] || g.kids[c.idx % 16 + 2:], ''))
    from climb c join groups g on c.at = g.tree and c.h = g.h and c.idx // 16 = g.up
    where c.n > 1
),
rise as (
    select c.doc_id, c.tree, c.leaf, 0 as h, s.idx, s.n, c.proof, c.folded from climb c join subroots s using (tree) where c.n = 1
    union all
    select c.doc_id, c.tree, c.leaf, c.h + 1, c.idx // 16, (c.n + 15) // 16,
           c.proof || array_to_string(g.kids[:c.idx % 16] || g.kids[c.idx % 16 + 2:], ''),
           sha256(array_to_string(g.kids[:c.idx % 16] || [c.folded] || g.kids[c.idx % 16 + 2:], ''))
    from rise c join groups g on g.tree = '' and c.h = g.h and c.idx // 16 = g.up
    where c.n > 1
)
select r.doc_id, r.leaf, s.digest as subroot, t.digest as root, sha256(r.proof) as proof_sha256, r.folded as folded_root,
       r.folded = t.digest as verified
from rise r join subroots s using (tree) cross join (select digest from tops where n = 1) t
where r.n = 1
"""

RANKED = r"""
with terms as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
),
sizes as (select doc_id, count(*) as n from terms group by doc_id),
totals as (select count(*)::bigint as docs, sum(n)::bigint as length from sizes),
asked as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
tfs as (select doc_id, term, count(*) as tf from terms where term in (select term from asked) group by all),
weights as (
    select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from tfs cross join totals group by term
),
values_of as (
    select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))) as v
    from tfs join weights using (term) join sizes using (doc_id) cross join totals
),
scores as (select item_id, doc_id, sum(v)::bigint as score from asked join values_of using (term) group by all),
ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as place from scores where score > 0
)
select item_id, place::integer as rank, doc_id, score from ranked where place <= 50
"""

SQL = {
    "op1_line_dedup": LINES,
    "op2_exact_top_k": TOP_K,
    "op3_near_duplicates": NEAR,
    "op5_quality_rules": QUALITY,
    "op8_secret_scan": _secrets(),
    "op11_merkle_manifest": MERKLE,
    "op12_ranked_search": RANKED,
}
