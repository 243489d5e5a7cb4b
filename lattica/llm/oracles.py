"""DuckDB SQL for the queries that it can express.

Not expressible, and tested against plain versions instead: trained models (op1,
op5), the tokenizer (op3), the seeded choice of documents (op6) and XXH64 (op10).
"""

from __future__ import annotations

from . import quality_rules, secrets

_WORD = r"[^\x20\x09-\x0D]+"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def rules() -> str:
    less = lambda pattern: f"length(j) - length(regexp_replace(j, '{pattern}', '', 'g'))"
    bits = " + ".join(f"case when {r.fails} then {1 << i} else 0 end" for i, r in enumerate(quality_rules.RULES))
    mask = quality_rules.DEFAULT.mask()
    return f"""
with d as (select row_number() over () as rn, doc_id, coalesce(text, '') as t from documents),
w as (select rn, doc_id, t, regexp_extract_all(t, '{_WORD}') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls from d),
i as (select rn, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3),
k as (select rn, i, count(*) over (partition by rn, ws[i], ws[i + 1], ws[i + 2]) as n from i),
c as (select rn, count(distinct p) as n from (select rn, unnest([i, i + 1, i + 2]) as p from k where n >= 2) group by rn),
m as (select w.rn, doc_id, array_to_string(ws, '') as j, len(ws)::bigint as n_words, len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words from w left join c on w.rn = c.rn),
f as (select *, length(j)::bigint as word_chars, ({less(quality_rules.SYMBOLS)})::bigint as n_symbols, {less(r"\p{Lu}")} as n_upper, {less(r"\p{L}")} as n_letters, {less("!")} as n_bangs from m),
b as (select *, ({bits})::bigint as fail_bits from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 as base_failed, (fail_bits & {mask}) = 0 as kept, fail_bits from b"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def secret_spans() -> str:
    def found(pattern: str, rank: int, value: int = 0) -> str:
        p = _quoted(pattern)
        return f"select rn, {rank} as rank, regexp_extract_all(t, {p}) as m, regexp_extract_all(t, {p}, {value}) as v, regexp_split_to_array(t, {p}) as g from d where regexp_matches(t, {p})"

    parts = [found(secrets.ASSIGN, 0, 2), found("AKIA[A-Z0-9]{16,}", 1), found("[0-9a-f]{24,}", 2)]
    tests = ["rank = 0 and length(v) >= 6", "rank in (1, 2)"]
    for c in secrets.CLASSES:
        rank = secrets.KINDS.index(c.kind)
        alphabet = c.alphabet.replace("-", "") + "-" * ("-" in c.alphabet)
        parts.append(found(f"[{alphabet}]{{{c.least},}}", rank))
        needs = [f"regexp_matches(s, {_quoted(n)})" for n in c.needs] + [f"not regexp_matches(s, {_quoted(a)})" for a in secrets.ALLOWED]
        best = f"list_max(list_transform(range(1, length(s) - {c.width} + 2), lambda x: list_entropy(string_split(s[x:x + {c.width - 1}], ''))))"
        tests.append(f"rank = {rank} and {' and '.join(needs)} and {best} >= {c.bits - 1e-12}")
    kinds = "[" + ", ".join(map(_quoted, secrets.KINDS)) + "]"
    listing = "coalesce(string_agg({}[rank + 1] || ':' || start || ':' || stop, ',' order by start, rank){}, '')"
    return f"""
with d as (select row_number() over () as rn, doc_id, coalesce(text, '') as t from documents),
a as ({" union all ".join(parts)}),
k as (select rn, rank, unnest(range(1, len(m) + 1)) as k, m, v, g from a),
s as (select rn, rank, m[k] as s, v[k] as v, (list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::bigint as start from k),
x as (select rn, rank, start, (start + length(s))::bigint as stop from s where {" or ".join(f"({t})" for t in tests)}),
y as (select * from x where rank < 3 or not exists (select 1 from x z where z.rn = x.rn and z.rank < 3 and z.start < x.stop and x.start < z.stop)),
n as (select rn, {", ".join(f"count_if(rank = {i})::bigint as n_{kind}" for i, kind in enumerate(secrets.KINDS))}, {listing.format(kinds, " filter (where rank < 3)")} as base, {listing.format(kinds, "")} as spans from y group by rn)
select doc_id, {", ".join(f"coalesce(n_{kind}, 0) as n_{kind}" for kind in secrets.KINDS)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join n on d.rn = n.rn"""


EMBEDDINGS = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
n as (select vec_id, e, sqrt(list_inner_product(e, e)) as l from v where len(e) > 0 and list_count(e) = len(e) and len(list_filter(e, lambda x: not isfinite(x))) = 0),
p as (select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and a.l > 0 and b.l > 0 and list_inner_product(a.e, b.e) / (a.l * b.l) >= 0.95),
r(vec_id, far) as (select vec_id, vec_id from v union select r.vec_id, p.b from r join p on r.far = p.a),
c as (select vec_id, min(far) as component_id from r group by vec_id),
k as (select a as vec_id, count(*) as n from p group by a)
select c.vec_id, coalesce(k.n, 0)::bigint as n_links, component_id, c.vec_id = component_id as kept from c left join k on c.vec_id = k.vec_id"""

SUBSTRINGS = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as ws from documents),
i as (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from d where len(ws) >= 13),
k as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as key from i),
f as (select doc_id, i, min(doc_id) over (partition by key) as first from k),
g as (select distinct doc_id, unnest(range(i, i + 13)) as p from f where first < doc_id),
x as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from d),
y as (select x.doc_id, count(g.p)::bigint as n_removed, coalesce(string_agg(word, ' ' order by x.p) filter (where g.p is null), '') as kept from x left join g on x.doc_id = g.doc_id and x.p = g.p group by x.doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join y on d.doc_id = y.doc_id"""


def urls(rules: tuple[tuple[str, str], ...]) -> str:
    values = ", ".join(f"('{v}', '{r}', split_part('{r}', '/', 1), '{r[r.index('/') :]}')" for v, r in rules)
    return f"""
with r(verdict, rule, h, p) as (values {values}),
a as (select page_id, url, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
b as (select page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') as raw from a),
c as (select row_number() over () as rn, page_id, translate(raw, {_AZ}) as host, regexp_extract(substr(coalesce(rest, ''), length(raw) + 1), '^[^?#]*') as path from b),
m as (select rn, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from c join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by rn)
select page_id, host, path, rule, coalesce(verdict, case when host = '' then 'block' else 'allow' end) as verdict from c left join m on c.rn = m.rn"""
