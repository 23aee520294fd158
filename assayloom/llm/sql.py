"""DuckDB statements for the queries of this package that SQL can express.

They follow the contracts, not the methods: op5 counts the windows themselves,
op6 compares all vectors of a label.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after(url: str) -> str:
    return f"case when strpos({url}, '://') > 0 then substr({url}, strpos({url}, '://') + 3) end"


def _host(url: str) -> str:
    return f"coalesce(translate(regexp_extract({_after(url)}, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({_after(url)}, '^[^/?#]*([^?#]*)', 1), '')"


def _address(url: str) -> str:
    query = f"coalesce(regexp_extract({_after(url)}, '^[^?#]*(\\?[^#]*)', 1), '')"
    return f"case when {_host(url)} <> '' then {_host(url)} || coalesce(nullif({_path(url)}, ''), '/') || {query} end"


OP1 = rf"""
with recursive rules(action, rule, site, start) as (values
    ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
    ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
given as (select row_number() over () as r, page_id, html, url, {_host('url')} as host, {_path('url')} as path, {_address('url')} as node from pages),
tags as (select host, path, node, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) as tag from given where node is not null),
named as (select host, path, node, replace(trim(case
    when regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
    then regexp_replace(regexp_extract(tag, '(?i)\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), '^["'']|["'']$', '', 'g')
    when regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
    then regexp_extract(tag, '(?i)\bcontent\s*=\s*["''][^"''>]*?\burl\s*=\s*["'']?([^"''>\s]+)', 1) end), '&amp;', '&') as link from tags),
resolved as (select node, case
    when link = '' or starts_with(link, '#') then null
    when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') then link
    when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
    when starts_with(link, '//') then 'http:' || link
    when starts_with(link, '/') then 'http://' || host || link
    when starts_with(link, '?') then 'http://' || host || path || link
    else 'http://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || link end as goal from named),
links as (select node as a, {_address('goal')} as b from resolved where {_address('goal')} is not null),
edges as (select a, b from links where a <> b union select b, a from links where a <> b),
walk as (select a as node, a as reached from edges union select w.node, e.b from walk as w join edges as e on e.a = w.reached),
judged as (select node, arg_max(action, length(rule)) as action from (select distinct reached as node, 'x://' || reached as url from walk)
    join rules on ({_host('url')} = site or ends_with({_host('url')}, '.' || site)) and starts_with({_path('url')}, start) group by node),
classes as (select w.node, case when bool_or(action = 'allow') then 'allow' else 'block' end as of_class
    from walk as w join judged as j on j.node = w.reached group by w.node),
fits as (select r, arg_max(rule, length(rule)) as rule, arg_max(action, length(rule)) as action
    from given join rules on (host = site or ends_with(host, '.' || site)) and starts_with(path, start) group by r)
select page_id, host, path, rule, coalesce(action, of_class, 'allow') as verdict,
    case when action is not null then 'rule' when of_class is not null then 'alias' else 'default' end as "by"
from given left join fits using (r) left join classes using (node)
"""

OP5 = r"""
with texts as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
windows as (select r, i, array_to_string(words[i:i + 34], ' ') as body from texts, unnest(range(1, len(words) - 33)) as t(i)),
again as (select r, i from windows where body in (select body from windows group by body having count(*) > 1)),
gone as (select distinct r, j from again, unnest(range(i, i + 35)) as t(j)),
single as (select r, j, words[j] as word from texts, unnest(range(1, len(words) + 1)) as t(j)),
kept as (select r, string_agg(word, ' ' order by j) as body, count(*) as n from single anti join gone using (r, j) group by r)
select doc_id, len(words) as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(body, '')) as kept_sha256
from texts left join kept using (r)
"""

OP6 = """
with recursive given as (select row_number() over () as r, vec_id, label, embedding::double[] as e from embeddings),
good as (select r, vec_id, label, e from given where label is not null
    and case when len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(e) > 0 then list_dot_product(e, e) > 0 else false end),
links as (select a.r as x, b.r as y from good as a join good as b on a.label = b.label and a.r <> b.r
    where case when len(a.e) = len(b.e) then list_cosine_similarity(a.e, b.e) >= 0.93 else false end),
walk as (select r, r as reached from good union select w.r, l.y from walk as w join links as l on l.x = w.reached),
components as (select w.r, min(g.vec_id) as component_id from walk as w join given as g on g.r = w.reached group by w.r),
counts as (select x as r, count(*) as n from links group by x)
select vec_id, coalesce(n, 0) as n_links, coalesce(component_id, vec_id) as component_id,
    vec_id is not distinct from coalesce(component_id, vec_id) as kept
from given left join components using (r) left join counts using (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_redirect_classes": OP1, "op5_substring_super_kmers": OP5, "op6_embedding_hyperplanes": OP6}
