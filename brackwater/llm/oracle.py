"""The corpus queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from . import licences, urls

FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

NEAR_VECTORS = f"""
    with recursive rows as (select row_number() over () as uid, vec_id, embedding::double[] as v, {FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0 as ok from embeddings),
    links as (select a.uid as a, b.uid as b from rows a join rows b on a.ok and b.ok and a.uid <> b.uid and list_cosine_similarity(a.v, b.v) >= 0.95),
    reach as (select uid as a, uid as b from rows union select r.a, l.b from reach r join links l on r.b = l.a),
    least as (select a, min(vec_id) as component_id from reach join rows on uid = b group by a),
    degree as (select a, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept from rows join least on least.a = uid left join degree on degree.a = uid"""

TOP_PRODUCTS = f"""
    with v as (select row_number() over () as uid, vec_id as id, list_transform(embedding, lambda x: floor(1024 * x::double)) as z from embeddings where vec_id is not null and {FINITE}),
    s as (select q.uid, q.id as query_id, v.id as vec_id, list_inner_product(q.z, v.z)::bigint as score from v q join v on q.uid <> v.uid where q.id % 100 = 0),
    r as (select *, row_number() over (partition by uid order by score desc, vec_id) as rank from s)
    select query_id, rank::int as rank, vec_id, score from r where rank <= 10"""


TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
    with words as (select row_number() over () as uid, doc_id, {TERMS} as terms from documents),
    each as (select uid, doc_id, len(terms) as n, unnest(terms) as term from words),
    posted as (select uid, doc_id, n, term, count(*) as tf from each group by all),
    size as (select count(*) as docs, sum(len(terms))::bigint as terms from words where len(terms) > 0),
    weights as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::double))::bigint as w from posted, size group by term, docs),
    asked as (select item, item_id, term, count(*) as times from (select row_number() over () as item, item_id, unnest({TERMS}) as term from benchmark) group by all),
    scored as (select item, item_id, uid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * size.docs) // size.terms))))::bigint as score
        from asked join weights using (term) join posted using (term), size group by all),
    placed as (select *, row_number() over (partition by item order by score desc, doc_id nulls first) as rank from scored where score > 0)
    select item_id, rank::int as rank, doc_id, score from placed where rank <= 20"""


#: Segments that the SQL for URLs is written out for; the tables given have no deeper paths.
LEVELS = 6


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _urls() -> str:
    rules = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"when (host = {_quoted(h)} or ends_with(host, {_quoted('.' + h)})) and starts_with(path, {_quoted(p)})" for _, h, p in rules]
    rule = "case " + " ".join(f"{f} then {_quoted(h + p)}" for f, (_, h, p) in zip(fits, rules, strict=True)) + " end"
    verdict = "case " + " ".join(f"{f} then {_quoted(v)}" for f, (v, _, _) in zip(fits, rules, strict=True)) + " end"
    variable = r"""(regexp_matches(s, '^(?:[0-9]+(?:[-_.][0-9]+)*(?:\.[A-Za-z0-9]{1,5})?|[0-9a-fA-F]{8,}(?:-[0-9a-fA-F]{4,})*)$') or (regexp_matches(s, '^[A-Za-z0-9_-]{16,}$') and regexp_matches(s, '[0-9]')))"""
    parts = [
        f"""parsed as (select page_id, coalesce(translate(regexp_extract(url, '{urls.PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host, coalesce(regexp_extract(url, '{urls.PARTS}', 2), '') as path from pages)""",
        f"""judged as (select *, {rule} as rule, {verdict} as fixed, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: case when {variable} then '*' else s end) as whole from parsed)""",
        f"rows as (select *, case when len(whole) > {LEVELS} then list_append(whole[1:{LEVELS}], '**') else whole end as shape from judged)",
        "t0 as (select host, shape, count(*) as n, count(rule) as labelled, count(*) filter (where fixed = 'block') as blocked, '' as template from rows group by host, shape)",
    ]
    for k in range(1, LEVELS + 1):
        parts += [
            f"c{k} as (select host, template, shape[{k}] as segment, sum(n) as own from t{k - 1} where len(shape) >= {k} group by all)",
            f"n{k} as (select host, template, count(*) as children, sum(own) as whole from c{k} group by all)",
            f"w{k} as (select host, template, segment from c{k} join n{k} using (host, template) where children >= {urls.FAN} and own <= {urls.RARE} * whole)",
            f"""t{k} as (select t.host, t.shape, t.n, t.labelled, t.blocked, t.template || case when len(t.shape) < {k} then '' when w.segment is not null then '/*' else '/' || t.shape[{k}] end as template
            from t{k - 1} t left join w{k} w on t.host = w.host and t.template = w.template and t.shape[{k}] = w.segment)""",
        ]
    weight = f"{urls.WEIGHT}::double"
    parts += [
        f"placed as (select host, shape, n, labelled, blocked, template || case when len(shape) > {LEVELS} then '/**' else '' end as template from t{LEVELS})",
        f"b{LEVELS + 2} as (select host, template, list_filter(string_split(template, '/'), lambda s: s <> '') as segs, sum(labelled)::bigint as labelled, sum(blocked)::bigint as blocked, '' as below from placed group by host, template)",
    ]
    for k in range(LEVELS + 1, 0, -1):
        parts += [
            f"""places{k} as (select host, array_to_string(segs[1:{k - 1}], '/') as prefix, segs[{k}] as seg, below, sum(labelled)::bigint as n, sum(blocked)::bigint as bad
            from b{k + 1} where len(segs) >= {k} and segs[{k}] not in ('*', '**') group by all)""",
            f"wholes{k} as (select host, prefix, seg, sum(n)::bigint as n, sum(bad)::bigint as bad from places{k} group by all having sum(n) > 0)",
            f"""all{k} as (select p.host, p.prefix, p.seg, p.below, p.n, p.bad, w.n as size from places{k} p join wholes{k} w using (host, prefix, seg) where p.n > 0
            union all select host, prefix, seg, '=', n, bad, n from wholes{k})""",
            f"""pairs{k} as (select a.host, a.prefix, a.seg, b.seg as root, b.size, (a.bad + b.bad) / (a.n + b.n)::double as p,
            abs(a.bad / a.n::double - b.bad / b.n::double) > {urls.APART} * sqrt(p * (1 - p) * (1 / a.n::double + 1 / b.n::double)) as differ
            from all{k} a join all{k} b on a.host = b.host and a.prefix = b.prefix and a.below = b.below and (b.size > a.size or (b.size = a.size and b.seg < a.seg)))""",
            f"alike{k} as (select host, prefix, seg, root, size from pairs{k} group by all having not bool_or(differ))",
            f"""roots{k} as (select host, prefix, seg, root from alike{k} l where not exists (select 1 from alike{k} r where r.host = l.host and r.prefix = l.prefix and r.seg = l.root)
            qualify row_number() over (partition by host, prefix, seg order by size desc, root) = 1)""",
            f"""b{k} as (select b.host, b.template, b.segs, b.labelled, b.blocked, case when len(segs) < {k} then '' else '/' || coalesce(r.root, segs[{k}]) || below end as below
            from b{k + 1} b left join roots{k} r on r.host = b.host and r.prefix = array_to_string(segs[1:{k - 1}], '/') and r.seg = segs[{k}])""",
        ]
    parts += [
        "marked as (select host, template, labelled, blocked, below as branch, regexp_extract(host, '([^.]+\\.[^.]+)$', 1) as domain from b1)",
        "sums as (select host, branch, sum(labelled) as n, sum(blocked) as bad from marked group by all)",
        "near as (select domain, template, sum(labelled) as nn, sum(blocked) as nb from marked group by all)",
        "far as (select template, sum(labelled) as fn, sum(blocked) as fb from marked group by all)",
        "base as (select coalesce(sum(blocked) / nullif(sum(labelled), 0)::double, 0.0::double) as b from marked)",
        f"""pure as (select host, template, (bad + ((nb + ((fb + b * {weight}) / (fn + {weight})) * {weight}) / (nn + {weight})) * {weight}) / (n + {weight}) as purity
        from marked join sums using (host, branch) join near using (domain, template) join far using (template), base)""",
    ]
    return f"""with {", ".join(parts)}
    select r.page_id, r.host, r.path, r.rule, coalesce(r.fixed, case when purity >= {urls.PURITY} then 'block' else 'allow' end) as verdict, p.template
    from rows r join placed p on r.host = p.host and r.shape = p.shape join pure on pure.host = p.host and pure.template = p.template"""


def _licences() -> str:
    weights, bias, temperature = licences.model()
    classes = range(len(licences.CLASSES))
    table = ", ".join(f"({_quoted(g)}, {', '.join(f'{float(x)!r}::double' for x in w)})" for g, w in weights.items())
    z = ", ".join(f"(coalesce(z{k}, 0) + {float(bias[k])!r}::double) / {temperature!r}::double" for k in classes)
    shares = []
    for name, texts in licences.TEMPLATES.items():
        own = [sorted(licences.grams(licences.split_words(t))) for t in texts]
        each = ", ".join(f"len(list_intersect(grams, [{', '.join(map(_quoted, t))}])) / {len(t)}.0::double" for t in own)
        shares.append(f"when {_quoted(name)} then greatest({each})")
    names = ", ".join(map(_quoted, licences.CLASSES))
    keys = ", ".join(map(_quoted, licences.KEYS))
    return f"""with weights(gram, {", ".join(f"w{k}" for k in classes)}) as (values {table}),
    pars as (select row_number() over () as row, doc_id, list_transform(string_split_regex(coalesce(text, ''), '{licences.BLANK}'),
        lambda p: list_filter(string_split_regex(translate(p, '{licences.CAPITALS}', '{licences.SMALL}'), '{licences.BETWEEN}'), lambda w: w <> '')) as pars from documents),
    docs as (select row, doc_id, list_filter(flatten(list_transform(pars, lambda w: list_transform(range(1, 2 + ceil(greatest(len(w) - {licences.SPAN}, 0) / {licences.STRIDE})::int * {licences.STRIDE}, {licences.STRIDE}), lambda i: w[i:i + {licences.SPAN - 1}]))),
        lambda w: list_has_any(w, [{keys}])) as lines from pars),
    worded as (select row, unnest(range(len(lines))) as line, unnest(lines) as w from docs),
    grammed as (select *, list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')), list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) as grams from worded),
    sums as (select row, line, {", ".join(f"sum(w{k}) as z{k}" for k in classes)} from (select row, line, unnest(grams) as gram from grammed) join weights using (gram) group by row, line),
    scored as (select g.*, [{z}] as z from grammed g left join sums using (row, line)),
    chosen as (select *, 1 / list_sum(list_transform(z, lambda x: exp(x - list_max(z)))) as p, list_position(z, list_max(z)) as best from scored),
    named as (select *, case when p >= {licences.NAMED} then [{names}][best] else 'unknown' end as family from chosen),
    compared as (select *, family <> 'unknown' and coalesce(case family {" ".join(shares)} end, 0) >= {licences.CONFIRMED} as confirmed from named),
    by_doc as (select row, count(*) filter (where confirmed) as n_confirmed, array_to_string(list_sort(list(distinct family) filter (where confirmed)), ',') as licences,
        array_to_string(list_sort(list(distinct family) filter (where not confirmed and family <> 'unknown')), ',') as unconfirmed, max(p) filter (where confirmed) as probability from compared group by row)
    select doc_id, len(lines)::bigint as n_paragraphs, coalesce(n_confirmed, 0)::bigint as n_confirmed, coalesce(licences, '') as licences, coalesce(unconfirmed, '') as unconfirmed, round(probability, 6) as probability
    from docs left join by_doc using (row)"""


ORACLE_SQL: dict[str, str] = {"op2_near_vectors": NEAR_VECTORS, "op3_urls": _urls(), "op5_licences": _licences(), "op6_top_products": TOP_PRODUCTS, "op13_ranked": RANKED}
