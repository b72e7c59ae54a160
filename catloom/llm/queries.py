"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catloom.llm import decontaminate, factorisation, hilbert, language_id, lexical_search, mixing, ngram_lm, quality_rules, repeats, secrets, simhash, spelling, token_ids
from catloom.llm.common import table


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_ids(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_digest(table(spark, sf_dir, "documents"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.lm_scores(table(spark, sf_dir, "documents"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard_digest(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation.classify_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_digest(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_token_ids, op2_secret_scan, op3_source_mix, op4_simhash, op5_lm_scores, op6_repeats, op7_quality_rules, op8_hilbert_shards, op9_quality_classifier, op10_benchmark_leaks, op11_language_id, op12_spelling_variants, op13_lexical_search)
}



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULES = ", ".join(f"({i}, {_quoted(r.kind)}, {_quoted(r.pattern)}, {r.group}, {r.least})" for i, r in enumerate(secrets.RULES))

def _crc_step(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


_CRC = f"[{', '.join(str(_crc_step(b)) for b in range(256))}]::bigint[]"

ORACLE_SQL: dict[str, str] = {
    "op2_secret_scan": f"""
with d as (select doc_id, coalesce(text, '') as t from documents), r(rank, kind, pattern, g, least) as (values {_RULES}),
m as (select doc_id, rank, kind, pattern, g, least, regexp_split_to_array(t, pattern) as gaps, regexp_extract_all(t, pattern) as ms from d, r where regexp_matches(t, pattern)),
x as (select *, unnest(range(1, len(ms) + 1)) as i from m),
y as (select doc_id, rank, kind, ms[i] as hit, list_sum(list_transform(gaps[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda v: length(v))), 0) as start, pattern, g, least from x),
z as (select doc_id, rank, kind, start::bigint as start, (start + length(hit))::bigint as stop from y where case when g = 2 then length(regexp_extract(hit, pattern, 2)) else length(hit) end >= least)
select d.doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
 sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (where rank < 3), '')) as base_sha256, coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank), '') as spans
from d left join z on d.doc_id = z.doc_id group by 1""",
    "op3_source_mix": """
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as total from d group by 1), n as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w, row_number() over (order by source nulls last) as i from s),
o as (select *, row_number() over (order by 3 * total / w::double, i) as k, sum(total) over () as everything, sum(w) over () as all_w from n),
p as (select *, everything - coalesce(sum(3 * total) over (order by k rows between unbounded preceding and 1 preceding), 0) as left_, all_w - coalesce(sum(w) over (order by k rows between unbounded preceding and 1 preceding), 0) as weight from o),
c as (select *, bool_and(3 * total * weight < left_ * w) over (order by k rows unbounded preceding) as capped from p),
l as (select everything_left, weight_left from (select max(everything) - coalesce(sum(3 * total) filter (where capped), 0) as everything_left, max(all_w) - coalesce(sum(w) filter (where capped), 0) as weight_left from c)),
t as (select source, total, case when capped then (3 * total)::double else (everything_left * w)::double / weight_left end as target from c, l),
q as (select *, round_even(target, 0)::bigint as give from t),
h as (select d.*, total, target, give // greatest(total, 1) as whole, give % greatest(total, 1) as rest, ('0x' || substr(md5('42|' || doc_id || '|' || size), 1, 15))::bigint as h from d join q on d.source is not distinct from q.source),
g as (select source, h, sum(size) as words, count(*) as n, sum(sum(size)) over (partition by source order by h) - sum(size) as at_ from h group by 1, 2)
select doc_id, size, total as source_size, target, (case when total > 0 then whole * size else 0 end + case when at_ + words <= rest then size when at_ <= rest then least((rest - at_) // n, size) else 0 end)::bigint as taken from h join g on h.source is not distinct from g.source and h.h = g.h""",
    "op6_repeats": """
with n as (select doc_id, hex(encode(coalesce(text, ''))) as x, length(hex(encode(coalesce(text, '')))) // 2 as n_bytes from documents),
p as (select doc_id, i, md5(substr(x, 2 * i + 1, 400)) as w from (select doc_id, x, unnest(range(0, greatest(n_bytes - 199, 0))) as i from n)),
r as (select w from p group by 1 having count(*) > 1),
s as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 200 then 0 else 1 end as new from p where w in (select w from r)),
g as (select *, sum(new) over (partition by doc_id order by i rows unbounded preceding) as run from s),
m as (select doc_id, min(i) as a, max(i) + 200 as b from g group by doc_id, run),
l as (select *, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from m),
k as (select l.doc_id, sum(b - a) as removed, count(*) as spans, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(x), 2 * max(b) + 1) as kept from l join n on l.doc_id = n.doc_id group by 1)
select n.doc_id, n_bytes::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, x))) as kept_sha256 from n left join k on n.doc_id = k.doc_id""",
    "op13_lexical_search": r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
k as (select count(*)::bigint as docs, sum(len(ts))::bigint as words from d where len(ts) > 0),
t as (select doc_id, len(ts)::bigint as n, term, count(*)::bigint as tf from (select doc_id, ts, unnest(ts) as term from d) group by 1, 2, 3),
f as (select term, floor(1000 * ln((2.0::double * max(docs) + 2) / (2.0::double * count(*) + 1)))::bigint as w from t, k group by 1),
i as (select item_id, term, count(*)::bigint as r from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by 1, 2),
g as (select doc_id, t.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) as gain from t join f on t.term = f.term, k where t.term in (select term from i)),
s as (select item_id, doc_id, sum(r * gain)::bigint as score from i join g on i.term = g.term group by 1, 2)
select item_id, rank::integer as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0) where rank <= 20""",
    "op12_spelling_variants": f"""
with r as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
k as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*)::bigint as n from r where length(run) >= 6 group by 1, 2),
x as (select *, hex(encode(doc_id || ':' || run)) as x from k),
b as (select doc_id, run, n, list_prepend(4294967295::bigint, list_transform(range(0, (length(x) // 2)::bigint), lambda i: ('0x' || substr(x, (2 * i + 1)::bigint, 2))::bigint)) as bytes from x),
h as (select run, n, xor(list_reduce(bytes, lambda c, y: xor(({_CRC})[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) as h from b),
v as (select case when h % 199 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run) + 2)::bigint) else run end as word, sum(n)::bigint as n from h group by 1),
w as (select word, n from v where length(word) >= 6 and n >= 5),
d as (select word, n, length(word) as l, i, left(word, (i - 1)::bigint) || substr(word, (i + 1)::bigint) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
p as (select a.word, c.word as other, c.n as m from d a join d c on a.rest = c.rest and a.i = c.i and a.l = c.l and a.word <> c.word
 union select d.word, w.word, w.n from d join w on d.rest = w.word union select w.word, d.word, d.n from d join w on d.rest = w.word),
g as (select word, count(*)::bigint as n_near, max(m) as best from p group by 1),
f as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when best >= 5 * w.n then (select min(other) from p where p.word = w.word and p.m = g.best) end as form, case when best >= 5 * w.n then best end as form_n from w left join g on w.word = g.word),
t as (with recursive c as (select word, word as root, 0 as step from f union all select c.word, f.form, step + 1 from c join f on c.root = f.word where f.form is not null) select word, arg_max(root, step) as root from c group by 1)
select f.word, form, root, n, n_near, form_n from f join t on f.word = t.word""",
}
