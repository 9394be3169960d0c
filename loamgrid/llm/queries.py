"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, classlm, decontam, language, licences, mixing, neardup, packing, pii, substrings, toxicity, turns, whitening
from .common import read, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


@query()
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.profiles(docs, remainder(F.col("doc_id"), 3) != 1))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


MIX_SQL = r"""
with words as (
  select doc_id, source, coalesce(text, '') as text,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
keyed as (
  select doc_id, source, size, md5(text) as tie,
    -ln((cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 13)) as bigint) + 0.5) / 4503599627370496.0)
      * (1.0 + abs(ln((length(text) + 1.0) / (size + 1.0) / 6.5))) as key from words),
sources as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) as n from keyed group by source),
shares as (
  select *, 2.0 * source_size as cap, case n % 3 when 1 then 3.0 when 2 then 1.0 else 2.0 end as weight,
    1.5 * sum(source_size) over () as pool from sources),
levels as (
  select *, (pool - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as even from shares),
goal as (
  select source, source_size, least(cap, weight * coalesce((select even from levels where cap / weight >= even order by cap / weight, source nulls last limit 1), 1e300)) as target from levels),
ranked as (
  select k.doc_id, k.size, g.source_size, g.target, case when g.source_size > 0 then floor(g.target / g.source_size) else 0 end as epochs,
    coalesce(sum(k.size) over (partition by k.source order by key, k.doc_id, tie rows between unbounded preceding and 1 preceding), 0) as ahead
  from keyed k join goal g on k.source is not distinct from g.source)
select doc_id, size, cast(source_size as bigint) as source_size, round(target, 4) as target,
  cast(size * (epochs + case when ahead + size / 2.0 <= target - epochs * source_size then 1 else 0 end) as bigint) as taken
from ranked
"""


@query(MIX_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")


NEAR_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) end as s from words),
sizes as (select doc_id, len(s) as n from sets),
items as (select doc_id, unnest(s) as x from sets),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as hits from items a join items b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * hits >= 85 * (p.n + q.n - hits)),
edges as (select a as u, b as v from links union all select b, a from links),
reach(id, top) as (select doc_id, doc_id from sizes union select e.v, r.top from reach r join edges e on e.u = r.id),
tops as (select id, min(top) as component_id from reach group by id)
select doc_id, cast(n as bigint) as n_shingles, component_id, doc_id = component_id as kept from sizes join tops on id = doc_id
"""


@query(NEAR_SQL)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=(85, 100))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


REPEAT_SQL = r"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from words)),
often as (select h from windows group by h having count(*) > 1),
gone as (
  select doc_id, count(distinct pos) as n_removed, list_distinct(list(pos)) as places
  from (select doc_id, unnest(range(i, i + 35)) as pos from windows where h in (select h from often)) group by doc_id),
kept as (
  select w.doc_id, len(w.w) as n_words, coalesce(n_removed, 0) as n_removed,
    case when n_removed is null then w.w else [w.w[i] for i in range(1, len(w.w) + 1) if not list_contains(g.places, i)] end as k
  from words w left join gone g on g.doc_id = w.doc_id)
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""


@query(REPEAT_SQL)
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents"))


@query()
def op9_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.class_scores(read(spark, sf_dir, "documents"))


@query()
def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


@query()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return decontam.contaminated(docs, decontam.searcher(docs, read(spark, sf_dir, "benchmark")))


@query()
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


TURNS_SQL = r"""
with recursive
raw as (select conv_id, cast(turn as bigint) as turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
marked as (select *, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(range(1, len(k) + 1), lambda i: cast(ord(k[i]) as bigint))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [cast(0 as bigint) for z in range(8)]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 20 as f from raw),
damaged as (select conv_id, turn, case when f = 4 then 'user' else role end as role,
  case when f = 1 then '' when f = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case when f = 3 then 2 else 1 end)) as copy from marked where f <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos from damaged),
inked as (select *, regexp_matches(text, '[^ 	-]') as ink,
  row_number() over (partition by conv_id, role, text order by pos) > 1 as seen, substr(role, 1, 1) as i from placed),
lines as (select *, ink and seen as again, ink and not seen and not regexp_matches(text, '[.!?][ 	-]*$') as cut,
  lag(i) over (partition by conv_id order by pos) as ahead from inked),
inserts(before, mid, price, ed, made) as (values ('n', 'n', 0, '', cast([] as varchar[])), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
  ('n', 'u', 5, 'I', ['user:']), ('s', 'u', 5, 'I', ['user:']), ('a', 'u', 5, 'I', ['user:']), ('u', 'a', 5, 'I', ['assistant:']),
  ('n', 'a', 10, 'II', ['user:', 'assistant:']), ('s', 'a', 10, 'II', ['user:', 'assistant:'])),
ops(op) as (values ('D'), ('K'), ('R')),
path(conv_id, pos, st, cost, audit, made) as (
  select conv_id, cast(0 as bigint), 'n', cast(0 as bigint), '', cast([] as varchar[]) from (select distinct conv_id from raw)
  union all
  select conv_id, pos, st, cost, audit, made from (
    select p.conv_id, r.pos, case op when 'D' then mid when 'K' then r.i else case mid when 'u' then 'a' else 'u' end end as st,
      p.cost + price + case op when 'D' then 2 when 'R' then 1 else 0 end + case when cut and op <> 'D' then 5 else 0 end as cost,
      p.audit || ed || op as audit,
      list_concat(list_concat(p.made, n.made), case op when 'D' then cast([] as varchar[]) when 'K' then [r.role || ':' || r.text]
        else [case mid when 'u' then 'assistant:' else 'user:' end || r.text] end) as made
    from path p join lines r on r.conv_id is not distinct from p.conv_id and r.pos = p.pos + 1 join inserts n on n.before = p.st cross join ops
    where op = 'D' or (ink and not again and (op = 'R' or mid || r.i in ('ns', 'nu', 'su', 'ua', 'au'))))
  qualify row_number() over (partition by conv_id, st order by cost, audit) = 1),
counted as (select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) as n, count_if(not ink) as blank,
  count_if(again) as duplicate, count_if(cut) as truncated, count_if(ahead is not null and ahead || i not in ('su', 'ua', 'au')) as illegal from lines group by conv_id),
ends as (select p.conv_id, p.cost + price as cost, p.audit || ed as audit, list_concat(p.made, n.made) as made
  from path p left join counted c on c.conv_id is not distinct from p.conv_id join inserts n on n.before = p.st
  where p.pos = coalesce(c.n, 0) and mid in ('n', 'a')
  qualify row_number() over (partition by p.conv_id order by p.cost + price, p.audit || ed) = 1)
select e.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank, cast(coalesce(duplicate, 0) as bigint) as duplicate,
  cast(coalesce(truncated, 0) as bigint) as truncated, cast(coalesce(illegal, 0) as bigint) as illegal, cast(cost as bigint) as cost, audit,
  sha256(array_to_string(made, chr(10))) as repaired_sha256
from ends e left join counted c on c.conv_id is not distinct from e.conv_id
"""


@query(TURNS_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(read(spark, sf_dir, "conversations")))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))
