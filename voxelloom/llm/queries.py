"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, hostrep, langcodes, linededup, merkle, nbsvm, piecetable, preference, projpass, resample, simhash, warc, wrapper
from .shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecetable.encode_decode(table(spark, sf_dir, "documents"), PIECE_MODEL)


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL["op9_line_dedup"] = r"""
with docs as (
  select doc_id, row_number() over () as row_id, coalesce(text, '') as text from documents
), lines as (
  select doc_id, row_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as line_no from docs
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines
), hot as (
  select k, max(doc_id) as last_doc from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5
), judged as (
  select keyed.*, hot.k is not null and doc_id <> last_doc as gone from keyed left join hot on keyed.k = hot.k
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by line_no) filter (not gone), '')) as kept_sha256
from judged group by doc_id, row_id
"""


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langcodes.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


RULES = [hostrep.Rule("net/", "block"), hostrep.Rule("example.net/en/", "allow"), hostrep.Rule("example.com/de/", "block"), hostrep.Rule("org/fr/", "allow")]


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hostrep.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op2_url_filter"] = r"""
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), outcome as (
  select doc_id, max(case when toxic = 1 or quality = 0 then 1 else 0 end) as bad from labels group by doc_id
), sites as (
  select host, count(bad) as n, coalesce(sum(bad), 0) as bad, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as site
  from parts left join outcome on page_id = doc_id group by host
), named as (
  select *, string_split(site, '.') as labels, regexp_matches(site, '^([0-9]+\.){3}[0-9]+$|^\[') as address from sites
), suffixed as (
  select *, case when address then site
    when len(labels) > 1 and length(labels[-1]) = 2 and list_contains(['ac', 'co', 'com', 'edu', 'go', 'gob', 'gov', 'gr', 'ltd', 'mil', 'ne', 'net', 'nhs', 'nom', 'or', 'org', 'plc', 'sch'], labels[-2]) then labels[-2] || '.' || labels[-1]
    else labels[-1] end as suffix from named
), hosts as (
  select host, n, bad, suffix,
    case when address or len(labels) <= len(string_split(suffix, '.')) + 1 then site else array_to_string(labels[-(len(string_split(suffix, '.')) + 1):], '.') end as domain
  from suffixed
), domains as (select suffix, domain, sum(n) as n, sum(bad) as bad from hosts group by suffix, domain),
suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by suffix),
total as (select case when sum(n) > 0 then sum(bad)::double / sum(n) else 0 end as mean from suffixes),
levels as (
  select 'host' as level, n, bad from hosts union all select 'domain', n, bad from domains union all select 'suffix', n, bad from suffixes
), moments as (
  select level, count(*) as g, sum(n)::double as n, sum(bad)::double / sum(n) as rate, sum(bad * bad / n::double) as squares, sum(n * n)::double as n2
  from levels where n > 0 group by level
), strengths as (
  select level, case when g < 2 or not (rate > 0 and rate < 1) or n - n2 / n <= 0 then 1000
    when squares - n * rate * rate - (g - 1) * rate * (1 - rate) <= 0 then 1000
    else least(greatest(1 / (((squares - n * rate * rate - (g - 1) * rate * (1 - rate)) / (n - n2 / n)) / (rate * (1 - rate))) - 1, 2), 1000) end as s
  from moments
), strength as (
  select coalesce(max(s) filter (level = 'host'), 1000) as sh, coalesce(max(s) filter (level = 'domain'), 1000) as sd, coalesce(max(s) filter (level = 'suffix'), 1000) as ss from strengths
), suffix_rate as (select suffix, (mean * ss + bad) / (ss + n) as rate from suffixes, total, strength),
domain_rate as (select d.suffix, d.domain, (s.rate * sd + d.bad) / (sd + d.n) as rate from domains d join suffix_rate s using (suffix), strength),
host_rate as (select h.host, h.n, (d.rate * sh + h.bad) / (sh + h.n) as rate, sh from hosts h join domain_rate d using (suffix, domain), strength),
bound as (select host, rate - 1.645 * sqrt(rate * (1 - rate) / (n + sh + 1)) as low from host_rate),
rules(rule, rule_host, rule_path, rule_verdict) as (values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
numbered as (select *, row_number() over () as row_id from parts),
fits as (
  select row_id, arg_max(rule, length(rule)) as rule, arg_max(rule_verdict, length(rule)) as rule_verdict
  from numbered join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by row_id
)
select page_id, host, path, rule, coalesce(rule_verdict, case when low > 0.3 then 'block' else 'allow' end) as verdict
from numbered join bound using (host) left join fits using (row_id)
"""


def _spans(mask: str):
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), " ")


@query
def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are chosen and rejected of pair k."""
    turns = table(spark, sf_dir, "conversations")
    turns = turns.withColumn("pair_id", F.floor(F.col("conv_id") / 2)).withColumn("side", F.pmod("conv_id", F.lit(2)).cast("int"))
    return preference.format_pairs(turns).withColumn("chosen_mask", _spans("chosen_mask")).withColumn("rejected_mask", _spans("rejected_mask"))


ORACLE_SQL["op6_preference"] = r"""
with turns as (
  select conv_id // 2 as pair_id, conv_id % 2 as side, conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text from conversations where conv_id is not null
), shown as (
  select *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as shown, row_number() over (partition by pair_id, side order by turn, role, text) as nth from turns
), spans as (
  select *, sum(length(shown)) over (partition by pair_id, side order by nth) as stop from shown
), ends as (
  select pair_id, min(conv_id) filter (side = 0) as chosen_id, min(conv_id) filter (side = 1) as rejected_id,
    least(count(*) filter (side = 0), count(*) filter (side = 1)) as both_n from spans group by pair_id
), differ as (
  select c.pair_id, min(c.nth) as nth from spans c join spans r on c.pair_id = r.pair_id and c.nth = r.nth and c.side = 0 and r.side = 1
  where c.role <> r.role or c.text <> r.text group by c.pair_id
), prefix as (
  select e.pair_id, chosen_id, rejected_id, coalesce(d.nth - 1, both_n) as n_prefix from ends e left join differ d using (pair_id)
), skip as (
  select p.*, coalesce((select max(stop) from spans s where s.pair_id = p.pair_id and s.side = 0 and s.nth = p.n_prefix), 0) as skip from prefix p
)
select k.pair_id, any_value(chosen_id) as chosen_id, any_value(rejected_id) as rejected_id, any_value(n_prefix)::bigint as n_prefix,
  coalesce(string_agg(shown, '' order by nth) filter (side = 0 and nth <= n_prefix), '') as prompt,
  coalesce(string_agg(shown, '' order by nth) filter (side = 0 and nth > n_prefix), '') as chosen,
  coalesce(string_agg(shown, '' order by nth) filter (side = 1 and nth > n_prefix), '') as rejected,
  coalesce(string_agg((stop - skip - length(text) - 8)::bigint || ':' || (stop - skip)::bigint, ' ' order by nth) filter (side = 0 and nth > n_prefix and role = 'assistant'), '') as chosen_mask,
  coalesce(string_agg((stop - skip - length(text) - 8)::bigint || ':' || (stop - skip)::bigint, ' ' order by nth) filter (side = 1 and nth > n_prefix and role = 'assistant'), '') as rejected_mask
from spans s join skip k on s.pair_id = k.pair_id group by k.pair_id
"""


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


_BASE32_SQL = "translate(" + " || ".join(f"lpad(to_base(('0x' || substr(h, {10 * k + 1}, 10))::bigint, 32), 8, '0')" for k in range(4)) + ", '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
ORACLE_SQL["op7_warc"] = f"""
with rows as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages),
firsts as (select *, min(page_id) over (partition by h) as first_id from rows)
select page_id, payload_bytes, {_BASE32_SQL} as payload_digest,
  case when page_id is not distinct from first_id then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from first_id then null else first_id end as refers_to
from firsts
"""


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projpass.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op4_embedding_dedup"] = r"""
with recursive vectors as (
  select vec_id, row_number() over () as row_id, embedding::double[] as v from embeddings
), usable as (
  select *, sqrt(list_sum([x * x for x in v])) as norm from vectors
  where vec_id is not null and len(v) > 0 and len([x for x in v if x is null or not isfinite(x)]) = 0 and list_sum([abs(x) for x in v]) > 0
), links as (
  select a.row_id as a, b.row_id as b, b.vec_id as other from usable a join usable b on a.row_id <> b.row_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
), reach as (
  select row_id as a, vec_id as other, row_id as b from usable union select r.a, l.other, l.b from reach r join links l on r.b = l.a
), lowest as (select a, min(other) as low from reach group by a),
counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(low, vec_id) as component_id, coalesce(vec_id = coalesce(low, vec_id), true) as kept
from vectors left join lowest on row_id = lowest.a left join counted on row_id = counted.a
"""


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf_dir, "pages"))


@query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's bytes: each byte is mixed in, then eight bits are shifted out."""
    steps = f"list_concat([4294967295::bigint], flatten(list_transform(range(1, octet_length(encode({text})) + 1), lambda i: [('0x' || substr(hex(encode({text})), (2 * i - 1)::bigint, 2))::bigint, -1, -1, -1, -1, -1, -1, -1, -1])))"
    return f"xor(list_reduce({steps}, lambda c, b: case when b >= 0 then xor(c, b) when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end), 4294967295::bigint)"


ORACLE_SQL["op12_resample"] = rf"""
with texts as (
  select 0 as kind, row_number() over () as row_id, doc_id, coalesce(text, '') as text from documents
  union all select 1, row_number() over (), null, coalesce(text, '') from benchmark
), worded as (
  select kind, row_id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
), used as (
  select kind, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as feature from worded
), hashed as (
  select feature, {_crc32_sql("feature")} % 10000 as bucket from (select distinct feature from used)
), counted as (
  select bucket, count(*) filter (kind = 0) as s, count(*) filter (kind = 1) as t from used join hashed using (feature) group by bucket
), gains as (
  select bucket, floor(1000 * ln(((t + 1)::double * ((select sum(s) from counted) + 10000)::double) / ((s + 1)::double * ((select sum(t) from counted) + 10000)::double))) as gain from counted
), weights as (
  select row_id, count(*) as n_features, floor(sum(gain) / count(*))::bigint as weight from used join hashed using (feature) join gains using (bucket) where kind = 0 group by row_id
), scored as (
  select doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from worded left join weights using (row_id) where kind = 0
), ranked as (
  select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls first, n_features, weight) end as nth from scored
)
select doc_id, n_features, weight, score, case when nth <= (select count(*) * 25 // 100 from scored where n_words >= 20) then nth end::bigint as rank from ranked
"""


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def _leaf_sql(text: str) -> str:
    sized = lambda c: f"coalesce(octet_length(encode({c}))::varchar || ':' || {c}, '-')"
    return "sha256(" + " || ".join([sized("doc_id::varchar"), sized("source"), sized("lang"), sized("n_chars::varchar"), sized(text)]) + ")"


ORACLE_SQL["op13_merkle"] = f"""
with recursive leaves as (
  select row_number() over () as row_id, doc_id, source, {_leaf_sql("text")} as leaf,
    case when {_crc32_sql("coalesce(doc_id::varchar, '')")} % 5 = 0 and doc_id is not null then {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as forged
  from documents
), placed as (
  select *, dense_rank() over (order by source nulls first) - 1 as g, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from leaves
), nodes(g, level, pos, n, digest) as (
  select g, 0, pos, n, leaf from placed
  union all select g, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by pos)) from nodes where n > 1 group by g, level, pos // 16, n
), subroots as (
  select g, digest as subroot, count(*) over () as groups from nodes where n = 1
), above(level, pos, n, digest) as (
  select 0, g, groups, subroot from subroots
  union all select level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by pos)) from above where n > 1 group by level, pos // 16, n
), every as (
  select g, level, pos, n, digest from nodes where n > 1 union all select -1, level, pos, n, digest from above where n > 1
), sides as (
  select g, level, pos,
    coalesce(string_agg(digest, '') over (partition by g, level, pos // 16 order by pos rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(digest, '') over (partition by g, level, pos // 16 order by pos rows between 1 following and unbounded following), '') as after
  from every
), steps as (
  select row_id, row_number() over (partition by row_id order by own desc, level) as nth, before, after from (
    select row_id, 1 as own, level, before, after from placed p join sides s on s.g = p.g and s.pos = p.pos >> (4 * level)::bigint
    union all select row_id, 0, level, before, after from placed p join sides s on s.g = -1 and s.pos = p.g >> (4 * level)::bigint
  )
), fold(row_id, nth, forged) as (
  select row_id, 0::bigint, coalesce(forged, leaf) from placed
  union all select f.row_id, f.nth + 1, sha256(s.before || f.forged || s.after) from fold f join steps s on f.row_id = s.row_id and s.nth = f.nth + 1
), folded as (
  select row_id, arg_max(forged, nth) as folded_root from fold group by row_id
), proofs as (
  select row_id, string_agg(before || after, '' order by nth) as proof from steps group by row_id
)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = root as verified
from placed join subroots using (g) join folded using (row_id) left join proofs using (row_id), (select digest as root from above where n = 1)
"""
