"""The registered queries of the operators, with production parameters over
their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (chat_repair, chunk_dedup, ctw, dart_minhash, hilbert_shard, ipf_mix, lang_hdc, line_clean,
                         packing, secret_scan, suffix_dedup, topk_nra, zone_negatives)
from terrace.llm.common import on_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Vocabulary files of public tokenizers.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Target weights of the mixture; values without one keep their share.
SOURCES = {f"src{i}": 1.0 for i in range(20)}
LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
TOPICS = {"prose": 0.7, "table": 0.1, "code": 0.1, "contact": 0.1}
MIX = {"source": SOURCES, "lang": LANGUAGES, "topic": TOPICS}


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def remainder(column: str, parts: int) -> Column:
    """crc32 of an integer's decimal digits, modulo ``parts``."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % parts


def topic(text: Column) -> Column:
    """The form of a text stands for its topic: the tables have no topic column."""
    return (F.when(text.contains("|"), "table").when(text.contains("="), "code")
            .when(text.contains("@"), "contact").otherwise("prose"))


def mix_dims() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}


def _hilbert_sql(bits: int, dims: int) -> str:
    """CTEs c0, c1, ... that turn bins x0, x1, ... of ``bins`` into an index."""
    names = [f"x{i}" for i in range(dims)]
    steps, last = [], "bins"

    def step(**new: str) -> None:
        nonlocal last
        fields = ", ".join(f"{new.get(n, n)} as {n}" for n in [*names, "flip"])
        steps.append(f"c{len(steps)} as (select * exclude ({', '.join(names)}, flip), {fields} from {last})")
        last = f"c{len(steps) - 1}"

    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        step(x0=f"case when x0 & {q} <> 0 then xor(x0, {low}) else x0 end")
        for n in names[1:]:
            step(x0=f"case when {n} & {q} <> 0 then xor(x0, {low}) else xor(x0, xor(x0, {n}) & {low}) end",
                 **{n: f"case when {n} & {q} <> 0 then {n} else xor({n}, xor(x0, {n}) & {low}) end"})
    for a, n in zip(names, names[1:]):
        step(**{n: f"xor({n}, {a})"})
    for b in range(bits - 1, 0, -1):
        step(flip=f"case when {names[-1]} & {1 << b} <> 0 then xor(flip, {(1 << b) - 1}) else flip end")
    index = " + ".join(f"(((xor({n}, flip) >> {b}) & 1) << {b * dims + dims - 1 - i})" for b in range(bits) for i, n in enumerate(names))
    return ",\n".join(steps) + f",\ncurve as (select *, {index} as hilbert from {last})"


def _crc_step(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)  # the polynomial of CRC-32
    return byte


def _bins_sql(i: int, value: str) -> str:
    return f"""v{i} as (select {value} as v, count(*) as n from documents where {value} is not null group by 1),
b{i} as (select v, floor((coalesce(sum(n) over (order by v rows between unbounded preceding and 1 preceding), 0) + n * 0.5e0)
         / (sum(n) over ()) * 64e0)::bigint as bin from v{i})"""


_CHARS = "lpad(length(coalesce(text, ''))::varchar, 12, '0')"
_HILBERT_ORACLE = f"""
with crc as (select {[_crc_step(i) for i in range(256)]}::bigint[] as t),
{_bins_sql(0, 'lang')}, {_bins_sql(1, 'source')}, {_bins_sql(2, _CHARS)},
d as (select *, {_CHARS} as chars, coalesce(text, '') as raw from documents),
bins as (select d.doc_id, d.raw, coalesce(b0.bin, 0) as x0, coalesce(b1.bin, 0) as x1, coalesce(b2.bin, 0) as x2, 0::bigint as flip
         from d left join b0 on b0.v = d.lang left join b1 on b1.v = d.source left join b2 on b2.v = d.chars),
{_hilbert_sql(6, 3)},
r as (select *, row_number() over (order by hilbert, md5(raw), doc_id) - 1 as k, count(*) over () as total from curve),
s as (select *, (k * 40 // total)::integer as shard from r)
select doc_id, octet_length(encode(raw)) + 16 as size,
  xor(list_reduce(list_transform(regexp_extract_all(hex(encode(raw)), '..'), lambda x: ('0x' || x)::bigint),
    lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as text_crc32,
  'rows' as law, shard, k - (shard * total + 39) // 40 as slot, null::integer as grown_shard, hilbert from s, crc"""


@query("op1_hilbert_shards", _HILBERT_ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {"lang": F.col("lang"), "source": F.col("source"),
            "chars": F.lpad(F.length(F.coalesce(F.col("text"), F.lit(""))).cast("string"), 12, "0")}
    out = hilbert_shard.hilbert_shards(documents(spark, sf_dir), dims, 40)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


@query("op2_context_trees")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(documents(spark, sf_dir), remainder("doc_id", 5) == 1)


@query("op3_ipf_mixture")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ipf_mix.mix_weights(documents(spark, sf_dir), MIX, mix_dims(), reach=True)


_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


@query("op4_chunk_recipes", f"""
with d as (select doc_id, length(coalesce(text, '')) as points, sha256({_NORMAL}) as text_sha256 from documents),
g as (select *, first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
      count(*) over (partition by text_sha256) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(documents(spark, sf_dir)).drop("text_hash")


@query("op5_dart_minhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_classes(documents(spark, sf_dir)).drop("text_hash")


@query("op6_mixture_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), WORD_BPE).drop("ids")


@query("op7_token_efficiency")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(documents(spark, sf_dir), BYTE_BPE)
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@query("op8_suffix_repeats")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir), kept_bytes=True)
    # a removed byte run may end inside a character
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


@query("op9_language_profiles")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    docs = documents(spark, sf_dir)
    return lang_hdc.identify(docs.withColumn("held_out", held), ~held, keep=["doc_id", "held_out"])


@query("op10_nra_top_k", """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
           where embedding is not null and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
q as (select * from v where vec_id % 100 = 0),
s as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.v::double[], v.v::double[])::bigint as score
      from q join v on q.vec_id <> v.vec_id and len(q.v) = len(v.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_nra.top_k(vectors, F.col("vec_id") % 100 == 0)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SYMBOLS, _LINE_SYMBOLS, _SEPARATORS, _NAVIGATION, _BOILERPLATE, _CLOSING = map(_quoted, (
    line_clean.SYMBOLS, line_clean.LINE_SYMBOLS, line_clean.SEPARATORS, line_clean.NAVIGATION, line_clean.BOILERPLATE,
    line_clean.CLOSING))
_TERMINAL = ", ".join(map(_quoted, line_clean.TERMINAL))
_LINES_ORACLE = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as raw from documents),
w as (select r, regexp_extract_all(raw, '[^\x20\x09-\x0D]+') as w from d),
g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
      from (select r, w, unnest(range(1, len(w) - 1)) as i from w where len(w) > 2)),
h as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
rep as (select r, count(*) as n_repeat_words from (select distinct r, unnest([i, i + 1, i + 2]) from h) group by r),
l as (select r, line, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) as t
      from (select r, unnest(string_split(raw, chr(10))) as line from d)),
m as (select r, line, t, length(t) - length(replace(t, ' ', '')) + 1 as n, length(replace(t, ' ', '')) as chars,
        length(t) - length(regexp_replace(t, {_SEPARATORS}, '', 'g')) as seps,
        length(t) - length(regexp_replace(t, {_LINE_SYMBOLS}, '', 'g')) as signs from l where t <> ''),
j as (select *, case when regexp_matches(t, {_NAVIGATION}) or (seps >= 2 and n <= 4 * (seps + 1)) then 'navigation'
        when n <= 25 and regexp_matches(t, {_BOILERPLATE}) then 'boilerplate'
        when right(rtrim(t, {_CLOSING}), 1) not in ({_TERMINAL}) or 10 * signs > chars then 'punctuation' end as rule from m),
k as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
        {', '.join(f"count(*) filter (rule = '{x}') as n_{x}" for x in line_clean.RULES)},
        coalesce(sum(chars) filter (rule is not null), 0)::bigint as lost_chars from j group by r),
a as (select doc_id, len(w.w)::bigint as n_words, length(array_to_string(w.w, ''))::bigint as word_chars,
        (length(raw) - length(regexp_replace(raw, {_SYMBOLS}, '', 'g')))::bigint as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
        {', '.join(f"coalesce(n_{x}, 0) as n_{x}" for x in line_clean.RULES)}, coalesce(lost_chars, 0) as lost_chars
      from d join w using (r) left join rep using (r) left join k using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from a)
select *, not base_failed and 100 * lost_chars <= 30 * word_chars as kept from b"""


@query("op11_line_rules", _LINES_ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_clean.clean_lines(documents(spark, sf_dir)).drop("cleaned")


def _edit(label: str, cost: str, letter: str, line: str | None = None) -> str:
    """A label of the repair's recursion after one more edit."""
    text = f"list_append({label}.t, {line})" if line else f"{label}.t"
    return f"(case when {label} is not null then {{'c': {label}.c + {cost}, 'a': {label}.a || '{letter}', 't': {text}}} end)"


def _least(*labels: str) -> str:
    return f"list_min([{', '.join(labels)}])"


def _inserted(source: str) -> str:
    """Labels of all states after insertions before a row (or at the end)."""
    user = _least("s2", *(_edit(s, "3", "I", "'user:'") for s in ("s0", "s1", "s3")))
    return f"(select * exclude (s2, s3), u as s2, {_least('s3', _edit('u', '3', 'I', chr(39) + 'assistant:' + chr(39)))} as s3 from (select *, {user} as u from {source}))"


def _read(initial: str, state: str, role: str) -> str:
    return f"case when k = '{initial}' then {_edit(state, 'm', 'K', 'line')} else {_edit(state, '(3 + m)', 'R', chr(39) + role + ':' + chr(39) + ' || text')} end"


_REPAIR_ORACLE = f"""
with recursive crc as (select {[_crc_step(i) for i in range(256)]}::bigint[] as t),
c as (select *, coalesce(conv_id::varchar, ' ') as conv, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
h as (select c.* exclude (k), xor(list_reduce(list_transform(regexp_extract_all(hex(encode(k)), '..'), lambda x: ('0x' || x)::bigint),
        lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 20 as hit from c, crc),
d as (select conv, turn, case when hit = 4 then 'user' else coalesce(role, ' ') end as role,
        case hit when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text,
        unnest(range(case when hit = 3 then 2 else 1 end)) from h where hit <> 0),
o as (select *, row_number() over (partition by conv order by turn nulls first, role, text) as i from d),
f as (select conv, turn, role, text, i, left(role, 1) as k, role || ':' || text as line,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare, row_number() over (partition by conv, role, text order by i) > 1 as again,
        lag(left(role, 1)) over (partition by conv order by i) || left(role, 1) not in ('su', 'ua', 'au') as wrong from o),
e as (select *, case when bare = '' then 'blank' when again then 'duplicate' when right(bare, 1) not in ('.', '!', '?') then 'truncated' end as fault,
        case when bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') then 3 else 0 end as m from f),
p as (select conv, 0::bigint as i, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as s0, null::struct(c bigint, a varchar, t varchar[]) as s1,
        null::struct(c bigint, a varchar, t varchar[]) as s2, null::struct(c bigint, a varchar, t varchar[]) as s3 from (select distinct conv from e)
      union all
      select q.conv, e.i, {_edit('s0', '4', 'D')},
        {_least(_edit('s1', '4', 'D'), f"case when ok and k = 's' then {_edit('s0', 'm', 'K', 'line')} end")},
        {_least(_edit('s2', '4', 'D'), *(f"case when ok then {_read('u', s, 'user')} end" for s in ('s0', 's1', 's3')))},
        {_least(_edit('s3', '4', 'D'), f"case when ok then {_read('a', 's2', 'assistant')} end")}
      from {_inserted('p')} q join (select *, fault is null or fault = 'truncated' as ok from e) e on e.conv = q.conv and e.i = q.i + 1),
z as (select conv, {_least('s0', 's3')} as s from {_inserted('(select *, max(i) over (partition by conv) as top from p)')} where i = top),
r as (select conv, case when count(turn) = 0 then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated, count(*) filter (wrong) as illegal from e group by conv)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(s.c, 0) as cost, coalesce(s.a, '') as audit,
  sha256(coalesce(array_to_string(s.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id, conv from c) left join r using (conv) left join z using (conv)"""


@query("op12_chat_repair", _REPAIR_ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


_NEGATIVES_ORACLE = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
           where embedding is not null and vec_id is not null and label is not null
             and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select a.vec_id as anchor_id, a.label = v.label as same, v.vec_id as id, list_inner_product(a.v, v.v)::bigint as score
      from (select * from v where vec_id % 100 = 0) a join v on a.vec_id <> v.vec_id and len(a.v) = len(v.v)),
p as (select anchor_id, id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (select p.*, s.id as negative_id, s.score as negative_score,
        row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id)::integer as rank
      from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * positive_score <= 100 * s.score and s.score <= positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5"""


@query("op13_zone_negatives", _NEGATIVES_ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return zone_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
