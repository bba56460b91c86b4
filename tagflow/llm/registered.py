"""Registered queries of the text operators: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagflow.llm import backoff, chat, decontaminate, jaccard, langid, merkle, mixing, quality, secrets, sentences, shards, surrogates, trie
from tagflow.llm.common import UPPER

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def load() -> dict:
    return REGISTRY


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_STOPS = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)


def _rules_sql(rules=quality.RULES) -> str:
    tests = [f"{n} >= {a}" for n, a, _ in rules if a is not None] + [f"{n} <= {b}" for n, _, b in rules if b is not None]
    return " and ".join(tests)


_QUALITY_SQL = rf"""
with t as (
  select doc_id, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
c as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         len(list_filter(w, lambda x: lower(x) in ({_STOPS})))::bigint as n_stop,
         len(l)::bigint as n_lines, w, row_number() over () as r
  from t),
g as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(generate_series(1, len(w) - 2)) as i from c where len(w) > 2)),
rep as (
  select r, count(distinct j)::bigint as n from (
    select r, unnest([i, i + 1, i + 2]) as j from (select r, i, count(*) over (partition by r, g) as k from g) where k > 1)
  group by r),
m as (
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words, n_stop, n_lines,
         case when n_words > 0 then word_chars / n_words else 0.0 end as mean_word_chars,
         case when n_words > 0 then n_symbols / n_words else 0.0 end as symbol_ratio,
         case when n_words > 0 then n_stop / n_words else 0.0 end as stop_ratio,
         case when n_lines > 0 then n_dup_lines / n_lines else 0.0 end as dup_line_ratio,
         case when n_lines > 0 then n_words / n_lines else 0.0 end as words_per_line
  from c left join rep on c.r = rep.r)
select *, (n_words < 50 or n_repeat_words * 100 > n_words * 50) as base_failed,
       not (n_words < 50 or n_repeat_words * 100 > n_words * 50) and {_rules_sql()} as kept
from m"""


@query("op1_quality_rules", _QUALITY_SQL)
def op1(spark, sf):
    return quality.assess(table(spark, sf, "documents"))


_DECONTAMINATE_SQL = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w, row_number() over () as r
  from documents),
b as (
  select item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark),
bw as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as g
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from b where len(w) > 0)),
dw as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as i
        from w, (select distinct n from bw) where len(w) >= n)),
h as (select distinct dw.r, dw.i, dw.n, bw.item_id from dw join bw on dw.n = bw.n and dw.g = bw.g),
x as (select r, count(distinct j) as n_hit from (select r, unnest(generate_series(i, i + n - 1)) as j from h) group by r),
y as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
      from h group by r)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from w left join x on w.r = x.r left join y on w.r = y.r"""


@query("op7_benchmark_decontamination", _DECONTAMINATE_SQL)
def op7(spark, sf):
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op9_mixing_sources")
def op9(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


@query("op2_language_id")
def op2(spark, sf):
    docs = table(spark, sf, "documents")
    return langid.identify(docs, langid.train(docs)).select("doc_id", "held_out", "lang_pred", "score")


@query("op4_secret_scan")
def op4(spark, sf):
    docs = table(spark, sf, "documents")
    spans = F.col("spans")
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    return secrets.scan(docs, secrets.train(docs)).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(F.filter(spans, lambda x: x["kind"] != "crf")), 256).alias("base_sha256"),
        joined(spans).alias("spans"), count("crf").alias("n_added"),
    )


@query("op6_ngram_jaccard_join")
def op6(spark, sf):
    return jaccard.join(table(spark, sf, "documents")).select("doc_id", "class_id", "n_links")


@query("op5_substring_dedup")
def op5(spark, sf):
    return sentences.dedup(table(spark, sf, "documents"))


@query("op8_surrogates")
def op8(spark, sf):
    return surrogates.replace(table(spark, sf, "documents"))


_BACKOFF_SQL = r"""
with t as (
  select row_number() over () as r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
w as (select r, unnest(w) as w, generate_subscripts(w, 1) as i from t),
b as (select r, i, w, lag(w) over (partition by r order by i) as u, lag(w, 2) over (partition by r order by i) as v from w),
c1 as (select w, count(*) as c from w group by w),
c2 as (select u, w, count(*) as c from b where u is not null group by u, w),
c3 as (select v, u, w, count(*) as c from b where v is not null group by v, u, w),
n as (select count(*) as n from w),
s1 as (select w, c, ln(greatest(c - 1, 1) / greatest(n.n - 1, 1)) as s from c1, n),
s2 as (select c2.u, c2.w, c2.c, case when c2.c > 1 then ln((c2.c - 1) / (y.c - 1)) else ln(0.4) + x.s end as s
       from c2 join s1 x on c2.w = x.w join s1 y on c2.u = y.w),
s3 as (select c3.v, c3.u, c3.w, c3.c, case when c3.c > 1 then ln((c3.c - 1) / (y.c - 1)) else ln(0.4) + x.s end as s
       from c3 join s2 x on c3.u = x.u and c3.w = x.w join s2 y on c3.v = y.u and c3.u = y.w),
s as (
  select b.r, case when b.v is not null then s3.s when b.u is not null then s2.s else s1.s end as s,
         case when b.v is not null then s3.c = 1 when b.u is not null then s2.c = 1 else false end as off
  from b join s1 on b.w = s1.w left join s2 on b.u = s2.u and b.w = s2.w left join s3 on b.v = s3.v and b.u = s3.u and b.w = s3.w),
a as (select r, sum(s) as s, sum(off::int) as off from s group by r)
select doc_id, len(t.w)::bigint as n_words, coalesce(off, 0)::bigint as n_backed_off, round(coalesce(s, 0), 4) as log_score,
       case when len(t.w) > 0 then round(s / len(t.w), 4) end as mean_log_score
from t left join a on t.r = a.r"""


@query("op10_lm_scoring", _BACKOFF_SQL)
def op10(spark, sf):
    return backoff.score(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_backed_off", F.round("log_score", 4).alias("log_score"),
        F.round("mean_log_score", 4).alias("mean_log_score"),
    )


TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_CHAT_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f as (
  select *, length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t'))
            + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c')) + 14 as n from c)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
       sum(n)::bigint as formatted_chars
from f group by conv_id"""


@query("op3_chat_format", _CHAT_SQL)
def op3(spark, sf):
    odd = "\\### Assistant: </turn> ok"
    own = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"),
    )
    nodes, members = chat.forest(own.unionByName(extra), TOKENIZER)
    return chat.read_back(nodes, members, TOKENIZER)


# The unsigned checksum of a decimal, byte by byte over its table.
_CRC_SQL = """crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as k)"""


def _crc_column(text: str, table: str = "k") -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda d: ord(d)::bigint)),
  lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)"""


def _merkle_levels(name: str, levels: int) -> str:
    """{name}0 (g, p, n, d) to the levels above, and the siblings of each, b and a."""
    out = []
    for i in range(levels):
        at, up = f"{name}{i}", f"{name}{i + 1}"
        out.append(f"""{at}s as (select *, string_agg(d, '') over (partition by g, p // 16 order by p rows between unbounded preceding and 1 preceding) as b,
  string_agg(d, '') over (partition by g, p // 16 order by p rows between 1 following and unbounded following) as a from {at})""")
        out.append(f"""{up} as (select g, p // 16 as p, (max(n) + 15) // 16 as n,
  case when max(n) = 1 then min(d) else sha256(string_agg(d, '' order by p)) end as d from {at} group by g, p // 16)""")
    return ",\n".join(out)


_IN, _TOP = 5, 3
_PART = lambda c, v=None: f"coalesce(strlen({v or c}::varchar)::varchar || ':' || {v or c}::varchar, '-')"
_LEAF = lambda text: "sha256(" + " || ".join([*map(_PART, ("doc_id", "source", "lang", "n_chars")), _PART("text", text)]) + ")"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_fold = lambda d, levels, of: f"case when {of}{levels}.n > 1 then sha256(coalesce({of}{levels}.b, '') || {d} || coalesce({of}{levels}.a, '')) else {d} end"


def _merkle_sql() -> str:
    joins, folds, proof, last = [], [], [], "f"
    for i in range(_IN):
        joins.append(f"join s{i}s as s{i} on s{i}.g is not distinct from l.g and s{i}.p = l.p // {16 ** i}")
        proof.append(f"case when s{i}.n > 1 then coalesce(s{i}.b, '') || coalesce(s{i}.a, '') else '' end")
        folds.append(f"{_fold(last, i, 's')} as f{i}")
        last = f"f{i}"
    joins.append("join top on top.g is not distinct from l.g")
    for i in range(_TOP):
        joins.append(f"join t{i}s as t{i} on t{i}.p = top.p // {16 ** i}")
        proof.append(f"case when t{i}.n > 1 then coalesce(t{i}.b, '') || coalesce(t{i}.a, '') else '' end")
        folds.append(f"{_fold(last, i, 't')} as u{i}")
        last = f"u{i}"
    return f"""with {_CRC_SQL},
doc as (select doc_id, source, {_LEAF('text')} as leaf,
  case when {_crc_column('doc_id::varchar')} % 5 = 0 then {_LEAF(_LOWER)} else {_LEAF('text')} end as f from documents, crc_table),
l as (select *, source as g, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p, count(*) over (partition by source) as n from doc),
s0 as (select g, p, n, leaf as d from l),
{_merkle_levels('s', _IN)},
top as (select g, d, row_number() over (order by g nulls first) - 1 as p, count(*) over () as n from s{_IN}),
t0 as (select 0 as g, p, n, d from top),
{_merkle_levels('t', _TOP)},
x as (select l.doc_id, l.leaf, top.d as subroot, sha256({' || '.join(proof)}) as proof_sha256, {', '.join(folds)} from l {' '.join(joins)})
select doc_id, leaf, subroot, (select d from t{_TOP}) as root, proof_sha256, {last} as folded_root, {last} = (select d from t{_TOP}) as verified from x"""


@query("op12_merkle_manifest", _merkle_sql())
def op12(spark, sf):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    text = F.when(tampered, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    rows = merkle.prove(table(spark, sf, "documents"), merkle.leaf({"text": text}))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified"
    )


@query("op13_sharding")
def op13(spark, sf):
    rows = shards.assign(table(spark, sf, "documents"))
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


_TRIE_SQL = f"""with {_CRC_SQL},
t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id
  order by turn nulls first, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as place
  from conversations where conv_id is not null),
c as (select conv_id, {_crc_column('conv_id::varchar')} % 9 as h from (select distinct conv_id from t), crc_table),
r as (select c.conv_id, t.place, t.role, t.text from c join t on t.conv_id = c.conv_id - c.conv_id % 5 and t.place <= c.h
  union all select t.conv_id, t.place, t.role, t.text from c join t on t.conv_id = c.conv_id and t.place > c.h),
s as (select c.conv_id, coalesce(list(sha256(strlen(r.role)::varchar || ':' || r.role || r.text) order by r.place) filter (r.place is not null), []) as w,
  coalesce(list(strlen(r.text) order by r.place) filter (r.place is not null), []) as sizes from c left join r on r.conv_id = c.conv_id group by c.conv_id),
m as (select conv_id, len(w) as n, d, array_to_string(w[1:d], '') as k, case when d > 0 then array_to_string(w[1:d - 1], '') end as up,
  case when d > 0 then sizes[d] else 0 end as size from (select *, unnest(generate_series(0, len(w))) as d from s)),
n as (select k, any_value(d) as depth, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
  string_agg(conv_id::varchar, ',' order by conv_id) filter (m.n = d) as ends from m group by k),
f as (select n.*, coalesce(n_children, 0) as n_children, (n.n_convs - 1) * n.size as saved from n
  left join (select up as k, count(*) as n_children from n where up is not null group by up) using (k)),
b as (select distinct a.k as top, z.k as k from m a join m z on a.conv_id = z.conv_id and a.d <= z.d),
v as (select top as k, count(*) filter (f.n_children = 0) as n_leaves, sum(f.saved) as saved_tokens from b join f using (k) group by top)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, v.n_leaves, v.saved_tokens::bigint as saved_tokens,
  sha256(coalesce(f.ends, '')) as ends_sha256 from f join v using (k) left join f p on p.k = f.up"""


@query("op11_conversation_trie", _TRIE_SQL)
def op11(spark, sf):
    return trie.prefix_trie(trie.chains(*trie.rebuilt(table(spark, sf, "conversations")))).drop("node")
