"""The queries of the corpus operators over whole tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, exact_dedup, lang_id, minhash, resharding, secrets, suffix_dedup, url_filter
from .common import documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the labelled documents that are not held out; every whole text is predicted."""
    docs = documents(spark, sf_dir)
    return lang_id.predict(docs, lang_id.train(docs))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a similarity of 0.8 or more."""
    return minhash.near_duplicates(documents(spark, sf_dir), width=4, threshold=80)


def op3_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every text encoded by the public 50k byte-level ranks, and its ids decoded again."""
    return bpe_digests(documents(spark, sf_dir), path)


def bpe_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with the benchmark items that one of its passages holds."""
    found = decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), F.array_join(ids.cast("array<string>"), ",").alias("item_ids"), F.coalesce(F.round(F.array_max(F.transform("hits", lambda h: h["score"])), 6), F.lit(0.0)).alias("best_score"),
    )


def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of even bytes out of the input files; the rows are read back from the new shards, or old ones that stay."""
    written, _, _ = resharding.rewrite(documents(spark, sf_dir), 40)
    text = F.col("row.text")
    return written.select(
        F.col("row.doc_id").alias("doc_id"), resharding.row_size(text).alias("size"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"), F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


#: A conversation whose texts hold control strings.
ODD_CONVERSATION = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def op6_chat_format(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rows = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(ODD_CONVERSATION, rows.schema))
    back = chat.read_back(chat.format_conversations(rows, tokenizer))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


_OP6_SQL = r"""
with r as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s as (select *, len(text) + len(regexp_extract_all(text, '\\|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) as chars from r)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then len(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
  sum(chars + len(role) + 24)::bigint as formatted_chars
from s group by conv_id
"""


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 50-byte strings of documents with smaller ids are removed."""
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir), length=50)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


_OP8_SQL = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as folded from documents)
select doc_id, max(doc_id) over (partition by folded) as keep_id, count(*) over (partition by folded) as group_size,
  doc_id = max(doc_id) over (partition by folded) as kept, sha256(folded) as text_sha256
from t
"""


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pages: the label of a page is that of the document of the same number, bad if toxic or of low quality."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    return documents(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(documents(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir)).drop("bad_bound")


_OP10_SQL = r"""
with p as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
hosts0 as (select distinct host, string_split(host, '.') as labels from p),
hosts1 as (select host, labels, case when array_to_string(labels[-2:], '.') in ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'co.nz', 'com.br', 'co.in') then array_to_string(labels[-2:], '.') else labels[-1] end as suffix from hosts0),
hosts as (select host, suffix, array_to_string(labels[-(len(string_split(suffix, '.')) + 1):], '.') as domain from hosts1),
seen as (select p.host, case when toxic = 1 or quality = 0 then 1 when toxic is null or quality is null then null else 0 end as bad from p join labels l on p.page_id = l.doc_id where p.host <> ''),
h as (select host, any_value(domain) as domain, any_value(suffix) as suffix, count(*) as n, sum(bad) as bad from seen join hosts using (host) where bad is not null group by host),
d as (select domain, suffix, sum(n) as n, sum(bad) as bad from h group by domain, suffix),
s as (select suffix, sum(n) as n, sum(bad) as bad from d group by suffix),
c as (select coalesce(sum(bad), 0) + 0.5::double as a, coalesce(sum(n), 0) - coalesce(sum(bad), 0) + 0.5::double as b from s),
sp as (select suffix, 10 * a / (a + b) + bad as a, 10 * b / (a + b) + n - bad as b from s, c),
dk as (select suffix, count(*) as k, avg(bad / n) as m, var_samp(bad / n) as v from d group by suffix),
ds as (select suffix, case when k > 1 and v > 0 then least(greatest(m * (1 - m) / v - 1, 1), 100) else 10 end as st from dk),
dp as (select d.domain, st * sp.a / (sp.a + sp.b) + d.bad as a, st * sp.b / (sp.a + sp.b) + d.n - d.bad as b from d join ds using (suffix) join sp using (suffix)),
hk as (select suffix, count(*) as k, avg(bad / n) as m, var_samp(bad / n) as v from h group by suffix),
hs as (select suffix, case when k > 1 and v > 0 then least(greatest(m * (1 - m) / v - 1, 1), 100) else 10 end as st from hk),
hp as (select h.host, st * dp.a / (dp.a + dp.b) + h.bad as a, st * dp.b / (dp.a + dp.b) + h.n - h.bad as b from h join hs using (suffix) join dp using (domain)),
k as (select x.host, coalesce(hp.a, dp.a, sp.a, c.a) as a, coalesce(hp.b, dp.b, sp.b, c.b) as b
  from hosts x left join hp on x.host = hp.host left join dp on x.domain = dp.domain left join sp on x.suffix = sp.suffix, c),
r as (select p.*, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound,
  case when (p.host = 'example.com' or p.host like '%.example.com') and starts_with(path, '/en/7') then 'example.com/en/7'
    when (p.host = 'example.net' or p.host like '%.example.net') and starts_with(path, '/de/8') then 'example.net/de/8'
    when (p.host = 'com' or p.host like '%.com') and starts_with(path, '/en/') then 'com/en/'
    when (p.host = 'net' or p.host like '%.net') and starts_with(path, '/de/') then 'net/de/'
    when (p.host = 'org' or p.host like '%.org') and starts_with(path, '/es/') then 'org/es/' end as rule
  from p join k using (host))
select page_id, host, path, rule,
  case when rule in ('com/en/', 'example.net/de/8', 'org/es/') then 'block' when rule is not null then 'allow' when bound > 0.25 then 'block' else 'allow' end as verdict
from r
"""

def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(secrets.written(F.col("base")).cast("binary"), 256).alias("base_sha256"), secrets.written(F.concat("base", "added")).alias("spans"),
    )


def _sql_matches(name: str, pattern: str, group: int = 0) -> str:
    """CTE of (doc_id, row, start, end, value): pieces between matches and matches alternate."""
    p = pattern.replace("'", "''")
    return f"""{name}_m as (select r, doc_id, string_split_regex(text, '{p}') as g, regexp_extract_all(text, '{p}') as w, regexp_extract_all(text, '{p}', {group}) as v from d where regexp_matches(text, '{p}')),
{name}_l as (select r, doc_id, len(g[i]) as gap, len(w[i]) as wide, v[i] as value, i from (select *, unnest(range(1, len(w) + 1)) as i from {name}_m)),
{name} as (select r, doc_id, (sum(gap + wide) over (partition by r order by i) - wide)::bigint as s, (sum(gap + wide) over (partition by r order by i))::bigint as e, value from {name}_l)"""


_SQL_ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: In SQL groups aren't possessive.
_SQL_ALLOWED = "|".join(f"(?:{p})" for p in secrets.ALLOWED).replace("++", "+").replace("}+", "}")
_SQL_CLASS = "case " + " ".join(f"when regexp_matches(value, '{p}') then {least}" for _, p, least in secrets.CLASSES) + " end"
_OP9_SQL = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
{_sql_matches("a", _SQL_ASSIGN, 1)},
{_sql_matches("k", secrets.ACCESS)},
{_sql_matches("h", secrets.HEX)},
{_sql_matches("c", secrets.CANDIDATE)},
base as (select r, s, e, 0 as kind from a where len(value) >= 12 union all select r, s, e, 1 from k union all select r, s, e, 2 from h),
rest as (select c.*, {_SQL_CLASS} as least from c where not exists (select 1 from base b where b.r = c.r and b.s < c.e and c.s < b.e) and not regexp_matches(value, '{_SQL_ALLOWED}')),
added as (select r, s, e, 3 as kind from rest where least < 99 and list_max(list_transform(range(1, len(value) - {secrets.WINDOW} + 2), lambda i: list_entropy(string_split(substr(value, i, {secrets.WINDOW}), '')))) >= least),
spans as (select *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e as w from (select * from base union all select * from added)),
g as (select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex, coalesce(string_agg(w, ',' order by s, kind) filter (kind < 3), '') as b, string_agg(w, ',' order by s, kind) as spans from spans group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(b, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (r)
"""

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_bpe": op3_bpe,
    "op4_decontamination": op4_decontamination,
    "op5_resharding": op5_resharding,
    "op6_chat_format": op6_chat_format,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_url_filter": op10_url_filter,
}
ORACLE_SQL = {
    "op6_chat_format": _OP6_SQL,
    "op8_exact_dedup": _OP8_SQL,
    "op9_secret_scan": _OP9_SQL,
    "op10_url_filter": _OP10_SQL,
}
