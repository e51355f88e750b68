"""Queries by name, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunk, clean, embed, extract, index, layout, retrieve
from ..operators import tables as tab
from ..sinks import results
from ..storage import settled
from . import tables as data

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_LINES = "lines as (select doc_id, generate_subscripts(ls, 1) - 1 as line_no, unnest(ls) as line from (select doc_id, string_split(text, chr(10)) as ls from documents))"
_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "]"


def _terms(x: str) -> str:
    found = f"regexp_extract_all(lower({x}), '[a-z0-9]+(?:[-_./][a-z0-9]+)*')"
    return f"list_filter(flatten(list_transform({found}, lambda t: case when regexp_matches(t, '[-_./]') then list_prepend(t, string_split_regex(t, '[-_./]')) else [t] end)), lambda t: not list_contains({_STOP}, t))"


# ---- text functions -----------------------------------------------------------


@query(f"select doc_id, len({_terms('text')})::bigint as n_terms, md5(array_to_string({_terms('text')}, ' ')) as terms_md5 from documents")
def tokenize_terms(spark, sf_dir):
    found = data.read(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("terms"))
    return found.select("doc_id", F.size("terms").cast("bigint").alias("n_terms"), F.md5(F.array_join("terms", " ").cast("binary")).alias("terms_md5"))


@query(r"select doc_id, coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z]+|\p{Nd}+|[^\p{L}\p{N}_\s]'), lambda t: greatest(1, ceil(len(t) / 3.2)))), 0)::bigint as cost from documents")
def token_cost(spark, sf_dir):
    return data.read(spark, sf_dir, "documents").select("doc_id", T.token_cost(F.col("text")).alias("cost"))


@query(r"""with s as (select doc_id, list_filter(string_split_regex(regexp_replace(text, '([.!?;])\s+', '\1' || chr(1), 'g'), '\x01|\n+'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13)) <> '') as ss from documents)
select doc_id, len(ss)::bigint as n_sentences, md5(array_to_string(ss, chr(10))) as sentences_md5 from s""")
def sentence_split(spark, sf_dir):
    found = data.read(spark, sf_dir, "documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    return found.select("doc_id", F.size("s").cast("bigint").alias("n_sentences"), F.md5(F.array_join("s", "\n").cast("binary")).alias("sentences_md5"))


@query(f"with {_LINES} select doc_id, line_no::int as line_no, regexp_replace(lower(trim(line, ' ' || chr(9) || chr(13))), '[0-9]+', '#', 'g') as signature from lines")
def line_signature(spark, sf_dir):
    return data.lines(spark, sf_dir).select("doc_id", "line_no", T.line_signature(F.col("line")).alias("signature"))


@query(r"select o_orderkey, regexp_matches(t, '(?i)^\s*(?:page\s*)?[0-9]+(?:\s*(?:/|of)\s*[0-9]+)?\s*$') as is_page_number from (select o_orderkey, case o_orderkey % 4 when 0 then 'Page ' || o_orderkey when 1 then o_orderkey || ' of ' || o_custkey when 2 then o_orderkey || '/' || o_custkey else 'No. ' || o_orderkey end as t from orders)")
def page_number_lines(spark, sf_dir):
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    m = F.pmod("o_orderkey", F.lit(4))
    t = F.when(m == 0, F.concat(F.lit("Page "), k)).when(m == 1, F.concat(k, F.lit(" of "), c)).when(m == 2, F.concat(k, F.lit("/"), c)).otherwise(F.concat(F.lit("No. "), k))
    return data.read(spark, sf_dir, "orders").select("o_orderkey", T.is_page_number(t).alias("is_page_number"))


@query("select p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_brand || ' (' || p_size || ')'), '[^a-z0-9]+', ' ', 'g')) as name from part")
def header_normalise(spark, sf_dir):
    p = data.read(spark, sf_dir, "part")
    return p.select("p_partkey", T.norm_name(F.concat("p_name", F.lit(" / "), "p_brand", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))).alias("name"))



@query("""with t as (select o_orderkey, case o_orderkey % 6 when 0 then '1,' || lpad((o_orderkey % 1000)::varchar, 3, '0') when 1 then '+' || o_orderkey || '.5%' when 2 then '—' when 3 then ' N/A ' when 4 then '-' || o_orderkey else o_orderkey || 'd' end as raw from orders)
select o_orderkey, case o_orderkey % 6 when 0 then 1000 + o_orderkey % 1000 when 1 then o_orderkey + 0.5 when 4 then -o_orderkey end::double as value,
  case o_orderkey % 6 when 0 then true when 1 then false when 4 then true end as is_int,
  case when lower(trim(raw)) in ('—', 'n/a') then null else trim(raw) end as text from t""")
def to_number(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    m = F.pmod("o_orderkey", F.lit(6))
    raw = F.when(m == 0, F.concat(F.lit("1,"), F.lpad(F.pmod("o_orderkey", F.lit(1000)).cast("string"), 3, "0"))).when(m == 1, F.concat(F.lit("+"), k, F.lit(".5%"))).when(m == 2, "—").when(m == 3, " N/A ").when(m == 4, F.concat(F.lit("-"), k)).otherwise(F.concat(k, F.lit("d")))
    return data.read(spark, sf_dir, "orders").select("o_orderkey", T.to_number(raw).alias("value"), T.number_is_int(raw).alias("is_int"), T.text_or_null(raw).alias("text"))


@query("""with t as (select o_orderkey, case o_orderkey % 7 when 0 then ' ' when 1 then 'NULL' when 2 then ' n/a ' when 3 then '–' when 4 then ' value ' || o_orderkey || ' ' when 5 then 'nan' else 'none of ' || o_orderkey end as raw from orders)
select o_orderkey, o_orderkey % 7 not in (4, 6) as is_null, case o_orderkey % 7 when 4 then 'value ' || o_orderkey when 6 then 'none of ' || o_orderkey end as text from t""")
def null_text(spark, sf_dir):
    k, m = F.col("o_orderkey").cast("string"), F.pmod("o_orderkey", F.lit(7))
    raw = F.lit("nan")
    for n, x in ((0, F.lit(" ")), (1, F.lit("NULL")), (2, F.lit(" n/a ")), (3, F.lit("–")), (4, F.concat(F.lit(" value "), k, F.lit(" "))), (6, F.concat(F.lit("none of "), k))):
        raw = F.when(m == n, x).otherwise(raw)
    return data.read(spark, sf_dir, "orders").select("o_orderkey", T.is_null(raw).alias("is_null"), T.text_or_null(raw).alias("text"))


_DATED = "with d as (select o_orderkey, o_orderdate::date as d from orders)"


@query(f"""{_DATED} select o_orderkey,
  case o_orderkey % 5 when 0 then d::varchar when 1 then d::varchar
    when 2 then case when day(d) > 12 or day(d) = month(d) then d::varchar end
    when 4 then case when day(d) > 12 or day(d) = month(d) then '20' || substr(d::varchar, 3) end end as iso,
  case o_orderkey % 5 when 2 then case when day(d) > 12 or day(d) = month(d) then null else 'date_ambiguous' end
    when 3 then 'date_missing_year'
    when 4 then case when day(d) > 12 or day(d) = month(d) then null else 'date_ambiguous' end end as flag
from d""")
def parse_date(spark, sf_dir):
    d = F.to_date("o_orderdate")
    raw = F.date_format(d, data.DATE_STYLES[0])
    for k, style in enumerate(data.DATE_STYLES[1:], 1):
        raw = F.when(F.pmod("o_orderkey", F.lit(5)) == k, F.date_format(d, style)).otherwise(raw)
    day = T.parse_date(raw)
    return data.read(spark, sf_dir, "orders").select("o_orderkey", day["iso"].alias("iso"), day["flag"].alias("flag"))


_GROUND = "trim(regexp_replace(lower({}), '[^a-z0-9@+.]+', ' ', 'g'))"


@query(f"with v as (select doc_id, text, case when doc_id % 3 = 0 then 'zq' || substr(text, 11, 40) when doc_id % 3 = 1 then substr(text, 11, 40) else substr(text, 51, 20) || substr(text, 11, 20) end as value from documents) select doc_id, coalesce(value = '' or position({_GROUND.format('value')} in {_GROUND.format('text')}) > 0, false) as grounded from v")
def grounded_filter(spark, sf_dir):
    """Values that were cut out of a text, that have something before them, or two parts the wrong way round."""
    d = data.read(spark, sf_dir, "documents")
    part, m = lambda at, n: F.substring("text", at, n), F.pmod("doc_id", F.lit(3))
    value = F.when(m == 0, F.concat(F.lit("zq"), part(11, 40))).when(m == 1, part(11, 40)).otherwise(F.concat(part(51, 20), part(11, 20)))
    return d.select("doc_id", F.coalesce(T.grounded(value, F.col("text")), F.lit(False)).alias("grounded"))


# ---- index and retrieval --------------------------------------------------------

ASKED = ((1, "the license of the General Public"), (2, "password token for the account"), (3, "thnd the reation of erthing"))
_ASKED = "asked(query_id, query) as (values " + ", ".join(f"({i}, '{q}')" for i, q in ASKED) + ")"
_BM25 = f"""{_ASKED},
q as (select distinct query_id, unnest({_terms('query')}) as term from asked),
bags as (select doc_id, {_terms('text')} as ts from documents),
corpus as (select count(*) as n, avg(len(ts)) as mean from bags),
tf as (select doc_id, len(ts) as size, t as term, count(*) as tf from (select doc_id, ts, unnest(ts) as t from bags) group by all),
df as (select term, count(*) as df from tf group by term),
scores as (select query_id, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * size / mean))) as score from q join tf using (term) join df using (term), corpus group by all)"""


def _asked(spark) -> DataFrame:
    return spark.createDataFrame(ASKED, "query_id int, query string")


def _chunks(spark, sf_dir) -> DataFrame:
    return data.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text", "lang")


def _top(scores: DataFrame, k: int) -> DataFrame:
    return retrieve.ranked(scores.withColumn("score", F.round("score", 9)), 0.0, k).select("query_id", "rank", F.col("chunk_id").alias("doc_id"), F.round("score", 6).alias("score"))


@query(f"with {_BM25} select term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) as idf from df, corpus")
def bm25_term_stats(spark, sf_dir):
    found = index.lexical(_chunks(spark, sf_dir))
    return found.terms.select("term", "df", F.round(index.idf(found.corpus.select("n").scalar(), F.col("df")), 6).alias("idf"))


@query(f"with {_BM25}, r as (select query_id, doc_id, round(score, 9) as score, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank from scores where score > 0) select query_id, rank::int as rank, doc_id, round(score, 6) as score from r where rank <= 10")
def bm25_topk(spark, sf_dir):
    return _top(index.bm25_search(_chunks(spark, sf_dir), _asked(spark)), 10)


@query(f"with {_BM25}, r as (select query_id, doc_id, round(score, 9) as score, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank from scores join documents using (doc_id) where score > 0 and lang = 'en') select query_id, rank::int as rank, doc_id, round(score, 6) as score from r where rank <= 40")
def bm25_masked(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    return _top(retrieve.masked(index.bm25_search(chunks, _asked(spark)), chunks, {"lang": ["en"]}), 40)


NAMED = ((1, 'the "General Public License" of GNU, version 3'), (2, "MIT license"), (3, "AKIA keys"))
_EXACT = """toks(query_id, token) as (values (1, 'general public license'), (1, 'gnu'), (2, 'mit'), (3, 'akia')),
hits as (select doc_id, token from documents, (select distinct token from toks) where regexp_matches(lower(text), '(?:^|[^a-z0-9])' || token || '(?:$|[^a-z0-9])')),
w as (select token, ln(1 + (select count(*) from documents) / (1 + count(*))) as weight from hits group by token),
ex as (select query_id, doc_id, sum(weight) as score from hits join w using (token) join toks using (token) group by all)"""


@query(f"with {_EXACT}, r as (select query_id, doc_id, score, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank from ex) select query_id, rank::int as rank, doc_id, round(score, 6) as score from r where rank <= 40")
def exact_id_rank(spark, sf_dir):
    return _top(index.exact(_chunks(spark, sf_dir), spark.createDataFrame(NAMED, "query_id int, query string")), 40)


_GRAMS = "grams{s} as (select {k}, unnest(list_concat(ws, flatten(list_transform(ws, lambda w: list_transform(range(1, greatest(1, len(w) - 3) + 1), lambda i: substr(w, i, 4)))))) as gram from (select {k}, regexp_extract_all(lower({t}), '[a-z0-9]+') as ws from {f}))"
_VECTORS = """w{s} as (select {k}, (('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::bigint % 384)::int as bucket, sum(case when ('0x' || substr(h, 9, 2))::int % 2 = 1 then 1.0::double else -1.0::double end) as w from (select {k}, md5(gram) as h from grams{s}) group by all having sum(case when ('0x' || substr(h, 9, 2))::int % 2 = 1 then 1.0::double else -1.0::double end) <> 0),
v{s} as (select {k}, bucket, w / sqrt(sum(w * w) over (partition by {k})) as weight from w{s})"""
_ITEMS = "items as (select doc_id as chunk_id, text from documents)"
_DENSE = ", ".join([_ITEMS, _GRAMS.format(s="", k="chunk_id", t="text", f="items"), _VECTORS.format(s="", k="chunk_id")])


@query(f"with {_DENSE} select chunk_id, bucket, round(weight, 6) as weight from v")
def hash_embed_buckets(spark, sf_dir):
    return index.hash_vectors(_chunks(spark, sf_dir), "chunk_id").select("chunk_id", "bucket", F.round("weight", 6).alias("weight"))


_COSINE = f"{_DENSE}, {_ASKED}, {_GRAMS.format(s='q', k='query_id', t='query', f='asked')}, {_VECTORS.format(s='q', k='query_id')}, cs as (select query_id, chunk_id, sum(v.weight * vq.weight) as score from v join vq using (bucket) group by all)"


@query(f"with {_COSINE}, r as (select query_id, chunk_id, round(score, 9) as score, row_number() over (partition by query_id order by round(score, 9) desc, chunk_id) as rank from cs where score > -1) select query_id, rank::int as rank, chunk_id as doc_id, round(score, 6) as score from r where rank <= 40")
def hash_embed_cosine(spark, sf_dir):
    scores = embed.near(_chunks(spark, sf_dir), _asked(spark)).withColumn("score", F.round("score", 9))
    return retrieve.ranked(scores, -1.0, 40).select("query_id", "rank", F.col("chunk_id").alias("doc_id"), F.round("score", 6).alias("score"))


_DOT = "(select vec_id as query_id, embedding::double[] as q from embeddings where vec_id % 50 = 0)"


@query(f"with s as (select query_id, vec_id, list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))) as score from (select vec_id, embedding::double[] as e from embeddings), {_DOT}), r as (select *, row_number() over (partition by query_id order by round(score, 9) desc, vec_id) as rank from s where score > -1) select query_id, rank::int as rank, vec_id as doc_id, round(score, 6) as score from r where rank <= 40")
def cosine_topk(spark, sf_dir):
    e = data.read(spark, sf_dir, "embeddings")
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    scores = index.dense_cosine(e.withColumnRenamed("vec_id", "chunk_id"), asked).withColumn("score", F.round("score", 9))
    return retrieve.ranked(scores, -1.0, 40).select("query_id", "rank", F.col("chunk_id").alias("doc_id"), F.round("score", 6).alias("score"))


@query(f"with s as (select query_id, vec_id, list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))) as score from (select vec_id, embedding::double[] as e from embeddings), {_DOT}) select query_id, count(*) as n, count(*) filter (vec_id = query_id) as itself, round(avg(score), 6) as mean from s where round(score, 9) > 0.25 group by query_id")
def dense_floor(spark, sf_dir):
    """How many vectors are above a floor of similarity, for a stated set of queries."""
    e = data.read(spark, sf_dir, "embeddings")
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    above = index.dense_cosine(e.withColumnRenamed("vec_id", "chunk_id"), asked).where(F.round("score", 9) > 0.25)
    return above.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("chunk_id") == F.col("query_id")).alias("itself"), F.round(F.avg("score"), 6).alias("mean"))


_RANKED = "select query_id, {c} as doc_id, row_number() over (partition by query_id order by round(score, 9) desc, {c}) as rank from {t}"


@query(f"with {_BM25}, {_EXACT}, lex as (select * from ({_RANKED.format(c='doc_id', t='scores')}) where rank <= 40), exr as (select * from ({_RANKED.format(c='doc_id', t='ex')}) where rank <= 40), f as (select query_id, doc_id, round(sum(1.0::double / (60 + rank)), 12) as fused from (select * from lex union all select * from exr) group by all), p as (select *, row_number() over (partition by query_id order by fused desc, doc_id) as place from f) select query_id, place::int as place, doc_id, round(fused, 5) as score from p where place <= 10")
def rrf_fuse(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    near = lambda s: retrieve.ranked(s.withColumn("score", F.round("score", 9)))
    named = spark.createDataFrame(NAMED, "query_id int, query string")
    both = [(near(index.bm25_search(chunks, _asked(spark))), 1.0), (near(index.exact(chunks, named)), 1.0)]
    return retrieve.fuse(both, by="query_id", k=10).select("query_id", "place", F.col("chunk_id").alias("doc_id"), F.col("retrieval_score").alias("score"))


_NEEDS = "needs(need_id, query_id) as (values (1, 1), (1, 2), (2, 3))"


@query(f"with {_COSINE}, {_BM25.split(',' + chr(10), 1)[1]}, {_NEEDS}, d as ({_RANKED.format(c='chunk_id', t='cs')}), l as ({_RANKED.format(c='doc_id', t='scores')}), f as (select need_id, doc_id, round(sum(1.0::double / (60 + rank)), 12) as fused from (select * from d where rank <= 40 union all select * from l where rank <= 40) join needs using (query_id) group by all), p as (select *, row_number() over (partition by need_id order by fused desc, doc_id) as place from f) select need_id, place::int as place, doc_id, round(fused, 5) as score from p where place <= 8")
def hybrid_search(spark, sf_dir):
    """Two needs, one in two phrasings, over all documents; none of the phrasings holds an identifier."""
    needs = _asked(spark).withColumn("query", F.regexp_replace("query", "General Public", "general public")).withColumn("need_id", F.when(F.col("query_id") <= 2, 1).otherwise(2))
    return retrieve.hybrid(_chunks(spark, sf_dir), needs).select("need_id", "place", F.col("chunk_id").alias("doc_id"), F.col("retrieval_score").alias("score"))


@query(f"with {_BM25}, {_NEEDS}, l as ({_RANKED.format(c='doc_id', t='scores')}), f as (select need_id, doc_id, round(sum(1.0::double / (60 + rank)), 12) as fused from l join needs using (query_id) where rank <= 40 group by all), p as (select *, row_number() over (partition by need_id order by fused desc, doc_id) as place from f) select need_id, place::int as place, doc_id, round(fused, 5) as score from p where place <= 20")
def rrf_multi_query(spark, sf_dir):
    """Needs in several phrasings, each ranked by itself."""
    needs = _asked(spark).withColumn("need_id", F.when(F.col("query_id") <= 2, 1).otherwise(2)).select("query_id", "need_id")
    ranks = retrieve.ranked(index.bm25_search(_chunks(spark, sf_dir), _asked(spark)).withColumn("score", F.round("score", 9))).join(needs, "query_id")
    return retrieve.fuse([(ranks, 1.0)], k=20).select("need_id", "place", F.col("chunk_id").alias("doc_id"), F.col("retrieval_score").alias("score"))


_TURNS = "t as (select conv_id as doc_id, row_number() over (partition by conv_id order by turn, role) - 1 as chunk_index, role as section, (turn // 2)::int as page, text from conversations)"


@query(f"with {_TURNS} select distinct t.doc_id, t.chunk_index::int as chunk_index, t.section from t join t p on p.doc_id = t.doc_id and abs(p.chunk_index - t.chunk_index) = 1 where p.section = 'system'")
def neighbors(spark, sf_dir):
    t = data.turns(spark, sf_dir)
    return retrieve.neighbours(t.where("section = 'system'"), t).select("doc_id", "chunk_index", "section")


@query(f"with {_TURNS} select doc_id, chunk_index::int as chunk_index, page from t where coalesce(nullif(page, 0), 99) <= 1 and section in ('user', 'system')")
def first_pages(spark, sf_dir):
    return retrieve.first_pages(data.turns(spark, sf_dir), 1, {"section": ["user", "system"]}).select("doc_id", "chunk_index", "page")


@query(f"with {_TURNS} select doc_id, chunk_index::int as chunk_index, section from t where regexp_matches(section, '(?i)SYS|assist') and page > 0")
def section_lookup(spark, sf_dir):
    return retrieve.by_section(data.turns(spark, sf_dir), "SYS|assist", F.col("page") > 0).select("doc_id", "chunk_index", "section")


@query(f"with {_TURNS}, u as (select *, sum(len(text)) over (partition by doc_id order by chunk_index) as used from t) select doc_id, md5(string_agg(text, chr(10) || chr(10) order by chunk_index)) as context_md5, sum(len(text))::bigint as chars, count(*) as chunks from u where used <= 1200 group by doc_id")
def context_cap(spark, sf_dir):
    picked = data.turns(spark, sf_dir).withColumnRenamed("text", "body")
    return retrieve.context(picked, 1200).select("doc_id", F.md5(F.col("context").cast("binary")).alias("context_md5"), "chars", "chunks")


# ---- cleaning and chunks ---------------------------------------------------------

_WEB = r"""web as (select regexp_extract(url, '://([^/?#]*)', 1) as doc_id, page_id::int as page, string_split(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(html, '<[^>]*>', chr(10), 'g'), chr(9), ' '), '\r\n?', chr(10), 'g'), '([a-z])-\n([a-z])', '\1\2', 'g'), ' {2,}', ' ', 'g'), chr(10)) as ls from pages),
wl as (select doc_id, page, i, trim(ls[i], ' ' || chr(160)) as line from (select *, unnest(range(1, len(ls) + 1)) as i from web)),
sg as (select doc_id, page, i, line, regexp_replace(lower(line), '[0-9]+', '#', 'g') as signature from wl),
np as (select doc_id, count(distinct page) as pages from wl group by doc_id),
rep as (select doc_id, signature, count(distinct page) as pages from sg where line <> '' group by all),
repeated as (select r.* from rep r join np using (doc_id) where np.pages >= 3 and r.pages >= greatest(3, floor(0.6 * np.pages)))"""


@query(f"with {_WEB} select doc_id, signature, pages from repeated")
def repeated_lines(spark, sf_dir):
    e = data.web_elements(spark, sf_dir).withColumn("text", T.plain_text(F.col("text")))
    return clean.repeated_lines(clean.lines_of(e).withColumn("line", T.clean_line(F.col("line"))))


@query(rf"""with {_WEB}, kept as (select * from sg s where not regexp_matches(line, '(?i)^\s*(?:page\s*)?[0-9]+(?:\s*(?:/|of)\s*[0-9]+)?\s*$') and (line = '' or not exists (select 1 from repeated r where r.doc_id = s.doc_id and r.signature = s.signature))),
j as (select doc_id, page, trim(regexp_replace(string_agg(line, chr(10) order by i), '\n{{3,}}', chr(10) || chr(10), 'g'), chr(10) || ' ') as text from kept group by all)
select doc_id, page as element_no, len(text)::bigint as chars, md5(text) as text_md5 from j where text <> ''""")
def clean_lines(spark, sf_dir):
    e = clean.clean_elements(data.web_elements(spark, sf_dir))
    return e.select("doc_id", "element_no", F.length("text").cast("bigint").alias("chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query()
def nfkc_clean(spark, sf_dir):
    d = data.read(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(clean.nfkc(F.col("text")).cast("binary")).alias("text_md5"))


@query(f"with {_LINES} select doc_id, line_no::int as chunk_index, doc_id || '/c' || lpad(line_no::varchar, 4, '0') as chunk_id from lines")
def chunk_number(spark, sf_dir):
    numbered = clean.numbered(data.lines(spark, sf_dir), "doc_id", ["line_no"], "chunk_index")
    return numbered.select("doc_id", "chunk_index", F.concat_ws("/", F.col("doc_id").cast("string"), F.concat(F.lit("c"), F.lpad(F.col("chunk_index").cast("string"), 4, "0"))).alias("chunk_id"))


@query("with f as (select conv_id, turn, role, case when lag(role) over w is null or lag(role) over w <> role then 1 else 0 end as fresh from conversations window w as (partition by conv_id order by turn)) select conv_id as doc_id, turn::int as element_no, (sum(fresh) over (partition by conv_id order by turn))::bigint as group_no from f")
def section_islands(spark, sf_dir):
    c = data.read(spark, sf_dir, "conversations")
    e = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("element_no"), F.lit("chat").alias("source"), F.col("role").alias("section"), F.lit("text").alias("element_type"), F.lit(None).cast("string").alias("sheet_name"))
    return chunk.sections(e).select("doc_id", "element_no", "group_no")


@query("select conv_id as doc_id, turn::int as element_no, md5(last_value(case when role = 'user' then text end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row)) as section_md5 from conversations")
def running_section(spark, sf_dir):
    c = data.read(spark, sf_dir, "conversations")
    e = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("element_no"), (F.col("role") == "user").alias("is_heading"), "text")
    return layout.running_section(e).select("doc_id", "element_no", F.md5(F.col("section").cast("binary")).alias("section_md5"))


def _line_costs(spark, sf_dir) -> DataFrame:
    return data.read(spark, sf_dir, "documents").select("doc_id", F.transform(F.split("text", "\n"), lambda x: F.length(x) + 1).alias("costs"))


@query("""with recursive c as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: len(x) + 1) as costs from documents),
p as (select doc_id, costs, 1 as i, 0 as g, costs[1] as used from c
  union all select doc_id, costs, i + 1, case when used + costs[i + 1] > 400 then g + 1 else g end, case when used + costs[i + 1] > 400 then costs[i + 1] else used + costs[i + 1] end from p where i < len(costs))
select doc_id, g::int as group_no, min(i)::bigint - 1 as first, max(i)::bigint - 1 as last from p group by all""")
def greedy_pack(spark, sf_dir):
    packed = _line_costs(spark, sf_dir).withColumn("groups", chunk.pack(F.col("costs"), F.lit(400)))
    rows = packed.select("doc_id", F.posexplode("groups").alias("i", "group_no"))
    return rows.groupBy("doc_id", "group_no").agg(F.min("i").cast("bigint").alias("first"), F.max("i").cast("bigint").alias("last"))


_PACK = "select doc_id, {k}, costs, lim, 1 as i, 0 as g, costs[1] as used from {start} union all select doc_id, {k}, costs, lim, i + 1, case when used + costs[i + 1] > lim then g + 1 else g end, case when used + costs[i + 1] > lim then costs[i + 1] else used + costs[i + 1] end from {own} where i < len(costs)"


@query(f"""with recursive c as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: len(x) + 1) as costs, -1 as k, 400 as lim from documents),
p as ({_PACK.format(k='k', start='c', own='p')}),
n as (select doc_id, any_value(costs) as costs, max(g) + 1 as groups from p group by doc_id),
e as (select doc_id, costs, groups, k, least(400, ceil(list_sum(costs) / groups) + floor([0.25, 0.5, 0.75, 1.0][k + 1] * list_max(costs)))::bigint as lim from n, range(0, 4) t(k) where groups > 1),
q as ({_PACK.format(k='k', start='e', own='q')}),
fits as (select doc_id, min(k) as k from (select q.doc_id, q.k, max(g) + 1 as m from q group by all) join n using (doc_id) where m <= groups group by doc_id)
select doc_id, g::int as group_no, min(i)::bigint - 1 as first, max(i)::bigint - 1 as last from (select q.doc_id, q.i, q.g from q join fits using (doc_id, k) union all select p.doc_id, p.i, p.g from p where not exists (select 1 from fits f where f.doc_id = p.doc_id)) group by doc_id, g""")
def balanced_pack(spark, sf_dir):
    packed = chunk.balanced(_line_costs(spark, sf_dir), "costs", F.lit(400), "groups")
    # A null text is one group of one item, as in the SQL.
    rows = packed.select("doc_id", F.posexplode(F.coalesce("groups", F.array(F.lit(0)))).alias("i", "group_no"))
    return rows.groupBy("doc_id", "group_no").agg(F.min("i").cast("bigint").alias("first"), F.max("i").cast("bigint").alias("last"))


_LINEROW = "concat_ws(' | ', l_linenumber, l_partkey, l_suppkey, l_quantity::bigint, l_returnflag, strftime(l_shipdate, '%Y-%m-%d'))"
_LINEORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@query(f"select l_orderkey as doc_id, count(*) as n_rows, md5('Table: Order ' || l_orderkey || chr(10) || 'Section: Lines' || chr(10) || 'Columns: Line | Part | Supplier | Quantity | Flag | Ship Date' || chr(10) || string_agg({_LINEROW}, chr(10) order by {_LINEORDER})) as text_md5 from lineitem group by l_orderkey")
def table_render(spark, sf_dir):
    t = data.line_tables(spark, sf_dir)
    title = F.concat(F.lit("Order "), F.col("doc_id").cast("string"))
    head = tab.header_lines(title, F.lit("Lines"), F.array().cast("array<int>"), F.col("columns"), F.lit(True), F.lit(None).cast("string"))
    return t.select("doc_id", F.size("rows").cast("bigint").alias("n_rows"), F.md5(tab.table_text(head, F.col("rows")).cast("binary")).alias("text_md5"))


def _line_chunks(spark, sf_dir) -> DataFrame:
    t = data.line_tables(spark, sf_dir).withColumn("header", F.lit("Table: Lines\nColumns: Line | Part | Supplier | Quantity | Flag | Ship Date"))
    return chunk.chunk_tables(t, 120, lambda x: F.length(x).cast("bigint"))


@query("select l_orderkey as doc_id, count(*) as rows_covered, 1::bigint as first_row, count(*) as last_row from lineitem group by l_orderkey")
def row_coverage(spark, sf_dir):
    c = _line_chunks(spark, sf_dir)
    return c.groupBy("doc_id").agg(F.sum(F.col("row_end") - F.col("row_start") + 1).cast("bigint").alias("rows_covered"), F.min("row_start").cast("bigint").alias("first_row"), F.max("row_end").cast("bigint").alias("last_row"))


@query("select l_orderkey as doc_id, 1::bigint as headers, md5('Table: Lines' || chr(10) || 'Columns: Line | Part | Supplier | Quantity | Flag | Ship Date') as header_md5, true as numbered from lineitem group by l_orderkey")
def table_chunk_headers(spark, sf_dir):
    """Every chunk of a table begins with its header, and chunks are numbered without gaps."""
    c = _line_chunks(spark, sf_dir).withColumn("header", F.substring_index("text", "\n", 2))
    numbered = (F.count(F.lit(1)) == F.max("table_chunks")) & (F.max("table_chunk") == F.count(F.lit(1)) - 1) & (F.min("table_chunk") == 0)
    return c.groupBy("doc_id").agg(F.count_distinct("header").alias("headers"), F.md5(F.min("header").cast("binary")).alias("header_md5"), numbered.alias("numbered"))


@query()
def table_chunks(spark, sf_dir):
    return _line_chunks(spark, sf_dir)


@query()
def text_chunks(spark, sf_dir):
    c = data.read(spark, sf_dir, "conversations")
    none = F.lit(None).cast("string")
    e = c.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("element_no"), F.lit("chat").alias("source"), F.lit("Talk").alias("section"), F.lit("text").alias("element_type"), F.lit("pdf").alias("file_type"), none.alias("sheet_name"), (F.col("turn") / 2 + 1).cast("int").alias("page"), F.array((F.col("turn") / 2 + 1).cast("int")).alias("pages"), F.lit(False).alias("is_heading"), "text")
    return chunk.chunk_texts(chunk.sections(e), 120).select("doc_id", "part", "page", F.md5(F.col("text").cast("binary")).alias("text_md5"))


# ---- layout ------------------------------------------------------------------------

_GRID = "g as (select event_type as doc_id, user_id::int as r, datediff('day', date '2020-01-01', ts::date)::int as c, count(*) as n from events group by all)"


@query(f"with {_GRID}, b as (select doc_id, r, r - dense_rank() over (partition by doc_id order by r) as shift from (select distinct doc_id, r from g)), k as (select doc_id, shift, min(r) as low, max(r) as high from b group by all) select doc_id, dense_rank() over (partition by doc_id order by shift)::int as row_band, low, high from k")
def row_bands(spark, sf_dir):
    b = layout.islands(data.grid(spark, sf_dir), ["doc_id"], "row", "row_band")
    return b.groupBy("doc_id", "row_band").agg(F.min("row").alias("low"), F.max("row").alias("high"))


@query(f"with {_GRID}, b as (select doc_id, r // 10 as band, c, c - dense_rank() over (partition by doc_id, r // 10 order by c) as shift from (select distinct doc_id, r, c from g)) select doc_id, band::int as band, min(c) as low, max(c) as high, count(*) as cells from b group by doc_id, band, shift")
def col_bands(spark, sf_dir):
    g = data.grid(spark, sf_dir).withColumn("band", F.floor(F.col("row") / 10).cast("int"))
    b = layout.islands(g, ["doc_id", "band"], "col", "col_band")
    return b.groupBy("doc_id", "band", "col_band").agg(F.min("col").alias("low"), F.max("col").alias("high"), F.count(F.lit(1)).alias("cells")).drop("col_band")


@query("select p_partkey % 50 as doc_id, p_partkey * 10 + i as row, p_partkey + j as col, p_name as value, i = 0 and j = 0 as actual from part, range(0, 3) a(i), range(0, 2) b(j)")
def merged_expand(spark, sf_dir):
    p = data.read(spark, sf_dir, "part").withColumns({"doc_id": F.col("p_partkey") % 50, "row": F.col("p_partkey") * 10, "col": F.col("p_partkey"), "sheet_index": F.lit(1), "value": F.col("p_name")})
    merged = p.select("doc_id", "sheet_index", F.col("row").alias("min_row"), F.col("col").alias("min_col"), (F.col("row") + 2).alias("max_row"), (F.col("col") + 1).alias("max_col"))
    return layout.expand_merged(p.select("doc_id", "sheet_index", "row", "col", "value"), merged).drop("sheet_index")


@query("with e as (select user_id, event_id, floor(epoch(ts))::bigint as s from events), f as (select *, case when s - lag(s) over w > 86400 then 1 else 0 end as apart from e window w as (partition by user_id order by s, event_id)) select user_id, run::bigint as run, count(*) as n, min(s) as low, max(s) as high from (select *, sum(apart) over (partition by user_id order by s, event_id) as run from f) group by user_id, run")
def gap_sessions(spark, sf_dir):
    e = data.read(spark, sf_dir, "events").select("user_id", F.unix_timestamp("ts").alias("s"))
    runs = layout.sessions(e, ["user_id"], "s", "s", F.lit(86400), "run")
    return runs.groupBy("user_id", "run").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))


_BOXES = "(select o_orderkey as box, o_orderkey % 40 as doc_id, o_orderkey % 7 as page, (o_orderkey * 37 % 600)::double as x0, (o_orderkey * 53 % 800)::double as top, (o_orderkey * 37 % 600)::double + 5 + o_orderkey * 3 % 11 as x1, (o_orderkey * 53 % 800)::double + 4 + o_orderkey * 5 % 13 as bottom from orders)"
_STAMPS = _BOXES.replace("o_orderkey", "p_partkey").replace("orders", "part")
_OVER = f"from {_BOXES} a where {{}} exists (select 1 from {_STAMPS} b where b.doc_id = a.doc_id and b.page = a.page and a.x0 < b.x1 and a.x1 > b.x0 and a.top < b.bottom and a.bottom > b.top)"


@query("select box, x0, top " + _OVER.format(""))
def box_overlap_semi(spark, sf_dir):
    return layout.overlapping(data.boxes(spark, sf_dir), data.boxes(spark, sf_dir, "part", "p_partkey")).select("box", "x0", "top")


@query("select box, x0, top " + _OVER.format("not"))
def box_overlap_anti(spark, sf_dir):
    return layout.overlapping(data.boxes(spark, sf_dir), data.boxes(spark, sf_dir, "part", "p_partkey"), "left_anti").select("box", "x0", "top")


_ANCHORS = f"x as (select *, count(*) over (partition by doc_id, page) as n from {_BOXES}), s as (select *, case when x0 - lag(x0) over (partition by doc_id, page order by x0) > 8 then 1 else 0 end as apart from x where n >= 6), c as (select doc_id, page, k, avg(x0) as anchor, count(*) as m from (select *, sum(apart) over (partition by doc_id, page order by x0) as k from s) group by all having count(*) >= 3), a as (select doc_id, page, anchor, count(*) over (partition by doc_id, page) as big from c)"


@query(f"with {_ANCHORS} select doc_id, page, round(anchor, 6) as anchor from a where big >= 2")
def column_anchors(spark, sf_dir):
    lines = data.boxes(spark, sf_dir).withColumn("page_width", F.lit(40.0))
    return layout.column_anchors(lines).select("doc_id", "page", F.round("anchor", 6).alias("anchor"))


@query("select o_orderkey, list_position([abs(10.5 - x), abs(99.5 - x), abs(250.5 - x), abs(400.0 - x)], list_min([abs(10.5 - x), abs(99.5 - x), abs(250.5 - x), abs(400.0 - x)]))::int - 1 as col from (select o_orderkey, (o_orderkey * 37 % 600)::double as x from orders)")
def nearest_anchor(spark, sf_dir):
    x = F.pmod(F.col("o_orderkey") * 37, F.lit(600)).cast("double")
    return data.read(spark, sf_dir, "orders").select("o_orderkey", layout.nearest(x, F.array(*map(F.lit, (10.5, 99.5, 250.5, 400.0)))).alias("col"))


# ---- tables and records ---------------------------------------------------------------


@query("with n as (select l_orderkey, list(case when l_quantity > 45 then null else case when l_linenumber % 2 = 0 then 'Flag' else 'flag' end end order by l_linenumber, l_partkey, l_suppkey) as ns from lineitem group by l_orderkey), u as (select l_orderkey, ns, unnest(range(1, len(ns) + 1)) as i from n), m as (select l_orderkey, i, coalesce(ns[i], 'col_' || i) as name from u) select l_orderkey, i::int as place, case when k = 1 then name else name || '_' || k end as name from (select *, row_number() over (partition by l_orderkey, lower(name) order by i) as k from m)")
def unique_columns(spark, sf_dir):
    li = data.read(spark, sf_dir, "lineitem")
    name = F.when(F.col("l_quantity") > 45, F.lit(" ")).when(F.col("l_linenumber") % 2 == 0, "Flag").otherwise("flag")
    names = li.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", name.alias("n")))), lambda x: x["n"]).alias("names"))
    return names.select("l_orderkey", F.posexplode(tab.unique_columns(F.col("names"))).alias("p", "name")).select("l_orderkey", (F.col("p") + 1).alias("place"), "name")


@query("select p_partkey, len(p_name) <= 40 and p_size % 3 <> 0 and p_size % 5 <> 0 as is_header from part")
def looks_like_header(spark, sf_dir):
    p = data.read(spark, sf_dir, "part")
    third = F.when(F.col("p_size") % 3 == 0, "1,250.5%").when(F.col("p_size") % 5 == 0, " N/A ").otherwise("Region")
    return p.select("p_partkey", tab.looks_like_header(F.array(F.col("p_name"), F.col("p_brand"), third)).alias("is_header"))


_HEADERS = (("ID", "Order Date", "Status", "Total"), ("Month", "Volume", "Closed", "CSAT", "P95 Hours"), ("Flag", "Area", "Details"), ("Name", "Phone"), ("Site", "Dept", "Amount", "Date", "Other"))


@query("select o_orderkey, ['master', 'monthly', 'dq', 'generic', 'master'][o_orderkey % 5 + 1] as class, [3, -1, -1, -1, -1][o_orderkey % 5 + 1]::int as amount_place, [-1, 4, -1, -1, -1][o_orderkey % 5 + 1]::int as p95_place from orders")
def classify_tables(spark, sf_dir):
    headers = F.array(*[F.array(*map(F.lit, h)) for h in _HEADERS])
    columns = F.get(headers, F.pmod("o_orderkey", F.lit(5)).cast("int"))
    t = data.read(spark, sf_dir, "orders").select("o_orderkey", columns.alias("columns"), F.lit("table").alias("element_type"), F.lit("pdf").alias("file_type"), F.lit(False).alias("secondary_sheet"), F.lit(True).alias("has_header"), F.array(F.array(F.lit("x"))).alias("rows"))
    place = lambda m, f, c: F.when(F.col("class") == c, F.try_element_at(F.col(m), F.lit(f)))
    return tab.classify(t).select("o_orderkey", "class", F.coalesce(F.when(F.size("columns") == 4, place("master", "amount", "master")), F.lit(-1)).alias("amount_place"), F.coalesce(place("monthly", "p95_hrs", "monthly"), F.lit(-1)).alias("p95_place"))


#: What the headers' columns are of a record, by the aliases.
_PLACES = "(0, 'record_id', 0), (0, 'date_raw', 1), (0, 'status', 2), (0, 'amount', 3), (3, 'name', 0), (3, 'phone', 1), (4, 'date_raw', 3), (4, 'entity_site', 0), (4, 'department', 1), (4, 'amount', 2)"


@query(f"select o_orderkey, field, place::int as place from orders join (values {_PLACES}) as w(header, field, place) on header = o_orderkey % 5")
def match_columns(spark, sf_dir):
    headers = F.array(*[F.array(*map(F.lit, h)) for h in _HEADERS])
    t = data.read(spark, sf_dir, "orders").select("o_orderkey", F.get(headers, F.pmod("o_orderkey", F.lit(5)).cast("int")).alias("columns"))
    matched = tab.match_columns(t, tab.MASTER_ALIASES, "master").where(F.pmod("o_orderkey", F.lit(5)).isin(0, 3, 4))
    return matched.select("o_orderkey", F.explode("master").alias("field", "place"))


@query("select o_orderkey, 'Price' as label, printf('%d%%', o_orderkey) as value_raw, o_orderkey::double as value_number, '%' as unit from orders where o_orderkey % 3 <> 0 union all select o_orderkey, 'Order key', o_orderkey::varchar, o_orderkey, null from orders where o_orderkey % 3 <> 0")
def value_groups(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    second = F.when(F.col("o_orderkey") % 3 == 0, "no value here").otherwise(F.concat(F.lit(" Order key = "), k))
    rows = F.array(F.array(F.concat(F.lit("Price: "), k, F.lit("%"))), F.array(second))
    t = data.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("t").alias("table_id"), F.lit("box").alias("title"), F.lit("s").alias("section"), F.array(F.lit(1)).alias("pages"), rows.alias("rows"))
    t = t.withColumn("class", F.when(tab.is_value_group(F.col("rows")), "values").otherwise("generic"))
    return tab.value_groups(t).select(F.col("doc_id").alias("o_orderkey"), F.inline("items"))


_RECORDS = f"""d as (select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate::date as d, 'ORD-' || (o_orderkey - case when o_orderkey % 7 = 6 then 1 else 0 end) as record_id from orders),
r as (select *, 'customer-' || o_custkey as doc_id, row_number() over (partition by o_custkey order by o_orderkey) - 1 as row_no,
  case o_orderkey % 5 when 0 then d::varchar when 1 then d::varchar when 3 then null when 2 then case when day(d) > 12 or day(d) = month(d) then d::varchar end else case when day(d) > 12 or day(d) = month(d) then '20' || substr(d::varchar, 3) end end as date_iso,
  case o_orderkey % 5 when 3 then 'date_missing_year' when 2 then case when day(d) > 12 or day(d) = month(d) then null else 'date_ambiguous' end when 4 then case when day(d) > 12 or day(d) = month(d) then null else 'date_ambiguous' end end as date_flag,
  case o_orderkey % 3 when 0 then floor(o_totalprice) when 1 then round(o_totalprice, 2) end::double as amount,
  case when o_orderkey % 4 = 0 then null else o_orderpriority end as owner,
  count(*) over (partition by o_custkey, record_id) as same from d)"""


def _records(spark, sf_dir, again: bool = False) -> tuple[DataFrame, DataFrame]:
    """Tables and their records; written down where they are read ``again``."""
    t = tab.classify(data.order_tables(spark, sf_dir))
    t = settled(t, "typed") if again else t
    m = tab.master_records(t)
    return t, settled(m, "records") if again else m


@query(f"with {_RECORDS} select doc_id, row_no::int as row_no, record_id, date_iso, o_orderstatus as status, round(amount, 2) as amount, owner, 'Legacy Code=see ' || o_orderkey as source_fields, array_to_string(list_filter([date_flag, case when owner is null then 'missing_owner' end, case when same > 1 then 'duplicate_id' end], lambda x: x is not null), ',') as flags from r")
def master_records(spark, sf_dir):
    _, m = _records(spark, sf_dir)
    pairs = F.array_join(F.transform(F.map_entries("source_fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return m.select("doc_id", "row_no", "record_id", "date_iso", "status", F.round("amount", 2).alias("amount"), "owner", pairs.alias("source_fields"), F.array_join("flags", ",").alias("flags"))


@query(f"with {_RECORDS} select doc_id, record_id, same from r where same > 1 group by all")
def duplicate_flags(spark, sf_dir):
    _, m = _records(spark, sf_dir)
    return m.where(F.array_contains("flags", "duplicate_id")).groupBy("doc_id", "record_id").agg(F.count(F.lit(1)).alias("same"))


@query(f"with {_RECORDS} select doc_id, 1::bigint as tables_found, 0::bigint as stitched_tables, count(*) as master_records, coalesce(string_agg(distinct case when same > 1 then record_id end, ',' order by case when same > 1 then record_id end), '') as duplicate_ids, count(*) filter (date_flag = 'date_ambiguous') as ambiguous_dates, 1::bigint as ancillary_tables from r group by doc_id")
def extraction_report(spark, sf_dir):
    t, m = _records(spark, sf_dir, again=True)
    return extract.report(t, m, {"ancillary_tables": tab.ancillary_tables(t)}).withColumn("duplicate_ids", F.array_join("duplicate_ids", ","))


@query("select o_orderkey, 'K' || o_orderkey as record_id, 'Pune' as location, 'Pune' as entity_site, floor(o_totalprice)::double as amount, 'Custom Tag=' || o_orderstatus as rest from orders")
def promote_source_fields(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    said = F.concat(F.lit("ID=x; ID=K"), k, F.lit("; City = Pune ;Total="), F.format_number(F.col("o_totalprice").cast("bigint"), 0), F.lit("; Custom Tag="), F.col("o_orderstatus"), F.lit("; no pair"))
    o = data.read(spark, sf_dir, "orders").withColumn("source_fields", extract.pairs_of(said))
    for f in ("record_id", "name", "department", "location", "date_raw", "status", "priority", "entity_site"):
        o = o.withColumn(f, F.lit(None).cast("string"))
    out = extract.promote(o.withColumn("amount", F.lit(None).cast("double")))
    rest = F.array_join(F.transform("source_fields", lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";")
    return out.select("o_orderkey", "record_id", "location", "entity_site", F.round("amount", 0).alias("amount"), rest.alias("rest"))


@query("with n as (select conv_id, count(*) as n, count(*) filter (turn % 3 <> 2) as shaped from conversations group by conv_id) select conv_id as doc_id, row_number() over (partition by conv_id order by turn)::int - 1 as note_no, turn::varchar as date_raw, role as area, 'a | b' as text from conversations join n using (conv_id) where turn % 3 <> 2 and shaped >= greatest(2, floor(n * 0.5))")
def pipe_notes(spark, sf_dir):
    c = data.read(spark, sf_dir, "conversations")
    line = F.when(F.col("turn") % 3 == 2, F.lit("no note")).otherwise(F.concat_ws(" | ", F.col("turn").cast("string"), "role", F.lit("a | b")))
    texts = c.groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    return extract.pipe_notes(texts)


@query()
def stitch_tables(spark, sf_dir):
    """An order's lines cut into pages of two rows, put together again."""
    li = data.line_tables(spark, sf_dir)
    parts = li.select("doc_id", "columns", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("rows"), F.lit(2)), lambda i: F.slice("rows", i, 2))).alias("element_no", "rows"))
    none, zero = F.lit(None).cast("string"), F.lit(0.0)
    t = parts.select(
        "doc_id", "element_no", F.lit("body").alias("kind"), "columns", F.lit(True).alias("has_header"), F.col("columns").alias("header_row"), "rows", none.alias("title"), none.alias("heading"), F.array(F.col("element_no") + 1).alias("pages"), zero.alias("x0"), zero.alias("x1"), zero.alias("top"), zero.alias("bottom"), zero.alias("page_height"),
    )
    return tab.stitch(t).select("doc_id", F.size("rows").cast("bigint").alias("n_rows"), "merged_parts", F.size("pages").alias("n_pages"))


@query(f"with {_RECORDS} select doc_id, row_no::int as row_no, '{{\"record_id\":\"' || record_id || '\",\"status\":\"' || o_orderstatus || '\",\"owner\":' || coalesce('\"' || owner || '\"', 'null') || '}}' as line from r")
def json_rows(spark, sf_dir):
    _, m = _records(spark, sf_dir)
    return m.select("doc_id", "row_no", F.to_json(F.struct("record_id", "status", "owner"), {"ignoreNullFields": "false"}).alias("line"))


@query(f"""with {_RECORDS}, n as (select doc_id, count(*) as n from r group by doc_id)
select doc_id, (row_no + 3)::bigint as row_no, record_id || ' | ' || o_orderstatus || ' | ' || coalesce(owner, '-') as line from r
union all select doc_id, k - 1, case k when 0 then '' when 1 then 'RECORDS (' || n || ')' when 2 then '-------------' else 'ID | status | owner' end from n, range(0, 4) t(k)""")
def report_lines(spark, sf_dir):
    t, m = _records(spark, sf_dir, again=True)
    return results.section(t, m, 1, "RECORDS", ("record_id", "status", "owner"), {"record_id": "ID"}).select("doc_id", "row_no", "line")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: hybrid search with rank fusion."""
    return hybrid_search(spark, sf_dir)


