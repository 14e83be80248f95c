"""The queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from serieskit.llm import decontaminate, hard_negatives, html_text, jaccard_join, language, max_score, near_dup, pieces, suffix_dedup, token_files, toxicity, vector_codes, warc
from serieskit.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file; every machine has them installed."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(load(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)


NEAR_SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), g as (
  select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) = 1 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as g from d
), n as (
  select doc_id, count(*) as n from g group by doc_id
), l as (
  select a.doc_id as a, b.doc_id as b from g a join g b on a.g = b.g and a.doc_id < b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))
), e as (
  select a, b from l union all select b, a from l
), r as (
  select doc_id, doc_id as reach from d union select r.doc_id, e.b from r join e on e.a = r.reach
), c as (
  select doc_id, min(reach) as component_id from r group by doc_id
)
select c.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component_id, c.doc_id = c.component_id as kept from c left join n using (doc_id)
"""


@query("op3_near_duplicates", NEAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(load(spark, sf_dir, "documents"), words=2, percent=80)


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""


@query("op4_max_score", TOP_K_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = max_score.quantized(load(spark, sf_dir, "embeddings"))
    return max_score.search(rows.where("vec_id % 20 = 0"), rows)


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op6_html_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages"))


@query("op7_language")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(load(spark, sf_dir, "pages"), load(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(load(spark, sf_dir, "documents"))


WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as payload from pages
), d as (
  select page_id, strlen(payload) as payload_bytes, sha1(payload) as hex, max(page_id) over (partition by sha1(payload)) as first_id from p
)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(1 + ((cast('0x' || substr(hex, cast(1 + 10 * (i // 8) as bigint), 10) as bigint) >> cast(35 - 5 * (i % 8) as bigint)) & 31) as bigint), 1)), '') as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id = first_id then null else first_id end as refers_to
from d
"""


@query("op9_warc", WARC_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, load(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_pieces")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(load(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


JOIN_SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), g as (
  select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from d
), n as (
  select doc_id, count(*) as n from g group by doc_id
), l as (
  select a.doc_id as a, b.doc_id as b from g a join g b on a.g = b.g and a.doc_id < b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 90 * (x.n + y.n - count(*))
), e as (
  select a, b from l union all select b, a from l
), r as (
  select doc_id, doc_id as reach from d union select r.doc_id, e.b from r join e on e.a = r.reach
), c as (
  select doc_id, min(reach) as component_id from r group by doc_id
)
select c.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component_id from c left join n using (doc_id)
"""


@query("op11_jaccard_join", JOIN_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(load(spark, sf_dir, "documents"), words=3, percent=90)


def _lloyd_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds as steps that follow each other; a distance and an index make one number, so ties go to the lower index."""
    steps = [f"""with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as materialized (
  select vec_id, label, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) as x from kept, range({parts}) as t(p)
), book0 as materialized (
  select p, cast(row_number() over (partition by p order by vec_id) - 1 as bigint) as i, x as c from cut qualify i < {entries}
)"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} as materialized (
  select vec_id, label, cut.p, x, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) * {entries} + i) as best
  from cut join book{r} as b on cut.p = b.p group by all
)""")
        if r < rounds:
            steps.append(f"""book{r + 1} as materialized (
  with y as (
    select p, cast(best as bigint) % {entries} as i, unnest(x) as x, generate_subscripts(x, 1) as place from near{r}
  ), z as (
    select p, i, list(m order by place) as c from (select p, i, place, floor(sum(x) / count(*)) as m from y group by all) group by p, i
  )
  select b.p, b.i, coalesce(z.c, b.c) as c from book{r} as b left join z using (p, i)
)""")
    return ", ".join(steps) + f""", coded as (
  select vec_id, label, string_agg(printf('%02x', cast(best as bigint) % {entries}), '' order by p) as code, cast(sum(cast(best as bigint) // {entries}) as bigint) as error
  from near{rounds} group by vec_id, label
), written as (
  select sha256(string_agg(array_to_string(list_transform(c, lambda x: cast(cast(x as bigint) as varchar)), ','), ',' order by p, i)) as h from book{rounds}
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256 from coded, written
"""


@query("op12_vector_codes", _lloyd_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = vector_codes.compress(vector_codes.integer_vectors(load(spark, sf_dir, "embeddings")))
    out = vector_codes.with_label_errors(codes).withColumn("codebooks_sha256", F.lit(vector_codes.book_hash(book)))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
  select a.vec_id as anchor_id, a.label, a.e, b.vec_id as positive_id, cast(list_inner_product(a.e, b.e) as bigint) as positive_score
  from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where a.vec_id % 100 = 0
  qualify row_number() over (partition by a.vec_id order by positive_score desc, b.vec_id) <= 5
), n as (
  select anchor_id, positive_id, positive_score, c.vec_id as negative_id, cast(list_inner_product(p.e, c.e) as bigint) as negative_score
  from p join v c on c.label <> p.label where 30 * positive_score <= 100 * negative_score and 100 * negative_score <= 90 * positive_score
)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by negative_score desc, negative_id) as integer) as rank, negative_id, positive_score, negative_score
from n qualify rank <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.labelled(load(spark, sf_dir, "embeddings"), 256, label)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)
