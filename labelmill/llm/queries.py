"""The operators of this folder as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm import (
    bottom_k,
    filter_audit,
    fingerprint,
    jaccard,
    licenses,
    packing,
    periodic,
    pieces,
    pii,
    repeats,
    simple8b,
    toxicity,
    voronoi,
)
from labelmill.sources.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_voronoi_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Every hundredth vector's ten best others."""
    vectors = _table(spark, sf, "embeddings")
    return voronoi.top_k(vectors, is_query=F.col("vec_id") % 100 == 0, k=10, scale=1024)


ORACLES["op1_voronoi_top_k"] = """
with v as (
    select row_number() over () as r, vec_id,
           list_transform(embedding, lambda x: floor(1024 * x::double)) as e
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), s as (
    select q.r, q.vec_id as query_id, x.vec_id,
           list_inner_product(q.e, x.e)::bigint as score
    from v q join v x on q.vec_id % 100 = 0 and q.r <> x.r
), r as (
    select *, row_number() over (partition by r order by score desc, vec_id) as rank from s
)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10
"""


@query
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """License notices in every document."""
    return licenses.scan(_table(spark, sf, "documents"))


@query
def op3_bin_slack_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents' ids in sequences of 1024."""
    docs = _table(spark, sf, "documents")
    return packing.digests(packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0))


@query
def op4_backtracking_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of every document, and the text decoded from them."""
    docs = _table(spark, sf, "documents")
    return pieces.digests(pieces.encode(docs, vocabulary("piece_bpe_32k.model")))


@query
def op5_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Documents joined by 85 hundredths of their four-word shingles."""
    return jaccard.similar_components(_table(spark, sf, "documents"), words=4, num=85, den=100)


ORACLES["op5_ngram_jaccard"] = """
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
    from documents
), s as (
    select doc_id, case when len(ws) = 0 then []
        when len(ws) < 4 then [array_to_string(ws, ' ')]
        else list_distinct(list_transform(range(1, len(ws) - 2),
            lambda i: array_to_string(ws[i:i + 3], ' '))) end as sh
    from w
), n as (select doc_id, len(sh)::bigint as n from s),
t as (select doc_id, unnest(sh) as t from s),
p as (
    select a.doc_id as a, b.doc_id as b, count(*) as c
    from t a join t b on a.t = b.t and a.doc_id <> b.doc_id group by all
), l as (
    select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
    where 100 * c >= 85 * (x.n + y.n - c)
), r(doc_id, root) as (
    select doc_id, doc_id from n
    union
    select l.b, r.root from r join l on l.a = r.doc_id
)
select n.doc_id, n.n as n_shingles, min(r.root) as component_id
from n join r using (doc_id) group by all
"""


@query
def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without byte strings of 400 that stand elsewhere too."""
    return repeats.summary(repeats.remove_repeats(_table(spark, sf, "documents"), length=400))


@query
def op7_disclosure_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document, and the terms that reveal it."""
    return pii.digests(pii.find(_table(spark, sf, "documents")))


@query
def op8_ordinal_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Expected severity and grade of every document, from a model fitted on the label table."""
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    model = toxicity.fit(docs, labels, toxicity.severity(F.col("quality"), F.col("toxic")))
    return toxicity.score(docs, model)


@query
def op9_simple8b_ids(spark: SparkSession, sf: str) -> DataFrame:
    """All documents' ids written to Simple-8b files, as they are read back."""
    path = Staging(spark).path("simple8b")
    docs = _table(spark, sf, "documents")
    simple8b.write(docs, vocabulary("byte_bpe_50k.json"), end_id=2, path=path)
    return simple8b.digests(simple8b.read(spark, path))


@query
def op10_quartile_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprint.compare_edited(_table(spark, sf, "documents"))


@query
def op11_bottom_k(spark: SparkSession, sf: str) -> DataFrame:
    """Documents joined by 80 hundredths of their four-word shingles, one of each group kept."""
    docs = _table(spark, sf, "documents")
    return bottom_k.near_duplicates(docs, words=4, num=80, den=100)


ORACLES["op11_bottom_k"] = """
select *, doc_id = component_id as kept from ({linked})
""".format(linked=ORACLES["op5_ngram_jaccard"].replace(">= 85 *", ">= 80 *"))


@query
def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What five filters remove from every source's documents, in all 120 orders."""
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


ORACLES["op12_filter_audit"] = """
with w as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                       lambda x: x <> '') as ws,
           min(doc_id) over (partition by coalesce(text, '')) as first
    from documents
), l as (
    select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic
    from labels group by doc_id
), f as (
    select part, good, toxic,
           case when len(ws) < 50 then 'A' else '' end
           || case when 100 * len(list_distinct(ws)) < 65 * len(ws) then 'B' else '' end
           || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))
                        > 5 * length(t) then 'C' else '' end
           || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
           || case when doc_id > first then 'E' else '' end as fails
    from w left join l using (doc_id)
), m as (
    select part, fails, count(*) as n, count(*) filter (good) as good,
           count(*) filter (toxic) as toxic
    from f group by all
), x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (
    select a.x || b.x || c.x || d.x || e.x as filter_order
    from x a join x b on b.x <> a.x join x c on c.x not in (a.x, b.x)
    join x d on d.x not in (a.x, b.x, c.x) join x e on e.x not in (a.x, b.x, c.x, d.x)
), s as (
    select filter_order, unnest(range(1, 6))::int as step from o
), g as (
    select part, filter_order, step, substr(filter_order, step, 1) as filter, n, good, toxic,
           contains(fails, substr(filter_order, step, 1)) as failing,
           fails = substr(filter_order, step, 1) as alone,
           translate(fails, substr(filter_order, 1, step - 1), '') = fails as before,
           translate(fails, substr(filter_order, 1, step), '') = fails as after
    from m cross join s
), r as (
    select part, filter_order, step, filter,
           coalesce(sum(n) filter (after), 0)::bigint as kept,
           coalesce(sum(n) filter (before and failing), 0)::bigint as removed,
           coalesce(sum(n) filter (not before and failing), 0)::bigint as redundant,
           coalesce(sum(n) filter (alone), 0)::bigint as unique_fails,
           coalesce(sum(good) filter (before and failing), 0)::bigint as good_lost,
           coalesce(sum(toxic) filter (before and failing), 0)::bigint as toxic_lost
    from g group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, filter))::bigint as shapley
from r
"""


@query
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words in every document, some of them given a tail that repeats."""
    docs = periodic.with_tails(_table(spark, sf, "documents"))
    return periodic.summary(periodic.runs(docs))
