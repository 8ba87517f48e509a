"""SQL counterparts of the catalogue's queries, for DuckDB on the same tables."""

from __future__ import annotations

from labelmill.catalogue import DIM, PREFIX, PROMPT
from labelmill.functions.text import NULL_TOKENS, WHITESPACE
from labelmill.operators import analyze
from labelmill.operators.analyze import WHOLE

WS = f"'{WHITESPACE}'"
TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def before_value(line: str) -> str:
    """A report line up to its value, as an SQL string."""
    return f"'{line.split('%')[0]}'"


def python_round(x: str, digits: int) -> str:
    return f"cast(format('{{:.{digits}f}}', {x}) as double)"


def with_tables(*tables: str) -> str:
    return "with " + ",\n".join(tables) + "\n"


SAMPLES = f"""
samples as (
  select d.doc_id as seq,
         case when d.source = 'src19' then 'new' else d.source end as sheet,
         trim(d.text, {WS}) as input,
         case when l.toxic = 1 then 'toxic' when l.quality = 1 then 'keep'
              when l.quality is not null then 'drop' end as output
  from documents d left join labels l on l.doc_id = d.doc_id)"""

COMPLETE = f"""
complete as (
  select * from samples
  where input is not null and output is not null
    and input not in ({TOKENS}) and output not in ({TOKENS}))"""

CLEAN = """
legal as (select *, sheet = 'new' as is_new from complete where output in ('keep', 'drop')),
all_clean as (
  select * from legal
  qualify row_number() over (partition by is_new, input order by seq desc) = 1),
regular as (select * from all_clean where not is_new)"""

BASE = (SAMPLES, COMPLETE, CLEAN)


def split_tables(
    source: str, stratum: str, train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42
) -> str:
    """CTEs ending in ``tagged``: the rows of ``source`` with their split."""
    return f"""
counted as (select {stratum} as stratum, count(*) as c from {source} group by 1),
sizes as (
  select *, ceil(n_rest::double * ({val}::double / ({train}::double + {val}::double)))::bigint as n_val
  from (select n, n_test, n - n_test as n_rest
        from (select n, ceil(n::double * {test}::double)::bigint as n_test
              from (select sum(c)::bigint as n from counted)))),
q1 as (
  select stratum, c, n_test, n_rest, n_val,
         (c * n_test) // n
         + (row_number() over (order by (c * n_test) % n desc, stratum)
            <= n_test - sum((c * n_test) // n) over ())::int as q_test
  from counted, sizes),
q2 as (
  select stratum, q_test,
         ((c - q_test) * n_val) // n_rest
         + (row_number() over (order by ((c - q_test) * n_val) % n_rest desc, stratum)
            <= n_val - sum(((c - q_test) * n_val) // n_rest) over ())::int as q_val
  from q1),
placed as (
  select s.*, row_number() over (
           partition by {stratum} order by md5('{seed}:' || s.seq), s.seq) as place,
         {stratum} as stratum
  from {source} s),
tagged as (
  select p.* exclude (place, stratum),
         case when place <= q_test then 'test'
              when place <= q_test + q_val then 'val' else 'train' end as split
  from placed p join q2 using (stratum))"""


SETS = f"""{split_tables("regular", "output")},
sets as (
  select seq, sheet, input, output, split, false as injected from tagged
  union all
  select seq, sheet, input, output, split, true
  from all_clean, (values ('train'), ('val')) v(split) where is_new)"""

NAMED = f"""
named as (
  select split as dataset, seq, input, output, injected from sets
  union all
  select '{WHOLE}', seq, input, output, injected from sets
  where not (injected and split <> 'train'))"""


def label_stats(source: str, dataset: str = "dataset") -> str:
    ratio = python_round("count / total::double * 100", 2)
    return f"""
select dataset, label, count, {ratio} as ratio
from (select *, sum(count) over (partition by dataset) as total
      from (select {dataset} as dataset, output as label, count(*) as count
            from {source} group by all))"""


def length_stats(source: str, dataset: str = "dataset") -> str:
    return f"""
select {dataset} as dataset, count(*) as total,
       round_even(sum(length(input))::double / count(*) * 100, 0) / 100 as mean,
       max(length(input)) as max, min(length(input)) as min,
       round(quantile_cont(length(input), 0.5), 6) as p50,
       round(quantile_cont(length(input), 0.9), 6) as p90,
       round(quantile_cont(length(input), 0.99), 6) as p99
from {source} group by 1"""


def label_line(source: str) -> str:
    return f"""
select dataset, row_number() over (partition by dataset order by count desc, label) as place,
       printf('  %-8s  %5d 条  (%5.1f%%)  ', label, count, ratio)
       || repeat('█', floor(ratio / 5)::int) as line
from ({label_stats(source)})"""


def turns(user: str, prefix: str = "") -> str:
    return f"""'system' as system_role, '{PROMPT}' as system_text,
       '{user}' as user_role, '{prefix}' || input as user_text,
       'assistant' as assistant_role, output as assistant_text"""


def hash_sum(text: str) -> str:
    return f"sum(('0x' || substr(md5({text}), 1, 8))::bigint)::bigint"


def records(rows: str, user: str = "input", ids: bool = True) -> str:
    id_columns = "min(id) as first_id, max(id) as last_id, count(distinct id) as ids,"
    record = f"'{PROMPT}', {user}, output"
    return f"""
select split, count(*) as records, {id_columns if ids else ""}
       sum(length({user}))::bigint as chars,
       {hash_sum(f"concat_ws('|', {'id::varchar, ' if ids else ''}{record})")} as hashes
from (select *, row_number() over (partition by split order by injected, seq) as id
      from {rows}) group by split"""


WITH_FULL = """
with_full as (
  select split, seq, input, output, injected from sets
  union all
  select 'data', seq, input, output, injected from sets where not (injected and split <> 'train'))"""


def cosine(k: int, queries: str, refs: str, threshold: str = "-2") -> str:
    """CTE ``matches``: exact neighbours of (id, v) among (id, v)."""
    return f"""
scored as (
  select q.id as q_id, r.id as r_id,
         round(list_inner_product(q.v, r.v)
               / sqrt(list_inner_product(q.v, q.v) * list_inner_product(r.v, r.v)), 12) as score
  from ({queries}) q, ({refs}) r),
matches as (
  select q_id, r_id, score, row_number() over (partition by q_id order by score desc, r_id) as rank
  from scored where score >= {threshold} qualify rank <= {k})"""


def side(where: str) -> str:
    return f"select vec_id as id, embedding::double[] as v from embeddings where {where}"


DENSE3 = cosine(3, side("label = 1"), side("label = 0"))
ALL1, ALL3 = (cosine(k, side("label < 5"), side("label >= 5")) for k in (1, 3))
SHOWN = f"q_id, r_id, rank, {python_round('score', 4)} as similarity"


def lexical(k: int, threshold: str) -> str:
    return f"""
reviewed as (
  select doc_id as id, text, toxic = 1 as is_query
  from documents join labels using (doc_id) where toxic = 1 or quality = 1),
tf as (
  select id, is_query, token, count(*) as c
  from (select id, is_query, unnest(string_split(lower(text), ' ')) as token from reviewed)
  where token <> '' group by all),
norms as (select id, sqrt(sum(c * c)::double) as norm from tf group by id),
dots as (
  select q.id as q_id, r.id as r_id, sum(q.c * r.c)::double as dot
  from tf q join tf r using (token) where q.is_query and not r.is_query group by all),
scored as (
  select q.id as q_id, r.id as r_id, coalesce(round(dot / (nq.norm * nr.norm), 12), 0) as score
  from reviewed q join reviewed r on q.is_query and not r.is_query
  left join dots on q_id = q.id and r_id = r.id
  left join norms nq on nq.id = q.id left join norms nr on nr.id = r.id),
matches as (
  select q_id, r_id, score, row_number() over (partition by q_id order by score desc, r_id) as rank
  from scored where score >= {threshold} qualify rank <= {k})"""


def hashed(source: str) -> str:
    """CTE ``weights`` (id, bucket, weight): unit vectors of hashed token counts, as floats."""
    return f"""
hits as (
  select id, ('0x' || substr(md5(token), 1, 8))::bigint % {DIM} as bucket, count(*) as c
  from (select id, unnest(string_split(lower(text), ' ')) as token from {source})
  where token <> '' group by all),
weights as (
  select id, bucket, (c / sqrt(sum(c * c) over (partition by id)::double))::float::double as weight
  from hits)"""


MEMBERS = f"""
members as (
  select row_number() over (order by conv_id, turn) - 1 as seq, 'conversations' as sheet,
         trim(text, {WS}) as input, trim(role, {WS}) as output
  from conversations
  union all
  select doc_id + (select count(*) from conversations), 'new', trim(text, {WS}), trim(lang, {WS})
  from documents)"""

RECORD_ROWS = "(select *, is_new as injected, 'data' as split from all_clean)"

ORACLES: dict[str, str] = {
    "load_samples": f"""{with_tables(MEMBERS)}
select seq, sheet, md5(input) as input_md5, output as role from members""",
    "load_separated_counts": f"""{with_tables(MEMBERS)}
select if(sheet = 'new', 'new', 'regular') as part, count(*) as rows, sum(length(input))::bigint as chars
from members group by 1""",
    "load_folder_counts": f"""
select source as sheet, count(*) as rows, sum(length(input))::bigint as chars,
       {hash_sum("coalesce(input, '-') || '|' || coalesce(lang, '-')")} as hashes,
       (sum(count(*)) over (order by source) - count(*))::bigint as first_seq,
       (sum(count(*)) over (order by source) - 1)::bigint as last_seq, count(*) as numbers
from (select source, trim(text, {WS}) as input, trim(lang, {WS}) as lang from documents)
group by source""",
    "load_csv_members": f"""
with rows as (
  select 'conversations' as sheet, trim(text, {WS}) as input, trim(role, {WS}) as output
  from conversations
  union all
  select 'documents', trim(text, {WS}), trim(lang, {WS}) from documents)
select sheet, count(*) as rows, sum(length(input))::bigint as chars,
       {hash_sum("coalesce(input, '-') || '|' || coalesce(output, '-')")} as hashes,
       (sum(count(*)) over (order by sheet) - count(*))::bigint as first_seq,
       (sum(count(*)) over (order by sheet) - 1)::bigint as last_seq, count(*) as numbers
from rows group by sheet""",
    "member_counts": f"""{with_tables(SAMPLES)}
select coalesce(sheet, 'all') as sheet, count(*) as rows from samples group by rollup (sheet)""",
    "normalize_text": f"""
select doc_id, length(t) as chars, md5(t) as text_md5
from (select doc_id, trim('　 ' || chr(9) || chr(31) || text || ' ' || chr(13) || chr(10) || ' ', {WS}) as t
      from documents)""",
    "null_tokens": f"""{with_tables(SAMPLES)}
select seq, if(coalesce(output, 'nan') in ({TOKENS}), '-', output) as output,
       coalesce(input in ({TOKENS}), true) as input_missing from samples""",
    "drop_null_rows": f"{with_tables(SAMPLES, COMPLETE)} select seq, sheet, output from complete",
    "legal_labels": f"""{with_tables(SAMPLES, COMPLETE)}
select seq, sheet, output from complete where output in ('keep', 'drop')""",
    "illegal_label_values": f"""{with_tables(SAMPLES, COMPLETE)}
select output, count(*) as rows from complete where output not in ('keep', 'drop') group by 1""",
    "dedup_keep_last": f"{with_tables(*BASE)} select seq, output, md5(input) as input_md5 from regular",
    "dedup_whole_documents": """
select max(doc_id) as seq, md5(text) as input_md5 from documents group by text""",
    "validation_metrics": f"""{with_tables(*BASE)},
parts as (
  select if(s.sheet = 'new', 'new', 'regular') as part, count(*) as raw_count,
         count(*) - count(c.seq) as null_count,
         count(*) filter (where c.output not in ('keep', 'drop')) as invalid_label_count,
         count(*) filter (where c.output in ('keep', 'drop')) as legal_count
  from samples s left join complete c on c.seq = s.seq group by 1),
finals as (
  select if(is_new, 'new', 'regular') as part, count(*) as final_count from all_clean group by 1)
select part, raw_count, null_count, invalid_label_count,
       legal_count - final_count as duplicate_count, final_count,
       raw_count - final_count as removed_count, final_count > 0 as is_valid
from parts join finals using (part)""",
    "label_counts": f"{with_tables(*BASE)} select output, count(*) as rows from regular group by 1",
    "stratified_split": f"""{with_tables(*BASE, split_tables("regular", "output"))}
select seq, output, split from tagged""",
    "random_split": f"""{with_tables(*BASE, split_tables("regular", "''"))}
select seq, output, split from tagged""",
    "split_fallback": f"""{with_tables(
        "docs as (select doc_id as seq, doc_id::varchar as output from documents)",
        split_tables("docs", "''"))}
select seq, output, split from tagged""",
    "split_by_source": f"""{with_tables(
        "docs as (select doc_id as seq, source as output from documents)",
        split_tables("docs", "output", 0.7, 0.2, 0.1, 7))}
select seq, output, split from tagged""",
    "split_null_labels": f"""{with_tables(
        SAMPLES, split_tables("samples", "coalesce('=' || output, '')"))}
select seq, coalesce(output, '-') as output, split from tagged""",
    "ids_null_group": f"""{with_tables(SAMPLES)}
select coalesce(output, '-') as output, seq,
       row_number() over (partition by output order by seq) as id from samples""",
    "record_ids_sparse": """
select source, doc_id * 200000 as seq,
       row_number() over (partition by source order by doc_id) as id from documents""",
    "export_array_counts": f"""{with_tables(*BASE, SETS)}
select split, count(*) as records,
       sum(('0x' || md5('{PROMPT}|' || input || '|' || output)[1:8])::bigint)::bigint as hashes
from sets group by split""",
    "inject_new": f"{with_tables(*BASE, SETS)} select split, injected, seq, output from sets",
    "split_summary": f"""{with_tables(*BASE, SETS)}
select split, coalesce(output, 'all') as output, count(*) as rows
from sets group by grouping sets ((split, output), (split))""",
    "record_ids": f"""{with_tables(*BASE, SETS)}
select split, row_number() over (partition by split order by injected, seq) as id, seq from sets""",
    "prefix_input": f"""{with_tables(*BASE)}
select seq, md5('{PREFIX}' || input) as input_md5 from regular""",
    "record_openai": f"{with_tables(*BASE)} select seq, {turns('user')} from all_clean",
    "record_internal": f"""{with_tables(*BASE)}
select seq, row_number() over (order by is_new, seq) as id, {turns('human', PREFIX)}
from all_clean""",
    "record_ark": f"""{with_tables(*BASE)}
select seq, '{PROMPT}' as instruction, input, output from all_clean""",
    "export_counts": f"{with_tables(*BASE, SETS)} {records('sets')}",
    "label_stats": f"{with_tables(*BASE)} {label_stats('all_clean', repr(WHOLE))}",
    "length_stats": f"{with_tables(*BASE)} {length_stats('all_clean', repr(WHOLE))}",
    "split_label_report": f"{with_tables(*BASE, SETS, NAMED)} {label_stats('named')}",
    "split_report": f"{with_tables(*BASE, SETS, NAMED)} {length_stats('named')}",
    "label_bars": f"""{with_tables(
        "docs as (select lang || '/' || source as output from documents)")}
{label_line("(select '" + WHOLE + "' as dataset, output from docs)")}""",
    "label_lines_many": label_line("""(
  select 'documents' as dataset, doc_id::varchar as output from documents
  union all select 'sources', source from documents)"""),
    "length_stats_empty_set": f"""{with_tables(*BASE)}
{length_stats('all_clean', 'output')}
union all select 'none', 0, null, null, null, null, null, null""",
    "report_text": f"""{with_tables(*BASE, SETS, NAMED)},
stats as ({length_stats('named')}),
lines as (
  select dataset, unnest(['{analyze.RULE}', {before_value(analyze.TITLE)} || dataset,
                          '{analyze.RULE}', {before_value(analyze.TOTAL)} || total, '',
                          '{analyze.LABELS}']) as line,
         unnest(range(6)) as pos from stats
  union all
  select dataset, line, 5 + place from ({label_line('named')})
  union all
  select dataset, unnest(['', '{analyze.LENGTHS}',
                          {before_value(analyze.MEAN)} || format('{{:.1f}}', mean),
                          {before_value(analyze.MAX)} || max, {before_value(analyze.MIN)} || min,
                          {before_value(analyze.P50)} || format('{{:.1f}}', p50),
                          {before_value(analyze.P90)} || format('{{:.1f}}', p90),
                          {before_value(analyze.P99)} || format('{{:.1f}}', p99),
                          '{analyze.RULE}']),
         unnest(range(1000, 1009)) from stats)
select dataset, row_number() over (partition by dataset order by pos) as line_no, line from lines""",
    "topk_cosine": f"{with_tables(ALL1)} select {SHOWN} from matches",
    "topk3_cosine": f"{with_tables(ALL3)} select {SHOWN} from matches",
    "nearest_few_references": f"""{with_tables(cosine(2, side("label > 0"), side("label = 0")))}
select {SHOWN} from matches""",
    "all_nearest_vectors": f"""{with_tables(cosine(2, side("label < 5"), side("label >= 5")))}
select {SHOWN} from matches""",
    "conflict_pairs": f"""{with_tables(DENSE3)}
select {SHOWN}, d.text as input, e.text as similar_text
from matches join documents d on d.doc_id = q_id join documents e on e.doc_id = r_id
where score >= 0.35""",
    "conflict_summary": f"""{with_tables(DENSE3)}
select (select count(*) from embeddings where label = 1) as total_checked,
       count(distinct q_id) as high_risk_count, count(*) as high_risk_rows,
       0.35::double as threshold, 3::bigint as topk
from matches where score >= 0.35""",
    "score_range": f"""{with_tables(ALL3)}
select {python_round('min(score)', 4)} as min_similarity,
       {python_round('max(score)', 4)} as max_similarity from matches""",
    "conflict_lexical": f"{with_tables(lexical(1, '0.9'))} select {SHOWN} from matches",
    "topk3_lexical": f"{with_tables(lexical(3, '-2'))} select {SHOWN} from matches",
    "near_documents": f"""{with_tables(
        "docs as (select doc_id as id, text from documents)",
        hashed("docs"),
        """norms as (select id, sqrt(sum(weight * weight)) as norm from weights group by id),
dots as (
  select a.id as q_id, b.id as r_id, sum(a.weight * b.weight) as dot
  from weights a join weights b using (bucket) group by all),
matches as (
  select q_id, r_id, round(dot / (q.norm * r.norm), 12) as score,
         row_number() over (partition by q_id order by score desc, r_id) as rank
  from dots join norms q on q.id = q_id join norms r on r.id = r_id
  where score >= 0.99 qualify rank <= 3)""")} select {SHOWN} from matches""",
    "lexical_all_documents": f"""{with_tables("""
tf as (
  select id, token, count(*) as c
  from (select doc_id as id, unnest(string_split(lower(text), ' ')) as token from documents)
  where token <> '' group by all),
norms as (select id, sqrt(sum(c * c)::double) as norm from tf group by id),
dots as (
  select q.id as q_id, r.id as r_id, sum(q.c * r.c)::double as dot
  from tf q join tf r using (token) group by all),
matches as (
  select q_id, r_id, round(dot / (nq.norm * nr.norm), 12) as score,
         row_number() over (partition by q_id order by score desc, r_id) as rank
  from dots join norms nq on nq.id = q_id join norms nr on nr.id = r_id
  where score >= 0.9 qualify rank <= 3)""")} select {SHOWN} from matches""",
    "l2_normalize": """
select vec_id, unnest(range(len(v))) as pos,
       unnest([round(if(norm > 0, x / norm, 0), 6) for x in v]) as value
from (select vec_id, v, sqrt(list_inner_product(v, v)) as norm
      from (select vec_id, [x::double * (label * 2) for x in embedding] as v
            from embeddings))""",
    "embed_hashed": f"""{with_tables(
        "docs as (select doc_id as id, text from documents)", hashed("docs"))}
select id as doc_id, bucket, weight from weights""",
    "embedding_cache_merge": f"""{with_tables(
        "docs as (select min(doc_id) as id, text from documents group by text)", hashed("docs"))}
select id as doc_id, bucket, weight from weights""",
    "job_full": f"{with_tables(*BASE, SETS, WITH_FULL)} {records('with_full')}",
    "job_split": f"{with_tables(*BASE, SETS)} {records('sets', ids=False)}",
    "job_convert": f"""{with_tables(SAMPLES, COMPLETE)},
kept as (
  select 'data' as split, false as injected, * from complete where output in ('keep', 'drop')
  qualify row_number() over (partition by input order by seq desc) = 1)
{records('kept', f"'{PREFIX}' || input")}""",
    "job_clean": f"""{with_tables(SAMPLES, COMPLETE)}
select output, md5(input) as input_md5 from complete where output in ('keep', 'drop')
qualify row_number() over (partition by input order by seq desc) = 1""",
    "job_conflict": f"""{with_tables(
        SAMPLES, COMPLETE,
        '''texts as (
  select input as text, output = 'toxic' as is_query, min(seq) as id, count(*) as n
  from complete where output in ('toxic', 'keep') group by all)''',
        hashed("texts"),
        '''pairs as (
  select q.id as q_id, r.id as r_id, round(dot / sqrt(q.norm * r.norm), 12) as score, r.n, r.text
  from (select a.id as qa, b.id as rb, sum(a.weight * b.weight) as dot
        from weights a join weights b using (bucket) group by all)
  join (select t.*, s.norm from texts t join (select id, sum(weight * weight) as norm
        from weights group by id) s using (id)) q on q.id = qa and q.is_query
  join (select t.*, s.norm from texts t join (select id, sum(weight * weight) as norm
        from weights group by id) s using (id)) r on r.id = rb and not r.is_query)''',
        '''copied as (select *, unnest(range(1, least(n, 3) + 1)) as copy from pairs)''',
        '''neighbours as (
  select *, row_number() over (partition by q_id order by score desc, r_id, copy) as rank
  from copied qualify rank <= 3)''')}
select c.seq, rank, {python_round('score', 4)} as similarity, md5(p.text) as similar_md5
from neighbours p join texts t on t.id = p.q_id and t.is_query
join complete c on c.output = 'toxic' and c.input = t.text
where score >= 0.9""",
}
