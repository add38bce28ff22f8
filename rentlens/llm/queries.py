"""The queries over the operators of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, own_dir, ship, table
from . import byte_bpe, embedding_dedup, fill_in_middle, hard_negatives, language_id, ngram_join, packing, token_counts, token_files, url_filters
from . import quality_classifier as quality
from .line_dedup import dedup_lines
from .quality_rules import apply_rules


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; a null id is in no fold and has no label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", F.coalesce(language_id.bucket("doc_id", 3) == 1, F.lit(False)))
    stats = cut(quality.describe(docs))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    model = quality.fit(stats.filter(~F.col("held_out")).join(labels, "doc_id"))
    return quality.score(stats, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by given rules, then mined ones. A page's url ends with the number of its document, whose labels say what to block: low quality, or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.try_to_number(F.regexp_extract("url", "/([0-9]{1,18})(?:\\.html)?/?(?:[?#].*)?$", 1), F.lit("9" * 18)).cast("long")
    bad = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    labelled = pages.select("url", number.alias("doc_id")).join(bad, "doc_id").select("url", "blocked")
    return url_filters.judge(pages, labelled).select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.col("clean_text").alias("text"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = own_dir(spark, "token-ids")
    token_files.write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_files.read(spark, path)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_failed_lines", "chars_lost")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; one with a null id is not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(language_id.bucket("doc_id", 4) == 2, F.lit(False)))
    model = language_id.train(docs.filter(~F.col("held_out")), "text", "lang")
    return language_id.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode_column(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern).drop("text")
    return byte_bpe.decode_column(ids, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    return token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"), text="body", keep=["doc_id"])


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2(c.cast("binary"), 256).alias(n) for c, n in ((F.col("output"), "output_sha256"), (text, "restored_sha256"))]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


SQL_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP4_SQL = f"""
with ls as (
  select doc_id, coalesce(text, '') as body, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
full_lines as (
  select doc_id, i, trim(line, {SQL_BLANKS}) as line, row_number() over (partition by doc_id order by i) as k
  from ls where trim(line, {SQL_BLANKS}) <> ''),
w as (
  select doc_id, k, line || chr(10) || lead(line, 1) over p || chr(10) || lead(line, 2) over p as h
  from full_lines window p as (partition by doc_id order by k)),
later as (
  select doc_id, k from (select *, row_number() over (partition by h order by doc_id, k) as rn from w where h is not null) where rn > 1),
gone as (select distinct doc_id, k + j as k from later, (values (0), (1), (2)) t(j)),
kept as (
  select ls.doc_id, ls.i, ls.line, f.k is not null as is_full, g.k is not null as gone
  from ls left join full_lines f on f.doc_id = ls.doc_id and f.i = ls.i left join gone g on g.doc_id = f.doc_id and g.k = f.k)
select doc_id, count(*) filter (is_full) as n_lines, count(*) filter (gone) as n_removed,
       coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as text
from kept group by doc_id
"""

# Fixed values as in the contract of the query, written out: they don't follow the operator's.
_PHRASE_SQL = (
    "accept cookies|alle rechte vorbehalten|all rights reserved|click here|conditions générales|cookie policy|copyright \\(c\\)|copyright ©|datenschutzerklärung|enable javascript|"
    "haga clic aquí|iniciar sesión|licensed under|log in|mentions légales|politique de confidentialité|política de privacidad|privacy policy|released under|se connecter|sign up|"
    "subscribe to|terms of service|terms of use|todos los derechos reservados|tous droits réservés"
)
_END_SQL = "[.!?:;…؛؟۔।॥。！．：；？｡][\"'')\\]»”’」』】）]*$"
_SEPS_SQL = "length(line) - length(translate(line, '|>·•»', ''))"

OP6_SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as body,
         [x for x in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] as w from documents),
ls_i as (select doc_id, unnest(string_split(body, chr(10))) as line, generate_subscripts(string_split(body, chr(10)), 1) as i from d),
ls as (select doc_id, line, lead(line) over (partition by doc_id order by i) as after from ls_i),
full_lines as (select doc_id, i, trim(line, {SQL_BLANKS}) as line from (select doc_id, i, line from ls_i) where trim(line, {SQL_BLANKS}) <> ''),
around as (select doc_id, i, line, lag(line) over p as before, lead(line) over p as after from full_lines window p as (partition by doc_id order by i)),
firsts as (select line, before, after from around where length(line) <= 120 qualify row_number() over (partition by doc_id, line order by i) = 1),
repeated as (
  select line from (select distinct line, before, after from firsts) group by line having count(*) >= 20 and count(*) >= (select count(*) from documents) / 2000.0),
f as (
  select doc_id, line, after, length(translate(line, {SQL_BLANKS}, '')) as chars,
         len([x for x in regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+') if x <> '']) as n,
         right(rtrim(line, {SQL_BLANKS}), 4) as trimmed
  from ls where length(translate(line, {SQL_BLANKS}, '')) > 0),
judged as (
  select *, (not regexp_matches(trimmed, '{_END_SQL}') and not (n >= 6 and coalesce(regexp_matches(after, '^[\\x20\\x09]*\\p{{Ll}}'), false)))
      or length(line) - length(replace(replace(line, '!!', ''), '??', '')) >= n
      or 3 * (length(line) - length(translate(line, '#*$%&|<>', ''))) >= n
      or ({_SEPS_SQL} >= 3 and 4 * ({_SEPS_SQL}) >= n) or regexp_matches(lower(line), '(^|[^\\p{{L}}\\p{{N}}])({_PHRASE_SQL})([^\\p{{L}}\\p{{N}}]|$)')
      or trim(line, {SQL_BLANKS}) in (select line from repeated) as bad from f),
l as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines, count(*) filter (bad) as n_failed_lines,
         coalesce(sum(chars) filter (bad), 0) as chars_lost from judged group by doc_id),
wins as (select doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win, i from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
rep as (select doc_id, i from (select *, count(*) over (partition by doc_id, win) as c from wins) where c > 1),
cov as (select doc_id, count(distinct i + j) as n from rep, (values (0), (1), (2)) t(j) group by doc_id),
a as (
  select d.doc_id, cast(len(w) as bigint) as n_words, cast(length(translate(body, {SQL_BLANKS}, '')) as bigint) as word_chars,
         cast(length(body) - length(translate(body, '#*$%&|<>', '')) as bigint) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, cast(coalesce(cov.n, 0) as bigint) as n_repeat_words,
         coalesce(n_lines, 0) as n_lines, coalesce(n_failed_lines, 0) as n_failed_lines, cast(coalesce(chars_lost, 0) as bigint) as chars_lost
  from d left join l using (doc_id) left join cov using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 2 * chars_lost <= word_chars as kept from a
"""


OP8_SQL = """
with recursive e as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and list_sum([case when x is null or isnan(x) or isinf(x) then 1 else 0 end for x in embedding]) = 0
    and list_sum([abs(x) for x in embedding]) > 0),
pairs as (
  select a.vec_id as a, b.vec_id as b from e a join e b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98),
reach(node, low) as (
  select a, a from pairs union select p.b, r.low from reach r join pairs p on p.a = r.node where r.low < p.b),
c as (select node, min(low) as low from reach group by node),
n as (select a, count(*) as n from pairs group by a)
select vec_id, coalesce(n.n, 0) as n_links, coalesce(c.low, vec_id) as component_id, coalesce(c.low, vec_id) = vec_id as kept
from embeddings left join c on c.node = vec_id left join n on n.a = vec_id
"""


OP11_SQL = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as q
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and coalesce(list_sum([case when x is null or isnan(x) or isinf(x) then 1 else 0 end for x in embedding]), 0) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score
  from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, id) as r from s where same) where r <= 5),
n as (
  select p.anchor_id, p.id as positive_id, p.score as positive_score, s.id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""

OP13_SQL = """
with d as (
  select doc_id, coalesce(text, '') as body, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u from documents),
c as (
  select *, len(u) as n, [('0x' || substr(h, 8 * k + 1, 8))::bigint for k in [0, 1, 2, 3]] as x from d),
f as (
  select *, least(x[1] % (n + 1), x[2] % (n + 1)) as a, greatest(x[1] % (n + 1), x[2] % (n + 1)) as b,
         case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>') or x[3] % 100 >= 100 then 'plain'
              when x[4] % 100 < 50 then 'spm' else 'psm' end as form from c),
t as (
  select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:], '') as suffix from f)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then body when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(body) as restored_sha256
from t
"""


def _shipped(f):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return query


QUERIES = {f.__name__: _shipped(f) for f in (op1_quality_classifier, op2_url_filters, op3_packing, op4_line_dedup, op5_token_files, op6_quality_rules, op7_language_id, op8_embedding_dedup, op9_byte_bpe, op10_ngram_join, op11_hard_negatives, op12_token_counts, op13_fill_in_middle)}
ORACLE = {"op4_line_dedup": OP4_SQL, "op6_quality_rules": OP6_SQL, "op8_embedding_dedup": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op13_fill_in_middle": OP13_SQL}
