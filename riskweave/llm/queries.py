"""The corpus operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    attention,
    collocations,
    conversations,
    fingerprints,
    jaccard,
    language,
    packing,
    pieces,
    pivots,
    quality,
    sharding,
    toxicity,
    warc,
)
from riskweave.llm.common import mod_crc, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# What SQL can express. The drawn, hashed and learned results have none.
ORACLE: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f):
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8).drop("text_md5")


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(table(spark, sf_dir, "documents"), shards=8, seed=20)
    return rows.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2
    )
    return rows.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    rows = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95, seed=8)


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(mod_crc("doc_id", 5) != 0))
    # Each text with a letter gets a learned language here, so none is rejected.
    return language.identify(docs, model, reject_below=0.0).select(
        "doc_id", (mod_crc("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score"
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = toxicity.labelled(
        docs.filter(mod_crc("doc_id", 3) != 1), table(spark, sf_dir, "labels"), "toxic"
    )
    return toxicity.with_scores(docs, toxicity.fit(learn)).select(
        "doc_id",
        (mod_crc("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


@query
def op13_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    held_out = mod_crc("doc_id", 5) == 1
    subwords = partial(
        attention.Subwords, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    scored = attention.score(docs, attention.fit(docs, ~held_out, subwords))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


ORACLE["op6_warc"] = """
with p as (select page_id, encode(coalesce(html, '')) payload, sha1(coalesce(html, '')) digest from pages),
f as (select digest, max(page_id) first from p where octet_length(payload) >= 1000 group by digest)
select p.page_id, octet_length(payload) payload_bytes, p.digest payload_digest,
       case when f.first is null or f.first = p.page_id then 'response' else 'revisit' end record_type,
       case when f.first <> p.page_id then f.first end refers_to
from p left join f on p.digest = f.digest and octet_length(payload) >= 1000
"""

# The cheapest edits by dynamic programming: per conversation and state the least (cost, audit),
# with the lines that remain. {'c','a','t'} compare in that order.
ORACLE["op11_conversations"] = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') k from conversations),
crcs as (
  select k, xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(k, ''), lambda c: ord(c)::bigint)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
      lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 kind
  from (select distinct k from keyed)),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text
  from keyed join crcs using (k), generate_series(1, case when kind = 3 then 2 else 1 end)
  where kind <> 0),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) i from damaged),
seen as (
  select *, left(role, 1) r, not regexp_matches(text, '[^\x20\x09-\x0D]') blank,
         row_number() over (partition by conv_id, role, text order by i) > 1 again,
         lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) pair
  from ordered),
faulty as (
  select *, not blank and again repeated,
         not blank and not again and regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') cut
  from seen),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint gaps,
         count_if(blank)::bigint blank, count_if(repeated)::bigint duplicate, count_if(cut)::bigint truncated,
         count_if(pair not in ('su', 'ua', 'au'))::bigint illegal, count(*) n
  from faulty group by conv_id),
steps as (
  select conv_id, i, r, role, text, blank or repeated gone, case when cut then 5 else 0 end more from faulty),
walk as (
  select conv_id, 0::bigint i, {'c': 0, 'a': '', 't': []::varchar[]} e, {'c': 999999, 'a': '', 't': []::varchar[]} s,
         {'c': 999999, 'a': '', 't': []::varchar[]} u, {'c': 999999, 'a': '', 't': []::varchar[]} a
  from counts
  union all
  select conv_id, i,
    {'c': e.c + 2, 'a': e.a || 'D', 't': e.t},
    list_min([{'c': s.c + 2, 'a': s.a || 'D', 't': s.t},
      {'c': case when gone or r <> 's' then 999999 else e.c + more end, 'a': e.a || 'K', 't': e.t || [role || ':' || text]}]),
    list_min([{'c': u.c + 2, 'a': u.a || 'D', 't': u.t},
      {'c': case when gone then 999999 else x.c + more + 1 end, 'a': x.a || 'R', 't': x.t || ['user:' || text]},
      {'c': case when gone or r <> 'u' then 999999 else x.c + more end, 'a': x.a || 'K', 't': x.t || [role || ':' || text]}]),
    list_min([{'c': a.c + 2, 'a': a.a || 'D', 't': a.t},
      {'c': case when gone then 999999 else u.c + more + 1 end, 'a': u.a || 'R', 't': u.t || ['assistant:' || text]},
      {'c': case when gone or r <> 'a' then 999999 else u.c + more end, 'a': u.a || 'K', 't': u.t || [role || ':' || text]}])
  from (
    select conv_id, i, r, role, text, gone, more, e, s, u, a, list_min([e, s, a]) x
    from (
      select w.conv_id, p.i, p.r, p.role, p.text, p.gone, p.more, e, s,
        list_min([u, {'c': e.c + 5, 'a': e.a || 'I', 't': e.t || ['user:']}, {'c': s.c + 5, 'a': s.a || 'I', 't': s.t || ['user:']},
          {'c': a.c + 5, 'a': a.a || 'I', 't': a.t || ['user:']}]) u,
        list_min([a, {'c': u.c + 5, 'a': u.a || 'I', 't': u.t || ['assistant:']},
          {'c': e.c + 10, 'a': e.a || 'II', 't': e.t || ['user:', 'assistant:']},
          {'c': s.c + 10, 'a': s.a || 'II', 't': s.t || ['user:', 'assistant:']}]) a
      from walk w join steps p on w.conv_id is not distinct from p.conv_id and p.i = w.i + 1))),
ends as (
  select w.conv_id, list_min([e, a, {'c': u.c + 5, 'a': u.a || 'I', 't': u.t || ['assistant:']},
      {'c': s.c + 10, 'a': s.a || 'II', 't': s.t || ['user:', 'assistant:']}]) best
  from walk w join counts k on w.conv_id is not distinct from k.conv_id and w.i = k.n)
select d.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate,
       coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, coalesce(best.c, 0)::bigint "cost",
       coalesce(best.a, '') audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) repaired_sha256
from (select distinct conv_id from conversations) d
left join counts k on d.conv_id is not distinct from k.conv_id
left join ends f on d.conv_id is not distinct from f.conv_id
"""

ORACLE["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') lang, regexp_extract_all(piece, '[^\x20\x09]+') w
  from (select lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents)),
places as (select lang, w, unnest(range(1, len(w) + 1)) i from pieces),
windows as (select lang, w[i] w1, w[i + 1] w2, w[i + 2] w3 from places),
ones as materialized (select lang, w1, count(*)::hugeint n from windows group by all),
twos as materialized (select lang, w1, w2, count(*)::hugeint n from windows where w2 is not null group by all having count(*) >= 10),
threes as materialized (select lang, w1, w2, w3, count(*)::hugeint n from windows where w3 is not null group by all having count(*) >= 10),
longer as (
  select lang, w1, w2, max(n) n from (select lang, w1, w2, n from threes union all select lang, w2, w3, n from threes) group by all),
cuts as (
  select c.lang, c.w1 || ' ' || c.w2 phrase, c.n a, 1 k, x.n l, y.n r
  from twos c join ones x on x.lang = c.lang and x.w1 = c.w1 join ones y on y.lang = c.lang and y.w1 = c.w2
  left join longer i on i.lang = c.lang and i.w1 = c.w1 and i.w2 = c.w2
  where i.n is null or 100 * i.n < 50 * c.n
  union all
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.n, 1, x.n, y.n
  from threes c join ones x on x.lang = c.lang and x.w1 = c.w1
  join twos y on y.lang = c.lang and y.w1 = c.w2 and y.w2 = c.w3
  union all
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.n, 2, x.n, y.n
  from threes c join twos x on x.lang = c.lang and x.w1 = c.w1 and x.w2 = c.w2
  join ones y on y.lang = c.lang and y.w1 = c.w3),
weakest as (
  select *, 1000000 * a * a // (l * r) score from cuts
  qualify row_number() over (partition by lang, phrase order by score, k) = 1),
totals as (select lang, sum(n) n from ones group by lang)
select * from (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) "rank", phrase,
         a::bigint a, l::bigint l, r::bigint r, n::bigint n, score::bigint score
  from weakest join totals using (lang)) where "rank" <= 2000
"""
