"""Registered queries of the operators for training corpora, each over its whole table, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equitrace.llm import bpe, chat, dedup, jaccard, licenses, mixing, order, sharding, simhash, token_counts, toxicity
from equitrace.llm.text import text_of, word_count
from equitrace.sources.workspace import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: byte limit of a shard
SHARD_BYTES = 1 << 20


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHARD_SQL = f"""
with rows as (
  select doc_id, strlen(coalesce(text, ''))::bigint as n_bytes,
    lpad(bin(('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint), 60, '0') as bits
  from documents),
levels as (select *, unnest(range(0, 41))::int as depth from rows),
sums as (select depth, substr(bits, 1, depth) as prefix, sum(n_bytes) as s from levels group by 1, 2),
fit as (select doc_id, min(l.depth) as depth from levels l join sums s
  on l.depth = s.depth and substr(l.bits, 1, l.depth) = s.prefix where s.s <= {SHARD_BYTES} group by 1)
select doc_id, n_bytes, f.depth, substr(bits, 1, f.depth) as shard from rows join fit f using (doc_id)
"""


@query("op1_shard_by_extendible_hash", SHARD_SQL)
def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def _digest_parts(digest: str):
    """A SHA-256 digest as four numbers, which aggregates carry without strings."""
    return [F.conv(F.substring(digest, 1 + 16 * k, 16), 16, -10).cast("long").alias(f"d{k}") for k in range(4)]


def _row_keys(docs: DataFrame) -> DataFrame:
    """Adds file and row, which tell all rows of a Parquet table apart, whatever their ids.

    They come from the files themselves, so every scan and every retry gives a row the same key.
    """
    return docs.withColumns({"file": F.xxhash64("_metadata.file_path"), "row": F.col("_metadata.row_index")})


@query("op2_simhash_fingerprints")
def fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and its edited form; the edited form ends in the beginning of the next document.

    Rows are joined and vote by their place in the files: null and repeated ids are rows like others. Rows
    of one id follow each other in the ring by length, text and place.
    """
    rows = _row_keys(table(spark, sf_dir, "documents")).select("file", "row", "doc_id", text_of().alias("text"))
    sizes = rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("body"), "file", "row"
    )
    ring = order.next_below(sizes, "doc_id", ["n_chars", "body", "file", "row"])
    cut = F.floor(F.col("n_chars") / 3).cast("int").alias("cut")
    ring = ring.select(
        F.col("file").alias("owner_file"), F.col("row").alias("owner_row"), "doc_id", "n_chars",
        "next_doc_id", "next_file", "next_row", cut,
    )
    # both joins read the texts by the same exchange
    docs = rows.select("file", "row", "text")
    heads = docs.join(ring, (docs["file"] == ring["next_file"]) & (docs["row"] == ring["next_row"]))
    heads = heads.select(*[c for c in ring.columns], F.left("text", F.col("cut")).alias("head"))
    both = docs.join(heads, (docs["file"] == heads["owner_file"]) & (docs["row"] == heads["owner_row"])).withColumn(
        "edited", F.concat(F.left("text", (F.col("n_chars") - F.col("cut")).cast("int")), "head")
    )
    # shingles that end before the last word of the kept part are the same in both texts
    kept_words = word_count(F.left("text", (F.col("n_chars") - F.col("cut")).cast("int"))).cast("int")
    both = both.withColumn("digest", F.sha2(F.encode("edited", "UTF-8"), 256))
    carry = ("doc_id", "n_chars", "next_doc_id", "next_file", "next_row", "d0", "d1", "d2", "d3")
    both = both.select(
        "file", "row", *carry[:5], "text", "edited", *_digest_parts("digest"),
        F.greatest(F.lit(0), kept_words - simhash.SHINGLE).alias("shared"),
    )
    both = simhash.with_terms(simhash.with_terms(both, "text", "own"), "edited", "tail", "shared")
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.slice("own", F.lit(1), F.col("shared")).alias("terms")),
        F.struct(F.lit(1).alias("kind"), F.slice("own", F.col("shared") + 1, F.size("own")).alias("terms")),
        F.struct(F.lit(2).alias("kind"), F.col("tail").alias("terms")),
    )
    versions = both.select("file", "row", *carry, F.inline(kinds))
    votes = simhash.count_votes(versions, ["file", "row", "kind"], "terms", carry)
    prints = simhash.fingerprints(
        votes, ["file", "row"], {"own": "kind <= 1", "edited": "kind <> 1"}, carry
    )
    prints = stage(prints, "simhash")
    following = prints.select(
        F.col("file").alias("next_file"), F.col("row").alias("next_row"), F.col("own").alias("following")
    )
    out = prints.join(following, ["next_file", "next_row"])
    digest = F.concat(*[F.lower(F.lpad(F.hex(f"d{k}"), 16, "0")) for k in range(4)])
    return out.select(
        "doc_id",
        "n_chars",
        digest.alias("edited_sha256"),
        simhash.as_hex(F.col("own")).alias("fingerprint"),
        simhash.as_hex(F.col("edited")).alias("edited_fingerprint"),
        simhash.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        simhash.likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


MIX_SQL = f"""
with recursive rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as tokens from documents),
sums as (select source, count(*) as n_rows, sum(tokens)::bigint as tokens from rows group by 1),
shares as (select *, tokens / (select sum(tokens) from sums)::double as share from sums),
live as (select share from shares where share > 0),
goal as (select {mixing.TARGET_ENTROPY} * ln(count(*)) as goal from live),
by_entropy(i, lo, hi) as (
  select 0, 0.0::double, 1.0::double
  union all
  select i + 1, case when h >= goal then (lo + hi) / 2 else lo end, case when h >= goal then hi else (lo + hi) / 2 end
  from (select i, lo, hi, ln(sum(pow(share, (lo + hi) / 2)))
      - sum(pow(share, (lo + hi) / 2) * ((lo + hi) / 2) * ln(share)) / sum(pow(share, (lo + hi) / 2)) as h
    from by_entropy, live where i < {mixing.STEPS} group by 1, 2, 3), goal),
first as (select case when (select -sum(share * ln(share)) from live) < (select goal from goal)
  then (select lo from by_entropy where i = {mixing.STEPS}) else 1.0::double end as a),
by_passes(i, lo, hi) as (
  select 0, (select a from first), 1.0::double
  union all
  select i + 1, case when p > {mixing.MAX_PASSES} then (lo + hi) / 2 else lo end,
    case when p > {mixing.MAX_PASSES} then hi else (lo + hi) / 2 end
  from (select i, lo, hi, max(pow(share, (lo + hi) / 2 - 1)) / min(pow(share, (lo + hi) / 2 - 1)) as p
    from by_passes, live where i < {mixing.STEPS} group by 1, 2, 3)),
exponent as (select case when (select max(pow(share, a - 1)) / min(pow(share, a - 1)) from live, first) > {mixing.MAX_PASSES}
  then (select hi from by_passes where i = {mixing.STEPS}) else (select a from first) end as a),
plan as (
  select source, n_rows, tokens,
    coalesce(round(case when share > 0 then pow(share, a - 1) end
      / (select min(pow(share, a - 1)) from live, exponent), {mixing.PLACES}), 1.0) as passes
  from shares, exponent),
budget as (select *, floor(passes)::bigint as whole, floor((passes - floor(passes)) * tokens)::bigint as partial,
  ceil(n_rows / {mixing.BLOCK_ROWS})::bigint as blocks from plan),
placed as (select r.*, b.whole, b.partial,
    ('0x' || substr(md5('block|' || doc_id), 1, 15))::bigint % b.blocks as block
  from rows r join budget b on r.source is not distinct from b.source),
passes as (select *, unnest(range(1, whole + case when partial > 0 then 2 else 1 end)) as pass from placed),
keyed as (select *,
    ('0x' || substr(md5('turn|' || coalesce(source, '') || '|' || pass || '|' || block), 1, 15))::bigint as turn,
    ('0x' || substr(md5('rank|' || doc_id || '|' || pass), 1, 15))::bigint as rank
  from passes),
lined as (select *, row_number() over line as position, sum(tokens) over line as upto
  from keyed window line as (partition by source, pass order by turn, block, rank, doc_id, tokens))
select doc_id, source, tokens, pass, block, position from lined where pass <= whole or upto - tokens < partial
"""


@query("op3_mix_sources", MIX_SQL)
def mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy and its position in the permutation of its source's pass."""
    copies, _ = mixing.mixture(table(spark, sf_dir, "documents"))
    return copies


DEDUP_SQL = """
with t as (select doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents)
select doc_id, max(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size,
  doc_id = max(doc_id) over (partition by body) as kept, sha256(body) as text_sha256
from t
"""


@query("op6_exact_dedup", DEDUP_SQL)
def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(
        table(spark, sf_dir, "documents"), carry={"text_sha256": dedup.text_digest()}
    )


CHAT_SQL = """
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))
    + case when again then 8 else length(role) + 4 end + case when final then 7 else 0 end)::bigint as formatted_chars
from (select *, coalesce(lag(role) over w = role, false) as again, coalesce(lead(role) over w <> role, true) as final
  from t window w as (partition by conv_id order by turn, role, text))
group by 1
"""


@query("op9_format_chats", CHAT_SQL)
def format_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted strings and their masks."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    chats = chat.format_chats(turns.unionByName(planted))
    back = chats.select(
        "conv_id", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"),
    )
    listing = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(listing, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: files whose ids the token queries must give
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
TOKEN_LIMIT = 512


@query("op8_bpe_encode_decode")
def encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query("op10_token_counts")
def count_document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), TOKEN_LIMIT
    )


@query("op7_toxicity")
def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model, ["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


#: three-word shingles, similar at 90 of 100
NEAR_RULE = jaccard.Rule(3, 90, 100)


@query("op4_ngram_jaccard_join")
def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_components(table(spark, sf_dir, "documents"), NEAR_RULE)
    return found.select("doc_id", "n_shingles", "component_id")


_TEMPLATE_ROWS = ", ".join(
    f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(licenses.TEMPLATES)
)
_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"
LICENCE_SQL = f"""
with files as (
  select doc_id, coalesce(text, '') as text, coalesce(source, '') || '/' || coalesce(lang, '') as dir from documents),
templates(template, licence, text) as (values {_TEMPLATE_ROWS}),
tt as (select template, licence, word, count(*) as tf
  from (select template, licence, unnest({_WORDS.format('text')}) as word from templates) group by 1, 2, 3),
n as (select count(*) as n from files),
df as (select word, count(*) as df from (select unnest(list_distinct({_WORDS.format('text')})) as word from files)
  group by 1),
idf as (select v.word, ln((n + 1.0) / (coalesce(df, 0) + 1)) + 1 as idf
  from (select word from tt union select word from df) v left join df using (word), n),
tw as (select template, licence, word, tf * idf as weight, sqrt(sum(tf * idf * tf * idf) over (partition by template)) as norm
  from tt join idf using (word)),
bodies as (select doc_id, unnest([text] || string_split(text, chr(10)) || regexp_split_to_array(text, '\n[ \t\r]*\n')) as body,
  generate_subscripts([text] || string_split(text, chr(10)) || regexp_split_to_array(text, '\n[ \t\r]*\n'), 1) - 1 as unit
  from files),
tf as (select doc_id, unit, word, count(*) as tf
  from (select doc_id, unit, unnest({_WORDS.format('body')}) as word from bodies) group by 1, 2, 3),
weighted as (select doc_id, unit, t.word, t.tf * idf as w from tf t join idf using (word)),
lengths as (select doc_id, unit, sqrt(sum(w * w)) as length from weighted group by 1, 2),
scores as (select doc_id, unit, licence, template, round(sum(w * weight) / (any_value(length) * any_value(norm)), 6) as score
  from weighted join tw using (word) join lengths using (doc_id, unit) group by 1, 2, 3, 4),
good as (select * from scores where score >= {licenses.LIMIT}),
own as (select doc_id, min(licence) as licence, any_value(score) as score, bool_or(whole) as whole
  from (select *, rank() over (partition by doc_id order by score desc) as r,
    bool_or(unit = 0) over (partition by doc_id) as whole from good) where r = 1 group by 1),
givers as (select dir, licence, score from own join files using (doc_id) where whole),
giving as (select dir, min(licence) as given
  from (select *, rank() over (partition by dir order by score desc) as r from givers) where r = 1 group by 1)
select doc_id, coalesce(licence, given) as licence,
  case when licence is not null then 'own' when given is not null then 'inherited' else 'none' end as origin, score
from files left join own using (doc_id) left join giving using (dir)
"""


@query("op5_license_scan", LICENCE_SQL)
def license_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree source/lang/doc_id."""
    parts = [F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.col("doc_id").cast("string")]
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_licences(docs, licenses.template_table(spark), "doc_id", F.concat_ws("/", *parts))
