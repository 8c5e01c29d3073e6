"""Registered queries on spelling variants, conversation tries and repeated lines, and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equitrace.llm import linededup, spelling, trie
from equitrace.llm.queries import query, table
from equitrace.sources.workspace import stage

#: crc32 (reflected, polynomial 0xEDB88320) of the ASCII or two-byte letters of a text, in DuckDB
_BYTES = (
    "flatten(list_transform(string_split({0}, ''), lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint] "
    "else [192 + (unicode(ch) >> 6)::bigint, 128 + (unicode(ch) & 63)::bigint] end))"
)
_CRC = (
    "xor(list_reduce([4294967295::bigint] || " + _BYTES + ", lambda c, b: "
    "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)

#: a word's least length and count, the part of runs that lose a code point, how much more a form occurs
WORD_LENGTH, WORD_COUNT, ONE_IN, TIMES = 7, 2, 31, 10

SPELLING_SQL = f"""
with recursive runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as times
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents)
  where length(run) >= {WORD_LENGTH} group by 1, 2),
hashed as (select run, times, {_CRC.format("doc_id::varchar || ':' || run")} as h from runs),
worn as (select times, case when h % {ONE_IN} = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word
  from hashed),
words as materialized (select word, sum(times)::bigint as n from worn where length(word) >= {WORD_LENGTH} group by 1
  having sum(times) >= {WORD_COUNT}),
cuts as materialized (select word, n, unnest(range(1, length(word) + 1)) as k from words),
gaps as materialized (select word, n, k, word[:k - 1] as a, word[k + 1:] as b from cuts),
pairs as (
  select x.word, x.n, y.word as near, y.n as near_n from gaps x join gaps y on x.a = y.a and x.b = y.b and x.k = y.k
    and x.word <> y.word
  union select x.word, x.n, y.word, y.n from gaps x join words y on x.a || x.b = y.word
  union select y.word, y.n, x.word, x.n from gaps x join words y on x.a || x.b = y.word),
ranked as (select *, count(*) over (partition by word) as n_near,
  row_number() over (partition by word order by near_n desc, near collate "binary") as r from pairs),
forms as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when near_n >= {TIMES} * w.n then near end as form, case when near_n >= {TIMES} * w.n then near_n end as form_n
  from words w left join ranked p on p.word = w.word and r = 1),
walk(word, root, form) as (
  select word, word, form from forms
  union all select walk.word, forms.word, forms.form from walk join forms on walk.form = forms.word)
select word, f.form, root, n, n_near, form_n from walk join forms f using (word) where walk.form is null
""".replace(' collate "binary"', "")


@query("op11_spelling_variants", SPELLING_SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"), WORD_LENGTH)
    words = spelling.count_words(spelling.worn_runs(runs, ONE_IN), WORD_LENGTH, WORD_COUNT)
    return spelling.group_variants(words, TIMES)


TRIE_SQL = f"""
with t as (select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  where conv_id is not null),
placed as (select c, row_number() over (partition by c order by turn nulls first, role, text) as pos, role, text from t),
heads as (select c, {_CRC.format("c::varchar")} % 9 as h, c - c % 5 as base from (select distinct c from t)),
given as (select heads.c, pos, role, text from heads join placed on placed.c = base and pos <= h),
rebuilt as (select * from given union all
  select placed.c, pos - h + (select count(*) from given where given.c = placed.c), role, text
  from placed join heads using (c) where pos > h),
seqs as (select c, coalesce(list(struct_pack(r := role, t := text) order by pos) filter (where pos is not null), []) as seq
  from heads left join (select c, pos, role, text from rebuilt) using (c) group by 1),
steps as (select c, seq, unnest(range(0, len(seq) + 1)) as depth from seqs),
members as (select c, depth, seq[:depth] as node, depth = len(seq) as ends,
  case when depth = 0 then 0 else strlen(seq[depth].t) end as size from steps),
nodes as materialized (select node, depth, min(c) as conv_id, count(*) as n_convs, any_value(size) as size,
  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where ends), '')) as ends_sha256 from members group by 1, 2),
linked as materialized (select n.*, p.conv_id as parent_conv_id,
  (select count(*) from nodes k where k.depth = n.depth + 1 and k.node[:n.depth] = n.node) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.node = n.node[:n.depth - 1]),
up as (select node[:d] as node, sum((n_convs - 1) * size)::bigint as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
  from (select *, unnest(range(0, depth + 1)) as d from linked) group by 1)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from linked join up using (node)
"""

#: of each conversation, up to so many turns less one come from the first of its group
SWAPPED, GROUP = 9, 5


def rebuilt_turns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Turn ids of the rebuilt conversations, and all conversations.

    The first h turns come from the first conversation of the group; the own turns after the first h
    follow, moved up where that conversation has fewer. Only h < 9 turns of a conversation are joined.
    """
    placed = stage(trie.turn_ids(trie.place_turns(table(spark, sf_dir, "conversations"))), "trie-turns")
    conv = F.col("conv_id")
    h = (F.crc32(F.encode(conv.cast("string"), "UTF-8")) % SWAPPED).cast("long")
    conversations = placed.where("pos = 1").select("conv_id", h.alias("h"), (conv - conv % GROUP).alias("base"))
    heads = placed.where(F.col("pos") < SWAPPED).join(conversations.where("conv_id = base").select("conv_id"), "conv_id")
    heads = heads.withColumnRenamed("conv_id", "base")
    given = conversations.join(heads, "base").where("pos <= h").select("conv_id", "pos", "a", "b", "s")
    has = heads.groupBy("base").agg(F.count("*").alias("has"))
    own = placed.withColumns({"h": h, "base": conv - conv % GROUP}).where("pos > h").join(has, "base", "left")
    missing = F.col("h") - F.least("h", F.coalesce("has", F.lit(0).cast("long")))
    own = own.select("conv_id", (F.col("pos") - missing).alias("pos"), "a", "b", "s")
    return given.unionByName(own), conversations.select("conv_id")


@query("op12_conversation_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*rebuilt_turns(spark, sf_dir))


#: documents and code points from which on a line counts as repeated
LINE_DOCS, LINE_CHARS = 3, 20

LINES_SQL = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
repeated as (select key, max(doc_id) as keeper from keyed where length(key) >= {LINE_CHARS}
  group by 1 having count(distinct doc_id) >= {LINE_DOCS}),
marked as (select k.*, r.key is not null and keeper <> doc_id as gone from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by 1
"""


@query("op13_line_dedup", LINES_SQL)
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_repeated_lines(table(spark, sf_dir, "documents"), LINE_DOCS, LINE_CHARS)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
