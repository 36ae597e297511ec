"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadencia.llm.alignment import align
from cadencia.llm.chat import format_conversations, read_loss, read_turns
from cadencia.llm.common import table
from cadencia.llm.decontam import decontaminate
from cadencia.llm.exact import exact_dedup
from cadencia.llm.lines import line_dedup
from cadencia.llm.mixing import mix
from cadencia.llm.packing import pack
from cadencia.llm.pii import find_pii
from cadencia.llm.quality import score, train
from cadencia.llm.repeats import remove_repeats
from cadencia.llm.sharding import shard
from cadencia.llm.simhash import near_dedup
from cadencia.llm.spelling import spelling_variants


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies",
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=100).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=16)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(
            [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string",
        )
    )
    read = format_conversations(rows).select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256",
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, damage=199)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=4096, end_id=1)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    aligned = align(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.withColumn("groups_sha256", digest).drop("groups")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_quality, op3_mixing, op4_repeats, op5_sharding, op6_pii, op7_chat, op8_line_dedup,
        op9_exact_dedup, op10_simhash, op11_spelling, op12_packing, op13_alignment,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = f"""
with items as (select item_id, words, least(len(words), 13) as n from (select item_id, {_WORDS} as words from benchmark) where len(words) > 0),
wanted as (
  select distinct item_id, array_to_string(words[i : i + n - 1], ' ') as win
  from items, unnest(range(1, len(words) - n + 2)) as u(i)),
docs as (select doc_id, {_WORDS} as words from documents),
places as (
  select doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') as win
  from docs, (select distinct n from items), unnest(range(1, len(words) - n + 2)) as u(i)),
found as (select doc_id, i, n, item_id from places join wanted using (win)),
hit as (select doc_id, count(distinct p) as n_hit from found, unnest(range(i, i + n)) as u(p) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""

# CRC-32 in SQL: the usual table of 256 remainders, folded over the bytes of the text.
_CRC_TABLE = """recursive steps as (
  select i, 0 as s, i::bigint as c from range(256) as r(i)
  union all
  select i, s + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end from steps where s < 8),
crc as (select list(c order by i) as t from steps where s = 8)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(
      list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::bigint)"""


SHARDING_SQL = f"""
with {_CRC_TABLE},
rows as (
  select doc_id, strlen(coalesce(text, '')) + 1 as size, md5(coalesce(text, '')) as digest,
    {_crc32("coalesce(text, '')")} as text_crc32
  from documents, crc),
total as (select sum(size)::hugeint as total from rows),
placed as (
  select *, coalesce(sum(size) over (order by digest, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0)::hugeint as before,
    row_number() over (order by digest, doc_id nulls first, size) - 1 as nth
  from rows),
groups as (select digest, min(before) as b, max(before + size) as e from placed group by digest),
cuts as (
  select k, digest, doc_id, b, e, total from range(1, 16) as r(k), total, placed join groups using (digest)
  where before <= (k * total + 15) // 16 and before + size > (k * total + 15) // 16),
numbered as (
  select p.doc_id, size, text_crc32, nth,
    (select count(*) from cuts c where p.digest > c.digest or (p.digest = c.digest and (
       (16 * (e - b) > total and p.doc_id >= c.doc_id) or (16 * (e - b) <= total and 2 * k * total <= 16 * (b + e)))))::int as shard
  from placed p)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'bytes' as law, shard,
  (nth - min(nth) over (partition by shard))::bigint as slot, null::int as grown_shard
from numbered
"""

CHAT_SQL = """
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select * from (values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) as v(conv_id, turn, role, text)),
turns as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) as previous,
    3 * length(role) - length(replace(replace(replace(role, chr(92), ''), '<', ''), '[', '')) - length(role) as role_chars,
    3 * length(text) - length(replace(replace(replace(text, chr(92), ''), '<', ''), '[', '')) - length(text) as text_chars
  from rows)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  (7 + sum(text_chars + case when previous = role then 6 else role_chars + 19 end))::bigint as formatted_chars
from turns group by conv_id
"""

LINES_SQL = f"""
with lines as (
  select doc_id, line, i, trim(key, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key
  from (select doc_id, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as i,
    unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(string_split({_LOWER}, chr(10))) as key from documents)),
frequent as (select key from lines where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*)::bigint as n_lines, count(f.key)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (f.key is null), '')) as kept_sha256
from lines l left join frequent f using (key) group by doc_id
"""

EXACT_SQL = r"""
with rows as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare from documents),
grouped as (
  select doc_id, first_value(doc_id) over (partition by bare order by n desc, doc_id) as keep_id, count(*) over (partition by bare) as group_size, bare
  from rows)
select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from grouped
"""

# Near words share what is left without the code point at one place (replaced), or one is left of the other (inserted, deleted).
SPELLING_SQL = f"""
with {_CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')) as run from documents),
hashed as (select run, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from runs, crc where length(run) >= 6),
words as (
  select word, count(*) as n
  from (select case when h % 199 = 0 then run[: h % length(run)] || run[h % length(run) + 2 :] else run end as word from hashed)
  where length(word) >= 6 group by word having count(*) >= 5),
less as (select word, n, i, word[: i - 1] || word[i + 1 :] as rest from words, unnest(range(1, length(word) + 1)) as u(i)),
pairs as (
  select a.word, b.word as near, b.n as near_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select l.word, w.word, w.n from less l join words w on l.rest = w.word
  union select w.word, l.word, l.n from less l join words w on l.rest = w.word),
around as (
  select word, count(*) as n_near, first(near order by near_n desc, near) as best, max(near_n) as best_n from pairs group by word),
formed as (
  select word, n, coalesce(n_near, 0) as n_near, case when best_n >= 5 * n then best end as form, case when best_n >= 5 * n then best_n end as form_n
  from words left join around using (word)),
chain as (
  select word, word as at from formed
  union all
  select c.word, f.form from chain c join formed f on f.word = c.at where f.form is not null)
select f.word, f.form, c.at as root, f.n::bigint as n, f.n_near::bigint as n_near, f.form_n::bigint as form_n
from formed f join chain c using (word) join formed e on e.word = c.at where e.form is null
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION_SQL,
    "op5_sharding": SHARDING_SQL,
    "op7_chat": CHAT_SQL,
    "op8_line_dedup": LINES_SQL,
    "op9_exact_dedup": EXACT_SQL,
    "op11_spelling": SPELLING_SQL,
}
