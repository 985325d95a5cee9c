"""The registered queries of the numbered operators and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import (byte_bpe, conversation_repair, language_id, length_buckets, line_dedup, near_duplicates, periodic_runs, pitman_yor,
                          preferences, quality_rules, records, syncmers, token_counts)
from shopflow.llm.common import documents, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Production parameters of packing: padded tokens of a batch, and number of buckets.
BATCH_TOKENS = 16_384
BUCKETS = 16


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def id_remainder(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod n (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def packed_documents(docs: DataFrame) -> DataFrame:
    """Documents packed by their token counts with an end token each."""
    counted = token_counts.count_tokens(docs.select("doc_id", "text"), BYTE_BPE)
    lengths = written(counted.select("doc_id", (F.col("n_tokens") + 1).alias("n_tokens")), "lengths")
    return length_buckets.pack(lengths, "n_tokens", ["doc_id", "n_tokens"], BATCH_TOKENS, BUCKETS)


@query
def op1_length_buckets(spark, sf_dir):
    """Every document's bucket, batch and slot under optimal length buckets and a token budget."""
    return packed_documents(documents(spark, sf_dir))


def preference_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in input of op2: for each conversation, its turns as chosen; as rejected its turns up to
    number conv_id mod 6, and from there on those of the conversation with the next id."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    chosen = turns.select(F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side"), "turn", "role", "text")
    same = turns.where("turn < conv_id % 6").select(F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), "turn", "role", "text")
    other = turns.withColumn("pair_id", F.col("conv_id") - 1).where("turn >= pair_id % 6")
    ids = turns.select(F.col("conv_id").alias("pair_id")).distinct()
    swapped = other.join(ids, "pair_id").select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    return chosen.unionByName(same).unionByName(swapped)


@query
def op2_preferences(spark, sf_dir):
    """Prompt, masked completions and loss spans of every pair."""
    got = preferences.format_pairs(preference_turns(spark, sf_dir))
    return got.select(*[preferences.spans_text(F.col(c)).alias(c) if c.endswith("_spans") else c for c in got.columns])


def _completion(side: str) -> str:
    mine = f"filter (where part = '{side}')"
    span = "cast(start + 13 + length(role) as varchar) || ':' || cast(start + 23 + length(role) + length(text) as varchar)"
    return (f"count(*) {mine} as {side}_turns, coalesce(string_agg(body, '' order by pos) {mine}, '') as {side}, "
            f"coalesce(string_agg({span}, ',' order by pos) filter (where part = '{side}' and role = 'assistant'), '') as {side}_spans")


# 13: the mark that opens a turn and the line break after its role; 10 more: the mark that closes it.
ORACLES["op2_preferences"] = f"""
with src as (
  select conv_id as pair_id, 'chosen' as side, turn, role, text from conversations
  union all select conv_id, 'rejected', turn, role, text from conversations where turn < conv_id % 6
  union all select conv_id - 1, 'rejected', turn, role, text from conversations
    where turn >= (conv_id - 1) % 6 and conv_id - 1 in (select conv_id from conversations)
), turns as (
  select distinct pair_id, side, turn, coalesce(role, '') as role, coalesce(text, '') as text from src
  where pair_id is not null and turn is not null
), placed as (
  select *, row_number() over (partition by pair_id, side order by turn, role, text) as pos from turns
), compared as (
  select pair_id, pos, count(*) = 2 and count(distinct role) = 1 and count(distinct text) = 1 as same
  from placed group by pair_id, pos
), prompt as (
  select pair_id, coalesce(min(case when not same then pos end) - 1, max(pos)) as n from compared group by pair_id
), parts as (
  select p.*, q.n, case when pos <= n then 'prompt' else side end as part,
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) as body
  from placed p join prompt q on p.pair_id = q.pair_id
), offsets as (
  select *, coalesce(sum(length(body)) over (partition by pair_id, side, part order by pos
    rows between unbounded preceding and 1 preceding), 0) as start from parts
)
select pair_id, max(n) as prompt_turns,
  coalesce(string_agg(body, '' order by pos) filter (where part = 'prompt' and side = 'chosen'), '') as prompt,
  {_completion("chosen")}, {_completion("rejected")}, bool_or(part <> 'prompt') as has_preference
from offsets group by pair_id
"""


@query
def op3_binary_records(spark, sf_dir):
    """All documents tokenized, written as framed records with an index, and read back."""
    return records.read_digests(records.write_records(documents(spark, sf_dir), BYTE_BPE))


@query
def op4_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of all whole documents, and what they decode to."""
    return byte_bpe.digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN, ["doc_id"])


@query
def op5_pitman_yor(spark, sf_dir):
    """log10 probabilities of all whole documents under a hierarchical Pitman-Yor model of the training part."""
    return pitman_yor.score_texts(documents(spark, sf_dir), id_remainder(7) == 2)


@query
def op6_syncmers(spark, sf_dir):
    """Closed-syncmer fingerprints of all whole documents and of their edited texts."""
    return syncmers.fingerprints(documents(spark, sf_dir))


def teaches_language(docs: DataFrame) -> DataFrame:
    return docs.where(id_remainder(5) != 0)


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    """Learned from all documents outside the held-out fifth; without ``least_fit``, which ``least_fits`` gives for scored documents."""
    return language_id.train(teaches_language(docs), PIECES, fits=False)


@query
def op7_language_id(spark, sf_dir):
    """The predicted language of every whole document."""
    docs = documents(spark, sf_dir)
    held = docs.select("doc_id", F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"), "text")
    return language_id.predict(held, language_model(docs), ["doc_id", "held_out"])


@query
def op8_token_counts(spark, sf_dir):
    """Token counts of all whole documents; huge ones by overlapping chunks, spliced again."""
    counted = token_counts.count_tokens(documents(spark, sf_dir).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text"), BYTE_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op9_near_duplicates(spark, sf_dir):
    """The near-duplicate class of every document."""
    return near_duplicates.duplicate_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_rows", "is_kept")


# All pairs that share a shingle are compared here; \x0b is written by its code.
ORACLES["op9_near_duplicates"] = f"""
with recursive nodes as (
  select coalesce(text, '') as text, min(doc_id) as node, count(*) as n from documents group by 1
), words as (
  select node, list_filter(string_split_regex(text, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') as w from nodes
), shingles as (
  select node, unnest(case when len(w) = 0 then [] when len(w) < {near_duplicates.WORDS} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {near_duplicates.WORDS - 2}), lambda i: array_to_string(w[i:i + {near_duplicates.WORDS - 1}], ' ')) end) as s
  from words
), counted as (
  select node, s, count(*) as k from shingles group by 1, 2
), totals as (
  select node, sum(k) as total from counted group by 1
), shared as (
  select a.node as a, b.node as b, sum(least(a.k, b.k)) as k from counted a join counted b on a.s = b.s and a.node < b.node group by 1, 2
), links as (
  select a, b from shared join totals x on x.node = a join totals y on y.node = b
  where shared.k >= {near_duplicates.THRESHOLD} * (x.total + y.total - shared.k)
), edges as (
  select a, b from links union all select b, a from links
), reached(node, label) as (
  select node, node from nodes union select e.b, r.label from reached r join edges e on e.a = r.node
), labels as (
  select node, min(label) as class_id from reached group by 1
), classes as (
  select class_id, sum(n) as class_rows from labels l join nodes n on l.node = n.node group by 1
)
select d.doc_id, l.class_id, cast(c.class_rows as bigint) as class_rows, d.doc_id = l.class_id as is_kept
from documents d join nodes n on coalesce(d.text, '') = n.text join labels l on l.node = n.node join classes c on c.class_id = l.class_id
"""


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_rules.QualityModel:
    return quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op10_quality_rules(spark, sf_dir):
    """Base counts and the quality verdict of every whole document."""
    docs = documents(spark, sf_dir)
    got = quality_rules.apply_rules(docs, quality_model(spark, docs, sf_dir), ["doc_id"])
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Which of op11's texts end in a periodic stretch: (its first word, its period)."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    return g % n, 1 + (n - g % n) // (3 + g % 8)


@query
def op11_periodic_runs(spark, sf_dir):
    """All runs of words of every whole document, every tenth with a planted periodic end."""
    found = periodic_runs.periodic_runs(documents(spark, sf_dir), planted_period)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    one = found.withColumn("best", best)
    return one.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def damaged_conversations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """op12's input: every twentieth row dropped, emptied, without stops, repeated or said by the user; and how often each row stands."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
    return rows, F.col("copies")


@query
def op12_conversation_repair(spark, sf_dir):
    """Faults and cheapest repair of every damaged conversation."""
    return conversation_repair.repair_conversations(*damaged_conversations(spark, sf_dir))


# crc32 byte by byte and bit by bit; then one step for each row of a conversation over the grammar's
# four states: 0 nothing said, 1 system, 2 user, 3 assistant.  Up to two inserts may stand before a row or at the end.
_CRC32 = ("xor(4294967295, list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::ubigint)), "
          "lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)::ubigint[]), lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1)))))")
_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

ORACLES["op12_conversation_repair"] = f"""
with recursive source as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_CRC32.format("(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))")} % 20 as kind
  from conversations
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from source, range(0, case when kind = 0 then 0 when kind = 3 then 2 else 1 end) as copies(k)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos, rtrim(text, {_WHITE}) as solid from damaged
), judged as (
  select *, case when solid = '' then 'blank'
    when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
    when solid[-1:] not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(role[1]) over (partition by conv_id order by pos) || role[1] as pair
  from placed
), inserts(state, edits, price, said, after) as (values
  (0, '', 0, [], 0), (1, '', 0, [], 1), (2, '', 0, [], 2), (3, '', 0, [], 3),
  (0, 'I', 2, ['user:'], 2), (1, 'I', 2, ['user:'], 2), (2, 'I', 2, ['assistant:'], 3), (3, 'I', 2, ['user:'], 2),
  (0, 'II', 4, ['user:', 'assistant:'], 3), (1, 'II', 4, ['user:', 'assistant:'], 3)
), next_turn(state, token, after) as (values
  (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), moves as (
  select i.state, i.edits || 'D' as edits, i.price + 3 as price, i.said, null::varchar as token, null::varchar as says, i.after, true as gone from inserts i
  union all select i.state, i.edits || 'K', i.price, i.said, n.token, null::varchar, n.after, false from inserts i join next_turn n on n.state = i.after
  union all select i.state, i.edits || 'R', i.price + 2, i.said, null::varchar, case n.token when 'u' then 'user' else 'assistant' end, n.after, false
    from inserts i join next_turn n on n.state = i.after where n.token <> 's'
), walk(conv_id, pos, state, cost, audit, said) as (
  select distinct conv_id, 0::bigint, 0, 0, '', []::varchar[] from conversations
  union all
  select conv_id, pos, state, best.cost, best.audit, best.said from (
    select w.conv_id, j.pos, m.after as state, min({{
      'cost': w.cost + m.price + case when not m.gone and j.fault = 'truncated' then 1 else 0 end, 'audit': w.audit || m.edits,
      'said': w.said || m.said || case when m.gone then [] else [coalesce(m.says, j.role) || ':' || j.text] end}}) as best
    from walk w join judged j on w.conv_id is not distinct from j.conv_id and j.pos = w.pos + 1 join moves m on m.state = w.state
    where m.gone or (j.fault not in ('blank', 'duplicate') and (m.token is null or m.token = j.role[1]))
    group by 1, 2, 3)
), ends as (
  select w.conv_id, min({{'cost': w.cost + i.price, 'audit': w.audit || i.edits, 'said': w.said || i.said}}) as best
  from walk w join inserts i on i.state = w.state and i.after in (0, 3)
  where w.pos = (select count(*) from judged j where j.conv_id is not distinct from w.conv_id) group by 1
), faults as (
  select conv_id, case when count(turn) = 0 then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
  from judged group by 1
)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.cost::bigint as cost, best.audit as audit,
  sha256(array_to_string(best.said, chr(10))) as repaired_sha256
from ends e left join faults f on e.conv_id is not distinct from f.conv_id
"""


@query
def op13_line_dedup(spark, sf_dir):
    """Every document without the long lines that at least five documents share, but for the greatest of them."""
    got = line_dedup.dedup_lines(documents(spark, sf_dir))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op13_line_dedup"] = f"""
with rows as (
  select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
  select row, doc_id, i, lines[i] as line, translate(trim(lines[i], {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from rows, unnest(range(1, len(lines) + 1)) as places(i)
), shared as (
  select key, max(doc_id) as top from lines where length(key) >= {line_dedup.MIN_CHARS}
  group by key having count(distinct doc_id) >= {line_dedup.MIN_DOCS}
), marked as (
  select l.*, s.key is not null and l.doc_id <> s.top as gone from lines l left join shared s on l.key = s.key
)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by row
"""
