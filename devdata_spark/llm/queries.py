"""The numbered operators as queries over whole tables, and SQL that checks them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark.llm import (
    bpe,
    chat,
    contamination,
    licenses,
    line_dedup,
    negatives,
    neighbours,
    ngram_join,
    pii,
    suffix_dedup,
    topk,
    toxicity,
    trie,
)
from devdata_spark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain's probabilities for every document, and whether it is rejected."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, chain).select(
        "document.doc_id",
        F.col("p.low_quality").alias("p_low_quality"),
        F.col("p.toxic").alias("p_toxic"),
        (F.col("p.toxic") >= 0.5).alias("toxic"),
    )


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated and nearly repeated lines."""
    found = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query
def op3_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    count = {kind: F.size(F.filter("base", _of_kind(kind))).cast("long") for kind in pii.KINDS}
    return found.select(
        "doc_id",
        *[count[kind].alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(F.concat("base", "terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as tokens and back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encode, decode = bpe.codec(spark, path, public_tokenizers.PATTERN)
    encoded = table(spark, sf_dir, "documents").select(
        "doc_id", encode(F.coalesce("text", F.lit(""))).alias("ids")
    )
    return encoded.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode("ids"), 256).alias("decoded_sha256"),
    )


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                        F.lit(role).alias("role"), F.lit(said).alias("text"),
                    )
                    for i, role in enumerate(("user", "assistant"))
                ]
            )
        )
    )
    read = chat.format_conversations(turns.unionByName(extra)).select(
        "conv_id",
        "formatted",
        chat.parse(F.col("formatted")).alias("turns"),
        F.array_join(chat.under_mask(F.col("formatted"), F.col("loss_mask")), "").alias("loss"),
    )
    line = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL["op5_chat_format"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before,
    length(regexp_replace(role, '(\\|<\||</?s>|\[/?INST\])', '\\\1', 'g')) as role_chars,
    length(regexp_replace(text, '(\\|<\||</?s>|\[/?INST\])', '\\\1', 'g')) as text_chars
  from turns),
-- a block costs <|turn|>, role, <|says|> and <|done|>; each further turn in it <|and|>
grouped as (
  select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text))
      as turns_sha256,
    coalesce(string_agg(text, '' order by turn nulls first, role, text)
      filter (where role = 'assistant'), '') as loss,
    sum(text_chars + case when before is distinct from role then 24 + role_chars else 7 end)
      as formatted_chars
  from marked group by conv_id)
select conv_id, n_turns, turns_sha256, cast(length(loss) as bigint) as loss_chars,
  sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from grouped
"""


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License mentions of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))

    def labels(column: str):
        return F.array_join(F.array_sort(F.array_distinct(f"{column}.label")), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("detections").alias("labels"),
        F.coalesce(F.array_max("detections.weight"), F.lit(0.0)).alias("score"),
    )


@query
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every fiftieth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


SQL["op6_exact_topk"] = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_dot_product(q.v, c.v) as bigint) as score
  from usable q join usable c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share nine tenths of their three-word shingles."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


SQL["op9_ngram_jaccard"] = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    end as s
  from texts),
sized as (select doc_id, cast(len(s) as bigint) as n, s from sets),
entries as (select doc_id, n, unnest(s) as shingle from sized),
common as (
  select a.doc_id as a, b.doc_id as b, a.n as n_a, b.n as n_b, count(*) as c
  from entries a join entries b using (shingle) where a.doc_id <> b.doc_id group by all),
links as (select a, b from common where 100 * c >= 90 * (n_a + n_b - c)),
reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least as (select a as doc_id, min(b) as b from reach group by a)
select doc_id, n as n_shingles, least(doc_id, coalesce(b, doc_id)) as component_id
from sized left join least using (doc_id)
"""


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings of smaller documents."""
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


SQL["op7_suffix_dedup"] = """
with texts as (
  select doc_id, hex(encode(coalesce(text, ''))) as h,
    cast(octet_length(encode(coalesce(text, ''))) as bigint) as n
  from documents),
strings as (
  select doc_id, pos, substr(h, cast(2 * pos + 1 as bigint), 100) as s
  from (select doc_id, h, unnest(range(n - 49)) as pos from texts where n >= 50)),
least as (
  select s, min(doc_id) as first from strings group by s having min(doc_id) < max(doc_id)),
covered as (
  select distinct doc_id, pos from strings join least using (s) where doc_id > first),
runs as (  -- strings fewer than 51 apart cover one stretch
  select doc_id, pos, sum(case when pos <= before + 50 then 0 else 1 end)
    over (partition by doc_id order by pos) as run
  from (select *, lag(pos, 1, -1000) over (partition by doc_id order by pos) as before from covered)),
spans as (
  select doc_id, min(pos) as a, max(pos) + 50 as b from runs group by doc_id, run),
gaps as (
  select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as before from spans),
ends as (select doc_id, 0 as a, 0 as b, max(b) as before, count(*) as k, sum(b - a) as gone
  from spans group by doc_id),
pieces as (
  select t.doc_id, g.a, substr(t.h, cast(2 * g.before + 1 as bigint), cast(2 * (g.a - g.before) as bigint)) as p
  from gaps g join texts t using (doc_id)
  union all
  select t.doc_id, 1000000000, substr(t.h, cast(2 * e.before + 1 as bigint)) from ends e join texts t using (doc_id)),
kept as (select doc_id, string_agg(p, '' order by a) as h from pieces group by doc_id)
select t.doc_id, t.n as n_bytes, cast(coalesce(e.gone, 0) as bigint) as n_removed,
  cast(coalesce(e.k, 0) as bigint) as n_spans, sha256(unhex(coalesce(k.h, t.h))) as kept_sha256
from texts t left join ends e using (doc_id) left join kept k using (doc_id)
"""


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that occur in every document, up to a few edits."""
    find = contamination.finder(table(spark, sf_dir, "benchmark"))
    found = table(spark, sf_dir, "documents").select("doc_id", find(F.col("text")).alias("found"))
    items = F.array_sort(F.array_distinct("found.item_id"))
    return found.select(
        "doc_id",
        (F.size("found") > 0).alias("contaminated"),
        F.size(items).cast("long").alias("n_items"),
        F.size("found").cast("long").alias("n_matches"),
        F.array_join(F.transform(items, lambda i: i.cast("string")), ",").alias("items"),
    )


@query
def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its five positives."""
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=turned
    )


SQL["op12_hard_negatives"] = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, x.vec_id as vec_id, a.label = x.label as same,
    cast(list_dot_product(a.v, x.v) as bigint) as score
  from usable a join usable x on a.vec_id <> x.vec_id where a.vec_id % 100 = 0),
positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
met as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id,
    p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score
from met where rank <= 5
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


SQL["op13_prefix_trie"] = """
with recursive turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as place
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 5 as base,
    xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(
        range(1, cast(8 * length(cast(conv_id as varchar)) + 1 as bigint)),
        -- each of eight steps of a character; the first takes it in
        lambda i: case when i % 8 = 1
          then ascii(substr(cast(conv_id as varchar), cast((i + 7) // 8 as bigint), 1)) else 0 end)),
      lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 9 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, t.place, t.role, t.text
  from convs c join turns t on t.conv_id = c.base and t.place <= c.h
  union all
  select c.conv_id, 1, t.place, t.role, t.text
  from convs c join turns t on t.conv_id = c.conv_id and t.place > c.h),
said as (
  select conv_id, row_number() over (partition by conv_id order by part, place) as depth,
    md5(length(role) || ':' || role || text) as m, octet_length(encode(text)) as n_bytes
  from rebuilt),
prefixes as (
  select conv_id, cast(0 as bigint) as depth, '' as node, cast(null as varchar) as parent,
    cast(0 as bigint) as n_bytes from convs
  union all
  select s.conv_id, s.depth, md5(p.node || s.m), p.node, s.n_bytes
  from prefixes p join said s on s.conv_id = p.conv_id and s.depth = p.depth + 1),
ends as (
  select conv_id, max_by(node, depth) as node from prefixes group by conv_id),
hashes as (
  select node, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256
  from ends group by node),
nodes as (
  select node, min(conv_id) as conv_id, min(depth) as depth, min(parent) as parent,
    count(*) as n_convs, min(n_bytes) as n_bytes
  from prefixes group by node),
children as (select parent as node, count(*) as n_children from nodes group by parent),
below(top, node) as (
  select node, node from nodes
  union all
  select b.top, n.node from below b join nodes n on n.parent = b.node),
sums as (
  select top as node, sum((n.n_convs - 1) * n.n_bytes) as saved_tokens,
    count(*) filter (where c.n_children is null) as n_leaves
  from below b join nodes n on n.node = b.node left join children c on c.node = b.node group by top)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0) as n_children, s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens,
  coalesce(h.ends_sha256, sha256('')) as ends_sha256
from nodes n join sums s using (node) left join children c using (node)
left join hashes h using (node) left join nodes p on p.node = n.parent
"""
