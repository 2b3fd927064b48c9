"""The operators as queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    decontaminate,
    fingerprints,
    language_id,
    mixing,
    ngram_join,
    personal_data,
    quotes,
    ranked_search,
    shards,
    substring_dedup,
    token_counts,
    toxicity,
)
from .common import read, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return add


@query("op1_quote_links", """
with said as (select conv_id, turn, min(text) as text from conversations group by all),
mail as (
  select m.conv_id, m.turn, m.role,
         concat_ws(chr(10), case when a.text is not null then '> > ' || replace(b.text, chr(10), chr(10) || '> > ') end,
                   '> ' || replace(a.text, chr(10), chr(10) || '> '), m.text) as text
  from conversations m
  left join said a on a.conv_id = m.conv_id and a.turn = m.turn - case when m.turn % 3 = 2 then 2 else 1 end
  left join said b on b.conv_id = m.conv_id and b.turn = (m.turn - case when m.turn % 3 = 2 then 2 else 1 end)
       - case when (m.turn - case when m.turn % 3 = 2 then 2 else 1 end) % 3 = 2 then 2 else 1 end),
raw as (select *, unnest(string_split(coalesce(text, ''), chr(10))) as l from mail),
split as (select *, regexp_extract(l, '^((?:>[ \\t]?)*)', 1) as signs from raw),
lines as (
  select conv_id, turn, role, len(signs) - len(replace(signs, '>', '')) as level,
         lower(trim(regexp_replace(substr(l, len(signs) + 1), '\\s+', ' ', 'g'))) as line
  from split),
source as (select distinct conv_id, turn, line from lines where level = 0 and line <> ''),
quoted as (select row_number() over () as q, conv_id, turn, level, line from lines where level > 0 and line <> ''),
found as (
  select q.conv_id, q.turn, q.level, q.q, max(s.turn) as latest
  from quoted q left join source s on s.conv_id = q.conv_id and s.line = q.line and s.turn < q.turn group by all),
votes as (select conv_id, turn, level, latest, count(*) as n from found group by all),
best as (
  select conv_id, turn, first(latest order by level, n desc, latest desc) filter (latest is not null) as source,
         sum(n)::bigint as n_quoted, coalesce(sum(n) filter (latest is not null), 0)::bigint as n_linked
  from votes group by all),
earlier as (select conv_id, turn, lag(turn) over (partition by conv_id order by turn) as previous
            from (select distinct conv_id, turn from conversations))
select m.conv_id, m.turn, m.role, coalesce(source, previous) as reply_to,
       row_number() over (partition by m.conv_id order by m.turn, m.role, m.text) - 1 as position,
       coalesce(n_quoted, 0) as n_quoted, coalesce(n_linked, 0) as n_linked,
       regexp_replace(m.text, '^\\s+|\\s+$', '', 'g') as text
from conversations m left join best on best.conv_id = m.conv_id and best.turn = m.turn
left join earlier on earlier.conv_id = m.conv_id and earlier.turn = m.turn
""")
def op1_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, written as mail that quotes, linked again and freed of the quotes."""
    return quotes.link(quotes.as_replies(read(spark, sf_dir, "conversations")))


@query("op2_ngram_join", """
with recursive words as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') as w
  from documents),
grams as (
  select distinct r, doc_id, list_slice(w, i, i + 4) as gram
  from (select *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select r, doc_id, count(gram) as n from words left join grams using (r, doc_id) group by all),
common as (select a.r as a, b.r as b, count(*) as n from grams a join grams b on a.gram = b.gram and a.r < b.r group by all),
near as (select x.doc_id as a, y.doc_id as b from common join sizes x on x.r = common.a join sizes y on y.r = common.b
         where 100 * common.n >= 80 * (x.n + y.n - common.n)),
edges as (select a, b from near union select b, a from near),
reach as (select doc_id as d, doc_id as c from words union select edges.a, c from reach join edges on edges.b = d),
component as (select d, min(c) as c from reach group by d)
select doc_id, n as n_shingles, c as component_id from sizes join component on d = doc_id
""")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and its component of near duplicates."""
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score, learned from the labels that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.teachable(read(spark, sf_dir, "labels")))
    return (toxicity.with_scores(docs, model)
            .select("doc_id", toxicity.held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


@query("op4_fingerprints")
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = (read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("print", fingerprints.fingerprint(F.col("text"))))
    rows = (fingerprints.with_next(docs, carry=("text", "print"))
            .withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text")))
            .select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "print", "next_print",
                    fingerprints.fingerprint(F.col("edited")).alias("edited_print")))
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprints.as_text(F.col("print")).alias("fingerprint"),
                       fingerprints.as_text(F.col("edited_print")).alias("edited_fingerprint"),
                       fingerprints.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       fingerprints.likeness(F.col("print"), F.col("next_print")).alias("near_next"))


@query("op5_decontamination", """
with item_words as (
  select coalesce(item_id::varchar, 'null') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
windows as (
  select distinct item, least(len(words), 10) as n, list_slice(words, i, i + least(len(words), 10) - 1) as phrase
  from (select *, unnest(range(1, len(words) - least(len(words), 10) + 2)) as i from item_words where len(words) > 0)),
docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
places as (
  select r, n, i, list_slice(words, i, i + n - 1) as phrase
  from (select r, words, n, unnest(range(1, len(words) - n + 2)) as i
        from docs, (select distinct n from windows))),
hits as (select r, i, p.n, item from places p join windows w on p.n = w.n and p.phrase = w.phrase),
words_hit as (select r, count(distinct w) as n_hit from (select r, unnest(range(i, i + n)) as w from hits) group by r),
items as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
          from hits group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join words_hit using (r) left join items using (r)
""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words and items of the benchmark found in it."""
    index = decontaminate.build_index(read(spark, sf_dir, "documents"))
    found = decontaminate.search(index, read(spark, sf_dir, "benchmark"))
    return decontaminate.contamination(index, found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_mixing", """
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
         (('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 12))::bigint
          + 0.5::double) / 281474976710656.0::double as u
  from documents),
weighed as (select *, case when size between 64 and 4096 then 1.0::double else 0.5::double end as weight from rows),
levels as (select source, weight, sum(size)::bigint as words from weighed group by all),
sources as (
  select source, sum(words)::bigint as source_size,
         [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
  from levels group by source),
needs as (
  select *, source_size * 2.0::double / w as need, sum(source_size) over () * 1.5::double as total,
         sum(w) over () as all_w,
         coalesce(sum(source_size * 2.0::double) over filled, 0.0) as capped,
         coalesce(sum(w) over filled, 0.0) as before
  from sources window filled as (order by source_size * 2.0::double / w, source nulls last
                                 rows between unbounded preceding and 1 preceding)),
level as (select min_by((total - capped) / (all_w - before), need) as found from needs
          where (total - capped) / (all_w - before) <= need),
targets as (
  select source, source_size,
         least(source_size * 2.0::double, coalesce(found * w, source_size * 2.0::double)) as target
  from needs, level),
filled as (
  select l.source, l.weight, l.words, t.source_size, t.target,
         (t.target - coalesce(sum(l.words * 2.0::double) over heavy, 0.0))
         / (sum(l.words * l.weight) over (partition by l.source)
            - coalesce(sum(l.words * l.weight) over heavy, 0.0)) as c
  from levels l join targets t on l.source is not distinct from t.source
  window heavy as (partition by l.source order by l.weight desc rows between unbounded preceding and 1 preceding)),
found as (select *, max(case when c * weight <= 2.0 then {'weight': weight, 'c': c} end)
                    over (partition by source) as best from filled),
exact as (select *, least(2.0::double, coalesce(best.c * weight, 2.0::double)) as raw from found),
plan as (select *, case when abs(raw - round(raw)) < 1e-9 then round(raw) else raw end as copies from exact),
ranked as (
  select r.*, p.source_size, p.target, floor(p.copies)::bigint as whole, p.copies - floor(p.copies) as prob,
         case when p.copies > floor(p.copies) then (r.u / (1 - r.u))
              / ((p.copies - floor(p.copies)) / (1 - (p.copies - floor(p.copies)))) end as q
  from weighed r join plan p on r.source is not distinct from p.source and r.weight = p.weight),
running as (
  select *, target - sum(size * whole) over (partition by source) as missing,
         coalesce(sum(size) over (partition by source, q is null order by q, u, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0) as start
  from ranked)
select doc_id, size::bigint as size, source_size, target,
       ((whole + case when q is not null and start + size / 2.0::double <= missing then 1 else 0 end) * size)::bigint as taken
from running
""")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 5, 2, 1."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, equal texts together."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed = shards.with_shards(docs, 24).select("doc_id", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), "shard")
    return (shards.with_slots(staged(placed, "shards")).withColumn("law", F.lit("bytes"))
            .withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    return (token_counts.with_token_counts(read(spark, sf_dir, "documents"))
            .withColumn("over_limit", F.col("n_tokens") > 512))


@query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that another document has too."""
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page by all evidence, and of every document by its text and source."""
    docs = read(spark, sf_dir, "documents")
    model = language_id.train(docs)
    pages = language_id.page_evidence(read(spark, sf_dir, "pages"), model[0])
    of_pages = language_id.identify(pages, model, ["page_id"], declared="declared", suffix="suffix", host="host", domain="domain")
    of_docs = language_id.identify(docs.select("doc_id", "text", "source"), model, ["doc_id"], host="source")
    none = F.lit(None).cast("bigint")
    return (of_pages.withColumn("doc_id", none).unionByName(of_docs.withColumn("page_id", none))
            .select("doc_id", "page_id", "text_lang", "lang", "confidence"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the byte-level vocabulary laid on those of the piece model, in every whole document."""
    return alignment.aligned(read(spark, sf_dir, "documents"))


@query("op12_ranked_search", """
with docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents),
sums as (select count(*)::bigint as all_docs, sum(len(terms))::bigint as all_terms from docs where len(terms) > 0),
items as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark),
tfs as (select r, term, count(*)::bigint as tf from (select r, unnest(terms) as term from docs)
        where term in (select term from items) group by all),
weights as (select term, floor(1000 * ln((2 * all_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
            from tfs, sums group by term, all_docs),
norms as (select r, doc_id, 50 + (50 * len(terms)::bigint * all_docs) // all_terms as m from docs, sums where len(terms) > 0),
scores as (
  select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from items join tfs using (term) join weights using (term) join norms using (r) group by all),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
           from scores where score > 0)
select * from ranked where rank <= 50
""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    index = ranked_search.build_index(read(spark, sf_dir, "documents"))
    return ranked_search.search(index, read(spark, sf_dir, "benchmark"))


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document: base spans, and what a field trained on them adds."""
    docs = read(spark, sf_dir, "documents")
    found = personal_data.find(docs, personal_data.train(personal_data.labelled_from(docs)))
    count = lambda kind: F.regexp_count("base", F.lit(kind + ":")).cast("bigint").alias("n_" + kind)
    return found.select("doc_id", *map(count, personal_data.KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
