"""The named queries of the corpus operators, and their results in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.storage import scratch_path
from scoreloom.llm.bpe import default_vocabulary, encoding_report
from scoreloom.llm.dedup import exact_duplicates
from scoreloom.llm.divergence import audit_report
from scoreloom.llm.jaccard import Join
from scoreloom.llm.language import predicted_languages
from scoreloom.llm.lines import LineRules
from scoreloom.llm.mixing import mixed_sizes
from scoreloom.llm.phrases import collocations
from scoreloom.llm.privacy import with_surrogates
from scoreloom.llm.scoring import katz_scores
from scoreloom.llm.secrets import secret_report
from scoreloom.llm.warc import round_trip
from scoreloom.llm.winnowing import edited_fingerprints, fingerprint

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query("""
with t as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(text) as text_sha256
from t join g using (text)
""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


@query()
def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("text").alias("fingerprint"),
        fingerprint("edited").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query()
def op3_katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz_scores(table(spark, folder, "documents"))


@query()
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return Join(words=3, percent=90).components(table(spark, folder, "documents")).drop("mark")


@query("""
with p as (select page_id, coalesce(html, '') as payload from pages),
g as (select payload, max(page_id) as original from p group by payload),
d as (select page_id, original, octet_length(encode(payload)) as payload_bytes, sha1(payload) as h
  from p join g using (payload))
select page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    ((cast('0x' || substr(h, (1 + 10 * (j // 8))::int, 10) as bigint) >> (35 - 5 * (j % 8))::int) & 31)::int, 1)), '') as payload_digest,
  case when original is null or page_id = original then 'response' else 'revisit' end as record_type,
  case when page_id = original then null else original end as refers_to
from d
""")
def op5_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    read = round_trip(table(spark, folder, "pages"), scratch_path(spark, "archives"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op6_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return with_surrogates(table(spark, folder, "documents"))


@query()
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(table(spark, folder, "documents"))


@query()
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return predicted_languages(table(spark, folder, "documents"))


@query(r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    coalesce(doc_id::varchar, 'text:' || md5(coalesce(text, ''))) as draw from documents),
totals as (
  select source, sum(size)::bigint as source_size,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from sized group by source),
steps as (
  select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over (
        order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
    / sum(weight) over (order by source_size / weight, source nulls last
        rows between current row and unbounded following) as level
  from totals),
targets as (
  select source, source_size, least(source_size * 3e0, weight * (
      select max(level) from steps where 3 * source_size >= level * weight)) as target from steps),
rates as (select *, case when source_size > 0 then target / source_size else 0e0 end as rate from targets)
select doc_id, size, source_size, target,
  size * (floor(rate)::bigint + case when cast('0x' || substr(md5('mix:' || draw), 1, 8)
    as bigint) / 4294967296e0 < rate - floor(rate) then 1 else 0 end) as taken
from sized join rates on sized.source is not distinct from rates.source
""")
def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_sizes(table(spark, folder, "documents")).drop("copies")


@query()
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_report(table(spark, folder, "documents"), default_vocabulary())


@query(r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from split group by lang),
grams as (
  select lang, unnest(flatten([[array_to_string(w[i:i + size - 1], ' ') for i in range(1, len(w) - size + 2)] for size in range(1, 5)])) as phrase
  from split where len(w) > 0),
counts as (select lang, phrase, count(*) as f from grams group by lang, phrase having count(*) >= 30),
phrases as (select lang, phrase, f as a, string_split(phrase, ' ') as w from counts where contains(phrase, ' ')),
cuts as (select lang, phrase, a, w, unnest(range(1, len(w))) as k from phrases),
scored as (
  select c.lang, c.phrase, c.a, k, x.f as l, y.f as r, (2000000::hugeint * c.a // (x.f::hugeint + y.f))::bigint as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:k], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
parts as (select lang, a, w, unnest(range(2, len(w))) as size from phrases where len(w) > 2),
inside as (
  select lang, unnest([array_to_string(w[i:i + size - 1], ' ') for i in range(1, len(w) - size + 2)]) as phrase, a from parts),
longer as (select lang, phrase, max(a) as b from inside group by lang, phrase),
kept as (select s.* from weakest s left join longer o using (lang, phrase) where b is null or 100 * b::hugeint < 80 * s.a::hugeint)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join totals using (lang) qualify rank <= 2000
""")
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


@query(r"""
with t as (
  select row_number() over () as row, doc_id, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (select row, i, array_to_string(w[i:i + 4], ' ') as win from t, unnest(range(1, len(w) - 3)) as u(i)),
again as (select row, i from windows qualify count(*) over (partition by row, win) > 1),
repeats as (select row, count(distinct i + j) as n from again, range(0, 5) as u(j) group by row),
raw as (select row, source, text, unnest(string_split(text, chr(10))) as line from t),
lines as (
  select *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
    '[^\x20\x09-\x0D]+') as w from raw where regexp_matches(line, '[^\x20\x09-\x0D]')),
normal as (select row, source, text, line, array_to_string(w, ' ') as norm, len(w) as n from lines),
dups as (select row, count(*) - count(distinct line) as n from normal group by row),
hosts as (select source, count(distinct text) as texts from t group by source),
often as (
  select o.source, norm from (select source, norm, count(distinct text) as docs from normal group by source, norm) o
  join hosts h on o.source is not distinct from h.source where docs > 20 and docs * 100 > texts),
gone as (
  select row, sum(n) as n from normal l join often o on l.source is not distinct from o.source and l.norm = o.norm group by row),
measured as (
  select doc_id, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(d.n, 0)::bigint as n_dup_lines,
    coalesce(r.n, 0)::bigint as n_repeat_words, (len(w) - coalesce(g.n, 0))::bigint as words_left
  from t left join dups d using (row) left join repeats r using (row) left join gone g using (row))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and words_left >= 10 and 100 * words_left >= 50 * n_words as kept
from measured
""")
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return LineRules().report(table(spark, folder, "documents"))


@query(r"""
with t as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
words as (select row, lang, source, unnest(w) as term from t),
kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct row) >= 3),
counts as (select lang, source, term, count(*) as c from words join kept using (lang, term) group by lang, source, term),
langs as (select l.lang, count(k.term) as v, coalesce(sum(k.n), 0)::bigint as n
  from (select distinct lang from t) l left join kept k on k.lang = l.lang group by l.lang),
groups as (select g.lang, g.source, v, coalesce(sum(c), 0)::bigint + v as total
  from (select distinct lang, source from t) g join langs using (lang) left join counts c on c.lang = g.lang and c.source = g.source
  group by g.lang, g.source, v),
full_ as (select g.lang, g.source, k.term, coalesce(c, 0) as c, 1 + (1000000000::hugeint * (coalesce(c, 0) + 1) // total)::bigint as p
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (select x.lang, x.source, y.source as item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) as value
  from full_ x join full_ y on x.lang = y.lang and x.term = y.term and x.source != y.source group by all),
every as (select x.lang, x.source, y.source as item, coalesce(value, 0)::bigint as value
  from groups x join groups y on x.lang = y.lang and x.source != y.source
  left join pairs p on p.lang = x.lang and p.source = x.source and p.item = y.source),
above as (
  select f.lang, source, term as item, p, 1 + (1000000000::hugeint * (k.n + 1) // (l.n + l.v))::bigint as q
  from full_ f join kept k using (lang, term) join langs l on l.lang = f.lang where c > 0),
terms as (select lang, source, item, ((p - q) * (p - q)) // q as value from above where p > q)
select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from every
union all
select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from terms
qualify rank <= 200
""")
def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit_report(table(spark, folder, "documents"))
