"""Registered queries of the pipeline operators, with production parameters over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from .common import table
from .decontaminate import contamination
from .fingerprint import fingerprint_documents
from .importance import BUCKETS, LEAST_WORDS, PERCENT, SEED, resample
from .line_dedup import dedup_lines
from .mixing import mix, train_domains
from .ngram_join import jaccard_components, jaccard_links
from .periodic_runs import document_runs
from .sharding import shard_documents
from .token_counts import count_tokens
from .token_files import token_documents
from .toxicity import held_out, score_texts, train
from .url_filter import RULES, SOFT_NEEDED, SOFT_ROOTS, STRICT_TERMS, filter_urls
from .warc import derive_records, read_warc, response_records, write_warc


def op1_ngram_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op1_ngram_links(spark, sf_dir):
    return jaccard_links(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark, sf_dir):
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark, sf_dir):
    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return c.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


def op5_warc_derivatives(spark, sf_dir):
    folder = scratch_path(spark, "warc")
    files = write_warc(response_records(table(spark, sf_dir, "pages")), folder)
    d = derive_records(read_warc(spark, folder, files))
    return d.select("page_id", "kind", "record_id", "refers_to", "target_uri", "source_digest", "block_digest",
                    F.length("record").cast("long").alias("n_bytes"), F.sha2("record", 256).alias("record_sha256"))


def op6_line_dedup(spark, sf_dir):
    d = dedup_lines(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    s = score_texts(docs, model)
    return s.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def byte_bpe_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op8_token_files(spark, sf_dir):
    return token_documents(table(spark, sf_dir, "documents"), byte_bpe_path())


def op9_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"))


def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    m = mix(docs, train_domains(docs, table(spark, sf_dir, "labels")))
    return m.select("row.doc_id", "tokens", F.col("p")[0].alias("p_low"), F.col("p")[1].alias("p_high"), "rate")


def op11_periodic_runs(spark, sf_dir):
    return document_runs(table(spark, sf_dir, "documents"))


def op12_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), byte_bpe_path())


def op13_importance(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registry():
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as g from w),
e as (select doc_id, unnest(g) as g from s),
n as (select doc_id, len(g) as n from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b using (g) where a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from l union select b, a from l),
reach as (select doc_id as a, doc_id as b from n union select r.a, t.b from reach r join both_ways t on t.a = r.b)
select n.doc_id, cast(n.n as bigint) as n_shingles, min(reach.b) as component_id
from n join reach on reach.a = n.doc_id group by n.doc_id, n.n
"""

OP1_LINKS_SQL = OP1_SQL.replace("min(reach.b) as component_id", "min(reach.b) as component_id, (select count(*) from both_ways t where t.a = n.doc_id) as n_links")

_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = rf"""
with d as (select doc_id, {_WORDS} as w from documents),
i as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
wins as (select distinct item_id, array_to_string(w[o:o + 9], ' ') as win, least(len(w), 10) as n
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as o from i where len(w) > 0)),
sizes as (select distinct n from wins),
spans as (select doc_id, w, unnest(range(1, len(w) - n + 2)) as o, n from d, sizes where len(w) >= n),
hits as (select s.doc_id, s.o, s.n, x.item_id from (select doc_id, o, n, array_to_string(w[o:o + n - 1], ' ') as win from spans) s
  join wins x on x.win = s.win and x.n = s.n),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(o, o + n)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(t, ',' order by t) as names
  from (select distinct doc_id, cast(item_id as varchar) as t from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

OP6_SQL = rf"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
k as (select *, {_LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} as key from l),
f as (select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) > 1),
m as (select k.*, first is not null and doc_id <> first as gone from k left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""


def _op9_sql():
    def has(t):
        return f"cast(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') as int)"

    fits = [(len(h + p), f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, v) for v, h, p in RULES]
    fits.sort(key=lambda x: -x[0])
    rule = " ".join(f"when {c} then '{r}'" for _, c, r, _ in fits)
    verdict = " ".join(f"when {c} then '{v}'" for _, c, _, v in fits)
    return rf"""
with u as (select page_id, lower(coalesce(url, '')) as low,
    case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
    cast({' + '.join(map(has, STRICT_TERMS))} as int) as strict_hits,
    cast({' + '.join(has('(' + '|'.join(f) + ')') for _, f in SOFT_ROOTS)} as int) as soft_hits,
    cast({' + '.join(f"{w} * " + has('(' + '|'.join(f) + ')') for w, f in SOFT_ROOTS)} as int) as soft_weight from u)
select page_id, host, path, case {rule} end as rule,
  case {verdict} when strict_hits >= 1 or (soft_hits >= 2 and soft_weight >= {SOFT_NEEDED}) then 'block' else 'allow' end as verdict, strict_hits, soft_hits, soft_weight
from h
"""


#: crc32 of each distinct word: the table of the polynomial by its eight shifts, then the word's bytes one after the other.
OP13_SQL = rf"""
with recursive shifts as (select cast(b as bigint) as b, cast(b as bigint) as c, 0 as k from range(256) t(b)
  union all select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from shifts where k < 8),
crc as (select list(c order by b) as t from shifts where k = 8),
w as (select 0 as side, doc_id, unnest({_WORDS}) as word from documents union all select 1, null, unnest({_WORDS}) from benchmark),
hexes as (select word, hex(encode(word)) as x from (select distinct word from w)),
buckets as (select word, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint),
    list_transform(range(1, length(x), 2), lambda i: cast(cast('0x' || substr(x, i, 2) as integer) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % {BUCKETS} as bucket from hexes, crc),
counts as (select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from w join buckets using (word) group by bucket),
gains as (select bucket, cast(floor(1000 * ln((t + 1)::double * ((select sum(s) from counts)::double + {BUCKETS})
  / ((s + 1)::double * ((select sum(t) from counts)::double + {BUCKETS})))) as bigint) as gain from counts),
weights as (select doc_id, count(*) as n, sum(gain) as weight from w join buckets using (word) join gains using (bucket) where side = 0 group by doc_id),
scored as (select d.doc_id, coalesce(n, 0) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
  cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
  from documents d left join weights using (doc_id)),
ranked as (select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scored where n_features >= {LEAST_WORDS})
select s.doc_id, n_features, weight, score, case when r <= {PERCENT} * n // 100 then r end as rank from scored s left join ranked using (doc_id)
"""


def oracles():
    return {"op13_importance": OP13_SQL, "op1_ngram_join": OP1_SQL, "op1_ngram_links": OP1_LINKS_SQL, "op3_decontaminate": OP3_SQL, "op6_line_dedup": OP6_SQL, "op9_url_filter": _op9_sql()}
