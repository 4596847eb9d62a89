"""Driver queries over the corpus operators, and their SQL counterparts.

Each query applies its operator to its whole table and derives the columns of the contract.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    html_text,
    minmax,
    mixture,
    periodic_runs,
    quality,
    secrets_scan,
    simhash,
    spelling,
    superkmers,
    token_files,
    toxicity,
    warc,
    winnowing,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def op1_warc(spark, sf_dir):
    files = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, files, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_secrets(spark, sf_dir):
    return secrets_scan.scan(_table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return quality.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_html_text(spark, sf_dir):
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_mixture(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    marked = mixture.with_copies(documents, mixture.mixture_plan(documents))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return marked.select("row.doc_id", "size", "source_size", "target", taken)


def op7_token_files(spark, sf_dir):
    files = token_files.write_token_files(_table(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, files)


def op8_decontamination(spark, sf_dir):
    return winnowing.contaminated_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op9_toxicity(spark, sf_dir):
    found = toxicity.scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_substrings(spark, sf_dir):
    found = superkmers.without_repeats(_table(spark, sf_dir, "documents"), with_text=False)
    return found.drop("kept")


def op11_minmax(spark, sf_dir):
    return minmax.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_spelling(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"), planted=True)


def op13_periodic_runs(spark, sf_dir):
    documents = periodic_runs.with_planted_runs(_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(documents, with_text=False)
    best = {c: F.get(c, F.col("best").cast("int")) for c in ("start", "length", "period")}
    lines = F.transform(
        F.arrays_zip("start", "length", "period"),
        lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")),
    )
    return found.select(
        "doc_id",
        F.size("start").cast("long").alias("n_runs"),
        *(value.alias(c) for c, value in best.items()),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


QUERIES = {
    "op1_warc": op1_warc,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_html_text": op4_html_text,
    "op5_simhash": op5_simhash,
    "op6_mixture": op6_mixture,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_substrings": op10_substrings,
    "op11_minmax": op11_minmax,
    "op12_spelling": op12_spelling,
    "op13_periodic_runs": op13_periodic_runs,
}

# -- SQL counterparts, for DuckDB -----------------------------------------------------

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_OP1 = f"""
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest from pages),
numbered as (
  select *, min(page_id) over (partition by digest) as first_id,
         row_number() over (partition by digest order by page_id) as place
  from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('{_BASE32}', 1 + cast(
           (('0x' || substr(digest, cast(i // 4 * 5 + 1 as int), 5))::bigint
            >> cast(15 - 5 * (i % 4) as int)) & 31 as int), 1)), '') as payload_digest,
       case when place = 1 then 'response' else 'revisit' end as record_type,
       case when place = 1 then null else first_id end as refers_to
from numbered
"""


def _by_measure(parameter: dict[str, float]) -> str:
    whens = " ".join(f"when '{name}' then {value}" for name, value in parameter.items())
    return f"(case measure {whens} end::double)"


_OP3 = rf"""
with d as (
  select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents),
grams as (
  select r, s, array_to_string(words[s:s + 2], ' ') as g
  from (select r, words, unnest(range(1, len(words) - 1)) as s from d where len(words) >= 3)),
often as (select *, count(*) over (partition by r, g) as n from grams),
covered as (
  select r, count(distinct pos) as n_repeat_words
  from (select r, unnest(range(s, s + 3)) as pos from often where n > 1) group by r),
stats as (
  select r, doc_id, lang, source, cast(len(words) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as bigint)
           as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint)
           as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from d left join covered using (r)),
measured as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         case when n_words > 0 then word_chars / n_words else 0 end as word_length,
         case when n_words > 0 then n_symbols / n_words else 0 end as symbols,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_lines,
         case when n_words > 0 then n_repeat_words / n_words else 0 end as repeats
  from stats),
binned as (
  select lang, source, measure,
         case when value > 0 then ceil(ln(value) / {math.log(quality._GROWTH)!r}::double) end as bin
  from measured, lateral (values ('word_length', word_length), ('symbols', symbols),
                                 ('dup_lines', dup_lines), ('repeats', repeats))
       as m(measure, value)
  where not base_failed),
levels as (
  select 's' as level, lang, source, measure, bin from binned
  union all select 'l', lang, null, measure, bin from binned
  union all select 'c', null, null, measure, bin from binned),
counted as (
  select level, lang, source, measure, bin, count(*) as n from levels group by all),
ranked as (
  select *, cast(sum(n) over (w order by bin nulls first) as double) as upto,
         cast(sum(n) over w as double) as total, {_by_measure(quality.LEVEL)} as lvl,
         coalesce(exp(bin * {math.log(quality._GROWTH)!r}::double)
                  * {2 / (quality._GROWTH + 1)!r}::double, 0) as value
  from counted window w as (partition by level, lang, source, measure)),
halved as (
  select *, min(case when upto >= ceil(total * 0.5) then value end)
              over (partition by level, lang, source, measure) as middle
  from ranked),
spread as (
  select level, lang, source, measure, max(total) as total, max(middle) as middle,
         sum((least(upto, lvl * total) - least(upto - n, lvl * total))
             * greatest(value - middle, 0) / (total * (lvl - 0.5))) as over_it,
         sum((greatest(upto, (1 - lvl) * total) - greatest(upto - n, (1 - lvl) * total))
             * greatest(middle - value, 0) / (total * (lvl - 0.5))) as under_it
  from halved group by level, lang, source, measure),
sided as (
  select level, lang, source, total, measure,
         middle + {_by_measure(quality.LEAST_DISTANCE)}
                + {_by_measure(quality.SPREADS)} * over_it as upper_fence,
         greatest(middle - {_by_measure(quality.LEAST_DISTANCE)}
                  - {_by_measure(quality.SPREADS)} * under_it, {quality.LEAST_FENCE}) as lower_fence
  from spread),
bounds as (
  select g.lang, g.source, m.measure, m.side,
         coalesce(exp((s.total * ln(case when side = 1 then s.upper_fence else s.lower_fence end)
                       + {quality.POOL} * ln(pooled)) / (s.total + {quality.POOL})), pooled) as fence
  from (select distinct lang, source from measured) g,
       (select c.measure, side, l.lang,
               coalesce(exp((l.total * ln(case when side = 1 then l.upper_fence
                                               else l.lower_fence end)
                             + {quality.POOL} * ln(case when side = 1 then c.upper_fence
                                                        else c.lower_fence end))
                            / (l.total + {quality.POOL})),
                        case when side = 1 then c.upper_fence else c.lower_fence end) as pooled
        from (select distinct lang from measured) as langs
        cross join (values (1), (2)) as sides(side)
        join sided c on c.level = 'c'
        left join sided l on l.level = 'l' and l.measure = c.measure
          and l.lang is not distinct from langs.lang) as m
  left join sided s on s.level = 's' and s.measure = m.measure
    and s.lang is not distinct from g.lang and s.source is not distinct from g.source
  where m.lang is not distinct from g.lang),
outside as (
  select r
  from measured,
       lateral (values ('word_length', word_length), ('symbols', symbols),
                       ('dup_lines', dup_lines), ('repeats', repeats)) as m(measure, value)
  join bounds b on b.measure = m.measure and b.lang is not distinct from measured.lang
    and b.source is not distinct from measured.source
  where (side = 1 and value > fence) or (side = 2 and m.measure = 'word_length' and value < fence)
  group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and outside.r is null as kept
from measured left join outside on measured.r = outside.r
"""

_OP6 = r"""
with sized as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mixture|' || coalesce(cast(doc_id as varchar), 'none') || '|'
             || md5(coalesce(text, ''))) as tie
  from documents),
named as (
  select source, cast(sum(size) as bigint) as source_size,
         [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight,
         row_number() over (order by source nulls last) as place
  from sized group by source),
steps as (
  select *, row_number() over w as step,
         cast(sum(source_size) over () * 3
              - 2 * coalesce(sum(2 * source_size) over (w rows between unbounded preceding
                                                        and 1 preceding), 0) as double) as rest,
         cast(sum(weight) over (w rows between current row and unbounded following) * 2
              as double) as sharing
  from named
  window w as (order by cast(source_size as double) / weight, place)),
level as (
  select step, rest, sharing from steps
  where not (2 * source_size * sharing <= weight * rest) order by step limit 1),
targets as (
  select s.source, s.source_size,
         case when l.step is null or s.step < l.step then cast(2 * s.source_size as double)
              else s.weight * l.rest / l.sharing end as target
  from steps s left join level l on true),
quotas as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as int) else 0 end
              as whole,
         target - (case when source_size > 0 then floor(target / source_size) else 0 end)
                  * source_size as quota
  from targets),
by_size as (
  select s.source, size, n, quota,
         quota - coalesce(cast(sum(size * n) over (w rows between unbounded preceding
                                                   and 1 preceding) as double), 0) as rest,
         cast(sum(cast(size as hugeint) * size * n) over (w rows between current row
                                                and unbounded following) as double) as squares
  from (select source, size, count(*) as n from sized where size > 0 group by all) as s
  join quotas q on s.source is not distinct from q.source and quota > 0
  window w as (partition by s.source order by size desc)),
levels as (
  select source, max(size) as lvl, arg_max(rest, size) as rest,
         arg_max(rest, size) / arg_max(squares, size) as scale
  from by_size where rest * size < squares group by source),
drawn as (
  select d.doc_id, d.size, d.tie, q.*, l.lvl, l.rest, l.scale * d.size as p,
         (cast(('0x' || substr(d.tie, 1, 13))::bigint as double) + 0.5)
           / 4503599627370496.0::double as u
  from sized d join quotas q on d.source is not distinct from q.source
  left join levels l on d.source is not distinct from l.source),
ranked as (
  select *, (u / (1.0::double - u)) / (p / (1.0::double - p)) as rank
  from drawn where size > 0 and size <= lvl),
summed as (
  select *, cast(sum(size) over (partition by source order by rank, tie) as double) as upto,
         cast(sum(size) over (partition by source, rank, tie) as double) as own
  from ranked)
select doc_id, size, source_size, target,
       size * (whole + case when quota > 0 and upto - rest <= rest - (upto - own)
                            then 1 else 0 end) as taken
from summed
union all
select doc_id, size, source_size, target,
       size * (whole + case when quota > 0 and size > coalesce(lvl, 0) then 1 else 0 end)
from drawn where not (size > 0 and coalesce(size <= lvl, false))
"""

_OP8 = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
b as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
wanted as (
  select distinct item_id, n, array_to_string(words[s:s + n - 1], ' ') as w
  from (select *, least(10, len(words)) as n,
               unnest(range(1, greatest(len(words) - 10, 0) + 2)) as s
        from b where len(words) > 0)),
lengths as (select distinct n from wanted),
runs as (
  select r, n, s, array_to_string(words[s:s + n - 1], ' ') as w
  from (select r, words, n, unnest(range(1, len(words) - n + 2)) as s
        from d, lengths where len(words) >= n)),
found as (select r, runs.n, s, item_id from runs join wanted using (w, n)),
hit as (
  select r, count(distinct pos) as n_hit
  from (select r, unnest(range(s, s + n)) as pos from found) group by r),
items as (
  select r, count(distinct item_id) as n_items,
         string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))
           as names
  from found group by r)
select doc_id, cast(len(words) as bigint) as n_words,
       cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join items using (r)
"""

_OP10 = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
windows as (
  select r, doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) as w
  from (select *, unnest(range(1, len(words) - 48)) as s from d where len(words) >= 50)),
lowest as (select w, min(doc_id) as low from windows group by w),
gone as (
  select distinct r, unnest(range(s, s + 50)) as pos
  from windows join lowest using (w) where low < doc_id),
kept as (
  select r, string_agg(word, ' ' order by pos) as words, count(*) as n
  from (select r, words[pos] as word, pos
        from (select r, words, unnest(range(1, len(words) + 1)) as pos from d)) as p
  anti join gone using (r, pos)
  group by r)
select doc_id, cast(len(d.words) as bigint) as n_words,
       cast(len(d.words) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(kept.words, '')) as kept_sha256
from d left join kept using (r)
"""

_OP11 = r"""
with recursive d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
sets as (
  select r, doc_id, list_sort(list_distinct(
           case when len(words) < 2 then words
                else list_transform(range(1, len(words)),
                                    lambda i: words[i] || ' ' || words[i + 1]) end)) as s
  from d),
classes as (
  select row_number() over () as c, s, len(s) as n, min(doc_id) as low
  from sets where len(s) > 0 group by s),
members as (select c, n, unnest(s) as shingle from classes),
links as (
  select a.c as a, b.c as b
  from members a join members b on a.shingle = b.shingle and a.c < b.c
    and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.c, b.c, a.n, b.n
  having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
steps as (select a, b from links union all select b, a from links),
reach as (select a, b from steps
          union select reach.a, steps.b from reach join steps on reach.b = steps.a),
lowest as (
  select c, min(low) as low
  from (select c, low from classes
        union all select reach.a, classes.low from reach join classes on reach.b = classes.c)
  group by c)
select doc_id, cast(len(sets.s) as bigint) as n_shingles,
       case when c is null then doc_id else lowest.low end as component_id,
       doc_id is not distinct from case when c is null then doc_id else lowest.low end as kept
from sets left join classes using (s) left join lowest using (c)
"""

# Checksums of strings, of which DuckDB has no function: a table of the 256 bytes, and one
# step per byte of UTF-8.
_CRC_TABLE = """crc as (
  select list(c order by i) as steps
  from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
          case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c
        from range(256) as r(i)))"""


def _crc32(text: str) -> str:
    return f"""xor(4294967295::bigint, list_reduce(
      list_prepend(4294967295::bigint, list_transform(range(0, strlen({text})), lambda i:
        ('0x' || substr(hex({text}), cast(2 * i + 1 as int), 2))::bigint)),
      lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"""


_OP12 = rf"""
with recursive {_CRC_TABLE},
runs as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run
  from documents),
counted as (
  select run, count(*) as n, coalesce(cast(doc_id as varchar), '') || ':' || run as name
  from runs group by doc_id, run),
checked as (select run, n, {_crc32("name")} as h from counted, crc),
typed as (
  select case when h % 199 = 0 then substr(run, 1, cast(h % length(run) as int))
                                    || substr(run, cast(h % length(run) as int) + 2)
              else run end as word, n
  from checked),
words as (
  select word, cast(sum(n) as bigint) as n from typed
  where length(word) >= 6 group by word having sum(n) >= 5),
cut as (
  select word, n, pos, substr(word, 1, cast(pos - 1 as int)) || substr(word, cast(pos + 1 as int))
           as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as pos from words)),
near as (
  select a.word, b.word as other, b.n as other_n
  from cut a join cut b using (pos, rest) where a.word <> b.word
  union select words.word, cut.word, cut.n from words join cut on words.word = cut.rest
  union select cut.word, words.word, words.n from words join cut on words.word = cut.rest),
best as (
  select word, count(*) as n_near, max(other_n) as most,
         min(other) filter (where other_n = largest) as other
  from (select *, max(other_n) over (partition by word) as largest from near) group by word),
judged as (
  select word, n, coalesce(n_near, 0) as n_near,
         case when most >= 5 * n then other end as form,
         case when most >= 5 * n then most end as form_n
  from words left join best using (word)),
climb as (
  select word, word as root, 0 as depth from words
  union all
  select climb.word, judged.form, depth + 1 from climb join judged on climb.root = judged.word
  where judged.form is not null)
select word, n, cast(n_near as bigint) as n_near, form, form_n,
       (select arg_max(root, depth) from climb where climb.word = judged.word) as root
from judged
"""

_OP13 = rf"""
with {_CRC_TABLE},
d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as words,
         coalesce(cast(doc_id as varchar), '') as name
  from documents),
checked as (select r, doc_id, words, {_crc32("name")} as h from d, crc),
placed as (
  select *, len(words) as n, h // 10 as g,
         doc_id is not null and h % 10 = 0 and len(words) > 0 as planted
  from checked),
bent as (
  select r, doc_id, n, case when planted then g % n end as a,
         case when planted then 1 + (n - g % n) // (3 + g % 8) end as p, words
  from placed),
texts as (
  select r, doc_id, n, case when a is null then words else list_transform(range(0, n),
           lambda i: words[1 + case when i < a then i else a + (i - a) % p end]) end as words
  from bent),
placed_words as (
  select r, n, pos, words[pos + 1] as word
  from (select r, n, words, unnest(range(0, n)) as pos from texts)),
pairs as (
  select x.r, x.pos, y.pos - x.pos as period
  from placed_words x join placed_words y
    on x.r = y.r and x.word = y.word and y.pos > x.pos and 3 * (y.pos - x.pos) <= x.n),
islands as (
  select r, period, min(pos) as start, count(*) + period as length
  from (select *, pos - row_number() over (partition by r, period order by pos) as island
        from pairs)
  group by r, period, island having count(*) + period >= greatest(24, 3 * period)),
runs as (select r, start, length, min(period) as period from islands group by r, start, length),
gone as (
  select distinct r, unnest(range(start + period, start + length)) as pos from runs),
left_over as (
  select r, string_agg(word, ' ' order by pos) as words
  from placed_words anti join gone using (r, pos) group by r),
best as (
  select *, row_number() over (partition by r
           order by cast(length as double) / period desc, start, period) as place
  from runs),
listed as (
  select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
           order by start, period) as lines
  from runs group by r)
select doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, best.start, best.length,
       best.period, 1000 * best.length // best.period as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256,
       sha256(coalesce(left_over.words, '')) as collapsed_sha256
from texts left join listed using (r) left join left_over using (r)
  left join best on best.r = texts.r and best.place = 1
"""

ORACLES = {
    "op1_warc": _OP1,
    "op3_quality": _OP3,
    "op6_mixture": _OP6,
    "op8_decontamination": _OP8,
    "op10_substrings": _OP10,
    "op11_minmax": _OP11,
    "op12_spelling": _OP12,
    "op13_periodic_runs": _OP13,
}
