"""The operators with production parameters on the given tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (bitpack, decontam, exact_dedup, fill_middle, jaccard_join, langid, packing, phrases, pii,
                           quality, suffix_dedup, token_count, url_filter)
from tidewater.llm.token_count import tokenizer_file
from tidewater.session import scratch_path
from tidewater.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn
    return add


#: Fixed values of the contract.
URL_RULES = [
    url_filter.prefix_rule("org", "/", "allow"),
    url_filter.prefix_rule("example.org", "/es/", "block"),
    url_filter.prefix_rule("example.org", "/en/1", "block"),
    url_filter.prefix_rule("com", "/fr/", "allow"),
    url_filter.prefix_rule("com", "/de/", "block"),
]
#: Pattern rules of our own, for the URLs that no rule of the contract fits.
URL_PATTERNS = [
    url_filter.pattern_rule("spam-farm", r"\A(?:[^/]*\.)?spam-farm\.", ("spam", "farm")),
    url_filter.pattern_rule("cheap-pills", r"\A(?:[^/]*\.)?cheap-pills\.", ("cheap", "pills")),
    url_filter.pattern_rule("casino", r"\A[^/]*(?:\A|[.-])casino[.-]", ("casino",)),
    url_filter.pattern_rule("tracker-path", r"\A[^/]+/(?:[^/]+/)*(?:adserver|doubleclick)/", ()),
]


@query("op1_url_filters", r"""
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
hosts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw_host from parts),
split as (
  select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path
  from hosts),
judged as (
  select page_id, coalesce(host, '') as host, coalesce(path, '') as path from split)
select page_id, host, path,
  case when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
       when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
       when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
       when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'com/de/'
       when ('.' || host) like '%.org' and starts_with(path, '/') then 'org/' end as rule,
  case when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'block'
       when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'block'
       when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'allow'
       when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'block'
       when ('.' || host) like '%.org' and starts_with(path, '/') then 'allow'
       when regexp_matches(host || path, '^([^/]*\.)?spam-farm\.') then 'block'
       when regexp_matches(host || path, '^([^/]*\.)?cheap-pills\.') then 'block'
       when regexp_matches(host || path, '^[^/]*(^|[.-])casino[.-]') then 'block'
       when regexp_matches(host || path, '^[^/]+/([^/]+/)*(adserver|doubleclick)/') then 'block'
       else 'allow' end as verdict,
  case when ('.' || host) like '%.example.org' and (starts_with(path, '/en/1') or starts_with(path, '/es/')) then null
       when ('.' || host) like '%.com' and (starts_with(path, '/fr/') or starts_with(path, '/de/')) then null
       when ('.' || host) like '%.org' and starts_with(path, '/') then null
       when regexp_matches(host || path, '^([^/]*\.)?spam-farm\.') then 'spam-farm'
       when regexp_matches(host || path, '^([^/]*\.)?cheap-pills\.') then 'cheap-pills'
       when regexp_matches(host || path, '^[^/]*(^|[.-])casino[.-]') then 'casino'
       when regexp_matches(host || path, '^[^/]+/([^/]+/)*(adserver|doubleclick)/') then 'tracker-path' end as pattern
from judged
""")
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rule`` names rules of the contract only; what our own patterns found is in ``pattern``."""
    found = url_filter.filter_urls(load(spark, sf_dir, "pages"), URL_RULES + URL_PATTERNS)
    fixed = F.col("rule").isin([r.name for r in URL_RULES])
    return found.select("page_id", "host", "path", F.when(fixed, F.col("rule")).alias("rule"), "verdict",
                        F.when(~fixed, F.col("rule")).alias("pattern"))


@query("op2_decontamination", r"""
with docs as (
  select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') as w
  from documents),
items as (
  select w as iw, min(item_id) as item
  from (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'),
                                    lambda x: x <> '') as w
        from benchmark)
  where len(w) > 0 group by w),
masks as (select * from (values ([0,1,2,4,6,7]), ([0,1,4,5,6,7])) m(mask)),
item_seeds as (
  select item, k, mask, array_to_string(list_transform(mask, lambda o: iw[k + o + 1]), ' ') as seed
  from (select item, iw, mask, unnest(range(0, len(iw) - 7)) as k from items, masks)),
doc_seeds as (
  select doc_id, k, mask, array_to_string(list_transform(mask, lambda o: w[k + o + 1]), ' ') as seed
  from (select doc_id, w, mask, unnest(range(0, len(w) - 7)) as k from docs, masks)),
hits as (
  select distinct doc_id, item, d.k - i.k as diagonal
  from doc_seeds d join item_seeds i on d.seed = i.seed and d.mask = i.mask),
same as (
  select doc_id, item, len(iw) as n,
         list_transform(range(greatest(0, -diagonal), least(len(iw), len(w) - diagonal)),
                        lambda k: (iw[k + 1] = w[k + diagonal + 1])::int) as same
  from hits join docs using (doc_id) join items using (item)),
leaks as (
  select doc_id, item, max(list_sum(same)) as n_matched
  from same
  where len(list_filter(range(1, len(same) - least(n, 13) + 2),
                        lambda s: list_sum(same[s:s + least(n, 13) - 1]) >= case when n >= 13 then 11 else n end)) > 0
  group by all),
best as (
  select doc_id, count(*) as n_items, max(n_matched) as n_matched from leaks group by doc_id)
select d.doc_id, b.doc_id is not null as contaminated, coalesce(n_items, 0) as n_items,
       (select min(item) from leaks l where l.doc_id = d.doc_id and l.n_matched = b.n_matched) as item_id,
       coalesce(b.n_matched, 0)::int as n_matched
from documents d left join best b on b.doc_id = d.doc_id
""")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_spans(load(spark, sf_dir, "documents")))


def held_out():
    """A fifth of the documents, which language ID doesn't learn from; fixed by the contract."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(load(spark, sf_dir, "documents"), token_count.vocabulary())


@query("op6_exact_dedup", r"""
with rows as (
  select doc_id, length(coalesce(text, '')) as len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
ranked as (
  select doc_id, norm,
         first_value(doc_id) over (partition by norm order by len desc, doc_id) as keep_id,
         row_number() over (partition by norm order by len desc, doc_id) as place,
         count(*) over (partition by norm) as group_size
  from rows)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from ranked
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


@query("op7_token_ids")
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = bitpack.write_ids(load(spark, sf_dir, "documents"), scratch_path(spark, "token-ids"),
                                 tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return bitpack.read_ids(manifest)


@query("op8_jaccard_join", r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words),
classes as (select list_sort(s) as s, min(doc_id) as rep from sets where len(s) > 0 group by 1),
items as (select rep, len(s) as n, unnest(s) as g from classes),
pairs as (
  select a.rep as x, b.rep as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as c
  from items a join items b on a.g = b.g and a.rep < b.rep group by 1, 2),
links as (select x, y from pairs where 100 * c >= 80 * (nx + ny - c)),
edges as (select x, y from links union all select y, x from links),
reach(x, y) as (
  select x, y from edges union select r.x, e.y from reach r join edges e on r.y = e.x),
least_of as (select x, least(x, min(y)) as component_id from reach group by x)
select d.doc_id, len(d.s) as n_shingles,
       case when len(d.s) = 0 then d.doc_id else coalesce(l.component_id, c.rep) end as component_id
from sets d left join classes c on list_sort(d.s) = c.s left join least_of l on l.x = c.rep
""")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(load(spark, sf_dir, "documents"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded ratings: 0 to 2, a point for good quality and one for not being toxic."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return quality.grade(docs, quality.fit(docs, labels.select(
        "doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(load(spark, sf_dir, "documents"), token_count.vocabulary())


@query("op11_phrases", r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from worded),
grams as (
  select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, k
  from places, (select unnest([1, 2, 3, 4, 5]) as k) where i + k - 1 <= len(w)),
f as (select lang, phrase, any_value(k) as k, count(*)::hugeint as f from grams group by lang, phrase
      having count(*) >= 100),
total as (select lang, sum(len(w))::hugeint as n from worded group by lang),
longer as (
  select lang, f, string_split(phrase, ' ') as w, k, unnest(range(2, k)) as size from f where k >= 3),
inside as (
  select lang, array_to_string(w[o:o + size - 1], ' ') as phrase, max(f) as around
  from (select *, unnest(range(1, k - size + 2)) as o from longer) group by 1, 2),
kept as (
  select f.lang, f.phrase, f.f as a, f.k from f left join inside i on i.lang = f.lang and i.phrase = f.phrase
  where f.k >= 2 and coalesce(100 * i.around < 100 * f.f, true)),
cuts as (
  select lang, phrase, a, string_split(phrase, ' ') as w, k as size, unnest(range(1, k)) as k from kept),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, t.n, (1000 * c.a * t.n) // (x.f * y.f) as score
  from cuts c join total t on t.lang = c.lang
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
""")
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(load(spark, sf_dir, "documents"))


@query("op12_fill_middle", r"""
with drawn as (
  select doc_id, coalesce(text, '') as txt, sha256('1:' || coalesce(doc_id::varchar, '')) as h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u
  from documents),
numbers as (
  select doc_id, txt, u, len(u) as n, ('0x' || h[1:8])::bigint % (len(u) + 1) as x,
         ('0x' || h[9:16])::bigint % (len(u) + 1) as y, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from drawn),
formed as (
  select doc_id, txt, n,
         case when txt = '' or contains(txt, '<P>') or contains(txt, '<S>') or contains(txt, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form,
         array_to_string(u[1:least(x, y)], '') as pre,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') as mid,
         array_to_string(u[greatest(x, y) + 1:], '') as suf
  from numbers)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
       case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'plain' then txt when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(txt) as restored_sha256
from formed
""")
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.fill_middle(load(spark, sf_dir, "documents")))


@query("op13_suffix_dedup", r"""
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
  select doc_id, i, substr(h, 2 * i + 1, 200) as w
  from (select doc_id, h, unnest(range(0, length(h) // 2 - 99)) as i from docs)),
firsts as (select w, min((doc_id, i)) as first from windows group by w having count(*) > 1),
covered as (
  select doc_id, i from windows join firsts using (w) where (doc_id, i) > first),
edged as (
  select *, i > lag(i) over (partition by doc_id order by i) + 100 as edge from covered),
numbered as (
  select *, sum(coalesce(edge, true)::int) over (partition by doc_id order by i) as run from edged),
spans as (select doc_id, run, min(i) as b, max(i) + 100 as e from numbered group by all),
gaps as (
  select doc_id, b, e, coalesce(lag(e) over (partition by doc_id order by b), 0) as before from spans),
cut as (
  select g.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' order by b) as front,
         max(e) as last, sum(e - b) as gone, count(*) as n
  from gaps g join docs d on d.doc_id = g.doc_id group by g.doc_id)
select d.doc_id, length(h) // 2 as n_bytes, coalesce(gone, 0)::bigint as n_removed, coalesce(n, 0)::bigint as n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from docs d left join cut c on c.doc_id = d.doc_id
""")
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(load(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
