"""Oracle SQL (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

from ledgerlake.llm.rules import CONFIDENCE, LEVELS, RATES, RISK

ORACLES: dict[str, str] = {}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _rejecting() -> str:
    cases = []
    for k, cutoffs in enumerate(LEVELS):
        cases.append(f"when {' or '.join(f'{r} > {c}' for r, c in zip(RATES, cutoffs))} then {k}")
    return f"case {' '.join(cases)} else {len(LEVELS)} end"


ORACLES["op5_quality_rules"] = rf"""
with d as (
  select row_number() over () as rid, doc_id, lang, coalesce(text, '') as text, {WORDS} as words from documents
), lines as (
  select rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d
), windows as (
  select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from d where len(words) >= 3)
), repeats as (
  select rid, i from windows qualify count(*) over (partition by rid, w) > 1
), covered as (
  select rid, count(distinct i + k) as n from repeats, (select unnest([0, 1, 2]) as k) group by rid
), counted as (
  select d.rid, doc_id, lang, len(words) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words,
    len(regexp_extract_all(text, '\p{{Lu}}')) as n_capitals, len(regexp_extract_all(text, '!')) as n_exclaims
  from d join lines using (rid) left join covered c using (rid)
), measured as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    case when n_words > 0 then 1000 * n_symbols // n_words else 0 end as symbol_rate,
    case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as dup_line_rate,
    case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeat_rate,
    case when word_chars > 0 then 1000 * n_capitals // word_chars else 0 end as capital_rate,
    case when n_words > 0 then 1000 * n_exclaims // n_words else 0 end as exclaim_rate
  from counted
), leveled as (select *, {_rejecting()} as rejecting from measured
), good as (select doc_id from labels group by doc_id having max(quality) = 1
), hits as (select lang, rejecting from leveled join good using (doc_id) where not base_failed
), tests as (
  select lang, l.level, count(*) as n, count(*) filter (where rejecting <= l.level) as k
  from hits, (select unnest(range({len(LEVELS)})) as level) l group by lang, l.level
), passed as (
  select lang, level, n, k,
    case when k >= n * {RISK} then 1.0 else list_sum(list_transform(range(0, k + 1), lambda j: exp(
      lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({RISK}) + (n - j) * ln(1 - {RISK})))) end
      <= (1 - {CONFIDENCE}) / (select count(distinct coalesce(lang, '')) from hits) as passes
  from tests
), levels as (
  select lang, coalesce(min(level) filter (where not passes), {len(LEVELS)}) - 1 as level from passed group by lang
)
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rejecting > coalesce(v.level, -1) as kept
from leveled m left join levels v on m.lang is not distinct from v.lang
"""

ORACLES["op8_fair_mix"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as key
  from documents
), s as (
  select source, sum(size)::bigint as source_size,
    [3.0, 1.0, 2.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight
  from d group by source
), lv as (
  select *, (source_size * 2)::double as cap, (sum(source_size) over () * 3 / 2)::double as budget,
    sum((source_size * 2)::double) over (w rows between unbounded preceding and 1 preceding) as spent,
    sum(weight) over (w rows between current row and unbounded following) as left_weight
  from s window w as (order by (source_size * 2)::double / weight, source nulls last)
), op as (
  select *, (budget - coalesce(spent, 0)) / left_weight as level from lv
), opened as (select arg_min(level, cap / weight) as level from op where cap > level * weight
), t as (
  select source, source_size, budget,
    case when (select level from opened) is null then cap else least(cap, (select level from opened) * weight) end as target
  from op
), q as (
  select d.*, t.source_size, t.target, t.budget, sum(size) over (partition by d.source order by key, doc_id) as served
  from d join t on d.source is not distinct from t.source
), copies as (
  select *, (served + k * source_size) / target as vft from q, (select unnest([0, 1]) as k) where target > 0
), cum as (
  select *, sum(size) over (order by vft, source nulls last, key, doc_id) as upto from copies
), cut as (
  select vft, source is null as none, source, key, doc_id from cum where upto > budget
  order by vft, source nulls last, key, doc_id limit 1
), took as (
  select c.key, c.doc_id, c.source, count(*) as n from (select distinct key, doc_id, source, k, vft from copies) c
  where not exists (select * from cut)
    or (select (c.vft, c.source is null, coalesce(c.source, ''), c.key, coalesce(c.doc_id, -1))
           < (cut.vft, cut.none, coalesce(cut.source, ''), cut.key, coalesce(cut.doc_id, -1)) from cut)
  group by all
)
select q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(n, 0) as taken
from q left join took on took.key = q.key and took.doc_id is not distinct from q.doc_id and took.source is not distinct from q.source
"""

LOWER_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op2_decontaminate"] = rf"""
with b as (select item_id::varchar as item, {LOWER_WORDS} as words from benchmark),
bw as (
  select distinct item, least(10, len(words)) as width,
    array_to_string(words[i:i + least(10, len(words)) - 1], ' ') as w
  from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from b where len(words) > 0)
), widths as (select distinct width from bw),
d as (select row_number() over () as rid, doc_id, {LOWER_WORDS} as words from documents),
dw as (
  select rid, width, i, array_to_string(words[i:i + width - 1], ' ') as w
  from (select rid, words, width, unnest(range(1, len(words) - width + 2)) as i from d, widths where len(words) >= width)
), hit as (select rid, i, dw.width, item from dw join bw using (width, w)),
words as (
  select rid, count(distinct place) as n_hit
  from (select rid, unnest(range(i, i + width)) as place from (select distinct rid, i, width from hit)) group by rid
), items as (
  select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as named from hit group by rid
)
select doc_id, len(d.words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(named, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
"""


def jaccard_sql(words: int, part: int) -> str:
    """doc_id, n_shingles and component_id over a table ``documents`` with unique ids."""
    gram = " || ' ' || ".join(f"words[i + {k}]" for k in range(words))
    return rf"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents
), sh as (
  select distinct doc_id, {gram} as s
  from (select doc_id, words, unnest(range(1, len(words) - {words} + 2)) as i from d where len(words) >= {words})
  union all select doc_id, array_to_string(words, ' ') from d where len(words) between 1 and {words} - 1
), n as (select doc_id, count(*) as n from sh group by doc_id
), links as (
  select p.a, p.b from (
    select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y on x.s = y.s and x.doc_id <> y.doc_id group by all
  ) p join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b where 100 * c >= {part} * (na.n + nb.n - c)
), reach as (
  select doc_id, doc_id as root from d union select l.b, r.root from reach r join links l on l.a = r.doc_id
)
select r.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(root) as component_id
from reach r left join n on n.doc_id = r.doc_id group by r.doc_id
"""


ORACLES["op6_jaccard_join"] = jaccard_sql(3, 90)

# The pipeline, stage by stage: each stage's SQL over what the one before kept.
_KEY = "('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint"


def _over(sql: str, name: str) -> str:
    return sql.replace("from documents", f"from {name}")


def pipeline_sql(shards: int = 24, slots: int = 4096) -> str:
    return rf"""
with recursive s1 as (
  select * from documents where doc_id in (select doc_id from ({ORACLES["op5_quality_rules"]}) where kept)
), s2 as (
  select * from s1 where doc_id in (
    select doc_id from ({_over(jaccard_sql(5, 80), "s1")}) where doc_id = component_id)
), s3 as (
  select * from s2 where doc_id in (
    select doc_id from ({_over(ORACLES["op2_decontaminate"], "s2")}) where not contaminated)
), s4 as (
  select s3.* from s3 join ({_over(ORACLES["op8_fair_mix"], "s3")}) m on m.doc_id = s3.doc_id,
    unnest(range(case when m.size > 0 then m.taken // m.size else 0 end)) u(x)
), v as (select *, ({_KEY} % {slots})::int as virtual_slot from s4
), totals as (
  select virtual_slot, sum(octet_length(encode(coalesce(text, ''))) + 8)::bigint as bytes from v group by virtual_slot
), ranked as (
  select *, row_number() over (order by bytes desc, virtual_slot) as rn from totals
), fold as (
  select 0::bigint as rn, list_transform(range({shards}), lambda x: 0::bigint) as load, null::int as virtual_slot, null::int as shard
  union all
  select r.rn,
    list_transform(range(1, {shards} + 1), lambda i:
      f.load[i] + case when i = list_position(f.load, list_min(f.load)) then r.bytes else 0 end),
    r.virtual_slot, (list_position(f.load, list_min(f.load)) - 1)::int
  from fold f join ranked r on r.rn = f.rn + 1
)
select v.*, fold.shard from v join fold on fold.virtual_slot = v.virtual_slot
"""

ORACLES["op13_phrases"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null
), worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), grams as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (select unnest([1, 2, 3]) as k))
), f as (select lang, k, phrase, count(*) as n from grams group by all
), totals as (select lang, sum(n) as n from f where k = 1 group by lang
), candidates as (select lang, k, phrase, n as a, string_split(phrase, ' ') as w from f where k > 1 and n >= 10
), cuts as (
  select lang, k, phrase, a, c, array_to_string(w[1 : c], ' ') as head, array_to_string(w[c + 1 : k], ' ') as tail
  from (select *, unnest(range(1, k)) as c from candidates)
), scored as (
  select cuts.lang, cuts.k, cuts.phrase, a, c, l.n as l, r.n as r,
    1000000::hugeint * a::hugeint * a::hugeint // (l.n::hugeint * r.n::hugeint) as score
  from cuts join f l on l.lang = cuts.lang and l.phrase = head join f r on r.lang = cuts.lang and r.phrase = tail
), best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1
), parts as (
  select lang, array_to_string(w[i : i + 1], ' ') as phrase, max(a) as longer
  from (select *, unnest([1, 2]) as i from candidates where k = 3) group by all
), alone as (
  select best.* from best left join parts using (lang, phrase) where longer is null or 100 * longer < 50 * a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from alone
)
select lang, rank, phrase, a, l, r, totals.n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""
