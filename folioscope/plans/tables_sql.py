"""SQL for the reports over the tables of plans/tables.py, written apart from the engine."""

from __future__ import annotations

from folioscope.plans.tables import FILES_SQL, RECORDS_SQL

NORM = r"""lower(trim(regexp_replace(replace(translate({}, '‘’“”–—−*_`', '''''""---'), '…', '...'), '\s+', ' ', 'g')))"""
LEFT = r"(?:^|[^\p{L}\p{N}_])"
BASE = f"with recursive {FILES_SQL},{RECORDS_SQL}"


def hits(terms: list[str], text: str) -> str:
    return f"len(regexp_extract_all({text}, '{LEFT}(?:{'|'.join(terms)})'))"


SECTIONS = f"with {FILES_SQL} select file, ordinal::int as ordinal, id, level, title, array_to_string(titles, ' > ') as titles, anchor, line_start::int as line_start, line_end::int as line_end, words::int as words, sha256(text) as text_sha256 from sections"
DOCUMENTS = f"with {FILES_SQL} select path, slug, author, title, case when doc_id % 3 = 0 then doc_id::varchar end as wordpress_id, sha256, n_lines::int as lines, words::int as words, url from docs"
STALE = "case when stale then '; the record is older than the document' else '' end"
CHECKED = f"""
valid as materialized (select r.*, n.sha256 as doc_sha, n.path as doc_file, n.sha256 <> r.source_sha256 as stale from rec r left join named n on n.slug = r.commentary where r.source_sha256 <> 'short' and r.coverage <> 'whole'),
last_section as (select * from sections qualify row_number() over (partition by file, id order by ordinal desc) = 1),
owners as (select id, list(distinct commentary) as owners from strata group by 1),
items as (select u.path, u.id, u.locator, u.commentary, u.quote, u.theme, u.stratum, v.stale, 'unit' as noun, u.nr from unit u join valid v using (doc_id) where v.doc_sha is not null
  union all select i.path, i.id, i.locator, i.commentary, i.quote, null, null, n.sha256 <> i.source_sha256, 'engagement', 0 from inh i join named n on n.slug = i.commentary),
cut as (select *, case when strpos(locator, '#') > 1 and strpos(locator, '#') < length(locator) then locator[: strpos(locator, '#') - 1] end as l_slug, case when strpos(locator, '#') > 1 and strpos(locator, '#') < length(locator) then locator[strpos(locator, '#') + 1 :] end as sec from items),
found as materialized (select c.*, s.line_start, s.line_end, {NORM.format('s.text')} as body, {NORM.format('c.quote')} as nq, case when l_slug is null then 'a locator has a document, # and a section, not ''' || locator || '''' when l_slug <> c.commentary then 'the locator names ''' || l_slug || ''' in a record on ''' || c.commentary || ''''
  when n.slug is null then 'there is no document ''' || l_slug || '''' when s.id is null then 'document ''' || l_slug || ''' has no section ''' || sec || '''' end as reason
  from cut c left join named n on n.slug = c.l_slug left join last_section s on s.file = n.path and s.id = c.sec),
gone as (select a.path, a.locator, a.commentary, v.stale, unnest(coalesce(a.absent_terms, (select arg_max(search_terms, position) from themes t where t.id = a.theme))) as term from absence a join valid v using (doc_id) where v.doc_sha is not null),
gone_at as (select g.*, {NORM.format('s.text')} as body, locator[strpos(locator, '#') + 1 :] as sec from gone g join named n on n.slug = g.commentary join last_section s on s.file = n.path and s.id = locator[strpos(locator, '#') + 1 :] where g.locator like g.commentary || '#%'),
lost as (select a.path, a.locator, a.commentary, v.doc_file, locator[: strpos(locator, '#') - 1] as l_slug, locator[strpos(locator, '#') + 1 :] as sec from absence a join valid v using (doc_id) where v.doc_sha is not null)"""
VIOLATIONS = f"""{BASE},{CHECKED}
select severity, rule, file, item, message from (
select 'error' as severity, 'V2' as rule, 'themes.json' as file, id as item, 'theme ''' || id || ''' is listed twice' as message from themes qualify row_number() over (partition by id order by position) > 1
union all select 'error', 'V3', 'chronology.json', commentary, 'no document is called ''' || commentary || '''' from entry where commentary not in (select slug from files)
union all select 'error', 'V4', 'chronology.json', id, 'layer ''' || id || ''' is listed twice' from strata qualify row_number() over (partition by id order by position, nr) > 1
union all select 'error', 'V5', 'chronology.json', id, 'layer ''' || id || ''' takes its date from elsewhere and names no evidence' from strata where not stated and evidence is null
union all select 'error', 'V6', 'chronology.json', commentary, 'entry ''' || commentary || ''' counts as ' || status || case status when 'resolved' then ' but has no year' else ' but has a year' end from (select e.commentary, e.status, (select count(y1) from strata s where s.position = e.position) as years from entry e) where (status = 'resolved') = (years = 0)
union all select 'warning', 'V7', 'chronology.json', slug, 'document ''' || slug || ''' has no entry, so no ledger can place it' from (select distinct slug from files) where slug not in (select commentary from entry)
union all select 'warning', 'V8', 'gaps.json', id, 'raised by ''' || raised_by || ''', which is not a file' from gaps where raised_by not in (select path from files)
union all select 'error', 'V9', path, null, '$.source_sha256: does not fit ^[0-9a-f]{{64}}$' from rec where source_sha256 = 'short'
union all select 'error', 'V9', path, null, '$.coverage: must be one of ["complete", "partial"]' from rec where coverage = 'whole'
union all select 'error', 'V10', path, commentary, 'there is no theme ''' || theme || '''' from valid where theme not in (select id from themes)
union all select 'error', 'V10', path, commentary, 'the folder is not that of the theme' from valid where path not like 'extractions/' || theme || '/%'
union all select 'error', 'V10', path, commentary, 'the file is not named after its document' from valid where path not like '%/' || commentary || '.json'
union all select 'error', 'V11', path, commentary, 'there is no document ''' || commentary || '''' from valid where doc_sha is null
union all select 'warning', 'V12', path, commentary, 'document ''' || commentary || ''' is newer than the record: ' || left(source_sha256, 12) || ' then, ' || left(doc_sha, 12) || ' now' from valid where stale
union all select 'warning', 'V12', i.path, i.commentary, 'document ''' || i.commentary || ''' is newer than the record' from inh i join named n on n.slug = i.commentary where n.sha256 <> i.source_sha256
union all select 'error', 'V13', path, commentary, 'a partial record needs a note on what was read' from valid where doc_sha is not null and coverage = 'partial' and coverage_note is null
union all select 'error', 'V14', path, id, noun || ' id was used before, last in ' || previous from (select *, lag(path) over (partition by noun, id order by path, nr) as previous from items) where previous is not null
union all select 'error', 'V15', path, id, 'the id does not begin with that of the theme' from items where noun = 'unit' and not starts_with(id, theme || '/')
union all select 'error', 'V16', path, id, 'there is no layer ''' || stratum || '''' from items where stratum is not null and stratum not in (select id from strata)
union all select 'warning', 'V16x', path, i.id, 'layer ''' || stratum || ''' is another document''s; the unit counts but is not shown' from items i join owners o on o.id = i.stratum where not list_contains(owners, commentary)
union all select 'error', 'V17', path, id, reason from found where reason is not null
union all select 'error', 'V17', path, 'absence 0', case when l_slug <> commentary then 'the locator names ''' || l_slug || ''' in a record on ''' || commentary || '''' else 'document ''' || l_slug || ''' has no section ''' || sec || '''' end from lost l where l_slug <> commentary or not exists (select 1 from sections s where s.file = l.doc_file and s.id = l.sec)
union all select case when stale then 'warning' else 'error' end, 'V18', path, id, 'the quote is not in section ''' || sec || ''', lines ' || line_start || ' to ' || line_end || {STALE} from found where reason is null and nq <> '' and not contains(body, nq)
union all select 'error', 'V18', path, id, 'nothing is left of the quote when it is normalized' from found where reason is null and nq = ''
union all select case when stale then 'warning' else 'error' end, 'V19', path, 'absence 0', 'term ''' || term || ''' does occur in section ''' || sec || '''' || {STALE} from gone_at where regexp_matches(body, '{LEFT}' || term)
union all select 'warning', 'V20', 'index', null, 'the index is older than the documents')"""
TIMELINE = """
last_entry as materialized (select * from entry qualify row_number() over (partition by commentary order by position desc) = 1),
own_strata as materialized (select s.* from strata s join last_entry e using (position)),
dated as (select position, min(y1) as year, list(case when y2 is null or y2 = 0 or y2 = y1 then y1::varchar else y1 || '-' || y2 end order by nr) filter (y1 is not null) as labels from own_strata group by 1)"""
LINK = "case when s.id is not null then ', [' || s.title || '](' || n.url || '#' || s.anchor || ')' else '' end"
LEDGER = f"""{BASE},{TIMELINE},
own as materialized (select * from rec where theme = 'care' qualify row_number() over (partition by commentary order by path desc) = 1),
placed as materialized (select o.*, e.position, case when e.status = 'unresolved' then 3 when e.role = 'reception' then 2 else 1 end as bucket, coalesce(d.year, 9999) as year, coalesce(case when labels[1] = labels[-1] then labels[1] else labels[1] || ' to ' || labels[-1] end, 'undated') as label, n.title as doc_title, n.path as doc_file, n.url, (select count(*) from own_strata s where s.position = e.position) as n_strata
  from own o join last_entry e using (commentary) left join dated d using (position) join named n on n.slug = o.commentary where role <> 'output'),
last_section as (select * from sections qualify row_number() over (partition by file, id order by ordinal desc) = 1),
us as materialized (select p.commentary, p.bucket, p.year, p.n_strata, u.*, coalesce(x.y1, 9999) as sy, x.nr as sat, x.label as slabel, x.id as sid, {LINK.replace('n.url', 'p.url')} as link from placed p join unit u using (doc_id) left join own_strata x on x.position = p.position and x.id = u.stratum
  left join last_section s on s.file = p.doc_file and strpos(u.locator, '#') > 0 and s.id = u.locator[strpos(u.locator, '#') + 1 :]),
shown as materialized (select *, case when stratum is null then 99999 else sy end as gy, coalesce(sat, 0) as gat from us where stratum is null or sid is not null),
groups as (select commentary, bucket, year, gy, gat, max(slabel) as slabel, any_value(n_strata) as n_strata, bool_and(stratum is null) as loose, (select count(*) from shown z where z.commentary = s.commentary and z.stratum is not null) as others from shown s group by all),
ab as (select p.commentary, p.bucket, p.year, a.*, {LINK.replace('n.url', 'p.url')} as link from placed p join absence a using (doc_id) left join last_section s on s.file = p.doc_file and s.id = a.locator[strpos(a.locator, '#') + 1 :]),
counts as (select count(*) as n, coalesce(sum((select count(*) from unit u where u.doc_id = o.doc_id)), 0)::bigint as units, coalesce(sum((select count(*) from absence a where a.doc_id = o.doc_id)), 0)::bigint as absences from own o),
lines(k0, k1, k2, name, seg, g1, g2, nr, ls) as (
  select 0, 0, 0, '', 0, 0, 0, 0, ['# Care, tending: the records in order of time', '', 'What is tended.', '', 'From ' || n || ' documents: units ' || units || ', absences ' || absences, ''] from counts
  union all select distinct 1, bucket, 0, '', 0, 0, 0, 0, case bucket when 1 then ['## Dated sources', ''] when 2 then ['## Later readers', '', 'Years here are those of the readers.', ''] else ['## Without a date', '', 'No year is known, so these have no place in the order above.', ''] end from placed
  union all select 1, bucket, year + 1000, commentary, 0, 0, 0, 0, ['### ' || doc_title || ', ' || label || ' (`' || commentary || '`)', ''] from placed
  union all select 1, bucket, year + 1000, commentary, 1, gy, gat, -1, case when loose then ['#### No layer named', ''] else ['#### ' || slabel, ''] end from groups where case when loose then others > 0 else n_strata > 1 end
  union all select 1, bucket, year + 1000, commentary, 1, gy, gat, nr, ['- ' || status || ' **' || term || '** (`' || id || '`): ' || claim, '  - at `' || locator || '`' || coalesce(', ' || primary_locator, '') || link, '  - > ' || replace(quote, chr(10), ' ')] from shown
  union all select 1, bucket, year + 1000, commentary, 1, gy, gat, 1000000, [''] from groups
  union all select 1, bucket, year + 1000, commentary, 2, 0, 0, 0, list_filter(['#### Not found', '', '- nothing at `' || locator || '`' || link, '  - looked for since ' || expected_because, '  - ' || note, ''], lambda x: x is not null) from ab
  union all select 1, bucket, year + 1000, commentary, 3, 0, 0, 0, ['Read in part: ' || coalesce(coverage_note, 'which part is not said'), ''] from placed where coverage = 'partial'
  union all select 2, 0, 0, '', 0, 0, 0, 0, ['## Not read yet', '']
  union all select 3, -hits, 0, slug, 0, 0, 0, 0, ['- `' || slug || '`, hits: ' || hits] from (select f.slug, f.path, {hits(['thand', 'then', 'in the'], NORM.format('f.text'))} as hits from files f left join last_entry e on e.commentary = f.slug where f.slug not in (select commentary from own) and coalesce(e.role, '') <> 'output') where hits > 0
  union all select 4, 0, 0, '', 0, 0, 0, 0, ['Nothing: all documents with these terms have a record.'] where false),
each as (select *, generate_subscripts(ls, 1) as ln, unnest(ls) as line from lines)
select row_number() over (order by k0, k1, k2, name, seg, g1, g2, nr, ln)::int as ordinal, line from each"""
ALL_HITS = " union all ".join(f"select path, slug, author, '{t}' as theme, {hits(w, NORM.format('text'))} as hits from files" for t, w in (("path", ["für", "pour"]), ("care", ["thand", "then", "in the"]), ("being", ["onat", "erth"])))
STATUS = f"""{BASE},{TIMELINE},
th(nr, theme, english) as (values (0, 'being', 'to be'), (1, 'care', 'tending'), (2, 'path', 'road')),
all_hits as ({ALL_HITS}),
open as materialized (select a.*, d.year from all_hits a left join last_entry e on e.commentary = a.slug left join dated d using (position) where hits > 0 and coalesce(e.role, '') <> 'output' and not exists (select 1 from rec r where r.commentary = a.slug and r.theme = a.theme)),
kept as (select r.*, n.sha256 <> r.source_sha256 as stale from rec r left join named n on n.slug = r.commentary),
per as (select theme, count(*) as records, sum((select count(*) from unit u where u.doc_id = k.doc_id)) as units, sum((select count(*) from absence a where a.doc_id = k.doc_id)) as absences, count(*) filter (stale) as stale, count(*) filter (coverage = 'partial') as partial from kept k group by 1),
nexts as (select *, row_number() over (partition by theme order by hits desc, author, path) as rank from open qualify rank <= 6),
lines(k0, k1, name, name2, ls) as (
  select 0, 0, '', '', ['# Coverage', '', (select count(*) from files) || ' documents, ' || (select count(*) from sections) || ' sections, ' || (select sum(words) from docs)::bigint || ' words', '', '## Themes', '', '| theme | records | units | absences | stale | partial | open |', '|-|-|-|-|-|-|-|']
  union all select 1, nr, '', '', ['| ' || th.theme || ' (' || english || ') | ' || coalesce(records, 0) || ' | ' || coalesce(units, 0)::bigint || ' | ' || coalesce(absences, 0)::bigint || ' | ' || coalesce(stale, 0) || ' | ' || coalesce(partial, 0) || ' | ' || (select count(*) from open o where o.theme = th.theme) || ' |'] from th left join per on per.theme = th.theme
  union all select 2, 0, '', '', ['']
  union all select 3, 0, '', '', ['## To be read next', '']
  union all select 3, 1, theme, lpad(rank::varchar, 9, '0'), ['- ' || theme || ' ' || rank || ': `' || slug || '`, ' || coalesce(year::varchar, 'no year') || ', hits: ' || hits] from nexts
  union all select 3, 2, '', '', ['']
  union all select 4, 0, '', '', ['## Inheritance', '']
  union all select 4, 1, i.path, '', ['- `' || i.commentary || '`: 1 engagements' || case when n.sha256 <> i.source_sha256 then ', stale' else '' end] from inh i join named n on n.slug = i.commentary
  union all select 4, 2, '', '', ['']
  union all select 5, 0, '', '', ['## Older than their documents', '']
  union all select 5, 1, theme, path, ['- `' || theme || '/' || commentary || '`'] from kept where stale and theme in (select theme from th)
  union all select 5, 2, '', '', ['']
  union all select 6, 0, '', '', ['## No date known', '']
  union all select 6, 1, commentary, '', ['- `' || commentary || '`' || coalesce(': ' || note, '')] from last_entry where status = 'unresolved' and role <> 'output'
  union all select 6, 2, '', '', ['']
  union all select 7, 0, '', '', ['## Open questions', '']
  union all select 7, 1, id, '', ['- ' || id || ' (' || status || coalesce(', ' || theme, '') || '): ' || question || ' Needs: ' || needs] from gaps where status <> 'closed'
  union all select 7, 2, '', '', ['']),
each as (select *, generate_subscripts(ls, 1) as ln, unnest(ls) as line from lines)
select row_number() over (order by k0, k1, name, name2, ln)::int as ordinal, line from each"""

TOTALS = f"with {FILES_SQL} select (select count(*) from docs)::bigint as documents, (select sum(words) from docs)::bigint as words, (select count(*) from sections)::bigint as sections"
TWO_TOTALS = f"with {FILES_SQL} select f.path, {hits(['thand', 'then', 'in the'], NORM.format('f.text'))}::bigint as document_hits, coalesce((select sum({hits(['thand', 'then', 'in the'], NORM.format('s.text'))}) from sections s where s.file = f.path), 0)::bigint as section_hits from files f"
OPEN = STATUS[: STATUS.index("kept as (")].rstrip().rstrip(",") + " select path, theme, year, hits::bigint as hits from open"
UNCOVERED = f"""{BASE},{TIMELINE} select slug, path, year, hits::bigint as hits from (select f.slug, f.path, d.year, {hits(['thand', 'then', 'in the'], NORM.format('f.text'))} as hits from files f left join last_entry e on e.commentary = f.slug left join dated d using (position)
  where f.slug not in (select commentary from rec where theme = 'care') and coalesce(e.role, '') <> 'output') where hits > 0 order by hits desc, slug, path limit 25"""
SEARCH = f"""{BASE}, w as (select s.*, url, {hits(['thand', 'then', 'in the'], NORM.format('s.text'))} as hits from sections s join docs d on d.path = s.file),
covered as (select locator from unit join rec using (doc_id) where rec.theme = 'care' union select locator from absence join rec using (doc_id) where rec.theme = 'care')
select row_number() over (order by hits desc, slug, file, line_start)::int as rank, hits::bigint as hits, author, slug || '#' || id as locator, slug || '#' || id in (select locator from covered) as done, array_to_string(titles[greatest(len(titles) - 1, 1):], ' > ') as titles, line_start::int as line_start, line_end::int as line_end, words::int as words, url || '#' || anchor as url, count(*) over ()::bigint as total
from w where hits >= 1 order by rank limit 40"""
ESCAPED = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&#x27;')"
AUTHORS = f"""with {FILES_SQL} select author, row_number() over (order by lower(author), author)::int as place, string_agg('      <li><a href="' || {ESCAPED.format("replace(author || '/' || slug, ' ', '%20') || '.html'")} || '">' || {ESCAPED.format('title')} || '</a></li>', chr(10) order by path) as items from docs group by author"""
PAYLOADS = f"""with {FILES_SQL} select path, slug, title, array_to_string(list_transform(string_split(author, '-'), lambda x: upper(left(x, 1)) || lower(x[2:])), '-') as tag, case when doc_id % 3 = 0 then 'update' else 'create' end as action, case when doc_id % 3 = 0 then doc_id::varchar end as wordpress_id,
  sha256(case when doc_id % 3 = 0 then text else '---' || chr(10) || 'wordpress_id: n-' || slug || chr(10) || '---' || chr(10) || text end) as new_sha256 from docs"""
#: Headings one after the other; the open lists are (level, owner, last item), outermost first.
TOC = f"""with recursive {FILES_SQL},
t(file, n, open, parent) as (
  select distinct file, 0::bigint, [{{'level': 0::bigint, 'owner': null::bigint, 'last': null::bigint}}], null::bigint from sections
  union all
  select file, n, list_transform(kept, lambda x: {{'level': x.level, 'owner': x.owner, 'last': case when x.owner is not distinct from kept[-1].owner then n else x.last end}}), kept[-1].owner from (
    select file, n, case when fit[-1].level = level then fit else list_append(fit, {{'level': level, 'owner': coalesce(fit[-1].last, fit[-1].owner), 'last': null::bigint}}) end as kept
    from (select s.file, s.ordinal as n, s.level::bigint as level, list_filter(t.open, lambda x: x.level <= s.level) as fit from t join sections s on s.file = t.file and s.ordinal = t.n + 1)))
select file, n::bigint as n, parent from t where n > 0"""
