"""DuckDB SQL equal to core queries."""

from __future__ import annotations

_E = "e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY title) AS rn FROM entries WHERE coalesce(title, '') <> '') WHERE rn = 1)"
_WS = r"[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _squeezed(t: str) -> str:
    return rf"trim(regexp_replace({t}, '{_WS}+', ' ', 'g'))"


def _bare(t: str) -> str:
    out = rf"regexp_replace(coalesce({t}, ''), '</?[A-Za-z][^<>]*>', '', 'g')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{a}', '{b}')"
    return _squeezed(out)


_PLAIN = f"{_E}, p AS (SELECT pos, title, url, definition, details, {_bare('definition')} AS plain FROM e)"
_FORWARD = rf"""nullif(rtrim({_squeezed(r"coalesce(nullif(regexp_extract(plain, '(?i)^See:\s+(.+)$', 1), ''), nullif(regexp_extract(plain, '(?i)^duplicate page\s*-\s*please see\s+(.+)$', 1), ''), nullif(regexp_extract(plain, '(?i)^(?:System Message:\s*)?For .+?,\s*please see\s+(.+)$', 1), ''), nullif(regexp_extract(plain, '(?i)^please see\s+(.+)$', 1), ''))")}, '.'), '')"""
_TITLE_BARE = r"nullif(trim(regexp_replace(title, '\s+\([^()]{1,120}\)\s*$', '')), '')"
_CATS = "list_filter(list_transform(coalesce(source_categories, []), lambda c: regexp_replace(lower(trim(c)), '^category:', '')), lambda c: c <> '')"
_FIRST = r"CASE WHEN regexp_full_match(title, '\p{Lu}[\p{L}''-]+ \p{Lu}[\p{L}''-]+') AND split_part(title, ' ', 1) NOT IN ('A', 'An', 'Captain', 'Commander', 'Count', 'Crown', 'Doctor', 'Dr', 'Duchess', 'Duke', 'King', 'Lady', 'Lord', 'Prince', 'Princess', 'Queen', 'Ser', 'Sir', 'The') THEN split_part(title, ' ', 1) END"


def _poss(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN [] ELSE [{x} || '''s', {x} || '’s'] || CASE WHEN regexp_matches({x}, '[sS]$') THEN [{x} || '''', {x} || '’'] ELSE [] END END"


_ITEM = "'Badge','Bandage','Beanie','Biscuit','Bolt','Box','Card','Chest','Chip','Cloak','Condom','Guide','Grenade','Kit','Pass','Patch','Pen','Potion','Scroll','Sigil','Tab','Table','Tattoo','Ticket','Workshop'"
_GROUP = "'Army','Club','Company','Corporation','Court','Empire','Front','Guild','Militia','Sultanate','Syndicate'"
_GENERIC = "'achievement','box','captain','class','club','commander','company','corporation','doctor','duke','duchess','group','item','king','lady','lord','militia','potion','prince','princess','queen','race','scroll','spell','system'"
_AUDIT = rf"""{_PLAIN}, f AS (SELECT *, {_FORWARD} AS fwd FROM p), a AS (
 SELECT 'unresolved-forward' AS kind, title, fwd AS detail FROM f WHERE fwd IS NOT NULL AND lower(fwd) NOT IN (SELECT lower(title) FROM e)
 UNION ALL SELECT 'gallery-credit', title, plain FROM f WHERE regexp_matches(plain, '(?i)\b(?:official\s+art|art)\s+by\b')
 UNION ALL SELECT 'maintenance-text', title, plain FROM f WHERE regexp_matches(plain, '(?i)duplicate page|for more information|please see')
 UNION ALL SELECT 'source-artifact', title, plain FROM f WHERE regexp_matches(plain, '\bisa\b|\bof\s+\.|\s+,|\s+\.')
 UNION ALL SELECT 'truncated', title, plain FROM f WHERE regexp_matches(plain, '(?i)\b(?:and|or|but|because|with|of|to)\s*$')
 UNION ALL SELECT 'short', title, plain FROM f WHERE length(plain) < 80 AND coalesce(len(details), 0) = 0 AND fwd IS NULL)"""
_SECTION = r"CASE WHEN regexp_extract(title, '[\p{L}\p{Nd}]') = '' OR regexp_matches(regexp_extract(title, '[\p{L}\p{Nd}]'), '^\p{Nd}') THEN '#' ELSE upper(strip_accents(regexp_extract(title, '[\p{L}\p{Nd}]'))) END"
_AL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "entries_scan": "SELECT title, url, first_paragraph, source_category FROM (SELECT *, row_number() OVER (PARTITION BY pageid ORDER BY fetched_at DESC NULLS LAST, title DESC NULLS LAST, first_paragraph DESC NULLS LAST, raw_html DESC NULLS LAST, source_category DESC NULLS LAST) AS rn FROM pages WHERE status = 'ok' AND coalesce(first_paragraph, '') <> '' AND in_scope = 1) WHERE rn = 1",
    "artifacts": rf"""SELECT pageid, {_squeezed(rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '{_WS}*\[{_WS}*\d+{_WS}*\]', '', 'g'), '\bisa\b', 'is a', 'g'), '(?i)\ba god of{_WS}*\.', 'a god.', 'g'), '{_WS}+([,.;:!?])', '\1', 'g'), '(?i){_WS}+For more information:{_WS}*[^.]+\.?\n?$', ''), '(?i){_WS}+(?:official{_WS}+art|art){_WS}+by\b[^\n]*\n?$', '')")} AS cleaned
FROM (SELECT DISTINCT pageid, first_paragraph || (['  [1] , and', ' isa god of .', ' Official art by X Y', ' For more information: Z'])[pageid % 4 + 1] AS t FROM (SELECT pageid, first_paragraph FROM pages WHERE first_paragraph IS NOT NULL))""".replace("'  [1] , and'", "' [1] , and'"),
    "text_forms": rf"""SELECT doc_id, CASE WHEN length(s) <= 220 THEN s ELSE rtrim(substr(s, 1, 219)) || '…' END AS snippet,
 CASE WHEN g <> '' THEN g ELSE 'Dictionary' END AS slug, regexp_matches(s, '(?i)\b(?:and|or|but|because|with|of|to)\s*$') AS trails_off
FROM (SELECT doc_id, {_squeezed("coalesce(text, '')")} AS s, regexp_replace(regexp_replace(coalesce(about_title, ''), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS g FROM documents)""",
    "first_sentences": rf"WITH {_PLAIN} SELECT pos, CASE WHEN regexp_extract(plain, '(?s)^(.*?[.!?]){_WS}+', 1) <> '' THEN regexp_extract(plain, '(?s)^(.*?[.!?]){_WS}+', 1) ELSE substr(plain, 1, 500) END AS sentence FROM p",
    "parentheticals": f"""WITH {_E}, b AS (SELECT pos, title, CASE WHEN {_TITLE_BARE} <> title THEN {_TITLE_BARE} END AS bare FROM e)
SELECT pos, title, bare, CASE WHEN bare IS NOT NULL AND count(bare) OVER (PARTITION BY lower(bare)) = 1 AND lower(bare) NOT IN (SELECT lower(title) FROM b) THEN bare ELSE title END AS munged FROM b""",
    "forwards": f"WITH {_PLAIN} SELECT pos, target FROM (SELECT pos, {_FORWARD} AS target FROM p) WHERE target IS NOT NULL",
    "forwards_resolved": f"""WITH RECURSIVE {_PLAIN}, f AS (SELECT pos, title, {_FORWARD} AS fwd FROM p),
 x AS (SELECT title, max(pos) AS pos FROM f GROUP BY title), y AS (SELECT lower(title) AS w, max(pos) AS pos FROM f GROUP BY 1),
 link AS (SELECT f.pos, coalesce(x.pos, y.pos) AS nxt FROM f LEFT JOIN x ON x.title = f.fwd LEFT JOIN y ON y.w = lower(f.fwd) WHERE f.fwd IS NOT NULL AND coalesce(x.pos, y.pos) IS NOT NULL),
 walk AS (SELECT pos, nxt, 1 AS n FROM link UNION ALL SELECT w.pos, l.nxt, w.n + 1 FROM walk w JOIN link l ON l.pos = w.nxt WHERE w.n < 60)
SELECT DISTINCT walk.pos, walk.nxt AS final FROM walk JOIN f ON f.pos = walk.nxt WHERE f.fwd IS NULL""",
    "out_of_scope": f"WITH {_E} SELECT pos, title FROM e WHERE len(source_categories) > 0 AND NOT list_has_any(list_transform(source_categories, lambda c: lower(replace(regexp_replace(c, '^Category:', ''), '_', ' '))), ['characters', 'groups', 'spells', 'achievements'])",
    "title_aliases": rf"""WITH {_E} SELECT title, source, alias FROM (
 SELECT title, 'title-suffix-' || lower(w) AS source, trim(title[:-(len(w) + 2)]) AS alias FROM e, (VALUES ('Spell'), ('Box'), ('Achievement'), ('Potion'), ('Scroll')) t(w) WHERE ends_with(title, ' ' || w)
 UNION ALL SELECT title, 'title-prefix-' || lower(w) || '-of', trim(title[len(w) + 5:]) FROM e, (VALUES ('Potion'), ('Scroll'), ('Ring'), ('Wand')) t(w) WHERE starts_with(title, w || ' of ')
 UNION ALL SELECT title, 'title-parenthetical', {_TITLE_BARE} FROM e WHERE {_TITLE_BARE} <> title) WHERE alias <> ''""",
    "plural_aliases": rf"""WITH {_E}, w AS (SELECT title, {_CATS} AS cats, trim(split_part(title, ' ', len(string_split(title, ' '))), '"''') AS last FROM e),
 k AS (SELECT * FROM w WHERE NOT regexp_matches(title, '[(),:]') AND regexp_full_match(last, '[A-Z][A-Za-z''-]*') AND last NOT IN ('Blue','Chee','Controls','Daughters','Experience','Limited','Male','Series') AND NOT ends_with(last, 'ii') AND NOT regexp_matches(last, '[sS]$') AND ends_with(title, last)
  AND list_has_any(cats, ['groups', 'items', 'mob_types', 'races']) AND (NOT list_contains(cats, 'items') OR last IN ({_ITEM})) AND (list_contains(cats, 'items') OR NOT regexp_matches(title, '(?i)\bof\b')) AND (NOT list_contains(cats, 'groups') OR last IN ({_GROUP})))
SELECT title, 'category-plural' AS source, title[:length(title) - length(last)] || unnest(CASE last WHEN 'Dwarf' THEN ['Dwarfs', 'Dwarves'] WHEN 'Elf' THEN ['Elves'] ELSE [CASE WHEN regexp_matches(last, '(?i)[^aeiou]y$') THEN last[:length(last) - 1] || 'ies' WHEN regexp_matches(last, '(?i)(?:s|x|z|ch|sh)$') THEN last || 'es' ELSE last || 's' END] END) AS alias FROM k""",
    "sidebar_aliases": rf"""WITH {_E}, v AS (SELECT title, unnest(string_split(regexp_replace(translate(d.value, ';|', ',,'), '(?i){_WS}+or{_WS}+', ',', 'g'), ',')) AS x FROM (SELECT title, unnest(details) AS d FROM e) WHERE d.label = 'Aliases'),
 n AS (SELECT title, {_squeezed("x")} AS alias FROM v), s AS (SELECT title, alias, {_squeezed(rf"regexp_replace(alias, '(?i)^(?:the|a|an){_WS}+', '')")} AS short FROM n WHERE alias <> '')
SELECT title, 'sidebar' AS source, alias FROM s UNION ALL SELECT title, 'sidebar-leading-article', short FROM s WHERE short <> alias""",
    "human_aliases": rf"WITH {_E} SELECT title, 'human-name' AS source, unnest(string_split(title, ' ')) AS alias FROM e WHERE regexp_full_match(title, '[A-Z][A-Za-z''-]{{2,}} [A-Z][A-Za-z''-]{{2,}}') AND len(list_filter(coalesce(details, []), lambda d: d.label = 'Race' AND contains(lower(d.value), 'human'))) > 0",
    "possessive_aliases": f"WITH {_E}, k AS (SELECT title, {_FIRST} AS first FROM e WHERE list_contains({_CATS}, 'characters')) SELECT DISTINCT title, 'character-possessive' AS source, unnest({_poss('title')} || {_poss('first')}) AS alias FROM k",
    "usability": rf"""WITH {_E}, a AS (SELECT pos, unnest(redirect_aliases) AS alias FROM e) SELECT pos, alias, CASE WHEN alias = '' THEN 'empty' WHEN length(alias) < 2 THEN 'too-short' WHEN regexp_matches(alias, '\[\d+\]') THEN 'citation-marker' WHEN regexp_matches(alias, '[()]') THEN 'parenthetical-note' WHEN contains(alias, ':') THEN 'not-a-name'
 WHEN regexp_matches(alias, '["“”]') THEN 'quoted-noise' WHEN NOT regexp_matches(alias, '^[\p{{Lu}}\p{{Lt}}\p{{Nd}}]') THEN 'not-title-like' WHEN lower(alias) IN ({_GENERIC}) THEN 'generic-word' END AS reason FROM a WHERE alias IS NOT NULL""",
    "page_latest": "SELECT pageid, title, url, source_category, status, in_scope, fetched_at FROM (SELECT *, row_number() OVER (PARTITION BY pageid ORDER BY fetched_at DESC NULLS LAST, in_scope DESC NULLS LAST, pageid, source_category DESC NULLS LAST, status DESC NULLS LAST, title DESC, url DESC) AS rn FROM pages) WHERE rn = 1",
    "resume": "SELECT DISTINCT pageid, title FROM pages WHERE pageid NOT IN (SELECT pageid FROM pages WHERE status = 'ok')",
    "redirect_statuses": "SELECT status, count(*) AS n FROM (SELECT CASE WHEN coalesce(target_title, '') = '' THEN 'error' WHEN lower(target_title) IN (SELECT lower(title) FROM pages WHERE title IS NOT NULL) THEN 'ok' ELSE 'ignored' END AS status FROM redirects) GROUP BY status",
    "crawl_counts": "SELECT count(*) AS n_pages, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'empty') AS n_empty, count(*) FILTER (status = 'error') AS n_error, count(*) FILTER (in_scope = 1) AS n_in_scope, count(*) FILTER (last_attempt_error IS NOT NULL) AS n_kept_error FROM pages",
    "listing_categories": "SELECT pageid, string_agg(category, ', ' ORDER BY seq, category) AS source_category, min(seq)::INT AS first_seen FROM (SELECT pageid, category, min(seq) AS seq FROM (SELECT pageid, unnest(string_split(source_category, ', ')) AS category, generate_subscripts(string_split(source_category, ', '), 1) - 1 AS seq FROM pages WHERE source_category IS NOT NULL) GROUP BY 1, 2) GROUP BY pageid",
    "pages_per_category": "SELECT pageid, category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pageid) AS n FROM (SELECT DISTINCT pageid, unnest(string_split(source_category, ', ')) AS category FROM pages WHERE source_category IS NOT NULL)) WHERE n <= 25",
    "title_chunks": "SELECT chunk, string_agg(source_title, '|' ORDER BY source_title) AS values FROM (SELECT source_title, (row_number() OVER (ORDER BY source_title) - 1) // 50 AS chunk FROM (SELECT DISTINCT source_title FROM redirects WHERE source_title IS NOT NULL)) GROUP BY chunk",
    "metadata": "SELECT meta_key, max(CASE WHEN meta_value IS NULL THEN NULL ELSE upper(meta_value) END) AS meta_value FROM crawl_meta GROUP BY meta_key",
    "audit_findings": f"WITH {_AUDIT} SELECT kind, title, detail FROM a",
    "audit_counts": f"WITH {_AUDIT} SELECT kind, count(*) AS n FROM a GROUP BY kind",
    "audit_severity": f"WITH {_AUDIT} SELECT CASE WHEN kind IN ('short', 'unresolved-forward') THEN 'warning' ELSE 'fatal' END AS severity, count(*) AS n FROM a GROUP BY 1",
    "cleanup": rf"""WITH {_PLAIN}, q AS (SELECT *, regexp_full_match(plain, '(?i)(?:the\s+)?' || regexp_escape(trim(title)) || '\s+(?:is|are)\s+(?:a|an)\s+(?:item|race|spell|loot box|box|mob)\.?') AS generic FROM p WHERE plain <> ''),
 r AS (SELECT title, url, plain, list_filter([
  CASE WHEN contains(plain, '''''''') OR contains(plain, '‘’’') OR contains(plain, '’’’') OR contains(plain, '‘‘‘') THEN 'malformed-wiki-markup' END,
  CASE WHEN lower(trim(regexp_replace(plain, '[.!?]+$', ''))) = lower(trim(title)) THEN 'title-only-definition' END,
  CASE WHEN regexp_matches(plain, '\bSection of\s+[^:]{{1,160}}:\s*$') THEN 'generated-section-label' END,
  CASE WHEN generic THEN 'generic-type-definition' END,
  CASE WHEN NOT generic AND (regexp_matches(plain, '(?i)\b(?:and|or|but|because|with|of|to)\s*$') OR length(plain) < 120 AND NOT regexp_matches(plain, '[.!?:;"”'']\s*$')) THEN 'truncated-looking-definition' END,
  CASE WHEN length(plain) < 80 AND coalesce(len(details), 0) = 0 THEN 'short-definition-without-sidebar' END,
  CASE WHEN ends_with(plain, ':') AND regexp_matches(plain, '(?i)\b(?:describes?|description|message|voice|from|part of|as part of|of [^:]{{1,80}})\s*:\s*$') THEN 'quote-or-description-leadin-ending' END], lambda x: x IS NOT NULL) AS reasons FROM q)
SELECT title, array_to_string(reasons, '|') AS reasons, CASE WHEN list_has_any(reasons, ['malformed-wiki-markup', 'title-only-definition', 'truncated-looking-definition', 'generated-section-label']) THEN 0 WHEN list_contains(reasons, 'generic-type-definition') THEN 1 WHEN list_contains(reasons, 'short-definition-without-sidebar') THEN 2 ELSE 3 END AS severity,
 CASE WHEN length(plain) <= 220 THEN plain ELSE rtrim(substr(plain, 1, 219)) || '…' END AS detail, url FROM r WHERE len(reasons) > 0""",
    "index_rows": f"""WITH {_E}, w AS (SELECT title AS word, octet_length(encode(max(definition))) AS size FROM e WHERE definition IS NOT NULL GROUP BY title)
SELECT word, (row_number() OVER o - 1) AS ordinal, coalesce(sum(size) OVER (ORDER BY {_AL.format('word')}, word ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset", size::INT AS size FROM w WINDOW o AS (ORDER BY {_AL.format('word')}, word)""",
    "ranks": f"WITH {_E} SELECT pos, title, row_number() OVER (ORDER BY {_AL.format('title')}, title, pos) AS rank FROM e",
    "sections": f"WITH {_E}, r AS (SELECT title, row_number() OVER (ORDER BY {_AL.format('title')}, title, pos) AS rank FROM e), l AS (SELECT rank, title, {_SECTION} AS label FROM r) SELECT rank, title, label FROM (SELECT *, lag(label) OVER (ORDER BY rank) AS last FROM l) WHERE label IS DISTINCT FROM last",
    "shards": rf"""WITH {_E}, f AS (SELECT title AS target, title AS form FROM e UNION ALL SELECT title, unnest(redirect_aliases) FROM e),
 k AS (SELECT target, trim(substr(lower(form), 1, 2)) AS p FROM f WHERE form IS NOT NULL)
SELECT CASE WHEN p = '' THEN '11' WHEN regexp_matches(p, '^\p{{Cyrillic}}') THEN p WHEN regexp_full_match(rpad(p, 2, 'a'), '\p{{L}}{{2}}') THEN rpad(p, 2, 'a') ELSE '11' END AS prefix, target AS word, count(*) AS n_forms FROM k GROUP BY 1, 2""",
    "headwords": r"SELECT doc_id, octet_length(encode(coalesce(text, ''))) BETWEEN 1 AND 255 AND NOT regexp_matches(coalesce(text, ''), '[\x00\n\r]') AS valid FROM documents",
    "tag_inventory": "SELECT tag, count(*) AS n FROM (SELECT lower(unnest(regexp_extract_all(raw_html, '<([A-Za-z][A-Za-z0-9]*)', 1))) AS tag FROM (SELECT DISTINCT pageid, raw_html FROM pages)) GROUP BY tag",
    "hosts": "SELECT lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, count(*) AS n_rows, count(DISTINCT pageid) AS n_pages FROM pages GROUP BY 1",
    "digests": "SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL",
    "page_json": "SELECT DISTINCT pageid, (json_extract_string(raw_json, '$.parse.revid'))::BIGINT AS revid, json_extract_string(raw_json, '$.parse.title') AS title FROM pages WHERE raw_json IS NOT NULL",
}

#: Wide forms of ASCII letters and digits, which compatibility normalisation makes narrow.
_WIDE = "".join(chr(c + 0xFEE0) for r in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)) for c in range(*r))
_NARROW = "".join(chr(ord(c) - 0xFEE0) for c in _WIDE)


def _narrow(t: str) -> str:
    return f"translate({t}, '{_WIDE}', '{_NARROW}')"


_REASON = rf"""CASE WHEN alias = '' THEN 'empty' WHEN length(alias) < 2 THEN 'too-short' WHEN regexp_matches(alias, '\[\d+\]') THEN 'citation-marker' WHEN regexp_matches(alias, '[()]') THEN 'parenthetical-note' WHEN contains(alias, ':') THEN 'not-a-name'
 WHEN regexp_matches(alias, '["“”]') THEN 'quoted-noise' WHEN NOT regexp_matches(alias, '^[\p{{Lu}}\p{{Lt}}\p{{Nd}}]') THEN 'not-title-like' WHEN lower(alias) IN ({_GENERIC}) THEN 'generic-word' WHEN starts_with(source, 'sidebar') AND length(alias) > 80 THEN 'suspiciously-long' WHEN lower(alias) = lower(target) THEN 'self-alias' END"""
_STOP = "'a','about','all','an','and','are','as','at','be','been','being','by','can','did','do','does','for','from','have','how','i','in','into','is','it','it''s','its','just','my','not','of','on','or','out','that','the','then','these','this','those','to','was','what','when','where','who','why','with','you','your'"
_IGNORED = "'achievement','box','company','golem','guild','item','kin','potion','ring','spell','swarm'"
_BOLD = _squeezed(r"regexp_replace(regexp_extract(coalesce(definition, ''), '(?is)<(?:b|strong)>(.*?)(?:</(?:b|strong)>|$)', 1), '</?[A-Za-z][^<>]*>', '', 'g')")
_TOKENS = "regexp_extract_all({}, '[A-Za-z0-9][A-Za-z0-9''’-]*')"
_WHY = _REASON.replace("lower(alias) = lower(target)", "false").replace("starts_with(source, 'sidebar') AND length(alias) > 80", "false")
_PARENS = r"regexp_extract_all(intro, '\(([^)]{1,160})\)', 1)"
_PLURALS = "list_transform(CASE last WHEN 'Dwarf' THEN ['Dwarfs', 'Dwarves'] WHEN 'Elf' THEN ['Elves'] ELSE [CASE WHEN regexp_matches(last, '(?i)[^aeiou]y$') THEN last[:length(last) - 1] || 'ies' WHEN regexp_matches(last, '(?i)(?:s|x|z|ch|sh)$') THEN last || 'es' ELSE last || 's' END] END, lambda x: title[:length(title) - length(last)] || x)"
_SHORT = _squeezed(rf"regexp_replace(alias, '(?i)^(?:the|a|an){_WS}+', '')")
#: Candidates of all generators with their order, then what becomes of them.
_LOOKUPS = rf"""{_E}, d AS (SELECT pos, title, title AS target, details, redirect_aliases, {_CATS} AS cats, {_bare("definition")} AS plain, {_BOLD} AS bold, {_FIRST} AS first,
  trim(split_part(title, ' ', len(string_split(title, ' '))), '"''') AS last FROM e),
 m AS (SELECT *, CASE WHEN regexp_extract(plain, '(?s)^(.*?[.!?]){_WS}+', 1) <> '' THEN regexp_extract(plain, '(?s)^(.*?[.!?]){_WS}+', 1) ELSE substr(plain, 1, 500) END AS intro FROM d),
 g AS (
  SELECT pos, 1 AS g, i AS i, target, trim(title[:-(len(w) + 2)]) AS alias, 'title-suffix-' || lower(w) AS source FROM m, (VALUES (0, 'Spell'), (1, 'Box'), (2, 'Achievement'), (3, 'Potion'), (4, 'Scroll')) t(i, w) WHERE ends_with(title, ' ' || w) AND trim(title[:-(len(w) + 2)]) <> ''
  UNION ALL SELECT pos, 2, i, target, trim(title[len(w) + 5:]), 'title-prefix-' || lower(w) || '-of' FROM m, (VALUES (0, 'Potion'), (1, 'Scroll'), (2, 'Ring'), (3, 'Wand')) t(i, w) WHERE starts_with(title, w || ' of ') AND trim(title[len(w) + 5:]) <> ''
  UNION ALL SELECT pos, 3, 0, target, {_TITLE_BARE}, 'title-parenthetical' FROM m WHERE {_TITLE_BARE} <> title
  UNION ALL SELECT pos, 4, i, target, trim(regexp_extract(x, '(?i)^\s*(?:or|aka)\s+(.+?)\s*$', 1), ' ''"“”'), 'description-parenthetical' FROM (SELECT pos, target, unnest({_PARENS}) AS x, generate_subscripts({_PARENS}, 1) AS i FROM m) WHERE regexp_matches(x, '(?i)^\s*(?:or|aka)\s+(.+?)\s*$')
  UNION ALL SELECT pos, 5, 0, target, bold, 'bold-intro' FROM m WHERE bold <> '' AND lower(bold) <> lower(title)
  UNION ALL SELECT pos, 6, 0, target, regexp_extract(plain, '(?i)^(The|A|An)\s', 1) || ' ' || title, 'description-leading-article' FROM m WHERE lower(bold) = lower(title) AND regexp_matches(plain, '(?i)^(?:The|A|An)\s+' || regexp_escape(title) || '(?:\W|$)') AND regexp_matches(title, '[\p{{L}}\p{{N}}_]$')
  UNION ALL SELECT pos, 7, 2 * i + k, target, CASE k WHEN 0 THEN alias ELSE short END, CASE k WHEN 0 THEN 'sidebar' ELSE 'sidebar-leading-article' END FROM (
    SELECT pos, target, j * 1000 + i AS i, alias, {_SHORT} AS short FROM (
     SELECT pos, target, j, i, {_squeezed("x")} AS alias FROM (SELECT pos, target, j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (
      SELECT pos, target, j, string_split(regexp_replace(translate(y.value, ';|', ',,'), '(?i){_WS}+or{_WS}+', ',', 'g'), ',') AS v FROM (SELECT pos, target, unnest(details) AS y, generate_subscripts(details, 1) AS j FROM m) WHERE y.label = 'Aliases'))) WHERE alias <> ''), (VALUES (0), (1)) t(k) WHERE k = 0 OR short <> alias
  UNION ALL SELECT pos, 8, 0, target, first, 'character-first-name' FROM m WHERE list_contains(cats, 'characters') AND first IS NOT NULL
  UNION ALL SELECT pos, 9, generate_subscripts(v, 1), target, unnest(v), 'character-possessive' FROM (SELECT pos, target, {_poss("title")} || {_poss("first")} AS v FROM m WHERE list_contains(cats, 'characters'))
  UNION ALL SELECT pos, 10, generate_subscripts(v, 1), target, unnest(v), 'category-plural' FROM (SELECT pos, target, {_PLURALS} AS v FROM m
    WHERE NOT regexp_matches(title, '[(),:]') AND regexp_full_match(last, '[A-Z][A-Za-z''-]*') AND last NOT IN ('Blue','Chee','Controls','Daughters','Experience','Limited','Male','Series') AND NOT ends_with(last, 'ii') AND NOT regexp_matches(last, '[sS]$') AND ends_with(title, last)
    AND list_has_any(cats, ['groups', 'items', 'mob_types', 'races']) AND (NOT list_contains(cats, 'items') OR last IN ({_ITEM})) AND (list_contains(cats, 'items') OR NOT regexp_matches(title, '(?i)\bof\b')) AND (NOT list_contains(cats, 'groups') OR last IN ({_GROUP})))
  UNION ALL SELECT pos, 11, generate_subscripts(redirect_aliases, 1), target, coalesce(unnest(redirect_aliases), ''), 'wiki-redirect' FROM m
  UNION ALL SELECT pos, 12, generate_subscripts(string_split(title, ' '), 1), target, unnest(string_split(title, ' ')), 'human-name' FROM m WHERE regexp_full_match(title, '[A-Z][A-Za-z''-]{{2,}} [A-Z][A-Za-z''-]{{2,}}') AND len(list_filter(coalesce(details, []), lambda y: y.label = 'Race' AND contains(lower(y.value), 'human'))) > 0),
 r AS (SELECT pos, g, i, target, {_squeezed(_narrow("alias"))} AS alias, source FROM g),
 cw AS (SELECT w, count(DISTINCT target) AS n FROM (SELECT lower(unnest({_TOKENS.format("title")})) AS w, title AS target FROM m UNION ALL SELECT lower(alias), target FROM (SELECT alias, target, {_WHY} AS why FROM r) WHERE why IS NULL AND NOT contains(alias, ' ')) GROUP BY w),
 b0 AS (SELECT pos, target, coalesce(CASE WHEN {_TITLE_BARE} <> title THEN {_TITLE_BARE} END, title) AS b FROM m),
 b1 AS (SELECT pos, target, CASE WHEN regexp_matches(b, '(?i)^(?:potion|scroll) of ') THEN trim(b[11:]) WHEN regexp_matches(b, '(?i)^(?:ring|wand) of ') THEN trim(b[9:]) ELSE b END AS b FROM b0),
 b2 AS (SELECT pos, target, CASE WHEN regexp_matches(b, '(?i) (?:spell|box|achievement|potion|scroll)$') THEN trim(regexp_replace(b, '(?i) (?:spell|box|achievement|potion|scroll)$', '')) ELSE b END AS b FROM b1),
 b3 AS (SELECT pos, target, list_filter({_TOKENS.format("b")}, lambda t: lower(t) NOT IN ({_STOP}, {_GENERIC}, {_IGNORED}) AND length(t) >= 2 AND NOT regexp_matches(t, '[''’]') AND regexp_matches(t, '^[A-Z0-9]')) AS k FROM b2),
 b4 AS (SELECT pos, target, unnest(k) AS alias, generate_subscripts(k, 1) AS i FROM b3 WHERE len(k) BETWEEN 1 AND 2),
 r2 AS (SELECT 0 AS late, * FROM r UNION ALL SELECT 1, pos, 13, 0, target, alias, 'title-component' FROM (SELECT b4.*, row_number() OVER (PARTITION BY b4.pos ORDER BY coalesce(n, 0), i) AS rn FROM b4 LEFT JOIN cw ON cw.w = lower(b4.alias)) WHERE rn = 1),
 c AS (SELECT *, row_number() OVER (ORDER BY late, pos, g, i) AS spot, lower(alias) AS word, {_REASON} AS reason FROM r2),
 ct AS (SELECT lower(title) AS word, arg_max(title, pos) AS title FROM e GROUP BY 1),
 l AS (SELECT c.*, ct.title FROM c LEFT JOIN ct ON ct.word = c.word WHERE reason IS NULL),
 f1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, word ORDER BY spot) AS rn FROM l WHERE title IS NULL OR title = target) WHERE rn = 1),
 gr AS (SELECT word, count(*) AS n, bool_and(starts_with(source, 'title-') OR source IN ('category-plural', 'character-first-name', 'character-possessive', 'bold-intro', 'description-leading-article', 'description-parenthetical', 'wiki-redirect')) AS shared, arg_min(alias, spot) AS shown FROM f1 GROUP BY word),
 accepted AS (SELECT f1.target, f1.alias, f1.source, f1.spot FROM f1 JOIN gr USING (word) WHERE n = 1),
 omitted AS (SELECT alias, target, source, reason FROM c WHERE reason IS NOT NULL UNION ALL SELECT alias, target, source, 'alias-collision' FROM f1 JOIN gr USING (word) WHERE n > 1 AND NOT shared),
 clash AS (SELECT * FROM l WHERE title IS NOT NULL AND title <> target),
 heads AS (SELECT word, arg_min(alias, spot) AS shown, min(title) AS title FROM clash GROUP BY word),
 rows_ AS (SELECT f1.word, lower(f1.target) AS own, arg_max(f1.target, f1.spot) AS target, min(gr.shown) AS shown, 1 AS rank FROM f1 JOIN gr USING (word) WHERE n > 1 AND shared GROUP BY 1, 2
  UNION ALL SELECT clash.word, lower(clash.target), arg_max(clash.target, spot), min(heads.shown), 1 FROM clash JOIN heads USING (word) WHERE lower(clash.target) <> clash.word GROUP BY 1, 2
  UNION ALL SELECT word, word, title, shown, 0 FROM heads),
 shared AS (SELECT shown AS word, row_number() OVER (PARTITION BY word ORDER BY rank, own) AS ord, target FROM rows_)"""

SQL |= {
    "lookup_accepted": f"WITH {_LOOKUPS} SELECT target, alias, source FROM accepted",
    "lookup_shared": f"WITH {_LOOKUPS} SELECT word, ord, target FROM shared",
    "lookup_omitted": f"WITH {_LOOKUPS} SELECT alias, target, source, reason FROM omitted",
    "lookup_forms": f"WITH {_LOOKUPS} SELECT target, row_number() OVER (PARTITION BY target ORDER BY spot) - 1 AS ord, form FROM (SELECT DISTINCT title AS target, -1 AS spot, title AS form FROM e UNION ALL SELECT target, spot, alias FROM accepted)",
    "lookup_counts": f"WITH {_LOOKUPS} SELECT (SELECT count(*) FROM e) AS n_entries, (SELECT count(*) FROM accepted) AS n_accepted, (SELECT count(*) FROM shared WHERE ord = 1) AS n_shared, (SELECT count(*) FROM omitted) AS n_omitted",
    "format_health": f"WITH {_LOOKUPS}, w AS (SELECT lower(word) AS w, count(*) AS n FROM shared GROUP BY word), j AS (SELECT n, w IN (SELECT lower(title) FROM e) AS t FROM w), k AS (SELECT (SELECT count(*) FROM e) AS n_entries, coalesce((SELECT sum(CASE WHEN t THEN n - 1 ELSE n END) FROM j), 0)::BIGINT AS more, (SELECT count(*) FROM j WHERE NOT t) AS extra) SELECT unnest(['Kindle', 'StarDict', 'Kobo']) AS format, n_entries, unnest([n_entries + more, n_entries + extra, n_entries + extra]) AS n_records FROM k",
    "alias_quality": f"WITH {_LOOKUPS} SELECT kind, alias, targets FROM (SELECT CASE WHEN length(alias) > 60 THEN 'long-accepted-alias' WHEN starts_with(source, 'sidebar') AND NOT contains(alias, ' ') AND length(alias) > 10 AND regexp_matches(alias, '[a-z][A-Z]') THEN 'possibly-joined-sidebar-alias' END AS kind, alias, target AS targets FROM accepted UNION ALL SELECT 'broad-multi-target-lookup', word, string_agg(target, '|' ORDER BY ord) FROM shared GROUP BY word HAVING count(*) > 8) WHERE kind IS NOT NULL",
    "lookup_lines": f"""WITH {_LOOKUPS} SELECT 'alias: alias="' || alias || '" main="' || target || '" source=' || source AS line FROM accepted UNION ALL SELECT 'omitted alias: alias="' || alias || '" main="' || target || '" source=' || source || ' reason=' || reason FROM omitted UNION ALL SELECT 'multi-target lookup: lookup="' || word || '" targets=' || string_agg('"' || target || '"', ' | ' ORDER BY ord) FROM shared GROUP BY word""",
    "title_collisions": "SELECT lower(source_title) AS word, count(*) AS n FROM redirects WHERE source_title IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "scope_synced": """WITH p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pageid ORDER BY fetched_at DESC NULLS LAST) AS rn FROM pages) WHERE rn = 1),
 x AS (SELECT title, unnest(source_categories) AS category, generate_subscripts(source_categories, 1) - 1 AS seq FROM entries), y AS (SELECT p.pageid, category, min(seq) AS seq FROM x JOIN p ON p.title = x.title WHERE category IS NOT NULL GROUP BY 1, 2),
 z AS (SELECT pageid, string_agg(category, ', ' ORDER BY seq, category) AS c FROM y GROUP BY pageid)
SELECT p.pageid, (CASE WHEN z.pageid IS NOT NULL THEN 1 ELSE 0 END)::INT AS in_scope, coalesce(z.c, p.source_category) AS source_category FROM p LEFT JOIN z ON z.pageid = p.pageid""",
}

SQL |= {
    "page_urls": f"WITH {_E} SELECT pos, regexp_extract(url, '^(https?://[^/]+)', 1) || '/wiki/' || replace(replace(replace(replace(url_encode(replace(title, ' ', '_')), '%2F', '/'), '%3A', ':'), '%28', '('), '%29', ')') AS made, url FROM e",
    "badges": f"""WITH {_E} SELECT category, '{{"schemaVersion":1,"label":"' || category || '","message":"' || format('{{:,}}', n) || '","color":"' || CASE WHEN n >= 1000 THEN 'brightgreen' WHEN n >= 500 THEN 'green' WHEN n >= 1 THEN 'yellow' ELSE 'red' END || '"}}' AS badge FROM (SELECT category, count(*) AS n FROM (SELECT DISTINCT unnest(source_categories) AS category, pos FROM e) WHERE category IS NOT NULL GROUP BY 1)""",
    "inflections": f"WITH {_E} SELECT DISTINCT pos, form FROM (SELECT pos, title, unnest([lower(title), title || '''s', title || '’s', lower(title) || '''s', lower(title) || '’s']) AS form FROM e) WHERE form <> title",
    "lookup_words": f"""WITH {_E}, w AS (SELECT pos, title AS word, title AS target, 0 AS rank FROM e UNION ALL SELECT pos, unnest(redirect_aliases), title, 1 FROM e),
 k AS (SELECT * FROM (SELECT *, lower(word) AS key, row_number() OVER (PARTITION BY lower(word), target ORDER BY rank, pos, word) AS rn FROM w WHERE coalesce(word, '') <> '') WHERE rn = 1)
SELECT first_value(word) OVER o AS word, row_number() OVER o AS ord, target FROM k WINDOW o AS (PARTITION BY key ORDER BY rank, pos, word)""",
    "known_good": """WITH a AS (SELECT *, status IN ('ok', 'empty') AS good, row_number() OVER (PARTITION BY pageid ORDER BY fetched_at DESC NULLS LAST, error DESC NULLS LAST, first_paragraph DESC NULLS LAST, in_scope DESC NULLS LAST) AS last FROM pages WHERE pageid IS NOT NULL),
 g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pageid ORDER BY last) AS rn FROM a WHERE good) WHERE rn = 1), p AS (SELECT * FROM a WHERE last = 1)
SELECT p.pageid, p.title, coalesce(g.status, 'error') AS status, CASE WHEN g.pageid IS NULL THEN p.error ELSE g.error END AS error, CASE WHEN NOT p.good AND g.pageid IS NOT NULL THEN coalesce(p.error, 'error') END AS last_attempt_error, p.fetched_at FROM p LEFT JOIN g ON g.pageid = p.pageid""",
}


def key_sql(t: str) -> str:
    """A title's key, as far as SQL can go: wide letters made narrow stand for compatibility normalisation."""
    return f"lower({_squeezed(f'''replace(split_part(nfc_normalize({_narrow(t)}), '#', 1), '_', ' ')''')})"


_POINTER = rf"""regexp_replace(coalesce(nullif(regexp_extract(plain, '(?is)^(?:siehe|voir|véase|see)(?: also| auch| aussi)?\s*:\s*(.+)$', 1), ''), nullif(regexp_extract(plain, '(?is)^duplicate page\s*-\s*please see\s*:?\s+(.+)$', 1), ''), nullif(regexp_extract(plain, '(?is)^(?:system message:\s*)?for .+?,\s*(?:please )?see\s+(.+)$', 1), ''), nullif(regexp_extract(plain, '(?is)^please see\s*:?\s+(.+)$', 1), ''),
 nullif(regexp_extract(plain, '(?is)^(?:→|⇒|->|=>)\s*(.+)$', 1), ''), nullif(regexp_extract(plain, '(?is)^(?:this (?:entry|page|article) (?:has been|was) )?(?:moved|merged|redirected)\s+(?:in)?to\s+(.+)$', 1), '')), '\s*\.\s*$', '')"""
_ORPHANS = rf"""t AS (SELECT 'redirects' AS rec_table, {key_sql("source_title")} AS from_key, {key_sql("target_title")} AS to_key, fetched_at AS moment FROM redirects WHERE target_title IS NOT NULL
  UNION SELECT 'entries', {key_sql("title")}, {key_sql("target")}, built_at FROM (SELECT title, built_at, {_POINTER} AS target FROM (SELECT title, built_at, {_bare("definition")} AS plain FROM entries WHERE definition IS NOT NULL)) WHERE target <> '' AND NOT regexp_matches(target, '[.!?]\s+\S')),
 l AS (SELECT DISTINCT {key_sql("title")} AS k FROM list_pages),
 r AS (SELECT {key_sql("source_title")} AS k, min(fetched_at) AS since FROM redirects WHERE {key_sql("source_title")} <> coalesce({key_sql("target_title")}, chr(1)) GROUP BY 1),
 p AS (SELECT {key_sql("title")} AS k, min(fetched_at) AS since FROM pages GROUP BY 1),
 d AS (SELECT DISTINCT {key_sql("title")} AS k, deleted_at, restored_at FROM deletions WHERE deleted_at IS NOT NULL),
 j AS (SELECT t.*, l.k IS NOT NULL OR coalesce(r.since <= moment, false) OR (coalesce(p.since <= moment, false) AND NOT EXISTS (SELECT 1 FROM d WHERE d.k = t.to_key AND deleted_at <= moment AND (restored_at IS NULL OR restored_at > moment))) AS alive
  FROM t LEFT JOIN l ON l.k = t.to_key LEFT JOIN r ON r.k = t.to_key LEFT JOIN p ON p.k = t.to_key)"""

SQL["p2_found"] = f"WITH {_ORPHANS} SELECT DISTINCT rec_table, from_key, to_key, strftime(moment, '%Y-%m') AS ref_month FROM j WHERE NOT alive"


def _esc(t: str) -> str:
    return f"replace(replace(replace({t}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_HTML = rf"""'<div class="entry"><p class="headword"><b>' || {_esc("title")} || '</b></p>' || CASE WHEN coalesce(spoiler_notice, '') <> '' THEN '<p class="spoiler-note"><b>Spoiler note:</b> ' || {_esc("spoiler_notice")} || '</p>' ELSE '' END || '<ul class="definition"><li>' || coalesce(definition, '') || '</li>'
 || coalesce(array_to_string(list_transform(coalesce(details, []), lambda y: '<li><b>' || {_esc("y.label")} || ':</b> ' || {_esc("y.value")} || '</li>'), ''), '') || '</ul><p class="source">Source: ' || {_esc("title")} || ' on Delver Wiki<br />' || {_esc("coalesce(url, '')")} || '</p></div>'"""
_PIECES = r"regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]')"

SQL |= {
    "definitions": f"WITH {_E} SELECT pos, {_HTML} AS html FROM e",
    "combined": f"WITH {_LOOKUPS}, h AS (SELECT title, {_HTML} AS html FROM e) SELECT word, '<div class=\"multi-lookup\">' || string_agg(html, '' ORDER BY ord) || '</div>' AS definition FROM shared JOIN h ON h.title = shared.target GROUP BY word",
    "index_synonyms": f"WITH {_LOOKUPS}, x AS (SELECT title, row_number() OVER (ORDER BY {_AL.format('title')}, title) - 1 AS ordinal FROM (SELECT DISTINCT title FROM e)) SELECT alias AS word, ordinal FROM accepted JOIN x ON x.title = accepted.target WHERE alias <> accepted.target",
# places of every title in every text, then the leftmost longest after the last taken one, own titles among them
    "title_mentions": rf"""WITH RECURSIVE {_PLAIN}, t AS (SELECT DISTINCT title AS target FROM e WHERE length(title) >= 4 OR regexp_matches(title, '[ \-'']')),
 c AS (SELECT pos, title, plain, target, unnest(range(1, length(plain) - length(target) + 2)) AS spot FROM p JOIN t ON contains(plain, target)),
 hit AS (SELECT pos, spot, max(length(target)) AS n FROM c WHERE substr(plain, spot, length(target)) = target
  AND NOT regexp_matches(substr(plain, spot - 1, CASE WHEN spot > 1 THEN 1 ELSE 0 END), '[\p{{L}}\p{{N}}_]') AND NOT regexp_matches(substr(plain, spot + length(target), 1), '[\p{{L}}\p{{N}}_]') GROUP BY pos, spot),
 step AS (SELECT a.pos, a.spot, a.n, min(b.spot) AS follows FROM hit a LEFT JOIN hit b ON b.pos = a.pos AND b.spot >= a.spot + a.n GROUP BY a.pos, a.spot, a.n),
 taken AS (SELECT pos, min(spot) AS spot FROM hit GROUP BY pos UNION ALL SELECT s.pos, s.follows FROM taken k JOIN step s USING (pos, spot) WHERE s.follows IS NOT NULL)
SELECT pos, substr(plain, k.spot, n) AS target, min(len({_PIECES.format("substr(plain, 1, k.spot - 1)")}))::INT AS at
 FROM taken k JOIN hit USING (pos, spot) JOIN p USING (pos) WHERE substr(plain, k.spot, n) <> title GROUP BY ALL""",
}

SQL["term_status"] = f"""WITH {_LOOKUPS}, terms AS (SELECT unnest(['Carl', 'Golem', '1000 Minor Delvers', 'Babex', 'Ring of Zeme Libram', 'Bagrorn-Drebol']) AS term),
 s AS (SELECT lower(word) AS w, word AS s_word, string_agg(target, '|' ORDER BY ord) AS s_targets FROM shared GROUP BY word),
 fo AS (SELECT *, row_number() OVER (PARTITION BY lower(alias) ORDER BY target DESC, spot DESC) AS rn FROM accepted),
 x AS (SELECT term, s_word, s_targets, ct.title AS c_title, fo.alias AS a_form, fo.target AS a_target FROM terms LEFT JOIN s ON s.w = lower(term) LEFT JOIN ct ON ct.word = lower(term) LEFT JOIN fo ON lower(fo.alias) = lower(term) AND fo.rn = 1)
SELECT term, CASE WHEN s_word IS NOT NULL THEN 'multi-target' WHEN c_title IS NOT NULL THEN 'canonical' WHEN a_form IS NOT NULL THEN 'alias' ELSE 'missing' END AS status, coalesce(s_word, c_title, a_form, term) AS shown, coalesce(s_targets, c_title, a_target, '') AS targets FROM x"""
SQL["alias_lists"] = f"WITH {_LOOKUPS} SELECT target, row_number() OVER (PARTITION BY target ORDER BY spot)::INT AS ord, alias FROM accepted"
SQL["duplicate_records"] = f"WITH {_LOOKUPS} SELECT h.pos AS rank, s.word, s.ord FROM shared s JOIN shared f ON f.word = s.word AND f.ord = 1 JOIN e h ON h.title = f.target JOIN e g ON g.title = s.target WHERE NOT (s.ord = 1 AND lower(s.word) = lower(s.target))"
SQL["lookup_order"] = f"SELECT row_number() OVER (ORDER BY lower(line), line)::INT AS ord, line FROM ({SQL['lookup_lines']})"
SQL["p2_report"] = f"""WITH {_ORPHANS}, x AS (SELECT j.*, CASE WHEN alive THEN NULL WHEN EXISTS (SELECT 1 FROM d WHERE d.k = j.to_key AND deleted_at <= moment AND (restored_at IS NULL OR restored_at > moment)) THEN 'deleted'
  WHEN r.since > moment OR p.since > moment THEN 'late' ELSE 'missing' END AS cause FROM j LEFT JOIN r ON r.k = j.to_key LEFT JOIN p ON p.k = j.to_key)
SELECT rec_table, strftime(moment, '%Y-%m') AS ref_month, count(*) AS n_references, count(cause) AS n_orphans, count(*) FILTER (cause = 'missing') AS n_missing, count(*) FILTER (cause = 'deleted') AS n_deleted, count(*) FILTER (cause = 'late') AS n_late FROM x GROUP BY 1, 2"""
