"""DuckDB SQL for the registered queries, written for that engine's dialect."""

from __future__ import annotations

import re

from loamline.functions.patterns import CJK, ENGLISH_WORDS, TITLE_GUARD, TITLE_KILL, TITLE_KILL_HARD, subject_re2
from loamline.operators import coverage as c
from loamline.operators import lines as rules
from loamline.operators.discovery import TOPIC_RULES

from loamline.operators.prune import TRANSIENT_STATUS
from loamline.operators.registry import FORMATS, LICENSES, SHARDS, TOPICS
from loamline.operators.report import LICENSE_ORDER
from loamline.plans.derived import sql_line_documents, sql_manifest

#: Titles for the predicates, and subject words that are put before texts.
TITLES = ["A smoking article with concrete holder", "Semiconductor wafer", "Semiconductor heat pump controller", "Wafer board for a bridge", "Bridge rectifier", "Concrete bridge", "Construction of a gene library", "Construction of a house", "Makeup with a light foundation", "Pile foundation", "E-Cigarette", "FIELD-EFFECT transistor", "", "Tunnel junction in asphalt"]
SUBJECTS = [
    "heat pump and ventilation", "architect of a school building", "seismic beam design", "wastewater drainage plan", "bridge and tunnel asphalt", "urban zoning", "fire sprinkler in a hotel",
    "soil excavation", "cement and concrete recycling", "daylight lighting", "building automation with bacnet sensor", "construction management handbook", "Sanierung im Quartier", "feasibility study of housing in China",
    "retrofit of an office in Denmark", "commissioning case study, Scotland", "dataset of smart meter time series", "nothing of the kind", "Holz und Beton", "energi och klimatdeklaration", "heating control with MPC", "European standard for roads",
]
LICENSE_IDS = ["cc-by-4.0", "CC-BY-SA-4.0", "cc-by-nc-4.0", "cc-by-nd", "cc0-1.0", "other-open", "public-domain-mark", "", "cc-by", "cc0", "cc-by-sa"]

M = sql_manifest()
D = sql_line_documents()


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(items) -> str:
    return ", ".join(q(i) for i in items)


def _values(items: list[str]) -> str:
    return ", ".join(f"({i}, {q(t)})" for i, t in enumerate(items))


def re2(pattern: str) -> str:
    """A pattern for matching at all; RE2's word boundary knows ASCII only, so neighbours stand in."""
    begun = re.sub(r"(^|[|(])\\b", lambda m: m[1] + r"(?:^|[^\p{L}\p{N}_])", pattern)
    return q("(?i)" + begun.replace(r"\b", r"(?:$|[^\p{L}\p{N}_])"))


# --- quality -------------------------------------------------------------------------------------


def _window(name: str, size: int) -> str:
    t = f"left(b, {size})"
    words = f"regexp_split_to_array(lower({t}), '[^\\p{{L}}\\p{{N}}_]+')"
    return f"""CAST(length(trim({t}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160))) AS BIGINT) AS {name}_chars,
  CASE WHEN length({t}) > 0 THEN round_even(length(regexp_replace({t}, '[^\\p{{L}}]+', '', 'g')) / length({t}), 6) ELSE 0.0 END AS {name}_alpha,
  CAST(len(regexp_extract_all({t}, '[A-Za-z]{{2,}}')) AS BIGINT) AS {name}_words,
  CAST(length(regexp_replace({t}, '[^{CJK}]+', '', 'g')) AS BIGINT) AS {name}_cjk,
  CAST(len(list_filter({words}, lambda w: w IN ({listed(ENGLISH_WORDS)}))) AS BIGINT) AS {name}_en,
  CAST(len(regexp_extract_all({t}, {q(subject_re2())})) AS BIGINT) AS {name}_domain"""


_SEP = "chr(10) || '---' || chr(10) || chr(10)"
_BODY = f"CASE WHEN contains(text, {_SEP}) THEN substr(text, strpos(text, {_SEP}) + 6) ELSE text END"
_METRICS = f"SELECT doc_id, lang, CAST(length(b) AS BIGINT) AS total, {_window('w20', 20000)}, {_window('w100', 100000)} FROM (SELECT doc_id, lang, {_BODY} AS b FROM documents)"
_VERDICT = f"""SELECT doc_id, lang, CASE
    WHEN chars < 2000 THEN 'thin'
    WHEN alpha < CASE WHEN cjk >= 300 THEN 0.45 ELSE 0.55 END THEN 'garbage'
    WHEN words + cjk // 2 < 200 THEN 'thin'
    WHEN CASE WHEN book THEN 1000.0 * domain / (words + cjk // 2) < 8.0 ELSE domain < 10 END THEN 'off-topic'
    ELSE 'ok' END AS verdict
FROM (SELECT doc_id, lang, total > 120000 AS book, {', '.join(f'CASE WHEN total > 120000 THEN w100_{m} ELSE w20_{m} END AS {m}' for m in ('chars', 'alpha', 'words', 'cjk', 'domain'))} FROM ({_METRICS}))"""

SQL: dict[str, str] = {
    "quality_metrics": f"SELECT * EXCLUDE (lang) FROM ({_METRICS})",
    "quality_verdict": f"SELECT doc_id, verdict FROM ({_VERDICT})",
    "quality_verdict_counts": f"SELECT verdict, lang, count(*) AS n FROM ({_VERDICT}) GROUP BY verdict, lang",
    "off_domain_titles": f"SELECT CAST(n AS INTEGER) AS n, regexp_matches(t, {re2(TITLE_KILL_HARD)}) OR (regexp_matches(t, {re2(TITLE_KILL)}) AND NOT regexp_matches(t, {re2(TITLE_GUARD)})) AS off FROM (VALUES {_values(TITLES)}) AS v(n, t)",
    "word_glue": f"SELECT doc_id, length(h) > 0 AND length(regexp_replace(h, '[^{CJK}]+', '', 'g')) / length(h) <= 0.10 AND (length(h) - length(replace(h, ' ', ''))) / length(h) < 0.05 AS glued FROM (SELECT doc_id, left(replace(text, ' ', CASE WHEN doc_id % 3 = 0 THEN '' ELSE ' ' END), 20000) AS h FROM documents)",
}

# --- cleaning ------------------------------------------------------------------------------------

_LETTER = r"[\p{L}\p{Nl}\p{No}]"
_MARKS = r"[\p{L}\p{N}_\s]+"
_LINES = f"""SELECT id, CAST(i AS INTEGER) AS i, line, trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)) AS s
FROM (SELECT id, unnest(l) AS line, unnest(range(len(l))) AS i FROM (SELECT id, string_split({_BODY}, chr(10)) AS l FROM {D} AS docs))"""
_SHAPES = f"""SELECT *,
  count(*) OVER (PARTITION BY id, s) >= 4 AND length(s) > 12 AS is_repeated_boilerplate,
  regexp_matches(s, {re2(rules.TOC_LEADER)}) AS is_toc_leaders,
  s <> '' AND regexp_matches(s, {re2(rules.PAGE_MARKER)}) AND regexp_matches(s, '[\\p{{L}}\\p{{N}}]') AS is_page_markers,
  length(s) BETWEEN 1 AND 2 AS is_orphan_chars,
  regexp_matches(s, {q(rules.PATENT_ID)}) AND NOT regexp_matches(s, {q(rules.MONEY)}) AND NOT regexp_matches(s, {q(rules.CATALOG)}) AS ident,
  s IN ({listed(rules.PATENT_LABELS)}) OR regexp_matches(s, {q(rules.SUBSTANCE)}) OR regexp_matches(s, {q(rules.ISO_DATE)}) AS is_patent_furniture,
  s IN ({listed(rules.SITE_LABELS)}) AS is_site_chrome,
  length(s) >= 2 AND NOT regexp_matches(s, '{_LETTER}')
    AND (replace(s, ' ', '') = '' OR length(regexp_replace(replace(s, ' ', ''), '[^\\p{{Nd}}]+', '', 'g')) / length(replace(s, ' ', '')) < 0.10)
    AND length(regexp_replace(s, '{_MARKS}', '', 'g')) >= 2 AS is_ocr_debris,
  s <> '' AND (regexp_matches(line, {q(rules.ANNOTATION)}) OR regexp_matches(s, {re2(rules.TAG_ONLY)})) AS annot,
  length(s) > 6 AND regexp_matches(s, {q(rules.COORDINATES)}) AND length(s) - length(replace(s, ',', '')) >= 2 AS coord
FROM ({_LINES})"""
_FLAGS = f"""SELECT *, ident AND (coalesce(last_value(CASE WHEN s <> '' THEN ident END IGNORE NULLS) OVER b, false) OR coalesce(first_value(CASE WHEN s <> '' THEN ident END IGNORE NULLS) OVER a, false)) AS is_patent_id_soup,
  annot OR (coord AND coalesce(last_value(CASE WHEN annot OR NOT coord THEN annot END IGNORE NULLS) OVER b, false)) AS is_code_annotations
FROM ({_SHAPES}) WINDOW b AS (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""
_CLAIMS = f"SELECT *, CASE {' '.join(f'WHEN is_{r} THEN {q(r)}' for r in rules.RULES)} END AS rule FROM ({_FLAGS})"
_CLEAN = f"""WITH claims AS ({_CLAIMS}),
docs AS (SELECT id, CASE WHEN contains(text, {_SEP}) THEN left(text, strpos(text, {_SEP}) + 5) ELSE '' END AS head, n FROM {D} AS d JOIN (SELECT id, count(rule) AS n FROM claims GROUP BY id) USING (id)),
kept AS (SELECT id, i, line, s, n, lag(s) OVER (PARTITION BY id ORDER BY i) AS before FROM claims JOIN docs USING (id) WHERE rule IS NULL),
joined AS (SELECT id, string_agg(line, chr(10) ORDER BY i) AS t FROM kept WHERE NOT (n > 0 AND s = '' AND before IS NOT NULL AND before = '') GROUP BY id)
SELECT id, head || coalesce(t, '') AS text, CAST(length(coalesce(t, '')) AS BIGINT) AS corpus_chars, sha256(head || coalesce(t, '')) AS corpus_sha256 FROM docs LEFT JOIN joined USING (id)"""
_ATTRIBUTION = f"SELECT id, rule, CAST(sum(length(line) + 1) AS BIGINT) AS dropped_chars FROM ({_CLAIMS}) WHERE rule IS NOT NULL GROUP BY id, rule"

SQL |= {
    "clean_flags": f"SELECT id, i, rule FROM ({_CLAIMS}) WHERE rule IS NOT NULL",
    "clean_attribution": _ATTRIBUTION,
    "clean_text_hash": f"SELECT id, corpus_chars, corpus_sha256 FROM ({_CLEAN})",
    "clean_report_pct": f"""SELECT r.rule, CAST(r.place AS INTEGER) AS place, CAST(coalesce(d, 0) AS BIGINT) AS dropped_chars, round_even(100 * coalesce(d, 0) / total, 4) AS pct
FROM (VALUES {', '.join(f'({q(r)}, {k})' for k, r in enumerate(rules.RULES))}) AS r(rule, place)
LEFT JOIN (SELECT rule, sum(dropped_chars) AS d FROM ({_ATTRIBUTION}) GROUP BY rule) USING (rule), (SELECT CAST(sum(length(line) + CASE WHEN i > 0 THEN 1 ELSE 0 END) AS DOUBLE) AS total FROM ({_LINES}))""",
    **{f"clean_{r}": f"SELECT id, i FROM ({_FLAGS}) WHERE is_{r}" for r in rules.RULES},
    "clean_check": f"""WITH done AS (SELECT CAST(id AS VARCHAR) AS id, id AS n, text, corpus_chars, corpus_sha256 FROM ({_CLEAN})),
e AS (SELECT id, n, corpus_chars + CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END AS chars, CASE WHEN n % 11 = 0 THEN sha256(id) ELSE corpus_sha256 END AS sha FROM done)
SELECT 'missing' AS problem, id FROM e WHERE n % 13 = 0
UNION ALL SELECT 'unprovenanced', 'x' || CAST(id AS VARCHAR) FROM {D} AS f WHERE id < 0
UNION ALL SELECT 'corpus_chars drift', id FROM e WHERE n % 13 <> 0 AND n % 7 = 0
UNION ALL SELECT 'corpus_sha256 drift', id FROM e WHERE n % 13 <> 0 AND n % 11 = 0""",
    "clean_orphans": f"SELECT 'x' || CAST(id AS VARCHAR) AS id FROM {D} AS f WHERE id < 0",
    "clean_stale": f"SELECT id FROM {M} AS m WHERE NOT (pos % 5 <> 0 AND pos % 3 <> 0 AND pos % 4 <> 0)",
}

# --- registry ------------------------------------------------------------------------------------

_DISCOVERED = "(" + " OR ".join(f"starts_with(id, {q(p)})" for p in SHARDS) + ")"
_NORM = r"trim(regexp_replace(lower(title), '[^\p{L}\p{N}_]+', ' ', 'g'))"
_SLUG = "trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-')"
_URL = "rtrim(url, '/')"
_ROUTE = f"""CASE {' '.join(f"WHEN starts_with(id, {q(p)}) THEN " + ("CASE WHEN regexp_matches(id, '^pat-[a-z]{2}') THEN 'patents-' || substr(id, 5, 2) ELSE 'patents' END" if s == 'patents' else q(s)) for p, s in SHARDS.items())} ELSE 'curated' END"""
_KEYS = lambda rows: f"SELECT 'url' AS kind, {_URL} AS value FROM {rows} UNION SELECT 'title', {_NORM} FROM {rows} UNION SELECT 'id', id FROM {rows}"  # noqa: E731

SQL |= {
    "slug_norm": f"SELECT id, {_SLUG} AS slug, {_NORM} AS norm, {_URL} AS url_key, rtrim(trim(' ' || url), '/') AS block_key FROM {M} AS m",
    "shard_route": f"SELECT id, {_ROUTE} AS route, {_DISCOVERED} AS discovered FROM {M} AS m",
    "known_keys": f"WITH m AS (SELECT * FROM {M} AS x), a AS (SELECT * FROM m WHERE pos % 2 = 0 OR pos % 3 = 0) SELECT DISTINCT * FROM ({_KEYS('a')} UNION SELECT 'url', {_URL} FROM m WHERE pos % 5 = 0) WHERE value <> ''",
    "new_candidates_anti": f"WITH m AS (SELECT *, {_NORM} AS t, {_URL} AS u FROM {M} AS x), a AS (SELECT * FROM m WHERE pos % 2 = 0 OR pos % 3 = 0) SELECT id, url FROM m WHERE u NOT IN (SELECT u FROM a) AND (t = '' OR t NOT IN (SELECT t FROM a))",
    "index_documents": f"SELECT source AS id, url, topic FROM {M} AS m QUALIFY row_number() OVER (PARTITION BY source ORDER BY pos DESC) = 1",
    "registry_removed": f"SELECT id, title FROM {M} AS m WHERE pos % 9 <> 4",
    "backend_validation": "SELECT * FROM (VALUES ('b', 'missing rotation entry'), ('c', 'rotation entry exists but is switched off'), ('d', 'missing script'), ('e', 'rotation entry has no backend')) AS v(name, problem)",
}

#: CRC-32 of an ASCII id, bit by bit: DuckDB has no such function.
_STEPS = "flatten(list_transform(range(1, length(id) + 1), lambda i: [CAST(ascii(substr(id, CAST(i AS INT), 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
_CRC = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_STEPS}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
_SHARD = f"CASE WHEN starts_with(id, 'pat-cn') THEN 'patents-cn-' || CAST({_CRC} % 16 AS VARCHAR) WHEN starts_with(id, 'pat-us') THEN 'patents-us-' || CAST({_CRC} % 8 AS VARCHAR) ELSE {_ROUTE} END"

_ENTRIES = f"""SELECT CASE WHEN pos % 41 = 9 THEN 'hand-' || CAST(pos % 3 AS VARCHAR) ELSE id END AS id, CASE WHEN pos % 41 = 1 THEN '' ELSE title END AS title,
  CASE WHEN pos % 41 = 2 THEN 'ftp://x.example.org/1' ELSE url END AS url, source, CASE WHEN pos % 41 = 3 THEN 'unknown' ELSE license END AS license,
  CASE WHEN pos % 41 = 4 THEN 'gardens' ELSE topic END AS topic, CASE WHEN pos % 41 = 5 THEN NULL ELSE format END AS format,
  CASE WHEN pos % 41 = 6 THEN 'www.example.org' END AS license_url, pos FROM {M} AS m WHERE pos % 10 <> 9"""
_REQUIRED = ["id", "title", "url", "source", "license", "topic", "format"]
SQL |= {
    "lint_registry": f"""WITH e AS ({_ENTRIES})
{' UNION ALL '.join(f"SELECT 'missing field' AS check, id, '{f}' AS detail FROM e WHERE coalesce({f}, '') = ''" for f in _REQUIRED)}
UNION ALL SELECT 'unknown license', id, coalesce(license, 'None') FROM e WHERE coalesce(license, '') NOT IN ({listed(LICENSES)})
UNION ALL SELECT 'unknown topic', id, coalesce(topic, 'None') FROM e WHERE coalesce(topic, '') NOT IN ({listed(TOPICS)})
UNION ALL SELECT 'unknown format', id, coalesce(format, 'None') FROM e WHERE coalesce(format, '') NOT IN ({listed(FORMATS)})
UNION ALL SELECT 'url is not http(s)', id, url FROM e WHERE NOT regexp_matches(url, '^https?://')
UNION ALL SELECT 'license_url is not http(s)', id, license_url FROM e WHERE license_url <> '' AND NOT regexp_matches(license_url, '^https?://')
UNION ALL SELECT 'wrong shard', id, 'books for ' || shard FROM (SELECT id, pos, {_SHARD} AS shard FROM e) WHERE pos % 41 = 7 AND shard <> 'books'
UNION ALL SELECT 'duplicate id', id, CAST(count(*) AS VARCHAR) FROM e GROUP BY id HAVING count(*) > 1""",
    "lint_manifest": f"""WITH e AS (SELECT * FROM ({_ENTRIES}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1),
m AS (SELECT id, url, source, CASE WHEN pos % 29 = 0 THEN 'proprietary-internal' ELSE license END AS license, topic, format, CASE WHEN pos % 31 = 0 THEN 'zz' ELSE sha256 END AS sha256 FROM {M} AS x),
j AS (SELECT m.*, e.id AS known, {', '.join(f'e.{f} AS e_{f}' for f in _REQUIRED[2:])} FROM m LEFT JOIN e ON m.id = e.id)
SELECT 'pointer-only payload' AS check, id, license AS detail FROM j WHERE license = 'proprietary-internal'
UNION ALL SELECT 'orphan', id, '' FROM j WHERE known IS NULL
{' '.join(f"UNION ALL SELECT 'drift', id, '{f}' FROM j WHERE known IS NOT NULL AND {f} IS DISTINCT FROM e_{f}" for f in _REQUIRED[2:])}
UNION ALL SELECT 'invalid hash', id, 'sha256' FROM j WHERE known IS NOT NULL AND NOT regexp_matches(sha256, '^[0-9a-f]{{64}}$')""",
}

# --- pruning -------------------------------------------------------------------------------------

_OFF = f"(regexp_matches(title, {re2(TITLE_KILL_HARD)}) OR (regexp_matches(title, {re2(TITLE_KILL)}) AND NOT regexp_matches(title, {re2(TITLE_GUARD)})))"
def _pruned(rows: str, verdict: str = "'ok'") -> str:
    """rows with reason, by the same precedence."""
    return f"""SELECT *, CASE WHEN own IS NOT NULL THEN own WHEN dup_title THEN 'dup-title' WHEN eligible AND found AND place > 1 THEN 'dup-bytes' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY sha256, eligible ORDER BY found, id) AS place
FROM (SELECT *, status = 'ok' AND own IS NULL AND NOT dup_title AS eligible
FROM (SELECT *, claims AND (rank > 1 OR seeded) AS dup_title
FROM (SELECT *, row_number() OVER (PARTITION BY title_key, claims ORDER BY shard || '.jsonl', topic, id) AS rank, bool_or(NOT found AND status = 'ok') OVER (PARTITION BY title_key) AS seeded
FROM (SELECT *, found AND own IS NULL AND title_key <> '' AS claims
FROM (SELECT *, {_SHARD} AS shard, {_NORM} AS title_key, CASE WHEN NOT found THEN NULL WHEN status <> 'ok' THEN 'failed' WHEN starts_with(id, 'pat-') AND {_OFF} THEN 'off-topic-title' WHEN {verdict} <> 'ok' THEN {verdict} END AS own
FROM (SELECT *, {_DISCOVERED} AS found FROM {rows} AS x)))))))"""


_PASSING = _pruned(M)
_DROPPED = f"SELECT *, rtrim(trim(url), '/') AS key, reason <> 'failed' OR http_status NOT IN ({', '.join(map(str, TRANSIENT_STATUS))}) AS blockable FROM ({_PASSING}) WHERE reason IS NOT NULL"
SQL |= {
    "shard_bucket": f"SELECT id, {_SHARD} AS shard FROM {M} AS m",
    "prune_reasons": f"SELECT id, reason FROM ({_pruned(f'(SELECT m.*, v.verdict FROM {M} AS m JOIN ({_VERDICT}) AS v ON v.doc_id = m.pos)', 'verdict')}) WHERE reason IS NOT NULL",
    "dup_title": f"SELECT id, title FROM ({_PASSING}) WHERE reason = 'dup-title'",
    "dup_bytes": f"SELECT id, sha256 FROM ({_pruned(f'(SELECT * REPLACE (id AS title) FROM {M} AS y)')}) WHERE reason = 'dup-bytes'",
    "prune_counts": f"SELECT reason, count(*) AS n FROM ({_PASSING}) WHERE reason IS NOT NULL GROUP BY reason",
    "prune_ledger": f"SELECT id, url, reason, source, topic, license, http_status, sha256, key IN (SELECT key FROM ({_DROPPED}) WHERE blockable) AS blocklisted, '2026-01-01T00:00:00Z' AS pruned_at, 'run-1' AS run_id FROM ({_DROPPED})",
    "blocklist_add": f"SELECT DISTINCT key AS url FROM ({_DROPPED}) WHERE blockable AND key NOT IN (SELECT rtrim(trim('  ' || url || '/ '), '/') FROM {M} AS x WHERE pos % 3 = 0)",
    "prune_kept": f"SELECT id FROM ({_PASSING}) WHERE reason IS NULL",
}

# --- coverage ------------------------------------------------------------------------------------

_SOURCE_LIST = ["osti", "gh_a", "wikipedia_de", "oapen", "gov_uk", "gov_x", "kitopen", "arxiv", "zenodo", "sdz_at", "nowhere", "eia", "brick", "unmethours", "patents"]
_SOURCED = f"SELECT * REPLACE (([{listed(_SOURCE_LIST)}])[1 + CAST(pos * pos % {len(_SOURCE_LIST)} AS INT)] AS source) FROM {M} AS x WHERE status = 'ok'"
_SEEDED = f"SELECT *, title || chr(10) || left(([{listed(SUBJECTS)}])[1 + CAST(pos % {len(SUBJECTS)} AS INT)] || chr(10) || body, 4000) AS t, text_chars // 4 AS tok FROM ({_SOURCED})"


def _facet(table: dict[str, str]) -> str:
    found = f"list_filter([{', '.join(f'CASE WHEN regexp_matches(t, {re2(p)}) THEN {q(k)} END' for k, p in table.items())}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE ['(none)'] END"


_SOURCE_MAP = "CASE source " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in c.SOURCE_REGION.items()) + " END"
_PATENT_MAP = "CASE WHEN regexp_matches(id, '^pat-[a-z]{2}') THEN CASE substr(id, 5, 2) " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in c.PATENT_REGION.items()) + " ELSE 'Global' END END"
_REGION_FOUND = f"list_distinct(list_filter([{_SOURCE_MAP}, {_PATENT_MAP}, {', '.join(f'CASE WHEN regexp_matches(left(t, 600), {re2(p)}) THEN {q(k)} END' for k, p in c.TEXT_REGION.items())}], lambda x: x IS NOT NULL))"
_REGION = f"CASE WHEN len({_REGION_FOUND}) > 0 THEN {_REGION_FOUND} ELSE ['(unmapped)'] END"
_FACETS = f"SELECT id, tok, {', '.join(f'{_facet(t)} AS {n}' for n, t in c.FACETS.items())}, {_REGION} AS region, [license] AS license FROM ({_SEEDED})"
_DIMENSIONS = [*c.FACETS, "region", "license", "language"]


def _cross(other: str, keys: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER (k = {q(x)}) AS \"{x}\"" for x in keys)
    return f"SELECT domain, {counts} FROM (SELECT d AS domain, unnest(o) AS k FROM (SELECT unnest(domain) AS d, {other} AS o FROM ({_FACETS}))) WHERE domain <> '(none)' GROUP BY domain"


def _votes(language: str) -> str:
    return f"len(list_filter(w, lambda x: x IN ({listed(c.LANGUAGE_WORDS[language])})))"


def _language(keep: str, rows: str) -> str:
    return f"""SELECT {keep}, CASE WHEN regexp_matches(text, '[가-힯]') THEN 'ko' WHEN regexp_matches(text, '[぀-ヿ]') THEN 'ja'
  WHEN length(regexp_replace(left(text, 2000), '[^一-鿿]+', '', 'g')) > 20 THEN 'zh' WHEN length(regexp_replace(left(text, 2000), '[^а-яА-Я]+', '', 'g')) > 20 THEN 'ru'
  WHEN best > en * 1.2 AND first <> 'en' THEN first ELSE 'en' END AS detected
FROM (SELECT *, CASE {' '.join(f'WHEN {k} = best THEN {q(k)}' for k in c.LANGUAGE_WORDS)} END AS first
FROM (SELECT *, greatest({', '.join(c.LANGUAGE_WORDS)}) AS best FROM (SELECT {keep}, text, {', '.join(f'{_votes(k)} AS {k}' for k in c.LANGUAGE_WORDS)}
FROM (SELECT *, regexp_split_to_array(lower(left(text, 3000)), '[^\\p{{L}}\\p{{N}}_]+') AS w FROM {rows}))))"""


_LANGUAGE = _language("doc_id, lang", "documents")
_GENRE = "CASE source " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in c.SOURCE_GENRE.items()) + " ELSE CASE " + " ".join(f"WHEN {' OR '.join(f'starts_with(source, {q(p)})' for p in prefixes)} THEN {q(g)}" for prefixes, g in c.PREFIX_GENRE) + " END END"

SQL |= {
    "stats_totals": f"""SELECT count(*) AS docs, CAST(sum(text_chars) AS BIGINT) AS text_chars, CAST(sum(text_chars) // 4 AS BIGINT) AS tokens, CAST(sum(cc) AS BIGINT) AS corpus_chars, CAST(sum(cc) // 4 AS BIGINT) AS corpus_tokens, count(DISTINCT topic) AS topics
FROM (SELECT *, CASE WHEN pos % 5 = 0 THEN 0 ELSE text_chars - pos % 7 END AS cc FROM {M} AS x WHERE status = 'ok')""",
    "by_topic": f"SELECT topic, docs, CAST(row_number() OVER (ORDER BY docs DESC, topic) AS INTEGER) AS place FROM (SELECT topic, count(*) AS docs FROM {M} AS x WHERE status = 'ok' GROUP BY topic)",
    "by_license": f"SELECT license, docs, CAST(list_position([{listed(LICENSE_ORDER)}], license) AS INTEGER) AS place FROM (SELECT license, count(*) AS docs FROM {M} AS x WHERE status = 'ok' GROUP BY license) WHERE list_position([{listed(LICENSE_ORDER)}], license) > 0",
    "load_report": f"""WITH m AS (SELECT * FROM {M} AS x) SELECT 'rows' AS metric, count(*) AS value FROM m UNION ALL SELECT 'ok', count(*) FROM m WHERE status = 'ok' UNION ALL SELECT 'failed', count(*) FROM m WHERE status <> 'ok'
UNION ALL SELECT 'topic:' || topic, count(*) FROM m WHERE status = 'ok' GROUP BY topic""",
    "duplicate_groups": f"SELECT sha256, n, id FROM (SELECT sha256, id, count(*) OVER (PARTITION BY sha256) AS n FROM {M} AS x) WHERE n > 1",
    "big_numbers": "SELECT c_custkey, CASE WHEN n >= 1e9 THEN printf('%.3fB', n / 1e9) ELSE printf('%.0fM', round_even(n / 1e6, 0)) END AS shown FROM (SELECT c_custkey, CAST(c_custkey * 1234567 AS DOUBLE) AS n FROM customer)",
    "genre_coverage": f"""WITH g AS (SELECT {_GENRE} AS genre, count(*) AS docs FROM ({_SOURCED}) GROUP BY 1),
e AS (SELECT genre, listed, coalesce(docs, 0) AS docs FROM (VALUES {', '.join(f'({q(g)}, {i})' for i, g in enumerate(c.GENRES))}) AS v(genre, listed) LEFT JOIN g USING (genre))
SELECT genre, docs, CASE WHEN docs = 0 THEN 'none' WHEN docs < 16 THEN 'thin' WHEN docs < 61 THEN 'some' ELSE 'heavy' END AS status, CAST(row_number() OVER (ORDER BY docs >= 16, docs >= 61, docs, listed) AS INTEGER) AS place FROM e""",
    "uncategorized_sources": f"SELECT source, count(*) AS docs FROM ({_SOURCED}) WHERE {_GENRE} IS NULL GROUP BY source",
    "facet_marginals": f"""WITH l AS (SELECT id, detected FROM ({_language("id", f"(SELECT id, t AS text FROM ({_SEEDED}))")})), f AS (SELECT f.*, [detected] AS language FROM ({_FACETS}) AS f JOIN l USING (id)), n AS (SELECT count(*) AS n FROM f), cells AS ({' UNION ALL '.join(f"SELECT {q(d)} AS dimension, unnest({d}) AS key, tok FROM f" for d in _DIMENSIONS)})
SELECT dimension, key, count(*) AS docs, CAST(sum(tok) AS BIGINT) AS tok, count(*) < 0.01 * any_value(n) AND key <> '(none)' AS gap FROM cells, n GROUP BY dimension, key""",
    "cross_domain_lifecycle": _cross("lifecycle", list(c.LIFECYCLE)),
    "cross_domain_region": _cross("region", c.REGION_COLUMNS),
    "cross_cells_lifecycle": f"""WITH f AS ({_FACETS}), n AS (SELECT count(*) AS n FROM f), d AS (SELECT unnest(domain) AS domain, lifecycle FROM f)
SELECT domain, key, count(*) FILTER (list_contains(lifecycle, key)) AS docs, count(*) FILTER (list_contains(lifecycle, key)) BETWEEN 1 AND ceil(0.003 * any_value(n)) - 1 AS gap
FROM d, n, (SELECT unnest([{listed(c.LIFECYCLE)}]) AS key) WHERE domain <> '(none)' GROUP BY domain, key""",
    "detect_lang": f"SELECT doc_id, detected FROM ({_LANGUAGE})",
    "lang_confusion": f"SELECT lang, detected, count(*) AS n FROM ({_LANGUAGE}) GROUP BY lang, detected",
}

# --- fetching ------------------------------------------------------------------------------------

_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_RENDER = "'# ' || title || chr(10) || chr(10) || 'source: ' || url || chr(10) || 'license: ' || license || chr(10) || 'topic: ' || topic || chr(10) || chr(10) || '---' || chr(10) || chr(10)"
_PAYLOAD = "CASE WHEN pos % 4 = 0 THEN '%PDF-1.7' WHEN pos % 4 = 1 THEN 'unusual traffic' ELSE '' END || body"
SQL |= {
    "fair_order": f"SELECT id, {_HOST} AS host, CAST(row_number() OVER (PARTITION BY {_HOST} ORDER BY pos) AS INTEGER) AS turn, min(pos) OVER (PARTITION BY {_HOST}) AS host_place FROM {M} AS m",
    "host_slots": f"SELECT id, h || '#' || CAST((row_number() OVER (PARTITION BY h ORDER BY pos) - 1) % CASE WHEN h = 'www.osti.gov' THEN 4 ELSE 2 END AS VARCHAR) AS slot FROM (SELECT id, pos, CASE WHEN pos % 2 = 0 THEN 'www.osti.gov' ELSE {_HOST} END AS h FROM {M} AS m)",
    "fetch_plan": f"SELECT id FROM {M} AS m WHERE pos % 6 <> 5 AND topic IN ('building_energy', 'urban') AND NOT (status = 'ok' AND pos % 3 = 0)",
    "fetch_accept": f"""SELECT id, strlen(p) > 512 AND CASE WHEN format = 'pdf' THEN starts_with(p, '%PDF-') ELSE NOT contains(p, 'unusual traffic') END AS accepted, format = 'pdf' AND NOT starts_with(p, '%PDF-') AS rejected FROM (SELECT *, {_PAYLOAD} AS p FROM {M} AS m)""",
    "verify_counts": f"SELECT count(*) FILTER (pos % 7 <> 0 AND pos % 5 <> 0) AS \"match\", count(*) FILTER (pos % 7 <> 0 AND pos % 5 = 0) AS mismatch, count(*) FILTER (pos % 7 = 0) AS missing, count(*) AS ok_docs FROM {M} AS m WHERE status = 'ok'",
    "repro_tags": f"SELECT CASE WHEN pos % 4 = 0 THEN 'new' WHEN pos % 3 = 0 THEN 'DRIFTED' ELSE 'reproduced' END AS tag, count(*) AS n FROM {M} AS m WHERE status = 'ok' GROUP BY 1",
    "extract_reuse": f"""WITH m AS (SELECT * FROM {M} AS x), t AS (SELECT DISTINCT sha256, body FROM m WHERE pos % 2 = 0 AND status = 'ok' AND body <> '')
SELECT id, sha256({_RENDER} || t.body) AS text_sha256, CAST(length(t.body) AS BIGINT) AS text_chars FROM m JOIN t ON m.sha256 = t.sha256 WHERE pos % 2 = 1""",
    "header_body": f"SELECT id, CAST(CASE WHEN pos % 2 = 0 THEN length({_RENDER}) ELSE 0 END AS BIGINT) AS header_chars, sha256(body) AS body_sha256, CAST((length(body) + CASE WHEN pos % 2 = 0 THEN length({_RENDER}) ELSE 0 END) // 4 AS BIGINT) AS tokens FROM {M} AS m",
    "new_records": f"SELECT id, 'failed' AS status, CAST(0 AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS corpus_chars, format AS ext FROM {M} AS m",
    "repos_pending": f"SELECT id AS repo, pos % 2 = 0 AS code FROM {M} AS m WHERE pos % 3 = 0 OR (pos % 2 = 0 AND pos % 5 <> 0)",
    "html_main_links": "SELECT page_id, CAST(unnest(range(len(h))) AS INTEGER) AS n, replace(unnest(h), '&amp;', '&') AS href FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"]*)\"', 1) AS h FROM pages)",
    "url_hosts": f"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1",
}

# --- discovery, merging, rounds ------------------------------------------------------------------


def _topic(source: str) -> str:
    rules_of = TOPIC_RULES[source]
    default = next((name for p, name in rules_of if not p), None)
    return f"CASE {' '.join(f'WHEN regexp_matches(t, {re2(p)}) THEN {q(n)}' for p, n in rules_of if p)} ELSE {q(default) if default else 'NULL'} END AS {source}"


_WEEK = "CAST(year(o_orderdate) AS VARCHAR) || '-W' || lpad(CAST(dayofyear(o_orderdate) % 53 + 1 AS VARCHAR), 2, '0')"
_PREVIOUS = lambda w: f"CASE WHEN CAST(right({w}, 2) AS INT) > 1 THEN left({w}, 4) || '-W' || lpad(CAST(CAST(right({w}, 2) AS INT) - 1 AS VARCHAR), 2, '0') ELSE CAST(CAST(left({w}, 4) AS INT) - 1 AS VARCHAR) || '-W52' END"  # noqa: E731
SQL |= {
    "topic_rules": f"SELECT CAST(n AS INTEGER) AS n, {', '.join(_topic(s) for s in ('kitopen', 'worldbank', 'patents', 'sdz', 'boverket', 'modelica'))} FROM (VALUES {_values(SUBJECTS)}) AS v(n, t)",
    "license_map": f"""SELECT ident, CASE WHEN starts_with(l, 'cc-by-nc') OR starts_with(l, 'cc-by-nd') THEN NULL WHEN starts_with(l, 'cc-by-sa') THEN 'cc-by-sa' WHEN starts_with(l, 'cc-by') THEN 'cc-by'
  WHEN starts_with(l, 'cc0') OR contains(l, 'public-domain') THEN 'cc0' END AS tag, CASE WHEN l IN ('cc-by', 'cc-by-sa', 'cc0', 'public-domain') THEN l ELSE 'open' END AS open_tag
FROM (SELECT ident, lower(ident) AS l FROM (VALUES {', '.join(f'({q(i)})' for i in LICENSE_IDS)}) AS v(ident))""",
    "shaped_ids": f"""SELECT id, left(source, 3) || '-' || left({_SLUG}, 46) AS entry_id, left(trim(title), 150) AS entry_title,
  CASE WHEN pos % 2 = 0 THEN left(sha1('建筑'), 10) WHEN length(rtrim(left({_SLUG}, 40), '-')) < 3 THEN trim(rtrim(left({_SLUG}, 40), '-') || '-' || left(sha1(title), 10), '-') ELSE rtrim(left({_SLUG}, 40), '-') END AS native FROM {M} AS m""",
    "page_urls": f"SELECT id, 'https://x.example.org/wiki/' || replace(replace(url_encode(replace(title, ' ', '_')), '%2F', '/'), '%23', '#') AS page_url FROM {M} AS m",
    "previous_weeks": f"SELECT o_orderkey, {_PREVIOUS('w')} AS before FROM (SELECT o_orderkey, {_WEEK} AS w FROM orders)",
    "title_resolution": f"SELECT id AS raw, CASE WHEN pos % 2 = 0 THEN 'r-' || id WHEN pos % 3 = 0 THEN 'n-' || id ELSE id END AS final FROM {M} AS m",
    "links_reached": """WITH l AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS p, 's' || CAST(l_suppkey AS VARCHAR) AS s FROM lineitem),
one AS (SELECT s FROM l WHERE p = '1') SELECT '1' AS page, 0 AS hops WHERE true UNION ALL SELECT s, 1 FROM one UNION ALL SELECT DISTINCT p, 2 FROM l WHERE s IN (SELECT s FROM one) AND p <> '1'""",
    "shard_sample": f"SELECT shard, id FROM (SELECT id, {_SHARD} AS shard FROM {M} AS m) QUALIFY row_number() OVER (PARTITION BY shard ORDER BY md5(id || 'sample'), id) <= 2",
    "finder_caps": f"SELECT id, source FROM {M} AS m QUALIFY row_number() OVER (PARTITION BY source ORDER BY title, id) <= 3",
    "circuit_breaker": """WITH e AS (SELECT event_id, user_id, abs((event_id * 7 + user_id) % 5) < 3 AS hit FROM events),
c AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS calm FROM e),
s AS (SELECT *, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, calm ORDER BY event_id) AS BIGINT) AS streak FROM c)
SELECT event_id, streak, max(CASE WHEN streak >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) = 1 AS open FROM s""",
    "rotation_advance": f"""SELECT id AS name, CASE WHEN status <> 'ok' THEN w WHEN pos % 3 = 0 THEN {_PREVIOUS('w')} ELSE CAST(pos + CASE WHEN pos % 2 = 0 THEN 25 ELSE 1 END AS VARCHAR) END AS next
FROM (SELECT *, CASE WHEN pos % 3 = 0 THEN '2026-W' || lpad(CAST(pos % 52 + 1 AS VARCHAR), 2, '0') ELSE CAST(pos AS VARCHAR) END AS w FROM {M} AS m)""",
}

# --- passes in order, as recursion over numbered rows ---------------------------------------------


def _first_kept(rows: str) -> str:
    """n of the rows (n, u, t) that a pass keeps: those whose u and t no kept row before has."""
    return f"""(WITH RECURSIVE pass AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS us, CAST([] AS VARCHAR[]) AS ts, false AS kept
  UNION ALL
  SELECT r.n, CASE WHEN list_contains(us, r.u) OR list_contains(ts, r.t) THEN us ELSE list_append(us, r.u) END,
    CASE WHEN list_contains(us, r.u) OR list_contains(ts, r.t) THEN ts ELSE list_append(ts, r.t) END, NOT (list_contains(us, r.u) OR list_contains(ts, r.t))
  FROM pass JOIN ({rows}) AS r ON r.n = pass.n + 1)
SELECT n FROM pass WHERE kept)"""


def _unique_ids(rows: str, reserved: list[str]) -> str:
    """n and id of the rows (n, id): a taken id becomes its first 50 characters and the first free number from 2."""
    free = "list_filter(range(2, len(list_filter(taken, lambda y: starts_with(y, left(r.id, 50)))) + 4), lambda k: NOT list_contains(taken, left(r.id, 50) || '-' || CAST(k AS VARCHAR)))[1]"
    new = f"CASE WHEN list_contains(taken, r.id) THEN left(r.id, 50) || '-' || CAST({free} AS VARCHAR) ELSE r.id END"
    return f"""(WITH RECURSIVE named AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST([{listed(reserved)}] AS VARCHAR[]) AS taken, CAST(NULL AS VARCHAR) AS id
  UNION ALL
  SELECT r.n, list_append(taken, {new}), {new} FROM named JOIN ({rows}) AS r ON r.n = named.n + 1)
SELECT n, id FROM named WHERE n > 0)"""


_NORM_OF = lambda c: r"trim(regexp_replace(lower(" + c + r"), '[^\p{L}\p{N}_]+', ' ', 'g'))"  # noqa: E731
_ROUNDS = f"SELECT row_number() OVER (ORDER BY doc_id % 2, doc_id) AS n, doc_id, url, title, rtrim(url, '/') AS u, {_NORM_OF('title')} AS t FROM (SELECT doc_id, 'https://' || source || '.example.org/' || CAST(doc_id % 700 AS VARCHAR) AS url, left(split_part(text, chr(10), 1), 150) AS title FROM documents)"
_OFFERED = f"""SELECT left(id, 5) AS id, title, CASE WHEN pos % 7 = 0 THEN 'https://shared.example.org/' || CAST(pos % 50 AS VARCHAR) ELSE url END AS url, 'b' || CAST(pos % 3 AS VARCHAR) AS backend, pos FROM {M} AS m WHERE title <> ''"""
_FRESH = f"""SELECT row_number() OVER (ORDER BY pos % 3, pos) AS n, *, rtrim(url, '/') AS u, {_NORM} AS t FROM ({_OFFERED})
WHERE rtrim(url, '/') NOT IN (SELECT {_URL} FROM {M} AS k WHERE pos % 10 = 0) AND ({_NORM} = '' OR {_NORM} NOT IN (SELECT {_NORM} FROM {M} AS k WHERE pos % 10 = 0))"""
_KEPT = f"SELECT row_number() OVER (ORDER BY f.n) AS n, id, url, backend, pos FROM ({_FRESH}) AS f JOIN {_first_kept(f'SELECT n, u, t FROM ({_FRESH})')} AS k ON f.n = k.n"
#: The test pages hold one article, without elements in it that never count.
_ARTICLE = r"regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1)"
SQL |= {
    "round_stream": f"SELECT doc_id, url, title, CAST(doc_id % 2 AS INTEGER) AS batch FROM ({_ROUNDS}) AS r JOIN {_first_kept(f'SELECT n, u, t FROM ({_ROUNDS})')} AS k ON r.n = k.n",
    "uniquify_ids": f"SELECT u.id, r.pos FROM (SELECT row_number() OVER (ORDER BY pos) AS n, pos FROM {M} AS m) AS r JOIN {_unique_ids(f'SELECT row_number() OVER (ORDER BY pos) AS n, left(id, 6) AS id FROM {M} AS m', ['hand-3', 'hand-3-2'])} AS u ON r.n = u.n",
    "merge_proposals": f"SELECT u.id, k.url, k.backend, k.pos FROM ({_KEPT}) AS k JOIN {_unique_ids(f'SELECT n, id FROM ({_KEPT})', ['ost-1', 'gh-4-2'])} AS u ON k.n = u.n",
    "html_extract": rf"""WITH nodes AS (SELECT page_id, list_filter(regexp_split_to_array({_ARTICLE}, '(?s)<!--.*?-->|<[^>]+>'), lambda x: x <> '') AS n FROM pages),
l AS (SELECT page_id, list_transform(regexp_split_to_array(array_to_string(list_transform(n, lambda x: replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')), chr(10)), '
|[
-]'), lambda x: trim(x, ' ' || chr(9) || chr(160))) AS l FROM nodes),
t AS (SELECT page_id, trim(array_to_string(list_filter(l, lambda x, i: x <> '' OR (i > 1 AND l[i - 1] <> '')), chr(10)), chr(10)) AS t FROM l)
SELECT page_id, length(t) AS text_chars, sha256(t) AS text_sha256 FROM t""",
}
