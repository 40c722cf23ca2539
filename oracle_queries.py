"""SQL twins of the catalogued queries, written for DuckDB over the same tables.

Common table expressions are named once and pulled in by the queries that use them.
Patterns and word lists are the ones of the Latin rule pack.
"""

from __future__ import annotations

import re

from rootloom.operators.governed import MACHINE_ONLY, REVIEWED
from rootloom.operators.claimgraph import CLAIM_TYPES, DEFAULT_CLAIM, ETYMOLOGY, USAGE
from rootloom.plans.bindings import FOOTNOTE, ORIGIN_LABELS, POETRY
from rootloom.plans.requests import ALIASES, HANDLERS
from rootloom.rules import latin as P, vocab as V

CTES: dict[str, str] = {}
SQL: dict[str, str] = {}
WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
D, O = P.DISCOURSE, P.ORIGINS
CHAINED = (MACHINE_ONLY, *dict.fromkeys(REVIEWED.values()))


def s(text) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def lst(values) -> str:
    return "(" + ", ".join(s(v) for v in values) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {s(pattern)})"


def grab(x: str, pattern: str, group: int = 1) -> str:
    return f"coalesce(regexp_extract({x}, {s(pattern)}, {group}), '')"


def label(x: str, rules, default: str | None) -> str:
    whens = " ".join(f"WHEN {has(x, p)} THEN {s(v)}" for p, v in rules)
    return f"CASE {whens} ELSE {s(default) if default is not None else 'NULL'} END"


def table(x: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {s(k)} THEN {s(v)}" for k, v in mapping.items())
    return f"(CASE {x} {whens} ELSE {default} END)"


def norm(x: str, p) -> str:
    out = f"lower({x})" if p.lower else x
    if p.fold_from or p.delete:
        out = f"translate({out}, {s(p.fold_from + p.delete)}, {s(p.fold_to)})"
    if p.strip_prefix:
        out = f"regexp_replace({out}, {s(p.strip_prefix)}, '')"
    if p.collapse:
        out = f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"
    return out


def root_norm(x: str, p=P.PROFILES["lookup"]) -> str:
    return norm(f"replace({x}, ' ', '')", p)


def with_ctes(final: str) -> str:
    order: list[str] = []

    def visit(text: str, inside: tuple[str, ...] = ()) -> None:
        for name in CTES:
            if name not in order and name not in inside and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name], (*inside, name))
                if name not in order:
                    order.append(name)
    visit(final)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + final if order else final


def cte(name: str, text: str) -> None:
    CTES[name] = text


def sql(name: str, text: str) -> None:
    SQL[name] = text  # completed at the end, when all common tables are named


def cols(x: str) -> str:
    return f"array_to_string({x}, '|')"


LOOKUP, INITIAL = P.PROFILES["lookup"], P.PROFILES["initial"]

# ------------------------------------------------------------------- bindings
cte("parsed", f"""SELECT doc_id AS entry_num, source, lower(regexp_extract(text, '\\p{{L}}+')) AS root_letters,
  regexp_extract(text, '\\p{{L}}+') AS root_display, lang AS chapter_header,
  regexp_extract(text, '\\p{{L}}+') <> '' AS is_lexical_entry, text AS body_text,
  list_filter(string_split(text, chr(10)), lambda x: x <> '' AND {has('x', POETRY)}) AS poetry_lines,
  list_filter(string_split(text, chr(10)), lambda x: x <> '' AND {has('x', FOOTNOTE)}) AS footnote_lines,
  regexp_extract_all(text, ' from (\\p{{L}}+)', 1) AS page_refs FROM documents""")

_bad = f"(length(body_text) - length(regexp_replace(body_text, {s(O.ocr_suspect)}, '', 'g')))"


def enrichment(pack, prefix: str = "") -> None:
    """Entries after their letter chain, the rule that holds, and what it says."""
    text = strip(f"regexp_replace(regexp_replace(body_text, {s(pack.noise)}, ' ', 'g'), '\\s+', ' ', 'g')") if pack.noise else "body_text"
    tails = ", ".join(f"nullif({grab('t', c)}, '')" for c in pack.chains)
    after = strip(f"coalesce({tails}, t)")
    if pack.raw_prefix:
        after = f"regexp_replace({after}, {s(pack.raw_prefix)}, '')"
    after = norm(after, pack.profile)
    for p in pack.context_prefixes:
        after = strip(f"regexp_replace({after}, {s(p)}, '')")
    cte(prefix + "after_chain", f"SELECT *, {after} AS after_text FROM (SELECT *, {text} AS t FROM parsed)")

    def seen(window):
        return f"substr(after_text, 1, {window})" if window else "after_text"

    def axis_list(r) -> str:
        src = seen(r.extract_window if r.extract else r.window)
        items = ", ".join(strip(f"regexp_replace({grab(src, r.extract or r.pattern, g)}, '\\s+', ' ', 'g')") for g in r.groups)
        out = f"list_filter([{items}], lambda v: v <> '')"
        return f"list_slice({out}, 1, 1)" if r.first_only else out
    rule = "CASE " + " ".join(f"WHEN {has(seen(r.window), r.pattern)} THEN {s(r.name)}" for r in pack.rules) + " END"
    cte(prefix + "ruled", f"SELECT *, {rule} AS origin_rule FROM {prefix}after_chain")
    axes = "CASE origin_rule " + " ".join(f"WHEN {s(r.name)} THEN {axis_list(r)}" for r in pack.rules if r.groups) \
        + " ELSE CAST([] AS VARCHAR[]) END"
    kind = "CASE origin_rule " + " ".join(f"WHEN {s(r.name)} THEN {s(r.entry_type)}" for r in pack.rules) + " ELSE 'UNKNOWN' END"
    count = "CASE origin_rule " + " ".join(
        f"WHEN {s(r.name)} THEN {r.axes_count if r.axes_count is not None else 'NULL'}" for r in pack.rules) + " END"
    cte(prefix + "enriched", f"""SELECT *, entry_num AS entry_id, {kind} AS entry_type, CAST({count} AS BIGINT) AS axes_count,
  {axes} AS axes, list_sort(list_distinct(regexp_extract_all(body_text, {s('(' + pack.authorities + ')')}, 1))) AS authorities,
  greatest(0.0, round(1.0 - {_bad} / greatest(length(body_text), 1) * 10, 2)) AS ocr_confidence,
  'PENDING' AS review_state, 'UNVERIFIED' AS claim_status FROM {prefix}ruled""")


enrichment(O)
enrichment(P.ORIGINS_V1, "v1_")
cte("axis_rows", """SELECT entry_id, unnest(axes) AS axis_text, CAST(generate_subscripts(axes, 1) AS BIGINT) AS axis_num,
  'IBN_FARIS_DIRECT' AS attribution, root_letters, root_display FROM enriched""")
cte("asks", """SELECT item_id AS request_id, lower(w[1]) AS root, lower(w[2]) AS concept, lower(w[3]) AS concept_id,
  concat_ws(' ', lower(w[2]), lower(w[4])) AS claim_text, lower(w[5]) AS lemma,
  CASE WHEN n % 2 = 0 THEN 'ADOPTED_BY_IBN_FARIS' END AS author_position,
  CASE WHEN n % 7 = 0 THEN 'DEFER' WHEN n % 7 = 1 THEN 'BLOCK' WHEN n % 7 = 2 THEN 'MAYBE' WHEN n % 7 > 3 THEN 'ACCEPT' END
  AS directive FROM (SELECT item_id, regexp_extract_all(text, '(\\p{L}+)', 1) AS w, length(text) AS n FROM benchmark)""")

_labels = "[" + ", ".join(map(s, ORIGIN_LABELS)) + "]"
cte("labelled", f"""SELECT d.doc_id, d.text, d.source, d.n_chars, l.quality, l.toxic,
  lower(regexp_extract(d.text, '\\p{{L}}+')) AS letters, {_labels}[d.n_chars % {len(ORIGIN_LABELS)} + 1] AS olabel
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")


def _line_ids(pattern: str) -> str:
    return (f"list_transform(list_filter(range(1, len(string_split(text, chr(10))) + 1), "
            f"lambda i: {has('string_split(text, chr(10))[i]', pattern)}), lambda i: doc_id || ':' || (i - 1))")


cte("root_entries", f"""SELECT doc_id AS line_no, doc_id, source || '.pdf:r' || doc_id AS entry_id, source || '.pdf' AS source_pdf,
  CAST(floor(n_chars / 100) AS BIGINT) AS pdf_page, regexp_extract(text, '^[^.\\n]*') AS heading,
  CASE WHEN n_chars % 97 = 0 THEN '' ELSE letters END AS root_letters,
  CASE WHEN quality = 0 THEN '' WHEN toxic = 1 THEN 'letter x' ELSE 'letter ' || substr(letters, 1, 1) END AS bab_letter,
  olabel AS semantic_origin_type, nullif({grab('text', '[.]\\s+([^.\\n]{3,})')}, '') AS semantic_origin_text,
  CAST(CASE olabel WHEN 'SINGULAR' THEN 1 WHEN 'DUAL' THEN 2 WHEN 'TRIPLE' THEN 3 END AS BIGINT) AS origin_count,
  CASE WHEN quality = 1 THEN 'AUTO_AGREED' WHEN quality = 0 THEN 'REVIEW_REQUIRED' ELSE '' END AS review_status,
  text FROM labelled""")
_chapter = table("substr(root_letters, 1, 1)", P.CHAPTER_NAMES, "''")
cte("corrected", f"""SELECT *, bab_letter AS original_bab_letter,
  CASE WHEN root_letters = '' THEN '' ELSE {_chapter} END AS corrected_bab_letter FROM root_entries""")
cte("scan_lines", """SELECT doc_id || ':' || pos AS line_id, doc_id, source, quality, pos, raw_ocr,
  replace(replace(raw_ocr, 'rn', 'm'), '.,', ',') AS corrected_ocr,
  CASE WHEN quality = 1 AND length(raw_ocr) % 5 = 0 THEN raw_ocr END AS human_text, (length(raw_ocr) % 90 + 10) / 100.0 AS confidence
  FROM (SELECT doc_id, source, quality, unnest(string_split(text, chr(10))) AS raw_ocr,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM labelled)""")
cte("certs", """SELECT doc_id AS line_no, 'cert:' || doc_id AS certificate_id, doc_id * 60 AS reviewed_at,
  CASE WHEN quality = 1 THEN 'LEXICALLY_REVIEWED' ELSE 'TEXT_CANDIDATE' END AS granted_state,
  CASE WHEN toxic = 1 THEN 'MACHINE_ONLY' ELSE 'HUMAN_REVIEWER' END AS reviewer_type FROM labels""")

# ------------------------------------------------------------------------- A
sql("A1_parse_json_lines", """SELECT event_id AS line_no, CAST(json_extract(props, '$.k') AS BIGINT) AS k, false AS is_malformed
  FROM events WHERE trim(props) <> ''""")
_lines = "len(string_split(text, chr(10)))"
sql("A2_resolve_corpus", f"""SELECT CASE WHEN ok THEN entry_id END AS entry_id, CASE WHEN ok THEN source_pdf END AS source_pdf, CASE WHEN ok THEN root_letters END AS root_letters,
  CASE WHEN ok THEN semantic_origin_text END AS semantic_origin_text, CASE WHEN ok THEN {_lines} END AS lines, NOT ok AS is_malformed, 'ORIGINAL' AS load_status
  FROM (SELECT *, line_no % 7 <> 0 AS ok FROM root_entries)""")
sql("A2_load_health", "SELECT count_if(line_no % 7 = 0) AS malformed_line_count, count_if(line_no % 7 = 0) > 0 AS partial_load FROM root_entries")
sql("A4_write_jsonl", f"SELECT entry_num, entry_type, root_letters, {cols('axes')} AS axes, {cols('authorities')} AS authorities FROM enriched")
sql("A3_star_entries", f"""SELECT entry_id, source, root_letters, root_display, chapter_header, is_lexical_entry,
  CAST(length(body_text) AS BIGINT) AS body_length, CAST(len(page_refs) AS BIGINT) AS page_ref_count, entry_type, axes_count,
  {cols('authorities')} AS authorities, ocr_confidence, review_state, claim_status FROM enriched""")
sql("A3a_semantic_axes", """SELECT entry_id, axis_num, axis_text, axis_text AS axis_text_orig, attribution FROM axis_rows""")
sql("A3b_poetry_evidence", """SELECT entry_num AS entry_id, CAST(generate_subscripts(poetry_lines, 1) AS BIGINT) AS line_num,
  unnest(poetry_lines) AS line_text FROM parsed""")
sql("A3c_source_passages", """SELECT entry_num AS entry_id, CAST(generate_subscripts(footnote_lines, 1) AS BIGINT) AS passage_num,
  unnest(footnote_lines) AS content, 'FOOTNOTE' AS passage_type FROM parsed""")
sql("A3d_trace_events", """SELECT entry_id, CASE WHEN entry_type = 'UNKNOWN' THEN 'FLAGGED' ELSE 'ENRICHED' END AS event_type,
  'entry_type=' || entry_type || ' axes=' || coalesce(CAST(axes_count AS VARCHAR), 'None') AS detail FROM enriched""")
_article = "regexp_extract(html, '<article[^>]*>([\\s\\S]*?)</article>', 1)"
_plain = f"regexp_replace({_article}, '<[^>]*>', chr(10), 'g')"
for _entity, _char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _plain = f"replace({_plain}, '&{_entity};', '{_char}')"
_tagless = f"string_split({_plain}, chr(10))"
_clean_lines = f"list_filter(list_transform({_tagless}, lambda x: {strip('x')}), lambda x: x <> '')"
_squeezed = f"array_to_string(list_transform({_clean_lines}, lambda x: regexp_replace(x, '[ \\t\\r\\f\\v]{{2,}}', ' ', 'g')), chr(10))"
sql("A5_extract_pages", f"""SELECT page_id, CAST(length(t) AS BIGINT) AS text_length, md5(t) AS text_md5, CAST(0 AS BIGINT) AS footnotes
  FROM (SELECT page_id, {_squeezed} AS t FROM pages)""")
sql("A6_volume_page", """SELECT conv_id, turn, 'ج' || conv_id AS vol, 'ص' || turn AS page_label FROM conversations""")

L = P.LINES
cte("page_lines", f"""SELECT book, page_num, pos, line FROM (SELECT conv_id AS book, turn AS page_num,
  {strip('unnest(string_split(text, chr(10)))')} AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS pos
  FROM conversations) WHERE line <> ''""")
_names = "|".join(sorted(L.letter_names, key=len, reverse=True))
_letters = lambda x: (f"coalesce(array_to_string(list_transform(regexp_extract_all(lower({x}), {s('(' + _names + ')')}, 1), "
                      f"lambda n: {table('n', L.letter_names, 'NULL')}), ''), '')")
_refs = lambda x: (f"list_filter(list_transform(regexp_extract_all({x}, {s(L.page_ref)}, 0), lambda m: coalesce("
                   f"nullif({grab('m', L.page_ref, 1)}, ''), nullif({grab('m', L.page_ref, 2)}, ''))), lambda r: r IS NOT NULL)")
_book = "PARTITION BY book ORDER BY page_num, pos"
cte("state_lines", f"""SELECT *, lag(bracket) OVER ({_book}) AS pending,
  last_value(CASE WHEN is_chapter THEN line END IGNORE NULLS) OVER ({_book} ROWS UNBOUNDED PRECEDING) AS chapter FROM (
  SELECT *, {has('line', L.chapter)} AS is_chapter,
    CASE WHEN NOT {has('line', L.chapter)} THEN nullif({grab('line', L.bracket)}, '') END AS bracket FROM page_lines)""")
cte("entry_lines", f"""SELECT * FROM (SELECT *, count(opener) OVER ({_book} ROWS UNBOUNDED PRECEDING) AS entry_num,
  CASE WHEN {has('line', L.footnote)} THEN 'footnote' WHEN {has('line', L.poetry)} THEN 'poetry' ELSE 'text' END AS role,
  {_letters(f"CASE opener WHEN 'confirm' THEN {grab('line', L.confirm, 0)} WHEN 'strict' THEN {grab('line', L.strict, 0)} ELSE {grab('line', L.geminate, 0)} END")} AS start_root
  FROM (SELECT *, CASE WHEN pending IS NOT NULL THEN CASE WHEN {has('line', L.confirm)} THEN 'confirm' END
    WHEN {has('line', L.strict)} THEN 'strict' WHEN {has('line', L.geminate)} THEN 'geminate' END AS opener
    FROM state_lines WHERE NOT is_chapter AND bracket IS NULL)) WHERE entry_num > 0""")
sql("A7_entry_lines", "SELECT book, page_num, pos, entry_num, role, opener, chapter FROM entry_lines")
cte("entry_bodies", "SELECT book, entry_num, bool_or(role <> 'footnote') AS filled FROM entry_lines GROUP BY book, entry_num")
sql("A7_entry_heads", """SELECT book, entry_num, max(CASE WHEN opener IS NOT NULL THEN coalesce(nullif(start_root, ''), pending, start_root) END) AS root_letters,
  max(CASE WHEN opener IS NOT NULL THEN coalesce(pending, start_root) END) AS root_display, max(CASE WHEN opener IS NOT NULL THEN chapter END) AS chapter_header,
  count_if(role = 'text') AS text_lines, count_if(role = 'poetry') AS poetry_lines, count_if(role = 'footnote') AS footnote_lines
  FROM entry_lines GROUP BY book, entry_num HAVING bool_or(role <> 'footnote')""")
sql("A7_numbered_lines", """SELECT book, entry_num, row_number() OVER (PARTITION BY book, entry_num ORDER BY page_num, pos) - 1 AS line_num, page_num, pos, role, filled
  FROM entry_lines JOIN entry_bodies USING (book, entry_num)""")
sql("A7_segment_entries", f"""SELECT book, entry_num,
  max(CASE WHEN opener IS NOT NULL THEN coalesce(nullif(start_root, ''), pending, start_root) END) AS root_letters,
  max(CASE WHEN opener IS NOT NULL THEN coalesce(pending, start_root) END) AS root_display,
  max(CASE WHEN opener IS NOT NULL THEN chapter END) AS chapter_header,
  coalesce(string_agg(line || chr(10), '' ORDER BY page_num, pos) FILTER (role <> 'footnote'), '') AS body_text,
  coalesce(string_agg(line, chr(10) ORDER BY page_num, pos) FILTER (role = 'poetry'), '') AS poetry,
  coalesce(string_agg(line, chr(10) ORDER BY page_num, pos) FILTER (role = 'footnote'), '') AS footnotes,
  coalesce(string_agg(nullif({cols(_refs('line'))}, ''), '|' ORDER BY page_num, pos) FILTER (role = 'text'), '') AS page_refs,
  array_to_string(list_sort(list_distinct(list(page_num))), '|') AS raw_page_nums
  FROM entry_lines GROUP BY book, entry_num""")
_class = "CASE " + " ".join(f"WHEN {has('line', getattr(L, n))} THEN {s(n)}" for n in (
    "chapter", "bracket", "confirm", "strict", "geminate", "footnote", "poetry", "page_ref")) + " ELSE 'plain' END"
sql("A8_classify_lines", f"SELECT book, page_num, pos, {_class} AS line_class, {cols(_refs('line'))} AS page_refs FROM page_lines")
sql("A9_letter_names_to_root", f"SELECT book, page_num, pos, {_letters(grab('line', L.confirm, 0))} AS root FROM page_lines")
sql("A10_segmentation_report", """SELECT (SELECT count(*) FROM conversations) AS pages, count(opener) AS entries,
  count(opener) AS lexical_entries, CAST(0 AS BIGINT) AS other_entries FROM entry_lines""")
sql("A11_page_counts", "SELECT source, count(*) AS page_count FROM documents GROUP BY source")
sql("A12_volume_content_hash", "SELECT source, sha256(coalesce(string_agg(text, '' ORDER BY doc_id), '')) AS sha256 FROM documents GROUP BY source")
cte("hash_0", "SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id, sha256(coalesce(text, ''))) - 1 AS p, sha256(coalesce(text, '')) AS h FROM documents")
_up = "SELECT source, p // 1024 AS p, CASE WHEN count(*) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h FROM {} GROUP BY ALL"
cte("hash_1", _up.format("hash_0"))
cte("hash_2", _up.format("hash_1"))
cte("tree_hash", f"SELECT source, h AS sha256, n AS lines FROM ({_up.format('hash_2')}) JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) USING (source)")
sql("A12_volume_tree_hash", "SELECT * FROM tree_hash")
sql("A13_source_records", """SELECT 'lex:source:vol' || v AS source_id, v AS volume_number, d.source || '.pdf' AS source_pdf, h.sha256,
  d.n AS page_count, CAST(2 AS BIGINT) AS ocr_pass_count, false AS is_missing_volume, coalesce(i.letters, '') AS initial_letters, '' AS pdf_sha256
  FROM (SELECT source, count(*) AS n, CAST(regexp_extract(source, '(\\d+)') AS BIGINT) AS v FROM documents GROUP BY source) d
  JOIN tree_hash h ON d.source = h.source LEFT JOIN (SELECT source_pdf, string_agg(c, '' ORDER BY encode(c)) AS letters FROM (
    SELECT DISTINCT source_pdf, substr(root_letters, 1, 1) AS c FROM root_entries WHERE root_letters <> '') GROUP BY source_pdf) i ON i.source_pdf = d.source || '.pdf'
  WHERE d.source <> 'src19'""")

# ------------------------------------------------------------------------- B
for _n in ("lookup", "classify", "classify_v1", "graph_origin", "entity", "initial"):
    sql(f"B_normalize_{_n}", f"SELECT doc_id, md5({norm('text', P.PROFILES[_n])}) AS norm FROM documents")
sql("B2_normalize_root", f"SELECT p_partkey, {root_norm('p_name')} AS root_norm FROM part")
sql("B9_fix_ocr", "SELECT doc_id, md5(replace(text, ' de ', ' di ')) AS fixed FROM documents")


def excerpt(text: str, key: str) -> str:
    at = f"(strpos({text}, {key}) - 1)"
    start, stop = f"greatest(0, {at} - 60)", f"least(length({text}), {at} + 150)"
    return (f"CASE WHEN {at} >= 0 THEN (CASE WHEN {start} > 0 THEN '…' ELSE '' END) || substr({text}, {start} + 1, {stop} - {start}) "
            f"|| (CASE WHEN {stop} < length({text}) THEN '…' ELSE '' END) ELSE substr({text}, 1, 150) END")


def body_excerpt(text: str) -> str:
    return f"CASE WHEN length({text}) > 300 THEN substr({text}, 1, 300) || '…' ELSE {text} END"


sql("B10_excerpt", f"SELECT doc_id, {excerpt('text', s(' that '))} AS excerpt FROM documents")
sql("B11_body_excerpt", f"SELECT doc_id, {body_excerpt('text')} AS excerpt FROM documents")
_best = f"coalesce(nullif({strip('human_text')}, ''), nullif({strip('corrected_ocr')}, ''), nullif({strip('raw_ocr')}, ''), '')"
sql("B12_best_text", f"SELECT line_id, {_best} AS best FROM scan_lines")
sql("B13_text_confidence", """SELECT line_id, round(CASE WHEN length(human_text) > 0 THEN 1.0
  WHEN corrected_ocr <> raw_ocr AND length(corrected_ocr) > 0 THEN 0.7
  WHEN length(raw_ocr) > 0 THEN round(confidence * 0.6, 3) ELSE 0.0 END, 6) AS confidence FROM scan_lines""")
sql("B14_checksum", "SELECT doc_id, sha256(text) AS full, substr(sha256(text), 1, 16) AS short FROM documents")
sql("B15_entity_ids", """SELECT line_no, 'lex:passage:' || root_letters || ':' || line_no AS by_line,
  'lex:claim:' || root_letters || ':' || entry_id AS by_entry FROM root_entries""")
sql("B16_source_id", """SELECT line_no, 'lex:source:vol' || CAST(CAST(regexp_extract(source_pdf, '(\\d+)') AS BIGINT) AS VARCHAR) AS source_id,
  CAST(regexp_extract(source_pdf, '(\\d+)') AS BIGINT) AS volume_number FROM root_entries""")
sql("B17_classify_evidence_id", """SELECT doc_id, CASE lang WHEN 'en' THEN 'LEXICON_ROOT' WHEN 'fr' THEN 'LEXICON_ENTITY'
  WHEN 'es' THEN 'ROOT_CATALOG' ELSE 'OTHER' END AS kind FROM documents""")
sql("B18_root_profile", """SELECT line_no, CASE WHEN l = '' THEN '' ELSE array_to_string(string_split(l, ''), '|') END AS letters,
  CAST(nullif(length(l), 0) AS BIGINT) AS letter_count, length(replace(root_letters, ' ', '')) = 2 AS geminate
  FROM (SELECT line_no, root_letters, regexp_replace(root_letters, '[^\\p{L}]', '', 'g') AS l FROM root_entries)""")

# ------------------------------------------------------------------------- C
sql("C1_drop_noise", f"SELECT line_no, semantic_origin_type FROM root_entries WHERE semantic_origin_type NOT IN {lst(V.NOISE_TYPES)}")
sql("C2_drop_blank_root", "SELECT line_no, root_letters FROM root_entries WHERE root_letters <> ''")
_gap = f"{norm('substr(root_letters, 1, 1)', INITIAL)} IN {lst(P.MISSING_INITIALS)}"
sql("C3_exclude_uncovered_initials", f"SELECT line_no, root_letters FROM root_entries WHERE NOT ({_gap})")
sql("C4_lexical_only", "SELECT entry_num, root_letters FROM parsed WHERE is_lexical_entry")
sql("C5_by_author_position", """SELECT * FROM (SELECT entry_id, axis_num, CASE WHEN length(axis_text) % 3 = 0 THEN 'QUOTED_AUTHORITY'
  ELSE attribution END AS attribution FROM axis_rows) WHERE entry_id % 2 <> 0 OR attribution = 'IBN_FARIS_DIRECT'""")
_refusal = """CASE WHEN directive IS NULL THEN 'domain_directive_absent' WHEN directive = 'DEFER' THEN 'root_directive_DEFER'
  WHEN directive = 'BLOCK' THEN 'root_directive_BLOCK' WHEN directive <> 'ACCEPT' THEN 'root_directive_not_accepted:' || directive
  WHEN root IS NULL THEN 'no_root_claim_for_accepted_directive' WHEN root = '' THEN 'root_claim_has_no_radicals_field' END"""
sql("C6_licence_refusal", f"SELECT request_id, {_refusal} AS reason FROM asks")

# ------------------------------------------------------------------------- D
sql("D1_strip_letter_chain", "SELECT entry_num, after_text AS after FROM after_chain")
sql("D2_classify_origin", "SELECT entry_num, origin_rule, entry_type, axes_count FROM enriched")
sql("D3_extract_axes", f"SELECT entry_num, {cols('axes')} AS axes FROM enriched")
sql("D5_quoted_authorities", f"SELECT entry_num, {cols('authorities')} AS authorities FROM enriched")
sql("D6_ocr_confidence", "SELECT entry_num, ocr_confidence FROM enriched")
sql("D7_enrich", f"""SELECT entry_num, root_letters, entry_type, axes_count, {cols('axes')} AS axes, {cols('authorities')} AS authorities,
  ocr_confidence, review_state, claim_status FROM enriched""")
sql("D4_enrich_v1", f"SELECT entry_num, entry_type, axes_count, {cols('axes')} AS axes, ocr_confidence FROM v1_enriched")
sql("D8_enrichment_report", """SELECT entry_type, count(*) AS entries, count_if(len(axes) > 0) AS with_axes,
  count_if(coalesce(axes_count, 0) >= 2) AS multi_origin, count_if(ocr_confidence < 0.8) AS low_ocr,
  count_if(entry_type = 'UNKNOWN') AS unknown, arg_min(root_display, entry_num) AS sample_root,
  arg_min(substr(coalesce(axes[1], '—'), 1, 50), entry_num) AS sample_axis FROM enriched GROUP BY entry_type""")

# ------------------------------------------------------------------------- E
sql("E1_correct_chapter", """SELECT line_no, bab_letter, original_bab_letter, corrected_bab_letter,
  'first_radical_derivation' AS correction_reason, 'v1' AS correction_version FROM corrected""")
sql("E2_correction_report", """SELECT count(*) AS total_entries,
  count_if(root_letters <> '' AND corrected_bab_letter <> '' AND original_bab_letter <> corrected_bab_letter) AS bab_changed,
  count_if(root_letters <> '' AND corrected_bab_letter <> '' AND original_bab_letter = corrected_bab_letter) AS bab_already_correct,
  count_if(root_letters = '') AS no_root_letters,
  count_if(root_letters <> '' AND corrected_bab_letter = '') AS first_radical_not_in_map FROM corrected""")
sql("E3_remaining_mismatch", f"""SELECT count_if(original_bab_letter <> '' AND original_bab_letter NOT IN {lst(sorted(set(P.CHAPTER_NAMES.values())))})
  AS wrong_chapter_remaining, count_if(root_letters <> '' AND original_bab_letter <> '' AND corrected_bab_letter <> ''
  AND original_bab_letter <> corrected_bab_letter) AS chapter_initial_mismatch, CAST(0 AS BIGINT) AS provenance_missing FROM corrected""")

# ------------------------------------------------------------------------- F
_real = "semantic_origin_type NOT IN ('NONE', 'UNKNOWN', '')"
cte("covered", f"SELECT * FROM corrected WHERE root_letters <> '' AND NOT ({_gap})")
cte("registry", f"""SELECT root_letters, coalesce(CASE WHEN agreed THEN agt ELSE anyt END, 'NONE') AS semantic_origin_type,
  CASE WHEN agreed THEN ac ELSE anyc END AS origin_count, CASE WHEN agreed THEN 'AUTO_AGREED' ELSE 'REVIEW_REQUIRED' END AS review_status,
  entry_count, source_pdfs, heading_sample, CASE WHEN chap IS NOT NULL THEN chap ELSE {_chapter} END AS bab_letter,
  CASE WHEN chap IS NOT NULL THEN orig ELSE coalesce(stored, '') END AS original_bab_letter,
  CASE WHEN chap IS NOT NULL THEN 'v1' ELSE 'v1-derived' END AS correction_version FROM (
  SELECT root_letters, bool_or(review_status = 'AUTO_AGREED') AS agreed, count(*) AS entry_count,
    arg_min(semantic_origin_type, line_no) FILTER ({_real} AND review_status = 'AUTO_AGREED') AS agt,
    first(origin_count ORDER BY line_no) FILTER ({_real} AND review_status = 'AUTO_AGREED') AS ac,
    arg_min(semantic_origin_type, line_no) FILTER ({_real}) AS anyt, first(origin_count ORDER BY line_no) FILTER ({_real}) AS anyc,
    arg_min(corrected_bab_letter, line_no) FILTER (corrected_bab_letter <> '') AS chap,
    arg_min(original_bab_letter, line_no) FILTER (corrected_bab_letter <> '') AS orig,
    arg_min(bab_letter, line_no) FILTER (bab_letter <> '') AS stored,
    coalesce(arg_min(heading, line_no) FILTER (heading <> ''), '') AS heading_sample FROM covered GROUP BY root_letters)
  JOIN (SELECT root_letters, string_agg(source_pdf, '|' ORDER BY f) AS source_pdfs FROM (SELECT root_letters, source_pdf, min(line_no) AS f
    FROM covered GROUP BY ALL) GROUP BY root_letters) USING (root_letters)""")
sql("F1_merge_roots", "SELECT * FROM registry")
_askgap = f"{norm('substr(a.root, 1, 1)', INITIAL)} IN {lst(P.MISSING_INITIALS)}"
cte("lookups", f"""SELECT a.request_id, a.root AS lookup_root, r.* EXCLUDE (root_letters), CASE WHEN a.root = '' THEN 'INVALID_ROOT_INPUT'
  WHEN {_askgap} THEN 'MISSING_VOLUME_COVERAGE_GAP' WHEN r.root_letters IS NULL THEN 'NOT_FOUND_IN_COVERED_VOLUME'
  WHEN r.review_status = 'AUTO_AGREED' THEN 'FOUND_AUTO_AGREED' ELSE 'FOUND_REVIEW_REQUIRED' END AS kind
  FROM asks a LEFT JOIN registry r ON a.root = r.root_letters""")
sql("F2_typed_lookup", "SELECT request_id, lookup_root, kind, semantic_origin_type, review_status, bab_letter FROM lookups")
sql("F3_lookup_flags", """SELECT request_id, kind LIKE 'FOUND_%' AS found, kind = 'FOUND_AUTO_AGREED' AS auto_agreed,
  kind = 'FOUND_REVIEW_REQUIRED' AS review_required, kind = 'MISSING_VOLUME_COVERAGE_GAP' AS coverage_gap FROM lookups""")
_cat_ids = f"""list_filter([CASE WHEN kind = 'FOUND_AUTO_AGREED' AND {_real} THEN 'lex:root:' || lookup_root || ':origin:' ||
  semantic_origin_type || ':count:' || coalesce(CAST(origin_count AS VARCHAR), 'none') END,
  CASE WHEN kind LIKE 'FOUND_%' AND bab_letter <> '' THEN 'lex:root:' || lookup_root || ':bab:' || bab_letter END], lambda x: x IS NOT NULL)"""
sql("F4_catalog_evidence_ids", f"SELECT request_id, {cols(_cat_ids)} AS evidence_ids FROM lookups")
sql("F5_registry_health", "SELECT count(*) AS total_roots, count(*) > 0 AS is_healthy FROM registry")

# ------------------------------------------------------------------------- G
cte("imports", f"""SELECT line_no, root_letters, review_status, semantic_origin_type AS origin_label, origin_count,
  CASE WHEN corrected_bab_letter <> '' THEN corrected_bab_letter ELSE bab_letter END AS bab_letter, corrected_bab_letter,
  original_bab_letter, 'v1' AS correction_version,
  CASE WHEN review_status = 'AUTO_AGREED' THEN 'MACHINE_CANDIDATE' ELSE 'UNVERIFIED_REVIEW_REQUIRED' END AS review_state,
  'MACHINE_SOURCE_CLAIM_CANDIDATE' AS evidence_status, semantic_origin_type IN {lst(V.MULTI_TYPES)} AS requires_segmentation,
  semantic_origin_type IN {lst(V.NOISE_TYPES)} AS is_noise, {strip('heading')} AS heading_text, semantic_origin_text AS origin_text,
  entry_id, source_pdf, pdf_page, 'lex:root-identity-candidate:' || root_letters || ':' || line_no AS candidate_id,
  'lex:passage:' || root_letters || ':' || line_no AS passage_id, 'lex:source-root-claim:' || root_letters || ':' || line_no AS claim_id,
  'lex:trace:import:' || root_letters || ':' || line_no AS import_trace_id, entry_id AS discriminator FROM corrected WHERE root_letters <> ''""")
sql("G1_import_entries", "SELECT * EXCLUDE (origin_text, heading_text, origin_count) FROM imports")


def n(cond: str, name: str) -> str:
    return f"count_if({cond}) AS {name}"


_ok, _kind = "root_letters <> ''", "semantic_origin_type"
cte("recon", "SELECT " + ", ".join([
    "count(*) AS raw_jsonl_lines", "CAST(0 AS BIGINT) AS malformed_json_lines", "count(*) AS valid_raw_entries",
    n("root_letters = ''", "no_root_letters"), n("review_status = 'AUTO_AGREED'", "auto_agreed_raw"),
    n("review_status = 'REVIEW_REQUIRED'", "review_required_raw"), n("review_status = ''", "unknown_status_raw"),
    n(f"{_ok} AND review_status = 'AUTO_AGREED'", "mapped_machine_candidate"),
    n(f"{_ok} AND review_status <> 'AUTO_AGREED'", "mapped_unverified_review"), n(_ok, "import_success"),
    n("root_letters = ''", "import_failed"), n(f"{_kind} IN {lst(V.NOISE_TYPES)}", "noise_entries"),
    *(n(f"{_kind} = {s(t)}", t.lower()) for t in V.NOISE_TYPES),
    n(f"{_kind} IN {lst(V.MULTI_TYPES)}", "requires_segmentation"), *(n(f"{_kind} = {s(t)}", t.lower()) for t in V.MULTI_TYPES),
    n("corrected_bab_letter = '' AND bab_letter = ''", "bab_empty"),
    n("corrected_bab_letter <> '' AND original_bab_letter <> '' AND corrected_bab_letter <> original_bab_letter", "bab_corrected"),
    "CAST(0 AS BIGINT) AS agreed_mapped_to_verified", "CAST(0 AS BIGINT) AS none_as_negative_claim",
    "CAST(0 AS BIGINT) AS review_as_positive", n(f"{_ok} AND {strip('heading')} <> ''", "heading_text_present"),
    n(f"{_ok} AND semantic_origin_text IS NOT NULL", "origin_text_present"),
    n(f"{_ok} AND {strip('heading')} = root_letters", "passage_is_root_text"),
    f"count_if({_ok} AND {_kind} IN {lst(V.MULTI_TYPES)}) + count_if({_ok} AND review_status <> 'AUTO_AGREED') AS residuals_emitted",
    n(_ok, "trace_events_emitted"),
    f"count_if({_ok}) - count_if({_kind} IN {lst(V.NOISE_TYPES)}) AS pipeline_entries",
    "'constitutional-v1' AS import_schema_version", "'legacy_importer_v1' AS import_actor"]) + " FROM corrected")
sql("G2_reconciliation", "SELECT * FROM recon")
sql("G6_verify_import", """SELECT unnest(['agreed_mapped_to_verified', 'none_as_negative_claim', 'review_as_positive', 'import_failed',
  'import_success']) AS "check", unnest(['0', '0', '0', CAST(no_root_letters AS VARCHAR), '>0']) AS expected,
  unnest(['0', '0', '0', CAST(import_failed AS VARCHAR), CAST(import_success AS VARCHAR)]) AS actual, true AS ok FROM recon""")


def residual(name: str, frm: str, rid: str, target: str, ttype: str, kind: str, desc: str, block: str, where: str = "true") -> None:
    cte(name, f"""SELECT {rid} AS residual_id, root_letters, {target} AS target_id, {s(ttype)} AS target_type, {kind} AS residual_type,
      {desc} AS description, {block} AS blocking_until FROM {frm} WHERE {where}""")


_RV = "residual_id, target_id, target_type, residual_type, description, blocking_until"
residual("res_segmentation", "imports", "'lex:residual:SEGMENTATION_REQUIRED:' || root_letters || ':' || line_no", "claim_id",
         "SourceRootClaim", "'SEGMENTATION_REQUIRED'",
         "'Origin type ' || origin_label || ' requires segmentation into separate origin candidates'", "'ORIGIN_SEGMENTED'",
         "requires_segmentation")
residual("res_review", "imports", "'lex:residual:REVIEW_REQUIRED_UNRESOLVED:' || root_letters || ':' || line_no", "candidate_id",
         "RootIdentityCandidate", "'REVIEW_REQUIRED_UNRESOLVED'", "'Human review required for root ' || root_letters",
         "'IDENTITY_VERIFIED'", "review_state = 'UNVERIFIED_REVIEW_REQUIRED'")
sql("G3_segmentation_residuals", f"SELECT {_RV} FROM res_segmentation")
sql("G4_review_residuals", f"SELECT {_RV} FROM res_review")
sql("G5_import_trace_events", """SELECT import_trace_id AS trace_id, 'IMPORT' AS kind, candidate_id AS target_id,
  'legacy_importer_v1' AS actor_id, 'Legacy import: ' || root_letters || ' (' || review_status || ' → ' || review_state || ')' AS summary,
  review_status || '|' || review_state || '|' || is_noise || '|' || requires_segmentation AS metadata FROM imports""")
_otype = lambda x: table(x, V.LEGACY_ORIGIN_TYPE, "'UNKNOWN'")
sql("G7_origin_type_normalize", f"SELECT line_no, {_otype('semantic_origin_type')} AS origin_type FROM root_entries")
_rank = lambda x: f"list_position([{', '.join(map(s, V.REVIEW_STATES))}], {x})"
cte("review_done", f"""SELECT r.*, {_rank('c.granted_state')} >= {_rank('r.blocking_until')} AS done FROM res_review r
  JOIN imports i ON r.target_id = i.candidate_id LEFT JOIN certs c ON c.line_no = i.line_no""")
sql("C7_open_residuals", "SELECT residual_id, target_id FROM review_done WHERE NOT coalesce(done, false)")
sql("K12_residuals_apply", "SELECT residual_type, coalesce(done, false) AS resolved, count(*) AS n FROM review_done GROUP BY ALL")

# ------------------------------------------------------------------------- H
cte("used", "SELECT * FROM imports WHERE NOT is_noise")
cte("passages", """SELECT passage_id, 'lex:source:vol' || CAST(CAST(regexp_extract(source_pdf, '(\\d+)') AS BIGINT) AS VARCHAR) AS source_id,
  pdf_page AS page_number, heading_text AS raw_passage, CASE WHEN review_state = 'MACHINE_CANDIDATE' THEN 1.0 ELSE 0.7 END AS ocr_confidence,
  review_state, evidence_status, entry_id, source_pdf, source_pdf || ':p' || pdf_page AS image_ref,
  CASE WHEN heading_text <> '' THEN sha256(heading_text) ELSE '' END AS passage_checksum FROM used""")
sql("H1_passages", "SELECT * REPLACE (CAST(ocr_confidence AS DOUBLE) AS ocr_confidence) FROM passages")
residual("res_passage", "used", "'lex:residual:MISSING_SOURCE_PASSAGE:' || root_letters || ':' || discriminator", "passage_id",
         "SourcePassage", "'MISSING_SOURCE_PASSAGE'", "'No heading text for root ' || root_letters", "'TEXT_VERIFIED'", "heading_text = ''")
sql("H2_missing_passage_residuals", f"SELECT {_RV} FROM res_passage")
residual("res_blank", "used", "'lex:residual:MISSING_SOURCE_PASSAGE:' || root_letters || ':' || discriminator", "passage_id",
         "SourcePassage", "'MISSING_SOURCE_PASSAGE'", "'No heading text for root ' || root_letters", "'TEXT_VERIFIED'", f"NOT {has('heading_text', '^[[:upper:]]')}".replace("[[:upper:]]", "\\p{Lu}"))
sql("H2_blank_headings", f"SELECT {_RV} FROM res_blank")


def gate(kind: str, arg: str) -> str:
    inside = [f"contains(root_letters, {s(c)})" for c in arg]
    return {"all": " AND ".join(inside) or "false", "never": "false", "longer": f"length(root_letters) >= {arg}",
            "shorter": f"length(root_letters) <= {arg}",
            "distinct_2": " + ".join(f"CAST({i} AS INT)" for i in inside) + " >= 2"}.get(
        kind, f"length(root_letters) - length(translate(root_letters, {s(arg)}, '')) >= {kind[-1]}")


_flags = {g: f"({gate(k, a)})" for g, k, a, _ in P.GATES}
sql("H3_ocr_gates", "SELECT line_no, " + " || ".join(f"CAST(CAST({f} AS INT) AS VARCHAR)" for f in _flags.values()) + " AS gates FROM root_entries")
_flagged = "list_filter([" + ", ".join(f"CASE WHEN {f} THEN {s(g)} END" for g, f in _flags.items()) + "], lambda x: x IS NOT NULL)"
cte("candidates", f"""SELECT line_no, candidate_id, passage_id, root_letters, discriminator, {norm('root_letters', INITIAL)} AS normalized_letters,
  bab_letter, original_bab_letter, correction_version, {_flagged} AS flagged, 'IDENTITY_CANDIDATE' AS review_state FROM used""")
sql("H4_identity_candidates", f"""SELECT candidate_id, passage_id, root_letters, normalized_letters, bab_letter, original_bab_letter,
  {cols('flagged')} AS flagged, review_state FROM candidates""")
_gname = table("g", {g: d for g, _, _, d in P.GATES}, "''")
residual("res_ocr", "(SELECT *, unnest(flagged) AS g FROM candidates)",
         "'lex:residual:OCR_AMBIGUITY:' || g || ':' || root_letters || ':' || discriminator", "candidate_id", "RootIdentityCandidate",
         "'OCR_AMBIGUITY'", f"'OCR gate ' || g || ' raised: ' || {_gname}", "'IDENTITY_VERIFIED'")
sql("H5_ocr_ambiguity_residuals", f"SELECT {_RV} FROM res_ocr")
cte("trace_identity", """SELECT 'lex:trace:identity_extracted:' || root_letters || ':' || discriminator AS trace_id, root_letters,
  'IDENTITY_EXTRACTED' AS kind, candidate_id AS target_id, 'identity_pipeline_v1' AS actor_id,
  'Identity extracted for root ' || root_letters || ': ' || len(flagged) || ' gate(s) flagged' AS summary,
  array_to_string(flagged, ',') || '|' || bab_letter || '|' || (bab_letter <> original_bab_letter) AS metadata FROM candidates""")
sql("H6_identity_trace_events", "SELECT * EXCLUDE (root_letters) FROM trace_identity")
_sumflags = " + ".join(f"count_if({f} AND NOT is_noise)" for f in _flags.values())
_metrics = {"pipeline_input": "count_if(NOT is_noise)", "skipped_noise": "count_if(is_noise)", "candidates": "count_if(NOT is_noise)",
            "entries_with_any_flag": "count_if(NOT is_noise AND (" + " OR ".join(_flags.values()) + "))",
            **{g: f"count_if(NOT is_noise AND {f})" for g, f in _flags.items()}, "ocr_ambiguity_residuals": _sumflags}
sql("H7_gate_summary", f"""SELECT unnest([{', '.join(map(s, _metrics))}]) AS metric, unnest([{', '.join(f'CAST({v} AS BIGINT)' for v in _metrics.values())}])
  AS value FROM imports""")

# ------------------------------------------------------------------------- I
_ckind = table("origin_label", V.LEGACY_CLAIM_KIND, "'INCOMPLETE_CLAIM'")
cte("root_claims_t", f"""SELECT line_no, claim_id, passage_id, candidate_id AS identity_id, root_letters, discriminator, {_ckind} AS claim_kind,
  {_otype('origin_label')} AS origin_type, coalesce(origin_text, '') AS raw_claim_text, origin_text, heading_text, evidence_status,
  'TEXT_CANDIDATE' AS review_state FROM used""")
sql("I1_root_claims_build", """SELECT claim_id, passage_id, identity_id, claim_kind, origin_type, raw_claim_text, review_state FROM root_claims_t""")
_single = "origin_type IN ('SINGULAR', 'SOUND_ROOTS')"
_text = "coalesce(origin_text, '') <> ''"
_odesc = table("origin_type", V.ORIGIN_DESCRIPTIONS, "origin_type")
cte("origin_rows", f"""SELECT line_no, 'lex:lexical-origin-candidate:' || root_letters || ':' || discriminator || ':0' AS origin_id, claim_id, root_letters,
  origin_type, {_odesc} AS origin_description, origin_text AS raw_origin_text FROM root_claims_t WHERE {_single} AND {_text}""")
sql("I2_origin_candidates", "SELECT origin_id, claim_id, origin_type, origin_description, raw_origin_text FROM origin_rows")
sql("I2_origin_candidates_heading_fallback", f"""SELECT 'lex:lexical-origin-candidate:' || root_letters || ':' || discriminator || ':0' AS origin_id, claim_id,
  CASE WHEN {_text} THEN origin_text ELSE heading_text END AS raw_origin_text FROM root_claims_t
  WHERE {_single} OR (origin_type = 'MULTIPLE' AND {_text})""")
_defer = f"""CASE WHEN origin_type IN {lst(V.MULTI_TYPES)} THEN 'SEGMENTATION_REQUIRED' WHEN origin_type IN {lst(V.NO_ORIGIN_TYPES)} THEN
  'ORIGIN_NOT_EXTRACTED' WHEN NOT ({_single} AND {_text}) THEN 'ORIGIN_NOT_EXTRACTED' END"""
residual("res_deferral", f"(SELECT *, {_defer} AS r FROM root_claims_t)",
         "'lex:residual:' || CASE WHEN r = 'SEGMENTATION_REQUIRED' THEN r || ':' || origin_type || '_NO_DISTINCT_SPANS' ELSE r END || ':' || root_letters || ':' || discriminator",
         "claim_id", "SourceRootClaim", "r", "'Root ' || root_letters || ' origin_type=' || origin_type",
         "CASE WHEN r = 'SEGMENTATION_REQUIRED' THEN 'ORIGIN_SEGMENTED' ELSE 'ORIGIN_CANDIDATE' END", "r IS NOT NULL")
sql("I3_segmentation_deferral_residuals", f"SELECT {_RV} FROM res_deferral")
residual("res_claim_text", "root_claims_t", "'lex:residual:MISSING_SOURCE_CLAIM_TEXT:' || root_letters || ':' || discriminator", "claim_id",
         "SourceRootClaim", "'MISSING_SOURCE_PASSAGE'", "'No origin text for root ' || root_letters", "'TEXT_CANDIDATE'", f"NOT ({_text})")
sql("I4_missing_claim_text_residuals", f"SELECT {_RV} FROM res_claim_text")
_one = f"({_single} AND {_text})"
cte("trace_origin", f"""SELECT 'lex:trace:' || lower(k) || ':' || root_letters || ':' || discriminator AS trace_id, root_letters, k AS kind,
  claim_id AS target_id, 'claim_pipeline_v1' AS actor_id, lower(k) || ' ' || root_letters || ' ' || origin_type AS summary,
  origin_type || '|' || CASE WHEN {_one} THEN '1' ELSE '0' END AS metadata
  FROM (SELECT *, CASE WHEN {_one} THEN 'ORIGIN_EXTRACTED' ELSE 'ORIGIN_EXTRACTION_DEFERRED' END AS k FROM root_claims_t)""")
sql("I5_origin_trace_events", "SELECT * EXCLUDE (root_letters) FROM trace_origin")
cte("conflicts", """SELECT root_letters, CAST(sum(n) AS BIGINT) AS entry_count, string_agg(origin_label, ',' ORDER BY origin_label) AS origin_types,
  arg_min(claim_id, f) AS claim_id, 'Root ''' || root_letters || ''' has ' || CAST(sum(n) AS BIGINT) || ' entries with conflicting origin types: '
  || string_agg(origin_label, ', ' ORDER BY origin_label) AS description FROM (SELECT root_letters, origin_label, count(*) AS n,
    min(line_no) AS f, arg_min(claim_id, line_no) AS claim_id FROM used GROUP BY ALL) GROUP BY root_letters HAVING count(*) > 1""")
sql("I6_detect_conflicts", "SELECT * FROM conflicts")
residual("res_conflict", "conflicts", "'lex:residual:ORIGIN_CLAIM_CONFLICT:' || root_letters", "claim_id", "SourceRootClaim",
         "'ORIGIN_CLAIM_CONFLICT'", "description", "'ORIGIN_SEGMENTED'")
sql("I7_claim_summary", """SELECT (SELECT count(*) FROM used) AS claims_produced, (SELECT count(*) FROM origin_rows) AS origin_candidates,
  (SELECT count(*) FROM origin_rows) AS singular_claims, CAST(0 AS BIGINT) AS multi_origin_segmented,
  (SELECT count(*) FROM conflicts) AS conflict_roots, (SELECT count(*) FROM imports WHERE is_noise) AS skipped_noise, CAST(0 AS BIGINT) AS failed""")

# ------------------------------------------------------------------------- J
cte("residuals", " UNION ALL ".join(f"SELECT residual_id, root_letters FROM {r}" for r in (
    "res_segmentation", "res_review", "res_passage", "res_ocr", "res_deferral", "res_claim_text", "res_conflict")))
cte("traces", """SELECT trace_id, root_letters FROM trace_identity UNION ALL SELECT trace_id, root_letters FROM trace_origin
  UNION ALL SELECT 'lex:trace:origin_conflict:' || root_letters, root_letters FROM conflicts""")
sql("J1_entity_index", """SELECT root_letters, count_if(k = 'claim') AS claim, count_if(k = 'origin') AS origin, count_if(k = 'candidate') AS candidate,
  count_if(k = 'residual') AS residual, count_if(k = 'import') AS "import", count_if(k = 'trace') AS trace FROM (
  SELECT root_letters, 'claim' AS k FROM root_claims_t UNION ALL SELECT root_letters, 'origin' FROM origin_rows
  UNION ALL SELECT root_letters, 'candidate' FROM candidates UNION ALL SELECT root_letters, 'residual' FROM residuals
  UNION ALL SELECT root_letters, 'import' FROM imports UNION ALL SELECT root_letters, 'trace' FROM traces) GROUP BY root_letters""")
cte("facts", """SELECT root_letters, count(*) AS import_count, count_if(NOT is_noise) AS claim_count, bool_and(review_status = 'AUTO_AGREED') AS all_agreed,
  bool_or(review_state = 'MACHINE_CANDIDATE') AS any_machine, bool_and(is_noise) AS noise_only,
  count(DISTINCT CASE WHEN NOT is_noise THEN origin_label END) > 1 AS is_conflict,
  arg_min(candidate_id, line_no) FILTER (NOT is_noise) AS candidate_id, arg_min(bab_letter, line_no) FILTER (NOT is_noise) AS bab_letter
  FROM imports GROUP BY root_letters""")
cte("governed", f"""SELECT *, kind LIKE 'FOUND_%' AS found, kind = 'FOUND_CONFLICT_REVIEW_REQUIRED' AS has_conflict,
  kind = 'MISSING_VOLUME_COVERAGE_GAP' AS coverage_gap, kind IN ('FOUND_MACHINE_CANDIDATE_ONLY', 'FOUND_REVIEW_REQUIRED_UNRESOLVED') AS is_machine_only,
  CASE WHEN kind NOT LIKE 'FOUND_%' THEN 'UNREVIEWED' WHEN any_machine THEN 'IDENTITY_CANDIDATE' ELSE 'UNVERIFIED_REVIEW_REQUIRED' END AS review_state,
  CASE WHEN kind = 'MISSING_VOLUME_COVERAGE_GAP' THEN 'Root ''' || root_letters || ''' starts in a missing volume; a coverage gap is not an absence claim' END AS coverage_note
  FROM (SELECT a.request_id, a.root AS root_letters, a.directive, f.* EXCLUDE (root_letters), CASE WHEN a.root = '' THEN 'NOT_FOUND_IN_COVERED_VOLUME'
    WHEN {_askgap} THEN 'MISSING_VOLUME_COVERAGE_GAP' WHEN f.root_letters IS NULL THEN 'NOT_FOUND_IN_COVERED_VOLUME'
    WHEN is_conflict THEN 'FOUND_CONFLICT_REVIEW_REQUIRED' WHEN all_agreed THEN 'FOUND_MACHINE_CANDIDATE_ONLY'
    ELSE 'FOUND_REVIEW_REQUIRED_UNRESOLVED' END AS kind FROM asks a LEFT JOIN facts f ON a.root = f.root_letters)""")
sql("J2_governed_lookup", """SELECT request_id, root_letters, kind, found, has_conflict, coverage_gap, is_machine_only, review_state, coverage_note,
  noise_only, candidate_id FROM governed""")
sql("J3_load_health", """SELECT request_id, kind, CAST(0 AS BIGINT) AS malformed_line_count, false AS partial_load FROM governed""")
cte("evidence_ids", f"""SELECT request_id, CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS position, 'lex:root:' || root_letters || ':bab:' || bab_letter AS evidence_id
  FROM governed WHERE found AND coalesce(bab_letter, '') <> ''
  UNION ALL SELECT g.request_id, 1, 0, 'lex:root:' || g.root_letters || ':origin:' || f.t || ':count:' || f.c FROM governed g JOIN (
    SELECT root_letters, arg_min(origin_type, line_no) AS t, arg_min(CASE WHEN {_one} THEN '1' ELSE 'none' END, line_no) AS c FROM root_claims_t
    WHERE origin_type NOT IN {lst(V.NO_ORIGIN_TYPES)} GROUP BY root_letters) f USING (root_letters) WHERE g.kind = 'FOUND_MACHINE_CANDIDATE_ONLY'
  UNION ALL SELECT request_id, 2, 0, candidate_id FROM governed WHERE kind = 'FOUND_MACHINE_CANDIDATE_ONLY' AND candidate_id IS NOT NULL
  UNION ALL SELECT g.request_id, 3, c.line_no, c.claim_id FROM governed g JOIN root_claims_t c USING (root_letters) WHERE g.kind = 'FOUND_MACHINE_CANDIDATE_ONLY'
  UNION ALL SELECT g.request_id, 4, o.line_no, o.origin_id FROM governed g JOIN (SELECT *, row_number() OVER (PARTITION BY root_letters ORDER BY line_no) AS rn
    FROM origin_rows) o USING (root_letters) WHERE g.kind = 'FOUND_MACHINE_CANDIDATE_ONLY' AND o.rn <= 3""")
sql("J4_governed_evidence_ids", "SELECT * FROM evidence_ids")
sql("J5_evidence_metadata", """SELECT e.request_id, e.evidence_id, g.root_letters, g.kind, 'MACHINE_SOURCE_CLAIM_CANDIDATE' AS evidence_status, g.review_state
  FROM evidence_ids e JOIN governed g USING (request_id)""")
_step = lambda n: f"SELECT DISTINCT root_letters, step, position, evidence_id FROM {n} JOIN governed USING (request_id)"
sql("J4_root_evidence_ids", _step("evidence_ids"))
cte("outcomes", f"""SELECT line_no, arg_max(granted_state, (reviewed_at, certificate_id)) AS reviewed_state, arg_max(certificate_id, (reviewed_at, certificate_id)) AS certificate_id,
  arg_max(reviewer_type, (reviewed_at, certificate_id)) <> 'MACHINE_ONLY' AS by_human FROM certs
  WHERE NOT (reviewer_type = 'MACHINE_ONLY' AND granted_state IN {lst(V.HUMAN_STATES)}) GROUP BY line_no""")
cte("root_reviews", """SELECT f.root_letters, o.reviewed_state, o.certificate_id FROM (SELECT root_letters, arg_min(line_no, line_no) AS line_no FROM imports WHERE NOT is_noise
  GROUP BY root_letters) f JOIN outcomes o USING (line_no) WHERE o.by_human""")
cte("verified", f"""SELECT g.* EXCLUDE (kind, review_state), CASE WHEN g.found AND NOT g.has_conflict AND k.new_kind IS NOT NULL THEN k.new_kind ELSE g.kind END AS kind,
  CASE WHEN g.found AND NOT g.has_conflict AND k.new_kind IS NOT NULL THEN k.reviewed_state ELSE g.review_state END AS review_state,
  CASE WHEN g.found AND NOT g.has_conflict AND k.new_kind IN ('FOUND_IDENTITY_VERIFIED', 'FOUND_TEXT_VERIFIED', 'FOUND_LEXICALLY_REVIEWED')
    THEN 'lex:root-identity-carrier:' || g.root_letters || ':' || k.certificate_id END AS carrier_id
  FROM governed g LEFT JOIN (SELECT *, {table('reviewed_state', REVIEWED, 'NULL')} AS new_kind FROM root_reviews) k USING (root_letters)""")
sql("J2_verified_lookup", "SELECT request_id, root_letters, kind, found, review_state, carrier_id FROM verified")
cte("verified_ids", f"""SELECT root_letters, 0 AS step, 0 AS position, 'lex:root:' || root_letters || ':bab:' || bab_letter AS evidence_id FROM verified
    WHERE found AND coalesce(bab_letter, '') <> ''
  UNION ALL SELECT g.root_letters, 1, 0, 'lex:root:' || g.root_letters || ':origin:' || f.t || ':count:' || f.c FROM verified g JOIN (
    SELECT root_letters, arg_min(origin_type, line_no) AS t, arg_min(CASE WHEN {_one} THEN '1' ELSE 'none' END, line_no) AS c FROM root_claims_t
    WHERE origin_type NOT IN {lst(V.NO_ORIGIN_TYPES)} GROUP BY root_letters) f USING (root_letters) WHERE g.kind = 'FOUND_MACHINE_CANDIDATE_ONLY'
  UNION ALL SELECT root_letters, 2, 0, candidate_id FROM verified WHERE kind IN {lst(CHAINED)} AND candidate_id IS NOT NULL
  UNION ALL SELECT root_letters, 2, 1, carrier_id FROM verified WHERE carrier_id IS NOT NULL
  UNION ALL SELECT g.root_letters, 3, c.line_no, c.claim_id FROM verified g JOIN root_claims_t c USING (root_letters) WHERE g.kind IN {lst(CHAINED)}
  UNION ALL SELECT g.root_letters, 4, o.line_no, o.origin_id FROM verified g JOIN (SELECT *, row_number() OVER (PARTITION BY root_letters ORDER BY line_no) AS rn
    FROM origin_rows) o USING (root_letters) WHERE g.kind IN {lst(CHAINED)} AND (g.kind <> 'FOUND_MACHINE_CANDIDATE_ONLY' OR o.rn <= 3)""")
sql("J4_verified_evidence_ids", "SELECT DISTINCT root_letters, CAST(step AS BIGINT) AS step, CAST(position AS BIGINT) AS position, evidence_id FROM verified_ids")
cte("licensed", f"SELECT *, {_refusal.replace('root ', 'root_letters ').replace('root =', 'root_letters =')} AS refusal FROM governed")
sql("J6_licensed_augmentation", """SELECT request_id, root_letters AS root, CASE WHEN refusal IS NULL THEN kind ELSE 'NOT_FOUND_IN_COVERED_VOLUME' END AS lookup_kind,
  'MACHINE_SOURCE_CLAIM_CANDIDATE' AS evidence_status, CASE WHEN refusal IS NULL THEN review_state ELSE 'UNREVIEWED' END AS review_state,
  refusal IS NULL AND found AS licensed, CASE WHEN refusal IS NOT NULL THEN 'NOT_LICENSED' WHEN coverage_gap THEN 'MISSING_VOLUME' WHEN found THEN 'COVERED'
    ELSE 'NOT_FOUND' END AS coverage_status, CASE WHEN refusal IS NOT NULL THEN refusal WHEN has_conflict THEN 'conflict' ELSE coverage_note END AS failure_detail,
  refusal IS NULL AS root_licensed, refusal IS NULL AND coalesce(claim_count, 0) > 0 AS source_candidate_found, false AS lexical_evidence_licensed FROM licensed""")
sql("J6_augmentation_ids", """SELECT request_id, 'passage' AS id_kind, passage_id AS id FROM licensed l JOIN root_claims_t USING (root_letters) WHERE refusal IS NULL
  UNION ALL SELECT request_id, 'residual', residual_id FROM licensed JOIN residuals USING (root_letters) WHERE refusal IS NULL
  UNION ALL SELECT request_id, 'trace', trace_id FROM licensed JOIN traces USING (root_letters) WHERE refusal IS NULL""")
_asked = "(SELECT DISTINCT root_letters FROM licensed WHERE refusal IS NULL)"
sql("J6_root_augmentation_ids", f"""SELECT root_letters, 'passage' AS id_kind, passage_id AS id FROM {_asked} JOIN root_claims_t USING (root_letters)
  UNION ALL SELECT root_letters, 'residual', residual_id FROM {_asked} JOIN residuals USING (root_letters)
  UNION ALL SELECT root_letters, 'trace', trace_id FROM {_asked} JOIN traces USING (root_letters)""")
_cnt = lambda t: f"(SELECT count(*) FROM {t} x WHERE x.root_letters = g.root_letters)"
sql("J7_lookup_explain", f"""SELECT request_id, root_letters, kind, 'MACHINE_SOURCE_CLAIM_CANDIDATE' AS evidence_status, review_state, found, is_machine_only, has_conflict,
  coverage_gap, (SELECT count(*) FROM evidence_ids e WHERE e.request_id = g.request_id) AS evidence_id_count,
  CASE WHEN found THEN {_cnt('residuals')} ELSE 0 END AS open_residuals, CASE WHEN found THEN coalesce(claim_count, 0) ELSE 0 END AS claims_count,
  CASE WHEN found THEN {_cnt('origin_rows')} ELSE 0 END AS origins_count,
  CASE WHEN found THEN coalesce((SELECT arg_min(array_to_string(flagged, ','), line_no) FROM candidates x WHERE x.root_letters = g.root_letters), '') ELSE '' END
  AS flagged_gates FROM governed g""")
sql("J7_catalog_explain", f"""SELECT request_id, lookup_root AS root, kind, review_status, bab_letter, correction_version,
  CAST(coalesce(len(string_split(source_pdfs, '|')), 0) AS BIGINT) AS source_pdf_count, CAST(len({_cat_ids}) AS BIGINT) AS evidence_id_count FROM lookups""")

# ------------------------------------------------------------------------- K
sql("K1_audit_source_to_identity", """SELECT 'TC-SI-01' AS contract, passage_id AS record_id, review_state AS reason FROM passages
  WHERE review_state NOT IN ('MACHINE_CANDIDATE', 'SOURCE_LOCATED')""")
sql("K2_audit_identity_licence", """SELECT * FROM (SELECT 'TC-II-02' AS contract, c.candidate_id AS record_id, CASE WHEN k.reviewer_type = 'MACHINE_ONLY' THEN
  'machine_reviewer' WHEN c.root_letters IN (SELECT root_letters FROM conflicts) THEN 'open_conflict' END AS reason
  FROM candidates c JOIN certs k USING (line_no)) WHERE reason IS NOT NULL""")
sql("K3_audit_identity_to_claim", """SELECT 'TC-IR-03' AS contract, candidate_id AS record_id, review_state AS reason FROM imports""")
sql("K4_audit_claim_to_origins", f"""SELECT 'TC-RO-04' AS contract, claim_id AS record_id, 'no_segmentation_needed' AS reason FROM root_claims_t
  WHERE origin_type NOT IN {lst(V.MULTI_TYPES)}""")
sql("K5_audit_origin_review", """SELECT * FROM (SELECT 'TC-OR-05' AS contract, o.origin_id AS record_id, CASE WHEN k.reviewer_type = 'MACHINE_ONLY' THEN
  'machine_reviewer' WHEN o.claim_id IN (SELECT claim_id FROM conflicts) THEN 'open_conflict' END AS reason FROM origin_rows o JOIN certs k USING (line_no))
  WHERE reason IS NOT NULL""")
sql("K6_audit_machine_ceiling", """SELECT * FROM (SELECT 'MACHINE-CEILING' AS contract, certificate_id AS record_id, CASE
  WHEN reviewer_type = 'MACHINE_ONLY' AND granted_state = 'LEXICALLY_REVIEWED' THEN 'human_state'
  WHEN line_no % 3 = 0 AND granted_state <> 'LEXICALLY_REVIEWED' THEN 'carrier_floor' END AS reason FROM certs) WHERE reason IS NOT NULL""")
sql("K7_audit_id_uniqueness", """SELECT id, count(*) AS n, min(k) AS first_kind, max(k) AS last_kind FROM (SELECT claim_id AS id, 'Claim' AS k FROM root_claims_t
  UNION ALL SELECT origin_id, 'Origin' FROM origin_rows UNION ALL SELECT candidate_id, 'Import' FROM imports
  UNION ALL SELECT candidate_id, 'Candidate' FROM candidates) GROUP BY id HAVING count(*) > 1""")
sql("K8_audit_domains", """SELECT 'DOMAIN' AS contract, candidate_id AS record_id, 'volume=' || v AS reason FROM (SELECT candidate_id,
  CAST(regexp_extract(source_pdf, '(\\d+)') AS BIGINT) AS v FROM imports) WHERE v NOT BETWEEN 1 AND 6
  UNION ALL SELECT 'DOMAIN', candidate_id, 'review_status=' || review_status FROM imports WHERE review_status NOT IN ('AUTO_AGREED', 'REVIEW_REQUIRED')""")
sql("K9_audit_orphans", """SELECT 'ORPHAN' AS contract, origin_id AS record_id, claim_id AS reason FROM origin_rows
  WHERE claim_id NOT IN (SELECT claim_id FROM root_claims_t WHERE contains(raw_claim_text, ' '))""")
_expected = table(norm("substr(root_letters, 1, 1)", INITIAL), P.CHAPTER_NAMES, "NULL")
cte("initial_audit", f"SELECT *, {_expected} AS expected FROM imports")
sql("K10_audit_chapter_initial", """SELECT 'CHAPTER-INITIAL' AS contract, candidate_id AS record_id, original_bab_letter || ' / ' || expected AS reason
  FROM initial_audit WHERE original_bab_letter <> '' AND expected IS NOT NULL AND original_bab_letter <> expected""")
_counters = {
    "passages_in_wrong_state": "SELECT 1 FROM passages WHERE review_state NOT IN ('MACHINE_CANDIDATE', 'SOURCE_LOCATED')",
    "identity_below_candidate": "SELECT 1 FROM candidates WHERE review_state <> 'IDENTITY_CANDIDATE'",
    "segmentation_not_due": f"SELECT 1 FROM root_claims_t WHERE origin_type NOT IN {lst(V.MULTI_TYPES)}",
    "import_mapping": "SELECT 1 FROM imports WHERE review_status = 'AUTO_AGREED' AND review_state <> 'MACHINE_CANDIDATE'",
    "orphan_origins": "SELECT 1 FROM origin_rows WHERE claim_id NOT IN (SELECT claim_id FROM root_claims_t)",
    "chapter_initial": "SELECT 1 FROM initial_audit WHERE bab_letter <> '' AND expected IS NOT NULL AND bab_letter <> expected",
    "none_as_negative": "SELECT 1 FROM root_claims_t WHERE origin_type = 'NONE' AND claim_kind = 'NEGATIVE_CLAIM'",
    "origin_from_unextracted": f"SELECT 1 FROM origin_rows WHERE origin_type IN {lst(V.NO_ORIGIN_TYPES)}",
    "claim_text_is_root": "SELECT 1 FROM root_claims_t WHERE raw_claim_text <> '' AND raw_claim_text = root_letters",
    "multiple_forced": "SELECT 1 FROM origin_rows WHERE origin_type = 'MULTIPLE'",
    "duplicate_ids": "SELECT 1 FROM (SELECT claim_id AS id FROM root_claims_t UNION ALL SELECT origin_id FROM origin_rows UNION ALL SELECT candidate_id FROM candidates) GROUP BY id HAVING count(*) > 1"}
sql("K11_audit_counters", " UNION ALL ".join(f"SELECT {s(k)} AS counter, (SELECT count(*) FROM ({v})) AS value" for k, v in _counters.items()))
sql("K12_review_apply", """SELECT c.candidate_id, c.review_state, coalesce(k.granted_state, c.review_state) AS effective_state, k.certificate_id, k.reviewer_type
  FROM candidates c LEFT JOIN certs k USING (line_no)""")

# ------------------------------------------------------------------------- L
def body_cte(name: str, footnotes: bool) -> None:
    extra = f""" UNION ALL SELECT entry_id, 1 AS grp, pos, best FROM (SELECT e.entry_id, l.pos, l.raw_ocr, {_best} AS best FROM root_entries e
      JOIN scan_lines l ON e.doc_id = l.doc_id) WHERE {has('raw_ocr', FOOTNOTE)} AND NOT {has('raw_ocr', POETRY)}""" if footnotes else ""
    fix = f"replace(string_agg(best, ' ' ORDER BY grp, pos) FILTER (best <> ''), {s(D.ocr_fix[0])}, {s(D.ocr_fix[1])})"
    cte(name, f"""SELECT e.entry_id, coalesce(b.body, '') AS body FROM root_entries e LEFT JOIN (SELECT entry_id, {fix} AS body FROM (
      SELECT entry_id, 0 AS grp, pos, best FROM (SELECT e.entry_id, l.pos, l.raw_ocr, {_best} AS best FROM root_entries e
        JOIN scan_lines l ON e.doc_id = l.doc_id) WHERE NOT {has('raw_ocr', POETRY)}{extra}) GROUP BY entry_id) b USING (entry_id)""")


body_cte("bodies", False)
body_cte("bodies_notes", True)
sql("L1_resolve_body", "SELECT * FROM bodies")
sql("L1_resolve_body_with_footnotes", "SELECT * FROM bodies_notes")
sql("L2_entry_text", f"""SELECT entry_id, concat_ws(chr(10), nullif({strip('heading')}, ''), nullif(body, '')) AS entry_text
  FROM root_entries JOIN bodies USING (entry_id)""")
sql("L3_poetry_texts", f"""SELECT entry_id, row_number() OVER (PARTITION BY entry_id ORDER BY pos) - 1 AS pos, best AS line_text FROM (
  SELECT e.entry_id, l.pos, l.raw_ocr, {_best} AS best FROM root_entries e JOIN scan_lines l ON e.doc_id = l.doc_id) WHERE {has('raw_ocr', POETRY)}""")
_by = {m.name: m for m in D.markers}
_split = "(" + "|".join(_by[k].pattern for k in D.split_order) + ")"
_mtype = label("raw_marker", [(m.pattern, m.segment_type) for m in D.markers], "CONTINUATION")
cte("pieces", f"""SELECT entry_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (SELECT entry_id, list_filter(string_split(
  regexp_replace(body, {s(_split)}, chr(1) || chr(2) || '\\1' || chr(1), 'g'), chr(1)), lambda x: {strip("ltrim(x, chr(2))")} <> '') AS p FROM bodies)""")
cte("segs", f"""SELECT *, CASE WHEN pos >= min(CASE WHEN segment_type = 'SECOND_ORIG' THEN pos END) OVER (PARTITION BY entry_id) THEN 1 ELSE 0 END AS origin_index FROM (
  SELECT entry_id, row_number() OVER (PARTITION BY entry_id ORDER BY i) - 1 AS pos, {strip('raw_marker')} AS marker, {strip('piece')} AS text,
    CASE WHEN raw_marker = '' THEN 'CONTINUATION' ELSE {_mtype} END AS segment_type FROM (
    SELECT *, CASE WHEN starts_with(prev, chr(2)) THEN substr(prev, 2) ELSE '' END AS raw_marker FROM (
      SELECT *, lag(piece) OVER (PARTITION BY entry_id ORDER BY i) AS prev FROM pieces))
  WHERE NOT starts_with(piece, chr(2)) AND length({strip('piece')}) >= 3)""")
sql("L4_segment_body", "SELECT entry_id, pos, segment_type, marker, text, CAST(origin_index AS BIGINT) AS origin_index FROM segs")
sql("L5_marker_types", "SELECT segment_type, marker, count(*) AS n FROM segs GROUP BY ALL")
_hits = []
for _i, _r in enumerate(D.claim_rules):
    _c = f"segment_type = {s(_r.segment_type)} AND {has('f', _r.pattern)}"
    _hits.append(f"WHEN {_c}" + (f" AND contains(f, {s(_r.requires)})" if _r.requires else "") + f" THEN {_i}")
cte("claim_rule", f"SELECT *, CASE {' '.join(_hits)} END AS rule FROM (SELECT *, marker || ' ' || text AS f FROM segs)")


def by_rule(value, default: str) -> str:
    out = [f"WHEN {i} THEN {v}" for i, r in enumerate(D.claim_rules) if (v := value(r)) is not None]
    return f"CASE rule {' '.join(out)} ELSE {default} END"


def _definition(r):
    if not r.definition_group:
        return None
    x = strip(grab("f", r.pattern, r.definition_group))
    return f"substr({x}, 1, {r.definition_limit})" if r.definition_limit else x


def _authority(r):
    if r.authority is None:
        return None
    if isinstance(r.authority, str):
        return s(r.authority)
    name = f"regexp_replace({strip(grab('f', r.pattern, r.authority))}, {s(D.authority_trail)}, '')"
    return f"array_to_string(list_slice(regexp_split_to_array({name}, '\\s+'), 1, 3), ' ')"


_fallback = table("segment_type", DEFAULT_CLAIM, "'RAW_SEGMENT'")


def _id(prefix: str, *parts: str) -> str:
    key = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"{s(prefix + ':')} || substr(sha256({key}), 1, 32)"


cte("claim_rows", f"""SELECT entry_id, pos, segment_type, marker, text AS raw_text, origin_index, {by_rule(lambda r: s(r.claim_type), _fallback)} AS claim_type,
  {by_rule(lambda r: strip(grab('f', r.pattern, r.term_group)) if r.term_group else None, 'NULL')} AS term,
  {by_rule(_definition, "CASE WHEN segment_type = 'HADITH' THEN substr(text, 1, 200) END")} AS definition,
  {by_rule(_authority, 'NULL')} AS authority, {_id('CLM', 'entry_id', 'pos')} AS claim_id FROM claim_rule""")
sql("L6_extract_claims", """SELECT entry_id, pos, claim_type, term, definition, authority, CAST(origin_index AS BIGINT) AS origin_index FROM claim_rows""")
sql("L7_origin_index", """SELECT entry_id, count_if(origin_index = 0) AS first_origin, count_if(origin_index = 1) AS second_origin FROM segs GROUP BY entry_id""")


def ordered(value: str, cond: str) -> str:
    return f"coalesce(string_agg({value}, '|' ORDER BY pos) FILTER ({cond} AND coalesce({value}, '') <> ''), '')"


cte("first_authorities", """SELECT entry_id, string_agg(authority, '|' ORDER BY f) AS authorities FROM (SELECT entry_id, authority, min(pos) AS f FROM claim_rows
  WHERE claim_type = 'AUTHORITY_CITATION' AND coalesce(authority, '') <> '' GROUP BY ALL) GROUP BY entry_id""")
cte("type_counts", """SELECT entry_id, string_agg(claim_type || '=' || n, ',' ORDER BY claim_type) AS by_type FROM (SELECT entry_id, claim_type, count(*) AS n
  FROM claim_rows GROUP BY ALL) GROUP BY entry_id""")
sql("L8_claims_summary", f"""SELECT c.entry_id, count(*) AS total, any_value(t.by_type) AS by_type, {ordered('term', f'claim_type IN {lst(USAGE)}')} AS usage_terms,
  {ordered('term', "claim_type = 'PLURAL_FORM'")} AS plural_forms, coalesce(any_value(a.authorities), '') AS authorities,
  {ordered('definition', "claim_type = 'HADITH_EVIDENCE'")} AS hadiths, {ordered('definition', "starts_with(claim_type, 'ETYMOLOGY')")} AS etymology,
  bool_or(claim_type = 'ORIGIN_BOUNDARY') AS dual_entry FROM claim_rows c JOIN type_counts t USING (entry_id)
  LEFT JOIN first_authorities a USING (entry_id) GROUP BY c.entry_id""")
_nlines = "len(string_split(text, chr(10)))"
_count_lines = lambda p: f"CAST(len(list_filter(string_split(text, chr(10)), lambda x: {has('x', p)})) AS BIGINT)"
sql("L9_entry_summary", f"""SELECT e.entry_id, root_letters, CAST({_nlines} AS BIGINT) AS body_line_count, {_count_lines(POETRY)} AS poetry_excluded,
  {_count_lines(FOOTNOTE)} AS footnote_count, coalesce(g.n, 0) AS segments, coalesce(g.kinds, '') AS segment_types, b.body <> '' AS body_resolved
  FROM root_entries e JOIN bodies b USING (entry_id) LEFT JOIN (SELECT entry_id, count(*) AS n, string_agg(DISTINCT segment_type, ',' ORDER BY segment_type) AS kinds
    FROM segs GROUP BY entry_id) g USING (entry_id)""")
cte("claim_nodes", f"""SELECT *, CASE WHEN claim_type = 'AUTHORITY_CITATION' THEN 'REPORTED' WHEN claim_type IN {lst(ETYMOLOGY)} AND {has('raw_text', D.hedge)}
  THEN 'PROBABLE' WHEN claim_type = 'EXCEPTION_NOTE' THEN 'REPORTED' WHEN claim_type IN ('RAW_SEGMENT', 'ORIGIN_BOUNDARY') THEN 'UNKNOWN' ELSE 'ASSERTED' END
  AS assertion_strength, CASE WHEN claim_type = 'AUTHORITY_CITATION' THEN 'REPORTED_ONLY' ELSE 'ADOPTED' END AS author_position,
  CASE WHEN claim_type = 'AUTHORITY_CITATION' AND contains(authority, {s(D.anonymous)}) THEN 'ARABS_GENERAL'
   WHEN claim_type = 'AUTHORITY_CITATION' AND authority <> '' THEN 'QUOTED_SCHOLAR' WHEN claim_type = 'AUTHORITY_CITATION' THEN 'UNKNOWN'
   WHEN claim_type = 'HADITH_EVIDENCE' THEN 'QUOTED_SCHOLAR' WHEN marker IN {lst(D.self_markers)} OR segment_type IN
   ('USAGE', 'ETYMOLOGY', 'BRANCH', 'EXCEPTION', 'PLURAL', 'INTRO') THEN 'IBN_FARIS' ELSE 'UNKNOWN' END AS claim_attribution FROM claim_rows""")
sql("L10_claim_nodes", "SELECT claim_id, entry_id, claim_type, assertion_strength, author_position, claim_attribution FROM claim_nodes")


def node_sql(value: str, prefix: str) -> str:
    return f"""SELECT {_id(prefix, 'entry_id', 'norm')} AS node_id, entry_id, arg_min({value}, pos) AS surface, norm FROM (
      SELECT *, {norm(value, D.term_profile)} AS norm FROM claim_rows WHERE coalesce({value}, '') <> '') GROUP BY entry_id, norm"""


cte("term_nodes", node_sql("term", "TRM"))
sql("L11_term_nodes", "SELECT * FROM term_nodes")
sql("L12_authority_nodes", node_sql("authority", "AUTH"))
_isev = "(claim_type = 'HADITH_EVIDENCE' OR (claim_type = 'AUTHORITY_CITATION' AND claim_attribution IN ('QUOTED_SCHOLAR', 'ARABS_GENERAL')))"
_usage = f"CASE WHEN claim_type = 'HADITH_EVIDENCE' THEN 'HADITH' ELSE {label('raw_text', D.usage_cues, 'ARAB_SPEECH')} END"
_strength = f"CASE WHEN {_usage} IN ('QURANIC', 'HADITH') THEN 'DIRECT' ELSE 'SUPPORTING' END"
sql("L13_evidence_nodes", f"""SELECT {_id('EV', 'entry_id', 'pos')} AS node_id, entry_id, claim_id,
  substr(CASE WHEN coalesce(definition, '') <> '' THEN definition ELSE raw_text END, 1, 300) AS text, {_usage} AS usage_type,
  CASE WHEN claim_type = 'HADITH_EVIDENCE' THEN 'DEMONSTRATES_USAGE' ELSE 'DEMONSTRATES_SENSE' END AS witness_function,
  {has('raw_text', D.poetry_cue)} AS is_embedded_poetry, {_strength} AS evidence_strength FROM claim_nodes WHERE {_isev}""")
sql("L14_claim_edges", f"""SELECT entry_id, 'CLAIM_ABOUT' AS edge_type, claim_id AS source_id, {_id('TRM', 'entry_id', norm('term', D.term_profile))} AS target_id, '' AS strength
  FROM claim_nodes WHERE coalesce(term, '') <> '' UNION ALL
  SELECT entry_id, 'ATTRIBUTED_TO', claim_id, {_id('AUTH', 'entry_id', norm('authority', D.term_profile))}, '' FROM claim_nodes WHERE coalesce(authority, '') <> '' UNION ALL
  SELECT entry_id, 'ELABORATES', claim_id, {_id('CLM', 'entry_id', 'pos - 1')}, '' FROM claim_nodes WHERE claim_type = 'RAW_SEGMENT' AND segment_type = 'CONTINUATION' AND pos > 0
  UNION ALL SELECT entry_id, 'SUPPORTED_BY', {_id('EV', 'entry_id', 'pos')}, claim_id, {_strength} FROM claim_nodes WHERE {_isev}""")
sql("L15_claims_by_type", """SELECT claim_type, count(*) AS claims, count_if(coalesce(term, '') <> '') AS with_term,
  count_if(coalesce(definition, '') <> '') AS with_definition FROM claim_rows GROUP BY claim_type""")

# ------------------------------------------------------------------------- M
_conf = "list_filter([" + ", ".join(
    f"CASE WHEN contains(raw_ocr, {s(a)}) AND NOT contains(corrected_ocr, {s(a)}) THEN {s(chr(39) + a + chr(39) + '→' + chr(39) + b + chr(39))} END"
    for a, b in D.confusions) + "], lambda x: x IS NOT NULL)"
_bestraw = "CASE WHEN coalesce(human_text, '') <> '' THEN human_text WHEN corrected_ocr <> '' THEN corrected_ocr ELSE raw_ocr END"
_agg = lambda v: f"coalesce(string_agg({v}, ' ' ORDER BY pos) FILTER (coalesce({v}, '') <> ''), '')"
cte("body_lines", f"SELECT e.entry_id, l.*, {_bestraw} AS shown FROM root_entries e JOIN scan_lines l ON e.doc_id = l.doc_id WHERE NOT {has('raw_ocr', POETRY)}")
cte("evidence_agg", f"""SELECT entry_id, count(*) AS lines_found, {_agg('raw_ocr')} AS raw_text, {_agg('corrected_ocr')} AS fixed_text, {_agg('human_text')} AS human_all,
  coalesce(string_agg(shown, ' ' ORDER BY pos) FILTER ({strip('shown')} <> ''), '') AS body_text, avg(CAST(confidence AS DECIMAL(18, 9))) AS ocr_confidence,
  CAST(sum(length(raw_ocr) - length(replace(raw_ocr, chr(65533), ''))) AS BIGINT) AS repl, CAST(min(pos * 10.0) AS DOUBLE) AS y,
  CAST(max(length(raw_ocr)) AS DOUBLE) AS w, CAST(max(pos * 10.0 + 9.0) - min(pos * 10.0) AS DOUBLE) AS h FROM body_lines GROUP BY entry_id""")
cte("evidence_t", """SELECT e.entry_id, e.source_pdf, e.pdf_page, coalesce(lines_found, 0) AS lines_found, coalesce(raw_text, '') AS raw_text, coalesce(fixed_text, '') AS fixed_text,
  coalesce(human_all, '') AS human_all, coalesce(body_text, '') AS body_text, coalesce(CAST(ocr_confidence AS DOUBLE), 0.0) AS ocr_confidence, coalesce(repl, 0) AS repl, y, w, h
  FROM root_entries e LEFT JOIN evidence_agg USING (entry_id)""")
sql("M1_source_evidence", """SELECT entry_id, CAST(regexp_extract(source_pdf, '(\\d+)') AS BIGINT) AS volume_number, pdf_page, lines_found, md5(raw_text) AS raw_md5,
  md5(fixed_text) AS fixed_md5, md5(human_all) AS human_md5, substr(sha256(coalesce(nullif(human_all, ''), nullif(fixed_text, ''), nullif(raw_text, ''), '')), 1, 16)
  AS passage_checksum FROM evidence_t""")
sql("M2_ocr_confidence_mean", "SELECT entry_id, round(ocr_confidence, 6) AS ocr_confidence FROM evidence_t")
sql("M3_bbox_union", "SELECT entry_id, CASE WHEN y IS NOT NULL THEN CAST(0.0 AS DOUBLE) END AS x, y, w, h FROM evidence_t")
sql("M4_replacement_characters", "SELECT entry_id, repl AS replacement_characters FROM evidence_t")
sql("M5_confusion_detection", f"""SELECT e.entry_id, coalesce(c.confusions, '') AS confusions FROM root_entries e LEFT JOIN (
  SELECT entry_id, string_agg(x, '|' ORDER BY p, k) AS confusions FROM (SELECT entry_id, x, min(pos) AS p, arg_min(k, pos) AS k FROM (
    SELECT entry_id, pos, unnest({_conf}) AS x, generate_subscripts({_conf}, 1) AS k FROM body_lines) GROUP BY entry_id, x) GROUP BY entry_id) c USING (entry_id)""")
sql("M6_coverage_state", """SELECT entry_id, CASE WHEN body_text = '' THEN 'UNREADABLE_PAGE' ELSE 'COVERED' END AS coverage_state,
  CASE WHEN human_all <> '' THEN 'HUMAN_CORRECTED' ELSE 'TEXT_CANDIDATE' END AS text_review_state FROM evidence_t""")
_bare = "regexp_replace(heading, '[()،\\s]', '', 'g')"
_xref = has("heading", D.xref_phrase)
cte("bundles_1", f"""SELECT c.*, v.body_text, v.ocr_confidence, v.human_all, c.semantic_origin_type AS olabel, CASE WHEN semantic_origin_type = 'CHAPTER_HEADER' THEN 'CHAPTER_HEADER'
  WHEN semantic_origin_type = 'CROSS_REFERENCE' THEN 'CROSS_REFERENCE' WHEN semantic_origin_type = 'NOT_ROOT' THEN 'NOT_ROOT'
  WHEN semantic_origin_type = 'NONE' AND length({_bare}) <= 2 AND {has(_bare, '^[' + D.script_class + ']+$')} THEN 'CHAPTER_HEADER'
  WHEN semantic_origin_type = 'NONE' AND {_xref} THEN 'CROSS_REFERENCE' WHEN semantic_origin_type = 'NONE' THEN 'UNCERTAIN'
  WHEN semantic_origin_type IN {lst(V.POSITIVE_TYPES)} THEN 'ROOT_ENTRY' ELSE 'UNCERTAIN' END AS heading_type,
  CASE WHEN semantic_origin_type IN ('CROSS_REFERENCE', 'CHAPTER_HEADER') THEN 'CROSS_REFERENCE' WHEN semantic_origin_type = 'NOT_ROOT' THEN 'NEGATIVE_CLAIM'
  WHEN semantic_origin_type = 'NONE' AND {_xref} THEN 'CROSS_REFERENCE' WHEN semantic_origin_type = 'NONE' THEN 'INCOMPLETE_CLAIM' ELSE 'POSITIVE_ORIGIN' END AS claim_kind,
  CASE WHEN bab_letter = corrected_bab_letter THEN 'EXACT' WHEN corrected_bab_letter <> '' THEN 'NORMALIZED_MATCH' ELSE 'EXACT' END AS root_identity_match
  FROM corrected c JOIN evidence_t v USING (entry_id)""")
cte("bundles_2", f"""SELECT *, CASE heading_type WHEN 'CHAPTER_HEADER' THEN 'OCR_NOISE' WHEN 'CROSS_REFERENCE' THEN 'CROSS_REFERENCE' WHEN 'NOT_ROOT' THEN 'NEGATIVE_ENTRY'
  WHEN 'UNCERTAIN' THEN CASE WHEN {strip('body_text')} = '' THEN 'OCR_NOISE' ELSE 'SUBENTRY' END ELSE 'ROOT_ENTRY' END AS entry_kind FROM bundles_1""")
_cue = f"CASE WHEN semantic_origin_text IS NULL THEN 'UNKNOWN' ELSE {label('semantic_origin_text', D.strength_cues, 'ASSERTED')} END"
cte("bundles", f"""SELECT *, entry_kind IN ('ROOT_ENTRY', 'CROSS_REFERENCE', 'NEGATIVE_ENTRY') AS has_source_claim, list_filter([
  CASE WHEN entry_kind IN ('ROOT_ENTRY', 'NEGATIVE_ENTRY') AND {strip('body_text')} = '' THEN 'MISSING_SOURCE_PASSAGE' END,
  CASE WHEN human_all = '' AND ocr_confidence < 0.60 THEN 'TEXT_VERIFICATION_FAILED' END,
  CASE WHEN entry_id IN (SELECT entry_id FROM conflicted) THEN 'INTER_ENTRY_CONFLICT' END], lambda x: x IS NOT NULL) AS residuals FROM bundles_2""")
sql("M8_entry_labels", f"""SELECT entry_id, heading_type, claim_kind, entry_kind, CASE WHEN has_source_claim THEN CASE WHEN olabel IN {lst(V.POSITIVE_TYPES)} THEN olabel
  WHEN olabel IN ('NONE', 'NOT_ROOT', 'CHAPTER_HEADER', 'CROSS_REFERENCE') THEN 'NOT_EXTRACTED' ELSE 'UNKNOWN' END END AS origin_type FROM bundles""")
sql("M9_root_identity_match", """SELECT entry_id, root_identity_match, CASE root_identity_match WHEN 'EXACT' THEN CAST(1.0 AS DOUBLE) ELSE 0.9 END AS match_confidence,
  CAST(nullif(length(regexp_replace(root_letters, '[^\\p{L}]', '', 'g')), 0) AS BIGINT) AS letter_count FROM bundles""")
sql("M10_source_claims", f"""SELECT entry_id, CASE claim_kind WHEN 'NEGATIVE_CLAIM' THEN 'NEGATIVE' WHEN 'CROSS_REFERENCE' THEN 'UNCERTAIN' ELSE 'POSITIVE' END AS polarity,
  CASE claim_kind WHEN 'NEGATIVE_CLAIM' THEN 'REJECTED' ELSE 'ADOPTED' END AS author_position, {_cue} AS assertion_strength,
  origin_count IS NOT NULL AS origin_count_explicit FROM bundles WHERE has_source_claim""")
sql("M11_entry_residuals", f"SELECT entry_id, {cols('residuals')} AS residuals, len(residuals) = 0 AS ontology_buildable FROM bundles")
sql("M12_root_knowledge", f"""SELECT root_letters, arg_min(entry_id, line_no) AS primary_entry_id, count(*) - 1 AS secondary_entries, CASE WHEN count(*) > 1 AND
  count(DISTINCT CASE WHEN olabel NOT IN {lst(V.NOISE_TYPES)} THEN olabel END) > 1 THEN 'CONFLICTING_MULTI' WHEN count(*) > 1 THEN 'CONSISTENT_MULTI'
  ELSE 'SINGLE_SOURCE' END AS aggregation_state FROM bundles GROUP BY root_letters""")
sql("M12_root_members", """SELECT root_letters, entry_id, line_no = min(line_no) OVER (PARTITION BY root_letters) AS is_primary FROM bundles""")

# ------------------------------------------------------------------------- N
cte("boundary", "SELECT entry_id, bool_or(segment_type = 'SECOND_ORIG') AS dual FROM segs GROUP BY entry_id")
_parts = (f"CASE WHEN coalesce(dual, false) AND contains(t, {s(D.boundary_probe)}) THEN CASE WHEN {has('t', D.boundary_split)} THEN "
          f"[regexp_extract(t, {s('^([\\s\\S]*?)' + D.boundary_split)}, 1), regexp_extract(t, {s('^[\\s\\S]*?' + D.boundary_split + '([\\s\\S]*)$')}, 1)] ELSE [t] END "
          "WHEN coalesce(dual, false) THEN [t, ''] ELSE [t] END")
cte("origin_parts", f"""SELECT entry_id, olabel, unnest(p) AS part, CAST(generate_subscripts(p, 1) - 1 AS BIGINT) AS origin_index FROM (SELECT *, {_parts} AS p FROM (
  SELECT e.entry_id, e.semantic_origin_type AS olabel, e.semantic_origin_text AS t, b.dual FROM root_entries e LEFT JOIN boundary b USING (entry_id)
  WHERE coalesce(e.semantic_origin_text, '') <> '' AND e.semantic_origin_type NOT IN {lst(V.NOISE_TYPES)}))""")
_clean_part = strip("part")
_explicit = "coalesce(" + ", ".join(f"nullif({grab(_clean_part, p)}, '')" for p in D.nucleus_rules) + ")"
_words = f"nullif(array_to_string(list_slice(regexp_split_to_array({strip(grab(_clean_part, D.first_words))}, '\\s+'), 1, 3), ' '), '')"
cte("origin_nuclei", f"""SELECT *, coalesce(ex, wo) AS semantic_nucleus, CASE WHEN ex IS NOT NULL THEN 'SOURCE_EXPLICIT' WHEN wo IS NOT NULL THEN 'MACHINE_SUMMARIZED'
  ELSE 'NOT_EXTRACTABLE' END AS gloss_method FROM (SELECT *, {strip(_explicit)} AS ex, {_words} AS wo FROM origin_parts)""")
_comb = "(coalesce(semantic_nucleus, '') || ' ' || part)"
cte("origin_t", f"""SELECT *, {label(_comb, D.semantic_kinds, 'UNKNOWN')} AS semantic_kind, {label(_comb, D.abstraction, 'UNKNOWN')} AS abstraction_level,
  {label('part', D.temporal, 'UNKNOWN')} AS temporal_profile, {_id('ORI', 'entry_id', 'origin_index')} AS origin_id FROM origin_nuclei""")
sql("N1_semantic_nucleus", "SELECT entry_id, origin_index, semantic_nucleus, gloss_method FROM origin_t")
sql("N2_origins", f"""SELECT origin_id, entry_id, origin_index, CASE WHEN olabel IN {lst(V.POSITIVE_TYPES)} THEN olabel ELSE 'UNKNOWN' END AS origin_type,
  nullif(part, '') AS raw_origin_text, nullif({norm('part', D.origin_profile)}, '') AS normalized_origin_text FROM origin_t""")
sql("N3_origin_labels", "SELECT entry_id, origin_index, semantic_kind, abstraction_level, temporal_profile FROM origin_t")
cte("last_origin", "SELECT entry_id, max(origin_index) AS last_index FROM origin_t GROUP BY entry_id")
_linked = "CASE WHEN last_index IS NULL THEN NULL WHEN origin_index <= last_index THEN origin_index ELSE 0 END"
_origin_ref = f"CASE WHEN last_index IS NOT NULL THEN {_id('ORI', 'entry_id', _linked)} END"
cte("branch_t", f"""SELECT *, {_id('BR', 'entry_id', 'pos')} AS branch_id, CAST(row_number() OVER (PARTITION BY entry_id, origin_index ORDER BY pos) - 1 AS BIGINT) AS branch_index,
  {label('gloss', D.relations, None)} AS stated FROM (SELECT c.entry_id, c.pos, CAST(c.origin_index AS BIGINT) AS origin_index, {_origin_ref.replace('entry_id', 'c.entry_id').replace('origin_index', 'c.origin_index')} AS origin_id,
  substr({strip("CASE WHEN coalesce(definition, '') <> '' THEN definition ELSE raw_text END")}, 1, 200) AS gloss, nullif({strip('term')}, '') AS form
  FROM claim_rows c LEFT JOIN last_origin l ON c.entry_id = l.entry_id WHERE claim_type = 'BRANCH_ITEM')""")
sql("N6_branches", f"""SELECT branch_id, entry_id, origin_id, origin_index, branch_index, form AS source_form,
  nullif({norm('form', D.origin_profile)}, '') AS normalized_form, gloss, coalesce(stated, 'DIRECT_INSTANCE') AS relation,
  CASE WHEN stated IS NOT NULL THEN 'STRONGLY_IMPLIED' ELSE 'SYSTEM_INFERRED' END AS explicitness, {label('gloss', D.distances, 'NEAR')} AS distance,
  {label('gloss', D.domains, 'GENERAL_LANGUAGE')} AS domain FROM branch_t""")
cte("exception_t", f"""SELECT {_id('EXN', 'c.entry_id', 'pos')} AS node_id, c.entry_id, pos, CAST(c.origin_index AS BIGINT) AS origin_index,
  {_origin_ref.replace('entry_id', 'c.entry_id').replace('origin_index', 'c.origin_index')} AS origin_id, raw_text
  FROM claim_rows c LEFT JOIN last_origin l ON c.entry_id = l.entry_id WHERE claim_type = 'EXCEPTION_NOTE'""")
sql("N7_exceptions", "SELECT * FROM exception_t")
cte("xref_t", f"""SELECT {_id('XRN', 'entry_id', 'pos')} AS node_id, entry_id, {norm(f"nullif({grab('raw_text', D.xref_target)}, '')", D.origin_profile)} AS target
  FROM claim_rows WHERE claim_type = 'ORIGIN_BOUNDARY'""")
sql("N8_cross_refs", "SELECT * FROM xref_t")
sql("N9_origin_edges", f"""SELECT entry_id, 'SECOND_ORIGIN_OF' AS edge_type, origin_id AS source_id, {_id('ORI', 'entry_id', '0')} AS target_id, '' AS meta FROM origin_t WHERE origin_index = 1
  UNION ALL SELECT entry_id, 'BRANCHES_FROM', branch_id, origin_id, coalesce(stated, 'DIRECT_INSTANCE') FROM branch_t WHERE origin_id IS NOT NULL
  UNION ALL SELECT entry_id, 'IS_EXCEPTION_OF', node_id, origin_id, '' FROM exception_t WHERE origin_id IS NOT NULL
  UNION ALL SELECT entry_id, 'CROSS_REFERENCES', node_id, 'ENTRY_REF:' || target, 'true' FROM xref_t WHERE target IS NOT NULL""")
cte("root_hits", f"""SELECT k, arg_min(entry_id, line_no) AS hit FROM (SELECT {root_norm('root_letters')} AS k, entry_id, line_no FROM root_entries) WHERE k <> '' GROUP BY k""")
cte("resolved", f"""SELECT x.node_id, x.entry_id, x.target, coalesce(a.k, b.k) AS target_root, CASE WHEN a.k IS NOT NULL THEN a.hit ELSE b.hit END AS target_entry_id,
  coalesce(a.k, b.k) IS NOT NULL AS resolved FROM xref_t x LEFT JOIN root_hits a ON a.k = {root_norm('x.target')}
  LEFT JOIN root_hits b ON b.k = {root_norm("string_split(x.target, ' ')[1]")}""")
sql("N9_resolved_cross_refs", "SELECT * FROM resolved")
cte("ref_edges", f"""SELECT x.entry_id, {root_norm('e.root_letters')} AS src, x.target_root AS dst FROM resolved x JOIN root_entries e USING (entry_id)
  WHERE x.resolved AND {root_norm('e.root_letters')} <> ''""")
cte("ref_pairs", "SELECT DISTINCT src, dst FROM ref_edges")
cte("ref_reach", "SELECT src, dst FROM ref_pairs UNION SELECT r.src, p.dst FROM ref_reach r JOIN ref_pairs p ON r.dst = p.src")
cte("ref_cycles", "SELECT p.src, p.dst FROM ref_pairs p JOIN ref_reach r ON r.src = p.dst AND r.dst = p.src")
cte("conflicted", "SELECT DISTINCT e.entry_id FROM ref_edges e JOIN ref_cycles c ON e.src = c.src AND e.dst = c.dst")
sql("N10_cycle_check", "SELECT * FROM ref_cycles")
sql("N10_entry_conflicts", "SELECT entry_id, 'INTER_ENTRY_CONFLICT' AS residual FROM conflicted")
sql("N11_nucleus_residuals", """SELECT DISTINCT entry_id, 'NUCLEUS_NOT_EXTRACTABLE' AS residual FROM origin_t WHERE semantic_nucleus IS NULL""")

# ------------------------------------------------------------------------- O
cte("gate_t", """SELECT entry_id, CASE WHEN reason IS NULL THEN 'BUILT' ELSE 'BLOCKED' END AS status, reason FROM (SELECT entry_id,
  CASE WHEN len(residuals) > 0 THEN 'blocking residual present — human review required' WHEN entry_kind = 'OCR_NOISE' THEN 'noise entry'
  WHEN entry_id NOT IN (SELECT entry_id FROM origin_t) THEN 'no origins' END AS reason FROM bundles)""")
sql("O1_ontology_gate", "SELECT * FROM gate_t")
cte("concept_t", f"""SELECT 'CC:' || substr(o.origin_id, 5, 32) AS concept_id, o.*, b.claim_kind, b.semantic_origin_text AS claim_text, b.has_source_claim,
  {table('o.semantic_kind', V.UPPER_KINDS, "'UNKNOWN'")} AS upper_kind FROM origin_t o JOIN gate_t g USING (entry_id) JOIN bundles b USING (entry_id) WHERE g.status = 'BUILT'""")
sql("O2_concepts", """SELECT concept_id, entry_id, origin_index, 'ONTOLOGY_CANDIDATE_ONLY' AS notice, semantic_nucleus AS preferred_label, '' AS alternative_labels,
  nullif(substr(part, 1, 300), '') AS definition, upper_kind FROM concept_t""")
sql("O3_genus", """SELECT concept_id, semantic_nucleus AS concept_ref, CAST(CASE WHEN semantic_nucleus IS NULL THEN NULL WHEN gloss_method = 'SOURCE_EXPLICIT' THEN 0.7 ELSE 0.4 END AS DOUBLE)
  AS confidence, CASE WHEN semantic_nucleus IS NULL THEN NULL WHEN gloss_method = 'SOURCE_EXPLICIT' THEN 'EXPLICIT' ELSE 'INFERRED' END AS explicitness FROM concept_t""")
cte("concept_branches", "SELECT c.concept_id, b.pos, coalesce(b.stated, 'DIRECT_INSTANCE') AS relation, b.gloss FROM concept_t c JOIN branch_t b USING (entry_id, origin_index)")
_bsum = lambda cond, val: f"(SELECT string_agg({val}, '|' ORDER BY pos) FROM concept_branches b WHERE b.concept_id = c.concept_id AND {cond})"
_bcount = lambda cond: f"(SELECT count(*) FROM concept_branches b WHERE b.concept_id = c.concept_id AND {cond})"
sql("O4_concept_features", f"""SELECT concept_id, coalesce({_bsum(f"relation IN {lst(V.NAMING_RELATIONS)} AND gloss <> ''", 'substr(gloss, 1, 100)')}, '') AS differentia,
  CAST(semantic_kind IN ('PROPERTY_KIND', 'EVALUATIVE_KIND') AS BIGINT) AS properties,
  CASE WHEN semantic_kind = 'FUNCTION_KIND' THEN concat_ws(':', 'PURPOSIVE', semantic_nucleus) ELSE coalesce({_bsum("relation = 'INSTRUMENT_OF'", "'INSTRUMENT_FOR:' || gloss")}, '') END AS functions,
  CASE WHEN semantic_kind = 'RELATION_KIND' THEN '' ELSE coalesce({_bsum(f'relation IN {lst(V.RELATION_KINDS)}', table('relation', V.RELATION_KINDS, 'NULL'))}, '') END AS relations,
  CASE WHEN {_bcount("relation = 'PART_OF'")} > 0 THEN 'STRUCTURAL_PART_OF' END AS mereology, CAST(NULL AS VARCHAR) AS causal_mode,
  {_bcount("relation = 'SIMILARITY_EXTENSION'")} AS similarity,
  coalesce(CASE WHEN has_source_claim THEN {label("coalesce(claim_text, '')", D.oppositions, None)} END,
    CASE WHEN has_source_claim AND claim_kind = 'NEGATIVE_CLAIM' THEN 'COMPLEMENTARY' END) AS opposition,
  {_bcount("relation = 'METAPHORICAL_EXTENSION'")} AS transfers FROM concept_t c""")
_ev = "semantic_kind IN ('EVENT_KIND', 'MOTION_KIND')"
sql("O6_event_profile", f"""SELECT concept_id, CASE WHEN {_ev} THEN {label(_comb, D.event_kinds, 'UNKNOWN')} END AS event_kind, CASE WHEN {_ev} THEN 'DYNAMIC' END AS dynamicity,
  CASE WHEN {_ev} THEN coalesce({_bsum(f'relation IN {lst(V.RELATION_ROLES)}', table('relation', V.RELATION_ROLES, 'NULL'))}, '') END AS roles FROM concept_t c""")
_n = lambda t: f"(SELECT count(*) FROM {t} x WHERE x.entry_id = b.entry_id)"
sql("M13_layer_summary", f"""SELECT entry_id, entry_kind, root_identity_match, claim_kind, len(residuals) = 0 AS ontology_buildable, CAST(len(residuals) AS BIGINT) AS residual_count,
  {_n('claim_rows')} AS claims, {_n('origin_t')} AS origins, {_n('branch_t')} AS branches, {_n('concept_t')} AS concepts FROM bundles b""")
sql("O14_bundle_export", f"""SELECT entry_id, root_letters, CASE WHEN corrected_bab_letter <> '' THEN corrected_bab_letter ELSE bab_letter END AS bab_letter,
  CASE WHEN corrected_bab_letter <> '' AND bab_letter <> '' AND corrected_bab_letter <> bab_letter THEN bab_letter END AS corrected_from,
  (SELECT status FROM gate_t g WHERE g.entry_id = b.entry_id) AS status, {_n('claim_rows')} AS claim_nodes, {_n('origin_t')} AS origins FROM bundles b""")

# ------------------------------------------------------------------------- P
_tok = lambda x: f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda z: z <> '')"
cte("branch_words", f"""SELECT entry_id, pos, 0 AS k, form, 'source_lexical_form' AS field FROM branch_t WHERE form IS NOT NULL
  UNION ALL SELECT entry_id, pos, 1, {norm('form', D.origin_profile)}, 'normalized_form' FROM branch_t WHERE form IS NOT NULL""")
cte("word_seen", f"""SELECT entry_id, {norm('token', D.entity_profile)} AS word, rk, place, ix, layer, field FROM (
  SELECT entry_id, 0 AS rk, origin_index AS place, unnest({_tok('semantic_nucleus')}) AS token, generate_subscripts({_tok('semantic_nucleus')}, 1) AS ix, 'L3_nucleus' AS layer, 'semantic_nucleus' AS field
    FROM origin_t WHERE semantic_nucleus IS NOT NULL
  UNION ALL SELECT entry_id, 1, pos * 2 + k, unnest({_tok('form')}), generate_subscripts({_tok('form')}, 1), 'L3_branch', field FROM branch_words
  UNION ALL SELECT entry_id, 2, 0, unnest({_tok('surface')}), generate_subscripts({_tok('surface')}, 1), 'L2_term', 'lexical_form' FROM term_nodes
  UNION ALL SELECT entry_id, 3, origin_index, unnest({_tok('semantic_nucleus')}), generate_subscripts({_tok('semantic_nucleus')}, 1), 'L4_genus', 'concept_ref' FROM concept_t WHERE semantic_nucleus IS NOT NULL)""")
cte("words", """SELECT entry_id, word, arg_min(layer, (rk, place, ix)) AS source_layer, arg_min(field, (rk, place, ix)) AS source_field FROM word_seen
  WHERE length(word) >= 2 GROUP BY entry_id, word""")
sql("P1_entity_words", "SELECT * FROM words")
cte("dict", """SELECT word, ends_with(word, 'er') AS is_human, ends_with(word, 'e') AS is_animate, ends_with(word, 's') AS is_artifact, ends_with(word, 'n') AS is_location,
  ends_with(word, 'tion') AS is_abstraction FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '(\\p{L}+)', 1)) AS word FROM benchmark) WHERE length(word) >= 2""")
_f = lambda c: f"coalesce(d.{c}, false)"
_flagcols = ("is_human", "is_animate", "is_artifact", "is_location", "is_abstraction")
cte("classified", f"""SELECT w.word, w.entry_id, w.source_layer, w.source_field, {', '.join(f'{_f(c)} AS {c}' for c in _flagcols)}, {' OR '.join(_f(c) for c in _flagcols)} AS classified,
  'ENTITY_CANDIDATE_ONLY' AS notice FROM words w LEFT JOIN dict d USING (word)""")
sql("P2_classify_entities", "SELECT * FROM classified")
sql("P3_entity_summary", """SELECT entry_id, count(*) AS words_examined, count_if(classified) AS words_classified, count_if(is_human) AS human_count,
  count_if(is_animate AND NOT is_human) AS animate_count, count_if(is_artifact) AS artifact_count, count_if(is_location) AS location_count,
  count_if(is_abstraction) AS abstraction_count, count_if(NOT classified) AS unknown_count FROM classified GROUP BY entry_id""")
sql("P4_selectional_checks", f"""SELECT entry_id, verb, position, subject, required_flag, valid, CASE WHEN valid IS NULL THEN 'UNKNOWN' WHEN valid THEN 'COMPATIBLE' ELSE 'INCOMPATIBLE' END AS verdict
  FROM (SELECT t.entry_id, t.root_letters AS verb, CAST(t.rn - 1 AS BIGINT) AS position, t.word AS subject, CASE WHEN length(t.root_letters) % 2 = 0 THEN 'is_animate' ELSE 'is_location' END AS required_flag,
    CASE WHEN length(t.root_letters) % 2 = 0 THEN d.is_animate ELSE d.is_location END AS valid FROM (
    SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY origin_index, ix) AS rn FROM (SELECT entry_id, root_letters, origin_index, ix, {norm('token', D.entity_profile)} AS word FROM (
      SELECT o.entry_id, e.root_letters, o.origin_index, unnest(regexp_split_to_array(semantic_nucleus, '\\s+')) AS token, generate_subscripts(regexp_split_to_array(semantic_nucleus, '\\s+'), 1) AS ix
      FROM origin_t o JOIN root_entries e USING (entry_id) WHERE semantic_nucleus IS NOT NULL AND e.root_letters IN (SELECT root FROM asks)))
    WHERE length(word) >= 2) t LEFT JOIN dict d ON t.word = d.word WHERE rn <= 5)""")

# ------------------------------------------------------------------------- Q
cte("keyed", f"SELECT *, {root_norm('root_letters')} AS root_key, {root_norm('root_display')} AS display_key FROM enriched")
cte("ask_keys", f"SELECT *, {root_norm('root')} AS rn FROM asks")
cte("direct", """SELECT a.request_id, e.* FROM ask_keys a JOIN keyed e ON a.rn <> '' AND (e.root_key = a.rn OR starts_with(e.display_key, a.rn))""")
cte("found", """SELECT * FROM direct UNION ALL SELECT * EXCLUDE (k) FROM (SELECT a.request_id, e.*, row_number() OVER (PARTITION BY a.request_id ORDER BY e.entry_num) AS k
  FROM ask_keys a JOIN keyed e ON a.rn <> '' AND contains(e.root_key, substr(a.rn, 1, 3)) WHERE a.request_id NOT IN (SELECT request_id FROM direct)) WHERE k <= 20""")
sql("Q1_find_entries", "SELECT request_id, entry_id, root_letters FROM found")
cte("answers", """SELECT a.request_id, a.claim_text, a.lemma, a.concept_id, a.author_position, f.n IS NOT NULL AS found, CASE WHEN a.rn = '' THEN 'INVALID_ROOT_INPUT' WHEN f.n IS NULL THEN 'NOT_FOUND' ELSE 'OK' END
  AS query_status, f.canonical_root, coalesce(f.n, 0) AS entry_count, f.* EXCLUDE (request_id, n, canonical_root) FROM ask_keys a LEFT JOIN (
  SELECT request_id, count(*) AS n, arg_min(root_letters, entry_num) AS canonical_root, arg_min(ocr_confidence, entry_num) AS first_confidence,
    arg_min(root_display, entry_num) AS first_display, arg_min(entry_type, entry_num) AS first_type, min(ocr_confidence) AS min_confidence,
    bool_or(entry_type = 'UNKNOWN') AS any_unknown, avg(CAST(CASE WHEN ocr_confidence = 0 THEN 1.0 ELSE ocr_confidence END AS DECIMAL(18, 9))) AS mean_confidence
  FROM found GROUP BY request_id) f USING (request_id)""")


def ask(name: str, columns: str) -> None:
    sql(name, f"""SELECT a.request_id, a.found, a.query_status, a.canonical_root, e.entry_id, {columns}
      FROM answers a LEFT JOIN found e USING (request_id)""")


_ax = "CASE WHEN e.entry_id IS NOT NULL THEN array_to_string(e.axes, '|') END"
ask("Q2_ROOT_LOOKUP", f"""e.entry_type, e.axes_count, {_ax} AS axes, CASE WHEN len(e.poetry_lines) > 0 THEN array_to_string(e.poetry_lines, chr(10)) END AS poetry, e.ocr_confidence,
  a.first_confidence, CASE WHEN a.found THEN 'PENDING' END AS first_review_state, CASE WHEN e.entry_id IS NOT NULL THEN {cols('e.authorities')} END AS authorities""")
ask("Q3_ROOT_SEMANTIC_ORIGINS", f"e.entry_type, {_ax} AS axes, {body_excerpt('e.body_text')} AS body_excerpt, a.min_confidence AS confidence")
sql("Q4_ROOT_EXISTS", """SELECT a.request_id, a.found, a.query_status, a.canonical_root, a.entry_count, s.entry_statuses FROM answers a LEFT JOIN (
  SELECT request_id, string_agg(entry_type || ':PENDING:' || n, '|' ORDER BY entry_type) AS entry_statuses FROM (SELECT request_id, entry_type, count(*) AS n FROM found GROUP BY ALL)
  GROUP BY request_id) s USING (request_id)""")
ask("Q5_ROOT_CANONICAL_IDENTITY", "a.first_display, a.first_type, length(replace(a.canonical_root, ' ', '')) = 2 AS is_geminate, a.entry_count > 1 AS ambiguous")
ask("Q6_ENTRY_QUALIFICATION", """e.entry_type, e.claim_status, length(e.body_text) > 0 AS has_body, round(a.mean_confidence, 2) AS confidence, a.any_unknown AS partial_load,
  CASE WHEN a.found THEN 'PRESENT' ELSE 'ABSENT' END AS entry_status""")
_needle = "coalesce(nullif(a.concept_id, ''), nullif(a.claim_text, ''))"
ask("Q10_ROOT_MEANING_EVIDENCE", f"CASE WHEN {_needle} IS NOT NULL THEN {excerpt('e.body_text', _needle)} ELSE substr(e.body_text, 1, 200) END AS body_excerpt")
ask("Q11_ROOT_ORIGIN_RELATIONS", f"""{_ax} AS axes, len(e.axes) > 1 AS has_multiple_origins, CASE WHEN e.entry_id IS NULL THEN NULL WHEN e.entry_type = 'SINGLE_ORIGIN' THEN 'FULL'
  WHEN len(e.axes) > 1 THEN 'PARTIAL' ELSE 'UNKNOWN' END AS generalization_scope""")
ask("Q12_ROOT_INTERNAL_CONFLICT", "CAST(len(e.axes) AS BIGINT) AS axis_rows, len(e.axes) > 1 AS has_conflict, e.entry_type = 'UNKNOWN' AS has_residuals")
sql("Q13_DERIVATIVE_ATTESTATION", f"""SELECT a.request_id, coalesce(h.n, 0) > 0 AS found, CASE WHEN a.query_status = 'INVALID_ROOT_INPUT' THEN a.query_status WHEN coalesce(h.n, 0) > 0 THEN 'OK' ELSE 'NOT_FOUND' END
  AS query_status, a.canonical_root, e.entry_id, e.excerpt FROM answers a LEFT JOIN (SELECT f.request_id, f.entry_id, {excerpt('f.body_text', 'q.lemma')} AS excerpt FROM found f JOIN asks q USING (request_id)
    WHERE coalesce(q.lemma, '') <> '' AND contains(f.body_text, q.lemma)) e USING (request_id) LEFT JOIN (SELECT f.request_id, count(*) AS n FROM found f JOIN asks q USING (request_id)
    WHERE coalesce(q.lemma, '') <> '' AND contains(f.body_text, q.lemma) GROUP BY 1) h USING (request_id)""")
ask("Q14_SOURCE_EVIDENCE", f"""e.source, CASE WHEN e.entry_id IS NOT NULL THEN {cols('e.page_refs')} END AS page_refs,
  CASE WHEN len(e.footnote_lines) > 0 THEN array_to_string(e.footnote_lines, chr(10)) END AS passages""")
ask("Q15_CLAIM_ATTRIBUTION", f"""{_ax} AS axes, CASE WHEN e.entry_id IS NOT NULL THEN {cols('e.authorities')} END AS authorities,
  e.entry_id IS NOT NULL AND len(e.authorities) = 0 AS unattributed""")
ask("Q16_ROOT_SENSE_CANDIDATES", "CASE WHEN e.entry_id IS NOT NULL THEN array_to_string(list_transform(e.axes, lambda v, i: i || ':' || v), '|') END AS senses")
ask("Q17_RECORD_INTEGRITY", "e.entry_type <> 'UNKNOWN' AS axes_extracted, e.entry_type = 'UNKNOWN' AS entry_partial, a.any_unknown AS partial_load")
sql("Q18_TRACE_LOOKUP", """SELECT a.request_id, a.found, a.query_status, a.canonical_root, e.entry_id, v.event_id, v.event_type, CAST(json_extract_string(v.props, '$.k') AS VARCHAR) AS detail
  FROM answers a LEFT JOIN found e USING (request_id) LEFT JOIN events v ON v.user_id = e.entry_id""")
ask("Q19_ASSERTION_PROVENANCE", "CASE WHEN e.entry_id IS NOT NULL THEN array_to_string(list_transform(e.axes, lambda v: 'EXPLICIT_IBN_FARIS:' || v), '|') END AS provenance")
_nc, _at = norm("coalesce(q.claim_text, '')", LOOKUP), norm("v", LOOKUP)
_support = (f"list_filter(e.axes, lambda v: q.nc <> '' AND {_at} <> '' AND (contains({_at}, q.nc) OR contains(q.nc, {_at}) OR "
            f"len(list_filter(string_split(q.nc, ' '), lambda w: length(w) > 2 AND contains({_at}, w))) > 0))")
cte("support", f"""SELECT e.request_id, e.entry_id, e.root_letters, {_support} AS hits, q.claim <> '' AND contains(e.body_text, q.claim) AS in_body, {excerpt('e.body_text', 'q.claim')} AS ex
  FROM found e JOIN (SELECT request_id, coalesce(claim_text, '') AS claim, {_nc.replace('q.', '')} AS nc FROM asks) q USING (request_id)""")
cte("verdicts", """SELECT request_id, max(CASE WHEN len(hits) > 0 THEN 2 WHEN in_body THEN 1 ELSE 0 END) AS v,
  CAST(sum(CASE WHEN len(hits) > 0 THEN len(hits) WHEN in_body THEN 1 ELSE 0 END) AS BIGINT) AS c FROM support GROUP BY request_id""")
_status = "CASE WHEN v = 2 THEN 'SUPPORTED' WHEN v = 1 THEN 'PARTIALLY_SUPPORTED' ELSE 'NOT_SUPPORTED' END"
sql("Q9_CLAIM_EVIDENCE", f"""SELECT a.request_id, coalesce(c, 0) > 0 AS found, a.query_status, a.canonical_root, a.entry_count AS entries_checked, {_status} AS claim_status,
  coalesce(c, 0) AS evidence_count, a.min_confidence AS confidence FROM answers a LEFT JOIN verdicts USING (request_id)""")
sql("Q26_check_claim", f"SELECT a.request_id, {_status} AS claim_status FROM answers a LEFT JOIN verdicts USING (request_id)")
sql("Q9_claim_evidence_rows", """SELECT request_id, entry_id, root_letters, CAST(generate_subscripts(hits, 1) - 1 AS BIGINT) AS pos, 'SEMANTIC_AXIS' AS source_type, unnest(hits) AS text,
  'IBN_FARIS_DIRECT' AS attribution, 'SUPPORTED' AS claim_support FROM support UNION ALL SELECT request_id, entry_id, root_letters, 0, 'BODY_TEXT', ex, 'IBN_FARIS_DIRECT',
  'PARTIALLY_SUPPORTED' FROM support WHERE len(hits) = 0 AND in_body""")
sql("Q23_root_summary", f"""SELECT a.request_id, a.found, e.entry_id, e.root_display, e.entry_type, {_ax} AS axis_texts, {body_excerpt('e.body_text')} AS evidence_text, e.ocr_confidence
  FROM answers a LEFT JOIN found e USING (request_id)""")
_shown = f"substr({body_excerpt('body_text')}, 1, 300)"
cte("root_claim_rows", f"""SELECT request_id, entry_id, unnest(axes) AS claim_text, CAST(generate_subscripts(axes, 1) AS BIGINT) AS claim_rank, 'SEMANTIC_AXIS' AS claim_type, {_shown} AS evidence FROM found
  UNION ALL SELECT request_id, entry_id, NULL, 0, 'RAW_TEXT_ONLY', {_shown} FROM found WHERE len(axes) = 0 AND body_text <> ''""")
sql("Q24_root_claims", "SELECT * FROM root_claim_rows")
sql("Q25_evidence_ids_v2", """SELECT request_id, 'lex:v2:' || root || ':axis:' || claim_rank || ':' || replace(substr(c.claim_text, 1, 40), ' ', '_') AS evidence_id FROM root_claim_rows c JOIN asks USING (request_id)
  WHERE claim_rank > 0 AND c.claim_text <> '' UNION ALL SELECT request_id, 'lex:v2:' || root || ':type:' || first_type FROM answers JOIN asks USING (request_id) WHERE found""")


def concept_sql(prefix: str, concept: str) -> None:
    cte(prefix + "_asks", f"SELECT request_id, {concept} AS concept, {norm(concept, LOOKUP)} AS nc FROM asks")
    cte(prefix + "_axis", f"""SELECT request_id, entry_id, arg_min(axis_text, axis_num) AS matched_axis FROM (SELECT q.request_id, x.entry_id, x.axis_num, x.axis_text,
      row_number() OVER (PARTITION BY q.request_id ORDER BY x.entry_id, x.axis_num) AS k FROM {prefix}_asks q JOIN axis_rows x ON q.concept IS NOT NULL AND
      ((q.nc <> '' AND contains(x.axis_text, q.nc)) OR contains(x.axis_text, q.concept))) WHERE k <= 50 GROUP BY request_id, entry_id""")
    cte(prefix + "_body", f"""SELECT request_id, entry_id FROM (SELECT q.request_id, e.doc_id AS entry_id, row_number() OVER (PARTITION BY q.request_id ORDER BY e.doc_id) AS k
      FROM {prefix}_asks q JOIN documents e ON contains(e.text, q.concept)) WHERE k <= 30""")
    cte(prefix + "_hits", f"""SELECT request_id, entry_id, 'ROOT_EXPLICITLY_LINKED_BY_IBN_FARIS' AS match_type, matched_axis FROM {prefix}_axis UNION ALL
      SELECT request_id, entry_id, 'ROOT_SEMANTICALLY_SIMILAR', NULL FROM {prefix}_body b WHERE NOT EXISTS (SELECT 1 FROM {prefix}_axis x WHERE x.request_id = b.request_id AND x.entry_id = b.entry_id)""")


concept_sql("c7", "coalesce(nullif(concept, ''), nullif(claim_text, ''), nullif(concept_id, ''))")
concept_sql("c8", "coalesce(nullif(claim_text, ''), nullif(concept_id, ''))")
sql("Q7_CONCEPT_TO_ROOT_SEARCH", """SELECT q.request_id, h.entry_id IS NOT NULL AS found, CASE WHEN q.concept IS NULL THEN 'MISSING_PARAM' WHEN h.entry_id IS NULL THEN 'NOT_FOUND' ELSE 'OK' END AS query_status,
  h.entry_id, h.match_type, h.matched_axis FROM c7_asks q LEFT JOIN c7_hits h USING (request_id)""")
sql("Q8_SEMANTIC_REVERSE_SEARCH", """SELECT q.request_id, h.entry_id IS NOT NULL AS found, h.entry_id, h.match_type FROM c8_asks q LEFT JOIN c8_hits h USING (request_id)""")
sql("Q26_find_roots_by_concept", "SELECT request_id, entry_id, match_type, matched_axis FROM c7_hits")
cte("c26_axis", """SELECT q.request_id, x.entry_id, arg_min(x.axis_text, x.axis_num) AS matched_axis FROM c7_asks q JOIN axis_rows x ON
  contains(x.axis_text, q.concept) OR (q.nc <> '' AND contains(x.axis_text, q.nc)) GROUP BY q.request_id, x.entry_id""")
sql("Q26_find_roots_by_concept_all", """SELECT request_id, entry_id, 'ROOT_EXPLICITLY_LINKED_BY_IBN_FARIS' AS match_type, matched_axis FROM c26_axis UNION ALL
  SELECT q.request_id, d.doc_id, 'ROOT_SEMANTICALLY_SIMILAR', NULL FROM c7_asks q JOIN documents d ON contains(d.text, q.concept)
  WHERE NOT EXISTS (SELECT 1 FROM c26_axis x WHERE x.request_id = q.request_id AND x.entry_id = d.doc_id)""")
cte("c26_hits", """SELECT request_id, entry_id, 'ROOT_EXPLICITLY_LINKED_BY_IBN_FARIS' AS match_type, matched_axis FROM c26_axis UNION ALL
  SELECT q.request_id, d.doc_id, 'ROOT_SEMANTICALLY_SIMILAR', NULL FROM c7_asks q JOIN documents d ON contains(d.text, q.concept)
  WHERE NOT EXISTS (SELECT 1 FROM c26_axis x WHERE x.request_id = q.request_id AND x.entry_id = d.doc_id)""")
sql("Q7_CONCEPT_TO_ROOT_SEARCH_all", """SELECT q.request_id, h.entry_id IS NOT NULL AS found, CASE WHEN q.concept IS NULL THEN 'MISSING_PARAM' WHEN h.entry_id IS NULL THEN 'NOT_FOUND' ELSE 'OK' END AS query_status,
  h.entry_id, h.match_type, h.matched_axis FROM c7_asks q LEFT JOIN c26_hits h USING (request_id)""")
_kinds = [*sorted(HANDLERS), *sorted(ALIASES), "SOMETHING_ELSE"]
_kind_of = "[" + ", ".join(map(s, _kinds)) + f"][request_id % {len(_kinds)} + 1]"
_handler = table("query_type", ALIASES, "query_type")
cte("mixed", f"SELECT *, {_handler} AS handler FROM (SELECT request_id, {_kind_of} AS query_type FROM asks)")
_entry_types = sorted(set(HANDLERS) - {"ROOT_EXISTS", "CONCEPT_TO_ROOT_SEARCH", "CLAIM_EVIDENCE", "DERIVATIVE_TO_ORIGIN_ATTESTATION", "TRACE_LOOKUP"})
cte("mixed_rows", f"""SELECT m.request_id, query_type, a.found, a.query_status, a.canonical_root, e.entry_id,
  CASE handler WHEN 'ROOT_SEMANTIC_ORIGINS' THEN a.min_confidence WHEN 'ENTRY_QUALIFICATION' THEN round(a.mean_confidence, 2) END AS confidence
  FROM mixed m JOIN answers a USING (request_id) LEFT JOIN found e USING (request_id) WHERE handler IN {lst(_entry_types)}
  UNION ALL SELECT m.request_id, query_type, a.found, a.query_status, a.canonical_root, NULL, NULL FROM mixed m JOIN answers a USING (request_id) WHERE handler = 'ROOT_EXISTS'
  UNION ALL SELECT m.request_id, query_type, coalesce(v.c, 0) > 0, a.query_status, a.canonical_root, NULL, a.min_confidence
    FROM mixed m JOIN answers a USING (request_id) LEFT JOIN verdicts v USING (request_id) WHERE handler = 'CLAIM_EVIDENCE'
  UNION ALL SELECT m.request_id, query_type, h.entry_id IS NOT NULL, CASE WHEN a.query_status = 'INVALID_ROOT_INPUT' THEN a.query_status WHEN h.entry_id IS NULL THEN 'NOT_FOUND' ELSE 'OK' END,
    a.canonical_root, h.entry_id, NULL FROM mixed m JOIN answers a USING (request_id) LEFT JOIN (SELECT f.request_id, f.entry_id FROM found f JOIN asks q USING (request_id)
      WHERE coalesce(q.lemma, '') <> '' AND contains(f.body_text, q.lemma)) h USING (request_id) WHERE handler = 'DERIVATIVE_TO_ORIGIN_ATTESTATION'
  UNION ALL SELECT m.request_id, query_type, a.found, a.query_status, a.canonical_root, e.entry_id, NULL FROM mixed m JOIN answers a USING (request_id)
    LEFT JOIN found e USING (request_id) LEFT JOIN events v ON v.user_id = e.entry_id WHERE handler = 'TRACE_LOOKUP'
  UNION ALL SELECT m.request_id, query_type, h.entry_id IS NOT NULL, CASE WHEN q.concept IS NULL THEN 'MISSING_PARAM' WHEN h.entry_id IS NULL THEN 'NOT_FOUND' ELSE 'OK' END,
    NULL, h.entry_id, NULL FROM mixed m JOIN c7_asks q USING (request_id) LEFT JOIN c7_hits h USING (request_id) WHERE handler = 'CONCEPT_TO_ROOT_SEARCH'
  UNION ALL SELECT request_id, query_type, false, 'UNKNOWN_QUERY_TYPE', NULL, NULL, NULL FROM mixed WHERE handler NOT IN {lst(HANDLERS)}""")
sql("Q20_run_queries", """SELECT request_id, query_type, found, query_status, canonical_root, count(entry_id) AS rows,
  count(CASE WHEN query_status <> 'UNKNOWN_QUERY_TYPE' THEN 1 END) AS payloads FROM mixed_rows GROUP BY request_id, query_type, found, query_status, canonical_root""")
sql("Q20_answers", "SELECT * FROM mixed_rows")
sql("Q21_stats", """SELECT 'total_entries' AS metric, count(*) AS value FROM enriched UNION ALL SELECT 'total_axes', count(*) FROM axis_rows
  UNION ALL SELECT 'total_poetry_lines', CAST(sum(len(poetry_lines)) AS BIGINT) FROM enriched UNION ALL SELECT 'type:' || entry_type, count(*) FROM enriched GROUP BY entry_type""")
sql("Q22_top_axes", "SELECT axis_text, count(*) AS n FROM axis_rows GROUP BY axis_text ORDER BY n DESC, axis_text LIMIT 5")
sql("Q22_type_distribution", "SELECT entry_type, count(*) AS n FROM enriched GROUP BY entry_type")

for _n, _text in SQL.items():
    SQL[_n] = with_ctes(_text)
