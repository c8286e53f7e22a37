"""DuckDB oracle SQL for the registered queries (same keys as ``catalog.QUERIES``).

Shared regular expressions come from the library's fixed values and are written with
explicit classes that RE2 (DuckDB) and Java (Spark) read alike. String literals in
DuckDB take backslashes verbatim.
"""

from __future__ import annotations

# Patterns stated here from the definitions they check (white space as Python's str.strip
# and \s have it; float() and int() texts; control characters; e-mails and telephone numbers).
WS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
CONTROL = r"[\x{00}-\x{08}\x{0B}-\x{1F}]"
_N = r"[0-9]+(_[0-9]+)*"
INT_RE = rf"\A[{WS}]*[+-]?{_N}[{WS}]*\z"
FLOAT_RE = rf"\A[{WS}]*[+-]?({_N}(\.({_N})?)?|\.{_N})([eE][+-]?{_N})?[{WS}]*\z"
NONFINITE_RE = rf"(?i)\A[{WS}]*([+-]?)(inf|infinity|nan)[{WS}]*\z"
BOOL_WORDS = ["1", "t", "true", "y", "yes", "on", "0", "f", "false", "n", "no", "off"]
EMAIL_RE = r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_US_RE = rf"\+?1?[-.{WS}]?\(?[0-9]{{3}}\)?[-.{WS}]?[0-9]{{3}}[-.{WS}]?[0-9]{{4}}"
PHONE_INTL_RE = rf"\+?[0-9]{{1,3}}[-.{WS}]?[0-9]{{3,4}}[-.{WS}]?[0-9]{{3,4}}[-.{WS}]?[0-9]{{4}}"
NETLOC_RE = r"\A([A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {_lit(rf'\A[{WS}]+|[{WS}]+\z')}, '', 'g')"


def cs(e: str) -> str:
    """C7 clean_string."""
    return (f"regexp_replace(regexp_replace({strip(e)}, ' {{2,}}', ' ', 'g'), "
            f"{_lit(CONTROL)}, '', 'g')")


def words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {_lit(f'[{WS}]+')}), lambda x: x <> '')"


def wc(e: str) -> str:
    return f"CAST(len({words(e)}) AS BIGINT)"


def unescape(e: str) -> str:
    # The entities present in the pages; as in HTML's legacy named
    # references the ';' is optional; '&amp' last so '&amp;lt;' yields '&lt;'.
    for a, b in [("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;?", "'"),
                 ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")]:
        e = f"regexp_replace({e}, {_lit(a)}, {_lit(b)}, 'g')"
    return e


def netloc(e: str) -> str:
    deleted = _lit(r"[\x{09}\x{0A}\x{0D}]")
    leading = _lit(r"^[\x{00}-\x{20}]+")
    cleaned = f"regexp_replace(regexp_replace({e}, {deleted}, '', 'g'), {leading}, '')"
    return f"regexp_extract({cleaned}, {_lit(NETLOC_RE)}, 2)"


def host_prefix(e: str) -> str:
    return f"regexp_extract({e}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


def file_size(e: str) -> str:
    units = ["B", "KB", "MB", "GB", "TB"]
    whens = []
    for k in range(4, 0, -1):
        whens.append(f"WHEN abs({e}) >= {1024 ** k} AND {e} > 0 THEN printf('%.1f', {e} / {float(1024 ** k)}) || '{units[k]}'")
    return (f"CASE WHEN {e} IS NULL THEN NULL WHEN {e} = 0 THEN '0B' " + " ".join(whens) +
            f" ELSE printf('%.1f', {e} * 1.0) || 'B' END")


def safe_filename(e: str) -> str:
    s1 = f"regexp_replace(regexp_replace({e}, '[<>:\"/\\\\|?*]', '_', 'g'), {_lit(r'[\x{00}-\x{1F}\x{7F}-\x{9F}]')}, '', 'g')"
    return f"""(SELECT CASE WHEN s4 = '' THEN 'unnamed' ELSE s4 END FROM (
      SELECT regexp_replace(CASE WHEN n > 255 THEN substr(stem, 1, CASE WHEN 255 - length(ext) >= 0
               THEN least(255 - length(ext), length(stem)) ELSE greatest(length(stem) + 255 - length(ext), 0) END) || ext
             ELSE s2 END, '\\A[ .]+|[ .]+\\z', '', 'g') AS s4 FROM (
        SELECT s2, n, CASE WHEN has_ext THEN substr(s2, last_dot) ELSE '' END AS ext,
               CASE WHEN has_ext THEN substr(s2, 1, last_dot - 1) ELSE s2 END AS stem FROM (
          SELECT s2, n, last_dot, back > 0 AND last_dot > 1 AND last_dot < n AS has_ext FROM (
            SELECT s2, length(s2) AS n, instr(reverse(s2), '.') AS back,
                   length(s2) - instr(reverse(s2), '.') + 1 AS last_dot FROM (SELECT {s1} AS s2))))))"""


def slugify(e: str) -> str:
    s = strip(f"lower({e})")
    s = f"regexp_replace({s}, {_lit(rf'[^\p{{L}}\p{{N}}_{WS}-]')}, '', 'g')"
    s = f"regexp_replace({s}, {_lit(f'[-{WS}]+')}, '-', 'g')"
    s = f"regexp_replace({s}, '\\A-+|-+\\z', '', 'g')"
    return f"(SELECT CASE WHEN s = '' THEN 'untitled' ELSE s END FROM (SELECT {s} AS s))"


def to_double(e: str) -> str:
    sign = f"regexp_extract({e}, {_lit(NONFINITE_RE)}, 1)"
    word = f"lower(regexp_extract({e}, {_lit(NONFINITE_RE)}, 2))"
    return (f"CASE WHEN regexp_matches({e}, {_lit(NONFINITE_RE)}) THEN "
            f"(CASE WHEN {word} = 'nan' THEN 'nan'::DOUBLE WHEN {sign} = '-' THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) "
            f"WHEN regexp_matches({e}, {_lit(FLOAT_RE)}) THEN CAST(replace({strip(e)}, '_', '') AS DOUBLE) END")


def to_int(e: str) -> str:
    return (f"CASE WHEN regexp_matches({e}, {_lit(FLOAT_RE)}) THEN "
            f"TRY_CAST(trunc(CAST(replace({strip(e)}, '_', '') AS DOUBLE)) AS BIGINT) END")


GAPS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS o_orderstatus,
       nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders"""


def _fill(col, val):
    return f"CASE WHEN {col} IS NULL OR {col} = '' THEN {_lit(val)} ELSE {col} END AS {col}"


VALID_INPUT = """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS VARCHAR) || '.5' ELSE ' ' || CAST(o_custkey AS VARCHAR) END AS custkey_text,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'n/a'
       ELSE CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS price_text,
  CASE WHEN o_orderstatus = 'F' THEN 'yes' WHEN o_orderstatus = 'O' THEN 'no' ELSE 'maybe' END AS flag_text
FROM orders"""

BOOLS = ", ".join(_lit(w) for w in BOOL_WORDS)
VALID_ERRS = f"""SELECT *, list_filter([
  CASE WHEN o_orderpriority IS NULL THEN 'o_orderpriority:missing' END,
  CASE WHEN custkey_text IS NOT NULL AND NOT regexp_matches(custkey_text, {_lit(INT_RE)}) THEN 'custkey_text:type_int' END,
  CASE WHEN price_text IS NOT NULL AND NOT (regexp_matches(price_text, {_lit(FLOAT_RE)})
       OR regexp_matches(price_text, {_lit(NONFINITE_RE)})) THEN 'price_text:type_float' END,
  CASE WHEN flag_text IS NOT NULL AND lower(flag_text) NOT IN ({BOOLS}) THEN 'flag_text:type_bool' END
], lambda x: x IS NOT NULL) AS errs FROM ({VALID_INPUT})"""

PADDED = """SELECT p_partkey, '  ' || p_name || '   x ' || chr(1) || ' ' AS name, chr(9) || p_brand || '   ' AS brand,
  p_type, p_size, [' ' || p_name || '  ', p_type || chr(9) || ' x  y', p_brand] AS tags FROM part"""

QS = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"


def numeric_raw(kind: str) -> str:
    if kind == "bool":
        return (f"CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'yes' WHEN 4 THEN ' on' "
                f"WHEN 5 THEN '0' WHEN 6 THEN 'no' ELSE {QS} END")
    last = "'1_'" if kind == "float" else "'x'"
    return (f"CASE l_linenumber WHEN 1 THEN {QS} || '.9' WHEN 2 THEN '-' || {QS} || '.9' "
            f"WHEN 3 THEN ' ' || {QS} || ' ' WHEN 4 THEN {QS} || 'e1' WHEN 5 THEN 'inf' WHEN 6 THEN '' "
            f"ELSE {last} || {QS} END")


# Strftime patterns printing the twelve parse_date formats, in order.
DATE_PRINT = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y",
              "%m-%d-%Y", "%d-%m-%Y", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y"]
CONVERT_FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y"]

NAV = """(SELECT page_id, url, unnest(range(len(hrefs))) AS i, hrefs, texts FROM (
  SELECT page_id, url,
    regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
    regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts
  FROM pages))"""

NAV_LINKS = f"""SELECT page_id, CAST(i AS INTEGER) AS item_pos, {strip(unescape('texts[i + 1]'))} AS text,
  {host_prefix('url')} || {unescape('hrefs[i + 1]')} AS href FROM {NAV}"""

TITLE = strip(unescape("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))

FIRST_LINK = f"""SELECT page_id, url, CASE WHEN regexp_matches(html, '(?s)<nav>.*?<li><a href="')
  THEN {host_prefix('url')} || {unescape("regexp_extract(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href=\"([^\"]*)\">', 1)")} END AS next_url
  FROM pages"""

NESTED = """'{"u":{"id":' || CAST(user_id AS VARCHAR) || ',"t":"' || event_type || '"},"p":' || props
  || ',"x":[' || CAST(event_id AS VARCHAR) || ',{"y":' || CAST(user_id AS VARCHAR) || '}],"e":{}}'"""

TS6 = "'%Y-%m-%d %H:%M:%S.%f'"

COURSE = """WITH c AS (SELECT ts, sum(sum((event_type = 'click')::INT - (event_type = 'purchase')::INT)) OVER (ORDER BY ts) AS active,
  sum(sum((event_type = 'signup')::INT - (event_type = 'click')::INT)) OVER (ORDER BY ts) AS queue FROM events GROUP BY ts)"""

SQL = {
    "flagship_clean_dedupe_transform": f"""
WITH c AS (SELECT doc_id, {cs('text')} AS text, {cs('lang')} AS lang, {cs('source')} AS source FROM documents)
SELECT doc_id, text AS body, lang, source, CAST(length(text) AS BIGINT) AS text_length, {wc('text')} AS word_count
FROM c QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",

    "missing_drop": f"""SELECT * FROM ({GAPS}) WHERE o_orderstatus IS NOT NULL AND o_orderstatus <> ''
  AND o_orderpriority IS NOT NULL AND o_orderpriority <> ''""",
    "missing_default": f"""SELECT o_orderkey, {_fill('o_orderstatus', 'N/A')}, {_fill('o_orderpriority', 'UNKNOWN')},
  'none' AS o_clerk FROM ({GAPS})""",
    "missing_interpolate": f"""SELECT o_orderkey, {_fill('o_orderstatus', 'O')}, {_fill('o_orderpriority', '3-MEDIUM')}
  FROM ({GAPS})""",

    "missing_ffill": """SELECT event_id, key,
  coalesce(last_value(v IGNORE NULLS) OVER w, -1.0) AS value, coalesce(last_value(k IGNORE NULLS) OVER w, 'none') AS kind
FROM (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS key,
  CASE WHEN event_type IN ('click', 'error') THEN value END AS v, CASE WHEN event_type = 'purchase' THEN event_type END AS k FROM events)
WINDOW w AS (PARTITION BY key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "dedupe_first": """SELECT doc_id, lang, source, n_chars FROM documents
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "dedupe_events": """SELECT event_id, user_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",

    "validate_good": f"""SELECT o_orderkey, o_orderpriority, custkey_text, price_text, flag_text
  FROM ({VALID_ERRS}) WHERE len(errs) = 0""",
    "validate_rejected": f"""SELECT o_orderkey, array_to_string(errs, ',') AS errors FROM ({VALID_ERRS}) WHERE len(errs) > 0""",
    "validate_error_counts": f"""SELECT split_part(e, ':', 1) AS field, split_part(e, ':', 2) AS reason, count(*) AS failures
  FROM (SELECT unnest(list_append(errs, '*:rejected_rows')) AS e FROM ({VALID_ERRS}) WHERE len(errs) > 0) GROUP BY 1, 2""",

    "clean_strings": f"""SELECT p_partkey, {cs('name')} AS name, {cs('brand')} AS brand, {cs('p_type')} AS p_type, p_size
  FROM ({PADDED})""",
    "clean_string_arrays": f"""SELECT p_partkey, array_to_string(list_transform(tags, lambda x: {cs('x')}), '|') AS tags
  FROM ({PADDED})""",

    "cleaning_stats": """SELECT count(*) AS original_count, count(DISTINCT text) AS cleaned_count,
  count(*) - count(DISTINCT text) AS removed_count,
  CASE WHEN count(*) > 0 THEN round((count(*) - count(DISTINCT text)) / count(*), 6) ELSE 0.0 END AS removal_rate
  FROM documents""",
    "transform_stats": """SELECT count(*) AS original_count, count(*) AS transformed_count,
  CAST(5 AS BIGINT) AS original_field_count, CAST(7 AS BIGINT) AS transformed_field_count,
  'body,origin,text_length,word_count' AS added_fields, 'source,text' AS removed_fields,
  'doc_id,lang,n_chars' AS common_fields FROM documents""",

    "transform_stats_variant": """SELECT count(*) AS original_count, count(*) AS transformed_count,
  count(DISTINCT event_type) + 1 AS original_field_count, count(DISTINCT event_type) + 2 AS transformed_field_count,
  string_agg(DISTINCT upper(event_type), ',' ORDER BY upper(event_type)) || ',score' AS added_fields,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS removed_fields, 'p' AS common_fields FROM events""",
    "field_mapping": """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, c_custkey, c_nationkey
  FROM customer""",
    "convert_string": """SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CAST(l_quantity AS VARCHAR) AS l_quantity, CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS is_return
  FROM lineitem""",
    "convert_int": f"""SELECT l_orderkey, l_linenumber, raw, {to_int('raw')} AS value,
  raw IS NOT NULL AND {to_int('raw')} IS NULL AS failed FROM (SELECT l_orderkey, l_linenumber, {numeric_raw('int')} AS raw FROM lineitem)""",
    "convert_float": f"""SELECT l_orderkey, l_linenumber, raw, {to_double('raw')} AS value,
  raw IS NOT NULL AND {to_double('raw')} IS NULL AS failed FROM (SELECT l_orderkey, l_linenumber, {numeric_raw('float')} AS raw FROM lineitem)""",
    "convert_bool": f"""SELECT l_orderkey, l_linenumber, raw, lower(raw) IN ('true', '1', 'yes', 'on') AS value
  FROM (SELECT l_orderkey, l_linenumber, {numeric_raw('bool')} AS raw FROM lineitem)""",
    "convert_array": f"""SELECT p_partkey, raw, array_to_string(items, '|') AS items, CAST(len(items) AS BIGINT) AS n_items FROM (
  SELECT p_partkey, raw, CASE WHEN raw IS NULL THEN NULL
    WHEN starts_with({strip('raw')}, '[') AND ends_with({strip('raw')}, ']') AND json_valid(raw)
      THEN json_extract_string(raw, '$[*]')
    ELSE list_transform(string_split(raw, ','), lambda x: {strip('x')}) END AS items
  FROM (SELECT p_partkey, CASE p_size % 4
      WHEN 0 THEN '["' || replace(p_name, ' ', '", "') || '"]'
      WHEN 1 THEN replace(p_name, ' ', ', ')
      WHEN 2 THEN '[' || p_name
      ELSE '[' || CAST(p_size AS VARCHAR) || ', ' || CAST(p_partkey AS VARCHAR) || ']' END AS raw FROM part))""",
    "convert_dict": """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE json_extract_string(props, '$.k') END AS k,
  event_type = 'error' AS failed FROM events""",
    "convert_datetime": f"""SELECT o_orderkey, raw, strftime(try_strptime(raw, [{', '.join(_lit(f) for f in CONVERT_FORMATS)}]), '%Y-%m-%d %H:%M:%S') AS parsed,
  try_strptime(raw, [{', '.join(_lit(f) for f in CONVERT_FORMATS)}]) IS NULL AS failed FROM (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%-d.%-m.%Y') END AS raw FROM orders)""",

    "computed_columns": f"""SELECT doc_id, lang, source, n_chars, CAST(length(text) AS BIGINT) AS text_length,
  {wc('text')} AS word_count, md5(text) AS text_hash,
  CASE WHEN contains(lower(text), 'urgent') THEN 'important' ELSE 'normal' END AS keyword_category,
  CASE WHEN contains(lower(text), 'la') THEN 'important' ELSE 'normal' END AS keyword_la,
  upper(lang) AS upper_lang, n_chars * 2 AS n_chars_x2,
  array_to_string(list_transform({words("concat_ws(' ', lang, source)")}, lambda x: upper(substr(x, 1, 1))), '') AS initials,
  CAST(len(string_split(text, chr(10))) AS BIGINT) AS line_count FROM documents""",
    "computed_columns_pages": f"""SELECT page_id, url,
  CASE WHEN instr(url, '/') > 0 THEN string_split(url, '/')[3] ELSE 'unknown' END AS url_category,
  {netloc('url')} AS domain,
  {to_double("replace(replace('$' || CAST(page_id AS VARCHAR) || ',' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || '.5', '$', ''), ',', '')")} AS price_clean
  FROM pages""",
    "eval_expression": """SELECT l_orderkey, l_linenumber, l_quantity * 2 + l_linenumber AS result,
  l_returnflag || '-' || l_linestatus AS flags FROM lineitem""",

    "clean_text": f"""SELECT doc_id, translate(regexp_replace(regexp_replace({strip("coalesce(src, '')")}, {_lit(f'[{WS}]+')}, ' ', 'g'),
  {_lit(CONTROL)}, '', 'g'), '“”‘’', '""''''') AS cleaned
  FROM (SELECT doc_id, '  “' || text || '” ‘x’' || chr(9) || chr(9) || chr(1) AS src FROM documents)""",
    "extract_domain": f"""SELECT page_id, {netloc('url')} AS domain,
  {netloc("regexp_replace(url, '^[a-z]+:', '')")} AS domain_relative,
  {netloc("regexp_replace(url, '^[a-z]+://', '')")} AS domain_bare FROM pages""",
    "normalize_url": """SELECT page_id, CASE WHEN url IS NULL OR url = '' THEN '' ELSE split_part(url, '#', 1) END AS norm,
  CASE WHEN rel = '' THEN '' WHEN starts_with(rel, 'http://') OR starts_with(rel, 'https://') THEN rel
       ELSE 'http://mirror.example.org' || rel END AS norm_rel
  FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS rel FROM pages)""",
    "hashes": "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents",
    "parse_date": f"""SELECT o_orderkey, strftime(try_strptime({strip('raw')}, [{', '.join(_lit(f) for f in DATE_PRINT)}]),
  '%Y-%m-%d %H:%M:%S') AS parsed FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN ' ' || r || ' ' ELSE r END AS raw FROM (
    SELECT o_orderkey, CASE o_orderkey % 12 {' '.join(f'WHEN {i} THEN strftime(o_orderdate, {_lit(f)})' for i, f in enumerate(DATE_PRINT))} END AS r
    FROM orders))""",
    "file_size": f"""SELECT doc_id, {file_size('(n_chars * 1000 + doc_id)')} AS size_text, {file_size('n_chars')} AS chars_text
  FROM documents""",
    "safe_filename": f"""SELECT page_id, {safe_filename('url')} AS fname,
  {safe_filename("repeat(url, 6) || ' .html'")} AS fname_long FROM pages""",
    "emails": f"""SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS email
  FROM (SELECT doc_id, regexp_extract_all(text, {_lit(EMAIL_RE)}) AS l FROM documents)""",
    "phones": f"""SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS phone
  FROM (SELECT doc_id, list_concat(regexp_extract_all(text, {_lit(PHONE_US_RE)}),
                                   regexp_extract_all(text, {_lit(PHONE_INTL_RE)})) AS l FROM documents)""",
    "slugify": f"SELECT doc_id, {slugify('text')} AS slug FROM documents",
    "merge_maps": """SELECT user_id, key, value FROM (
  SELECT e.user_id, e.ts, e.event_id, j.key AS key, j.value ->> '$' AS value FROM events e, json_each(e.props) j)
  QUALIFY row_number() OVER (PARTITION BY user_id, key ORDER BY ts DESC, event_id DESC) = 1""",
    "chunks": """SELECT event_id, user_id, CAST((rn - 1) // 5 AS BIGINT) AS chunk_id, CAST((rn - 1) % 5 AS BIGINT) AS chunk_pos
  FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)""",
    "flatten_json": f"""SELECT e.event_id, regexp_replace(regexp_replace(t.fullkey, '\\[(\\d+)\\]', '.\\1', 'g'), '^\\$\\.?', '') AS path,
  t.value ->> '$' AS value FROM (SELECT event_id, {NESTED} AS j FROM events) e, json_tree(e.j) t
  WHERE t.type NOT IN ('OBJECT', 'ARRAY')""",
    "merge_versions": f"""SELECT user_id, path, value FROM (
  SELECT e.user_id, e.ts, e.event_id, regexp_replace(t.fullkey, '^\\$\\.?', '') AS path,
    CASE WHEN t.type = 'ARRAY' THEN CAST(t.value AS VARCHAR) ELSE t.value ->> '$' END AS value
  FROM (SELECT user_id, ts, event_id, {NESTED} AS j FROM events) e, json_tree(e.j) t
  WHERE (t.type <> 'OBJECT' OR CAST(t.value AS VARCHAR) = '{{}}') AND NOT contains(t.fullkey, '['))
QUALIFY row_number() OVER (PARTITION BY user_id, path ORDER BY ts DESC, event_id DESC) = 1""",
    "flatten_documents": """SELECT doc_id, 'doc.doc_id' AS path, CAST(doc_id AS VARCHAR) AS value FROM documents
UNION ALL SELECT doc_id, 'doc.body.text', text FROM documents UNION ALL SELECT doc_id, 'doc.body.lang', lang FROM documents
UNION ALL SELECT doc_id, 'doc.meta.0.source', source FROM documents
UNION ALL SELECT doc_id, 'doc.meta.1.source', lang FROM documents
UNION ALL SELECT doc_id, 'doc.n_chars', CAST(n_chars AS VARCHAR) FROM documents
UNION ALL SELECT doc_id, o.path, o.value FROM documents,
  (VALUES ('n', '2.50'), ('big', '1e400'), ('half', chr(65533) || '.'), (chr(65533) || 'k.0', '-0')) o(path, value)""",
    "merge_versions_documents": """SELECT doc_id, 's' AS path, 'second' AS value FROM documents
UNION ALL SELECT doc_id, 'x.y', '1' FROM documents UNION ALL SELECT doc_id, 'x.y', '2' FROM documents
UNION ALL SELECT doc_id, 'a.t', text FROM documents WHERE doc_id % 3 <> 0
UNION ALL SELECT doc_id, 'a', CASE WHEN doc_id % 2 = 0 THEN '{}' ELSE source END FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT -1, 'k' || doc_id || '.half', chr(65533) FROM documents
UNION ALL SELECT -1, 'n', max(doc_id) || '.50' FROM documents""",
    "record_hashes": """SELECT c_custkey, md5('{"c_acctbal": ' || c_acctbal || ', "c_custkey": ' || c_custkey || ', "c_mktsegment": '
  || CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || ', "c_name": "' || c_name || '"}') AS md5 FROM customer""",
    "pagination_chain": """WITH RECURSIVE p AS (
  SELECT 'http://site.example/p/' || page_id AS url,
    'http://site.example/p/' || (CASE WHEN page_id % 50 = 49 THEN page_id - 20 ELSE page_id + 1 END) AS next_url FROM pages),
walk(url, depth) AS (
  SELECT url, 0 FROM p WHERE url NOT IN (SELECT next_url FROM p)
  UNION SELECT n.url, w.depth + 1 FROM walk w JOIN p ON p.url = w.url JOIN p n ON n.url = p.next_url WHERE w.depth < 60)
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY url""",
    "extract_plain_selector": "SELECT page_id, CAST(0 AS INTEGER) AS item_pos, 'on' AS text, 'on' AS self FROM pages",
    "run_result": """SELECT page_id, CAST(0 AS INTEGER) AS item_pos, page_id AS num, 'http://h.example/a/r/' || page_id AS link,
  'd' || page_id AS own, CASE WHEN page_id <> 3 THEN 12 / (page_id - 3) END AS ratio, CAST(NULL AS INTEGER) AS as_int
FROM pages WHERE page_id % 5 <> 0 AND page_id % 7 <> 0""",
    "run_rejected": """SELECT 'records' AS target_name, page_id, CAST(0 AS INTEGER) AS item_pos,
  CASE WHEN page_id % 7 = 0 THEN 'extract' ELSE 'validate' END AS stage,
  CASE WHEN page_id % 7 = 0 THEN 'item: ValueError: Invalid IPv6 URL' ELSE 'num:type_int' END AS reason
FROM pages WHERE page_id % 5 = 0 OR page_id % 7 = 0""",
    "run_all_targets": f"""SELECT 'records' AS target_name, page_id, CAST(0 AS INTEGER) AS item_pos, CAST(page_id AS VARCHAR) AS num,
  CAST(NULL AS VARCHAR) AS title FROM pages WHERE page_id % 5 <> 0 AND page_id % 7 <> 0
UNION ALL SELECT 'heads', page_id, 0, NULL, {cs(TITLE)} FROM pages""",
    "run_all_failures": """SELECT 'records' AS target_name, 'extract' AS stage, count(*) AS n FROM pages WHERE page_id % 7 = 0
UNION ALL SELECT 'records', 'validate', count(*) FROM pages WHERE page_id % 7 <> 0 AND page_id % 5 = 0
UNION ALL SELECT 'wrong', 'spec', 1""",
    "run_record": """WITH n AS (SELECT count_if(page_id % 7 <> 0) AS scraped, count_if(page_id % 7 = 0 OR page_id % 5 = 0) AS failed,
  count_if(page_id % 7 <> 0 AND page_id % 5 <> 0) AS good FROM pages)
SELECT r.run_id, 'records' AS target_name, 'success' AS status, scraped AS scraped_count, failed AS failed_count,
  good AS processed_count, CASE WHEN r.run_id = 'r3' THEN 0 ELSE good END AS saved_count,
  CASE WHEN r.run_id = 'r3' THEN 0 ELSE good END AS stored FROM n, (VALUES ('r1'), ('r2'), ('r3')) r(run_id)""",
    "run_outputs": """WITH r AS (SELECT unnest(['r1', 'r2']) AS run_id),
n AS (SELECT count_if(page_id % 7 <> 0) AS scraped, count_if(page_id % 7 = 0) AS bad, count_if(page_id % 7 <> 0 AND page_id % 5 = 0) AS out,
  count_if(page_id % 7 <> 0 AND page_id % 5 <> 0) AS good, count(*) AS n FROM pages),
v AS (SELECT 'records' AS target_name, unnest(['log: scraped', 'log: failed', 'log: processed', 'log: saved', 'results', 'rejected', 'errors']) AS output,
    unnest([scraped, bad + out, good, good, good, out, bad]) AS n FROM n
  UNION ALL SELECT 'heads', unnest(['log: scraped', 'log: failed', 'log: processed', 'log: saved', 'results']), unnest([n, 0, n, n, n]) FROM n
  UNION ALL SELECT 'wrong', unnest(['log: scraped', 'log: failed', 'log: processed', 'log: saved', 'errors']), unnest([0, 1, 0, 0, 1]))
SELECT run_id, target_name, output, n FROM r, v""",
    "csv_append_union": """SELECT CAST(NULL AS VARCHAR) AS a, CAST(NULL AS DOUBLE) AS c_big, CAST(c_custkey AS VARCHAR) AS c_custkey,
  CASE i WHEN 1 THEN c_name ELSE c_name || chr(10) || c_mktsegment END AS c_name,
  CAST(NULL AS INTEGER) AS digits FROM customer, (VALUES (1), (2)) v(i)
UNION ALL SELECT 'x', round(c_acctbal * 1e6, 2), CAST(c_custkey AS VARCHAR), NULL, len(CAST(c_acctbal * 1e6 AS VARCHAR)) FROM customer""",
    "csv_dialect": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'a;"b"; ' || o_orderpriority AS note FROM orders""",
    "table_own_id": "SELECT c_custkey * 3 AS id, c_name, 't' AS target_name FROM customer",
    "table_bad_json": """SELECT c_custkey, c_name, (SELECT count(*) FROM customer) AS stored FROM customer WHERE c_custkey % 4 <> 0""",
    "counts_and_clear": """SELECT k.kind, count(*) AS stored, 0 AS after_clear FROM customer, (VALUES ('csv'), ('jsonl'), ('table')) k(kind)
GROUP BY k.kind UNION ALL SELECT 'new table', 1, 0""",
    "output_names": """SELECT c_mktsegment, count(*) AS n,
  'out/target_name=' || c_mktsegment || '/run_id=r1/' || c_mktsegment || '_20240506_070809.csv' AS path FROM customer GROUP BY 1""",
    "drop_empty": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 > 0",
    "cleaning_stats_cleaned": f"""WITH n AS (SELECT count(*) AS n, count(DISTINCT {cs("'  ' || text || repeat(' ', CAST(doc_id % 3 AS INTEGER))")}) AS k FROM documents)
SELECT n AS original_count, k AS cleaned_count, n - k AS removed_count, round((n - k) / n, 6) AS removal_rate FROM n""",
    "convert_large_and_unknown": """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '0000000.5' AS big, o_orderstatus AS same FROM orders
WHERE o_orderkey > 0 UNION ALL SELECT o_orderkey, '0.5', o_orderstatus FROM orders WHERE o_orderkey = 0""",
    "convert_json_whole": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '[1]|[' || user_id || ']' ELSE CAST(user_id AS VARCHAR) END AS a,
  CASE WHEN event_id % 2 = 1 THEN json_extract_string(props, '$.k') END AS k, event_id % 2 = 0 AS failed FROM events""",
    "null_on_error": """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 2 THEN round((l_orderkey + 1) / (l_linenumber - 2), 6) END AS ratio,
  CAST(NULL AS INTEGER) AS as_int, CASE WHEN l_linenumber <= 2 THEN CAST(l_linenumber AS INTEGER) END AS third FROM lineitem""",
    "registry_functions": "SELECT doc_id, n_chars, n_chars * 2 AS twice, right(text, 3) AS tail FROM documents",
    "registry_generators": """SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, CAST(len(parts[i]) AS INTEGER) AS n, CAST(2 * len(parts[i]) AS INTEGER) AS twice
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, '. ') AS parts FROM documents))""",
    "bad_urls": """SELECT page_id, CASE page_id % 6 WHEN 0 THEN NULL WHEN 4 THEN 'other.example' ELSE '' END AS domain,
  CASE page_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'https://base.example/x/' || page_id WHEN 2 THEN 'https://base.example/x/y/z?q=' || page_id
    WHEN 3 THEN 'https://base.example/x/y/a/' || page_id WHEN 4 THEN 'https://other.example/' || page_id
    ELSE 'https://base.example/r/' || page_id END AS norm FROM pages""",
    "scrape_counters": """SELECT event_type, count(*) AS scraped, count_if(event_type = 'purchase') AS saved,
  count_if(event_type <> 'error') AS processed, count_if(event_type = 'error') AS failed FROM events GROUP BY 1""",
    "active_runs": """WITH r AS (SELECT user_id, bool_or(event_type = 'click') AS b, bool_or(event_type = 'purchase') AS e FROM events GROUP BY 1)
SELECT count_if(b AND NOT e) AS active_runs, count_if(NOT b AND NOT e) AS queue_size FROM r""",
    "gauge_course": f"""{COURSE} SELECT strftime(ts, {TS6}) AS ts, CAST(active AS BIGINT) AS active, CAST(queue AS BIGINT) AS queue FROM c""",
    "gauge_peaks": f"""{COURSE}, g AS (SELECT ts, 'active' AS gauge, active AS v FROM c UNION ALL SELECT ts, 'queue', queue FROM c)
SELECT gauge, CAST(max(v) AS BIGINT) AS peak, strftime(arg_min(ts, (-v, ts)), {TS6}) AS peak_at, CAST(arg_max(v, ts) AS BIGINT) AS last_value FROM g GROUP BY gauge""",
    "processed_at": "SELECT doc_id, true AS has_time FROM documents",
    "redact": """SELECT '***REDACTED***' AS c_custkey, c_name, '***REDACTED***' AS c_nationkey, c_acctbal, c_mktsegment,
  '***REDACTED***' AS api_token, c_mktsegment AS segment FROM customer""",

    "redact_json": """SELECT event_id, '{"id": ' || event_id || ', "AUTH":"***REDACTED***", "l":[{"api_Token" : "***REDACTED***", "n": 1.50}, "token"],"p":{"q":'
  || props || '}}' AS doc, '***REDACTED***' AS auth, '***REDACTED***' AS token, props ->> '$.k' AS k,
  '***REDACTED***' AS secret_event_type, CAST(NULL AS BIGINT) AS secret_user_id, event_type AS plain_event_type, user_id AS plain_user_id FROM events""",
    "search_hot": "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'error' AND user_id = 69",
    "search_eq": """SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'error' AND props = '{"k": 69}'""",
    "filter_field": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "newest_topk": f"SELECT event_id, strftime(ts, {TS6}) AS ts FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 10",
    "target_filter": "SELECT o_orderkey, o_totalprice, o_orderpriority AS target_name FROM orders WHERE o_orderpriority = '2-HIGH'",

    "csv_roundtrip": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name || chr(13) || chr(10) || '"x",' || chr(10), CAST(c_nationkey AS VARCHAR),
  CAST(c_acctbal AS VARCHAR), c_mktsegment FROM customer""",
    "jsonl_roundtrip": "SELECT * FROM conversations",
    "jsonl_ascii_roundtrip": "SELECT doc_id, text FROM documents",
    "table_roundtrip": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'r1' AS run_id,
  c_mktsegment AS target_name FROM customer""",
    "export_target": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority, 'r1' AS run_id,
  o_orderpriority AS target_name FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "backup_convert": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, replace(p_type, ' ', chr(13) || chr(10)) AS p_type,
  CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
    "storage_info": """SELECT 'customer_csv' AS storage, true AS exists, 0 AS files_unknown,
  CAST(sum(len(CAST(c_custkey AS VARCHAR)) + strlen(c_name) + len(CAST(c_nationkey AS VARCHAR)) + len(CAST(c_acctbal AS VARCHAR))
    + strlen(c_mktsegment) + 15) AS BIGINT) AS data_bytes, count(*) AS row_count FROM customer""",

    "extract_title": f"SELECT page_id, {TITLE} AS title FROM pages",
    "extract_nav_links": NAV_LINKS,
    "next_link": f"SELECT page_id, next_url FROM ({FIRST_LINK})",
    "pagination_walk": f"""WITH RECURSIVE edges AS (SELECT url, next_url FROM ({FIRST_LINK}) WHERE next_url IS NOT NULL),
walk(url, depth) AS (SELECT url, 0 FROM pages
  UNION SELECT e.next_url, w.depth + 1 FROM walk w JOIN edges e ON w.url = e.url WHERE w.depth + 1 < 3)
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE url IN (SELECT url FROM pages) GROUP BY url""",
    "multi_target_extract": f"""SELECT 'titles' AS target_name, page_id, CAST(0 AS INTEGER) AS item_pos, {TITLE} AS title,
  CAST(NULL AS VARCHAR) AS ad_text FROM pages
UNION ALL
SELECT 'ads' AS target_name, page_id, CAST(generate_subscripts(ads, 1) - 1 AS INTEGER) AS item_pos,
  CAST(NULL AS VARCHAR) AS title, {strip(unescape('unnest(ads)'))} AS ad_text
FROM (SELECT page_id, regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1) AS ads FROM pages)""",

    "items_by_label": """SELECT event_type, strftime(ts, '%Y-%m-%d') AS run_day, count(*) AS items,
  round(sum(value), 4) AS value_sum FROM events GROUP BY 1, 2""",
    "requests_by_status": """SELECT user_id, CASE WHEN event_type <> 'error' THEN 'success' ELSE 'error' END AS status,
  count(*) AS requests FROM events GROUP BY 1, 2""",
    "duration_histogram": """SELECT event_type, count_if(value <= 0.1) AS le_0_1, count_if(value <= 0.5) AS le_0_5,
  count_if(value <= 1.0) AS le_1, count_if(value <= 2.5) AS le_2_5, count_if(value <= 5.0) AS le_5,
  count_if(value <= 10.0) AS le_10, count_if(value <= 25.0) AS le_25, count_if(value <= 50.0) AS le_50,
  count_if(value <= 100.0) AS le_100, count(value) AS le_inf, round(sum(value), 4) AS duration_sum,
  count(value) AS duration_count FROM events GROUP BY event_type""",
    "last_run": f"""SELECT user_id, arg_max(event_type, row(ts, event_id)) AS last_value, strftime(max(ts), {TS6}) AS last_attempt,
  strftime(max(CASE WHEN event_type <> 'error' THEN ts END), {TS6}) AS last_success FROM events GROUP BY user_id""",
    "run_summary": """SELECT count_if(ok) AS completed, count_if(NOT ok) AS failed,
  CAST(sum(CASE WHEN ok THEN CAST(event_type = 'purchase' AS BIGINT) ELSE 0 END) AS BIGINT) AS total_saved,
  round(coalesce(sum(CASE WHEN ok THEN value END), 0.0), 4) AS total_duration,
  round(coalesce(sum(CASE WHEN ok THEN value END) / nullif(count_if(ok), 0), 0.0), 4) AS avg_duration
  FROM (SELECT *, event_type <> 'error' AS ok FROM events)""",
    "job_counts": """SELECT count(*) AS total_runs, count_if(event_type <> 'error') AS successful_runs,
  count_if(event_type = 'error') AS failed_runs FROM events""",
    "check_suite": """WITH a AS (SELECT count_if(o_orderkey IS NULL) AS c0, count_if(o_totalprice < 0) AS c1,
  count_if(o_orderstatus NOT IN ('F', 'O', 'P')) AS c2, count(*) - count(DISTINCT o_orderkey) AS c3,
  count_if(o_orderpriority = '5-LOW') AS c4 FROM orders)
SELECT 'orderkey_not_null' AS check_name, c0 AS failing, CASE WHEN c0 = 0 THEN 'healthy' ELSE 'unhealthy' END AS status FROM a
UNION ALL SELECT 'totalprice_non_negative', c1, CASE WHEN c1 = 0 THEN 'healthy' ELSE 'unhealthy' END FROM a
UNION ALL SELECT 'status_domain', c2, CASE WHEN c2 = 0 THEN 'healthy' ELSE 'unhealthy' END FROM a
UNION ALL SELECT 'orderkey_unique', c3, CASE WHEN c3 = 0 THEN 'healthy' ELSE 'unhealthy' END FROM a
UNION ALL SELECT 'no_low_priority', c4, CASE WHEN c4 = 0 THEN 'healthy' ELSE 'unhealthy' END FROM a
UNION ALL SELECT 'overall', c0 + c1 + c2 + c3 + c4,
  CASE WHEN c0 + c1 + c2 + c3 + c4 = 0 THEN 'healthy' ELSE 'unhealthy' END FROM a""",
    "storage_health": """SELECT 'customer' AS storage, 'healthy' AS status, count(*) AS row_count FROM customer
UNION ALL SELECT 'no_such_table', 'unhealthy', NULL""",
    "quality_report": """SELECT count(*) AS rows,
  CAST(sum(CAST(doc_id IS NULL AS BIGINT) + CAST(text IS NULL AS BIGINT) + CAST(lang IS NULL AS BIGINT)
      + CAST(source IS NULL AS BIGINT) + CAST(n_chars IS NULL AS BIGINT)) AS BIGINT) AS null_cells,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM documents)) AS duplicate_rows FROM documents""",

    "run_target_dry": f"""WITH l AS ({NAV_LINKS}),
c AS (SELECT page_id, item_pos, CASE WHEN text IS NULL OR text = '' THEN 'N/A' ELSE text END AS text, href FROM l),
d AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, item_pos) = 1)
SELECT page_id, item_pos, {cs('text')} AS text, {cs('href')} AS link, {netloc(cs('href'))} AS domain,
  CAST(length({cs('text')}) AS BIGINT) AS text_length, 'dry' AS run_id, 'nav' AS target_name FROM d""",

    "stream_incremental": f"""SELECT event_id, user_id, upper({cs('event_type')}) AS kind, value * 2 AS value_x2 FROM events""",
    "stream_dedupe": """SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
}


def _bigint_count_if(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT. Cast every call."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


SQL = {k: _bigint_count_if(v) for k, v in SQL.items()}
