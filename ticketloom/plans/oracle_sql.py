"""DuckDB SQL of every query with an oracle (run by the driver over the
pre-registered parquet views).  Each statement inlines the fixture rule as
a CTE and spells the semantics out independently of the Spark code."""

from __future__ import annotations


from ticketloom import fixed_values as FV


def _lit(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_lit(v) for v in values) + "]"


def _path(key: str) -> str:
    return "'$.\"" + key + "\"'"


def jtype(j: str, key: str) -> str:
    return f"json_type({j}, {_path(key)})"


def jtext(j: str, key: str) -> str:
    """Any non-null value as text (JSON null and absence -> NULL)."""
    return f"json_extract_string({j}, {_path(key)})"


def jstr(j: str, key: str) -> str:
    """String values only."""
    return f"CASE WHEN {jtype(j, key)} = 'VARCHAR' THEN {jtext(j, key)} END"


def jhas(j: str, key: str) -> str:
    return f"({jtype(j, key)} IS NOT NULL)"


def jjson(j: str, key: str) -> str:
    """Canonical JSON text of a value; NULL for absent and JSON null."""
    return f"NULLIF(CAST(json_extract({j}, {_path(key)}) AS VARCHAR), 'null')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def is_object(x: str) -> str:
    return (f"COALESCE(CASE WHEN {x} IS NOT NULL AND {x} <> '' AND json_valid({x}) "
            f"THEN json_type({x}) = 'OBJECT' END, FALSE)")


def case_map(x: str, mapping: dict, default: str | None) -> str:
    arms = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"COALESCE(CASE {x} {arms} END, {_lit(default)})"


def md5_int(x: str) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, 15)) AS BIGINT)"


# ---------------------------------------------------------------------------
# fixture CTEs (FIXTURES.md)

_TYPES = ["Complaint", " complaints", "COMPLAINING", "compla intimation", "Inquiry",
          "enquiray ", "assistance", "Request for Assistance", "refund", "inquiry"]
_DESCRIPTIONS = ["Needs LOAN help", "mortgage on my account", "account locked", "something else"]
_SEV = ['"Severity": "low"', '"Severity": " Medium"', '"Severity": "HIGH"',
        '"Severity": "critical"', '"Severity": "urgent"', '"Severity": null', None]
_COMM = ['"Preferred Communication": "Email"', '"Preferred Communication": "phone "',
         '"Preferred Communication": "Not Specified"', '"Preferred Communication": "chat"',
         '"Preferred Communication": "in-person"', None]

RAW_TICKETS = f"""raw_tickets AS (
  SELECT doc_id AS row_index, text AS input,
    CASE WHEN doc_id % 97 = 0 THEN '{{"Ticket Type": "complaint"'
         WHEN doc_id % 89 = 0 THEN '[1, 2]'
         WHEN doc_id % 83 = 0 THEN NULL
         WHEN doc_id % 79 = 0 THEN '{{"Ticket Type": 5, "Severity": "low"}}'
         WHEN doc_id % 73 = 0 THEN '{{"Ticket Type": "inquiry", "Title": 7, "Description": {{"a":1}}, "Severity": "low", "Department Impacted": true, "Service Impacted": ["x",2]}}'
         ELSE '{{' || concat_ws(', ',
           '"Ticket Type": "' || ({_list(_TYPES)})[doc_id % 10 + 1] || '"',
           '"Title": "Ticket ' || CAST(doc_id AS VARCHAR) || '"',
           '"Description": "' || ({_list(_DESCRIPTIONS)})[doc_id % 4 + 1] || '"',
           ({_list(_SEV)})[doc_id % 7 + 1],
           '"Department Impacted": "Dept ' || CAST(doc_id % 13 AS VARCHAR) || '"',
           '"Service Impacted": "Service ' || CAST(doc_id % 3 AS VARCHAR) || '"',
           ({_list(_COMM)})[doc_id % 6 + 1],
           CASE WHEN doc_id % 250 = 6 THEN '"Assistance Request": "loan"' END) || '}}'
    END AS output
  FROM documents)"""

_RAW_COLS = {k: k.lower().replace(" ", "_") for k in FV.RAW_KEYS}

PARSED = f"""parsed AS (
  SELECT row_index, original_input, j,
    {", ".join(f"{jtext('j', k)} AS {c}" for k, c in _RAW_COLS.items())}
  FROM (SELECT row_index, input AS original_input,
               CASE WHEN {is_object('output')} THEN output END AS j FROM raw_tickets)
  WHERE j IS NOT NULL)"""

_COMM_CLEAN = strip(f"lower({jstr('j', 'Preferred Communication')})")

CLEAN = f"""clean AS (
  SELECT row_index, original_input, j,
    {case_map(strip(f"lower({jstr('j', 'Ticket Type')})"), FV.TICKET_TYPE_MAPPING, FV.TICKET_TYPE_DEFAULT)} AS ticket_type,
    {case_map(strip(f"lower({jstr('j', 'Severity')})"), FV.SEVERITY_MAPPING, FV.SEVERITY_DEFAULT)} AS severity,
    CASE WHEN {_COMM_CLEAN} = 'not specified' THEN 'email' ELSE {_COMM_CLEAN} END AS preferred_communication,
    title, description, department_impacted, service_impacted, assistance_request
  FROM parsed)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


T = with_(RAW_TICKETS)
P = with_(RAW_TICKETS, PARSED)
C = with_(RAW_TICKETS, PARSED, CLEAN)


def pct(n: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN round(CAST(100.0 AS DOUBLE) * {n} / {total}, 6) END"


ORACLE: dict[str, str] = {}

ORACLE["parse_counts"] = T + f"""
SELECT count(*) FILTER (WHERE {is_object('output')}) AS parsed,
       count(*) FILTER (WHERE NOT {is_object('output')}) AS parse_errors
FROM raw_tickets"""

ORACLE["parse_tickets"] = P + f"""
SELECT row_index, original_input, {", ".join(_RAW_COLS.values())} FROM parsed"""

ORACLE["clean_tickets"] = C + """
SELECT row_index, ticket_type, severity, preferred_communication, title, description,
       department_impacted, service_impacted, assistance_request FROM clean"""

ORACLE["type_distribution"] = C + f"""
SELECT ticket_type AS value, count(*) AS n,
       {pct('count(*)', '(SELECT count(*) FROM clean)')} AS pct
FROM clean WHERE ticket_type IS NOT NULL GROUP BY ticket_type"""

ORACLE["severity_distribution"] = C + f"""
SELECT severity AS value, count(*) AS n,
       {pct('count(*)', '(SELECT count(*) FROM clean)')} AS pct
FROM clean WHERE severity IS NOT NULL GROUP BY severity"""

_TOTAL = "(SELECT count(*) FROM clean)"

ORACLE["discover_keys"] = P + """
SELECT key, count(*) AS n_rows FROM (SELECT unnest(json_keys(j)) AS key FROM parsed) GROUP BY key"""

ORACLE["assistance_tickets"] = P + f"""
SELECT row_index, ticket_type FROM parsed
WHERE COALESCE(contains(lower({jstr('j', 'Ticket Type')}), 'assistance'), FALSE)"""

ORACLE["high_severity"] = C + """
SELECT row_index, severity FROM clean WHERE severity IN ('high', 'critical')"""

ORACLE["non_standard_types"] = P + f"""
SELECT row_index, ticket_type FROM parsed
WHERE NOT COALESCE(ticket_type IN ({", ".join(_lit(x) for x in FV.STANDARD_TYPES)}), FALSE)"""

ORACLE["very_short_inputs"] = P + """
SELECT row_index, CAST(length(original_input) AS BIGINT) AS n_chars FROM parsed
WHERE length(original_input) < 10"""

ORACLE["clean_by_lookup_join"] = f"""
SELECT o_orderkey,
  {case_map(strip("lower(string_split(o_orderpriority, '-')[-1])"), FV.SEVERITY_MAPPING, FV.SEVERITY_DEFAULT)} AS severity
FROM orders"""

ORACLE["dataset_overview"] = T + """
SELECT count(*) AS total_records, CAST(2 AS BIGINT) AS n_columns, 'input, output' AS columns
FROM raw_tickets"""

ORACLE["raw_distributions"] = P + "\n UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM parsed WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ["ticket_type", "severity", "department_impacted", "service_impacted"])

ORACLE["quality_summary"] = C + """
SELECT count(*) AS total_records, count(DISTINCT ticket_type) AS unique_ticket_types,
       count(DISTINCT severity) AS unique_severities FROM clean"""

_MISSING = f"""keys_ AS (
  SELECT row_index, j, unnest(json_keys(j)) AS key, unnest(range(len(json_keys(j)))) AS pos FROM clean),
missing_all AS (
  SELECT key AS "column", {_TOTAL} - count(*) FILTER (WHERE nn) AS n_missing, min(row_index) AS fr,
         arg_min(pos, row_index) AS fp FROM (
    SELECT key, row_index, pos, CASE WHEN key IN ('Ticket Type', 'Severity') THEN TRUE
                     WHEN key = 'Preferred Communication' THEN json_type(j, '$."' || key || '"') = 'VARCHAR'
                     ELSE json_type(j, '$."' || key || '"') <> 'NULL' END AS nn
    FROM keys_) GROUP BY key
  UNION ALL
  SELECT 'original_input', count(*) FILTER (WHERE original_input IS NULL), min(row_index),
         arg_min(len(json_keys(j)), row_index) FROM clean),
missing AS (SELECT "column", n_missing, fr AS first_row, CAST(fp AS BIGINT) AS first_pos FROM missing_all)"""

ORACLE["missing_values"] = with_(RAW_TICKETS, PARSED, CLEAN, _MISSING) + f"""
SELECT "column", first_row, first_pos, n_missing, {pct('n_missing', _TOTAL)} AS pct FROM missing WHERE n_missing > 0"""


def _length_stats(src: str, col: str) -> str:
    n = f"length({col})"
    return f"""SELECT round(avg({n}), 6) AS mean, round(CAST(median({n}) AS DOUBLE), 6) AS median,
       CAST(min({n}) AS BIGINT) AS min, CAST(max({n}) AS BIGINT) AS max,
       round(stddev_samp({n}), 6) AS std FROM {src}"""


ORACLE["length_stats"] = P + _length_stats("parsed", "original_input")
ORACLE["document_length_stats"] = _length_stats("documents", "text")

ORACLE["profile_by_day"] = """
SELECT lang, count(*) AS n_rows, count(text) AS n_texts, round(avg(length(text)), 6) AS mean,
       round(stddev_samp(length(text)), 6) AS std, CAST(min(length(text)) AS BIGINT) AS min,
       CAST(max(length(text)) AS BIGINT) AS max, count(DISTINCT source) AS unique_source,
       count(DISTINCT text) AS unique_digest, true AS median_within, true AS source_within, true AS digest_within
FROM documents GROUP BY lang"""

ORACLE["duplicate_inputs"] = P + """
SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM parsed GROUP BY original_input)"""

ORACLE["duplicate_rows"] = """
SELECT doc_id, doc_id <> min(doc_id) OVER (PARTITION BY text) AS is_duplicate FROM documents"""


def _edge(b: str) -> str:
    return f"CASE WHEN {b} = 50 THEN hi ELSE CAST({b} AS DOUBLE) * step + lo END"


ORACLE["length_histogram"] = with_(RAW_TICKETS, PARSED, """L AS (
  SELECT CAST(length(original_input) AS DOUBLE) AS x FROM parsed WHERE original_input IS NOT NULL)""",
  """R AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                  CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM L)""",
  """S AS (SELECT lo, hi, (hi - lo) / 50 AS step FROM R)""",
  """B0 AS (SELECT x, lo, hi, step,
             LEAST(GREATEST(CAST(floor((x - lo) * (50 / (hi - lo))) AS BIGINT), 0), 49) AS b0 FROM L, S)""",
  f"""B1 AS (SELECT x, lo, hi, step, CASE WHEN x < {_edge('b0')} THEN b0 - 1 ELSE b0 END AS b1 FROM B0)""",
  f"""B2 AS (SELECT CASE WHEN b1 <> 49 AND x >= {_edge('b1 + 1')} THEN b1 + 1 ELSE b1 END AS bin FROM B1)""",
  """CNT AS (SELECT bin, count(*) AS n FROM B2 GROUP BY bin)""") + f"""
SELECT g.bin, {_edge('g.bin')} AS lo, {_edge('g.bin + 1')} AS hi, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(50)) g CROSS JOIN S LEFT JOIN CNT c ON c.bin = g.bin"""

ORACLE["top_departments"] = C + f"""
SELECT department_impacted AS value, count(*) AS n, {pct('count(*)', _TOTAL)} AS pct
FROM clean WHERE department_impacted IS NOT NULL GROUP BY department_impacted
ORDER BY n DESC, value LIMIT 10"""

_STD = ", ".join(_lit(x) for x in FV.STANDARD_TYPES)

ORACLE["quality_report"] = with_(RAW_TICKETS, PARSED, CLEAN, _MISSING, f"""sc AS (
  SELECT count(*) AS total, count(DISTINCT ticket_type) AS ut, count(DISTINCT severity) AS us,
         avg(len) AS mean, CAST(median(len) AS DOUBLE) AS med, min(len) AS mn, max(len) AS mx,
         stddev_samp(len) AS sd, count(*) FILTER (WHERE len < 10) AS short,
         count(*) FILTER (WHERE NOT COALESCE(ticket_type IN ({_STD}), FALSE)) AS nonstd
  FROM (SELECT *, length(original_input) AS len FROM clean))""",
  """dup AS (SELECT COALESCE(sum(n - 1), 0) AS d FROM (SELECT count(*) AS n FROM clean GROUP BY original_input))""",
  f"""dist AS (
  SELECT 'ticket_type' AS section, ticket_type AS key, count(*) AS n FROM clean GROUP BY ticket_type
  UNION ALL SELECT 'severity', severity, count(*) FROM clean GROUP BY severity
  UNION ALL SELECT 'department', department_impacted, count(*) FROM clean
            WHERE department_impacted IS NOT NULL GROUP BY department_impacted)""",
  """ranked AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY n DESC, key) AS ord FROM dist)""",
  f"""lines AS (
SELECT 'overview' AS section, CAST(1 AS BIGINT) AS ord, 'Total Records' AS key, CAST(total AS BIGINT) AS n,
       CAST(NULL AS DOUBLE) AS pct, CAST(NULL AS DOUBLE) AS value FROM sc
UNION ALL SELECT 'overview', 2, 'Unique Ticket Types', ut, NULL, NULL FROM sc
UNION ALL SELECT 'overview', 3, 'Unique Severities', us, NULL, NULL FROM sc
UNION ALL SELECT 'input_length', 1, 'Mean', NULL, NULL, round(mean, 6) FROM sc
UNION ALL SELECT 'input_length', 2, 'Median', NULL, NULL, round(med, 6) FROM sc
UNION ALL SELECT 'input_length', 3, 'Min', NULL, NULL, CAST(mn AS DOUBLE) FROM sc
UNION ALL SELECT 'input_length', 4, 'Max', NULL, NULL, CAST(mx AS DOUBLE) FROM sc
UNION ALL SELECT 'input_length', 5, 'Std Dev', NULL, NULL, round(sd, 6) FROM sc
UNION ALL SELECT 'issues', 1, 'very_short_inputs', short, NULL, NULL FROM sc WHERE short > 0
UNION ALL SELECT 'issues', 2, 'duplicate_inputs', d, NULL, NULL FROM dup WHERE d > 0
UNION ALL SELECT 'issues', 3, 'non_standard_types', nonstd, NULL, NULL FROM sc WHERE nonstd > 0
UNION ALL SELECT section, ord, key, n, {pct('n', _TOTAL)}, NULL FROM ranked WHERE section <> 'department' OR ord <= 10)""") + f"""
SELECT section, ord, CAST(0 AS BIGINT) AS ord2, key, n, pct, value FROM lines
UNION ALL SELECT 'missing', first_row, first_pos, "column", n_missing, {pct('n_missing', _TOTAL)}, NULL
FROM missing WHERE n_missing > 0"""

# -- text mining ----------------------------------------------------------------

_WORD_RUN = r"[\p{L}\p{N}_]+"


def words(x: str) -> str:
    return f"list_filter(regexp_extract_all(lower({x}), '{_WORD_RUN}'), lambda w: regexp_full_match(w, '[a-z]+'))"


ORACLE["word_tokens"] = f"""
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, md5(array_to_string(w, ' ')) AS words_md5
FROM (SELECT doc_id, {words('text')} AS w FROM documents)"""

ORACLE["word_counts"] = f"""
SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest({words('text')}) AS word FROM documents)
GROUP BY lang, word"""


def _stop(words_: list[str]) -> str:
    return ", ".join(_lit(w) for w in words_)


def top_keywords_sql(src: str, group: str | None, top: int, stop: list[str]) -> str:
    """src has columns (group?, word, n)."""
    part = f"PARTITION BY {group}" if group else ""
    g = f"{group}, " if group else ""
    return f"""(SELECT {g}CAST(row_number() OVER ({part} ORDER BY rk) AS BIGINT) AS "rank", word, n FROM (
      SELECT * FROM (SELECT *, row_number() OVER ({part} ORDER BY n DESC, word) AS rk FROM {src})
      WHERE rk <= {top} AND word NOT IN ({_stop(stop)}) AND length(word) >= 3)
    QUALIFY "rank" <= 10)"""


_TYPE_WC = f"""type_wc AS (SELECT ticket_type, word, count(*) AS n FROM (
  SELECT ticket_type, unnest({words('original_input')}) AS word FROM clean WHERE ticket_type IN ({_STD}))
  GROUP BY ticket_type, word)"""
_HIGH_WC = f"""high_wc AS (SELECT word, count(*) AS n FROM (
  SELECT unnest({words('original_input')}) AS word FROM clean WHERE severity IN ('high', 'critical'))
  GROUP BY word)"""

ORACLE["class_keywords"] = with_(RAW_TICKETS, PARSED, CLEAN, _TYPE_WC) + "SELECT * FROM " + \
    top_keywords_sql("type_wc", "ticket_type", 20, FV.TYPE_STOPWORDS)

ORACLE["lang_keywords"] = with_(f"""lang_wc AS (SELECT lang, word, count(*) AS n FROM (
  SELECT lang, unnest({words('text')}) AS word FROM documents) GROUP BY lang, word)""") + \
    "SELECT * FROM " + top_keywords_sql("lang_wc", "lang", 20, FV.TYPE_STOPWORDS)

ORACLE["heavy_lang_keywords"] = ORACLE["lang_keywords"]

ORACLE["high_severity_keywords"] = with_(RAW_TICKETS, PARSED, CLEAN, _HIGH_WC) + "SELECT * FROM " + \
    top_keywords_sql("high_wc", None, 15, FV.HIGH_SEVERITY_STOPWORDS)

ORACLE["class_keywords_top5"] = with_(RAW_TICKETS, PARSED, CLEAN, _TYPE_WC, _HIGH_WC,
    f"""pat AS (
  SELECT ticket_type || '_keywords' AS pattern, "rank", word FROM {top_keywords_sql("type_wc", "ticket_type", 20, FV.TYPE_STOPWORDS)}
  UNION ALL
  SELECT 'high_severity_keywords', "rank", word FROM {top_keywords_sql("high_wc", None, 15, FV.HIGH_SEVERITY_STOPWORDS)})""") + """
SELECT pattern, string_agg(word, ', ' ORDER BY "rank") AS keywords FROM pat WHERE "rank" <= 5 GROUP BY pattern"""

# -- records, loaders, validators -----------------------------------------------

_FIELDS = FV.TICKET_FIELDS
_SAMPLE_OUT = ["sample_id", "user_input", *_FIELDS, "assistance_request", "error"]
_DESC = jstr("j", "Description")

_FREE = {"title": "Title", "description": "Description", "department_impacted": "Department Impacted",
         "service_impacted": "Service Impacted"}


def _typed(j: str, keys: dict) -> str:
    """JSON text of values that are neither strings nor null, as f_j columns."""
    return ", ".join(f"CASE WHEN {jtype(j, k)} NOT IN ('VARCHAR', 'NULL') THEN {jjson(j, k)} END AS {f}_j" for f, k in keys.items())


def _seen(col: str, key: str) -> str:
    """The column, or its default when no ticket has the key."""
    return (f"CASE WHEN (SELECT COALESCE(bool_or({jhas('j', key)}), FALSE) FROM clean) THEN {col} "
            f"ELSE {_lit(FV.RECORD_COLUMN_DEFAULTS[key])} END AS {col}")


RECORDS = f"""records AS (
  SELECT 'records' AS source, row_index AS sample_id, original_input AS user_input, ticket_type, {_seen('title', 'Title')},
         {_seen('description', 'Description')}, severity, {_seen('department_impacted', 'Department Impacted')},
         {_seen('service_impacted', 'Service Impacted')}, {_seen('preferred_communication', 'Preferred Communication')},
         CASE WHEN ticket_type = 'assistance' THEN
           CASE WHEN COALESCE(contains(lower({_DESC}), 'loan'), FALSE) THEN 'loan assistance'
                WHEN COALESCE(contains(lower({_DESC}), 'mortgage'), FALSE) THEN 'mortgage assistance'
                WHEN COALESCE(contains(lower({_DESC}), 'account'), FALSE) THEN 'account assistance'
                ELSE 'general assistance' END END AS assistance_request,
         CAST(NULL AS VARCHAR) AS error, {_typed('j', _FREE)}
  FROM clean)"""
R_ = with_(RAW_TICKETS, PARSED, CLEAN, RECORDS)

ORACLE["training_records"] = R_ + f"SELECT {', '.join(_SAMPLE_OUT)} FROM records"

ORACLE["assistance_request"] = R_ + """
SELECT sample_id, assistance_request FROM records WHERE assistance_request IS NOT NULL"""

_LD = FV.LOADER_DEFAULTS


def _get_or(j: str, key: str, default: str) -> str:
    return f"CASE WHEN {jhas(j, key)} THEN {jtext(j, key)} ELSE {_lit(default)} END"


_LOW3 = ["Ticket Type", "Severity", "Preferred Communication"]
LOADED = f"""loaded AS (
  SELECT 'loader' AS source, row_index AS sample_id, input AS user_input,
    lower({_get_or('j', 'Ticket Type', _LD['Ticket Type'])}) AS ticket_type,
    {_get_or('j', 'Title', _LD['Title'])} AS title,
    {_get_or('j', 'Description', _LD['Description'])} AS description,
    lower({_get_or('j', 'Severity', _LD['Severity'])}) AS severity,
    {_get_or('j', 'Department Impacted', _LD['Department Impacted'])} AS department_impacted,
    {_get_or('j', 'Service Impacted', _LD['Service Impacted'])} AS service_impacted,
    lower({_get_or('j', 'Preferred Communication', _LD['Preferred Communication'])}) AS preferred_communication,
    CASE WHEN lower({_get_or('j', 'Ticket Type', _LD['Ticket Type'])}) = 'assistance'
         THEN 'general assistance' END AS assistance_request,
    CAST(NULL AS VARCHAR) AS error,
    j IS NOT NULL AND {" AND ".join(f"COALESCE({jtype('j', k)} = 'VARCHAR', {jtype('j', k)} IS NULL)" for k in _LOW3)} AS ok
  FROM (SELECT row_index, input, CASE WHEN {is_object('output')} THEN output END AS j FROM raw_tickets))"""

ORACLE["load_defaults"] = with_(RAW_TICKETS, LOADED) + f"SELECT {', '.join(_SAMPLE_OUT)} FROM loaded WHERE ok"
ORACLE["load_defaults_events"] = with_("raw_tickets AS (SELECT event_id AS row_index, props AS input, props AS output FROM events)", LOADED) + \
    f"SELECT {', '.join(_SAMPLE_OUT)} FROM loaded WHERE ok"
ORACLE["records_without_department"] = with_(
    RAW_TICKETS.replace("raw_tickets AS (", "raw_0 AS (", 1),
    """raw_tickets AS (SELECT row_index, input,
  regexp_replace(output, '"Department Impacted": "Dept [0-9]+", ', '') AS output FROM raw_0)""", PARSED, CLEAN, RECORDS) + \
    f"SELECT {', '.join(_SAMPLE_OUT)} FROM records"
ORACLE["load_defaults_counts"] = with_(RAW_TICKETS, LOADED) + """
SELECT count(*) AS "rows", count(*) FILTER (WHERE ok) AS loaded, count(*) FILTER (WHERE NOT ok) AS skipped
FROM loaded"""

_EVAL_TYPES = ["complaint", "inquiry", "assistance"]
_EVAL_SEV = ["low", "medium", "high", "critical"]
_OOD_JSON = '{"error": "' + FV.OUT_OF_DOMAIN_ERROR + '"}'


def _member(key: str, value_sql: str) -> str:
    return f"""'"{key}": "' || {value_sql} || '"'"""


def _sample_ticket_sql(i: str) -> str:
    vals = {
        "ticket_type": f"({_list(_EVAL_TYPES)})[{i} % 3 + 1]",
        "title": f"'Title ' || CAST({i} AS VARCHAR)",
        "description": f"'Description ' || CAST({i} AS VARCHAR)",
        "severity": f"({_list(_EVAL_SEV)})[{i} % 4 + 1]",
        "department_impacted": f"'Dept ' || CAST({i} % 5 AS VARCHAR)",
        "service_impacted": f"'Service ' || CAST({i} % 3 AS VARCHAR)",
        "preferred_communication": "'email'",
    }
    members = []
    for k, f in enumerate(_FIELDS):
        m = _member(f, vals[f])
        if f == "title":
            m = f"""CASE WHEN {i} % 40 = 10 THEN '"title": null' ELSE {m} END"""
        members.append(f"CASE WHEN {i} % 40 <> {3 + k} THEN {m} END")
    return (f"CASE WHEN {i} % 12 = 0 THEN {_lit(_OOD_JSON)} "
            f"ELSE '{{' || concat_ws(', ', {', '.join(members)}) || '}}' END")


RAW_SAMPLES = f"""raw_samples AS (
  SELECT doc_id AS sample_id, '{{' || concat_ws(', ',
      CASE WHEN doc_id % 40 <> 1 THEN '"user_input": ' || CAST(to_json(text) AS VARCHAR) END,
      CASE WHEN doc_id % 40 <> 2 THEN '"ticket_data": ' || ({_sample_ticket_sql('doc_id')}) END) || '}}' AS sample_json
  FROM documents)"""

_TD = "td"
VALIDATED = f"""validated AS (
  SELECT 'json' AS source, sample_id, {jtext('sj', 'user_input')} AS user_input,
    {", ".join(f"json_extract_string(sj, '$.ticket_data.{f}') AS {f}" for f in _FIELDS + ["assistance_request", "error"])},
    {", ".join(f"CASE WHEN json_type(sj, '$.ticket_data.{f}') NOT IN ('VARCHAR', 'NULL') THEN CAST(json_extract(sj, '$.ticket_data.{f}') AS VARCHAR) END AS {f}_j" for f in _FREE)},
    COALESCE(sj IS NOT NULL AND {jhas('sj', 'user_input')} AND json_type(sj, '$.ticket_data') = 'OBJECT'
      AND (json_type(sj, '$.ticket_data.error') IS NOT NULL OR
           ({" AND ".join(f"json_type(sj, '$.ticket_data.{f}') IS NOT NULL" for f in _FIELDS)})), FALSE) AS ok
  FROM (SELECT sample_id, CASE WHEN {is_object('sample_json')} THEN sample_json END AS sj FROM raw_samples))"""
V_ = with_(RAW_SAMPLES, VALIDATED)

ORACLE["validate_samples"] = V_ + f"SELECT {', '.join(_SAMPLE_OUT)} FROM validated WHERE ok"
ORACLE["validate_counts"] = V_ + """
SELECT count(*) AS loaded, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS skipped
FROM validated"""


def _values(source: str, rows, first_id: int) -> str:
    out = []
    for k, (text, t) in enumerate(rows):
        vals = [_lit(source), str(first_id - k), _lit(text)] + [_lit(v) for v in t]
        out.append("(" + ", ".join(vals) + ")")
    cols = "source, sample_id, user_input, " + ", ".join(_FIELDS) + ", assistance_request, error"
    return f"SELECT * FROM (VALUES {', '.join(out)}) AS v({cols})"


def _literal_rows(name: str):
    from ticketloom.sources import literals as L
    return {"synthetic": (L.SYNTHETIC, -1), "ood": (L.OUT_OF_DOMAIN, -11),
            "challenge": (L.CHALLENGE, -21)}[name]


SYNTHETIC = "synthetic AS (" + _values("synthetic", *_literal_rows("synthetic")) + ")"
OOD = "ood AS (" + _values("ood", *_literal_rows("ood")) + ")"

_SCOLS = "source, sample_id, user_input, " + ", ".join(_FIELDS) + ", assistance_request, error"
COMBINED = f"""combined AS (
  SELECT {_SCOLS} FROM validated WHERE ok
  UNION ALL SELECT {_SCOLS} FROM loaded WHERE ok
  UNION ALL SELECT {_SCOLS} FROM synthetic)"""
U_ = with_(RAW_TICKETS, LOADED, RAW_SAMPLES, VALIDATED, SYNTHETIC, COMBINED)

ORACLE["combined_samples"] = U_ + f"SELECT {_SCOLS} FROM combined"


def _q(x: str) -> str:
    """``json.dumps`` of a text: ASCII from space to ~ as it is, all else escaped."""
    unit = lambda n: f"'\\u' || format('{{:04x}}', {n})"
    cp = "ord(r)"
    run = (f"CASE WHEN regexp_matches(r, '^[ !#-\\[\\]-~]') THEN r WHEN r = '\"' THEN '\\\"' WHEN r = '\\' THEN '\\\\' "
           f"WHEN {cp} = 8 THEN '\\b' WHEN {cp} = 9 THEN '\\t' WHEN {cp} = 10 THEN '\\n' WHEN {cp} = 12 THEN '\\f' WHEN {cp} = 13 THEN '\\r' "
           f"WHEN {cp} < 65536 THEN {unit(cp)} "
           f"ELSE {unit(f'(({cp} - 65536) >> 10) + 55296')} || {unit(f'(({cp} - 65536) & 1023) + 56320')} END")
    return (f"CASE WHEN {x} IS NULL THEN 'null' ELSE '\"' || list_aggregate(list_transform("
            f"regexp_extract_all({x}, '(?s)[ !#-\\[\\]-~]+|.'), lambda r: {run}) || [''], 'string_agg', '') || '\"' END")


NL = "chr(10)"


def _margin(level: int) -> str:
    return f"{NL} || '{'  ' * level}'"


def _pretty(j: str, level: int) -> str:
    """``json.dumps(indent=2)`` of a value whose members hold no further members."""
    inner, outer = _margin(level + 1), _margin(level)
    return (f"CASE json_type({j}) WHEN 'OBJECT' THEN '{{' || {inner} || array_to_string(list_transform(json_keys({j}), "
            f"lambda k: '\"' || k || '\": ' || CAST(json_extract({j}, '$.\"' || k || '\"') AS VARCHAR)), ',' || {inner}) || {outer} || '}}' "
            f"WHEN 'ARRAY' THEN '[' || {inner} || array_to_string(list_transform(range(CAST(json_array_length({j}) AS BIGINT)), "
            f"lambda k: CAST(json_extract({j}, '$[' || k || ']') AS VARCHAR)), ',' || {inner}) || {outer} || ']' ELSE {j} END")


def ticket_json_sql(level: int = 0) -> str:
    nl, close = _margin(level + 1), f"{_margin(level)} || '}}'"
    sep = f"',' || {nl}"
    free = lambda f: f"CASE WHEN {f}_j IS NOT NULL THEN {_pretty(f'{f}_j', level + 1)} ELSE {_q(f)} END"
    members = [f"""'"{f}": ' || {free(f) if f in _FREE else _q(f)}""" for f in _FIELDS]
    members.append(f"""CASE WHEN assistance_request IS NOT NULL THEN '"assistance_request": ' || {_q('assistance_request')} END""")
    normal = f"'{{' || {nl} || concat_ws({sep}, {', '.join(members)}) || {close}"
    err = f"""'{{' || {nl} || '"error": ' || {_q('error')} || {close}"""
    return f"(CASE WHEN error IS NOT NULL THEN {err} ELSE {normal} END)"


def _sql_text(s: str) -> str:
    """A SQL expression for a Python string that may contain newlines."""
    parts = s.split("\n")
    return f" || {NL} || ".join(_lit(p) for p in parts) if len(parts) > 1 else _lit(s)


_TRAIN_SYS = _sql_text(FV.TRAINING_SYSTEM_PROMPT)
_EVAL_SYS = _sql_text(FV.EVAL_SYSTEM_PROMPT)


def train_prompt_sql() -> str:
    return (f"'<s>[INST] ' || {_TRAIN_SYS} || {NL} || {NL} || user_input || ' [/INST]' || "
            f"{ticket_json_sql()} || '</s>'")


def eval_prompt_sql(user: str) -> str:
    return (f"'<s>[INST] <<SYS>>' || {NL} || {_EVAL_SYS} || {NL} || '<</SYS>>' || {NL} || {NL} || "
            f"{user} || ' [/INST]'")


ORACLE["chat_messages"] = R_ + f"""
SELECT sample_id, CAST(0 AS BIGINT) AS msg_index, 'system' AS role, {_TRAIN_SYS} AS content FROM records
UNION ALL SELECT sample_id, 1, 'user', user_input FROM records
UNION ALL SELECT sample_id, 2, 'assistant', {ticket_json_sql()} FROM records"""

ORACLE["training_prompts"] = R_ + f"SELECT sample_id, {train_prompt_sql()} AS prompt FROM records"

ORACLE["inference_prompts"] = f"""
SELECT conv_id, turn, {eval_prompt_sql('text')} AS prompt FROM conversations WHERE role = 'user'"""

ORACLE["inference_prompts_chat"] = R_ + f"""
SELECT sample_id, '<s>[INST] ' || {_TRAIN_SYS} || {NL} || {NL} || user_input || ' [/INST]' AS prompt FROM records"""

ORACLE["sample_preview"] = V_ + f"""
SELECT sample_id, substring(user_input, 1, 100) AS preview, ticket_type, severity,
       CAST(length({train_prompt_sql()}) AS BIGINT) AS prompt_chars
FROM validated WHERE ok ORDER BY sample_id LIMIT 3"""

# -- balancing, shuffling, splitting --------------------------------------------


def _key(*parts: str) -> str:
    return "md5(concat_ws(':', '42', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "))"


def _hash_int(md5_expr: str) -> str:
    return f"CAST(('0x' || substr({md5_expr}, 1, 15)) AS BIGINT)"


def balance_sql(src: str, cls: str, idc: str, target: int) -> str:
    return f"""ranked AS (
  SELECT {idc}, {cls}, row_number() OVER (PARTITION BY {cls} ORDER BY {_key(idc)}, {idc}) - 1 AS pos,
         count(*) OVER (PARTITION BY {cls}) AS n FROM {src}),
kept AS (SELECT {idc}, {cls}, 0 AS draw FROM ranked WHERE pos < {target}),
cls AS (SELECT DISTINCT {cls}, n FROM ranked WHERE n < {target}),
draws AS (SELECT {cls}, n, CAST(unnest(range(1, {target} - n + 1)) AS INTEGER) AS draw FROM cls),
picked AS (SELECT r.{idc}, d.{cls}, d.draw FROM draws d JOIN ranked r
           ON r.{cls} = d.{cls} AND r.pos = {_hash_int(_key('d.' + cls, 'd.draw'))} % d.n),
allrows AS (SELECT * FROM kept UNION ALL SELECT * FROM picked)
SELECT {idc}, {cls}, draw, row_number() OVER (ORDER BY {_key(cls, idc, 'draw')}, {cls}, {idc}, draw) - 1 AS pos
FROM allrows"""


ORACLE["balance_classes"] = with_(RAW_TICKETS, PARSED, CLEAN, "src AS (SELECT row_index, ticket_type FROM clean)") + \
    ", " + balance_sql("src", "ticket_type", "row_index", FV.BALANCE_TARGET)
ORACLE["balance_orders"] = "WITH " + balance_sql("orders", "o_orderpriority", "o_orderkey", 3000)

ORACLE["balanced_distribution"] = with_(
    RAW_TICKETS, PARSED, CLEAN, "src AS (SELECT row_index, ticket_type FROM clean)") + ", bal AS (WITH " + \
    balance_sql("src", "ticket_type", "row_index", FV.BALANCE_TARGET) + """)
SELECT ticket_type AS value, count(*) AS n FROM bal GROUP BY ticket_type"""

ORACLE["shuffle_rows"] = f"""
SELECT doc_id, row_number() OVER (ORDER BY {_key('doc_id')}, doc_id) - 1 AS pos FROM documents"""

THREE_WAY = f"""three_way AS (
  SELECT *, CASE WHEN pos < t_end THEN 'train' WHEN pos < v_end THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY {_key('sample_id')}, sample_id) - 1 AS pos,
               CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS BIGINT) AS t_end,
               CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) + floor(count(*) OVER () * CAST(0.1 AS DOUBLE)) AS BIGINT) AS v_end
        FROM records)
  UNION ALL SELECT *, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'test' FROM ood)"""
S3_ = with_(RAW_TICKETS, PARSED, CLEAN, RECORDS, OOD, THREE_WAY)

ORACLE["split_three_way"] = S3_ + "SELECT sample_id, split FROM three_way"

ORACLE["split_orders"] = f"""
SELECT o_orderkey, CASE WHEN pos < t_end THEN 'train' WHEN pos < v_end THEN 'validation' ELSE 'test' END AS split
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {_key('o_orderkey')}, o_orderkey) - 1 AS pos,
             CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS BIGINT) AS t_end,
             CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) + floor(count(*) OVER () * CAST(0.1 AS DOUBLE)) AS BIGINT) AS v_end
      FROM orders)"""

ORACLE["split_distribution"] = S3_ + """
SELECT split, 'total' AS dim, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM three_way GROUP BY split
UNION ALL SELECT split, 'ticket_type', COALESCE(ticket_type, 'unknown'), count(*) FROM three_way
          WHERE error IS NULL GROUP BY split, COALESCE(ticket_type, 'unknown')
UNION ALL SELECT split, 'severity', COALESCE(severity, 'unknown'), count(*) FROM three_way
          WHERE error IS NULL GROUP BY split, COALESCE(severity, 'unknown')"""

ORACLE["split_leakage"] = S3_ + """
SELECT sample_id FROM three_way WHERE split = 'test'
  AND user_input IN (SELECT user_input FROM three_way WHERE split = 'train')"""

ORACLE["split_train_eval"] = U_ + f""",
pos AS (SELECT source, sample_id, row_number() OVER (ORDER BY {_key('source', 'sample_id')}, source, sample_id) - 1 AS pos,
               CAST(floor(count(*) OVER () * CAST(0.9 AS DOUBLE)) AS BIGINT) AS t_end, count(*) OVER () AS n
        FROM combined),
seg AS (SELECT *, t_end + CAST(floor((n - t_end) * CAST(0.5 AS DOUBLE)) AS BIGINT) AS v_end FROM pos)
SELECT source, sample_id, 'train' AS split FROM seg WHERE pos < t_end
UNION ALL SELECT source, sample_id, 'validation' FROM seg WHERE pos >= t_end AND pos < v_end
UNION ALL SELECT source, sample_id, 'test' FROM seg WHERE pos >= t_end"""

# -- evaluation ---------------------------------------------------------------

_REPLIES = [
    "I cannot help with that.",
    'Sure: {"ticket_type": "complaint" } extra }',
    _OOD_JSON,
    '{"severity": "low"}',
    '{"ticket_type": "complaint", "severity": "low"}',
]
_REPLY5 = f"'Here: ' || {NL} || " + _lit('{"ticket_type": "inquiry",') + f" || {NL} || " + \
    _lit(' "severity": "high"}') + f" || {NL} || 'Thanks'"

EVAL_PAIRS = f"""eval_pairs AS (
  SELECT sample_id, user_input, true_json,
    '[INST] sys [/INST] ' || CASE sample_id % 11
      {" ".join(f"WHEN {k} THEN {_lit(r)}" for k, r in enumerate(_REPLIES))}
      WHEN 5 THEN {_REPLY5}
      ELSE true_json END AS response
  FROM (SELECT doc_id AS sample_id, text AS user_input,
    CASE WHEN doc_id % 12 = 0 THEN {_lit(_OOD_JSON)} ELSE '{{' || concat_ws(', ',
      '"ticket_type": "' || ({_list(_EVAL_TYPES)})[doc_id % 3 + 1] || '"',
      '"severity": "' || ({_list(_EVAL_SEV)})[doc_id % 4 + 1] || '"',
      '"department_impacted": "D' || CAST(doc_id % 2 AS VARCHAR) || '"',
      '"service_impacted": "S' || CAST(doc_id % 3 AS VARCHAR) || '"',
      CASE WHEN doc_id % 5 <> 0 THEN '"preferred_communication": "email"' END,
      CASE WHEN doc_id % 3 = 2 THEN '"assistance_request": "loan"' END) || '}}' END AS true_json
  FROM documents))"""

PRED = f"""pred AS (
  SELECT *, CASE WHEN blk IS NULL THEN 'no_json' WHEN pj IS NULL THEN 'bad_json' ELSE 'ok' END AS status
  FROM (SELECT *, CASE WHEN {is_object('blk')} THEN blk END AS pj FROM (
    SELECT *, NULLIF(regexp_extract(tail, '(?s)\\{{.*\\}}', 0), '') AS blk
    FROM (SELECT *, {strip("string_split(response, '[/INST]')[-1]")} AS tail FROM eval_pairs))))"""

OUTCOME = f"""outcome AS (
  SELECT *, CASE WHEN p_err AND NOT t_err THEN 'pred_error' WHEN t_err AND p_err THEN 'both_error'
                 WHEN NOT t_err AND NOT p_err THEN 'compared' ELSE 'domain_error' END AS outcome
  FROM (SELECT *, {jhas('true_json', 'error')} AS t_err,
               (status <> 'ok' OR COALESCE({jhas('pj', 'error')}, FALSE)) AS p_err FROM pred))"""


def _t_type(default: str) -> str:
    return f"CASE WHEN {jhas('true_json', 'ticket_type')} THEN {jtext('true_json', 'ticket_type')} ELSE {_lit(default)} END"


LABELS = f"""labels_ AS (
  SELECT *,
    CASE outcome WHEN 'pred_error' THEN 'error' WHEN 'both_error' THEN 'out_of_domain'
      WHEN 'compared' THEN CASE WHEN {jhas('pj', 'ticket_type')} THEN {jtext('pj', 'ticket_type')} ELSE 'unknown' END
      ELSE 'domain_error' END AS pred_label,
    CASE outcome WHEN 'pred_error' THEN {_t_type('unknown')} WHEN 'both_error' THEN 'out_of_domain'
      WHEN 'compared' THEN {_t_type('unknown')} ELSE {_t_type('out_of_domain')} END AS true_label
  FROM outcome)"""


def _match(f: str) -> str:
    return f"({jjson('true_json', f)} IS NOT DISTINCT FROM {jjson('pj', f)})"


DETAILED = f"""detailed AS (
  SELECT sample_id, true_label, pred_label, (true_label IS NOT DISTINCT FROM pred_label) AS type_correct,
    {", ".join(f"{_match(f)} AS {f}_match" for f in FV.COMPARED_FIELDS)},
    CASE WHEN true_label = 'assistance' THEN
      COALESCE({jtype('pj', 'assistance_request')} IS NOT NULL AND {jtype('pj', 'assistance_request')} <> 'NULL', FALSE)
    END AS assistance_request_match
  FROM labels_ WHERE outcome = 'compared')"""

E_ = with_(EVAL_PAIRS, PRED, OUTCOME, LABELS)
ED_ = with_(EVAL_PAIRS, PRED, OUTCOME, LABELS, DETAILED)

ORACLE["parse_responses"] = with_(EVAL_PAIRS, PRED) + f"""
SELECT sample_id, status, (status <> 'ok' OR COALESCE({jhas('pj', 'error')}, FALSE)) AS pred_has_error,
  CASE status WHEN 'no_json' THEN {_lit(FV.REPLY_NO_JSON_ERROR)} WHEN 'bad_json' THEN {_lit(FV.REPLY_BAD_JSON_PREFIX + 'Extra data: line 1 column 31 (char 30)')}
    ELSE {jtext('pj', 'error')} END AS pred_error,
  {jtext('pj', 'ticket_type')} AS ticket_type, {jtext('pj', 'severity')} AS severity,
  CASE WHEN status <> 'ok' THEN tail END AS raw
FROM pred"""

ORACLE["quick_eval_labels"] = with_(EVAL_PAIRS, PRED) + f"""
SELECT sample_id, {jtext('true_json', 'ticket_type')} AS true_label,
  CASE status WHEN 'no_json' THEN 'parse_error' WHEN 'bad_json' THEN 'json_error'
    ELSE CASE WHEN {jhas('pj', 'ticket_type')} THEN {jtext('pj', 'ticket_type')} ELSE 'parse_error' END END AS pred_label
FROM pred WHERE NOT {jhas('true_json', 'error')}"""

ORACLE["outcome_labels"] = E_ + "SELECT sample_id, status, outcome, true_label, pred_label FROM labels_"

ORACLE["eval_detailed"] = ED_ + "SELECT * FROM detailed"

ORACLE["overall_accuracy"] = E_ + """
SELECT count(*) AS n_samples,
       round(avg(CAST(true_label IS NOT DISTINCT FROM pred_label AS INTEGER)), 6) AS accuracy FROM labels_"""

CLASS_METRICS = """pc AS (SELECT true_label AS t, pred_label AS p, count(*) AS n FROM labels_ GROUP BY ALL),
lab AS (SELECT t AS label FROM pc UNION SELECT p FROM pc),
cm AS (
  SELECT label,
    COALESCE((SELECT sum(n) FROM pc WHERE t = label AND p = label), 0) AS tp,
    COALESCE((SELECT sum(n) FROM pc WHERE t = label), 0) AS sup,
    COALESCE((SELECT sum(n) FROM pc WHERE p = label), 0) AS pr
  FROM lab),
cm2 AS (SELECT label, CASE WHEN pr > 0 THEN tp / pr ELSE 0.0 END AS p_,
               CASE WHEN sup > 0 THEN tp / sup ELSE 0.0 END AS r_, sup FROM cm),
class_metrics AS (
  SELECT label, round(p_, 6) AS precision, round(r_, 6) AS recall,
         round(CASE WHEN p_ + r_ > 0 THEN 2 * p_ * r_ / (p_ + r_) ELSE 0.0 END, 6) AS f1,
         CAST(sup AS BIGINT) AS support FROM cm2)"""

ORACLE["class_metrics"] = E_ + ", " + CLASS_METRICS + "\nSELECT * FROM class_metrics"

ORACLE["avg_metrics"] = E_ + ", " + CLASS_METRICS + """
SELECT 'macro avg' AS average, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
       round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM class_metrics
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM class_metrics"""

ORACLE["confusion_matrix"] = E_ + """
SELECT true_label, pred_label, count(*) AS n FROM labels_ GROUP BY true_label, pred_label"""

ORACLE["label_set"] = E_ + """
SELECT true_label AS label FROM labels_ UNION SELECT pred_label FROM labels_"""

ORACLE["field_accuracy"] = ED_ + " UNION ALL ".join(
    f"""SELECT '{f}' AS field, round(avg(CAST({f}_match AS INTEGER)), 6) AS accuracy
FROM detailed WHERE type_correct AND {f}_match IS NOT NULL HAVING count(*) > 0 """
    for f in FV.FIELD_ACCURACY_ORDER)

_RATES = """rates AS (
  SELECT count(*) AS n_samples, count(*) FILTER (WHERE outcome = 'pred_error') AS parse_errors,
         count(*) FILTER (WHERE outcome = 'domain_error') AS domain_errors FROM labels_),
rates2 AS (SELECT *, round(CASE WHEN n_samples > 0 THEN parse_errors / n_samples END, 6) AS parse_error_rate,
                  round(CASE WHEN n_samples > 0 THEN domain_errors / n_samples END, 6) AS domain_error_rate FROM rates)"""

ORACLE["error_rates"] = E_ + ", " + _RATES + "\nSELECT * FROM rates2"

ORACLE["error_shares"] = E_ + ", " + _RATES + """
SELECT 'Correct' AS part, round(1.0 - parse_error_rate - domain_error_rate, 6) AS share FROM rates2
UNION ALL SELECT 'Parse Errors', parse_error_rate FROM rates2
UNION ALL SELECT 'Domain Errors', domain_error_rate FROM rates2"""

ORACLE["sample_predictions"] = ED_ + """
SELECT type_correct, CAST(ord AS BIGINT) AS ord, sample_id, user_input, true_label, pred_label, true_type, pred_type FROM (
  SELECT d.*, l.user_input, CASE WHEN """ + jhas('true_json', 'ticket_type') + " THEN " + jtext('true_json', 'ticket_type') + """ ELSE 'N/A' END AS true_type,
    CASE WHEN """ + jhas('pj', 'ticket_type') + " THEN " + jtext('pj', 'ticket_type') + """ ELSE 'N/A' END AS pred_type, row_number() OVER (PARTITION BY type_correct ORDER BY sample_id) AS ord
  FROM detailed d JOIN labels_ l USING (sample_id))
WHERE ord <= 3"""

ORACLE["labels_class_metrics"] = """WITH labels_ AS (
  SELECT CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS true_label,
         CASE WHEN d.n_chars >= 1000 THEN 'good' ELSE 'bad' END AS pred_label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id), """ + CLASS_METRICS + "\nSELECT * FROM class_metrics"

ORACLE["prompt_truncation"] = with_(EVAL_PAIRS) + f"""
SELECT sample_id, CAST(n AS BIGINT) AS n_tokens, CAST(LEAST(n, 512) AS BIGINT) AS kept_tokens, n > 512 AS truncated
FROM (SELECT sample_id, len(regexp_extract_all({eval_prompt_sql('user_input')},
      '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_ \\t\\n\\r]')) AS n FROM eval_pairs)"""

_NULLS = ", ".join(_lit(x) for x in FV.CSV_NULL_SPELLINGS)

ORACLE["scan_raw_tickets"] = T + f"""
SELECT row_index, CASE WHEN input IN ({_NULLS}) THEN NULL ELSE input END AS input,
       CASE WHEN output IN ({_NULLS}) THEN NULL ELSE output END AS output FROM raw_tickets"""

ORACLE["domain_filter"] = with_(RAW_TICKETS, PARSED, CLEAN, _TYPE_WC, EVAL_PAIRS,
    f"kw AS (SELECT list(DISTINCT word) AS words FROM {top_keywords_sql('type_wc', 'ticket_type', 20, FV.TYPE_STOPWORDS)})") + f"""
SELECT sample_id, CAST(s AS BIGINT) AS domain_score, s >= 1 AS in_domain,
  CASE WHEN s < 1 THEN {_lit(FV.OUT_OF_DOMAIN_ERROR)} END AS error FROM (
  SELECT sample_id, len(list_filter({words('user_input')}, lambda w: list_contains(kw.words, w))) AS s
  FROM eval_pairs CROSS JOIN kw)"""

_FIELD_ACC = " UNION ALL ".join(
    f"""SELECT '{f}' AS field, round(avg(CAST({f}_match AS INTEGER)), 6) AS accuracy
FROM detailed WHERE type_correct AND {f}_match IS NOT NULL HAVING count(*) > 0 """
    for f in FV.FIELD_ACCURACY_ORDER)

ORACLE["eval_report"] = ED_ + ", " + CLASS_METRICS + ", " + _RATES + f""",
fa AS ({_FIELD_ACC}),
acc AS (SELECT count(*) AS n, round(avg(CAST(true_label IS NOT DISTINCT FROM pred_label AS INTEGER)), 6) AS a FROM labels_)
SELECT 'overall' AS section, 'all' AS key, 'accuracy' AS metric, CAST(a AS DOUBLE) AS value FROM acc
UNION ALL SELECT 'overall', 'all', 'total_samples', CAST(n AS DOUBLE) FROM acc
UNION ALL SELECT 'class', label, 'precision', precision FROM class_metrics
UNION ALL SELECT 'class', label, 'recall', recall FROM class_metrics
UNION ALL SELECT 'class', label, 'f1', f1 FROM class_metrics
UNION ALL SELECT 'class', label, 'support', CAST(support AS DOUBLE) FROM class_metrics
UNION ALL SELECT 'macro', 'macro avg', 'precision', round(avg(precision), 6) FROM class_metrics
UNION ALL SELECT 'macro', 'macro avg', 'recall', round(avg(recall), 6) FROM class_metrics
UNION ALL SELECT 'macro', 'macro avg', 'f1', round(avg(f1), 6) FROM class_metrics
UNION ALL SELECT 'field', field, 'accuracy', accuracy FROM fa
UNION ALL SELECT 'errors', 'all', 'parse_error_rate', parse_error_rate FROM rates2
UNION ALL SELECT 'errors', 'all', 'domain_error_rate', domain_error_rate FROM rates2"""

ORACLE["eval_summary"] = ED_ + ", " + _RATES + f""",
fa AS ({_FIELD_ACC})
SELECT 'overall_accuracy' AS metric, round(avg(CAST(true_label IS NOT DISTINCT FROM pred_label AS INTEGER)), 6) AS value FROM labels_
UNION ALL SELECT 'parse_error_rate', parse_error_rate FROM rates2
UNION ALL SELECT 'domain_error_rate', domain_error_rate FROM rates2
UNION ALL SELECT 'field:' || field, accuracy FROM fa"""

ORACLE["quick_eval_metrics"] = with_(EVAL_PAIRS, PRED, f"""labels_ AS (
SELECT sample_id, {jtext('true_json', 'ticket_type')} AS true_label,
  CASE status WHEN 'no_json' THEN 'parse_error' WHEN 'bad_json' THEN 'json_error'
    ELSE CASE WHEN {jhas('pj', 'ticket_type')} THEN {jtext('pj', 'ticket_type')} ELSE 'parse_error' END END AS pred_label
FROM pred WHERE NOT {jhas('true_json', 'error')})""") + ", " + CLASS_METRICS + "\nSELECT * FROM class_metrics"

ORACLE["event_props_parse"] = f"""
SELECT count(*) FILTER (WHERE {is_object('props')}) AS parsed,
       count(*) FILTER (WHERE NOT {is_object('props')}) AS parse_errors FROM events"""

ORACLE["event_props_keys"] = f"""
SELECT key, count(*) AS n_rows FROM (
  SELECT unnest(json_keys(j)) AS key FROM (
    SELECT CASE WHEN {is_object('props')} THEN props END AS j FROM events) WHERE j IS NOT NULL)
GROUP BY key"""

ORACLE["training_prompt_budget"] = R_ + f"""
SELECT sample_id, CAST(n AS BIGINT) AS n_tokens, CAST(LEAST(n, 2048) AS BIGINT) AS kept_tokens, n > 2048 AS truncated
FROM (SELECT sample_id, len(regexp_extract_all({train_prompt_sql()},
      '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_ \\t\\n\\r]')) AS n FROM records)"""

# K5 read back: type_correct as JSON text, field_match as a JSON object whose
# keys come back sorted (the written object is re-read as a variant)
_FM_SORTED = sorted(FV.FIELD_ACCURACY_ORDER)
ORACLE["write_eval_results"] = ED_ + f"""
SELECT CASE WHEN type_correct THEN 'true' ELSE 'false' END AS type_correct,
  '{{' || concat_ws(',', {", ".join(
      f"CASE WHEN {f}_match IS NOT NULL THEN '\"{f}\":' || CASE WHEN {f}_match THEN 'true' ELSE 'false' END END"
      for f in _FM_SORTED)}) || '}}' AS field_match
FROM detailed"""

ORACLE["write_samples"] = R_ + f"SELECT {', '.join(c for c in _SAMPLE_OUT if c != 'sample_id')} FROM records"

CHALLENGE = "challenge AS (" + _values("challenge", *_literal_rows("challenge")) + ")"
ORACLE["write_splits"] = with_(RAW_TICKETS, PARSED, CLEAN, RECORDS, OOD, THREE_WAY, CHALLENGE) + """
SELECT split, user_input, ticket_type, severity, error FROM three_way
UNION ALL SELECT 'challenge', user_input, ticket_type, severity, error FROM challenge"""


def _rule_reply_type(text: str) -> str:
    """The stand-in model's ticket type (scoring.rule_model) in SQL; NULL
    for its out-of-domain reply."""
    t = f"lower(COALESCE({text}, ''))"
    has = lambda words: "(" + " OR ".join(f"contains({t}, '{w}')" for w in words) + ")"
    return (f"CASE WHEN {has(['weather', 'recipe', 'movie', 'joke'])} THEN NULL "
            f"WHEN {has(['loan', 'mortgage', 'help'])} THEN 'assistance' "
            f"WHEN {has(['lost', 'fraud', 'declined', 'error', 'hacked', 'not'])} THEN 'complaint' "
            f"ELSE 'inquiry' END")


ORACLE["batch_score"] = with_(EVAL_PAIRS) + f"""
SELECT sample_id, 'ok' AS status, {_rule_reply_type('user_input')} AS ticket_type FROM eval_pairs"""

ORACLE["stream_score"] = f"""
SELECT conv_id, turn, 'ok' AS status,
       ({_rule_reply_type('text')}) IS NULL AS pred_has_error
FROM conversations WHERE role = 'user' AND length({strip('text')}) > 0"""


ORACLE["scan_keyless_tickets"] = T + f"""
SELECT row_number() OVER (ORDER BY row_index) - 1 AS row_index,
       CASE WHEN input IN ({_NULLS}) THEN NULL ELSE input END AS input,
       CASE WHEN output IN ({_NULLS}) THEN NULL ELSE output END AS output FROM raw_tickets"""

ORACLE["scan_sample_array"] = with_(
    RAW_SAMPLES.replace("raw_samples AS (", "raw_0 AS ("),
    """raw_samples AS (SELECT sample_id,
  CASE WHEN sample_id % 37 = 5 THEN regexp_replace(sample_json, '^\\{"user_input": ".*?", "ticket_data"',
                                                   '{"user_input": null, "ticket_data"', 's')
       WHEN sample_id % 41 = 7 THEN '{"user_input": "x", "ticket_data": "plain text"}'
       ELSE sample_json END AS sample_json FROM raw_0)""", VALIDATED) + \
    f"SELECT {', '.join(c for c in _SAMPLE_OUT if c != 'sample_id')} FROM validated WHERE ok"

ORACLE["write_eval_metrics"] = ORACLE["eval_report"]


def _rule_reply(text: str) -> str:
    """The stand-in model's whole reply (scoring.rule_model) in SQL."""
    kind = _rule_reply_type(text)
    sev = f"CASE WHEN contains(lower(COALESCE({text}, '')), '!') THEN 'high' ELSE 'medium' END"
    return (f"('[INST] prompt [/INST] ' || CASE WHEN ({kind}) IS NULL THEN {_lit(_OOD_JSON)} ELSE "
            f"'{{\"ticket_type\": \"' || ({kind}) || '\", \"severity\": \"' || ({sev}) || "
            f"'\", \"preferred_communication\": \"email\"' || CASE WHEN ({kind}) = 'assistance' "
            f"THEN ', \"assistance_request\": \"general assistance\"' ELSE '' END || '}}' END)")


_SCORED = with_(
    EVAL_PAIRS.replace("eval_pairs AS (", "pairs_0 AS (", 1),
    f"prompts AS (SELECT sample_id, {eval_prompt_sql('user_input')} AS prompt FROM pairs_0)",
    f"replies AS (SELECT sample_id, {_rule_reply('prompt')} AS response FROM prompts)",
    "eval_pairs AS (SELECT p.sample_id, p.user_input, p.true_json, r.response FROM pairs_0 p LEFT JOIN replies r USING (sample_id))",
    PRED, OUTCOME, LABELS, DETAILED)
ORACLE["scored_eval_labels"] = _SCORED + "SELECT sample_id, outcome, true_label, pred_label FROM labels_"
ORACLE["scored_eval_report"] = ORACLE["eval_report"].replace(ED_, _SCORED)

_BAYES = with_(RAW_TICKETS, PARSED, CLEAN, f"""seg AS (
  SELECT row_index, original_input, ticket_type,
    row_number() OVER (ORDER BY {_key('row_index')}, row_index) - 1 < CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train
  FROM clean)""", f"""w AS (SELECT row_index, ticket_type, train, unnest({words('original_input')}) AS word FROM seg)""",
  """cnt AS (SELECT word, ticket_type AS label, count(*) AS n FROM w WHERE train GROUP BY ALL)""",
  """classes_ AS (SELECT ticket_type AS label, ln(count(*) / (SELECT count(*) FROM seg WHERE train)) AS prior,
    ln(COALESCE((SELECT sum(n) FROM cnt WHERE cnt.label = ticket_type), 0) + (SELECT count(DISTINCT word) FROM cnt)) AS base
  FROM seg WHERE train GROUP BY ticket_type)""",
  """bag AS (SELECT row_index, word, count(*) AS c FROM w WHERE NOT train AND word IN (SELECT word FROM cnt) GROUP BY ALL)""",
  """known AS (SELECT row_index, sum(c) AS k FROM bag GROUP BY row_index)""",
  """sums AS (SELECT row_index, label, sum(c * ln(n + 1)) AS s FROM bag JOIN cnt USING (word) GROUP BY ALL)""",
  """scores AS (SELECT t.row_index, t.ticket_type, l.label,
    round(l.prior + COALESCE(s.s, 0) - COALESCE(k.k, 0) * l.base, 9) AS score
  FROM seg t CROSS JOIN classes_ l LEFT JOIN known k USING (row_index)
  LEFT JOIN sums s ON s.row_index = t.row_index AND s.label = l.label WHERE NOT t.train)""",
  """labels_ AS (SELECT row_index, any_value(ticket_type) AS true_label, arg_min(label, struct_pack(a := -score, b := label)) AS pred_label
  FROM scores GROUP BY row_index)""")
ORACLE["fit_classifier"] = _BAYES + "SELECT row_index, true_label, pred_label FROM labels_"
ORACLE["classifier_metrics"] = _BAYES.rstrip() + ",\n" + CLASS_METRICS + "\nSELECT * FROM class_metrics"

ORACLE["scan_split_tickets"] = ORACLE["scan_keyless_tickets"]

_PLACE = "row_number() OVER (ORDER BY sample_id) - 1"
ORACLE["scan_split_array"] = R_ + f"SELECT {_PLACE} AS sample_id, {', '.join(c for c in _SAMPLE_OUT if c != 'sample_id')} FROM records"

ORACLE["write_training_array"] = R_ + f""",
elements AS (
  SELECT {_PLACE} AS k, '  {{' || {NL} || '    "user_input": ' || ({_q('user_input')}) || ',' || {NL} || '    "ticket_data": '
         || {ticket_json_sql(2)} || {NL} || '  }}' AS element FROM records),
files AS (
  SELECT k // 300 AS part, '[' || {NL} || string_agg(element, ',' || {NL} ORDER BY k) || {NL} || ']' || {NL} AS content
  FROM elements GROUP BY part)
SELECT part, strlen(content) AS n_bytes, sha256(content) AS sha256 FROM files"""

ORACLE["numbered_samples"] = with_(
    RAW_SAMPLES.replace("raw_samples AS (", "raw_0 AS ("),
    f"raw_samples AS (SELECT {_PLACE} AS sample_id, sample_json FROM raw_0)", VALIDATED) + \
    f"SELECT {', '.join(_SAMPLE_OUT)} FROM validated WHERE ok"

ORACLE["paired_outcomes"] = with_(
    EVAL_PAIRS.replace("eval_pairs AS (", "pairs_0 AS (", 1),
    f"""eval_pairs AS (SELECT {_PLACE} AS sample_id, user_input, true_json,
  CASE WHEN sample_id < (SELECT max(sample_id) FROM pairs_0) * 9 / 10 THEN response END AS response FROM pairs_0)""",
    PRED, OUTCOME, LABELS) + "SELECT sample_id, status, outcome, true_label, pred_label FROM labels_"

# each kind of damage has its error at a place that is known without a decoder
_AT = "': line 1 column ' || (place + 1) || ' (char ' || place || ')'"
ORACLE["reply_json_errors"] = with_(EVAL_PAIRS) + f"""
SELECT sample_id, CASE WHEN kind = 4 THEN 'Expecting property name enclosed in double quotes: line 2 column 1 (char 2)'
                       WHEN place IS NOT NULL THEN said || {_AT} END AS message
FROM (SELECT sample_id, sample_id % 7 AS kind, true_json AS j,
  CASE sample_id % 7 WHEN 0 THEN length(true_json) + 1 WHEN 1 THEN strpos(true_json, ':') - 1 WHEN 2 THEN length(true_json) - 1
    WHEN 3 THEN CASE WHEN strpos(true_json, '", "') > 0 THEN strpos(true_json, '", "') + 1 END WHEN 5 THEN length(true_json) - 1 END AS place,
  CASE sample_id % 7 WHEN 0 THEN 'Extra data' WHEN 1 THEN 'Expecting '':'' delimiter' WHEN 5 THEN 'Illegal trailing comma before end of object'
    ELSE 'Expecting '','' delimiter' END AS said
  FROM eval_pairs)"""

ORACLE["document_tf_idf"] = f"""
WITH w AS (SELECT doc_id, unnest({words('text')}) AS word FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word)
SELECT doc_id, word, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 9) AS tfidf FROM tf JOIN df USING (word)"""

ORACLE["fit_logistic"] = f"""
WITH seg AS (
  SELECT lang, row_number() OVER (ORDER BY {_key('doc_id')}, doc_id) - 1 < CAST(floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train
  FROM documents)
SELECT lang AS label, count(*) AS n_rows FROM seg WHERE train AND lang IS NOT NULL GROUP BY lang"""

ORACLE["dense_confusion_matrix"] = E_ + """,
axis_ AS (SELECT true_label AS label FROM labels_ UNION SELECT pred_label FROM labels_)
SELECT a.label AS true_label, b.label AS pred_label, count(l.true_label) AS n
FROM axis_ a CROSS JOIN axis_ b LEFT JOIN labels_ l ON l.true_label = a.label AND l.pred_label = b.label
GROUP BY a.label, b.label"""


def _runs(table: str, keep: str) -> str:
    """Every run of one to three words of a text, ``keep`` beside it."""
    return " UNION ALL ".join(f"""
  SELECT {keep} unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase
  FROM {table}{' WHERE len(w) >= 3' if not keep else ''}""" for n in (1, 2, 3))


ORACLE["phrase_filter"] = f"""
WITH b AS (SELECT {words('text')} AS w FROM benchmark), d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
phrases AS (SELECT DISTINCT phrase FROM ({_runs('b', '')})),
hits AS (SELECT doc_id, count(*) AS n_matches, count(DISTINCT phrase) AS n_phrases
         FROM ({_runs('d', 'doc_id,')}) JOIN phrases USING (phrase) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_matches, 0) AS BIGINT) AS n_matches, CAST(coalesce(n_phrases, 0) AS BIGINT) AS n_phrases,
       coalesce(n_phrases, 0) >= 5 AS in_domain,
       CASE WHEN coalesce(n_phrases, 0) < 5 THEN {_lit(FV.OUT_OF_DOMAIN_ERROR)} END AS error
FROM d LEFT JOIN hits USING (doc_id)"""
