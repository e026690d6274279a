"""DuckDB SQL for each registered query, over the driver tables as views.

The SQL is written the way the warehouse models are written (DISTINCT
sides, fan-out joins, GROUP BY with MAX), so it is an independent check of
the reduced Spark plans. Rule CASE chains are generated from the same fixed
values of ``hirelens.rules``; the fixture adapter from the same value lists.
Regular expressions here are RE2 (no ``(?U)`` flag: in RE2 it means
"ungreedy").
"""

from __future__ import annotations

from hirelens import rules
from hirelens.operators.skills import SOFT, TECHNICAL, lexicon_terms
from hirelens.plans.registry import FIRST_LOAD, SECOND_LOAD, STORED_BEFORE, WEEK_HOURS
from hirelens.schemas import CLEAN_COLUMNS, FACT_COLUMNS, POSTING_KEY, RAW_COLUMNS
from hirelens.sources import fixtures as fx


def lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def pick(values: list, key: str) -> str:
    return f"([{', '.join(lit(v) for v in values)}])[({key}) % {len(values)} + 1]"


def case(pairs: list[tuple[str, str]], otherwise: str) -> str:
    body = " ".join(f"WHEN {c} THEN {lit(v)}" for c, v in pairs)
    return f"CASE {body} ELSE {otherwise} END"


def city_std(c: str = "CITY") -> str:
    lc = f"lower({c})"
    pairs = [(f"{lc} = {lit(t)}" if k == "equals" else f"{lc} LIKE {lit('%' + t + '%')}", out)
             for k, t, out in rules.CITY_RULES]
    return case(pairs, c)


def state_std(s: str = "STATE", cs: str = "CITY_STANDARDIZED") -> str:
    ls = f"lower({s})"
    ph = f"{ls} IN ({', '.join(lit(x) for x in rules.STATE_PLACEHOLDERS)})"
    pairs = [(f"{ph} AND {cs} = {lit(city)}", code) for city, code in rules.STATE_BY_CITY]
    pairs.append((f"{ls} = {lit(rules.STATE_NA_TOKEN)}", rules.STATE_UNKNOWN))
    return case(pairs, s)


def seniority_label(c: str) -> str:
    key = f"replace(lower({strip(c)}), ' ', '')"
    body = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in rules.SENIORITY_LABELS)
    return f"COALESCE(CASE {key} {body} END, {lit(rules.SENIORITY_DEFAULT)})"


def seniority_category(c: str) -> str:
    n = f"lower(replace({c}, '_', ' '))"
    pat = lit(rules.YEARS_PATTERN)
    years = f"(CASE WHEN regexp_matches({n}, {pat}) THEN TRY_CAST(regexp_extract({n}, {pat}, 1) AS DECIMAL(38, 0)) END)"
    pairs = [(f"{c} IS NULL OR {c} = ''", rules.SENIORITY_DEFAULT)]
    pairs += [(f"contains({n}, {lit(t)})", lab) for t, lab in rules.SENIORITY_CONTAINS_RULES]
    pairs += [(f"{n} = {lit(t)}", lab) for t, lab in rules.SENIORITY_EXAMPLES]
    pairs += [(f"{n} = {lit(cat.lower())}", cat) for cat in rules.SENIORITY_CATEGORIES]
    pairs += [(f"{years} >= {lo}" if hi is None else f"{years} BETWEEN {lo} AND {hi}", lab)
              for lo, hi, lab in rules.SENIORITY_YEAR_BANDS]
    return case(pairs, lit(rules.SENIORITY_DEFAULT))


def title_regex(c: str = "TITLE") -> str:
    alt = "|".join(rf"\b{t}\b" for t in rules.TARGET_TITLES)
    return f"regexp_matches({c}, {lit(alt)}, 'i')"


def title_like(c: str = "TITLE") -> str:
    return "(" + " OR ".join(f"lower({c}) LIKE {lit('%' + t.lower() + '%')}"
                             for t in rules.TARGET_TITLES) + ")"


def city_extract(c: str) -> str:
    pat = lit(rules.CITY_TEXT_PATTERN)
    city = f"(CASE WHEN regexp_matches({c}, {pat}) THEN regexp_extract({c}, {pat}, 1) END)"
    syd = " OR ".join(f"contains(lower({city}), {lit(s)})" for s in rules.SYDNEY_SPELLINGS)
    return f"(CASE WHEN {syd} THEN {lit(rules.SYDNEY)} ELSE {city} END)"


def state_extract(c: str) -> str:
    pat = lit(rules.STATE_TEXT_PATTERN)
    return (f"(CASE WHEN regexp_matches({c}, {pat}) THEN "
            f"{strip(f'replace(regexp_extract({c}, {pat}, 1), chr(39), {lit("")})')} END)")


def employment_type(c: str) -> str:
    return strip(f"regexp_replace(coalesce({c}, 'nan'), '[\\[\\]'']', '', 'g')")


def org_size(c: str) -> str:
    return strip(f"regexp_replace(coalesce({c}, 'nan'), 'employees', '', 'g')")


def job_date(c: str) -> str:
    return f"TRY_CAST(substr({c}, 1, 10) AS DATE)"


def _raw_cte() -> str:
    place = (f"{lit(fx.PLACE_PREFIX)} || coalesce(_CITY, '') || {lit(fx.PLACE_MIDDLE)} || "
             f"coalesce(_STATE, '') || {lit(fx.PLACE_SUFFIX)}")
    values = {
        "ID": "CAST(l_orderkey AS VARCHAR)",
        "DATE_CREATED": (f"CASE WHEN l_partkey % {fx.NULL_DATE_MODULUS} = 0 THEN NULL ELSE "
                         f"CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || {lit(fx.TIME_OF_DAY)} END"),
        "TITLE": pick(fx.TITLES, "l_partkey"),
        "JOB_CATEGORY": pick(fx.CATEGORIES, "l_linenumber"),
        "ORGANIZATION": "s_name",
        "LOCATIONS_RAW": (f"CASE WHEN l_orderkey % 11 = 0 THEN NULL "
                          f"WHEN l_orderkey % 11 = 1 THEN '[' || {place} || ', ' || {place} || ']' "
                          f"ELSE '[' || {place} || ']' END"),
        "EMPLOYMENT_TYPE": pick(fx.EMPLOYMENT_TYPES, "l_linenumber"),
        "URL": f"{lit(fx.URL_PREFIX)} || CAST(l_orderkey AS VARCHAR)",
        "LINKEDIN_ORG_SIZE": pick(fx.ORG_SIZES, "l_suppkey"),
        "SENIORITY": pick(fx.SENIORITIES, "l_orderkey"),
    }
    cols = ",\n    ".join(f"{values.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in RAW_COLUMNS)
    return f"""j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, o.o_orderdate,
         s.s_name,
         {pick(fx.CITIES, "l.l_partkey")} AS _CITY,
         {pick(fx.STATES, "l.l_partkey + l.l_linenumber")} AS _STATE
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw AS (
  SELECT {cols},
    _CITY, _STATE
  FROM j
)"""


def _clean_cte() -> str:
    derived = {
        "JOB_DATE": job_date("DATE_CREATED"),
        "CITY": "_CITY",
        "STATE": "_STATE",
        "EMPLOYMENT_TYPE": employment_type("EMPLOYMENT_TYPE"),
        "ORG_SIZE": org_size("LINKEDIN_ORG_SIZE"),
    }
    cols = ",\n    ".join(f"{derived.get(c, c)} AS {c}" for c in CLEAN_COLUMNS)
    return f"""clean AS (
  SELECT {cols}
  FROM raw
)"""


def _sen_dict_cte() -> str:
    return f"""sen_levels AS (
  SELECT lower(SENIORITY) AS SENIORITY FROM (SELECT DISTINCT SENIORITY FROM clean)
),
sen_dict AS (
  SELECT SENIORITY, {seniority_label(seniority_category('SENIORITY'))} AS SENIORITY_STANDARDIZED
  FROM sen_levels
)"""


def _fact_cte() -> str:
    keys = ", ".join(f"jb.{c}" for c in POSTING_KEY)
    maxima = {"CITY": "MAX(c.CITY_STANDARDIZED)", "STATE": "MAX(s.STATE_STANDARDIZED)",
              "SENIORITY": "MAX(e.SENIORITY_STANDARDIZED)"}
    sel = ", ".join(f"{maxima[c]} AS {c}" if c in maxima else f"jb.{c}" for c in FACT_COLUMNS)
    return f"""base_city AS (
  SELECT CITY, {city_std('CITY')} AS CITY_STANDARDIZED, STATE
  FROM (SELECT DISTINCT CITY, STATE FROM clean)
),
base_state AS (
  SELECT DISTINCT CITY_STANDARDIZED, {state_std('STATE', 'CITY_STANDARDIZED')} AS STATE_STANDARDIZED
  FROM base_city
),
job_base AS (SELECT DISTINCT * FROM clean),
city AS (SELECT DISTINCT CITY, CITY_STANDARDIZED, STATE FROM base_city),
state AS (SELECT DISTINCT CITY_STANDARDIZED, STATE_STANDARDIZED FROM base_state),
exp AS (SELECT DISTINCT SENIORITY, SENIORITY_STANDARDIZED FROM sen_dict),
fact AS (
  SELECT {sel}
  FROM job_base jb
  JOIN city c ON jb.CITY = c.CITY
  JOIN state s ON c.CITY_STANDARDIZED = s.CITY_STANDARDIZED
  JOIN exp e ON jb.SENIORITY = e.SENIORITY
  GROUP BY {keys}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


RAW = _raw_cte()
CLEAN = _clean_cte()
SEN = _sen_dict_cte()
FACT = _fact_cte()
POSTINGS = _with(RAW, CLEAN)
FACT_BASE = _with(RAW, CLEAN, SEN, FACT)
STORED = f"""stored AS (
  SELECT ID, TITLE FROM clean
  WHERE JOB_DATE < DATE '{STORED_BEFORE.isoformat()}' AND {title_like('TITLE')}
)"""


def _translate_v2(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} = '' OR lower({strip(c)}) IN "
            f"({', '.join(lit(t) for t in rules.TRANSLATE_SKIP_TOKENS)}) THEN 'NA' ELSE {c} END")


def _translate_v1(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'NA' ELSE {c} END"


def _daily_sql() -> str:
    return """SELECT CAST(JOB_DATE AS DATE) AS date,
       CAST(date_part('month', JOB_DATE) AS BIGINT) AS month,
       CAST(date_part('year', JOB_DATE) AS BIGINT) AS "Year",
       JOB_CATEGORY, COUNT(DISTINCT ID) AS total_jobs
FROM fact GROUP BY JOB_CATEGORY, JOB_DATE"""


def _feed_cap(hours: int) -> str:
    return f"""SELECT event_type, event_id, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id ASC) AS rn
  FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL {hours} HOUR
) WHERE rn <= {rules.FEED_LIMIT}"""


def _lookup(default: str) -> str:
    val = "COALESCE(d.v, 'NA')" if default == "na" else "COALESCE(d.v, c.SENIORITY)"
    return POSTINGS[:-1] + f""",
{SEN},
d AS (SELECT SENIORITY AS k, MAX(SENIORITY_STANDARDIZED) AS v FROM sen_dict GROUP BY SENIORITY)
SELECT c.ID, {val} AS SENIORITY FROM clean c LEFT JOIN d ON c.SENIORITY = d.k"""


def _ingest_sql(variant: str = "v2") -> str:
    derived = {
        "JOB_DATE": job_date("DATE_CREATED"),
        "CITY": city_extract("LOCATIONS_RAW"),
        "STATE": state_extract("LOCATIONS_RAW"),
        "EMPLOYMENT_TYPE": employment_type("EMPLOYMENT_TYPE"),
        "ORG_SIZE": org_size("LINKEDIN_ORG_SIZE"),
    }
    cols = ", ".join(f"{derived.get(c, c)} AS {c}" for c in CLEAN_COLUMNS)
    tr = _translate_v2 if variant == "v2" else _translate_v1
    out = ", ".join(tr(c) + f" AS {c}" if c in ("CITY", "STATE", "ORGANIZATION", "SENIORITY")
                    else c for c in CLEAN_COLUMNS)
    tokens = ", ".join(lit(t) for t in rules.CSV_NULL_TOKENS)
    feed = "raw" if variant == "v2" else "feed"
    v1_feed = ("" if variant == "v2" else ",\nfeed AS (\n  SELECT " + ", ".join(
        f"CASE WHEN {c} IN ({tokens}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS) + " FROM raw\n)")
    return _with(RAW + v1_feed, CLEAN, STORED, f"""batch AS (
  SELECT {cols} FROM {feed} WHERE {title_regex('TITLE')}
)""") + f"""SELECT {out} FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.ID IS NOT DISTINCT FROM b.ID)"""


def _top_skills_sql(docs: str = "SELECT doc_id, source, text FROM documents",
                    groups: str = "SELECT DISTINCT source FROM documents") -> str:
    lex = ", ".join(f"({lit(s)}, {lit(k)})" for s, k in lexicon_terms())
    return f"""WITH docs AS ({docs}),
toks AS (
  SELECT doc_id, source,
         list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM docs
),
grams AS (
  SELECT doc_id, source, unnest(list_distinct(list_concat(
      w,
      list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i+1], ' ')),
      list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))))) AS g
  FROM toks
),
lex AS (SELECT * FROM (VALUES {lex}) t(skill, kind)),
counts AS (
  SELECT source, kind, skill, COUNT(DISTINCT doc_id) AS n_docs
  FROM grams JOIN lex ON grams.g = lex.skill GROUP BY source, kind, skill
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, kind ORDER BY n_docs DESC, skill ASC) AS rk
  FROM counts
),
listed AS (
  SELECT source, kind, string_agg(skill, ', ' ORDER BY rk) AS skills
  FROM ranked WHERE rk <= {rules.TOP_SKILLS} GROUP BY source, kind
),
srcs AS ({groups})
SELECT s.source AS job_title,
       COALESCE(MAX(CASE WHEN l.kind = '{TECHNICAL}' THEN l.skills END), '') AS "Top {rules.TOP_SKILLS} Technical Skills",
       COALESCE(MAX(CASE WHEN l.kind = '{SOFT}' THEN l.skills END), '') AS "Top {rules.TOP_SKILLS} Soft Skills"
FROM srcs s LEFT JOIN listed l ON s.source = l.source
GROUP BY s.source"""


def _csv_block_sql() -> str:
    # The conversation texts hold no double quotes, so a CSV row is its
    # comma-separated fields (an empty field is null), as Spark's from_csv
    # reads it; the line and block rules are those of the Spark query. The
    # answers with quoted line breaks hold one row each, spelt out here.
    breaks = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
    return f"""WITH t AS (
  SELECT conv_id, turn,
         string_split_regex({strip('text')}, '{breaks}') AS lines
  FROM (SELECT conv_id, CAST(turn AS INTEGER) AS turn, text FROM conversations
        UNION ALL SELECT conv_id, CAST(-1 - turn AS INTEGER), {lit(fx.ANSWER_HEAD)} || conv_id || ',' || role || {lit(fx.ANSWER_TAIL)}
        FROM conversations)
),
h AS (
  SELECT *, list_position(list_transform(lines, lambda l: starts_with(lower(l), 'job_title')), true) AS hdr
  FROM t
),
b AS (
  SELECT conv_id, turn,
         CASE WHEN hdr > 0 THEN lines[hdr:hdr + 3] ELSE lines END AS block
  FROM h
),
r AS (
  SELECT conv_id, turn,
         list_filter(block[2:], lambda l: length({strip('l')}) > 0) AS body
  FROM b
),
x AS (
  SELECT conv_id, turn, unnest(body) AS line, unnest(generate_series(0, len(body) - 1)) AS row_no
  FROM r WHERE len(body) > 0
)
SELECT conv_id, turn, CAST(row_no AS INTEGER) AS row_no,
       NULLIF(string_split(line, ',')[1], '') AS job_title,
       NULLIF(string_split(line, ',')[2], '') AS technical_skills,
       NULLIF(string_split(line, ',')[3], '') AS soft_skills
FROM x
UNION ALL SELECT conv_id, CAST(-1000 - turn AS INTEGER), 0, 'Data' || chr(10) || 'Analyst', CAST(conv_id AS VARCHAR),
       'say "hi", then' || chr(10) || 'go' FROM conversations"""


def _top_job_skills_sql() -> str:
    titles = ", ".join(f"({lit(t)})" for t in rules.TARGET_TITLES)
    return _top_skills_sql(
        f"""SELECT row_number() OVER () AS doc_id, title AS source, text FROM (
    SELECT DISTINCT title, text FROM (
      SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS rn FROM (
        SELECT doc_id, source, text, {pick(fx.DESCRIPTION_TITLES, "doc_id")} AS title FROM documents))
    WHERE rn = 1 AND text IS NOT NULL)""",
        f"SELECT * FROM (VALUES {titles}) t(source)")


def _csv_text_sql() -> str:
    def shown(c):
        return (f"CASE WHEN {c} IS NULL THEN '' WHEN {c} = '' THEN '\"\"' WHEN regexp_matches({c}, '[,\"\\n]') "
                f"THEN '\"' || replace({c}, '\"', '\"\"') || '\"' ELSE {c} END")
    tokens = ", ".join(lit(t) for t in rules.CSV_NULL_TOKENS)
    fields = ["ID", "TITLE", "CITY", "SENIORITY"]
    back = ", ".join(f"CASE WHEN {c} IN ({tokens}) THEN NULL ELSE {c} END AS {c}" for c in fields[1:])
    return POSTINGS + f"SELECT ID, {' || chr(44) || '.join(shown(c) for c in fields)} AS line, {back} FROM clean"


def _scored_terms_sql(k: int = 10, min_docs: int = 3) -> str:
    def cell(o, r, c):
        return f"CASE WHEN {o} > 0 THEN {o} * ln({o} * CAST(n AS DOUBLE) / (CAST({r} AS DOUBLE) * ({c}))) ELSE 0 END"
    g2 = " + ".join([cell("a", "r", "df"), cell("(r - a)", "r", "(n - df)"), cell("(df - a)", "(n - r)", "df"),
                     cell("(n - r - df + a)", "(n - r)", "(n - df)")])
    return f"""WITH d AS (
  SELECT DISTINCT {pick(fx.DESCRIPTION_TITLES, "doc_id")} AS g, text FROM documents WHERE text IS NOT NULL),
toks AS (
  SELECT g, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM d),
held AS (
  SELECT g, unnest(list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i+1], ' '))))) AS term FROM toks),
sizes AS (SELECT g, count(*) AS r, sum(count(*)) OVER () AS n FROM d GROUP BY g),
counts AS (SELECT g, term, a, sum(a) OVER (PARTITION BY term) AS df FROM (SELECT g, term, count(*) AS a FROM held GROUP BY g, term)),
scored AS (
  SELECT g, term, a, df, round(2 * ({g2}), 6) AS score FROM counts JOIN sizes USING (g) WHERE a >= {min_docs} AND a * n > r * df),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, term) AS rk FROM scored)
SELECT g AS Job_Title, term, a AS n_docs, CAST(df AS BIGINT) AS all_docs, score FROM ranked WHERE rk <= {k}"""


def _translate_kept(c: str) -> str:
    return f"CASE WHEN t.{c} IN ('NA', 'Canberra') THEN t.{c} ELSE upper(t.{c}) END"


def oracle_sql() -> dict[str, str]:
    wow = FACT_BASE[:-1] + f""",
daily AS ({_daily_sql()}),
weekly AS (
  SELECT JOB_CATEGORY, CAST(date_trunc('week', date) AS DATE) AS week_start,
         CAST(SUM(total_jobs) AS BIGINT) AS total_jobs_this_week
  FROM daily GROUP BY JOB_CATEGORY, week_start
),
wow AS (
  SELECT *,
    LAG(total_jobs_this_week) OVER (PARTITION BY JOB_CATEGORY ORDER BY week_start ASC NULLS LAST)
      AS total_jobs_last_week,
    total_jobs_this_week - LAG(total_jobs_this_week) OVER (PARTITION BY JOB_CATEGORY
      ORDER BY week_start ASC NULLS LAST) AS wow_diff
  FROM weekly
)
SELECT *, wow_diff / NULLIF(total_jobs_last_week, 0) AS wow_diff_pct FROM wow
ORDER BY JOB_CATEGORY, week_start"""
    translated_v2 = ", ".join(f"{_translate_v2(c)} AS {c}" for c in ("CITY", "STATE", "ORGANIZATION", "SENIORITY"))
    translated_v1 = ", ".join(f"{_translate_v1(c)} AS {c}" for c in ("CITY", "STATE", "ORGANIZATION", "SENIORITY"))
    return {
        "q_title_regex": _with(RAW) + f"SELECT ID, TITLE, JOB_CATEGORY FROM raw WHERE {title_regex()}",
        "q_title_like": POSTINGS + f"SELECT ID, TITLE FROM clean WHERE {title_like()}",
        "q_feed_cap": _feed_cap(rules.FEED_WINDOW_HOURS),
        "q_feed_cap_week": _feed_cap(WEEK_HOURS),
        "q_union_categories": _with(RAW) + "\nUNION ALL\n".join(
            f"SELECT ID, TITLE, {lit(t)} AS JOB_CATEGORY FROM raw WHERE regexp_matches(TITLE, {lit(chr(92) + 'b' + t + chr(92) + 'b')}, 'i')"
            for t in rules.TARGET_TITLES),
        "q_city_extract": _with(RAW) + f"SELECT ID, LOCATIONS_RAW, {city_extract('LOCATIONS_RAW')} AS CITY FROM raw",
        "q_state_extract": _with(RAW) + f"SELECT ID, LOCATIONS_RAW, {state_extract('LOCATIONS_RAW')} AS STATE FROM raw",
        "q_employment_type": _with(RAW) + (f"SELECT ID, EMPLOYMENT_TYPE AS EMPLOYMENT_TYPE_RAW, "
                                            f"{employment_type('EMPLOYMENT_TYPE')} AS EMPLOYMENT_TYPE FROM raw"),
        "q_org_size": _with(RAW) + f"SELECT ID, LINKEDIN_ORG_SIZE, {org_size('LINKEDIN_ORG_SIZE')} AS ORG_SIZE FROM raw",
        "q_job_date": _with(RAW) + f"SELECT ID, DATE_CREATED, {job_date('DATE_CREATED')} AS JOB_DATE FROM raw",
        "q_url_encode": _with(RAW) + ("SELECT TITLE, replace(url_encode(TITLE), '%2F', '/') AS TITLE_ENCODED "
                                      "FROM (SELECT DISTINCT TITLE FROM raw WHERE TITLE IS NOT NULL)"),
        "q_json_path": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
        "q_json_flatten": ("SELECT event_id, event_type, TRY_CAST(json_extract(props, '$.k') AS BIGINT) "
                           "AS \"props.k\" FROM events"),
        "q_anti_join": _with(RAW, CLEAN, STORED) + """SELECT c.ID, c.TITLE, c.JOB_CATEGORY, c.JOB_DATE FROM clean c
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.ID IS NOT DISTINCT FROM c.ID)""",
        "q_dict_lookup_na": _lookup("na"),
        "q_dict_lookup_keep": _lookup("keep"),
        "q_translate": POSTINGS + f"SELECT ID, {translated_v2} FROM clean",
        "q_translate_v1": POSTINGS + f"SELECT ID, {translated_v1} FROM clean",
        "q_base_city": FACT_BASE + "SELECT CITY, CITY_STANDARDIZED, STATE FROM base_city",
        "q_base_state": FACT_BASE + "SELECT CITY_STANDARDIZED, STATE_STANDARDIZED FROM base_state",
        "q_seniority_rules": _with(RAW, CLEAN, SEN) + "SELECT SENIORITY, SENIORITY_STANDARDIZED FROM sen_dict",
        "q_seniority_labels": POSTINGS + (f"SELECT SENIORITY, {seniority_label('SENIORITY')} AS SENIORITY_LABEL "
                                          f"FROM (SELECT DISTINCT SENIORITY FROM clean)"),
        "q_int_data": FACT_BASE + "SELECT * FROM fact",
        "q_job_links": POSTINGS + ("SELECT DISTINCT ID, TITLE, JOB_CATEGORY, URL FROM clean "
                                   "ORDER BY JOB_CATEGORY, ID, TITLE"),
        "q_by_city": FACT_BASE + ("SELECT JOB_CATEGORY, CITY, COUNT(DISTINCT ID) AS total_jobs FROM fact "
                                  "GROUP BY JOB_CATEGORY, CITY ORDER BY JOB_CATEGORY, CITY, total_jobs DESC"),
        "q_by_org": FACT_BASE + ("SELECT ORGANIZATION, JOB_CATEGORY, COUNT(DISTINCT ID) AS total_jobs FROM fact "
                                 "GROUP BY ORGANIZATION, JOB_CATEGORY ORDER BY ORGANIZATION, JOB_CATEGORY, total_jobs DESC"),
        "q_by_state": FACT_BASE + ("SELECT JOB_CATEGORY, STATE, COUNT(DISTINCT ID) AS total_jobs FROM fact "
                                   "GROUP BY JOB_CATEGORY, STATE ORDER BY JOB_CATEGORY, STATE"),
        "q_by_type": FACT_BASE + ("SELECT JOB_CATEGORY, COUNT(DISTINCT ID) AS total_jobs FROM fact "
                                  "GROUP BY JOB_CATEGORY ORDER BY JOB_CATEGORY, total_jobs DESC"),
        "q_daily": FACT_BASE + _daily_sql(),
        "q_wow": wow,
        "q_ingest": _ingest_sql(),
        "q_ingest_v1": _ingest_sql("v1"),
        "q_first_per_key": """SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS rn FROM documents
) WHERE rn = 1""",
        "q_role_text": """SELECT role, text, conv_id AS first_conv_id, turn AS first_turn FROM (
  SELECT *, row_number() OVER (PARTITION BY role, text ORDER BY conv_id, turn) AS rn FROM conversations
) WHERE rn = 1""",
        "q_top_skills": _top_skills_sql(),
        "q_csv_block": _csv_block_sql(),
        "q_top_job_skills": _top_job_skills_sql(),
        "q_union_aligned": _with(RAW) + f"""SELECT ID, TITLE, NULL AS ORGANIZATION, NULL AS URL FROM raw WHERE JOB_CATEGORY = {lit(fx.CATEGORIES[0])}
UNION ALL SELECT ID, TITLE, ORGANIZATION, NULL FROM raw WHERE JOB_CATEGORY = {lit(fx.CATEGORIES[1])}
UNION ALL SELECT ID, NULL, NULL, URL FROM raw WHERE JOB_CATEGORY = {lit(fx.CATEGORIES[2])}""",
        "q_json_default": ("SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, "
                           "coalesce(json_extract_string(props, '$.absent'), 'none') AS absent, "
                           "'none' AS invalid FROM events"),
        "q_csv_text": _csv_text_sql(),
        "q_row_counts": _with(RAW) + f"""SELECT 'feed' AS step, count(*) AS rows FROM raw
UNION ALL SELECT 'titled', count(*) FROM raw WHERE {title_regex()}
UNION ALL SELECT 'titled_with_date', count(*) FROM raw WHERE {title_regex()} AND {job_date('DATE_CREATED')} IS NOT NULL""",
        "q_translate_kept": POSTINGS + f"SELECT ID, {', '.join(f'{_translate_kept(c)} AS {c}' for c in ('CITY', 'STATE', 'ORGANIZATION', 'SENIORITY'))} "
                                       f"FROM (SELECT ID, {translated_v2} FROM clean) t",
        "q_kept_calls": POSTINGS[:-1] + f""",
every AS (SELECT CITY AS v FROM clean WHERE CITY IS NOT NULL UNION SELECT SENIORITY FROM clean WHERE SENIORITY IS NOT NULL),
early AS (SELECT CITY AS v FROM clean WHERE CITY IS NOT NULL AND JOB_DATE < DATE '{STORED_BEFORE}'
  UNION SELECT SENIORITY FROM clean WHERE SENIORITY IS NOT NULL AND JOB_DATE < DATE '{STORED_BEFORE}')
SELECT 0 AS run, count(*) AS called, count(*) FILTER (v = 'Canberra') AS failed FROM early
UNION ALL SELECT 1, count(*), count(*) FILTER (v = 'Canberra') FROM every WHERE v = 'Canberra' OR v NOT IN (SELECT v FROM early)
UNION ALL SELECT 2, count(*), count(*) FROM every WHERE v = 'Canberra'""",
        "q_scored_terms": _scored_terms_sql(),
        "q_daily_loads": POSTINGS[:-1] + f""",
batch AS (SELECT ID, TITLE, JOB_CATEGORY, JOB_DATE, CITY FROM clean),
first AS (SELECT * FROM batch WHERE JOB_DATE < DATE '{FIRST_LOAD}'),
second AS (SELECT * FROM batch b WHERE JOB_DATE < DATE '{SECOND_LOAD}' AND CITY IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM first f WHERE f.ID IS NOT DISTINCT FROM b.ID))
SELECT *, '{FIRST_LOAD}' AS LOAD_DATE FROM first UNION ALL SELECT *, '{SECOND_LOAD}' FROM second""",
        "q_csv_typed": """SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no, l_extendedprice AS price,
  CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_suppkey AS DOUBLE) END AS supplier, l_returnflag = 'R' AS returned,
  l_returnflag || l_linenumber AS code, 'say "' || l_linestatus || '"' || chr(10) || l_returnflag || ', ' || l_partkey AS note
FROM lineitem""",
        "q_sheets": f"""SELECT CAST(sheet_no AS INTEGER) AS sheet_no, CAST(doc_id AS VARCHAR) AS doc_id, Job_Title, NULLIF(text, '') AS Job_Description FROM (
  SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS rn, {pick(fx.DESCRIPTION_TITLES, "doc_id")} AS Job_Title,
    dense_rank() OVER (ORDER BY source) - 1 AS sheet_no FROM documents)
WHERE rn = 1 AND sheet_no > 0""",
        "q_replace_view": POSTINGS + "SELECT ID, TITLE, JOB_CATEGORY, JOB_DATE FROM clean WHERE JOB_DATE IS NOT NULL",
        "q_marts": FACT_BASE + """SELECT 'by_city' AS mart, JOB_CATEGORY, CITY, NULL AS ORGANIZATION, NULL AS STATE, COUNT(DISTINCT ID) AS total_jobs FROM fact GROUP BY JOB_CATEGORY, CITY
UNION ALL SELECT 'by_org', JOB_CATEGORY, NULL, ORGANIZATION, NULL, COUNT(DISTINCT ID) FROM fact GROUP BY ORGANIZATION, JOB_CATEGORY
UNION ALL SELECT 'by_state', JOB_CATEGORY, NULL, NULL, STATE, COUNT(DISTINCT ID) FROM fact GROUP BY JOB_CATEGORY, STATE
UNION ALL SELECT 'by_type', JOB_CATEGORY, NULL, NULL, NULL, COUNT(DISTINCT ID) FROM fact GROUP BY JOB_CATEGORY""",
        "q_day_states": POSTINGS + """SELECT JOB_CATEGORY, year(JOB_DATE) AS "Year", 'year' AS level, COUNT(DISTINCT ID) AS total_jobs FROM clean GROUP BY 1, 2
UNION ALL SELECT JOB_CATEGORY, NULL, 'all', COUNT(DISTINCT ID) FROM clean GROUP BY 1""",
        "q_json_merged": """SELECT event_id, CASE event_id % 5 WHEN 0 THEN '7' WHEN 1 THEN event_type END AS "props.code",
  CAST(NULL AS VARCHAR) AS "props.gone", CASE WHEN event_id % 5 = 4 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS "props.k",
  CASE WHEN event_id % 5 = 2 THEN user_id + 0.5::DOUBLE END AS "props.score", CASE WHEN event_id % 5 = 1 THEN ['a', 'b'] END AS "props.tags",
  CASE WHEN event_id % 5 = 0 THEN user_id END AS "props.user.id", CASE WHEN event_id % 5 = 0 THEN event_type END AS "props.user.kind" FROM events""",
        "q_landed": _with(RAW) + """SELECT JOB_CATEGORY, CASE CAST(ID AS BIGINT) % 40 WHEN 0 THEN 'malformed' WHEN 1 THEN 'not an object' WHEN 2 THEN 'wrong type'
    WHEN 3 THEN 'no id' END AS reason, count(*) AS records, count(DISTINCT CASE WHEN CAST(ID AS BIGINT) % 40 NOT IN (0, 1, 3) THEN ID END) AS ids
FROM raw GROUP BY 1, 2""",
        "q_preview": """(SELECT event_id, ts, user_id, event_type, 'head' AS part FROM events ORDER BY ts, event_id LIMIT 5)
UNION ALL (SELECT event_id, ts, user_id, event_type, 'tail' FROM events ORDER BY ts DESC, event_id DESC LIMIT 5)""",
        "q_distinct_function": POSTINGS + ("SELECT DISTINCT CITY, CASE WHEN CITY = 'Canberra' THEN 'none' ELSE upper(left(CITY, 3)) END "
                                           "AS code, CITY = 'Canberra' AS failed FROM clean WHERE CITY IS NOT NULL"),
    }
