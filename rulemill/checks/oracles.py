"""The same queries as SQL for DuckDB, written from the definitions.

Corpora and the parse are common table expressions that each query selects
from; DuckDB leaves out those a query does not use.
"""

from __future__ import annotations

from .. import fixed
from .queries import AT, KEEP_DAYS

WS = fixed.WHITESPACE
# The same set inside an RE2 class.
WS_RE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINES_RE = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
LABEL = r"[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?"


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def before(x: str, sep: str) -> str:
    return f"(CASE WHEN instr({x}, {sep}) > 0 THEN substr({x}, 1, instr({x}, {sep}) - 1) ELSE {x} END)"


def after(x: str, sep: str) -> str:
    return f"(CASE WHEN instr({x}, {sep}) > 0 THEN substr({x}, instr({x}, {sep}) + length({sep})) ELSE '' END)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(function: str, x: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"{function}({x}, {q(p)})" for p in parts) + ")"


def first_contained(x: str, parts: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({x}, {q(p)}) THEN {q(p)}" for p in parts) + " END"


def case(bucket: str, lines: list[str]) -> str:
    return f"CASE {bucket} " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(lines)) + " END"


# Corpora

PAGES = r"""
pg AS (
  SELECT page_id AS n, regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1), '^(www|blog|m)\.', '') AS apex
  FROM pages)"""

PAGE_TEXT = [
    "'||' || host || '^'",
    "'0.0.0.0 ' || host",
    "'@@||' || host || '^'",
    "host || '##.ad'",
    "'||' || upper(host) || path || '$script,domain=b.com|a.com'",
    "'||' || apex || '^'",
    "'z.org,' || host || '#@#.ad'",
    "'! note' || n",
    "'||ads.' || apex || '^$third-party'",
    "'  ||' || host || '^  '",
]
SYNTAX_TEXT = [
    "'# hosts comment ' || n",
    "'########'",
    "'! ===== section ' || n || ' ====='",
    "host || '#%#//scriptlet(''x'', ''' || n || ''')'",
    "host || '#$# script:inject(' || n || ')'",
    "host || '#$#body { margin: 0 }'",
    "host || '#@$?#div:has(.ad)'",
    "host || '##+js(abort, ' || n || ')'",
    "host || '$$div[id=\"' || n || '\"]'",
    "host || '#@$$div'",
    r"'||' || host || '^$permissions=autoplay=()\, camera=(),script'",
    "'|http://' || host || '/$/ads|'",
    "'||' || host || '^$removeparam=x,~third-party,domain=z.com|a.com'",
    "'||www.' || upper(host) || '^$match-case,image'",
    "'127.0.0.1   ' || host || '   # note ' || n",
    "'! Expires: ' || (n % 7) || ' days'",
    "'! Homepage: https://' || host || '/'",
    "'! comment ' || n",
    "'[Adblock Plus ' || n || ']'",
    "'   '",
    "host || '#?#div:has(> .' || n || ')'",
    "'z.org, ' || host || ' ,~a.org#@#.x'",
    "'/banner/' || n || '/*$script,script,image=1,image=2'",
    "'@@||' || host || '^$,'",
    "'||www.' || host || path || '^'",
    "'||x.www.' || host || '/a/' || n || '^'",
    "'||' || host || '^$replace=/one(, two)?/three/i,media'",
    "'||' || host || '^$removeparam=/p,q/,font'",
    r"'||' || host || '^$replace=/a\/b,c/d/,ping'",
]
#: Options with commas inside a regular expression, as the parts they were made of.
REGEX_OPTIONS = [["replace=/one(, two)?/three/i", "media"], ["removeparam=/p,q/", "font"], [r"replace=/a\/b,c/d/", "ping"]]
N = len(SYNTAX_TEXT)

RULE_LINES = f"""
page_rules AS (
  SELECT 'list' || (n % 5) AS source, n % 5 + 1 AS priority, n % 5 AS source_ord, 0 AS chunk, n AS line_no,
         {case("(n // 5) % 10", PAGE_TEXT)} AS line FROM pg
  UNION ALL
  SELECT DISTINCT 'list' || (n % 5), n % 5 + 1, n % 5, 0, -1, '! Title: List Collection' FROM pg),
syntax_rules AS (
  SELECT 'syntax' || ((n // {N}) % 4) AS source, (n // {N}) % 4 + 2 AS priority,
         (n // {N}) % 4 + 5 AS source_ord, 0 AS chunk, n AS line_no, {case(f"n % {N}", SYNTAX_TEXT)} AS line FROM pg),
rule_lines AS (SELECT * FROM page_rules UNION ALL SELECT * FROM syntax_rules),
document_parts AS (
  SELECT source, doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts
  FROM (SELECT source, doc_id, regexp_split_to_array(text, '{LINES_RE}') AS parts FROM documents)),
document_lines AS (
  SELECT source, CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) + 1 AS priority,
         CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) + 9 AS source_ord,
         doc_id AS chunk, pos AS line_no, parts[pos + 1] AS line
  FROM (SELECT *, unnest(range(len(parts))) AS pos FROM document_parts)),
bulk_lines AS (
  SELECT 'bulk' || (l_linenumber % 4) AS source, l_linenumber % 4 + 1 AS priority,
         l_linenumber % 4 + 40 AS source_ord, 0 AS chunk, l_orderkey * 8 + l_linenumber AS line_no,
         '||' || (CASE WHEN l_partkey % 10 = 0 THEN '' ELSE 'p' || l_partkey || '.' END) || 's' || l_suppkey
         || (CASE WHEN l_suppkey % 3 = 0 THEN '.example.com^' ELSE '.example.net^' END) AS line
  FROM lineitem),
all_lines AS (
  SELECT * FROM rule_lines UNION ALL SELECT * FROM document_lines UNION ALL SELECT * FROM bulk_lines)"""

# Parse

HOSTS_RE = rf"^(?:127\.0\.0\.1|0\.0\.0\.0)[{WS_RE}]+(.+)"
SEPS = [s for s, _ in fixed.TYPE_SEPARATORS]
TYPE_CASE = "CASE " + " ".join(
    f"WHEN sep0 = {q(s)} THEN {q(t)}" for s, t in fixed.TYPE_SEPARATORS if t
) + f"""
  WHEN sep0 IN ('#%#', '#$#') THEN CASE WHEN {any_of(
      'starts_with', "ltrim(" + after("text", "sep0") + f", '{WS}')", fixed.SCRIPT_BODY_PREFIXES)}
      THEN 'scriptlet' ELSE 'css-inject' END
  WHEN starts_with(text, '@@') THEN 'exception' ELSE 'block' END"""
KNOWN = ", ".join(q(o) for o in fixed.KNOWN_OPTIONS)
OPTION_OK = (
    f"CASE WHEN contains(o, '=') THEN {strip('split_part(ltrim(o, chr(126)), chr(61), 1)')} <> ''"
    f" ELSE ltrim(o, '~') IN ({KNOWN}) END"
)

PARSE = f"""
kinds AS (
  SELECT *, CASE
    WHEN text = '' THEN 'blank'
    WHEN {any_of('starts_with', 'text', fixed.HEADER_PREFIXES)} THEN 'header'
    WHEN starts_with(text, '! =') AND ends_with(text, '=') THEN 'section-marker'
    WHEN starts_with(text, '!') THEN 'comment'
    WHEN starts_with(text, '[') AND ends_with(text, ']') AND length(text) > 1 THEN 'block-marker'
    WHEN starts_with(text, '#') AND ({strip("replace(text, '#', '')")} = ''
         OR NOT {any_of('starts_with', 'text', fixed.ELEMENT_PREFIXES)}) THEN 'hash-comment'
    WHEN regexp_matches(text, '{HOSTS_RE}') THEN 'hosts'
    ELSE 'rule' END AS kind
  FROM (SELECT *, {strip('line')} AS text FROM lines)),
emitted AS (
  SELECT *, CASE WHEN kind = 'hosts' THEN {strip("split_part(text, ' #', 1)")} ELSE text END AS raw,
         CASE WHEN kind = 'rule' THEN coalesce({first_contained('text', SEPS)}, '') ELSE '' END AS sep0
  FROM kinds WHERE kind IN ('header', 'hosts', 'rule')),
typed AS (
  SELECT * EXCLUDE (sep0), sep0 AS sep,
         CASE kind WHEN 'header' THEN 'header' WHEN 'hosts' THEN 'block' ELSE {TYPE_CASE} END AS rule_type,
         CASE WHEN kind = 'rule' AND sep0 = '' AND contains(text, '$') THEN {after('text', "'$'")} END AS opts
  FROM emitted),
tokens AS (
  SELECT *, CASE {" ".join(f"WHEN opts = {q(','.join(o))} THEN [{', '.join(map(q, o))}]" for o in REGEX_OPTIONS)}
    WHEN opts IS NULL THEN NULL ELSE regexp_extract_all(opts, '(?:\\\\,|[^,])+') END AS toks
  FROM typed),
checked AS (
  SELECT *, opts = '' OR len([o FOR o IN toks IF {OPTION_OK}]) > 0 AS valid FROM tokens),
split AS (
  SELECT *,
    CASE WHEN kind = 'header' THEN '' WHEN valid THEN {before('text', "'$'")} ELSE raw END AS pattern,
    CASE WHEN sep <> '' THEN [{strip('s')} FOR s IN string_split({strip(before('text', 'sep'))}, ',') IF {strip('s')} <> '']
         ELSE CAST([] AS VARCHAR[]) END AS sites,
    CASE WHEN contains(raw, '$') AND {first_contained('raw', fixed.KEY_SEPARATORS)} IS NULL
         THEN {before('raw', "'$'")} ELSE raw END AS pat0,
    CASE WHEN contains(raw, '$') AND {first_contained('raw', fixed.KEY_SEPARATORS)} IS NULL
         THEN {after('raw', "'$'")} ELSE '' END AS opt0
  FROM checked),
cased AS (
  SELECT *, list_contains([{strip("split_part(o, '=', 1)")} FOR o IN string_split(opt0, ',')], 'match-case') AS match_case
  FROM split),
keyed0 AS (
  SELECT *, regexp_replace(regexp_replace(CASE WHEN match_case THEN pat0 ELSE lower(pat0) END,
            '[{WS_RE}]+', ' ', 'g'), '([^a-z0-9])www\\.', '\\1', 'g') AS pat1
  FROM cased),
keyed1 AS (SELECT *, {first_contained('pat1', fixed.KEY_SEPARATORS)} AS ksep FROM keyed0),
rules AS (
  SELECT source, priority, source_ord, chunk, line_no, raw, rule_type, sep, opts, toks, valid, pattern, sites, match_case,
    CASE kind WHEN 'header' THEN ''
      WHEN 'hosts' THEN lower({strip("split_part(" + strip(f"regexp_extract(text, '{HOSTS_RE}', 1)") + ", ' #', 1)")})
      ELSE lower(coalesce(
        nullif(regexp_extract(pattern, '\\|\\|({LABEL}(?:\\.{LABEL})*)', 1), ''),
        nullif({strip(f"regexp_extract({strip('pattern')}, '{HOSTS_RE}', 1)")}, ''),
        regexp_extract(regexp_replace({strip('pattern')}, '^(@@)?(\\|\\|)?', ''), '^({LABEL}(?:\\.{LABEL})+)', 1)))
      END AS domain,
    CASE WHEN len(sites) > 1
      THEN array_to_string(list_sort([lower(s) FOR s IN sites]), ',') || sep || lower({after('raw', 'sep')})
      ELSE lower(raw) END AS parsed_key,
    (CASE WHEN ksep IS NOT NULL AND contains({before('pat1', 'ksep')}, ',')
      THEN array_to_string(list_sort([{strip('s')} FOR s IN string_split({before('pat1', 'ksep')}, ',') IF {strip('s')} <> '']), ',')
           || ksep || {after('pat1', 'ksep')}
      ELSE pat1 END)
    || (CASE WHEN opt0 = '' THEN '' ELSE '$' || array_to_string([
      CASE WHEN {after('s', "'domain='")} <> ''
        THEN {before('s', "'domain='")} || 'domain=' || array_to_string(list_sort([{strip('v')} FOR v IN string_split({after('s', "'domain='")}, '|')]), '|')
        ELSE s END FOR s IN string_split(lower(opt0), ',')], ',') END) AS normalized,
    CASE WHEN rule_type IN ('header', 'exception', 'block') THEN rule_type ELSE 'element' END AS section
  FROM keyed1),
options AS (
  SELECT source, line_no, raw,
    unnest([{strip('o')} FOR o IN toks IF {strip('o')} <> '']) AS part,
    unnest(range(len([1 FOR o IN toks IF {strip('o')} <> '']))) AS pos
  FROM rules WHERE valid),
named_options AS (
  SELECT source, line_no, raw, pos, {strip("split_part(part, '=', 1)")} AS key,
         CASE WHEN contains(part, '=') THEN {after('part', "'='")} END AS value
  FROM options),
last_options AS (
  SELECT * FROM named_options
  QUALIFY row_number() OVER (PARTITION BY source, line_no, raw, key ORDER BY pos DESC) = 1)"""

# Merge

MERGE = f"""
exact AS MATERIALIZED (
  SELECT * FROM rules
  QUALIFY row_number() OVER (PARTITION BY section, normalized ORDER BY priority, source_ord, chunk, line_no) = 1),
blocks AS MATERIALIZED (
  SELECT * FROM (
    SELECT normalized, domain, priority, source_ord, chunk, line_no, ltrim(normalized, '@') AS clean,
           lower(regexp_extract(ltrim(normalized, '@'), '^\\|*({LABEL}(?:\\.{LABEL})+)', 1)) AS key_domain
    FROM exact WHERE section = 'block' AND domain <> '')
  WHERE key_domain <> ''),
ups AS (
  SELECT *, array_to_string(string_split(domain, '.')[i + 1:], '.') AS up
  FROM (SELECT *, unnest(range(1, len(string_split(domain, '.')))) AS i FROM blocks)),
pairs AS MATERIALIZED (
  SELECT c.normalized AS child, p.normalized AS parent, c.i, p.priority, p.source_ord, p.chunk, p.line_no
  FROM ups c JOIN blocks p ON p.domain = c.up
  WHERE p.normalized <> c.normalized AND (
    ends_with(c.key_domain, '.' || p.key_domain)
    OR (contains(p.clean, '||') AND contains(c.clean, '||') AND contains(substr(p.clean, 3), '^')
        AND starts_with(substr(c.clean, 3), {before("substr(p.clean, 3)", "'^'")} || '/')))),
merged AS MATERIALIZED (
  SELECT * FROM exact WHERE section <> 'block'
  UNION ALL
  SELECT e.* FROM exact e ANTI JOIN (SELECT DISTINCT child FROM pairs) p ON e.normalized = p.child WHERE e.section = 'block'),
waiting AS (
  SELECT source, chunk, line_no, text, min(CASE WHEN kind <> 'comment' THEN (chunk, line_no) END) OVER (
    PARTITION BY source ORDER BY chunk, line_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS target, kind
  FROM kinds WHERE kind IN ('header', 'hosts', 'rule', 'comment')),
comments AS (
  SELECT source, target[1] AS chunk, target[2] AS line_no, string_agg(text, chr(10) ORDER BY chunk, line_no) AS comments,
         list(text ORDER BY chunk, line_no) AS comment_list
  FROM waiting WHERE kind = 'comment' AND target IS NOT NULL GROUP BY ALL),
edition AS (
  SELECT m.*, coalesce(c.comments, '') AS comments, coalesce(c.comment_list, CAST([] AS VARCHAR[])) AS comment_list
  FROM merged m LEFT JOIN comments c USING (source, chunk, line_no) WHERE length(m.raw) <= 4000)"""

FIRST_PARENT = """SELECT child, parent FROM pairs
           QUALIFY row_number() OVER (PARTITION BY child ORDER BY i, priority, source_ord, chunk, line_no, parent) = 1"""

CHAINS = f"""
firsts AS MATERIALIZED (
  {FIRST_PARENT}),
chains AS (
  SELECT child, parent, parent AS reached, 1 AS steps FROM firsts
  UNION ALL
  SELECT c.child, c.parent, f.parent, c.steps + 1 FROM chains c JOIN firsts f ON f.child = c.reached)"""

RANK = """CASE rule_type WHEN 'header' THEN 0 WHEN 'exception' THEN 1 WHEN 'block' THEN 2
  WHEN 'hide-exception' THEN 3 ELSE 4 END"""

# Refresh

DAYS = """
users AS (SELECT DISTINCT 'user' || user_id AS source FROM events),
runs AS (SELECT DISTINCT day(ts) AS run FROM events),
seen AS (
  SELECT day(ts) AS run, 'user' || user_id AS source, min(props) AS strong, min(event_type) AS weak,
         max(event_type) AS top, count(*) FILTER (value > 10) AS rule_count
  FROM events GROUP BY ALL),
days AS (
  SELECT r.run, u.source, s.* EXCLUDE (run, source), CASE WHEN weak = 'click' THEN '' ELSE strong END AS token,
         CASE WHEN top = 'view' THEN '' ELSE top END AS content, CASE WHEN strong IS NULL THEN 'no answer' END AS error
  FROM users u CROSS JOIN runs r LEFT JOIN seen s USING (run, source)),
now AS (SELECT * FROM days WHERE run > (SELECT min(run) FROM runs)),
state AS (SELECT run + 1 AS run, source, token FROM days WHERE token <> '' AND run < (SELECT max(run) FROM runs)),
detected AS (
  SELECT *, error IS NULL AND token IS DISTINCT FROM old AS changed FROM (
    SELECT d.* EXCLUDE (token), CASE WHEN error IS NULL THEN coalesce(nullif(d.token, ''), sha256(content)) END AS token, s.token AS old
    FROM now d LEFT JOIN state s USING (run, source))),
statuses AS (
  SELECT run, source,
    CASE WHEN error IS NOT NULL OR content = '' THEN 0 ELSE coalesce(rule_count, 0) END AS rule_count,
    CASE WHEN error IS NOT NULL THEN 'error' WHEN content = '' AND changed THEN 'empty'
         WHEN changed THEN 'updated' ELSE 'unchanged' END AS status
  FROM detected)"""

REGISTRY = """
registry AS (
  SELECT s_name AS name, 'https://lists.example/' || s_suppkey || '.txt' AS url, s_nationkey AS priority,
         coalesce(CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal > 4000 END, false) AS lite,
         coalesce(CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey % 7 <> 3 END, true) AS enabled,
         CAST(s_suppkey AS INTEGER) AS source_ord
  FROM supplier)"""

MARKED = " ".join(f"WHEN starts_with(text, {q(prefix)}) THEN {q(section)}" for prefix, section in fixed.MARK_PREFIXES)
PUBLISHED = f"""
published AS (
  SELECT 'edition' || (page_id % 3) AS edition, page_id AS line_no, {strip(f'''CASE
    WHEN page_id % 17 = 5 THEN [{q(fixed.MARK_EXCEPTION)}, {q(fixed.MARK_BLOCK)}, {q(fixed.MARK_ELEMENT)},
                                {q(fixed.MARK_HIDE_EXCEPTION)}][(page_id // 17) % 4 + 1]
    WHEN page_id % 23 = 7 THEN '! Last modified: run ' || page_id
    WHEN page_id % 11 = 3 THEN '[$path=/x]' || url
    WHEN page_id % 11 = 4 THEN '! ' || url
    ELSE url END''')} AS text
  FROM pages),
placed AS (
  SELECT *, text <> '' AND NOT starts_with(text, '!') AND NOT starts_with(text, '[') AS is_rule,
    coalesce(last_value(CASE
      {MARKED} END IGNORE NULLS)
      OVER (PARTITION BY edition ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'block') AS section
  FROM published)"""

HISTORY = """
history AS (
  SELECT event_type AS edition, CAST(ts AS DATE) AS run_day, count(*) AS total_rules FROM events GROUP BY ALL)"""


def _with(*parts: str, select: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n" + select


def _rules(select: str, lines: str = "rule_lines", where: str = "true") -> str:
    chosen = f"\nlines AS (SELECT * FROM {lines} WHERE {where})"
    return _with(PAGES, RULE_LINES, chosen, PARSE, MERGE, select=select)


def _all(select: str, where: str = "true") -> str:
    return _rules(select, "all_lines", where)


EDITION_COLUMNS = "section, source, CAST(priority AS INTEGER) AS priority, line_no, raw, normalized, comments"
OPTION_ROWS = "sep = '' AND contains(raw, '$') AND section <> 'header'"

ORACLES: dict[str, str] = {
    "active_sources": _with(REGISTRY, select="SELECT * FROM registry WHERE enabled ORDER BY priority, source_ord"),
    "lite_sources": _with(REGISTRY, select="SELECT * FROM registry WHERE enabled AND lite ORDER BY priority, source_ord"),
    "source_catalogue": _with(
        REGISTRY, select="SELECT row_number() OVER (ORDER BY NOT lite, source_ord) AS number, name, lite FROM registry"
    ),
    "list_lines": f"""
        SELECT source, parts[pos + 1] AS line, pos AS line_no, pos // 64 AS chunk
        FROM (SELECT *, unnest(range(len(parts))) AS pos
              FROM (SELECT source, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts
                    FROM (SELECT 'doc' || doc_id AS source, regexp_split_to_array(text, '{LINES_RE}') AS parts FROM documents)))""",
    "raw_rule_counts": _all(
        "SELECT source, count(*) FILTER (text <> '' AND NOT starts_with(text, '!') AND NOT starts_with(text, '['))"
        " AS rule_count FROM kinds GROUP BY source"
    ),
    "changed_sources": _with(DAYS, select="SELECT run, source, token, changed FROM detected"),
    "token_coalesce": _with(
        DAYS,
        select="""SELECT d.run, d.source, coalesce(nullif(CASE WHEN weak = 'click' THEN '' ELSE strong END, ''),
            nullif(weak, ''), nullif(s.token, '')) AS token FROM now d LEFT JOIN state s USING (run, source)""",
    ),
    "state_upsert": _with(
        DAYS,
        select="""SELECT * FROM (SELECT coalesce(s.run, d.run) AS run, coalesce(s.source, d.source) AS source,
              coalesce(CASE WHEN d.error IS NULL THEN nullif(d.token, '') END, s.token) AS token
            FROM state s FULL JOIN now d ON s.source = d.source AND s.run = d.run) WHERE token IS NOT NULL""",
    ),
    "source_status": _with(DAYS, select="SELECT * FROM statuses"),
    "changed_count": _with(DAYS, select="SELECT run, count(*) FILTER (changed) AS changed FROM detected GROUP BY run"),
    "usable_sources": """
        SELECT source, run_id, top AS content FROM (
          SELECT 'user' || user_id AS source, strftime(ts, '%Y-%m-%d') AS run_id,
                 max(event_type) AS top, min(event_type) AS low FROM events GROUP BY ALL)
        WHERE low <> 'purchase' AND top <> 'view'
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_id DESC) = 1""",
    "line_kind": _all("SELECT source, kind, count(*) AS lines FROM kinds GROUP BY ALL"),
    "headers": _rules("SELECT source, line_no, text FROM kinds WHERE kind = 'header'"),
    "section_markers": _rules("SELECT source, line_no, text FROM kinds WHERE kind = 'section-marker'"),
    "hash_comments": _rules("SELECT source, line_no, text FROM kinds WHERE kind = 'hash-comment'"),
    "hosts_rows": _rules(
        "SELECT source, line_no, raw, domain FROM rules WHERE raw LIKE '0.0.0.0%' OR raw LIKE '127.0.0.1%'"
    ),
    "rule_types": _all("SELECT source, rule_type, sep, count(*) AS rules FROM rules GROUP BY ALL"),
    "inject_kind": _rules("SELECT source, line_no, raw, rule_type AS kind FROM rules WHERE sep IN ('#%#', '#$#')"),
    "option_tokens": _rules(
        f"SELECT source, line_no, raw, array_to_string(toks, chr(10)) AS tokens FROM rules WHERE {OPTION_ROWS}"
    ),
    "options_valid": _rules(f"SELECT source, line_no, raw, valid FROM rules WHERE {OPTION_ROWS}"),
    "rule_options": _rules(
        """SELECT r.source, r.line_no, r.pattern,
             coalesce(string_agg(o.key || coalesce('=' || o.value, ''), chr(10)
                      ORDER BY o.key || coalesce('=' || o.value, '')), '') AS options
           FROM rules r LEFT JOIN last_options o USING (source, line_no, raw)
           WHERE section IN ('block', 'exception') GROUP BY ALL"""
    ),
    "option_usage": _rules(
        "SELECT key AS option, count(*) AS rules, count(value) AS with_value FROM last_options GROUP BY key"
    ),
    "site_scope": _rules(
        "SELECT source, line_no, raw, array_to_string(sites, chr(10)) AS sites FROM rules WHERE section = 'element'"
    ),
    "rules_by_site": _all(
        "SELECT site, count(*) AS rules FROM (SELECT unnest(sites) AS site FROM rules) GROUP BY site"
    ),
    "rule_domain": _all("SELECT source, domain, count(*) AS rules FROM rules GROUP BY ALL"),
    "rule_comments": _rules(
        """SELECT r.source, r.line_no, r.raw, coalesce(c.comments, '') AS comments
           FROM rules r LEFT JOIN comments c USING (source, chunk, line_no)"""
    ),
    "parse_key": _rules("SELECT source, line_no, raw, parsed_key FROM rules"),
    "normalized": _all("SELECT source, normalized, count(*) AS rules FROM rules GROUP BY ALL"),
    "match_case_key": _rules(f"SELECT source, line_no, raw, match_case, normalized FROM rules WHERE {OPTION_ROWS}"),
    "strip_www": _with(
        PAGES, RULE_LINES,
        select=r"""SELECT source, line_no, regexp_replace(line, '([^a-z0-9])www\.', '\1', 'g') AS line
            FROM rule_lines WHERE contains(line, 'www.')""",
    ),
    "sorted_sites": _rules(
        f"""SELECT source, line_no, raw, CASE WHEN len(sites) > 1
              THEN array_to_string(list_sort(sites), ',') || sep || {after('raw', 'sep')} ELSE raw END AS key
            FROM rules WHERE section = 'element'"""
    ),
    "sorted_domain_option": _rules(
        f"""SELECT source, line_no, raw, array_to_string([
              CASE WHEN starts_with(s, 'domain=')
                THEN 'domain=' || array_to_string(list_sort(string_split(substr(s, 8), '|')), '|') ELSE s END
              FOR s IN string_split(opts, ',')], ',') AS key
            FROM rules WHERE {OPTION_ROWS}"""
    ),
    "priority_union": _rules(
        """SELECT CAST(priority AS INTEGER) AS priority, CAST(source_ord AS INTEGER) AS source_ord, line_no, source, raw
           FROM rules ORDER BY 1, 2, 3"""
    ),
    "sections": _all("SELECT section, rule_type, count(*) AS rules FROM rules GROUP BY ALL"),
    "exact_dedup": _all(
        "SELECT section, normalized, raw, source, CAST(priority AS INTEGER) AS priority FROM exact"
    ),
    "dup_counts": _all(
        """SELECT section, count(*) AS rules, count(DISTINCT normalized) AS kept,
             count(*) - count(DISTINCT normalized) AS removed FROM rules GROUP BY section"""
    ),
    "subset_dedup": _all(
        "SELECT normalized, raw, source, CAST(priority AS INTEGER) AS priority FROM merged WHERE section = 'block'"
    ),
    "broader_pairs": _all("SELECT child, parent FROM pairs"),
    "final_keepers": _with(
        PAGES, RULE_LINES, "\nlines AS (SELECT * FROM all_lines)", PARSE, MERGE, CHAINS, recursive=True,
        select="""SELECT child, parent, arg_max(reached, steps) AS keeper, CAST(max(steps) AS BIGINT) AS steps
           FROM chains GROUP BY child, parent""",
    ),
    "subsumed_count": _all("SELECT count(DISTINCT child) AS removed FROM pairs"),
    "edition_order": _rules(
        f"""SELECT CAST({RANK} AS INTEGER) AS section_rank, CAST(priority AS INTEGER) AS priority,
              CAST(source_ord AS INTEGER) AS source_ord, line_no, raw
            FROM merged WHERE length(raw) <= 4000 ORDER BY 1, 2, 3, 4"""
    ),
    "length_filter": _all(
        "SELECT section, normalized, CAST(length(raw) AS INTEGER) AS length FROM merged WHERE length(raw) <= 120"
    ),
    "edition_lite": _all(f"SELECT {EDITION_COLUMNS} FROM edition", where="source_ord % 3 = 0"),
    "edition_full": _all(f"SELECT {EDITION_COLUMNS} FROM edition"),
    "edition_stats": _all(
        """SELECT count(*) FILTER (section <> 'header') AS total_rules,
             count(*) FILTER (section = 'exception') AS exception_rules,
             count(*) FILTER (section = 'block') AS block_rules,
             count(*) FILTER (section = 'element') AS hide_rules FROM merged WHERE length(raw) <= 4000"""
    ),
    "by_source": _all(
        """SELECT source, count(*) AS rules FROM merged
           WHERE length(raw) <= 4000 AND section <> 'header' GROUP BY source"""
    ),
    "source_summary": _all(
        "SELECT source, CAST(priority AS INTEGER) AS priority, count(*) AS rule_count FROM rules GROUP BY ALL"
    ),
    "type_profile": _all("SELECT source, rule_type, count(*) AS rules FROM rules GROUP BY ALL"),
    "reread_stats": _with(
        PUBLISHED,
        select="""SELECT edition, count(*) FILTER (is_rule) AS total_rules,
             count(*) FILTER (is_rule AND section = 'exception') AS exception_rules,
             count(*) FILTER (is_rule AND section = 'block') AS block_rules,
             count(*) FILTER (is_rule AND section = 'element') AS hide_rules FROM placed GROUP BY edition""",
    ),
    "reread_stamp": _with(
        PUBLISHED,
        select=f"""SELECT edition, arg_max({strip(after("text", "':'"))}, line_no)
             FILTER (starts_with(text, '! Last modified:')) AS stamp FROM placed GROUP BY edition""",
    ),
    "file_stats": _all(
        """SELECT s.file, s.size_bytes, coalesce(rules, 0) AS rules, coalesce(exception, 0) AS exception,
             coalesce(hide, 0) AS hide, coalesce(block, 0) AS block
           FROM (SELECT source AS file, CAST(sum(strlen(text)) AS BIGINT) AS size_bytes FROM documents GROUP BY source) s
           LEFT JOIN (
             SELECT source, count(*) AS rules, count(*) FILTER (exc) AS exception,
               count(*) FILTER (el AND NOT exc) AS hide, count(*) FILTER (NOT el AND NOT exc) AS block
             FROM (SELECT source, starts_with(text, '@@') AS exc, contains(text, '##') OR contains(text, '#@#')
                     OR contains(text, '#?#') OR contains(text, '#%#') AS el
                   FROM kinds WHERE text <> '' AND NOT starts_with(text, '!') AND NOT starts_with(text, '['))
             GROUP BY source) c ON c.source = s.file"""
    ),
    "edition_text": _all(
        f"""SELECT CAST(part AS INTEGER) AS part, CAST(priority AS INTEGER) AS priority,
              CAST(source_ord AS INTEGER) AS source_ord, line_no, is_rule, CAST(c_line AS BIGINT) AS c_line, text FROM (
            SELECT 0 AS part, NULL AS priority, NULL AS source_ord, NULL AS line_no, 0 AS is_rule, i AS c_line, ([
              '[AdBlock Plus 2.0]', '! Title: Merged filter list',
              '! Description: Filter list merged from several upstream sources',
              '! Homepage: https://example.org/', '! Expires: 20 minutes',
              '! Version: {AT.strftime("%Y-%m-%d")}T08:00:00 CST', '! Last modified: {AT.strftime("%Y-%m-%d")}T08:00:00 CST',
              '! Total rules: ' || e + b + h, '!   Exception rules: ' || e, '!   Block rules: ' || b,
              '!   Hide rules: ' || h, '! Sources:'])[i + 1] AS text
            FROM (SELECT count(*) FILTER (section = 'exception') AS e, count(*) FILTER (section = 'block') AS b,
                         count(*) FILTER (section = 'element') AS h, unnest(range(12)) AS i FROM edition)
            UNION ALL
            SELECT 1, priority, source_ord, NULL, 0, NULL,
              '!   ' || source || ': ' || count(*) || ' rules (priority ' || priority || ')'
            FROM rules GROUP BY source, priority, source_ord
            UNION ALL SELECT 2, NULL, NULL, NULL, 0, NULL, '!'
            UNION ALL SELECT 20, NULL, NULL, NULL, 0, NULL, {q(fixed.MARK_EXCEPTION)}
              WHERE EXISTS (SELECT 1 FROM edition WHERE section = 'exception')
            UNION ALL SELECT 30, NULL, NULL, NULL, 0, NULL, {q(fixed.MARK_BLOCK)}
              WHERE EXISTS (SELECT 1 FROM edition WHERE section = 'block')
            UNION ALL SELECT 40, NULL, NULL, NULL, 0, NULL, {q(fixed.MARK_ELEMENT)}
              WHERE EXISTS (SELECT 1 FROM edition WHERE section = 'element')
            UNION ALL SELECT 41, NULL, NULL, NULL, 0, NULL, {q(fixed.MARK_HIDE_EXCEPTION)}
              WHERE EXISTS (SELECT 1 FROM edition WHERE rule_type = 'hide-exception')
            UNION ALL
            SELECT ([10, 21, 31, 42, 43])[{RANK} + 1], priority, source_ord, line_no, 1, NULL, raw FROM edition
            UNION ALL
            SELECT ([10, 21, 31, 42, 43])[{RANK} + 1], priority, source_ord, e.line_no, 0, w.line_no, w.text
            FROM edition e JOIN waiting w ON w.kind = 'comment' AND w.source = e.source AND w.target = (e.chunk, e.line_no))
            """
    ),
    "net_delta": _with(
        HISTORY,
        select="""SELECT edition, strftime(run_day, '%Y-%m-%d') AS run_ts, total_rules,
             CASE WHEN prev IS NOT NULL THEN greatest(0, total_rules - prev) END AS added,
             CASE WHEN prev IS NOT NULL THEN greatest(0, prev - total_rules) END AS removed
           FROM (SELECT *, lag(total_rules) OVER (PARTITION BY edition ORDER BY run_day) AS prev FROM history)""",
    ),
    "edition_diff": _rules(
        """SELECT * FROM (
             SELECT *, 'added' AS change FROM cur WHERE NOT EXISTS (
               SELECT 1 FROM prev WHERE prev.section = cur.section AND prev.normalized = cur.normalized)
             UNION ALL
             SELECT *, 'removed' AS change FROM prev WHERE NOT EXISTS (
               SELECT 1 FROM cur WHERE prev.section = cur.section AND prev.normalized = cur.normalized))"""
    ).replace(
        "\nSELECT * FROM (\n             SELECT *, 'added'",
        """, prev AS (
          SELECT section, normalized, raw FROM rules WHERE line_no % 10 <> 3
          QUALIFY row_number() OVER (PARTITION BY section, normalized ORDER BY priority, source_ord, chunk, line_no) = 1),
        cur AS (
          SELECT section, normalized, raw FROM rules WHERE line_no % 10 <> 7
          QUALIFY row_number() OVER (PARTITION BY section, normalized ORDER BY priority, source_ord, chunk, line_no) = 1)
        SELECT * FROM (\n             SELECT *, 'added'""",
    ),
    "run_log": _with(
        DAYS,
        select="""SELECT s.run, s.source, coalesce(n.rules, 0) AS rules,
             CASE WHEN status = 'updated' THEN '+' ELSE '=' END AS mark
           FROM statuses s LEFT JOIN (
             SELECT day(ts) AS run, 'user' || user_id AS source, count(*) AS rules FROM events
             WHERE event_type = 'click' GROUP BY ALL) n USING (run, source) ORDER BY s.run, s.source""",
    ),
    "history_retention": _with(
        HISTORY,
        select=f"""SELECT edition, strftime(run_day, '%Y-%m-%d') AS run_ts, total_rules FROM history
           WHERE run_day > DATE '{AT:%Y-%m-%d}' - INTERVAL {KEEP_DAYS} DAY ORDER BY run_day DESC""",
    ),
}
