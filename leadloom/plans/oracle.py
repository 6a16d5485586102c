"""SQL for the check engine: the derived tables and the rules, restated.

Nothing here is used by the library. The text shares only the fixed values with
it, so that the two can be compared.
"""

from __future__ import annotations

from leadloom import schema as S
from leadloom.plans import derived as D

# ASCII white space and the Unicode kinds, in the check engine's syntax
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def pick(values: list[str], index: str) -> str:
    return f"[{', '.join(map(text, values))}][CAST({index} AS BIGINT) + 1]"


def clean(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '{_WS}', ' ', 'g')), '')"


def name_key(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"


def digits(c: str) -> str:
    return f"nullif(regexp_replace({c}, '[^0-9]', '', 'g'), '')"


def status(c: str) -> str:
    cases = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in S.STATUS_NAMES.items())
    return f"CASE lower({clean(c)}) {cases} ELSE {clean(c)} END"


def date(c: str) -> str:
    t = clean(c)
    iso = "'%Y-%m-%dT%H:%M:%S'"
    return (
        f"CASE WHEN contains({t}, 'T') THEN "
        rf"CASE WHEN regexp_full_match({t}, '\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\dZ') "
        f"THEN replace({t}, 'Z', '+00:00') ELSE {t} END "
        f"WHEN contains({t}, '/') THEN coalesce(strftime(try_strptime({t}, '%m/%d/%Y'), {iso}), {t}) "
        f"ELSE coalesce(strftime(try_strptime({t}, '%Y-%m-%d'), {iso}), {t}) END"
    )


def whole(c: str) -> str:
    t = clean(c)
    return (
        rf"CASE WHEN regexp_full_match({t}, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') "
        f"THEN CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS BIGINT) END"
    )


def joined(*parts: str) -> str:
    return "nullif(concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in parts) + "), '')"


def matching_name(first: str, last: str, full: str) -> str:
    return name_key(f"coalesce({clean(full)}, {joined(clean(first), clean(last))})")


def lead_name() -> str:
    return f"coalesce(nullif(name_normalized, ''), lower({joined('trim(first_name)', 'trim(last_name)')}))"


def display_name() -> str:
    return f"coalesce(nullif(full_name, ''), {joined('first_name', 'last_name')})"


def _has_any(c: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {text(w)})" for w in words) + ")"


def _capture(c: str, pattern: str) -> str:
    return f"nullif(trim(regexp_extract({c}, {text(pattern)}, 1, 'i')), '')"


def classified(relation: str, column: str, keep: str = "*") -> str:
    """``relation`` with ``source_channel`` and ``source_detail``."""
    names = ", ".join(_capture("txt", p) for p in S.EVENT_NAME_PATTERNS)
    return f"""
    SELECT * EXCLUDE (txt, low, event_name),
      CASE source_channel
        WHEN 'Event' THEN CASE WHEN contains(low, 'qr')
          THEN CASE WHEN coalesce(event_name, 'Event') = 'Event' THEN 'EventBooth QR Code'
                    ELSE event_name || ' — Booth QR Code' END
          ELSE coalesce(event_name, 'Event') END
        WHEN 'LinkedIn' THEN CASE WHEN contains(low, 'dm') THEN 'LinkedIn DM'
          WHEN contains(low, 'comment') THEN 'LinkedIn post/comment'
          WHEN contains(low, 'connect') THEN 'LinkedIn connection' ELSE 'LinkedIn' END
        WHEN 'Referral' THEN coalesce('Referral — ' || {_capture('txt', S.REFERRAL_PATTERN)}, 'Referral')
        WHEN 'Organic Search' THEN
          coalesce('Organic Search — ' || {_capture('txt', S.ORGANIC_PATTERN)}, 'Organic Search')
        WHEN 'Website' THEN coalesce('Website — ' || {_capture('txt', S.WEBSITE_PATTERN)}, 'Website')
        ELSE source_channel END AS source_detail
    FROM (
      SELECT *,
        CASE WHEN {_has_any('low', S.EVENT_KEYWORDS)} THEN 'Event'
          WHEN contains(low, 'linkedin') OR (contains(low, 'our post') AND contains(low, 'comment')) THEN 'LinkedIn'
          WHEN {_has_any('low', S.REFERRAL_KEYWORDS)} THEN 'Referral'
          WHEN {_has_any('low', S.ORGANIC_KEYWORDS)} THEN 'Organic Search'
          WHEN {_has_any('low', S.MANUAL_KEYWORDS)} THEN 'Manual/Sales'
          WHEN {_has_any('low', S.WEBSITE_KEYWORDS)} THEN 'Website' ELSE 'Other' END AS source_channel,
        regexp_replace(coalesce({names}), '^(our|the) +', '', 'i') AS event_name
      FROM (SELECT *, lower(txt) AS low FROM
        (SELECT {keep}, coalesce({clean(column)}, '') AS txt FROM {relation})))"""


def _person(p: str) -> dict[str, str]:
    first, last = pick(D.FIRST, f"({p} * 7) % 16"), pick(D.LAST, f"({p} * 11 + {p} // 16) % 20")
    company = f"CASE WHEN {p} % 4 = 0 THEN 'Acme' ELSE {pick(D.COMPANY, f'({p} * 5) % 24')} END"
    return {
        "f": first,
        "l": last,
        "c": company,
        "ph": f"CAST(90000000 + ({p} * 7919) % 9999999 AS VARCHAR)",
    }


def _with_person(relation: str) -> str:
    person = ", ".join(f"{v} AS {k}" for k, v in _person("p").items())
    return f"""SELECT *, lower(f || '.' || l) || p || '@' || dom AS mail FROM
      (SELECT *, lower(replace(c, ' ', '')) || '.com' AS dom FROM (SELECT *, {person} FROM ({relation})))"""


LEADS_RAW = f"""leads_raw AS MATERIALIZED (
  SELECT k + 1 AS id, CAST(k + 1000 AS VARCHAR) AS record_id, f AS first_name,
    CASE v WHEN 1 THEN l || right(l, 1) ELSE l END AS last_name,
    CASE v WHEN 0 THEN f || ' ' || l WHEN 1 THEN f || ' ' || l || right(l, 1)
      ELSE '  ' || upper(f) || '  ' || l || ' ' END AS full_name,
    ' ' || lower(c_mktsegment) || '  lead' AS job_title,
    c || CASE v WHEN 0 THEN ' Pte Ltd' WHEN 1 THEN ' Pte. Ltd' ELSE '' END AS company_name,
    CASE v WHEN 0 THEN mail WHEN 1 THEN ' ' || upper(mail) || ' '
      ELSE CASE WHEN p % 2 = 0 THEN lower(f || l) || p || '@gmail.com' END END AS email,
    CASE v WHEN 0 THEN '+65 ' || substr(ph, 1, 4) || ' ' || substr(ph, 5, 4)
      WHEN 1 THEN '(65) ' || substr(ph, 1, 4) || '-' || substr(ph, 5, 4)
      ELSE CASE WHEN p % 5 <> 0 THEN ph END END AS phone_number,
    n_name AS country, {pick(D.STATUS, 'k % 11')} AS lead_status, {pick(D.OWNER, '(k * 3) % 5')} AS contact_owner,
    CASE WHEN k % 4 = 0 THEN strftime(dt, '%Y-%m-%d') WHEN k % 4 = 2 THEN strftime(dt, '%Y-%m-%dT08:00:00Z')
      WHEN k % 20 = 3 THEN 'not a date' ELSE month(dt) || '/' || day(dt) || '/' || year(dt) END AS create_date,
    {pick(D.NOTE, 'k % 24')} AS notes, {pick(D.SCORE, '(k % 7) % 5')} AS lead_score
  FROM ({_with_person(
    "SELECT c_custkey AS k, c_custkey // 3 AS p, c_custkey % 3 AS v, n_name, c_mktsegment, "
    "DATE '2026-01-01' + CAST(c_custkey % 150 AS INTEGER) AS dt "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey"
  )}))"""

_ABSENT = [
    "city",
    "lifecycle_stage",
    "original_source",
    "original_source_drill_down_1",
    "last_modified_date",
    "annual_revenue",
    "marketing_contact_status",
    "gdpr_consent",
]


def normalized(relation: str, extra: str = "") -> str:
    """Seed records of ``relation`` normalised, in the lead columns."""
    plain = ["first_name", "last_name", "full_name", "job_title", "company_name", "phone_number", "country", "contact_owner"]
    cleaned = ", ".join(f"{clean(c)} AS {c}" for c in plain)
    absent = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in _ABSENT)
    return f"""SELECT {extra} CAST(record_id AS BIGINT) AS record_id, {cleaned}, {absent},
      lower({clean('email')}) AS email, lower({clean('email')}) AS email_normalized,
      {digits('phone_number')} AS phone_normalized, {status('lead_status')} AS lead_status,
      {date('create_date')} AS create_date, {clean('notes')} AS notes, {whole('lead_score')} AS lead_score,
      {matching_name('first_name', 'last_name', 'full_name')} AS name_normalized,
      {name_key('company_name')} AS company_normalized, source_channel, source_detail
    FROM ({classified(relation, 'notes')})"""


LEADS = f"""{LEADS_RAW},
leads AS MATERIALIZED (SELECT {', '.join(S.LEAD_COLUMNS)} FROM ({normalized('leads_raw', 'id,')}))"""

SUBMISSIONS_RAW = f"""submissions_raw AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY e) AS seq, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS submitted_at,
    '/' || event_type AS page_url,
    CASE WHEN e % 28 <> 3 THEN f || ' ' || l || CASE WHEN e % 4 = 3 THEN right(l, 1) ELSE '' END END AS name,
    CASE WHEN e % 4 = 0 THEN mail END AS email, CASE WHEN e % 4 = 1 THEN '+65 ' || ph END AS phone,
    CASE WHEN e % 28 <> 3 AND e % 4 >= 2 THEN c || ' Pte Ltd' END AS company,
    'NATION_' || (p % 25) AS country, {pick(D.NOTE, 'e % 24')} AS message
  FROM ({_with_person(
    "SELECT event_id AS e, ts, event_type, user_id + CASE WHEN event_id % 10 = 9 THEN 100000 ELSE 0 END AS p FROM events"
  )}))"""

FOLLOWUPS_RAW = f"""followups_raw AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY o) AS seq, CAST(NULL AS VARCHAR) AS submitted_at,
    CAST(NULL AS VARCHAR) AS page_url, f || ' ' || l AS name,
    lower(f || '.' || l) || p || '@mail.' || dom AS email, '+1 ' || ph AS phone,
    c || CASE WHEN o % 3 = 0 THEN ' Pte. Ltd' ELSE ' Pte Ltd' END AS company,
    'NATION_' || (o % 25) AS country, {pick(D.NOTE, 'o % 24')} AS message
  FROM ({_with_person("SELECT o_orderkey AS o, o_custkey // 3 AS p FROM orders")}))"""


def normalized_submissions(relation: str) -> str:
    first_rest = f"string_split({clean('name')}, ' ')"
    identified = " OR ".join(f"coalesce({c}, '') <> ''" for c in ("name", "email", "phone", "company"))
    return f"""SELECT seq, ({identified}) AS identified, {first_rest}[1] AS first_name,
      nullif(array_to_string({first_rest}[2:], ' '), '') AS last_name, {clean('name')} AS full_name,
      {clean('company')} AS company_name, {clean('email')} AS email, lower({clean('email')}) AS email_normalized,
      {clean('phone')} AS phone_number, {digits('phone')} AS phone_normalized, {clean('country')} AS country,
      {clean('message')} AS notes, {clean('page_url')} AS page_url, {clean('submitted_at')} AS submitted_at,
      {name_key('name')} AS name_normalized, {name_key('company')} AS company_normalized,
      source_channel, source_detail
    FROM ({classified(relation, 'message')})"""


SUBMISSIONS = f"""{SUBMISSIONS_RAW},
submissions AS MATERIALIZED ({normalized_submissions('submissions_raw')})"""
FOLLOWUPS = f"""{FOLLOWUPS_RAW},
followups AS MATERIALIZED ({normalized_submissions('followups_raw')})"""

_DOMAIN = "CASE WHEN contains({0}, '@') THEN nullif(lower(string_split({0}, '@')[-1]), '') END"

KEYS = f"""keys AS MATERIALIZED (
  SELECT id, kind, value FROM (
    SELECT id, unnest([
      {{'kind': 'phone', 'value': nullif(phone_normalized, '')}},
      {{'kind': 'email', 'value': nullif(email_normalized, '')}},
      {{'kind': 'email_domain', 'value': CASE WHEN domain NOT IN ({', '.join(map(text, S.GENERIC_EMAIL_DOMAINS))}) THEN domain END}},
      {{'kind': 'company', 'value': nullif(company_normalized, '')}},
      {{'kind': 'name', 'value': lname}},
      {{'kind': 'name_country', 'value': lname || '|' || lower(trim(nullif(country, '')))}}], recursive := true)
    FROM (SELECT *, {lead_name()} AS lname, {_DOMAIN.format('email_normalized')} AS domain FROM leads))
  WHERE value IS NOT NULL),
sizes AS MATERIALIZED (SELECT kind, value, count(*) AS n FROM keys GROUP BY ALL)"""

PAIRS = f"""{KEYS},
pairs AS MATERIALIZED (
  SELECT DISTINCT a.id AS id_a, b.id AS id_b
  FROM (SELECT * FROM keys SEMI JOIN (SELECT * FROM sizes WHERE n BETWEEN 2 AND {S.MAX_BLOCK_SIZE}) USING (kind, value)) a
  JOIN keys b ON a.kind = b.kind AND a.value = b.value AND a.id < b.id)"""


# Of leads alike in all that is compared one represents the others. Two representatives of an
# oversized block are compared if at most as many of it as a block may have share all that the two share.
REFINED = f"""{PAIRS},
known AS MATERIALIZED (
  SELECT id, min(id) OVER (PARTITION BY {', '.join(f"coalesce({c}, '')" for c in ('phone_normalized', 'email_normalized', 'company_normalized', 'country', lead_name()))})
    AS representative FROM leads),
marks AS MATERIALIZED (
  SELECT kind, value, id, list_sort(list_distinct(list_filter(list_concat(
      ['p ' || CASE WHEN len(phone_normalized) >= 8 THEN right(phone_normalized, 8) ELSE phone_normalized END,
       'e ' || string_split(nullif(email_normalized, ''), '@')[1]],
      list_transform(string_split(coalesce({lead_name()}, ''), ' '), lambda w: 'n ' || w),
      list_transform(string_split(coalesce(company_normalized, ''), ' '), lambda w: 'c ' || w)), lambda m: len(m) > 2))) AS own
  FROM (SELECT * FROM keys SEMI JOIN (SELECT * FROM sizes WHERE n > {S.MAX_BLOCK_SIZE}) USING (kind, value))
  JOIN leads USING (id) WHERE id IN (SELECT representative FROM known)),
shared AS MATERIALIZED (
  SELECT a.kind, a.value, a.id AS id_a, b.id AS id_b, list_sort(list_intersect(a.own, b.own)) AS marks
  FROM marks a JOIN marks b ON a.kind = b.kind AND a.value = b.value AND a.id < b.id),
parts AS (
  SELECT s.kind, s.value, s.marks FROM (SELECT DISTINCT kind, value, marks FROM shared) s
  JOIN marks m ON m.kind = s.kind AND m.value = s.value AND list_has_all(m.own, s.marks)
  GROUP BY ALL HAVING count(*) <= {S.MAX_BLOCK_SIZE}),
refined AS (
  SELECT id_a, id_b FROM pairs UNION SELECT id_a, id_b FROM shared SEMI JOIN parts USING (kind, value, marks)
  UNION SELECT representative, id FROM known WHERE id <> representative)"""

UNCOMPARED = f"SELECT kind, value, own AS marks, count(*) AS n FROM marks GROUP BY ALL HAVING count(*) > {S.MAX_BLOCK_SIZE}"


def _lcs(a: str, b: str) -> str:
    chars_a, chars_b = f"string_split({a}, '')", f"string_split({b}, '')"
    return f"""list_reduce(
      list_transform({chars_a}, lambda x: list_transform({chars_b}, lambda y: CASE WHEN x = y THEN 1 ELSE 0 END)),
      lambda above, hits: list_reduce(
        list_transform(range(1, len({b}) + 1), lambda j: [hits[j], above[j + 1], above[j]]),
        lambda line, cell: list_append(line,
          CASE WHEN cell[1] = 1 THEN cell[3] + 1 ELSE greatest(cell[2], line[-1]) END), [0]),
      list_transform(range(0, len({b}) + 1), lambda j: 0))[-1]"""


def _tokens(c: str) -> str:
    return f"list_sort(list_distinct(string_split({c}, ' ')))"


def _less(a: str, b: str) -> str:
    return f"array_to_string(list_filter({a}, lambda t: NOT list_contains({b}, t)), ' ')"


def _token_ratio(what: str, lcs: str) -> str:
    s, a, b = f"{what}_s", f"len({what}_x)", f"len({what}_y)"
    d = f"({a} + {b} - 2 * {lcs})"
    return f"""CASE WHEN {what}_a IS NULL OR {what}_b IS NULL THEN 0::DOUBLE
      WHEN {s} > 0 AND ({a} = 0 OR {b} = 0) THEN 1::DOUBLE
      WHEN {s} = 0 THEN (100::DOUBLE - (100 * {d})::DOUBLE / ({a} + {b})::DOUBLE) / 100::DOUBLE
      ELSE greatest(100::DOUBLE - (100 * {d})::DOUBLE / (2 * {s} + 2 + {a} + {b})::DOUBLE,
        100::DOUBLE - (100 * (1 + {a}))::DOUBLE / (2 * {s} + 1 + {a})::DOUBLE,
        100::DOUBLE - (100 * (1 + {b}))::DOUBLE / (2 * {s} + 1 + {b})::DOUBLE) / 100::DOUBLE END"""


def _ratio(a: str, b: str, lcs: str) -> str:
    n = f"(len({a}) + len({b}))"
    return f"CASE WHEN {n} = 0 THEN 1::DOUBLE ELSE (1::DOUBLE - ({n} - 2 * {lcs})::DOUBLE / {n}::DOUBLE) * 100::DOUBLE / 100::DOUBLE END"


def scored(pairs: str, left: str, right: str) -> str:
    """CTEs that end in ``scored``: all signals of ``pairs (id_a, id_b)``."""
    common = "len(array_to_string(list_filter({0}_ta, lambda t: list_contains({0}_tb, t)), ' '))"
    texts = {"name": ("name_x", "name_y"), "company": ("company_x", "company_y"), "local": ("local_a", "local_b"), "domain": ("domain_a", "domain_b")}
    side = "{0}.name AS name_{1}, {0}.company AS company_{1}, {0}.email AS email_{1}, {0}.phone AS phone_{1}, {0}.country AS country_{1}"
    lcs_join = " ".join(f"LEFT JOIN lcs l_{k} ON l_{k}.x = p.{a} AND l_{k}.y = p.{b}" for k, (a, b) in texts.items())
    total = " + ".join(f"{k}_score * {w}::DOUBLE" for k, w in S.SIGNAL_WEIGHTS.items())
    return f"""
sided AS MATERIALIZED (
  SELECT id_a, id_b, {side.format('a', 'a')}, {side.format('b', 'b')}
  FROM {pairs} JOIN {left} a ON a.id = id_a JOIN {right} b ON b.id = id_b),
parts AS MATERIALIZED (
  SELECT *, {common.format('name')} AS name_s, {_less('name_ta', 'name_tb')} AS name_x, {_less('name_tb', 'name_ta')} AS name_y,
    {common.format('company')} AS company_s, {_less('company_ta', 'company_tb')} AS company_x,
    {_less('company_tb', 'company_ta')} AS company_y,
    array_to_string(string_split(email_a, '@')[:-2], '@') AS local_a, string_split(email_a, '@')[-1] AS domain_a,
    array_to_string(string_split(email_b, '@')[:-2], '@') AS local_b, string_split(email_b, '@')[-1] AS domain_b
  FROM (SELECT *, {_tokens('name_a')} AS name_ta, {_tokens('name_b')} AS name_tb,
    {_tokens('company_a')} AS company_ta, {_tokens('company_b')} AS company_tb FROM sided)),
lcs AS MATERIALIZED (
  SELECT x, y, CASE WHEN x = '' OR y = '' THEN 0 WHEN x = y THEN len(x) ELSE {_lcs('x', 'y')} END AS n
  FROM ({' UNION '.join(f'SELECT {a} AS x, {b} AS y FROM parts WHERE {a} IS NOT NULL AND {b} IS NOT NULL' for a, b in texts.values())})),
signals AS MATERIALIZED (
  SELECT id_a, id_b, {_token_ratio('name', 'l_name.n')} AS name_score, {_token_ratio('company', 'l_company.n')} AS company_score,
    CASE WHEN email_a IS NULL OR email_b IS NULL THEN 0::DOUBLE WHEN email_a = email_b THEN 1::DOUBLE
      WHEN NOT contains(email_a, '@') OR NOT contains(email_b, '@') THEN 0::DOUBLE
      ELSE ({_ratio('local_a', 'local_b', 'l_local.n')}) * {S.EMAIL_LOCAL_WEIGHT}::DOUBLE
        + ({_ratio('domain_a', 'domain_b', 'l_domain.n')}) * {S.EMAIL_DOMAIN_WEIGHT}::DOUBLE END AS email_score,
    CASE WHEN phone_a IS NULL OR phone_b IS NULL THEN 0::DOUBLE WHEN phone_a = phone_b THEN 1::DOUBLE
      WHEN len(phone_a) >= 8 AND len(phone_b) >= 8 AND right(phone_a, 8) = right(phone_b, 8) THEN 0.9::DOUBLE
      ELSE 0::DOUBLE END AS phone_score,
    CASE WHEN lower(trim(country_a)) = lower(trim(country_b)) THEN 1::DOUBLE ELSE 0::DOUBLE END AS country_score,
    coalesce(email_a = email_b, false) AS same_email, coalesce(phone_a = phone_b, false) AS same_phone
  FROM parts p {lcs_join}),
scored AS MATERIALIZED (
  SELECT *, least(greatest({total}, CASE
      WHEN same_email AND (name_score >= 0.5 OR company_score >= 0.5) THEN {S.SAME_EMAIL_FLOOR}::DOUBLE
      WHEN same_phone AND (name_score >= 0.5 OR company_score >= 0.5) THEN {S.SAME_PHONE_FLOOR}::DOUBLE
      ELSE 0::DOUBLE END), 1::DOUBLE) AS score FROM signals)"""


FIELDS = f"""fields AS MATERIALIZED (
  SELECT id, {lead_name()} AS name, nullif(company_normalized, '') AS company, nullif(email_normalized, '') AS email,
    nullif(phone_normalized, '') AS phone, nullif(country, '') AS country FROM leads)"""

DEDUPE = f"{LEADS},\n{PAIRS},\n{FIELDS},\n{scored('pairs', 'fields', 'fields')}"

REASON = """coalesce(nullif(concat_ws('; ',
    CASE WHEN same_email THEN 'exact normalized email match' END,
    CASE WHEN same_phone THEN 'exact normalized phone match' END,
    CASE WHEN name_score >= 0.9 THEN 'very similar names' WHEN name_score >= 0.75 THEN 'similar names' END,
    CASE WHEN company_score >= 0.9 THEN 'very similar company names'
      WHEN company_score >= 0.75 THEN 'similar company names' END,
    CASE WHEN email_score >= 0.8 THEN 'similar email addresses' END,
    CASE WHEN phone_score >= 0.8 THEN 'similar phone numbers' END,
    CASE WHEN country_score = 1 THEN 'same country' END), ''), 'multiple identity fields are similar')"""


def rounded(c: str) -> str:
    return f"floor({c} * 10000 + 0.5::DOUBLE) / 10000::DOUBLE"


def exact(rows: str) -> str:
    """CTE ``exact (seq, kind, id)``: smallest id with the e-mail, else with the phone."""
    return f"""exact AS MATERIALIZED (
  SELECT seq, CASE WHEN e.id IS NOT NULL THEN 1 ELSE 2 END AS kind, coalesce(e.id, p.id) AS id FROM {rows} s
  LEFT JOIN (SELECT email_normalized AS v, min(id) AS id FROM leads GROUP BY ALL) e ON e.v = s.email_normalized
  LEFT JOIN (SELECT phone_normalized AS v, min(id) AS id FROM leads GROUP BY ALL) p ON p.v = s.phone_normalized
  WHERE s.identified AND coalesce(e.id, p.id) IS NOT NULL)"""


# Best lead of every follow-up. None has an exact match, so a score of 0.90 needs
# phones with the same last eight digits; rows that are alike are scored once.
FOLLOWUP_MATCH = f"""probe AS MATERIALIZED (
  SELECT min(seq) AS id, name_normalized AS name, company_normalized AS company, email_normalized AS email,
    phone_normalized AS phone, country FROM followups GROUP BY ALL),
{FIELDS},
near AS MATERIALIZED (
  SELECT s.id AS id_a, l.id AS id_b FROM probe s JOIN leads l ON right(l.phone_normalized, 8) = right(s.phone, 8)
  WHERE l.company_normalized = s.company OR l.name_normalized = s.name),
{scored('near', 'probe', 'fields')},
best AS (SELECT id_a, min(id_b) AS id_b, score FROM scored JOIN
  (SELECT id_a, max(score) AS score FROM scored WHERE score >= {S.MERGE_CONFIDENCE} GROUP BY ALL) USING (id_a, score)
  GROUP BY ALL),
fuzzy AS MATERIALIZED (
  SELECT f.seq, b.id_b AS id, b.score FROM followups f JOIN probe p
    ON (f.name_normalized, f.company_normalized, f.email_normalized, f.phone_normalized, f.country)
     = (p.name, p.company, p.email, p.phone, p.country)
  JOIN best b ON b.id_a = p.id)"""

_TAIL = "CASE WHEN len({0}) >= 8 THEN right({0}, 8) ELSE {0} END"
_LEAD_STATE = "STRUCT(t BIGINT, f VARCHAR, l VARCHAR, e VARCHAR, p VARCHAR, c VARCHAR, n VARCHAR, k VARCHAR)[]"


def targets(rows: str) -> str:
    """CTEs that end in ``targets (seq, target)``: the rows one after the other, as they arrive.

    Rows and leads that contact values link in any way are a cell; cells cannot
    influence each other. Each step of the recursion takes the next row of every
    cell: its exact match, else the best lead of the cell in its present state,
    else itself as a new lead, and changes that lead. How similar texts of a cell
    are is looked up. A lead without a name in matching form is compared by its
    first and last name, which the cell's rows have brought.
    """
    name, company, email = (f"coalesce({c}_sims[x.{k}], 0::DOUBLE)" for c, k in (("name", "NAME"), ("company", "k"), ("email", "e")))
    name = name.replace("x.NAME", "coalesce(x.n, lower(x.f || ' ' || x.l))")
    phone = """CASE WHEN x.p = phone THEN 1::DOUBLE WHEN len(x.p) >= 8 AND len(phone) >= 8 AND right(x.p, 8) = right(phone, 8)
      THEN 0.9::DOUBLE ELSE 0::DOUBLE END"""
    signals = {"name": name, "company": company, "email": email, "phone": phone}
    signals["country"] = "CASE WHEN lower(trim(x.c)) = lower(trim(country)) THEN 1::DOUBLE ELSE 0::DOUBLE END"
    total = " + ".join(f"{signals[k]} * {w}::DOUBLE" for k, w in S.SIGNAL_WEIGHTS.items())
    score = f"""least(greatest({total}, CASE WHEN {name} < 0.5 AND {company} < 0.5 THEN 0::DOUBLE
      WHEN x.e = email THEN {S.SAME_EMAIL_FLOOR}::DOUBLE WHEN x.p = phone THEN {S.SAME_PHONE_FLOOR}::DOUBLE ELSE 0::DOUBLE END), 1::DOUBLE)"""
    best = f"""list_sort(list_filter(list_transform(
        list_filter(leads, lambda x: coalesce(x.n = name, false) OR coalesce(x.k = company, false)),
        lambda x: {{'less': -{score}, 'new': x.t < 0, 'place': abs(x.t), 't': x.t}}), lambda y: y.less <= -{S.MERGE_CONFIDENCE}::DOUBLE))[1].t"""
    keep = {"f": "first_name", "l": "last_name", "e": "email", "p": "phone", "c": "country"}
    changed = ", ".join(f"'{k}': coalesce({v}, x.{k})" for k, v in keep.items())
    fresh = ", ".join(f"'{k}': {v}" for k, v in keep.items())
    return f"""{exact(rows)},
contacts AS MATERIALIZED (
  SELECT seq AS node, 'e' || nullif(email_normalized, '') AS key FROM {rows} WHERE identified AND email_normalized <> ''
  UNION ALL SELECT seq, 'p' || {_TAIL.format('phone_normalized')} FROM {rows} WHERE identified AND phone_normalized <> ''
  UNION ALL SELECT -id, 'e' || email_normalized FROM leads WHERE email_normalized <> ''
  UNION ALL SELECT -id, 'p' || {_TAIL.format('phone_normalized')} FROM leads WHERE phone_normalized <> ''),
key_links AS MATERIALIZED (SELECT DISTINCT a.key AS k1, b.key AS k2 FROM contacts a JOIN contacts b USING (node)),
reach AS (SELECT DISTINCT key AS k1, key AS k2 FROM contacts UNION SELECT r.k1, l.k2 FROM reach r JOIN key_links l ON l.k1 = r.k2),
cells AS MATERIALIZED (
  SELECT node, min(low) AS cell FROM contacts JOIN (SELECT k1 AS key, min(k2) AS low FROM reach GROUP BY ALL) USING (key) GROUP BY node),
active AS MATERIALIZED (
  SELECT DISTINCT cell FROM cells JOIN {rows} ON seq = node WHERE seq NOT IN (SELECT seq FROM exact)),
acting AS MATERIALIZED (
  SELECT cell, row_number() OVER (PARTITION BY cell ORDER BY s.seq) AS idx, s.seq, x.id AS fixed, nullif(first_name, '') AS first_name,
    nullif(last_name, '') AS last_name, nullif(name_normalized, '') AS name, nullif(company_normalized, '') AS company,
    nullif(email_normalized, '') AS email, nullif(phone_normalized, '') AS phone, nullif(country, '') AS country
  FROM {rows} s JOIN cells ON node = s.seq SEMI JOIN active USING (cell) LEFT JOIN exact x ON x.seq = s.seq),
standing AS MATERIALIZED (
  SELECT cell, id, first_name, last_name, nullif(email_normalized, '') AS email, nullif(phone_normalized, '') AS phone,
    nullif(country, '') AS country, nullif(name_normalized, '') AS name, nullif(company_normalized, '') AS company
  FROM leads JOIN cells ON node = -id SEMI JOIN active USING (cell)),
persons AS (SELECT cell, name, company, email FROM acting UNION ALL SELECT cell, name, company, email FROM standing),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS id, *, NULL::VARCHAR AS phone, NULL::VARCHAR AS country FROM (
    SELECT cell, 'name' AS what, name, NULL::VARCHAR AS company, NULL::VARCHAR AS email FROM persons WHERE name IS NOT NULL
    UNION SELECT cell, 'company', NULL, company, NULL FROM persons WHERE company IS NOT NULL
    UNION SELECT cell, 'email', NULL, NULL, email FROM persons WHERE email IS NOT NULL)),
text_pairs AS MATERIALIZED (SELECT a.id AS id_a, b.id AS id_b FROM texts a JOIN texts b USING (cell, what)),
{scored('text_pairs', 'texts', 'texts').strip()},
sims AS MATERIALIZED (
  SELECT a.cell, a.what, coalesce(a.name, a.company, a.email) AS own, map_from_entries(list({{'a': coalesce(b.name, b.company, b.email),
    'b': CASE a.what WHEN 'name' THEN name_score WHEN 'company' THEN company_score ELSE email_score END}})) AS found
  FROM scored JOIN texts a ON a.id = id_a JOIN texts b ON b.id = id_b GROUP BY ALL),
steps AS MATERIALIZED (
  SELECT a.*, {', '.join(f'{c}_s.found AS {c}_sims' for c in ('name', 'company', 'email'))} FROM acting a
  {' '.join(f"LEFT JOIN sims {c}_s ON {c}_s.cell = a.cell AND {c}_s.what = '{c}' AND {c}_s.own = a.{c}" for c in ('name', 'company', 'email'))}),
play AS (
  SELECT cell, 0::BIGINT AS idx, NULL::BIGINT AS seq, NULL::BIGINT AS target, coalesce(list({{'t': id, 'f': first_name, 'l': last_name,
    'e': email, 'p': phone, 'c': country, 'n': name, 'k': company}} ORDER BY id) FILTER (id IS NOT NULL), [])::{_LEAD_STATE} AS leads
  FROM active LEFT JOIN standing USING (cell) GROUP BY cell
  UNION ALL
  SELECT cell, idx, seq, target, (CASE WHEN target = -seq
      THEN list_append(leads, {{'t': target, {fresh}, 'n': name, 'k': company}})
      ELSE list_transform(leads, lambda x: CASE WHEN x.t = target
        THEN {{'t': x.t, {changed}, 'n': x.n, 'k': x.k}} ELSE x END) END)::{_LEAD_STATE}
  FROM (SELECT s.*, p.leads, coalesce(s.fixed, {best}, -s.seq) AS target
    FROM (SELECT cell AS held, idx AS done, leads FROM play) p JOIN steps s ON s.cell = p.held AND s.idx = p.done + 1)),
targets AS MATERIALIZED (
  SELECT s.seq, coalesce(x.id, p.target, -s.seq) AS target FROM {rows} s LEFT JOIN exact x ON x.seq = s.seq
  LEFT JOIN (SELECT seq, target FROM play WHERE seq IS NOT NULL) p ON p.seq = s.seq WHERE s.identified)"""


# Four persons share their addresses, numbers and companies in all combinations, so rows contradict each other.
CONTESTED_RAW = f"""contested_raw AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY o.e) AS seq, strftime(o.ts, '%Y-%m-%dT%H:%M:%SZ') AS submitted_at, '/' || o.event_type AS page_url,
    CASE WHEN o.e % 5 < 3 THEN o.f || ' ' || o.l WHEN o.e % 5 = 3 THEN o.f || ' ' || o.l || right(o.l, 1) END AS name,
    CASE (o.e // 3) % 4 WHEN 0 THEN o.mail WHEN 1 THEN replace(o.mail, '@', '@mail.') WHEN 2 THEN n.mail END AS email,
    CASE (o.e // 7) % 5 WHEN 0 THEN '+65 ' || o.ph WHEN 1 THEN '+1 ' || o.ph WHEN 2 THEN '+44 ' || n.ph WHEN 3 THEN o.ph END AS phone,
    CASE (o.e // 2) % 4 WHEN 0 THEN o.c || ' Pte Ltd' WHEN 1 THEN o.c WHEN 2 THEN n.c END AS company,
    'NATION_' || (o.p % 25) AS country, {pick(D.NOTE, 'o.e % 24')} AS message
  FROM ({_with_person("SELECT event_id AS e, ts, event_type, user_id AS p FROM events")}) o
  JOIN ({_with_person("SELECT event_id AS e, user_id - user_id % 4 + (user_id + 1) % 4 AS p FROM events")}) n ON n.e = o.e)"""
CONTESTED = f"""{CONTESTED_RAW},
contested AS MATERIALIZED ({normalized_submissions('contested_raw')})"""

# every third lead is there twice
ALIKE_LEADS = LEADS.replace("\nleads AS MATERIALIZED (", "\nsingle_leads AS MATERIALIZED (") + f""",
leads AS MATERIALIZED (SELECT * FROM single_leads UNION ALL
  SELECT * REPLACE (id + {D.COPY_OFFSET} AS id, record_id + {D.COPY_OFFSET} AS record_id) FROM single_leads WHERE id % 3 = 1)"""

SUBMISSION_TARGETS = targets("submissions")
FOLLOWUP_TARGETS = targets("followups")

_LATEST = (
    "first_name last_name full_name company_name email email_normalized phone_number phone_normalized country notes"
).split()


def merged(rows: str) -> str:
    """CTE ``merged``: leads after ``targets (seq, target)`` of ``rows``."""
    latest = ", ".join(f"arg_max({c}, seq) FILTER ({c} IS NOT NULL) AS {c}" for c in _LATEST)
    source = ["source_channel", "source_detail"]
    stored = {c: f"coalesce(f.{c}, l.{c})" for c in [*_LATEST, *source]}
    stored["original_source"] = "CASE WHEN f.target IS NULL THEN l.original_source ELSE 'Website Form' END"
    new = {c: f"f.{c}" for c in [*_LATEST, *source]}
    new |= {
        "id": "(SELECT max(id) FROM leads) + row_number() OVER (ORDER BY s.seq)",
        "record_id": "(SELECT max(record_id) FROM leads) + row_number() OVER (ORDER BY s.seq)",
        "lead_status": "'New'",
        "original_source": "'Website Form'",
        "original_source_drill_down_1": "s.page_url",
        "create_date": "s.submitted_at",
        "last_modified_date": "s.submitted_at",
        "name_normalized": "s.name_normalized",
        "company_normalized": "s.company_normalized",
    }
    return f"""folds AS MATERIALIZED (
  SELECT target, {latest}, {', '.join(f'arg_max({c}, seq) AS {c}' for c in source)}
  FROM {rows} JOIN targets USING (seq) GROUP BY target),
merged AS MATERIALIZED (
  SELECT {', '.join(f'{stored.get(c, "l." + c)} AS {c}' for c in S.LEAD_COLUMNS)}
  FROM leads l LEFT JOIN folds f ON f.target = l.id
  UNION ALL SELECT {', '.join(f'{new.get(c, "NULL")} AS {c}' for c in S.LEAD_COLUMNS)}
  FROM folds f JOIN {rows} s ON s.seq = -f.target)"""
