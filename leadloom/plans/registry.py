"""Every query by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import schema as S
from leadloom.functions import dates, identity, text
from leadloom.functions.source import classify_source
from leadloom.operators import blocking, dashboard, dedupe, merge, query, upsert
from leadloom.operators.normalize import normalize_seed, normalize_submissions
from leadloom.plans import derived as D
from leadloom.plans import oracle as O
from leadloom.sources import files
from leadloom.sources.scratch import new_folder, written
from leadloom.sources.store import LeadStore
from leadloom.streaming.jobs import live_counts, merge_into, store_counts, stream_merge

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def stored_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lead table as jobs meet it: written, not recomputed at every use."""
    return written(D.leads(spark, sf_dir), "leads")


_ALL = ", ".join(S.LEAD_COLUMNS)
_EXPORT = ", ".join(S.EXPORT_FIELDS)


# -- normalisation ----------------------------------------------------------


@register("normalize_leads", f"WITH {O.LEADS} SELECT {_ALL} FROM leads")
def _(spark, sf):
    return D.leads(spark, sf)


@register("normalize_submissions", f"WITH {O.SUBMISSIONS} SELECT * FROM submissions")
def _(spark, sf):
    return D.submissions(spark, sf)


@register(
    "clean_text",
    f"WITH {O.LEADS_RAW} SELECT id, {', '.join(f'{O.clean(c)} AS {c}' for c in ('full_name', 'email', 'job_title', 'notes'))} FROM leads_raw",
)
def _(spark, sf):
    cleaned = [text.clean_text(F.col(c)).alias(c) for c in ("full_name", "email", "job_title", "notes")]
    return D.leads_raw(spark, sf).select("id", *cleaned)


@register(
    "status_map",
    f"WITH {O.LEADS_RAW} SELECT lead_status AS raw, {O.status('lead_status')} AS status, count(*) AS n FROM leads_raw GROUP BY ALL",
)
def _(spark, sf):
    status = text.normalize_status(F.col("lead_status")).alias("status")
    return D.leads_raw(spark, sf).groupBy(F.col("lead_status").alias("raw"), status).agg(F.count("*").alias("n"))


@register("date_normalize", f"WITH {O.LEADS_RAW} SELECT id, {O.date('create_date')} AS create_date FROM leads_raw")
def _(spark, sf):
    return D.leads_raw(spark, sf).select("id", dates.normalize_date(F.col("create_date")).alias("create_date"))


@register(
    "date_order_and_event_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 <> 0 "
    "THEN strftime(ts, '.%f') ELSE '' END || '+00:00' AS iso FROM events",
)
def _(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return D.table(spark, sf, "events").select("event_id", dates.normalize_date(stamp).alias("iso"))


@register(
    "split_names",
    f"WITH {O.LEADS_RAW} SELECT id, string_split({O.clean('full_name')}, ' ')[1] AS first, "
    f"nullif(array_to_string(string_split({O.clean('full_name')}, ' ')[2:], ' '), '') AS rest FROM leads_raw",
)
def _(spark, sf):
    return D.leads_raw(spark, sf).select("id", text.split_name(F.col("full_name")).alias("s")).select("id", "s.*")


@register("lead_scores_int", f"WITH {O.LEADS_RAW} SELECT id, {O.whole('lead_score')} AS lead_score FROM leads_raw")
def _(spark, sf):
    return D.leads_raw(spark, sf).select("id", text.parse_int(F.col("lead_score")).alias("lead_score"))


@register("phone_digits", f"WITH {O.LEADS_RAW} SELECT id, {O.digits('phone_number')} AS phone FROM leads_raw")
def _(spark, sf):
    return D.leads_raw(spark, sf).select("id", text.normalize_phone(F.col("phone_number")).alias("phone"))


@register(
    "email_parts",
    f"WITH {O.LEADS} SELECT id, {O._DOMAIN.format('email_normalized')} AS domain, "
    "array_to_string(string_split(email_normalized, '@')[:-2], '@') AS local FROM leads",
)
def _(spark, sf):
    email = F.col("email_normalized")
    local = F.regexp_extract(email, "(?s)^(.*)@[^@]*$", 1)
    return D.leads(spark, sf).select("id", text.email_domain(email).alias("domain"), local.alias("local"))


@register(
    "matching_names",
    f"WITH {O.LEADS_RAW} SELECT id, {O.matching_name('first_name', 'last_name', 'full_name')} AS from_full, "
    f"{O.matching_name('first_name', 'last_name', 'NULL')} AS from_parts FROM leads_raw",
)
def _(spark, sf):
    first, last = F.col("first_name"), F.col("last_name")
    return D.leads_raw(spark, sf).select(
        "id",
        identity.matching_name(first, last, F.col("full_name")).alias("from_full"),
        identity.matching_name(first, last, F.lit(None).cast("string")).alias("from_parts"),
    )


@register(
    "lead_names",
    f"WITH {O.LEADS} SELECT id, {O.lead_name()} AS name FROM "
    "(SELECT * REPLACE (CASE WHEN id % 2 = 0 THEN name_normalized END AS name_normalized) FROM leads)",
)
def _(spark, sf):
    half = F.when(F.col("id") % 2 == 0, F.col("name_normalized"))
    return D.leads(spark, sf).withColumn("name_normalized", half).select("id", identity.lead_name().alias("name"))


@register("lead_summary", f"WITH {O.LEADS} SELECT id, record_id, {O.display_name()} AS name, email, phone_number, company_name, country FROM leads")
def _(spark, sf):
    return identity.lead_summary(D.leads(spark, sf))


# -- classification ---------------------------------------------------------


@register(
    "classify_source",
    f"WITH {O.LEADS_RAW} SELECT id, notes, source_channel, source_detail FROM ({O.classified('leads_raw', 'notes', 'id, notes')})",
)
def _(spark, sf):
    return classify_source(D.leads_raw(spark, sf).select("id", "notes"))


_TALK = f"SELECT conv_id, turn, text || ' ' || {O.pick(D.NOTE, '(conv_id + turn) % 24')} AS note FROM conversations"
_PAPER = f"SELECT doc_id, text || ' ' || {O.pick(D.NOTE, 'doc_id % 24')} AS note FROM documents"


@register(
    "classify_conversations",
    f"SELECT conv_id, turn, source_channel, source_detail FROM ({O.classified(f'({_TALK})', 'note')})",
)
def _(spark, sf):
    talk = D.table(spark, sf, "conversations")
    note = F.concat("text", F.lit(" "), D._pick(D.NOTE, (F.col("conv_id") + F.col("turn")) % len(D.NOTE)))
    return classify_source(talk.select("conv_id", "turn", note.alias("note")), "note").drop("note")


@register(
    "channel_of_documents",
    f"SELECT source_channel, count(*) AS n, count(DISTINCT source_detail) AS details FROM ({O.classified(f'({_PAPER})', 'note')}) GROUP BY ALL",
)
def _(spark, sf):
    papers = D.table(spark, sf, "documents")
    note = F.concat("text", F.lit(" "), D._pick(D.NOTE, F.col("doc_id") % len(D.NOTE)))
    found = classify_source(papers.select(note.alias("note")), "note")
    return found.groupBy("source_channel").agg(
        F.count("*").alias("n"), F.countDistinct("source_detail").alias("details")
    )


@register(
    "channel_detail",
    f"WITH {O.LEADS} SELECT source_channel, source_detail, count(*) AS n FROM leads GROUP BY ALL",
)
def _(spark, sf):
    return D.leads(spark, sf).groupBy("source_channel", "source_detail").agg(F.count("*").alias("n"))


@register(
    "channel_check",
    f"WITH {O.LEADS} SELECT source_channel, count(*) AS n, source_channel IN ({', '.join(map(O.text, S.CHANNELS))}) AS allowed FROM leads GROUP BY ALL",
)
def _(spark, sf):
    return dashboard.channel_check(D.leads(spark, sf))


# -- listings ---------------------------------------------------------------


def _listing(name: str, where: str, **params) -> None:
    limit, offset = params.get("limit", 50), params.get("offset", 0)

    @register(name, f"WITH {O.LEADS} SELECT {_ALL} FROM leads WHERE {where} ORDER BY id LIMIT {limit} OFFSET {offset}")
    def _(spark, sf):
        return query.list_leads(stored_leads(spark, sf), **params)


_like = "{0} ILIKE '%{1}%'"
_search = " OR ".join(_like.format(c, "jane") for c in S.SEARCH_FIELDS)
_listing("list_by_status", "lead_status = 'Closed Won'", status=" close  WON ", limit=200)
_listing("list_blank_status", "lead_status IS NULL", status=" ")
_listing("list_by_owner", _like.format("contact_owner", "n o_h"), owner=" n O_h ")
_listing("list_by_country", _like.format("country", "ation_1"), country="ATION_1", limit=120, offset=7)
_listing("list_search", f"({_search})", q="JANE")
_listing(
    "list_combined",
    f"lead_status = 'New' AND {_like.format('contact_owner', 'a')} AND ({' OR '.join(_like.format(c, 'acme') for c in S.SEARCH_FIELDS)})",
    status="new",
    owner="a",
    q="acme",
)
_listing("list_page", "true", limit=50, offset=100)


@register("list_deep_page", f"WITH {O.LEADS} SELECT {_ALL} FROM leads ORDER BY id LIMIT 60 OFFSET 115")
def _(spark, sf):
    return query.page_by_count(stored_leads(spark, sf), limit=60, offset=115)


@register("lead_lookup", f"WITH {O.LEADS} SELECT {_ALL} FROM leads WHERE id IN (1, 77, 130, 999999999)")
def _(spark, sf):
    return query.get_leads(stored_leads(spark, sf), [1, 77, 130, 999999999])


@register(
    "lead_lookup_join",
    f"WITH {O.LEADS} SELECT {_ALL} FROM leads WHERE id IN (SELECT o_custkey + 1 FROM orders WHERE o_totalprice > 200000)",
)
def _(spark, sf):
    wanted = D.table(spark, sf, "orders").where(F.col("o_totalprice") > 200000)
    return query.get_leads(stored_leads(spark, sf), wanted.select((F.col("o_custkey") + 1).alias("id")))


@register(
    "export_rows",
    f"WITH {O.LEADS} SELECT {_EXPORT} FROM leads WHERE {_like.format('country', '2')} ORDER BY id",
)
def _(spark, sf):
    return query.export_rows(stored_leads(spark, sf), country="2")


# -- dashboard --------------------------------------------------------------

_UNKNOWN = "coalesce(nullif({0}, ''), 'Unknown')"
_COUNTS = f"""
  SELECT 'status' AS dimension, {_UNKNOWN.format('lead_status')} AS key, count(*) AS n FROM leads GROUP BY ALL
  UNION ALL SELECT 'source_channel', {_UNKNOWN.format('source_channel')}, count(*) FROM leads GROUP BY ALL
  UNION ALL SELECT 'total', 'leads', count(*) FROM leads"""


@register("dashboard", f"WITH {O.LEADS} {_COUNTS}")
def _(spark, sf):
    return dashboard.dashboard(D.leads(spark, sf))


_JSON = """'{{' || string_agg('"' || key || '":' || n, ',' ORDER BY key) FILTER (dimension = '{0}') || '}}'"""


@register(
    "dashboard_json",
    f"WITH {O.LEADS}, counts AS ({_COUNTS}) SELECT max(n) FILTER (dimension = 'total') AS total_leads, "
    f"{_JSON.format('status')} AS by_status, {_JSON.format('source_channel')} AS by_source_channel FROM counts",
)
def _(spark, sf):
    return dashboard.dashboard_json(D.leads(spark, sf))


# -- duplicates -------------------------------------------------------------


@register("block_keys", f"WITH {O.LEADS}, {O.KEYS} SELECT id, kind, value FROM keys")
def _(spark, sf):
    return identity.block_keys(D.leads(spark, sf))


@register("block_sizes", f"WITH {O.LEADS}, {O.KEYS} SELECT kind, value, n FROM sizes")
def _(spark, sf):
    return blocking.block_sizes(D.leads(spark, sf))


@register("candidate_pairs", f"WITH {O.LEADS}, {O.PAIRS} SELECT id_a, id_b FROM pairs")
def _(spark, sf):
    return blocking.candidate_pairs(stored_leads(spark, sf))


@register(
    "oversized_blocks",
    f"""WITH {O.LEADS}, {O.KEYS} SELECT kind, value, n, CAST(n * (n - 1) // 2 AS BIGINT) AS pairs_not_compared
      FROM sizes WHERE n > {S.MAX_BLOCK_SIZE}""",
)
def _(spark, sf):
    return blocking.oversized_blocks(stored_leads(spark, sf))


@register("candidate_pairs_refined", f"WITH {O.LEADS}, {O.REFINED} SELECT id_a, id_b FROM refined")
def _(spark, sf):
    return blocking.refined_pairs(stored_leads(spark, sf))


@register("representatives", f"WITH {O.LEADS}, {O.REFINED} SELECT id, representative FROM known")
def _(spark, sf):
    return blocking.representatives(stored_leads(spark, sf)).select("id", "representative")


@register("uncompared_parts", f"WITH {O.LEADS}, {O.REFINED} {O.UNCOMPARED}")
def _(spark, sf):
    return blocking.uncompared_parts(stored_leads(spark, sf))


@register("candidate_pair_count", f"WITH {O.LEADS}, {O.PAIRS} SELECT count(*) AS candidate_pairs_considered FROM pairs")
def _(spark, sf):
    return blocking.candidate_pair_count(stored_leads(spark, sf))


_SCORES = "id_a, id_b, score, name_score, company_score, email_score, phone_score, country_score, same_email, same_phone"


@register("pair_scores", f"WITH {O.DEDUPE} SELECT {_SCORES} FROM scored")
def _(spark, sf):
    return dedupe.pair_scores(stored_leads(spark, sf))


@register(
    "dedupe_reasons",
    f"WITH {O.DEDUPE} SELECT id_a, id_b, score, {O.rounded('score')} AS confidence, {O.REASON} AS reason FROM scored WHERE score >= 0.5",
)
def _(spark, sf):
    return dedupe.scored_candidates(stored_leads(spark, sf), 0.5).drop("signals")


_SUMMARY = ["record_id", "name", "email", "phone_number", "company_name", "country"]


@register(
    "dedupe_candidates",
    f"WITH {O.DEDUPE}, summary AS (SELECT *, {O.display_name()} AS name FROM leads) SELECT "
    + ", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in ["id", *_SUMMARY])
    + f", {O.rounded('score')} AS confidence, {O.REASON} AS reason FROM scored "
    "JOIN summary a ON a.id = id_a JOIN summary b ON b.id = id_b WHERE score >= 0.72",
)
def dedupe_candidates(spark, sf):
    found = dedupe.dedupe_candidates(stored_leads(spark, sf))
    flat = [F.col(f"lead_{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in ["id", *_SUMMARY]]
    return found.select(*flat, "confidence", "reason")


# -- changes to the table ---------------------------------------------------

_SECOND = f"""second AS MATERIALIZED (SELECT * FROM ({O.normalized(
    "(SELECT * REPLACE (CAST(CAST(record_id AS BIGINT) + 499 AS VARCHAR) AS record_id), id AS seq FROM leads_raw)",
    "seq,",
)}))"""
_VALUES = [c for c in S.LEAD_COLUMNS if c not in ("id", "record_id")]
_UPSERT = f"""
  SELECT l.id, l.record_id, {', '.join(f'CASE WHEN s.seq IS NULL THEN l.{c} ELSE s.{c} END AS {c}' for c in _VALUES)}
  FROM leads l LEFT JOIN second s USING (record_id)
  UNION ALL SELECT (SELECT max(id) FROM leads) + row_number() OVER (ORDER BY seq), record_id, {', '.join(_VALUES)}
  FROM second WHERE record_id NOT IN (SELECT record_id FROM leads)"""


def _second_seed(spark, sf):
    return written(normalize_seed(D.seed_update_raw(spark, sf)), "seed")


@register("seed_upsert", f"WITH {O.LEADS}, {_SECOND} {_UPSERT}")
def _(spark, sf):
    return upsert.seed_upsert(stored_leads(spark, sf), _second_seed(spark, sf))


@register("seed_upsert_twice", f"WITH {O.LEADS}, {_SECOND} {_UPSERT}")
def _(spark, sf):
    store, seed = LeadStore(spark, new_folder(spark, "store")), _second_seed(spark, sf)
    store.write(D.leads(spark, sf))
    for _ in range(2):
        store.write(upsert.seed_upsert(store.read(), seed))
    return store.read()


@register(
    "seed_report",
    f"WITH {O.LEADS}, {_SECOND} SELECT count(*) - count(l.id) AS inserted, count(l.id) AS updated "
    "FROM second LEFT JOIN leads l USING (record_id)",
)
def _(spark, sf):
    return upsert.seed_report(stored_leads(spark, sf), _second_seed(spark, sf))


_PATCH = "(SELECT c_custkey + 51 AS id, c_custkey AS k FROM customer)"


@register(
    "apply_patches",
    f"""WITH {O.LEADS} SELECT * REPLACE (
      CASE k % 4 WHEN 0 THEN 'Closed Won' WHEN 3 THEN NULL ELSE lead_status END AS lead_status,
      CASE k % 4 WHEN 1 THEN ' New Owner' ELSE contact_owner END AS contact_owner,
      CASE k % 4 WHEN 1 THEN NULL WHEN 3 THEN 'note ' || k ELSE notes END AS notes)
    FROM (SELECT leads.*, k FROM leads LEFT JOIN {_PATCH} USING (id))""".replace(
        "SELECT * REPLACE", "SELECT * EXCLUDE (k) REPLACE"
    ),
)
def _(spark, sf):
    return upsert.apply_patches(stored_leads(spark, sf), D.patches(spark, sf))


@register(
    "apply_patches_repeated",
    f"""WITH {O.LEADS}, given AS (
      SELECT id, seq, unnest(CASE (k + seq) % 4
        WHEN 0 THEN [{{'key': 'status', 'value': 'Closed Won'}}]
        WHEN 1 THEN [{{'key': 'owner', 'value': 'Owner ' || seq}}, {{'key': 'notes', 'value': NULL}}]
        WHEN 2 THEN []
        ELSE [{{'key': 'status', 'value': NULL}}, {{'key': 'notes', 'value': 'note ' || k || ' ' || seq}}] END, recursive := true)
      FROM {_PATCH} CROSS JOIN range(1, 4) t(seq)),
    last AS (SELECT id, key, value FROM given QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY seq DESC) = 1)
    SELECT leads.* REPLACE (
      CASE WHEN s.id IS NULL THEN lead_status ELSE s.value END AS lead_status,
      CASE WHEN o.id IS NULL THEN contact_owner ELSE o.value END AS contact_owner,
      CASE WHEN n.id IS NULL THEN notes ELSE n.value END AS notes)
    FROM leads LEFT JOIN (FROM last WHERE key = 'status') s ON s.id = leads.id
    LEFT JOIN (FROM last WHERE key = 'owner') o ON o.id = leads.id
    LEFT JOIN (FROM last WHERE key = 'notes') n ON n.id = leads.id""",
)
def _(spark, sf):
    return upsert.apply_patches(stored_leads(spark, sf), D.repeated_patches(spark, sf))


@register(
    "patch_actions",
    f"""WITH {O.LEADS} SELECT id, CASE WHEN l.record_id IS NULL THEN 'not_found' WHEN k % 4 = 2 THEN 'no_fields'
      ELSE 'updated' END AS action FROM {_PATCH} LEFT JOIN leads l USING (id)""",
)
def _(spark, sf):
    return upsert.patch_actions(stored_leads(spark, sf), D.patches(spark, sf))


@register("max_record_id", f"WITH {O.LEADS} SELECT coalesce(max(record_id), 0) AS record_id FROM leads")
def _(spark, sf):
    return upsert.max_value(D.leads(spark, sf), "record_id")


# -- submissions ------------------------------------------------------------


def _stored(df: DataFrame) -> DataFrame:
    return written(df, "rows")


@register("match_exact", f"WITH {O.LEADS}, {O.SUBMISSIONS}, {O.exact('submissions')} SELECT seq, kind, id FROM exact")
def _(spark, sf):
    return merge.match_exact(_stored(D.submissions(spark, sf)).where("identified"), stored_leads(spark, sf))


@register("match_fuzzy", f"WITH {O.LEADS}, {O.FOLLOWUPS}, {O.FOLLOWUP_MATCH} SELECT seq, id, score FROM fuzzy")
def _(spark, sf):
    return merge.match_fuzzy(_stored(D.followups(spark, sf)), stored_leads(spark, sf))


_MERGE = f"WITH RECURSIVE {O.LEADS}, {O.SUBMISSIONS}, {O.SUBMISSION_TARGETS}"
_ACTION = "CASE WHEN target = -seq THEN 'inserted' ELSE 'updated' END"


@register("merge_decisions", f"{_MERGE} SELECT seq, {_ACTION} AS action, target FROM targets")
def _(spark, sf):
    return merge.merge_decisions(stored_leads(spark, sf), _stored(D.submissions(spark, sf)))


@register("merge_leads", f"{_MERGE}, {O.merged('submissions')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    return merge.merge_submissions(stored_leads(spark, sf), D.submissions(spark, sf)).leads


@register(
    "merge_report",
    f"{_MERGE} SELECT count(*) AS total_rows, count(*) FILTER (target = -seq) AS inserted, "
    "count(*) FILTER (target <> -seq) AS updated, count(*) FILTER (NOT identified) AS skipped, "
    "CAST(0 AS BIGINT) AS errors FROM submissions LEFT JOIN targets USING (seq)",
)
def _(spark, sf):
    return merge.merge_submissions(stored_leads(spark, sf), D.submissions(spark, sf)).report()


@register(
    "merge_messages",
    f"WITH {O.SUBMISSIONS} SELECT seq, 'Item ' || seq || ': no identifying fields' AS message FROM submissions WHERE NOT identified",
)
def _(spark, sf):
    return merge.item_messages(D.submissions(spark, sf))


_FOLLOWUPS = f"WITH RECURSIVE {O.LEADS}, {O.FOLLOWUPS}, {O.FOLLOWUP_TARGETS}"


@register("merge_followups", f"{_FOLLOWUPS}, {O.merged('followups')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    return merge.merge_submissions(stored_leads(spark, sf), D.followups(spark, sf)).leads


# contradictory rows against leads of which every third is there twice: conflicts, ties, chains
_CONTESTED = f"WITH RECURSIVE {O.ALIKE_LEADS}, {O.CONTESTED}, {O.targets('contested')}"


def _contested_merge(spark, sf):
    return merge.merge_submissions(written(D.alike_leads(spark, sf), "leads"), D.contested(spark, sf))


@register("merge_contested_decisions", f"{_CONTESTED} SELECT seq, {_ACTION} AS action, target FROM targets")
def _(spark, sf):
    return _contested_merge(spark, sf).decisions


@register("merge_contested", f"{_CONTESTED}, {O.merged('contested')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    return _contested_merge(spark, sf).leads


@register("store_merge_contested", f"{_CONTESTED}, {O.merged('contested')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    store = _store(spark, sf, D.alike_leads(spark, sf))
    merge_into(store, D.contested(spark, sf))
    return store.read()


@register(
    "merge_dashboard",
    f"{_MERGE}, {O.merged('submissions')} " + _COUNTS.replace("FROM leads", "FROM merged"),
)
def _(spark, sf):
    return dashboard.dashboard(merge.merge_submissions(stored_leads(spark, sf), D.submissions(spark, sf)).leads)


# -- files ------------------------------------------------------------------

_PER_FILE = 500


def _seed_files(spark, sf) -> str:
    raw, path = D.leads_raw(spark, sf).orderBy("id"), new_folder(spark, "seed-csv")
    headed = raw.select(*[F.col(c).alias(header) for header, c in S.SEED_HEADERS.items()])
    headed.write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def _mixed_files(spark, sf) -> str:
    """The same records in two folders, whose files have their columns in opposite orders."""
    raw, path = D.leads_raw(spark, sf), new_folder(spark, "mixed-csv")
    middle = raw.agg(F.percentile_approx("id", 0.5)).first()[0]
    headed = [F.col(c).alias(header) for header, c in S.SEED_HEADERS.items()]
    for folder, some, columns in (("a", F.col("id") <= middle, headed), ("b", F.col("id") > middle, headed[::-1])):
        raw.where(some).orderBy("id").select(*columns).write.csv(
            f"{path}/{folder}", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    return f"{path}/*"


def _submission_files(spark, sf) -> str:
    """JSON arrays of at most 500 submissions per file, in order of file name."""
    raw, path = D.submissions_raw(spark, sf), new_folder(spark, "submission-json")
    fields = [c for c in raw.columns if c != "seq"]
    part = F.lpad(F.floor((F.col("seq") - 1) / _PER_FILE).cast("string"), 12, "0")
    items = raw.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("seq", *fields))).alias("items"))
    items.select("part", F.to_json("items").alias("value")).write.partitionBy("part").text(path)
    return path


@register("seed_csv_load", f"WITH {O.LEADS} SELECT {_ALL} FROM leads")
def _(spark, sf):
    seed = normalize_seed(files.read_seed_csv(spark, _seed_files(spark, sf)))
    return upsert.seed_upsert(LeadStore(spark, new_folder(spark, "store")).read(), written(seed, "seed"))


@register("seed_csv_mixed_headers", f"WITH {O.LEADS} SELECT {_ALL} FROM leads")
def _(spark, sf):
    seed = normalize_seed(files.read_seed_csv(spark, _mixed_files(spark, sf)))
    return upsert.seed_upsert(LeadStore(spark, new_folder(spark, "store")).read(), written(seed, "seed"))


@register(
    "submission_csv_mixed_headers",
    f"""WITH {O.LEADS_RAW}, as_sent AS (SELECT id AS seq, full_name AS name, email, phone_number AS phone,
      company_name AS company, country, notes AS message, create_date AS submitted_at,
      CAST(NULL AS VARCHAR) AS page_url FROM leads_raw) {O.normalized_submissions('as_sent')}""",
)
def _(spark, sf):
    return normalize_submissions(files.read_submission_csv(spark, _mixed_files(spark, sf)))


@register(
    "submission_csv_load",
    f"""WITH {O.LEADS_RAW}, as_sent AS (SELECT id AS seq, full_name AS name, email, phone_number AS phone,
      company_name AS company, country, notes AS message, create_date AS submitted_at,
      CAST(NULL AS VARCHAR) AS page_url FROM leads_raw) {O.normalized_submissions('as_sent')}""",
)
def _(spark, sf):
    return normalize_submissions(files.read_submission_csv(spark, _seed_files(spark, sf)))


@register("submission_json_load", f"WITH {O.SUBMISSIONS} SELECT * FROM submissions")
def _(spark, sf):
    return normalize_submissions(files.read_submission_json(spark, _submission_files(spark, sf)))


@register("submission_array_load", f"WITH {O.SUBMISSIONS} SELECT * FROM submissions")
def _(spark, sf):
    return normalize_submissions(files.read_submission_arrays(spark, _submission_files(spark, sf)))


@register("submission_lines_load", f"WITH {O.SUBMISSIONS} SELECT * FROM submissions")
def _(spark, sf):
    path = new_folder(spark, "submission-lines")
    D.submissions_raw(spark, sf).orderBy("seq").drop("seq").write.json(path)
    return normalize_submissions(files.read_submission_lines(spark, path))


@register(
    "export_csv",
    f"WITH {O.LEADS} SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in S.EXPORT_FIELDS)} FROM leads",
)
def _(spark, sf):
    path = new_folder(spark, "export")
    files.export_leads(stored_leads(spark, sf), path)
    return spark.read.options(header=True, multiLine=True, escape='"').csv(path)


# -- streams ----------------------------------------------------------------


# small parts, so that a version rewrites only some of them on the check's tables too
_WIDTH, _KEY_PARTS = 4096, 16


def _store(spark, sf, leads: DataFrame | None = None) -> LeadStore:
    store = LeadStore(spark, new_folder(spark, "store"), _WIDTH, _KEY_PARTS)
    store.write(D.leads(spark, sf) if leads is None else leads)
    return store


@register("store_merge", f"{_MERGE}, {O.merged('submissions')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    store = _store(spark, sf)
    merge_into(store, D.submissions(spark, sf))
    return store.read()


@register(
    "store_keys",
    f"""{_MERGE}, {O.merged('submissions')},
    held AS (SELECT * REPLACE (nullif(email_normalized, '') AS email_normalized, nullif(phone_normalized, '') AS phone_normalized) FROM merged)
    SELECT 1 AS kind, email_normalized AS value, id FROM held WHERE email_normalized IS NOT NULL
    UNION ALL SELECT 2, phone_normalized, id FROM held WHERE phone_normalized IS NOT NULL
    UNION ALL SELECT 3, right(phone_normalized, 8) || '|company_normalized|' || company_normalized, id FROM held
      WHERE email_normalized IS NOT NULL AND len(phone_normalized) >= 8 AND company_normalized <> ''
    UNION ALL SELECT 3, right(phone_normalized, 8) || '|name_normalized|' || name_normalized, id FROM held
      WHERE email_normalized IS NOT NULL AND len(phone_normalized) >= 8 AND name_normalized <> ''""",
)
def _(spark, sf):
    store = _store(spark, sf)
    merge_into(store, D.submissions(spark, sf))
    return store.keys()


@register("store_search", f"WITH {O.LEADS} SELECT {_ALL} FROM leads WHERE {_search} ORDER BY id LIMIT 200")
def _(spark, sf):
    return _store(spark, sf).list_leads(q="JANE", limit=200)


@register("store_deep_page", f"WITH {O.LEADS} SELECT {_ALL} FROM leads ORDER BY id LIMIT 60 OFFSET 115")
def _(spark, sf):
    return _store(spark, sf).list_leads(limit=60, offset=115)


@register("live_counts_after_merge", f"{_MERGE}, {O.merged('submissions')} " + _COUNTS.replace("FROM leads", "FROM merged"))
def _(spark, sf):
    store = _store(spark, sf)
    merge_into(store, D.submissions(spark, sf))
    return _run(store_counts(store), spark, "complete", "counts")


# every 13th item is a number, the one after it has an object for a name
_BROKEN = "CASE seq % 13 WHEN 0 THEN 'not an object' WHEN 1 THEN 'name is not a text' END"
_READABLE = f"""{O.SUBMISSIONS_RAW}, submissions AS MATERIALIZED (
  SELECT * REPLACE (identified AND {_BROKEN} IS NULL AS identified), {_BROKEN} AS error
  FROM ({O.normalized_submissions('submissions_raw')}))"""
_SOME_BROKEN = f"WITH RECURSIVE {O.LEADS}, {_READABLE}, {O.SUBMISSION_TARGETS}"


def _broken_files(spark, sf) -> str:
    raw, path = D.submissions_raw(spark, sf), new_folder(spark, "broken-json")
    fields = [c for c in raw.columns if c != "seq"]
    nested = F.to_json(F.struct(F.struct(F.col("name").alias("full")).alias("name"), "email"))
    item = F.when(F.col("seq") % 13 == 0, F.col("seq").cast("string")).when(F.col("seq") % 13 == 1, nested)
    item = F.coalesce(item, F.to_json(F.struct(*fields)))
    part = F.lpad(F.floor((F.col("seq") - 1) / _PER_FILE).cast("string"), 12, "0")
    items = raw.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("seq", item.alias("item")))).alias("items"))
    text = F.concat(F.lit("["), F.array_join("items.item", ", "), F.lit("]"))
    items.select("part", text.alias("value")).write.partitionBy("part").text(path)
    return path


def _broken_merge(spark, sf):
    rows = normalize_submissions(files.read_submission_json(spark, _broken_files(spark, sf), on_error="keep"))
    return merge.merge_submissions(stored_leads(spark, sf), rows)


@register(
    "merge_errors",
    f"{_SOME_BROKEN} SELECT count(*) AS total_rows, count(*) FILTER (target = -seq) AS inserted, "
    "count(*) FILTER (target <> -seq) AS updated, count(*) FILTER (NOT identified AND error IS NULL) AS skipped, "
    "count(error) AS errors FROM submissions LEFT JOIN targets USING (seq)",
)
def _(spark, sf):
    return _broken_merge(spark, sf).report()


@register(
    "ingest_error_details",
    f"{_SOME_BROKEN} SELECT seq, 'Item ' || seq || ': ' || coalesce(error, 'no identifying fields') AS message FROM submissions WHERE NOT identified",
)
def _(spark, sf):
    rows = normalize_submissions(files.read_submission_json(spark, _broken_files(spark, sf), on_error="keep"))
    return merge.item_messages(rows)


@register("merge_past_errors", f"{_SOME_BROKEN}, {O.merged('submissions')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    return _broken_merge(spark, sf).leads


@register("stream_merge", f"{_MERGE}, {O.merged('submissions')} SELECT {_ALL} FROM merged")
def _(spark, sf):
    store = _store(spark, sf)
    run = stream_merge(spark, _submission_files(spark, sf), store.path, new_folder(spark, "progress"))
    run.awaitTermination()
    return store.read()


def _stream_of(spark, df: DataFrame, label: str) -> DataFrame:
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _run(stream: DataFrame, spark, mode: str, label: str) -> DataFrame:
    """Run a stream over what is there and return what it wrote last."""
    path = new_folder(spark, label)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{'all' if mode == 'complete' else batch_id}")

    run = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", new_folder(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(path)


@register(
    "stream_classify",
    f"WITH {O.SUBMISSIONS_RAW} SELECT seq, source_channel, source_detail FROM ({O.classified('submissions_raw', 'message')})",
)
def _(spark, sf):
    notes = D.submissions_raw(spark, sf).select("seq", "message")
    found = classify_source(_stream_of(spark, notes, "notes"), "message").drop("message")
    return _run(found, spark, "append", "classified")


@register("stream_counts", f"WITH {O.LEADS} {_COUNTS}")
def _(spark, sf):
    return _run(live_counts(_stream_of(spark, D.leads(spark, sf), "arriving")), spark, "complete", "counts")
