"""Lead and submission tables derived from the given tables.

The given tables hold no leads, e-mails or phones, so messy lead records are
derived from ``customer`` and ``nation``, form submissions from ``events`` and
``orders``. Each recipe exists once for Spark and once as SQL for the check, and
both read the same constants. Work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.normalize import normalize_seed, normalize_submissions
from leadloom.operators.numbering import number_rows
from leadloom.schema import LEAD_COLUMNS, SEED_HEADERS

# ---------------------------------------------------------------------------
# Fixed values of the recipe
# ---------------------------------------------------------------------------
FIRST = "Jane John Maria Wei Amir Chloe Diego Emma Farah Grace Hugo Ines Karim Lena Omar Priya".split()
LAST = (
    "Tan Lim Garcia Smith Rossi Chen Kumar Novak Silva Ito "
    "Meyer Dubois Haddad Olsen Park Reyes Weber Young Zhang Okafor"
).split()
COMPANY = [
    "Acme",
    "Liu Trading",
    "Northwind",
    "Blue Harbor",
    "Delta Foods",
    "Evergreen Labs",
    "Falcon Air",
    "Granite Bank",
    "Helios Energy",
    "Iris Media",
    "Juniper Health",
    "Kestrel Tech",
    "Lotus Retail",
    "Mosaic Design",
    "Nimbus Cloud",
    "Orchid Travel",
    "Pioneer Steel",
    "Quartz Legal",
    "Rapid Freight",
    "Summit Foods",
    "Tidal Water",
    "Umbra Games",
    "Vertex Auto",
    "Willow Homes",
]
STATUS = [
    " New",
    "NEW",
    "contacted",
    "Connected ",
    "qualified",
    "Opportunity",
    "close won",
    "CLOSED  WON",
    "closed lost",
    "Nurture",
    "",
]
OWNER = ["Alice Tan", "Bob Lee", "Cara Diaz", "", "Dan O_Hara"]
SCORE = ["42", "12.9", "", "n/a", "-3.5"]
NOTE = [
    "Scanned the QR code at our Singapore FinTech Festival 2026 booth.",
    "Met him at SaaStr Annual.",
    "Talked at the Mobile World Congress, wants a quote",
    "Scanned QR, visited booth",
    "Stopped by during the Growth Summit booth tour",
    "Wants to export goods",
    "met at the booth",
    "Linkedin dm inbound asking about pricing.",
    "Left a comment on our post",
    "LinkedIn connection request",
    "Found on LinkedIn",
    "LinkedIn admin page follow",
    "Referred by Maria Lim, existing customer",
    "Warm intro from a partner",
    "Referral from a partner.",
    "Found us through organic google search then landed on the book-a-demo page.",
    "Googled us yesterday",
    "Manual - added after inbound phone call.",
    "Cold outreach list Q2",
    "Filled out the form on the pricing page. Wants a call",
    "newsletter   signup",
    "Our website chat",
    "Walked into the office without an appointment.",
    "",
]
UNKNOWN_PERSON = 100_000
COPY_OFFSET = 1_000_000_000


# tasks for each core that rows are dealt out to
_TASKS_A_CORE = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows over some tasks for each core.

    A small file is read by one task, and a stretch of numbers is given by one;
    what comes next is dear for each row and should run on all cores.
    """
    return rows.repartition(_TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _person(p: Column) -> dict[str, Column]:
    first = _pick(FIRST, (p * 7) % len(FIRST))
    last = _pick(LAST, (p * 11 + F.floor(p / 16)) % len(LAST))
    company = F.when(p % 4 == 0, F.lit(COMPANY[0])).otherwise(_pick(COMPANY, (p * 5) % len(COMPANY)))
    domain = F.concat(F.lower(F.replace(company, F.lit(" "))), F.lit(".com"))
    return {
        "first": first,
        "last": last,
        "company": company,
        "phone": (F.lit(90000000) + (p * 7919) % 9999999).cast("string"),
        "domain": domain,
        "email": F.concat(F.lower(F.concat_ws(".", first, last)), p.cast("string"), F.lit("@"), domain),
    }


def leads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy lead records: three variants per person, in the lead columns."""
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    k = F.col("c_custkey")
    rows = spread(rows.select("c_custkey", "n_name", "c_mktsegment")).select(
        k.alias("k"), F.floor(k / 3).alias("p"), (k % 3).alias("v"), "n_name", "c_mktsegment"
    )
    rows = rows.withColumns({f"_{n}": c for n, c in _person(F.col("p")).items()})
    k, p, v = F.col("k"), F.col("p"), F.col("v")
    first, last, company = F.col("_first"), F.col("_last"), F.col("_company")
    phone = F.col("_phone")
    date = F.date_add(F.lit("2026-01-01").cast("date"), (k % 150).cast("int"))
    longer = F.concat(last, F.right(last, F.lit(1)))
    digits = (F.substring(phone, 1, 4), F.substring(phone, 5, 4))

    def variant(zero: Column, one: Column, two: Column) -> Column:
        return F.when(v == 0, zero).when(v == 1, one).otherwise(two)

    private = F.concat(F.lower(F.concat(first, last)), p.cast("string"), F.lit("@gmail.com"))
    fields = {
        "first_name": first,
        "last_name": F.when(v == 1, longer).otherwise(last),
        "full_name": variant(
            F.concat_ws(" ", first, last),
            F.concat_ws(" ", first, longer),
            F.concat(F.lit("  "), F.upper(first), F.lit("  "), last, F.lit(" ")),
        ),
        "job_title": F.concat(F.lit(" "), F.lower(F.col("c_mktsegment")), F.lit("  lead")),
        "company_name": F.concat(company, variant(F.lit(" Pte Ltd"), F.lit(" Pte. Ltd"), F.lit(""))),
        "email": variant(
            F.col("_email"),
            F.concat(F.lit(" "), F.upper(F.col("_email")), F.lit(" ")),
            F.when(p % 2 == 0, private),
        ),
        "phone_number": variant(
            F.concat(F.lit("+65 "), digits[0], F.lit(" "), digits[1]),
            F.concat(F.lit("(65) "), digits[0], F.lit("-"), digits[1]),
            F.when(p % 5 != 0, phone),
        ),
        "country": F.col("n_name"),
        "lead_status": _pick(STATUS, k % len(STATUS)),
        "contact_owner": _pick(OWNER, (k * 3) % len(OWNER)),
        "create_date": F.when(k % 4 == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(k % 4 == 2, F.date_format(date, "yyyy-MM-dd'T08:00:00Z'"))
        .when(k % 20 == 3, F.lit("not a date"))
        .otherwise(F.date_format(date, "M/d/yyyy")),
        "notes": _pick(NOTE, k % len(NOTE)),
        "lead_score": _pick(SCORE, (k % 7) % len(SCORE)),
    }
    columns = [
        fields.get(c, F.lit(None).cast("string")).alias(c) for c in SEED_HEADERS.values() if c != "record_id"
    ]
    return rows.select((k + 1).alias("id"), (k + 1000).cast("string").alias("record_id"), *columns)


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised lead table."""
    raw = leads_raw(spark, sf_dir).withColumnRenamed("id", "_id")
    return normalize_seed(raw).withColumnRenamed("_id", "id").select(*LEAD_COLUMNS)


def _numbered(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``seq`` 1, 2, ... by ``order``, given while they are narrow and in few tasks."""
    return spread(number_rows(rows, order, "_n").withColumn("seq", F.col("_n") + 1).drop("_n"))


def submissions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form submissions, one from every event, with ``seq`` 1, 2, ... by event."""
    e = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        e.alias("e"),
        "ts",
        "event_type",
        (F.col("user_id") + F.when(e % 10 == 9, UNKNOWN_PERSON).otherwise(0)).alias("p"),
    )
    rows = _numbered(rows, "e").withColumns({f"_{n}": c for n, c in _person(F.col("p")).items()})
    e, first, last = F.col("e"), F.col("_first"), F.col("_last")
    typo = F.concat(last, F.right(last, F.lit(1)))
    anonymous = e % 28 == 3
    return rows.select(
        "seq",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("submitted_at"),
        F.concat(F.lit("/"), F.col("event_type")).alias("page_url"),
        F.when(~anonymous, F.concat_ws(" ", first, F.when(e % 4 == 3, typo).otherwise(last))).alias("name"),
        F.when(e % 4 == 0, F.col("_email")).alias("email"),
        F.when(e % 4 == 1, F.concat(F.lit("+65 "), F.col("_phone"))).alias("phone"),
        F.when(~anonymous & (e % 4 >= 2), F.concat(F.col("_company"), F.lit(" Pte Ltd"))).alias("company"),
        F.concat(F.lit("NATION_"), (F.col("p") % 25).cast("string")).alias("country"),
        _pick(NOTE, e % len(NOTE)).alias("message"),
    )


def contested_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions that contradict each other, one from every event, with ``seq`` by event.

    Four persons share their addresses, numbers and companies in all combinations.
    """
    e, p = F.col("event_id"), F.col("user_id")
    rows = table(spark, sf_dir, "events").select(e.alias("e"), "ts", "event_type", p.alias("p"), (p - p % 4 + (p + 1) % 4).alias("q"))
    rows = _numbered(rows, "e").withColumns({f"_{n}": c for n, c in _person(F.col("p")).items()} | {f"_next_{n}": c for n, c in _person(F.col("q")).items()})
    e, first, last, mail, phone = (F.col(c) for c in ("e", "_first", "_last", "_email", "_phone"))
    name = F.concat_ws(" ", first, last)

    def nth(places: int, step: int, *values: Column) -> Column:
        return F.get(F.array(*values), (F.floor(e / step) % places).cast("int"))

    nothing = F.lit(None).cast("string")
    return rows.select(
        "seq",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("submitted_at"),
        F.concat(F.lit("/"), F.col("event_type")).alias("page_url"),
        nth(5, 1, name, name, name, F.concat(name, F.right(last, F.lit(1))), nothing).alias("name"),
        nth(4, 3, mail, F.replace(mail, F.lit("@"), F.lit("@mail.")), F.col("_next_email"), nothing).alias("email"),
        nth(5, 7, F.concat(F.lit("+65 "), phone), F.concat(F.lit("+1 "), phone), F.concat(F.lit("+44 "), F.col("_next_phone")), phone, nothing).alias("phone"),
        nth(4, 2, F.concat(F.col("_company"), F.lit(" Pte Ltd")), F.col("_company"), F.col("_next_company"), nothing).alias("company"),
        F.concat(F.lit("NATION_"), (F.col("p") % 25).cast("string")).alias("country"),
        _pick(NOTE, e % len(NOTE)).alias("message"),
    )


def contested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_submissions(contested_raw(spark, sf_dir))


def alike_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lead table with every third lead twice, the copy under ids of its own."""
    once = leads(spark, sf_dir)
    moved = {c: F.col(c) + COPY_OFFSET for c in ("id", "record_id")}
    return once.unionByName(once.where("id % 3 = 1").withColumns(moved))


def followups_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions that match nobody exactly: one per order, ``seq`` by order.

    The phone has another country prefix and the e-mail a subdomain, so only the
    score finds the lead.
    """
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(o.alias("o"), F.floor(F.col("o_custkey") / 3).alias("p"))
    rows = _numbered(rows, "o").withColumns({f"_{n}": c for n, c in _person(F.col("p")).items()})
    o, p = F.col("o"), F.col("p")
    mailbox = F.concat(F.lower(F.concat_ws(".", F.col("_first"), F.col("_last"))), p.cast("string"))
    return rows.select(
        "seq",
        F.concat_ws(" ", F.col("_first"), F.col("_last")).alias("name"),
        F.concat(mailbox, F.lit("@mail."), F.col("_domain")).alias("email"),
        F.concat(F.lit("+1 "), F.col("_phone")).alias("phone"),
        F.concat(F.col("_company"), F.when(o % 3 == 0, " Pte. Ltd").otherwise(" Pte Ltd")).alias("company"),
        F.concat(F.lit("NATION_"), (o % 25).cast("string")).alias("country"),
        _pick(NOTE, o % len(NOTE)).alias("message"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_submissions(submissions_raw(spark, sf_dir))


def followups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_submissions(followups_raw(spark, sf_dir))


def seed_update_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second seed: every record again under a record id 499 further on.

    Part of it meets stored leads, the rest is new. ``seq`` is the order.
    """
    raw = leads_raw(spark, sf_dir)
    later = (F.col("record_id").cast("bigint") + 499).cast("string")
    return raw.withColumn("record_id", later).withColumnRenamed("id", "seq")


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A patch per customer, some for leads that do not exist, some empty."""
    k = F.col("c_custkey")
    nothing = F.lit(None).cast("string")
    changes = (
        F.when(k % 4 == 0, F.create_map(F.lit("status"), F.lit("  closed   WON ")))
        .when(k % 4 == 1, F.create_map(F.lit("owner"), F.lit(" New Owner"), F.lit("notes"), nothing))
        .when(k % 4 == 2, F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(F.lit("status"), nothing, F.lit("notes"), F.concat(F.lit("note "), k.cast("string"))))
    )
    return table(spark, sf_dir, "customer").select((k + 51).alias("id"), changes.alias("changes"))


def repeated_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three patches per customer, with ``seq``, the order in which they came."""
    k, seq = F.col("c_custkey"), F.col("seq")
    nothing = F.lit(None).cast("string")
    owner, note = F.concat(F.lit("Owner "), seq.cast("string")), F.concat_ws(" ", F.lit("note"), k.cast("string"), seq.cast("string"))
    changes = (
        F.when((k + seq) % 4 == 0, F.create_map(F.lit("status"), F.lit("  closed   WON ")))
        .when((k + seq) % 4 == 1, F.create_map(F.lit("owner"), owner, F.lit("notes"), nothing))
        .when((k + seq) % 4 == 2, F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(F.lit("status"), nothing, F.lit("notes"), note))
    )
    rows = spread(table(spark, sf_dir, "customer").select("c_custkey")).withColumn("seq", F.explode(F.expr("sequence(1, 3)")))
    return rows.select((k + 51).alias("id"), seq.cast("long").alias("seq"), changes.alias("changes"))
