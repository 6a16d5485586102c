"""Column layouts and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType

LEAD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("record_id", T.LongType(), False),
        T.StructField("first_name", _S()),
        T.StructField("last_name", _S()),
        T.StructField("full_name", _S()),
        T.StructField("job_title", _S()),
        T.StructField("company_name", _S()),
        T.StructField("email", _S()),
        T.StructField("email_normalized", _S()),
        T.StructField("phone_number", _S()),
        T.StructField("phone_normalized", _S()),
        T.StructField("country", _S()),
        T.StructField("city", _S()),
        T.StructField("lead_status", _S()),
        T.StructField("lifecycle_stage", _S()),
        T.StructField("original_source", _S()),
        T.StructField("original_source_drill_down_1", _S()),
        T.StructField("contact_owner", _S()),
        T.StructField("create_date", _S()),
        T.StructField("last_modified_date", _S()),
        T.StructField("notes", _S()),
        T.StructField("annual_revenue", _S()),
        T.StructField("marketing_contact_status", _S()),
        T.StructField("gdpr_consent", _S()),
        # 64-bit so that a large score is kept rather than nulled
        T.StructField("lead_score", T.LongType()),
        T.StructField("name_normalized", _S()),
        T.StructField("company_normalized", _S()),
        T.StructField("source_channel", _S()),
        T.StructField("source_detail", _S()),
    ]
)
LEAD_COLUMNS = LEAD_SCHEMA.names

SUBMISSION_SCHEMA = T.StructType(
    [
        T.StructField(name, _S())
        for name in (
            "form_id",
            "form_name",
            "page_url",
            "submitted_at",
            "name",
            "email",
            "phone",
            "company",
            "country",
            "message",
        )
    ]
)

# ---------------------------------------------------------------------------
# File headers, status names, domains, keywords, patterns,
# weights and labels must equal these for results to be right.
# ---------------------------------------------------------------------------

# header in a CRM seed file -> lead column
SEED_HEADERS = {
    "Record ID": "record_id",
    "First Name": "first_name",
    "Last Name": "last_name",
    "Full Name": "full_name",
    "Job Title": "job_title",
    "Company Name": "company_name",
    "Email": "email",
    "Phone Number": "phone_number",
    "Country/Region": "country",
    "City": "city",
    "Lead Status": "lead_status",
    "Lifecycle Stage": "lifecycle_stage",
    "Original Source": "original_source",
    "Original Source Drill-Down 1": "original_source_drill_down_1",
    "Contact Owner": "contact_owner",
    "Create Date": "create_date",
    "Last Modified Date": "last_modified_date",
    "Notes": "notes",
    "Annual Revenue": "annual_revenue",
    "Marketing contact status": "marketing_contact_status",
    "GDPR consent": "gdpr_consent",
    "Lead Score": "lead_score",
}

# an export leaves out the four matching columns
EXPORT_FIELDS = [
    "id",
    "record_id",
    "first_name",
    "last_name",
    "full_name",
    "job_title",
    "company_name",
    "email",
    "phone_number",
    "country",
    "city",
    "lead_status",
    "lifecycle_stage",
    "original_source",
    "original_source_drill_down_1",
    "contact_owner",
    "create_date",
    "last_modified_date",
    "notes",
    "annual_revenue",
    "marketing_contact_status",
    "gdpr_consent",
    "lead_score",
    "source_channel",
    "source_detail",
]

# columns that free-text search looks into
SEARCH_FIELDS = [
    "full_name",
    "first_name",
    "last_name",
    "company_name",
    "email",
    "name_normalized",
    "company_normalized",
    "email_normalized",
]

# case-folded status text -> stored status
STATUS_NAMES = {
    "new": "New",
    "contacted": "Contacted",
    "connected": "Connected",
    "qualified": "Qualified",
    "opportunity": "Opportunity",
    "close won": "Closed Won",
    "closed won": "Closed Won",
    "closed lost": "Closed Lost",
}

# mailbox providers whose domain says nothing about the employer
GENERIC_EMAIL_DOMAINS = [
    "gmail.com",
    "yahoo.com",
    "hotmail.com",
    "outlook.com",
    "icloud.com",
    "proton.me",
]

# a block with more leads than this proposes no pairs
MAX_BLOCK_SIZE = 50

# smallest confidence of a listed duplicate, and of a merge into a lead
LIST_CONFIDENCE = 0.72
MERGE_CONFIDENCE = 0.90

SIGNAL_WEIGHTS = {"name": 0.35, "company": 0.20, "email": 0.20, "phone": 0.20, "country": 0.05}
EMAIL_LOCAL_WEIGHT = 0.65
EMAIL_DOMAIN_WEIGHT = 0.35
PHONE_TAIL = 8
PHONE_TAIL_SCORE = 0.9
SAME_EMAIL_FLOOR = 0.98
SAME_PHONE_FLOOR = 0.96
FLOOR_SUPPORT = 0.50

CHANNELS = ["Website", "Event", "LinkedIn", "Organic Search", "Referral", "Manual/Sales", "Other"]

EVENT_KEYWORDS = [
    "festival",
    "conference",
    "summit",
    "expo",
    "booth",
    "disrupt",
    "fintech week",
    "fintech festival",
    "mobile world congress",
    "saastr annual",
    "techcrunch",
]
# tried in this order; the second can only match where the first does
EVENT_NAME_PATTERNS = [
    r"(?:at|during|from) (?:the )?(.+?) booth",
    r"at (?:our )?(.+?) booth",
    r"at the (.+?)(?:,|\.|$)",
    r"met (?:him|her|them) at (?:the )?(.+?)(?: booth|,|\.)",
]
REFERRAL_KEYWORDS = ["referred by", "warm intro", "referral"]
REFERRAL_PATTERN = r"referred by\s+([^,.]+)"
ORGANIC_KEYWORDS = [
    "googled us",
    "google search",
    "organic google",
    "organic search",
    "found us through organic",
]
ORGANIC_PATTERN = r"(?:landed on|ended up on|before booking a demo|then landed on)\s+(?:the )?([^,.]+)"
MANUAL_KEYWORDS = [
    "manually added",
    "manual -",
    "manual—",
    "inbound phone call",
    "cold outreach list",
    "sales added",
]
WEBSITE_KEYWORDS = [
    "filled out the form",
    "contact page",
    "book-a-demo page",
    "newsletter signup",
    "website",
    "form on the blog",
    "pricing page",
]
WEBSITE_PATTERN = r"form on the ([^.]+)"
