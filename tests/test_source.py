import pytest

from leadloom.functions.source import classify_source
from leadloom.plans.derived import NOTE
from leadloom.schema import CHANNELS

EXPECTED = [
    ("Event", "Singapore FinTech Festival 2026 — Booth QR Code"),
    ("Event", "SaaStr Annual"),
    ("Event", "Mobile World Congress"),
    ("Event", "EventBooth QR Code"),
    ("Event", "Growth Summit"),
    ("Event", "Event"),
    ("Event", "the"),
    ("LinkedIn", "LinkedIn DM"),
    ("LinkedIn", "LinkedIn post/comment"),
    ("LinkedIn", "LinkedIn connection"),
    ("LinkedIn", "LinkedIn"),
    ("LinkedIn", "LinkedIn DM"),
    ("Referral", "Referral — Maria Lim"),
    ("Referral", "Referral"),
    ("Referral", "Referral"),
    ("Organic Search", "Organic Search — book-a-demo page"),
    ("Organic Search", "Organic Search"),
    ("Manual/Sales", "Manual/Sales"),
    ("Manual/Sales", "Manual/Sales"),
    ("Website", "Website — pricing page"),
    ("Website", "Website"),
    ("Website", "Website"),
    ("Other", "Other"),
    ("Other", "Other"),
]
MORE = {
    None: ("Other", "Other"),
    "LinkedIn comment at the expo, nice": ("Event", "expo"),
    "Referred by  Bob Lee. Saw us on LinkedIn": ("LinkedIn", "LinkedIn"),
    "that big booth": ("Event", "big"),
    "Visited us at our Paris booth": ("Event", "Paris"),
    "met her at Summit 2026, talked": ("Event", "Summit 2026"),
    "AT THE TechCrunch Disrupt": ("Event", "TechCrunch Disrupt"),
    "manual— typed in": ("Manual/Sales", "Manual/Sales"),
    "Referred by , nobody": ("Referral", "Referral"),
    "form on the blog. thanks": ("Website", "Website — blog"),
    "Googled us, ended up on pricing page": ("Organic Search", "Organic Search — pricing page"),
    "met at the event booth": ("Event", "event"),
    "QR from the Event booth": ("Event", "EventBooth QR Code"),
    "Our post got a Comment": ("LinkedIn", "LinkedIn post/comment"),
}


@pytest.mark.parametrize("notes, expected", [(NOTE, EXPECTED), (list(MORE), list(MORE.values()))])
def test_notes(spark, notes, expected):
    df = spark.createDataFrame(list(enumerate(notes)), "i int, notes string")
    rows = classify_source(df).orderBy("i").collect()
    assert [(r["source_channel"], r["source_detail"]) for r in rows] == expected
    assert {r["source_channel"] for r in rows} <= set(CHANNELS)


def test_long_notes_are_read_to_the_end(spark):
    text = "word " * 20000 + "stopped by during the Growth Summit booth tour " + "word " * 20000
    row = classify_source(spark.createDataFrame([(text,)], "notes string")).first()
    assert (row["source_channel"], row["source_detail"]) == ("Event", "Growth Summit")
