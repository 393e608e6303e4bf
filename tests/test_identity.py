import pytest
from frames import rows
from pyspark.sql import functions as F

from touchledger.operators import identity as ident

CONTACT = ("contact_id bigint; email string; is_personal_email boolean; full_name_key string; job_title string; "
           "phone_key string; company_id bigint; created_at timestamp")


def contact(cid, email, phone=None, company=None, name="x y"):
    personal = email.endswith("@gmail.com")
    return (cid, email, personal, name, None, phone, company, "2025-01-01 00:00:00")


@pytest.fixture
def contacts(frame):
    return frame(
        CONTACT,
        contact(1, "ann@acme.io", "4155550134", 10, "ann lee"), contact(2, "ann@gmail.com", "4155550134"),
        contact(3, "bob@gmail.com", None), contact(4, "cy@gmail.com", "999"),
        contact(5, "dee@acme.io", "777", 10, "dee fox"), contact(6, "eve@acme.io", "777", 11, "dee fox"),
        contact(7, "dup@gmail.com", "777"), contact(8, "solo@nowhere.io", "111", None))


@pytest.fixture
def companies(frame):
    return frame("company_id bigint; domain string", (10, "acme.io"), (11, "beta.io"))


def test_personal_contacts_join_the_work_contact_with_their_phone(contacts):
    got = {r["contact_id"]: (r["person_id"], r["match_rule"]) for r in ident.identity_contacts(contacts, "min_id").collect()}
    assert got == {1: (1, "self"), 2: (1, "phone_match"), 3: (3, "unmatched_personal"), 4: (4, "unmatched_personal"),
                   5: (5, "self"), 6: (6, "self"), 7: (5, "phone_match"), 8: (8, "self")}


def test_shared_phone_fans_out_and_is_reported(contacts):
    fan = ident.identity_contacts(contacts)
    assert sorted(r["person_id"] for r in fan.filter("contact_id = 7").collect()) == [5, 6]
    conflict = ident.phone_conflicts(contacts).collect()
    assert [(r["phone_key"], r["work_contacts"], r["personal_contacts"]) for r in conflict] == [("777", 2, 1)]
    with pytest.raises(ValueError):
        ident.phone_owners(contacts, "guess")


def test_written_owners_give_the_same_result(contacts, spark, tmp_path):
    ident.phone_owners(contacts).write.parquet(str(tmp_path / "o"))
    owners = spark.read.parquet(str(tmp_path / "o"))
    assert rows(ident.identity_contacts(contacts, owners=owners), "contact_id") == rows(
        ident.identity_contacts(contacts), "contact_id")


def test_people_without_account_are_dropped(contacts, companies):
    people = ident.identity_people(ident.identity_contacts(contacts), contacts, companies)
    assert [(r["person_id"], r["company_id"], r["company_domain"]) for r in people.orderBy("person_id").collect()] == [
        (1, 10, "acme.io"), (5, 10, "acme.io"), (6, 11, "beta.io")]


def test_email_map_holds_merged_addresses(contacts):
    got = rows(ident.identity_email_map(ident.identity_contacts(contacts, "min_id")), "email")
    assert got == [("ann@acme.io", 1, 10), ("ann@gmail.com", 1, 10), ("dee@acme.io", 5, 10), ("dup@gmail.com", 5, 10),
                   ("eve@acme.io", 6, 11)]


def test_client_map_takes_the_lowest_person(frame, contacts):
    fills = frame("client_id string; email string; submitted_at timestamp",
                  ("k1", "eve@acme.io", "2025-01-02 00:00:00"), ("k1", "ann@gmail.com", "2025-01-03 00:00:00"),
                  ("k1", "ann@gmail.com", "2025-01-05 00:00:00"), ("k2", "who@else.io", "2025-01-01 00:00:00"))
    got = ident.identity_client_map(fills, ident.identity_email_map(ident.identity_contacts(contacts))).collect()
    assert [(r["client_id"], r["person_id"], str(r["first_identified_at"]), r["company_id"]) for r in got] == [
        ("k1", 1, "2025-01-02 00:00:00", 10)]


SIGNAL = "signal_id string; full_name_key string; company_domain string; email string; detected_at timestamp"


def test_signals_match_by_email_or_by_name_and_domain(frame):
    people = frame("person_id bigint; work_email string; full_name_key string; company_id bigint; company_domain string",
                   (1, "ann@acme.io", "ann lee", 10, "acme.io"), (2, "a2@acme.io", "dee fox", 10, "acme.io"),
                   (3, "a3@acme.io", "dee fox", 10, "acme.io"), (4, None, None, 10, "acme.io"))
    at = "2025-01-01 00:00:00"
    signals = frame(SIGNAL, ("by_mail", "zzz", "zzz", "ann@acme.io", at), ("by_name", "ann lee", "acme.io", None, at),
                    ("twins", "dee fox", "acme.io", None, at), ("mail_only", "ann lee", "acme.io", "no@acme.io", at),
                    ("other_domain", "ann lee", "beta.io", None, at), ("nameless", None, "acme.io", None, at))
    def matched(**how):
        return rows(ident.match_signals(signals, people, **how).select("signal_id", "person_id", "match_rule"),
                    "signal_id", "person_id")

    fixed = [("by_mail", 1, "work_email"), ("by_name", 1, "name_and_domain"), ("twins", 2, "name_and_domain")]
    assert matched(on_conflict="min_id") == fixed and matched(keys=ident.people_keys(people, "min_id")) == fixed
    assert matched() == [*fixed, ("twins", 3, "name_and_domain")]
    assert rows(ident.signal_conflicts(signals, people)) == [("name_and_domain", "dee fox", "acme.io", 2)]
    assert ident.signal_conflicts(signals.filter("signal_id <> 'twins'"), people).isEmpty()


def test_ambiguous_address_multiplies_unless_the_lowest_is_asked_for(frame):
    email_map = frame("email string; person_id bigint; company_id bigint", ("a@x.io", 3, 30), ("a@x.io", 2, 20), ("b@x.io", 4, 40))
    assert rows(ident.email_lookup(email_map, "min_id"), "email") == [("a@x.io", 2, 20), ("b@x.io", 4, 40)]
    assert ident.email_lookup(email_map).count() == 3


def test_lead_events(frame, contacts):
    email_map = ident.identity_email_map(ident.identity_contacts(contacts))
    fills = frame("email string; submitted_at timestamp", ("ann@gmail.com", "2025-01-02 00:00:00"), ("x@y.z", None))
    mails = frame("email string; event_type string; reply_category string; event_at timestamp",
                  ("ann@acme.io", "reply", "interested", "2025-01-01 00:00:00"),
                  ("ann@acme.io", "reply", None, "2025-01-01 00:00:00"),
                  ("ann@acme.io", "click", "interested", "2025-01-01 00:00:00"))
    got = rows(ident.lead_events(fills, mails, email_map).select("person_id", "lead_source", "company_id"), "lead_source")
    assert got == [(1, "demo_form", 10), (1, "interested_reply", 10)]
    assert ident.lead_events(fills, mails, email_map).filter(F.col("lead_at").isNull()).count() == 0


def test_phones_without_digits_that_would_merge_contacts(frame):
    schema = "contact_id bigint; is_personal_email boolean; phone_key string"
    assert ident.empty_phones(frame(schema, (1, True, ""), (2, True, ""), (3, False, "1"), (4, False, None))).count() == 0
    assert rows(ident.empty_phones(frame(schema, (1, True, ""), (2, False, ""), (3, None, "")))) == [(1, 1)]


def test_phones_multiply_contacts_only_where_matches_outnumber_them(frame):
    from touchledger.operators.identity import multiplying_phones

    def contacts(work, personal, others):
        rows = [("1", False)] * work + [("1", True)] * personal + [(None, None)] * others
        return frame("phone_key string; is_personal_email boolean", *rows)

    assert multiplying_phones(contacts(2, 2, 0)).count() == 0
    assert multiplying_phones(contacts(3, 3, 2)).collect() == [(8, 9.0)]
    assert multiplying_phones(contacts(3, 3, 3)).count() == 0
    assert multiplying_phones(contacts(1, 50, 0)).count() == 0
