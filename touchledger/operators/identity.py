"""Identity resolution: contacts -> people, email -> person, cookie -> person, signal -> person.

The person's account is found once, while contacts are merged, and travels with every mapping. So a touch
needs one join to reach both its person and its account.

A phone, address or name that belongs to several people breaks a contract. ``on_conflict`` decides what a join on
such a key does: ``fanout``, the default, returns every match; ``min_id`` keeps the lowest person. Before contacts
are joined at all, a nightly run checks that no phones, those without a digit among them, multiply them, and every ambiguous
key before it builds any touches, so a key that very many people share stops it instead of multiplying rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lowest(df: DataFrame, keys: list[str], on_conflict: str) -> DataFrame:
    """One person and account per key, or all of them."""
    if on_conflict == "fanout":
        return df
    if on_conflict != "min_id":
        raise ValueError(f"unknown on_conflict: {on_conflict}")
    return df.groupBy(*keys).agg(F.min("person_id").alias("person_id"),
                                 F.min_by("company_id", "person_id").alias("company_id"))


def phone_owners(contacts: DataFrame, on_conflict: str = "fanout") -> DataFrame:
    """Phone -> work contact that personal contacts with this phone belong to."""
    owners = (contacts.filter(~F.col("is_personal_email") & F.col("phone_key").isNotNull())
              .select("phone_key", F.col("contact_id").alias("person_id"), "company_id"))
    return (_lowest(owners, ["phone_key"], on_conflict)
            .withColumnsRenamed({"person_id": "owner_id", "company_id": "owner_company"}))


def identity_contacts(contacts: DataFrame, on_conflict: str = "fanout", owners: DataFrame | None = None) -> DataFrame:
    """Contact -> person: a personal-email contact becomes the work contact with the same phone.

    Adds ``company_id``, the account of the person (not of the contact). ``owners`` takes ``phone_owners`` as a written table: with a scan
    on both sides adaptive execution can split a phone that very many contacts share.
    """
    owners = phone_owners(contacts, on_conflict) if owners is None else owners
    # Only personal contacts look for an owner; the others skip the join and its shuffle.
    personal = (contacts.filter(F.col("is_personal_email")).select("contact_id", "email", "phone_key", "company_id")
                .join(owners, "phone_key", "left"))
    matched = F.col("owner_id").isNotNull()
    resolved = personal.select(
        "contact_id", "email",
        F.coalesce("owner_id", "contact_id").alias("person_id"),
        F.when(matched, "phone_match").otherwise("unmatched_personal").alias("match_rule"),
        F.when(matched, F.col("owner_company")).otherwise(F.col("company_id")).alias("company_id"),
    )
    own = (contacts.filter(~F.coalesce("is_personal_email", F.lit(False)))
           .select("contact_id", "email", F.col("contact_id").alias("person_id"),
                   F.lit("self").alias("match_rule"), "company_id"))
    return own.unionByName(resolved)


def phone_conflicts(contacts: DataFrame) -> DataFrame:
    """Phones of personal contacts that more than one work contact owns: the merge is ambiguous there."""
    personal = F.col("is_personal_email")
    return (contacts.filter(F.col("phone_key").isNotNull())
            .groupBy("phone_key")
            .agg(F.count_if(~personal).alias("work_contacts"), F.count_if(personal).alias("personal_contacts"))
            .filter((F.col("work_contacts") > 1) & (F.col("personal_contacts") > 0)))


def multiplying_phones(contacts: DataFrame) -> DataFrame:
    """One row if phones of several work contacts would give more rows to personal contacts than there are contacts."""
    personal, several = F.col("is_personal_email"), F.col("phone_key").isNotNull() & (F.col("work_contacts") > 1)
    groups = contacts.groupBy("phone_key").agg(
        F.count(F.lit(1)).alias("contacts"), F.count_if(~personal).alias("work_contacts"),
        F.count_if(personal).alias("personal_contacts"))
    matches = F.when(several, F.col("work_contacts").cast("double") * F.col("personal_contacts"))
    return groups.agg(F.sum("contacts").alias("contacts"), F.sum(matches).alias("matches")).filter("matches > contacts")


def empty_phones(contacts: DataFrame) -> DataFrame:
    """One row if phones without a digit would merge personal contacts into work contacts, none otherwise."""
    personal = F.col("is_personal_email")
    return (contacts.filter(F.col("phone_key") == "")
            .agg(F.count_if(~personal).alias("work_contacts"), F.count_if(personal).alias("personal_contacts"))
            .filter((F.col("work_contacts") > 0) & (F.col("personal_contacts") > 0)))


def identity_people(id_contacts: DataFrame, contacts: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per person with an account, described by the person's own contact.

    A person's own contact is the one that resolved to itself, so no distinct is needed.
    """
    persons = id_contacts.filter((F.col("person_id") == F.col("contact_id")) & F.col("company_id").isNotNull())
    described = contacts.select(
        F.col("contact_id").alias("person_id"), F.col("email").alias("work_email"), "full_name_key", "job_title",
        "company_id", "created_at")
    domains = companies.select("company_id", F.col("domain").alias("company_domain"))
    return (persons.select("person_id").join(described, "person_id").join(domains, "company_id", "left")
            .select("person_id", "work_email", "full_name_key", "job_title", "company_id", "company_domain",
                    "created_at"))


def identity_email_map(id_contacts: DataFrame) -> DataFrame:
    """Every known email address -> person and account; merged personal addresses included."""
    return (id_contacts.filter(F.col("company_id").isNotNull())
            .select("email", "person_id", "company_id").distinct())


def email_lookup(email_map: DataFrame, on_conflict: str = "fanout") -> DataFrame:
    """The address map as joins use it. An ambiguous address breaks the uniqueness of ``identity_email_map``."""
    return _lowest(email_map, ["email"], on_conflict)


def identity_client_map(form_fills: DataFrame, email_map: DataFrame) -> DataFrame:
    """Cookie -> person, learned from form fills; the lowest person id wins.

    Fills are reduced to one row per cookie and address before the join, so a cookie or address that
    submits over and over does not become a hot key.
    """
    seen = form_fills.groupBy("client_id", "email").agg(F.min("submitted_at").alias("submitted_at"))
    return (seen.join(email_map, "email").groupBy("client_id")
            .agg(F.min("person_id").alias("person_id"),
                 F.min("submitted_at").alias("first_identified_at"),
                 F.min_by("company_id", "person_id").alias("company_id")))


def people_keys(people: DataFrame, on_conflict: str = "fanout") -> DataFrame:
    """What a signal can be matched by: a person's work email, or name and company domain."""
    def rule(name: str, key: str, domain):
        return F.struct(F.lit(name).alias("match_rule"), F.col(key).alias("match_key"), domain.alias("match_domain"))

    keys = people.select("person_id", "company_id", F.inline(F.array(
        rule("work_email", "work_email", F.lit("")), rule("name_and_domain", "full_name_key", F.col("company_domain")))))
    known = keys.filter(F.col("match_key").isNotNull() & F.col("match_domain").isNotNull())
    return _lowest(known, ["match_rule", "match_key", "match_domain"], on_conflict)


def _signal_keys(signals: DataFrame) -> DataFrame:
    by_email = F.col("email").isNotNull()
    return signals.select(
        "signal_id", "detected_at",
        F.when(by_email, "work_email").otherwise("name_and_domain").alias("match_rule"),
        F.coalesce("email", "full_name_key").alias("match_key"),
        F.when(by_email, "").otherwise(F.col("company_domain")).alias("match_domain"))


def match_signals(signals: DataFrame, people: DataFrame, on_conflict: str = "fanout",
                  keys: DataFrame | None = None) -> DataFrame:
    """Signal -> person: by work email when the signal has one, else by name and company domain.

    A signal follows exactly one rule, so both rules run as one equi-join on the rule and its key instead of
    a join on an OR. ``keys`` takes ``people_keys`` as a written table.
    """
    keys = people_keys(people, on_conflict) if keys is None else keys
    return (_signal_keys(signals).join(keys, ["match_rule", "match_key", "match_domain"])
            .select("signal_id", "detected_at", "person_id", "company_id", "match_rule"))


def signal_conflicts(signals: DataFrame, people: DataFrame) -> DataFrame:
    """Keys that signals use and that more than one person has: the match is ambiguous there."""
    on = ["match_rule", "match_key", "match_domain"]
    shared = (people_keys(people, "fanout").groupBy(*on).agg(F.count(F.lit(1)).alias("people"))
              .filter(F.col("people") > 1))
    return shared.join(_signal_keys(signals).select(*on).distinct(), on, "left_semi")


def lead_events(form_fills: DataFrame, email_events: DataFrame, email_map: DataFrame) -> DataFrame:
    """Moments a person became a lead: a demo form or an interested reply. One join serves both feeds."""
    forms = form_fills.select("email", F.col("submitted_at").alias("lead_at"),
                              F.lit("demo_form").alias("lead_source"))
    replies = (email_events
               .filter((F.col("event_type") == "reply") & (F.col("reply_category") == "interested"))
               .select("email", F.col("event_at").alias("lead_at"), F.lit("interested_reply").alias("lead_source")))
    return (forms.unionByName(replies).join(email_map, "email")
            .select("person_id", "lead_at", "lead_source", "company_id"))
