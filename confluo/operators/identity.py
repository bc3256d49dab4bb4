"""Identities: records that share an e-mail address or a phone number, directly or over others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import settle
from .components import connected_components


def contact_keys(records: DataFrame, key: str = "rid") -> DataFrame:
    """(key, kind, value): one row for each contact of a record; e-mails and phones are apart."""
    mail = records.select(key, F.lit("email").alias("kind"), F.explode("emails").alias("value"))
    phone = records.select(key, F.lit("phone").alias("kind"), F.explode("phones").alias("value"))
    return mail.unionByName(phone).where("value is not null and value <> ''")


def contact_classes(records: DataFrame, key: str = "rid") -> DataFrame:
    """(kind, value, key, representative, n): the records of each contact with its smallest record and their number.

    Two records match if they share a class; a contact of n records takes n rows, not n squared.
    """
    keys = contact_keys(records, key).distinct()
    least = keys.groupBy("kind", "value").agg(F.min(key).alias("representative"), F.count(F.lit(1)).alias("n")).select(F.struct("kind", "value").alias("k"), "representative", "n")
    # A struct as key has both sides exchanged for this join alone, so adaptive execution can split a hot contact.
    return keys.select(F.struct("kind", "value").alias("k"), key).join(least, "k").select("k.kind", "k.value", key, "representative", "n")


def contact_match(left: DataFrame, right: DataFrame, key: str = "rid", max_degree: int = 1000) -> DataFrame:
    """(left, right) of the records that share a contact: an equi-join on the contact, never one on the arrays.

    Pairs grow with the square of a contact's records: one of more than ``max_degree`` is an
    error here, and ``contact_classes`` the way that has no bound.
    """
    a = contact_keys(left, key).withColumnRenamed(key, "left")
    b = contact_keys(right, key).withColumnRenamed(key, "right")
    n = F.max("n").alias("n")
    most = max(x.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).agg(n).first()["n"] or 0 for x in (a, b))
    if most > max_degree:
        raise ValueError(f"a contact has {most} records; use contact_classes")
    return a.join(b, ["kind", "value"]).select("left", "right").distinct()


def identity_components(records: DataFrame, key: str = "rid", max_key_degree: int | None = None) -> DataFrame:
    """(key, component) for every record; component is the smallest key reachable, the record's own if it has no contact.

    Each record is linked to the smallest record of each of its contacts, not to all of
    them, so a contact that many share makes a star of as many links. Contacts of more than
    ``max_key_degree`` records (placeholders) are left out if it is given.
    """
    keys = contact_keys(records, key)
    least = keys.groupBy("kind", "value").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("n"))
    if max_key_degree:
        least = least.where(F.col("n") <= max_key_degree)
    hub = least.select(F.struct("kind", "value").alias("k"), "least")
    links = keys.select(F.struct("kind", "value").alias("k"), key).join(hub, "k").select(F.col(key).alias("a"), F.col("least").alias("b"))
    found = connected_components(links).withColumnRenamed("node", key)
    return records.select(key).distinct().join(found, key, "left").select(key, F.coalesce("component", key).alias("component"))


def candidate_id(component) -> F.Column:
    """A key that depends on the identity's smallest record alone."""
    return F.sha2(component.cast("string"), 256)


def membership(records: DataFrame, key: str = "rid", max_key_degree: int | None = None) -> DataFrame:
    """(key, candidate_id)."""
    found = identity_components(records, key, max_key_degree)
    return found.select(key, candidate_id(F.col("component")).alias("candidate_id"))


def records_of(records: DataFrame, members: DataFrame, candidates: DataFrame, key: str = "rid") -> DataFrame:
    """The records of the given candidates."""
    return records.join(members.join(candidates.select("candidate_id"), "candidate_id", "left_semi"), key)


def merge_increment(old: DataFrame, new: DataFrame, records: DataFrame, key: str = "rid") -> DataFrame:
    """(key, component) of all records after ``new`` ones came to those with components in ``old``.

    Only identities that share a contact with a new record are joined anew: old components
    and new records are nodes, linked over contacts. A record that is known already changes
    nothing, so a batch may be given twice.
    """
    fresh = settle(new.select(key, "emails", "phones").join(old.select(key), key, "left_anti"), "fresh")
    known = contact_keys(records.join(old.select(key), key, "left_semi"), key).join(old, key).select("kind", "value", F.col("component").alias("node"))
    keys = known.unionByName(contact_keys(fresh, key).select("kind", "value", F.col(key).alias("node")))
    touched = keys.join(contact_keys(fresh, key).select("kind", "value").distinct(), ["kind", "value"], "left_semi")
    least = touched.groupBy("kind", "value").agg(F.min("node").alias("least")).select(F.struct("kind", "value").alias("k"), "least")
    links = touched.select(F.struct("kind", "value").alias("k"), "node").join(least, "k").select(F.col("node").alias("a"), F.col("least").alias("b"))
    moved = connected_components(links).withColumnRenamed("component", "to")
    every = old.unionByName(fresh.select(key, F.col(key).alias("component")))
    return every.join(moved, every["component"] == moved["node"], "left").select(key, F.coalesce("to", "component").alias("component"))
