"""What plans of larger tables hang on: steps worked out once, only the fields and tables that a query needs."""

import pytest
from pyspark.sql import functions as F

from confluo.functions import phones
from confluo.operators import projection, survivorship
from confluo.plans import candidates, queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_phone_steps_are_worked_out_once(spark):
    said = plan(spark.createDataFrame([("+1 415 555 0132",)], "v string").select(phones.normalize_phone(F.col("v"))))
    assert said.count("regexp_replace(") < 20


def test_contacts_leave_orders_unread(spark):
    assert "o_orderkey" not in plan(candidates.contacts(spark, SF)) and "o_orderkey" in plan(candidates.candidates(spark, SF))


@pytest.mark.parametrize("config", ["DEFAULT", "CARD", "SUBSET"])
def test_named_fields_of_profiles(spark, config):
    """Profiles of the fields that a projection shows are those of whole profiles, and hold no other."""
    own, fields = candidates.members(spark, SF), projection.fields_shown(getattr(queries, config))
    some = survivorship.fuse(own.select("rid", "candidate_id", *survivorship.fields_read(fields)), fields)
    assert set(some.columns) == set(fields)
    key = lambda r: r["candidate_id"]
    assert sorted(some.collect(), key=key) == sorted(survivorship.fuse(own).select(*some.columns).collect(), key=key)


def test_projects_are_dealt_out(spark):
    """The customer table has few splits, reading a project is dear."""
    assert "RepartitionByExpression" in plan(queries.project_segments(spark, SF))


def test_fields_that_toggles_hide_are_not_worked_out():
    shown = [{"path": "candidate_id"}, {"path": "skills"}, {"path": "overall_confidence"}]
    assert projection.fields_shown(projection.Config.of({"fields": shown})) == ["candidate_id", "skills"]
    assert set(projection.fields_shown(projection.Config.of({"fields": shown, "include_confidence": True}))) == {"candidate_id", "skills", "overall_confidence"}


def test_named_single_values(spark):
    own = candidates.members(spark, SF)
    one = survivorship.scalars(own.drop("headline", "location"), ["years"]).select("candidate_id", "n", "years")
    assert sorted(one.collect()) == sorted(survivorship.scalars(own).select("candidate_id", "n", "years").collect())


def test_entries_are_worked_out_once_and_kinds_kept_apart(spark):
    """No filter works the entries out for their number alone, and no list of all kinds is searched for each column."""
    said = survivorship.fuse(candidates.members(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "size(concat(" not in said and "filter(all" not in said and "array_sort(" not in said.replace("sort_array(", "")


def test_contacts_are_worked_out_once(spark):
    """Every branch of an identity reads what is written of them, none the customer table."""
    for df in (candidates.contacts(spark, SF), candidates.components(spark, SF), queries.incremental_merge(spark, SF)):
        assert df.inputFiles() and not any("customer" in f for f in df.inputFiles())
