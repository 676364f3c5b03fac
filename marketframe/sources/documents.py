"""Account documents: XML groups, allocation profiles and aliases, and delimited account lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import ALLOCATION_TYPE, map_values

_GROUPS = (
    "Group ARRAY<STRUCT<name: STRING, defaultMethod: STRING, "
    "ListOfAccts: STRUCT<Account: ARRAY<STRUCT<acct: STRING>>>>>"
)
_PROFILES = (
    "AllocationProfile ARRAY<STRUCT<name: STRING, type: STRING, "
    "ListOfAllocations: STRUCT<Allocation: ARRAY<STRUCT<acct: STRING, amount: DOUBLE>>>>>"
)
_ALIASES = "AccountAlias ARRAY<STRUCT<account: STRING, alias: STRING>>"


def _parse(df: DataFrame, xml: str, root: str, schema: str) -> DataFrame:
    """The documents parsed; a root tag other than the expected one is an error."""
    tag = F.regexp_extract(F.col(xml), r"^(?:\s|<\?[^>]*\?>|<!--.*?-->)*<([^\s/>]+)", 1)
    wrong = F.raise_error(F.concat(F.lit("Unexpected XML tag: "), tag, F.lit(f" != {root}")))
    checked: Column = F.when(tag == root, F.col(xml)).otherwise(wrong.cast("string"))
    return df.select(F.from_xml(checked, schema).alias("doc"))


def explode_groups(df: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per (group, account)."""
    groups = _parse(df, xml, "ListOfGroups", _GROUPS).select(F.explode("doc.Group").alias("g"))
    return groups.select(
        F.col("g.name").alias("GroupName"),
        F.col("g.defaultMethod").alias("DefaultMethod"),
        F.explode("g.ListOfAccts.Account.acct").alias("Account"),
    )


def explode_profiles(df: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per allocation of each profile, with the profile type named."""
    profiles = _parse(df, xml, "ListOfAllocationProfiles", _PROFILES)
    rows = profiles.select(F.explode("doc.AllocationProfile").alias("p")).select(
        F.col("p.name").alias("AllocationProfileName"),
        map_values(F.col("p.type"), ALLOCATION_TYPE).alias("Type"),
        F.explode("p.ListOfAllocations.Allocation").alias("a"),
    )
    return rows.select("AllocationProfileName", "Type", F.col("a.acct").alias("Account"), F.col("a.amount").alias("Amount"))


def explode_aliases(df: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per alias."""
    aliases = _parse(df, xml, "ListOfAccountAliases", _ALIASES).select(F.explode("doc.AccountAlias").alias("a"))
    return aliases.select(F.col("a.account").alias("Account"), F.col("a.alias").alias("Alias"))


def explode_list(df: DataFrame, column: str, delimiter: str = ",", name: str | None = None) -> DataFrame:
    """Distinct non-blank items of delimited lists. On a stream, repeats are dropped with state."""
    name = name or column
    items = df.select(F.explode(F.split(F.col(column), f"[{delimiter}]")).alias(name))
    return items.filter(F.col(name) != "").dropDuplicates([name])
