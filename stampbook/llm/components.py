"""Connected components of things that are members of groups, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.llm.working import kept


def smallest_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(item, label) with the smallest label that each item reaches through shared groups.

    members: (item, grp); labels: (item, label), one row for each item in members. In turn, each group
    takes its members' smallest label and each member its groups' smallest, both pre-aggregated before
    the shuffle, until no label changes. Items without a group keep their label.
    """
    current = kept(members.select("item").distinct().join(labels, "item").select("item", "label"))
    while True:
        least = members.join(current, "item").groupBy("grp").agg(F.min("label").alias("label"))
        found = members.join(least, "grp").groupBy("item").agg(F.min("label").alias("label"))
        following = kept(current.withColumnRenamed("label", "last").join(found, "item"))
        changed = following.where("label < last").limit(1).count()
        current = following.select("item", "label")
        if not changed:
            break
    reached = current.withColumnRenamed("label", "reached")
    return labels.join(reached, "item", "left").select("item", F.coalesce("reached", "label").alias("label"))
