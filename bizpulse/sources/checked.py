"""Writes that check their rows on the way: bad rows go to quarantine, and too many of them stop the publication."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bizpulse.session import observed
from bizpulse.sources import versions
from bizpulse.sources.lake import write_table
from bizpulse.sources.readers import DEFAULT_FORMAT

#: Column by which good and bad rows are kept apart in a version's folder, and the names of the rules that a bad row breaks.
VALID, BROKEN = "rules_kept", "broken_rules"


class TooManyBadRows(ValueError):
    """A write whose bad rows exceed its limit; `counts` has what was found, `path` the folder that nothing points at."""

    def __init__(self, table: str, counts: Mapping[str, int], path: str):
        super().__init__(f"{table} not published, {counts['bad']} of {counts['rows']} rows break rules: {dict(counts)}")
        self.counts, self.path = dict(counts), path


def checked_write(
    df: DataFrame,
    rules: Mapping[str, Column],
    table: str,
    root: str,
    most_bad: float = 0.0,
    quarantine: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    cluster_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write `df` as a new version of the catalog table `table`, without the rows that break a rule; return the counts.

    `rules` maps names to conditions that a bad row meets; null breaks none. One job reads `df` once, writes good and bad rows
    to folders of their own under `root` and counts `rows`, `bad` and each rule's breaks. If the bad are more than the share
    `most_bad` of all, TooManyBadRows is raised and both tables stay as they were. Otherwise `table` moves to the good rows
    and then `quarantine` (default: `<table>_quarantine`) to the bad ones, which carry the names of the rules they break.
    """
    taken = {VALID, BROKEN} & {c.lower() for c in df.columns}
    if taken or not rules:
        raise ValueError(f"columns {sorted(taken)} are taken" if taken else "no rules given")
    spark = df.sparkSession
    named = [F.when(F.coalesce(bad, F.lit(False)), F.lit(rule)) for rule, bad in rules.items()]
    marked = df.withColumn(BROKEN, F.array_compact(F.array(*named)))
    marked = marked.withColumn(VALID, F.size(BROKEN) == 0)
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(VALID)).alias("bad")]
    counts += [F.count_if(F.array_contains(BROKEN, rule)).alias(f"rule_{i}") for i, rule in enumerate(rules)]
    path = f"{root.rstrip('/')}/{versions.VERSION}{uuid.uuid4().hex}"
    write_table(marked.observe(seen, *counts), path, "errorifexists", [VALID], fmt=fmt, cluster_by=cluster_by)
    got = observed(seen)
    found = {"rows": got.get("rows", 0), "bad": got.get("bad", 0), **{rule: got.get(f"rule_{i}", 0) for i, rule in enumerate(rules)}}
    if found["bad"] > most_bad * found["rows"]:
        raise TooManyBadRows(table, found, path)
    for name, frame, folder, there in (
        (table, df, "true", found["rows"] > found["bad"]),
        (quarantine or f"{table}_quarantine", marked.drop(VALID), "false", found["bad"] > 0),
    ):
        own = f"{path}/{VALID}={folder}"
        if not there:  # a partition without rows has no folder
            write_table(spark.createDataFrame([], frame.schema), own, "errorifexists", fmt=fmt)
        versions._point(spark, name, own, fmt, frame)
    return found
