"""URL filters: hashed host-suffix and path-prefix expressions against a rule list.

A url gives one expression for each host suffix (the host, and what follows each
dot) with each path prefix of a length that occurs among the rules. Expressions
and rules meet in an equi-join on the first four bytes of their SHA-256; the full
digest then confirms, and of the confirmed rules of a url the longest wins.

Scale: only DataFrame operations. Rules of up to ``broadcast_rules`` (counted
beforehand) are broadcast, then the only shuffle is one pre-aggregated row per
input row; a larger list is joined by the hash prefix with a shuffle, where
adaptive execution splits the prefixes that many urls share. The set of rule path
lengths is bounded by the longest rule path.

Defined cases: a null url, or one without ``://``, has an empty host and path and
gets the default verdict; an empty rule list gives every url the default; a rule
listed twice counts once, and of an allow and a block for the same expression the
block wins; repeated rows stay repeated; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT_VERDICT = "allow"
BROADCAST_RULES = 100_000


def url_host(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and what follows each of its dots; an empty host has none."""
    labels = F.split(host, r"\.", -1)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))


def path_prefixes(path: Column, lengths: Sequence[int]) -> Column:
    """Prefixes of the path of those lengths that it has."""
    return F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]).cast("array<string>"),
        lambda p: p.isNotNull())


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    keys: Sequence[str] = ("page_id",),
    url: str = "url",
    default: str = DEFAULT_VERDICT,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """One row per input row: a struct ``key`` of the key columns, host, path, rule
    (host and path of the winning rule, else null), verdict.

    ``rules`` has host, path, verdict (allow or block).
    """
    listed = (
        rules.where("host is not null and path is not null and verdict is not null")
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("digest", F.sha2(F.concat_ws("\n", "host", "path"), 256))
        .select(F.substring("digest", 1, 8).alias("prefix"), F.length("path").alias("n"),
                F.struct("digest", F.concat("host", "path").alias("rule"), "verdict").alias("listed"))
    )
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.collect_set("n").alias("lengths")).first()
    # the few rules that share a hash prefix stand in one row, so the join adds no rows
    listed = listed.groupBy("prefix").agg(F.collect_list("listed").alias("listed"))
    if facts["n"] <= broadcast_rules:
        listed = F.broadcast(listed)
    key = F.struct(*[F.col(c) for c in keys])
    parsed = urls.select(key.alias("key"), F.col(url).alias("_url")).withColumns(
        {"host": url_host(F.col("_url")), "path": url_path(F.col("_url"))})
    pairs = F.flatten(F.transform(
        host_suffixes(F.col("host")),
        lambda h: F.transform(path_prefixes(F.col("path"), sorted(facts["lengths"])), lambda p: F.concat_ws("\n", h, p))))
    opened = parsed.select("key", "host", "path", F.posexplode_outer(pairs).alias("pos", "expression")).withColumn(
        "digest", F.sha2("expression", 256)).withColumn("prefix", F.substring("digest", 1, 8)).drop("expression")
    met = opened.join(listed, "prefix", "left")
    confirmed = F.filter("listed", lambda r: r["digest"] == F.col("digest"))[0]
    judged = met.groupBy("key", "host", "path").agg(
        F.max(F.when(confirmed.isNotNull(), F.struct(
            F.length(confirmed["rule"]).alias("n"), confirmed["rule"].alias("rule"), confirmed["verdict"].alias("verdict")))).alias("best"),
        F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0)).alias("copies"),
    )
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "key", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
