"""Captures judged by dated URL lists, as the lists stood when each page was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SCOPES = ("domain", "host", "prefix")


def validity(entries: DataFrame) -> DataFrame:
    """Dated entries as validity intervals: ``list``, ``verdict``, ``scope``, ``pattern``, ``valid_from`` and
    ``valid_to`` (exclusive, null while open).

    An entry has ``list``, ``verdict`` (``block`` or ``allow``), ``scope`` (``domain``: the host and all below it;
    ``host``; ``prefix``: host and path, cut at a slash), ``pattern``, ``action`` (``add`` or ``remove``) and ``at``.
    An entry holds from its ``add`` to the next ``remove``. Adding what is listed and removing what is not change
    nothing; at one instant a ``remove`` wins. Entries with a null in any of these columns, or an unknown scope, are
    left out. Patterns are compared in lower case as far as the host goes.
    """
    names = ["list", "verdict", "scope", "pattern"]
    known = entries.dropna(subset=[*names, "action", "at"]).where(F.col("scope").isin(*SCOPES))
    host = F.lower(F.substring_index("pattern", "/", 1))
    known = known.withColumn("pattern", F.concat(host, F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)")))
    # One state per instant, with map-side combine: repeated entries leave here.
    states = known.groupBy(*names, "at").agg(F.max(F.col("action") == "remove").alias("off"))
    order = Window.partitionBy(*names).orderBy("at")
    changes = states.withColumn("was", F.lag("off").over(order)).where("was IS NULL AND NOT off OR was <> off")
    spans = changes.withColumn("valid_to", F.lead("at").over(order)).where("NOT off")
    return spans.select(*names, F.col("at").alias("valid_from"), "valid_to")


def host_of(url: Column) -> Column:
    """Lower-case host of an http or https address, without user, port and last dot; null where there is none."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^[^/?#]*//[^/?#]*([^?#]*)", 1)


def patterns_of(host: Column, path: Column) -> Column:
    """Every pattern that could list the address: the host, each domain above it down to the last label, and each
    prefix of the path that ends before or at a slash."""
    labels = F.split(host, r"\.")
    steps = F.split(path, "/")
    pattern = lambda scope, text: F.struct(F.lit(scope).alias("scope"), text.alias("pattern"))
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: pattern("domain", F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    # A path "/a/b" has the steps "", a and b: prefixes host, host/, host/a, host/a/, host/a/b.
    plain = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: pattern("prefix", F.concat(host, F.array_join(F.slice(steps, F.lit(1), i), "/")))
    )
    closed = F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1), lambda i: pattern("prefix", F.concat(host, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/")))
    )
    return F.array_distinct(F.concat(F.array(pattern("host", host)), domains, plain, F.when(F.size(steps) > 1, closed).otherwise(F.slice(plain, 1, 0))))


def judge(captures: DataFrame, entries: DataFrame, url_column: str = "url", time_column: str = "fetched_at") -> DataFrame:
    """Adds to every capture ``host``, ``n_active`` (entries that listed its address when it was fetched), and
    ``verdict`` with the deciding ``list``, ``scope`` and ``pattern``.

    The longest pattern decides; of equal ones a prefix before a host before a domain, then ``allow`` before
    ``block``, then the smaller list name. ``verdict`` is ``none`` where nothing is active: also for a null or
    malformed address or a null time. Rows stay, repeated ones too; columns of these names are replaced.

    Judgement is by distinct (address, time), so repeated captures are judged once. Candidate patterns are
    exploded (their number is bounded by the address) and meet the intervals in an equality join whose hot keys
    (a large host) Spark's skew join can split; the interval test keeps at most one span of each entry.
    """
    new = ["host", "n_active", "verdict", "list", "scope", "pattern"]
    own = captures.drop(*[c for c in new if c in captures.columns])
    url, time = F.col(url_column).alias("_url"), F.col(time_column).alias("_time")
    distinct = own.select(url, time).distinct().where(F.col("_time").isNotNull()).withColumn("_host", host_of(F.col("_url"))).where("_host IS NOT NULL")
    asked = distinct.select("_url", "_time", F.inline(patterns_of(F.col("_host"), path_of(F.col("_url")))))
    spans = validity(entries)
    active = asked.join(spans, ["scope", "pattern"]).where("valid_from <= _time AND (valid_to IS NULL OR _time < valid_to)")
    place = F.when(F.col("scope") == "prefix", 0).when(F.col("scope") == "host", 1).otherwise(2)
    rank = [(-F.length("pattern")).alias("length"), place.alias("place"), (F.col("verdict") != "allow").alias("blocks")]
    best = active.groupBy("_url", "_time").agg(
        F.count("*").alias("n_active"), F.min(F.struct(*rank, "list", "scope", "pattern", "verdict")).alias("b")
    )
    best = best.select("_url", "_time", "n_active", "b.verdict", "b.list", "b.scope", "b.pattern")
    keyed = own.withColumn("_url", F.col(url_column)).withColumn("_time", F.col(time_column))
    return keyed.join(best, ["_url", "_time"], "left").select(
        *own.columns, host_of(F.col(url_column)).alias("host"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"), F.coalesce("verdict", F.lit("none")).alias("verdict"), "list", "scope", "pattern",
    )
