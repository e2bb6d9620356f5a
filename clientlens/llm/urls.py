"""URL filter: host-suffix and path-prefix expressions, matched by hash prefix, confirmed by full digest.

A URL is expanded into every suffix of its host that has as many labels as some rule's host, with every prefix
of its path that is as long as some rule's path. Expressions meet rules in an equi-join on the first hex digits of a SHA-256
digest; the full digest confirms. The longest fitting rule decides (ties: longer host, then `block`).

Cases: a null URL or one without `://` has an empty host and path and fits no rule; a repeated row is a row of
its own; an empty table gives no rows; no rules give the default verdict; columns other than the two named are
not looked at; the time for a URL is in proportion to its length, however many labels it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url):
    """Host (A-Z lower-cased) and path columns of a URL column, both empty where there is no `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def expressions(host, path, labels, lengths):
    """Array of structs (expr_host, expr_path): host suffixes of some numbers of labels, path prefixes of some lengths."""
    count = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = F.array(*[F.when(count >= n, F.substring_index(host, ".", -n)) for n in labels])
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    there = lambda x: x.isNotNull()
    pairs = F.transform(
        F.filter(suffixes, there),
        lambda s: F.transform(F.filter(prefixes, there), lambda p: F.struct(s.alias("expr_host"), p.alias("expr_path"))),
    )
    return F.flatten(pairs)


def filter_urls(
    urls: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    prefix_digits: int = 8,
    salts: int = 32,
    few_rules: int = 10_000,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of `urls`.

    `rules` has the columns host, path, action. The different numbers of labels and lengths of paths that rules
    have come to the driver; there are at most as many as the longest host and path have characters. A rule table
    of any size works: Spark broadcasts it below its size limit and otherwise joins by shuffle. Over
    `few_rules` rules, which may be too many to broadcast, each stands in `salts` copies, so that an expression that nearly all
    URLs have, as that of a top-level domain, is met in as many tasks.
    """
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "action"
    ).where("rule_host is not null and rule_path is not null")
    kinds = rules.groupBy(F.size(F.split("rule_host", r"\.")), F.length("rule_path")).agg(F.count("*")).collect()
    labels, lengths = (sorted({r[n] for r in kinds}) for n in (0, 1))
    salts = salts if sum(r[2] for r in kinds) > few_rules else 1
    digest = lambda host, path: F.sha2(F.concat(host, F.lit("\0"), path), 256)
    keyed = rules.withColumn("rule_digest", digest("rule_host", "rule_path"))
    keyed = keyed.withColumn("prefix", F.substr("rule_digest", F.lit(1), F.lit(prefix_digits)))

    host, path = host_and_path(F.col("url"))
    pages = urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row")
    )
    fits = F.when(F.col("host") != "", expressions(F.col("host"), F.col("path"), labels, lengths))
    expanded = pages.select("*", F.explode_outer(fits).alias("e")).select(
        "id", "host", "path", "row", digest("e.expr_host", "e.expr_path").alias("digest")
    )
    expanded = expanded.withColumn("prefix", F.substr("digest", F.lit(1), F.lit(prefix_digits)))
    meet = ["prefix"]
    if salts > 1:
        expanded = expanded.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
        keyed = keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        meet.append("salt")
    # The digest confirms after the prefix has matched; as a value it cannot become a join key of its own.
    confirmed = F.col("digest") == F.col("rule_digest")
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("long"),
        F.length("rule_host").alias("host_long"),
        F.when(F.col("action") == "block", 1).otherwise(0).alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("action"),
    )
    best = (
        expanded.join(keyed, meet, "left")
        .groupBy("row", "id", "host", "path")
        .agg(F.max(F.when(confirmed, rank)).alias("best"))
    )
    return best.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
