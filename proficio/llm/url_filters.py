"""URL allow and block rules by host-suffix and path-prefix expressions.

Each URL is cut into host and path; every suffix of the host at a label
boundary is combined with every prefix of the path that is as long as some
rule's path.  The expressions meet the rules in an equi-join on the first 32
bits of a digest; the full SHA-256 then confirms the match, and the longest
rule wins.  Work is done once per distinct (host, path), so a URL or host that
holds a third of the pages is judged once.

Defined cases: a null URL or one without ``://`` has an empty host and path
and matches nothing; of equally long rules the one with the longer host wins,
then block before allow; unmatched URLs get the default verdict ``allow``
(the list blocks, it does not admit).  An empty rule table leaves every page
at the default; repeated pages are judged alike, each with its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proficio.llm._util import lower_ascii

DEFAULT_VERDICT = "allow"
#: host, path, verdict
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path up to ``? #``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def host_suffixes(host: Column) -> Column:
    """The host and each of its parent domains (``a.b.c``, ``b.c``, ``c``)."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_prefixes(path: Column, lengths: list[int]) -> Column:
    """The prefixes of the path that have one of the given lengths."""
    fit = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path))
    return F.transform(fit, lambda n: F.substring(path, F.lit(1), n))


def digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def short_hash(full: Column) -> Column:
    """The first 32 bits of a hex digest, as a number."""
    return F.conv(F.substring(full, 1, 8), 16, 10).cast("bigint")


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules`` has host, path and verdict.  The rules' path lengths go to the
    driver: at most as many numbers as the longest rule has characters.
    The join strategy is the planner's, by the rule table's size.
    """
    keyed_rules = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
                   .select(F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"),
                           F.col("verdict").alias("rule_verdict"))
                   .withColumn("full", digest(F.concat_ws("\0", F.expr("left(rule, host_len)"),
                                                          F.expr("substring(rule, host_len + 1)"))))
                   .withColumn("short", short_hash(F.col("full"))))
    lengths = sorted(r[0] for r in rules.where("path is not null")
                     .select(F.length("path")).distinct().collect())
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    if not lengths:
        return parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    expressions = (parts.where("host <> ''").select("host", "path").distinct()
                   .withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
                   .withColumn("prefix", F.explode(path_prefixes(F.col("path"), lengths)))
                   .withColumn("expr_full", digest(F.concat_ws("\0", "suffix", "prefix")))
                   .withColumn("short", short_hash(F.col("expr_full"))))
    confirmed = expressions.join(keyed_rules, "short").where(F.col("expr_full") == F.col("full"))
    rank = F.struct(F.length("rule"), F.col("host_len"), F.col("rule_verdict"))  # 'block' > 'allow'
    best = (confirmed.groupBy("host", "path")
            .agg(F.max_by(F.struct("rule", "rule_verdict"), rank).alias("won")))
    return (parts.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict")))
