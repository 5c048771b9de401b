"""Allow and block rules on hosts and path prefixes by a sort-merge range join.

A host becomes a canonical key: its labels in reverse order, each closed by ``\\x01``. A host and all its subdomains are then
exactly the keys in ``[key, key with the last \\x01 raised to \\x02)``, so rules are intervals that nest and never cross. The
rules' ends are swept in order with a stack of the rules that are open; every end becomes a segment that carries the stack.
Urls meet their segment by sorting both together: rows are dealt by a hash of the url, never by host, and every share gets
all segments, whose number is bounded by ``MAX_RULES``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kinweave.llm.text import ascii_lower

MAX_RULES = 5_000
SHARES_PER_PARTITION = 4


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for NULL or without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "\x01"), F.lit("\x01"))


def rule_segments(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(key, stack): from ``key`` up to the next one, the rules in ``stack`` are open, outermost first."""
    table = spark.createDataFrame([(v, h.lower(), p) for v, h, p in rules], "verdict string, host string, path string")
    start = host_key(F.col("host"))
    stop = F.concat(F.expr("substring(lo, 1, length(lo) - 1)"), F.lit("\x02"))
    ends = table.distinct().withColumn("lo", start).withColumn("hi", stop).select(
        F.struct("host", "path", "verdict").alias("rule"), F.explode(F.array(
            F.struct(F.col("lo").alias("key"), F.lit(1).alias("opens")),
            F.struct(F.col("hi").alias("key"), F.lit(0).alias("opens")))).alias("e"))
    line = ends.select("e.key", "e.opens", "rule").agg(F.sort_array(F.collect_list(F.struct("key", "opens", "rule"))).alias("line"))
    swept = line.selectExpr(
        "aggregate(line, "
        " named_struct('stack', slice(transform(line, e -> e.rule), 1, 0),"
        "              'out', slice(transform(line, e -> named_struct('key', e.key, 'stack', array(e.rule))), 1, 0)),"
        " (s, e) -> named_struct("
        "   'stack', if(e.opens = 1, concat(s.stack, array(e.rule)), slice(s.stack, 1, size(s.stack) - 1)),"
        "   'out', concat(s.out, array(named_struct('key', e.key, 'stack',"
        "      if(e.opens = 1, concat(s.stack, array(e.rule)), slice(s.stack, 1, size(s.stack) - 1)))))),"
        " s -> s.out) AS out")
    rows = swept.select(F.posexplode("out").alias("place", "o")).select("place", "o.key", "o.stack")
    return rows.groupBy("key").agg(F.max_by("stack", "place").alias("stack"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", page_id: str = "page_id",
                url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page.

    ``rules``: (verdict, host, path). A rule fits its host and all subdomains when the path starts with the rule's; the longest
    host and path together wins, then the longer host. Without a rule the verdict is ``default`` and ``rule`` is NULL; an
    empty path starts with no rule's path but the empty one. NULL urls and urls without ``://`` have an empty host and path.
    Repeated pages are judged one by one; other columns are ignored.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    spark = pages.sparkSession
    shares = SHARES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select(
        F.pmod(F.xxhash64(F.col(page_id), F.col(url)), F.lit(shares)).alias("share"), F.lit(1).alias("kind"),
        F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
    ).withColumn("key", host_key(F.col("host")))
    segments = rule_segments(spark, rules) if rules else None
    stack = "array<struct<host:string,path:string,verdict:string>>"
    if segments is None:
        swept = urls.withColumn("open", F.lit(None).cast(stack))
    else:
        dealt = segments.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(
            F.col("share").cast("long"), F.lit(0).alias("kind"), "key", "stack")
        both = urls.unionByName(dealt, allowMissingColumns=True)
        before = W.partitionBy("share").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
        swept = both.withColumn("open", F.last("stack", ignorenulls=True).over(before)).where("kind = 1")
    fits = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]) & (
        (F.col("host") == r["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"]))))
    ranked = F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("n"), F.length(r["host"]).alias("h"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"))))
    return swept.withColumn("won", ranked).select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
