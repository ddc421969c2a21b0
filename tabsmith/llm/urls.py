"""op3: URL filter by a sort-merge range join.

A host is reversed into a canonical key (``www.example.net`` -> ``net.example.www.``),
so a rule's host and its subdomains are one interval of keys. Page keys and rule
intervals are cut at the same split points into key ranges; a rule goes to every range
that its interval meets. Each range is sorted once and swept: rules are pushed on a
stack where their interval begins and popped where it ends, so the stack holds exactly
the nested rules that cover the current key. The path test and the choice of the longest
rule look at the stack only.

Split points come from a bounded sample of the keys, salted with the page id, so that
one host (or one url) that holds a third of all pages is cut into several ranges.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm.common import input_bytes, table

# fixed values: (verdict, host, path)
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
DEFAULT_VERDICT = "allow"
SAMPLE_ROWS = 16_384
PAGES_PER_RANGE = 250_000


def host_and_path(url) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def reversed_host(host) -> F.Column:
    """Labels in reverse order, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _rule_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def _after(prefix: str) -> str:
    """The least string above every string that starts with ``prefix`` (which ends in a dot)."""
    return prefix[:-1] + chr(ord(prefix[-1]) + 1)


def rule_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    rows = [(_rule_key(h), _after(_rule_key(h)), p, h + p, v) for v, h, p in rules]
    return spark.createDataFrame(rows, "lo string, hi string, rule_path string, rule string, rule_verdict string")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over sorted rows: rules (kind 0) enter the stack, pages (kind 1) read it.
    Ranges follow one another within a task; a new range starts with an empty stack."""
    stack: list[tuple[str, str, str, str]] = []
    current = None
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in ("part", "sort_key", "kind", "hi", "path", "rule", "rule_verdict")}
        rules, verdicts, keep = [], [], []
        for i, part in enumerate(cols["part"]):
            key = cols["sort_key"][i]
            if part != current:
                current, stack = part, []
            while stack and stack[-1][0] <= key:
                stack.pop()
            if cols["kind"][i] == 0:
                stack.append((cols["hi"][i], cols["path"][i], cols["rule"][i], cols["rule_verdict"][i]))
                continue
            path, best = cols["path"][i], None
            for _, rule_path, rule, verdict in stack:
                if path.startswith(rule_path) and (best is None or len(rule) >= len(best[0])):
                    best = (rule, verdict)
            keep.append(i)
            rules.append(best[0] if best else None)
            verdicts.append(best[1] if best else DEFAULT_VERDICT)
        kept = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [kept.column("page_id"), kept.column("host"), kept.column("path"),
             pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names=["page_id", "host", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    Null urls and urls without ``://`` have empty host and path, fit no rule and get the
    default verdict. Repeated rows and null ids are judged row by row. Of rules equally
    long, the one later in key order wins. An empty table gives no rows.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    salt = F.hex(F.xxhash64("page_id", "path"))
    rows = rows.withColumn("sort_key", reversed_host(F.col("host"))).withColumn("cut_key", F.concat("sort_key", F.lit("\u0001"), salt))

    # bounded: at most about SAMPLE_ROWS keys, chosen by hash so that reruns agree
    n_ranges = max(1, min(4096, input_bytes(pages) // (PAGES_PER_RANGE * 64)))
    n_ranges = max(n_ranges, min(12, int(spark.conf.get("spark.sql.shuffle.partitions", "12"))))
    count = rows.count()
    step = max(1, -(-count // SAMPLE_ROWS))
    sample = rows.where(F.pmod(F.xxhash64("cut_key"), F.lit(step)) == 0).select("cut_key")
    keys = [r[0] for r in sample.orderBy("cut_key").collect()]
    points = sorted({keys[i * len(keys) // n_ranges] for i in range(1, n_ranges)}) if keys else []
    cuts = F.array(*[F.lit(p) for p in points]) if points else F.array().cast("array<string>")

    def range_of(key):
        return F.size(F.filter(cuts, lambda p: p <= key)).cast("int")

    paged = rows.select(range_of(F.col("cut_key")).alias("part"), "sort_key", F.lit(1).alias("kind"),
                        F.lit(None).cast("string").alias("hi"), "page_id", "host", "path",
                        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("rule_verdict"))
    ruled = rules.select(
        F.explode(F.sequence(range_of(F.col("lo")), range_of(F.col("hi")))).alias("part"),
        F.col("lo").alias("sort_key"), F.lit(0).alias("kind"), "hi", F.lit(None).cast("long").alias("page_id"),
        F.lit(None).cast("string").alias("host"), F.col("rule_path").alias("path"), "rule", "rule_verdict")
    page_type = dict(paged.dtypes)["page_id"]
    events = paged.unionByName(ruled.withColumn("page_id", F.col("page_id").cast(page_type)))
    # hashing the range number keeps whole ranges together; each task sorts its ranges once.
    # Wider intervals first among equal starts, so that the stack nests.
    swept = events.repartition(max(n_ranges, 1), "part").sortWithinPartitions(
        "part", "sort_key", "kind", F.col("hi").desc())
    return swept.mapInArrow(_sweep, f"page_id {page_type}, host string, path string, rule string, verdict string")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_frame(spark))


SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(v, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, host, path, (SELECT arg_max({'rule': rh || rp, 'v': v}, length(rh || rp)) FROM r
    WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS hit FROM h)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.v, 'allow') AS verdict FROM m
"""
