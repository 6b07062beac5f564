"""URL filtering against dated lists.

A list is a table of dated entries: from ``listed_at`` on, ``domain`` (and all
below it) has the given ``action``: ``block``, ``allow`` or ``remove``.  An
entry holds until the domain's next one, so entries become validity intervals.
A capture is judged by the entries active when it was fetched: of all active
ones for the host and the domains above it, the most specific decides.

Both steps work per time bucket.  Interval ends come from the next entry in the
bucket, or else from the first entry of the domain's next bucket.  A capture
meets, by a join on (domain, bucket), the intervals that start in its bucket and
the one that was open before it, which a window over a domain's buckets carries
to those that hold captures.  So an interval costs nothing in the buckets
between, however long it stays open, and neither a domain with a long list
history nor a host with a third of all captures ends up in one task (Spark
splits the join's hot keys; no window holds more than a domain's bucket, or one
row for each of its buckets).

Times count to the microsecond.  Of a host, letter case and one dot at the end
do not matter; an IPv6 address in brackets is a host without domains above it.

Defined results: a null or unreadable URL, a host of over 253 characters (no
host name can be) or a null fetch time gives ``none``; entries with a null
domain, time or unknown action are ignored; of entries of a domain at the same
time ``block`` beats ``remove`` beats ``allow``; repeated captures give
repeated rows; an empty list gives ``none`` everywhere; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET_MICROS = 30 * 86_400 * 1_000_000
MAX_HOST = 253
# Actions, the strongest last.
ACTIONS = ("allow", "remove", "block")


def host_of(url):
    """Lower-case host of an absolute URL, null if there is none."""
    h = _domain(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]+)", 1))
    return F.when((F.length(h) > 0) & (F.length(h) <= MAX_HOST), h)


def _domain(name):
    return F.regexp_replace(F.lower(name), r"\.\z", "")


def domains_of(host):
    """The host and every domain above it."""
    labels = F.when(host.startswith("["), F.array(host)).otherwise(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _bucket(micros):
    return F.floor(micros / BUCKET_MICROS)


def _micros(col):
    return F.unix_micros(F.col(col).cast("timestamp"))


def intervals(entries: DataFrame, domain_col: str = "domain", action_col: str = "action",
              time_col: str = "listed_at") -> DataFrame:
    """Entries to (domain, action, since, until) in epoch microseconds; ``until`` is
    null for a domain's last entry.  ``remove`` ends an interval and starts
    none."""
    strength = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col(action_col))
    e = (entries.select(_domain(F.col(domain_col)).alias("domain"), strength.alias("s"), _micros(time_col).alias("since"))
         .filter("domain is not null and since is not null and s > 0")
         .groupBy("domain", "since").agg(F.max("s").alias("s"))
         .withColumn("bucket", _bucket(F.col("since"))))
    inside = Window.partitionBy("domain", "bucket").orderBy("since")
    firsts = e.groupBy("domain", "bucket").agg(F.min("since").alias("first"))
    later = firsts.select("domain", "bucket", F.lead("first").over(
        Window.partitionBy("domain").orderBy("bucket")).alias("next_first"))
    return (e.withColumn("next", F.lead("since").over(inside)).join(later, ["domain", "bucket"])
            .select("domain", F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), F.col("s").cast("int"))
                    .alias("action"), "since", F.coalesce("next", "next_first").alias("until"))
            .filter(F.col("action") != "remove"))


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetched_at") -> DataFrame:
    """Per capture: ``page_id``, ``host``, ``decision`` (block, allow, none),
    ``rule`` (the deciding domain) and ``rule_since`` (epoch seconds)."""
    c = captures.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        _micros(time_col).alias("at"))
    # captures of one host at one time are judged once
    asked = c.filter("host is not null and at is not null").select("host", "at").distinct()
    seen = (asked.withColumn("domain", F.explode(domains_of(F.col("host"))))
            .withColumn("bucket", _bucket(F.col("at"))))
    held = intervals(entries).withColumn("bucket", _bucket(F.col("since")))
    lasts = held.groupBy("domain", "bucket").agg(F.max(F.struct("since", "until", "action")).alias("i"))
    buckets = (lasts.unionByName(seen.select("domain", "bucket").distinct(), allowMissingColumns=True)
               .groupBy("domain", "bucket").agg(F.max("i").alias("i")))
    before = Window.partitionBy("domain").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (buckets.withColumn("i", F.last("i", ignorenulls=True).over(before)).filter("i is not null")
               .select("domain", "bucket", "i.since", "i.until", "i.action")
               .filter(F.col("until").isNull() | (F.col("until") > F.col("bucket") * BUCKET_MICROS)))
    held = held.unionByName(carried)
    active = seen.join(held, ["domain", "bucket"]).filter("since <= at and (until is null or at < until)")
    best = (active.groupBy("host", "at")
            .agg(F.max(F.struct(F.length("domain").alias("n"), "domain", "action", "since")).alias("r")))
    return (c.join(best, ["host", "at"], "left")
            .select("page_id", "host", F.coalesce("r.action", F.lit("none")).alias("decision"),
                    F.col("r.domain").alias("rule"),
                    F.floor(F.col("r.since") / 1_000_000).alias("rule_since")))


# ------------------------------------------------- stand-in over `pages`
# `pages` has no fetch time and no list, so both are derived from it: a page
# was fetched on day 37 * page_id mod 365 of 2024, on a quarter of a second,
# and every host got a list history from the ids of its first and last page,
# half a second after midnight.
START = 1_704_067_200


def captures_of(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id") * 37, F.lit(365))
    seconds = F.lit(START) + day * 86_400 + F.pmod("page_id", F.lit(24)) * 3600
    return pages.select("page_id", "url", F.timestamp_micros(seconds * 1_000_000 + F.pmod("page_id", F.lit(4)) * 250_000)
                        .alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Per host: blocked, removed 20-59 days later, then by the last page's
    id allowed or blocked again 90 days after the first; and the domain above
    it blocked from the first page's day on if that page's id is even."""
    h = (pages.select("page_id", host_of(F.col("url")).alias("host")).filter("host is not null")
         .groupBy("host").agg(F.min("page_id").alias("lo"), F.max("page_id").alias("hi")))
    day = F.pmod(F.col("lo") * 53, F.lit(300))
    dated = lambda d: F.timestamp_micros((F.lit(START) + d * 86_400) * 1_000_000 + 500_000)
    rows = F.array(
        F.struct(F.col("host").alias("domain"), F.lit("block").alias("action"), dated(day).alias("listed_at")),
        F.struct(F.col("host").alias("domain"), F.lit("remove").alias("action"),
                 dated(day + 20 + F.pmod("hi", F.lit(40))).alias("listed_at")),
        F.struct(F.col("host").alias("domain"), F.when(F.col("hi") % 2 == 0, "allow").otherwise("block")
                 .alias("action"), dated(day + 90).alias("listed_at")),
        F.struct(F.regexp_replace("host", r"^[^.]*\.", "").alias("domain"),
                 F.when(F.col("lo") % 2 == 0, "block").otherwise("remove").alias("action"),
                 dated(day).alias("listed_at")))
    return h.select(F.explode(rows).alias("e")).select("e.*")


def over_pages(pages: DataFrame) -> DataFrame:
    return judge(captures_of(pages), entries_of(pages))


SQL = rf"""
WITH p AS (
  SELECT page_id, regexp_replace(lower(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]+)', 1)), '\.$', '') AS h,
         ({START} + (page_id * 37 % 365) * 86400 + page_id % 24 * 3600) * 1000000 + page_id % 4 * 250000 AS ts
  FROM pages),
c AS (SELECT page_id, CASE WHEN length(h) BETWEEN 1 AND 253 THEN h END AS host, ts FROM p),
hosts AS (SELECT host, min(page_id) AS lo, max(page_id) AS hi FROM c WHERE host IS NOT NULL GROUP BY host),
d AS (
  SELECT host AS domain, 3 AS s, lo * 53 % 300 AS day FROM hosts
  UNION ALL SELECT host, 2, lo * 53 % 300 + 20 + hi % 40 FROM hosts
  UNION ALL SELECT host, CASE WHEN hi % 2 = 0 THEN 1 ELSE 3 END, lo * 53 % 300 + 90 FROM hosts
  UNION ALL SELECT regexp_replace(host, '^[^.]*\.', ''), CASE WHEN lo % 2 = 0 THEN 3 ELSE 2 END, lo * 53 % 300 FROM hosts),
e AS (SELECT domain, s, ({START} + day * 86400) * 1000000 + 500000 AS since FROM d),
one AS (SELECT domain, since, max(s) AS s FROM e GROUP BY domain, since),
iv AS (SELECT domain, s, since, lead(since) OVER (PARTITION BY domain ORDER BY since) AS until FROM one),
m AS (
  SELECT c.page_id, arg_max(struct_pack(d := iv.domain, s := iv.s, f := iv.since), length(iv.domain)) AS r
  FROM c JOIN iv ON (c.host = iv.domain OR c.host LIKE '%.' || iv.domain)
   AND iv.since <= c.ts AND (iv.until IS NULL OR c.ts < iv.until)
  WHERE iv.s <> 2 GROUP BY c.page_id)
SELECT c.page_id, c.host, CASE r.s WHEN 3 THEN 'block' WHEN 1 THEN 'allow' ELSE 'none' END AS decision,
       r.d AS rule, (r.f // 1000000)::BIGINT AS rule_since
FROM c LEFT JOIN m USING (page_id)
"""
