"""URL filters: a temporal list join that judges every capture by the entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.runtime import materialize, sized, table

HOST = "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = "^[^:]*://[^/?#]*(/[^?#]*)"


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, value, since, until) from dated entries (kind, value, dated, action add or remove): [since, until) where the value is listed.

    The state from a date on is the last action of that date (a removal beats an addition of the same date); it lasts until
    the next date of that value, or for ever (null until). Entries with a null field are left out; repeated ones count once.
    """
    clean = entries.where("kind is not null and value is not null and dated is not null and action in ('add', 'remove')")
    days = clean.groupBy("kind", "value", "dated").agg(F.max("action").alias("action"))
    until = F.lead("dated").over(Window.partitionBy("kind", "value").orderBy("dated"))
    return days.withColumn("until", until).where("action = 'add'").select("kind", "value", F.col("dated").alias("since"), "until")


def keys(url: Column) -> Column:
    """What a list can hold of a URL: its host, every parent domain of two labels or more, and the host with each leading part of the path."""
    host = F.regexp_extract(F.lower(url), HOST, 1)
    labels = F.split(host, "\\.")
    n = F.size(labels)
    domains = F.when(n >= 2, F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda k: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, -k, k), ".").alias("value"))))
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda p: p != "")
    m = F.size(parts)
    prefixes = F.when(m >= 1, F.transform(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), lambda k: F.struct(F.lit("prefix").alias("kind"), F.concat_ws("/", host, F.array_join(F.slice(parts, 1, k), "/")).alias("value"))))
    none = F.array().cast("array<struct<kind:string,value:string>>")
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    return F.when(F.coalesce(host, F.lit("")) == "", none).otherwise(F.concat(own, F.coalesce(domains, none), F.coalesce(prefixes, none)))


def judge(spark: SparkSession, captures: DataFrame, entries: DataFrame, page_id: str = "page_id", url: str = "url", fetched: str = "fetched", salts: int = 16) -> DataFrame:
    """One row per capture: page_id, url, fetched, n_active, rule, blocked.

    n_active: list values of the URL that were listed on the fetch date; rule: the first of them as kind:value. Each value is one row with its sorted intervals, so a
    capture meets a value once, however often that was listed, and takes the last interval that began at or before its fetch date (as of). The values' rows and bytes are measured:
    small ones are broadcast, else they meet the captures by a shuffle on (kind, value, salt), repeated per salt, so a host with a third of
    all captures is spread over `salts` tasks. Only matches are aggregated. Null url or fetch date, and URLs without a host, match
    nothing. Captures repeated whole are returned each with the same verdict.
    """
    rows = captures.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(fetched).alias("fetched"))
    spans = intervals(entries).groupBy("kind", "value").agg(F.sort_array(F.collect_list(F.struct("since", "until"))).alias("spans"))
    listed = materialize(spark, spans, "intervals")
    asked = rows.distinct().select("page_id", "url", "fetched", F.explode(keys(F.col("url"))).alias("k")).select("page_id", "url", "fetched", "k.kind", "k.value")
    on = ["kind", "value"]
    side = sized(listed, listed.count())
    if side is listed:
        asked = asked.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
        side, on = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["kind", "value", "salt"]
    last = F.try_element_at(F.filter("spans", lambda s: s["since"] <= F.col("fetched")), F.lit(-1))
    active = asked.join(side, on).withColumn("last", last).where(F.col("last").isNotNull() & (F.col("last.until").isNull() | (F.col("fetched") < F.col("last.until"))))
    verdict = active.groupBy(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetched").alias("f")).agg(F.count("*").alias("n"), F.min(F.concat_ws(":", "kind", "value")).alias("rule"))
    joined = rows.join(verdict, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u")) & (F.col("fetched") == F.col("f")), "left")
    return joined.select("page_id", "url", "fetched", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_active"), "rule", F.col("n").isNotNull().alias("blocked"))


def _number(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 6), 16, 10).cast("int")


def dated_list(pages: DataFrame) -> DataFrame:
    """A list for the tables at hand, which have none: additions and removals of hosts, domains and path prefixes on dates by md5."""
    seen = pages.select(F.explode(keys(F.col("url"))).alias("k")).select("k.kind", "k.value").distinct().withColumn("x", _number(F.concat_ws(":", "kind", "value"))).where("x % 3 = 0")
    turn = lambda days, action: F.struct(F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("x") / 3).cast("int") % 200 + days).cast("int")).alias("dated"), F.lit(action).alias("action"))
    return seen.select("kind", "value", F.explode(F.array(turn(0, "add"), turn(40, "remove"), turn(90, "add"))).alias("e")).select("kind", "value", "e.dated", "e.action")


def op3_temporal_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, fetched on a date by md5 of their page_id, against dated_list()."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    dates = F.date_add(F.lit("2024-01-01").cast("date"), _number(F.col("page_id").cast("string")) % 365)
    return judge(spark, pages.withColumn("fetched", dates), dated_list(pages))


ORACLE = r"""
with p as (select page_id, url, date '2024-01-01' + (('0x' || substr(md5(page_id::varchar), 1, 6))::int % 365) as fetched,
                  regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1) as host,
                  regexp_extract(url, '^[^:]*://[^/?#]*(/[^?#]*)', 1) as path from pages),
q as (select *, string_split(host, '.') as labels, list_filter(string_split(path, '/'), lambda x: x <> '') as parts from p where host <> ''),
k as (select page_id, url, fetched, 'host' as kind, host as value from q
      union all select page_id, url, fetched, 'domain', array_to_string(labels[len(labels) - n + 1:], '.') from (select *, unnest(range(2, len(labels) + 1)) as n from q)
      union all select page_id, url, fetched, 'prefix', host || '/' || array_to_string(parts[1:n], '/') from (select *, unnest(range(1, len(parts) + 1)) as n from q)),
s as (select kind, value, ('0x' || substr(md5(kind || ':' || value), 1, 6))::int as x from (select distinct kind, value from k)),
e as (select kind, value, date '2024-01-01' + ((x // 3) % 200 + d.days) as dated, d.action from s, (values (0, 'add'), (40, 'remove'), (90, 'add')) as d(days, action) where x % 3 = 0),
i as (select kind, value, dated as since, lead(dated) over (partition by kind, value order by dated) as until, action from e),
m as (select page_id, url, fetched, count(*) as n, min(kind || ':' || value) as rule from k join (select * from i where action = 'add') i using (kind, value)
      where since <= fetched and (until is null or fetched < until) group by all)
select p.page_id, p.url, cast(p.fetched as date) as fetched, coalesce(n, 0)::bigint as n_active, rule, n is not null as blocked
from p left join m on p.page_id = m.page_id and p.url = m.url and p.fetched = m.fetched
"""
