"""URL filter: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

The filter has one row per block of eight 64-bit words; a listed URL sets one bit in each word of its
block, so a URL is looked up in one row, by an equi-join on the block: a broadcast one while the blocks
are counted to be few. Pages that a rule decides, or that have no host, are not looked up. What may be listed
goes to an exact hash join with the list, which removes false positives; all else never meets the list.

Canonical: the host without a leading ``www.``, the path without trailing slashes, the query without
tracking parameters; scheme and fragment do not count.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is
never listed; every row is judged, repeated ones alike; an empty list blocks nothing; of rules of one
length the last by text wins. A very long URL is one value of its row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.native import ascii_lower

BITS_PER_URL = 16
WORDS = 8
#: blocks (72 bytes each) up to which the filter is broadcast: that of 16 million listed URLs
BROADCAST_BLOCKS = 500_000

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_TRACKING = r"(?:^|(?<=&))(?:utm_[^=&]*|ref|gclid|fbclid)(?:=[^&]*)?(?:&|$)"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: words of host names whose pages make the list of the registered query
UNWANTED = ("spam", "pills", "casino", "malware")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _SPLIT, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def canonical(url: Column) -> Column:
    query = F.rtrim(F.regexp_replace(F.regexp_extract(url, _SPLIT, 3), _TRACKING, ""), F.lit("&"))
    return F.concat(
        F.regexp_replace(host_of(url), r"^www\.", ""),
        F.rtrim(path_of(url), F.lit("/")),
        F.coalesce(F.when(query != "", F.concat(F.lit("?"), query)), F.lit("")),
    )


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.text), rule.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bit(url: Column, word: int) -> Column:
    place = F.shiftright(F.xxhash64(url, F.lit(1)), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter: block, w0 ... w7; blocks without a listed URL have no row."""
    url = F.col("listed_url")
    masks = [F.bit_or(_bit(url, word)).alias(f"w{word}") for word in range(WORDS)]
    return listed.groupBy(_block(url, blocks).alias("block")).agg(*masks)


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, possible (passed the Bloom filter) of every row.

    ``listed`` has the URLs to block in a column ``url``.
    """
    urls = listed.select(canonical(F.col("url")).alias("listed_url"), host_of(F.col("url")).alias("host"))
    urls = urls.where("host <> ''").select("listed_url").distinct()
    count = urls.count()
    blocks = max(1, -(-count * BITS_PER_URL // (64 * WORDS)))
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    rule, verdict = rule_of(host, path, rules)
    judged = pages.select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        rule.alias("rule"),
        verdict.alias("by_rule"),
        canonical(url).alias("canonical_url"),
    )
    # only pages that neither a rule decides nor lack a host are looked up at all
    is_open = F.col("by_rule").isNull() & (F.col("host") != "")
    no = F.lit(False)
    decided = judged.where(~is_open).select("page_id", "host", "path", "rule", "by_rule", no.alias("is_listed"), no.alias("possible"))
    asked = judged.where(is_open).withColumn("block", _block(F.col("canonical_url"), blocks))
    filter_ = bloom_blocks(urls, blocks)
    filter_ = F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_
    held = [F.col(f"w{i}").bitwiseAND(_bit(F.col("canonical_url"), i)) != 0 for i in range(WORDS)]
    every = held[0]
    for bit in held[1:]:
        every = every & bit
    looked = asked.join(filter_, "block", "left").withColumn("possible", F.coalesce(every, no))
    hits = looked.where("possible").join(
        urls.withColumn("is_listed", F.lit(True)), F.col("canonical_url") == F.col("listed_url"), "left"
    )
    others = looked.where("not possible").withColumn("is_listed", no)
    columns = decided.columns
    both = hits.select(*columns).unionByName(others.select(*columns)).unionByName(decided)
    by_list = F.when(F.coalesce("is_listed", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return both.select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_list).alias("verdict"), "possible"
    )


def op5_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    unwanted = pages.where(host_of(F.col("url")).rlike("|".join(UNWANTED))).select("url")
    return filter_urls(pages, unwanted).drop("possible")


_SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5_SQL = f"""
    with parts as (
        select page_id,
               coalesce({_SQL_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') as host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*\\?([^#]*)', 1), '') as raw_query
        from pages
    ), cleaned as (
        select *, array_to_string(list_filter(string_split(raw_query, '&'), lambda p:
                   not regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$')), '&') as query
        from parts
    ), canonical as (
        select *, regexp_replace(host, '^www\\.', '') || rtrim(path, '/')
                  || case when rtrim(query, '&') <> '' then '?' || rtrim(query, '&') else '' end as url
        from cleaned
    ), listed as (
        select distinct url from canonical
        where regexp_matches(host, 'spam|pills|casino|malware') and host <> ''
    ), ruled as (
        select page_id, host, path, url,
               case when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/')
                    then 'www.example.com/en/'
                    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/')
                    then 'example.com/en/'
                    when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
                    when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
                    when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/'
               end as rule
        from canonical
    )
    select page_id, host, path, rule,
           case when rule in ('com/', 'www.example.com/en/') then 'allow'
                when rule is not null then 'block'
                when host <> '' and exists (select 1 from listed where listed.url = ruled.url) then 'block'
                else 'allow' end as verdict
    from ruled
"""
