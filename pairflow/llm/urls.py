"""URL filters as a temporal list join.

A filter list is a set of dated entries (key, verdict, listed_on): a key is a
host, a parent domain or a host with leading path segments; the verdict is
'block', 'allow' or 'clear'. An entry holds from its date until the next dated
entry of the same key, so the entries become validity intervals. Every capture
looks up all its keys, host, parent domains and path prefixes, as of the day
it was fetched, and the most specific active entry decides: longer path
prefixes before shorter ones, these before the host, the host before its
parents. 'clear' ends an entry and decides nothing. Paths are looked up as
deep as the list's deepest entry; hosts match in any case, paths in their own.

DataFrame functions only. Captures are reduced to distinct (target, day)
pairs and these to distinct (key, day) pairs before the as-of join, so a host
that holds a third of all captures is looked up once a day. The as-of join
lines up a key's entries and days by date and carries the last entry forward, so
a key costs its days plus its entries. The day is part of every join key
behind that.

Defined cases: a null or unreadable url has no keys and is kept with verdict
'none'; a null fetch day matches nothing; entries with a null key, verdict or
date are ignored; of several entries of one key and day 'block' wins over
'allow' over 'clear'; repeated captures are judged each; empty tables give no
row or no match. Other columns of the captures are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PATH_DEPTH = 2  # of the shown target and of the list derived from the pages
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), ABSOLUTE, 1))
    return F.regexp_replace(host, r"\.$", "")


def segments_of(url: Column, depth: int = PATH_DEPTH) -> Column:
    path = F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)
    return F.slice(F.filter(F.split(path, "/"), lambda s: s != ""), 1, depth)


def target_of(url: Column, depth: int = PATH_DEPTH) -> Column:
    """The part of a url that its keys of so many path segments depend on."""
    return F.concat_ws("/", host_of(url), segments_of(url, depth))


def keys_of(target: Column) -> Column:
    """array<(key, specificity)> of a target 'host/seg/seg'."""
    parts = F.split(target, "/")
    host = F.element_at(parts, 1)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    numeric = host.rlike(r"^[0-9.]+$")
    # parents of a host keep two labels at least; an address has none
    domains = F.transform(
        F.sequence(F.lit(1), F.when(numeric, F.lit(1)).otherwise(F.greatest(F.lit(1), n - 1))),
        lambda i: F.struct(F.array_join(F.slice(labels, i, n), ".").alias("key"),
                           (n - i).cast("int").alias("specificity")))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.struct(F.array_join(F.slice(parts, 1, i), "/").alias("key"),
                           (F.lit(1000) + i).cast("int").alias("specificity")))
    found = F.concat(domains, F.slice(prefixes, F.lit(2), F.size(parts)))
    return F.when(host == "", F.slice(found, 1, 0)).otherwise(found)


USABLE = "key IS NOT NULL AND verdict IS NOT NULL AND listed_on IS NOT NULL"


def entry_key(key: Column) -> Column:
    """An entry's key with its host in lower case; paths keep their case."""
    host = F.substring_index(key, "/", 1)
    return F.concat(F.lower(host), F.substring(key, F.length(host) + 1, F.length(key)))


def deepest(entries: DataFrame) -> int:
    """Path segments of the deepest entry."""
    return entries.where(USABLE).agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0


def validity(entries: DataFrame) -> DataFrame:
    """(key, verdict, valid_from, valid_to): each entry up to the next one of
    its key. Entries are dated by day, so a key has at most one a day."""
    day = (entries.where(USABLE)
           .withColumn("order", F.expr("CASE verdict WHEN 'block' THEN 2 WHEN 'allow' THEN 1 "
                                       "ELSE 0 END"))
           .groupBy(entry_key(F.col("key")).alias("key"), "listed_on")
           .agg(F.max("order").alias("order")))
    following = Window.partitionBy("key").orderBy("listed_on")
    return (day.withColumn("valid_to", F.lead("listed_on").over(following))
            .where("order > 0")
            .select("key", F.expr("CASE order WHEN 2 THEN 'block' ELSE 'allow' END")
                    .alias("verdict"),
                    F.col("listed_on").alias("valid_from"), "valid_to"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures (page_id, url, fetched_on) with target, verdict,
    matched_key, listed_on and kept."""
    captures = captures.select("page_id", "url", "fetched_on",
                               target_of(F.col("url")).alias("target"),
                               target_of(F.col("url"), deepest(entries)).alias("place"))
    lookups = (captures.where("fetched_on IS NOT NULL").select("place", "fetched_on").distinct()
               .withColumn("k", F.explode(keys_of(F.col("place"))))
               .select("place", "fetched_on", "k.key", "k.specificity"))
    intervals = validity(entries)
    # the entries of a key and the days it is asked for, in one line by date:
    # each day takes the last interval begun, if that has not ended
    asked = lookups.select("key", F.col("fetched_on").alias("on")).distinct()
    begun = intervals.select("key", F.col("valid_from").alias("on"),
                             F.struct("verdict", "valid_from", "valid_to").alias("entry"))
    line = (Window.partitionBy("key").orderBy("on", F.col("entry").isNull())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    active = (asked.unionByName(begun, allowMissingColumns=True)
              .select("key", "on", F.col("entry").isNull().alias("asked"),
                      F.last("entry", ignorenulls=True).over(line).alias("entry"))
              .where(F.col("asked") & F.col("entry").isNotNull()
                     & F.coalesce(F.col("on") < F.col("entry.valid_to"), F.lit(True)))
              .select("key", F.col("on").alias("fetched_on"), "entry.verdict",
                      "entry.valid_from"))
    decided = (lookups.join(active, ["key", "fetched_on"])
               .groupBy("place", "fetched_on")
               .agg(F.max_by(F.struct("verdict", "key", "valid_from"), "specificity").alias("m")))
    return (captures.join(decided, ["place", "fetched_on"], "left")
            .select("page_id", "url", "fetched_on", "target",
                    F.coalesce("m.verdict", F.lit("none")).alias("verdict"),
                    F.col("m.key").alias("matched_key"),
                    F.col("m.valid_from").alias("listed_on"),
                    F.coalesce(F.col("m.verdict") != "block", F.lit(True)).alias("kept")))


# --- the given pages as captures, and a dated list over their hosts ------------------

START = "2024-01-01"


def _digits(key: Column, at: int) -> Column:
    """A number below 65536 or so from two hex digits of the key's md5."""
    h = F.md5(key.cast("binary"))
    return F.ascii(F.substring(h, at, 1)) * 31 + F.ascii(F.substring(h, at + 1, 1)) * 7


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages fetched over one year, a day by id."""
    return pages.select("page_id", "url", F.date_add(
        F.lit(START).cast("date"), F.pmod(F.col("page_id"), F.lit(365)).cast("int"))
        .alias("fetched_on"))


def list_of(pages: DataFrame) -> DataFrame:
    """Dated entries for a part of the keys that the pages' urls have: a first
    verdict, for some a second one, for some a clearing."""
    keys = (pages.select(target_of(F.col("url")).alias("target")).distinct()
            .select(F.explode(keys_of(F.col("target"))).alias("k")).select("k.key").distinct())
    start = F.lit(START).cast("date")
    key = F.col("key")
    first = F.date_add(start, (_digits(key, 3) % 200).cast("int"))
    events = F.array(
        F.struct(F.when(_digits(key, 1) % 3 == 0, F.when(_digits(key, 5) % 2 == 0, "block")
                        .otherwise("allow")).alias("verdict"), first.alias("listed_on")),
        F.struct(F.when((_digits(key, 1) % 3 == 0) & (_digits(key, 7) % 2 == 0), "block")
                 .alias("verdict"),
                 F.date_add(first, (30 + _digits(key, 9) % 60).cast("int")).alias("listed_on")),
        F.struct(F.when((_digits(key, 1) % 3 == 0) & (_digits(key, 11) % 2 == 0), "clear")
                 .alias("verdict"),
                 F.date_add(first, (90 + _digits(key, 13) % 60).cast("int")).alias("listed_on")))
    return (keys.select("key", F.explode(events).alias("e"))
            .select("key", "e.verdict", "e.listed_on").where("verdict IS NOT NULL"))


def pages_judged(pages: DataFrame) -> DataFrame:
    out = judge(captures_of(pages), list_of(pages))
    return out.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "listed_on")})


def _sql_digits(key: str, at: int) -> str:
    h = f"md5({key})"
    return f"(ascii(substr({h}, {at}, 1)) * 31 + ascii(substr({h}, {at + 1}, 1)) * 7)"


_LISTED = f"{_sql_digits('key', 1)} % 3 = 0"
_FIRST = f"(DATE '{START}' + CAST({_sql_digits('key', 3)} % 200 AS INTEGER))"

ORACLE_SQL = f"""
WITH captures AS (
  SELECT page_id, url,
         CAST(DATE '{START}' + CAST(((page_id % 365) + 365) % 365 AS INTEGER) AS DATE) AS fetched_on,
         regexp_replace(lower(regexp_extract(coalesce(url, ''),
           '{ABSOLUTE}', 1)), '\\.$', '') AS host,
         list_filter(string_split(regexp_extract(coalesce(url, ''), '{PATH}', 1), '/'),
                     lambda s: s <> '')[1:{PATH_DEPTH}] AS segs
  FROM pages),
targets AS (
  SELECT page_id, url, fetched_on, host, segs,
         CASE WHEN len(segs) = 0 THEN host ELSE host || '/' || array_to_string(segs, '/') END
           AS target
  FROM captures),
distinct_targets AS (SELECT DISTINCT target, host, segs FROM targets WHERE host <> ''),
keyed AS (
  SELECT target, array_to_string(labels[i:], '.') AS key, len(labels) - i AS specificity
  FROM (SELECT target, host, string_split(host, '.') AS labels,
               unnest(generate_series(1, CASE WHEN regexp_matches(host, '^[0-9.]+$') THEN 1
                 ELSE greatest(1, len(string_split(host, '.')) - 1) END)) AS i
        FROM distinct_targets)
  UNION ALL
  SELECT target, host || '/' || array_to_string(segs[1:i], '/') AS key, 1001 + i AS specificity
  FROM (SELECT target, host, segs, unnest(generate_series(1, len(segs))) AS i
        FROM distinct_targets)),
keys AS (SELECT DISTINCT key FROM keyed),
entries AS (
  SELECT key, CASE WHEN {_sql_digits('key', 5)} % 2 = 0 THEN 2 ELSE 1 END AS ord,
         {_FIRST} AS listed_on FROM keys WHERE {_LISTED}
  UNION ALL
  SELECT key, 2, {_FIRST} + CAST(30 + {_sql_digits('key', 9)} % 60 AS INTEGER)
  FROM keys WHERE {_LISTED} AND {_sql_digits('key', 7)} % 2 = 0
  UNION ALL
  SELECT key, 0, {_FIRST} + CAST(90 + {_sql_digits('key', 13)} % 60 AS INTEGER)
  FROM keys WHERE {_LISTED} AND {_sql_digits('key', 11)} % 2 = 0),
days AS (SELECT lower(split_part(key, '/', 1)) || substr(key, length(split_part(key, '/', 1)) + 1)
                  AS key, listed_on, max(ord) AS ord FROM entries GROUP BY 1, 2),
intervals AS (
  SELECT key, ord, listed_on AS valid_from,
         lead(listed_on) OVER (PARTITION BY key ORDER BY listed_on) AS valid_to FROM days),
hits AS (
  SELECT t.target, t.fetched_on,
         arg_max({{'ord': i.ord, 'key': i.key, 'valid_from': i.valid_from}}, k.specificity) AS m
  FROM (SELECT DISTINCT target, fetched_on FROM targets) t
  JOIN keyed k ON k.target = t.target
  JOIN intervals i ON i.key = k.key AND i.ord > 0 AND t.fetched_on >= i.valid_from
       AND (i.valid_to IS NULL OR t.fetched_on < i.valid_to)
  GROUP BY 1, 2)
SELECT t.page_id, t.url, CAST(t.fetched_on AS VARCHAR) AS fetched_on, t.target,
       CASE h.m.ord WHEN 2 THEN 'block' WHEN 1 THEN 'allow' ELSE 'none' END AS verdict,
       h.m.key AS matched_key, CAST(CAST(h.m.valid_from AS DATE) AS VARCHAR) AS listed_on,
       coalesce(h.m.ord <> 2, TRUE) AS kept
FROM targets t LEFT JOIN hits h ON h.target = t.target AND h.fetched_on = t.fetched_on
"""
