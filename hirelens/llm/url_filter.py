"""URL filters: temporal list join.

List events (list, kind, value, action, at) are dated additions and removals.
They become validity intervals [from, to) with LEAD over each entry's history,
and an as-of join evaluates every capture against the entries that are active
at its fetch date. Kinds: ``host`` (the whole host), ``domain`` (the host or
any parent domain) and ``prefix`` (host and leading path segments).

A host is what stands between ``//``, or a user part up to the last ``@``, and a
port, path, query or fragment; an address in brackets is whole. Hosts are
compared in lower case without closing dots. Paths are compared as they are,
letter case and empty segments included; a prefix ends where a segment ends,
and closing slashes of an entry don't matter.

The join is by equal key: an interval is laid out over the 32-day slices that
it touches, and a capture looks up its keys in its own slice only, so a key
with a long history costs a capture no more than the entries of that slice.
Captures are first reduced to distinct (url, date), so repeated captures of a
hot host are evaluated once. Only DataFrame functions are used.

Verdict: ``dropped`` if an entry of a list in ``block`` is active and none of
a list in ``allow``.

Defined results: a null or hostless url, or a null date, matches nothing and
is not dropped; several additions in a row continue each other; on one date a
removal comes after an addition, so both together leave the entry inactive
from that date on; repeated captures and repeated events count once in a
verdict; events with a null list, kind, value, action or date are ignored; an
empty list drops nothing; no capture is lost or added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_DAYS = 32


def host_of(url):
    """The host of a url, empty if it has none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"\.+$", "")


def entry_value(kind, value):
    """A listed value as urls are compared with it."""
    at = F.locate("/", value)
    host = F.when(at > 0, F.substring(value, F.lit(1), at - 1)).otherwise(value)
    host = F.regexp_replace(F.lower(host), r"\.+$", "")
    path = F.when(at > 0, F.regexp_replace(F.substring(value, at, F.length(value)), "/+$", "")).otherwise(F.lit(""))
    return F.when(kind == "prefix", F.concat(host, path)).otherwise(F.regexp_replace(F.lower(value), r"\.+$", ""))


def intervals(events: DataFrame) -> DataFrame:
    """(list, kind, value, since, until) with ``until`` exclusive or null."""
    known = events.select("list", "kind", entry_value(F.col("kind"), F.col("value")).alias("value"), "action",
                          F.col("at").cast("date").alias("at")).dropna().distinct()
    daily = (known.groupBy("list", "kind", "value", "at")
             .agg(F.max(F.when(F.col("action") == "remove", 1).otherwise(0)).alias("removed")))
    entry = Window.partitionBy("list", "kind", "value").orderBy("at")
    return (daily.withColumn("until", F.lead("at").over(entry))
            .where("removed = 0")
            .select("list", "kind", "value", F.col("at").alias("since"), "until"))


def _keys(url):
    """Lookup keys of a url as an array of (kind, value)."""
    host = host_of(url)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    labels = F.split(host, r"\.")
    segments = F.when(path == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(path, "/", -1))
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.when(F.size(segments) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(segments), F.lit(1))),
        lambda i: key("prefix", F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))))
    empty = F.expr("cast(array() as array<struct<kind:string,value:string>>)")
    return F.when(host != "", F.concat(F.array(key("host", host)), domains, F.coalesce(prefixes, empty)))


def _slice(date):
    return F.floor(F.datediff(date, F.lit("1970-01-01")) / SLICE_DAYS)


def url_filter(captures: DataFrame, events: DataFrame, url_col: str = "url", date_col: str = "fetched",
               block: tuple = ("block",), allow: tuple = ("allow",)) -> DataFrame:
    """All rows of ``captures`` with ``n_active`` (active entries that match),
    ``lists`` (their lists, sorted, joined by commas) and ``dropped``."""
    url, date = F.col(url_col), F.col(date_col).cast("date")
    seen = captures.select(url.alias("u"), date.alias("d")).distinct()
    span = seen.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    lo, hi = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    entries = (intervals(events)
               .where((F.col("since") <= hi) & (F.col("until").isNull() | (F.col("until") > lo)))
               .withColumn("slice", F.explode(F.sequence(
                   _slice(F.greatest("since", lo)), _slice(F.least(F.coalesce("until", hi), hi))))))
    asked = (seen.withColumn("key", F.explode(_keys(F.col("u"))))
             .select("u", "d", "key.kind", "key.value", _slice(F.col("d")).alias("slice")))
    hit = (asked.join(entries, ["kind", "value", "slice"])
           .where((F.col("d") >= F.col("since")) & (F.col("until").isNull() | (F.col("d") < F.col("until")))))
    is_in = lambda names: F.max(F.col("list").isin(*names)) if names else F.lit(False)
    verdict = (hit.groupBy("u", "d")
               .agg(F.count("*").alias("n_active"),
                    F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
                    is_in(block).alias("b"), is_in(allow).alias("a"))
               .select("u", "d", F.struct("n_active", "lists", (F.col("b") & ~F.col("a")).alias("dropped")).alias("v")))
    own = captures.select(F.struct(*captures.columns).alias("row"), url.alias("u0"), date.alias("d0"))
    kept = own.join(verdict, (F.col("u0") == F.col("u")) & (F.col("d0") == F.col("d")), "left")
    return kept.select(
        *[F.col("row").getField(c).alias(c) for c in captures.columns if c not in ("n_active", "lists", "dropped")],
        F.coalesce("v.n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("v.lists", F.lit("")).alias("lists"),
        F.coalesce("v.dropped", F.lit(False)).alias("dropped"))
