"""URL filters (operator 5): captures against dated block lists, as they were at fetch time. DataFrame functions only.

List entries are dated changes (domain, list, date, action 'add' or 'remove'). Window functions turn them into validity
intervals [valid_from, valid_to): an interval opens at an 'add' and ends at the next change of the same domain and
list, or never. A capture meets every interval of its host and of the host's parent domains that covers its fetch
date: an as-of join on the domain with the date as a range. Of several matches the longest domain wins, then the
list's name. An IP address, of version 6 in brackets, has no parent domains.

Null, empty or unparsable URLs, and captures without a date, match nothing and are allowed. Entries without a
domain, list or date are ignored. Several changes on one day: 'remove' comes last. Every capture gives one row,
repeated rows and ids included. The captures' join is a sort-merge join by host; Spark
can split a hot host only on the side of the captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port and a leading www; null where there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.|\.$", ""), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and its parent domains down to two labels; of an IP address, itself."""
    labels = F.split(host, r"\.")
    return F.when(host.rlike(r"^\[|^[0-9.]+$"), F.array(host)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def intervals(entries: DataFrame) -> DataFrame:
    """domain, list, valid_from, valid_to from dated changes. Changes are few per domain and list; none is dropped."""
    known = entries.where("domain is not null and list is not null and date is not null").select(
        F.lower("domain").alias("domain"), "list", F.col("date").cast("date").alias("date"), (F.col("action") == "add").alias("on"))
    day = known.groupBy("domain", "list", "date").agg(F.min(F.coalesce("on", F.lit(False))).alias("on"))
    w = W.partitionBy("domain", "list").orderBy("date")
    spans = day.withColumn("valid_to", F.coalesce(F.lead("date").over(w), F.lit(OPEN_END).cast("date")))
    return spans.where("on").select("domain", "list", F.col("date").alias("valid_from"), "valid_to")


def filter_urls(captures: DataFrame, entries: DataFrame, id_column: str = "page_id", url: str = "url", fetched: str = "fetch_date") -> DataFrame:
    """Per capture: its id, url, fetch date, host, and the matched domain and list; `blocked` tells whether any matched."""
    seen = captures.select(F.col(id_column), F.col(url), F.col(fetched).cast("date").alias(fetched)).withColumn("host", host_of(F.col(url)))
    asked = seen.where(F.col("host").isNotNull() & F.col(fetched).isNotNull()).select(F.col(fetched).alias("at"), "host")
    # a host's captures of one day share their matches: ask once for each
    days = asked.groupBy("host", "at").agg(F.lit(1).alias("one")).select("host", "at", F.explode(domains_of(F.col("host"))).alias("domain"))
    spans = intervals(entries)
    met = days.join(spans, (days["domain"] == spans["domain"]) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to")))
    best = met.groupBy("host", "at").agg(
        F.count("*").alias("n_matches"),
        F.min(F.struct((-F.length(days["domain"])).alias("by"), days["domain"].alias("domain"), F.col("list"))).alias("best"),
    )
    found = best.select(F.col("host").alias("m_host"), F.col("at").alias("m_at"), "n_matches", F.col("best.domain").alias("matched_domain"), F.col("best.list").alias("matched_list"))
    joined = seen.join(found, (F.col("host") == F.col("m_host")) & (F.col(fetched) == F.col("m_at")), "left")
    return joined.select(id_column, url, fetched, "host", "matched_domain", "matched_list", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.col("n_matches").isNotNull().alias("blocked"))
