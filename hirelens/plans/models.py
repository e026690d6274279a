"""Warehouse models M-1 ... M-10 as DataFrame → DataFrame functions.

Dependency order (plain calls, no template engine): clean postings →
base_city → base_state → fact table (with the seniority dictionary) → the
count marts → daily → week-over-week trend. ``job_links`` depends only on
the clean table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens import functions as HF
from hirelens.operators import collapse_max, count_distinct_by, distinct_rows, lag_trend, sum_by
from hirelens.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, broadcast_if_small
from hirelens.schemas import FACT_COLUMNS, LINK_COLUMNS, POSTING_KEY
from hirelens.session import written


# of rows that one task sorts
RANGE_BYTES = 128 * 1024 * 1024


def base_city(clean: DataFrame) -> DataFrame:
    """M-1: distinct (CITY, STATE) with the standardized city."""
    return (distinct_rows(clean, ["CITY", "STATE"])
            .select("CITY", HF.city_standardized("CITY").alias("CITY_STANDARDIZED"), "STATE"))


def base_state(city: DataFrame) -> DataFrame:
    """M-2: distinct (standardized city, standardized state)."""
    return city.select(
        "CITY_STANDARDIZED",
        HF.state_standardized("STATE", "CITY_STANDARDIZED").alias("STATE_STANDARDIZED"),
    ).distinct()


def posting_profiles(clean: DataFrame) -> DataFrame:
    """Distinct (CITY, STATE, SENIORITY) of the clean postings: everything
    the city, state and seniority sides are derived from, in one pass."""
    return clean.select("CITY", "STATE", "SENIORITY").distinct()


def _vocabulary(columns: dict[str, DataFrame]) -> DataFrame:
    """One small table of (kind, value, code): the distinct non-null values of
    each named column with their rank in byte order (Spark's string order),
    so MAX of the code is MAX of the string. Only built from measured,
    small inputs; the window is global per kind."""
    parts = [df.select(F.lit(kind).alias("kind"), F.col(col).alias("value"))
             for kind, (df, col) in columns.items()]
    vals = parts[0]
    for p in parts[1:]:
        vals = vals.unionByName(p)
    vals = vals.filter(F.col("value").isNotNull()).distinct()
    return vals.withColumn("code", F.row_number().over(Window.partitionBy("kind").orderBy("value")))


def _codes(vocab: DataFrame, kind: str, value_as: str, code_as: str) -> DataFrame:
    return vocab.filter(F.col("kind") == kind).select(
        F.col("value").alias(value_as), F.col("code").alias(code_as))


def _matching(clean: DataFrame, seniority: DataFrame | None, seniority_match: str) -> DataFrame:
    """The postings that the inner joins of M-3 keep.

    The city and state sides are built from the same postings, so they keep
    every posting with a CITY. A dictionary derived from the same postings
    (``seniority`` None) holds lower(x) of every level x, so it has a level
    exactly if that level is lower case already; with lower-cased matching it
    has every level. Another dictionary is a semi join to its levels.
    """
    rows = clean.filter(F.col("CITY").isNotNull())
    level = F.lower("SENIORITY") if seniority_match == "casefold" else F.col("SENIORITY")
    if seniority is None:
        return rows.filter(level == F.lower("SENIORITY"))
    levels = seniority.select(F.col("SENIORITY").alias("_SEN_KEY")).filter(F.col("_SEN_KEY").isNotNull()).distinct()
    return rows.join(broadcast_if_small(levels), level == F.col("_SEN_KEY"), "left_semi")


def fact_rows(clean: DataFrame, columns: list[str], seniority: DataFrame | None = None, *,
              seniority_match: str = "exact") -> DataFrame:
    """Distinct values of posting columns over the fact table, without its
    sides: the fact table groups by all posting columns, so for a mart that
    reads none of CITY, STATE and SENIORITY only the postings kept matter.
    With a derived dictionary this is a scan and a filter, and nothing runs
    before the plan does."""
    if set(columns) - set(POSTING_KEY):
        raise ValueError(f"not posting columns: {sorted(set(columns) - set(POSTING_KEY))}")
    return _matching(clean, seniority, seniority_match).select(*columns)


def fact_postings(clean: DataFrame, seniority: DataFrame | None = None, *, profiles: DataFrame | None = None,
                  seniority_match: str = "exact") -> DataFrame:
    """M-3, the deduplicated fact table.

    Same result as the warehouse model (distinct postings, inner joins to
    the distinct city, state and seniority sides, GROUP BY the 28 posting
    columns with independent MAX of the three standardized values), planned
    without its fan-out:

    * the city and state sides collapse into one row per raw CITY:
      its standardized city (a pure function of CITY) and the MAX of the
      standardized states of that standardized city; the seniority side
      into one row per level. MAX is idempotent and ignores nulls, so the
      final maxima are unchanged, and no posting row is multiplied;
    * the sides come from ``profiles`` (distinct CITY, STATE, SENIORITY;
      written once) and the dictionary (None: derived from the profiles;
      another one is written once, so an external classifier runs once);
    * the two sides themselves are measured. When both are small, they and a
      rank vocabulary are held in memory: each standardized string travels as
      its rank in byte order, the GROUP BY takes MAX of integers (a hash
      aggregate, combined map-side, so a hot posting is reduced before the
      single shuffle of posting rows), and the ranks are decoded by broadcast
      lookups; a null label has no rank and stays null;
    * beyond the size limits the sides are joined by shuffle (AQE splits a
      hot city) and MAX runs on the strings (sort-based aggregation, which
      spills).

    Both ways give the rows of :func:`fact_postings_naive`.
    ``seniority_match='casefold'`` matches the posting's level lower-cased
    (the dictionary keys are lower case); the default is exact.
    """
    from hirelens.plans.enrich import seniority_dictionary
    if profiles is None:
        profiles, _, _ = written(posting_profiles(clean), "profiles")
    seniority = seniority_dictionary(profiles) if seniority is None else written(seniority, "seniority")[0]
    state_dim = (base_state(base_city(profiles))
                 .filter(F.col("CITY_STANDARDIZED").isNotNull())
                 .groupBy("CITY_STANDARDIZED")
                 .agg(F.max("STATE_STANDARDIZED").alias("STATE_STANDARDIZED")))
    city_dim, *city_size = written(
        profiles.select("CITY").filter(F.col("CITY").isNotNull()).distinct()
        .withColumn("CITY_STANDARDIZED", HF.city_standardized("CITY"))
        .join(state_dim, "CITY_STANDARDIZED", "inner").select("CITY", "CITY_STANDARDIZED", "STATE_STANDARDIZED"), "city-side")
    sen_dim, *sen_size = written(
        seniority.filter(F.col("SENIORITY").isNotNull())
        .groupBy(F.col("SENIORITY").alias("_SEN_KEY"))
        .agg(F.max("SENIORITY_STANDARDIZED").alias("SENIORITY_STANDARDIZED")), "seniority-side")
    posting_sen = F.lower("SENIORITY") if seniority_match == "casefold" else F.col("SENIORITY")
    postings = clean.withColumn("_SEN", posting_sen)
    if not all(n <= BROADCAST_MAX_ROWS and b <= BROADCAST_MAX_BYTES for n, b in (city_size, sen_size)):
        joined = (postings.join(city_dim, "CITY", "inner")
                          .join(sen_dim, F.col("_SEN") == sen_dim["_SEN_KEY"], "inner"))
        out = collapse_max(joined, POSTING_KEY, {
            "CITY": "CITY_STANDARDIZED", "STATE": "STATE_STANDARDIZED",
            "SENIORITY": "SENIORITY_STANDARDIZED"})
        return out.select(*FACT_COLUMNS)

    vocab, _, _ = written(_vocabulary({
        "c": (city_dim, "CITY_STANDARDIZED"),
        "s": (city_dim, "STATE_STANDARDIZED"),
        "e": (sen_dim, "SENIORITY_STANDARDIZED")}), "vocabulary")
    city_side = (city_dim.join(F.broadcast(_codes(vocab, "c", "CITY_STANDARDIZED", "_c")), "CITY_STANDARDIZED", "left")
                 .join(F.broadcast(_codes(vocab, "s", "STATE_STANDARDIZED", "_s")), "STATE_STANDARDIZED", "left")
                 .select("CITY", "_c", "_s"))
    sen_side = (sen_dim.join(F.broadcast(_codes(vocab, "e", "SENIORITY_STANDARDIZED", "_e")), "SENIORITY_STANDARDIZED", "left")
                .select("_SEN_KEY", "_e"))
    joined = (postings.join(F.broadcast(city_side), "CITY", "inner")
                      .join(F.broadcast(sen_side), F.col("_SEN") == F.col("_SEN_KEY"), "inner"))
    coded = joined.groupBy(*POSTING_KEY).agg(
        F.max("_c").alias("_c"), F.max("_s").alias("_s"), F.max("_e").alias("_e"))
    decoded = (coded.join(F.broadcast(_codes(vocab, "c", "CITY", "_c")), "_c", "left")
                    .join(F.broadcast(_codes(vocab, "s", "STATE", "_s")), "_s", "left")
                    .join(F.broadcast(_codes(vocab, "e", "SENIORITY", "_e")), "_e", "left"))
    return decoded.select(*FACT_COLUMNS)


def fact_postings_naive(clean: DataFrame, seniority: DataFrame) -> DataFrame:
    """M-3 exactly as the warehouse model is written (with its fan-out);
    kept for differential tests of :func:`fact_postings`."""
    city = base_city(clean)
    jb = clean.distinct()
    c = city.select("CITY", "CITY_STANDARDIZED", "STATE").distinct().withColumnRenamed("STATE", "_c_state")
    s = base_state(city).distinct()
    e = seniority.select("SENIORITY", "SENIORITY_STANDARDIZED").distinct().withColumnRenamed(
        "SENIORITY", "_e_sen")
    j = (jb.join(c, "CITY").join(s, "CITY_STANDARDIZED")
           .join(e, jb["SENIORITY"] == e["_e_sen"]))
    out = collapse_max(j, POSTING_KEY, {
        "CITY": "CITY_STANDARDIZED", "STATE": "STATE_STANDARDIZED",
        "SENIORITY": "SENIORITY_STANDARDIZED"})
    return out.select(*FACT_COLUMNS)


def job_links(clean: DataFrame) -> DataFrame:
    """M-4: distinct links, sorted by (category, ID, title); nulls last.

    Rows are dealt by ranges of the sort columns once: equal rows meet in a
    range, so the distinct needs no shuffle of its own, and ranges are in
    order, so neither does the sort. The rows are written and measured first:
    ranges are as many as keep a task's rows near ``RANGE_BYTES`` in memory,
    however many rows there are, and finding them doesn't compute the rows
    again."""
    order = _asc("JOB_CATEGORY", "ID", "TITLE")
    rows, _, size = written(clean.select(*LINK_COLUMNS), "links")
    if size <= RANGE_BYTES:
        return distinct_rows(rows.repartitionByRange(*order)).orderBy(*order)
    usual = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(usual, -(-size // RANGE_BYTES))  # a given number isn't merged again
    return distinct_rows(rows.repartitionByRange(ranges, *order)).orderBy(*order)


def _asc(*cols: str):
    return [F.col(c).asc_nulls_last() for c in cols]


def jobs_by_city(fact: DataFrame) -> DataFrame:
    """M-5."""
    return (count_distinct_by(fact, ["JOB_CATEGORY", "CITY"])
            .orderBy(*_asc("JOB_CATEGORY", "CITY"), F.col("total_jobs").desc_nulls_first()))


def jobs_by_org(fact: DataFrame) -> DataFrame:
    """M-6."""
    return (count_distinct_by(fact, ["ORGANIZATION", "JOB_CATEGORY"])
            .orderBy(*_asc("ORGANIZATION", "JOB_CATEGORY"), F.col("total_jobs").desc_nulls_first()))


def jobs_by_state(fact: DataFrame) -> DataFrame:
    """M-7."""
    return count_distinct_by(fact, ["JOB_CATEGORY", "STATE"]).orderBy(*_asc("JOB_CATEGORY", "STATE"))


def jobs_by_type(fact: DataFrame) -> DataFrame:
    """M-8."""
    return (count_distinct_by(fact, ["JOB_CATEGORY"])
            .orderBy(*_asc("JOB_CATEGORY"), F.col("total_jobs").desc_nulls_first()))


MARTS = {
    "by_city": ["JOB_CATEGORY", "CITY"],
    "by_org": ["ORGANIZATION", "JOB_CATEGORY"],
    "by_state": ["JOB_CATEGORY", "STATE"],
    "by_type": ["JOB_CATEGORY"],
}


def jobs_marts(fact: DataFrame) -> DataFrame:
    """M-5 ... M-8 at once, by GROUPING SETS: one scan of the fact rows and one
    pair of shuffles for all of them. ``mart`` names the set; the columns that
    a set doesn't group by are null there."""
    columns = list(dict.fromkeys(c for cols in MARTS.values() for c in cols))
    grouped = fact.groupingSets([[F.col(c) for c in cols] for cols in MARTS.values()], *columns).agg(
        F.countDistinct("ID").alias("total_jobs"), F.grouping_id().alias("_set"))
    ids = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cols): name for name, cols in MARTS.items()}
    name = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    return grouped.select(name[F.col("_set").cast("int")].alias("mart"), *columns, "total_jobs")


def mart(marts: DataFrame, name: str) -> DataFrame:
    """One mart of :func:`jobs_marts`, with its own columns."""
    return marts.where(F.col("mart") == name).select(*MARTS[name], "total_jobs")


def jobs_daily(fact: DataFrame) -> DataFrame:
    """M-9: distinct postings per category and raw JOB_DATE, with the date,
    month and year of that date (BIGINT parts)."""
    counted = count_distinct_by(fact, ["JOB_CATEGORY", "JOB_DATE"])
    return counted.select(
        F.col("JOB_DATE").cast("date").alias("date"),
        HF.month_of("JOB_DATE").alias("month"),
        HF.year_of("JOB_DATE").alias("Year"),
        "JOB_CATEGORY", "total_jobs")


def jobs_wow_trend(daily: DataFrame) -> DataFrame:
    """M-10: weekly sums of the daily counts, previous present week, the
    difference and the ratio to the previous week."""
    weekly = sum_by(daily.withColumn("week_start", HF.week_start("date")),
                    ["JOB_CATEGORY", "week_start"], "total_jobs", "total_jobs_this_week")
    trend = lag_trend(weekly, "JOB_CATEGORY", "week_start", "total_jobs_this_week",
                      "total_jobs_last_week", "wow_diff", "wow_diff_pct")
    return trend.orderBy(*_asc("JOB_CATEGORY", "week_start"))
