"""Enrichment plans: seniority dictionary (M-11), translation (F-28),
distinct-value functions (U-2 / U-3) and top skills by role (M-12)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import functions as HF
from hirelens import rules
from hirelens.operators import anti_join_new, broadcast_if_small, digest, first_per_key
from hirelens.operators.skills import scored_terms, top_skills
from hirelens.session import file_system, written


def seniority_levels(clean: DataFrame) -> DataFrame:
    """S-7: distinct SENIORITY, then lower-cased with no second distinct, so
    levels differing only in case appear once per original spelling."""
    return clean.select("SENIORITY").distinct().select(F.lower("SENIORITY").alias("SENIORITY"))


def apply_to_distinct(df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series],
                      out_col: str, *, default: str | None = None) -> DataFrame:
    """U-2 / U-3: run ``fn`` once per distinct non-null value of ``column``
    (Arrow batches through ``mapInPandas``) and return the value → result
    dictionary with ``failed``. When the call for a batch raises, its values
    are tried one by one, and only those that raise get ``default`` and
    ``failed``; ``failed`` can be counted, so no failure is silent."""
    values = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()

    def one(value):
        try:
            return pd.Series(fn(pd.Series([value]))).iloc[0], False
        except Exception:  # the source keeps going with a default label
            return default, True

    def run(batches):
        for pdf in batches:
            try:
                out = list(pd.Series(fn(pdf["value"])).astype(object))
                failed = [False] * len(pdf)
            except Exception:  # some value of the batch failed
                out, failed = zip(*map(one, pdf["value"]))
            yield pd.DataFrame({"value": pdf["value"].to_numpy(), out_col: pd.Series(list(out), dtype=object), "failed": list(failed)})

    return values.mapInPandas(run, f"value string, `{out_col}` string, failed boolean")


def kept_dictionary(df: DataFrame, columns: list[str], fn: Callable[[pd.Series], pd.Series], root: str,
                    *, out_col: str = "translated") -> tuple[DataFrame, int, int]:
    """U-2 / U-3 with memory: a stored value -> result table at ``root``. Only
    values of ``columns`` that it has no answer for are called; their answers
    are appended in one commit, failures too, marked, so that a later run calls
    them again. Returns the dictionary (value, result; one row a value), how
    many values were called and how many failed."""
    spark = df.sparkSession
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(out_col, T.StringType()), T.StructField("failed", T.BooleanType())])
    fs, path = file_system(spark, root)

    def stored() -> DataFrame:
        rows = spark.read.schema(schema).parquet(root) if fs.exists(path) else spark.createDataFrame([], schema)
        return rows.where("NOT failed")
    values = df.select(F.explode(F.array(*[F.col(f"`{c}`").cast("string") for c in columns])).alias("value")).where("value IS NOT NULL").distinct()
    values, _, _ = written(values, "values")  # compared and called: ``df`` is read once
    todo = anti_join_new(values, stored(), "value")
    seen = Observation()
    (apply_to_distinct(todo, "value", fn, out_col)
     .observe(seen, F.count(F.lit(1)).alias("called"), F.count_if("failed").alias("failed")).write.mode("append").parquet(root))
    got = seen.get
    # two runs at once may both have answered a value
    return stored().groupBy("value").agg(F.max(out_col).alias(out_col)), int(got["called"] or 0), int(got["failed"] or 0)


def seniority_dictionary(clean: DataFrame,
                         classifier: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """M-11: SENIORITY (lower case) → SENIORITY_STANDARDIZED.

    Default classifier: the deterministic rules of
    :func:`hirelens.functions.seniority_category`, as a column expression.
    A custom ``classifier`` (for example a model client) runs once per
    distinct level through :func:`apply_to_distinct`, failures defaulting
    to 'Not Applicable'. The answer is normalized by the label map (P-11).
    """
    levels = seniority_levels(clean)
    if classifier is None:
        category = HF.seniority_category("SENIORITY")
        return levels.select("SENIORITY", HF.seniority_label(category).alias("SENIORITY_STANDARDIZED"))
    answers = apply_to_distinct(levels, "SENIORITY", classifier, "answer",
                                default=rules.SENIORITY_DEFAULT)
    joined = levels.join(answers, levels["SENIORITY"] == answers["value"], "left")
    label = F.when(levels["SENIORITY"].isNull(), F.lit(rules.SENIORITY_DEFAULT)).otherwise(
        HF.seniority_label(F.coalesce(F.col("answer"), F.lit(""))))
    return joined.select(levels["SENIORITY"], label.alias("SENIORITY_STANDARDIZED"))


TRANSLATED_COLUMNS = ["CITY", "STATE", "ORGANIZATION", "SENIORITY"]


def translate_columns(df: DataFrame, columns: list[str] | None = None, *, variant: str = "v2",
                      translator: Callable[[pd.Series], pd.Series] | None = None, store: str | None = None) -> DataFrame:
    """F-28, translation to English of the listed columns.

    The placeholder rules apply first, as one column expression: v1 writes 'NA'
    for null or empty; v2 writes 'NA' for empty and for the texts 'nan' / 'na'
    and keeps null. Without a ``translator`` (no external service) every other
    value is taken as already English. With one, the distinct other values of
    all columns are translated once and looked up (J-5); a value that fails is
    'NA' in v1 and stays as it is in v2. With ``store`` the answers are kept
    there, and only values without one are called (:func:`kept_dictionary`).
    """
    columns = columns or TRANSLATED_COLUMNS
    tokens = rules.TRANSLATE_SKIP_TOKENS if variant == "v2" else None

    def rule(c: str):
        shown = HF.missing_as_na(c, tokens)
        return F.when(F.col(f"`{c}`").isNotNull(), shown) if variant == "v2" else shown
    if translator is None:
        return df.withColumns({c: rule(c) for c in columns})

    def todo(c: str):  # what the placeholder rules leave as it is, tokens of that name too
        skip = (F.col(f"`{c}`") == "") if not tokens else (F.col(f"`{c}`") == "") | F.lower(HF.strip(F.col(f"`{c}`"))).isin(tokens)
        return F.when(~skip, F.col(f"`{c}`"))
    values = df.select(*[todo(c).alias(c) for c in columns])
    if store:
        known, _, _ = kept_dictionary(values, columns, translator, store)
    else:
        stacked = values.select(F.explode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("value"))
        known = apply_to_distinct(stacked, "value", translator, "translated").filter(~F.col("failed")).select("value", "translated")
    known = broadcast_if_small(known.withColumnsRenamed({"value": "_dk", "translated": "_dv"}))
    out = df
    for c in columns:
        unknown = F.lit(rules.NA_TOKEN) if variant == "v1" else F.col(f"`{c}`")
        new = F.when(todo(c).isNotNull(), F.coalesce("_dv", unknown)).otherwise(rule(c))
        j = out.join(known, todo(c) == F.col("_dk"), "left")
        out = j.select(*[new.alias(x) if x == c else F.col(f"`{x}`") for x in df.columns])
    return out


def role_descriptions(sheets: DataFrame, *, sheet: str = "sheet_no", row: str = "row_no",
                      text: str = "Job_Description") -> DataFrame:
    """M-12 input: per sheet, the first row of each description (A-6); the
    later sheet first (U-PRE) stays in the order columns."""
    return first_per_key(sheets, [sheet, text], [row])


def top_job_skills(descriptions: DataFrame, *, role: str = "Job_Title", text: str = "Job_Description",
                   roles: list[str] | None = None) -> DataFrame:
    """M-12: top technical and soft skills per role, counted over the unique
    descriptions of the role (the source joins ``unique()`` descriptions),
    for exactly the listed roles (default the three target titles); a role
    without descriptions gets empty strings."""
    roles = roles or rules.TARGET_TITLES
    spark = descriptions.sparkSession
    d = descriptions.filter(F.col(role).isin(roles)).filter(F.col(text).isNotNull())
    # a description is counted by its digest, so texts never move
    skills = top_skills(d.select(role, text, digest(text).alias("_description")), role, text, "_description")
    names = spark.createDataFrame([(r,) for r in roles], "job_title string")
    return (names.join(skills, "job_title", "left")
                 .select("job_title",
                         *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c)
                           for c in skills.columns if c != "job_title"]))


def role_terms(descriptions: DataFrame, *, role: str = "Job_Title", text: str = "Job_Description", k: int = 10) -> DataFrame:
    """M-12 without a lexicon: the terms that set each role's unique
    descriptions apart from those of the other roles."""
    unique = first_per_key(descriptions.filter(F.col(text).isNotNull()), [role, text], ["sheet_no", "row_no"])
    return scored_terms(unique, role, text, k=k)
