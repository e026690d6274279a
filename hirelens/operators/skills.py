"""Top skills per role by document frequency (A-8).

The source asks a hosted model for the five most frequent technical and
soft skills per role. Re-aimed as a distributed count: each description is
searched once for all terms of a skills lexicon (one pattern, so no join and no
cross product), distinct descriptions are counted per (role, kind, skill), the
top k per (role, kind) are kept with a partial group limit, and each kind
becomes one column.

A lexicon finds what it lists. :func:`scored_terms` needs none: it scores every
word and pair of words by how much more often a role's descriptions hold it
than the others do (log-likelihood ratio of the document frequencies).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.operators.joins import broadcast_if_small
from hirelens.operators.topk import top_k_per_group
from hirelens.session import written

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
TECHNICAL = "technical"
SOFT = "soft"


def lexicon_terms(technical: list[str] | None = None, soft: list[str] | None = None
                  ) -> list[tuple[str, str]]:
    technical = rules.TECHNICAL_SKILLS if technical is None else technical
    soft = rules.SOFT_SKILLS if soft is None else soft
    return [(s, TECHNICAL) for s in technical] + [(s, SOFT) for s in soft]


def words(text: Column) -> Column:
    """Lower-case word tokens (letters and digits), empties removed."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT, -1), lambda w: w != F.lit(""))


def ngrams(tokens: Column, n: int, first_words: list[str] | None = None) -> Column:
    """Space-joined word n-grams of a token array, in one linear pass: the
    array is zipped with its shifted copies (no per-position slicing, which
    would re-evaluate the token array for every position). With
    ``first_words`` only n-grams starting with one of them are built."""
    if n == 1:
        return tokens
    shifted = [tokens] + [F.slice(tokens, k + 1, F.greatest(F.size(tokens) - F.lit(k), F.lit(0)))
                          for k in range(1, n)]
    zipped = F.arrays_zip(*[s.alias(f"w{k}") for k, s in enumerate(shifted)])
    starts = F.array(*[F.lit(w) for w in sorted(set(first_words))]) if first_words else None

    def keep(z):
        full = z[f"w{n - 1}"].isNotNull()
        return full & F.array_contains(starts, z["w0"]) if starts is not None else full
    return F.transform(F.filter(zipped, keep),
                       lambda z: F.concat_ws(" ", *[z[f"w{k}"] for k in range(n)]))


def lexicon_pattern(terms: list[str]) -> str:
    """One pattern that finds, at every place where a word starts, the longest
    term that starts there (group 1, of zero width, so terms may overlap). Terms
    are merged letter by letter, so a place is given up at its first letter that
    no term has."""
    gap, more = r"[^\p{L}\p{N}]++", r"[\p{L}\p{N}]"
    root: dict = {}
    for t in sorted(set(terms)):
        node = root
        for ch in t:
            node = node.setdefault(ch, {})
        node[""] = {}

    def build(node: dict) -> str:
        parts = [(gap if ch == " " else re.escape(ch)) + build(below) for ch, below in sorted(node.items()) if ch]
        if "" in node:  # the longer ones first
            parts.append(f"(?!{more})")
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"
    begins = "".join(re.escape(ch) for ch in sorted(root))
    return f"(?=[{begins}])(?<!{more})(?=({build(root)}))"


def matched_terms(text: Column, terms: list[str]) -> Column:
    """Distinct lexicon terms present in ``text`` as whole word sequences, by
    one pass of one pattern over the text; words may be apart by any characters
    but letters and digits."""
    found = F.regexp_extract_all(F.lower(text), F.lit(lexicon_pattern(terms)), F.lit(1))
    found = F.transform(F.array_distinct(found), lambda x: F.regexp_replace(x, TOKEN_SPLIT, " "))
    begun = {t: [p for p in sorted(set(terms)) if t.startswith(p + " ")] for t in terms}
    if any(begun.values()):  # shorter terms that start at the same place
        with_begun = F.create_map(*[x for t, ps in sorted(begun.items()) if ps for x in (F.lit(t), F.array(*[F.lit(p) for p in [t, *ps]]))])
        found = F.flatten(F.transform(found, lambda x: F.coalesce(F.try_element_at(with_begun, x), F.array(x))))
    return F.array_distinct(found)


def skill_counts(df: DataFrame, group: str, text: str, doc_id: str,
                 lexicon: list[tuple[str, str]] | None = None) -> DataFrame:
    """Distinct documents per (group, kind, skill), and one row with a null
    skill for each group.

    A row is reduced to its matched terms before anything moves; the rows of a
    document are merged, so a document gives a term once and the count is a
    plain one, combined map-side. The hits themselves are never shuffled."""
    lexicon = lexicon or lexicon_terms()
    kind_of = F.create_map(*[F.lit(x) for pair in lexicon for x in pair])
    found = df.select(F.col(f"`{group}`").alias("_group"), F.col(f"`{doc_id}`").alias("_doc"),
                      F.coalesce(matched_terms(F.col(f"`{text}`"), [s for s, _ in lexicon]),
                                 F.array().cast("array<string>")).alias("terms"))
    merged = (found.groupBy("_group", "_doc")
              .agg(F.array_distinct(F.flatten(F.collect_set("terms"))).alias("terms")))
    # the null stands for the group itself
    hits = merged.select("_group", F.when(F.col("_doc").isNull(), F.lit(0)).otherwise(1).alias("one"),
                         F.explode(F.concat("terms", F.array(F.lit(None).cast("string")))).alias("skill"))
    kind = F.when(F.col("skill").isNotNull(), F.try_element_at(kind_of, F.coalesce("skill", F.lit(""))))
    return (hits.groupBy("_group", "skill").agg(F.sum("one").alias("n_docs"))
            .select(F.col("_group").alias(group), kind.alias("kind"), "skill", "n_docs"))


def top_skills(df: DataFrame, group: str, text: str, doc_id: str, *, k: int = rules.TOP_SKILLS,
               lexicon: list[tuple[str, str]] | None = None, group_alias: str = "job_title",
               sep: str = ", ") -> DataFrame:
    """One row per group: ``job_title``, ``Top k Technical Skills``,
    ``Top k Soft Skills`` (most documents first, ties by skill name; an
    absent kind gives an empty string). The table is read once: the groups
    come with the counts."""
    counts = skill_counts(df, group, text, doc_id, lexicon).filter("skill IS NULL OR n_docs > 0")
    top = top_k_per_group(counts, [group, "kind"],
                          [F.col("n_docs").desc(), F.col("skill").asc()], k, rank_col="rank")

    def listed(kind: str) -> Column:
        mine = F.collect_list(F.when(F.col("kind") == kind, F.struct("rank", "skill")))  # k rows at most
        return F.array_join(F.transform(F.sort_array(mine), lambda s: s["skill"]), sep)
    return (top.groupBy(F.col(f"`{group}`").alias(group_alias))
            .agg(listed(TECHNICAL).alias(f"Top {k} Technical Skills"), listed(SOFT).alias(f"Top {k} Soft Skills")))


def log_likelihood(a: Column, group: Column, df: Column, n: Column) -> Column:
    """G2 of a 2 x 2 table: ``a`` of ``group`` documents of a group and ``df``
    of all ``n`` documents hold a term."""
    cells = [(a, group, df), (group - a, group, n - df), (df - a, n - group, df), (n - group - df + a, n - group, n - df)]
    parts = [F.when(o > 0, o * F.ln(o * n / (r * c.cast("double")))).otherwise(F.lit(0.0)) for o, r, c in cells]
    return 2 * (parts[0] + parts[1] + parts[2] + parts[3])


def scored_terms(df: DataFrame, group: str, text: str, *, k: int = 10, min_docs: int = 3, sizes: tuple[int, ...] = (1, 2)) -> DataFrame:
    """For each group the ``k`` terms (word sequences of the ``sizes``) that its
    rows hold most above the others: group, term, n_docs, all_docs, score. Each
    row is a document of its own; a term counts once a row, from ``min_docs``
    rows of the group on. Ties go by term.

    A row's terms are made distinct in the row and counted by (group, term),
    combined map-side, so a hot group or word is a number before it moves; the
    counts meet by term (a row for each group) for the counts over all groups."""
    tokens = words(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    terms = F.array_distinct(F.concat(*[ngrams(F.col("_tokens"), n) for n in sizes]))
    # a column of its own: a text is cut into words once, not for every place in ``terms``
    rows = df.select(F.col(f"`{group}`").alias("_group"), tokens.alias("_tokens")).select("_group", terms.alias("terms"))
    held, _, _ = written(rows.groupBy("_group").agg(F.count("*").alias("rows")), "group-sizes")  # a row for each group
    # explode_outer: for explode, a filter on the terms is put before the join of ``df``, which finds them all once more
    counts = rows.select("_group", F.explode_outer("terms").alias("term")).where("term IS NOT NULL").groupBy("_group", "term").agg(F.count("*").alias("n_docs"))
    counts = counts.withColumn("all_docs", F.sum("n_docs").over(Window.partitionBy("term"))).where(F.col("n_docs") >= min_docs)
    held = broadcast_if_small(held.withColumn("n", held.select(F.sum("rows")).scalar()).withColumnRenamed("_group", "_g"))
    scored = counts.join(held, F.col("_group").eqNullSafe(F.col("_g"))).where(F.col("n_docs") * F.col("n") > F.col("rows") * F.col("all_docs"))
    score = F.round(log_likelihood(F.col("n_docs"), F.col("rows"), F.col("all_docs"), F.col("n")), 6)
    top = top_k_per_group(scored.withColumn("score", score), ["_group"], [F.col("score").desc(), F.col("term").asc()], k)
    return top.select(F.col("_group").alias(group), "term", "n_docs", "all_docs", "score")
