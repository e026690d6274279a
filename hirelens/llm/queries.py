"""Registered queries of the operators, with DuckDB SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch, ordinals
from hirelens.llm.byte_bpe import encode_decode
from hirelens.llm.conversation_repair import repair, report
from hirelens.llm.embedding_near_dedup import embedding_near_dedup
from hirelens.llm.exact_dedup import exact_dedup
from hirelens.llm.html_extraction import extract_pages
from hirelens.llm.line_dedup import line_dedup
from hirelens.llm.mixing import mix
from hirelens.llm.ngram_join import ngram_join
from hirelens.llm.pii import BASE, find_personal_data
from hirelens.llm.prefix_trie import prefix_trie, turn_key
from hirelens.llm.quality_classifier import classify, train
from hirelens.llm.token_output import read_tokens, write_tokens
from hirelens.llm.url_filter import host_of, url_filter


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, installed on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to files in ascending doc_id order and read back."""
    scratch = Scratch(spark, "token-output")
    path, end, symbols = scratch.path("files"), 2, 50257
    write_tokens(table(spark, sf_dir, "documents"), path, scratch, vocabulary("byte_bpe_50k.json"), end, symbols)
    return read_tokens(spark, path, symbols).select("doc_id", "start", "n_tokens", "ids_crc32")


def captures_and_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every page as a capture, fetched on a date that follows from its id;
    list events that follow from the pages of each host, parent domain and
    first path segment."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr("date_add(date'2024-01-01', cast(page_id % 366 as int))"))
    parts = pages.select(
        "page_id", host_of(F.col("url")).alias("host"),
        F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]+)", 1).alias("seg")).where("host <> ''")

    def dated(kind, value, rows, listed, every, day, action):
        seeds = rows.groupBy(value.alias("value")).agg(F.min("page_id").alias("m")).where(f"m % {every} = 0")
        return seeds.select(F.lit(listed).alias("list"), F.lit(kind).alias("kind"), "value",
                            F.lit(action).alias("action"),
                            F.expr(f"date_add(date'2024-01-01', cast({day} as int))").alias("at"))

    host, domain = F.col("host"), F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    prefix = F.concat("host", F.lit("/"), "seg")
    under = parts.where("seg <> ''")
    events = (dated("host", host, parts, "block", 2, "m % 200", "add")
              .union(dated("host", host, parts, "block", 4, "m % 200 + 40 + m % 30", "remove"))
              .union(dated("host", host, parts, "block", 8, "m % 200 + 120", "add"))
              .union(dated("domain", domain, parts, "block", 1, "300 + m % 20", "add"))
              .union(dated("domain", domain, parts, "block", 1, "330 + m % 20", "remove"))
              .union(dated("prefix", prefix, under, "allow", 3, "m % 300", "add"))
              .union(dated("prefix", prefix, under, "watch", 5, "m % 100", "add")))
    return captures, events


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with the list entries active on their fetch date."""
    return url_filter(*captures_and_events(spark, sf_dir))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their links at Jaccard 0.8."""
    return ngram_join(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes from each, and the pieces
    of blocks that they lie in, with their shards."""
    got = mix(table(spark, sf_dir, "documents"), Scratch(spark, "mixing"))
    return got.documents.select("doc_id", "size", "source_size", "target", "taken", "pieces")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the rank file and decoded again."""
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the row of their text that stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the chunks of lines that stand elsewhere already."""
    left = line_dedup(table(spark, sf_dir, "documents"), Scratch(spark, "line-dedup"))
    return left.select("doc_id", "text", "n_chars", "n_lines", "n_removed")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their links at cosine 0.9 and their component."""
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversation rows with faults that follow from each row's id and turn."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("how"))
    text = F.when(F.col("how") == 1, F.lit("")).when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("how <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("again")).drop("again")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, with the figures of their cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    scratch = Scratch(spark, "conversation-repair")
    got = scratch.save(report(repair(damaged(conversations), scratch)), "report")
    every = conversations.select("conv_id").distinct()
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    names = [c for c in got.columns if c != "conv"]
    return every.join(got, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, nothing.get(c, F.lit(0).cast("long"))).alias(c) for c in names])


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, held) and their turns (conv, place, turn, size),
    each begun with the first turns of a neighbour: of conversation c - c % 5
    the first crc32(c) % 9, then its own after as many. Rows without an id
    belong to no conversation."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"turn": turn_key("role", "text"), "size": F.octet_length("text").cast("long")})
    rows = ordinals(rows, "conv", [F.col("at"), F.col("role"), F.col("text")],
                    [F.col("at"), F.left("role", F.lit(16)), F.left("text", F.lit(32))], scratch, "rows")
    rows = scratch.save(rows.select("conv", "place", "held", "turn", "size"), "turns")
    heads = rows.where("place = 0").select("conv", "held", (F.crc32(F.col("conv").cast("string")) % 9).alias("h"),
                                           F.expr("conv - conv % 5").alias("lender"))
    lent = rows.where("place = 0").select(F.col("conv").alias("lender"), F.col("held").alias("has"))
    heads = heads.join(lent, "lender", "left").withColumn("lent", F.least("h", F.coalesce("has", F.lit(0))))
    heads = scratch.save(heads, "heads")
    begun = (rows.where("place < 8").withColumnRenamed("conv", "lender").drop("held")
             .join(heads.select("conv", "lender", "h"), "lender").where("place < h").select("conv", "place", "turn", "size"))
    own = (rows.drop("held").join(heads.select("conv", "h", "lent"), "conv").where("place >= h")
           .select("conv", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "turn", "size"))
    convs = heads.select("conv", (F.col("lent") + F.greatest(F.col("held") - F.col("h"), F.lit(0))).alias("held"))
    return convs, begun.union(own)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each begun with its neighbour's turns."""
    scratch = Scratch(spark, "prefix-trie")
    trie = prefix_trie(*rebuilt(table(spark, sf_dir, "conversations"), scratch), scratch)
    return trie.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                       "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the personal data in their texts."""
    found = find_personal_data(table(spark, sf_dir, "documents"), Scratch(spark, "pii"))
    counts = [F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


LLM_QUERIES = {
    "op1_token_output": op1_token_output,
    "op2_url_filter": op2_url_filter,
    "op3_ngram_join": op3_ngram_join,
    "op4_mixing": op4_mixing,
    "op5_html_extraction": op5_html_extraction,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_line_dedup": op9_line_dedup,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_pii": op13_pii,
}

_OP2_SQL = r"""
-- the authority is what stands between '//' and the next of '/?#'; its host stands behind the last '@', before a port
WITH cut AS (
  SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS authority,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
named AS (SELECT *, string_split(authority, '@')[-1] AS a FROM cut),
urls AS (
  SELECT page_id, url, path, rtrim(lower(CASE WHEN starts_with(a, '[') THEN string_split(a, ']')[1] || ']' ELSE string_split(a, ':')[1] END), '.') AS host
  FROM named),
parts AS (
  SELECT page_id, host, regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) AS seg FROM urls),
hosts AS (SELECT host AS v, min(page_id) AS m FROM parts WHERE host <> '' GROUP BY 1),
domains AS (SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS v, min(page_id) AS m FROM parts WHERE host <> '' GROUP BY 1),
prefixes AS (SELECT host || '/' || seg AS v, min(page_id) AS m FROM parts WHERE host <> '' AND seg <> '' GROUP BY 1),
events AS (
  SELECT 'block' AS l, 'host' AS k, v, 'add' AS a, m % 200 AS at FROM hosts WHERE m % 2 = 0
  UNION SELECT 'block', 'host', v, 'remove', m % 200 + 40 + m % 30 FROM hosts WHERE m % 4 = 0
  UNION SELECT 'block', 'host', v, 'add', m % 200 + 120 FROM hosts WHERE m % 8 = 0
  UNION SELECT 'block', 'domain', v, 'add', 300 + m % 20 FROM domains
  UNION SELECT 'block', 'domain', v, 'remove', 330 + m % 20 FROM domains
  UNION SELECT 'allow', 'prefix', v, 'add', m % 300 FROM prefixes WHERE m % 3 = 0
  UNION SELECT 'watch', 'prefix', v, 'add', m % 100 FROM prefixes WHERE m % 5 = 0),
caps AS (SELECT page_id, page_id % 366 AS d, coalesce(host, '') AS host, coalesce(path, '') || '/' AS path FROM urls),
hits AS (
  SELECT c.page_id, e.l FROM caps c JOIN events e ON e.a = 'add' AND e.at <= c.d AND (
      (e.k = 'host' AND e.v = c.host) OR (e.k = 'domain' AND c.host <> '' AND ends_with('.' || c.host, '.' || e.v))
      OR (e.k = 'prefix' AND split_part(e.v, '/', 1) = c.host AND starts_with(c.path, '/' || split_part(e.v, '/', 2) || '/')))
  WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.l = e.l AND x.k = e.k AND x.v = e.v
      AND x.at <= c.d AND (x.at > e.at OR (x.at = e.at AND x.a = 'remove'))))
SELECT p.page_id, p.url, date '2024-01-01' + CAST(p.page_id % 366 AS INTEGER) AS fetched, count(h.l) AS n_active,
  coalesce(string_agg(DISTINCT h.l, ',' ORDER BY h.l), '') AS lists,
  coalesce(bool_or(h.l = 'block') AND NOT bool_or(h.l = 'allow'), false) AS dropped
FROM pages p LEFT JOIN hits h ON h.page_id = p.page_id GROUP BY p.page_id, p.url
"""

_OP7_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_OP12_SQL = """
WITH rows AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'role': role, 'text': text} ORDER BY place) AS turns FROM rows GROUP BY c),
-- crc32 of the decimal id: each byte is mixed in, then eight times a bit is shifted out
steps AS (
  SELECT c, turns, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS s FROM own),
heads AS (
  SELECT c, turns, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], s), lambda a, b:
    CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END),
    CAST(4294967295 AS BIGINT)) % 9 AS h FROM steps),
built AS (
  SELECT x.c, list_concat(coalesce(g.turns[1:x.h], []), x.turns[x.h + 1:]) AS s
  FROM heads x LEFT JOIN own g ON g.c = x.c - x.c % 5),
members AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built),
nodes AS (
  SELECT s[1:d] AS prefix, d, min(c) AS conv, count(*) AS n,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '') AS ends,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(s)[d].text) END AS saved
  FROM members GROUP BY 1, 2),
children AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
leaves AS (SELECT nodes.prefix, nodes.d, nodes.saved, CASE WHEN children.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes LEFT JOIN children ON children.d = nodes.d AND children.prefix = nodes.prefix),
spread AS (SELECT prefix, saved, leaf, unnest(range(0, d + 1)) AS k FROM leaves),
sums AS (SELECT prefix[1:k] AS prefix, k AS d, sum(saved) AS saved, sum(leaf) AS leaves FROM spread GROUP BY 1, 2)
SELECT x.conv AS conv_id, x.d AS depth, p.conv AS parent_conv_id, x.n AS n_convs, coalesce(children.n, 0) AS n_children,
  CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN sums ON sums.d = x.d AND sums.prefix = x.prefix
LEFT JOIN children ON children.d = x.d AND children.prefix = x.prefix
LEFT JOIN nodes p ON p.d = x.d - 1 AND p.prefix = x.prefix[1:x.d - 1]
"""


def llm_oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": _OP2_SQL, "op7_exact_dedup": _OP7_SQL, "op12_prefix_trie": _OP12_SQL}
