"""CSV block extraction from free text (S-11).

Rule: split the stripped text into lines; the first line whose lower-case
form starts with ``job_title`` is the header, and it plus the next three
lines form the block; with no such line the whole text is the block. The
block is cut into records by its quotes, so a quoted field may hold line
breaks; the first record is the header, the others are rows. All of it is
array arithmetic inside one row: no shuffle, whole texts.

Cutting: between the quotes of a text, every second piece lies inside a field.
Its line breaks are swapped for noncharacters (U+FDD0, U+FDD1), the text is
split at the breaks that are left, and they are swapped back. A quote that is
never closed runs to the end of the block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import strip

# Line breaks as Python's str.splitlines() knows them.
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
HEADER_PREFIX = "job_title"
BLOCK_ROWS = 3
RECORD_BREAKS = r"\r\n|[\n\r]"
HELD_BREAKS = "\ufdd0\ufdd1"
ROW_SCHEMA = "job_title STRING, technical_skills STRING, soft_skills STRING"


def csv_records(text: Column) -> Column:
    """The records of a CSV text, as an array."""
    pieces = F.transform(F.split(text, '"', -1), lambda x, i: F.when(i % 2 == 1, F.translate(x, "\n\r", HELD_BREAKS)).otherwise(x))
    cut = F.split(F.array_join(pieces, '"'), RECORD_BREAKS, -1)
    return F.transform(cut, lambda x: F.translate(x, HELD_BREAKS, "\n\r"))


def csv_block_rows(df: DataFrame, id_cols: list[str], text_col: str, *, header_prefix: str = HEADER_PREFIX,
                   block_rows: int = BLOCK_ROWS, schema: str = ROW_SCHEMA) -> DataFrame:
    """One output row per CSV data row of each text's block:
    ``*id_cols, row_no, <schema fields>`` (fields by position; blank lines
    are skipped as a CSV reader does)."""
    lines = F.split(strip(F.col(text_col)), LINE_BREAKS, -1)
    flags = F.transform(lines, lambda l: F.lower(l).startswith(header_prefix))
    hdr = F.array_position(flags, True).cast("int")
    found = F.array_join(F.slice(lines, F.greatest(hdr, F.lit(1)), block_rows + 1), "\n")
    block = csv_records(F.when(hdr > 0, found).otherwise(strip(F.col(text_col))))
    body = F.when(F.size(block) > 1, F.slice(block, 2, F.greatest(F.size(block) - 1, F.lit(1)))
                  ).otherwise(F.array().cast("array<string>"))
    rows = F.filter(body, lambda l: F.length(strip(l)) > 0)
    parsed = (df.select(*id_cols, F.posexplode(rows).alias("row_no", "line"))
                .select(*id_cols, "row_no", F.from_csv(F.col("line"), schema, {"escape": '"'}).alias("r")))
    return parsed.select(*id_cols, "row_no", "r.*")
