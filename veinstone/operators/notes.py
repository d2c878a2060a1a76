"""Markdown notes: export of evidence, and parsing of links under headings back into supervision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.operators.discovery import carry_forward


def export(rows: DataFrame, note: str, section: str, target: str, order: str) -> DataFrame:
    """(note, markdown): a heading per section and a wikilink per row; lines are listed by section and order. A note is a bounded document by its nature."""
    line = F.struct(section, order, F.format_string("- [[%s]]", F.col(target)).alias("line"))
    own = rows.groupBy(note, section).agg(F.sort_array(F.collect_list(line)).alias("l")).select(note, section, F.concat_ws("\n", F.concat(F.lit("## "), section), F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("part"))
    whole = own.groupBy(note).agg(F.sort_array(F.collect_list(F.struct(section, "part"))).alias("p"))
    return whole.select(note, F.concat_ws("\n", F.concat(F.lit("# "), F.col(note).cast("string")), F.array_join(F.transform("p", lambda x: x["part"]), "\n")).alias("markdown"))


def links(notes: DataFrame, note: str, markdown: str) -> DataFrame:
    """(note, line, heading, target): each wikilink with the last heading above it."""
    lines = notes.select(note, F.posexplode(F.split(markdown, "\n")).alias("line", "text"))
    headed = carry_forward(lines, note, "line", F.when(F.col("text").rlike("^#+ "), F.regexp_replace("text", "^#+ ", "")))
    return headed.select(note, "line", "heading", F.explode(F.regexp_extract_all("text", F.lit(r"\[\[([^\]|#]+)"), F.lit(1))).alias("target"))


def supervision(hints: DataFrame, key: str, sign: str, weight: str) -> DataFrame:
    """Per key the signed sum of hints and the number on each side."""
    return hints.groupBy(key).agg(F.sum(F.col(sign) * F.col(weight)).alias("score"), F.count_if(F.col(sign) > 0).alias("n_for"), F.count_if(F.col(sign) < 0).alias("n_against"))
