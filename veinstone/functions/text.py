"""Text expressions: tokens, overlaps, keys, sentences, HTML."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that do not count as query or title tokens.
STOPWORDS = ("a", "an", "and", "at", "by", "for", "from", "in", "into", "is", "of", "on", "or", "that", "the", "to", "with")


def blank(c: Column) -> Column:
    """A string column with null as the empty string, the convention of all evidence tables."""
    return F.coalesce(c, F.lit(""))


def filled(c: Column) -> Column:
    return F.trim(blank(c)) != ""


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, without stop words and single characters."""
    return F.filter(F.regexp_extract_all(F.lower(blank(text)), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: (F.length(t) > 1) & ~t.isin(*STOPWORDS))


def overlap_ratio(required: Column, observed: Column) -> Column:
    """Share of the distinct required tokens that are observed; 0 if either side has none."""
    need = F.array_distinct(required)
    return F.when((F.size(need) > 0) & (F.size(observed) > 0), F.size(F.array_intersect(need, observed)) / F.size(need)).otherwise(F.lit(0.0))


def phrase_overlap(phrases: list[str], text: Column) -> Column:
    """Share of the phrases that the text contains."""
    if not phrases:
        return F.lit(0.0)
    low = F.lower(blank(text))
    return reduce(lambda a, b: a + b, [low.contains(p).cast("int") for p in phrases]) / F.lit(float(len(phrases)))


def bigrams(query: str) -> list[str]:
    import re

    words = [w for w in re.findall("[a-z0-9]+", query.lower()) if len(w) > 1 and w not in STOPWORDS]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def title_key(title: Column) -> Column:
    """Lower case without anything but letters, digits and underscores, of any script."""
    return F.regexp_replace(F.lower(blank(title)), r"(?U)\W+", "")


def stable_id(*parts: Column, n: int = 20) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *[blank(p.cast("string")) for p in parts]).cast("binary")), 1, n)


def article_key(doi: Column, source_id: Column, title: Column) -> Column:
    """From the first of DOI, source id and title that is filled."""
    first = F.coalesce(*[F.when(filled(c), F.trim(c)) for c in (doi, source_id, title)], F.lit(""))
    return F.substring(F.sha1(first.cast("binary")), 1, 16)


def strip_html(html: Column) -> Column:
    """Tags to blanks, runs of white space to one."""
    return F.trim(F.regexp_replace(F.regexp_replace(blank(html), "<[^>]+>", " "), r"\s+", " "))


def sentences(text: Column) -> Column:
    """Split after . ! ? and white space; line breaks count as blanks."""
    return F.filter(F.split(F.regexp_replace(blank(text), "[\r\n]+", " "), r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")


def window_text(parts: Column, i: Column, radius: int) -> Column:
    """Parts i - radius to i + radius (from 0) joined by blanks."""
    low = F.greatest(i - radius, F.lit(0))
    return F.array_join(F.slice(parts, low + 1, F.least(i + radius, F.size(parts) - 1) - low + 1), " ")


#: Locators that name a line.
LOCATOR_LINE = r"(?:line|figure-cue-line|sentence):([0-9]+)"


def locator_line(locator: Column) -> Column:
    """The line number in a locator such as line:12 or sentence:3; null in others."""
    return F.try_element_at(F.regexp_extract_all(blank(locator), F.lit(LOCATOR_LINE), F.lit(1)), F.lit(1)).cast("int")


def line_number(explicit: Column, locator: Column) -> Column:
    """A line number as given, else that in the locator."""
    return F.coalesce(explicit.cast("int"), locator_line(locator))


#: Characters that stand for others, and how degrees Celsius come out of scans.
LOOKALIKES = str.maketrans("−–—‑‒СсКкµ", "-----CcKkμ")
SCANNED_CELSIUS = (r"/\s*c\s*\d+\s*c", r"\bo\s*c\b")


def normalise_dashes(text: Column) -> Column:
    """Dashes, micro signs and Cyrillic look-alikes replaced, degrees Celsius as C."""
    out = F.translate(blank(text), "".join(map(chr, LOOKALIKES)), "".join(map(chr, LOOKALIKES.values())))
    return reduce(lambda t, pattern: F.regexp_replace(t, f"(?i){pattern}", " c "), SCANNED_CELSIUS, out)


def key_clean(text: Column) -> Column:
    """Lower case, anything but letters and digits as one underscore; `unknown` if nothing is left."""
    return F.coalesce(F.nullif(slug(text), F.lit("")), F.lit("unknown"))


def json_list(text: Column) -> Column:
    """The items of a JSON list of texts, trimmed and without blank ones; none for anything else (single quotes are no JSON)."""
    items = F.from_json(blank(text), "array<string>", {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    listed = F.when(F.ltrim(blank(text)).startswith("["), items)
    return F.filter(F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda x: F.trim(blank(x))), lambda x: x != "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(blank(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def word_in(text: Column, words: list[str]) -> Column:
    """Whether one of the words stands in the text by itself."""
    import re

    # letters of any script are part of words in every engine that this is compared with
    return F.lower(blank(text)).rlike(r"(^|[^\p{L}\p{N}_])(" + "|".join(map(re.escape, words)) + r")([^\p{L}\p{N}_]|$)")


def inverted_index_text(index: Column) -> Column:
    """The text of a map from word to its positions."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(placed), lambda x: x["w"]), " ")
