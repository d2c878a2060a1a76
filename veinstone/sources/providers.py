"""Article records of public catalogue APIs as one table, from saved pages or a paged client.

`articles` maps the raw JSON records of a provider (a column of text) to the common columns; it
needs no network and no schema inference. `PagedSource` is a Python Data Source that reads pages
through a client given by name, one input partition a query.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from veinstone.functions.text import article_key, blank, inverted_index_text, strip_html

ARTICLE = "article_key string, provider string, source_id string, doi string, title string, abstract string, year int, venue string, article_type string, is_oa boolean, oa_url string, source_url string, license string, language string, raw_json string"
#: The fields of a record that are read, by provider.
SCHEMAS = {
    "openalex": "id string, doi string, title string, publication_year int, type string, language string, open_access struct<is_oa: boolean, oa_url: string>, best_oa_location struct<pdf_url: string, landing_page_url: string, license: string>, primary_location struct<source: struct<display_name: string>>, abstract_inverted_index map<string, array<int>>",
    "crossref": "DOI string, title array<string>, abstract string, issued struct<`date-parts`: array<array<int>>>, type string, language string, URL string, `container-title` array<string>, link array<struct<URL: string, `content-type`: string>>, license array<struct<URL: string>>",
    "europepmc": "id string, doi string, title string, abstractText string, pubYear string, journalTitle string, isOpenAccess string, license string, language string, fullTextUrlList struct<fullTextUrl: array<struct<url: string, documentStyle: string>>>",
    "arxiv": "id string, title string, summary string, published string, doi string, link array<struct<_href: string, _type: string>>",
}


def articles(raw: DataFrame, provider: str, json: str = "raw_json", oa_required: bool = False) -> DataFrame:
    """Records of one provider as articles; unreadable ones are dropped."""
    r = raw.select(F.col(json).alias("raw_json"), F.from_json(json, SCHEMAS[provider], {"mode": "PERMISSIVE"}).alias("r")).where("r is not null")
    c = F.col
    none = F.lit("")
    if provider == "openalex":
        oa = F.coalesce(c("r.best_oa_location.pdf_url"), c("r.best_oa_location.landing_page_url"), c("r.open_access.oa_url"))
        cols = dict(source_id=c("r.id"), doi=F.regexp_replace(c("r.doi"), "^https?://(dx\\.)?doi\\.org/", ""), title=c("r.title"), abstract=inverted_index_text(c("r.abstract_inverted_index")), year=c("r.publication_year"), venue=c("r.primary_location.source.display_name"), article_type=kind(c("r.type")), is_oa=c("r.open_access.is_oa"), oa_url=oa, source_url=c("r.id"), license=c("r.best_oa_location.license"), language=c("r.language"))
    elif provider == "crossref":
        links = F.filter(c("r.link"), lambda x: x["content-type"].rlike("pdf|xml|text"))
        cols = dict(source_id=c("r.DOI"), doi=c("r.DOI"), title=F.get(c("r.title"), F.lit(0)), abstract=strip_html(c("r.abstract")), year=F.get(F.get(c("r.issued")["date-parts"], F.lit(0)), F.lit(0)), venue=F.get(c("r")["container-title"], F.lit(0)), article_type=kind(c("r.type")), is_oa=F.size(F.coalesce(c("r.license"), F.array())) > 0, oa_url=F.coalesce(F.get(links, F.lit(0))["URL"], c("r.URL")), source_url=c("r.URL"), license=F.get(c("r.license"), F.lit(0))["URL"], language=c("r.language"))
    elif provider == "europepmc":
        urls = c("r.fullTextUrlList.fullTextUrl")
        cols = dict(source_id=c("r.id"), doi=c("r.doi"), title=c("r.title"), abstract=strip_html(c("r.abstractText")), year=c("r.pubYear").try_cast("int"), venue=c("r.journalTitle"), article_type=F.lit("journal-article"), is_oa=c("r.isOpenAccess") == "Y", oa_url=F.coalesce(F.get(F.filter(urls, lambda u: u["documentStyle"] == "pdf"), F.lit(0)), F.get(urls, F.lit(0)))["url"], source_url=F.concat(F.lit("https://europepmc.org/article/MED/"), c("r.id")), license=c("r.license"), language=c("r.language"))
    else:
        link = F.coalesce(F.get(F.filter(c("r.link"), lambda x: x["_type"] == "application/pdf"), F.lit(0)), F.get(c("r.link"), F.lit(0)))["_href"]
        cols = dict(source_id=c("r.id"), doi=c("r.doi"), title=F.trim(F.regexp_replace(c("r.title"), r"\s+", " ")), abstract=F.trim(F.regexp_replace(c("r.summary"), r"\s+", " ")), year=F.substring(c("r.published"), 1, 4).try_cast("int"), venue=F.lit("arXiv"), article_type=F.lit("preprint"), is_oa=F.lit(True), oa_url=F.coalesce(link, c("r.id")), source_url=c("r.id"), license=none, language=F.lit("en"))
    text = {k: blank(v) for k, v in cols.items() if k not in ("year", "is_oa")}
    out = r.select(F.lit(provider).alias("provider"), *[(text.get(k) if k in text else v).alias(k) for k, v in cols.items()], "raw_json").withColumn("is_oa", F.coalesce("is_oa", F.lit(False)))
    out = out.withColumn("article_key", article_key(c("doi"), c("source_id"), c("title"))).withColumn("language", language(c("language")))
    out = out.select(*[x.split()[0] for x in ARTICLE.split(", ")])
    return out.where("is_oa and oa_url <> ''") if oa_required else out


ATOM, ARXIV = "{http://www.w3.org/2005/Atom}", "{http://arxiv.org/schemas/atom}"


def atom_records(feed: str) -> list[str]:
    """The entries of an Atom feed as JSON records of the provider arxiv; of links those with a relation `alternate`, or none, count."""
    import json
    from xml.etree import ElementTree

    out = []
    for entry in ElementTree.fromstring(feed).findall(f"{ATOM}entry"):
        text = lambda tag: (entry.findtext(tag) or "").strip()  # noqa: E731,B023
        links = [{"_href": (n.get("href") or "").strip(), "_rel": (n.get("rel") or "").strip(), "_type": (n.get("type") or "").strip()} for n in entry.findall(f"{ATOM}link")]
        out.append(json.dumps({"id": text(f"{ATOM}id"), "title": text(f"{ATOM}title"), "summary": text(f"{ATOM}summary"), "published": text(f"{ATOM}published"), "doi": text(f"{ARXIV}doi").lower(), "link": [x for x in links if x["_href"] and x["_rel"] in ("", "alternate")]}))
    return out


def atom_page(feed: str, start: int, size: int) -> tuple[list[str], str | None]:
    """A page's records and the next page's offset; none after a page that is short."""
    records = atom_records(feed)
    return records, str(start + len(records)) if len(records) >= size else None


def wrapped_query(provider: str, query: str) -> str:
    """A query as the provider wants it: of Europe PMC open access is part of it."""
    return f"({query}) AND OPEN_ACCESS:y" if provider == "europepmc" else query


def kind(c: Column) -> Column:
    low = F.lower(blank(c))
    return F.when(low.isin("article", "journal-article"), "journal-article").when(low.isin("posted-content", "preprint"), "preprint").otherwise(low)


def language(c: Column) -> Column:
    low = F.lower(F.trim(blank(c)))
    return F.when(low.isin("eng", "english"), "en").when(low.isin("deu", "ger", "german"), "de").when(low.isin("fra", "fre", "french"), "fr").otherwise(F.substring(low, 1, 2))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(q) for q in self.options.get("queries", "").split("|") if q]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, name = self.options["client"].partition(":")
        client = getattr(importlib.import_module(module), name)
        token, page, seen = None, 0, set()
        while page < int(self.options.get("max_pages", "60")):
            records, token = client(partition.value, token)
            for raw in records:
                yield (partition.value, page, raw)
            page += 1
            if not records or token is None or token in seen:  # the last page, or a cursor that repeats
                return
            seen.add(token)


class PagedSource(DataSource):
    """format("veinstone_pages"): options client ("module:function" of (query, token) -> (records, next token)), queries (by |), max_pages."""

    @classmethod
    def name(cls) -> str:
        return "veinstone_pages"

    def schema(self) -> str:
        return "query string, page_index int, raw_json string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))
