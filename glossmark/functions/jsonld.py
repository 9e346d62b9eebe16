"""JSON-LD in pages: blocks, repaired where control characters break them, and the objects of wanted types at any depth."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from glossmark.functions.html import meta_content


def blocks(html: Column) -> Column:
    """array<string>: the page's JSON-LD scripts, control characters as spaces."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    return F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"[\x00-\x1f]", " ")))


def walk(value: object) -> Iterator[dict]:
    """All objects below a value, it first, in document order."""
    pending = [value]
    while pending:
        value = pending.pop()
        if isinstance(value, dict):
            yield value
            pending += reversed(list(value.values()))
        elif isinstance(value, list):
            pending += reversed(value)


def objects_of(types: tuple[str, ...]):
    """A function of array<string> blocks to array<string>: the objects whose @type is one of types; unreadable blocks have none.

    The depth is unknown, so this is Python, in Arrow batches; what is to be done with the objects is again SQL on JSON."""

    @F.arrow_udf(ArrayType(StringType()))
    def find(pages: pa.Array) -> pa.Array:
        rows = []
        for page in pages.to_pylist():
            found = []
            for block in page or []:
                try:
                    value = json.loads(block)
                except ValueError:
                    continue
                for x in walk(value):
                    kinds = x.get("@type")
                    if set(kinds if isinstance(kinds, list) else [kinds]) & set(types):
                        found.append(json.dumps(x, ensure_ascii=False))
            rows.append(found)
        return pa.array(rows, pa.list_(pa.string()))

    return find


def _said(text: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))


def _people(value: Column) -> Column:
    """Names of an author, an object or a list of either, with a comma between them."""
    listed = F.when(F.startswith(value, F.lit("[")), F.from_json(value, "array<string>")).otherwise(F.array(value))
    name = lambda x: F.when(F.startswith(x, F.lit("{")), F.coalesce(_said(F.get_json_object(x, "$.name")), _said(F.get_json_object(x, "$['@id']")))).otherwise(_said(x))
    return F.nullif(F.array_join(F.array_compact(F.transform(listed, name)), ", "), F.lit(""))


def _picture(value: Column) -> Column:
    first = F.when(F.startswith(value, F.lit("[")), F.get(F.from_json(value, "array<string>"), F.lit(0))).otherwise(value)
    return F.when(F.startswith(first, F.lit("{")), F.coalesce(_said(F.get_json_object(first, "$.url")), _said(F.get_json_object(first, "$.contentUrl")))).otherwise(_said(first))


def article(html: Column) -> Column:
    """struct of an article's metadata: its first JSON-LD article, and where that is silent the page's meta tags; what isn't there is null."""
    first = F.get(objects_of(("NewsArticle", "Article", "BlogPosting"))(blocks(html)), F.lit(0))
    raw = lambda path: F.get_json_object(first, path)
    value = lambda path: _said(raw(path))
    meta = lambda name, kind="property": F.nullif(meta_content(html, name, kind), F.lit(""))
    page = raw("$.mainEntityOfPage")
    of_page = F.when(F.startswith(page, F.lit("{")), F.coalesce(value("$.mainEntityOfPage['@id']"), value("$.mainEntityOfPage.url"))).otherwise(_said(page))
    words = raw("$.keywords")
    listed = F.when(F.startswith(words, F.lit("[")), F.from_json(words, "array<string>")).otherwise(F.filter(F.transform(F.split(words, ","), _said), lambda x: x.isNotNull()))
    return F.struct(
        F.coalesce(value("$.url"), value("$['@id']"), of_page).alias("url"),
        F.coalesce(value("$.headline"), value("$.name"), meta("og:title")).alias("title"),
        F.coalesce(value("$.description"), meta("og:description")).alias("description"),
        F.coalesce(value("$.datePublished"), meta("article:published_time")).alias("date_published"),
        value("$.dateModified").alias("date_modified"),
        F.coalesce(_people(F.coalesce(raw("$.author"), raw("$.creator"))), meta("author", "name")).alias("author"),
        value("$.articleSection").alias("article_section"),
        value("$.genre").alias("genre"),
        listed.alias("keywords"),
        _picture(raw("$.image")).alias("image_url"),
        raw("$.isAccessibleForFree").alias("is_accessible_for_free"),
    )


def record(article_: Column, source: Column, list_url: Column, position: Column, base: str) -> Column:
    """An article's struct as the record that an inventory keeps, of the fifteen fields: with where it was found, its address made whole and
    its id; fields that are empty are null, and keywords without any too (to_json then leaves them out).

    base is scheme and host: what an address without a scheme is below. An article without an address has base for one."""
    at = F.coalesce(article_["url"], F.lit(""))
    whole = F.when(at.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), at).when(F.startswith(at, F.lit("//")), F.concat(F.lit(base.split("//")[0]), at)).when(at == "", F.lit(base)).otherwise(F.concat(F.lit(base + "/"), F.ltrim(at, F.lit("/"))))
    there = lambda c: F.nullif(c, F.lit(""))
    words = F.filter(article_["keywords"], lambda x: x.isNotNull())
    return F.struct(
        there(source).alias("source"), there(list_url).alias("source_list_url"), position.alias("list_position"), article_id(whole).alias("article_id"), whole.alias("url"),
        *[there(article_[c]).alias(c) for c in ("title", "description", "date_published", "date_modified", "author", "article_section", "genre")],
        F.when(F.size(words) > 0, words).alias("keywords"), there(article_["image_url"]).alias("image_url"), there(article_["is_accessible_for_free"]).alias("is_accessible_for_free"),
    )


def article_id(url: Column) -> Column:
    """The number that ends an address's path; else the last part of the path; else the address with hyphens for what is no letter or digit."""
    number = F.regexp_extract(url, r"/(\d+)(?:\.html)?/?(?:[?#].*)?$", 1)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    last = F.regexp_extract(path, r"([^/]+)/*$", 1)
    bare = F.trim(F.regexp_replace(url, r"(?U)\W+", "-"), F.lit("-"))
    return F.when(number != "", number).when(last != "", last).otherwise(F.nullif(bare, F.lit("")))
