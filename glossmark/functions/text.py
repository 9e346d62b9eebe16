"""Text as columns: normal forms, counts, matches with places, snippets, shingles. Places and lengths are in code points."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossmark.functions.pieces import by_value


@by_value
def _nfkc(text: str | None) -> str | None:
    return text if text is None or text.isascii() else unicodedata.normalize("NFKC", text)


def nfkc_lower(text: Column) -> Column:
    """NFKC, then lower case: what scored search compares. Spark has no function for it, and Arrow's leaves letters decomposed. ASCII texts
    are in this form already, and don't cross to Python."""
    return F.lower(F.coalesce(_nfkc(F.when(F.octet_length(text) != F.length(text), text)), text))


def collapse_spaces(text: Column) -> Column:
    """Each run of white space, ideographic too, as one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends; trim takes spaces alone."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def count_literal(text: Column, needle: str | Column) -> Column:
    """Non-overlapping occurrences; 0 for an empty needle."""
    needle = F.lit(needle) if isinstance(needle, str) else needle
    n = (F.octet_length(text) - F.octet_length(F.replace(text, needle, F.lit("")))) / F.octet_length(needle)  # bytes: no walk over characters
    return F.when(F.length(needle) > 0, n.cast("long")).otherwise(F.lit(0).cast("long"))


def count_literal_any_case(text: Column, needle: str) -> Column:
    return F.regexp_count(text, F.lit(r"(?iu)" + literal(needle))).cast("long")


def literal(text: str) -> str:
    """A Java pattern for the text itself."""
    return re.sub(r"([^\w\s]|_)", r"\\\1", text)


def strip_frontmatter(text: Column) -> Column:
    """Without the block between a leading `---` and the next line that begins with `---`."""
    return F.regexp_replace(text, r"(?s)\A---.*?\n---\s*", "")


def plain_markdown(text: Column, frontmatter: bool = True) -> Column:
    """Links as their text, no addresses, headings or bullets, white space collapsed. The order of steps matters."""
    text = strip_frontmatter(text) if frontmatter else text
    for pattern, to in ((r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"https?://\S+", ""), (r"(?m)^#+\s*", ""), (r"(?m)^\s*[-*]\s*", "")):
        text = F.regexp_replace(text, pattern, to)
    return collapse_spaces(text)


def frontmatter_map(text: Column, quotes: str = "\"'") -> Column:
    """The leading block's `key: value` lines as a map; values lose the quotes given at their ends, and of a repeated key the last line counts.

    quotes is both kinds, or the double one alone, as corpora differ in it."""
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    return _last_fields(block, quotes)


def _last_fields(block: Column, quotes: str) -> Column:
    lines = F.filter(F.split(block, "\n"), lambda x: F.instr(x, ":") > 0)
    pair = F.transform(lines, lambda x: F.struct(F.trim(F.regexp_extract(x, r"^([^:]*):", 1)).alias("k"), F.trim(F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)), F.lit(quotes)).alias("v")))
    last = F.filter(pair, lambda x, i: ~F.exists(F.slice(pair, i + 2, F.size(pair)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def frontmatter_parts(text: Column) -> Column:
    """struct<meta, body> in the loose form: a text that begins with `---` and a line's end has its `key: value` lines up to the next `---`,
    wherever that stands, and the body behind it, stripped. Values lose double quotes alone. A text without either mark is all body, unstripped; its meta is empty."""
    # fixed values: the two marks
    loose = r"(?s)\A---\n(.*?)---(.*)\z"
    there = F.regexp_like(text, F.lit(loose))
    meta = _last_fields(F.regexp_extract(text, loose, 1), '"')
    return F.struct(meta.alias("meta"), F.when(there, strip(F.regexp_extract(text, loose, 2))).otherwise(text).alias("body"))


def _first_each(words: Column) -> Column:
    return F.array_distinct(F.filter(words, lambda x: x != ""))


def hashtags(text: Column) -> Column:
    """array<string>: the words behind `#`, each once, in the order they come in; a null text has none."""
    # fixed value: what ends a tag
    return F.coalesce(_first_each(F.regexp_extract_all(text, F.lit(r"(?U)#([^\s#\uFF0C,\u3001]+)"), 1)), F.array().cast("array<string>"))


def split_keywords(text: Column) -> Column:
    """array<string>: a feed's keywords, cut at commas of both widths, tabs and line ends, without white space and `#` at their ends, each once."""
    # fixed value: what parts keywords
    words = F.transform(F.split(text, r"[,\uFF0C\n\t]+"), lambda x: F.trim(strip(x), F.lit("#")))
    return F.coalesce(_first_each(words), F.array().cast("array<string>"))


def clean_transcript(text: Column) -> Column:
    """Without time stamps, heading lines and replacement characters."""
    text = F.regexp_replace(text, r"\[\d{2}:\d{2}:\d{2}\]\s*", "")
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?m)^# .*$", ""), "�", ""))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<ord, start, match>>: every match and the code points before it.

    Spark's own place of a match counts UTF-16 units, so places come from the lengths of what lies between matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    sizes = F.zip_with(F.transform(F.slice(between, 1, F.size(found)), F.length), found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
    empty = F.array().cast("array<struct<ord: int, start: int, match: string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct(F.size(acc["out"]).alias("ord"), (acc["at"] + x["gap"]).alias("start"), x["m"].alias("match")))).alias("out"),
    )
    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def around(text: Column, start: Column, length: Column, context: int) -> Column:
    """The match with so many characters to each side, white space collapsed. start counts from 0."""
    first = F.greatest(start - context, F.lit(0))
    return collapse_spaces(F.substring(text, first + 1, start + length + context - first))


def line_of(text: Column, start: Column) -> Column:
    """The line, from 1, that the place lies in."""
    return count_literal(F.substring(text, F.lit(1), start), "\n") + 1


def first_hit_snippet(raw: Column, normal: Column, needles: list[str], width: int = 220) -> Column:
    """width characters of raw from a third of it before the first hit in normal; its beginning if nothing hits. The place is one in
    the normal form, the slice is of the raw text; that they may differ is part of the contract."""
    places = F.array(*[F.nullif(F.locate(n, normal), F.lit(0)) for n in needles if n])
    at = F.array_min(places) - 1
    start = F.greatest(at - width // 3, F.lit(0))
    return F.when(at.isNull(), F.substring(raw, 1, width)).otherwise(strip(F.substring(raw, start + 1, width)))


def earliest_snippet(text: Column, keywords: list[str], context: int = 90) -> Column:
    """The first keyword in the text with its surroundings, `...` where cut; of two at one place the one listed first."""
    found = F.filter(F.array(*[F.struct(F.locate(k, text).alias("at"), F.lit(i).alias("ord"), F.lit(len(k)).alias("n")) for i, k in enumerate(keywords)]), lambda x: x["at"] > 0)
    hit = F.array_min(found)
    start = F.greatest(hit["at"] - 1 - context, F.lit(0))
    end = F.least(F.length(text), hit["at"] - 1 + hit["n"] + context)
    body = collapse_spaces(F.substring(text, start + 1, end - start))
    cut = F.concat(F.when(start > 0, "...").otherwise(""), body, F.when(end < F.length(text), "...").otherwise(""))
    return F.when(hit.isNull(), F.lit("")).otherwise(cut)


def ordered_snippets(text: Column, keywords: list[str], context: int = 80, limit: int = 3) -> Column:
    """array<struct<keyword, start, snippet>>: the first matches, keyword by keyword in the order given, in any case. Two whose snippets begin at
    one place, which only those cut off by the text's beginning do, are one."""
    each = []
    for k in keywords:
        found = F.filter(matches(text, "(?iu)" + literal(k)), lambda m: (m["ord"] == 0) | (m["start"] > context))
        each.append(F.transform(F.slice(found, 1, limit), _named(k)))
    return F.transform(F.slice(F.concat(*each), 1, limit), lambda h: F.struct(h["keyword"].alias("keyword"), h["start"].alias("start"), around(text, h["start"], F.length(h["match"]), context).alias("snippet")))


def _named(keyword: str):
    return lambda m: F.struct(F.lit(keyword).alias("keyword"), m["start"].alias("start"), m["match"].alias("match"))


def section(text: Column, heading: str) -> Column:
    """What stands between the `# heading` line and the next `# ` line; '' without the heading."""
    return F.regexp_extract(text, rf"(?ms)^# {literal(heading)}[ \t]*$(.*?)(?=^# [^\n]|\z)", 1)


def bullet_lines(block: Column) -> Column:
    """A block's lines without their bullets and the white space around them; empty ones and lone hyphens are left out."""
    lines = F.transform(F.split(block, "\n"), lambda x: strip(x))
    lines = F.transform(F.filter(lines, lambda x: (x != "") & (x != "-")), lambda x: strip(F.regexp_replace(x, r"\A- ", "")))
    return F.filter(lines, lambda x: x != "")


def heading_title(text: Column, boilerplate: list[str] | None = None) -> Column:
    """The first non-empty `# ` heading behind the frontmatter that isn't boilerplate; null without one."""
    lines = F.transform(F.split(strip_frontmatter(text), "\n"), lambda x: strip(x))
    titles = F.transform(F.filter(lines, lambda x: F.startswith(x, F.lit("# "))), lambda x: strip(F.substr(x, F.lit(3))))
    kept = F.filter(titles, lambda x: (x != "") & ~x.isin(*(boilerplate or [""])))
    return F.get(kept, F.lit(0))


def source_id(names: list[Column], numbers: list[Column], kind: str, fallback: Column) -> Column:
    """The first name that isn't empty; else the first number, as EP and three digits if it is one; else kind and fallback."""
    number = F.trim(first_nonempty(*[n.cast("string") for n in numbers]))
    numbered = F.when(number.rlike(r"^[0-9]+$"), F.concat(F.lit("EP"), F.lpad(number.cast("bigint").cast("string"), 3, "0"))).otherwise(number)
    long = F.when(number.rlike(r"^[0-9]+$") & (number.cast("bigint") > 999), F.concat(F.lit("EP"), number.cast("bigint").cast("string")))
    return F.coalesce(first_nonempty(*names), long, F.nullif(numbered, F.lit("")), F.concat(F.lit(kind + "-"), fallback))


def spaced_hits(hits: Column, context: int, limit: int) -> Column:
    """Of hits (structs with start), in order, those at least context away from all taken before; at most limit."""
    empty = F.filter(hits, lambda h: F.lit(False))
    free = lambda acc, h: ~F.exists(acc, lambda a: F.abs(a["start"] - h["start"]) < context) & (F.size(acc) < limit)
    return F.aggregate(hits, empty, lambda acc, h: F.when(free(acc, h), F.concat(acc, F.array(h))).otherwise(acc))


def trigrams(text: Column) -> Column:
    """The set of runs of three characters; a shorter text is its own only one, an empty one has none."""
    chars, n = F.split(text, ""), F.length(text)
    pairs = F.zip_with(chars, F.slice(chars, 2, n), lambda x, y: F.concat(x, y))
    grams = F.array_distinct(F.array_compact(F.zip_with(pairs, F.slice(chars, 3, n), lambda x, y: F.concat(x, y))))
    return F.when(F.length(text) > 3, grams).when(F.length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def bare(text: Column) -> Column:
    """NFKC, lower case, without addresses and all that isn't a letter or digit."""
    return F.regexp_replace(F.regexp_replace(nfkc_lower(text), r"https?://\S+", ""), r"(?U)[\W_]+", "")


def alias_pattern(alias: str) -> str:
    """Any case; an ASCII alias stands alone, not within a longer ASCII word."""
    body = literal(alias)
    return rf"(?iu)(?<![A-Za-z0-9_]){body}(?![A-Za-z0-9_])" if alias.isascii() else rf"(?iu){body}"


def short_summary(text: Column, size: int = 500) -> Column:
    return F.when(F.length(text) > size, F.concat(F.rtrim(F.substring(text, 1, size - 1)), F.lit("..."))).otherwise(text)


def first_nonempty(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def unfenced(text: Column) -> Column:
    """The inside of a JSON code fence; the text itself if there is none."""
    trimmed = strip(text)
    inner = F.regexp_extract(trimmed, r"(?s)\A```(?:json)?\s*(.*?)\s*```\z", 1)
    return F.when(trimmed.rlike(r"(?s)\A```(?:json)?\s*.*?\s*```\z"), inner).otherwise(trimmed)
