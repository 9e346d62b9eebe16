"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in column functions only.

A sketch is an array of cells in three tables. A digest has one place in each table; its cells count it and hold the exclusive or
of the digests there and of their checks. Sketches of two versions subtract cell by cell, which leaves the digests that differ;
a cell with one of them names it, and taking that one out of its other cells uncovers more (peeling)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Words of a paragraph's piece: a longer paragraph is cut, so that an edit leaves the rest of it alike.
PIECE_WORDS = 24
#: Cells of a table of the fingerprint, as a power of two. Larger sketches, for what doesn't peel, have more bits in turn.
TABLE_BITS, LARGER_BITS = 3, (3, 5, 7, 9)
#: Digests that a larger sketch has for each of its parts, on average. A part peels by itself.
PART_DIGESTS = 8
#: Rounds of peeling; what isn't done then counts as failed.
ROUNDS = 5
#: Bytes of text of a range of documents, on average.
RANGE_BYTES = 8 << 20


# Functions of arrays are written as SQL text, which takes Spark one call to read where columns take thousands.


def _let(value: str, name: str, use: str) -> str:
    """use, in which name stands for value, computed once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def digests(text: str) -> str:
    """SQL of the distinct 63-bit digests of a text's paragraphs, ascending. Paragraphs are lines, cut after PIECE_WORDS words; spaces and line
    ends at their edges don't count."""
    pieces = rf"regexp_extract_all({text}, '(?:[^\\n ]+ *){{1,{PIECE_WORDS}}}', 0)"
    return f"array_sort(array_distinct(transform({pieces}, p -> xxhash64(rtrim(p)) & {(1 << 63) - 1}L)))"


def _check(digest: str) -> str:
    return f"(xxhash64({digest}, 13) & 4294967295L)"


def _place(digest: str, table: int, bits: int) -> str:
    """In which cell of a table, from 0. Bits above the 32nd part digests, so they take no part here."""
    return f"(shiftright({digest}, {table * bits}) & {(1 << bits) - 1}L)"


def _cell(n: str, key: str, check: str) -> str:
    return f"named_struct('n', {n}, 'key', {key}, 'check', {check})"


def sketch(of: str, bits: int) -> str:
    """SQL of the cells of an array of digests: three tables of 2^bits, one after the other."""
    empty, more = _cell("0", "0L", "0L"), _cell("x.n + 1", "x.key ^ d", f"x.check ^ {_check('d')}")
    own = (f"filter({of}, d -> {_place('d', t, bits)} = i)" for t in range(3))
    tables = (f"transform(sequence(0L, {(1 << bits) - 1}L), i -> aggregate({x}, {empty}, (x, d) -> {more}))" for x in own)
    return f"concat({', '.join(tables)})"


def subtracted(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (x, y) -> {_cell('x.n - y.n', 'x.key ^ y.key', 'x.check ^ y.check')})"


def peeled(cells: str, bits: int) -> str:
    """SQL of (more, less): the digests that the first version alone has, and the second. Null if some cells don't peel."""
    places = ", ".join(f"'at{t}', cast({_place('k', t, bits)} AS int) + {t << bits}" for t in range(3))
    keys = "array_distinct(transform(filter(alone, c -> c.n = {}), c -> c.key))".format
    entry = f"k -> named_struct('n', {{}}, 'key', k, 'check', {_check('k')}, {places})".format
    without = f"IF(f.at0 = i OR f.at1 = i OR f.at2 = i, {_cell('x.n - f.n', 'x.key ^ f.key', 'x.check ^ f.check')}, x)"
    left = f"transform(s.cells, (c, i) -> IF(c.n = 0 AND c.key = 0, c, aggregate(found, c, (x, f) -> {without})))"
    after = f"named_struct('cells', {left}, 'more', concat(s.more, new.more), 'less', concat(s.less, new.less))"
    after = _let(f"concat(transform(new.more, {entry(1)}), transform(new.less, {entry(-1)}))", "found", after)
    after = _let(f"named_struct('more', {keys(1)}, 'less', {keys(-1)})", "new", after)
    alone = f"filter(s.cells, c -> abs(c.n) = 1 AND {_check('c.key')} = c.check)"
    next_ = _let(alone, "alone", f"IF(size(alone) > 0, {after}, s)")
    start = f"named_struct('cells', {cells}, 'more', cast(array() AS array<bigint>), 'less', cast(array() AS array<bigint>))"
    end = f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> {next_})"
    return _let(end, "s", "IF(forall(s.cells, c -> c.n = 0 AND c.key = 0 AND c.check = 0), named_struct('more', s.more, 'less', s.less), NULL)")


def _below(values: str, least: str, by: str = "<") -> str:
    """SQL of how many of the ascending values are below least (by "<=": or equal), by bisection."""
    steps = f"transform(sequence(ceil(log2(size({values}) + 1)), 0L, -1L), k -> shiftleft(1, cast(k AS int)))"
    return f"aggregate({steps}, 0, (at, step) -> IF(coalesce(get({values}, at + step - 1) {by} {least}, false), at + step, at))"


def _by_parts(a: str, b: str) -> str:
    """SQL of an array of (more, less) by a sketch as large as the two may need: one part for every few digests, each peeled alone. A part that doesn't
    peel gets larger tables in turn; one whose digests agree in all bits that tables use, a chance of about one in 2^27, is compared plainly."""
    parts = f"greatest(1L, cast(ceil((size({a}) + size({b})) / {PART_DIGESTS}) AS bigint))"
    least = f"shiftleft(cast(ceil({{}} * {float(1 << 31)}D / parts) AS bigint), 32)".format

    def cut(values: str) -> str:
        end = f"IF(j + 1 < parts, {_below(values, least('(j + 1)'))}, size({values}))"
        return _let(_below(values, least("j")), "begin", f"slice({values}, begin + 1, {end} - begin)")

    tries = ", ".join(peeled(subtracted(sketch("two.a", bits), sketch("two.b", bits)), bits) for bits in LARGER_BITS)
    plain = "named_struct('more', array_except(two.a, two.b), 'less', array_except(two.b, two.a))"
    each = _let(f"named_struct('a', {cut(a)}, 'b', {cut(b)})", "two", f"coalesce({tries}, {plain})")
    return _let(parts, "parts", f"transform(sequence(0L, parts - 1L), j -> {each})")


def difference(a: str, b: str, a_cells: str, b_cells: str) -> str:
    """SQL of an array of (more, less) that together hold the digests that differ: from the fingerprints' cells where these peel, else from
    larger sketches of the digests."""
    return _let(peeled(subtracted(a_cells, b_cells), TABLE_BITS), "small", f"IF(small IS NOT NULL, array(small), {_by_parts(a, b)})")


def likeness(a: str, b: str, differing: str) -> str:
    """SQL of the digests that both have, by those that either has: 1 where neither has any."""
    n, total = f"aggregate({differing}, 0, (n, d) -> n + size(d.more) + size(d.less))", f"(size({a}) + size({b}))"
    return _let(n, "d", f"IF({total} = 0, 1D, ({total} - d) / ({total} + d))")


def written_out(cells: str) -> str:
    """SQL of a sketch as hexadecimal digits: 32 bits of each cell's count, 64 of its digests, 32 of their checks."""
    cell = "concat(lpad(hex(cast(c.n AS bigint)), 8, '0'), lpad(hex(c.key), 16, '0'), lpad(hex(c.check), 8, '0'))"
    return f"lower(array_join(transform({cells}, c -> {cell}), ''))"


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs (id, text, digests) with those of the next document in descending order of ids, nulls last; after the last comes the first.

    Documents are dealt into ranges of ids, told by approximate quantiles; each range also gets a copy of the first document of the
    range after it, so that a range finds all it needs in itself. Rows with equal ids go by their texts."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / RANGE_BYTES))
    at = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(plain.agg(F.percentile_approx("id", at, F.lit(max(10000, 100 * ranges)))).first()[0] or [])) if at else []
    above = _below(f"cast(array({', '.join(map(str, bounds))}) AS array<bigint>)", "id", "<=")
    ranged = plain.withColumn("range", F.expr(f"IF(id IS NULL, {len(bounds) + 1}, {len(bounds)} - {above})"))
    firsts = sorted((r["range"], r["id"]) for r in ranged.groupBy("range").agg(F.max("id").alias("id")).collect())  # a row for each range
    turned = [(before[0], own[1]) for before, own in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    after = F.broadcast(spark.createDataFrame(turned, "range int, first long"))
    copies = plain.join(after, F.col("id").eqNullSafe(F.col("first"))).groupBy("range", "id").agg(F.min("text").alias("text"))
    dealt = ranged.select("range", "id", "text", F.lit(False).alias("copy")).unionByName(copies.select("range", "id", "text", F.lit(True).alias("copy")))
    dealt = dealt.repartitionById(len(bounds) + 2, "range").withColumn("digests", F.expr(digests("text")))
    order = W.partitionBy("range").orderBy("copy", F.desc_nulls_last("id"), "text")
    found = dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("digests").over(order).alias("next_digests"))
    return found.where(~F.col("copy")).select("id", "text", "digests", "next_text", "next_digests")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text is the text whose last half of code points (rounded down) gives way to as many first ones of the next document, or all that this has.
    A fingerprint is the sketch of a text's digests; likeness is told by peeling the difference of two fingerprints, and where that fails, of larger
    sketches, from the digests. It is the share of digests, of those of either text, that both have.

    A null text counts as empty; two texts without a word are alike by 1. Repeated rows each get a row; equal ids follow each other by
    their texts, null ids come last. A document alone is its own next one. An empty table gives no rows. Ids are read as long;
    columns other than the two are not read. Texts move once, in ranges of ids; a text is a value of one row. Rows of one id stay together.
    """
    near = with_next(docs, id_col, text_col)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    near = near.select("id", n.cast("long").alias("n_chars"), "digests", "next_digests", edited.alias("edited"))
    near = near.select("id", "n_chars", "digests", "next_digests", F.sha2("edited", 256).alias("edited_sha256"), F.expr(digests("edited")).alias("edited_digests"))
    names = {"cells": "digests", "edited_cells": "edited_digests", "next_cells": "next_digests"}
    near = near.withColumns({c: F.expr(sketch(d, TABLE_BITS)) for c, d in names.items()})
    like = {f"near_{x}": F.expr(likeness("digests", f"{x}_digests", difference("digests", f"{x}_digests", "cells", f"{x}_cells"))) for x in ("edited", "next")}
    prints = {"fingerprint": F.expr(written_out("cells")), "edited_fingerprint": F.expr(written_out("edited_cells"))}
    return near.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", *(c.alias(n) for n, c in {**prints, **like}.items()))
