"""Stat tables out of stored HTML pages.

A page is read as a stream of tags: comments, scripts and styles go first, and a mark is set before every real tag, so
what looks like a tag inside an attribute or a script is none. Elements are then paired by a depth counter over the tags
of their own name, so a table inside a cell ends itself and not the table around it. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions.text import strip
from waterline.sources.storage import materialise

# Attributes up to the end of a tag; a quoted value may hold any character.
_REST = r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>"
_SOME = r"[^>\"']*?(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*?)*?"
# A character that no text holds, set before every tag, and in the place of what is no text.
_MARK = "\x01"
_NEAR = 64
# Elements of one name inside each other that a pattern follows; deeper ones are counted.
_NESTED = 3
# Comments, declarations, scripts and styles with all they hold, and tags (group 2).
_STREAM = rf"(?is)<!--.*?(?:-->|\z)|<[!?][^>]*+>|<(script|style)\b{_REST}.*?(?:</\1\s*>|\z)|(</?[a-z]{_REST})"
_TAG = rf"(?s){_MARK}(?:</?[A-Za-z]{_REST})?"
# The table that holds the stats.
DATA_TABLE = rf"(?is){_MARK}<table\b{_SOME}\sid\s*=\s*(?:\"data\"|'data'|data(?=[\s>])){_REST}"
# Named references of Latin-1 and of markup; the ampersand comes last and a fixed space stays a space.
NAMED = {name: chr(code) for name, code in name2codepoint.items() if 160 <= code < 256} | {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "
}
BLANK_HEADER = "Column"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _plain(cell: Column) -> Column:
    """Visible text of a cell: each text node trimmed, tags gone, references undone."""
    bare = F.when(F.contains(cell, F.lit(_MARK)), F.regexp_replace(cell, rf"\s*{_TAG}\s*", "")).otherwise(cell)
    return _let(bare, lambda text: strip(F.when(F.contains(text, F.lit("&")), _decoded(text)).otherwise(text)))


def _decoded(text: Column) -> Column:
    """Named, decimal and hexadecimal character references undone; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def undo(form: str, char: Callable[[Column], Column], text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(form), F.lit(0)))
        return F.aggregate(found, text, lambda t, ref: F.coalesce(F.replace(t, ref, char(ref)), t))

    def named(ref: Column) -> Column:
        return F.try_element_at(names, F.substring(ref, 2, F.length(ref) - 2))

    def numbered(skip: int, base: int) -> Callable[[Column], Column]:
        def char(ref: Column) -> Column:
            digits = F.substring(ref, skip + 1, F.length(ref) - skip - 1)
            code = F.conv(digits, base, 10).try_cast("long")
            valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
            # 160 is the fixed space.
            char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
            return F.when(code == 160, " ").when(valid, char).otherwise("\ufffd")

        return char

    def numbers(text: Column) -> Column:
        return _let(undo("&#[0-9]{1,8};", numbered(2, 10), text), lambda t: undo("&#[xX][0-9A-Fa-f]{1,7};", numbered(3, 16), t))

    # Most texts hold ampersands only.
    others = _let(undo("&[A-Za-z]+[0-9]*;", named, text), numbers)
    return F.replace(F.when(F.rlike(text, F.lit("&(?!amp;)")), others).otherwise(text), F.lit("&amp;"), F.lit("&"))


def tag_stream(html: Column) -> Column:
    """The page with every tag marked, and without comments, declarations, scripts and styles."""
    return F.regexp_replace(F.replace(html, F.lit(_MARK), F.lit("")), _STREAM, f"{_MARK}$2")


def _pieces(stream: Column, name: str) -> Column:
    """The stream cut before every tag of a name."""
    return F.split(stream, rf"(?i)(?={_MARK}</?{name}\b)")


def _kind(piece: Column, name: str) -> Column:
    """1 for a piece that a start tag begins, -1 for an end tag, 0 for what stands before the first of them."""
    begins, ends = (F.rlike(piece, F.lit(rf"(?i)^{_MARK}<{slash}{name}\b")) for slash in ("", "/"))
    return F.when(begins, 1).when(ends, -1).otherwise(0)


def _depths(kinds: Column) -> Column:
    """How many elements are open after each piece's tag; an end tag without a start counts for nothing."""
    last = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))
    return F.aggregate(kinds, F.array().cast("array<int>"), lambda acc, k: F.concat(acc, F.array(F.greatest(last(acc) + k, F.lit(0)))))


def _without_tag(piece: Column) -> Column:
    return F.regexp_replace(piece, rf"(?s)^{_MARK}<{_REST}", "")


def _start(name: str) -> str:
    return rf"{_MARK}<{name}\b"


def _balanced(name: str) -> str:
    """A pattern of what stands before an element's own end tag: no tags of its name but those of whole elements, so deep at most.

    Its loops give nothing back, so a long page takes neither retries nor stack.
    """
    other = rf"[^{_MARK}]*+(?:{_MARK}(?!</?{name}\b)[^{_MARK}]*+)*+"
    held = other
    for _ in range(_NESTED):
        held = rf"{other}(?:{_start(name)}{held}{_MARK}</{name}\b{other})*+"
    return held


def elements(stream: Column, name: str) -> Column:
    """What every element of a name holds, in the order of their start tags; those inside others count as well.

    An element ends at its own end tag, by depth, or with the stream. Where each start tag has its end tag and few hold each other,
    one pattern finds them all, looking ahead, and nothing needs counting.
    """
    flat = F.regexp_extract_all(stream, F.lit(rf"(?i){_start(name)}{_REST}(?=({_balanced(name)}){_MARK}</{name}\b)"), F.lit(1))

    def deep(cut: Column) -> Column:
        pieces, kinds = cut["pieces"], cut["kinds"]
        return _let(_depths(kinds), lambda depths: F.array_compact(F.transform(pieces, lambda p, at: held(pieces, kinds, depths, p, at))))

    def held(pieces: Column, kinds: Column, depths: Column, piece: Column, at: Column) -> Column:
        def end(reach: Column | int) -> Column:
            return F.nullif(F.array_position(F.slice(depths, at + 2, reach), (depths[at] - 1).cast("int")), F.lit(0))

        ends = F.coalesce(end(_NEAR), end(F.size(depths)), F.lit(0))  # most end soon
        size = F.when(ends > 0, ends).otherwise(F.size(depths) - at).cast("int")
        return F.when(kinds[at] == 1, _without_tag(F.array_join(F.slice(pieces, at + 1, size), "")))

    def kinds_of(pieces: Column) -> Column:
        return F.struct(pieces.alias("pieces"), F.transform(pieces, lambda p: _kind(p, name)).alias("kinds"))

    counted = _let(_let(_pieces(stream, name), kinds_of), deep)
    starts = F.regexp_count(stream, F.lit(f"(?i){_start(name)}"))
    return _let(flat, lambda flat: F.when(starts == F.size(flat), flat).otherwise(counted))


def first_element(stream: Column, name: str, start: str | None = None) -> Column:
    """What the first element of a name holds, or the first whose tag matches ``start``; NULL without one.

    One pattern finds it, unless it is empty, has no end tag or holds others of its name too deep. Then a fold over the tags of the
    name takes pieces from the start tag on while the depth is not back to zero.
    """
    opening = start or rf"(?is){_start(name)}{_REST}"
    found = F.regexp_extract(stream, rf"{opening}(?:({_balanced(name)})(?={_MARK}</{name}\b))?", 1)
    opening = opening.replace("(?is)", "(?is)^", 1)
    state = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("held"), F.lit(False).alias("over"))

    def step(at: Column, piece: Column) -> Column:
        begins = at["held"].isNull() & F.rlike(piece, F.lit(opening))
        inside = at["held"].isNotNull() & ~at["over"]
        opens, closes = (F.rlike(piece, F.lit(rf"(?i)^{_MARK}<{end}{name}\b")) for end in ("", "/"))
        depth = F.when(begins, 1).when(inside & opens, at["depth"] + 1).when(inside & closes, at["depth"] - 1).otherwise(at["depth"])
        over = at["over"] | (inside & (depth == 0))
        held = F.when(begins, _without_tag(piece)).when(inside & ~over, F.concat(at["held"], piece)).otherwise(at["held"])
        return F.struct(depth.alias("depth"), held.alias("held"), over.alias("over"))

    counted = F.aggregate(_pieces(stream, name), state, step)["held"]
    there = F.rlike(stream, F.lit(opening.replace("^", "", 1)))
    return _let(found, lambda found: F.when(found != "", found).when(there, counted))


def _cells(source: Column, name: str) -> Column:
    return F.transform(elements(source, name), _plain)


def cell_texts(markup: Column) -> Column:
    """Texts of a row's cells."""
    return _cells(markup, "td")


def unique_headers(headers: Column) -> Column:
    """Blank headers become "Column"; the n-th repeat of a header gets the suffix _n."""
    named = F.transform(headers, lambda h: F.when(h == "", BLANK_HEADER).otherwise(h))

    def numbered(header: Column, at: Column) -> Column:
        before = F.size(F.filter(F.slice(named, 1, at), lambda other: other == header))
        return F.when(before == 0, header).otherwise(F.concat(header, F.lit("_"), before.cast("string")))

    return F.transform(named, numbered)


#: Why a page holds no stat table that can be read.
NO_TABLE, NO_HEAD, NO_BODY = "no stat table", "no table head", "no table body"


def parsed_pages(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """(keys, headers, rows, problem) of every page: the markup of its rows, or why there are none. One pass without a shuffle."""
    # A step a projection: what is used more than once is a column and not worked out again.
    streams = pages.select(*keys, tag_stream(F.col(html)).alias("_stream"))
    tables = streams.select(*keys, first_element(F.col("_stream"), "table", DATA_TABLE).alias("_table"))
    parts = tables.select(*keys, "_table", first_element(F.col("_table"), "thead").alias("_head"), first_element(F.col("_table"), "tbody").alias("_body"))
    problem = (
        F.when(F.col("_table").isNull(), NO_TABLE).when(F.col("_head").isNull(), NO_HEAD).when(F.col("_body").isNull(), NO_BODY)
    )
    rows = F.when(F.col("_head").isNotNull(), elements(F.col("_body"), "tr"))
    named = parts.select(*keys, _cells(F.col("_head"), "th").alias("_names"), rows.alias("rows"), problem.alias("problem"))
    return named.select(*keys, unique_headers(F.col("_names")).alias("headers"), "rows", "problem")


def table_rows(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """Rows (keys, headers, row, cells) of every page that holds a stat table.

    One pass over the pages without a shuffle. Rows without cells are dropped, surplus cells are
    cut to the header count, and a page without a stat table, its head or its body gives no rows (``parsed_pages`` tells why).
    Rows and cells of a table inside a cell count as rows and cells too, after the ones that hold them.
    """
    return _rows(parsed_pages(pages, keys, html), keys)


def _rows(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table_rows`` of parsed pages."""
    # Cells are found inside the generator, so that dropping empty rows does not parse them again.
    cells = F.transform("rows", lambda markup, at: F.struct(at.alias("row"), cell_texts(markup).alias("cells")))
    found = F.filter(cells, lambda r: F.size(r["cells"]) > 0)
    rows = parsed.select(*keys, "headers", F.inline(found))
    return rows.withColumn("cells", F.slice("cells", F.lit(1), F.size("headers")))


def _filled_headers() -> Column:
    return F.slice("headers", F.lit(1), F.size("cells"))


def table_cells(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """Long form (keys, row, col, header, value) of ``table_rows``."""
    pairs = F.arrays_zip(_filled_headers().alias("header"), F.col("cells").alias("value"))
    return (
        table_rows(pages, keys, html)
        .select(*keys, "row", F.posexplode(pairs).alias("col", "pair"))
        .select(*keys, "row", "col", F.col("pair.header").alias("header"), F.col("pair.value").alias("value"))
    )


def table_columns(pages: DataFrame, keys: Sequence[str], html: str, headers: Sequence[str]) -> DataFrame:
    """Wide form with one column per expected header, NULL where a page lacks it."""
    return _columns(table_rows(pages, keys, html), keys, headers)


def _columns(rows: DataFrame, keys: Sequence[str], headers: Sequence[str]) -> DataFrame:
    # By position, since headers may still clash: then the first counts.
    def cell(name: str) -> Column:
        return F.get("cells", (F.array_position("headers", F.lit(name)) - 1).cast("int")).alias(name)

    return rows.select(*keys, "row", *[cell(name) for name in headers])


#: Different header rows of one set of pages, at most: a site's pages have a few.
MOST_LAYOUTS = 1000


def layouts(rows: DataFrame, by: Sequence[str] = ()) -> list:
    """The different (by, headers) among rows that have headers; they are counted, and too many are no layouts."""
    found = rows.filter(F.size("headers") > 0).select(*by, "headers").distinct().limit(MOST_LAYOUTS + 1).collect()
    if len(found) > MOST_LAYOUTS:
        raise ValueError(f"the pages have more than {MOST_LAYOUTS} different header rows")
    return sorted(found)


def stat_frame(pages: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """One table (keys, row, a text column for every header) of all pages, headers in the order in which layouts bring them.

    The parsed pages are written first: the layouts and the rows both come from them, and a condition on the headers
    would otherwise go down to the pages and hold the whole parser, worked out anew for every use.
    """
    parsed = materialise(parsed_pages(pages, keys, html).select(*keys, "headers", "rows"))
    names = dict.fromkeys(h for layout in layouts(parsed) for h in layout["headers"])
    return _columns(_rows(parsed, keys), keys, list(names))
