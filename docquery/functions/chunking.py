"""Document splitting as row-local column expressions: no UDF and no shuffle."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.text import let, strip, unix_lines
from docquery.settings import DEFAULTS

# Separators from the coarsest to the finest; what is still too
# long after the last one is cut by length.
SEPARATORS = ["\n\n", "\n", ". ", " "]
INTRO_TITLE = "(intro)"
PLAIN_TITLE = "(document)"

# One to six "#" at a line start and a blank on the same line. `d` makes "\n" the
# only line end, `m` lets "^" match after it, `U` makes blanks Unicode-aware.
_HEADING_START = r"#{1,6}[[^\S\n]\x1f]"

_NO_SECTIONS = "cast(array() as array<struct<title: string, body: string>>)"

def markdown_sections(text: Column) -> Column:
    """`ARRAY<STRUCT<title, body>>`: one entry per heading, plus the text before the first."""

    def section(piece: Column) -> Column:
        named = F.regexp_extract(piece, "(?d)^#{1,6}(.*)", 1)
        title = F.when(piece.rlike(f"(?dU)^{_HEADING_START}"), strip(named))
        return F.struct(
            F.coalesce(title, F.lit(INTRO_TITLE)).alias("title"), strip(piece).alias("body")
        )

    pieces = F.split(unix_lines(text), f"(?dmU)^(?={_HEADING_START})", -1)
    return F.filter(F.transform(pieces, section), lambda s: s["body"] != "")


def recursive_split(text: Column, size: int) -> Column:
    """Pieces of at most `size` characters, cut at the coarsest separator that fits.

    Works level by level: each separator is applied to the pieces that are still
    too long. Within a level the packing is one regex scan: the longest run of at
    most `size` characters that ends at a separator, or else everything up to the
    next one. That keeps the work in compiled matching instead of a fold.
    """
    pieces = F.array(text)
    for separator in SEPARATORS:
        pieces = _refine(
            pieces, size, separator, lambda x, sep=separator: _packed(x, sep, size)
        )
    return _refine(
        pieces, size, "", lambda x: F.regexp_extract_all(x, F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))
    )


def _refine(pieces: Column, size: int, separator: str, cutter) -> Column:
    def keep(x: Column) -> Column:
        fits = F.length(x) <= size
        return fits | ~x.contains(separator) if separator else fits

    return F.flatten(
        F.transform(pieces, lambda x: F.when(keep(x), F.array(x)).otherwise(cutter(x)))
    )


def _packed(text: Column, separator: str, size: int) -> Column:
    """Runs of separated parts; separators at the start of a run are dropped."""
    sep = separator.replace(".", r"\.")
    if separator != "\n\n":
        return _runs(text, sep, sep, size)
    # Blank lines pair up from the left in a longer run of newlines, so a run may
    # only end where an even number of newlines comes before.
    paired = rf"(?<=(?:\A|[^\n])(?:\n\n){{0,{size}}}){sep}"
    return F.when(text.contains("\n\n\n"), _runs(text, sep, paired, size)).otherwise(
        _runs(text, sep, sep, size)
    )


def _runs(text: Column, sep: str, end: str, size: int) -> Column:
    run = rf"(?s)(?:{sep})*+(?:(.{{1,{size}}}|.{{{size + 1},}}?)(?:{end}|\z)|\z)"
    found = F.regexp_extract_all(text, F.lit(run), F.lit(1))
    return F.filter(found, lambda x: x != "")


def add_overlap(chunks: Column, overlap: int) -> Column:
    """Prefix each chunk but the first with the tail of its predecessor and a space."""
    if overlap <= 0:
        return chunks
    return let(
        chunks,
        lambda c: F.transform(
            c,
            lambda x, i: F.when(i == 0, x).otherwise(
                F.concat(F.right(F.get(c, i - 1), F.lit(overlap)), F.lit(" "), x)
            ),
        ),
    )


def section_id(body: Column) -> Column:
    return F.sha2(body, 256)


def _clean_pieces(text: Column, size: int) -> Column:
    return F.filter(F.transform(recursive_split(text, size), strip), lambda x: x != "")


def plain_chunks(
    text: Column, size: int = DEFAULTS.chunk_size, overlap: int = DEFAULTS.chunk_overlap
) -> Column:
    return add_overlap(let(strip(text), lambda t: _clean_pieces(t, size)), overlap)


def parent_child_chunks(
    text: Column,
    child_size: int | None = None,
    size: int = DEFAULTS.chunk_size,
    overlap: int = DEFAULTS.chunk_overlap,
    with_parent: bool = True,
) -> Column:
    """`ARRAY<STRUCT<parent_id, child, title[, parent]>>`.

    `parent_id` is the hash of the section text, and null for text without
    sections, whose chunks are their own parents. With `with_parent=False` the
    section text itself is left out, so that a long section is not repeated for
    each of its children (see the index).
    """
    child_size = child_size or DEFAULTS.child_size

    def unit(parent_id: Column, child: Column, parent: Column, title: Column) -> Column:
        fields = [parent_id.alias("parent_id"), child.alias("child"), title.alias("title")]
        return F.struct(*fields, *([parent.alias("parent")] if with_parent else []))

    def plain() -> Column:
        return F.transform(
            plain_chunks(text, size, overlap),
            lambda c: unit(F.lit(None).cast("string"), c, c, F.lit(PLAIN_TITLE)),
        )

    def children(section: Column) -> Column:
        return let(
            section_id(section["body"]),
            lambda known: F.transform(
                _clean_pieces(section["body"], child_size),
                lambda c: unit(known, c, section["body"], section["title"]),
            ),
        )

    def structured(sections: Column) -> Column:
        return F.flatten(F.transform(sections, children))

    # Text without a "#" has no heading: skip the line scan for it.
    sections = F.when(text.contains("#"), markdown_sections(text)).otherwise(F.expr(_NO_SECTIONS))
    return let(
        sections,
        lambda s: F.when(F.size(s) <= 1, plain()).otherwise(structured(s)),
    )
