"""Fields out of HTML table cells, as column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from vetrail.functions.text import strip_blanks

# Fixed value: the date attribute.
DATE_ATTRIBUTE = r'datetime="([^"]+)"'

# A tag runs to the first ">" outside quotes; a "<" before anything but a name, "/", "!" or "?" is text.
_INSIDE = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+"""
_TAG = rf"(?s)<(?:[a-zA-Z]|/[a-zA-Z]|[!?]){_INSIDE}>"
_HIDDEN = rf"(?is)<!--.*?(?:-->|$)|<(script|style|template)(?=[\s/>]){_INSIDE}>.*?(?:</\1\s*+>|$)"
_ANCHOR = rf"(?is)<a(?=[\s/>])({_INSIDE})>(.*?)(?:</a\s*+>|(?=<a[\s/>])|$)"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_HREF = (
    rf"""(?is)^(?:[\s/]*+(?!href\s*+=)[^\s=/>"']++(?:\s*+=\s*+{_VALUE})?+)*+[\s/]*+"""
    r"""href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
)
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*+);?"
_CUT = "\u0000"


def _entities() -> Column:
    """Names of the character entities of HTML 4 and their characters, as Python's own table gives them."""
    pairs = [F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))]
    return F.create_map(*pairs, F.lit("apos"), F.lit("'"))


def _character(reference: Column) -> Column:
    """The character of a reference without ``&`` and ``;``; null if it is none."""
    hexadecimal = F.conv(F.substring(reference, F.lit(3), F.length(reference)), 16, 10)
    decimal = F.substring(reference, F.lit(2), F.length(reference))
    code = F.when(reference.rlike("^#[xX]"), hexadecimal).when(reference.startswith("#"), decimal).cast("long")
    sound = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    written = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(sound, written).when(~reference.startswith("#"), F.try_element_at(_entities(), reference))


def unescape(c: Column) -> Column:
    """Named, decimal and hexadecimal character references as characters; unknown ones stay. Nothing is read twice."""
    pieces = F.split(c, "&")

    def resolved(piece: Column, place: Column) -> Column:
        character = _character(F.regexp_extract(piece, _REFERENCE, 1))
        rest = F.regexp_replace(piece, _REFERENCE, "")
        return F.when(place == 0, piece).when(character.isNotNull(), F.concat(character, rest)).otherwise(
            F.concat(F.lit("&"), piece)
        )

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pieces, resolved), "")).otherwise(c)


def _shown(cell: Column) -> Column:
    """Markup without comments and without the bodies of scripts and styles."""
    return F.regexp_replace(F.coalesce(cell, F.lit("")), _HIDDEN, _CUT)


def _text(markup: Column) -> Column:
    parts = F.split(F.regexp_replace(markup, _TAG, _CUT), _CUT)
    return F.array_join(F.transform(parts, lambda p: strip_blanks(unescape(p))), "")


def cell_date(cell: Column) -> Column:
    """First ten characters of the ``datetime`` attribute, or an empty text."""
    return F.substring(F.regexp_extract(F.coalesce(cell, F.lit("")), DATE_ATTRIBUTE, 1), 1, 10)


def cell_text(cell: Column) -> Column:
    """Text of a cell without tags, comments, scripts and styles; blanks next to a tag are dropped."""
    return _text(_shown(cell))


def anchor_text(cell: Column) -> Column:
    """Text of the first link of a cell; a link that is not closed ends with the next one or the cell."""
    return _text(F.regexp_extract(_shown(cell), _ANCHOR, 2))


def anchor_href(cell: Column) -> Column:
    """Target of the first link of a cell: quoted either way or not at all."""
    attributes = F.regexp_extract(_shown(cell), _ANCHOR, 1)
    return unescape(F.concat(*[F.regexp_extract(attributes, _HREF, i) for i in (1, 2, 3)]))


def absolute_url(href: Column, host: str) -> Column:
    """Prefix the host unless the target is empty or already absolute."""
    return F.when((href != "") & ~href.startswith("http"), F.concat(F.lit(host), href)).otherwise(
        href
    )


def cell_at(cells: Column, position: int) -> Column:
    """Cell by position, empty where the row is too short."""
    return F.coalesce(F.get(cells, F.lit(position)), F.lit(""))
