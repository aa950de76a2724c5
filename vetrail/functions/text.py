"""Company names, locations and character n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-form words dropped from a name, the punctuation turned into blanks, the
# "doing business as" tail and web addresses, and the markers of an absent location part.
LEGAL_FORMS = "llc inc corp corporation ltd limited co company plc gmbh ag sa"
PUNCTUATION = r"[.,;:!?'\"()\[\]{}/\\]"
TRADE_NAME_TAIL = r"\bd/?b/?a\b.*$"
WEB_ADDRESS = r"\bwww\.[a-z0-9.-]+\.(com|org|net|us)\b"
ABSENT_PARTS = ["", "N/A", "-"]

# Java's \b and \s follow Unicode only under this flag, whatever the Java version.
_UNICODE = "(?U)"
_FORM_PATTERN = rf"\b({'|'.join(LEGAL_FORMS.split())})\b"


def _drop(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, _UNICODE + pattern, to)


def strip_blanks(c: Column) -> Column:
    """Trim every kind of white space, not only the space character."""
    return _drop(c, r"^\s+|\s+$")


def normalize_name(name: Column | str, strip_first: bool = False) -> Column:
    """Lower-case name without punctuation, legal forms, trade-name tail and web address.

    By default punctuation goes first, so ``d/b/a`` is already three words when the tail is
    looked for and only ``dba`` is cut. ``strip_first`` cuts the tail and addresses before.
    """
    c = F.lower(F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit("")))
    if strip_first:
        c = _drop(_drop(c, WEB_ADDRESS), TRADE_NAME_TAIL)
    c = _drop(c, PUNCTUATION, " ")
    c = _drop(c, _FORM_PATTERN)
    if not strip_first:
        c = _drop(_drop(c, TRADE_NAME_TAIL), WEB_ADDRESS)
    return strip_blanks(_drop(c, r"\s+", " "))


def normalize_location(*parts: Column | str, nan_token: bool = False) -> Column:
    """Lower-case location parts joined with ``|``; absent parts are left out.

    ``nan_token`` turns a null part into the text ``nan``, so that two missing parts overlap.
    """
    given = [F.col(p) if isinstance(p, str) else p for p in parts]
    if nan_token:
        given = [F.coalesce(p, F.lit("nan")) for p in given]
    present = F.filter(
        F.array(*given), lambda p: p.isNotNull() & ~strip_blanks(p).isin(ABSENT_PARTS)
    )
    return F.array_join(F.transform(present, lambda p: strip_blanks(F.lower(p))), "|")


def locations_overlap(left: Column | str, right: Column | str) -> Column:
    """Whether two normalised locations share a part; an empty one shares nothing."""
    left, right = (
        F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (left, right)
    )
    return F.coalesce(
        F.arrays_overlap(F.split(left, r"\|"), F.split(right, r"\|")), F.lit(False)
    )


def char_grams(name: Column | str, sizes: tuple[int, ...] = (2, 3, 4)) -> Column:
    """Character n-grams inside words, each word framed by one blank on both sides.

    A word not longer than the gram size yields itself once, and no larger sizes follow.
    """
    c = F.col(name) if isinstance(name, str) else name
    words = F.filter(F.split(c, _UNICODE + r"\s+"), lambda w: w != "")

    def cut(framed: Column, n: int):
        return lambda at: F.substring(framed, at, F.lit(n))

    def of_word(word: Column) -> Column:
        framed = F.concat(F.lit(" "), word, F.lit(" "))
        width = F.length(framed)
        grams = []
        for i, n in enumerate(sizes):
            starts = F.sequence(F.lit(1), F.greatest(width - (n - 1), F.lit(1)))
            slides = F.transform(starts, cut(framed, n))
            if i:
                slides = F.when(width > sizes[i - 1], slides).otherwise(
                    F.array().cast("array<string>")
                )
            grams.append(slides)
        return F.concat(*grams)

    return F.flatten(F.transform(words, of_word))
