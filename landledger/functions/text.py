"""Text cleaning, flags and size classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts a CSV reader with pandas defaults takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Code page 1252 read as Latin-1 shows its 0x80-0x9F signs as control characters.
_CP1252_BYTES = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_CP1252_CONTROLS = "".join(chr(b) for b in _CP1252_BYTES)
_CP1252_SIGNS = bytes(_CP1252_BYTES).decode("cp1252")

# Every sign Python's str.strip removes.
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _unless_ascii(c: Column | str, change: Callable[[Column], Column]) -> Column:
    """A change of other than ASCII signs; text of as many bytes as signs has none and is spared it."""
    c = column(c).cast("string")
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(change(c))


def latin1_to_cp1252(c: Column | str) -> Column:
    return _unless_ascii(c, lambda c: F.translate(c, _CP1252_CONTROLS, _CP1252_SIGNS))


def cp1252_to_latin1(c: Column | str) -> Column:
    return _unless_ascii(c, lambda c: F.translate(c, _CP1252_SIGNS, _CP1252_CONTROLS))


def decode_header(name: str) -> str:
    return name.translate(str.maketrans(_CP1252_CONTROLS, _CP1252_SIGNS))


def cp1252_name(name: str) -> str:
    return name.translate(str.maketrans(_CP1252_SIGNS, _CP1252_CONTROLS))


def missing_to_null(c: Column | str, tokens=MISSING_TOKENS) -> Column:
    c = column(c)
    return F.when(~c.isin(*tokens), c)


def _bare(c: Column) -> Column:
    """Whether a text begins and ends with printable ASCII that is no blank; false for empty text."""
    last = F.substring(c.cast("binary"), -1, 1)
    return (c >= F.lit("!")) & (c < F.lit("\x7f")) & last.between(F.lit(b"!"), F.lit(b"~"))


def trim_text(c: Column | str) -> Column:
    """Strip every kind of white space, not only blanks.

    Text between two printable ASCII signs has none to strip and is left as it is, and if plain blanks were all
    around it, no others are looked for; both are much cheaper.
    """
    c = column(c).cast("string")
    plain = F.trim(c)
    return F.when(_bare(c), c).when(_bare(plain), plain).otherwise(F.btrim(c, F.lit(_BLANKS)))


# Other than printable ASCII, or a letter right after a sign that is neither letter nor blank.
_NOT_PLAIN_WORDS = r"[^ -~]|[!-@\[-`{-~][A-Za-z]"


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, as in ``Dun Laoghaire-Rathdown``.

    Printable ASCII whose words hold letters at their beginning only takes built-ins, which are much cheaper; a single
    such word the cheapest ones.
    """
    c = column(c)
    pieces = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    raised = F.transform(
        pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substring(p, 2, 2**31 - 1)))
    )
    word = F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 2**31 - 1)))
    plain = F.when(F.contains(c, F.lit(" ")), F.initcap(c)).otherwise(word)
    # what the register's flags hold; any other text is looked at
    return F.when(c.isin("Yes", "No"), c).when(~c.rlike(_NOT_PLAIN_WORDS), plain).otherwise(F.array_join(raised, ""))


def is_yes(c: Column | str) -> Column:
    """Exactly "Yes"; missing stays missing."""
    return column(c) == "Yes"


def is_yes_any_case(c: Column | str) -> Column:
    return F.lower(column(c)) == "yes"


def mentions(c: Column | str, phrase: str) -> Column:
    """Case-insensitive containment; missing counts as no."""
    return F.coalesce(F.contains(F.lower(column(c)), F.lit(phrase)), F.lit(False))


# Wording of the property descriptions.
NEW_PHRASE = "new dwelling"
SECOND_HAND_PHRASE_INGEST = "second-hand"
SECOND_HAND_PHRASE_EDA = "second-hand dwelling"


def _at_least(c: Column | str, size: int) -> Column:
    # the register also carries the misprint "orequal"
    return mentions(c, f"greater than or equal to {size}") | mentions(
        c, f"greater than orequal to {size}"
    )


def size_category_ingest(c: Column | str) -> Column:
    """Size class of the cleaned table; the largest matching class wins."""
    return (
        F.when(_at_least(c, 125), "125 sq m or more")
        .when(_at_least(c, 38) & mentions(c, "less than 125"), "38-124 sq m")
        .when(mentions(c, "less than 38"), "Under 38 sq m")
        .otherwise("Unknown")
    )


def size_category_eda(c: Column | str) -> Column:
    """Size class of the exploration tables; the smallest matching class wins."""
    c = column(c)
    return (
        F.when(c.isNull(), "Unknown")
        .when(mentions(c, "less than 38"), "Less than 38 sq m")
        .when(_at_least(c, 38) & mentions(c, "less than 125"), "38–124 sq m")
        .when(mentions(c, "greater than 125"), "125+ sq m")
        .otherwise("Other / Unclassified")
    )


def flag_word(c: Column | str) -> Column:
    """True or False of a boolean, as the cleaned files spell it."""
    c = column(c)
    return F.when(c, "True").when(~c, "False")


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(column(c), F.lit(""))


def typed(c: Column | str, data_type: str) -> Column:
    """Typed value of raw text; empty text is null, dirty text raises."""
    return empty_to_null(c).cast(data_type)


def flag_or_false(c: Column | str) -> Column:
    return F.coalesce(typed(c, "boolean"), F.lit(False))


def contains_any(c: Column | str, *fragments: str) -> Column:
    """Case-insensitive match of any fragment; null stays null."""
    c = column(c)
    matched = c.ilike(f"%{fragments[0]}%")
    for fragment in fragments[1:]:
        matched = matched | c.ilike(f"%{fragment}%")
    return matched
