"""Column helpers over code and document text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markup of the documentation export.
OUTER_TABLE = '<table width="600" class="SAPBEXBorderlessFlexBox" cellspacing="0" cellpadding="0" border="2">'
SECTION_TABLE = '<table width="600" class="SAPBEXBorderlessFlexBox" cellspacing="0" cellpadding="0" border="1">'
GRID_CLASS = "SAPBEXTableGrid"
TABLE_MISSING = "Table not found"


def strip_fences(c: Column) -> Column:
    """Drop ```sql fences and every other back-tick."""
    return F.regexp_replace(F.replace(c, F.lit("```sql"), F.lit("")), "`", "")


def clean_html(c: Column) -> Column:
    """Drop the HEAD block and image tags."""
    return F.regexp_replace(F.regexp_replace(c, "(?is)<head>.*?</head>", ""), "(?is)<img.+?>", "")


def first_table(c: Column) -> Column:
    """The first table with the outer signature, up to its first closing tag."""
    found = F.regexp_extract(c, r"(?is)\Q" + OUTER_TABLE + r"\E.*?</table>", 0)
    return F.when(found != "", found).when(c.isNotNull(), TABLE_MISSING)


def between(c: Column, start: str, end: str) -> Column:
    """Text between two literal markers; NULL when the first or the second is absent."""
    pattern = r"(?s)\Q" + start + r"\E(.*?)\Q" + end + r"\E"
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, 1))


def after(c: Column, start: str, length: int) -> Column:
    """``length`` characters behind a literal marker; NULL when it is absent."""
    pos = F.instr(c, start)
    return F.when(pos > 0, F.substring(c, pos + len(start), F.lit(length)))


def statements(c: Column) -> Column:
    """Array of trimmed, non-blank statements of a script."""
    trimmed = F.transform(F.split(c, ";"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda s: s != "")


def statement_blocks(c: Column) -> Column:
    """Statements separated by ``;`` and a blank line; each ends in ``;`` again."""
    text = F.regexp_replace(c, r"^\s+|\s+$", "")
    trimmed = F.transform(F.split(text, r";\s*\n\s*\n"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    kept = F.filter(trimmed, lambda s: s != "")
    return F.transform(kept, lambda s: F.when(F.endswith(s, F.lit(";")), s).otherwise(F.concat(s, F.lit(";"))))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


def needs_review(c: Column) -> Column:
    """Whether a statement has constructs worth a look; plain selects do not."""
    return F.rlike(F.lower(c), F.lit("if|case|join|rank|union"))


# Character entities, the ampersand last.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def plain_text(c: Column) -> Column:
    """Text of an HTML cell: tags dropped, entities resolved, outer white space trimmed."""
    c = F.regexp_replace(c, "(?s)<[^>]*>", "")
    for entity, character in _ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(character))
    return F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", "")
