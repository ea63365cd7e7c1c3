"""Text columns: whitespace, line ends, comment removal, HTML to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, in code point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set without the line feed, as a regex class: blanks inside one line.
_INLINE = "[" + WHITESPACE.replace("\n", "") + "]*"

# A comment block starts at a line that opens with <!-- and runs through the next line that ends
# with --> without opening one itself; a closing line on its own goes too. Only single-character
# loops are repeated, so the matcher neither recurses nor backtracks across lines.
_CLOSING = rf"[^\n]*-->{_INLINE}(?=\n|\z)"
_STRICT_COMMENT = (
    rf"\n(?:{_INLINE}<!--(?s:.)*?(?:\n(?!{_INLINE}<!--){_CLOSING}|\z)|{_CLOSING})"
)
# In the lenient form any line that ends with --> closes, the opening one included.
_LENIENT_COMMENT = rf"\n(?:{_INLINE}(?=<!--)(?s:.)*?(?:-->{_INLINE}(?=\n|\z)|\z)|{_CLOSING})"


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def unix_newlines(c: Column) -> Column:
    """Line ends as a text-mode read gives them: CRLF and CR become LF."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def strip_comments(c: Column, strict: bool = True) -> Column:
    """Drop comment lines. In strict form a one-line comment opens and does not close."""
    pattern = _STRICT_COMMENT if strict else _LENIENT_COMMENT
    kept = F.regexp_replace(F.concat(F.lit("\n"), c), pattern, "")
    return F.substr(kept, F.lit(2))


# Patterns that turn markup into text, applied in order. A tag ends before the next one begins, so that
# tags that are never closed are not scanned again and again.
HTML_RULES = (
    (r"(?is)<script[^<>]*>.*?</script>", " "),
    (r"(?is)<style[^<>]*>.*?</style>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|header|footer|title|head|body|html)(?:\s[^<>]*)?/?>", "\n"),
    (r"<[^<>]+>", ""),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t]+", " "),
    (r" ?\n[ \n]*", "\n"),
)


def html_to_text(c: Column) -> Column:
    for pattern, replacement in HTML_RULES:
        c = F.regexp_replace(c, pattern, replacement)
    return strip(c)


def display_name(c: Column) -> Column:
    """File name for a report line: over 30 characters, the first 28 and two dots."""
    return F.when(F.length(c) > 30, F.concat(F.substring(c, 1, 28), F.lit(".."))).otherwise(c)


def preview(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 200), F.lit("..."))
