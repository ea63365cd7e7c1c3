"""Text of HTML in one pass.

A scanner with the states text, tag, attribute value, raw text and comment; each character is looked at a bounded number of times, whatever is left open. Block
elements break lines; scripts, styles and comments are left out; entities are resolved once, in text only. A tag that never ends, and a script or comment
that is never closed, count as plain characters or as a plain tag, so that no page loses its text to them.
"""

from __future__ import annotations

import html
import re

from pagequarry.functions.text import WHITESPACE

# Elements that stand on lines of their own, and those whose content is no text.
BLOCKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table section article nav header footer title head body html".split())
RAW = ("script", "style")

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)|<[!?]")
_IN_TAG = re.compile(r"[<>]|=\s*[\"']")
_SPACES, _LINES = re.compile(r"[ \t]+"), re.compile(r" ?\n[ \n]*")


class _Scanner:
    def __init__(self, page: str):
        self.page, self.low = page, page.lower()
        if len(self.low) != len(page):  # some capitals are longer in lower case
            self.low = "".join(c.lower() if c.isascii() else c for c in page)
        self.next: dict[str, int] = {}  # where a mark is found next; the page's length if nowhere
        self.barrier = 0  # up to here no tag with quoted values can end

    def find(self, mark: str, at: int) -> int:
        """The next place of a mark, searched once for each stretch of the page; -1 if there is none."""
        known = self.next.get(mark, -1)
        if known < at:
            known = self.low.find(mark, at)
            self.next[mark] = known = len(self.page) if known < 0 else known
        return known if known < len(self.page) else -1

    def tag_end(self, at: int) -> int:
        """The place behind the tag that begins at ``at``; -1 if it never ends."""
        if at >= self.barrier:
            pos = at + 1
            while m := _IN_TAG.search(self.page, pos):
                if m[0] == ">":
                    return m.end()
                if m[0] == "<":
                    break
                close = self.find(m[0][-1], m.end())
                if close < 0:
                    break
                pos = close + 1
            self.barrier = m.start() if m else len(self.page)
        end, other = self.find(">", at + 1), self.find("<", at + 1)
        return end + 1 if end >= 0 and not 0 <= other < end else -1

    def parts(self):
        page, pos = self.page, 0
        while True:
            at = self.find("<", pos)
            if at < 0:
                yield page[pos:]
                return
            yield page[pos:at]
            if page.startswith("<!--", at) and (close := self.find("-->", at + 4)) >= 0:
                yield None
                pos = close + 3
                continue
            name = _NAME.match(page, at)
            end = self.tag_end(at) if name else -1
            if end < 0:
                yield "<"
                pos = at + 1
                continue
            element = (name[1] or "").lower()
            pos = end
            if element in RAW and page[at + 1] != "/" and (close := self.find(f"</{element}>", end)) >= 0:
                yield None
                pos = close + len(element) + 3
            elif element in BLOCKS:
                yield "\n"


def html_text(page: str) -> str:
    """The text of a page; lines and runs of spaces are joined."""
    out: list[str] = []
    held: list[str] = []  # text between breaks: an entity may stand on both sides of a plain "<" only as text

    def flush() -> None:
        if held:
            out.append(html.unescape("".join(held).replace("&nbsp;", " ")))
            held.clear()

    for part in _Scanner(page).parts():
        if part is None or part == "\n":
            flush()
            out.append(" " if part is None else part)
        elif part:
            held.append(part)
    flush()
    return _LINES.sub("\n", _SPACES.sub(" ", "".join(out))).strip(WHITESPACE)
