"""A pipe table of a few sample rows, padded and aligned like a notebook's Markdown output."""

from __future__ import annotations


def _is(number: type, cell: str) -> bool:
    try:
        number(cell)
    except ValueError:
        return False
    return True


def _fraction(cell: str) -> int:
    """Characters after the decimal point (or exponent mark); -1 for whole numbers."""
    at = cell.rfind(".") if "." in cell else cell.lower().rfind("e")
    return len(cell) - at - 1 if at >= 0 else -1


def render_table(columns: list[str], dtypes: list[str], rows: list[list[str | None]]) -> str:
    """Columns of numbers are right-aligned on their decimal point, all others left-aligned."""
    texts, rules = [], []
    for i, (name, dtype) in enumerate(zip(columns, dtypes)):
        cells = ["nan" if r[i] is None else r[i] for r in rows]
        if dtype == "bool":
            cells = [c.capitalize() for c in cells]
        numeric = dtype != "bool" and all(_is(float, c) for c in cells)
        if numeric:
            if not all(_is(int, c) for c in cells):
                cells = [f"{float(c):g}" for c in cells]
            longest = max(map(_fraction, cells), default=-1)
            cells = [c + " " * (longest - _fraction(c)) for c in cells]
        width = max([len(name) + 2] + [len(c) for c in cells])
        pad = str.rjust if numeric else str.ljust
        texts.append([pad(c, width) for c in [name, *cells]])
        rules.append("-" * (width + 1) + ":" if numeric else ":" + "-" * (width + 1))
    lines = ["| " + " | ".join(line) + " |" for line in zip(*texts)]
    return "\n".join([lines[0], "|" + "|".join(rules) + "|", *lines[1:]])
