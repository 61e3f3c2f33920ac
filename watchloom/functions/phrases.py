"""Plain phrases as expressions.

In a phrase # is a number, #### a year, * a run without blanks, ... a stretch of the same sentence, ? a word, ?? some words, (PAN) a tax
number in brackets, END the text's end.
"""

from __future__ import annotations

import re

_STANDS_FOR = {"#": r"\d+", "####": r"\d{4}", "*": r"\S+", "...": r"[^.]*?", "?": "[A-Za-z]+", "??": "[A-Za-z][A-Za-z ]*", "-": "[-–]", "END": "$", "No": r"No\.?", "(PAN)": r"\(PAN[^)]*\)", "Folio(s)": r"Folio\(s\)", "Ors": r"Ors\.?", "Anr": r"Anr\.?", "Others": r"Others\.?"}


def compiled(phrase: str) -> str:
    """A phrase as an expression: words are whole and apart, marks stand with or without blanks."""
    out, before = "", ""
    for token in phrase.split():
        piece = _STANDS_FOR.get(token) or re.escape(token).replace("\\#", r"\d+").replace("#", r"\d+")
        apart = before[-1:].isalnum() or before in ("*", "?", "??", "#", "####", "...")
        word = token != "END" and (token[0].isalnum() or token in ("*", "?", "??", "#", "####"))
        out += (r"\s+" if apart and word and before not in ("No",) else r"\s*" if before else (r"\b" if word else "")) + piece
        before = token
    return out + (r"\b" if before[-1:].isalpha() and before not in ("END", "Ors", "Anr", "Others") else "")


def one_of(phrases: tuple[str, ...]) -> str:
    return "(?:" + "|".join(map(compiled, phrases)) + ")"


def between(starts: tuple[str, ...], ends: tuple[str, ...]) -> str:
    """What stands after one of the phrases and before the first of the others; the first group."""
    return rf"(?i){one_of(starts)}\s+(.+?)\s*{one_of(ends)}"


def slug_between(starts: tuple[str, ...], ends: tuple[str, ...]) -> str:
    """The same in an address, where the pieces are as they are written."""
    return f"(?:{'|'.join(map(re.escape, starts))})(.+?)(?:{'|'.join(map(re.escape, ends))}|$)"
