"""Word tokens and document predicates.

A token is a maximal run of letters and digits of the lower-cased text. For scripts
written without spaces there is `pair_tokens`: overlapping pairs of characters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F

from docweave.errors import InvalidInputError
from docweave.schema import DOCUMENT

# Fixed value: what counts as part of a word.
WORD = r"[\p{L}\p{N}]"


def tokens(text: Column | str) -> Column:
    """All tokens of a text in order, with repeats."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(col), F.lit(f"({WORD}+)"), F.lit(1))


# Fixed value: scripts written without spaces.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsThai}]"


def pair_tokens(text: Column | str) -> Column:
    """Tokens in order, with runs of unspaced scripts as overlapping pairs of characters (a
    run of one character is itself)."""
    col = F.lower(F.col(text) if isinstance(text, str) else text)
    pieces = F.regexp_extract_all(col, F.lit(f"({UNSPACED}+|(?:(?!{UNSPACED}){WORD})+)"), F.lit(1))

    def pairs(piece: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(piece) - 1))
        return F.when(F.rlike(piece, F.lit(f"^{UNSPACED}")), F.transform(
            places, lambda at: F.substr(piece, at, F.lit(2)))).otherwise(F.array(piece))

    return F.flatten(F.transform(pieces, pairs))


Tokenizer = Callable[[Column], Column]

#: Tokenizers by the names under which collections keep them.
TOKENIZERS: dict[str, Tokenizer] = {"words": tokens, "pairs": pair_tokens}


@dataclass(frozen=True)
class Contains:
    """Natural-language match: the document holds any word of `text`. Give the tokenizer of the
    index the filter is used with."""

    text: str
    tokenizer: Tokenizer | None = None

    def column(self, document: Column | None = None) -> Column:
        doc = F.col(DOCUMENT) if document is None else document
        if self.tokenizer is not None:
            return F.arrays_overlap(self.tokenizer(doc), self.tokenizer(F.lit(self.text)))
        # One regex pass that stops at the first hit, instead of a token array per row.
        # The pattern is built from literals, so Catalyst folds it to a constant.
        words = F.array_distinct(tokens(F.lit(self.text)))
        pattern = F.concat(F.lit(f"(?<!{WORD})(?:"), F.array_join(words, "|"),
                           F.lit(f")(?!{WORD})"))
        return (F.array_size(words) > 0) & F.rlike(F.lower(doc), pattern)


@dataclass(frozen=True)
class Regex:
    """The pattern (Java syntax) matches anywhere in the document."""

    pattern: str
    ignore_case: bool = False

    def column(self, document: Column | None = None) -> Column:
        doc = F.col(DOCUMENT) if document is None else document
        return F.rlike(doc, F.lit(("(?i)" if self.ignore_case else "") + self.pattern))


@dataclass(frozen=True)
class _Many:
    parts: tuple

    def __init__(self, *parts):
        if not parts:
            raise InvalidInputError(f"{type(self).__name__} needs at least one part")
        object.__setattr__(self, "parts", tuple(parts))


class AllOf(_Many):
    """Every part holds."""

    def column(self, document: Column | None = None) -> Column:
        return reduce(lambda a, b: a & b, [p.column(document) for p in self.parts])


class AnyOf(_Many):
    """At least one part holds."""

    def column(self, document: Column | None = None) -> Column:
        return reduce(lambda a, b: a | b, [p.column(document) for p in self.parts])


DocFilter = Contains | Regex | AllOf | AnyOf


def document_predicate(where_document: DocFilter | Column | None) -> Column | None:
    """Column of a document filter; Columns pass through."""
    if where_document is None or isinstance(where_document, Column):
        return where_document
    return where_document.column()


def scored_text(where_document: DocFilter) -> str:
    """The words that rank a full-text branch: the texts of all Contains parts."""
    if isinstance(where_document, Contains):
        return where_document.text
    if isinstance(where_document, Regex):
        return ""
    return " ".join(t for t in map(scored_text, where_document.parts) if t)


def unscored_predicate(where_document: DocFilter) -> Column | None:
    """What the branch must hold besides a word match: its Regex and nested parts."""
    if isinstance(where_document, Contains):
        return None
    if isinstance(where_document, Regex):
        return where_document.column()
    others = [p for p in where_document.parts if not isinstance(p, Contains)]
    return type(where_document)(*others).column() if others else None
