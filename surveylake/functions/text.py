"""Text clean-up."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from surveylake.rules import ACCENTED, MISSING_WORDS, PLAIN

#: Characters beyond U+00FF whose lower case is a letter up to there, where it has another upper case or none.
_MORE_UPPER = {"k": "\u212a", "\u00e5": "\u212b", "\u00df": "\u1e9e"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy(c: Column | str) -> Column:
    """Trim, and reduce every run of blanks, of any alphabet, to one space."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def text_key(c: Column | str) -> Column:
    """The form in which two spellings of one category are equal."""
    text = _col(c)
    # only text with a letter of more than one byte can have an accent to remove; accents go first, so that blanks
    # are reduced once in the plan
    plain = F.when(F.octet_length(text) != F.length(text), F.translate(text, ACCENTED, PLAIN))
    return F.lower(tidy(plain.otherwise(text)))


def key_of(text: str) -> str:
    """``text_key`` of a fixed value."""
    return " ".join(text.split()).translate(str.maketrans(ACCENTED, PLAIN)).lower()


def standard(c: Column | str) -> Column:
    """One spelling for all that have the same key, where no map gives a label."""
    return F.upper(text_key(c))


def _any_case(letter: str) -> str:
    """A pattern of all characters whose lower case is ``letter``, one up to U+00FF."""
    upper = letter.upper()
    same = letter + (upper if len(upper) == 1 and upper.lower() == letter else "") + _MORE_UPPER.get(letter, "")
    return "[" + "".join(f"\\u{ord(x):04x}" for x in dict.fromkeys(same)) + "]"


def _word_pattern(words: Iterable[str]) -> str | None:
    """A pattern of the texts that are one of ``words`` once tidied and lowered; None if none can be."""
    # a word that is not in that form itself has no such text
    able = [w for w in dict.fromkeys(words) if w == w.lower() and w == " ".join(w.split())]
    forms = [r"(?U:\s+)".join("".join(map(_any_case, part)) for part in w.split(" ")) for w in able]
    return rf"^(?U:\s*+)(?:{'|'.join(sorted(forms, reverse=True))})(?U:\s*+)\z" if able else None


def is_missing_word(c: Column | str, words: Iterable[str] = MISSING_WORDS) -> Column:
    """True where the text says "no answer". False, not NULL, for NULL."""
    words = tuple(words)
    if not all(x <= "\u00ff" and x.isprintable() for w in words for x in w):
        return F.coalesce(F.lower(tidy(c)).isin(*words), F.lit(False))
    # the pattern mostly fails at the first letter, without a copy of the text
    pattern = _word_pattern(words)
    return F.coalesce(_col(c).rlike(pattern), F.lit(False)) if pattern else F.lit(False)
