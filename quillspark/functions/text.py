"""Row-local text expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lower-case letters with a stroke, which Unicode doesn't decompose.
STROKED = {"đ": "d", "ð": "d", "ħ": "h", "ı": "i", "ł": "l", "ø": "o", "ŧ": "t", "ƀ": "b", "ɨ": "i"}


def _latin() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and their plain letters, by Unicode's own decomposition."""
    pairs = dict(STROKED)
    for code in (*range(0xE0, 0x250), *range(0x1E00, 0x1F00)):
        c = chr(code)
        base = unicodedata.normalize("NFKD", c)[0]
        if c.islower() and base != c and "a" <= base <= "z":
            pairs[c] = base
    return "".join(pairs), "".join(pairs.values())


MARKED, PLAIN = _latin()
#: Letters that are written with two in plain text.
DOUBLED = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}
#: The Greek alphabet.
GREEK = "α alpha β beta γ gamma δ delta ε epsilon ζ zeta η eta θ theta ι iota κ kappa λ lambda μ mu ν nu ξ xi ο omicron π pi ρ rho σ sigma τ tau υ upsilon φ phi χ chi ψ psi ω omega".split()


def blank_to_null(x: Column) -> Column:
    """Null for null, empty and blank texts."""
    return F.when(F.regexp_replace(x, r"(?U)\s+", "") != "", x)


def clean_text(x: Column) -> Column:
    """Runs of white space as one blank, none outside; null as the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def fold(x: Column) -> Column:
    """Lower case without marks: letters of the Latin charts become plain, combining marks vanish."""
    out = F.translate(F.lower(x), MARKED, PLAIN)
    for letter, plain in DOUBLED.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return F.regexp_replace(out, r"\p{M}+", "")


def spell_greek(x: Column) -> Column:
    """Greek letters, bare or as TeX commands, by name."""
    out = F.regexp_replace(x, r"\$?\\(?:var)?([a-z]+)\$?", "$1")
    for letter, name in zip(GREEK[::2], GREEK[1::2]):
        out = F.replace(out, F.lit(letter), F.lit(name))
    return out


def words(x: Column) -> Column:
    """Folded words of letters and digits, in order."""
    return F.filter(F.split(fold(x), r"[^\p{L}\p{N}]+"), lambda w: w != "")
