"""Character tables of Greek, made from the Unicode database by rule."""

from __future__ import annotations

import unicodedata

GREEK = r"\u0370-\u03FF\u1F00-\u1FFF"

# Latin letters of the Greek base letters.
LETTERS = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "y", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}


def bare(c: str) -> str:
    """A character without its combining marks."""
    return "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")


def _codes():
    return (chr(i) for block in ((0xC0, 0x250), (0x370, 0x400), (0x1E00, 0x2000)) for i in range(*block))


#: Characters that lose marks, and what is left of them.
MARKED = {c: bare(c) for c in _codes() if bare(c) != c and len(bare(c)) == 1}
#: Greek characters, marks or not, and their Latin letters in lower case.
LATIN = {c: LETTERS[b] for c in (*LETTERS, *_codes()) if (b := bare(c).lower()) in LETTERS}
