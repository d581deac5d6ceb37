"""Alphabets as data: the letters of a script and the lists that text operators take as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# White space as Unicode text processing has it, spelt so that Java and RE2 read it alike.
SPACE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"


@dataclass(frozen=True)
class Alphabet:
    """``letters`` is the inside of a character class; the lists may be empty."""

    name: str
    letters: str
    abbreviations: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    min_stem: int = 3
    stopwords: frozenset[str] = field(default_factory=frozenset)

    def with_words(self, stopwords: list[str]) -> Alphabet:
        return Alphabet(self.name, self.letters, self.abbreviations, self.suffixes, self.min_stem, frozenset(stopwords))


# The Georgian block, abbreviations that don't end a sentence, and inflectional endings.
GEORGIAN = Alphabet(
    name="georgian",
    letters="ა-ჿ",
    abbreviations=("წ.", "ე.წ.", "ა.შ.", "სთ.", "გვ.", "მაგ.", "ე.ი.", "ლათ.", "ბერძ.", "დაახლ.", "ს.", "თ.", "ნ.", "მ."),
    suffixes=tuple(
        "ებისთვის ებისგან ებამდე ისთვის ისადმი ებთან ებში ებზე ებად ისგან ამდე თვის ადმი ებს ები ისა ის ში ზე დან თან კენ გან ვით ებ ად მა სა ს ო მ თ ა ე ი".split()
    ),
)
LATIN = Alphabet(name="latin", letters="A-Za-zÀ-ÖØ-öø-ÿ", suffixes=("ingly", "edly", "ing", "edly", "ed", "es", "ly", "s"))
