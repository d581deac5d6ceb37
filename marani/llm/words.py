"""Words of a text in one form, whatever their characters, case and markup; shared by the operators that compare words."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

# Letters that look the same in different scripts, a class on each line, Latin first where it has the letter.
LOOK_ALIKES = """
a а α ɑ
b Ꮟ
c с ⲥ
d ԁ
e е
g ɡ
h һ հ
i і ι Ꭵ
j ј ϳ
l ӏ
n ո
o о ο օ ჿ ⲟ
p р ρ ⲣ
q ԛ զ
s ѕ
u υ ս
v ν ѵ
w ԝ ѡ
x х
y у ү γ ყ
k κ к
A А Α Ꭺ ꓮ
B В Β Ᏼ ꓐ Ⲃ
C С Ꮯ ꓚ Ⲥ
D Ꭰ ꓓ
E Е Ε Ꭼ ꓰ
F ꓝ
G Ꮐ ꓖ
H Н Η Ꮋ ꓧ Ⲏ
I І Ι Ӏ ꓲ Ⲓ
J Ј Ꭻ ꓙ
K К Κ Ꮶ ꓗ Ⲕ
L Ꮮ ꓡ
M М Μ Ꮇ ꓟ Ⲙ
N Ν ꓠ Ⲛ
O О Ο Օ ꓳ Ⲟ
P Р Ρ Ꮲ ꓑ Ⲣ
R Ꭱ ꓣ
S Ѕ Տ Ꮪ ꓢ
T Т Τ Ꭲ ꓔ Ⲧ
U ꓴ
V Ꮩ ꓦ
W Ꮃ ꓪ
X Х Χ ꓫ Ⲭ
Y Ү Υ Ꮍ ꓬ
Z Ζ Ꮓ ꓜ
- ‐
""".split("\n")
CLASSES = [c for line in LOOK_ALIKES if (c := line.split())]
SKELETON = {ord(other): c[0] for c in CLASSES for other in c[1:]}

# Characters that show nothing (default-ignorable code points and joiners).
IGNORABLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff"
_ignorable = re.compile(f"[{IGNORABLE}]+")
_marks = re.compile("[̀-ͯ]+")
_broken = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n[ \t>*#•|]*(?=[^\W\d_])")
# Short tags whatever they hold; of any length and over any lines comments, addresses, closing tags, and tags whose attributes have values, but for three between two of them.
_value = r"""(?>"[^"<]*"|'[^'<]*'|[^\s<>"']+)"""
_bare = r"(?:[\s/]++[A-Za-z_:@][\w:.@-]*+(?!\s*=)){0,3}"
_attribute = rf"""[\s/]++[A-Za-z_:@][\w:.@-]*+\s*+=\s*+{_value}"""
_tags = re.compile(
    r"<[^<>\n]{1,80}>|<!--[^<>]*-->|<[A-Za-z][A-Za-z0-9+.-]*:[^\s<>]*>|</[A-Za-z][^\s<>]*\s*>"
    rf"|<[A-Za-z][^\s<>=/]*+(?:{_bare}{_attribute})++{_bare}[\s/]*+>"
)
# What a link leads to, beside the words that it shows: after a label, before one, or the page of a piped link.
_targets = re.compile(r"""(?<=\])\((?:<[^<>\n]*>|[^\s()<>]*(?:\([^\s()<>]*\)[^\s()<>]*)*)(?:\s+(?:"[^"\n]*"|'[^'\n]*'))?\s*\)|(?<=\[)(?:https?|ftp)://[^\s\[\]]*|(?<=\[\[)[^\[\]|\n]*\|(?=[^\[\]|\n]*\]\])""")
# A template without parameters shows no words of its own here.
_templates = re.compile(r"\{\{[^{}|\n]*\}\}")
WORDS = re.compile(r"[^\W_]+")


def drop_ignorable(text: str) -> str:
    return _ignorable.sub("", text) if _ignorable.search(text) else text


def plain(text: str) -> str:
    """Text without tags, targets of links, templates without parameters, hyphens at line ends, characters that show nothing,
    and accents that no composed letter holds.

    Other markup is punctuation."""
    if "[" in text or "{{" in text:
        text = _templates.sub(" ", _targets.sub(" ", text))
    if "<" in text:
        text = _tags.sub(" ", text)
    text = drop_ignorable(text)
    if "-" in text:
        text = _broken.sub("", text)
    if _marks.search(text):
        text = _marks.sub("", unicodedata.normalize("NFC", text))
    return text


def one_form(word: str) -> str:
    """A word in one form: compatibility characters, look-alike letters and case make no difference."""
    if word.isascii():
        return word.lower()
    spread = unicodedata.normalize("NFKD", word).translate(SKELETON).lower().translate(SKELETON)
    return unicodedata.normalize("NFC", spread)


class WordHashes(dict):
    """A 64-bit hash of each word's one form; a memo of bounded size."""

    def __init__(self, limit: int = 500_000) -> None:
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) > self.limit:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(one_form(word).encode("utf-8", "surrogatepass")) | 1
        return found


def hashed(words: list[str], memo: WordHashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
