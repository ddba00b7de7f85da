"""Romanization of letters that fold to no ASCII. Alphabets go by tables, Indic scripts, kana, Hangul and Thai by their Unicode
names. Han characters and what else is unknown stay as they are."""

from __future__ import annotations

import unicodedata


def _table(letters: str, latin: str) -> dict[str, str]:
    return dict(zip(letters, latin.replace("_", "").split(" "), strict=True))


#: Letters and their usual Latin spellings.
CYRILLIC = _table("абвгдежзийклмнопрстуфхцчшщъыьэюяёіїєґ", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch _ y _ e iu ia e i i ie g")
GREEK = _table("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o")
HEBREW = _table("אבגדהוזחטיךכלםמןנסעףפץצקרשת", "a b g d h v z kh t y k k l m m n n s _ p p ts ts q r sh t")
ARABIC = _table("ءآأؤإئابةتثجحخدذرزسشصضطظعغفقكلمنهوىيپچژکگی", "_ a a w i y a b h t th j h kh d dh r z s sh s d t z _ gh f q k l m n h w a y p ch zh k g y")
LATIN = _table("æœøłđðþħıŋŧ", "ae oe o l d d th h i ng t")
#: Signs that are words in Latin script.
SIGNS = {"€": "eur", "°": "deg", "×": "x"}
#: Kana whose usual spelling isn't that of their Unicode names.
KANA = {"si": "shi", "ti": "chi", "tu": "tsu", "hu": "fu", "zi": "ji"}
_LETTERS = CYRILLIC | GREEK | HEBREW | ARABIC | LATIN | SIGNS
_SCRIPTS = ("DEVANAGARI", "BENGALI", "GUJARATI", "GURMUKHI", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "ORIYA")


def _by_name(ch: str, out: list[str]) -> str:
    name = unicodedata.name(ch, "").split(" ")
    kind, last = " ".join(name[1:-1]), name[-1].lower()
    if name[0] in ("HIRAGANA", "KATAKANA") and kind.startswith("LETTER"):
        return KANA.get(last, last)
    if name[:2] == ["HANGUL", "SYLLABLE"]:
        return last
    if name[:2] == ["THAI", "CHARACTER"] and len(name) > 3:
        # a consonant is named for its sound and a word that has it, a vowel sign for its sound after SARA
        return name[3].lower() if name[2] == "SARA" else name[2].lower().removesuffix("o") if name[2].endswith("O") else ch
    if ch.isdecimal():
        return str(unicodedata.digit(ch))
    if name[0] not in _SCRIPTS:
        return ch
    if kind.startswith("LETTER"):
        return last
    if kind.startswith("VOWEL SIGN") or last == "virama":
        # a consonant's inherent `a` goes before a vowel sign or a virama
        if out and out[-1].endswith("a"):
            out[-1] = out[-1][:-1]
        return "" if last == "virama" else last
    return {"anusvara": "n", "candrabindu": "n", "visarga": "h", "nukta": ""}.get(last, ch)


def romanize(text: str) -> str:
    out: list[str] = []
    for ch in text:
        plain = ch if ch in _LETTERS else unicodedata.normalize("NFD", ch)[0]
        out.append(ch if ch < "\x80" else _LETTERS[plain] if plain in _LETTERS else _by_name(ch, out))
    return "".join(out)
