"""Column-name operators: pure functions on name lists plus one ``toDF``.

They never touch rows, so they cost nothing at any scale: the result is a
single projection in the plan.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


#: Latin letters for the Cyrillic ones from U+0430 on, in their order.
CYRILLIC = "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch  y  e yu ya".split(" ")

#: Words of a letter's Unicode name that do not belong to its sound.
_NOT_SOUND = {"LETTER", "SMALL", "CAPITAL", "VOWEL", "SIGN", "SYLLABLE", "FINAL", "INITIAL", "MEDIAL", "ISOLATED", "FORM",
              "INDEPENDENT", "VOCALIC", "CJK", "UNIFIED", "COMPATIBILITY"}

#: Latin letters that fold to others without an accent to drop.
LATIN = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i"}

#: Signs that end a syllable without its inherent vowel, and the marks that say so, as their names have them.
_SILENT, _NASAL = ("VIRAMA", "AL-LAKUNA", "PULLI"), {"ANUSVARA": "m", "CANDRABINDU": "m", "VISARGA": "h", "NUKTA": ""}


def _sound(char: str) -> tuple[str, str]:
    """(sound of a letter outside Latin, kind: ``letter``, ``vowel sign``, ``silent`` or ``other``).

    The sound is read off the letter's Unicode name: ``KANNADA LETTER KA`` is ``ka``, ``HANGUL SYLLABLE
    GAG`` is ``gag``, ``CJK UNIFIED IDEOGRAPH-4E00`` is ``ideograph4e00``.
    """
    if 0x430 <= ord(char) < 0x430 + len(CYRILLIC):
        return CYRILLIC[ord(char) - 0x430], "letter"
    name = unicodedata.name(char, f"U{ord(char):x}")
    words = name.split(" WITH ")[0].split(" ")[1:] or [name]
    if any(w in _SILENT for w in words):
        return "", "silent"
    if words[-1] in _NASAL:
        return _NASAL[words[-1]], "other"
    sound = "".join(w for w in words if w not in _NOT_SOUND).replace("-", "").lower()
    if "SIGN" in words:
        return sound, "vowel sign"
    return sound, "letter"


def transliterated(text: str) -> str:
    """Letters of other scripts in Latin ones; all else as it is.

    In scripts whose consonants carry an ``a`` of their own, a vowel sign takes its place and a silencing sign
    drops it: ``ಹೆಸರು`` reads ``hesaru``, ``नमस्ते`` ``namaste``.
    """
    out: list[str] = []
    carries = False  # whether the last letter ends in its own "a"
    for char in text:
        category = unicodedata.category(char)
        if char.isascii() or category[0] not in "LM" or "LATIN" in unicodedata.name(char, ""):
            out.append(char)
            carries = False
            continue
        if "a" <= unicodedata.normalize("NFKD", char)[0].lower() <= "z" or category == "Mn" and unicodedata.combining(char) >= 200:
            out.append(char)  # folded below, as accents are
            continue
        sound, kind = _sound(char.lower())
        if not sound and kind == "other":
            continue
        if kind in ("vowel sign", "silent") and carries:
            out[-1] = out[-1][:-1]
        out.append(sound)
        carries = kind == "letter" and len(sound) > 1 and sound.endswith("a") and category == "Lo"
    return "".join(out)


def snake_name(name: str) -> str:
    """One name in snake_case: transliterated, ASCII-folded, lower case, ``_`` separated.

    ``'Q7. Name of Participant (Main)'`` -> ``'q7_name_of_participant_main'``;
    a camelCase boundary also becomes ``_``; ``%`` reads as ``percent``; quotes
    vanish, so that ``Participant's`` stays one word.
    """
    text = re.sub("['\"\u2018\u2019\u201c\u201d\u02bc]", "", unicodedata.normalize("NFC", str(name)))
    text = "".join(LATIN.get(c, LATIN.get(c.lower(), c).upper() if c.lower() in LATIN else c) for c in text)
    text = unicodedata.normalize("NFKD", transliterated(text)).encode("ascii", "ignore").decode()
    text = text.replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text:
        text = "x"
    if text[0].isdigit():
        text = "x" + text
    return text


def clean_name_list(names: Iterable[str]) -> list[str]:
    """snake_case every name and make the result unique (``a``, ``a_2``, ...)."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for name in names:
        base = snake_name(name)
        if base in seen:
            seen[base] += 1
            candidate = f"{base}_{seen[base]}"
            while candidate in seen:
                seen[base] += 1
                candidate = f"{base}_{seen[base]}"
            seen[candidate] = 1
            out.append(candidate)
        else:
            seen[base] = 1
            out.append(base)
    return out


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_name_list(df.columns))


def names_without(names: Iterable[str], patterns: Iterable[str]) -> list[str]:
    """Names that match none of the case-insensitive regex ``patterns``."""
    regexes = [re.compile(p, re.IGNORECASE) for p in patterns]
    return [n for n in names if not any(r.search(n) for r in regexes)]


def drop_matching(df: DataFrame, patterns: Iterable[str]) -> DataFrame:
    return df.select(*[f"`{n}`" for n in names_without(df.columns, patterns)])


def replace_in_name(name: str, mapping: Mapping[str, str]) -> str:
    """Apply every literal replacement of ``mapping`` inside one name, in order."""
    for old, new in mapping.items():
        name = name.replace(old, new)
    return name


def replace_in_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.toDF(*[replace_in_name(n, mapping) for n in df.columns])


def with_suffix(df: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    keep = set(keep)
    return df.toDF(*[n if n in keep else n + suffix for n in df.columns])


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + n for n in df.columns])
