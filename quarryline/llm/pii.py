"""Personal information inside free text: find it, and put typed placeholders in its place.

Weak supervision. Patterns propose candidate spans; labelers (regular expressions, gazetteers, statistics of words over
the whole corpus, and the context) each vote for, against or not at all. Nobody labels by hand: expectation
maximisation (Dawid and Skene) estimates from the votes alone how reliable each labeler is, and its posteriors train
the final classifier, a logistic regression on the votes and the shape of a span, which decides.

Three stages. Words are counted exactly, in a table of their own, and what a word is (given name, surname, ...) follows
from *rates* alone, so a corpus delivered many times over gives the same names. Given names beyond the seed list are
learned: a word that often stands beside different surnames, or before patronymics. Then a map over the documents proposes spans with
their votes, and the counts per pattern of votes, of which there are few, train the model. The table of words goes to
the tasks as a broadcast while it has at most ``lexicon_words`` rows; beyond that each text gets its own words' rows by a join.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import split_hot_join
from ..plans.staging import staged
from .pii_lists import ADDRESS_CUES, GIVEN, ID_CUES, NAME_CUES, NAME_FOLLOWS, NUMBER_WORDS, PHONE_CUES, RESULT_NOUNS, TITLES, UNITS

EMAIL, PHONE, ID, ADDRESS, NAME = "email", "phone", "id_number", "address", "person_name"
PLACEHOLDER = {EMAIL: "[EMAIL]", PHONE: "[PHONE]", ID: "[ID_NUMBER]", ADDRESS: "[ADDRESS]", NAME: "[PERSON_NAME]"}
#: Counts of a word: occurrences, capitalised, beside a given name or patronymic on a line, beside one across a line
#: break, beside an initial or title.
_COUNTS = ("total", "capital", "near", "broken", "hint")

_i = regex.IGNORECASE
_or = "|".join

# ---------------------------------------------------------------- e-mail
_AT = r"(?:\s?\\?@\s?|\s*[(\[{]\s*(?:at|ät|собака|arobase)\s*[)\]}]\s*|\s+(?:at|ät|собака|arobase|klammeraffe)\s+)"
_DOT = r"(?:\.|\s*[(\[{]\s*(?:dot|точка|point|punkt)\s*[)\]}]\s*|\s+(?:dot|точка|point|punkt)\s+)"
_ATOM = r"(?:[\p{L}\p{M}\p{N}_+%-]|\\[_%&-])+"
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{M}\p{N}-]*[\p{L}\p{N}])?"
_EMAIL = regex.compile(rf"(?<![\p{{L}}\p{{N}}._+%-])(?P<local>{_ATOM}(?:{_DOT}{_ATOM})*+)(?P<at>{_AT})(?P<domain>{_LABEL}(?:{_DOT}{_LABEL})+)", _i)
#: What follows an ``at`` written out, bracketed or not, in an address.
_AFTER_AT = regex.compile(rf"\s*[)\]}}]?\s*{_LABEL}{_DOT}{_LABEL}", _i)

# ---------------------------------------------------------------- numbers
_S = r"[\s ]"
_PHONES = {
    "nanp": rf"(?:\+?1[-.\s]?)?(?:\(\d{{3}}\){_S}?|\d{{3}}[-.\s])\d{{3}}[-.\s]\d{{4}}(?:\s?(?:ext|x)\.?\s?\d+)?",
    "nanp_plain": r"\+1\d{10}",
    "uk": rf"(?:\+44{_S}?(?:\(0\))?|0)20{_S}\d{{4}}{_S}\d{{4}}|\(020\){_S}?\d{{4}}{_S}?\d{{4}}|\+44{_S}?\d(?:{_S}?\d){{8,9}}",
    "ru": rf"(?:\+7|8)[\s-]?\(?\d{{3}}\)?[\s-]?\d{{3}}[\s-]?\d{{2}}[\s-]?\d{{2}}",
    "de": rf"(?:\+49|0049){_S}?(?:\(0\))?{_S}?\d{{2,4}}[\s/-]?\d{{3,8}}(?:[\s-]\d{{2,4}})?|\(0\d{{2,4}}\){_S}?\d{{4,8}}(?:[\s-]\d{{2,4}})?|0\d{{2,4}}/\d{{4,8}}(?:-\d{{1,4}})?",
    "fr": rf"(?:\+33|0033){_S}?(?:\(0\))?{_S}?\d(?:[\s.]?\d{{2}}){{4}}|0\d(?:[\s.-]\d{{2}}){{4}}|0\d{{3}}{_S}\d{{2}}{_S}\d{{4}}|0[1-9]\d{{8}}",
    "intl": r"\+\d{1,3}[\s-]?(?:\(\d+\)[\s-]?)?\d(?:[\s-]?\d){6,12}",
}
_IDS = {
    "ssn": r"\d{3}-\d{2}-\d{4}|\d{3}\s\d{2}\s\d{4}",
    "coded": r"[A-Z]-\d{3}-\d{5}|[A-Z]\d{8}|[A-Z]{2}\s\d{2}\s\d{2}\s\d{2}\s[A-Z]|[A-Z]{2}\d{6}[A-Z]|[A-Z]\d{2}[A-Z]\d{4}[A-Z]|\d{2}[A-Z]{2}\d{5}|\d{2}\s?\d{6}\s?[A-Z]\s?\d{3}",
    "dashed": r"\d{3}-\d{3}-\d{3}[\s-]\d{2}|\d{4}-\d{6}",
    "numbered": r"\d{2}\s\d{2}\s№\s?\d{6}|\d{4}\s№\s?\d{6}|\d{2}\s\d{2}\s\d{6}|\d{4}\s\d{6}",
    "long": r"\d{12}|\d{13}(?:\s?\d{2})?|\d{15}|\d{9,11}",
    "insee": r"\d\s\d{2}\s\d{2}\s\d{2}\s\d{3}\s\d{3}\s\d{2}",
    "thousands": r"\d\s\d{3}\s\d{3}",
}
#: Where a number of six digits or more is; only there the shapes are tried.
_DIGITS = regex.compile(r"\d(?:[\s .()/№A-Z-]{0,4}+\d){5}")
_NUMBER = regex.compile(r"(?<![\p{L}\p{N}+/№])(?<!\d[.,:/-])(?:" + _or(f"(?P<p_{k}>{v})" for k, v in _PHONES.items()) + "|" + _or(f"(?P<i_{k}>{v})" for k, v in _IDS.items()) + r")(?![\p{L}\p{N}])(?![.,/:-]\d)")
_SPELLED = regex.compile(rf"(?<!\p{{L}})(?:(?:plus|плюс){_S}+)?(?:{_or(NUMBER_WORDS)})(?:[\s,-]+(?:{_or(NUMBER_WORDS)})){{6,}}(?!\p{{L}})", _i)

# ---------------------------------------------------------------- addresses
_UP = r"(?-i:\p{Lu})[\p{L}'’]*"
_EN_TOWN = rf"(?:,\s(?!(?:phone|tel)\b){_UP}(?:[\s-]{_UP}){{0,2}}(?:\s\d{{4,5}})?)"
_EN_STREET = r"(?:Road|Rd|Street|St|Lane|Ln|Avenue|Ave|Court|Ct|Drive|Close|Square|Terrace|Boulevard|Blvd|Crescent)"
_EN = rf"(?:(?:Flat|Apt|Apartment|Unit|Suite)\s\d+[A-Z]?,\s)?(?<!\d)\d{{1,4}}[A-Z]?\s(?:(?-i:\p{{Lu}})[\p{{L}}'’-]*\s){{1,3}}?(?=(?-i:\p{{Lu}})){_EN_STREET}\b\.?(?:,\s(?:Apt|Flat|Unit|Suite)\.?\s\d+[A-Z]?)?{_EN_TOWN}?"
_RU_KIND = r"(?:ул\.|улица|пр-т|проспект|просп\.|пер\.|переулок|пл\.|площадь|наб\.|набережная|шоссе|бульвар|б-р)"
_RU_NAME = r"[\p{Cyrillic}][\p{Cyrillic}-]+(?:\s(?!ул\.|пер\.|пр-т|д\.|дом\b)\p{Lu}[\p{Cyrillic}-]+)?"
_RU_HOUSE = r"(?:,?\s?(?:д\.|дом)\s?\d+\p{L}?|,?\s\d+(?:-\d+|\p{L}\b)?)(?:,?\s?(?:к\.|корп\.|корпус|стр\.)\s?\d+)?(?:,?\s?(?:кв\.|квартира|оф\.)\s?\d+)?"
_RU_LANE = r"(?:ая|ой|ый|ий|ов|ев),\s\d+-\d+"
_RU_TOWN = r"(?:(?:\d{6},\s)?(?<!\p{L}\.\s?)(?<!\p{L})(?-i:г\.\s?|город\s|Г\.\s?(?=\p{Lu}{3}))\p{Cyrillic}[\p{Cyrillic}-]+,\s|\d{6},\s(?:\p{Cyrillic}[\p{Cyrillic}-]+,\s)?)"
_RU = rf"{_RU_TOWN}?(?:(?<!\p{{L}}){_RU_KIND}\s{_RU_NAME}{_RU_HOUSE}|(?<!\p{{L}}){_RU_NAME}\s{_RU_KIND}{_RU_HOUSE})|{_RU_TOWN}(?=(?-i:\p{{Lu}})){_RU_NAME}{_RU_HOUSE}|(?<!\p{{L}})(?:\p{{Lu}}[\p{{Cyrillic}}-]+\s)?\p{{Cyrillic}}+{_RU_LANE}(?!-)"
_DE_END, _DE_AT = r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm)", r"(?<!\p{L})(?:Am|An\sder|Im|Auf\sdem|Zum|Zur)\s\p{L}+"
#: A street of two words begins with an adjective or the name of a place, not with a word that any street may follow.
_DE_NO_NAME = r"(?:d(?:er|ie|en|iese|ieser|iesen)|(?:k|m|s|d)?eine[rn]?|unsere[rn]?|ihre[rn]?|jede[rn]?|welche[rn]?|alle[rn]?|über|unter|hinter|weiter|immer|wieder)"
_DE_TWO = rf"(?<!\p{{L}})(?!{_DE_NO_NAME}\s)\p{{L}}[\p{{L}}-]+(?:er|e|en)\s{_DE_END}"
_DE_STREET = rf"(?:{_DE_TWO}|(?<!\p{{L}})\p{{L}}[\p{{L}}-]*{_DE_END}|{_DE_AT})\s\d{{1,4}}(?:\s?[a-z])?\b"
_DE_TOWN = r"(?<!\d)\d{5}\s\p{L}[\p{L}-]+"
_DE = rf"{_DE_TOWN},\s{_DE_STREET}|{_DE_STREET}(?:,\s{_DE_TOWN})?"
_FR_KIND = r"(?:rue|avenue|av\.|boulevard|bd|impasse|chemin|place|allée|quai|cours|route|square)"
_FR = rf"(?<!\d)\d{{1,4}}(?:\s(?:bis|ter|quater))?,?\s{_FR_KIND}\s(?:de\sla\s|de\sl['’]|des\s|du\s|de\s|d['’])?[\p{{L}}'’]+(?:-[\p{{L}}'’]+)*(?:,\s(?:appt|apt|app\.|bât\.)\s?\d+)?(?:,\s\d{{5}}\s\p{{L}}[\p{{L}}-]*)?"
_ADDRESS = regex.compile("|".join(f"(?P<{k}>{v})" for k, v in (("fr", _FR), ("ru", _RU), ("de", _DE), ("en", _EN))).replace(r"\s?", r"\s{0,2}").replace(r"\s(", r"\s{1,2}("), _i)
_AT_HERE = regex.compile(rf"{_DE_AT}\s{{1,2}}\d", _i)
_HOUSE_AFTER = regex.compile(r"\.?\s{1,2}\d")
_RU_BARE = regex.compile(r"\d{6},|,\s{1,2}\d+-\d")
_POSTAL = regex.compile(r"(?<!\d)\d{5,6}(?!\d)|\b(?:apt|flat|appt|кв\.|корп\.|г\.)\s?\d*", _i)

# ---------------------------------------------------------------- names
_TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*(?:[-'’]\p{L}+)*")
_PATRONYMIC = regex.compile(r"\p{Cyrillic}{2,}(?:ович|евич|ич|овна|евна|ична|инична)", _i)
_TEXMATH = regex.compile(r"(?<!(?<!\\)\\)(?:\$\$(?P<math>(?:[^$\\]|\\.)*+)\$\$|\$(?![\s$])(?P<math>(?:[^$\\]|\\.)*+)(?<!\s)\$)|\\\[(?P<math>(?:[^\\]|\\[^\[\]])*+)\\\]|\\(?:ref|cite|label|eqref|begin|end)\{[^}]*\}|\\\p{L}+", regex.DOTALL)
#: What no formula holds: an empty line, or two words in a row that are no commands.
_PROSE = regex.compile(r"\n[^\S\n]*\n|(?<![\\\p{L}])\p{L}{2,}\s+\p{L}{2,}")
_GIVEN = frozenset(g for names in GIVEN.values() for g in names)
_TITLES, _RESULT, _FOLLOWS = frozenset(TITLES), frozenset(RESULT_NOUNS), frozenset(NAME_FOLLOWS)
#: Kinds of tokens: G given name, P patronymic, I initial, S surname, C capitalised or rare word, other. Separators: _ space, ~ line break, comma, | any other.
_NAME = regex.compile(
    r"S,?[_~]G[_~]P|S,?[_~]G(?:[_~]I){0,2}(?!_[SC])|G[_~]P(?:[_~]S|_C)|G[_~]I(?:[_~]I)?(?:[_~]S|_C)|G(?:[_~]S|_C)|G[_~]P|S,?[_~]I(?:[_~]?I)*(?!_[SC])|I(?:[_~]?I)*(?:[_~]S|_C)|C,_G(?:_I)*(?!_[SC])|C_G_P|C_G(?!_[SC])|S"
)


def _cue(words: tuple[str, ...]) -> regex.Pattern:
    return regex.compile(rf"(?:^|(?<!\p{{L}}))(?:{_or(regex.escape(w) for w in sorted(words, key=len, reverse=True))})\W{{0,4}}$", _i)


_PHONE_CUE, _ID_CUE, _ADDRESS_CUE, _NAME_CUE = map(_cue, (PHONE_CUES, ID_CUES, ADDRESS_CUES, NAME_CUES + TITLES))
_UNIT = regex.compile(rf"\s?(?:[x×*=^_%]|(?:{_or(UNITS)})\b)", _i)
_MATH_BEFORE = regex.compile(r"(?:[=×*^_<>]|\b(?:isbn|doi|matrix|version|commit|seite|page|frame|step)\b\.?:?|\d\s?x)\s?$", _i)
_NAME_AFTER = regex.compile(rf"\s?(?:\(|:\s\d|<|;\S|,?\s(?:{_or(regex.escape(w) for w in NAME_FOLLOWS)})(?!\p{{L}}))", _i)
_EDGE_BEFORE, _EDGE_AFTER = regex.compile(r"(?:^|\n)[^\S\n]*$"), regex.compile(r"[^\S\n]*(?:\n|$)")


_JOINT = regex.compile(r"[-'’]")
_AT_WORD, _FR_WORD, _DE_WORD, _DE_PLACE, _EN_WORD, _RU_WORD, _COUNT_WORD = (1 << i for i in range(7))
_HINTS = (
    (_AT_WORD, {"at", "ät", "собака", "arobase", "klammeraffe"}),
    (_FR_WORD, {"rue", "avenue", "av", "boulevard", "bd", "impasse", "chemin", "place", "allée", "quai", "cours", "route", "square"}),
    (_DE_PLACE, {"am", "an", "im", "auf", "zum", "zur"}),
    (_EN_WORD, {"road", "rd", "street", "st", "lane", "ln", "avenue", "ave", "court", "ct", "drive", "close", "square", "terrace", "boulevard", "blvd", "crescent"}),
    (_RU_WORD, {"ул", "улица", "пр-т", "проспект", "просп", "пер", "переулок", "пл", "площадь", "наб", "набережная", "шоссе", "бульвар", "б-р", "г", "город"}),
    (_COUNT_WORD, frozenset(NUMBER_WORDS)),
)
_DE_ENDS = ("strasse", "str", "weg", "gasse", "platz", "allee", "ufer", "damm")


class _Flags(dict):
    """What a written word may be a part of: a bit per kind of hint. Each word is looked at once."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        low, folded = word.lower(), word.casefold()
        names = {low, folded, _JOINT.split(low)[0]}
        self[word] = bits = sum(bit for bit, some in _HINTS if not names.isdisjoint(some)) | (_DE_WORD if folded.endswith(_DE_ENDS) else 0)
        return bits


_FLAGS = _Flags()


class Lexicon:
    """What is known of words: ``G`` given name, ``S`` behaves as a surname, ``R`` beside given names though in lower case,
    ``N`` another proper noun, ``c`` common; see ``lexicon_of``. Words are in lower case, compounds are judged by all their parts."""

    def __init__(self, known: dict[str, str]):
        self.known = known
        self.tokens = _Tokens(self)

    def kind(self, word: str) -> str:
        kinds = {self.known.get(p, "") for p in _JOINT.split(word.lower()) if p}
        return "S" if kinds == {"S"} else "c" if "c" in kinds else "R" if kinds and kinds <= {"R", "S"} else "N" if kinds and kinds <= {"N", "R", "S"} else ""

    def given(self, lower: str) -> bool:
        return lower in _GIVEN or self.known.get(lower) == "G" or "-" in lower and all(p in _GIVEN or self.known.get(p) == "G" for p in lower.split("-"))


class _Tokens(dict):
    """Kind of a written word in ``_NAME``; ``i`` for one that is an initial if a full stop follows."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> str:
        if len(self) > 500_000:
            self.clear()
        lower = word.lower()
        if len(word) == 1 and word.isupper():
            kind = "i"
        elif self.lexicon.given(lower):
            kind = "G"
        elif len(word) > 4 and _PATRONYMIC.fullmatch(word):
            kind = "P"
        elif lower in _RESULT:
            kind = "o"
        else:
            known = self.lexicon.kind(word)
            rare = known in ("R", "N") or word[0].isupper() and len(word) > 3 and known != "c"
            kind = "S" if known == "S" else "C" if rare and lower not in _TITLES else "o"
        self[word] = kind
        return kind


@dataclass(frozen=True)
class Candidate:
    kind: str
    begin: int
    end: int
    shape: str
    votes: tuple[int, ...]

    @property
    def pattern(self) -> str:
        return f"{self.kind}/{self.shape}/" + "".join("-0+"[v + 1] for v in self.votes)


def _may_hold_email(text: str, found: list[regex.Match], flags: list[int]) -> bool:
    """Whether ``_EMAIL`` can match: there is an at sign, or an ``at`` written out before a domain."""
    return "@" in text or any(f & _AT_WORD and _AFTER_AT.match(text, m.end()) for m, f in zip(found, flags) if f)


def _may_hold_address(text: str, found: list[regex.Match], flags: list[int]) -> bool:
    """Whether ``_ADDRESS`` can match: a word that every one of its alternatives needs, with a number where it needs one."""
    if _RU_BARE.search(text):
        return True
    for m, f in zip(found, flags):
        if not f:
            continue
        if f & _RU_WORD:
            return True
        if f & _FR_WORD and any(c.isdigit() for c in text[max(0, m.start() - 14) : m.start()]):
            return True
        if f & _EN_WORD and any(c.isdigit() for c in text[max(0, m.start() - 200) : m.start()]):
            return True
        if f & _DE_WORD and _HOUSE_AFTER.match(text, m.end()) or f & _DE_PLACE and _AT_HERE.match(text, m.start()):
            return True
    return False


def _emails(text: str) -> Iterator[Candidate]:
    for m in _EMAIL.finditer(text):
        domain, at = m.group("domain"), m.group("at")
        labels = regex.split(_DOT, domain, flags=_i)
        plain_at, plain_dot = "@" in at, "." in domain
        left = text[max(0, m.start() - 12) : m.start()]
        shape = ("plain" if plain_at else "bracket" if regex.search(r"[(\[{]", at) else "word") + ("." if plain_dot else "word")
        yield Candidate(EMAIL, m.start(), m.end(), shape, (
            1 if labels[-1].isalpha() and len(labels[-1]) > 1 else -1,
            1 if any(c.isalpha() for x in labels[:-1] for c in x) and len(labels[0]) > 1 else -1,
            -1 if not plain_at and plain_dot and "(" not in at and "[" not in at else 1 if plain_at and plain_dot else 0,
            -1 if regex.search(r"\\(?:cite|ref|label)\{[^}]*$", left) else 1 if regex.search(r"[<{;]\s?$", left) else 0,
            1 if len(m.group("local")) > 3 else -1,
        ))


def _shaped(text: str) -> Iterator[regex.Match]:
    at = 0
    while near := _DIGITS.search(text, at):
        m = _NUMBER.search(text, max(at, near.start() - 6), min(len(text), near.end() + 60))
        if m and m.start() <= near.end():
            yield m
            at = m.end()
        else:
            at = near.start() + 1


def _numbers(text: str) -> Iterator[Candidate]:
    for m in _shaped(text):
        name = m.lastgroup or ""
        begin, end, left, right = m.start(), m.end(), text[max(0, m.start() - 40) : m.start()], text[m.end() : m.end() + 24]
        # A separated digit or group right before or after makes it part of a longer run of numbers.
        run = bool(regex.search(r"\d[  ]$", left[-2:])) or bool(regex.match(r"[  ]\d", right))
        unit = bool(_UNIT.match(right)) or bool(_MATH_BEFORE.search(left))
        alone = bool(_EDGE_BEFORE.search(left)) and bool(_EDGE_AFTER.match(right))
        phone_cue, id_cue = bool(_PHONE_CUE.search(left)), bool(_ID_CUE.search(left))
        follows = bool(regex.match(r"(?:,\s|\s)\p{L}[\p{L}.]*", right)) and bool(_EDGE_BEFORE.search(left))
        enclosed = bool(regex.search(r"[(;]$", left)) and bool(regex.match(r"[);]|\sext", right))
        decimal = bool(regex.fullmatch(r"[\d\s]*\d\.\d[\d\s]*", m.group()))
        if name.startswith("p_"):
            kind, shape = PHONE, name[2:]
            votes = (1 if m.group()[0] in "+(" else 0, 1 if phone_cue else -1 if id_cue else 0, -1 if unit or decimal else 0, -1 if run else 0, 1 if enclosed or alone else 0, 1 if shape not in ("intl",) else 0)
        else:
            kind, shape = ID, name[2:]
            strict = shape in ("ssn", "coded", "dashed", "numbered", "insee")
            votes = (1 if strict else 0, 1 if id_cue else -1 if phone_cue else 0, -1 if unit else 0, -1 if run else 0, 1 if alone or follows else 0, 1 if regex.match(r",\s\p{L}|\)|:\s", right) else 0)
        yield Candidate(kind, begin, end, shape, votes)


def _spelled(text: str) -> Iterator[Candidate]:
    """Phone numbers written out in words."""
    for m in _SPELLED.finditer(text):
        left = text[max(0, m.start() - 40) : m.start()]
        yield Candidate(PHONE, m.start(), m.end(), "spelled", (1, 1 if _PHONE_CUE.search(left) else 0, 0, 0, 1 if regex.search(r"[(;]$|\n$|^$", left) else 0, 1))


def _addresses(text: str) -> Iterator[Candidate]:
    for m in _ADDRESS.finditer(text):
        span, left = m.group(), text[max(0, m.start() - 40) : m.start()]
        words_ = [w for w in regex.findall(r"\p{L}{4,}", span)]
        capital = sum(w[0].isupper() for w in words_)
        yield Candidate(ADDRESS, m.start(), m.end(), m.lastgroup or "", (
            1 if _POSTAL.search(span) else 0,
            1 if _ADDRESS_CUE.search(left) or regex.search(r"[,;]\s$", left) else 0,
            1 if capital else -1,
            -1 if regex.search(r"\d[^\S\n]\Z|\b(?:step|steps|page|section|minute|group)[^\S\n]\Z", left, _i) else 0,
            1 if _EDGE_BEFORE.search(left) else 0,
        ))


def _blank(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with spans replaced by a character that belongs to no token, offsets unchanged."""
    if not spans:
        return text
    out, at = [], 0
    for begin, end in sorted(spans):
        if begin >= at:
            out += [text[at:begin], "\x00" * (end - begin)]
            at = end
    return "".join([*out, text[at:]])


def _tex(text: str) -> Iterator[tuple[int, int]]:
    """Formulas, references and commands. A dollar opens a formula only if the next one can close it; one that cannot is left open, so an unpaired dollar does not turn the prose after it into a formula."""
    at = 0
    while m := _TEXMATH.search(text, at):
        body = m.group("math")
        if body and _PROSE.search(body):
            at = m.start("math")
        else:
            yield m.span()
            at = m.end()


def _names(text: str, taken: list[tuple[int, int]], lexicon: Lexicon) -> Iterator[Candidate]:
    open_text = _blank(text, taken + list(_tex(text)))
    found = list(_TOKEN.finditer(open_text))
    spans = [m.span() for m in found]
    written = [m.group() for m in found]
    kinds = [lexicon.tokens[w] for w in written]
    for i, kind in enumerate(kinds):
        if kind == "i":
            begin, end = spans[i]
            stop = open_text[end : end + 1] == "."
            kinds[i], spans[i] = ("I", (begin, end + 1)) if stop else ("o", (begin, end))
    if not any(k in "GSPI" for k in kinds):
        return
    low = [w.lower() for w in written]
    line: list[str] = []
    token_of: list[int] = []
    for i, kind in enumerate(kinds):
        if i:
            gap = open_text[spans[i - 1][1] : spans[i][0]]
            bare = gap.strip()
            space = "~" if "\n" in gap else "_"
            sep = f",{space}" if bare == "," and gap != "," and len(gap) <= 4 else space if not bare and len(gap) <= 3 else "|"
            if not gap and kind == "I" and kinds[i - 1] == "I" or not gap and kinds[i - 1] == "I":
                sep = "_"
            for c in sep:
                line.append(c)
                token_of.append(-1)
        line.append(kind)
        token_of.append(i)
    string = "".join(line)
    for m in _NAME.finditer(string):
        members = [token_of[j] for j in range(m.start(), m.end()) if token_of[j] >= 0]
        begin, end = spans[members[0]][0], spans[members[-1]][1]
        shape = regex.sub(r"I(?:_?I)+", "I", m.group().replace("~", "_"))
        left, right = open_text[max(0, begin - 40) : begin], open_text[end : end + 40]
        first, last = members[0], members[-1]
        around = low[max(0, first - 2) : first] + low[last + 1 : last + 3]
        near_left = low[first - 1 : first] if first and open_text[spans[first - 1][1] : begin] == " " else []
        near_right = low[last + 1 : last + 2] if last + 1 < len(spans) and open_text[end : spans[last + 1][0]] == " " else []
        possessive = bool(regex.match(r"['’]s\b", right)) or bool(regex.search(r"['’]s$", text[begin:end]))
        result = bool(_RESULT.intersection(near_left + near_right)) or possessive or (len(members) == 1 and bool(_RESULT.intersection(around)))
        surnames = [low[i] for i in members if kinds[i] in "SC"]
        common = any(lexicon.kind(w) == "c" for w in surnames)
        stray = any(kinds[i] == "C" and lexicon.kind(text[slice(*spans[i])]) not in ("R", "N") for i in members) and not all(text[spans[i][0]].isupper() for i in members)
        contact = "\x00" in open_text[max(0, begin - 8) : begin] or "\x00" in open_text[end : end + 8]
        yield Candidate(NAME, begin, end, shape, (
            1 if "G" in m.group() else 0,
            1 if "P" in m.group() else 0,
            1 if "I" in m.group() else 0,
            -1 if common else 1 if "S" in m.group() else 0,
            1 if _NAME_CUE.search(left) else 0,
            1 if _NAME_AFTER.match(right) or _EDGE_BEFORE.search(left) and _EDGE_AFTER.match(right) else 0,
            -1 if result else 0,
            1 if contact else 0,
            -1 if stray else 0,
        ))


def candidates(text: str, lexicon: Lexicon) -> list[Candidate]:
    """Candidate spans of a text in order, not overlapping: e-mail before address, address before number, all before names."""
    kept: list[Candidate] = []

    def take(found: Iterator[Candidate]) -> None:
        begins, ends, fresh = [c.begin for c in kept], [c.end for c in kept], []
        for c in found:
            i = bisect_left(begins, c.end)  # the spans kept before this one's end; they are sorted and apart
            if (not i or ends[i - 1] <= c.begin) and (not fresh or fresh[-1].end <= c.begin):
                fresh.append(c)
        kept[:] = sorted(kept + fresh, key=lambda c: c.begin)

    found = list(_TOKEN.finditer(text))
    written = [m.group() for m in found]
    flags = [_FLAGS[w] for w in written]
    if _may_hold_email(text, found, flags):
        take(_emails(text))
    if _may_hold_address(text, found, flags):
        take(_addresses(text))
    take(_numbers(text))
    if sum(w.count("-") + 1 for w, f in zip(written, flags) if f & _COUNT_WORD) >= 7:
        take(_spelled(text))
    kinds = [lexicon.tokens[w] for w in written]
    if not {"G", "S", "P"}.isdisjoint(kinds) or any(k == "i" and text[m.end() : m.end() + 1] == "." for m, k in zip(found, kinds)):
        take(_names(text, [(c.begin, c.end) for c in kept], lexicon))
    return kept


# ---------------------------------------------------------------- the model
#: Weight of all patterns of a kind together, against the priors.
SAMPLE = 2_000.0


def dawid_skene(votes: np.ndarray, counts: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern being true, and per labeler the log odds that its vote for and against add.

    ``votes`` is patterns by labelers in -1, 0, 1; an abstention says nothing. Each labeler has a chance to vote for and
    one to vote against, given true and given false. The start is the votes' balance, a vote against counting double; a
    vote is never taken to mean its opposite, which keeps the meaning of the two classes.
    """
    for_, against = (votes > 0).astype(float), (votes < 0).astype(float)
    belief = 1 / (1 + np.exp(-(1 + for_.sum(1) - 3.0 * against.sum(1))))
    odds = np.zeros((votes.shape[1], 2))
    for _ in range(rounds):
        yes, no = belief * counts, (1 - belief) * counts
        ratio = [np.log((yes @ v + 1) / (yes.sum() + 10)) - np.log((no @ v + 1) / (no.sum() + 10)) for v in (for_, against)]
        odds[:, 0], odds[:, 1] = np.maximum(ratio[0], 0.1), np.minimum(ratio[1], -1.0)
        prior = np.clip(yes.sum() / counts.sum(), 0.3, 0.7)
        belief = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + for_ @ odds[:, 0] + against @ odds[:, 1], -30, 30)))
    return belief, odds


def logistic(x: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression on soft targets with counts, by Newton's method."""
    w = np.zeros(x.shape[1])
    scale = np.minimum(counts, 50.0 * np.sqrt(counts))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (scale * (p - target)) + ridge * w
        hess = (x * (scale * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(patterns: dict[str, int]) -> dict[str, float]:
    """The probability of being personal information for each pattern ``kind/shape/votes`` with its count."""
    chance: dict[str, float] = {}
    for kind in (EMAIL, PHONE, ID, ADDRESS, NAME):
        own = sorted(p for p in patterns if p.startswith(f"{kind}/"))
        if not own:
            continue
        votes = np.array([["-0+".index(v) - 1 for v in p.rpartition("/")[2]] for p in own])
        counts = np.array([patterns[p] for p in own], dtype=float)
        counts *= SAMPLE / counts.sum()  # so that the same corpus, delivered many times over, gives the same model
        belief, _ = dawid_skene(votes, counts)
        shapes = [p.split("/")[1] for p in own]
        names = sorted(set(shapes))
        x = np.hstack([np.ones((len(own), 1)), votes > 0, votes < 0, np.array([[s == n for n in names] for s in shapes])]).astype(float)
        w = logistic(x, belief, counts)
        chance |= dict(zip(own, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))
    return chance


# ---------------------------------------------------------------- over tables
_BEFORE_PATRONYMIC = "\x01"
_TRIGGER, _PAIR, _WORTH, _INITIAL = regex.compile("[GPIT]"), regex.compile("u[uP]"), regex.compile("[GPT]|u[uP]"), regex.compile(r"(?<!\p{L})\p{Lu}\.")
_WORD_ROWS = "word string, mate string, " + ", ".join(f"{c} bigint" for c in _COUNTS)


class _Triggers(dict):
    """``G`` for a given name, ``P`` a patronymic, ``I`` what may be an initial, ``T`` a title, ``u`` another capitalised word, ``.`` any other."""

    def __missing__(self, word: str) -> str:
        if len(self) > 500_000:
            self.clear()
        lower = word.lower()
        seeds = lower in _GIVEN or "-" in lower and all(p in _GIVEN for p in lower.split("-"))
        known = "G" if seeds else "P" if len(word) > 4 and _PATRONYMIC.fullmatch(word) else "T" if lower in _TITLES else ""
        self[word] = kind = "I" if len(word) == 1 and word.isupper() else known or ("u" if word[0].isupper() and len(word) > 2 else ".")
        return kind


def _statistics(flush: int = 400_000):
    """Counts of words, and of pairs of capitalised words (``word`` before ``mate``), of the texts of a task; at most about ``flush`` keys are held."""

    def rows(seen: Counter, beside: Counter, pairs: Counter) -> pa.RecordBatch:
        words: dict[str, list[int]] = {}
        for word, n in seen.items():
            for part in (word,) if word.isalpha() else _JOINT.split(word):
                if part:
                    row = words.setdefault(part.lower(), [0] * 5)
                    row[0] += n
                    row[1] += n * part[0].isupper()
        for (word, place), n in beside.items():
            for part in _JOINT.split(word):
                if part:
                    words.setdefault(part.lower(), [0] * 5)[place] += n
        mates = [(a, b, n, 0, 0, 0, 0) for (a, b), n in pairs.items()]
        out = [(w, None, *row) for w, row in words.items()] + mates
        types = [pa.string(), pa.string(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names=["word", "mate", *_COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, beside, pairs, triggers = Counter(), Counter(), Counter(), _Triggers()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                emails = [m.span() for m in _EMAIL.finditer(text)] if "@" in text else []
                text = _blank(text, emails + (list(_tex(text)) if "$" in text or "\\" in text else []))
                words = _TOKEN.findall(text)
                seen.update(words)
                marks = "".join([triggers[w] for w in words])
                if not _WORTH.search(marks) and not ("I" in marks and _INITIAL.search(text)):
                    continue
                spans = [m.span() for m in _TOKEN.finditer(text)]
                for m in _TRIGGER.finditer(marks):
                    i, mark = m.start(), m.group()
                    begin, end = spans[i]
                    if mark in "IT" and text[end : end + 1] == ".":
                        end += 1
                    elif mark == "I":
                        continue
                    if i + 1 < len(words) and marks[i + 1] not in "GPI" and (mark != "P" or words[i + 1][0].isupper()):
                        gap = text[end : spans[i + 1][0]]
                        if len(gap) <= 4 and gap.strip() in ("", ","):
                            beside[words[i + 1], 4 if mark in "IT" else 3 if "\n" in gap else 2] += 1
                    if i and mark not in "PT" and marks[i - 1] not in "GPI":
                        gap = text[spans[i - 1][1] : begin]
                        if len(gap) <= 4 and gap.strip() in ("", ","):
                            beside[words[i - 1], 4 if mark == "I" else 3 if "\n" in gap else 2] += 1
                for m in _PAIR.finditer(marks, overlapped=True):
                    i = m.start()
                    if text[spans[i][1] : spans[i + 1][0]] == " ":
                        pairs[words[i].lower(), _BEFORE_PATRONYMIC if marks[i + 1] == "P" else words[i + 1].lower()] += 1
            if len(seen) + len(beside) + len(pairs) > flush:
                yield rows(seen, beside, pairs)
                seen, beside, pairs = Counter(), Counter(), Counter()
        yield rows(seen, beside, pairs)

    return run


def _surname(near: str = "near") -> Column:
    """A word that is capitalised as a rule and stands beside a given name often enough."""
    return F.expr(f"length(word) >= 4 AND {near} + broken >= 0.1 * total AND capital >= 0.4 * total")


def lexicon_of(documents: DataFrame) -> DataFrame:
    """``word, class`` of the words that ever stand beside a given name, patronymic, initial or title, from counts over all documents.

    Classes follow from rates, never from sizes: a surname (``S``) stands beside a given name in a tenth of its occurrences
    and is capitalised in two fifths; ``R`` is beside one as often but mostly in lower case; a common word (``c``) is so in less than
    2 of 1,000, or of 100 if mostly in lower case, and beside initials and titles in less than a tenth; ``N`` is another word mostly
    capitalised. A word is a given name (``G``) if a tenth of its occurrences stand beside surnames, of which two are different, or before
    patronymics, at least half of that tenth before them, and if it is capitalised in three fifths; words beside learned names
    count as beside a given name. Words without a class are left out.
    """
    rows = documents.select("text").mapInArrow(_statistics(), _WORD_ROWS)
    counted = staged(rows.groupBy("word", "mate").agg(*[F.sum(c).alias(c) for c in _COUNTS]), "words")
    words, pairs = counted.where("mate IS NULL").drop("mate"), counted.where("mate IS NOT NULL").select("word", "mate", F.col("total").alias("n"))
    sure = words.where(_surname()).select(F.col("word").alias("sure"))
    before = pairs.join(sure, F.col("mate") == F.col("sure")).select("word", "mate", "n", F.lit("before").alias("where"))
    after = pairs.join(sure, F.col("word") == F.col("sure")).select(F.col("mate").alias("word"), F.col("word").alias("mate"), "n", F.lit("after").alias("where"))
    father = pairs.where(F.col("mate") == _BEFORE_PATRONYMIC).withColumn("where", F.lit("father"))
    met = before.unionByName(after).unionByName(father).groupBy("word").agg(F.sum("n").alias("met"), F.sum(F.when(F.col("where") != "after", F.col("n"))).alias("led"), F.count_distinct("mate").alias("mates"), F.bool_or(F.col("where") == "father").alias("father"))
    listed = [*_RESULT, *_TITLES, *_FOLLOWS, *_GIVEN]
    likely = "met >= 0.1 * total AND led >= 0.05 * total AND capital >= 0.6 * total AND (mates >= 2 OR father)"
    learned = words.join(met, "word").where(likely).where(~_surname() & ~F.col("word").isin(listed)).select("word", F.lit(True).alias("learned"))
    learned = staged(learned, "given")
    beside = pairs.where(F.col("mate") != _BEFORE_PATRONYMIC)
    right = beside.join(learned, "word").select(F.col("mate").alias("word"), "n")
    left = beside.join(learned.withColumnRenamed("word", "mate"), "mate").select("word", "n")
    extra = right.unionByName(left).groupBy("word").agg(F.sum("n").alias("extra"))
    joined = words.join(learned, "word", "left").join(extra, "word", "left").withColumn("by", F.col("near") + F.coalesce("extra", F.lit(0)))
    follows = [w for w in _FOLLOWS if " " not in w]
    kind = (
        F.when(F.col("learned"), "G")
        .when(_surname("by"), "S")
        .when(F.expr("length(word) >= 5 AND by + broken > 0 AND by + broken >= 0.1 * total") & ~F.col("word").isin(follows), "R")
        .when(F.expr("by < 0.002 * total AND hint < 0.1 * total"), "c")
        .when(F.expr("length(word) >= 4 AND capital >= 0.6 * total"), "N")
        .when(F.expr("by + broken < 0.02 * total AND hint < 0.1 * total AND capital < 0.3 * total"), "c")
    )
    return joined.where("by + broken + hint > 0 OR learned").select("word", kind.alias("class")).where("class IS NOT NULL")


_SPANS = "array<struct<kind:string,begin:bigint,stop:bigint,pattern:string>>"


def _proposals(shared, keep_text: bool):
    """Spans of each text. ``shared`` holds the lexicon, or is None if each row brings its own words' classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(dict(zip(*shared.value))) if shared else Lexicon({})
        spans_type = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("stop", pa.int64()), ("pattern", pa.string())]))
        for batch in batches:
            found = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not shared:
                    lexicon = Lexicon({x["word"]: x["class"] for x in batch.column("known")[i].as_py() or []})
                found.append([{"kind": c.kind, "begin": c.begin, "stop": c.end, "pattern": c.pattern} for c in candidates(text, lexicon)] if text else [])
            if keep_text:
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(found, type=spans_type)], names=["doc", "text", "spans"])
                continue
            some = pa.array([i for i, f in enumerate(found) if f], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(some), pa.array([f for f in found if f], type=spans_type)], names=["doc", "spans"])

    return run


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            words = sorted({p.lower() for m in _TOKEN.finditer(text) for p in _JOINT.split(m.group()) if p})
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(words), pa.int64()), pa.array(words, pa.string())], names=["key", "word"])


def _proposed(documents: DataFrame, doc_id: str, keep_text: bool, lexicon_words: int) -> tuple[DataFrame, list[str]]:
    """The documents with their proposed spans, written out, and the accepted patterns of votes."""
    spark = documents.sparkSession
    texts = documents.select(F.col(doc_id).alias("doc"), "text")
    lexicon = staged(lexicon_of(documents), "lexicon")
    typed = f"doc {texts.schema['doc'].dataType.simpleString()}, " + ("text string, " if keep_text else "") + f"spans {_SPANS}"
    if lexicon.count() <= lexicon_words:
        rows = lexicon.toArrow()
        shared = spark.sparkContext.broadcast((rows.column("word").to_pylist(), rows.column("class").to_pylist()))
        proposed = texts.mapInArrow(_proposals(shared, keep_text), typed)
    else:
        keyed = texts.withColumn("key", F.xxhash64("text"))
        words = keyed.where("text <> ''").groupBy("key").agg(F.max("text").alias("text")).mapInArrow(_words_of, "key bigint, word string")
        known = split_hot_join(staged(words, "text-words"), lexicon, ["word"], how="inner").groupBy("key").agg(F.collect_list(F.struct("word", "class")).alias("known"))
        proposed = split_hot_join(keyed, known, ["key"]).select("doc", "text", "known").mapInArrow(_proposals(None, keep_text), typed)
    proposed = staged(proposed, "spans")
    counted = proposed.select(F.explode("spans.pattern").alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))
    chance = fit({r["pattern"]: r["n"] for r in counted.toLocalIterator()})
    return proposed, [p for p, c in chance.items() if c >= 0.5]


def _accepted(patterns: list[str]) -> Column:
    return F.filter("spans", lambda s: F.array_contains(F.lit(patterns), s["pattern"]) if patterns else F.lit(False))


def find(documents: DataFrame, doc_id: str, lexicon_words: int = 1_000_000) -> DataFrame:
    """``doc_id, pii_type, begin_pos, end_pos``: one row per item, positions in characters from 0.

    ``documents`` has a ``text`` and an id; null and empty texts give no rows, null ids are ids like others, repeated rows
    give repeated rows, an empty table none. Items of a document do not overlap.
    """
    proposed, accepted = _proposed(documents, doc_id, False, lexicon_words)
    kept = proposed.select("doc", F.explode(_accepted(accepted)).alias("s")).select("doc", "s.*")
    return kept.select(F.col("doc").alias(doc_id), F.col("kind").alias("pii_type"), F.col("begin").alias("begin_pos"), F.col("stop").alias("end_pos"))


def redact(documents: DataFrame, doc_id: str, lexicon_words: int = 1_000_000) -> DataFrame:
    """``doc_id, text, items``: each text with placeholders in place of the items, the rest unchanged; null stays null.

    One row per row of ``documents``: the spans travel with their text, so null and repeated ids make no difference.
    """
    proposed, accepted = _proposed(documents, doc_id, True, lexicon_words)
    marks = F.create_map(*[F.lit(x) for pair in PLACEHOLDER.items() for x in pair])
    rows = proposed.withColumn("spans", _accepted(accepted)).withColumn("marks", marks)
    parts = F.expr(
        """concat(array_join(transform(spans, (s, i) -> concat(
             substring(text, cast(if(i = 0, 1, spans[greatest(i - 1, 0)].stop + 1) AS int), cast(s.begin - if(i = 0, 0, spans[greatest(i - 1, 0)].stop) AS int)),
             try_element_at(marks, s.kind))), ''),
           substring(text, cast(if(size(spans) = 0, 1, try_element_at(spans, -1).stop + 1) AS int)))"""
    )
    return rows.select(F.col("doc").alias(doc_id), parts.alias("text"), F.size("spans").alias("items"))
