"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation (operator 2)."""

from __future__ import annotations

import re
from datetime import date
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import map_texts

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

PARTS = {
    "secret": r"""(?<!\w)(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\s?[=:]\s?["']?(?P<value>[A-Za-z0-9+/_.-]{8,})""",
    "email": r"(?<![\w.+%-])(?P<local>[A-Za-z0-9][A-Za-z0-9._+%-]*)@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "key": r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])",
    # a time may follow a date after T
    "date": r"(?<![\w./-])(?:[0-9]{4}(?P<ymd>[-/.])[0-9]{1,2}(?P=ymd)[0-9]{1,2}|[0-9]{1,2}(?P<dmy>[-/.])[0-9]{1,2}(?P=dmy)[0-9]{4})(?![/-]|(?![Tt][0-9]{2})\w|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4})(?!\w)",
    "world": r"(?<![\w+])\+[2-9][0-9](?:[ .-]?\(?[0-9]\)?){7,12}(?!\w)",
    "card": r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?!\w)",
}
KINDS = tuple(PARTS)
EACH = {kind: re.compile(part) for kind, part in PARTS.items()}
PATTERN = re.compile("|".join(f"(?P<{kind}>{part})" for kind, part in PARTS.items()))
TOKEN = re.compile(r"\W*\w+")
#: Characters of an account number by country.
IBAN_SIZES = {k: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 33: "RU", 32: "LC",
}.items() for k in codes.split()}
HINT = re.compile("[0-9@=:]")


class Feistel:
    """Keyed permutations of ``range(size)``, one for each label; halves of equal width, walking on until the value fits."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, label: bytes, step: int, half: int, value: int) -> int:
        data = label + bytes([step]) + value.to_bytes((half + 7) // 8, "big")
        return int.from_bytes(blake2b(data, key=self.key, digest_size=(half + 7) // 8).digest(), "big") & ((1 << half) - 1)

    def permute(self, label: str, value: int, size: int, fits=lambda x: True, inverse: bool = False) -> int:
        """Image of ``value``; ``fits`` restricts the permutation to a subset that must hold ``value``."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        name, mask = f"{label}/{size}/".encode(), (1 << half) - 1
        while True:
            left, right = value >> half, value & mask
            for step in range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS):
                if inverse:
                    left, right = right ^ self._round(name, step, half, left), left
                else:
                    left, right = right, left ^ self._round(name, step, half, right)
            value = left << half | right
            if value < size and fits(value):
                return value


def luhn(digits: str) -> int:
    """Check sum of a card number; 0 for a valid one."""
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(sum(divmod(2 * d, 10)) for d in own[1::2])) % 10


def _candidates(kind: str, found: str):
    """What a match may hold at its start: cards end at any token from 19 to 13 digits, account numbers first at their country's length."""
    if kind == "iban":
        size = IBAN_SIZES.get(found[:2], 0)
        places = [k for k, c in enumerate(found, 1) if c != " "]
        if 0 < size < len(places) and found[places[size - 1]] == " ":
            yield found[: places[size - 1]]
    yield found
    if kind == "card":
        digits = sum(c.isdigit() for c in found)
        for k in range(len(found) - 1, 0, -1):
            digits -= found[k].isdigit()
            if digits < 13:
                return
            if not found[k].isdigit():
                yield found[:k]


def _refill(shape: str, letters: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    new = iter(letters)
    return "".join(next(new) if c.isascii() and c.isalnum() else c for c in shape)


class Pseudonyms:
    """Maps validated values to others of the same format; equal values, whatever their separators, get equal ones."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.feistel, self.inverse = Feistel(key), inverse

    def _permute(self, label: str, value: int, size: int, fits=lambda x: True) -> int:
        return self.feistel.permute(label, value, size, fits, self.inverse)

    def characters(self, label: str, text: str, codes: bool = False) -> str:
        """Digits stay digits and letters letters of their case; with ``codes``, lower-case hexadecimal text stays such."""
        own = [c for c in text if c.isascii() and c.isalnum()]
        hexadecimal = codes and all(c in "0123456789abcdef" for c in own)
        sets = ["0123456789abcdef" if hexadecimal else "0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" for c in own]
        value, size = 0, 1
        for c, s in zip(own, sets):
            value, size = value * len(s) + s.index(c.lower()), size * len(s)
        shape = "".join("h" if hexadecimal else "9" if c.isdigit() else "a" for c in own)
        value, out = self._permute(f"{label}/{shape}", value, size) if size > 1 else value, []
        for c, s in zip(reversed(own), reversed(sets)):
            value, k = divmod(value, len(s))
            out.append(s[k].upper() if c.isupper() else s[k])
        return _refill(text, "".join(reversed(out)))

    def secret(self, text: str) -> str:
        start = len(text) - len(PATTERN.fullmatch(text)["value"])
        return text[:start] + self.characters("secret", text[start:], codes=True)

    def email(self, text: str) -> str:
        local, _, host = text.partition("@")
        return f"{self.characters('email', local)}@{host}"

    def key(self, text: str) -> str:
        return text[:4] + self.characters("key", text[4:])

    def iban(self, text: str) -> str | None:
        own = text.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if number(own[4:] + own[:4]) % 97 != 1:
            return None
        body = self.characters(f"iban/{own[:2]}", own[4:])
        return _refill(text, f"{own[:2]}{98 - number(body + own[:2] + '00') % 97:02d}{body}")

    def ip(self, text: str) -> str | None:
        parts = [int(x) for x in text.split(".")]
        usable = lambda x: 0 < x >> 24 < 224 and x >> 24 != 127
        value = int.from_bytes(bytes(parts), "big") if max(parts) < 256 else 0
        if not usable(value):
            return None
        return ".".join(map(str, self._permute("ip", value, 1 << 32, usable).to_bytes(4, "big")))

    def date(self, text: str) -> str | None:
        mark = re.search("[-/.]", text)[0]
        parts = text.split(mark)
        year_first = len(parts[0]) == 4
        day_first = not year_first and (mark == "." or int(parts[0]) > 12)
        order = (0, 1, 2) if year_first else (2, 1, 0) if day_first else (2, 0, 1)
        try:
            value = date(*(int(parts[k]) for k in order)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= value <= LAST_DAY:
            return None
        # a day-first date is told by its day or its dots, and must be so afterwards
        fits = (lambda x: date.fromordinal(FIRST_DAY + x).day > 12) if day_first and mark != "." else lambda x: True
        new = date.fromordinal(FIRST_DAY + self._permute("date", value - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, fits))
        padded = all(len(p) >= 2 for p in parts)
        out = [""] * 3
        for k, v in zip(order, (new.year, new.month, new.day)):
            out[k] = f"{v:02d}" if padded else str(v)
        return mark.join(out)

    def _digits(self, label: str, text: str, lead: int, fits) -> str | None:
        """Permute the digits after the first ``lead`` ones, if they are valid."""
        own = [c for c in text if c.isdigit()]
        body = "".join(own[lead:])
        valid = lambda x: fits(f"{x:0{len(body)}d}")
        if not valid(int(body)):
            return None
        return _refill(text, "".join(own[:lead]) + f"{self._permute(f'{label}/{len(body)}', int(body), 10 ** len(body), valid):0{len(body)}d}")

    def ssn(self, text: str) -> str | None:
        return self._digits("ssn", text, 0, lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000")

    def phone(self, text: str) -> str | None:
        usual = lambda d: d[0] > "1" and d[3] > "1"
        new = self._digits("phone", text, sum(c.isdigit() for c in text) - 10, usual)
        if new is None and text[0] == "+":  # marked as a number, so unusual ones are permuted among themselves
            return self._digits("unusual", text, 1, lambda d: not usual(d))
        return new

    def world(self, text: str) -> str | None:
        return self._digits("world", text, 2, lambda d: True)

    def card(self, text: str) -> str | None:
        own = "".join(c for c in text if c.isdigit())
        if luhn(own) or not own.strip("0"):
            return None
        inner = f"{self._permute(f'card/{len(own)}', int(own[1:-1]), 10 ** (len(own) - 2)):0{len(own) - 2}d}"
        return _refill(text, own[0] + inner + str(-luhn(own[0] + inner + "0") % 10))

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with every valid value replaced, and how many of each kind."""
        counts: dict[str, int] = {}
        if not HINT.search(text):
            return text, counts

        out, done, at = [], 0, 0
        while (m := PATTERN.search(text, at)) is not None:
            kind, found, new = self._first(text, m)
            if new is None:
                at = TOKEN.match(text, m.start()).end()  # a valid value may begin inside what has failed
                continue
            counts[kind] = counts.get(kind, 0) + 1
            out += [text[done : m.start()], new]
            done = at = m.start() + len(found)
        return "".join([*out, text[done:]]), counts

    def _first(self, text: str, m: re.Match) -> tuple[str, str, str | None]:
        """Kind, value and pseudonym of the first candidate at the start of a match that passes its check; later kinds are tried too."""
        first = next(k for k, kind in enumerate(KINDS) if m[kind] is not None)
        for kind in KINDS[first:]:
            match = m if kind == KINDS[first] else EACH[kind].match(text, m.start())
            for found in _candidates(kind, match[0]) if match is not None else ():
                if (new := getattr(self, kind)(found)) is not None:
                    return kind, found, new
        return "", "", None


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", *, others: tuple[str, ...] = ()) -> DataFrame:
    """Replace personal data and secrets in whole texts by pseudonyms of the same format, without a shuffle.

    Cards pass the Luhn check before and after, account numbers the modulo-97 check, dates are days of 1900 to 2099, address
    and phone numbers keep valid parts; what fails its check stays, after cards have been tried at every token's end from 19 to 13
    digits and account numbers at their country's length, and the scan goes on behind the first token. A number after +1 that is no usual one is
    permuted among such. Each kind is a permutation keyed by ``key``, so equal
    values get equal pseudonyms in all documents, different ones different pseudonyms, and the key's holder can go back
    (``Pseudonyms(key, inverse=True)``; only dates written without leading zeros may come back with them, and a card
    right before more digits may be read with them if both pass the check). A mail address keeps its domain, a card its first digit, a phone number its
    country code. Day-first dates with slashes or hyphens are linked among themselves.

    Returns ``doc_id``, ``others`` as they are, ``text`` and ``kinds`` (a count for each kind found), one row per row of
    ``docs``; null stays null, other columns are not read, an empty table gives an empty result.
    """

    def make(texts: list[str | None]):
        names = Pseudonyms(key)
        made = [names.replace(t) if t is not None else (None, {}) for t in texts]
        return [t for t, _ in made], [list(c.items()) for _, c in made]

    base = docs.select(F.col(id_col).alias("doc_id"), *others, F.col(text_col).alias("_text"))
    out = map_texts(base, "_text", make, "text string, kinds map<string,bigint>")
    return out.select("doc_id", *(c for c in others), "text", "kinds")
