"""Personal data: format-preserving Feistel pseudonyms.

Card numbers, account numbers, phone numbers, social security numbers, IP addresses and dates are found by pattern, validated (check digits,
calendar, ranges), and replaced by a keyed permutation of the values of the same format: as long, punctuated alike and again valid.
Addresses of e-mail keep their domain, and access keys and passwords their alphabet.  The permutation depends on key, kind and
length only, so equal values get equal pseudonyms in all documents, whatever separators they are written with, and two values never share one.

Edge cases: a NULL text stays NULL with nothing found; an empty text stays empty.  Rows are treated one by one, so repeated
rows give equal results; other columns are passed on, an input column named n_replaced or kinds is replaced.  Of a match that fails validation
the shorter ends are tried, then the search goes on one token later, so values beside other digits or capitals are found; the rest is left alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyward.llm.text import ship

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "password": r"(?i:password|passwd|secret|token|api_?key)[ ]?[=:][ ]?[\"']?[A-Za-z0-9_-]{12,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ ]?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}|\+[0-9]{8,15}"
    r"|\([0-9]{3}\)[ ]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4})(?![0-9])",
}
FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PATTERNS.items()))
KINDS = {k: re.compile(p) for k, p in PATTERNS.items()}
RETRIED = ("iban", "card", "phone")  # kinds of no fixed length, whose match may have taken neighbours in
TOKEN_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
#: Inside a longer match a card has groups of four digits and more, but for the last; else nearly every row of small numbers would hold one.
CARD_GROUPS = re.compile(r"(?:[0-9]{4,}[ -])*[0-9]+")
LEAST_IBAN = 15  # the shortest of any country
HINT = re.compile(r"[0-9@]|AKIA|ASIA|[=:][ ]?[\"']?[A-Za-z0-9_-]{12}")


class Permutation:
    """A keyed permutation of 0..size-1: an alternating Feistel network over two digits, walked on until it is back in range."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size, self.salt = size, f"{kind}:{size}".encode()
        self.key = key
        self.a = isqrt(size - 1) + 1
        self.b = -(-size // self.a)

    def _mix(self, turn: int, half: int) -> int:
        said = b"%s:%d:%d" % (self.salt, turn, half)
        return int.from_bytes(blake2b(said, key=self.key, digest_size=24).digest(), "big")

    def once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for turn in range(ROUNDS):
            if turn % 2:
                right = (right + self._mix(turn, left)) % self.b
            else:
                left = (left + self._mix(turn, right)) % self.a
        return left * self.b + right

    def of(self, x: int, valid: Callable[[int], bool] = lambda y: True) -> int:
        """Walk from a valid value to the next valid one; that is a permutation of the valid values."""
        while True:
            x = self.once(x)
            if x < self.size and valid(x):
                return x


def luhn(payload: str) -> int:
    """Check digit of the digits before it."""
    total = 0
    for place, c in enumerate(reversed(payload)):
        d = int(c) * (2 - place % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def iban_check(country: str, account: str) -> int:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return 98 - int(number) % 97


class Pseudonyms:
    """Pseudonyms under one key."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()
        self.permutations: dict[tuple[str, int], Permutation] = {}

    def permutation(self, kind: str, size: int) -> Permutation:
        known = self.permutations.get((kind, size))
        if known is None:
            known = self.permutations[kind, size] = Permutation(self.key, kind, size)
        return known

    def digits(self, kind: str, text: str, valid: Callable[[str], bool] = lambda s: True) -> str:
        n = len(text)
        return f"{self.permutation(kind, 10**n).of(int(text), lambda y: valid(f'{y:0{n}d}')):0{n}d}"

    def letters(self, kind: str, text: str) -> str:
        """Permute the text among those with the same classes of characters at the same places."""
        classes = [next((c for c in (DIGITS, LOWER, UPPER) if x in c), None) for x in text]
        size, value = 1, 0
        for x, c in zip(text, classes):
            if c:
                size, value = size * len(c), value * len(c) + c.index(x)
        if size == 1:
            return text
        shape = "".join("-" if c is None else c[0] for c in classes)
        value, out = self.permutation(f"{kind}/{shape}", size).of(value), []
        for x, c in zip(reversed(text), reversed(classes)):
            if c:
                value, place = divmod(value, len(c))
                x = c[place]
            out.append(x)
        return "".join(reversed(out))

    # One method for each kind: the pseudonym, or None if the text is no valid value of its kind.

    def email(self, text: str) -> str:
        name, domain = text.split("@")
        return f"{self.letters('email', name)}@{domain}"

    def access_key(self, text: str) -> str:
        value = 0
        for c in text[4:]:
            value = value * 36 + int(c, 36)
        value, out = self.permutation("access_key", 36**16).of(value), ""
        for _ in range(16):
            value, d = divmod(value, 36)
            out = (DIGITS + UPPER)[d] + out
        return text[:4] + out

    def password(self, text: str) -> str | None:
        at = re.search(r"[A-Za-z0-9_-]{12,}$", text).start()
        secret = text[at:]
        if not re.search("[0-9]", secret):
            return None  # an ordinary word
        hexadecimal = re.fullmatch("[0-9a-f]+", secret)
        if hexadecimal:
            return f"{text[:at]}{self.permutation('hex', 16 ** len(secret)).of(int(secret, 16)):0{len(secret)}x}"
        return text[:at] + self.letters("password", secret)

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        country, account = plain[:2], plain[4:]
        if iban_check(country, account) != int(plain[2:4]):
            return None
        account = self.letters(f"iban{country}", account)
        return refill(text, f"{country}{iban_check(country, account):02d}{account}", str.isalnum)

    def date(self, text: str) -> str | None:
        iso = text[4] == "-"
        a, b, c = (int(x) for x in re.split("[-./]", text))
        # Day first with dots, month first with slashes; where only the other order is a date, that one.
        orders = [(a, b, c)] if iso else [(c, b, a), (c, a, b)] if text[2] == "." else [(c, a, b), (c, b, a)]
        for k, (y, m, d) in enumerate(orders):
            try:
                day = date(y, m, d)
            except ValueError:
                continue
            if FIRST_DAY <= day <= LAST_DAY:
                span = (LAST_DAY - FIRST_DAY).days + 1
                # Only a day after the twelfth is read in the second order, so the walk goes on to one: a string has one reading.
                reads_back = (lambda n: (FIRST_DAY + timedelta(n)).day > 12) if k else (lambda n: True)
                new = FIRST_DAY + timedelta(self.permutation("date", span).of((day - FIRST_DAY).days, reads_back))
                day_first = (text[2] == ".") == (k == 0)
                parts = (new.year, new.month, new.day) if iso else (new.day, new.month, new.year) if day_first else (new.month, new.day, new.year)
                return refill(text, "".join(f"{x:02d}" for x in parts), str.isdigit)
        return None

    def ip(self, text: str) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255:
            return None
        value = self.permutation("ip", 1 << 32).of(int.from_bytes(bytes(parts), "big"))
        return ".".join(str(x) for x in value.to_bytes(4, "big"))

    def ssn(self, text: str) -> str | None:
        def valid(s: str) -> bool:
            return s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"

        plain = text.replace("-", "")
        return refill(text, self.digits("ssn", plain, valid), str.isdigit) if valid(plain) else None

    def card(self, text: str) -> str | None:
        plain = re.sub("[ -]", "", text)
        if plain[0] == "0" or luhn(plain[:-1]) != int(plain[-1]):
            return None
        payload = plain[0] + self.digits(f"card{plain[0]}", plain[1:-1])
        return refill(text, f"{payload}{luhn(payload)}", str.isdigit)

    def phone(self, text: str) -> str | None:
        plain = re.sub("[^0-9]", "", text)
        if not 7 <= len(plain) <= 15:
            return None
        kept = ""
        if text[0] == "+":  # the country's code stays
            code = re.match(r"\+([0-9]{1,3})(?=[ .(-])", text)
            kept = code[1] if code else plain[:1]
        rest = plain[len(kept) :]
        # Ten digits are of the plan whose area and exchange never start with 0 or 1.
        local = (lambda s: s[0] > "1" and s[3] > "1") if len(rest) == 10 and kept in ("", "1") else (lambda s: True)
        if not local(rest):
            local = lambda s: not (s[0] > "1" and s[3] > "1")
        return refill(text, kept + self.digits(f"phone{kept}", rest, local), str.isdigit)

    def shorter(self, kind: str, text: str, start: int) -> tuple[str, int] | None:
        """The pseudonym and end of the longest valid value of the kind at ``start`` that ends with a token inside the pattern's match."""
        found = KINDS[kind].match(text, start)
        ends = [e.start() for e in TOKEN_END.finditer(text, start, found.end() + 1) if e.start() <= found.end()] if found else []
        for end in reversed(ends):
            if not KINDS[kind].fullmatch(text, start, end) or kind == "card" and not CARD_GROUPS.fullmatch(text, start, end):
                continue
            if kind == "iban" and end - start - text.count(" ", start, end) < LEAST_IBAN or kind == "phone" and self.cuts_card(text, start, end):
                continue
            new = getattr(self, kind)(text[start:end])
            if new is not None:
                return new, end
        return None

    def cuts_card(self, text: str, start: int, end: int) -> bool:
        """Does a valid card begin inside the span and end behind it?"""
        if not re.compile("[ -]?[0-9]").match(text, end):
            return False
        begins = (e.end() for e in re.compile(r"[^0-9]+(?=[0-9])").finditer(text, start + 1, end))
        cards = (self.shorter("card", text, at) for at in begins)
        return any(card is not None and card[1] > end for card in cards)

    def value(self, text: str, found: re.Match, inside: bool) -> tuple[str, str, int] | None:
        """Kind, pseudonym and end of the value at the start of the match: the whole match, or as much of it as is valid.

        ``inside`` tells that the match begins in one that failed.
        """
        kinds, start = list(PATTERNS)[list(PATTERNS).index(found.lastgroup) :], found.start()
        # What is no valid value of the first kind that fits may still be one of a later kind.
        for kind in kinds:
            if kind == found.lastgroup or KINDS[kind].fullmatch(found[0]):
                if kind == "card" and inside and not CARD_GROUPS.fullmatch(found[0]):
                    continue
                if kind == "phone" and self.cuts_card(text, start, found.end()) and (less := self.shorter(kind, text, start)):
                    return kind, *less
                new = getattr(self, kind)(found[0])
                if new is not None:
                    return kind, new, found.end()
        for kind in kinds:
            if kind in RETRIED and (less := self.shorter(kind, text, start)):
                return kind, *less
        return None

    def replace(self, text: str) -> tuple[str, list[str]]:
        """The text with all valid values replaced, and the kinds found, one per value."""
        kinds: list[str] = []
        out, done, failed, found = [], 0, 0, FIND.search(text)
        while found:
            value = self.value(text, found, found.start() < failed)
            if value:
                kind, new, at = value
                kinds.append(kind)
                out += text[done : found.start()], new
                done = at
            else:  # go on one token later: a valid value may begin inside
                at, failed = TOKEN_END.search(text, found.start() + 1).start(), max(failed, found.end())
            found = FIND.search(text, at)
        return "".join([*out, text[done:]]), kinds


def refill(text: str, new: str, slot: Callable[[str], bool]) -> str:
    """Put the characters of ``new`` into the slots of ``text``, keeping its punctuation."""
    it = iter(new)
    return "".join(next(it) if slot(c) else c for c in text)


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """The input with ``text`` rewritten, and n_replaced and kinds (sorted, distinct, comma-joined) added."""
    ship(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("n_replaced", "kinds")]
    schema = T.StructType([*kept, T.StructField("n_replaced", T.LongType()), T.StructField("kinds", T.StringType())])
    names = [f.name for f in schema.fields]
    at = [f.name for f in kept].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                done = [
                    (t, []) if t is None or not HINT.search(t) else pseudonyms.replace(t) for t in part.column(at).to_pylist()
                ]
                columns = part.columns
                columns[at] = pa.array([t for t, _ in done], pa.string())
                counts = pa.array([len(k) for _, k in done], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, counts, pa.array([",".join(sorted(set(k))) for _, k in done], pa.string())], names)

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)
