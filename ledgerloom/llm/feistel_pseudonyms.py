"""Personal data under format-preserving pseudonyms.

A number or date that passes its own check (Luhn digit, IBAN remainder, octets, calendar) is mapped to another that passes it too, by a
keyed Feistel permutation of all values of that format. The map depends on key, kind and value alone, so equal values
get equal pseudonyms in all documents, different values different ones, and the key holder can undo it. No
table of values is kept, and nothing is shuffled.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.textbytes import id_and_text

ROUNDS = 8
DEMO_KEY = b"replace this key"
KINDS = ("secret", "email", "iban", "ip", "date", "ssn", "phone", "card")
_MAYBE = re.compile(r"[0-9@]")
_FIND = re.compile(
    r"(?P<secret>(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z]))"
    r"|(?P<email>(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9]))"
    r"|(?P<iban>(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z]))"
    r"|(?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]))"
    r"|(?P<date>(?<![0-9])(?:[0-9]{4}(?P<s>[-/.])[0-9]{1,2}(?P=s)[0-9]{1,2}|[0-9]{1,2}(?P<t>[-/.])[0-9]{1,2}(?P=t)[0-9]{4})(?![0-9]))"
    r"|(?P<ssn>(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]))"
    r"|(?P<phone>(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9]))"
    r"|(?P<card>(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))"
)


class Permutation:
    """Keyed permutation of ``range(size)``: a balanced Feistel network, walked until it lands inside."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
        self.mask = (1 << self.half) - 1
        self.seed = hashlib.blake2b(f"{kind}/{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, half: int) -> int:
        data = bytes([i]) + half.to_bytes((self.half + 7) // 8, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.seed, digest_size=(self.half + 7) // 8).digest(), "big") & self.mask

    def _network(self, value: int, rounds: Iterator[int]) -> int:
        left, right = value >> self.half, value & self.mask
        for i in rounds:
            left, right = right, left ^ self._round(i, right)
        return right << self.half | left

    def forth(self, value: int) -> int:
        while True:
            value = self._network(value, range(ROUNDS))
            if value < self.size:
                return value

    def back(self, value: int) -> int:
        while True:
            value = self._network(value, reversed(range(ROUNDS)))
            if value < self.size:
                return value


def luhn_digit(digits: str) -> str:
    """The check digit to follow ``digits``."""
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _ssn_valid(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


EARLY, LATE = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Pseudonyms:
    """Maps a found value to its pseudonym, or back; the same object serves one task."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back
        self.permutations: dict[tuple[str, int], Permutation] = {}
        self.seen: dict[tuple[str, str], tuple[str, str] | None] = {}

    def _permuted(self, kind: str, size: int, value: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        permutation = self.permutations.setdefault((kind, size), None) or Permutation(self.key, kind, size)
        self.permutations[kind, size] = permutation
        step = permutation.back if self.back else permutation.forth
        value = step(value)
        while not valid(value):
            value = step(value)
        return value

    def _digits(self, kind: str, digits: str, valid: Callable[[str], bool] = lambda _: True) -> str:
        n = len(digits)
        return str(self._permuted(kind, 10**n, int(digits), lambda v: valid(str(v).zfill(n)))).zfill(n)

    def _characters(self, kind: str, text: str) -> str:
        """Letters to letters of their case, digits to digits; all other characters stay."""
        sets = [s for c in text for s in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c in s]
        value, size = 0, 1
        letters = iter(sets)
        for c in text:
            if c.isascii() and c.isalnum():
                own = next(letters)
                value, size = value * len(own) + own.index(c), size * len(own)
        if size == 1:
            return text
        value = self._permuted(f"{kind}:{''.join(s[0] for s in sets)}", size, value)
        chosen = []
        for own in reversed(sets):
            value, at = divmod(value, len(own))
            chosen.append(own[at])
        return "".join(chosen.pop() if c.isascii() and c.isalnum() else c for c in text)

    def replaced(self, kind: str, text: str) -> tuple[str, str] | None:
        """Kind and pseudonym of a candidate, or nothing if it does not pass its check."""
        found = (kind, text)
        if found not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[found] = getattr(self, f"_{kind}")(text)
        return self.seen[found]

    def _secret(self, text: str) -> tuple[str, str]:
        upper = text == text.upper()
        value = self._permuted("secret", 16 ** len(text), int(text, 16))
        out = f"{value:x}".zfill(len(text))
        return "secret", out.upper() if upper else out

    def _email(self, text: str) -> tuple[str, str]:
        name, _, host = text.rpartition("@")
        return "email", f"{self._characters('email', name)}@{host}"

    def _iban(self, text: str) -> tuple[str, str] | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_remainder(plain) != 1:
            return None
        body = self._characters(f"iban{plain[:2]}", plain[4:])
        check = 98 - iban_remainder(f"{plain[:2]}00{body}")
        return "iban", _like(text, f"{plain[:2]}{check:02d}{body}")

    def _ip(self, text: str) -> tuple[str, str] | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255:
            return None
        value = self._permuted("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return "ip", ".".join(str(b) for b in value.to_bytes(4, "big"))

    def _date(self, text: str) -> tuple[str, str] | None:
        a, mark, b, c = re.fullmatch(r"([0-9]+)([-/.])([0-9]+)[-/.]([0-9]+)", text).groups()
        for order in (("ymd",) if len(a) == 4 else ("dmy", "mdy")):
            named = dict(zip(order, (a, b, c)))
            try:
                day = datetime.date(int(named["y"]), int(named["m"]), int(named["d"])).toordinal()
            except ValueError:
                continue
            usual = EARLY <= day <= LATE
            first, last = (EARLY, LATE) if usual else (1, datetime.date.max.toordinal())
            own = datetime.date.fromordinal(day)

            def valid(value: int, own: datetime.date = own, order: str = order, usual: bool = usual, first: int = first) -> bool:
                """Dates that are read in the same order, and written with as many digits: among them the permutation is undone."""
                other = datetime.date.fromordinal(first + value)
                alike = (other.day < 10, other.month < 10) == (own.day < 10, own.month < 10)
                return alike and (order != "mdy" or other.day > 12) and (usual or not EARLY <= value + 1 <= LATE)

            new = datetime.date.fromordinal(first + self._permuted("date", last - first + 1, day - first, valid))
            values = {"y": f"{new.year:04d}", "m": str(new.month), "d": str(new.day)}
            return "date", mark.join(values[k].zfill(len(named[k])) for k in order)
        return None

    def _ssn(self, text: str) -> tuple[str, str] | None:
        digits = text.replace("-", "")
        if not _ssn_valid(digits):
            return None
        return "ssn", _like(text, self._digits("ssn", digits, _ssn_valid))

    def _phone(self, text: str) -> tuple[str, str] | None:
        prefix = re.match(r"\+[0-9]{1,3}?(?=[ .(-])|\+[0-9]{1,2}|", text).group()
        digits = re.sub(r"[^0-9]", "", text[len(prefix) :])
        if not 7 <= len(digits) <= 14:
            return None
        return "phone", prefix + _like(text[len(prefix) :], self._digits("phone", digits))

    def _card(self, text: str) -> tuple[str, str] | None:
        digits = re.sub(r"[^0-9]", "", text)
        if luhn_digit(digits[:-1]) != digits[-1]:
            return None
        body = digits[0] + self._digits("card", digits[1:-1])
        return "card", _like(text, body + luhn_digit(body))


def _like(pattern: str, characters: str) -> str:
    """``characters`` with the separators of ``pattern``."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in pattern)


def pseudonymised(text: str, names: Pseudonyms) -> tuple[str, dict[str, int]]:
    """The text with every value replaced, and how many of each kind there were."""
    counts = dict.fromkeys(KINDS, 0)
    if not _MAYBE.search(text):
        return text, counts

    out, at, copied = [], 0, 0
    while match := _FIND.search(text, at):
        kind, start = match.lastgroup if match.lastgroup in KINDS else _kind(match), match.start()
        at = match.end()
        for end in _ends(kind, match):
            new = names.replaced(kind, text[start:end])
            if new is not None:
                counts[new[0]] += 1
                out += [text[copied:start], new[1]]
                at = copied = end
                break
        else:
            # a value may begin at a later group of a run that holds none from its start
            if kind in GROUPED and (mark := _MARK.search(match.group())):
                at = start + mark.end()
    return "".join([*out, text[copied:]]), counts


# runs of groups: what follows the value with a space or a dash may look like a part of it
GROUPED = ("iban", "card")
_MARK = re.compile(r"[ -]")


def _ends(kind: str, match: re.Match) -> list[int]:
    """Where a value of the matched text may end: at its end, or before any of its marks, longest first."""
    shorter = [match.start() + m.start() for m in _MARK.finditer(match.group())] if kind in GROUPED else []
    return [match.end(), *(e for e in reversed(shorter) if sum(c.isalnum() for c in match.string[match.start() : e]) >= 13)]


def _kind(match: re.Match) -> str:
    return next(k for k in KINDS if k in match.re.groupindex and match.group(k) is not None)


def with_pseudonyms(documents: DataFrame, key: bytes = DEMO_KEY, back: bool = False) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, text`` under pseudonyms, ``n_found`` and ``found``, a count of each kind.

    What fails its check, as a card number without a right last digit, is no such value and stays. A date keeps its
    format, a mail address its host, a phone number its country code, a card its first digit. ``back``
    undoes a run with the same key for all values that keep their format, which all but dates with
    unpadded days do; where digits follow a card as a further group, the longer run may pass the check by chance, and is then taken for the card. Null texts are empty, null ids stay null, repeated rows are treated alike; an empty table
    gives an empty result; other columns are ignored. Whole texts are read, whatever their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, back)
        for batch in batches:
            done = [pseudonymised(t or "", names) for t in batch.column(1).to_pylist()]
            counts = [pa.array([c[k] for _, c in done], pa.int32()) for k in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in done], pa.string()), *counts], ["doc_id", "text", *KINDS]
            )

    flat = id_and_text(documents).mapInArrow(run, f"doc_id long, text string, {', '.join(f'{k} int' for k in KINDS)}")
    total = sum((F.col(k) for k in KINDS), F.lit(0)).alias("n_found")
    return flat.select("doc_id", "text", total, F.struct(*KINDS).alias("found"))
