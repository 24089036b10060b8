"""Private data replaced by keyed, type-consistent surrogates.

1. Detectors find entities in whole texts (:func:`find_entities`): e-mail and IP addresses, phone, card, bank and
   social-security numbers, access keys, passwords and tokens, and people known by a given name, a title or the place where their names stand.
2. Each distinct entity of the corpus is proposed a surrogate, an HMAC of (type, entity, attempt)
   that keeps the type's format: letters stay letters of the same case and script, digits stay digits, separators, country codes,
   card networks, check digits and address classes stay; given names stay within gender and script.
3. Collision checks over all distinct entities: two entities with the same surrogate, or a
   surrogate that is itself an entity of the corpus, make all but one try again until none is left.
   So distinct entities stay distinct, and one entity has one surrogate everywhere. A private address range that the corpus
   fills too far for that is turned as a whole by a keyed permutation.
4. Texts are rewritten in parallel. Surrogates are recomputed from the key; only the attempt numbers
   of the few entities that collided are joined to the documents that hold them.

Entities never reach the driver, only counts do.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import give_back, materialize, may_hold, text_or_empty, tidy

#: A caller's own secret; the default only serves tests and the registered query.
DEFAULT_KEY = "surrogate-key"
#: From this attempt on a surrogate is one character longer for each attempt, for formats with few values.
LENGTHEN = 6
MAX_ROUNDS = 40
#: In place of an attempt: the address is turned within its private range (:func:`turned`), which cannot collide.
TURNED = -1
#: A private range is turned as a whole once its distinct addresses are more than this share of it.
CROWDED = 0.25

# Given names by script and gender, and titles by gender.
GIVEN = {
    ("latin", "f"): "Alice Amelia Anna Barbara Camille Carmen Caroline Catherine Charlotte Clara Claudia Elena Elizabeth Emily Emma Eva "
                    "Hannah Heidi Helen Ingrid Isabella Jane Jennifer Jessica Julia Karin Laura Linda Lucia Margaret Maria Marie Martha "
                    "Mary Monika Nicole Olivia Patricia Petra Rachel Rosa Sabine Sarah Sofia Sophie Susan Teresa Ursula Victoria",
    ("latin", "m"): "Albert Alexander Andreas Antonio Arthur Benjamin Carlos Charles Christian Daniel David Diego Edward Eric Fernando "
                    "Francois Frank Frederick George Hans Henry Ignacio Jacques James Javier Jean John Jorge Joseph Juan Jürgen Karl "
                    "Klaus Louis Luis Manuel Mark Martin Matthew Michael Miguel Patrick Paul Peter Philippe Richard Robert Stefan "
                    "Thomas Walter William Wolfgang",
    ("cyrillic", "f"): "Александра Анастасия Анна Валентина Вера Галина Дарья Екатерина Елена Ирина Ксения Лариса Людмила Мария Марина "
                       "Надежда Наталья Ольга Светлана Татьяна Юлия",
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Василий Виктор Владимир Дмитрий Евгений Иван Игорь Максим Михаил Никита Николай "
                       "Олег Павел Пётр Роман Сергей Юрий",
    ("greek", "f"): "Αικατερίνη Άννα Βασιλική Γεωργία Ελένη Ευαγγελία Ιωάννα Κωνσταντίνα Μαρία Σοφία Χριστίνα",
    ("greek", "m"): "Αθανάσιος Αλέξανδρος Αντώνιος Βασίλειος Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Μιχαήλ Νικόλαος Παναγιώτης",
}
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra Lady", "m": "Mr Herr Monsieur Señor Sr Sir Lord", "": "Dr Prof Professor"}
LETTERS = {"latin": ("bcdfghklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрстф", "аеиоу"), "greek": ("βγδζκλμνπρστφ", "αειου")}
CAPITALS = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "".join(map(chr, range(0x410, 0x430))), "greek": "".join(chr(c) for c in range(0x391, 0x3AA) if c != 0x3A2)}
KEEP_DOMAINS = ("example.com", "example.org", "example.net")

NAMES = {key: names.split() for key, names in GIVEN.items()}
GENDER = {name: key for key, names in NAMES.items() for name in names}
TITLE = {t: g for g, titles in TITLES.items() for t in titles.split()}
# Words that end a run of capitalised words, or follow a lone word that is a verb or noun there; particles within names;
# field names, salutations and closings that stand before names.
STOP = frozenset("The A An In On At He She It They We I You This That These Those And But Or If When Then So As For From To My His Her Our Their "
                 "There Here Yesterday Today Tomorrow Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June "
                 "July August September October November December Sir Madam All Team Customer Customers Friend Friends Everyone Colleagues".split())
PLAIN_AFTER = frozenset("the a an this that these those your my our his her its their all each every it them".split())
PARTICLE = "(?:van|von|der|den|de|del|della|di|da|dos|das|du|la|le|bin|al|el|zu|ter|y) "
FIELD = "name|full name|author|contact|from|to|cc|attn|signed|signed by|sender|recipient|patient|customer|employee|nombre|nom|имя"
SALUTATION = "Dear|Hi|Hello|Hey|Liebe|Lieber|Cher|Chère|Estimado|Estimada|Querido|Querida|Дорогой|Дорогая|Уважаемый|Уважаемая|Αγαπητέ|Αγαπητή"
CLOSING = ("best regards|kind regards|regards|sincerely|yours sincerely|yours truly|best wishes|mit freundlichen grüßen|viele grüße|"
           "cordialement|saludos|atentamente|с уважением")

CAP = r"[^\W\d_a-zа-яёα-ω][^\W\d_]+(?:-[^\W\d_a-zа-яёα-ω][^\W\d_]+)*"
_TITLES = "|".join(sorted(TITLE, key=len, reverse=True))
_NO_TITLE = rf"(?!(?:{_TITLES})(?![\w]))"
#: A further word of a name: capitalised, with particles before it, or an initial; a title begins another name.
PART = rf"(?:{PARTICLE}){{0,3}}{_NO_TITLE}(?:{CAP}|[A-ZА-ЯΑ-Ω]\.)"
RUN = rf"{_NO_TITLE}{CAP}(?: {PART})*"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: One pattern a type, tried from the most specific; an entity is the named group ``v`` or the whole match.
DETECTORS = [
    ("secret", re.compile(r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key))\s*[=:]\s*[\"']?(?P<v>[A-Za-z0-9+/_\-.]{8,}[A-Za-z0-9+/_\-]=*)")),
    ("accesskey", re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b")),
    ("email", re.compile(r"(?<![\w.+%-])[A-Za-z0-9_+%-]+(?:\.[A-Za-z0-9_+%-]+)*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("ip", re.compile(rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)")),
    ("card", re.compile(r"(?<![\w.])(?:3\d{3}[ -]?\d{6}[ -]?\d{5}|(?:[3-6]\d{3}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720))(?:[ -]?\d{4}){2}[ -]?\d{1,7})(?![\w])")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+(?=(?:[ .-]?\d){8})\d{1,3}[ .-]\d(?:[ .-]?\d{2,4}){2,5}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ ]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w])")),
]
#: What a text must hold for a detector to be tried: one of these strings, or for the others a digit.
NEEDS = {"email": ("@",), "secret": ("=", ":"), "accesskey": ("AKIA", "ASIA")}
_GIVEN = "|".join(sorted(GENDER, key=lambda n: (-len(n), n)))
#: A known given name at the start of any word, and what follows it; a title and the name after it; names known by where they stand.
FULL = re.compile(rf"(?<![\w])(?P<names>(?:{_GIVEN})(?: {PART})+)(?![\w])")
TITLED = re.compile(rf"(?<![\w])(?:{_TITLES})\.? (?P<names>{RUN})(?![\w])")
#: Signs of which the text must hold one, capitalised words of which it must hold one, and the pattern.
PLACED = [
    ((":", "="), None, re.compile(rf"(?<![\w])(?i:{FIELD})[ \t]*[:=][ \t]*\"?(?P<names>{RUN})(?=\"?[ \t]*(?:[,;<(\n\"]|$))")),
    ((",", "!"), frozenset(SALUTATION.split("|")), re.compile(rf"(?<![\w])(?:{SALUTATION}) (?P<names>{RUN})(?=[,!])")),
    (("\n",), None, re.compile(rf"(?<![\w])(?i:{CLOSING})[,.!]?[ \t]*\n\s*(?P<names>{RUN})(?=[ \t]*(?:\n|$))")),
    (("<",), None, re.compile(rf"(?<![\w])(?P<names>{RUN})\"? ?<[^<>\s@]+@")),
]
WORD = re.compile(r"[A-ZÀ-ÖØ-ÞΆ-ΫА-ЯЁ]\w+")
CAP_WORD = re.compile(rf"(?<![\w])({CAP})(?![\w])(?=(?: (\w+))?)")
NAME_WORD = re.compile(rf"{PARTICLE}|({CAP}|[A-ZА-ЯΑ-Ω]\.)")


def script_of(word: str) -> str:
    c = ord(next((x for x in word if x.isalpha()), "a"))
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _name_words(text: str, start: int, end: int) -> list[tuple[int, str]]:
    """``(start, word)`` of a run of name words, without particles, up to the first word that is no name."""
    words = []
    for m in NAME_WORD.finditer(text, start, end):
        if m[1] in STOP:
            break
        if m[1]:
            words.append((m.start(1), m[1]))
    return words


def _people(text: str):
    """Name parts as ``(start, end, type, value)``: given names by gender and script, initials and surnames by script.

    A person is known by a given name of the list before at least one more name, by a title, or by its place: after a field's name, a
    salutation or a closing, or before an address in angle brackets. Their names alone elsewhere in the text
    are the same person, unless the word is visibly no name there (``Mark the box``, ``White House``).
    """
    words = set(WORD.findall(text))
    runs = {m.start("names"): m.end("names") for signs, marks, pattern in PLACED
            if any(c in text for c in signs) and (marks is None or not marks.isdisjoint(words)) for m in pattern.finditer(text)}
    titled = {} if TITLE.keys().isdisjoint(words) else {m.start("names"): m.end("names") for m in TITLED.finditer(text)}
    runs.update(titled)
    if not GENDER.keys().isdisjoint(words):
        runs.update((m.start("names"), max(m.end("names"), runs.get(m.start("names"), 0))) for m in FULL.finditer(text))
    given, family, found, alone = {}, {}, [], []
    for start in sorted(runs):
        words = _name_words(text, start, runs[start])
        if len(words) < 2 and start not in titled and not (words and words[0][1] not in TITLE):
            continue
        lead = True  # given names come first
        for i, (at, word) in enumerate(words):
            last = i == len(words) - 1
            if word.endswith("."):
                found.append((at, at + 1, f"initial:{script_of(word)}", word[0]))
                continue
            if lead and word in GENDER and (not last or (len(words) == 1 and start not in titled)):
                kind = given.setdefault(word, "given:{}:{}".format(*GENDER[word]))
            elif len(words) == 1 and word in GENDER:
                alone.append((at, word))  # a title and a given name alone
                continue
            else:
                lead = False
                kind = family.setdefault(word, f"surname:{script_of(word)}")
            found.append((at, at + len(word), kind, word))
    for at, word in alone:  # the person that the text names in full, or else a surname
        kind = given[word] if word in given and word not in family else family.setdefault(word, f"surname:{script_of(word)}")
        found.append((at, at + len(word), kind, word))
    yield from found
    names = {**given, **family}
    if not names:
        return
    ends = {at + len(word) for at, _, _, word in found}
    for m in CAP_WORD.finditer(text):
        after, at = m[2], m.start(1)
        if after is not None:
            other = after[0].isupper() and len(after) > 1 and after not in names and after not in STOP
            if m[1] in names and ((other and m.end(1) not in ends) or (after in PLAIN_AFTER and m[1] in given and m[1] not in family)):
                continue
        for word in (m[1],) if m[1] in names else m[1].split("-"):
            if word in names:
                yield at, at + len(word), names[word], word
            at += len(word) + 1


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    if kind == "email":
        return value.lower()
    if kind in ("card", "iban", "phone", "ssn"):
        return re.sub(r"[^A-Za-z0-9+]", "", value)
    return value


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, value)`` of a text's entities, in order and without overlaps; the earlier detector wins."""
    found: list[tuple[int, int, str, str]] = []
    digit = any(c in text for c in "0123456789")
    for kind, pattern in DETECTORS:
        if not any(sign in text for sign in NEEDS[kind]) if kind in NEEDS else not digit:
            continue
        for m in pattern.finditer(text):
            if kind == "card" and not _passes_luhn(canonical(kind, m[0])):
                continue
            group = "v" if "v" in pattern.groupindex else 0
            found.append((m.start(group), m.end(group), kind, m[group]))
    found += _people(text)
    if len(found) < 2:
        return found
    used, taken = bytearray(len(text)), []  # a byte for each character that belongs to an entity
    for entity in found:  # detectors' order is priority
        a, b = entity[:2]
        if used.find(1, a, b) < 0:
            used[a:b] = b"\x01" * (b - a)
            taken.append(entity)
    return sorted(taken)


class Stream:
    """Numbers drawn from HMAC-SHA256 of (type, entity, attempt)."""

    def __init__(self, key: str, kind: str, value: str, attempt: int):
        self.key = key.encode()
        self.seed = f"{kind}\x1f{value}\x1f{attempt}".encode()
        self.left, self.block = b"", 0

    def below(self, n: int) -> int:
        """A number below n (n up to 2**16, bias under 2**-16)."""
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        drawn, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return drawn % n

    def like(self, value: str, hexadecimal: bool = False) -> str:
        """The same shape: digits for digits, letters for letters of the same case."""
        out = []
        for c in value:
            if hexadecimal and c in "0123456789abcdef":
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def _luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _passes_luhn(digits: str) -> bool:
    return _luhn_digit(digits[:-1]) == digits[-1]


def _iban_checked(country: str, rest: str) -> str:
    digits = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{country}{98 - int(digits) % 97:02d}{rest}"


def private_range(value: str) -> tuple[str, int] | None:
    """The wholly private range that an address's surrogates stay in: its fixed octets and the number of its free bits."""
    if re.search(r"(^|\.)0\d", value):
        return None
    a, b = map(int, value.split(".")[:2])
    if a == 10:
        return "10.", 24
    if a in (0, 127) or a >= 240 or (a == 172 and 16 <= b < 32) or (a == 198 and b in (18, 19)) or (a, b) in ((169, 254), (192, 168)):
        return f"{a}.{b}.", 16
    return None


def turned(key: str, value: str) -> str:
    """A private address moved one place on in the keyed order of its whole range: a permutation without fixed points.

    The order is a Feistel network over the free bits, so it needs no list of the range.
    """
    prefix, bits = private_range(value)
    half, low = bits // 2, (1 << bits // 2) - 1

    def mixed(step: int, part: int) -> int:
        drawn = hmac.new(key.encode(), f"ip\x1f{prefix}\x1f{step}\x1f{part}".encode(), hashlib.sha256).digest()
        return int.from_bytes(drawn[:4], "big") & low

    number = int(ipaddress.IPv4Address(value)) & ((1 << bits) - 1)
    a, b = number >> half, number & low
    for step in range(6):
        a, b = b, a ^ mixed(step, b)
    place = ((a << half | b) + 1) & ((1 << bits) - 1)
    a, b = place >> half, place & low
    for step in reversed(range(6)):
        a, b = b ^ mixed(step, a), a
    number = a << half | b
    return prefix + ".".join(str(number >> shift & 255) for shift in range(bits - 8, -1, -8))


def surrogate(key: str, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical entity: same type and format, and the same for the same arguments."""
    s = Stream(key, kind, value, attempt)
    extra = max(0, attempt - LENGTHEN + 1)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        keep = next((d for d in KEEP_DOMAINS if domain == d or domain.endswith("." + d)), domain.rpartition(".")[2])
        owned = Stream(key, "domain", domain, 0)  # people of one domain stay together
        host = owned.like(domain[:len(domain) - len(keep)])
        return s.like(local) + s.like("a" * extra) + "@" + host + keep
    if kind == "ip":
        if attempt == TURNED:
            return turned(key, value)
        old = ipaddress.ip_address(value) if not re.search(r"(^|\.)0\d", value) else None
        if old is not None and old.is_private:
            fixed = next((n for p, n in (("10.", 1), ("192.168.", 2)) if value.startswith(p)), 2)
            return ".".join(value.split(".")[:fixed] + [str(1 + s.below(254)) for _ in range(4 - fixed)])
        while True:
            new = ".".join(str(1 + s.below(254)) for _ in range(4))
            if ipaddress.ip_address(new).is_global:
                return new
    if kind == "card":
        body = f"{2221 + s.below(500)}{s.like(value[4:-1])}" if value[0] == "2" else value[0] + s.like(value[1:-1])
        return body + (_luhn_digit(body) if _passes_luhn(value) else s.like("0"))
    if kind == "iban":
        return _iban_checked(value[:2], s.like(value[4:]))
    if kind == "ssn":
        return f"{900 + s.below(100)}{s.like(value[3:])}"  # never issued
    if kind == "phone":
        if value.startswith("+1") and len(value) == 12:
            exchange = "555" if value[5:8] == "555" and not extra else str(2 + s.below(8)) + s.like(value[6:8])
            return f"+1{2 + s.below(8)}{s.like(value[3:5])}{exchange}{s.like(value[8:])}"
        keep = 3 if value.startswith("+") else 0
        return value[:keep] + s.like(value[keep:]) + s.like("0" * extra)
    if kind == "accesskey":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[s.below(32)] for _ in value[4:])
    if kind == "secret":
        return s.like(value, hexadecimal=re.fullmatch("[0-9a-f]+", value) is not None) + s.like("a" * extra)
    if kind.startswith("given:"):
        # a keyed rotation of the shuffled list: no two names share a surrogate, none keeps its own
        names = NAMES[tuple(kind.split(":")[1:])]
        mixed = sorted(names, key=lambda n: hmac.new(key.encode(), f"{kind}{n}".encode(), hashlib.sha256).digest())
        return mixed[(mixed.index(value) + 1 + attempt) % len(mixed)]
    if kind.startswith("initial:"):  # likewise among the script's capital letters
        letters = CAPITALS[kind.partition(":")[2]]
        mixed = sorted(letters, key=lambda c: hmac.new(key.encode(), f"{kind}{c}".encode(), hashlib.sha256).digest())
        return mixed[(mixed.index(value) + 1) % len(mixed)]
    consonants, vowels = LETTERS[kind.partition(":")[2]]
    size = max(3, (len(value) + 1) // 2) + extra
    name = "".join(consonants[s.below(len(consonants))] + vowels[s.below(len(vowels))] for _ in range(size))
    return name.capitalize()


def fit_format(kind: str, original: str, new: str) -> str:
    """The canonical surrogate in the mention's own writing: separators and case."""
    if kind in ("card", "iban", "phone", "ssn"):
        chars, out = iter(new), []
        for c in original:
            out.append(next(chars, "") if c.isalnum() or c == "+" else c)
        return "".join(out) + "".join(chars)
    if kind == "email" and original.isupper():
        return new.upper()
    if kind.startswith("surname") and original.isupper():
        return new.upper()
    return new


def replace_entities(text: str, key: str, attempts: dict[tuple[str, str], int]) -> tuple[str, int, str]:
    """``(new text, number of replacements, their types)``; without entities the text is unchanged."""
    found = find_entities(text)
    if not found:
        return text, 0, ""
    out, at = [], 0
    for start, end, kind, value in found:
        entity = canonical(kind, value)
        out += [text[at:start], fit_format(kind, value, surrogate(key, kind, entity, attempts.get((kind, entity), 0)))]
        at = end
    return "".join(out) + text[at:], len(found), ",".join(sorted({k.partition(":")[0] for _, _, k, _ in found}))


def mentions(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct ``(text_key, kind, entity)``; equal texts share a key, so ids play no part."""

    def compute(batches):
        for batch in batches:
            rows = [(k, kind, canonical(kind, value)) for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for _, _, kind, value in find_entities(t)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)],
                                      names=["text_key", "kind", "entity"])

    text = text_or_empty(text_col)
    return (df.select(F.xxhash64(text).alias("text_key"), text.alias("text"))
            .mapInArrow(tidy(compute), "text_key long, kind string, entity string"))


def assign_attempts(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, entity, attempt)`` with ``attempt != 0``: entities whose first surrogates collided.

    Each round lets one entity of a shared surrogate keep it (the one with fewer attempts, then the first in order) and sends
    the others on, and also all whose surrogate is an entity of the corpus. Rounds are written to the shared folder; their
    number of collisions is all the driver sees. Given names are a permutation and take no part, nor do the addresses of
    crowded private ranges, whose attempt is ``TURNED``: their surrogates stay distinct, but may be addresses of the corpus.
    """

    @F.arrow_udf("string")
    def propose(kind: pa.Array, entity: pa.Array, attempt: pa.Array) -> pa.Array:
        return pa.array([surrogate(key, *x) for x in zip(kind.to_pylist(), entity.to_pylist(), attempt.to_pylist(), strict=True)], pa.string())

    @F.arrow_udf("struct<prefix: string, bits: int>")
    def range_of(entity: pa.Array) -> pa.Array:
        found = [private_range(x) for x in entity.to_pylist()]
        return pa.array([f and {"prefix": f[0], "bits": f[1]} for f in found], pa.struct({"prefix": pa.string(), "bits": pa.int32()}))

    ranged = entities.where("kind = 'ip'").select("kind", "entity", range_of("entity").alias("range")).where("range is not null")
    crowded = materialize(ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
                          .where(F.col("n") > F.lit(CROWDED) * F.pow(F.lit(2), F.col("range.bits"))), "crowded-ranges")
    names = entities.where(~F.col("kind").startswith("given:") & ~F.col("kind").startswith("initial:")).withColumn("attempt", F.lit(0))
    full = None
    if not crowded.isEmpty():
        full = materialize(ranged.join(crowded, "range", "left_semi").select("kind", "entity", F.lit(TURNED).alias("attempt")), "turned")
        names = names.join(full, ["kind", "entity"], "left_anti")
    real = names.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("is_real"))
    for _ in range(MAX_ROUNDS):
        rank = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "entity"))
        checked = materialize(
            names.withColumn("surrogate", propose("kind", "entity", "attempt")).withColumn("rank", rank)
            .join(real, ["kind", "surrogate"], "left")
            .select("kind", "entity", "attempt", ((F.col("rank") > 1) | F.col("is_real").isNotNull()).alias("collides")), "surrogates")
        if checked.where("collides").isEmpty():
            moved = checked.where("attempt > 0").select("kind", "entity", "attempt")
            return moved if full is None else moved.unionByName(full)
        names = checked.select("kind", "entity", (F.col("attempt") + F.col("collides").cast("int")).alias("attempt"))
    raise RuntimeError("surrogates still collide: the key space of a format is too small")


def replace_private_data(df: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text", report: bool = False) -> DataFrame:
    """``df`` with its texts' private data replaced; with ``report`` also ``n_replaced`` and ``kinds``.

    A null text stays null with 0 replacements, an empty one stays empty. Repeated rows get the same text; ids are not
    looked at and may be null. Columns named ``n_replaced`` or ``kinds`` are replaced by the report's. An empty table gives an empty
    result. Other columns are kept unchanged.
    """
    found = materialize(mentions(df, text_col), "mentions")
    entities = found.select("kind", "entity").distinct()
    moved = materialize(assign_attempts(entities, key), "moved-surrogates")

    @F.arrow_udf("text string, n long, kinds string")
    def rewrite(text: pa.Array, attempts: pa.Array) -> pa.Array:
        rows = []
        for t, moved_here in zip(text.to_pylist(), attempts.to_pylist(), strict=True):
            known = {(m["kind"], m["entity"]): m["attempt"] for m in moved_here or ()}
            rows.append((None, 0, "") if t is None else replace_entities(t, key, known))
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        give_back()
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()), strict=True)],
                                          ["text", "n", "kinds"])

    # The row travels as one struct, so that its columns may have any names.
    none = F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text_col).alias("value"),
                     F.xxhash64(text_or_empty(text_col)).alias("key"))
    if moved.isEmpty():
        parts = [rows.withColumn("moved", none)]
    else:
        # A document's list is bounded by its own mentions. Only documents that hold a moved entity
        # (and few more) are shuffled to their lists.
        lists = materialize(found.join(moved, ["kind", "entity"]).groupBy("text_key")
                            .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("moved")), "moved-lists")
        touched = may_hold(lists, "text_key")(F.col("key"))
        parts = [rows.where(~touched).withColumn("moved", none),
                 rows.where(touched).join(lists.hint("merge"), F.col("key") == F.col("text_key"), "left").drop("text_key")]
    added = [F.col("new.n").alias("n_replaced"), F.col("new.kinds").alias("kinds")] if report else []
    done = [part.withColumn("new", rewrite("value", "moved"))
            .select(*[F.col("new.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
                      for c in df.columns if not (report and c in ("n_replaced", "kinds"))], *added) for part in parts]
    return reduce(DataFrame.unionByName, done)
