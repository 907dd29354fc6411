"""Surrogates for personal data: keyed replacements that keep type, format, script and gender.

A surrogate is computed from the entity alone, by a keyed permutation of all entities of its format. So equal entities
get equal surrogates in every document (coreference), and different ones get different surrogates (distinctness), without
a table of entities that all tasks would have to read. A job over the distinct entities of the corpus checks this.
"""

from __future__ import annotations

import functools
import hashlib
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import text_slices

KEY = "surrogates"
CHUNK = 1 << 20
# Characters that are replaced as one number.
LONGEST = 64
KINDS = ("email", "iban", "ip", "card", "ssn", "phone", "person")

# Given names by script and gender; forms of address; letters by script, vowels first.
GIVEN = {
    ("latin", "f"): "Alice Anna Carla Carmen Claire Elena Emily Emma Eva Hannah Helga Ingrid Isabel Julia Karen Laura "
    "Linda Lisa Lucia Maria Marie Martha Mary Monika Nina Olivia Patricia Petra Rosa Sarah Sofia Sophie Susan Ursula",
    ("latin", "m"): "Albert Carlos Charles Daniel David Diego Dieter Eric Felix Frank George Hans Henry Jack James Jean "
    "John Jorge Juan Klaus Louis Lukas Luis Marco Mark Michael Miguel Oliver Pablo Paul Pedro Peter Pierre Robert Thomas "
    "William",
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна",
    ("cyrillic", "m"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей",
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra"
ALPHABETS = (
    ("aeiou", "bcdfghjklmnpqrstvwxyz"),
    ("àáâãäåèéêëìíîïòóôõöùúûü", "çñß"),
    ("аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ"),
    ("αεηιουω", "βγδζθκλμνξπρστφχψ"),
)
# Address blocks of which the leading bits stay, as network and number of bits.
BLOCKS = ((10 << 24, 8), (127 << 24, 8), (172 << 24 | 16 << 16, 12), (192 << 24 | 168 << 16, 16))

NAMES = {name.lower(): group for group, names in GIVEN.items() for name in names.split()}
NAME = r"[^\W\d_a-zà-ÿа-яα-ω][^\W\d_]+(?:['’-][^\W\d_]+)*"
EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+")
# Every entity but an address of mail begins with one of these.
TRIGGER = re.compile(r"[\d+(A-ZА-Я]")
OTHER = re.compile(
    rf"""
    (?P<iban>\b[A-Z]{{2}}\d\d(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
    |(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w))
    |(?P<card>(?<!\w)(?:\d{{13,19}}|\d{{4}}(?P<gap>[ -])\d{{4}}(?P=gap)\d{{4}}(?P=gap)\d{{4}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}})(?!\w))
    |(?P<ssn>(?<![\w-])\d{{3}}-\d\d-\d{{4}}(?![\w-]))
    |(?P<phone>(?<![\w+])(?:\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:[ .-]?\d{{2,4}}){{2,4}}
        |(?:\(\d{{3}}\)[ ]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}})(?!\w))
    |(?P<person>\b(?:(?:{"|".join(TITLES.split())})\.?[ ]+{NAME}(?:[ ]{NAME}){{0,2}}
        |(?:{"|".join(n for names in GIVEN.values() for n in names.split())})[ ]{NAME})(?!\w))
    """,
    re.VERBOSE,
)


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0..n-1 that leaves nothing in its place if n is over 1.

    A Feistel network, repeated until the result is below n, gives a permutation p; the surrogate of x is
    ``p(p⁻¹(x) + s)`` with a keyed shift s.
    """

    key: bytes
    tweak: bytes
    n: int

    def _round(self, number: int, half: int, bits: int) -> int:
        data = b"%b:%d:%d" % (self.tweak, number, half)
        wide = b"".join(hashlib.blake2b(data, key=self.key, salt=b"%d" % i).digest() for i in range(bits // 512 + 1))
        return int.from_bytes(wide) & ((1 << bits) - 1)

    def _walk(self, x: int, back: bool) -> int:
        bits = ((self.n - 1).bit_length() + 1) // 2
        mask = (1 << bits) - 1
        while True:
            left, right = x >> bits, x & mask
            for number in reversed(range(6)) if back else range(6):
                if back:
                    left, right = right ^ self._round(number, left, bits), left
                else:
                    left, right = right, left ^ self._round(number, right, bits)
            x = left << bits | right
            if x < self.n:
                return x

    def __call__(self, x: int) -> int:
        if self.n < 2:
            return x
        shift = 1 + self._round(99, self.n, self.n.bit_length() + 32) % (self.n - 1)
        return self._walk((self._walk(x, True) + shift) % self.n, False)


def moved(key: bytes, tweak: str, symbols: list[str], text: str, fits: Callable[[str], bool] = lambda s: True) -> str:
    """The surrogate of ``text``, whose i-th character is one of ``symbols[i]``, among all such texts that ``fits`` accepts.

    A long text is replaced block by block, each in a way that depends on those before it; it must not need ``fits``.
    """
    if len(text) > LONGEST:
        blocks, before = [], hashlib.sha256()
        for at in range(0, len(text), LONGEST):
            own = f"{tweak}|{at}|{before.hexdigest()}"
            blocks.append(moved(key, own, symbols[at : at + LONGEST], text[at : at + LONGEST]))
            before.update(text[at : at + LONGEST].encode("utf-8", "surrogatepass"))
        return "".join(blocks)
    n, x = 1, 0
    for options, c in zip(symbols, text):
        n, x = n * len(options), x * len(options) + options.index(c)
    order = Permutation(key, hashlib.sha256(f"{tweak}|{'|'.join(symbols)}".encode()).digest(), n)
    while True:
        x = value = order(x)
        letters = []
        for options in reversed(symbols):
            value, at = divmod(value, len(options))
            letters.append(options[at])
        made = "".join(reversed(letters))
        if fits(made):
            return made


def sort_of(c: str) -> tuple:
    """What a character outside the alphabets shares with those that may stand for it: block of 128, script, category and cases."""
    upper = c.upper()
    cases = lowered(c) == c, len(upper) == 1 and upper != c and lowered(upper) == c, len(upper) == 1 and upper != c
    return ord(c) >> 7, unicodedata.name(c, "").split(" ")[0], unicodedata.category(c), *cases


@functools.lru_cache(1 << 12)
def others_like(c: str) -> str:
    """The letters and numbers of the sort of ``c``, which has none of the alphabets' ones. One that is alone in its sort is joined by all such ones of its case."""
    block = ord(c) >> 7 << 7
    found = [x for x in map(chr, range(block, block + 128)) if free(x) and sort_of(x) == sort_of(c)]
    return "".join(found) if len(found) > 1 else lone()[case_of(c)]


def case_of(c: str) -> tuple[bool, bool]:
    return lowered(c) == c, c.isupper()


@functools.cache
def lone() -> dict[str, str]:
    """The letters and numbers that are alone in their sort, by case."""
    sorts = defaultdict(list)
    for x in map(chr, range(sys.maxunicode + 1)):
        if free(x):
            sorts[sort_of(x)].append(x)
    alone = defaultdict(str)
    for found in sorts.values():
        if len(found) == 1:
            alone[case_of(found[0])] += found[0]
    return alone


def free(c: str) -> bool:
    """Whether a character is a letter or number that no alphabet has in either case."""
    return c.isalnum() and not c.isascii() and not any(c.lower() in "".join(alphabet) for alphabet in ALPHABETS)


def like(c: str, parted: bool = True) -> str:
    """The characters of the same script as a lower case character, and of the same sound if ``parted``; digits for digits.

    For letters and numbers outside the alphabets these are the ones of the same sort. Other characters stand for themselves.
    """
    if c.isdigit() and c.isascii():
        return "0123456789"
    for alphabet in ALPHABETS:
        for letters in alphabet if parted else ["".join(alphabet)]:
            if c in letters:
                return letters
    return others_like(c) if free(c) else c


def cased(made: str, original: str) -> str:
    return "".join(m.upper() if o.isupper() and len(m.upper()) == 1 else m for m, o in zip(made, original))


def lowered(text: str) -> str:
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def refilled(mention: str, made: str) -> str:
    """A mention with its letters and digits replaced by those of ``made``: the separators stay, and digits are of the script they were."""
    rest = iter(made)
    return "".join(in_script(next(rest), c) if c.isalnum() else c for c in mention)


def in_script(digit: str, c: str) -> str:
    """A digit in the script of the digit ``c``; other characters as they are."""
    return chr(ord(c) - unicodedata.decimal(c) + int(digit)) if c.isdecimal() and digit.isdecimal() else digit


def plain_digits(text: str) -> str:
    """A text with the digits of all scripts as those of ASCII."""
    return text if text.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


class Surrogates:
    """Finds entities and replaces them, under a key."""

    def __init__(self, key: str = KEY) -> None:
        self.key = hashlib.sha256(key.encode()).digest()
        self.known = functools.lru_cache(1 << 16)(self.surrogate)

    def __reduce__(self):
        return rebuilt, (self.key,)

    def canonical(self, kind: str, mention: str) -> str:
        """What the mentions of one entity have in common."""
        if kind == "email":
            return lowered(mention)
        if kind == "person":
            return " ".join(name_parts(mention))
        mention = plain_digits(mention)
        if kind == "ip":
            return mention
        return "".join(filter(str.isalnum, mention[2:] if kind == "phone" and national(mention) else mention))

    def surrogate(self, kind: str, entity: str) -> str:
        """The surrogate of a canonical entity, itself canonical."""
        return getattr(self, f"_{kind}")(entity)

    def _email(self, entity: str) -> str:
        local, _, domain = entity.rpartition("@")
        name, _, ending = domain.rpartition(".")
        made = [moved(self.key, part, [like(c, False) for c in x], x) for part, x in (("local", local), ("domain", name))]
        return f"{made[0]}@{made[1]}.{ending}"

    def _iban(self, entity: str) -> str:
        """Country and kinds of characters stay; the check digits follow from the rest."""
        upper = ["0123456789" if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in entity[4:]]
        good = self._iban_check(entity[:2], entity[4:]) == entity[2:4]
        # An entity with wrong check digits keeps its distance to the right ones, so it can't meet one that has them.
        off = (int(entity[2:4]) - int(self._iban_check(entity[:2], entity[4:]))) % 100
        made = moved(self.key, f"iban{entity[:2]}", upper, entity[4:])
        check = self._iban_check(entity[:2], made)
        return entity[:2] + (check if good else f"{(int(check) + off) % 100:02d}") + made

    @staticmethod
    def _iban_check(country: str, rest: str) -> str:
        return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"

    def _ip(self, entity: str) -> str:
        value = functools.reduce(lambda a, b: a << 8 | int(b), entity.split("."), 0)
        bits = next((bits for net, bits in BLOCKS if value >> (32 - bits) == net >> (32 - bits)), 0)
        order = Permutation(self.key, b"ip%d:%d" % (bits, value >> (32 - bits) if bits else 0), 1 << (32 - bits))
        low, high = value & ((1 << (32 - bits)) - 1), value >> (32 - bits) << (32 - bits)
        while True:
            low = order(low)
            made = high | low
            if bits or not any(made >> (32 - b) == net >> (32 - b) for net, b in BLOCKS):
                return ".".join(str(made >> shift & 255) for shift in (24, 16, 8, 0))

    def _card(self, entity: str) -> str:
        """The first digit stays, and whether the check digit is right."""
        right = luhn(entity)
        return entity[0] + moved(
            self.key, f"card{entity[0]}{right}", ["0123456789"] * (len(entity) - 1), entity[1:], lambda s: luhn(entity[0] + s) == right
        )

    def _ssn(self, entity: str) -> str:
        return moved(self.key, "ssn", ["0123456789"] * len(entity), entity)

    def _phone(self, entity: str) -> str:
        """The first digit stays, which begins the country's code or the area's."""
        return entity[0] + moved(self.key, "phone", ["0123456789"] * (len(entity) - 1), entity[1:])

    def _person(self, entity: str) -> str:
        return " ".join(map(self.name, entity.split(" ")))

    def name(self, part: str) -> str:
        """A known given name becomes another of its script and gender. Any other keeps its sounds, and its last letter if an alphabet has it."""
        group = NAMES.get(part)
        if group:
            names = sorted(name for name, own in NAMES.items() if own == group)
            order = Permutation(self.key, f"given{group}".encode(), len(names))
            return names[order(names.index(part))]
        symbols = [like(c) for c in part[:-1]] + [like(part[-1]) if free(part[-1]) else part[-1]]
        return moved(self.key, "name", symbols, part, lambda s: s not in NAMES)

    def found(self, text: str) -> Iterator[tuple[int, int, str]]:
        """``start, end, kind`` of the entities in order. Where two overlap the earlier counts, an address of mail before others."""
        mails = [m.span() for m in EMAIL.finditer(text)] if "@" in text else []
        at, end = 0, 0
        for trigger in TRIGGER.finditer(text):
            start = trigger.start()
            while at < len(mails) and mails[at][0] <= start:
                if mails[at][0] >= end:
                    yield *mails[at], "email"
                    end = mails[at][1]
                at += 1
            if start < end:
                continue
            match = OTHER.match(text, start)
            if match and not (at < len(mails) and match.end() > mails[at][0]):
                end = match.end()
                yield start, end, next(kind for kind in KINDS[1:] if match[kind] is not None)
        for mail in mails[at:]:
            if mail[0] >= end:
                yield *mail, "email"

    def replaced(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text with surrogates, and ``kind, entity, surrogate`` of each mention in order."""
        mentions: list[tuple[str, str, str]] = []
        parts, at = [], 0
        for start, end, kind in self.found(text):
            mention = text[start:end]
            entity = self.canonical(kind, mention)
            made = self.known(kind, entity)
            mentions.append((kind, entity, made))
            parts += [text[at:start], self.in_format(kind, mention, made)]
            at = end
        return "".join([*parts, text[at:]]), mentions

    @staticmethod
    def in_format(kind: str, mention: str, made: str) -> str:
        """A surrogate with the separators, case, country code and form of address of the mention."""
        if kind == "email":
            return cased(made, mention)
        if kind == "ip":
            return "".join(in_script(c, mention[0]) for c in made)
        if kind == "phone":
            lead = 2 if national(mention) else 0
            return mention[:lead] + refilled(mention[lead:], made)
        if kind == "person":
            title = title_of(mention)
            words = zip(made.split(" "), mention[len(title) :].split(" "))
            return title + " ".join(cased(m, o) if len(m) == len(o) else m.upper() if o.isupper() else m.capitalize() for m, o in words)
        return refilled(mention, made)


def national(mention: str) -> bool:
    """Whether a number is written with the country code 1, which the same number may be written without."""
    return plain_digits(mention).startswith("+1") and sum(map(str.isdecimal, mention)) == 11


def rebuilt(key: bytes) -> Surrogates:
    made = Surrogates()
    made.key = key
    return made


def title_of(mention: str) -> str:
    """The form of address that a mention of a person begins with, up to the name."""
    match = re.match(rf"(?:{'|'.join(TITLES.split())})\.?[ ]+", mention)
    return match[0] if match else ""


def name_parts(mention: str) -> list[str]:
    return lowered(mention[len(title_of(mention)) :]).split(" ")


MENTION = T.StructType().add("kind", "string").add("entity", "string").add("surrogate", "string")


def mentions(docs: DataFrame, surrogates: Surrogates, text: bool) -> DataFrame:
    """``docs`` with ``mentions`` and, if ``text``, ``replaced``; otherwise the mentions alone."""
    shared = docs.sparkSession.sparkContext.broadcast(surrogates)
    arrow = pa.list_(pa.struct([(name, pa.string()) for name in MENTION.names]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "_text", CHUNK):
            made = [shared.value.replaced(t) for t in texts]
            rows = pa.array([[dict(zip(MENTION.names, m)) for m in found] for _, found in made], arrow)
            if not text:
                yield pa.RecordBatch.from_arrays([rows], names=["mentions"])
                continue
            whole = [None if was is None else t for (t, _), was in zip(made, part.column("_text").to_pylist())]
            others = [part.column(c) for c in part.schema.names if c != "_text"]
            names = [c for c in part.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*others, rows, pa.array(whole, pa.string())], names=[*names, "mentions", "replaced"])

    found = T.ArrayType(MENTION)
    if not text:
        return docs.select(F.col("text").alias("_text")).mapInArrow(scan, T.StructType().add("mentions", found))
    schema = docs.select([c for c in docs.columns if c != "_text"]).schema.add("mentions", found).add("replaced", "string")
    return docs.mapInArrow(scan, schema)


def clashes(each: DataFrame) -> DataFrame:
    """``kind, surrogate, n, stays`` where n > 1 entities of a kind have one surrogate or one has itself, of ``each(kind, entity, surrogate)``.

    An address of mail of punctuation alone, up to its ending, has nothing to replace. Entities are made distinct in each task before they are shuffled, so one that every document has is not hot.
    """
    stays = (F.col("entity") == F.col("surrogate")) & ((F.col("kind") != "email") | F.col("entity").rlike(r"(?s)[\p{L}\p{N}].*\."))
    counted = each.distinct().groupBy("kind", "surrogate").agg(F.count_distinct("entity").alias("n"), F.max(stays).alias("stays"))
    return counted.where("n > 1 or stays")


def check_distinct(each: DataFrame) -> None:
    """Stop if two entities of one kind in the corpus would get one surrogate, or one would get itself."""
    worst = clashes(each).orderBy("kind", "surrogate").limit(3).collect()
    if any(r["stays"] for r in worst):
        raise ValueError(f"an entity would stay as it is: {[(r['kind'], r['surrogate']) for r in worst if r['stays']]}")
    if worst:
        raise ValueError(f"two entities would share a surrogate: {[(r['kind'], r['surrogate']) for r in worst]}")


def with_surrogates(docs: DataFrame, key: str = KEY, check: bool = True) -> DataFrame:
    """``doc_id, text, n_<kind>..., entities`` of each row of ``docs(doc_id, text)``: the whole text with surrogates.

    ``entities`` counts the different ones of a row. A text without entities is unchanged and a missing one stays missing. Rows
    are independent, so repeated rows are replaced alike. An empty table gives no rows.
    """
    surrogates = Surrogates(key)
    rows = docs.select("doc_id", F.col("text").alias("_text"))
    if check:
        check_distinct(mentions(docs.select("text"), surrogates, text=False).select(F.explode("mentions").alias("m")).select("m.*"))
    made = mentions(rows, surrogates, text=True)
    count = lambda kind: F.size(F.filter("mentions", lambda m: m["kind"] == kind)).cast("long")
    different = F.size(F.array_distinct(F.transform("mentions", lambda m: F.struct(m["kind"], m["entity"])))).cast("long")
    return made.select(
        "doc_id",
        F.col("replaced").alias("text"),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        different.alias("entities"),
    )
