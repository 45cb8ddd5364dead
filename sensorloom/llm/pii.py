"""Personal data replaced by keyed surrogates of the same type and format.

Detection finds entities by pattern and checksum. A surrogate is a keyed function of the entity and
an attempt number, so one entity has one surrogate in all documents. Attempts are raised, in Spark,
for entities whose surrogate another entity has or that is itself an entity of the corpus, until
all are distinct. Replacing needs only the entities whose attempt is not 0, which are few.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored

DEFAULT_KEY = b"replace this key where surrogates are to be secret"
# From these attempts on, a surrogate may leave the format of a value whose format is too narrow.
WIDEN_AFTER = 6

# Titles before names, with the gender they tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n",
    "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Mademoiselle": "f",
    "Señor": "m", "Señora": "f", "Señorita": "f", "Sr": "m", "Sra": "f",
    "г-н": "m", "г-жа": "f", "господин": "m", "госпожа": "f",
}
# Given names that surrogates are drawn from, by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Alan Anton Arthur Bruno Carl Daniel David Edgar Emil Felix Frank Georg Henry Hugo Ivan Jakob Jonas Julian Karl Leo Lucas Marco Martin Max Nico Oscar Paul Peter Philip Ralph Robert Simon Stefan Theo Thomas Victor Walter William Xavier",  # noqa: E501
    ("latin", "f"): "Ada Alice Alma Amelia Anna Astrid Bella Carla Clara Diana Edith Elena Ella Emma Eva Flora Gloria Hanna Helen Ida Irene Jana Julia Karla Laura Lea Lena Lisa Lucia Maria Martha Nina Nora Olga Paula Rosa Sara Sofia Tina Vera",  # noqa: E501
    ("cyrillic", "m"): "Алексей Андрей Антон Борис Виктор Глеб Денис Егор Иван Игорь Кирилл Максим Никита Олег Павел Роман Сергей Тимур Фёдор Юрий",  # noqa: E501
    ("cyrillic", "f"): "Алина Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Раиса Светлана Тамара Ульяна Юлия",  # noqa: E501
}
# Syllables that surrogate surnames are built from.
SYLLABLES = {
    "latin": "bal bre car den dor fal fen gar hal hol jor kel lan lor mar mel nor pel ras ren sal sor tal tor var vel wen wil zan zor".split(),  # noqa: E501
    "cyrillic": "бал бер вол гор дан дор жар зан кал кор лан лор мар мел нор пел рас рен сал сор тал тор фал хол".split(),  # noqa: E501
}

_NAME = r"[^\W\d_a-zа-яà-öø-ÿ][^\W\d_]+(?:['’-][^\W\d_]+)?"
_TITLE = "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True))
_WORD = rf"(?!(?:{_TITLE})(?!\w)){_NAME}"
_INITIAL = r"[^\W\d_a-zа-яà-öø-ÿ](?:\.[ -]?| )"
PATTERNS = {
    "secret": r"(?i:\b(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|private[_-]?key)"
    r"\b[\"']?\s*[:=]\s*[\"']?)(?P<secret>[A-Za-z0-9_+/=.-]{6,})",
    # Keys that are known by how they begin; the beginning is kept.
    "key": r"(?<!\w)(?:(?:AKIA|ASIA)(?P<key1>[0-9A-Z]{16})|gh[opsu]_(?P<key2>[A-Za-z0-9]{36,})"
    r"|sk-(?P<key3>[A-Za-z0-9_-]{20,})|xox[abprs]-(?P<key4>[A-Za-z0-9-]{10,})"
    r"|eyJ(?P<key5>[\w-]{10,}\.[\w-]{10,}\.[\w-]{10,}))(?!\w)",
    "email": r"(?P<email>(?<![\w.+-])[\w][\w.+-]*@(?:[\w-]+\.)+[^\W\d_]{2,})",
    "iban": r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))",
    "ip": r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d))",
    "card": r"(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w|-[^\W\d]))",
    "ssn": r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    # Numbers of country 1 have ten digits more; those of other countries may have any number.
    "phone": r"(?P<phone>(?<![\w.])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
    r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w]))",
    "name": rf"(?<!\w)(?P<title>(?:{_TITLE})(?:(?:\. ?| )(?:{_TITLE})(?!\w))*)\.? "
    rf"(?P<names>(?:{_INITIAL})*{_WORD}(?: (?:{_INITIAL})*{_WORD}){{0,5}})",
}
_ALL = re.compile("|".join(PATTERNS.values()))
# What may start where a longer run of digits fails its checksum.
_UNCHECKED = re.compile(PATTERNS["ssn"] + "|" + PATTERNS["phone"])
_TITLES = re.compile(_TITLE)
_NAME_PARTS = re.compile(rf"(?P<initial>{_INITIAL})|{_NAME}")
_DIGIT_GROUPS = re.compile(r"\d+(?:[ -]\d+)*")
_CARD_LAYOUT = re.compile(r"\d+|\d{4}([ -])\d{4}\1\d{4}\1\d{1,4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5}")
# Every pattern needs one of these; texts without any are passed on untouched.
# They are searched for by RE2, whose \b knows ASCII letters only.
_MAY_HOLD = r"[0-9@=:]|sk-|gh[opsu]_|xox|eyJ|" + "|".join(
    t + r"\b" * t[-1].isascii() for t in TITLES
)


# Values of these begin with a gender and a bar.
_NAME_KINDS = ("given", "surname")


class Entity(NamedTuple):
    kind: str
    value: str  # canonical: equal for all spellings of one entity
    start: int
    end: int


def _luhn(digits: str) -> int:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _script(word: str) -> str:
    return "cyrillic" if "\u0400" <= word[:1] <= "\u04ff" else "latin"


def _gender(first: str, title: str | None) -> str:
    for (_, gender), names in GIVEN.items():
        if first in names.split():
            return gender
    return TITLES[title] if title else "n"


def _match(m: re.Match) -> list[Entity]:
    kind, text = m.lastgroup, m.string
    if kind in ("names", "title"):
        parts = list(_NAME_PARTS.finditer(text, *m.span("names")))
        words = [part for part in parts if not part["initial"]]
        title = next((t for t in _TITLES.findall(m["title"]) if TITLES[t] != "n"), None)
        gender = _gender(words[0][0] if len(words) > 1 else "", title)
        found = [Entity("surname", f"{gender}|{words[-1][0]}", *words[-1].span())]
        for part in words[:-1]:
            found.append(Entity("given", f"{gender}|{part[0]}", *part.span()))
        for part in parts:
            if part["initial"]:
                found.append(Entity("initial", part[0][0], part.start(), part.start() + 1))
        return found
    text = m[kind]
    span = m.span(kind)
    if kind == "email":
        domain = text.rpartition("@")[2].lower()
        return [Entity("domain", domain, *span), Entity("email", text.lower(), *span)]
    if kind == "ip":
        return [Entity(kind, text, *span)] if all(int(p) < 256 for p in text.split(".")) else []
    if kind == "secret":
        # A short value is a secret only if it looks like one.
        mixed = re.search(r"\d", text) and re.search(r"[A-Za-z]", text)
        return [Entity(kind, text, *span)] if len(text) >= 12 or mixed else []
    if kind.startswith("key"):
        return [Entity("secret", text, *span)]
    compact = re.sub(r"[^0-9A-Z]", "", text)
    if kind == "card" and not _card_ok(compact):
        return _unchecked(m) or _card_within(m)
    if kind == "iban" and not _iban_ok(compact):
        return _iban_within(m)
    return [Entity(kind, compact, *span)]


def _card_ok(digits: str) -> bool:
    return not _luhn(digits) and len(set(digits)) > 1


def _unchecked(m: re.Match) -> list[Entity]:
    """The number without a checksum that starts where a match failed its own."""
    shorter = _UNCHECKED.match(m.string, m.start())
    return _match(shorter) if shorter else []


def _card_within(m: re.Match) -> list[Entity]:
    """The card that starts where a longer run of digits failed, and ends with a group of them.

    Of overlapping cards in the run one that is laid out like a card counts, then the longest; if
    that starts later, nothing does here.
    """
    # As far as cards reach that overlap with one that starts here.
    run = _DIGIT_GROUPS.match(m.string, m.start(), m.end() + 40)
    groups = [g.span() for g in re.finditer(r"\d+", run[0])]
    found = []
    for first, (start, _) in enumerate(groups):
        digits = 0
        for last in range(first, len(groups)):
            digits += groups[last][1] - groups[last][0]
            if digits > 19:
                break
            end = groups[last][1]
            shown = run[0][start:end]
            after = m.string[run.start() + end : run.start() + end + 2]
            if digits >= 13 and not re.match(r"\w|-[^\W\d]", after):
                if _card_ok(re.sub(r"\D", "", shown)):
                    found.append((bool(_CARD_LAYOUT.fullmatch(shown)), digits, -start, end))
    # Only what overlaps a card that starts here can be in its way.
    own = max((f for f in found if f[2] == 0), default=None)
    if own is None or any(f[:2] > own[:2] and -f[2] < own[3] for f in found):
        return []
    value = re.sub(r"\D", "", run[0][: own[3]])
    return [Entity("card", value, m.start(), m.start() + own[3])]


def _iban_within(m: re.Match) -> list[Entity]:
    """The longest IBAN that starts where a longer match failed, and ends before a blank of it."""
    shown = m["iban"]
    for end in sorted((g.start() for g in re.finditer(" ", shown)), reverse=True):
        compact = shown[:end].replace(" ", "")
        if len(compact) >= 15 and _iban_ok(compact):
            return [Entity("iban", compact, m.start(), m.start() + end)]
    return []


def detect(text: str) -> list[Entity]:
    """Entities by place. Names found behind a title count wherever else they stand in the text."""
    found = []
    at = 0
    while m := _ALL.search(text, at):
        own = _match(m)
        found += own
        at = max(e.end for e in own) if own else max(m.start() + 1, _past_digits(text, m))
    names = {e.value[2:]: e for e in found if e.kind in ("given", "surname")}
    if names:
        taken = sorted((e.start, e.end) for e in found)
        spots = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, names)) + r")(?!\w)")
        for m in spots.finditer(text):
            before = bisect_left(taken, (m.end(), 0)) - 1  # spans do not overlap
            if before < 0 or taken[before][1] <= m.start():
                found.append(names[m[0]]._replace(start=m.start(), end=m.end()))
    return sorted(found, key=lambda e: (e.start, e.kind))


def _past_digits(text: str, m: re.Match) -> int:
    """Behind the first run of digits of a failed match: nothing can start within the run."""
    end = m.start()
    while end < m.end() and text[end].isdigit():
        end += 1
    return end


class _Draw:
    """Keyed random choices for one entity and attempt."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.parts, self.round, self.pool = key, "\0".join(map(str, parts)), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 16:
            message = f"{self.round}\0{self.parts}".encode()
            self.pool = int.from_bytes(hmac.new(self.key, message, hashlib.sha256).digest())
            self.round, self.left = self.round + 1, 256
        self.pool, value = divmod(self.pool, n)
        self.left -= n.bit_length()
        return value

    def like(self, text: str) -> str:
        """Digits for digits, letters for letters of the same case; the rest stays."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(chr(48 + self.below(10)))
            elif c.isalpha():
                letter = chr(97 + self.below(26))
                out.append(letter.upper() if c.isupper() else letter)
            else:
                out.append(c)
        return "".join(out)


@lru_cache(maxsize=200_000)
def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The canonical surrogate of a canonical value."""
    draw = _Draw(key, kind, value, attempt)
    wide = attempt >= WIDEN_AFTER
    if kind == "email":
        local, _, domain = value.rpartition("@")
        return draw.like(local) + (draw.like("a" * (attempt - 4)) if wide else "") + "@" + domain
    if kind == "domain":
        name, _, top = value.rpartition(".")
        return draw.like(name) + (draw.like("a" * (attempt - 4)) if wide else "") + "." + top
    if kind == "ip":
        parts = []
        for part in value.split("."):
            low, high = ((0, 10), (10, 100), (100, 256))[len(part) - 1]
            low, high = (1, 255) if wide else (low, high)
            parts.append(str(low + draw.below(high - low)))
        return ".".join(parts)
    if kind == "card":
        body = draw.like(value[:-1])
        return body + str((10 - _luhn(body + "0")) % 10)
    if kind == "iban":
        body = value[:2] + "00" + draw.like(value[4:])
        number = int("".join(str(int(c, 36)) for c in body[4:] + body[:4]))
        return f"{value[:2]}{98 - number % 97:02d}{body[4:]}"
    if kind == "phone":
        # The leading digits tell the country, and stay.
        return value[:1] + draw.like(value[1:])
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
            digits = "0123456789ABCDEF" if value.isupper() else "0123456789abcdef"
            return "".join(digits[draw.below(16)] for _ in value)
        return draw.like(value)
    if kind == "initial" and _script(value) == "cyrillic":
        return "АБВГДЕЖЗИКЛМНОПРСТУФХЭЮЯ"[draw.below(24)]
    if kind in ("given", "surname"):
        gender, _, name = value.partition("|")
        script = _script(name)
        if kind == "given":
            genders = ("m", "f") if gender == "n" else (gender,)
            pool = [n for g in genders for n in GIVEN[script, g].split()]
            parts = 1 if attempt < 3 else 2 if attempt < WIDEN_AFTER else attempt - 3
            made = "-".join(pool[draw.below(len(pool))] for _ in range(parts))
        else:
            pool = SYLLABLES[script]
            made = "".join(pool[draw.below(len(pool))] for _ in range(3 + attempt // 3))
            if script == "cyrillic":
                made += "ова" if gender == "f" else "ов"
            made = made.capitalize()
        return f"{gender}|{made.upper() if name.isupper() else made}"
    return draw.like(value)


def _laid_out(text: str, made: str) -> str:
    """The characters of a surrogate with the separators of the original spelling."""
    left = iter(made)
    out = [next(left, "") if c.isalnum() else c for c in text]
    return "".join(out) + "".join(left)


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with all entities replaced, and their number."""
    out, at, count = [], 0, 0
    domains: dict[str, str] = {}
    for e in detect(text):
        made = surrogate(key, e.kind, e.value, attempts.get((e.kind, e.value), 0))
        if e.kind == "domain":
            domains[e.value] = made
            continue
        original = text[e.start : e.end]
        if e.kind == "email":
            local, _, domain = made.rpartition("@")
            made = f"{local}@{domains[domain]}"
            if len(made) == len(original):
                made = "".join(m.upper() if o.isupper() else m for m, o in zip(made, original))
        elif e.kind in ("given", "surname"):
            made = made[2:]
        elif e.kind in ("card", "iban", "ssn", "phone"):
            made = _laid_out(original, made)
        out += [text[at : e.start], made]
        at, count = e.end, count + 1
    return "".join(out) + text[at:], count


def _may_hold(texts: pa.Array) -> list[bool]:
    return pc.fill_null(pc.match_substring_regex(texts, _MAY_HOLD), False).to_pylist()


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """text_key (a hash of the text), kind and value of the entities of each text, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for part in slices(batch):
                for n, may in enumerate(_may_hold(part.column(1))):
                    if may:
                        key = part.column(0)[n].as_py()
                        text = part.column(1)[n].as_py()
                        found.update(
                            (key, e.kind, e.value) for e in detect(text) if e.kind != "initial"
                        )
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*found)], names=["text_key", "kind", "value"]
                )

    keyed = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(run, "text_key long, kind string, value string").distinct()


def attempts(mentions: DataFrame, key: bytes) -> DataFrame:
    """kind, value and attempt of every entity whose first surrogate was not free.

    A surrogate is free if it is no entity of the corpus itself and no other entity keeps it: of
    those that draw it, the one with the fewest attempts and then the least value does. Names are
    judged as they are written, given names and surnames together: the gender that goes before
    them is only for the draw.
    """
    spark = mentions.sparkSession

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(3)))
            made = [
                surrogate(key, kind, value, attempt)[2 * (kind in _NAME_KINDS) :]
                for kind, value, attempt in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())],
                names=["kind", "value", "attempt", "made"],
            )

    schema = "kind string, value string, attempt int, made string"
    all_values = mentions.select("kind", "value").distinct()
    drawn = all_values.withColumn("attempt", F.lit(0)).mapInArrow(draw, schema)
    drawn = stored(drawn, "surrogates")
    is_name = F.col("kind").isin(*_NAME_KINDS)
    group = F.when(is_name, "name").otherwise(F.col("kind")).alias("group")
    written = F.when(is_name, F.substring("value", 3, 1 << 30)).otherwise(F.col("value"))
    originals = drawn.select(group, written.alias("made")).distinct()
    originals = originals.withColumn("original", F.lit(True))
    order = Window.partitionBy("group", "made").orderBy("attempt", "value", "kind")
    while True:
        judged = drawn.select("*", group).join(originals, ["group", "made"], "left").withColumn(
            "free", F.col("original").isNull() & (F.row_number().over(order) == 1)
        )
        judged = stored(judged.select("kind", "value", "attempt", "made", "free"), "judged")
        if judged.where("not free").isEmpty():
            return judged.where("attempt > 0").select("kind", "value", "attempt")
        again = judged.where("not free").select(
            "kind", "value", (F.col("attempt") + 1).alias("attempt")
        )
        kept = judged.where("free").select("kind", "value", "attempt", "made")
        drawn = stored(kept.unionByName(again.mapInArrow(draw, schema)), "surrogates")


def replace_entities(
    docs: DataFrame,
    text_col: str = "text",
    key: bytes = DEFAULT_KEY,
    count_col: str = "n_entities",
) -> DataFrame:
    """``docs`` with entities in ``text_col`` replaced, and their number in ``count_col``.

    Emails, phone numbers, payment cards (Luhn), IBANs (mod 97), US social security numbers, IPv4
    addresses, secrets behind words such as ``token =`` or with a known beginning, and names behind
    titles. One entity has
    one surrogate in all documents and spellings, distinct entities have distinct ones, and no
    surrogate is an entity of the corpus; only initials, of which there are too few, are just
    drawn. Punctuation, letter case, checksums, script and gender
    are kept.

    The texts are not shuffled: the few entities that needed a second draw are joined by a hash of
    the text, and Spark broadcasts them if their stored size is small. Null texts stay null with 0
    entities, texts without entities stay as they are, equal rows are treated equally, other
    columns pass unchanged (one named ``count_col`` is replaced), and an empty table stays empty.
    """
    docs = docs.drop(count_col)
    mentions = stored(entities(docs, text_col), "entities")
    again = attempts(mentions, key).join(mentions, ["kind", "value"])
    again = again.groupBy("text_key").agg(
        F.collect_list(F.struct("kind", "value", "attempt")).alias("redrawn")
    )
    again = stored(again, "redrawn")
    at, width = docs.columns.index(text_col), len(docs.columns)
    names = [*docs.columns, count_col]
    schema = T.StructType([*docs.schema.fields, T.StructField(count_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                texts = part.column(at).to_pylist()
                counts = [0] * len(texts)
                for n, may in enumerate(_may_hold(part.column(at))):
                    if may:
                        redrawn = part.column(width)[n].as_py() or ()
                        known = {(r["kind"], r["value"]): r["attempt"] for r in redrawn}
                        texts[n], counts[n] = replace(texts[n], key, known)
                columns = part.columns[:width]
                columns[at] = pa.array(texts, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64())], names=names
                )

    joined = docs.alias("docs").join(
        again.alias("again"), F.xxhash64(docs[text_col]) == F.col("again.text_key"), "left"
    )
    own = [F.col(f"docs.`{c}`") for c in docs.columns]
    rows = joined.select(*own, F.col("again.redrawn").alias(f"{count_col} redrawn"))
    return rows.mapInArrow(run, schema)
