"""Personal data replaced by keyed surrogates of the same kind and form.

Detected: e-mail addresses, phone numbers (three, three and four digits with or without
a country code, or a + and 8 to 15 digits in any groups), IPv4 and IPv6 addresses, payment
cards, international account numbers, US social security numbers, secrets after words like
``token =``, and names after titles.
An entity is its kind and normal form (case and separators do not matter), and
every mention of it anywhere gets the same surrogate, in the mention's own form:
separators, length, case and script stay, cards and account numbers keep whether their check
digits are right, addresses stay addresses, given names get one gender, that of most of their
titles in the corpus. A name found after a title is also replaced where it stands
alone in the same text, as a word with a capital.

Surrogates are keyed permutations (Feistel rounds over the characters that may
vary, each within its class), so different entities of one form never meet;
names are drawn by hash. The collision check makes that hold for all: over the
whole corpus, an entity whose surrogate is itself detected somewhere, or is
another's surrogate, is drawn again. After ``LAST_DRAW`` draws, or where nothing in it can
vary, it becomes a keyed tag in brackets, which no pattern finds, so that the rounds end.
What was redrawn, or has another gender than its text tells, is joined to the
documents that mention it; all others need no table at all.

Defined cases: a null or empty text has no entity and stays as it is (null stays
null); a repeated row gets a repeated result; mentions never overlap, the kind
listed first wins; an empty table gives an empty result; columns other than id
and text play no part.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from ipaddress import AddressValueError, IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import pieces, stored, union_all

# Letters by script, titles by gender, syllables of drawn names.
DIGITS = "0123456789"
HEX = "0123456789abcdef"
SCRIPTS = [
    "abcdefghijklmnopqrstuvwxyz", "áàâäãåéèêëíìîïóòôöõúùûüñçß",
    "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя",
]
# letters of scripts without capitals, as ranges
RANGES = [
    (0x4E00, 0x9FFF), (0x3041, 0x3096), (0x30A1, 0x30FA), (0xAC00, 0xD7A3), (0x0621, 0x064A),
    (0x05D0, 0x05EA), (0x0905, 0x0939), (0x0E01, 0x0E2E),
]
SCRIPTS += ["".join(map(chr, range(low, high + 1))) for low, high in RANGES]
MALE, FEMALE = "mr|herr|señor|sr|monsieur|sir", "mrs|ms|miss|frau|señora|sra|madame|mme|lady"
NEUTRAL = "dr|prof"
SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v".split(), "a e i o u".split(), {"f": "a", "m": "o", "n": "e"}),
    "greek": ("β δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο".split(), {"f": "α", "m": "ος", "n": "ι"}),
    "cyrillic": ("б в д к л м н п р с т".split(), "а е и о у".split(), {"f": "а", "m": "ин", "n": "о"}),
}

# programs that are no persons, after MS
PRODUCTS = "access dos excel office outlook paint powerpoint project sql teams visio windows word".split()

#: draws after which an entity gets a tag
LAST_DRAW = 12

# country codes of two digits; 1 and 7 have one, all others three
TWO_DIGITS = re.compile("2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")

_H, _V4 = "[0-9A-Fa-f]{1,4}", r"(?:\d{1,3}\.){3}\d{1,3}"
_TITLE = rf"\b(?P<title>(?i:{MALE}|{FEMALE}|{NEUTRAL}))\.?[ ]"
# a name may be double (Müller-Lüdenscheid) or begin with a letter and an apostrophe (O'Brien)
_LETTER = r"[^\W\d_]"
_WORD = rf"(?![a-z])(?:{_LETTER}['’])?{_LETTER}{{2,}}(?:-(?![a-z]){_LETTER}{{2,}})*"
ENTITY = re.compile(
    r"(?P<email>[^\W_][\w.+-]*@(?:[\w-]+\.)+[A-Za-z]{2,}(?![\w-]))"
    r"|(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b\s*[=:]\s*[\"']?(?P<secret>(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{16,}))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
    rf"|(?P<ip6>(?<![\w:.])(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{6}}{_V4}"
    rf"|(?:{_H}(?::{_H}){{0,6}}::|::(?=[0-9A-Fa-f]))(?:(?:{_H}:){{0,6}}(?:{_V4}|{_H}))?)(?![\w:]|\.\d))"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\b\d{3}[ .-])\d{3}[ .-]?\d{4}\b"
    r"|\+\d(?:[ ./()-]{0,2}\d){7,14}\b)"
    r"|(?P<ssn>\b\d{3}-\d{2}-\d{4}\b)"
    r"|(?P<card>\b\d(?:[ -]?\d){12,18}\b)"
    rf"|{_TITLE}(?P<name>{_WORD}(?:[ ]{_WORD})?)"
)
#: no entity without one of these
_HINT = re.compile(r"[@\d]|:[A-Fa-f:]|(?i:token|secret|password|passwd|api)|" + _TITLE)
Entity = tuple[str, str]


def _number(key: bytes, *parts: object) -> int:
    data = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=16).digest(), "big")


def permuted(key: bytes, tweak: str, values: list[int], sizes: list[int]) -> list[int]:
    """A keyed permutation of all tuples whose i-th value is below the i-th size."""
    half = len(values) // 2
    sides = [(values[:half], sizes[:half]), (values[half:], sizes[half:])]
    numbers, spans = [], []
    for part, bases in sides:
        number, span = 0, 1
        for value, base in zip(part, bases):
            number, span = number * base + value, span * base
        numbers.append(number)
        spans.append(span)
    for turn in range(8):
        side = turn % 2
        mask = _number(key, tweak, sizes, turn, numbers[1 - side])
        numbers[side] = (numbers[side] + mask) % spans[side]
    found: list[int] = []
    for (_, bases), number in zip(sides, numbers):
        part = []
        for base in reversed(bases):
            number, value = divmod(number, base)
            part.append(value)
        found += reversed(part)
    return found


def permuted_text(key: bytes, tweak: str, text: str, digits: str = DIGITS) -> str:
    """Permute the letters and digits of a lower-case text, each within its alphabet."""
    alphabets = [digits] + ([] if digits == HEX else SCRIPTS)
    of = [next((a for a in alphabets if c in a), None) for c in text]
    varying = [(i, a) for i, a in enumerate(of) if a]
    values = permuted(
        key, tweak, [a.index(text[i]) for i, a in varying], [len(a) for _, a in varying]
    )
    out = list(text)
    for (i, alphabet), value in zip(varying, values):
        out[i] = alphabet[value]
    return "".join(out)


def _luhn(digits: str) -> int:
    """The check digit that belongs to the digits before it."""
    doubled = [int(d) * (2 if i % 2 == 0 else 1) for i, d in enumerate(reversed(digits))]
    return -sum(d - 9 * (d > 9) for d in doubled) % 10


def _email(key: bytes, tweak: str, text: str) -> str:
    local, domain = text.rsplit("@", 1)
    *labels, top = domain.split(".")
    hidden = [permuted_text(key, "domain", label) for label in labels]
    return permuted_text(key, f"email{tweak}", local) + "@" + ".".join([*hidden, top])


def _ip(key: bytes, tweak: str, text: str) -> str:
    return ".".join(map(str, permuted(key, f"ip{tweak}", list(map(int, text.split("."))), [256] * 4)))


def _ip6(key: bytes, tweak: str, text: str) -> str:
    new = permuted(key, f"ip6{tweak}", list(IPv6Address(text).packed), [256] * 16)
    return str(IPv6Address(bytes(new)))


def _card(key: bytes, tweak: str, text: str) -> str:
    body = permuted_text(key, f"card{tweak}", text[:-1])
    return body + str((_luhn(body) + int(text[-1]) - _luhn(text[:-1])) % 10)


def _phone(key: bytes, tweak: str, text: str) -> str:
    """``text`` is the country code, ``|``, and the national digits."""
    country, national = text.split("|")
    return f"{country}|{permuted_text(key, f'phone{tweak}', national)}"


def _iban(key: bytes, tweak: str, text: str) -> str:
    """The country stays; right check digits stay right."""
    country, check, body = text[:2], text[2:4], text[4:]
    new = permuted_text(key, f"iban{tweak}", body)

    def right(of: str) -> str:
        return f"{98 - int(''.join(str(int(c, 36)) for c in of + country + '00')) % 97:02d}"

    return country + (right(new) if check == right(body) else permuted_text(key, f"iban{tweak}", check)) + new


def _secret(key: bytes, tweak: str, text: str) -> str:
    digits = HEX if set(text) <= set(HEX) else DIGITS
    return permuted_text(key, f"secret{tweak}", text, digits)


def _name(key: bytes, tweak: str, text: str) -> str:
    """``text`` is a gender (``s`` for a surname), ``|``, and the name."""
    gender, name = text.split("|")
    if any(low <= ord(c) <= high for c in name for low, high in RANGES):
        return f"{gender}|{permuted_text(key, f'name{tweak}', name)}"
    script = "greek" if re.search("[α-ωά-ώ]", name) else "cyrillic" if re.search("[а-я]", name) else "latin"
    consonants, vowels, endings = SYLLABLES[script]
    number, out = _number(key, "name", tweak, "s" if gender == "s" else "g", name), ""
    for _ in range(4):
        number, c = divmod(number, len(consonants))
        number, v = divmod(number, len(vowels))
        out += consonants[c] + vowels[v]
    return f"{gender}|{out}{consonants[number % len(consonants)]}{endings.get(gender, '')}"


SURROGATE: dict[str, Callable[[bytes, str, str], str]] = {
    "email": _email, "ip": _ip, "ip6": _ip6, "card": _card, "phone": _phone, "secret": _secret, "name": _name, "iban": _iban,
    "ssn": lambda key, tweak, text: permuted_text(key, f"ssn{tweak}", text),
}


def surrogate(key: bytes, entity: Entity, attempt: int = 0, gender: str = "n") -> str:
    """The surrogate's normal form; a given name's (``g|``) depends on its gender."""
    kind, normal = entity
    drawn = normal
    if attempt < LAST_DRAW:
        text = f"{gender}{normal[1:]}" if kind == "name" and normal[0] == "g" else normal
        drawn = SURROGATE[kind](key, str(attempt or ""), text)
        drawn = normal[0] + drawn[1:] if kind == "name" else drawn
    if drawn != normal:
        return drawn
    number = _number(key, "tag", attempt, kind, normal)
    return f"[{kind} {''.join('bcdfghjklmnpqrst'[number >> 4 * i & 15] for i in range(16))}]"


def _gender(title: str) -> str:
    title = title.lower()
    return "m" if title in MALE.split("|") else "f" if title in FEMALE.split("|") else "n"


def mentions(match: re.Match) -> list[tuple[int, int, Entity]]:
    """Start, end and entity of what a match mentions; a name may be two entities."""
    kind = next(
        k for k in ("email", "secret", "iban", "ip", "ip6", "phone", "ssn", "card", "name") if match[k]
    )
    text, (start, end) = match[kind], match.span(kind)
    if kind == "name":
        words = text.split(" ")
        if len(words) == 2 and words[1][0].islower():
            del words[1]
        title = match["title"]
        program = title.lower() == "ms" and (
            words[0].lower() in PRODUCTS or (title == "MS" and not words[0].isupper())
        )
        if words[0][0].islower() or program:
            return []
        found, at = [], start
        for i, word in enumerate(words):
            part = "g" if i == 0 < len(words) - 1 else "s"
            found.append((at, at + len(word), ("name", f"{part}|{word.lower()}")))
            at += len(word) + 1
        return found
    digits = re.sub(r"\D", "", text)
    if kind == "ip":
        if max(map(int, text.split("."))) > 255:
            return []
        normal = ".".join(str(int(part)) for part in text.split("."))
    elif kind == "ip6":
        try:
            normal = str(IPv6Address(text))
        except AddressValueError:
            return []
    elif kind == "phone":
        width = 1 if digits[0] in "17" else 2 if TWO_DIGITS.match(digits) else 3
        code = digits[:width] if text[0] == "+" else ""
        normal = f"{code}|{digits[len(code):]}"
    elif kind in ("ssn", "card"):
        normal = digits
    elif kind == "iban":
        normal = text.replace(" ", "").lower()
    elif kind == "secret" and not set(text.lower()) <= set(HEX):
        return [(start, end, (kind, text.lower()))]
    else:
        normal = text.lower()
    return [(start, end, (kind, normal))]


def in_form_of(mention: str, kind: str, new: str) -> str:
    """A surrogate's normal form, written as the mention was."""
    if new.startswith("["):
        return new
    if kind == "name":
        new = new.split("|")[1]
        return new.upper() if mention.isupper() else new.capitalize()
    if kind == "iban":
        letters = iter(new)
        return "".join(c if c == " " else next(letters).upper() for c in mention)
    if kind == "ip":
        return new
    if kind == "ip6":
        new = IPv6Address(new).exploded if len(mention) == 39 else new
        return new.upper() if any(c.isupper() for c in mention) else new
    if kind in ("phone", "ssn", "card"):
        digits = iter(new.replace("|", ""))
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, new))


def found_in(text: str) -> tuple[list[tuple[int, int, Entity]], dict[Entity, str]]:
    """All mentions in order, and the gender that the titles in the text give to given names."""
    if not _HINT.search(text):
        return [], {}
    found, votes = [], {}
    for match in ENTITY.finditer(text):
        some = mentions(match)
        found += some
        for _, _, entity in some:
            if entity[0] == "name" and entity[1][0] == "g":
                votes.setdefault(entity, []).append(_gender(match["title"]))
    named = [(text[start:end], e) for start, end, e in found if e[0] == "name"]
    if named:
        found = sorted(found + _alone(text, named, sorted(found)))
    return found, {e: most(v.count("m"), v.count("f")) for e, v in votes.items()}


def _alone(text: str, named: list[tuple[str, Entity]], spans: list) -> list[tuple[int, int, Entity]]:
    """Further places of names, as whole words as written, in capitals or with one, outside
    of the mentions there are."""
    starts, taken, alone = [start for start, _, _ in spans], set(), []
    forms = {form: e for name, e in named for form in (name.title(), name.upper(), name)}
    for form, entity in sorted(forms.items(), key=lambda f: -len(f[0])):
        start = text.find(form)
        while start >= 0:
            end = start + len(form)
            before = bisect_right(starts, start) - 1
            free = (before < 0 or spans[before][1] <= start) and (
                before + 1 == len(spans) or end <= starts[before + 1]
            )
            around = text[start - 1 : start] + text[end : end + 1]
            if free and not any(c.isalnum() or c in "_@" for c in around) and not any(
                s < end and start < e for s, e in taken
            ):
                taken.add((start, end))
                alone.append((start, end, entity))
            start = text.find(form, start + 1)
    return alone


def most(male: int, female: int) -> str:
    return "m" if male > female else "f" if female > male else "n"


def entities(text: str) -> set[Entity]:
    return {entity for _, _, entity in found_in(text)[0]}


def replaced(
    text: str, key: bytes, redrawn: dict[Entity, int], genders: dict[Entity, str] | None = None
) -> tuple[str, int]:
    """The text with every mention replaced, and how many there were. ``genders`` are
    those of the corpus where they are not those of the text."""
    found, own = found_in(text)
    out, last = [], 0
    genders = own | (genders or {})
    for start, end, entity in found:
        new = surrogate(key, entity, redrawn.get(entity, 0), genders.get(entity, "n"))
        out += [text[last:start], in_form_of(text[start:end], entity[0], new)]
        last = end
    return "".join([*out, text[last:]]), len(found)


# --- over a corpus ---------------------------------------------------------------


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, kind, normal, gender: the entities of each text, each once, with the gender
    that the text's titles give to a given name."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                spans, genders = found_in(text or "")
                rows += [(i, *e, genders.get(e)) for e in sorted({e for _, _, e in spans})]
            at, kinds, normals, genders = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()),
                 pa.array(normals, pa.string()), pa.array(genders, pa.string())],
                ["doc_id", "kind", "normal", "gender"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(found, f"doc_id {kind}, kind string, normal string, gender string")


def _drawn(entries: DataFrame, key: bytes) -> DataFrame:
    """Add ``new``: the surrogate at each entry's attempt."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            news = [
                surrogate(key, (kind, normal), attempt, gender)
                for kind, normal, gender, attempt in zip(*[c.to_pylist() for c in batch.columns])
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(news, pa.string())], ["kind", "normal", "gender", "attempt", "new"]
            )

    return entries.select("kind", "normal", "gender", "attempt").mapInArrow(
        draw, "kind string, normal string, gender string, attempt int, new string"
    )


def surrogates(found: DataFrame, key: bytes) -> DataFrame:
    """kind, normal, gender, attempt, new: a surrogate for every entity of the corpus, no two
    alike and none an entity.

    Rounds redraw only what collided and compare only that with all others. They end:
    from ``LAST_DRAW`` on a surrogate is a tag of 64 keyed bits, which is no entity.
    """
    votes = lambda g: F.count(F.when(F.col("gender") == g, 1))
    every = found.groupBy("kind", "normal").agg(votes("m").alias("m"), votes("f").alias("f")).select(
        "kind", "normal",
        F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("n").alias("gender"),
    )
    every = stored(every, "entities")
    real = every.select("kind", F.col("normal").alias("new"))
    columns, settled, attempt = ["kind", "normal", "gender", "attempt", "new"], [], 0
    fresh = stored(_drawn(every.withColumn("attempt", F.lit(0)), key), "drawn")
    while True:
        first = fresh.groupBy("kind", "new").agg(F.min("normal").alias("normal"))
        good = fresh.join(first, ["kind", "new", "normal"], "left_semi").join(real, ["kind", "new"], "left_anti")
        for part in settled:
            good = good.join(part.select("kind", "new"), ["kind", "new"], "left_anti")
        good = stored(good.select(*columns), "settled")
        settled.append(good)
        bad = stored(fresh.join(good.select("kind", "normal"), ["kind", "normal"], "left_anti"), "collided")
        if not bad.limit(1).count():
            return union_all(settled)
        attempt += 1
        fresh = stored(_drawn(bad.withColumn("attempt", F.lit(attempt)), key), "drawn")


def replace_entities(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates, n_replaced."""
    found = stored(detect(docs), "mentions")
    chosen = surrogates(found, key).withColumnRenamed("gender", "of_all").drop("new")
    differs = F.col("gender").isNotNull() & (F.col("gender") != F.col("of_all"))
    of_doc = stored(
        found.join(chosen, ["kind", "normal"]).filter((F.col("attempt") > 0) | differs)
        .groupBy(F.col("doc_id").alias("_id")).agg(
            F.collect_set(F.struct("kind", "normal", "attempt", "of_all")).alias("redrawn")
        ),
        "redrawn",
    )
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).join(
        of_doc, F.col("doc_id").eqNullSafe(F.col("_id")), "left"
    ).select("doc_id", "text", "redrawn")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, counts = [], []
            for text, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                attempts = {(r["kind"], r["normal"]): r["attempt"] for r in listed or []}
                genders = {(r["kind"], r["normal"]): r["of_all"] for r in listed or []}
                new, n = (None, 0) if text is None else replaced(text, key, attempts, genders)
                texts.append(new)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                ["doc_id", "text", "n_replaced"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(replace, f"doc_id {kind}, text string, n_replaced long")
