"""Personal data replaced by surrogates of the same kind.

Found are mail addresses, telephone numbers, IP addresses, card numbers (with a valid check
digit), social security numbers, IBANs, access keys, passwords and tokens beside their
label, and names behind a title: any number of capitalised words, with inner hyphens and
apostrophes, the last of them the family name; initials and particles (van, de) between
them stay. An entity is a kind and a normal form, so that spellings of
one number or address are one entity, and a surname behind "Mr" is the surname of the full name.

A surrogate comes from a keyed hash of the entity: nobody without the key can tell it from
another, and the same entity has the same surrogate wherever it stands. It keeps the
format (lengths, letters, digits, punctuation, valid check digits), and for names the
gender that title and ending show, and the script. The table of all entities is then
checked: no two entities of a kind share a surrogate and none is an entity that really
occurs; those that fail are derived again until none does. Names get a syllable more each
time, so that there are more of them than any table has.

Only texts with a character that some pattern needs (`MAYBE`, decided by Spark) are looked at;
of them only those with entities are joined with their replacements.

Defined results: null and empty texts stay; texts without personal data stay byte for
byte; repeated rows stay repeated; an empty table gives an empty one; all columns but
the text stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left
from functools import lru_cache
from heapq import merge
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalflow.llm.common import ship, unused, written

#: Every text with an entity matches this.
MAYBE = (
    r"@|[0-9]|AKIA|ASIA|ghp_|sk-|xox[abpr]-"
    r"|\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Frau|Señor|Señora|Sra|Monsieur|Madame|Mme|господин|госпожа)\b"
)

_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "госпожа")
_MALE = ("Mr", "Sir", "Herr", "Señor", "Monsieur", "господин")
_EITHER = ("Dr", "Prof")

_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]*[\w+-]@[\w-]+(?:\.[\w-]+)+")
_KEY = re.compile(
    r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bghp_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}\b|\bxox[abpr]-[A-Za-z0-9-]{10,}\b"
)
_SECRET = re.compile(
    r"\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?([A-Za-z0-9+/_-]{8,})", re.IGNORECASE
)
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
#: Groups of digits that may hold a card, and the groups of one that stands behind another number.
_DIGITS = re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,}")
_CARD_GROUPS = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])")
_PHONE = re.compile(
    r"(?<![\w.+-])(?:\+[0-9]{8,15}|(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
    r"[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3})(?!\w|-[0-9]|\.[0-9])"
)
_TITLE = re.compile(
    r"\b(" + "|".join(sorted(_FEMALE + _MALE + _EITHER, key=len, reverse=True)) + r")\b\.?(?=[ \t])"
)
_INITIALS = re.compile(r"(?:[^\W\d_]\.-?)+")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_BLANKS = re.compile(r"[ \t]*")
_POSSESSIVE = re.compile(r"['’][sS]$")
_PARTICLES = frozenset(
    "van von vom de der den des del della di da das do dos du la le lo los las ten ter te zu zum zur af av al el bin ibn y"
    .split()
)
#: As in d'Artagnan or al-Rashid.
_SMALL_HEAD = re.compile(r"(?:d|l|al|el|ad|an|ar|as|ash)['’-]([^\W\d_])")
_TITLES = frozenset(_FEMALE + _MALE + _EITHER)
_BEHIND = frozenset(("Jr", "Sr", "Jnr", "Snr", "II", "III", "IV", "Esq", "PhD", "MD"))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> int:
    """Remainder of the check sum; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _iban_rest(code: str) -> int:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


def _cards(text: str):
    """Spans of valid cards: the longest run of whole digit groups whose check digit is right."""
    for run in _DIGITS.finditer(text):
        groups = [m.span() for m in re.finditer("[0-9]+", run.group())]
        groups = [(run.start() + a, run.start() + b) for a, b in groups]
        first = 0
        while first < len(groups):
            start, found = groups[first][0], 0
            # no number that goes on behind a hyphen starts a card
            for last in range(first, min(first + 19, len(groups))) if first == 0 or text[start - 1] == " " else ():
                end = groups[last][1]
                digits = _digits(text[start:end])
                if len(digits) > 19:
                    break
                if len(digits) < 13 or re.match(r"\w|-(?![0-9])", text[end : end + 2]):
                    continue
                if luhn(digits) == 0 and len(set(digits)) > 1 and (first == 0 or _CARD_GROUPS.fullmatch(text, start, end)):
                    found = last + 1
            if found:
                yield start, groups[found - 1][1]
            first = found or first + 1


def _ibans(text: str):
    """Spans of valid IBANs: the longest that ends with a word."""
    at = 0
    while m := _IBAN.search(text, at):
        start, end = m.span()
        while end > start and not (15 <= len(code := text[start:end].replace(" ", "")) <= 34 and _iban_rest(code) == 1):
            end = text.rfind(" ", start, end)
        if end > start:
            yield start, end
        at = max(end, start + 4)


def _phone(match: str) -> str | None:
    digits = _digits(match)
    if not 7 <= len(digits) <= 15 or not (match[0] in "+(" or "(" in match or len(digits) >= 10):
        return None
    return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits


def _script(word: str) -> str:
    return unicodedata.name(word[0], "LATIN").split(" ")[0].lower()


def _gender(title: str, given: str) -> str:
    if title in _FEMALE:
        return "f"
    if title in _MALE:
        return "m"
    return "f" if given[-1:].lower() in ("a", "а", "я") else "m"


def _capital(word: str) -> bool:
    head = _SMALL_HEAD.match(word)
    return (head.group(1) if head else word[0]).isupper()


def _name_words(text: str, at: int) -> list[tuple[int, int]]:
    """Spans of the words of the name behind a title, the family name last.

    Initials, particles and what stands behind a family name (Jr, III) are passed over.
    """
    found: list[tuple[int, int]] = []
    while True:
        start = _BLANKS.match(text, at).end()
        m = _INITIALS.match(text, start)
        if m and m.group()[0].isupper():
            at = m.end()
            continue
        m = _WORD.match(text, start)
        if not m:
            return found
        word = _POSSESSIVE.sub("", m.group())
        at = m.end()
        if word in _TITLES:
            if found:
                return found
            at += text[at : at + 1] == "."
        elif word in _PARTICLES:
            pass
        elif not _capital(word) or found and word in _BEHIND:
            return found
        elif len(word) > 1:
            found.append((start, start + len(word)))
            if word != m.group():
                return found


def _names(text: str):
    known: dict[str, str] = {}
    for m in _TITLE.finditer(text):
        spans = _name_words(text, m.end())
        for i, (start, end) in enumerate(spans):
            word = text[start:end]
            if i + 1 < len(spans):
                kind = f"given:{_gender(m.group(1), word)}:{_script(word)}"
            else:
                kind = f"family:{_script(word)}"
            known.setdefault(word, kind)
    for word, kind in list(known.items()):  # either apostrophe
        known.setdefault(word.replace("’", "'"), kind)
        known.setdefault(word.replace("'", "’"), kind)
    if known:  # the same names without a title, and in capitals
        known |= {w.upper(): kind for w, kind in known.items() if w.upper() not in known}
        pattern = r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(known, key=lambda w: (-len(w), w)))) + r")(?!\w)"
        for m in re.finditer(pattern, text):
            yield m.start(), m.end(), known[m.group()], m.group().lower().replace("’", "'")


def _raw(text: str):
    for m in _EMAIL.finditer(text) if "@" in text else ():
        yield m.start(), m.end(), "email", m.group().lower()
    for m in _KEY.finditer(text):
        yield m.start(), m.end(), "key", m.group()
    for m in _SECRET.finditer(text):
        if any("0" <= c <= "9" for c in m.group(1)):
            yield m.start(1), m.end(1), "secret", m.group(1)
    for start, end in _ibans(text):
        yield start, end, "iban", text[start:end].replace(" ", "")
    for start, end in _cards(text):
        yield start, end, "card", _digits(text[start:end])
    for m in _SSN.finditer(text):
        yield m.start(), m.end(), "ssn", _digits(m.group())
    for m in _IP.finditer(text):
        yield m.start(), m.end(), "ip", ".".join(str(int(x)) for x in m.group().split("."))
    for m in _PHONE.finditer(text):
        normal = _phone(m.group())
        if normal is not None:
            yield m.start(), m.end(), "phone", normal
    yield from _names(text)


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, normal form)`` in order, without overlaps; earlier kinds go first."""
    taken: list[tuple[int, int, str, str]] = []  # of the kinds before, in order
    kinds = ((kind, list(spans)) for kind, spans in groupby(_raw(text), lambda span: "name" if ":" in span[2] else span[2]))
    for _, spans in kinds:
        free = []
        for span in spans:
            at = bisect_left(taken, span[1], key=lambda t: t[0])  # those before begin in front of its end
            if (not at or taken[at - 1][1] <= span[0]) and (not free or free[-1][1] <= span[0]):
                free.append(span)
        taken = list(merge(taken, free))
    return taken


# -- surrogates ----------------------------------------------------------------------------

# Syllables and endings of made-up names.
_LATIN = ("ba", "del", "fi", "gor", "han", "jo", "ka", "lem", "mi", "nor", "pe", "ra", "sil", "ta", "vel", "wi", "zo", "cha")
_CYRILLIC = ("ба", "вел", "го", "дар", "же", "зо", "ка", "лем", "ми", "нор", "пе", "ра", "сил", "та", "фе", "ша")
_ENDINGS = {
    ("latin", "f"): ("na", "lia", "ra", "sa"),
    ("latin", "m"): ("ton", "rik", "mus", "do"),
    ("latin", ""): ("ley", "mann", "ford", "ski", "ez", "ard"),
    ("cyrillic", "f"): ("на", "лия", "ра"),
    ("cyrillic", "m"): ("слав", "мир", "тон"),
    ("cyrillic", ""): ("енко", "ский", "ин"),
}


class _Stream:
    """Numbers below given bounds from a keyed hash."""

    def __init__(self, key: bytes, kind: str, normal: str, nonce: int):
        self._state = hmac.new(key, f"{kind}\0{normal}\0{nonce}".encode(), hashlib.sha256).digest()
        self._bytes, self._turn = b"", 0

    def below(self, n: int) -> int:
        if len(self._bytes) < 4:
            self._bytes = hashlib.sha256(self._state + self._turn.to_bytes(4, "little")).digest()
            self._turn += 1
        value, self._bytes = int.from_bytes(self._bytes[:4], "little"), self._bytes[4:]
        return value % n

    def pick(self, items):
        return items[self.below(len(items))]

    def like(self, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        """Letters for letters in their case, digits for digits, the rest kept."""

        def one(c: str) -> str:
            if "0" <= c <= "9":
                return str(self.below(10))
            if c.isalpha():
                new = self.pick(letters)
                return new.upper() if c.isupper() else new
            return c

        return "".join(map(one, text))


@lru_cache(64)
def _letters(block: int, script: str) -> list[str]:
    """Small letters of a script among 128 code points, those that come back from capitals."""
    found = [c for c in map(chr, range(block, block + 128)) if c.isalpha() and c.lower() == c == c.upper().lower()]
    found = [c for c in found if len(c.upper()) == 1 and _script(c) == script]
    return found if len(found) > 1 else list("abcdefghijklmnopqrstuvwxyz")


def _name(stream: _Stream, script: str, gender: str, normal: str, nonce: int) -> str:
    """A made-up name; every nonce has a syllable or letter more, so that names never run out."""
    if script not in ("latin", "cyrillic"):  # letters of the same alphabet
        letters = _letters(ord(normal[0]) // 128 * 128, script)
        return "".join(stream.pick(letters) for _ in range(max(2, len(normal)) + nonce))
    parts = _LATIN if script == "latin" else _CYRILLIC
    size = 2 + stream.below(2) + nonce
    return "".join(stream.pick(parts) for _ in range(size)) + stream.pick(_ENDINGS[script, gender])


def surrogate(key: bytes, kind: str, normal: str, nonce: int = 0) -> str:
    """Normal form of the replacement."""
    s = _Stream(key, kind, normal, nonce)
    if kind == "email":
        local, _, domain = normal.partition("@")
        last = domain.rpartition(".")[2]
        host = "".join(s.pick("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
        return f"{s.like(local)}@{host}.example.{last if last in ('com', 'net', 'org') else 'com'}"
    if kind == "phone":
        digits = [str(s.below(10)) for _ in normal]
        for at in (0, 3) if len(normal) == 10 else (0,):
            digits[at] = str(2 + s.below(8))
        return "".join(digits)
    if kind == "card":
        body = normal[0] + "".join(str(s.below(10)) for _ in normal[2:])
        return body + str(-luhn(body + "0") % 10)
    if kind == "ssn":
        return f"{1 + s.below(665):03d}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "ip":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "key":
        head = re.match(r"AKIA|ASIA|ghp_|sk-|xox[abpr]-", normal).group()
        return head + s.like(normal[len(head) :])
    if kind == "secret":
        return s.like(normal, "abcdef" if re.fullmatch(r"[0-9A-Fa-f]+", normal) else "abcdefghijklmnopqrstuvwxyz")
    if kind == "iban":
        body = s.like(normal[4:])
        return f"{normal[:2]}{98 - _iban_rest(normal[:2] + '00' + body):02d}{body}"
    if kind.startswith("given:"):
        _, gender, script = kind.split(":")
        return _name(s, script, gender, normal, nonce)
    return _name(s, kind.split(":")[1], "", normal, nonce)


def rendered(kind: str, original: str, new: str) -> str:
    """The surrogate in the format of the original."""
    if kind in ("phone", "card", "ssn"):
        places = [i for i, c in enumerate(original) if "0" <= c <= "9"][-len(new) :]
        out = list(original)
        for place, digit in zip(places, new):
            out[place] = digit
        return "".join(out)
    if kind == "iban":
        chars = iter(new)
        return "".join(c if c == " " else next(chars) for c in original)
    if kind.startswith(("given:", "family:")):
        return new.upper() if original.isupper() else new[:1].upper() + new[1:]
    return new


# -- over a table -----------------------------------------------------------------------------


def _find_batches(batches):
    schema = pa.schema([("h", pa.int64()), ("kind", pa.string()), ("normal", pa.string())])
    for batch in batches:
        rows = [
            (h, kind, normal)
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist())
            for kind, normal in sorted({(k, n) for _, _, k, n in find(text)})
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _derive(key: bytes):
    def run(batches):
        for batch in batches:
            kind, normal, nonce = (batch.column(c).to_pylist() for c in ("kind", "normal", "nonce"))
            new = [surrogate(key, *row) for row in zip(kind, normal, nonce)]
            yield batch.select(["kind", "normal", "nonce"]).append_column("surrogate", pa.array(new, pa.string()))

    return run


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, normal, surrogate)`` of distinct entities: distinct, and none that occurs.

    Entities that share a surrogate with one of a smaller nonce or normal form, or hit an
    entity of the table, get the next nonce. Each round looks at the whole table.
    """
    schema = "kind string, normal string, nonce int, surrogate string"
    real = entities.select("kind", F.col("normal").alias("surrogate"), F.lit(True).alias("real"))
    state = entities.withColumn("nonce", F.lit(0)).mapInArrow(_derive(key), schema)
    order = Window.partitionBy("kind", "surrogate").orderBy("nonce", "normal")
    while True:
        state = written(state, "surrogates")
        judged = (
            state.withColumn("turn", F.row_number().over(order))
            .join(real, ["kind", "surrogate"], "left")
            .withColumn("bad", (F.col("turn") > 1) | F.coalesce("real", F.lit(False)))
        )
        if judged.filter("bad").isEmpty():
            return state.select("kind", "normal", "surrogate")
        state = judged.withColumn("nonce", F.col("nonce") + F.col("bad").cast("int")).select(
            "kind", "normal", "nonce"
        ).mapInArrow(_derive(key), schema)


def _replaced(text: str, new) -> tuple[str, int]:
    """The text with surrogates for its entities, and how many spans they replaced."""
    spans = find(text) if new else []
    by_entity = {(x["kind"], x["normal"]): x["surrogate"] for x in new or ()}
    out, at = [], 0
    for start, end, kind, normal in spans:
        out += [text[at:start], rendered(kind, text[start:end], by_entity[kind, normal])]
        at = end
    return "".join([*out, text[at:]]), len(spans)


def _replace_batches(new_column: str, count: str):
    def run(batches):
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column(new_column).to_pylist())
            done = [_replaced(text, new) for text, new in rows]
            place = batch.schema.get_field_index("text")
            batch = batch.set_column(place, "text", pa.array([t for t, _ in done], pa.string()))
            yield batch.drop_columns([new_column]).append_column(count, pa.array([n for _, n in done], pa.int64()))

    return run


def replace_personal(docs: DataFrame, key: bytes, count: str | None = None) -> DataFrame:
    """The rows with personal data in ``text`` replaced; ``count`` names a column for how many."""
    ship(docs.sparkSession)
    text_key, new_column, counted = (unused(name, docs.columns) for name in ("__text", "__replacements", "__replaced"))
    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    looked = docs.filter(maybe).select(F.xxhash64("text").alias("h"), "text")
    found = written(looked.mapInArrow(_find_batches, "h long, kind string, normal string").distinct(), "found")
    new = surrogates(found.select("kind", "normal").distinct(), key)
    per_text = (
        found.join(new, ["kind", "normal"])
        .groupBy("h")
        .agg(F.collect_list(F.struct("kind", "normal", "surrogate")).alias(new_column))
        .withColumnRenamed("h", text_key)
    )
    joined = docs.filter(maybe).withColumn(text_key, F.xxhash64("text")).join(per_text, text_key, "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    schema = joined.select(*columns, F.lit(0).cast("long").alias(counted)).schema
    replaced = joined.select(*columns, new_column).mapInArrow(_replace_batches(new_column, counted), schema)
    rest = docs.filter(~maybe).select(*columns, F.lit(0).cast("long").alias(counted))
    both = rest.unionByName(replaced)
    return both.withColumnRenamed(counted, count) if count else both.drop(counted)


#: Key of the registered queries; a real job passes its own.
DEMO_KEY = b"surrogates of the registered queries"


def op6_pii_surrogates(spark, sf_dir: str, key: bytes = DEMO_KEY) -> DataFrame:
    """All documents with personal data replaced, and how many entities were."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_personal(docs, key, "n_replaced")


QUERIES = {"op6_pii_surrogates": op6_pii_surrogates}
