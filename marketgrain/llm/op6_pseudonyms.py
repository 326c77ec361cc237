"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

A value that is found and passes its check (Luhn, IBAN modulo 97, a real date,
octets up to 255, ...) is read as a number in its format's domain, moved by a keyed
permutation of that domain, and written in the same format: the signs between stay,
lengths stay, check digits are right again. The permutation is a balanced Feistel
network with keyed BLAKE2 rounds, walked until it lands in the domain. It is
conjugated with a shift by one, so no value stands for itself. Equal values get
equal pseudonyms in all documents, however they are spaced; without the key they
can't be turned back. One scan, no shuffle, no table of values.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketgrain.llm import common
from marketgrain.llm import textarrays as ta

KEY_SETTING = "spark.pseudonyms.key"  # of the session; a real run sets its own
ROUNDS = 8
DAY_ZERO = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - DAY_ZERO
LATE = [n for n in range(DAYS) if datetime.date.fromordinal(n + DAY_ZERO).day > 12]  # can't be read as a month
LENGTHS = {
    c: int(n)
    for n, countries in (part.split(":") for part in (
        "15:NO 16:BE 18:DK,FI,FO,GL,NL,SD,FK 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK,MN 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
        "23:AE,GI,IL,IQ,OM,TL,SO 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
        "28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
    ).split())
    for c in countries.split(",")
}

PATTERN = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+)"
    r"|(?P<secret>(?i:(?<![a-z])(?:token|secret|password|api_?key|key)\s{0,3}[=:]\s{0,3}[\"']?)(?P<hex>[0-9a-f]{16,128}|[0-9A-F]{16,128})(?![0-9A-Za-z]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d))"
    r"|(?P<iso>(?<!\d)\d{4}-\d{2}-\d{2}(?!\d))"
    r"|(?P<dotted>(?<![\d.])\d{1,2}\.\d{1,2}\.\d{4}(?!\d|\.\d))"
    r"|(?P<slashed>(?<![\d/])\d{1,2}/\d{1,2}/\d{4}(?!\d|/\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?!\d|-\d))"
    r"|(?P<phone>(?<!\w)\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<!\w)\+[2-9]\d{0,2}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ -]?\d{2,4}){2,3}(?!\d|\.\d)"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d))"
    r"|(?P<card>(?<!\d)(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d))"
)


def permute(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    head = tweak.encode() + b"|" + str(size).encode()

    def step(r: int, part: int) -> int:
        out, block = b"", 0
        while len(out) < width:
            out += hashlib.blake2b(head + bytes([r, block]) + part.to_bytes(width, "big"), key=key, digest_size=min(64, max(8, width))).digest()
            block += 1
        return int.from_bytes(out[:width], "big") & mask

    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            left, right = (right ^ step(r, left), left) if back else (right, left ^ step(r, right))
        x = left << half | right
        if x < size:
            return x


def moved(x: int, size: int, key: bytes, tweak: str, by: int = 1) -> int:
    """A keyed permutation that moves every value (for size over 1); ``by=-1`` undoes it."""
    return permute((permute(x, size, key, tweak) + by) % size, size, key, tweak, back=True)


def in_base(digits: list[int], bases: list[int]) -> tuple[int, int]:
    x, size = 0, 1
    for d, b in zip(digits, bases, strict=True):
        x, size = x * b + d, size * b
    return x, size


def from_base(x: int, bases: list[int]) -> list[int]:
    out = []
    for b in reversed(bases):
        x, d = divmod(x, b)
        out.append(d)
    return out[::-1]


def luhn(digits: list[int]) -> int:
    """The check digit after these digits."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 else (2 * d - 9 if d > 4 else 2 * d)
    return -total % 10


def refill(shape: str, values: list[int]) -> str:
    """The text with its digits replaced in order."""
    it = iter(values)
    return "".join(str(next(it)) if c.isdigit() else c for c in shape)


def digits_of(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def card(text: str, key: bytes, by: int) -> str | None:
    d = digits_of(text)
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != d[-1] or not any(d):
        return None
    x, size = in_base(d[:-1], [10] * (len(d) - 1))
    new = from_base(moved(x, size, key, "card", by), [10] * (len(d) - 1))
    return refill(text, [*new, luhn(new)])


def phone(text: str, key: bytes, by: int) -> str | None:
    start = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", text)
    head = start.group() if start else ""
    d = digits_of(text[len(head) :])
    if not 7 <= len(d) <= 14:
        return None
    x, size = in_base(d, [10] * len(d))
    return head + refill(text[len(head) :], from_base(moved(x, size, key, "phone" + head, by), [10] * len(d)))


def email(text: str, key: bytes, by: int) -> str | None:
    """The name before the @ moves; capital, small and digit stay what they are."""
    name, place = text.split("@")
    bases, digits = [], []
    for c in name:
        for base, zero in ((26, "a"), (26, "A"), (10, "0")):
            if 0 <= ord(c) - ord(zero) < base and c.isascii():
                bases.append(base)
                digits.append(ord(c) - ord(zero))
    if not bases:
        return None
    x, size = in_base(digits, bases)
    shape = re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", name)))
    new = iter(from_base(moved(x, size, key, f"email{shape}@{place.lower()}", by), bases))
    return "".join(chr(ord(c) + next(new)) if c in "aA0" else c for c in shape) + "@" + place


def ip(text: str, key: bytes, by: int) -> str | None:
    """Each octet keeps its number of digits."""
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    low = [{1: 0, 2: 10, 3: 100}[len(p)] for p in parts]
    bases = [{1: 10, 2: 90, 3: 156}[len(p)] for p in parts]
    x, size = in_base([int(p) - a for p, a in zip(parts, low, strict=True)], bases)
    new = from_base(moved(x, size, key, "ip" + "".join(str(len(p)) for p in parts), by), bases)
    return ".".join(str(a + n) for a, n in zip(low, new, strict=True))


def iban(text: str, key: bytes, by: int) -> str | None:
    """Country and length stay, letters and digits stay such, the checksum is right."""
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = plain[4:]
    bases = [10 if c.isdigit() else 26 for c in body]
    x, size = in_base([int(c) if c.isdigit() else ord(c) - 65 for c in body], bases)
    new = from_base(moved(x, size, key, "iban" + plain[:2] + "".join("0" if c.isdigit() else "A" for c in body), by), bases)
    made = "".join(str(n) if b == 10 else chr(65 + n) for n, b in zip(new, bases, strict=True))
    whole = iter(plain[:2] + f"{98 - number(made + plain[:2] + '00') % 97:02d}" + made)
    return "".join(c if c == " " else next(whole) for c in text)


def ssn(text: str, key: bytes, by: int) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    ok = [a for a in range(1, 900) if a != 666]
    if area not in ok or not group or not serial:
        return None
    bases = [len(ok), 99, 9999]
    x, size = in_base([ok.index(area), group - 1, serial - 1], bases)
    a, g, s = from_base(moved(x, size, key, "ssn", by), bases)
    return f"{ok[a]:03d}-{g + 1:02d}-{s + 1:04d}"


def date(text: str, key: bytes, by: int, order: str, sign: str) -> str | None:
    """A real day of 1900 to 2099 becomes another; it has leading zeros where the
    found one had two digits."""
    parts = dict(zip(order, text.split(sign), strict=True))
    try:
        day = datetime.date(int(parts["y"]), int(parts["m"]), int(parts["d"])).toordinal() - DAY_ZERO
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None
    new = datetime.date.fromordinal(moved(day, DAYS, key, "date", by) + DAY_ZERO)
    value = {"y": new.year, "m": new.month, "d": new.day}
    return sign.join(f"{value[o]:0{len(parts[o])}d}" for o in order)


def slashed(text: str, key: bytes, by: int) -> str | None:
    """m/d/y; or d/m/y where only that is a real day, which becomes another such."""
    new = date(text, key, by, "mdy", "/")
    d, m, y = (int(p) for p in text.split("/"))
    if new is not None or d <= 12:
        return new
    try:
        day = datetime.date(y, m, d).toordinal() - DAY_ZERO
    except ValueError:
        return None
    if not 0 <= day < DAYS:
        return None
    new = datetime.date.fromordinal(LATE[moved(bisect.bisect_left(LATE, day), len(LATE), key, "late", by)] + DAY_ZERO)
    return f"{new.day}/{new.month:0{len(text.split('/')[1])}d}/{new.year}"


def ends(kind: str, text: str) -> list[int]:
    """Where a found value may end, best first: an IBAN at its country's length, then
    as found, then before the groups that follow it (of a known country's, none)."""
    breaks = [m.start() for m in re.finditer(r" |(?<=\d)[-.](?=\d)", text)] if kind in ("iban", "phone") else []
    if kind != "iban":
        return [len(text), *breaks[::-1]]
    own = [n for n in (*breaks, len(text)) if n - text.count(" ", 0, n) == LENGTHS.get(text[:2])]
    return [*own, len(text)] if text[:2] in LENGTHS else [len(text), *breaks[::-1]]


def secret(text: str, key: bytes, by: int) -> str | None:
    digits = [int(c, 16) for c in text]
    x, size = in_base(digits, [16] * len(digits))
    new = "".join(f"{n:x}" for n in from_base(moved(x, size, key, "hex", by), [16] * len(digits)))
    return new.upper() if any(c.isupper() for c in text) else new


HANDLERS = {
    "email": email, "iban": iban, "ip": ip, "ssn": ssn, "phone": phone, "card": card,
    "iso": lambda t, k, b: date(t, k, b, "ymd", "-"),
    "dotted": lambda t, k, b: date(t, k, b, "dmy", "."),
    "slashed": slashed,
}


NEAR = 400  # longer than anything found here


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and @, outside of which nothing can be found."""
    low = high = -1
    for match in re.finditer(r"[0-9@](?:[^\n]{0,40}[0-9@])*", text):
        if high < 0 or match.start() - NEAR > high:
            if high >= 0:
                yield low, high
            low = max(0, match.start() - NEAR)
        high = min(len(text), match.end() + NEAR)
    if high >= 0:
        yield low, high


def values(text: str, low: int, high: int, key: bytes, by: int) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of what is found in a stretch. What fails its
    check is tried with shorter ends, then the scan goes on behind its first sign."""
    while match := PATTERN.search(text, low, high):
        kind = match.lastgroup if match.lastgroup in HANDLERS else ("secret" if match["hex"] else "card")
        start, end = match.span("hex") if kind == "secret" else match.span()
        low = match.start() + 1
        for stop in ends(kind, text[start:end]):
            old = text[start : start + stop]
            new = secret(old, key, by) if kind == "secret" else HANDLERS[kind](old, key, by)
            if new is not None:
                low = start + stop
                yield kind, start, low, new
                break


def replaced(text: str, key: bytes, by: int = 1) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, length in the new text) of each."""
    out, spans, done, shift = [], [], 0, 0
    for kind, start, end, new in (f for low, high in regions(text) for f in values(text, low, high, key, by)):
        out += [text[done:start], new]
        spans.append((kind if kind not in ("iso", "dotted", "slashed") else "date", start + shift, len(new)))
        shift += len(new) - (end - start)
        done = end
    return ("".join(out) + text[done:], spans) if spans else (text, spans)


def new_texts(column: pa.Array, key: bytes) -> tuple[pa.Array, list[list]]:
    """The texts with pseudonyms, and what was found in each."""
    data, offsets = ta.flat(column)
    # only texts with a digit or an @ can hold anything
    marks = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))])
    texts, found = None, [[] for _ in range(len(column))]
    for i in np.flatnonzero(marks[offsets[1:]] > marks[offsets[:-1]]).tolist():
        new, found[i] = replaced(column[i].as_py(), key)
        if found[i]:
            texts = column.to_pylist() if texts is None else texts
            texts[i] = new
    return column if texts is None else pa.array(texts, column.type), found


def key_of(spark: SparkSession) -> bytes:
    return spark.conf.get(KEY_SETTING, "for tests only").encode()[:64]


def pseudonymised(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """doc_id, text with pseudonyms, n_found, found (kind, start, length) per row.

    Replaces e-mail names, card numbers with a right Luhn digit, IBANs with a right
    checksum, IPv4 addresses, SSNs, phone numbers, days of 1900 to 2099 (written
    y-m-d, d.m.y, m/d/y, or d/m/y if that alone is a day), and hexadecimal secrets after a word like token. Numbers
    that fail their check stay. Null and empty texts, ids and repeated rows stay as
    they are (null text: null, 0 found); every row is answered; an empty table gives
    no rows. Texts are read whole; other columns are not read.
    """
    spark = docs.sparkSession
    common.ship(spark)
    key = key or key_of(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            texts, found = new_texts(batch.column(1), key)
            spans = [[{"kind": k, "start": s, "length": n} for k, s, n in f] for f in found]
            yield pa.record_batch(
                [batch.column(0), texts, pa.array([len(f) for f in found], pa.int32()), pa.array(spans, found_type)],
                names=["doc_id", "text", "n_found", "found"],
            )

    schema = f"doc_id {kind}, text string, n_found int, found array<struct<kind:string,start:int,length:int>>"
    return docs.select("doc_id", "text").mapInArrow(ta.freed(work), schema)


def with_pseudonyms(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with pseudonyms in the text; a non-null
    ``n_chars``, if there is one, follows a text that changed."""
    spark = docs.sparkSession
    common.ship(spark)
    key = key or key_of(spark)
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            columns = dict(zip(names, batch.columns, strict=True))
            columns["text"], found = new_texts(columns["text"], key)
            if "n_chars" in columns and any(found):
                sizes = zip(columns["n_chars"].to_pylist(), columns["text"].to_pylist(), found, strict=True)
                columns["n_chars"] = pa.array([len(t) if f and n is not None else n for n, t, f in sizes], columns["n_chars"].type)
            yield pa.record_batch([columns[n] for n in names], names=names)

    return docs.mapInArrow(ta.freed(work), docs.schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymised(common.table(spark, folder, "documents")).select("doc_id", "text", "n_found")
