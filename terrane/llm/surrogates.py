"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Entities are found by expressions and checks. A surrogate is a keyed function of the entity's kind and
normal form, so every mention in every document gets the same one. Digits and letters go through a
format-preserving Feistel permutation, which can't send two entities of one format to one surrogate;
names are drawn by a keyed hash, with endings by gender and letters of their script. A distributed check
then looks for surrogates that two entities share, or that are themselves an entity of the corpus, and
gives the later one another draw until there are none. Later draws make longer names and longer local
parts of addresses; what is left in a private network after MOST_DRAWS is dealt the addresses that are
still free, by rank. Where a format has no room for all its entities, an error is raised.

Defined cases: a null text stays null with no entities, an empty one stays empty; of overlapping
findings the first in the order of KINDS wins; repeated rows each get a result; an empty table gives an
empty result; a null id is kept; long texts are read whole, in time that grows as they do; a kept column
that has the name of a result gives way to it. An address outside the reserved domains gets one under
`.example`, so that it can't be anybody's: there its length changes, its form doesn't.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, fresh, map_arrow, map_texts, passed, quoted, saved

KINDS = ("email", "ipv4", "iban", "card", "ssn", "phone", "name")
#: At most so many entities with another draw are told to all tasks; more of them are joined to the rows.
MOST_TOLD = 20_000
#: After so many draws private networks are dealt by rank; after MOST_ROUNDS rows that remain are an error.
MOST_DRAWS, MOST_ROUNDS = 16, 100
# Private networks, as first address and width in bits.
_NETS = ((10 << 24, 24), (127 << 24, 24), (0xC0A80000, 16), (0xAC100000, 20), (0xA9FE0000, 16))

_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_CARD = re.compile(r"(?<![\d+])(?:\d{4}[ -]){3}\d{1,7}(?!\d)|(?<![\d+.])\d{13,19}(?!\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_PHONE = re.compile(r"(?<![\w+.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?!\d)|(?<![\w+.])\+\d{8,15}(?!\d)")
# Forms of address by gender.
_TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "господин", "г-н", "ბატონი"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "госпожа", "г-жа", "ქალბატონი"), "n": ("Dr", "Prof")}
_GENDER = {t: g for g, own in _TITLES.items() for t in own}
_NAME = re.compile(rf"(?<!\w)({'|'.join(sorted(map(re.escape, _GENDER), key=len, reverse=True))})\.?[ ]+((?:[^\W\d_a-zа-яß-öø-ÿ][^\W\d_]+)(?:[ -][A-ZÀ-ÖØ-ÞА-Яა-ჰ][^\W\d_]+){{0,2}})")
# Syllables of made-up names, and endings by gender, by script.
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ja jo ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo wa we za zo",
    "cyrillic": "ба бе бо да де до ва во га го жа за зо ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то фа ха ша",
    "georgian": "ბა ბე ბო და დე დო ვა გა გო ზა ზე კა კე კო ლა ლე ლო მა მე მო ნა ნე ნო პა რა რე რო სა სე სო ტა ტე შა შე ჩა ხა",
}
_ENDINGS = {"latin": {"m": "rn", "f": "lia", "n": "x"}, "cyrillic": {"m": "рин", "f": "лия", "n": "к"}, "georgian": {"m": "ძე", "f": "ლი", "n": "შვ"}}


def _script(word: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", word) else "georgian" if re.search("[Ⴀ-ჿ]", word) else "latin"


def _luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) in order of start."""
    if not text:
        return []
    taken: list[tuple[int, int, str, str]] = []

    covered = bytearray(len(text))

    def add(a: int, b: int, kind: str, normal: str) -> None:
        if covered.find(1, a, b) < 0:
            covered[a:b] = b"\x01" * (b - a)
            taken.append((a, b, kind, normal))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(*m.span(), "email", m.group().lower())
    if re.search(r"\d[\d. ()+-]{5}", text):
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m.group().split(".")):
                add(*m.span(), "ipv4", ".".join(str(int(x)) for x in m.group().split(".")))
        for m in _IBAN.finditer(text):
            normal = m.group().replace(" ", "")
            if 15 <= len(normal) <= 34 and int("".join(str(int(c, 36)) for c in normal[4:] + normal[:4])) % 97 == 1:
                add(*m.span(), "iban", normal)
        for kind, pattern in (("card", _CARD), ("ssn", _SSN), ("phone", _PHONE)):
            for m in pattern.finditer(text):
                normal = re.sub(r"\D", "", m.group())
                if kind != "phone" or 9 <= len(normal) <= 15:
                    add(*m.span(), kind, normal)
    if any(t in text for t in _GENDER):
        people: dict[str, str] = {}
        for m in _NAME.finditer(text):
            gender = _GENDER[m.group(1)]
            for w in re.finditer(r"[^\W\d_]+", m.group(2)):
                word = w.group()
                people.setdefault(word, gender)
                add(m.start(2) + w.start(), m.start(2) + w.end(), "name", f"{people[word]}:{word.lower()}")
        for m in re.finditer(r"\w+", text) if people else ():  # later mentions without a form of address
            if gender := people.get(m.group()):
                add(*m.span(), "name", f"{gender}:{m.group().lower()}")
    return sorted(taken)


class Surrogates:
    """Keyed surrogates; draws has the entities that need another than the first."""

    def __init__(self, key: bytes, draws: dict[tuple[str, str], int] | None = None):
        self.key, self.draws = key, draws or {}
        self.of = lru_cache(200_000)(self._of)

    def _number(self, *parts: object) -> int:
        return int.from_bytes(hmac.digest(self.key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), "sha256")[:16])

    def permuted(self, value: int, size: int, tweak: str) -> int:
        """A keyed permutation of range(size): a balanced Feistel network on enough bits, walked until inside."""
        if size < 2:
            return value
        half = ((size - 1).bit_length() + 1) // 2
        mask = (1 << half) - 1
        while True:
            a, b = value >> half, value & mask
            for turn in range(8):
                a, b = b, a ^ (self._number("f", tweak, turn, b) & mask)
            value = a << half | b
            if value < size:
                return value

    def digits(self, text: str, tweak: str) -> str:
        return str(self.permuted(int(text), 10 ** len(text), f"{tweak}/{len(text)}")).zfill(len(text)) if text else ""

    def letters(self, text: str, tweak: str) -> str:
        """Letters to letters and digits to digits, place by place; the rest stays, and with it the format."""
        value, size, form = 0, 1, []
        for c in text:
            base = 10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" else 0
            form.append(base)
            if base:
                value, size = value * base + (ord(c) - (48 if base == 10 else 97)), size * base
        value = self.permuted(value, size, f"{tweak}/{''.join(f'{c if not b else b}.' for c, b in zip(text, form, strict=True))}")
        out = []
        for c, base in zip(reversed(text), reversed(form), strict=True):
            if base:
                value, d = divmod(value, base)
                c = chr(d + (48 if base == 10 else 97))
            out.append(c)
        return "".join(reversed(out))

    def normal(self, kind: str, entity: str, draw: int) -> str:
        """The surrogate's normal form. A draw below 0 is a place in a private network that was dealt by rank."""
        tweak = f"{kind}/{draw}"
        if kind == "email":
            local, _, domain = entity.partition("@")
            labels = domain.split(".")
            safe = labels[-2:] in (["example", "com"], ["example", "org"], ["example", "net"]) or labels[-1] in ("example", "test", "invalid")
            keep = (2 if labels[-1] in ("com", "org", "net") else 1) if safe else 0
            own, rest = labels[: len(labels) - keep], labels[len(labels) - keep :]
            shown = [self.letters(x, "domain") for x in (own if keep else own[:-1])] + ([] if keep else [own[-1], "example"])
            return f"{self.letters(local + 'a' * (draw // 2), f'{tweak}/{domain}')}@{'.'.join([*shown, *rest])}"
        if kind == "ipv4":
            n = int.from_bytes(bytes(map(int, entity.split("."))))
            for head, width in _NETS:
                if n >> width == head >> width:
                    n = head | (-1 - draw if draw < 0 else self.permuted(n & (1 << width) - 1, 1 << width, f"{tweak}/{head}"))
                    return ".".join(map(str, n.to_bytes(4)))
            while True:  # public addresses only, which a walk along the permutation comes back to
                n = self.permuted(n, 1 << 32, tweak)
                a, b = n >> 24, n >> 16 & 255
                if not (a in (10, 127) or n >> 16 == 0xC0A8 or (a == 172 and 16 <= b < 32) or n >> 16 == 0xA9FE):
                    return ".".join(map(str, n.to_bytes(4)))
        if kind == "card":
            if _luhn(entity):
                body = self.digits(entity[:-1], f"{tweak}/valid")
                return body + next(c for c in "0123456789" if _luhn(body + c))
            while True:
                entity = self.digits(entity, tweak)
                if not _luhn(entity):
                    return entity
        if kind == "iban":
            body = self.letters(entity[4:].lower(), f"{tweak}/{entity[:2]}").upper()
            rest = int("".join(str(int(c, 36)) for c in body + entity[:2]) + "00") % 97
            return f"{entity[:2]}{98 - rest:02d}{body}"
        if kind == "phone" and len(entity) > 10:  # with a country's number, which stays, however it was written
            lead = 1 if entity[0] in "17" else 2
            return entity[:lead] + self.digits(entity[lead:], f"{tweak}/{entity[:lead]}")
        if kind in ("phone", "ssn"):
            return self.digits(entity, tweak)
        gender, _, word = entity.partition(":")
        script = _script(word)
        parts, n, out = _SYLLABLES[script].split(), self._number(kind, word, draw), ""
        for _ in range(min(4 + draw, 20)):  # a larger space at each draw
            n, d = divmod(n, len(parts))
            out += parts[d]
        return f"{gender}:{out}{_ENDINGS[script][gender]}"

    def _of(self, kind: str, entity: str) -> str:
        return self.normal(kind, entity, self.draws.get((kind, entity), 0))

    def shaped(self, kind: str, entity: str, surface: str) -> str:
        """The surrogate written as the mention was: its separators and its case."""
        new = self.of(kind, entity)
        if kind == "name":
            new = new.partition(":")[2]
            return new.upper() if surface.isupper() and len(surface) > 1 else new.capitalize() if surface[:1].isupper() and _script(new) != "georgian" else new
        if kind == "email":
            return "".join(c.upper() if i < len(surface) and surface[i].isupper() else c for i, c in enumerate(new))
        if kind == "ipv4":
            return new
        chars = iter(new)
        return "".join(next(chars, "") if c.isalnum() else c for c in surface)

    def replaced(self, text: str | None, found: list[tuple[int, int, str, str]]) -> str | None:
        if not found:
            return text
        out, at = [], 0
        for a, b, kind, entity in found:
            out += [text[at:a], self.shaped(kind, entity, text[a:b])]
            at = b
        return "".join([*out, text[at:]])


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct entities of a table: kind and entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = sorted({(k, e) for t in batch.column(0).to_pylist() for _, _, k, e in find(t)})
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen]), pa.array([e for _, e in seen])], names=["kind", "entity"])

    return map_arrow(docs.select(F.col(quoted(text)).alias("_text")), run, "kind string, entity string").distinct()


def collisions(known: DataFrame, key: bytes) -> DataFrame:
    """Entities that need another draw than the first, as (kind, entity, draw), so that no two share a surrogate and none gets an entity's."""

    def drawn(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            make = Surrogates(key)
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("kind", "entity", "draw")]
                made = [make.normal(*row) for row in zip(*cols, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("kind", "entity", "draw")] + [pa.array(made, pa.string())], names=["kind", "entity", "draw", "made"])

        return map_arrow(rows, run, "kind string, entity string, draw int, made string")

    # what a surrogate must differ in: the name itself, without its gender
    plain = lambda c: F.when(F.col("kind") == "name", F.substring_index(F.col(c), ":", -1)).otherwise(F.col(c))
    rows = saved(drawn(known.withColumn("draw", F.lit(0))))
    real = rows.select("kind", plain("entity").alias("shown")).distinct()
    for turn in range(MOST_ROUNDS):
        named = rows.withColumn("shown", plain("made"))
        keeps = named.groupBy("kind", "shown").agg(F.min("entity").alias("first"), F.count(F.lit(1)).alias("n"))
        doubtful = keeps.where("n > 1").join(real, ["kind", "shown"], "left_anti").select("kind", "shown", "first").unionByName(keeps.join(real, ["kind", "shown"], "left_semi").select("kind", "shown", F.lit(None).cast("string").alias("first")))
        again = saved(named.join(doubtful, ["kind", "shown"]).where("first is null or entity != first").select("kind", "entity", "draw"))
        if again.isEmpty():
            return rows.where("draw != 0").select("kind", "entity", "draw")
        kept = rows.join(again, ["kind", "entity"], "left_anti")
        more = again.withColumn("draw", F.col("draw") + 1)
        if turn >= MOST_DRAWS:
            private = (F.col("kind") == "ipv4") & _net("entity").isNotNull()
            more = more.where(~private).unionByName(_dealt(again.where(private), kept, real, key))
        rows = saved(kept.unionByName(drawn(more)))
    raise RuntimeError(f"{again.count()} entities have no surrogate of their own after {MOST_ROUNDS} rounds")


def _address(c: str) -> Column:
    parts = F.split(F.col(c), r"\.")
    return sum((parts[i].cast("long") * (1 << 24 - 8 * i) for i in range(4)), F.lit(0).cast("long"))


def _net(c: str) -> Column:
    """Which of _NETS an address is in, or null."""
    return F.coalesce(*[F.when(F.shiftright(_address(c), width) == head >> width, i) for i, (head, width) in enumerate(_NETS)])


def _dealt(again: DataFrame, kept: DataFrame, real: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, draw) of private addresses: the free ones of their network in a keyed order, by rank."""
    wanted = again.withColumn("net", _net("entity")).withColumn("rank", F.row_number().over(Window.partitionBy("net").orderBy("entity")))
    nets = {r.net: r.n for r in wanted.groupBy("net").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a network
    used = kept.where("kind = 'ipv4'").select(_address("made").alias("value")).unionByName(real.where("kind = 'ipv4'").select(_address("shown").alias("value")))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Surrogates(key)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([make._number("rank", v).to_bytes(16) for v in batch.column("value").to_pylist()], pa.binary())], names=["net", "value", "turn"])

    out = again.select("kind", "entity", "draw").limit(0)
    for net, n in sorted(nets.items()):
        head, width = _NETS[net]
        free = again.sparkSession.range(head, head + (1 << width)).select(F.lit(net).alias("net"), F.col("id").alias("value")).join(used, "value", "left_anti").select("net", "value")
        # a network's addresses are a fixed number, whatever the size of the corpus
        free = saved(map_arrow(free, order, "net int, value long, turn binary").withColumn("rank", F.row_number().over(Window.partitionBy("net").orderBy("turn"))))
        if (room := free.count()) < n:
            raise RuntimeError(f"{n} addresses of network {head >> 24}.{head >> 16 & 255} need a surrogate and {room} are free")
        out = out.unionByName(wanted.join(free, ["net", "rank"]).select("kind", "entity", (F.lit(head - 1) - F.col("value")).cast("int").alias("draw")))
    return out


def replace(docs: DataFrame, key: bytes, keep: tuple[str, ...] = ("doc_id",), text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """keep's columns, text with surrogates, n_entities and spans (kind:start:end in the original)."""
    again = collisions(entities(docs, text) if known is None else known, key)
    told = again.limit(MOST_TOLD + 1).collect()
    own = passed(keep, ("text", "n_entities", "spans"))
    held, draws = fresh(own, "_held"), {(r.kind, r.entity): r.draw for r in told}
    if len(told) > MOST_TOLD:
        draws = {}
    value, more = F.col(quoted(text)), F.lit(None).cast(_DRAWS)
    kept = docs.select(F.struct(*[F.col(quoted(c)) for c in own]).alias("own"), value.alias("text")) if own else docs.select(F.struct(F.lit(0)).alias("own"), value.alias("text"))
    kept = _with_draws(kept, again) if len(told) > MOST_TOLD else kept.withColumn("draws", more)
    kept = kept.select("own", F.struct("text", "draws").alias(held))

    def make():
        whole = Surrogates(key, draws)

        def each(rows: list) -> tuple[list, None]:
            out = []
            for r in rows:
                by = Surrogates(key, {(x["kind"], x["entity"]): x["draw"] for x in r["draws"]}) if r["draws"] else whole
                found = find(r["text"])
                out.append((by.replaced(r["text"], found), len(found), ",".join(f"{k}:{a}:{b}" for a, b, k, _ in found)))
            return columns_of(out, 3), None

        return each

    out = map_texts(kept, make, "text string, n_entities int, spans string", ("own",), held)
    return out.select(*[F.col(f"own.{quoted(c)}") for c in own], "text", "n_entities", "spans")


_DRAWS = "array<struct<kind:string,entity:string,draw:int>>"


def _with_draws(rows: DataFrame, again: DataFrame) -> DataFrame:
    """rows (own, text) with draws: the other draws that entities of the text need, joined by the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [(h, k, e) for h, t in zip(batch.column("h").to_pylist(), batch.column("t").to_pylist(), strict=True) for k, e in {(k, e) for _, _, k, e in find(t)}]
            cols = list(zip(*seen, strict=True)) if seen else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.string()), strict=True)], names=["h", "kind", "entity"])

    hashed = rows.withColumn("h", F.sha2(F.col("text"), 256))
    mentions = map_arrow(hashed.select("h", F.col("text").alias("t")), run, "h string, kind string, entity string").distinct()
    lists = mentions.join(again, ["kind", "entity"]).groupBy("h").agg(F.collect_list(F.struct("kind", "entity", "draw")).alias("draws"))  # as many as a text has mentions
    return hashed.join(lists, "h", "left").drop("h")


def key_of(secret: str) -> bytes:
    return hashlib.sha256(secret.encode()).digest()
