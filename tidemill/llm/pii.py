"""Personal data replaced by keyed surrogates of the same kind and shape.

Entities: e-mail addresses, telephone numbers, IPv4 addresses, payment card numbers, bank account numbers (IBAN), social
security numbers, and names behind a form of address. A surrogate is a keyed permutation of the entity's own shape: a
Feistel network over its letters and digits, so letters stay letters of the same case and script, digits digits, separators
where they are. Permutations are one to one, so different entities stay different and the same entity gets the same surrogate
in every document without any table. Checks are kept valid: card check digits, IBAN check digits, address octets. A given
name maps to another of the same gender and script; a title, which carries gender, stays.

Collision check: a surrogate that is itself an entity of the corpus, or that two entities share (kinds with check digits),
is drawn again with the next tweak; distinct entities are compared by joins, and a draw counts only after its own check.
After ``MAX_DRAWS`` draws from its own shape an entity draws from a domain that grows with every second draw: names get
further given names or letters, addresses letters, international numbers digits (15 in all). Kinds of a fixed length draw on;
an error is raised only if entities are left after ``WIDE_DRAWS`` more. The exceptions are applied from a table whose size is
checked before it is broadcast; should they not fit, every text gets its own ones by a join.

Defined results: null texts stay null with 0 entities; texts without entities are returned unchanged; overlapping finds give
the one that starts first, then the longest; rows that repeat are rewritten alike; an empty table gives no rows; only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BROADCAST_BYTES, blocks, documents, fits, row_hash, side, written

KEY = "tidemill-surrogates"
ROUNDS = 8
MAX_DRAWS = 20
WIDE_DRAWS = 40
ROUND_ENDS = (2, 5, MAX_DRAWS, MAX_DRAWS + 4, MAX_DRAWS + 12, MAX_DRAWS + WIDE_DRAWS)

_EMAIL = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_PHONE = re.compile(
    r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w]|[.-]\d)"
)
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w.-])[3-6]\d{3}(?:([ -]?)\d{4}(?:\1\d{4}){1,2}(?:\1?\d{1,3})?|[ -]\d{6}[ -]\d{5}|\d{9,11})(?![\w]|[.-]\d)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_TITLES = {
    "f": ("Mrs.", "Ms.", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "Госпожа"),
    "m": ("Mr.", "Herr", "Monsieur", "Señor", "Sr.", "Господин"),
}
_CAPITAL = "[A-ZÀ-ÖØ-ÞА-Я]"
_NAME = re.compile(
    r"(?<!\w)(" + "|".join(re.escape(t) for own in _TITLES.values() for t in own) + rf") ((?:{_CAPITAL}[^\W\d_]+[ -]){{0,2}}{_CAPITAL}[^\W\d_]+)"
)
_GIVEN = {
    ("f", "latin"): "Anna Clara Elena Emma Julia Laura Lucia Maria Nora Paula Sofia Sarah".split(),
    ("m", "latin"): "Adam Carlos David Felix Hugo Jonas Leon Martin Oscar Paul Thomas Victor".split(),
    ("f", "cyrillic"): "Анна Вера Елена Ирина Мария Нина Ольга Софья".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Иван Никита Олег Павел Юрий".split(),
}
_WHERE = {name: (who, names) for who, names in _GIVEN.items() for name in names}

_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "".join(map(chr, range(0x430, 0x450))),
              "".join(map(chr, range(0x410, 0x430))), "ßàáâäæçèéêëíîïñóôöøùúûü", "ÀÁÂÄÆÇÈÉÊËÍÎÏÑÓÔÖØÙÚÛÜ")
_CLASS = {c: own for own in _ALPHABETS for c in own}


def _draw(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()[:16], "big")


def permute(text: str, key: bytes, tweak: str) -> str:
    """Keyed permutation of all strings of one shape: every letter or digit stays in its class, other characters stay."""
    places = [i for i, c in enumerate(text) if c in _CLASS]
    out = list(text)
    if not places:
        return text
    classes = [_CLASS[text[i]] for i in places]
    shape = tweak + "".join(str(_ALPHABETS.index(c)) for c in classes)
    values = [c.index(text[i]) for i, c in zip(places, classes)]
    if len(places) == 1:
        values[0] = (values[0] + _draw(key, shape)) % len(classes[0])
    half = len(places) // 2
    sides = (range(half), range(half, len(places)))
    for turn in range(ROUNDS if len(places) > 1 else 0):
        moved, seen = sides[turn % 2], sides[1 - turn % 2]
        step = _draw(key, shape, turn, [values[i] for i in seen])
        for i in moved:  # adds a number to the mixed-radix value of this side, digit by digit, carry dropped
            step, rest = divmod(step, len(classes[i]))
            values[i] = (values[i] + rest) % len(classes[i])
    for i, c, v in zip(places, classes, values):
        out[i] = c[v]
    return "".join(out)


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_checks(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _only(text: str, wanted: str) -> str:
    return re.sub(f"[^{wanted}]", "", text)


def _refill(pattern: str, symbols: str) -> str:
    rest = iter(symbols)
    return "".join(next(rest) if c.isalnum() else c for c in pattern)


_TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def _country_code(digits: str) -> int:
    """Number of digits of the country code that an international number starts with."""
    return 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGIT_CODES else 3


def _more(key: bytes, tweak: str, value: str, symbols: str, n: int) -> str:
    rest, out = _draw(key, tweak, "more", value), ""
    for _ in range(n):
        rest, i = divmod(rest, len(symbols))
        out += symbols[i]
    return out


def canonical(kind: str, value: str) -> str:
    """What two mentions of one entity have in common; has the same surrogate as they."""
    if kind == "email":
        return value.lower()
    if kind == "phone" and value.startswith("+"):
        return "+" + _only(value, "0-9")
    if kind in ("phone", "card", "ssn"):
        return _only(value, "0-9")
    return value.replace(" ", "") if kind == "iban" else value


def surrogate(kind: str, value: str, key: bytes, draw: int = 0) -> str:
    """A replacement of the same kind and format; the same for all mentions of an entity.

    From draw ``MAX_DRAWS`` on it is longer, where the kind allows, by one symbol more with every second draw.
    """
    tweak = f"{kind}{draw}/"
    longer = max(0, (draw - MAX_DRAWS) // 2 + 1)
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        changed = permute(f"{local}@{host}".lower(), key, tweak)
        spelled = "".join(c.upper() if o.isupper() else c for o, c in zip(f"{local}@{host}", changed))
        added = _more(key, tweak, value.lower(), _ALPHABETS[1], min(longer, 64 - len(local)))
        return f"{spelled[: len(local)]}{added}{spelled[len(local) :]}.{top}"
    if kind == "ip":
        number = sum(int(o) << s for o, s in zip(value.split("."), (24, 16, 8, 0)))
        left, right = number >> 16, number & 0xFFFF
        for turn in range(ROUNDS):
            left, right = right, left ^ (_draw(key, tweak, turn, right) & 0xFFFF)
        return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"
    if kind in ("phone", "ssn"):
        digits = _only(value, "0-9")
        kept = min(_country_code(digits), len(digits) - 4) if value.startswith("+") else 0
        added = _more(key, tweak, digits, _ALPHABETS[0], min(longer, max(0, 15 - len(digits)))) if value.startswith("+") else ""
        return _refill(value, digits[:kept] + permute(digits[kept:], key, tweak + digits[:kept])) + added
    if kind == "card":
        digits = _only(value, "0-9")
        body = digits[0] + permute(digits[1:-1], key, tweak + digits[0])
        valid = luhn_digit(digits[:-1]) == digits[-1]
        return _refill(value, body + (luhn_digit(body) if valid else permute(digits[-1], key, tweak + body)))
    if kind == "iban":
        plain = value.replace(" ", "")
        body = permute(plain[4:], key, tweak + plain[:2])
        return _refill(value, plain[:2] + _iban_checks(plain[:2], body) + body)
    given, blank, rest = value.partition(" ")
    if given in _WHERE:
        who, names = _WHERE[given]
        order = sorted(names, key=lambda n: _draw(key, tweak, who, n))
        given = order[(order.index(given) + 1) % len(order)]  # one cycle over the list: one to one, never itself
        if longer and not rest:
            return "-".join([given, *(names[ord(i)] for i in _more(key, tweak, value, "".join(map(chr, range(len(names)))), longer))])
    else:
        given = permute(given, key, tweak)
    added = _more(key, tweak, value, _ALPHABETS[3 if "\u0400" <= value[-1] <= "\u04ff" else 1], longer)
    return given + blank + permute(rest, key, tweak) + added


def entities(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all entities, not overlapping, in order."""
    if not text:
        return []
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    if re.search("[0-9]", text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("iban", _IBAN), ("ssn", _SSN), ("phone", _PHONE)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    if any(t in text for own in _TITLES.values() for t in own):
        found += [(m.start(2), m.end(2), "name") for m in _NAME.finditer(text)]
    kept, end = [], 0
    for a, b, kind in sorted(found, key=lambda f: (f[0], -f[1])):
        if a >= end:
            kept.append((a, b, kind))
            end = b
    return kept


def rewrite(text: str, found: list[tuple[int, int, str]], key: bytes, draws: dict) -> str:
    out, at = [], 0
    for a, b, kind in found:
        value = text[a:b]
        out += [text[at:a], surrogate(kind, value, key, draws.get((kind, canonical(kind, value)), 0))]
        at = b
    return "".join([*out, text[at:]])


def _found(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = {(kind, canonical(kind, t[a:b])) for t in block.column("text").to_pylist() for a, b, kind in entities(t)}
            kinds, values = zip(*sorted(rows)) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (kinds, values)], names=["kind", "value"])

    return run


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, draws = (batch.column(c).to_pylist() for c in ("kind", "value", "draw"))
            new = [canonical(k, surrogate(k, v, key, d)) for k, v, d in zip(kinds, values, draws)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "value", "draw", "new"])

    return run


def checked_draws(docs: DataFrame, key: bytes) -> DataFrame:
    """The entities whose first surrogate is not free (kind, value), with the number of the first draw that is."""
    all_entities = written(docs.select("text").mapInArrow(_found(key), "kind string, value string").distinct(), "pii-entities")
    columns = "kind string, value string, draw int, new string"
    first = written(all_entities.withColumn("draw", F.lit(0)).mapInArrow(_drawn(key), columns), "pii-draws")
    # A first surrogate that is no original has one keeper, so none of these values is free, and all others are.
    used = all_entities.select("kind", F.col("value").alias("new")).unionByName(first.select("kind", "new"))
    shared = first.groupBy("kind", "new").agg(F.count("*").alias("_n"), F.min("value").alias("_keeps"))
    again = first.join(shared.filter("_n > 1").drop("_n"), ["kind", "new"]).filter("value != _keeps").select("kind", "value")
    taken = first.join(all_entities.select("kind", F.col("value").alias("new")), ["kind", "new"], "left_semi").select("kind", "value")
    again = written(taken.unionByName(again).distinct(), "pii-again")
    exceptions, begin = first.limit(0), 1
    for end in ROUND_ENDS:  # one round takes the first free draw of each entity; who loses it to another goes to the next round
        if not again.limit(1).count():
            break
        draws = again.withColumn("draw", F.explode(F.sequence(F.lit(begin), F.lit(end - 1))))
        moved = written(draws.mapInArrow(_drawn(key), columns), "pii-draws")
        met = used.join(side(moved.select("kind", "new"), 200), ["kind", "new"], "left_semi").distinct()
        free = moved.join(met, ["kind", "new"], "left_anti").groupBy("kind", "value").agg(F.min(F.struct("draw", "new")).alias("_first"))
        free = free.select("kind", "value", "_first.*").groupBy("kind", "new").agg(F.min(F.struct("value", "draw")).alias("_first"))
        settled = written(free.select("kind", "_first.*", "new"), "pii-settled")
        again = written(again.join(settled, ["kind", "value"], "left_anti"), "pii-again")
        used = used.unionByName(settled.select("kind", "new"))
        exceptions, begin = exceptions.unionByName(settled), end
    if again.limit(1).count():
        raise ValueError("surrogates cannot be told apart; the corpus holds nearly all values of a kind")
    return written(exceptions.select("kind", "value", "draw"), "pii-exceptions")


def _with_own_draws(rows: DataFrame, exceptions: DataFrame, key: bytes) -> DataFrame:
    """``rows`` with the exceptions among their own entities (_draws), for exceptions that fit no broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out = []
            for doc_id, tie, text in zip(*(block.column(c).to_pylist() for c in ("doc_id", "_hash", "text"))):
                own = sorted({(kind, canonical(kind, text[a:b])) for a, b, kind in entities(text)})
                out += [(doc_id, tie, kind, value) for kind, value in own]
            columns = list(zip(*out)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["_id", "_tie", "kind", "value"])

    hashed = rows.withColumn("_hash", row_hash())
    own = hashed.mapInArrow(run, "_id bigint, _tie bigint, kind string, value string").distinct().join(exceptions, ["kind", "value"])
    own = own.groupBy("_id", "_tie").agg(F.collect_list(F.struct("kind", "value", "draw")).alias("_draws"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie"))
    return hashed.join(own, same, "left").select("doc_id", "text", "_draws")


def replace_pii(docs: DataFrame, secret: str = KEY, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_entities and text with surrogates, for every row."""
    key = secret.encode()
    exceptions = checked_draws(docs, key)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    table = {}
    if fits(exceptions, 200, broadcast_bytes):
        table = {(r.kind, r.value): r.draw for r in exceptions.collect()}
        rows = rows.withColumn("_draws", F.lit(None).cast("array<struct<kind:string,value:string,draw:int>>"))
    else:
        rows = _with_own_draws(rows, exceptions, key)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            counts, texts = [], []
            for text, own in zip(block.column("text").to_pylist(), block.column("_draws").to_pylist()):
                found = entities(text)
                draws = shared.value if own is None else {(d["kind"], d["value"]): d["draw"] for d in own}
                counts.append(len(found))
                texts.append(rewrite(text, found, key, draws) if found else text)
            arrays = [block.column("doc_id"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_entities", "text"])

    return rows.mapInArrow(run, "doc_id bigint, n_entities bigint, text string")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir))
