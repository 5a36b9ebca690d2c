"""Surrogates for personal data.

Detected entities (e-mail addresses, telephone and payment card numbers, IP addresses, secrets and
personal names) are replaced by keyed stand-ins of the same kind and format:

* digits stand for digits and letters for letters of the same script and case; separators stay;
* card numbers stay valid (Luhn), addresses stay addresses under example domains;
* given names become given names of the same gender and script, family names invented ones of the
  same script.

The stand-in follows from a secret key and the entity alone, whatever its spelling (case, grouping),
so mentions of one entity agree across documents and later runs. It is then checked: no two entities
may share one, and none may be an entity that is found in the documents. Entities that fail draw
again, in an order that does not depend on how rows are stored, until all are distinct.

What is found is what ``PATTERNS`` and ``GIVEN`` hold, no more: persons by a fixed list of 64 given
names (48 Latin, 16 Cyrillic) with one capitalised word behind; telephone numbers with "+" or as
ddd-ddd-dddd and (ddd) ddd-dddd; secrets behind a key word; IPv4 addresses. Other names and scripts,
other telephone numbers, national ids, IBANs, IPv6 addresses and bare secrets stay in clear text.

Null texts stay null; empty ones stay empty; repeated rows and rows with one id get the same
stand-ins; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustmart.llm.common import ship, stored

# Given names by script and gender.
GIVEN = {
    ("latin", "m"): "Carlos Charles David François Hans Jacques James Javier John Joseph José Jürgen "
    "Klaus Michael Miguel Paul Pedro Peter Pierre Richard Robert Thomas William Wolfgang".split(),
    ("latin", "f"): "Barbara Camille Carmen Dolores Elizabeth Emily Helga Isabelle Jennifer Jessica "
    "Karen Linda Lucía Margaret Mary Monika Patricia Pilar Rosa Sabine Sarah Sophie Susan Ursula".split(),
    ("cyrillic", "m"): "Алексей Борис Владимир Дмитрий Иван Михаил Николай Сергей".split(),
    ("cyrillic", "f"): "Анна Екатерина Елена Ирина Людмила Мария Наталья Ольга".split(),
}
GROUP_OF = {name.lower(): group for group, names in GIVEN.items() for name in names}
#: Syllables of invented family names by script.
SYLLABLES = {
    "latin": "ba be bo da del den dor fa fel gar gel hol kam kel kor la len lin lo ma mer min mor na nel "
    "nor pa pel por ra rel ron sa sel son ta tel tor va vel von wa wel win".split(),
    "cyrillic": "ба бо ва вел гор дан дор ка кол лен лин ло ма мир мор на нев ор пав рам род са сол та "
    "тор фед".split(),
}

#: Octets of an address.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PATTERNS = {
    "secret": re.compile(
        r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b\s*[:=]\s*[\"']?([A-Za-z0-9_\-/+]{16,})"
    ),
    "email": re.compile(r"([A-Za-z0-9](?:[A-Za-z0-9._%+\-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,})"),
    "phone": re.compile(r"(?<![\w.])(\+\d{1,3}[ .\-]?\(?\d{2,4}\)?(?:[ .\-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?![\w\-])"),
    "card": re.compile(r"(?<![\d.\-])(\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}|\d{4}[ \-]?\d{6}[ \-]?\d{5})(?![\d])"),
    "ip": re.compile(rf"(?<![\w.])({_OCTET}(?:\.{_OCTET}){{3}})(?![\w]|\.\d)"),
}
_CAPITALIZED = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][\w'’\-]+"
PERSON = re.compile(rf"\b({_CAPITALIZED}) ({_CAPITALIZED})")
#: What a text must hold before a pattern is tried on it.
HINTS = {"email": "@", "secret": re.compile(r"[:=]"), "phone": re.compile(r"[-+(]"), "card": re.compile(r"\d{4}"), "ip": re.compile(r"\d\.\d")}


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    doubled = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def canonical(kind: str, value: str) -> str:
    """The same for all spellings of an entity."""
    if kind in ("phone", "card"):
        return re.sub(r"\D", "", value)
    return value.lower()


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, value) of the entities of a text, in order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in PATTERNS.items():
        hint = HINTS[kind]
        if not (hint in text if isinstance(hint, str) else hint.search(text)):
            continue
        for m in pattern.finditer(text):
            if kind == "card":
                digits = canonical("card", m[1])
                if not 13 <= len(digits) <= 19 or not luhn(digits):
                    continue
            found.append((m.start(1), m.end(1), kind, m[1]))
    # A name that stands alone is taken for a person's if its full form stands in the text.
    families = set()
    people = False
    for m in PERSON.finditer(text):
        if m[1].lower() in GROUP_OF:
            people = True
            families.add(m[2])
            found.append((m.start(1), m.end(1), "given", m[1]))
            found.append((m.start(2), m.end(2), "family", m[2]))
    if people:
        for m in re.finditer(r"\b(?:" + "|".join(map(re.escape, sorted(families))) + r")\b", text):
            found.append((m.start(), m.end(), "family", m[0]))
        for m in re.finditer(rf"\b{_CAPITALIZED}", text):
            if m[0].lower() in GROUP_OF:
                found.append((m.start(), m.end(), "given", m[0]))
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int, str, str]] = []
    for x in found:
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def _stream(key: bytes, *parts: str) -> Iterator[int]:
    """Keyed pseudo-random bytes."""
    block = 0
    while True:
        yield from hmac.digest(key, "\x1f".join([*parts, str(block)]).encode(), hashlib.sha256)
        block += 1


def _shaped(value: str, draw: Iterator[int], letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """Digits for digits, letters for letters; the rest stays."""
    pick = lambda alphabet: alphabet[(next(draw) * 256 + next(draw)) % len(alphabet)]
    return "".join(
        pick("0123456789") if c.isdigit() else pick(letters) if c.isalpha() else c for c in value
    )


def stand_in(kind: str, value: str, key: bytes, attempt: int) -> str:
    """The stand-in of an entity (canonical) in canonical form. ``attempt`` counts failed checks;
    from the eighth on, formats with little room are left for wider ones."""
    draw = _stream(key, kind, value, str(attempt))
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        host = [_shaped(x, draw) for x in labels[:-2]] or [_shaped("abcd", draw)]
        more = _shaped("abc00", draw) if attempt >= 8 else ""
        return f"{_shaped(local, draw)}{more}@{'.'.join(host)}.example.{labels[-1]}"
    if kind == "ip":
        if attempt >= 8:
            return ".".join(str(1 + next(draw) % 254) for _ in range(4))
        low, high = {1: 1, 2: 10, 3: 100}, {1: 9, 2: 99, 3: 254}
        sizes = [len(x) for x in value.split(".")]
        return ".".join(str(low[n] + (next(draw) * 256 + next(draw)) % (high[n] - low[n] + 1)) for n in sizes)
    if kind == "card":
        body = value[0] + _shaped(value[1:-1], draw)
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "phone":
        if len(value) < 10:
            return _shaped(value, draw)
        country, rest = value[:-10], value[-10:]
        number = _shaped(rest, draw)
        fictional = rest[3:6] == "555" and attempt < 8
        return country + number[:3] + ("555" if fictional else number[3:6]) + number[6:]
    if kind == "secret":
        hexadecimal = re.fullmatch(r"[0-9a-f]+", value)
        if not hexadecimal:
            return _shaped(value, draw)
        return "".join("0123456789abcdef"[next(draw) % 16] for _ in value)
    if kind == "given":
        # A keyed turn of the list: one name for each, never the same one.
        names = [n.lower() for n in GIVEN[GROUP_OF[value]]]
        turn = 1 + next(_stream(key, "given", *map(str, GROUP_OF[value]))) % (len(names) - 1)
        return names[(names.index(value) + turn) % len(names)]
    script = "cyrillic" if re.search("[а-яё]", value) else "latin"
    some = SYLLABLES[script]
    count = max(2, round(len(value) / 3)) + attempt // 2
    return "".join(some[next(draw) % len(some)] for _ in range(count))


def dressed(kind: str, value: str, substitute: str) -> str:
    """A canonical stand-in in the spelling (grouping, case) of a mention."""
    if kind in ("phone", "card"):
        digits = iter(substitute)
        return "".join(next(digits) if c.isdigit() else c for c in value)
    if value.isupper():
        return substitute.upper()
    if kind in ("given", "family"):
        return substitute.capitalize()
    return substitute


ENTITY = "kind string, value string"


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, value) of the distinct entities of each row, in canonical form."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (doc_id, kind, value)
                for doc_id, text in zip(batch["doc_id"].astype(object), batch["text"], strict=True)
                for kind, value in sorted({(k, canonical(k, v)) for _, _, k, v in mentions(text)})
            ]
            frame = pd.DataFrame(rows, columns=["doc_id", "kind", "value"])
            frame["doc_id"] = frame["doc_id"].where(frame["doc_id"].notna(), None).astype("Int64")
            yield frame

    some = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return some.mapInPandas(find, "doc_id bigint, " + ENTITY)


def assigned(entities: DataFrame, key: bytes, most_rounds: int = 64) -> DataFrame:
    """(kind, value, substitute): distinct stand-ins for distinct entities.

    Given names take their turn of a list and need no check. Of entities that drew the same stand-in
    the one with the smallest keyed hash keeps it. Each round writes what it has settled.
    """

    def draw(attempt: int):
        @F.pandas_udf("string")
        def of(kinds: pd.Series, values: pd.Series) -> pd.Series:
            return pd.Series([stand_in(k, v, key, attempt) for k, v in zip(kinds, values, strict=True)], dtype="object")

        return of("kind", "value")

    real = entities.select("kind", F.col("value").alias("substitute"))
    open_, done = entities, None
    for attempt in range(most_rounds):
        drawn = stored(open_.withColumn("substitute", draw(attempt)), "drawn")
        checked = drawn.filter("kind <> 'given'").join(real, ["kind", "substitute"], "left_anti")
        if done is not None:
            checked = checked.join(done.select("kind", "substitute"), ["kind", "substitute"], "left_anti")
        first = W.partitionBy("kind", "substitute").orderBy(F.sha2(F.col("value").cast("binary"), 256))
        checked = checked.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth")
        settled = stored(
            checked.unionByName(drawn.filter("kind = 'given'")).select("kind", "value", "substitute"), "settled"
        )
        done = settled if done is None else done.unionByName(settled)
        left = stored(drawn.join(settled, ["kind", "value"], "left_anti").select("kind", "value"), "open")
        if left.isEmpty():
            return done
        open_ = left
    raise RuntimeError(f"entities are left without a stand-in after {most_rounds} rounds")


def replaced(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with stand-ins in ``text`` and the number of replaced mentions in ``__replaced``."""
    ship(docs.sparkSession)
    found = stored(_found(docs), "mentions")
    pairs = assigned(found.select("kind", "value").distinct(), key)
    # A document's own stand-ins; rows without id look theirs up under a null id.
    own = (
        found.distinct()
        .join(pairs, ["kind", "value"])
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("kind", "value", "substitute")).alias("__pairs"))
        .withColumnRenamed("doc_id", "__doc")
    )

    @F.pandas_udf("text string, replaced int")
    def swap(texts: pd.Series, pairs: pd.Series) -> pd.DataFrame:
        out, counts = [], []
        for text, some in zip(texts, pairs, strict=True):
            if text is None or some is None:
                out.append(text)
                counts.append(0)
                continue
            of = {(p["kind"], p["value"]): p["substitute"] for p in some}
            pieces, at, n = [], 0, 0
            for begin, end, kind, value in mentions(text):
                pieces += [text[at:begin], dressed(kind, value, of[kind, canonical(kind, value)])]
                at, n = end, n + 1
            out.append("".join(pieces) + text[at:])
            counts.append(n)
        return pd.DataFrame({"text": out, "replaced": counts})

    # Only rows with a mention go through Python again.
    joined = docs.join(own, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")), "left")
    joined = joined.withColumn(
        "__swap", F.when(F.col("__pairs").isNotNull(), swap(F.col("text").cast("string"), F.col("__pairs")))
    )
    text = F.when(F.col("__pairs").isNotNull(), F.col("__swap.text")).otherwise(F.col("text"))
    count = F.coalesce(F.col("__swap.replaced"), F.lit(0))
    return joined.withColumns({"text": text, "__replaced": count}).select(*docs.columns, "__replaced")
