"""Personal data in texts: patterns propose spans, checksums confirm them, context adjusts.

DataFrame functions only. A kind's spans come from two passes of its pattern: the matches, and
the text between them, whose lengths give the places. A text without a match makes one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each pattern is the plain one in its comment, written so that no text takes more than linear
# time or deep recursion: possessive, and started only where a longer match can't start earlier.
#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: [0-9]([\x20-]?[0-9])+
CARD = r"[0-9](?:[\x20-]?[0-9])++"
#: \+[0-9][\x20().0-9-]+[0-9]
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Account numbers: two capitals, two digits, then 11 to 30 capitals or digits in groups.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Keys and tokens: 32 to 64 hexadecimal digits; digests look alike, so the words around tell.
SECRET = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}+(?![0-9A-Za-z])"
#: Phone numbers without a country code; only the words around them tell.
LOCAL = r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without this has no match.
    needs: str
    #: Words that make the kind likelier when they stand near, as a pattern on lower case.
    context: str
    #: Score without and with such a word.
    alone: float
    with_context: float
    #: Base kinds stay whatever their score.
    base: bool


#: Fixed order: it breaks ties of spans that start together.
KINDS = (
    Kind("email", EMAIL, "@", r"\b(?:e-?mail|mail|contact|write|correo|courriel)\b", 0.9, 1.0, True),
    Kind("ip", IP, ".", r"\b(?:ip|address|server|host|login|adresse)\b", 0.7, 0.95, True),
    Kind("card", CARD, "", r"\b(?:card|visa|credit|payment|karte|carte|tarjeta)\b", 0.8, 1.0, True),
    Kind("phone", PHONE, "+", r"\b(?:phone|tel|call|mobile|fax|telefon|numéro|teléfono)\b", 0.8, 1.0, True),
    Kind("iban", IBAN, "", r"\b(?:iban|account|bank|konto|compte|cuenta)\b", 0.9, 1.0, False),
    Kind("local_phone", LOCAL, "", r"\b(?:phone|tel|call|mobile|fax|telefon|numéro|teléfono)\b", 0.3, 0.8, False),
    Kind("secret", SECRET, "", r"\b(?:token|secret|api|key|password|passwd|credential|schlüssel|clave)\b", 0.3, 0.9, False),
)
#: Characters on either side in which context words count.
NEAR = 40


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn checksum: every second digit from the right doubled, their digit sum a multiple of 10."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + worth(i))
    return total % 10 == 0


def _mod97(found: Column) -> Column:
    """The account checksum: first four characters moved to the end, letters as 10 to 35, modulo 97 is 1."""
    plain = F.regexp_replace(found, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0)), F.lit(0), step) == 1


def _valid(kind: Kind, found: Column) -> Column:
    digits = _digits(found)
    if kind.name == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return found.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind.name == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    if kind.name == "iban":
        return F.when(F.length(F.regexp_replace(found, r"\x20", "")).between(15, 34), _mod97(found)).otherwise(False)
    return F.lit(True)


SPAN = "struct<start:bigint,ord:int,end:bigint,kind:string,score:double>"
#: Lengths that are summed at once; sums of sums make the way to any place short.
CHUNK = 64
#: No match is shorter, so NEAR characters are within NEAR / SHORTEST matches.
SHORTEST = 2


def _chunk_sums(lengths: Column) -> Column:
    """Sums of each CHUNK of lengths."""
    chunks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int"))
    return F.transform(chunks, lambda k: _total(F.slice(lengths, k * CHUNK + 1, F.lit(CHUNK))))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda acc, n: acc + n)


def _spans(text: Column, order: int, kind: Kind) -> Column:
    """The confirmed spans of one kind, in order, in time that is linear in their number."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast(f"array<{SPAN}>")
    pieces = F.struct(found.alias("found"), F.split(text, kind.pattern, -1).alias("between"))

    def once(value: Column, use) -> Column:  # noqa: ANN001
        """A one-element array names a value once, so that it isn't made again for each use."""
        return F.flatten(F.transform(F.array(value), use))

    def measured(both: Column) -> Column:
        found, before = both["found"], F.slice(both["between"], F.lit(1), F.size(both["found"]))
        near = F.lit(NEAR)
        return once(
            F.struct(
                found.alias("found"), before.alias("before"),
                F.zip_with(before, found, lambda b, f: (F.length(b) + F.length(f)).cast("long")).alias("lengths"),
                # Of a piece and the match behind it, what can stand in the context of other matches.
                F.zip_with(before, found, lambda b, f: F.concat(F.right(b, near), F.right(f, near))).alias("last"),
                F.zip_with(before, found, lambda b, f: F.concat(F.left(b, near), F.left(f, near))).alias("first"),
                F.left(F.element_at(both["between"], -1), near).alias("rest"),
            ),
            lambda m: once(_chunk_sums(m["lengths"]), lambda sums: once(_chunk_sums(sums), lambda more: told(m, sums, more))),
        )

    def told(m: Column, sums: Column, more: Column) -> Column:
        def span(f: Column, i: Column) -> Column:
            one, two = F.floor(i / CHUNK).cast("int"), F.floor(i / (CHUNK * CHUNK)).cast("int")
            piece = F.element_at(m["before"], i + 1)
            begin = (
                _total(F.slice(more, F.lit(1), two)) + _total(F.slice(sums, two * CHUNK + 1, one - two * CHUNK))
                + _total(F.slice(m["lengths"], one * CHUNK + 1, i - one * CHUNK)) + F.length(piece)
            )
            reach = NEAR // SHORTEST
            low = F.greatest(i - reach, F.lit(0))
            before = F.right(F.concat(F.array_join(F.slice(m["last"], low + 1, i - low), ""), F.right(piece, F.lit(NEAR))), F.lit(NEAR))
            behind = F.slice(m["first"], i + 2, F.lit(reach))
            after = F.left(F.concat(F.array_join(behind, ""), m["rest"]), F.lit(NEAR))
            near = F.lower(F.concat_ws(" ", before, after)).rlike(kind.context)
            score = F.when(near, F.lit(kind.with_context)).otherwise(F.lit(kind.alone))
            return F.struct(
                begin.alias("start"), F.lit(order).alias("ord"), (begin + F.length(f)).alias("end"), F.lit(kind.name).alias("kind"), score.alias("score")
            )

        valid = F.filter(F.transform(m["found"], lambda f, i: F.struct(f.alias("f"), i.alias("i"))), lambda x: _valid(kind, x["f"]))
        spans = F.transform(valid, lambda x: span(x["f"], x["i"]))
        return spans if kind.base else F.filter(spans, lambda s: s["score"] >= 0.5)

    has = text.rlike(kind.pattern) if not kind.needs else F.contains(text, F.lit(kind.needs)) & text.rlike(kind.pattern)
    return F.when(has, once(pieces, measured)).otherwise(none)


def find_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores and more for every document.

    The counts and base_sha256 are of the base spans: for each base kind the leftmost matches
    that don't overlap, without those that fail the kind's check. ``spans`` has these and the
    added kinds: account numbers confirmed modulo 97, phone numbers without country code that a word
    near them confirms, and keys and tokens that a word near them tells from digests. Spans are kind:start:end in code points, end exclusive, by
    start and then kind; ``scores`` are theirs in the same order, raised by context words near.
    n_iban, n_local_phone and n_secret count the added kinds, and ``found`` says whether there are
    any spans.

    Null or empty text: no spans, the digest of the empty text. Null doc_id and repeated rows:
    each row by itself. Extra columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text"))
    by_kind = rows.select("doc_id", *[_spans(F.col("text"), i, k).alias(k.name) for i, k in enumerate(KINDS)])
    base = [k.name for k in KINDS if k.base]
    added = [k.name for k in KINDS if not k.base]

    def joined(names: list[str]) -> Column:
        return F.array_sort(F.flatten(F.array(*[F.col(n) for n in names])))

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return by_kind.select(
        "doc_id", *[F.size(n).cast("long").alias(f"n_{n}") for n in base],
        F.sha2(told(joined(base)), 256).alias("base_sha256"),
        told(joined(base + added)).alias("spans"),
        F.array_join(F.transform(joined(base + added), lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"),
        *[F.size(n).cast("long").alias(f"n_{n}") for n in added],
        (F.size(F.flatten(F.array(*[F.col(n) for n in base + added]))) > 0).alias("found"),
    )
